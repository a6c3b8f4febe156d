"""Small configuration files: redaction policies, category trees of two versions, canonical JSON."""

from __future__ import annotations

import hashlib
import json
import os
import re
import tempfile
import tomllib
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.operators.invariants import LAYERS


class ConfigError(ValueError):
    """A configuration that can't be used; the message says why."""


@dataclass(frozen=True)
class Policy:
    """Ordered text rules (pattern, replacement), three lists of logos, and the file's hash."""

    enabled: bool
    rules: tuple[tuple[str, str], ...]
    logo_sha256: tuple[str, ...]
    logo_files: tuple[str, ...]
    logo_texts: tuple[str, ...]
    sha256: str


def policy(path: str, required: bool = False) -> Policy | None:
    """The redaction policy in a TOML file; None where there is none and none is required."""
    if not os.path.isfile(path):
        if required:
            raise ConfigError(f"no redaction policy at {path}")
        return None
    with open(path, "rb") as f:
        raw = f.read()
    try:
        red = tomllib.loads(raw.decode("utf-8")).get("redaction", {})
    except (tomllib.TOMLDecodeError, UnicodeDecodeError) as e:
        raise ConfigError(f"{path} is no TOML: {e}") from e
    rules = tuple((str(r.get("pattern", "")), str(r.get("replacement", "[REDACTED]"))) for r in red.get("text", []))
    for pattern, _ in rules:
        try:
            re.compile(pattern)
        except re.error as e:
            raise ConfigError(f"the pattern {pattern!r} is wrong: {e}") from e
    logos = red.get("logos", {})
    return Policy(bool(red.get("enabled", False)), rules, *(tuple(logos.get(k, ())) for k in ("sha256", "filename_globs", "alt_globs")), hashlib.sha256(raw).hexdigest())


def upgraded(tree: dict) -> dict:
    """A category tree of version 1 as one of version 2: its categories become systems. Version 2
    comes back as it is."""
    if int(tree.get("version", 1)) >= 2:
        return tree
    listed = ("prd_headings", "linked_specs", "keywords")
    systems = [{"slug": c.get("slug", ""), "title": c.get("title", ""), "layer": LAYERS[0], "pes_headings": [], "children": [], **{k: list(c.get(k, [])) for k in listed}} for c in tree.get("categories", []) if isinstance(c, dict)]
    return {"version": 2, "source_prd": tree.get("source_prd", ""), "source_pes_glob": None, "categories": systems}


def tree_problems(tree: dict) -> list[str]:
    """What is wrong with a category tree: its version, empty or doubled slugs, unknown layers, layers
    that don't follow their parent's, too many levels."""
    out = [] if tree.get("version") == 2 else [f"version {tree.get('version')}"]
    stack = [(tree.get("categories", []), 0, "")]
    while stack:
        nodes, depth, at = stack.pop()
        seen: set[str] = set()
        for n in nodes:
            slug, place = str(n.get("slug", "")), f"{at}/{n.get('slug', '')}"
            if not slug.strip():
                out.append(f"empty slug at {place}")
            elif slug in seen:
                out.append(f"duplicate slug at {place}")
            seen.add(slug)
            if depth >= len(LAYERS):
                out.append(f"too deep at {place}")
            elif n.get("layer") not in LAYERS:
                out.append(f"unknown layer at {place}")
            elif n["layer"] != LAYERS[depth]:
                out.append(f"wrong layer at {place}")
            stack.append((n.get("children") or [], depth + 1, place))
    return sorted(out)


def load_tree(path: str) -> dict:
    """A category tree from a file, of version 2 and without problems."""
    with open(path, encoding="utf-8") as f:
        tree = upgraded(json.load(f))
    if bad := tree_problems(tree):
        raise ConfigError("; ".join(bad[:5]))
    return tree


def save_tree(tree: dict, path: str) -> None:
    """Writes a category tree beside its place and moves it there; the order of keys is kept."""
    if bad := tree_problems(tree):
        raise ConfigError("; ".join(bad[:5]))
    replace(path, json.dumps(tree, ensure_ascii=False, indent=2) + "\n")


def replace(path: str, text: str) -> None:
    """Writes a text file so that readers see the old or the new one, never a part."""
    folder = os.path.dirname(os.path.abspath(path))
    os.makedirs(folder, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=folder, suffix=".tmp")
    try:
        with os.fdopen(handle, "w", encoding="utf-8", newline="\n") as f:
            f.write(text)
        os.replace(name, path)
    except BaseException:
        os.unlink(name)
        raise


def rows_of(spark: SparkSession, tree: dict) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rule tables of a tree for routing: specs (ord, slug, glob), keywords (ord, slug, keyword) and
    headings (ord, slug, heading), numbered in the order in which nodes are written; slugs are paths."""
    specs, words, heads, n = [], [], [], 0
    stack = [(c, c.get("slug", "")) for c in reversed(tree.get("categories", []))]
    while stack:
        node, path = stack.pop()
        n += 1
        specs += [(n, path, x) for x in node.get("linked_specs", [])]
        words += [(n, path, x) for x in node.get("keywords", [])]
        heads += [(n, path, x) for x in node.get("prd_headings", [])]
        stack.extend((c, f"{path}/{c.get('slug', '')}") for c in reversed(node.get("children") or []))
    return tuple(spark.createDataFrame(r, f"ord int, slug string, {c} string") for r, c in ((specs, "glob"), (words, "keyword"), (heads, "heading")))


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys, two spaces of indent, characters as they are and one line feed at the
    end. Indents need Python; the input must be valid JSON or null."""
    def of(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else json.dumps(json.loads(t), ensure_ascii=False, sort_keys=True, indent=2) + "\n")

    return F.pandas_udf(of, "string")(text)
