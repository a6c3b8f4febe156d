"""Deeply nested records as related flat tables.

One pass over the records: a depth-first visitor with a stack of its own emits a row for every
node and every entry of a nested list, tagged with its table, with its key, its parent's key and
its own fields as JSON. The tagged rows are written once, partitioned by the tag, in the folder that
all executors share (``stored``); each table is then a typed read of its partition (``typed``), so a
record is parsed once however many tables come from it.

No record can end a query: texts that are no JSON give no rows, code points that are half a pair become
the replacement character, depth has no bound, numbers too large for the machine stay as text, and what
fails all the same gives one row with the tag ``caught``.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.tables import first_deliveries, shared_folder

EMITTED = "tag string, record_kind string, record_id long, key string, parent_key string, ord int, payload string"

#: Schemas of the tables, by tag; the payload holds the fields as JSON.
SCHEMAS = {
    "node": "node_id string, slug string, title string, anchor string, level int, layer string, page_start int, page_end int, language string",
    "asset": "kind string, rel_path string, page int, alt string",
    "table": "anchor string, page int",
    "table_row": "cells array<string>",
    "entry": "field string, value string",
    "caught": "error string",
}

_OPEN = re.compile(r'[\s]*(?:([{\[\]},:])|("(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*")|(-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?)|(true|false|null))')


def _no_constant(name: str) -> None:
    raise ValueError(name)


def _whole(digits: str) -> int | str:
    """A whole number; one with more digits than Python reads stays a text."""
    return int(digits) if len(digits) <= 4000 else digits


def _real(digits: str) -> float | str:
    """A number with a point or an exponent; one beyond the range stays a text."""
    x = float(digits)
    return x if abs(x) != float("inf") else digits


def _deep_loads(text: str) -> object:
    """A JSON parser with a stack of its own, for trees deeper than the C parser goes."""
    at, end = 0, len(text.rstrip(" \t\r\n"))
    stack: list[tuple[object, object]] = []  # container, key that waits for its value
    root: list[object] = []
    key: object = None
    state = "value"

    def put(value: object) -> None:
        nonlocal key, state
        if not stack:
            root.append(value)
            state = "end"
            return
        box = stack[-1][0]
        if isinstance(box, list):
            box.append(value)
        else:
            box[key] = value
        state = "comma"

    while at < end:
        m = _OPEN.match(text, at)
        if not m or state == "end":
            raise ValueError(f"not JSON at {at}")
        at = m.end()
        sign, string, number, word = m.groups()
        box = stack[-1][0] if stack else None
        if sign in ("}", "]"):
            if not stack or isinstance(box, list) != (sign == "]") or state not in ("comma", "first", "firstkey"):
                raise ValueError(f"not JSON at {at}")
            box, key = stack.pop()
            put(box)
        elif sign == "," and state == "comma":
            state = "value" if isinstance(box, list) else "key"
        elif sign == ":" and state == "colon":
            state = "value"
        elif string and state in ("key", "firstkey"):
            key, state = json.loads(string), "colon"
        elif state not in ("value", "first"):
            raise ValueError(f"not JSON at {at}")
        elif sign in ("{", "["):
            stack.append(({} if sign == "{" else [], key))
            state = "firstkey" if sign == "{" else "first"
        elif sign:
            raise ValueError(f"not JSON at {at}")
        else:
            put(json.loads(string or word) if not number else (_whole if re.fullmatch(r"-?\d+", number) else _real)(number))
    if state != "end":
        raise ValueError("not JSON: it ends early")
    return root[0]


def parse(text: str | None) -> object:
    """The value of a JSON text; raises ValueError for what isn't strict JSON."""
    if not isinstance(text, str):
        raise ValueError("no text")
    try:
        return json.loads(text, parse_constant=_no_constant, parse_int=_whole, parse_float=_real)
    except RecursionError:
        return _deep_loads(text)


def as_list(value: object) -> list:
    """``value`` as the list that it stands for.

    A list is itself, null an empty list, a single object a list of one, an object with only
    numbers as keys its values in the order of the numbers, and a text its JSON value as a list.
    Anything else stands for no list.
    """
    if isinstance(value, str):
        try:
            value = parse(value)
        except ValueError:
            return []
        return [] if isinstance(value, str) else as_list(value)
    if isinstance(value, dict):
        if value and all(isinstance(k, str) and k.isascii() and k.isdigit() for k in value):
            return [value[k] for k in sorted(value, key=int)]
        return [value]
    return value if isinstance(value, list) else []


def find_root(value: object) -> dict | None:
    """The object with node_id ``root``, in whatever envelope; the first one in breadth."""
    level = [value]
    while level:
        after: list[object] = []
        for x in level:
            if isinstance(x, str) and x.lstrip()[:1] in ("{", "["):
                try:
                    x = parse(x)
                except ValueError:
                    continue
            if isinstance(x, dict):
                if x.get("node_id") == "root":
                    return x
                after.extend(x.values())
            elif isinstance(x, list):
                after.extend(x)
        level = after
    return None


_HALF = re.compile("[\ud800-\udfff]")


def _sound(text: str) -> str:
    """A text that can be encoded: halves of a pair that stand alone become the replacement character."""
    return text.encode("utf-16-le", "surrogatepass").decode("utf-16-le", "replace") if _HALF.search(text) else text


def dumps(value: object) -> str:
    """JSON of a value of any depth."""
    try:
        return _sound(json.dumps(value, ensure_ascii=False))
    except RecursionError:
        pass
    out: list[str] = []
    stack: list[object] = [value]
    signs = object()  # marks a text that is written as it stands
    while stack:
        x = stack.pop()
        if isinstance(x, tuple) and x[0] is signs:
            out.append(x[1])
        elif isinstance(x, dict):
            stack.append((signs, "}"))
            for i, (k, v) in reversed(list(enumerate(x.items()))):
                stack += [v, (signs, (", " if i else "") + json.dumps(k, ensure_ascii=False) + ": ")]
            out.append("{")
        elif isinstance(x, list):
            stack.append((signs, "]"))
            for i, v in reversed(list(enumerate(x))):
                stack += [v, (signs, ", ")] if i else [v]
            out.append("[")
        else:
            out.append(json.dumps(x, ensure_ascii=False))
    return _sound("".join(out))


def _fields(node: dict, nested: tuple[str, ...]) -> str:
    return dumps({k: v for k, v in node.items() if k not in nested})


def _lists(kind: str, number: int, path: str, node: dict) -> Iterator[tuple]:
    """Rows of the lists inside one node."""
    for i, asset in enumerate(as_list(node.get("assets")), 1):
        if isinstance(asset, dict):
            yield ("asset", kind, number, f"{path}/a{i}", path, i, dumps(asset))
    for i, table in enumerate(as_list(node.get("tables")), 1):
        if isinstance(table, dict):
            key = f"{path}/t{i}"
            yield ("table", kind, number, key, path, i, _fields(table, ("rows",)))
            for j, row in enumerate(as_list(table.get("rows")), 1):
                cells = [x if isinstance(x, str) else None if x is None else dumps(x) for x in as_list(row)]
                yield ("table_row", kind, number, f"{key}/r{j}", key, j, dumps({"cells": cells}))
    for field in ("prd_headings", "pes_headings", "linked_specs", "keywords"):
        for i, x in enumerate(as_list(node.get(field)), 1):
            if x is not None:
                yield ("entry", kind, number, f"{path}/{field}{i}", path, i, dumps({"field": field, "value": x if isinstance(x, str) else dumps(x)}))


NESTED = ("children", "assets", "tables", "prd_headings", "pes_headings", "linked_specs", "keywords")


def visit(kind: str, number: int, value: object) -> Iterator[tuple]:
    """Rows of one record, parents before their children, in document order."""
    if kind == "taxonomies":
        tops = as_list(value.get("categories")) if isinstance(value, dict) else []
        stack = [(str(k), None, k, x) for k, x in enumerate((x for x in tops if isinstance(x, dict)), 1)]
    else:
        root = find_root(value)
        stack = [("1", None, 1, root)] if root is not None else []
    stack.reverse()
    while stack:
        path, parent, ord_, node = stack.pop()
        yield ("node", kind, number, path, parent, ord_, _fields(node, NESTED))
        yield from _lists(kind, number, path, node)
        below = [(f"{path}.{i}", path, i, x) for i, x in enumerate(as_list(node.get("children")), 1) if isinstance(x, dict)]
        stack.extend(reversed(below))


def _emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    columns = ["tag", "record_kind", "record_id", "key", "parent_key", "ord", "payload"]
    rows: list[tuple] = []
    for batch in batches:
        for kind, number, text in zip(batch.record_kind, batch.record_id, batch.text):
            try:
                value = parse(text)
            except ValueError:
                continue
            found = visit(kind, number, value)
            while True:
                try:
                    row = next(found, None)
                except Exception as e:  # one record must not end the query; it shows by its row
                    row = ("caught", kind, number, "", None, 0, dumps({"error": f"{type(e).__name__}: {e}"[:500]}))
                if row is None:
                    break
                rows.append(row)
                if len(rows) >= 20_000:  # a wide record never waits in memory as a whole
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
    if rows:
        yield pd.DataFrame(rows, columns=columns)


def flatten(records: DataFrame) -> DataFrame:
    """Tagged rows of ``records`` (record_kind, record_id, text), columns as in ``EMITTED``.

    Texts that are null, empty or not strict JSON give no rows, as do trees without a root.
    Null entries of a list count for positions but are no nodes. Repeated node ids don't matter,
    as keys are paths. One row per record is expected; see ``documents_of``.
    """
    return records.select("record_kind", F.col("record_id").cast("long").alias("record_id"), "text").filter("record_id is not null").mapInPandas(_emit, EMITTED)


def documents_of(index_trees: DataFrame, taxonomies: DataFrame) -> DataFrame:
    """The records of both tables, deliveries counted once."""
    def once(df: DataFrame, kind: str, text: str) -> DataFrame:
        first = first_deliveries(df.select("record_id", "loaded_at", F.col(text).alias("text")), ["record_id"])
        return first.select(F.lit(kind).alias("record_kind"), "record_id", "text")

    return once(index_trees, "index_trees", "index_json").unionByName(once(taxonomies, "taxonomies", "taxonomy_json"))


def write_tables(tagged: DataFrame, path: str) -> None:
    """Writes the tagged rows once, partitioned by their tag."""
    tagged.write.mode("overwrite").partitionBy("tag").parquet(path)


def read_tables(spark: SparkSession, path: str) -> DataFrame:
    """The tagged rows of ``write_tables``, also where there are none."""
    return spark.read.schema(EMITTED).parquet(path)


MOST_FILES = 1000  # of both tables; beyond it every call writes anew
_stored: dict[tuple[str, str], str] = {}


def _state(spark: SparkSession, *tables: DataFrame) -> str | None:
    """Names, sizes and times of all files of the tables; None where they have none or too many."""
    files = [f for t in tables for f in t.inputFiles()]
    if not files or len(files) > MOST_FILES:
        return None
    seen = []
    for f in sorted(files):
        path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(f))
        status = path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path)
        seen.append((f, status.getLen(), status.getModificationTime()))
    return hashlib.sha256(repr(seen).encode()).hexdigest()


def forget() -> None:
    """The next query parses and writes anew."""
    _stored.clear()


def stored(spark: SparkSession, index_trees: DataFrame, taxonomies: DataFrame) -> DataFrame:
    """The tagged rows of both tables, parsed and written once in a session for the same files.

    They lie in the session's shared folder, so a lost executor loses nothing.
    """
    state = _state(spark, index_trees, taxonomies)
    key = (spark.sparkContext.applicationId, state or "")
    path = _stored.get(key) if state else None
    if path is None:
        path = f"{shared_folder(spark)}/tagged-{(state or hashlib.sha256(repr(len(_stored)).encode()).hexdigest())[:24]}"
        write_tables(flatten(documents_of(index_trees, taxonomies)), path)
        _stored[key if state else (key[0], path)] = path
    return read_tables(spark, path)


def typed(tagged: DataFrame, tag: str) -> DataFrame:
    """One flat table out of the tagged rows; over a written table only its partition is read."""
    of = F.from_json("payload", SCHEMAS[tag])
    rows = tagged.filter(F.col("tag") == tag).select("record_kind", "record_id", F.col("key").alias("node_path" if tag == "node" else "item_path"), F.col("parent_key").alias("parent_path"), "ord", of.alias("f"))
    return rows.select(*(c for c in rows.columns if c != "f"), "f.*")
