"""Text helpers that several operators share. Plain Python, run inside Arrow batches."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import islice

import pandas as pd
from pyspark.sql import DataFrame

CJK = "぀-ヿ㐀-䶿一-鿿豈-﫿"
_CJK = re.compile(f"[{CJK}]")
# begins with its characters, so that the search runs from one to the next
_END = re.compile(rf"""[.!?…。！？](?:(?<=[.!?…])[.!?…]*["'”’»)\]]*(?=\s|$|{_CJK.pattern})|(?<=[。！？])[。！？]*[」』”’）]*)""")
_UNIT = re.compile(r"\d\s?[^\W\d_]{1,3}\.$")
_ABBREVIATION = re.compile(r"(?:^|[\s(])(?:\d+|[A-Za-z]|no|nr|fig|sec|vol|pp?|approx|min|max|typ|e\.g|i\.e|z\.B|bzw|ca)\.$", re.I)


def is_cjk(text: str) -> bool:
    """Whether a text is mostly written without spaces between words."""
    return len(_CJK.findall(text)) * 3 > sum(map(str.isalpha, text))


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the whole sentences of a running text, in order.

    A sentence ends with its mark of its script; what no mark ends (headings, list entries, cells)
    is no sentence, nor are fewer than four words or eight characters without spaces.
    """
    out = []
    for p in _PARAGRAPH.finditer(text):
        start = p.start()
        for m in _END.finditer(text, p.start(), p.end()):
            end = m.end()
            if m[0][0] == "." and _ABBREVIATION.search(tail := text[max(start, end - 14) : end]) and not tail[-2:-1].isdigit() and not _UNIT.search(tail):
                continue
            piece = text[start:end]
            if "\n" in piece:  # entries on lines of their own before a sentence aren't part of it
                cut = max((i + 1 for i, ch in enumerate(piece) if ch == "\n" and _starts_anew(piece[:i], piece[i + 1 :])), default=0)
                start, piece = start + cut, piece[cut:]
            if piece.count(" ", 1) >= 3 and _at_least(_LETTERS, piece, 4) or not piece.isascii() and _at_least(_CJK, piece, 8):
                out.append((start, end))
            start = end
    return out


def _at_least(pattern: re.Pattern[str], text: str, n: int) -> bool:
    return sum(1 for _ in islice(pattern.finditer(text), n)) == n


_LETTERS = re.compile(r"[^\W\d_]+")
_PARAGRAPH = re.compile(r"[^\n]+(?:\n(?!\s*\n)[^\n]+)*")
_BULLET = re.compile(r"\s*(?:[-*+•·–—▪◦‣#]+\s|\(?\d{1,3}[.)]\s|\(?[a-z][.)]\s|[A-Z]{2,}-\d+)")


def _starts_anew(before: str, after: str) -> bool:
    """Whether a line break inside a paragraph parts an entry from what follows."""
    line = before.rsplit("\n", 1)[-1]
    return bool(_BULLET.match(after) or (_BULLET.match(line) and len(line) < 60 and not _END.search(line)))


def rows(df: DataFrame, each: Callable[..., Iterator[tuple]], schema: str, columns: list[str]) -> DataFrame:
    """``each`` over the given columns of every row, in Arrow batches; it yields tuples as in ``schema``."""
    names = [c.strip().split(" ")[0] for c in re.split(r",(?![^<]*>)", schema)]

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out: list[tuple] = []
            for values in zip(*(b[c] for c in columns)):
                out.extend(each(*values))
                if len(out) >= 20_000:
                    yield pd.DataFrame(out, columns=names)
                    out = []
            if out:
                yield pd.DataFrame(out, columns=names)

    return df.select(*columns).mapInPandas(of, schema)
