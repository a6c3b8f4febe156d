"""Oversized texts cut into pieces at natural boundaries, with an overlap.

The least number of pieces is computed first, equal targets are placed, and each target is snapped
to the strongest boundary near it. Where a piece would still be too long, one piece more is tried.
A piece after the first begins ``overlap`` characters before the cut, so it has room for
``limit - overlap`` characters of its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.texts import rows

LIMIT, OVERLAP = 6000, 200

#: Boundaries by strength: before headings, between paragraphs, lines, sentences, clauses, words.
_BOUNDARIES = [
    (6, re.compile(r"\n[ \t]*\n(?=\s{0,3}(?:#{1,6} |={2,6} |h[1-6]\. |<h[1-6]|\\(?:sub)*section))|\x0c")),
    (5, re.compile(r"\n[ \t\r]*\n")),
    (4, re.compile(r"\n")),
    (3, re.compile(r"[.!?…][\"'”’»)\]]*\s|[。！？][」』”’）]*|[.!?]$")),
    (2, re.compile(r"[;:,]\s|[；：，、]")),
    (1, re.compile(r"\s")),
]
_SINGLE = re.compile("[̀-ͯ‍︀-️゙゚ัิ-ฺ\U0001f3fb-\U0001f3ff]")


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Places after which a text may be cut, ascending, and the strength of each."""
    best: dict[int, int] = {}
    for strength, pattern in reversed(_BOUNDARIES):
        for m in pattern.finditer(text):
            best[m.end()] = strength
    at = np.fromiter(sorted(best), dtype=np.int64, count=len(best))
    return at, np.array([best[x] for x in at.tolist()], dtype=np.int64)


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[int]:
    """Where a text is cut; empty if it fits."""
    n, room = len(text), limit - overlap
    if n <= limit:
        return []
    at, strength = boundaries(text)
    pieces = 1 + -(-(n - limit) // room)
    while True:
        step = n / pieces
        out, last, ok = [], 0, True
        for i in range(1, pieces):
            most = limit if not out else last + room  # the last place that this piece may reach
            # what is left must fit in the pieces that are left
            least = max(last + 1, n - (pieces - i) * room, overlap + 1)
            if least > most:
                ok = False
                break
            target = min(max(round(i * step), least), most)
            reach = max(step / 4, 1)
            lo, hi = max(least, int(target - reach)), min(most, int(target + reach))
            a, b = np.searchsorted(at, (lo, hi + 1))
            if a < b:
                near = 1 - np.abs(at[a:b] - target) / (reach + 1)
                cut = int(at[a + int(np.argmax(strength[a:b] + near))])
            else:
                cut = target
                while cut > least and _SINGLE.match(text[cut]):
                    cut -= 1
            out.append(cut)
            last = cut
        if ok and n - last <= room:
            return out
        pieces += 1


PIECES = "doc_id string, anchor string, piece_no int, start int, end int, text string"


def _each(doc: str, anchor: str, body: str) -> Iterator[tuple]:
    for no, (a, b, t) in enumerate(pieces(body), 1):
        yield doc, anchor, no, a, b, t


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, str]]:
    """start, end and text of each piece; a piece after the first starts ``overlap`` characters
    before the end of the one before it. A text that fits is one piece."""
    ends = [*cuts(text, limit, overlap), len(text)]
    starts = [0, *(max(0, c - overlap) for c in ends[:-1])]
    return [(a, b, text[a:b]) for a, b in zip(starts, ends)]


def split_oversized(sections: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Pieces of the bodies (doc_id, anchor, body) above the limit, in Unicode code points.

    Null, empty and fitting bodies give no rows: they need no cut. A text without any boundary is
    cut between characters, never before a combining one if that can be helped. The body is rebuilt
    from its pieces by leaving out each overlap.
    """
    over = sections.filter(F.length("body") > limit)
    return rows(over, _each, PIECES, ["doc_id", "anchor", "body"])
