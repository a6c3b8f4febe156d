"""Statistics of each text's quality, and whether it is natural prose, a list, a table or junk.

Lines are first sorted out by their layout: rows of a table stand under each other with their
delimiters at the same places or in the same number (vertical delimiter alignment); entries of a
list are short, begin alike or at indents that come again with a period (autocorrelation of indents),
and their lengths go up and down, while wrapped prose keeps the same length from line to line
(autocorrelation of line lengths). What is left is running text: its sentences are kept as prose where they have the
words of a language. The shape is what most characters of the text belong to, and where prose and list
are as good as even, what the shares of punctuated lines and of common words say; ratios of symbols,
digits, vowels and repeated words tell junk.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.texts import CJK

MAX_COMMON = 20_000  # rows of the fixed table of common words, checked before it is sent to the tasks

_SPACES = {c: " " for c in (0xA0, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)} | {c: None for c in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)} | {c: "\n" for c in (0x0B, 0x0C, 0x85, 0x2028, 0x2029)}
_ODD = re.compile("[" + "".join(map(chr, _SPACES)) + "]")
_TAG = re.compile(r"<[a-zA-Z/!][^<>]{0,300}>")
_ROW_HTML = re.compile(r"<t[dh]\b", re.I)
_CJK = re.compile(f"[{CJK}]")
_WORD = re.compile(f"[{CJK}]|[^\\W_{CJK}]+(?:['’][^\\W_{CJK}]+)*")
_ASCII_WORD, _SPACED_WORD = re.compile("[a-z0-9]+(?:'[a-z0-9]+)*"), re.compile(r"[^\W_]+(?:['’][^\W_]+)*")
_END = re.compile(r"[.!?。！？…][\"'”’»)\]」』]*$")
_BULLET = re.compile(r"(?:[-*+•·–—▪◦‣○●■□o»>]|\(?\d{1,4}[.)]|\(?[a-zA-Z][.)]|\d{1,3}(?:\.\d{1,3})+\.?|[A-Z]{2,6}[-_ ]?\d{1,6}[:.)]?|\[[ xX]?\])\s+\S")
_LEADER = re.compile(r"(?:\.\s?){4,}\s*\d*$|…{2,}\s*\d*$")
_HEADING = re.compile(r"#{1,6}\s|={2,6}\s")
_MOJIBAKE = re.compile("[\xc2-\xf4][\x80-\xbf]|�|\x00")
_BROKEN = re.compile("[\u25a0-\u25a2\ufffd¤§¦]")
_LEADERS = re.compile(r"(?:\.\s?){4,}|…{2,}|_{4,}")
_ESCAPE = re.compile(r"\\x[0-9a-f]{2}|%[0-9A-F]{2}|0x[0-9a-f]{2,8}|\?\?|&&")
_STOP = re.compile(rf"[.!?…]+[\"'”’»)\]」』]*(?=\s|$|[{CJK}])|[。！？]+[」』”’）\"]*")
_VOWELS = re.compile("[aeiouyáàâäãåéèêëíìîïóòôöõúùûüœæAEIOUYÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜ]")
_NUMERIC = re.compile(r"[-+±<>≤≥~]?\s*\d[\d.,\s]*\s*[%°]?\s*\S{0,4}|[-–—]|n/a|NA|OK|NG|", re.I)


def _cells(line: str) -> tuple[str, int]:
    """The delimiter of a line's cells and how often it stands there; "" if it has none."""
    if line.count("\t") >= 2 and len(line) <= 60 * (line.count("\t") + 1):
        return "\t", line.count("\t")
    n = line.count("|")
    if n >= 3 or n == 2 and line.startswith("|"):
        return "|", n
    if line.count(";") >= 2:
        cells = line.split(";")
        if max(map(len, cells)) <= 40:
            return ";", len(cells) - 1
    if line.count(",") >= 2:
        cells = line.split(",")
        if sum(c[:1] == " " for c in cells) * 2 < len(cells) and max(map(len, cells)) <= 40 and not _END.search(line):
            return ",", len(cells) - 1
    return "", 0


_GAP = re.compile(r"\s{2,}(?=\S)|\t+(?=\S)")


def _starts(line: str) -> list[int]:
    """Columns at which cells parted by wide gaps begin; wide characters count as they stand."""
    if "  " not in line and "\t" not in line:
        return []
    return [m.end() for m in _GAP.finditer(line.rstrip()) if m.start() > 0 or m.end() - m.start() > 6]


def table_lines(lines: list[str]) -> list[bool]:
    """Which lines are rows of a table."""
    n = len(lines)
    if n < 2:
        return [False] * n
    lines = [x.replace(",\t", ", ") for x in lines]
    marks = [_cells(x.strip(" ")) for x in lines]
    rows = [False] * n
    tally: dict[tuple[str, int], int] = {}
    for m in marks:
        if m[0]:
            tally[m] = tally.get(m, 0) + 1
    for i, m in enumerate(marks):
        # rows come in company: others of the same delimiter, mostly in the same number
        if m[0] and sum(k for (d, c), k in tally.items() if d == m[0] and abs(c - m[1]) <= 1) >= 2:
            rows[i] = True
    gaps = [_starts(x) for x in lines]
    for i in range(n):
        if rows[i] or len(gaps[i]) < 1:
            continue
        for j in (i - 1, i + 1, i - 2, i + 2):
            if 0 <= j < n and gaps[j]:
                same = sum(any(abs(a - b) <= 1 for b in gaps[j]) for a in gaps[i])
                if same >= 2 or same == 1 and len(gaps[i]) == len(gaps[j]) == 1 and max(len(lines[i]), len(lines[j])) < 80:
                    rows[i] = True
                    break
                # ragged columns of scripts of another width: the same number of short cells
                if len(gaps[i]) >= 2 and abs(len(gaps[i]) - len(gaps[j])) <= 1 and all(len(c) <= 30 for c in re.split(r"\s{2,}", lines[i].strip())):
                    rows[i] = True
                    break
    return rows


def autocorrelation(x: list[int], lag: int = 1, centred: bool = False) -> float:
    """Sum of products of values ``lag`` places apart, over the sum of squares; 0 for too few values.

    Of the values themselves it is near 1 for lengths that stay the same and lower for lengths that go up and
    down; of their differences from the mean it is near 1 where values come again with that period.
    """
    if len(x) <= lag + 1:
        return 0.0
    if centred:
        mean = sum(x) / len(x)
        x = [v - mean for v in x]
    squares = sum(v * v for v in x) * (len(x) - lag) / len(x)
    return sum(map(mul, x, islice(x, lag, None))) / squares if squares else 0.0


def periodic(indents: list[int]) -> bool:
    """Whether indents come again with a period of up to six lines."""
    return len(set(indents)) > 1 and any(autocorrelation(indents, lag, True) > 0.5 for lag in range(1, min(7, len(indents) // 2 + 1)))


EVEN = 0.9  # autocorrelation of line lengths from which lines are taken for wrapped


def list_lines(lines: list[str]) -> list[bool]:
    """Which lines of one block are entries of a list: short, one to a line, with a bullet, a
    number, a leader or an indent, or among others that are as short and end in no sentence."""
    strip = [x.strip() for x in lines]
    sizes = [len(s) + len(_CJK.findall(s)) for s in strip]  # as wide as they look
    wrapped, wide = autocorrelation(sizes) > EVEN, sorted(sizes)[int(len(sizes) * 0.75)] if sizes else 0
    short = 80 if periodic([len(x) - len(x.lstrip()) for x in lines]) else 60
    out = [False] * len(lines)
    for k, s in enumerate(strip):
        led = (".." in s or ". ." in s or "…" in s) and _LEADER.search(s) is not None
        ended = not led and _ends(s)
        if led:
            out[k] = sizes[k] <= 160
        elif _BULLET.match(s):
            out[k] = sizes[k] <= 110 and not (ended and sizes[k] > 45)
        elif sizes[k] <= short and not ended and not _HEADING.match(s):
            near = [m for m in (k - 1, k + 1) if 0 <= m < len(lines)]
            # wrapped lines reach the full width, entries don't
            out[k] = bool(near) and all(sizes[m] <= 80 for m in near) and not (wrapped and wide > 45 and sizes[k] >= 0.8 * wide)
    return out


def repeated(words: list[str]) -> float:
    """The largest share of words that are the same as those one period before, for periods of any
    length that come five times or more.

    Periods of more than eight words are looked for where they show: as the distances at which four
    words in a row come again; the commonest ones are then measured as the short ones are.
    """
    n = len(words)
    if n < 12 or len(set(words)) * 3 > n:
        return 0.0
    h = np.fromiter(map(hash, words), np.int64, n)
    rows = h[: n - 3].copy()
    for k in range(1, 4):
        rows = rows * np.int64(0x5851F42D4C957F2D) + h[k : n - 3 + k]
    order = np.argsort(rows, kind="stable")
    apart = np.diff(order)[rows[order[1:]] == rows[order[:-1]]]
    found = np.bincount(apart[apart <= n // 5], minlength=1)
    lags = {*range(1, 9), *(np.argsort(found)[-4:].tolist() if len(found) > 9 else ())} - {0}
    return max(float((h[p:] == h[:-p]).mean()) for p in lags)


class Common:
    """Common words by language: those with spaces as sets, the others as patterns."""

    def __init__(self, rows: list[tuple[str, str]]) -> None:
        by: dict[str, set[str]] = {}
        for lang, word in rows:
            by.setdefault(lang, set()).add(word.strip().lower())
        self.spaced = {k: v for k, v in by.items() if not any(map(_CJK.search, v))}
        rest = {k: v for k, v in by.items() if k not in self.spaced}
        self.any = frozenset().union(*self.spaced.values())
        self.patterns = {k: re.compile("|".join(sorted(map(re.escape, v), key=len, reverse=True))) for k, v in rest.items()}

    def share(self, words: list[str], text: str, cjk: int) -> float:
        """Share of common words, in the language where it is largest."""
        if words and cjk * 2 < len(words):
            n = Counter(words)
            return max((sum(n[w] for w in v if w in n) / len(words) for v in self.spaced.values()), default=0.0)
        if cjk:
            return max((sum(map(len, p.findall(text))) / cjk for p in self.patterns.values()), default=0.0)
        return 0.0


STATS = "doc_id long, word_count int, mean_word_length double, symbol_ratio double, punctuated_lines double, common_words double, shape string"
_NAMES, _KINDS = [c.split()[0] for c in STATS.split(", ")], [pa.int32(), *[pa.float64()] * 4, pa.string()]


def measure(text: str | None, common: Common) -> tuple:
    """word count, mean word length, symbol ratio, share of lines that end in punctuation, share of
    common words, and the shape: prose, list, table or junk; null for a text without characters."""
    if not isinstance(text, str) or not text.strip():
        return 0, 0.0, 0.0, 0.0, 0.0, None
    clean = text.replace("\r\n", "\n").replace("\r", "\n")
    clean = clean.replace("\x0b", "\n").replace("\x0c", "\n") if clean.isascii() else _ODD.sub(lambda m: _SPACES[ord(m[0])] or "", clean)
    if not clean.strip():
        return 0, 0.0, 0.0, 0.0, 0.0, None
    html_rows = len(_ROW_HTML.findall(clean)) >= 4
    if html_rows:
        clean = re.sub(r"</tr>\s*", "\n", re.sub(r"</t[dh]>\s*(?=<t[dh])", "\t", clean, flags=re.I), flags=re.I).replace("&nbsp;", " ")
    if "<" in clean:
        clean = _TAG.sub("", clean)
    solid = sum(map(len, clean.split())) or 1
    plain = clean.isascii()
    cjk = 0 if plain else len(_CJK.findall(clean))
    words = (_ASCII_WORD if plain else _WORD if cjk else _SPACED_WORD).findall(clean.lower())  # the same words
    written = sum(map(len, words))
    lines = [x for x in clean.split("\n") if x and not x.isspace()]
    ended = sum(map(_ends, lines)) / max(1, len(lines))
    share = common.share(words, clean, cjk)
    stats = len(words), written / max(1, len(words)), (solid - written) / solid, ended, share
    return (*stats, _shape(clean, lines, words, solid, written, cjk, plain, common, ended, share))


def _ends(line: str) -> bool:
    """Whether a line ends like a sentence."""
    return _END.search(line.rstrip()[-8:]) is not None


def _valid(piece: str, common: Common) -> bool:
    """Whether a sentence has the look of a language: its common words are there."""
    if not piece.isascii() and (cjk := len(_CJK.findall(piece))) * 3 >= len(piece):
        return cjk >= 3 and common.share([], piece, cjk) >= 0.04
    words = piece.lower().split()
    n = len(words)
    return n >= 3 and sum(map(common.any.__contains__, words)) >= 0.08 * n


def _covered(text: str, common: Common) -> list[tuple[int, int]]:
    """Spans of the sentences of a paragraph that have the look of a language."""
    out, start = [], 0
    for m in _STOP.finditer(text):
        if _valid(text[start : m.end()], common):
            out.append((start, m.end()))
        start = m.end()
    return out


def _block(lines: list[str], common: Common) -> tuple[int, int]:
    """Characters of sentences and of list entries in one block of lines that is no table."""
    if all(map(_HEADING.match, map(str.strip, lines))):
        return 0, 0
    if len(lines) == 1 and not _BULLET.match(text := lines[0].strip()):
        got = sum(b - a - text.count(" ", a, b) for a, b in _covered(text, common))
        return (got, 0) if got * 2 >= len(text) - text.count(" ") else (got, (len(text) - text.count(" ")) * list_lines(lines)[0])
    text, places = "", []
    for x in lines:
        x = x.strip()
        if text and not (_CJK.search(text[-1]) or _CJK.match(x)):
            text += " "
        places.append((len(text), len(text) + len(x)))
        text += x
    spans = [] if sum(map(bool, map(_BULLET.match, map(str.strip, lines)))) * 2 > len(lines) else _covered(text, common)
    prose = [0] * len(lines)
    i = 0
    for a, b in spans:
        while i < len(places) and places[i][1] <= a:
            i += 1
        j = i
        while j < len(places) and places[j][0] < b:
            prose[j] += max(0, min(b, places[j][1]) - max(a, places[j][0]))
            j += 1
    left = [k for k, (a, b) in enumerate(places) if prose[k] * 2 < b - a]
    entries = list_lines([lines[k] for k in left])
    in_list = sum(len(lines[k]) - lines[k].count(" ") for k, e in zip(left, entries) if e)
    gone = {k: e for k, e in zip(left, entries)}
    in_prose = sum(len(x) - x.count(" ") for k, x in enumerate(lines) if k not in gone)
    in_prose += sum(int(prose[k] * (1 - lines[k].count(" ") / max(1, len(lines[k])))) for k, e in gone.items() if not e)
    return in_prose, in_list


def _entry(line: str) -> bool:
    """Whether a line may be an entry of a list whatever its neighbours are."""
    line = line.strip()
    return bool(_BULLET.match(line)) or len(line) <= 50 and not _END.search(line) and not _HEADING.match(line)


def _shape(clean: str, lines: list[str], words: list[str], solid: int, written: int, cjk: int, plain: bool, common: Common, ended: float, share: float) -> str:
    odd = 0 if plain else len(_MOJIBAKE.findall(clean)) * 2
    if any(map(clean.__contains__, ("\\x", "%", "0x", "??", "&&", "\x00"))):
        odd += sum(map(len, _ESCAPE.findall(clean))) + 2 * clean.count("\x00") * plain
    if odd > 0.15 * solid or not plain and len(_BROKEN.findall(clean)) > 0.03 * solid or repeated(words) > 0.6:
        return "junk"
    bare = solid - sum(len(m[0]) - m[0].count(" ") for m in _LEADERS.finditer(clean)) if ".." in clean or ". ." in clean or "__" in clean or "…" in clean else solid
    rows = table_lines(lines)
    in_rows = sum(len(x) - x.count(" ") for x, r in zip(lines, rows) if r)
    if written < 0.45 * bare and in_rows * 2 < solid:
        return "junk"
    prose = in_list = 0
    block: list[str] = []
    at = 0
    for x in [*clean.split("\n"), ""]:
        row = bool(x.strip()) and rows[at]
        if x.strip():
            at += 1
        if x.strip() and not row:
            block.append(x)
            continue
        if block and not row and at < len(lines) and not rows[at] and _entry(block[-1]) and _entry(lines[at]):
            continue  # entries with empty lines between them are one block
        if block:
            p, e = _block(block, common)
            prose, in_list, block = prose + p, in_list + e, []
    other = max(0, solid - in_rows - in_list - prose)
    if max(prose, in_list) >= max(in_rows, other) and abs(prose - in_list) < 0.02 * solid:  # even: what lines end in, and their words
        prose, in_list = (1 + in_list, in_list) if ended >= 0.5 and share >= 0.08 else (prose, 1 + prose)
    shape = max((("prose", prose), ("list", in_list), ("table", in_rows), ("junk", other)), key=lambda p: p[1])[0]
    return "junk" if shape == "list" and _junk_words(words, cjk) else shape


def _junk_words(words: list[str], cjk: int) -> bool:
    """Words of no language: hardly a vowel, or hardly a letter."""
    if cjk * 3 > len(words):
        return False
    spaced = [w for w in words if w.isalpha()]
    if len(spaced) * 5 < len(words):
        return True
    letters = "".join(spaced)
    return len(_VOWELS.findall(letters)) < 0.22 * max(1, len(letters))


def text_quality(documents: DataFrame, common_words: DataFrame) -> DataFrame:
    """Statistics and shape of each text, as in ``STATS``; one row per row of ``documents``.

    Null, empty and blank texts have zeros and a null shape. Whole texts are read, however long.
    """
    rows = common_words.filter("lang is not null and word is not null").select("lang", "word").limit(MAX_COMMON + 1).collect()
    if len(rows) > MAX_COMMON:
        raise ValueError(f"more than {MAX_COMMON} common words")
    pairs = [tuple(r) for r in rows]

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = Common(pairs)
        for b in batches:
            columns = list(zip(*(measure(t, common) for t in b.column(1).to_pylist()))) or [()] * len(_KINDS)
            yield pa.RecordBatch.from_arrays([b.column(0), *map(pa.array, columns, _KINDS)], names=_NAMES)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(of, STATS)
