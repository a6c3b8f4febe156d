"""Noise of scanned pages, repaired into continuous paragraphs.

The layout of a body is read on its own: lines that hold a page number (a rising sequence in one
style), heading and foot lines (short lines that come again after a page's length, compared after
folding characters that scanners confuse), and words broken at a line end. Misread words need the
corpus: the frequencies of all words form a lexicon. A symmetric-delete index over it gives candidates
for rare words; its forms are the words' strokes, in which confused pairs are equal but for one
stroke, so that any number of them meets. A weighted edit distance, in which confused pairs are cheap,
together with the frequency of the word pair before it weighs each candidate against the word as it is
read, after each word that stands before it. Chinese and Japanese have no spaces: there a character
between its two neighbours is the word, and the index leaves out the character in the middle.

Words are counted by partial sums, and the decisions (word before, misread word, repair) are made by
joins over the counts. Those that are few enough (``MOST_SENT``) are sent to the tasks as a book and
applied in one pass; more are joined with the words of each body. Both ways read the same decisions.
"""

from __future__ import annotations

import re
from bisect import bisect
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataframe.llm.texts import CJK
from strataframe.tables import checkpointed, slot_of, with_bit

KINDS = ("hyphen", "glyph", "header", "page_no")
CONFUSED = 0.25  # cost of a confused pair; other edits cost 1
MAX_COST = 0.8
RATIO_LETTERS, RATIO_SIGNS = 15, 3  # how much more frequent a repair is than the word
LEXICON_LEAST = 5
UNREAD = 2.0  # how much less a word as it is read is believed, as a logarithm; with signs in it: 6
UNREAD_SIGNS = 6.0
SHORT = 24  # letters; longer words have so few of a kind that runs of strokes of any length may meet

# What scanners read for what was printed.
PAIRS = {
    "í": ("i",), "ì": ("i",), "†": ("t",), "@": ("a",), "6": ("b", "6"), "8": ("b", "s"), "5": ("s",), "0": ("o",), "c": ("e",), "1": ("l", "i"), "|": ("l", "i"), "!": ("l", "i"), "q": ("g",), "9": ("g",), "3": ("e",), "$": ("s",), "€": ("e",),
    "rn": ("m",), "ii": ("u", "n"), "li": ("h",), "cl": ("d",), "vv": ("w",), "nn": ("m",), "ni": ("m",), "ri": ("n",), "tl": ("h",), "ln": ("h",), "fi": ("h",),
}
# The same for characters of Chinese and Japanese.
CJK_PAIRS = {
    "一": ("ー",), "力": ("カ",), "卜": ("ト",), "工": ("エ",), "二": ("ニ",), "口": ("ロ",), "ゐ": ("る",), "茌": ("在",), "丕": ("不",), "渎": ("读",),
    "庋": ("度",), "侧": ("测",), "犬": ("大",), "栽": ("载",), "干": ("于",), "晴": ("時",), "雷": ("電",), "曰": ("日",), "ば": ("は",),
}
_HYPHENS = "-‐¬\xad"
_C = f"[{CJK}]"
_PAGE = [
    ("dash", re.compile(r"[-—–]\s*(\d{1,4})\s*[-—–]")),
    ("tilde", re.compile(r"~\s*(\d{1,4})\s*~")),
    ("page", re.compile(r"(?:page|pag|seite|página|pagina)\.?\s*(\d{1,4})(?:\s*(?:of|von|de|van|/)\s*\d{1,4})?", re.I)),
    ("p", re.compile(r"pp?\.\s*(\d{1,4})")),
    ("of", re.compile(r"(\d{1,4})\s*/\s*\d{1,4}")),
    ("square", re.compile(r"\[(\d{1,4})\]")),
    ("cjk", re.compile(r"第\s*(\d{1,4})\s*[页頁ページ]+")),
    ("bare", re.compile(r"(\d{1,4})\.?")),
]
_CERTAIN = {"dash", "tilde", "page", "p", "of", "cjk"}
_ENTRY = re.compile(r"\s*(?:[-*+•·–▪◦‣]\s|\(?\d{1,4}[.)]\s|[A-Z]{2,}-\d)")
#: Lines of mark-up, which are never part of a paragraph.
_ALONE = re.compile(r"\s*(?:\|.*\|\s*$|#{1,6} |={2,}|-{4,}\s*$|```|~~~|[{}\\<]|h[1-6]\. )")
_CLOSED = re.compile(r"[.!?。！？:;：；]\s*$")


def fold(line: str) -> str:
    """A line as it is compared on different pages: confused characters made equal."""
    t = " ".join(line.lower().split())
    for a, b in (("rn", "m"), ("nn", "m"), ("ii", "u"), ("vv", "w"), ("cl", "d"), ("li", "h"), ("tl", "h")):
        t = t.replace(a, b)
    return t.translate(_FOLD)


_FOLD = str.maketrans({"í": "i", "ì": "i", "†": "t", "@": "a", "6": "b", "8": "b", "5": "s", "0": "o", "1": "l", "|": "l", "!": "l", "i": "l", "q": "g", "9": "g", "3": "e", "c": "e", "$": "s", "€": "e", "一": "ー", "干": "于"})


_RUN = re.compile(r"[^\W\d_]{2,}")
#: Four runs of two letters or more, with single letters and anything else between them.
_FOUR = re.compile(r"(?:[\W\d_]*+(?:[^\W\d_](?![^\W\d_])[\W\d_]*+)*+[^\W\d_]{2,}+){4}")
_CHARACTER = re.compile(_C)


def _words(line: str) -> int:
    return len(_RUN.findall(line)) + (0 if line.isascii() else len(_CHARACTER.findall(line)) // 3)


def _running(line: str) -> bool:
    """Whether a line has four words at least; reads no more of it than that takes."""
    return _FOUR.match(line) is not None or not line.isascii() and _words(line) >= 4


@lru_cache(4096)
def _naming(doc: str) -> tuple[frozenset[str], str, str]:
    """The folded words of a document's name, its number, and the number folded."""
    number = re.match(r"[A-Z]\d{5,}", doc)
    return frozenset(fold(w) for w in re.findall(r"[^\W_]{2,}", doc)), number[0] if number else "", fold(number[0]) if number else ""


def layout(body: str, doc: str = "") -> tuple[list[str], set[str]]:
    """The lines of a body without page numbers and heading lines, and which of both were there.

    A body without running text (lists, tables, figures) is left as it is.
    """
    if "\r" in body or "\x0c" in body:
        body = body.replace("\r\n", "\n").replace("\r", "\n").replace("\x0c", "\n\x0c\n")
    lines = body.split("\n")
    if len(lines) < 3:
        return lines, set()
    text = [i for i, x in enumerate(lines) if len(x) >= 16 and not _ENTRY.match(x) and _running(x)]
    if len(text) < 3:
        return lines, set()
    bare = [x.strip() for x in lines]
    kinds: set[str] = set()
    drop: set[int] = set()
    by: dict[str, list[tuple[int, int]]] = {}
    for i, x in enumerate(bare):
        if 0 < len(x) <= 24 and any(map(str.isdigit, x)):
            for style, pattern in _PAGE:
                if m := pattern.fullmatch(x):
                    by.setdefault(style, []).append((i, int(m[1])))
                    break
    for style, found in by.items():
        steps = list(zip(found, found[1:]))
        # numbers rise from page to page, and most pages have running text (the last may be short)
        rising = bool(steps) and all(0 < b[1] - a[1] <= 4 and b[0] - a[0] >= 2 for a, b in steps) and 2 * sum(bisect(text, a[0]) < bisect(text, b[0]) for a, b in steps) >= len(steps)
        inside = all(any(t < i for t in text) or any(t > i for t in text) for i, _ in found)
        if inside and (rising or style in _CERTAIN and len(found) <= 1 + len(lines) // 5):
            drop.update(i for i, _ in found)
    if drop:
        kinds.add("page_no")
    seen: dict[str, list[int]] = {}
    names, number, folded = _naming(doc)
    width = sorted(len(lines[i]) for i in text)[len(text) // 2]
    middle = lines[text[len(text) // 2]]
    shown = width * (2 if not middle.isascii() and len(_CHARACTER.findall(middle)) * 2 > width else 1)  # as wide as it looks
    for i, x in enumerate(bare):
        if 1 < len(x) <= 60 and (len(x) <= 0.8 * shown or number and number in x) and i not in drop and not _ENTRY.match(x + " "):
            key = fold(x)
            if not _CLOSED.search(x) or names and not names.isdisjoint(key.split()):
                seen.setdefault(key, []).append(i)
    found_lines: set[int] = set()
    ends = drop | {i for i, x in enumerate(lines) if x == "\x0c"}
    for key, at in seen.items():
        line = bare[at[0]]
        if len(at) == 1:
            if kinds and folded and folded in key and _words(line) <= 6:
                found_lines.update(at)
            continue
        own = bool(folded and folded in key) or bool(names and any(w in names for w in re.findall(r"[^\W_]{2,}", key)))
        gaps = sorted(b - a for a, b in zip(at, at[1:]))
        apart = gaps[len(gaps) // 4]  # a page may have a single line, or none
        # lines that don't name the document must stand where pages meet
        edges = len(at) >= 3 and 2 * sum(any(j in ends for j in range(i - 2, i + 3)) for i in at) >= len(at)
        other = edges and apart >= 5 and len(line) <= 0.6 * width and _words(line) <= 5 and not re.search(r"[`~{}\\<>|#=\[\]*_();:\"]", line) and re.search(r"[^\W\d_]", line) and _broken(lines, at, drop)
        if apart >= 2 and (own and _words(line) <= 7 and not re.match(r"[#=<\\{`~*]", line) or other):
            found_lines.update(at)
            if len({" ".join(lines[i].split()) for i in at}) > 1:
                kinds.add("glyph")  # one heading line in several readings
    if found_lines:
        kinds.add("header")
        drop |= found_lines
    if not ends and not drop:
        return lines, kinds
    keep, pending = [], False
    for i, x in enumerate(lines):
        if i in drop or x.strip() == "\x0c":
            pending = True  # empty lines around a page break part nothing
            continue
        if not x.strip() and (pending or i + 1 in drop) and keep and not _CLOSED.search(keep[-1] or "."):
            continue
        pending = False
        keep.append(x)
    return keep, kinds


def _broken(lines: list[str], at: list[int], drop: set[int]) -> bool:
    """Whether most of the lines stand inside running sentences."""
    n = 0
    for i in at:
        before = next((lines[j] for j in range(i - 1, -1, -1) if lines[j].strip() and j not in drop), "")
        n += bool(before) and not _CLOSED.search(before)
    return n * 2 >= len(at)


_TAIL = re.compile(rf"(?:^|(?<=[\s(\"'’«]))((?:[^\W\d_]|['’†@|\d])*[^\W\d_†@|])([{_HYPHENS}])\s*$")
_HEAD = re.compile(r"\s*((?:[^\W\d_]|[†@|\d])[^\s]*)")


def breaks(lines: list[str]) -> list[tuple[int, str, str, str]]:
    """Word breaks at line ends: index of the line, first part, mark, rest of the word."""
    out = []
    for i, x in enumerate(lines[:-1]):
        if x and x.rstrip()[-1:] in _HYPHENS and (m := _TAIL.search(x.rstrip())):
            j = next((j for j in range(i + 1, min(i + 4, len(lines))) if lines[j].strip()), None)
            if j is not None and (h := _HEAD.match(lines[j])) and (h[1][0].islower() or not h[1][0].isalpha()) and not re.match(_C, h[1]):
                out.append((i, m[1], m[2], re.match(r"[^\W_†@|]*(?:[\w†@|'’]*)", h[1])[0]))
    return out


def joined(lines: list[str], compound: set[str] = frozenset()) -> tuple[str, bool]:
    """The lines as paragraphs, broken words made whole, and whether there were any.

    ``compound``: words whose hyphen is their own and stays.
    """
    lines, any_ = list(lines), False
    for i, a, mark, b in breaks(lines):
        j = next(j for j in range(i + 1, len(lines)) if lines[j].strip())
        own = mark in "-‐" and f"{a}-{b}".lower().strip(".,;:") in compound
        lines[i] = lines[i].rstrip()[: None if own else -1] + lines[j].lstrip().split(" ", 1)[0]
        rest = lines[j].lstrip().split(" ", 1)[1:]
        lines[j] = rest[0] if rest else ""
        for k in range(i + 1, j):
            lines[k] = "\x00"
        any_ |= not own
    out: list[str] = []
    alone = False
    for x in lines:
        x = x.rstrip()
        if x == "\x00":
            continue
        before, alone = alone, bool(_ALONE.match(x))
        if out and out[-1] and x.strip() and not _ENTRY.match(x) and not alone and not before:
            cjk = re.search(_C + r"$", out[-1]) or re.match(_C, x)
            out[-1] += x.strip() if cjk else " " + x.strip()
        else:
            out.append(x)
    return re.sub(r"\n{2,}", "\n\n", "\n".join(x if x else "\n" for x in out)).strip("\n"), any_


_MARK = "@†|$€"
_IN = rf"a-zß-ɏ0-9{_MARK}"
_WORD = re.compile(rf"(?<![{_IN}])[{_IN}](?:[{_IN}!'’]*[{_IN}])(?![{_IN}])")
_LETTER = re.compile("[a-zß-ɏ]")
_MARKED = re.compile(r"<[^<>\n]*>|\\[A-Za-z]+|&[a-z#0-9]+;|\{\{|\}\}|\[\[|\]\]|^[ \t]*\|.*\|[ \t]*$", re.M)
_HAS_MARKED = re.compile(r"[<\\&{}\[\]|]")


def unmarked(text: str) -> str:
    """A text without mark-up, table rows and commands, for counting words."""
    return _MARKED.sub(" ", text) if _HAS_MARKED.search(text) else text


def is_word(w: str) -> bool:
    return w.isalpha() or _LETTER.search(w) is not None


_PARTS = re.compile(f"[{_IN}!'’]+")


@lru_cache(1 << 17)
def _known_word(run: str) -> str:
    """The word in a run of its characters: without signs at its ends, "" for what is none."""
    w = run.strip("!'’")
    return w if len(w) > 1 and is_word(w) else ""


def words_of(text: str) -> list[str]:
    """Words that may be misread: with a letter, in lower case, of two characters or more."""
    return list(filter(None, map(_known_word, _PARTS.findall(text.lower()))))


_READ = re.compile(f"[{''.join(CJK_PAIRS)}]")
_EITHER = re.compile(f"[{''.join(CJK_PAIRS)}{''.join(x for to in CJK_PAIRS.values() for x in to)}]")
_UNREAD = str.maketrans({read: to[0] for read, to in CJK_PAIRS.items()})


class _Beside(dict):
    """Neighbours as they are compared: confused characters made equal, digits, letters and gaps alike."""

    def __missing__(self, c: str) -> str:
        self[c] = v = "0" if c.isdigit() else "a" if c.isascii() and c.isalpha() else " " if not c.isalnum() else c.translate(_UNREAD)
        return v


_BESIDE = _Beside()


def windows(text: str, what: re.Pattern[str] = _EITHER) -> list[tuple[int, str]]:
    """Place and window of each character that may be misread, or be what was printed: the sign of a
    window, the neighbour before, the character, the neighbour after."""
    if text.isascii():
        return []
    return [(i, f"\x01{_BESIDE[text[i - 1 : i]]}{text[i]}{_BESIDE[text[i + 1 : i + 2]]}") for i in map(re.Match.start, what.finditer(text))]


def lines_of(body: str, doc: str) -> tuple[list[str], set[str]]:
    """The lines of a body's content; a body without any noise of pages or broken word is one piece."""
    if not ("\n" in body or "\r" in body or "\x0c" in body):
        return [body], set()
    lines, kinds = layout(body, doc)
    return (lines, kinds) if kinds or breaks(lines) else ([body], set())


_COMPOUND = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)+")


class _Numbers(dict):
    """Runs of a word's characters to the numbers of their words; 0 is no word before, -1 no word."""

    def __init__(self) -> None:
        super().__init__()
        self.words, self.number = [""], {"": 0}

    def __missing__(self, run: str) -> int:
        w = _known_word(run)
        if w and w not in self.number:
            self.number[w] = len(self.words)
            self.words.append(w)
        self[run] = n = self.number[w] if w else -1
        return n


MOST_TOKENS = 4_000_000  # words that wait as numbers until they are counted


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of words, of windows, of pairs (before, word), of hyphen compounds, and of the slots of
    bodies whose layout isn't plain, summed by batch. Words are counted as numbers."""
    for b in batches:
        numbers, waiting, size = _Numbers(), [], 0
        words: Counter[str] = Counter()
        around: Counter[str] = Counter()
        pairs: Counter[tuple[str, str]] = Counter()

        def flush() -> None:
            n = len(numbers.words)
            x = np.concatenate([*waiting, np.zeros(1, np.int64)])
            codes, counts = np.unique(x[:-1][x[1:] > 0] * n + x[1:][x[1:] > 0], return_counts=True)
            for code, k in zip(codes.tolist(), counts.tolist()):
                pairs[numbers.words[code // n], numbers.words[code % n]] += k
            waiting.clear()

        for doc, body, slot in zip(b.doc_id, b.body, b.slot):
            lines, _ = lines_of(body, doc or "")
            if len(lines) > 1:
                words[f"{SLOT}{slot}"] += 1
            text = unmarked(joined(lines)[0] if len(lines) > 1 else body)
            found = np.fromiter(map(numbers.__getitem__, _PARTS.findall(text.lower())), np.int64)
            waiting += [np.zeros(1, np.int64), found[found > 0]]
            size += len(found)
            if size > MOST_TOKENS:
                flush()
                size = 0
            if not text.isascii():
                wide = f"\n{text}\n"
                around.update([wide[i : i + 3] for i in map(re.Match.start, _EITHER.finditer(text))])
            if "-" in text:
                words.update(x.lower() for x in _COMPOUND.findall(text))
        flush()
        for w, n in around.items():
            words[f"\x01{_BESIDE[w[0]]}{w[1]}{_BESIDE[w[2]]}"] += n
        for (_, w), n in pairs.items():
            words[w] += n
        yield pd.DataFrame({"before": [None] * len(words) + [a for a, _ in pairs], "word": [*words, *(w for _, w in pairs)], "n": [*words.values(), *pairs.values()]}, columns=["before", "word", "n"])


SLOT = "\x03"  # begins the word of a body's slot


def frequencies(sections: DataFrame) -> DataFrame:
    """word, before (null: the word alone), n: counts over all bodies."""
    slot = slot_of(["doc_id", "anchor"]) if "anchor" in sections.columns else F.lit(0)
    counted = sections.filter("body is not null").select("doc_id", "body", slot.alias("slot")).mapInPandas(_count, "before string, word string, n long")
    return counted.groupBy("before", "word").agg(F.sum("n").alias("n"))


# The strokes that letters and their readings have in common.
_STROKES = str.maketrans({"í": "i", "ì": "i", "1": "i", "|": "i", "!": "i", "l": "i", "t": "i", "†": "i", "f": "i", "r": "i", "n": "ii", "u": "ii", "h": "ii", "m": "iii", "d": "ci", "w": "vv", "e": "c", "3": "c", "€": "c", "@": "a", "0": "o", "q": "g", "9": "g", "6": "s", "8": "s", "5": "s", "$": "s", "b": "s"})


def strokes(word: str) -> str:
    """A word's strokes: equal for what is read and what was printed, but for one stroke in ``nn`` and ``ln``."""
    return word.translate(_STROKES)


def forms(word: str) -> set[str]:
    """Forms on which a word meets those that it may be a reading of.

    Strokes and strokes less one, so two words meet if their strokes differ in one place; a word with
    ``nn`` or ``ln`` has both as they are and as ``m`` and ``h``, which is enough for three of them.
    Long words meet on strokes without the length of their runs; lengths near the bound have both. A
    window meets on its neighbours. The forms of a short word are nearly as long as itself, and so few
    words share one, however many words there are.
    """
    if word[:1] == "\x01":
        return {word[:2] + word[3:]}
    s = strokes(word)
    out = set()
    if len(word) <= SHORT + 3:  # three pairs are read in a word at most, each a letter longer
        for x in {s, strokes(word.replace("ln", "h").replace("nn", "m"))}:
            out |= {x} | {x[:i] + x[i + 1 :] for i in range(len(x))}
    if len(word) >= SHORT - 3:
        out.add("\x02" + re.sub("i+", "i", s))
    return out


def distance(read: str, printed: str, most: float = MAX_COST) -> float:
    """Weighted edit distance from a printed word to what was read of it; inf beyond ``most``.

    Only places within ``most`` are visited, so long words cost their length.
    """
    n, m = len(read), len(printed)
    rows: list[dict[int, float]] = [{} for _ in range(n + 1)]
    rows[0][0] = 0.0

    def put(i: int, j: int, d: float) -> None:
        if d <= most and d < rows[i].get(j, float("inf")):
            rows[i][j] = d

    for i in range(n + 1):
        row = rows[i]
        for j in sorted(row):
            while True:  # a letter left out leads to the next place of the same row
                d = row[j]
                if i < n and j < m:
                    put(i + 1, j + 1, d if read[i] == printed[j] else d + 1)
                for size in (1, 2):
                    for to in PAIRS.get(read[i : i + size], ()) if i + size <= n else ():
                        if printed.startswith(to, j):
                            put(i + size, j + len(to), d + CONFUSED)
                if i < n:
                    put(i + 1, j, d + 1)
                if j >= m or d + 1 > most or d + 1 >= row.get(j + 1, float("inf")):
                    break
                row[j + 1] = d + 1
                j += 1
    return rows[n].get(m, float("inf"))


def _indexed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for at in range(0, len(b), 2000):
            part = b.iloc[at : at + 2000]
            out = [(w, n, d) for w, n in zip(part.word, part.n) for d in forms(w)]
            yield pd.DataFrame(out, columns=["word", "n", "form"])


def _cost(read: str, printed: str) -> float:
    if read[:1] == "\x01":
        return CONFUSED if printed[2] in CJK_PAIRS.get(read[2], ()) else float("inf")
    return distance(read, printed)


def _measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        b = b.assign(cost=[_cost(a, c) for a, c in zip(b.word, b.candidate)])
        yield b[b.cost <= MAX_COST][["word", "n", "candidate", "m", "cost"]]


def candidates(words: DataFrame) -> DataFrame:
    """word, n, candidate, m, cost for rare words (word, n), by a symmetric-delete index.

    A candidate is a word of letters only, ``LEXICON_LEAST`` times or more in the corpus and
    ``RATIO_*`` times as frequent as the word. Both sides are joined on their ``forms``.
    """
    held = "^.*(?:[" + "".join(re.escape(p) for p in PAIRS if len(p) == 1) + "]|" + "|".join(p for p in PAIRS if len(p) == 2) + ").*$"
    window = F.col("word").startswith("\x01")
    read = F.substring("word", 3, 1).isin(*CJK_PAIRS)
    lexicon = words.filter((F.col("n") >= LEXICON_LEAST) & (window & ~read | F.col("word").rlike(r"^[\p{L}'’]+$")))
    rare = words.filter(window & read | ~window & F.col("word").rlike(held) & ~F.col("word").contains("-"))
    index = lexicon.mapInPandas(_indexed, "word string, n long, form string").select(F.col("word").alias("candidate"), F.col("n").alias("m"), "form")
    asked = rare.mapInPandas(_indexed, "word string, n long, form string")
    ratio = F.when(window | F.col("word").rlike(SIGNS), RATIO_SIGNS).otherwise(RATIO_LETTERS)
    near = asked.join(index, "form").filter((F.col("word") != F.col("candidate")) & (F.col("m") >= F.col("n") * ratio)).select("word", "n", "candidate", "m").distinct()
    return near.mapInPandas(_measured, "word string, n long, candidate string, m long, cost double")


SIGNS = r"[0-9@†|!$€]"


def decisions(counted: DataFrame) -> DataFrame:
    """before, word, repair: what to read for a misread word after the word before it.

    counted: word, before, n as of ``frequencies``. Each candidate is weighed by the logarithms of its
    frequency and of the pair's against the cost of its edits, and so is the word as it is read, without
    the very place that asks. Words that stay have no row. Compounds whose hyphen is their
    own have a row without a repair.
    """
    words = counted.filter(F.col("before").isNull() & ~F.col("word").startswith(SLOT)).select("word", "n")
    pairs = counted.filter("before is not null").select("before", F.col("word").alias("candidate"), F.col("n").alias("together"))
    near = candidates(words)
    window = F.col("word").startswith("\x01")
    asked = pairs.select("before", F.col("candidate").alias("word"), F.col("together").alias("read")).join(near.filter(~window), "word")
    asked = asked.unionByName(near.filter(window).select("word", F.lit("").alias("before"), F.lit(1).cast("long").alias("read"), "n", "candidate", "m", "cost"))
    hits = asked.join(pairs, ["before", "candidate"], "left")
    score = F.log(F.col("m") + 1.0) + 2 * F.log(F.coalesce("together", F.lit(0)) + 1.0) - 8 * F.col("cost")
    kept = F.log(F.col("n").cast("double")) + 2 * F.log(F.col("read").cast("double")) - F.when(window | F.col("word").rlike(SIGNS), UNREAD_SIGNS).otherwise(UNREAD)
    best = hits.groupBy("before", "word").agg(F.max(F.struct(score.alias("s"), F.col("candidate").alias("repair"))).alias("x"), F.first(kept).alias("kept"))
    own = words.filter(F.col("word").contains("-") & (F.col("n") >= 2)).select(F.lit("").alias("before"), "word", F.lit(None).cast("string").alias("repair"))
    return best.filter(F.col("x.s") > F.col("kept")).select("before", "word", F.col("x.repair").alias("repair")).unionByName(own)


REPAIRED = "doc_id string, anchor string, text string, noise array<string>"


def _asked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What each body may ask the decisions for, once each: its words with the word before, its
    windows, and the compounds of its broken words."""
    for b in batches:
        out: set[tuple] = set()
        for doc, anchor, body in zip(b.doc_id, b.anchor, b.body):
            lines, _ = lines_of(body, doc or "")
            if len(lines) > 1:
                out.update((doc, anchor, "", f"{a}-{rest}".lower().strip(".,;:")) for _, a, mark, rest in breaks(lines) if mark in "-‐")
            text = unmarked(joined(lines)[0] if len(lines) > 1 else body)
            found = words_of(text)
            out.update((doc, anchor, last, w) for last, w in zip(["", *found], found))
            out.update((doc, anchor, "", w) for _, w in windows(text, _READ))
        yield pd.DataFrame(list(out), columns=["doc_id", "anchor", "before", "word"])


class Book:
    """All decisions in memory, where they are few enough."""

    def __init__(self, rows: list[tuple[str, str, str | None]]) -> None:
        self.repairs = {(before, word): to for before, word, to in rows if to is not None}
        self.known = frozenset(word for _, word in self.repairs if word[:1] != "\x01")
        self.compounds = frozenset(word for _, word, to in rows if to is None)
        self.search: ahocorasick.Automaton | None = None  # built where it is used

    def __getstate__(self) -> dict:
        return self.__dict__ | {"search": None}

    def may_repair(self, text: str) -> bool:
        """Whether a text in lower case holds a word that has a repair, or what looks like one."""
        if self.search is None:
            self.search = ahocorasick.Automaton()
            for w in self.known:
                self.search.add_word(w, len(w))
            self.search.make_automaton()
        if not self.known:
            return False
        for end, n in self.search.iter(text):
            if text[end + 1 : end + 2] not in _PART_OF_WORD and (end < n or text[end - n] not in _PART_OF_WORD):
                return True
        return False

    def found(self, words: list[str]) -> dict[tuple[str, str], str]:
        """The repairs of the words of a text, by the word before and the word."""
        return {k: self.repairs[k] for k in zip(["", *words], words) if k in self.repairs}


class _Parts(dict):
    """Whether a character is part of a word."""

    def __missing__(self, c: str) -> bool:
        self[c] = v = c != "" and re.match(f"[{_IN}]", c) is not None
        return v

    def __contains__(self, c: object) -> bool:
        return self[c]


_PART_OF_WORD = _Parts()


def _repair_by(book):
    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(doc, anchor, *repair(body, doc, book.value, laid)) for doc, anchor, body, laid in zip(b.doc_id, b.anchor, b.body, b.laid)]
            yield pd.DataFrame(out, columns=["doc_id", "anchor", "text", "noise"])

    return of


def _repair(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for doc, anchor, body, laid, found in zip(b.doc_id, b.anchor, b.body, b.laid, b.found):
            book = Book([(r["before"], r["word"], r["repair"]) for r in found] if found is not None else [])
            out.append((doc, anchor, *repair(body, doc, book, laid)))
        yield pd.DataFrame(out, columns=["doc_id", "anchor", "text", "noise"])


_CJK_STOPS = re.compile(rf"(?<=[{CJK}])(?:([.,])(?=\s*[{CJK}]|\s*\d|\s*$)|(`)(?=\s|$))", re.M)
_CJK_UNIT = re.compile(rf"(?<=[{CJK}])([\d.,\s]{{1,12}}[A-Za-zµμ°·%]{{1,4}})\.(?=[{CJK}])")
_CJK_MARKS = {".": "。", ",": "，", "`": "、"}

_MISREAD_MARK = re.compile(rf"[.,`丨](?<=[{CJK}].)|\.(?=[{CJK}])")  # what the marks' patterns begin or end with
_STROKE = re.compile(rf"(?<=[{CJK}])丨(?=[{CJK}，。、]|\s|$)", re.M)  # a stroke that no word has


def marks_repaired(text: str) -> str:
    """Marks of Chinese and Japanese texts that are read as those of other scripts, line by line."""
    if text.isascii() or not _MISREAD_MARK.search(text):
        return text
    japanese = len(re.findall(r"[぀-ヿ]", text)) > len(text) // 50
    lines = text.split("\n")
    for i, x in enumerate(lines):
        n = 0 if x.isascii() or not _MISREAD_MARK.search(x) else len(_CHARACTER.findall(x))
        if n > 1 and n * 2 >= sum(map(str.isalpha, x)):
            x = _CJK_STOPS.sub(lambda m: "、" if japanese and m[1] == "," else _CJK_MARKS[m[1] or m[2]], x)
            lines[i] = _STROKE.sub("", _CJK_UNIT.sub(r"\1。", x))
    return "\n".join(lines)


def characters_repaired(text: str, repairs: dict[tuple[str, str], str]) -> str:
    """Misread characters of Chinese and Japanese texts replaced, by the windows that have a repair."""
    if text.isascii() or not repairs:
        return text
    at = {i: to[2] for i, w in windows(text, _READ) if (to := repairs.get(("", w)))}
    return "".join(at.get(i, c) for i, c in enumerate(text)) if at else text


_EOL = re.compile(r"\r\n|\r|\n")
_NONE = Book([])


def repair(body: str | None, doc: str | None, book: Book = _NONE, laid: bool = True) -> tuple[str | None, list[str]]:
    """Repaired text and kinds of noise of one body, by the decisions of a book. ``laid`` is false for a
    body that is known to be one piece."""
    if not isinstance(body, str) or not body.strip():
        return body, []
    lines, kinds = lines_of(body, doc or "") if laid else ([body], set())
    kinds = set(kinds)
    text = body
    if len(lines) > 1:
        text, hyphen = joined(lines, book.compounds)
        if hyphen:
            kinds.add("hyphen")
    found = book.found(words_of(unmarked(text))) if book.may_repair(text.lower()) else {}
    whole = len(lines) > 1
    for _ in range(2):  # repaired as it stands, and again as paragraphs if there was anything to repair
        fixed = marks_repaired(characters_repaired(_replaced(text, found), book.repairs))
        if fixed == text or whole:
            break
        text, whole = joined(_EOL.split(body))[0], True
    if fixed != text:
        kinds.add("glyph")
    return (fixed if kinds else body), [k for k in KINDS if k in kinds]


def _replaced(text: str, found: dict[tuple[str, str], str]) -> str:
    """A text with its misread words repaired, but for those inside mark-up."""
    if not found:
        return text
    marked = [m.span() for m in _MARKED.finditer(text)]
    out, at, last = [], 0, ""
    for m in _WORD.finditer(text.lower()):
        w = m[0]
        if not is_word(w):
            continue
        to, (a, b) = found.get((last, w)), m.span()
        last = w
        if to and not any(x < b and a < y for x, y in marked):
            word = text[a:b]
            if word[0].isupper() or not word[0].isalpha() and (a == 0 or re.search(r"[.!?]\s*$", text[max(0, a - 3) : a])):
                to = to[0].upper() + to[1:]
            out += [text[at:a], to.upper() if word.upper() == word and len(word) > 2 and any(map(str.isalpha, word)) else to]
            at = b
    return "".join([*out, text[at:]])


MOST_SENT = 200_000  # decisions that are sent to the tasks; more are joined


def repair_scans(sections: DataFrame, most_sent: int = MOST_SENT) -> DataFrame:
    """Continuous text and kinds of noise for each body (doc_id, anchor, body), one row per row.

    Null, blank and clean bodies stay as they are, without kinds. Rows are told apart by doc_id and
    anchor, which should be unique. Other columns are left out. Up to ``most_sent`` decisions go to the
    tasks as a book; more are joined with the words of each body, with the same result.
    """
    sections = sections.select("doc_id", "anchor", "body")
    counted = checkpointed(frequencies(sections))  # small beside the texts, and read several times
    decided = checkpointed(decisions(counted))
    few = decided.limit(most_sent + 1).collect()
    # bodies that were one piece when they were counted are not laid out again
    slots = counted.filter(F.col("word").startswith(SLOT)).select(F.substring("word", 2, 20).cast("long").alias("slot"))
    sections = with_bit(sections, ["doc_id", "anchor"], slots, "laid")
    if len(few) <= most_sent:
        book = Book([tuple(r) for r in few])
        return sections.mapInPandas(_repair_by(sections.sparkSession.sparkContext.broadcast(book)), REPAIRED)
    asked = sections.filter("body is not null").mapInPandas(_asked, "doc_id string, anchor string, before string, word string")
    found = asked.join(decided, ["before", "word"]).groupBy("doc_id", "anchor").agg(F.collect_list(F.struct("before", "word", "repair")).alias("found"))
    a, f = sections.alias("a"), found.alias("f")
    both = a.join(f, F.col("a.doc_id").eqNullSafe(F.col("f.doc_id")) & F.col("a.anchor").eqNullSafe(F.col("f.anchor")), "left")
    return both.select("a.doc_id", "a.anchor", "a.body", "a.laid", "f.found").mapInPandas(_repair, REPAIRED)
