"""Token ids of a whole corpus by a public byte-level BPE vocabulary.

Pre-tokens are found without regular expressions. All texts of a batch are one array of code
points. Each has a class (letter, number, space, other) and is, for the boundary search, a
transition function over the scanner's states. Here every function sets the state whatever it was,
so the associative composition of any stretch is the function of its last code point, and the scan
over a whole batch comes down to comparing the arrays with themselves, shifted: one back for runs,
one ahead for the last of a white-space run, two ahead for contractions. The slices between
boundaries are looked up in a cache that pair merging fills, so each different pre-token is merged
once per worker. Offsets are kept, so that tokens can be led back to their characters.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

VOCABULARY = "byte_bpe_50k.tiktoken"
CACHE = 400_000  # pre-tokens that a worker remembers
BATCH_CHARS = 4_000_000

_OTHER, _LETTER, _NUMBER, _SPACE = 0, 1, 2, 3
# White space of Unicode beyond its space separators.
_WHITE = [*range(0x09, 0x0E), 0x85, 0x2028, 0x2029]

_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """The class of each code point, built once per process."""
    global _classes
    if _classes is None:
        of = {"L": _LETTER, "N": _NUMBER}
        _classes = np.fromiter((of.get(c[0], _SPACE if c == "Zs" else _OTHER) for c in map(unicodedata.category, map(chr, range(sys.maxunicode + 1)))), np.int8, sys.maxunicode + 1)
        _classes[_WHITE] = _SPACE
    return _classes


def codepoints(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def boundaries(c: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a pre-token begins at each code point. first: marks where texts begin.

    The rules: runs of one class are one pre-token; a plain space before a run of letters, numbers
    or others belongs to it; of more white space, all but the last code point is a pre-token of its
    own; 's 't 're 've 'm 'll 'd stand alone where they begin a pre-token.
    """
    n = len(c)
    kind = classes()[c]
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    change |= first
    start = change.copy()
    space = kind == _SPACE
    # ends of white-space runs that something else of the same text follows
    last = np.zeros(n, bool)
    last[:-1] = space[:-1] & ~space[1:] & ~first[1:]
    at = np.flatnonzero(last)
    start[at] = True  # the last white space stands apart from those before it ...
    plain = at[c[at] == 32]
    start[plain + 1] = False  # ... and a plain space goes with what follows
    # contractions: an apostrophe that is a run of its own and begins a pre-token
    q = np.flatnonzero((c == 39) & start)
    q = q[(q + 1 < n)]
    q = q[(kind[q + 1] == _LETTER) & ~first[q + 1]]
    if len(q):
        a = c[q + 1]
        one = (a == 115) | (a == 116) | (a == 109) | (a == 100)  # s t m d
        room = (q + 2 < n) & ~first[np.minimum(q + 2, n - 1)]
        b = np.where(room, c[np.minimum(q + 2, n - 1)], 0)
        two = ((a == 114) & (b == 101)) | ((a == 118) & (b == 101)) | ((a == 108) & (b == 108))  # re ve ll
        size = np.where(one, 2, np.where(two, 3, 0))
        hit = size > 0
        q, size = q[hit], size[hit]
        start[q + 1] = False
        end = q + size
        inside = end < n
        start[end[inside]] = True
        long = q[size == 3]
        start[long + 2] = False
        # a plain space cannot be next after a contraction's letters, so nothing else changes
    return start


class Encoder:
    """Merges of one vocabulary, with a cache of pre-tokens. ``ranks`` maps bytes to ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.cache: dict[str, int] = {}
        self._flat: list[int] = []
        self._ends: list[int] = [0]
        self._grown = 0
        self._arrays: tuple[np.ndarray, np.ndarray] | None = None

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one pre-token: always the pair of the lowest rank is merged, leftmost first."""
        if (whole := self.ranks.get(piece)) is not None:
            return [whole]
        ranks, n = self.ranks, len(piece)
        if n < 64:
            parts = [piece[i : i + 1] for i in range(n)]
            while len(parts) > 1:
                best, where = None, -1
                for i in range(len(parts) - 1):
                    r = ranks.get(parts[i] + parts[i + 1])
                    if r is not None and (best is None or r < best):
                        best, where = r, i
                if best is None:
                    break
                parts[where : where + 2] = [parts[where] + parts[where + 1]]
            return [ranks[p] for p in parts]
        # long ones: a heap of pairs over a linked list, so that time is n log n
        end = list(range(1, n + 1))
        nxt, prv, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[int, int, int]] = []
        for i in range(n - 1):
            if (r := ranks.get(piece[i : i + 2])) is not None:
                heap.append((r, i, i + 2))
        heapq.heapify(heap)
        while heap:
            r, i, e = heapq.heappop(heap)
            j = nxt[i] if alive[i] else n
            if not alive[i] or j >= n or end[j] != e:
                continue
            end[i], alive[j], nxt[i] = e, False, nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (x := ranks.get(piece[i : end[nxt[i]]])) is not None:
                    heapq.heappush(heap, (x, i, end[nxt[i]]))
            if (p := prv[i]) >= 0 and (x := ranks.get(piece[p:e])) is not None:
                heapq.heappush(heap, (x, p, e))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = nxt[i]
        return out

    def _slot(self, piece: str) -> int:
        self._flat += self.merge(piece.encode("utf-8", "surrogatepass"))
        self._ends.append(len(self._flat))
        self.cache[piece] = slot = len(self._ends) - 2
        return slot

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, where each text ends in them, and for the offsets the number
        of tokens of each pre-token and the code point at which each pre-token begins."""
        joined = "".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        if not joined:
            none = np.zeros(0, np.int64)
            return none.astype(np.int32), np.zeros(len(texts), np.int64), none, none
        c = codepoints(joined)
        first = np.zeros(len(c), bool)
        begins = ends - sizes
        first[begins[sizes > 0]] = True
        at = np.flatnonzero(boundaries(c, first))
        cut = at.tolist()
        cut.append(len(joined))
        pieces = [joined[a:b] for a, b in zip(cut, cut[1:])]
        if len(self.cache) > CACHE:
            self.cache.clear()
            self._flat, self._ends = [], [0]
        get = self.cache.get
        slots = list(map(get, pieces))
        if None in slots:
            for i, s in enumerate(slots):
                if s is None:
                    slots[i] = self.cache[pieces[i]] if pieces[i] in self.cache else self._slot(pieces[i])
            self._arrays = None
        if self._arrays is None:
            self._arrays = np.array(self._flat, np.int32), np.array(self._ends, np.int64)
        flat, bounds = self._arrays
        s = np.array(slots, np.int64)
        lo, count = bounds[s], bounds[s + 1] - bounds[s]
        stop = np.cumsum(count)
        where = np.arange(stop[-1]) - np.repeat(stop - count - lo, count)
        # tokens up to the end of each text: those of the pre-tokens that begin before it
        upto = np.concatenate([[0], stop])[np.searchsorted(at, ends, "left")]
        return flat[where], upto, count, at


_encoders: dict[str, Encoder] = {}


def load(path: str) -> Encoder:
    """The encoder of a vocabulary file (base64 bytes and id on each line), once per process."""
    if path not in _encoders:
        with open(path, "rb") as f:
            _encoders[path] = Encoder({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})
    return _encoders[path]


def groups(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``BATCH_CHARS`` characters, so that memory stays bounded."""
    a = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if size and size + n > BATCH_CHARS:
            yield a, i
            a, size = i, 0
        size += n
    if a < len(texts):
        yield a, len(texts)


def encode(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and ids (array of int) of each row. Null and empty texts both have the empty list.

    Strings that look like special tokens are ordinary text. Other columns are left out.
    """
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = load(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for a, z in groups(texts):
                ids, upto, _, _ = e.encode(texts[a:z])
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], upto]).astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), lists], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(of, f"{key} {kind}, ids array<int>")


def counts(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key`` and n_tokens of each row, for what needs sizes only."""
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = load(path)
        for b in batches:
            texts = [t or "" for t in b.column(1).to_pylist()]
            for a, z in groups(texts):
                _, upto, _, _ = e.encode(texts[a:z])
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array(np.diff(np.concatenate([[0], upto])), pa.int64())], names=[key, "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(of, f"{key} {kind}, n_tokens long")


def offsets(texts: list[str], path: str) -> list[list[tuple[int, int]]]:
    """Characters (start, end) that the tokens of each text come from. A token that is part of a
    character covers the whole of it."""
    e, out = load(path), []
    for t in texts:
        ids, _, count, at = e.encode([t])
        spans: list[tuple[int, int]] = []
        back = {i: b for b, i in e.ranks.items()} if not hasattr(e, "back") else e.back
        e.back = back
        stop = np.cumsum(count)
        for k, a in enumerate(at.tolist()):
            b = at[k + 1] if k + 1 < len(at) else len(t)
            place = [a + i for i, ch in enumerate(t[a:b]) for _ in ch.encode("utf-8", "surrogatepass")]
            done = 0
            for i in ids[stop[k] - count[k] : stop[k]].tolist():
                n = len(back[i])
                spans.append((place[done], place[done + n - 1] + 1))
                done += n
        out.append(spans)
    return out
