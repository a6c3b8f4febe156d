"""Languages of texts and of their stretches.

A multinomial naive Bayes model over hashed character n-grams (two and three characters, spaces
and both ends of the text as characters). It is trained on a bounded sample of sentences with the labels
that their documents have; as some labels are wrong, the fit is repeated on the labels that the
first fit gives. The matrix of log probabilities (buckets x languages) is broadcast, and whole
batches of sentences are scored at once in numpy.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataframe.llm import markup, scans
from strataframe.llm.texts import sentences

LANGUAGES = ("en", "zh", "de", "fr", "es", "ja", "pt", "nl")
# English names of the languages.
NAMES = {"english": "en", "chinese": "zh", "german": "de", "french": "fr", "spanish": "es", "japanese": "ja", "portuguese": "pt", "dutch": "nl"}
BUCKETS, ORDER = 1 << 16, 3  # n-grams of two and three characters
SAMPLE_TEXTS, SAMPLE_SENTENCES = 400, 32  # labelled texts for each language, sentences of each; the fit's only bounds
UNKNOWN = "und"  # a text that is like none of the languages
FLOOR, FLOOR_GRAMS = 10.0, 40  # deviations below a language's usual likelihood; n-grams from which it is judged
CONFIDENT = 0.9
CHUNK = 2000  # sentences that are in memory as n-grams at once


def label(text: str | None) -> str | None:
    """The language that a label names: a two-letter code, a code with a region or an English name."""
    t = (text or "").strip().lower()
    if t in NAMES:
        return NAMES[t]
    m = re.fullmatch(r"([a-z]{2})(?:[-_][a-z0-9]{2,8})*", t)
    return m[1] if m and m[1] in LANGUAGES else None


def hashed(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order of n-grams: the buckets of all texts in a row, and where each text begins."""
    c = np.frombuffer("\0".join([*(t.replace("\0", " ") for t in texts), ""]).lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = c == 0
    letter = _letters()[c]
    # runs of other characters become one space, also at both ends of each text
    edge = np.concatenate([[True], ends[:-1]])
    gap = ~letter & ~ends & (np.concatenate([[False], letter[:-1]]) | edge)
    keep = letter | gap | ends
    extra = ends & np.concatenate([[False], letter[:-1]])  # texts that end in a letter get their space
    at = np.flatnonzero(keep)
    c = np.where(letter, c, np.where(ends, 10, 32))[at].astype(np.uint32)
    c = np.insert(c, np.flatnonzero(extra[at]), 32)
    first = np.concatenate([[True], c[:-1] == 10])
    c = np.insert(c, np.flatnonzero(first & (c != 32) & (c != 10)), 32)
    ends = c == 10
    broken, h = np.zeros(len(c), bool), np.zeros(len(c), np.uint32)
    for n in range(1, ORDER + 1):
        if len(c) < n:
            return
        m = len(c) - n + 1
        h = h[:m] * np.uint32(0x9E3779B1) + c[n - 1 :]
        broken = broken[:m] | ends[n - 1 :]
        if n < 2:
            continue
        keep = ~broken
        x = h[keep] * np.uint32(0x85EBCA6B)
        x ^= x >> np.uint32(15)
        x *= np.uint32(0xC2B2AE35)
        x ^= x >> np.uint32(16)
        begin = np.concatenate([[0], np.flatnonzero(ends) + 1])[:-1]
        yield (x & np.uint32(BUCKETS - 1)).astype(np.int64), np.concatenate([[0], np.cumsum(keep)])[np.minimum(begin, m)]


_table: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Which code points are letters, built once per process."""
    global _table
    if _table is None:
        _table = np.fromiter(map(str.isalpha, map(chr, range(0x110000))), bool, 0x110000)
    return _table


def fit(texts: list[str], labels: list[int], k: int) -> np.ndarray:
    """Log probabilities, buckets x languages, smoothed; equal in every bucket for no texts."""
    counts = np.full((BUCKETS, k), 0.1)
    y = np.asarray(labels, np.int64)
    for at in range(0, len(texts), CHUNK):
        for b, begin in hashed(texts[at : at + CHUNK]):
            sizes = np.diff(np.append(begin, len(b)))
            counts += np.bincount(b * k + np.repeat(y[at : at + CHUNK], sizes), minlength=BUCKETS * k).reshape(BUCKETS, k)
    return np.log(counts / counts.sum(0)).astype(np.float32)


def scores(model: np.ndarray, texts: list[str]) -> np.ndarray:
    """Posteriors of each language for each text, with equal priors; equal for texts without letters.

    As n-grams overlap, a text has the weight of about the square root of their number only.
    """
    return likelihoods(model, texts)[0]


def likelihoods(model: np.ndarray, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors as of ``scores``, the mean log probability of a text's n-grams in its likeliest language,
    and their number."""
    if len(texts) > CHUNK:
        return tuple(map(np.concatenate, zip(*(likelihoods(model, texts[at : at + CHUNK]) for at in range(0, len(texts), CHUNK)))))
    out, size = np.zeros((len(texts), model.shape[1])), np.ones(len(texts))
    if not texts:
        return out, size, size
    for b, begin in hashed(texts):
        some = np.diff(np.append(begin, len(b))) > 0
        if some.any():
            out[some] += np.add.reduceat(model[b], begin[some], axis=0)
            size += np.diff(np.append(begin, len(b)))
    best = out.max(1)
    p = np.exp((out - best[:, None]) / np.sqrt(size)[:, None])
    return p / p.sum(1, keepdims=True), best / size, size


def floors(model: np.ndarray, texts: list[str], labels: list[int]) -> np.ndarray:
    """For each language the mean log probability below which a text is taken for none of them: ``FLOOR``
    deviations below the mean. On the project's texts held-out sentences stay within 8, Italian ones are 12 and those of
    less related languages 30 or more below."""
    p, mean, size = likelihoods(model, texts)
    best, y, out = p.argmax(1), np.asarray(labels, np.int64), np.full(model.shape[1], -np.inf, np.float32)
    for k in range(model.shape[1]):
        x = mean[(best == k) & (y == k) & (size >= FLOOR_GRAMS)]
        if len(x) >= 30:
            out[k] = x.mean() - FLOOR * x.std()
        elif not (y == k).any():  # a language that was never seen is likeliest for what is like no other
            out[k] = np.inf
    return out


def plain(body: str | None, doc: str | None = "") -> str:
    """Text of a body without mark-up, headings, tables, code and lines of scanned pages."""
    if not isinstance(body, str) or not body.strip():
        return ""
    if markup._ANY.search(body):
        bs = markup.blocks(body)
        if any(b.strong for b in bs):
            body = "\n\n".join(b.text or "" for b in bs if b.kind not in ("code", "formula", "heading", "table", "navigation"))
            return re.sub(r"^[ \t]*#{1,6} .*$", "\n", body, flags=re.M)
    lines, _ = scans.lines_of(body, doc or "")
    if len(lines) > 1:
        return scans.joined(lines)[0]
    return body


def _code(label: Column) -> Column:
    named = F.lower(F.trim(label))
    names = F.create_map(*(F.lit(x) for kv in NAMES.items() for x in kv))
    code = F.coalesce(names[named], F.regexp_extract(named, "^([a-z]{2})(?:[-_][a-z0-9]{2,8})*$", 1))
    return F.when(code.isin(*LANGUAGES), code)


def train(labels: DataFrame, sections: DataFrame, per_language: int = SAMPLE_TEXTS) -> np.ndarray:
    """A model from bodies (doc_id, anchor, body) with labels (doc_id, anchor, label).

    About ``per_language`` bodies of each label are taken by the hash of their key, and of each body
    up to ``SAMPLE_SENTENCES`` by the hash of the sentence, so the sample is
    bounded and the same in any order. The keys are chosen without reading bodies, and sent to the
    scan of the bodies; sentences are cut where the bodies are read. The last row holds the languages' floors.
    """
    keys = labels.select("doc_id", "anchor", _code(F.col("label")).alias("code")).filter("code is not null")
    rate = {r.code: min(1.0, per_language / r.n) for r in keys.groupBy("code").agg(F.count("*").alias("n")).collect()}
    if not rate:
        return np.zeros((BUCKETS, len(LANGUAGES)), np.float32)
    cut = F.create_map(*(F.lit(x) for kv in rate.items() for x in kv))
    unit = F.pmod(F.xxhash64("doc_id", "anchor"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = keys.filter(unit < cut[F.col("code")]).limit(2 * per_language * len(LANGUAGES))

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for doc, anchor, code, body in zip(b.doc_id, b.anchor, b.code, b.body):
                t = plain(body, doc)
                found = sorted({t[x:y] for x, y in sentences(t)}, key=lambda x: (zlib.crc32(x.encode("utf-8", "replace")), x))
                out += [(code, doc, anchor, x) for x in found[:SAMPLE_SENTENCES]]
            yield pd.DataFrame(out, columns=["code", "doc_id", "anchor", "sentence"])

    sample = sections.filter(F.length("body") >= 60).select("doc_id", "anchor", "body").join(F.broadcast(chosen), ["doc_id", "anchor"]).select("doc_id", "anchor", "code", "body")
    rows = sorted({tuple(r) for r in sample.mapInPandas(of, "code string, doc_id string, anchor string, sentence string").collect()})
    texts, y = [r[3] for r in rows], [LANGUAGES.index(r[0]) for r in rows]
    model = fit(texts, y, len(LANGUAGES))
    for _ in range(2):  # wrong labels and foreign sentences are few; the fit itself corrects them
        y = scores(model, texts).argmax(1).tolist()
        model = fit(texts, y, len(LANGUAGES))
    return np.vstack([model, floors(model, texts, y)])


SEGMENTS = "doc_id string, anchor string, start int, end int, language string, confidence double, n_sentences int, n_chars int"


def stretches(text: str, spans: list[tuple[int, int]], p: np.ndarray) -> list[tuple[int, int, int, float, int]]:
    """Stretches of sentences in one language: start, end, language, confidence and number of
    sentences. A sentence that is unsure goes with the surest of its neighbours."""
    best, sure = p.argmax(1), p.max(1)  # the last column, if there is one more, is that of no language
    for i in np.flatnonzero(sure < CONFIDENT):
        near = [j for j in (i - 1, i + 1) if 0 <= j < len(spans) and sure[j] >= CONFIDENT]
        if near:
            j = max(near, key=lambda j: p[i, best[j]])
            if p[i, best[j]] > 0.05 * p[i].max():
                best[i] = best[j]
    out: list[tuple[int, int, int, float, int]] = []
    i = 0
    while i < len(spans):
        j = i
        while j + 1 < len(spans) and best[j + 1] == best[i]:
            j += 1
        out.append((spans[i][0], spans[j][1], int(best[i]), float(np.mean([p[x, best[i]] for x in range(i, j + 1)])), j - i + 1))
        i = j + 1
    return out


def segments(sections: DataFrame, model: np.ndarray) -> DataFrame:
    """Stretches of each body (doc_id, anchor, body) in one language, offsets in its running text.

    A body without whole sentences (null, blank, figures, lists, headings, code) gives no rows. A sentence
    far less likely than its likeliest language usually is, is ``und``.
    """
    shared = sections.sparkSession.sparkContext.broadcast(model)

    def of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            texts = list(map(plain, b.body, b.doc_id))
            spans = [sentences(t) for t in texts]
            out = []
            flat = [t[x:y] for t, s in zip(texts, spans) for x, y in s]
            p, mean, size = likelihoods(shared.value, flat)
            if len(shared.value) > BUCKETS and flat:
                strange = (size >= FLOOR_GRAMS) & (mean < shared.value[BUCKETS][p.argmax(1)])
                p = np.column_stack([np.where(strange[:, None], 0, p), np.where(strange, CONFIDENT, 0)])
            at = 0
            for doc, anchor, t, s in zip(b.doc_id, b.anchor, texts, spans):
                for x, y, lang, sure, n in stretches(t, s, p[at : at + len(s)]):
                    out.append((doc, anchor, x, y, (*LANGUAGES, UNKNOWN)[lang], sure, n, y - x))
                at += len(s)
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SEGMENTS.split(", ")])

    return sections.select("doc_id", "anchor", "body").mapInPandas(of, SEGMENTS)


def documents(found: DataFrame) -> DataFrame:
    """The language of each body: that of most characters, with the share-weighted confidence."""
    by = found.groupBy("doc_id", "anchor", "language").agg(F.sum("n_chars").alias("n"), F.sum(F.col("confidence") * F.col("n_chars")).alias("w"))
    return by.groupBy("doc_id", "anchor").agg(F.max_by("language", F.struct("n", "language")).alias("language"), (F.max_by("w", F.struct("n", "language")) / F.sum("n")).alias("confidence"), F.count("*").alias("n_languages"))


def mislabelled(found: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, anchor, language of the bodies whose label (doc_id, anchor, label) isn't their one language.
    Stretches in no known language say nothing of the label."""
    langs = found.filter(F.col("language") != UNKNOWN).groupBy("doc_id", "anchor").agg(F.collect_set("language").alias("languages"))
    both = langs.join(labels.select("doc_id", "anchor", _code(F.col("label")).alias("code")), ["doc_id", "anchor"], "left")
    wrong = both.filter((F.size("languages") > 1) | F.col("code").isNull() | (F.col("languages")[0] != F.col("code")))
    return wrong.select("doc_id", "anchor", F.explode("languages").alias("language"))
