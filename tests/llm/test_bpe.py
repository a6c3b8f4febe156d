import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from strataframe.llm import bpe, plans

PIECES = ["a", "'", "s", "ll", "re", " ", "  ", "\n", "\t", "1", "²", "é", "中", "!", "'t", "\xa0", "\u200b", "\x1c", "\x85", "\u3000", "<|endoftext|>", "'S", "’s", "ⅷ", "\u0301", "🙂", "\x00", "\ufeff", "m", "d", "ve", "\x0b", "\u2028"]


@pytest.fixture(scope="module")
def path(spark):
    return plans.vocabulary(spark)


@pytest.fixture(scope="module")
def reference(path):
    t = Tokenizer.from_file(path.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def ours(path, texts):
    ids, upto, _, _ = bpe.load(path).encode(texts)
    return [ids[a:b].tolist() for a, b in zip([0, *upto[:-1]], upto)]


def test_random_texts(path, reference):
    r = random.Random(0)
    texts = ["".join(r.choices(PIECES, k=r.randint(0, 14))) for _ in range(20_000)]
    assert ours(path, texts) == reference(texts)


def test_long_pieces(path, reference):
    texts = ["x" * 50_000, "ab" * 30_000, "é" * 5000, " " * 40_000, "!?" * 9000, "1" * 7777, "中文" * 4000]
    assert ours(path, texts) == reference(texts)


def test_documents(spark, sf, path, reference):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("text").filter("text is not null").toPandas().text.tolist()
    assert ours(path, rows) == reference(rows)


def test_decoding_and_offsets(path):
    e = bpe.load(path)
    back = {i: b for b, i in e.ranks.items()}
    for text in ("it's 中文 🙂x\n\n  y", "", "a"):
        ids = e.encode([text])[0]
        assert b"".join(back[i] for i in ids.tolist()).decode() == text
        spans = bpe.offsets([text], path)[0]
        assert len(spans) == len(ids)
        covered = np.zeros(len(text), bool)
        for a, b in spans:
            covered[a:b] = True
        assert covered.all()


def test_rows(spark, path):
    df = spark.createDataFrame([(1, "", 5), (2, None, 5), (3, "a b", 5), (3, "a b", 5)], "doc_id long, text string, ids long")
    got = sorted((r.doc_id, r.ids) for r in bpe.encode(df, path).collect())
    assert got == [(1, []), (2, []), (3, [64, 275]), (3, [64, 275])]
    assert sorted((r.doc_id, r.n_tokens) for r in bpe.counts(df, path).collect()) == [(1, 0), (2, 0), (3, 2), (3, 2)]
    assert bpe.encode(df.limit(0), path).count() == 0


def test_small_batches_give_the_same(spark, path, monkeypatch):
    texts = ["abc def", None, "", "x" * 30, "it's"]
    assert list(bpe.groups(["a" * bpe.BATCH_CHARS, "b", "c"])) == [(0, 1), (1, 3)]
    monkeypatch.setattr(bpe, "BATCH_CHARS", 4)
    assert [z for _, z in bpe.groups(texts)][-1] == len(texts)
