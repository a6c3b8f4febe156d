from collections import Counter, defaultdict

import numpy as np
import pytest

from strataframe.llm import packing as K


def test_nnls_finds_the_solution():
    rng = np.random.default_rng(0)
    for _ in range(20):
        a = rng.random((12, 30))
        x = np.where(rng.random(30) < 0.2, rng.random(30), 0)
        got = K.nnls(a, a @ x)
        assert (got >= 0).all() and np.linalg.norm(a @ got - a @ x) < 1e-6
    assert (K.nnls(np.eye(3), np.array([-1.0, 2, -3])) == [0, 2, 0]).all()


@pytest.mark.parametrize("histogram", [{}, {1: 1}, {2048: 3}, {2000: 5}, {1025: 7}, {1: 10_000}, {700: 3, 701: 5}, {k: 2049 - k for k in range(1, 2049, 3)}, {512: 999}, {683: 10, 682: 10, 1365: 4}])
def test_plans_are_whole(histogram):
    p = K.plan(histogram)
    n = Counter()
    for repeat, items in p.groups:
        assert repeat > 0 and sum(a * b for a, b in items.items()) <= 2048
        for a, b in items.items():
            n[a] += repeat * b
    assert n == Counter(histogram)


def test_little_space_is_left():
    rng = np.random.default_rng(1)
    n = np.clip(rng.lognormal(5.6, 1, 20_000).astype(int), 1, 2048)
    h = dict(zip(*map(list, np.unique(n, return_counts=True))))
    p = K.plan({int(a): int(b) for a, b in h.items()})
    assert n.sum() / (2048 * p.containers) > 0.99


def test_places(spark):
    rng = np.random.default_rng(2)
    sizes = [int(x) for x in np.clip(rng.lognormal(3, 1, 400), 1, 64)] + [0, None, 64, 65, 128, 500]
    df = spark.createDataFrame([(i, n, "c") for i, n in enumerate(sizes)], "doc_id long, n_tokens long, container_id string")
    rows = K.pack(df, capacity=64, salts=5).collect()
    used, pieces = Counter(), defaultdict(list)
    for r in rows:
        used[r.container_id] += r.n_tokens
        pieces[r.doc_id].append((r.piece_no, r.token_start, r.n_tokens))
    assert max(used.values()) <= 64
    assert set(used) == set(range(len(used)))
    for i, n in enumerate(sizes):
        p = sorted(pieces[i])
        assert sum(k for _, _, k in p) == (n or 0)
        assert len(p) == max(1, -(-(n or 0) // 64))
        assert [s for _, s, _ in p] == [64 * k for k in range(len(p))]
    assert sum(x or 0 for x in sizes) / (64 * len(used)) > 0.95
    again = {(r.doc_id, r.piece_no): r.container_id for r in K.pack(df.repartition(7), capacity=64, salts=5).collect()}
    assert again == {(r.doc_id, r.piece_no): r.container_id for r in rows}
    assert K.pack(df.limit(0), capacity=64).count() == 0
