import random

from hypothesis import given, settings
from hypothesis import strategies as st

from strataframe.llm import split as S


def checked(text, limit, overlap):
    ps = S.pieces(text, limit, overlap)
    assert all(len(t) <= limit for _, _, t in ps)
    assert "".join([ps[0][2], *(t[overlap:] for _, _, t in ps[1:])]) == text
    for (_, b, t), (a, _, u) in zip(ps, ps[1:]):
        assert a == b - overlap and t[-overlap:] == u[:overlap]
    return ps


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="ab. \n,é中。́", max_size=600), st.integers(20, 80))
def test_pieces_round_trip(text, limit):
    checked(text, limit, limit // 5)


def test_least_number_and_balance():
    random.seed(1)
    text = " ".join("".join(random.choices("abc", k=5)) for _ in range(4000))
    ps = checked(text, 6000, 200)
    assert len(ps) == 1 + -(-(len(text) - 6000) // 5800)
    assert all(text[b - 1] == " " for _, b, _ in ps[:-1])


def test_strong_boundaries_win():
    text = "x " * 1500 + "\n\n" + "y. " * 1100
    assert S.cuts(text, 6000, 200) == [3002]


def test_no_boundaries_and_limits():
    assert S.cuts("x" * 6000) == []
    checked("x" * 6001, 6000, 200)
    checked("x" * 50_000, 6000, 200)
    assert len(S.pieces("")) == 1


def test_rows(spark):
    rows = [("d", "a", "x" * 6001), ("d", "b", "x" * 6000), ("d", "c", None), ("d", "e", ""), ("d", "f", "\U0001f642" * 6001)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id string, anchor string, body string, text string")
    got = S.split_oversized(df)
    assert {r.anchor for r in got.collect()} == {"a", "f"}
    assert S.split_oversized(df.limit(0)).count() == 0
