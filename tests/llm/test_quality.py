import random

import pytest

from strataframe.llm import quality as Q

COMMON = Q.Common([("en", w) for w in "the of and is a to in by for has been must be on".split()] + [("zh", w) for w in ("的", "在", "之", "后", "了", "没有")])
PROSE = "The gap between the covers must be measured twice. The supplier has been told to keep it in line for the next build. "


@pytest.mark.parametrize(
    ("text", "shape"),
    [
        (PROSE * 3, "prose"), ("## Head\n\n" + PROSE + "\n\n- one\n- two", "prose"), ("\n".join(PROSE[i : i + 40] for i in range(0, len(PROSE), 40)), "prose"), ("天线窗口在107小时之后的位移。没有人知道了。在之后没有的。", "prose"),
        ("- check pad\n- spare cover\n- lot of coils", "list"), ("1. pad\n2. cover\n3. coil", "list"), ("1.1 Intro ........ 3\n1.2 Scope ........ 4", "list"), ("pad: 3 W\ncover: 4 W\ncoil: 9.7 V", "list"), ("REQ-1: pad\nREQ-2: cover", "list"), ("thermal pad\nrear cover\nlatch spring", "list"), ("a pad\n\na cover\n\na coil", "list"),
        ("item\tlot\tvalue\npad\t3\t4\ncover\t\t5", "table"), ("item,lot,value\npad,3,4\n,5,6", "table"), ("| a | b |\n|---|---|\n| c | d |", "table"), ("item      lot     value\npad       3       4\ncover     55      6", "table"), ("<table><tr><td>a</td><td>1</td></tr><tr><td>b</td><td>2</td></tr></table>", "table"), ("pad;3;4\ncover;5;6", "table"),
        ("xzvq dmxf hnz qnpd jzhw knhr jntk gprk qwqt bxbx pgbh kwpv mqgd", "junk"), ("pad cover " * 50, "junk"), ("~~~ ### $$$\n%%% ^^^", "junk"), ("zYdF7EDr7Nne4aa4tV3A/yJ+BWPtUx8r5PViPyWecBJsoJCBP" * 4, "junk"), ("<< Prev  Next >>\n" * 20, "junk"), ("EHT\\x00PAM&&??SIHT%20NOITCES0x49f1" * 4, "junk"), ("4284 163 99925 763 5482", "junk"),
        ("", None), (" \n\t", None), (None, None),
    ],
)
def test_shapes(text, shape):
    assert Q.measure(text, COMMON)[-1] == shape


@pytest.mark.parametrize("period", [1, 2, 7, 8, 9, 10, 23, 60, 150])
def test_the_same_words_over_and_over(period):
    r = random.Random(period)
    words = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(period)]
    assert Q.repeated(words * 12) > 0.6
    text = " ".join(["the", *words][:period]) + " "
    assert Q.measure(text * 30, COMMON)[-1] == "junk"


def test_different_sentences_are_not_the_same_words():
    r = random.Random(1)
    words = [r.choice("the of and a pump fan cover is has been set to run in".split()) for _ in range(3000)]
    assert Q.repeated(words) < 0.3


def test_long_sentences_are_prose():
    r = random.Random(2)
    for n in (12, 200, 2000):
        words = [r.choice("the of and in to be".split()) if i % 3 else "".join(r.choice("aeioumnrst") for _ in range(6)) for i in range(n)]
        assert Q.measure(" ".join(words) + ".", COMMON)[-1] == "prose"


def test_autocorrelation():
    assert Q.autocorrelation([50] * 20) == pytest.approx(1)
    assert Q.autocorrelation([5, 60] * 10) < 0.2
    assert Q.autocorrelation([0, 2, 4] * 8, 3, True) > 0.9 and Q.periodic([0, 2, 4] * 8) and not Q.periodic([0] * 9)
    assert Q.autocorrelation([]) == 0 and not Q.periodic([])


def test_statistics():
    n, mean, symbols, ended, common, _ = Q.measure("The cat is in.\nNo end", COMMON)
    assert (n, ended) == (6, 0.5)
    assert mean == pytest.approx(15 / 6)
    assert symbols == pytest.approx(1 / 16)
    assert common == pytest.approx(3 / 6)
    assert Q.measure(None, COMMON) == (0, 0.0, 0.0, 0.0, 0.0, None)


def test_long_texts_take_linear_time():
    for text in ("x" * 300_000, "a b " * 80_000, ". " * 100_000, "\n" * 200_000, "a\t" * 90_000, "|" * 100_000, "a, b\n" * 40_000):
        Q.measure(text, COMMON)


def test_rows(spark):
    docs = spark.createDataFrame([(1, PROSE, "c"), (2, None, "c"), (1, PROSE, "c")], "doc_id long, text string, shape string")
    words = spark.createDataFrame([("en", "the"), ("en", None), (None, "x"), ("en", "be"), ("en", "to")], "lang string, word string")
    assert sorted((r.doc_id, r.shape) for r in Q.text_quality(docs, words).collect() if r.shape) == [(1, "prose"), (1, "prose")]
    assert Q.text_quality(docs.limit(0), words).count() == 0
    assert Q.text_quality(docs, words.limit(0)).count() == 3
