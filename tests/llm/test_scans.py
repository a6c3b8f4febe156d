import random

import pytest

from strataframe.llm import scans as S

WORDS = "the supplier changes surface battery charging thermal module when every reading stays within limits during longer tests and measured values".split()
DOC = "M1000034 Thermal PRD"


def lines(seed=1, n=40, width=55):
    random.seed(seed)
    out, now = [], ""
    for _ in range(n * 8):
        w = random.choice(WORDS)
        if len(now) + len(w) > width:
            out.append(now)
            now = ""
        now = f"{now} {w}".strip()
    return out[:n]


@pytest.mark.parametrize("style", ["- {} -", "— {} —", "~ {} ~", "[{}]", "{}", "{}.", "PAGE {}", "Page {} of 99", "p. {}", "{} / 99"])
def test_page_numbers(style):
    x = lines()
    for k, at in enumerate((8, 17, 27), 41):
        x.insert(at, style.format(k))
    kept, kinds = S.layout("\n".join(x), DOC)
    assert kinds == {"page_no"} and not any("4" in y for y in kept)


@pytest.mark.parametrize("head", [["M1000034 Rev E   Thermal"] * 3, ["CONFIDENTIAL  M1000034"] * 3, ["THERMAL SPEC"] * 3, ["M1000034 | Thermal", "M1000034 | Therma|", "M1000034 | Thcrmal"], ["Thermal"] * 3])
def test_heading_lines(head):
    x = lines()
    for h, at in zip(head, (0, 12, 25)):
        x.insert(at, h)
    kept, kinds = S.layout("\n".join(x), DOC)
    assert kinds == ({"header"} if len(set(head)) == 1 else {"header", "glyph"}) and kept == lines()


def test_plain_layouts_stay():
    for text in ("\n".join(lines()), "12\t13\n14\t15", "1\n2\n3\n4", "- a\n- b\n- a\n- b", "", "one line only"):
        assert S.layout(text, DOC)[1] == set()


@pytest.mark.parametrize("mark", list("-‐¬\xad"))
def test_broken_words(mark):
    x = ["the supplier chan" + mark, "ges the surface"]
    assert S.joined(x) == ("the supplier changes the surface", True)
    assert S.joined(["a double-", "sided tape"], {"double-sided"}) == ("a double-sided tape", False)


def test_distance():
    assert S.distance("cuand0", "cuando") == S.CONFUSED
    assert S.distance("sliutter", "shutter") == S.CONFUSED
    assert S.distance("rnodiile", "module") == 2 * S.CONFUSED
    assert S.distance("cat", "dog") == float("inf")
    assert S.distance("same", "same") == 0


def whole_table(read, printed):
    """The weighted edit distance over the whole table of places."""
    n, m, rows = len(read), len(printed), {(0, 0): 0.0}
    for i in range(n + 1):
        for j in range(m + 1):
            d = rows.get((i, j), 9.0)
            steps = [(i + 1, j + 1, d + (read[i : i + 1] != printed[j : j + 1])), (i + 1, j, d + 1), (i, j + 1, d + 1)]
            steps += [(i + k, j + len(to), d + S.CONFUSED) for k in (1, 2) if i + k <= n for to in S.PAIRS.get(read[i : i + k], ()) if printed.startswith(to, j)]
            for x, y, c in steps:
                if x <= n and y <= m:
                    rows[x, y] = min(rows.get((x, y), 9.0), c)
    return rows[n, m]


def misread(word, r, n):
    """A word with up to n places read as a confused pair gives them."""
    at = len(word)
    while n and at > 0:
        at -= 1
        if ways := [p for p, to in S.PAIRS.items() if word[at] in to and p != word[at]]:
            if r.random() < 0.6:
                word, n = word[:at] + r.choice(ways) + word[at + 1 :], n - 1
    return word


def test_distance_equals_the_whole_table():
    r = random.Random(5)
    for _ in range(3000):
        a, b = ("".join(r.choice("rnmicl1e") for _ in range(r.randint(0, 6))) for _ in "ab")
        want = whole_table(a, b)
        assert S.distance(a, b) == (want if want <= S.MAX_COST else float("inf"))
        assert S.distance(a, b, 3.0) == (want if want <= 3 else float("inf"))


@pytest.mark.parametrize("length", [2, 4, 9, 20, 21, 22, 24, 26, 27, 28, 60, 3000])
def test_misread_words_of_any_length_meet(length):
    r = random.Random(length)
    for _ in range(60):
        word = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(length))
        read = misread(word, r, 3)
        if read.count("nn") + read.count("ln") <= 3 or length > 24:
            assert S.forms(word) & S.forms(read)
        assert S.distance(read, word) <= S.MAX_COST


def test_running_lines_have_four_words():
    r = random.Random(9)
    for _ in range(5000):
        x = "".join(r.choice("abé 1_-漢字。") for _ in range(r.randint(0, 30)))
        assert S._running(x) == (S._words(x) >= 4)


def test_long_words_are_words():
    long = "donaudampfschifffahrtsgesel1schaft"
    assert S.words_of(f"eine {long} und 12345 b") == ["eine", long, "und"]


def test_signs_of_chinese_and_japanese():
    t = "異音は聞こえなかった.供給者が変更したときは測定する,"
    assert S.marks_repaired(t) == "異音は聞こえなかった。供給者が変更したときは測定する、"
    assert S.marks_repaired("背面カバーは正しい.") == "背面カバーは正しい。"
    for t in ("合上盖子之后，键盘框架进入休眠状态，耗电应低于1.55 g。共有286个样品参加了试验。", "see the drawing in 図. Then go on.", "plain, text.", ""):
        assert S.marks_repaired(t) == t


GOOD = ["背面カバーは正しく動き、異音は聞こえなかった。", "カメラとモーターは電源に近い位置にある。", "圧力が一定の場合は動力を測る。", "一つの部品は二つの穴を持つ。"]


@pytest.mark.parametrize("most", [S.MOST_SENT, 0])
def test_misread_characters(spark, most):
    """A character is repaired where its neighbours stand with another, in a body of any length."""
    bad = ["背面カバ一は正しい。", "力メラは動く。", "背面カバーば正しい。"]
    rows = [("d", f"g{i}", "".join(GOOD)) for i in range(30)] + [("d", f"b{i}", x) for i, x in enumerate(bad)]
    got = {r.anchor: r for r in S.repair_scans(spark.createDataFrame(rows, "doc_id string, anchor string, body string"), most).collect()}
    assert [got[f"b{i}"].text for i in range(3)] == ["背面カバーは正しい。", "カメラは動く。", "背面カバーは正しい。"]
    assert all(got[f"b{i}"].noise == ["glyph"] for i in range(3)) and not any(got[f"g{i}"].noise for i in range(30))


def test_true_words_stay_where_they_are_known(spark):
    """A rare word that looks like a reading of a frequent one stays after the words that it stands with."""
    texts = ["the modem was tested again"] * 400 + ["a modern house stands there"] * 20 + ["the modern was tested again"]
    counted = S.frequencies(spark.createDataFrame([("d", x) for x in texts], "doc_id string, body string"))
    got = {(r.before, r.word): r.repair for r in S.decisions(counted).collect()}
    assert got == {("the", "modern"): "modem"}


def test_both_ways_are_the_same(spark):
    """A book sent to the tasks and a join over the bodies, on planted misreadings of all kinds."""
    r = random.Random(8)
    rows = [("D x", f"a{i}", "\n".join(lines(i, 30))) for i in range(60)]
    for i in range(60):
        words = "\n".join(lines(100 + i, 12)).split(" ")
        for at in r.sample(range(len(words)), 4):
            words[at] = misread(words[at], r, 1) if "\n" not in words[at] else words[at]
        rows.append(("D x" if i % 2 else None, f"b{i}", " ".join(words) + GOOD[i % 4].replace("ー", "一")))
    rows += [("D x", f"c{i}", "".join(GOOD)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id string, anchor string, body string")
    a, b = (sorted(map(tuple, S.repair_scans(df, most).collect()), key=str) for most in (S.MOST_SENT, 0))
    assert a == b and sum(bool(x[3]) for x in a) >= 50


def test_repairs(spark):
    rows = [("D x", f"a{i}", "\n".join(lines(i, 30))) for i in range(20)]
    bad = lines(99, 30)
    bad[3] = bad[3].replace("the", "thc", 1) if "the" in bad[3] else bad[3] + " thc"
    bad[9] += " suppl1er"
    rows += [("D x", "bad", "\n".join(bad)), ("D x", "null", None), ("D x", "blank", "  "), ("D x", "double", rows[0][2])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id string, anchor string, body string, word string")
    for most in (S.MOST_SENT, 0):
        got = {r.anchor: r for r in S.repair_scans(df, most).collect()}
        assert len(got) == len(rows)
        assert got["bad"].noise == ["glyph"] and "thc" not in got["bad"].text and "supplier" in got["bad"].text and "suppl1er" not in got["bad"].text
        assert all(not r.noise for a, r in got.items() if a != "bad")
        assert got["null"].text is None and got["a1"].text == rows[1][2]
    assert S.repair_scans(df.limit(0)).count() == 0
