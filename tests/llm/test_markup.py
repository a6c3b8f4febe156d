import random
import re

import pytest

from strataframe.llm import markup as M

PLAIN = [
    "A force < 30 N and > 5 N is normal.", "Press <Fn> and <Esc> within 2 s.", r"The file C:\rig\cfg_v2.ini holds limit_low and limit_high.", "One lane costs $45, a second lane costs $60 more.", "Ticket #2041 asks for ~5 % more travel at 2^3 steps.",
    "See [3.2] and [7] for it. The switch reads on|off|auto.", "The setting {low, mid, high} is printed. R&D signs, Q&A follows.", "The fixture uses a #4-40 screw, and A * B * 2 gives the area.", "- one\n- two\n\n1. x\n2. y", "σ = F / A", "", " \n ",
]


@pytest.mark.parametrize("text", PLAIN)
def test_plain_writing_is_no_markup(text):
    assert M.clean(text) == (text, [])


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("a <strong>b</strong> c", ["html"]), ("a<br/> b", ["html"]), ("2.8&nbsp; kPa", ["html"]), ("x <!-- p --> y", ["html"]), ("a <font\nsize=2>b</font>", ["html"]), ("x &amp;lt; y", ["html"]),
        ("a **b c** d", ["markdown"]), ("a [b](#sec-1) c", ["markdown"]), ("a [b][ref2] c", ["markdown"]), ("## head\n\ntext", ["markdown"]), ("head\n-----\n\ntext", ["markdown"]), ("a ~~b~~ c", ["markdown"]), ("a `b` c", ["markdown"]), ("```\nx = 1\n```", ["markdown"]), ("|a|b|\n|---|:---|\n|c|d|", ["markdown"]), ("![](img_4.png)", ["markdown"]),
        ("== head ==\ntext", ["wiki"]), ("a [[b|c]] d", ["wiki"]), ("a {{note|b}} c", ["wiki"]), ("a '''b''' c", ["wiki"]), ("{| class=\"x\"\n|-\n| a || b\n|}", ["wiki"]), ("h2. head", ["wiki"]), ("a [b|DOC:x] c", ["wiki"]), ("a {color:red}b{color}", ["wiki"]), ("== h ==\n\n# one\n# two", ["wiki"]),
        (r"a \textbf{b} c", ["latex"]), (r"5\, mm", ["latex"]), (r"x $x \leq 3$ y", ["latex"]), ("\\begin{itemize}\n\\item a\n\\end{itemize}", ["latex"]), (r"\[ P = U \times I \]", ["latex"]), (r"a~\cite{b}", ["latex"]),
        ("<h2>a</h2>\n\n## b\n\nc", ["html", "markdown"]),
    ],
)
def test_constructs(text, found):
    assert M.clean(text)[1] == found


def test_structure_is_kept():
    t, _ = M.clean("<h2>Head</h2><p>One <b>two</b>.</p><ul><li>a<li>b</ul><pre><code>if (a &lt; b)\n  c</code></pre><p class='eq'>T<sup>2</sup> = 4&pi;</p><table><tr><td>x</td><td>1</td></tr><tr><td>y</td><td>2</td></tr></table>")
    for part in ("## Head", "One two.", "- a", "- b", "if (a < b)\n  c", "T2 = 4π", "x\t1\ny\t2"):
        assert part in t
    t, _ = M.clean("\\section{Head}\n\n\\begin{enumerate}\n\\item a\n\\item b\n\\end{enumerate}\n\n\\begin{tabular}{ll}\nx & 1 \\\\\ny & 2 \\\\\n\\end{tabular}\n\n\\begin{verbatim}\n# x **y**\n\\end{verbatim}\n\n$$\\sigma = \\frac{F}{A}$$")
    for part in ("# Head", "- a\n- b", "x\t1\ny\t2", "# x **y**", "σ = (F)/(A)"):
        assert part in t
    t, _ = M.clean("== Head ==\nOne '''two'''.\n* a\n** b\n{| class=\"w\"\n|-\n| x || 1\n|-\n| y || 2\n|}")
    for part in ("# Head", "One two.", "- a\n  - b", "x\t1\ny\t2"):
        assert part in t


def test_long_and_hostile_texts():
    for text in ("<" * 50_000, "[" * 20_000, "*" * 50_000 + "a", "{{" * 20_000, "$" * 30_001, "\\" * 30_000, "`" * 20_000, "|" * 50_000, "x " * 100_000 + "<b>y</b>"):
        M.clean(text)


def test_rows(spark):
    df = spark.createDataFrame([("d", "a", "x <b>y</b>", "c"), ("d", "b", None, "c"), ("d", "c", "", "c")], "doc_id string, anchor string, body string, markup string")
    got = {r.anchor: (r.text, r.markup) for r in M.clean_markup(df).collect()}
    assert got == {"a": ("x y", ["html"]), "b": (None, []), "c": ("", [])}
    assert M.clean_markup(df.limit(0)).count() == 0


def test_a_construct_does_not_depend_on_its_length():
    for n in (3, 11, 200, 2000):
        text = "Use `x` here.\n\n" + "\n".join(f"| part {i} | {i} mm |" for i in range(n))
        assert M.clean(text)[0] == "Use x here.\n\n" + "\n".join(f"part {i}\t{i} mm" for i in range(n))


def test_running_text_is_not_ambiguous():
    text = "Use **x** here.\n\n# 5 of the parts that were in the box are not there, and the one that is left\nis to be sent to the supplier with a note of what was found in the test."
    assert "# 5 of the parts" in M.clean(text)[0]


def test_letter_case_and_tabs():
    code = "keep [[x]] = **b**"
    assert M.clean(f"<pre>{code}</pre>") == M.clean(f"<PRE>{code}</PRE>") == (code, ["html"])
    assert M.clean("h1.\thead")[1] == ["wiki"]


def test_gates_lose_nothing():
    """What a pattern finds holds what its gate asks for."""
    r = random.Random(4)
    pool = ["<b>", "<!--", "&amp;", "[a](b)", "[a]: b", "**a**", "__a__", "~~a~~", "|---|---|", "|a|b|", "head", "-----", "====", "`a`", "> a", "# a", "- [x] a", "== a ==", "[[a]]", "{{a}}", "{|", "|}", "''a''", "'''a'''", "__TOC__", "h1. a", "h2.\ta", "bq. a", "[a|b]", "{code}", "||a||b||", "\\begin{a}", "\\textbf{a}", "\\item", "\\(a\\)", "$$a$$", "$a_b$", "5\\, m", "\\_a", " ", "\n", "\n\n", "\t", "a", "3"]
    for _ in range(3000):
        text = "".join(r.choice(pool) for _ in range(r.randint(1, 12)))
        for notation, need, pattern in M._GATED:
            assert need in text or not pattern.search(text), (notation, need, text)
        assert M._ANY.search(text) or not any(p.search(text) for _, _, p in M._GATED)
        for table in (M._CODE, M._FORMULA):
            assert all(any(x in text for x in M._HELD[n]) for n, p, _ in table if p.search(text))


def test_boilerplate_is_decided_by_density_and_neighbours():
    links = " ".join(f"[[Part{i}|Part{i}]]" for i in range(8))
    prose = "The '''fan''' is in the rear of the unit and has to be cleaned when the air is not moving."
    assert M.clean(f"{prose}\n\n{links}\n\nMore parts\n\n{links}") == (prose.replace("'''", ""), ["wiki"])  # short, between links only
    assert M.clean(f"{prose}\n\nMore parts\n\n{links}")[0].endswith("More parts")  # running text is beside it
    assert "Part3" in M.clean(f"{prose} See " + links + " for what is in the box and what is not in it, as it was sent with the unit to the lab in the end of the test.")[0]


TRUTH = [
    ("html", "<h2>Fan</h2>\n<p>The fan &amp; the pump run <i>all day</i>.</p>\n<ul><li>fan</li><li>pump</li></ul>", "## Fan\n\nThe fan & the pump run all day.\n\n- fan\n- pump"),
    ("markdown", "## Fan\n\nThe fan and the [pump](p.md) run **all day**.\n\n| a | b |\n|---|---|\n| 1 | 2 |", "## Fan\n\nThe fan and the pump run all day.\n\na\tb\n1\t2"),
    ("wiki", "== Fan ==\n\nThe fan and the [[p|pump]] run '''all day'''.\n\n* fan\n** rotor", "# Fan\n\nThe fan and the pump run all day.\n\n- fan\n  - rotor"),
    ("latex", "\\section{Fan}\n\nThe fan and the \\textbf{pump} run at $p \\leq 3$ bar.\n\n\\begin{verbatim}\nx = {1}\n\\end{verbatim}", "# Fan\n\nThe fan and the pump run at p ≤ 3 bar.\n\nx = {1}"),
]


@pytest.mark.parametrize(("notation", "text", "want"), TRUTH)
def test_clean_text(notation, text, want):
    got, found = M.clean(text)
    assert found == [notation] and re.sub(r"\n+", "\n", got) == re.sub(r"\n+", "\n", want)
