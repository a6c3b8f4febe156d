"""Mark-up residue of four notations, turned into clean text.

A text is cut into blocks, which two passes decide. The first pass finds which notation's constructs a
block holds that can be no other's, and sorts blocks by length, density of stop words and density of
links: running text, structure (headings, lists, tables, code, formulas), boilerplate (mostly links,
hardly a stop word), or short. Short blocks are ambiguous twice over. Constructs in them that several notations
share (a line of ``#``, rows between bars, doubled stars before an entry) may belong to any of these,
while in running text they are plain writing; and a few words without stop words may be content or
boilerplate. The second pass gives an ambiguous block the notation of the nearest decided block that
can have its constructs, and content or boilerplate as its nearest decided neighbours are.

The clean text keeps headings, list entries, code, formulas and table cells; boilerplate and constructs
without text are left out.
"""

from __future__ import annotations

import html
import re
from bisect import bisect
from collections.abc import Iterator

from pyspark.sql import DataFrame

from strataframe.llm.texts import is_cjk, rows

NOTATIONS = ("html", "markdown", "wiki", "latex")

# Element names of HTML.
_TAGS = "a|abbr|article|aside|b|big|blockquote|body|br|button|caption|center|cite|code|col|colgroup|dd|del|details|div|dl|dt|em|figcaption|figure|font|footer|form|h[1-6]|head|header|hr|html|i|iframe|img|input|ins|kbd|label|li|link|main|mark|meta|nav|ol|option|p|pre|q|s|samp|script|section|select|small|span|strike|strong|style|sub|summary|sup|svg|table|tbody|td|textarea|tfoot|th|thead|title|tr|tt|u|ul|var|video"
_COMMANDS = "item|itshape|bfseries|ttfamily|scshape|em|bf|it|tt|sc|alpha|beta|gamma|delta|Delta|epsilon|theta|lambda|mu|pi|rho|sigma|Sigma|tau|phi|omega|Omega|leq|geq|neq|le|ge|ne|approx|times|cdot|pm|frac|sqrt|sum|int|infty|partial|to|rightarrow|left|right|quad|qquad|hline|toprule|midrule|bottomrule|centering|maketitle|tableofcontents|newline|newpage|noindent|par|ldots|dots|degree|celsius|milli|micro|metre|ohm|textdegree"
_PATH = re.compile(r"(?<![A-Za-z])[A-Za-z]:\\[^\s\"'<>|]*|\\\\[A-Za-z0-9._$-]+\\[^\s\"'<>|]*")

_TAG = re.compile(rf"</?(?:{_TAGS})(?=[\s/><&])(?:[^<>\"']|\"[^\"]*\"|'[^']*')*>", re.I)
_STRONG = {
    "html": [_TAG, re.compile(r"<!--|<!DOCTYPE\b"), re.compile(r"&(?:[a-zA-Z]{2,8}\d{0,2}|#\d{1,6}|#[xX][0-9a-fA-F]{1,5});")],
    "markdown": [
        re.compile(r"(?<![\\!])!?\[[^\[\]\n]*\](?:\([^()\s]*(?:\s+\"[^\"\n]*\")?\)|\[[\w .-]+\])"),
        re.compile(r"^\s{0,3}\[[\w .-]+\]:\s+\S", re.M),
        re.compile(r"(?<![\w*\\])\*\*(?=[^\s*])[^*\n]*(?:\n(?!\s*\n)[^*\n]*)?(?<=[^\s*])\*\*(?!\*)|(?<![\w*\\])\*\*\*(?=[^\s*])[^*\n]+\*\*\*"),
        re.compile(r"(?<![\w_])__(?=[^\s_])(?![A-Z]+__)[^_\n]+__(?![\w_])"),
        re.compile(r"~~(?=[^\s~])[^~\n]*(?:\n(?!\s*\n)[^~\n]*)?~~"),
        re.compile(r"^\s{0,3}\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)+\|?\s*$", re.M),
        re.compile(r"(?:\A|\n)[^\n|=#-][^\n]*\n(?:-{4,}|={4,})[ \t]*(?=\n|\Z)"),
        re.compile(r"(?<![`\w])`(?=[^\s`])[^`\n]+`(?![`\w])"),
        re.compile(r"^> \S", re.M),
        re.compile(r"(?:\A|\n[ \t]*\n)#{1,6}[ \t]+[^\s#][^\n]*(?=\n[ \t]*\n|\n?\Z)"),
        re.compile(r"- \[[ xX]\] \S"),
    ],
    "wiki": [
        re.compile(r"^(={2,6})[ \t]*[^=\n]+?[ \t]*\1[ \t]*$", re.M),
        re.compile(r"\[\[[^\[\]\n]*(?:\n(?!\s*\n)[^\[\]\n]*)?\]\]"),
        re.compile(r"\{\{[^{}\n]*(?:\n(?!\s*\n)[^{}\n]*)?\}\}"),
        re.compile(r"^\{\|[^\n]*$|^\|\}[ \t]*$", re.M),
        re.compile(r"(?<!')(?:''''?'?)(?=[^\s'])[^\n]*?[^\s'](?:''''?'?)(?!')"),
        re.compile(r"__(?:NOTOC|TOC|FORCETOC|NOEDITSECTION|NOINDEX|INDEX|NEWSECTIONLINK)__"),
        re.compile(r"^h[1-6]\.\s+\S|^bq\.\s+\S", re.M),
        re.compile(r"(?<!\[)\[[^\[\]|\n]+\|[^\[\]|\n]+\](?!\])"),
        re.compile(r"\{(?:color|code|noformat|quote|panel|info|note|warning|tip|toc|anchor|expand)(?::[^{}\n]*)?\}"),
        re.compile(r"^\|\|(?:[^|\n]+\|\|)+[ \t]*$", re.M),
    ],
    "latex": [
        re.compile(r"\\(?:begin|end)\s*\{[A-Za-z]+\*?\}"),
        re.compile(r"(?<!\\)\\[A-Za-z]{2,}\*?(?:\[[^\]\n]*\])?\{"),
        re.compile(rf"(?<!\\)\\(?:{_COMMANDS})(?![A-Za-z])"),
        re.compile(r"\\\([^\n]*?\\\)|\\\[(?:[^\n]|\n(?!\s*\n))*?\\\]"),
        re.compile(r"\$\$(?=[^$])[^$]+\$\$"),
        re.compile(r"(?<![\w$\\])\$(?=[^\s$\d])[^$\n]*?(?:\\[A-Za-z]+|[\^_{])[^$\n]*?(?<=[^\s$])\$(?![\w$])"),
        re.compile(r"(?<![\\\w])\\[#%&_$](?=\w)|(?<=\w)\\[%&_,;](?!\w*\\)|(?<=\d)\\[,;]"),
    ],
}
#: What a text must hold for a pattern to match at all, by notation and in the order of the patterns.
_NEEDS = {
    "html": ["<", "<!", "&"],
    "markdown": ["]", "]:", "**", "__", "~~", "---", "\n", "`", "> ", "#", "- ["],
    "wiki": ["==", "[[", "{{", "|", "''", "__", ".", "|", "{", "||"],
    "latex": ["\\", "\\", "\\", "\\", "$$", "$", "\\"],
}
_GATED = [(n, need, p) for n in _STRONG for need, p in zip(_NEEDS[n], _STRONG[n], strict=True)]


#: Constructs of short blocks that several notations share, and to which they may go.
_WEAK = [
    (re.compile(r"^#{1,6}[ \t]+\S", re.M), ("markdown", "wiki")),
    (re.compile(r"^\*{2,5}[ \t]+\S", re.M), ("wiki", "markdown")),
    (re.compile(r"^\|[^|\n]+\|(?:[^|\n]*\|)+[ \t]*$", re.M), ("markdown", "wiki")),
    (re.compile(r"^[;:][ \t]+\S", re.M), ("wiki",)),
]
RUNNING = 0.12  # share of stop words from which a block of many words is running text
FEW_WORDS = 6

_CODE = [
    ("markdown", re.compile(r"(?:\A|(?<=\n))[ \t]{0,3}(```+|~~~+)[^\n`]*\n(.*?)(?:\n[ \t]{0,3}\1[`~]*[ \t]*(?=\n|\Z)|\Z)", re.S), 2),
    ("html", re.compile(r"<pre\b[^>]*>(.*?)</pre\s*>", re.S | re.I), 1),
    ("latex", re.compile(r"\\begin\{(verbatim|lstlisting|minted)\*?\}(.*?)\\end\{\1\*?\}", re.S), 2),
    ("wiki", re.compile(r"\{\{code\|(.*?)(?:\n\}\}|\}\}(?!\}))", re.S), 1),
    ("wiki", re.compile(r"\{(noformat|code)(?::[^{}\n]*)?\}(.*?)\{\1\}", re.S), 2),
    ("wiki", re.compile(r"<(?:syntaxhighlight|nowiki)\b[^>]*>(.*?)</(?:syntaxhighlight|nowiki)>", re.S | re.I), 1),
]
_FORMULA = [
    ("latex", re.compile(r"\\begin\{(equation|align|gather|displaymath|math)\*?\}(.*?)\\end\{\1\*?\}", re.S), 2),
    ("latex", re.compile(r"\\\[(.*?)\\\]", re.S), 1),
    ("latex", re.compile(r"\$\$(.*?)\$\$", re.S), 1),
    ("wiki", re.compile(r"\{\{math\|([^{}]*)\}\}"), 1),
    ("wiki", re.compile(r"<math\b[^>]*>(.*?)</math>", re.S | re.I), 1),
    ("html", re.compile(r"<p\b[^>]*class=['\"]?eq['\"]?[^>]*>(.*?)</p\s*>", re.S | re.I), 1),
]
_HELD = {"markdown": ("```", "~~~"), "html": ("<",), "wiki": ("{", "<"), "latex": ("\\", "$$")}
_ANY = re.compile(r"[<&#*_`~\[{=\\$|>]|''|^h[1-6]\.|^bq\.|^-{4}|^[;:] ", re.M)
_BLOCK_TAG = re.compile(r"</?(?:p|div|h[1-6]|ul|ol|li|table|tr|pre|hr|blockquote|dl|dt|dd|section|article|header|footer|nav|body|html|head|title|form|tbody|thead|caption)\b[^<>]*>", re.I)

# Short words that mark running text.
STOP = frozenset("the of and to in is that for it as was with be by on not are this at from or an which has have but after no when will there der die das und nicht von mit ist auf dem den des eine ein wird zu le la les des du et est une dans que pour pas el los las y del que una por con se no o os da do em um uma para com het de een van en niet op wordt voor".split())


def _density(text: str) -> tuple[int, float]:
    """Number of words, and the share of stop words; for scripts without spaces, by characters."""
    if is_cjk(text):
        n = max(1, len(text) // 2)
        return n, sum(text.count(c) for c in "的了在是和与不后。はがをにのでとも、，") / n
    words = re.findall(r"[^\W\d_]+", text.lower())
    return len(words), sum(w in STOP for w in words) / max(1, len(words))


class Block:
    """A block: its raw text, the notations that hold it, its clean text and its class."""

    __slots__ = ("kind", "raw", "text", "strong")

    def __init__(self, raw: str, kind: str = "", strong: set[str] | None = None, text: str | None = None) -> None:
        self.raw, self.kind, self.text = raw, kind, text
        self.strong: set[str] = strong or set()


def _cut(text: str) -> list[Block]:
    """Code and formulas in their own notation first, as nothing inside them is mark-up; then
    blocks between blank lines or block elements."""
    kept: list[Block] = []

    def keep(kind: str, notation: str, group: int):
        def of(m: re.Match[str]) -> str:
            kept.append(Block(m[0], kind, {notation}, m[group].strip("\n")))
            return f"\n\n\x00{len(kept) - 1}\x00\n\n"

        return of

    for kind, table in (("code", _CODE), ("formula", _FORMULA)):
        for notation, pattern, group in table:
            if any(map(text.__contains__, _HELD[notation])):
                text = pattern.sub(keep(kind, notation, group), text)
    out: list[Block] = []
    for piece in re.split(r"\n[ \t]*(?:\n[ \t]*)+", text):
        if m := re.fullmatch(r"\s*\x00(\d+)\x00\s*", piece):
            out.append(kept[int(m[1])])
        elif piece.strip():
            out.append(Block(piece))
    return out


def _weak(raw: str) -> tuple[str, ...]:
    owners: list[str] = []
    for pattern, to in _WEAK:
        if pattern.search(raw):
            owners += to
    return tuple(dict.fromkeys(owners))


def blocks(text: str) -> list[Block]:
    """The blocks of a text with notations and classes decided in two passes."""
    text = text.replace("\r\n", "\n").replace("\r", "\n")
    out = _cut(text)
    gated = [x for x in _GATED if x[1] in text]
    for b in out:  # first pass: rules
        if b.kind:
            continue
        bare = _PATH.sub(" ", b.raw) if "\\" in b.raw else b.raw
        # the empty line that ended the block counts as one, so that headings stand alone
        for notation, need, p in gated:
            if notation not in b.strong and need in bare and p.search(bare):
                b.strong.add(notation)
        if "wiki" in b.strong and "latex" in b.strong and not any(p.search(re.sub(r"\{\{.*?\}\}", "", bare, flags=re.S)) for p in _STRONG["latex"]):
            b.strong.discard("latex")
        if "wiki" in b.strong and "latex" in b.strong and re.search(r"\\\w+\*?\{", bare):
            rest = re.sub(r"\\[A-Za-z]+\*?(?:\[[^\]\n]*\])?(?:\{[^{}]*\})*|\{\{?[^{}]*\}?\}", "", bare)
            if not any(p.search(rest) for p in _STRONG["wiki"]):
                b.strong.discard("wiki")
    decided = [i for i, b in enumerate(out) if b.strong]
    if not decided:  # a plain text needs no cleaning
        return out
    for i, b in enumerate(out):  # second pass: undecided blocks inherit from the nearest decided
        if not b.strong and not b.kind and (weak := _weak(_PATH.sub(" ", b.raw) if "\\" in b.raw else b.raw)) and not _running(b.raw):
            b.strong = _inherited(out, decided, i, weak)
    for b in out:
        if not b.kind:
            b.text = _clean(b)
            b.kind = _kind(b)
    sure = [i for i, b in enumerate(out) if b.kind not in ("short", "empty")]
    for i, b in enumerate(out):
        if b.kind == "short":  # boilerplate if there is nothing else beside it
            at = bisect(sure, i)
            near = [out[j].kind for j in (*sure[max(0, at - 1) : at], *sure[at : at + 1])]
            b.kind = BOILERPLATE if near and all(k == BOILERPLATE for k in near) else "prose"
    return out


def _inherited(out: list[Block], decided: list[int], i: int, weak: tuple[str, ...]) -> set[str]:
    """The notation of the nearest decided block that can have these constructs."""
    before, after = bisect(decided, i) - 1, bisect(decided, i)
    while before >= 0 or after < len(decided):
        left = i - decided[before] if before >= 0 else len(out)
        right = decided[after] - i if after < len(decided) else len(out)
        j, before, after = (decided[before], before - 1, after) if left <= right else (decided[after], before, after + 1)
        if of := [n for n in weak if n in out[j].strong]:
            return {of[0]}
    return set()


BOILERPLATE = "navigation"


def _running(raw: str) -> bool:
    """Whether a block is running text: many words, many of them stop words, most lines without a
    construct at their begin. Other blocks are ambiguous, however long they are."""
    lines = raw.split("\n")
    if sum(bool(_LINE.match(x)) for x in lines) * 2 >= len(lines):
        return False
    n, density = _density(raw)
    return n >= FEW_WORDS and density >= RUNNING


_LINE = re.compile(r"#{1,6}[ \t]+\S|\*{1,5}[ \t]+\S|\|.*\|[ \t]*$|[;:][ \t]+\S")


def _kind(b: Block) -> str:
    """The class of a block by its structure, its length, and its densities of stop words and links."""
    raw, text = b.raw, (b.text or "").strip()
    if not text:
        return "empty"
    if re.match(r"\s*(?:#{1,6}[ \t]|={2,6}[^=]|h[1-6]\.\s|\\(?:sub)*section|\\(?:sub)?paragraph|\\chapter|<h[1-6])", raw) and "\n" not in text:
        return "heading"
    links = len(re.findall(r"\]\(|\[\[|<a\b|\\href", raw))
    n, density = _density(text)
    if links >= 3 and links * 4 > n and density < 0.1:
        return BOILERPLATE
    lines = [x for x in text.split("\n") if x.strip()]
    if sum("\t" in x for x in lines) * 2 > len(lines):
        return "table"
    if sum(bool(re.match(r"\s*(?:[-*+•·]|\d{1,3}[.)])\s", x)) for x in lines) * 2 > len(lines):
        return "list"
    if n < FEW_WORDS and density < 0.2:
        return "short"
    return "prose"


_MATH = {"sigma": "σ", "Delta": "Δ", "delta": "δ", "pi": "π", "leq": "≤", "geq": "≥", "le": "≤", "ge": "≥", "times": "×", "cdot": "·", "pm": "±", "approx": "≈", "mu": "µ", "alpha": "α", "beta": "β", "lambda": "λ", "Omega": "Ω", "omega": "ω", "neq": "≠", "infty": "∞", "degree": "°", "ldots": "…", "dots": "…", "milli": "m", "micro": "µ", "metre": "m"}

_SPACED = set("≤≥×·±≈≠")  # signs that keep the space behind them


def _clean_html(t: str) -> str:
    t = re.sub(r"<!--.*?-->|<!DOCTYPE[^>]*>", "", t, flags=re.S)
    t = re.sub(r"<(script|style)\b[^>]*>.*?</\1\s*>", "", t, flags=re.S | re.I)
    t = re.sub(r"<img\b[^>]*?\balt=\"([^\"]*)\"[^>]*>", r"\1", t, flags=re.I)
    t = re.sub(r"</t[dh]>\s*(?=<t[dh]\b)", "\t", t, flags=re.I)
    t = re.sub(r"</tr>\s*<tr\b[^<>]*>", "\n", t, flags=re.I)
    t = re.sub(r"<br\b[^<>]*>\s?", " ", t, flags=re.I)
    t = re.sub(r"<li\b[^<>]*>", "\n- ", t, flags=re.I)
    t = re.sub(r"<h([1-6])\b[^<>]*>", lambda m: "\n\n" + "#" * int(m[1]) + " ", t, flags=re.I)
    t = re.sub(r"</?(?:p|div|h[1-6]|ul|ol|table|blockquote|section|article|header|footer|nav|dl)\b[^<>]*>", "\n\n", t, flags=re.I)
    t = re.sub(r"</?(?:tr|dt|dd|hr|caption)\b[^<>]*>", "\n", t, flags=re.I)
    t = _TAG.sub("", t)
    for _ in range(2):  # entities may be escaped twice
        t = html.unescape(t)
    return t


def _clean_markdown(t: str) -> str:
    t = re.sub(r"!?\[([^\[\]\n]*)\](?:\([^()\n]*\)|\[[\w .-]+\])", r"\1", t)
    t = re.sub(r"^\s{0,3}\[[\w .-]+\]:\s+\S.*$", "", t, flags=re.M)
    t = re.sub(r"^\s{0,3}\|?\s*:?-{3,}:?\s*(?:\|\s*:?-{3,}:?\s*)+\|?[ \t]*\n?", "", t, flags=re.M)
    t = re.sub(r"^[ \t]*\|(.*)\|[ \t]*$", lambda m: "\t".join(x.strip() for x in m[1].split("|")), t, flags=re.M)
    t = re.sub(r"^(?=\S)([^\n]+)\n(=|-){4,}[ \t]*$", r"# \1", t, flags=re.M)
    t = re.sub(r"(\*\*\*|\*\*|~~)(?=\S)(.+?)\1", r"\2", t, flags=re.S)
    t = re.sub(r"(?<![\w_])__(?=\S)(.+?)__(?![\w_])", r"\1", t)
    t = re.sub(r"(?<!`)`([^`\n]+)`(?!`)", r"\1", t)
    return re.sub(r"^> ?", "", t, flags=re.M)


def _clean_wiki(t: str) -> str:
    t = re.sub(r"^(={2,6})[ \t]*([^=\n]+?)[ \t]*\1[ \t]*$", lambda m: "\n" + "\x02" * (len(m[1]) - 1) + f" {m[2]}\n", t, flags=re.M)
    t = re.sub(r"^h([1-6])\.\s+(.*)$", lambda m: "\n" + "\x02" * int(m[1]) + f" {m[2]}\n", t, flags=re.M)
    t = re.sub(r"__[A-Z]+__\n?", "", t)
    t = re.sub(r"\[\[(?:[^\[\]|]*\|)*([^\[\]|]*)\]\]", r"\1", t)
    t = re.sub(r"(?<!\[)\[([^\[\]|\n]+)\|[^\[\]|\n]+\]", r"\1", t)
    t = re.sub(r"\{\{(?:[^{}|]*\|)*([^{}|]*)\}\}", r"\1", t)
    t = re.sub(r"\{(?:color|code|noformat|quote|panel|info|note|warning|tip|toc|anchor|expand)(?::[^{}\n]*)?\}", "", t)
    t = re.sub(r"^(?:\{\||\|\}|\|-)[^\n]*\n?", "", t, flags=re.M)
    t = re.sub(r"^\|\|(.*?)\|\|[ \t]*$", lambda m: "\t".join(x.strip() for x in m[1].split("||")), t, flags=re.M)
    t = re.sub(r"^[|!][ \t]*(.*\|\|.*)$", lambda m: "\t".join(x.strip() for x in m[1].split("||")), t, flags=re.M)
    t = re.sub(r"^\|([^|\n]+(?:\|[^|\n]*)+)\|[ \t]*$", lambda m: "\t".join(x.strip() for x in m[1].split("|")), t, flags=re.M)
    t = re.sub(r"'{2,5}", "", t)
    t = re.sub(r"^([*#:;]+)[ \t]+", lambda m: "  " * (len(m[1]) - 1) + "- ", t, flags=re.M)
    return t.replace("\x02", "#")  # headings wait for the lists, which share their mark


def _clean_latex(t: str, formula: bool = False) -> str:
    t = re.sub(r"(?<!\\)%[^\n]*", "", t) if "\\begin" in t else t
    t = re.sub(r"\\begin\{tabular\}\{[^{}]*\}|\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]\n]*\])?", "\n", t)
    t = re.sub(r"^[ \t]*(.*?&.*?)\\\\[ \t]*$", lambda m: "\t".join(x.strip() for x in re.split(r"(?<!\\)&", m[1])), t, flags=re.M)
    t = re.sub(r"\\(sub)*(?:section|paragraph|chapter)\*?\{([^{}]*)\}", r"\n# \2\n", t)
    t = re.sub(r"\\item\b[ \t]*", "- ", t)
    t = re.sub(r"~?\\(?:ref|cite|label|eqref|pageref)\{[^{}]*\}", "", t)
    t = re.sub(r"\\footnote\{([^{}]*)\}", r" (\1)", t)
    t = re.sub(r"\\SI\{([^{}]*)\}\{([^{}]*)\}", lambda m: m[1] + " " + re.sub(r"\\([a-z]+)", lambda x: _MATH.get(x[1], x[1]), m[2]), t)
    for _ in range(3):
        t = re.sub(r"\\frac\{([^{}]*)\}\{([^{}]*)\}", r"(\1)/(\2)", t)
        t = re.sub(r"\\sqrt\{([^{}]*)\}", r"√(\1)", t)
        t = re.sub(r"\\(?:text(?:bf|it|tt|sc|rm)?|emph|underline|math(?:rm|bf|it)|mbox|href\{[^{}]*\})\{([^{}]*)\}", r"\1", t)
    t = re.sub(r"\{\\(?:itshape|bfseries|ttfamily|em|bf|it|tt)\s+([^{}]*)\}", r"\1", t)
    t = re.sub(r"\\\(|\\\)|\\\[|\\\]|(?<!\\)\$(?!\d)", "", t)
    t = re.sub(r"\\([A-Za-z]+)\b(\s?)", lambda m: (sign := _MATH.get(m[1], "")) + (" " if formula and sign else m[2] if sign in _SPACED else ""), t)
    t = re.sub(r"\\[,;!: ]", " ", t)
    t = re.sub(r"\\([#%&_$~{}])", r"\1", t)
    t = re.sub(r"\\\\", "\n", t)
    return re.sub(r"[{}]", "", t) if formula else re.sub(r"(?<=\S)~(?=\S)", " ", t)


_CLEAN = {"html": _clean_html, "markdown": _clean_markdown, "wiki": _clean_wiki, "latex": _clean_latex}


def _clean(b: Block) -> str:
    t, paths = b.raw, []

    def hold(m: re.Match[str]) -> str:
        paths.append(m[0])
        return f"\x01{len(paths) - 1}\x01"

    t = _PATH.sub(hold, t)
    for n in ("latex", "wiki", "markdown", "html"):
        if n in b.strong:
            t = _CLEAN[n](t)
    if "latex" in b.strong:
        paths = [re.sub(r"\\([#%&_$])", r"\1", x) for x in paths]
    t = re.sub(r"\x01(\d+)\x01", lambda m: paths[int(m[1])], t)
    return re.sub(r"[ \t]*\n[ \t]*\n\s*", "\n\n", t).strip("\n")


def clean(text: str) -> tuple[str, list[str]]:
    """Clean text and the notations found. A text without mark-up stays as it is."""
    if not _ANY.search(text):
        return text, []
    bs = blocks(text)
    found = [n for n in NOTATIONS if any(n in b.strong for b in bs)]
    if not found:
        return text, []
    out = []
    for b in bs:
        t = b.text or ""
        if b.kind == "formula":
            t = _clean_latex(t, True).strip() if "latex" in b.strong else re.sub(r"\s+", " ", _clean_html(t)).strip()
        elif b.kind == "code":
            t = html.unescape(_TAG.sub("", t)) if "html" in b.strong else t
        elif b.kind == BOILERPLATE:
            continue
        if t.strip():
            out.append(t)
    return "\n\n".join(out), found


CLEANED = "doc_id string, anchor string, text string, markup array<string>"


def _each(doc: str, anchor: str, body: str | None) -> Iterator[tuple]:
    text, found = clean(body) if isinstance(body, str) else (None, [])
    yield doc, anchor, text, found


def clean_markup(sections: DataFrame) -> DataFrame:
    """Clean text and notations of each body; one row per row of ``sections``.

    Null bodies stay null, empty and blank ones stay as they are, both without notations. Other
    columns are left out, so clashing names don't matter.
    """
    return rows(sections, _each, CLEANED, ["doc_id", "anchor", "body"])
