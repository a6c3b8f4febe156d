"""Scalar text functions as columns; all of them stay in generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataframe.tables import squeezed

# Words that carry no meaning in titles.
STOPWORDS = (
    "the", "a", "an", "and", "or", "of", "to", "in", "on", "for", "with",
    "by", "is", "are", "was", "were", "be", "as", "at", "this", "that",
    "it", "from", "into", "about", "introduction", "overview", "appendix",
    "chapter", "section", "part",
    "的", "了", "和", "及", "或", "与", "之", "其", "在", "对", "对于", "关于",
    "概述", "简介", "介绍", "附录", "章", "节", "部分", "总结",
)

ANCHOR = r'<a id="([^"]+)"></a>'
SECTION_ANCHOR = r'<a id="(sec-\d+)"></a>'
MD_IMAGE, HTML_IMAGE = r"!\[[^\]]*\]\([^)]*\)", r"(?i)<img\b[^>]*>"
MD_ASSET = r"!\[[^\]]*\]\((assets/[^)\s]+)"
WIKILINK = r"\[\[([^\]|]+)(?:\|[^\]]*)?\]\]"
PIN = r"\[\^ev-(\d+)\]"
REFERENCE_DOC = r"[MH]\d{6,}"


def tokens(title: Column) -> Column:
    """The set of words of a title, sorted: lower case, no stop words, at least two characters. Null for null."""
    found = F.regexp_extract_all(F.lower(title), F.lit(r"(?U)[\w\x{4e00}-\x{9fff}]+"), F.lit(0))
    stop = F.array(*map(F.lit, STOPWORDS))
    return F.array_sort(F.array_distinct(F.filter(found, lambda t: (F.length(t) > 1) & ~F.array_contains(stop, t))))


def slug(text: Column, fallback: Column | str, keep_hyphen: bool = True) -> Column:
    """A slug of Latin letters, digits and Chinese characters, parted by single hyphens."""
    kept = r"[^a-z0-9\x{4e00}-\x{9fff}-]+" if keep_hyphen else r"[^a-z0-9\x{4e00}-\x{9fff}]+"
    s = F.regexp_replace(F.regexp_replace(F.lower(squeezed(text)), kept, "-"), "-+", "-")
    s = F.regexp_replace(s, "^-+|-+$", "")
    return F.coalesce(F.nullif(s, F.lit("")), F.lit(fallback) if isinstance(fallback, str) else fallback)


def is_numeric_title(title: Column) -> Column:
    """Whether a title is blank or only digits, dots, hyphens and white space."""
    return (squeezed(title) == "") | title.rlike(r"(?U)^[\d.\-\s]+$")


def normal_markdown(text: Column) -> Column:
    """No byte order mark, line feeds only, exactly one at the end."""
    t = F.regexp_replace(F.regexp_replace(text, "^\\x{FEFF}", ""), "\r\n|\r", "\n")
    return F.concat(F.regexp_replace(t, "\n+\\z", ""), F.lit("\n"))


def image_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(MD_IMAGE)) + F.regexp_count(F.regexp_replace(text, MD_IMAGE, ""), F.lit(HTML_IMAGE))


def without_images(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, MD_IMAGE, ""), HTML_IMAGE, "")


def anchors(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(ANCHOR), F.lit(1))


def asset_refs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(MD_ASSET), F.lit(1))


def wikilinks(text: Column) -> Column:
    """Targets of wiki links, trimmed."""
    return F.transform(F.regexp_extract_all(text, F.lit(WIKILINK), F.lit(1)), squeezed)


def pins(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(PIN), F.lit(1)), lambda x: x.cast("int"))


def reference_docs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(REFERENCE_DOC), F.lit(0))


def wikilink(path: Column, label: Column) -> Column:
    """``[[path|label]]`` without the file's ending; without the label where it is the same."""
    path = F.regexp_replace(path, r"\.md$", "")
    return F.when(path == label, F.concat(F.lit("[["), path, F.lit("]]"))).otherwise(F.concat(F.lit("[["), path, F.lit("|"), label, F.lit("]]")))


def with_block_refs(text: Column) -> Column:
    """A block reference on the line after each heading that follows a section's anchor."""
    return F.regexp_replace(text, r'<a id="(sec-\d+)"></a>\n(#{1,6} [^\n]*)', '<a id="$1"></a>\n$2\n^$1')


def section_body(text: Column, anchor: str, most: int = 1500) -> Column:
    """Text after an anchor up to the next section's, without white space at the end; beyond ``most``
    characters it is cut and ends in an ellipsis. Empty where there is no such anchor."""
    needle = f'<a id="{anchor}"></a>'
    at = F.instr(text, needle)
    rest = F.expr(f"substring({_name(text)}, instr({_name(text)}, '{needle}') + {len(needle)})")
    return F.when(at == 0, "").otherwise(excerpt(F.element_at(F.split(rest, r'<a id="sec-\d+"></a>', 2), 1), most))


def excerpt(segment: Column, most: int = 1500) -> Column:
    """The text between two section anchors without its first line end and white space at the end;
    beyond ``most`` characters it is cut and ends in an ellipsis."""
    end = r"(?U)[\s\x1c-\x1f]+\z"
    body = F.regexp_replace(F.regexp_replace(segment, "^\n", ""), end, "")
    return F.when(F.length(body) > most, F.concat(F.regexp_replace(F.substring(body, 1, most - 1), end, ""), F.lit("…"))).otherwise(body)


def _name(c: Column) -> str:
    return c._jc.toString()


def glob_pattern(glob: Column) -> Column:
    """A case-insensitive regular expression for a file glob of ``*`` and ``?``."""
    quoted = F.regexp_replace(F.lower(glob), r"([\\.\[\]{}()+^$|\-])", r"\\$1")
    return F.concat(F.lit("^"), F.replace(F.replace(quoted, F.lit("*"), F.lit(".*")), F.lit("?"), F.lit(".")), F.lit("$"))


def file_stem(path: Column) -> Column:
    name = F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1)
    return F.when(name.rlike(r".\.[^.]*$"), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise(name)


def suffix(path: Column) -> Column:
    return F.lower(F.regexp_extract(path, r"[^/.](\.[^./]*)$", 1))


def module_file_name(module: Column) -> Column:
    return F.concat(F.replace(F.replace(module, F.lit("/"), F.lit("-")), F.lit(" "), F.lit("_")), F.lit(".md"))


def sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def atom_id(entity: Column, parameter: Column, condition: Column, doc: Column, section: Column) -> Column:
    """First 16 digits of the hash of an atom's identity; value and case don't matter."""
    of = [F.lower(squeezed(F.coalesce(c, F.lit("")))) for c in (entity, parameter, condition)]
    return F.substring(sha(F.concat_ws("|", *of, F.coalesce(doc, F.lit("")), F.coalesce(section, F.lit("")))), 1, 16)


def json_string(text: Column) -> Column:
    """A JSON string literal; characters beyond ASCII stay as they are."""
    return F.regexp_extract(F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("x"))), r"(?s)^\{\"x\":(.*)\}$", 1)


def prompt_text(messages: Column) -> Column:
    """Messages (array of struct role, content) as JSON with sorted keys, ``, `` and ``: ``."""
    one = F.transform(messages, lambda m: F.concat(F.lit('{"content": '), json_string(m["content"]), F.lit(', "role": '), json_string(m["role"]), F.lit("}")))
    return F.concat(F.lit("["), F.array_join(one, ", "), F.lit("]"))


def prompt_hash(messages: Column) -> Column:
    return sha(prompt_text(messages))


def natural_key(name: Column) -> Column:
    """A string whose order is the natural order of names: digit runs as numbers, the rest in lower
    case, and names that don't begin with a digit last."""
    parts = F.regexp_extract_all(F.lower(name), F.lit(r"\d+|\D+"), F.lit(0))
    keyed = F.transform(parts, lambda p: F.when(p.rlike(r"^\d"), F.concat(F.lit("0"), F.lpad(F.regexp_replace(p, "^0+(?=.)", ""), 24, "0"))).otherwise(F.concat(F.lit("1"), p)))
    return F.concat(F.when(name.rlike(r"^\d"), "0").otherwise("1"), F.array_join(keyed, "\x01"))


def html_escaped(text: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;"), ("\n", "<br>")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return F.when(text == "", "&nbsp;").otherwise(text)


def html_table(rows: Column) -> Column:
    """A grid (array of rows; cells with text, colspan, rowspan, is_header) as an HTML table."""

    def cell(c: Column) -> Column:
        tag = F.when(c["is_header"], "th").otherwise("td")
        span = F.concat(*(F.when(c[k] > 1, F.concat(F.lit(f' {k}="'), c[k].cast("string"), F.lit('"'))).otherwise("") for k in ("colspan", "rowspan")))
        return F.concat(F.lit("<"), tag, span, F.lit(">"), html_escaped(F.coalesce(c["text"], F.lit(""))), F.lit("</"), tag, F.lit(">"))

    body = F.transform(rows, lambda r: F.concat(F.lit("<tr>"), F.array_join(F.transform(r, cell), ""), F.lit("</tr>")))
    return F.concat(F.lit("<table>"), F.array_join(body, ""), F.lit("</table>"))


def pipe_table(rows: Column) -> Column:
    """Rows (array of array of string) as a pipe table; the first is the header, all others get its width."""
    width = F.size(rows[0])
    padded = F.transform(rows, lambda r: F.slice(F.concat(r, F.array_repeat(F.lit(""), width)), 1, width))
    line = F.transform(padded, lambda r: F.concat(F.lit("| "), F.array_join(F.transform(r, lambda c: F.coalesce(c, F.lit(""))), " | "), F.lit(" |")))
    rule = F.concat(F.lit("| "), F.array_join(F.array_repeat(F.lit("---"), width), " | "), F.lit(" |"))
    return F.array_join(F.concat(F.slice(line, 1, 1), F.array(rule), F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0)))), "\n")


def formatted(value: Column, pattern: str) -> Column:
    """A cell's number by its format: percent, dollars or plain; an em dash for null."""
    places = len(pattern.split(".", 1)[1].rstrip('%"')) if "." in pattern else 0
    if "%" in pattern:
        out = F.concat(F.format_string(f"%.{places}f", value * 100), F.lit("%"))
    elif "$" in pattern:
        out = F.concat(F.lit("$"), F.format_number(value, 2 if places else 0))
    else:
        out = value.cast("string")
    return F.coalesce(out, F.lit("—"))


def formatted_time(value: Column) -> Column:
    """A date, with its time of day unless that is midnight; an em dash for null."""
    out = F.when(F.date_format(value, "HH:mm:ss") == "00:00:00", F.date_format(value, "yyyy-MM-dd")).otherwise(F.date_format(value, "yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(out, F.lit("—"))


def json_list(raw: Column) -> Column:
    """The JSON list inside a model's answer: fences stripped, else from the first [ to the last ]."""
    t = squeezed(F.regexp_replace(squeezed(raw), r"(?i)^```(?:json)?\s*|\s*```$", ""))
    inner = F.regexp_extract(t, r"(?s)(\[.*\])", 1)
    return F.nullif(F.when(t.startswith("["), t).otherwise(inner), F.lit(""))


def redacted(text: Column, rules: list[tuple[str, ...]]) -> tuple[Column, Column]:
    """Text with ordered rules (pattern, replacement) applied, and the number of replacements. A rule
    may name, third, a text without which its pattern can't match; it is looked for first."""
    n = F.lit(0)
    for pattern, to, *needs in rules:
        hit = text.contains(needs[0]) if needs else F.lit(True)
        n = n + F.when(hit, F.coalesce(F.regexp_count(text, F.lit(pattern)), F.lit(0))).otherwise(0)
        text = F.when(hit, F.regexp_replace(text, pattern, to)).otherwise(text)
    return text, n
