"""Word, spreadsheet and presentation files, read from their zipped XML."""

from __future__ import annotations

import datetime
import html
import io
import posixpath
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as E

from strataframe.sources.images import keep
from strataframe.sources.registry import Document, Reader

W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
A = "{http://schemas.openxmlformats.org/drawingml/2006/main}"
P = "{http://schemas.openxmlformats.org/presentationml/2006/main}"
R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
S = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
Cell = tuple[str, int, int]  # text, columns, rows


def html_table(rows: list[list[Cell]]) -> str:
    out = ["<table>"]
    for row in rows:
        out.append("<tr>")
        for text, wide, high in row:
            span = (f' colspan="{wide}"' if wide > 1 else "") + (f' rowspan="{high}"' if high > 1 else "")
            out.append(f"<td{span}>{html.escape(text).replace(chr(10), '<br>') or '&nbsp;'}</td>")
        out.append("</tr>")
    return "".join([*out, "</table>"])


def _links(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    """Targets of a part's relations by their id, as paths in the archive."""
    folder, name = posixpath.split(part)
    try:
        root = E.fromstring(z.read(f"{folder}/_rels/{name}.rels"))
    except KeyError:
        return {}
    return {x.get("Id"): posixpath.normpath(posixpath.join(folder, t)) if not (t := x.get("Target", "")).startswith("/") else t[1:] for x in root if x.get("TargetMode") != "External"}


def _word_text(p: E.Element) -> str:
    out = []
    for x in p.iter():
        if x.tag == W + "t":
            out.append(x.text or "")
        elif x.tag == W + "tab":
            out.append("\t")
        elif x.tag == W + "br":
            out.append("\n")
    return "".join(out).strip()


def _word_table(tbl: E.Element) -> list[list[Cell]]:
    """Cells of a table; continued cells of a vertical merge are left out and counted by the first."""
    grid: list[list[list]] = []
    for tr in tbl.findall(W + "tr"):
        row, at = [], 0
        for tc in tr.findall(W + "tc"):
            pr = tc.find(W + "tcPr")
            span = pr.find(W + "gridSpan") if pr is not None else None
            merge = pr.find(W + "vMerge") if pr is not None else None
            wide = int(span.get(W + "val", "1")) if span is not None else 1
            state = "" if merge is None else merge.get(W + "val", "continue")
            row.append([at, wide, state, "\n".join(filter(None, map(_word_text, tc.findall(W + "p"))))])
            at += wide
        grid.append(row)
    out: list[list[Cell]] = []
    for i, row in enumerate(grid):
        cells: list[Cell] = []
        for at, wide, state, text in row:
            if state == "continue":
                continue
            high = 1
            while state == "restart" and i + high < len(grid) and any(c[0] == at and c[2] == "continue" for c in grid[i + high]):
                high += 1
            cells.append((text, wide, high))
        out.append(cells)
    return out


def docx(data: bytes, name: str) -> Document:
    doc, images = Document(), 0
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        part = "word/document.xml"
        links, body = _links(z, part), E.fromstring(z.read(part)).find(W + "body")
        styles = {}
        if "word/styles.xml" in z.namelist():
            for s in E.fromstring(z.read("word/styles.xml")).iter(W + "style"):
                n = s.find(W + "name")
                styles[s.get(W + "styleId")] = n.get(W + "val", "") if n is not None else ""
        for x in body if body is not None else []:
            if x.tag == W + "tbl":
                doc.table(html_table(_word_table(x)))
            elif x.tag == W + "p":
                style = x.find(f"{W}pPr/{W}pStyle")
                key = style.get(W + "val", "") if style is not None else ""
                m = re.fullmatch(r"heading ?([1-4])", (styles.get(key) or key).lower())
                text = _word_text(x)
                if m and text:
                    doc.section(int(m[1]), text)
                elif text:
                    doc.text(text)
                for blip in x.iter(A + "blip"):
                    images += 1
                    target = links.get(blip.get(R + "embed", ""))
                    if target in z.namelist() and (kept := keep(doc, "img", images, z.read(target))):
                        doc.text(f"![](assets/{kept})")
    return doc


def _lines(x: E.Element) -> Iterator[str]:
    for p in x.iter(A + "p"):
        t = "".join(t.text or "" for t in p.iter(A + "t")).strip()
        if t:
            yield t


# Fixed value: where a presentation keeps its named sections.
_SECTIONS = "{http://schemas.microsoft.com/office/powerpoint/2010/main}"


def _outline(z: zipfile.ZipFile) -> tuple[list[str], list[tuple[str, list[int]]]]:
    """The slides of a presentation in its order, and its named sections with the places of their slides,
    from 1; slides of unknown numbers and sections without slides are left out."""
    names = z.namelist()
    slides = sorted((n for n in names if re.fullmatch(r"ppt/slides/slide\d+\.xml", n)), key=lambda n: int(re.search(r"\d+", n)[0]))
    if "ppt/presentation.xml" not in names:
        return slides, []
    root, links = E.fromstring(z.read("ppt/presentation.xml")), _links(z, "ppt/presentation.xml")
    listed = [(x.get("id"), links.get(x.get(R + "id", ""))) for x in root.iter(P + "sldId")]
    listed = [(k, part) for k, part in listed if part in names]
    if not listed:
        return slides, []
    place = {k: i for i, (k, _) in enumerate(listed, 1)}
    found = []
    for section in root.iter(_SECTIONS + "section"):
        at = sorted({place[x.get("id")] for x in section.iter(_SECTIONS + "sldId") if x.get("id") in place})
        if at:
            found.append((section.get("name") or "(Unnamed Section)", at))
    return [part for _, part in listed], found


def pptx(data: bytes, name: str) -> Document:
    """Slides as sections; below the presentation's own sections, where it has any. Slides in none of them
    stand beside them, after them."""
    doc, images = Document(), 0
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        slides, sections = _outline(z)
        rest_of = [k for k in range(1, len(slides) + 1) if not any(k in at for _, at in sections)]
        order = [x for title, at in sections for x in ((0, title), *((k, 2) for k in at))] + [(k, 1) for k in rest_of]
        for k, level in order:
            if not k:
                doc.section(1, level)
                continue
            part = slides[k - 1]
            root, links = E.fromstring(z.read(part)), _links(z, part)
            title, rest, tables = "", [], []
            for shape in root.iter():
                if shape.tag == P + "sp":
                    ph = shape.find(f"{P}nvSpPr/{P}nvPr/{P}ph")
                    lines = list(_lines(shape))
                    if ph is not None and ph.get("type") in ("title", "ctrTitle") and lines and not title:
                        title = " ".join(lines)
                    else:
                        rest += lines
                elif shape.tag == A + "tbl":
                    tables.append([[("\n".join(_lines(tc)), int(tc.get("gridSpan", "1")), int(tc.get("rowSpan", "1"))) for tc in tr.findall(A + "tc") if tc.get("hMerge") != "1" and tc.get("vMerge") != "1"] for tr in shape.findall(A + "tr")])
            doc.section(level, title or f"Slide {k}")
            for line in rest:
                doc.text(line)
            for t in tables:
                doc.table(html_table(t))
            for blip in root.iter(A + "blip"):
                images += 1
                target = links.get(blip.get(R + "embed", ""))
                if target in names and (kept := keep(doc, "img", images, z.read(target))):
                    doc.text(f"![](assets/{kept})")
            for target in links.values():
                if "notesSlide" in target and target in names:
                    for sp in E.fromstring(z.read(target)).iter(P + "sp"):
                        ph = sp.find(f"{P}nvSpPr/{P}nvPr/{P}ph")
                        if ph is not None and ph.get("type") == "body":
                            for line in _lines(sp):
                                doc.text(f"> **Note:** {line}")
    return doc


def natural(name: str) -> tuple:
    """Names that begin with a number first, digit runs as numbers."""
    parts = re.findall(r"\d+|\D+", name)
    return (not name[:1].isdigit(), [(0, int(p), "") if p.isdigit() else (1, 0, p.lower()) for p in parts])


_BUILT_IN = {9: "0%", 10: "0.00%", 5: '"$"#,##0', 6: '"$"#,##0', 7: '"$"#,##0.00', 8: '"$"#,##0.00', 14: "yyyy-mm-dd", 15: "d-mmm-yy", 16: "d-mmm", 17: "mmm-yy", 18: "h:mm", 19: "h:mm:ss", 20: "h:mm", 21: "h:mm:ss", 22: "yyyy-mm-dd h:mm", 45: "mm:ss", 46: "h:mm:ss", 47: "mm:ss"}


def shown(value: str, pattern: str) -> str:
    """A number as its format shows it: percent, dollars, dates and times; else as it is."""
    if value == "":
        return "—"
    try:
        x = float(value)
    except ValueError:
        return value
    bare = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', lambda m: "$" if "$" in m[0] else "", pattern).lower()
    if "%" in bare:
        m = re.search(r"0\.(0+)%", bare)
        return f"{x * 100:.{len(m[1]) if m else 0}f}%"
    if "$" in bare:
        return f"${x:,.{2 if '.' in bare else 0}f}"
    if re.search(r"[ydhs]|m{1,4}", bare) and bare != "general":
        t = datetime.datetime(1899, 12, 30) + datetime.timedelta(days=x)
        t = (t + datetime.timedelta(microseconds=500_000)).replace(microsecond=0)
        if "y" not in bare and "d" not in bare:
            return t.strftime("%H:%M:%S")
        return t.strftime("%Y-%m-%d %H:%M:%S") if (t.hour, t.minute, t.second) != (0, 0, 0) else t.strftime("%Y-%m-%d")
    return str(int(x)) if x.is_integer() and "e" not in value.lower() else value


def _place(ref: str) -> tuple[int, int]:
    m = re.match(r"([A-Z]+)(\d+)", ref)
    col = 0
    for ch in m[1]:
        col = col * 26 + ord(ch) - 64
    return int(m[2]), col


def xlsx(data: bytes, name: str) -> Document:
    doc = Document()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = z.namelist()
        strings = ["".join(t.text or "" for t in si.iter(S + "t")) for si in E.fromstring(z.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in names else []
        formats: list[str] = []
        if "xl/styles.xml" in names:
            st = E.fromstring(z.read("xl/styles.xml"))
            own = {int(x.get("numFmtId")): x.get("formatCode", "") for x in st.iter(S + "numFmt")}
            formats = [own.get(i, _BUILT_IN.get(i, "")) for x in st.findall(f"{S}cellXfs/{S}xf") for i in [int(x.get("numFmtId", "0"))]]
        links = _links(z, "xl/workbook.xml")
        sheets = [(x.get("name", ""), links.get(x.get(R + "id", ""), "")) for x in E.fromstring(z.read("xl/workbook.xml")).iter(S + "sheet")]
        for title, part in sorted(sheets, key=lambda s: natural(s[0])):
            doc.section(1, title)
            if part not in names:
                continue
            root, cells = E.fromstring(z.read(part)), {}
            for c in root.iter(S + "c"):
                v, t = c.find(S + "v"), c.get("t", "n")
                if t == "inlineStr":
                    text = "".join(x.text or "" for x in c.iter(S + "t"))
                elif v is None or v.text is None:
                    continue
                elif t == "s":
                    text = strings[int(v.text)]
                elif t == "b":
                    text = "True" if v.text == "1" else "False"
                elif t == "n":
                    i = int(c.get("s", "0"))
                    text = shown(v.text, formats[i] if i < len(formats) else "")
                else:
                    text = v.text
                cells[_place(c.get("r"))] = text
            if not cells:
                continue
            merged, hidden = {}, set()
            for m in root.iter(S + "mergeCell"):
                (r1, c1), (r2, c2) = map(_place, m.get("ref").split(":"))
                merged[r1, c1] = (c2 - c1 + 1, r2 - r1 + 1)
                hidden |= {(r, c) for r in range(r1, r2 + 1) for c in range(c1, c2 + 1)} - {(r1, c1)}
            rows = max(r for (r, _), t in cells.items() if t != "")
            cols = max(c for _, c in cells)
            doc.table(html_table([[(cells.get((r, c), "—"), *merged.get((r, c), (1, 1))) for c in range(1, cols + 1) if (r, c) not in hidden] for r in range(1, rows + 1)]))
    return doc


READERS = (Reader("docx", "1", (".docx",), docx), Reader("pptx", "1", (".pptx",), pptx), Reader("xlsx", "1", (".xlsx",), xlsx))
