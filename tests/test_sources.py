import io
import struct
import zipfile
import zlib

import pytest

from strataframe.sources import files, images, office, plain
from strataframe.sources.registry import Reader, default

W = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
A = 'xmlns:a="http://schemas.openxmlformats.org/drawingml/2006/main" xmlns:p="http://schemas.openxmlformats.org/presentationml/2006/main"'
S = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
RELS = 'xmlns="http://schemas.openxmlformats.org/package/2006/relationships"'


def zipped(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, data in parts.items():
            z.writestr(name.replace("__", "/"), data)
    return out.getvalue()


def docx():
    p = lambda t, s="": f'<w:p>{f"<w:pPr><w:pStyle w:val={chr(34)}{s}{chr(34)}/></w:pPr>" if s else ""}<w:r><w:t>{t}</w:t></w:r></w:p>'
    cell = lambda t, pr="": f"<w:tc><w:tcPr>{pr}</w:tcPr>{p(t)}</w:tc>"
    table = f'<w:tbl><w:tr>{cell("a", "<w:vMerge w:val=" + chr(34) + "restart" + chr(34) + "/>")}{cell("b")}</w:tr><w:tr>{cell("", "<w:vMerge/>")}{cell("c &amp; d")}</w:tr></w:tbl>'
    return zipped(**{"word/document.xml": f"<w:document {W}><w:body>{p('Top', 'Heading1')}{p('one')}{p('Sub', 'Heading2')}{table}{p('two')}</w:body></w:document>"})


def test_docx():
    d = office.docx(docx(), "x.docx")
    assert [(a, n, t) for a, n, t, _ in d.sections] == [("sec-0001", 1, "Top"), ("sec-0002", 2, "Sub")]
    assert d.sections[0][3] == "one"
    assert d.tables == [("tbl-0001", '<table><tr><td rowspan="2">a</td><td>b</td></tr><tr><td>c &amp; d</td></tr></table>')]


def test_pptx_sections():
    shape = lambda t, ph="": f'<p:sp><p:nvSpPr><p:nvPr>{ph}</p:nvPr></p:nvSpPr><p:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></p:txBody></p:sp>'
    slide = lambda x: f"<p:sld {A}><p:cSld><p:spTree>{x}</p:spTree></p:cSld></p:sld>"
    rel = "".join(f'<Relationship Id="r{k}" Target="slides/slide{k}.xml"/>' for k in (1, 2, 3, 4))
    ids = "".join(f'<p:sldId id="{250 + k}" r:id="r{k}"/>' for k in (2, 1, 3, 4))
    named = "".join(f'<s:section name="{n}"><s:sldIdLst>' + "".join(f'<s:sldId id="{250 + k}"/>' for k in at) + "</s:sldIdLst></s:section>" for n, at in (("Intro", [2]), ("", [3, 1, 77]), ("Empty", [88])))
    main = f'<p:presentation xmlns:p="{office.P[1:-1]}" xmlns:r="{office.R[1:-1]}" xmlns:s="{office._SECTIONS[1:-1]}"><p:sldIdLst>{ids}</p:sldIdLst><p:extLst><p:ext><s:sectionLst>{named}</s:sectionLst></p:ext></p:extLst></p:presentation>'
    parts = {f"ppt/slides/slide{k}.xml": slide(shape(f"T{k}", '<p:ph type="title"/>')) for k in (1, 2, 3, 4)}
    d = office.pptx(zipped(**{"ppt/presentation.xml": main, "ppt/_rels/presentation.xml.rels": f"<Relationships {RELS}>{rel}</Relationships>", **parts}), "x.pptx")
    assert [(level, title) for _, level, title, _ in d.sections] == [(1, "Intro"), (2, "T2"), (1, "(Unnamed Section)"), (2, "T1"), (2, "T3"), (1, "T4")]


def test_pptx():
    shape = lambda t, ph="": f'<p:sp><p:nvSpPr><p:nvPr>{ph}</p:nvPr></p:nvSpPr><p:txBody><a:p><a:r><a:t>{t}</a:t></a:r></a:p></p:txBody></p:sp>'
    slide = lambda x: f"<p:sld {A}><p:cSld><p:spTree>{x}</p:spTree></p:cSld></p:sld>"
    d = office.pptx(zipped(**{"ppt/slides/slide2.xml": slide(shape("second")), "ppt/slides/slide1.xml": slide(shape("Title", '<p:ph type="title"/>') + shape("body")), "ppt/slides/_rels/slide1.xml.rels": f'<Relationships {RELS}><Relationship Id="r1" Target="../notesSlides/notesSlide1.xml"/></Relationships>', "ppt/notesSlides/notesSlide1.xml": slide(shape("remember", '<p:ph type="body"/>'))}), "x.pptx")
    assert [(t, b) for _, _, t, b in d.sections] == [("Title", "body\n\n> **Note:** remember"), ("Slide 2", "second")]


def test_xlsx():
    sheet = '<c r="A1" t="s"><v>0</v></c><c r="B1" s="1"><v>0.256</v></c></row><row r="2"><c r="A2" s="2"><v>45000</v></c><c r="B2" s="3"><v>1234.5</v></c>'
    d = office.xlsx(zipped(**{
        "xl/workbook.xml": f'<workbook {S}><sheets><sheet name="Misc" r:id="r1"/><sheet name="10_b" r:id="r2"/><sheet name="2_a" r:id="r3"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships {RELS}>' + "".join(f'<Relationship Id="r{i}" Target="worksheets/sheet{i}.xml"/>' for i in (1, 2, 3)) + "</Relationships>",
        "xl/sharedStrings.xml": f"<sst {S}><si><t>name</t></si></sst>",
        "xl/styles.xml": f'<styleSheet {S}><numFmts><numFmt numFmtId="164" formatCode="$#,##0.00"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="10"/><xf numFmtId="14"/><xf numFmtId="164"/></cellXfs></styleSheet>',
        **{f"xl/worksheets/sheet{i}.xml": f'<worksheet {S}><sheetData><row r="1">{sheet if i == 3 else ""}</row></sheetData></worksheet>' for i in (1, 2, 3)},
    }), "x.xlsx")
    assert [t for _, _, t, _ in d.sections] == ["2_a", "10_b", "Misc"]
    assert d.tables[0][1] == "<table><tr><td>name</td><td>25.60%</td></tr><tr><td>2023-03-15</td><td>$1,234.50</td></tr></table>"


def png(w, h):
    chunk = lambda k, d: struct.pack(">I", len(d)) + k + d + struct.pack(">I", zlib.crc32(k + d))
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)) + chunk(b"IEND", b"")


def test_images():
    assert (images.sniff(png(4, 3)), images.size(png(4, 3))) == ("png", (4, 3))
    assert images.size(b"GIF89a" + struct.pack("<HH", 7, 5)) == (7, 5)
    assert images.sniff(b"BM") is None and images.sniff(b"BM12") == "bmp" and images.sniff(b"abcd") is None
    jpg = b"\xff\xd8\xff\xe0\x00\x04ab\xff\xc0\x00\x11\x08" + struct.pack(">HH", 9, 8) + b"\x00" * 9
    assert images.size(jpg) == (8, 9)


def test_web_and_markdown():
    d = plain.web(b"<h1>A</h1><p>b <b>c</b></p><script>x</script><ul><li>d<li>e</ul><table><tr><td>1<td>2</table>", "x.html")
    assert d.sections[0][2:] == ("A", "b c\n\n- d\n\n- e\n\n| 1 | 2 |")
    m = plain.markdown(b"# A\n```\n# no\n```\n## B ##\nx", "x.md")
    assert [(n, t) for _, n, t, _ in m.sections] == [(1, "A"), (2, "B")]


def test_registry():
    r = default()
    assert r.pick(".DOCX").name == "docx" and r.pick(".pdf") is None
    with pytest.raises(ValueError):
        r.register(Reader("again", "1", (".docx",), lambda d, n: None))


def test_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / ".git").mkdir()
    (tmp_path / "in" / ".git" / "a.md").write_text("# no")
    (tmp_path / "in" / "a.docx").write_bytes(docx())
    (tmp_path / "in" / "bad.docx").write_bytes(b"nothing")
    (tmp_path / "in" / "x.odd").write_bytes(b"x")
    (tmp_path / "in" / "z.zip").write_bytes(zipped(**{"in__b.md": "# B\ntext", "deep.zip": zipped(**{"c.txt": "t"})}))
    rows = {r.path: r for r in files.extract(files.discover(spark, str(tmp_path / "in"))).collect()}
    assert {p: r.status for p, r in rows.items()} == {"a.docx": "ok", "bad.docx": "failed", "x.odd": "skipped", "z.zip": "ok", "z.zip/in/b.md": "ok", "z.zip/deep.zip": "ok", "z.zip/deep.zip/c.txt": "ok"}
    assert rows["x.odd"].reason == "no_adapter"
    only = files.extract(files.discover(spark, str(tmp_path / "in"), [".DOCX"]))
    assert only.count() == 2
    assert [r.text for r in files.markdown(only).collect()][0].startswith('<a id="sec-0001"></a>\n# Top\n\none')
    assert files.manifest_rows(only).filter("status = 'failed'").count() == 1
