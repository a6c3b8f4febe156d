"""Markdown, plain text, web pages and archives."""

from __future__ import annotations

import io
import re
import zipfile
from html.parser import HTMLParser

from strataframe.sources.registry import Document, Reader

MOST_MEMBER = 1 << 30  # bytes of one unpacked member; larger ones are left out with a warning


def decode(data: bytes) -> str:
    for code in ("utf-8-sig", "utf-16") if data[:2] in (b"\xff\xfe", b"\xfe\xff") else ("utf-8-sig", "cp1252"):
        try:
            return data.decode(code)
        except UnicodeDecodeError:
            continue
    return data.decode("latin-1")


def markdown(data: bytes, name: str) -> Document:
    doc, fence = Document(), False
    for line in re.split(r"\r\n|\r|\n", decode(data)):
        fence ^= line.lstrip().startswith(("```", "~~~"))
        m = re.fullmatch(r"(#{1,6})[ \t]+(.*?)[ \t]*#*", line)
        if m and not fence:
            doc.section(len(m[1]), m[2])
        elif line.strip():
            doc.text(line)
    return doc


def plain(data: bytes, name: str) -> Document:
    doc = Document()
    doc.section(1, name)
    for p in re.split(r"\n\s*\n", re.sub(r"\r\n?", "\n", decode(data))):
        if p.strip():
            doc.text(p.strip("\n"))
    return doc


class _Html(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.doc, self.held, self.heading, self.skip, self.cells, self.row = Document(), "", 0, 0, None, None

    def flush(self) -> None:
        text = re.sub(r"\s+", " ", self.held).strip()
        self.held = ""
        if not text:
            return
        if self.row is not None:
            self.row.append(text)
        elif self.heading:
            self.doc.section(self.heading, text)
        else:
            self.doc.text(text)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style", "template"):
            self.skip += 1
        elif re.fullmatch(r"h[1-6]", tag):
            self.flush()
            self.heading = int(tag[1])
        elif tag == "tr":
            self.end_row()
            self.row = []
        elif tag in ("p", "div", "li", "table", "ul", "ol", "pre", "blockquote", "section", "article", "br", "td", "th"):
            self.flush()
            if tag == "li":
                self.held = "- "

    def handle_endtag(self, tag: str) -> None:
        if tag in ("script", "style", "template"):
            self.skip = max(0, self.skip - 1)
        elif re.fullmatch(r"h[1-6]", tag):
            self.flush()
            self.heading = 0
        elif tag in ("tr", "table"):
            self.end_row()
        elif tag in ("p", "div", "li", "td", "th", "pre", "blockquote"):
            self.flush()

    def end_row(self) -> None:
        """Ends what is held, and the row that may still be open, as end tags can be left out."""
        self.flush()
        row, self.row = self.row, None
        if row:
            self.doc.text("| " + " | ".join(row) + " |")

    def handle_data(self, data: str) -> None:
        if not self.skip:
            self.held += data


def web(data: bytes, name: str) -> Document:
    p = _Html()
    p.feed(decode(data))
    p.close()
    p.end_row()
    return p.doc


def archive(data: bytes, name: str) -> Document:
    doc = Document()
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for m in sorted(z.infolist(), key=lambda m: m.filename):
            if m.is_dir():
                continue
            if m.flag_bits & 1:
                doc.warnings.append(f"encrypted member skipped: {m.filename}")
            elif m.file_size > MOST_MEMBER:
                doc.warnings.append(f"member too large: {m.filename}")
            else:
                doc.members.append((m.filename, z.read(m)))
                doc.section(1, m.filename)
    return doc


READERS = (
    Reader("markdown", "1", (".md", ".markdown"), markdown),
    Reader("text", "1", (".txt",), plain),
    Reader("web", "1", (".html", ".htm"), web),
    Reader("zip", "1", (".zip",), archive),
)
