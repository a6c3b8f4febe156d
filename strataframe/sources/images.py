"""Images: format and size from the first bytes."""

from __future__ import annotations

import struct

from strataframe.sources.registry import Document, Reader

LEAST_BYTES = 1024


def sniff(data: bytes) -> str | None:
    """png, jpg, gif or bmp by the magic bytes; None for anything else or fewer than four bytes."""
    if len(data) < 4:
        return None
    if data[:8] == b"\x89PNG\r\n\x1a\n":
        return "png"
    if data[:2] == b"\xff\xd8":
        return "jpg"
    if data[:6] in (b"GIF87a", b"GIF89a"):
        return "gif"
    return "bmp" if data[:2] == b"BM" else None


def size(data: bytes) -> tuple[int | None, int | None]:
    """Width and height; None where the header doesn't tell."""
    kind = sniff(data)
    try:
        if kind == "png":
            return struct.unpack(">II", data[16:24])
        if kind == "gif":
            return struct.unpack("<HH", data[6:10])
        if kind == "bmp":
            w, h = struct.unpack("<ii", data[18:26])
            return w, abs(h)
        if kind == "jpg":
            at = 2
            while at + 9 < len(data):
                if data[at] != 0xFF:
                    at += 1
                    continue
                mark = data[at + 1]
                if 0xC0 <= mark <= 0xCF and mark not in (0xC4, 0xC8, 0xCC):
                    h, w = struct.unpack(">HH", data[at + 5 : at + 9])
                    return w, h
                at += 2 + (struct.unpack(">H", data[at + 2 : at + 4])[0] if not 0xD0 <= mark <= 0xD9 else 0)
    except struct.error:
        pass
    return None, None


def keep(doc: Document, prefix: str, index: int, data: bytes) -> str | None:
    """Adds an inline image under the name ``prefix_index.kind`` if it is large enough and of a known kind."""
    kind = sniff(data)
    if kind is None or len(data) < LEAST_BYTES:
        return None
    name = f"{prefix}_{index}.{kind}"
    doc.assets.append((name, "image", data, *size(data)))
    return name


def read(data: bytes, name: str) -> Document:
    doc = Document()
    kind = sniff(data)
    if kind is None:
        doc.warnings.append("unknown image format")
    doc.section(1, name)
    doc.text(f"![{name}](assets/{name})")
    doc.assets.append((name, "image", data, *size(data)))
    return doc


READERS = (Reader("image", "1", (".png", ".jpg", ".jpeg", ".gif", ".bmp"), read),)
