"""Readers by file suffix. A reader turns the bytes of one file into a ``Document``."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field


@dataclass
class Document:
    """What a reader finds: sections (anchor, level, title, body), tables (anchor, html), assets
    (name, kind, content, width, height), warnings, and files inside the file (name, content)."""

    sections: list[tuple[str, int, str, str]] = field(default_factory=list)
    tables: list[tuple[str, str]] = field(default_factory=list)
    assets: list[tuple[str, str, bytes, int | None, int | None]] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)
    members: list[tuple[str, bytes]] = field(default_factory=list)

    def section(self, level: int, title: str) -> None:
        self.sections.append((f"sec-{len(self.sections) + 1:04d}", level, title, ""))

    def text(self, line: str) -> None:
        """Adds a line to the last section, or to one of its own before any heading."""
        if not self.sections:
            self.section(1, "")
        a, n, t, body = self.sections[-1]
        self.sections[-1] = a, n, t, f"{body}\n\n{line}" if body else line

    def table(self, html: str) -> None:
        anchor = f"tbl-{len(self.tables) + 1:04d}"
        self.tables.append((anchor, html))
        self.text(f'<a id="{anchor}"></a>\n{html}')


@dataclass(frozen=True)
class Reader:
    name: str
    version: str
    suffixes: tuple[str, ...]
    read: Callable[[bytes, str], Document]


class Registry:
    """Readers by suffix, in lower case with the dot; a suffix can't be registered twice."""

    def __init__(self) -> None:
        self.by_suffix: dict[str, Reader] = {}

    def register(self, reader: Reader) -> Reader:
        for s in reader.suffixes:
            if s.lower() in self.by_suffix:
                raise ValueError(f"{s} already has the reader {self.by_suffix[s.lower()].name}")
        for s in reader.suffixes:
            self.by_suffix[s.lower()] = reader
        return reader

    def pick(self, suffix: str) -> Reader | None:
        return self.by_suffix.get(suffix.lower())


def default() -> Registry:
    """A registry of all readers that need no other library. PDF has a seam only: register a reader
    for ``.pdf`` where a parser is installed."""
    from strataframe.sources import images, office, plain

    r = Registry()
    for reader in (*office.READERS, *images.READERS, *plain.READERS):
        r.register(reader)
    return r
