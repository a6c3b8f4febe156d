"""Queries by name, and the SQL that states the same results."""

from __future__ import annotations

from collections.abc import Callable

MODULES = ("problems", "text_queries", "section_queries", "store_queries", "page_queries")


def _gather(name: str) -> dict:
    from importlib import import_module

    out: dict = {}
    for m in MODULES:
        part = getattr(import_module(f"strataframe.plans.{m}"), name)
        if twice := out.keys() & part.keys():
            raise ValueError(f"two queries are named {twice}")
        out |= part
    return out


def all_queries() -> dict[str, Callable]:
    return _gather("QUERIES")


def all_oracles() -> dict[str, str]:
    return _gather("ORACLE")
