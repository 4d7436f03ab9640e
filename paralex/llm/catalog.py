"""Queries of the training-data operators and their checking SQL."""

from __future__ import annotations

from importlib import import_module

SECTIONS = ["text", "dedup", "search", "manifest"]


def _sections() -> list:
    return [import_module(f"paralex.llm.queries_{name}") for name in SECTIONS]


def queries() -> dict:
    return {key: run for s in _sections() for key, run in s.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {key: sql for s in _sections() for key, sql in s.ORACLE.items()}
