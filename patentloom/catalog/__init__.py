"""The registered queries: each a Spark callable with an independent SQL statement."""

from __future__ import annotations

from importlib import import_module

from patentloom.catalog.registry import ORACLE_SQL, QUERIES, Query

_MODULES = ["patent", "inventor", "applicant", "branch", "curation", "text", "stream"]


def _load() -> None:
    for module in _MODULES:
        import_module(f"patentloom.catalog.{module}_queries")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLE_SQL)
