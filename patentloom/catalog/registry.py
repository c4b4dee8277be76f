"""Registration of queries and their SQL counterparts."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from patentloom.catalog.tables import Tables
from patentloom.catalog.views import VIEWS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def with_views(sql: str) -> str:
    """``sql`` preceded by the views it mentions, directly or through other views."""
    needed: dict[str, None] = {}

    def visit(text: str) -> None:
        for name, body in VIEWS.items():
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(body)
                needed[name] = None

    visit(sql)
    if not needed:
        return sql
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in needed)
    joined = ",\n" if sql.lstrip().upper().startswith("WITH ") else "\n"
    rest = re.sub(r"^\s*WITH\s", "", sql, flags=re.IGNORECASE)
    return f"WITH {views}{joined}{rest}"


def register(name: str, build: Callable[[Tables], DataFrame], sql: str | None = None) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
    if sql is not None:
        ORACLE_SQL[name] = with_views(sql)
