"""Pairs every Spark query with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tradewind.checks.shapes import SHAPE_SQL, Retail
from tradewind.session import tune_tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def oracle_text(body: str) -> str:
    """Prefix the shape views the text names; the text may open with its own WITH."""
    body = body.strip()
    shared = dict(SHAPE_SQL, **MODEL_SQL)
    needed: list[str] = []

    def require(text: str) -> None:
        for name in re.findall(r"\b[sm]_[a-z_]+\b", text):
            if name in shared and name not in needed:
                require(shared[name])
                if name not in needed:
                    needed.append(name)

    require(body)
    if not needed:
        return body
    views = ",\n".join(f"{name} as ({shared[name]})" for name in needed)
    if re.match(r"with\s", body, re.IGNORECASE):
        return f"with {views},\n{body[4:].lstrip()}"
    return f"with {views}\n{body}"


# Model views named m_<name>, added by the modules that define them.
MODEL_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(retail) -> DataFrame`` under the name, with its oracle SQL if there is one."""
    def register(fn: Callable[[Retail], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Retail(tune_tables(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register
