"""Named queries over a folder of tables, each with the SQL that must give the same rows."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
BASE: dict[str, str] = {}


def cte(name: str, text: str) -> None:
    """Name a table expression that oracle texts may use; earlier ones may be used in later ones."""
    BASE[name] = text


def _uses(text: str, name: str) -> bool:
    return re.search(rf"\b{name}\b", text) is not None


def oracle(body: str, **local: str) -> str:
    """``body`` with the common and the local table expressions it needs in front."""
    needed = " ".join([body, *local.values()])
    common: dict[str, str] = {}
    for name in reversed(list(BASE)):
        if name not in local and _uses(needed, name):
            common[name] = BASE[name]
            needed += " " + BASE[name]
    parts = [*reversed(common.items()), *local.items()]
    if not parts:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in parts) + "\n" + body


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. Date columns leave as text, so both engines print them alike."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return dates_as_text(fn(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def dates_as_text(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DateType)]
    return df.withColumns({c: F.col(c).cast("string") for c in dates}) if dates else df


def sql_percent(new: str, old: str, scale: int = 10000) -> str:
    """SQL for a growth ratio rounded half away from zero, in whole-number arithmetic."""
    d = f"(CAST({new} AS HUGEINT) - CAST({old} AS HUGEINT))"
    o = f"CAST({old} AS HUGEINT)"
    return (
        f"CASE WHEN {old} IS NULL OR {old} = 0 THEN NULL ELSE "
        f"CAST(sign({d}) * ((2 * abs({d}) * {scale} + {o}) // (2 * {o})) AS DOUBLE) / 100 END"
    )


def sql_fraction(new: str, old: str) -> str:
    """The same as a fraction at two places, 0 for a zero base."""
    return f"CASE WHEN {old} = 0 THEN 0e0 ELSE {sql_percent(new, old, 100)} END"


def sql_ratio(a: str, b: str) -> str:
    """SQL for a ratio that is infinite for a positive number over zero."""
    return (
        f"CASE WHEN {b} <> 0 THEN CAST({a} AS DOUBLE) / CAST({b} AS DOUBLE) "
        f"WHEN {a} > 0 THEN CAST('Infinity' AS DOUBLE) WHEN {a} < 0 THEN CAST('-Infinity' AS DOUBLE) END"
    )


def rounded(*columns: str, places: int = 6) -> dict:
    return {c: F.round(F.col(c), places) for c in columns}


def finite(column: str, places: int = 6):
    """Rounded, with an infinite value shown as null."""
    c = F.col(column)
    return F.when(F.abs(c) < float("inf"), F.round(c, places)).alias(column)
