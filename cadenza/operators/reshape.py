"""Wide to long and back."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _tick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def melt_series(
    df: DataFrame, keys: Sequence[str], series: Mapping[str, Mapping[dt.date, str]], default: int | None = 0
) -> DataFrame:
    """Several parallel date-column families to one row per key and date, in one pass.

    ``series`` maps an output column to its ``{date: input column}``; all families
    share the dates. Missing values become ``default``.
    """
    names = list(series)
    dates = list(series[names[0]])
    if any(list(series[n]) != dates for n in names):
        raise ValueError("the column families do not cover the same dates")
    cells = []
    for d in dates:
        values = [f"cast({_tick(series[n][d])} as bigint)" for n in names]
        cells.append(f"date'{d.isoformat()}', " + ", ".join(values))
    long = df.select(
        *keys, F.expr(f"stack({len(dates)}, {', '.join(cells)}) as (date, {', '.join(map(_tick, names))})")
    )
    return long if default is None else long.fillna(default, names)


def melt_dates(df: DataFrame, keys: Sequence[str], columns: Mapping[dt.date, str], value: str) -> DataFrame:
    """Date columns to (key, date, value) rows with nulls as 0."""
    return melt_series(df, keys, {value: columns})


def melt_columns(df: DataFrame, keys: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Named columns (one per territory) to rows, nulls as 0."""
    return df.unpivot(list(keys), list(columns), name, value).fillna(0, [value])


def pivot_dates(df: DataFrame, keys: Sequence[str], dates: Sequence[dt.date], value: str) -> DataFrame:
    """(key, date, value) rows to one column per date, in the given order."""
    cells = [F.max(F.when(F.col("date") == F.lit(d), F.col(value))).alias(d.isoformat()) for d in dates]
    first, last = min(dates), max(dates)
    return df.filter(F.col("date").between(F.lit(first), F.lit(last))).groupBy(*keys).agg(*cells)


def attributes_to_columns(
    df: DataFrame, keys: Sequence[str], kind: str, value: str, names: Mapping[int, str]
) -> DataFrame:
    """One attribute per row to one column per kind, one row per key.

    Of several values of one kind the smallest is taken. (Joining one table per kind
    would multiply such keys, and a keyed upsert could not take the result.)
    """
    cells = [F.min(F.when(F.col(kind) == code, F.col(value))).alias(name) for code, name in names.items()]
    return df.groupBy(*keys).agg(*cells)


def unpack(df: DataFrame, column: str, name: str, sep: str = "/") -> DataFrame:
    """One row per element of a delimited list; empty and null lists give none."""
    parts: Column = F.split(F.col(column), sep)
    return df.withColumn(name, F.explode(parts)).filter(F.length(name) > 0)
