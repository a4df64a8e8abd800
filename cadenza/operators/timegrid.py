"""Weekly buckets, growth streaks, daily gap filling and snapshot comparison."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.dates import aligned_week, back, calendar_week
from cadenza.functions.numeric import clamp, exact_percent


def weekly_sums(df: DataFrame, keys: Sequence[str], value: str, as_of: dt.date, days: int) -> DataFrame:
    """Sums per aligned 7-day bucket over the dates strictly between ``as_of - days`` and ``as_of``."""
    date = F.col("date")
    window = (date > F.lit(back(as_of, days))) & (date < F.lit(as_of))
    return (
        df.filter(window)
        .groupBy(*keys, aligned_week(date, as_of).alias("week"))
        .agg(F.sum(value).alias(value))
    )


def calendar_weekly_sums(df: DataFrame, keys: Sequence[str], value: str, since: dt.date) -> DataFrame:
    """Sums per Monday week over the dates after ``since``."""
    date = F.col("date")
    return (
        df.filter(date > F.lit(since))
        .groupBy(*keys, calendar_week(date).alias("week"))
        .agg(F.sum(value).alias(value))
    )


def streaks(weekly: DataFrame, keys: Sequence[str], value: str, first_counts: bool = False) -> DataFrame:
    """Positive weeks and clamped cumulative growth per key.

    Each week is compared with the previous present one. A first week has no
    predecessor: it never counts, or counts against 0 with ``first_counts``. Growth per
    week is a percent rounded at two places, kept within ±50, 0 without a predecessor.
    """
    w = Window.partitionBy(*keys).orderBy("week")
    before: Column = F.lag(value, 1).over(w)
    if first_counts:
        before = F.coalesce(before, F.lit(0))
    pct = F.coalesce(clamp(exact_percent(value, "__before"), -50, 50), F.lit(0).cast("decimal(10,2)"))
    return (
        weekly.withColumn("__before", before)
        .groupBy(*keys)
        .agg(
            F.sum(F.when(F.col(value) > F.col("__before"), 1).otherwise(0)).alias("num_positive_weeks"),
            F.sum(pct.cast("decimal(10,2)")).cast("double").alias("rolling_pct_chg"),
        )
    )


def densify(df: DataFrame, key: str, value: str, date: str = "date") -> DataFrame:
    """One row per key and day between its first and last day, gaps filled linearly.

    Every observed row emits itself and the days up to the next observed one, so the
    grid needs neither a calendar table nor a join. ``df`` must be unique on (key, date).
    """
    w = Window.partitionBy(key).orderBy(date)
    steps = df.select(
        key,
        F.col(date).alias("__d0"),
        F.col(value).cast("double").alias("__v0"),
        F.lead(date).over(w).alias("__d1"),
        F.lead(F.col(value).cast("double")).over(w).alias("__v1"),
    )
    gap = F.coalesce(F.datediff("__d1", "__d0"), F.lit(1))
    days = steps.withColumn("__gap", gap).withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__gap") - 1)))
    slope = (F.col("__v1") - F.col("__v0")) * F.col("__k") / F.col("__gap")
    return days.select(
        key,
        F.date_add("__d0", F.col("__k")).alias(date),
        F.when(F.col("__k") == 0, F.col("__v0")).otherwise(F.col("__v0") + slope).alias(value),
    )


def lagged(df: DataFrame, key: str, value: str, steps: int, name: str, date: str = "date") -> DataFrame:
    """Add the value ``steps`` rows earlier; on a dense grid that is ``steps`` days."""
    return df.withColumn(name, F.lag(value, steps).over(Window.partitionBy(key).orderBy(date)))


def week_gain(dense: DataFrame, key: str, value: str, gain: str, days: int = 7, date: str = "date") -> DataFrame:
    """The last day of each key with its gain over the day ``days`` earlier, where that day exists."""
    latest = F.max_by(F.struct(F.col(date), F.col(value)), F.col(date))
    w = Window.partitionBy(key).orderBy(date)
    rows = dense.withColumn("__then", F.lag(value, days).over(w))
    last = rows.groupBy(key).agg(
        latest.alias("__last"), F.max_by(F.col("__then"), F.col(date)).alias("__then")
    )
    return last.filter(F.col("__then").isNotNull()).select(
        key,
        F.col(f"__last.{date}").alias(date),
        F.col(f"__last.{value}").alias(value),
        (F.col(f"__last.{value}") - F.col("__then")).alias(gain),
    )


def snapshots(
    df: DataFrame, keys: Sequence[str], values: Sequence[str], offsets: Mapping[str, int], as_of: dt.date
) -> DataFrame:
    """Compare single days: one row per key, columns ``<prefix>_<value>`` per offset.

    All snapshots come from one scan and one shuffle instead of a self-join per day.
    """
    days = {prefix: back(as_of, n) for prefix, n in offsets.items()}
    cells = [
        F.max(F.when(F.col("date") == F.lit(d), F.col(v))).alias(f"{prefix}_{v}")
        for prefix, d in days.items()
        for v in values
    ]
    return df.filter(F.col("date").isin(list(days.values()))).groupBy(*keys).agg(*cells)
