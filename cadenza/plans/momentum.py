"""Daily momentum and weekly acceleration reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import back, chart_week
from cadenza.functions.numeric import acceleration, change, not_true
from cadenza.operators.reshape import pivot_dates


def _ge(c: Column | str, low: float) -> Column:
    """``c >= low`` where a missing measure fails (never null, so OR and AND stay two-valued)."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c) >= low, F.lit(False))


def _gt(c: Column | str, low: float) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c) > low, F.lit(False))


def _measured(wide: DataFrame, measures: dict[str, Column]) -> DataFrame:
    """Add measures, each evaluated once.

    They leave a one-row generator, so a rule over them stays above it. Pushed into the
    raw columns, the rule would repeat every ratio many times and, below the renames of
    a wide file, double the optimizer's constraint set with every renamed column.
    """
    values = F.struct(*[c.alias(name) for name, c in measures.items()])
    return wide.select("*", F.inline(F.array(values)))


def momentum_metrics(wide: DataFrame, days: list[str]) -> DataFrame:
    """Growth measures from the daily columns ``days`` (newest first) and the rolling sums."""
    return _measured(
        wide,
        {
            "pct_chg": change("tw_oda_streams", "lw_oda_streams"),
            "rolling_pct_chg": change("tw_rolling_oda", "lw_rolling_oda"),
            "2_day_chg": change(days[0], days[1]),
            "3_day_chg": change(days[1], days[2]),
            "7_day_acc": acceleration(days[1], days[7], 6),
            "4_day_acc": acceleration(days[1], days[4], 3),
        },
    )


def momentum_rule(rolling_floor: int = 100_000) -> Column:
    """Rolling growth is not negative and one of five short-term signs holds."""
    # All thresholds of this rule.
    signs = (
        (_ge("2_day_chg", 0.15) & _gt("3_day_chg", 0))
        | _ge("3_day_chg", 0.25)
        | (_ge("7_day_acc", 0.15) & _gt("4_day_acc", 0))
        | (_ge("rolling_pct_chg", 0.5) & _gt("lw_rolling_oda", rolling_floor))
        | (_ge("4_day_acc", 0.15) & _gt("3_day_chg", 0))
    )
    return _ge("rolling_pct_chg", 0) & signs


def daily_momentum(
    wide: DataFrame,
    songs: DataFrame,
    streams: DataFrame,
    key: str,
    as_of: dt.date,
    days: list[str],
    floor: int = 10_000,
    rolling_floor: int = 100_000,
) -> DataFrame:
    """Unsigned songs with daily momentum, plus their last 14 days as columns, newest first.

    ``wide`` is the current daily file (rolling sums, week sums, ``days`` newest first).
    ``songs`` adds ``signed`` and the descriptive columns.
    """
    loud = wide.filter(F.col(days[1]) >= floor)
    known = loud.join(songs, key, "left").filter(not_true("signed"))
    picked = momentum_metrics(known, days).filter(momentum_rule(rolling_floor)).drop(*days)
    fortnight = [back(as_of, i) for i in range(14)]
    return picked.join(pivot_dates(streams, [key], fortnight, "streams"), key, "left")


def acceleration_metrics(wide: DataFrame, days: list[str]) -> DataFrame:
    """Rank change (null with ``is_new`` when unranked before), weekly and daily growth."""
    return _measured(
        wide,
        {
            "is_new": F.col("lw_rank") == 0,
            "rank_chg": F.when(F.col("lw_rank") != 0, F.col("lw_rank") - F.col("tw_rank")),
            "pct_chg": change("tw_oda_streams", "lw_oda_streams"),
            "three_wk_acc": acceleration("tw_oda_streams", "l2w_oda_streams", 2),
            "seven_day_acc": acceleration(days[0], days[6], 6),
        },
    )


def acceleration_rule(oldest_day: str, unit: int = 1_000) -> Column:
    """Eight alternative signs; stream thresholds are multiples of ``unit``."""
    # All thresholds of this rule.
    tw, lw, l2w = "tw_oda_streams", "lw_oda_streams", "l2w_oda_streams"
    mid = _ge(tw, 50 * unit) & F.coalesce(F.col(tw) <= 100 * unit, F.lit(False))
    big = _ge(tw, 100 * unit)
    moved = _gt(oldest_day, unit)
    return (
        (_ge("pct_chg", 0.25) & _ge(tw, 200 * unit) & _ge(lw, 5 * unit))
        | (_ge("pct_chg", 0.35) & big & _ge(lw, 5 * unit))
        | (_ge("three_wk_acc", 0.15) & big & _ge(l2w, unit) & _ge("pct_chg", 0.15))
        | (_ge("seven_day_acc", 0.1) & big & moved)
        | (_ge("three_wk_acc", 0.2) & big & _gt("seven_day_acc", 0) & _ge("pct_chg", 0.25))
        | (mid & _ge("seven_day_acc", 0.15) & moved)
        | (_ge("three_wk_acc", 0.15) & mid & _gt("seven_day_acc", 0) & _ge("pct_chg", 0.4))
        | (F.coalesce(F.col(lw) < 5 * unit, F.lit(False)) & big)
    )


def weekly_acceleration(wide: DataFrame, songs: DataFrame, key: str, days: list[str], unit: int = 1_000) -> DataFrame:
    """Unsigned, known songs of the last chart week (``days``, newest first) that accelerate."""
    loud = wide.filter(F.col("tw_oda_streams") >= 50 * unit)
    known = loud.join(songs, key).filter(not_true("signed"))
    return acceleration_metrics(known, days).filter(acceleration_rule(days[6], unit))


def chart_week_columns(run_date: dt.date) -> list[str]:
    """File column names of the last chart week."""
    return [d.strftime("%m/%d/%Y") for d in chart_week(run_date)]
