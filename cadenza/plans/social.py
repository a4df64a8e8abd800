"""Follower and listener growth charts over daily account statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.dates import back
from cadenza.functions.numeric import any_present, change, not_true, present
from cadenza.operators.binned import above, fit_model
from cadenza.operators.charts import mark_new
from cadenza.operators.keys import keep_keys, top_per_key
from cadenza.operators.timegrid import densify, lagged, snapshots, week_gain


@dataclass(frozen=True)
class GainRule:
    """What differs between the platforms of the weekly gain chart."""

    days: int
    min_points: int
    points_after_filling: bool
    floor: int
    sigmas: float
    drop_zero: bool = False


# Look-back, history, floor and cut per platform.
PHOTO_RULE = GainRule(16, 3, True, 5000, 2.0)
AUDIO_RULE = GainRule(16, 4, False, 2000, 2.5)
VIDEO_RULE = GainRule(21, 4, False, 1000, 2.0, drop_zero=True)


def chart_base(artists: DataFrame, id_map: DataFrame, stats: DataFrame, accounts: Sequence[str]) -> DataFrame:
    """Unsigned artists with at least one platform account, and their streams."""
    last = stats.select("artist_id", F.coalesce("lw_streams", F.lit(0)).alias("lw_streams"))
    held = artists.filter(F.col("signed") == F.lit(False)).select("artist_id", "artist", "tw_streams", "pct_chg")
    base = held.join(id_map.select("artist_id", *accounts), "artist_id").filter(any_present(*accounts))
    return base.join(last, "artist_id", "left").fillna(0, ["lw_streams"])


def daily_points(stats: DataFrame, account: str, value: str, as_of: dt.date, days: int) -> DataFrame:
    """One non-null value per account and day within the look-back; a repeated day keeps the largest."""
    return (
        stats.filter((F.col("date") > F.lit(back(as_of, days))) & F.col(value).isNotNull())
        .groupBy(account, "date")
        .agg(F.max(value).alias(value))
    )


def with_history(points: DataFrame, account: str, more_than: int) -> DataFrame:
    """Accounts with more than ``more_than`` observed days.

    A window does: after :func:`daily_points` an account has at most one row per day of
    the look-back, and gap filling needs the rows by account anyway.
    """
    held = F.count(F.lit(1)).over(Window.partitionBy(account))
    return points.withColumn("__held", held).filter(F.col("__held") > more_than).drop("__held")


def owners(entities: DataFrame, account: str) -> DataFrame:
    """The entity with the most streams per account."""
    held = entities.filter(present(F.col(account).cast("string")))
    return top_per_key(held, [account], "tw_streams", "artist_id")


def weekly_gains(
    stats: DataFrame, wanted: DataFrame, account: str, value: str, as_of: dt.date, rule: GainRule, latest: DataFrame | None = None
) -> DataFrame:
    """Last value and seven-day gain per wanted account that passes the rule.

    ``latest`` (account, ``followers_latest``) carries the floor where the platform keeps
    it beside the series; otherwise the last filled value is tested.
    """
    if rule.drop_zero:
        stats = stats.filter(F.col(value) != 0)
    points = keep_keys(daily_points(stats, account, value, as_of, rule.days), wanted, [account])
    if latest is not None:
        points = keep_keys(points, latest.filter(F.col("followers_latest") > rule.floor), [account])
    if not rule.points_after_filling:
        points = with_history(points, account, rule.min_points)
    dense = densify(points, account, value)
    if rule.points_after_filling:
        dense = with_history(dense, account, rule.min_points)
    gains = week_gain(dense, account, value, "gain")
    return gains if latest is not None else gains.filter(F.col(value) > rule.floor)


def follower_gain_chart(
    stats: DataFrame,
    entities: DataFrame,
    model: DataFrame,
    previous: DataFrame,
    account: str,
    value: str,
    as_of: dt.date,
    rule: GainRule,
    latest: DataFrame | None = None,
) -> DataFrame:
    """Accounts that gained far more in a week than accounts of their size do.

    ``entities`` are the unsigned artists with their account ids. The chart names the
    owner with the most streams and flags artists missing from ``previous``.
    """
    own = owners(entities, account)
    gains = weekly_gains(stats, own, account, value, as_of, rule, latest)
    hot = above(fit_model(gains, model, value, "gain", "growth_score"), "gain", rule.sigmas)
    chart = hot.drop("mean", "std", "date").withColumns(
        {value: F.col(value).cast("bigint"), "gain": F.col("gain").cast("bigint")}
    )
    return mark_new(chart.join(own, account, "left"), previous, ["artist_id"])


def long_term_growth(
    stats: DataFrame,
    entities: DataFrame,
    model: DataFrame,
    previous: DataFrame,
    account: str,
    value: str,
    as_of: dt.date,
    days: int = 186,
    min_points: int = 4,
    recent: int = 14,
    size: int = 1000,
    latest: DataFrame | None = None,
    floor: int = 2000,
) -> DataFrame:
    """Accounts whose daily gains keep rising over half a year.

    Above-average count of days that gained at least as much as the day before, then
    positive mean z-scores of the seven-day gain over the whole span and over the last
    ``recent`` days, and of those the ``size`` best.
    """
    own = owners(entities, account)
    points = keep_keys(daily_points(stats, account, value, as_of, days), own, [account])
    if latest is not None:
        points = keep_keys(points, latest.filter(F.col("followers_latest") > floor), [account])
    dense = densify(with_history(points, account, min_points), account, value)
    w = Window.partitionBy(account).orderBy("date")
    gained = dense.withColumn("__g", F.coalesce(F.col(value) - F.lag(value, 1).over(w), F.lit(0.0)))
    gained = gained.withColumn("__p", F.coalesce(F.lag("__g", 1).over(w), F.lit(0.0)))
    rises = gained.groupBy(account).agg(
        F.sum(F.when((F.col("__g") > 0) & (F.col("__g") >= F.col("__p")), 1).otherwise(0)).alias("__rises")
    )
    keen = rises.filter(F.col("__rises") > rises.agg(F.avg("__rises")).scalar())
    series = lagged(keep_keys(dense, keen, [account]), account, value, 7, "followers_7_days_ago")
    series = series.filter(F.col("followers_7_days_ago").isNotNull()).withColumn(
        "followers_gained", F.col(value) - F.col("followers_7_days_ago")
    )
    scored = fit_model(series, model, value, "followers_gained", "__z")
    scored = scored.withColumn("__last", F.max("date").over(Window.partitionBy(account)))
    late = F.when(F.col("date") > F.date_sub("__last", recent), F.col("__z"))
    scores = scored.groupBy(account).agg(
        F.avg("__z").alias("six_month_z_score"),
        F.avg(late).alias("fourteen_day_z_score"),
        F.max_by(F.struct("date", value, "followers_7_days_ago", "followers_gained"), "date").alias("__l"),
    )
    best = (
        scores.filter((F.col("fourteen_day_z_score") > 0) & (F.col("six_month_z_score") > 0))
        .orderBy(F.col("six_month_z_score").desc(), F.col(account).asc())
        .limit(size)
    )
    report = best.select(account, "six_month_z_score", "fourteen_day_z_score", "__l.*")
    pct = F.try_divide(F.col(value) - F.col("followers_7_days_ago"), F.col("followers_7_days_ago")) * 100
    report = report.withColumn("followers_pct_chg", F.bround(pct, 2)).withColumnRenamed("date", "recent_date")
    whole = {c: F.col(c).cast("bigint") for c in (value, "followers_7_days_ago", "followers_gained")}
    return mark_new(report.withColumns(whole).join(own, account), previous, ["artist_id"])


def viral_growth(
    counts: DataFrame,
    songs: DataFrame,
    model: DataFrame,
    previous: DataFrame,
    key: str,
    value: str,
    as_of: dt.date,
    days: int = 14,
    min_points: int = 5,
    min_score: float = 1.0,
) -> DataFrame:
    """Songs whose daily counts grow faster than their size explains, over two weeks."""
    positive = daily_points(counts.filter(F.col(value) > 0), key, value, as_of, days)
    points = with_history(keep_keys(positive, songs, [key]), key, min_points - 1)
    dense = densify(points, key, value)
    w = Window.partitionBy(key).orderBy("date")
    daily = dense.withColumn("__gain", F.coalesce(F.col(value) - F.lag(value, 1).over(w), F.lit(0.0)).cast("bigint"))
    daily = daily.withColumn(value, F.col(value).cast("bigint"))
    week = lagged(daily, key, value, 7, "__then").withColumn(
        "gain_7_day", F.coalesce(F.col(value) - F.col("__then"), F.lit(0)).cast("bigint")
    )
    scores = fit_model(week, model, value, "__gain", "__z").groupBy(key).agg(
        F.avg("__z").alias("z_score"), F.max_by(F.struct("date", value, "gain_7_day"), "date").alias("__l")
    )
    strong = scores.filter(F.col("z_score") > min_score)
    report = strong.select(key, "z_score", "__l.*").withColumnRenamed("date", "latest_date")
    return mark_new(report.join(songs, key), previous, ["song_id"])


def snapshot_growth(
    stats: DataFrame,
    known: DataFrame,
    key: str,
    as_of: dt.date,
    floor: int = 100_000,
    min_pct: float = 15.0,
    lead: str = "monthly_listeners",
    others: tuple[str, ...] = ("popularity", "followers"),
    offsets: tuple[int, int] = (3, 10),
) -> DataFrame:
    """Accounts where any of three measures rose by more than ``min_pct`` percent in a week.

    ``stats`` holds one row per account and date. ``known`` adds the stored artist
    (``signed`` and streams); signed ones drop out.
    """
    values = [lead, *others]
    wide = snapshots(stats.filter(F.col(lead).isNotNull()), [key], values, {"tw": offsets[0], "lw": offsets[1]}, as_of)
    base = wide.filter((F.col(f"tw_{lead}") >= floor) & (F.col(f"lw_{lead}") != 0))
    risen = F.lit(False)
    for v in values:
        base = base.withColumn(f"{v}_pct_chg", change(f"tw_{v}", f"lw_{v}") * 100)
        risen = risen | F.coalesce(F.col(f"{v}_pct_chg") > min_pct, F.lit(False))
    return base.filter(risen).join(known, key, "left").filter(not_true("signed"))
