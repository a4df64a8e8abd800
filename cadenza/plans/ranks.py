"""Rank-improvement charts and rank-change reports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import back
from cadenza.operators.charts import mark_new, rank_change
from cadenza.operators.keys import first_per_key, top_per_key, value_counts
from cadenza.operators.labels import mark_by_substring
from cadenza.operators.timegrid import snapshots

# The worst rank that still charts, per rank kind, and the climb that counts.
RANK_CAPS = {"rank_25_75": 50_000, "rank_fb": 150_000, "rank_eg": 50_000}
MIN_CLIMB = 1000


def rank_improvement(
    ranks: DataFrame,
    entities: DataFrame,
    previous: DataFrame,
    account: str,
    rank: str,
    cap: int,
    latest: dt.date,
    min_climb: int = MIN_CLIMB,
) -> DataFrame:
    """Entities whose rank got better by more than ``min_climb`` in a week, or is new.

    Several ranks of one account on one day count as the largest number. ``latest`` is
    the last date of the rank table.
    """
    held = ranks.filter(F.col(rank).isNotNull())
    pair = snapshots(held, [account], [rank], {"tp": 0, "lp": 7}, latest).select(
        account, F.col(f"tp_{rank}").alias("rnk"), F.col(f"lp_{rank}").alias("last_rnk")
    )
    pair = pair.filter(F.col("rnk").isNotNull()).withColumn("rnk_chg", rank_change(F.col("rnk"), F.col("last_rnk")))
    climbed = F.col("rnk_chg").isNull() | (F.col("rnk_chg") > min_climb)
    chart = pair.filter((F.col("rnk") < cap) & climbed).join(entities, account)
    return mark_new(chart, previous, ["artist_id"])


def new_first(chart: DataFrame, key: str = "artist_id") -> DataFrame:
    return chart.orderBy(F.col("rnk_chg").desc_nulls_first(), F.col(key).asc())


def combined_ranks(overall: DataFrame, fans: DataFrame, engagement: DataFrame, previous: DataFrame) -> DataFrame:
    """Entities on all three charts, with the three ranks and their changes."""

    def part(chart: DataFrame, name: str) -> DataFrame:
        return chart.select(
            "artist_id", F.col("rnk").alias(name), F.col("rnk_chg").alias(f"{name}_chg")
        )

    base = overall.drop("last_rnk", "is_new").withColumnsRenamed({"rnk": "cm_rank", "rnk_chg": "cm_rank_chg"})
    out = base.join(part(fans, "cm_fanbase_rank"), "artist_id").join(part(engagement, "cm_engagement_rank"), "artist_id")
    return mark_new(out, previous, ["artist_id"])


def rank_changes(
    chart: DataFrame, keys: Sequence[str], as_of: dt.date, carry: Sequence[str] = (), offsets: Mapping[str, int] | None = None
) -> DataFrame:
    """Current chart ranks with the ranks of two earlier days.

    A missing earlier rank is 0 and marks the entry as new. One scan serves all days.
    """
    offsets = dict(offsets or {"tp": 2, "lp": 3, "lw": 7})
    now, *before = list(offsets)
    wide = snapshots(chart, keys, ["rank"], offsets, as_of).filter(F.col(f"{now}_rank").isNotNull())
    out = wide.withColumnRenamed(f"{now}_rank", "rank")
    for prefix in before:
        old = F.col(f"{prefix}_rank")
        out = out.withColumn(f"{prefix}_rank_chg", rank_change(F.col("rank"), old))
        out = out.withColumn(f"{prefix}_is_new", old.isNull()).withColumn(f"{prefix}_rank", F.coalesce(old, F.lit(0)))
    if carry:
        today = chart.filter(F.col("date") == F.lit(back(as_of, offsets[now])))
        about = today.groupBy(*keys).agg(*[F.min(c).alias(c) for c in carry])
        out = out.join(about, list(keys))
    return out


def city_changes(
    chart: DataFrame,
    national: DataFrame,
    markets: DataFrame,
    labels_of: DataFrame,
    label_list: DataFrame,
    as_of: dt.date,
    key: str = "track_id",
) -> DataFrame:
    """Rank changes per track and city with market rank, national flag, label and signed flag.

    ``labels_of`` (track, label, popularity) may hold several albums per track: the most
    popular one names the label.
    """
    moved = rank_changes(chart, [key, "city"], as_of)
    top_label = top_per_key(labels_of, [key], "popularity", "label").select(key, "label")
    out = moved.join(markets.select("city", "market_rank"), "city", "left")
    listed = national.select(key).distinct().withColumn("__n", F.lit(True))
    out = out.join(listed, key, "left").withColumn("national_chart", F.col("__n").isNotNull()).drop("__n")
    out = out.join(top_label, key, "left").withColumn("signed", F.lit(False))
    return mark_by_substring(out, "label", label_list)


def city_summary(changes: DataFrame, key: str = "track_id") -> DataFrame:
    """One row per track: its best-ranked city row and the number of cities it charts in."""
    first = first_per_key(changes, [key], [F.col("rank").asc(), F.col("city").asc()])
    return first.drop("market_rank", "city").join(value_counts(changes, [key], "count"), key)


def genre_chart_changes(today: DataFrame, before: DataFrame, facts: DataFrame, key: str, genre: str = "genre") -> DataFrame:
    """Places gained per genre chart since the stored edition, null for new, with stored facts."""
    old = before.select(key, genre, F.col("rank").alias("lp_rank"))
    out = today.join(old, [key, genre], "left").withColumn("chg", rank_change(F.col("rank"), F.col("lp_rank")))
    return out.withColumn("is_new", F.col("lp_rank").isNull()).join(facts, key, "left")
