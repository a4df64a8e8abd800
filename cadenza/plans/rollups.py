"""Territory rollups: ex-home, worldwide, totals, overlap, daily sums."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import back
from cadenza.functions.numeric import percent_or_zero
from cadenza.operators.keys import global_rank, keep_keys
from cadenza.operators.maintain import patch, upsert

MEASURES = ("tw_streams", "lw_streams", "ytd_streams", "rtd_streams", "digital_song_sales_tw")


def _ranked(sums: DataFrame, key: str) -> DataFrame:
    ranked = global_rank(sums, [F.col("tw_streams").desc_nulls_last(), F.col(key).asc()], "rnk")
    return ranked.withColumn("pct_chg", percent_or_zero("tw_streams", "lw_streams"))


def ex_home(stats: DataFrame, key: str, rollup_ids: Sequence[int], ex_home_id: int) -> DataFrame:
    """Sum over the real territories (the stored rollup rows left out), rank, growth."""
    measures = [m for m in MEASURES if m in stats.columns]
    sums = (
        stats.filter(~F.col("global_id").isin(list(rollup_ids)))
        .groupBy(key)
        .agg(*[F.sum(m).alias(m) for m in measures])
    )
    return _ranked(sums, key).withColumn("global_id", F.lit(ex_home_id))


def worldwide(ex: DataFrame, home: DataFrame, key: str, world_id: int, with_rtd: bool = True) -> DataFrame:
    """Ex-home plus home stats, each missing side as 0; year-to-date and sales are 0."""
    measures = ["tw_streams", "lw_streams"] + (["rtd_streams"] if with_rtd else [])
    h = home.select(key, *[F.col(m).alias(f"__h_{m}") for m in measures])
    sums = ex.select(key, *measures).join(h, key, "full")
    zero = F.lit(0)
    sums = sums.select(
        key, *[(F.coalesce(m, zero) + F.coalesce(f"__h_{m}", zero)).alias(m) for m in measures]
    )
    out = _ranked(sums, key).withColumn("global_id", F.lit(world_id))
    for name in ("ytd_streams", "digital_song_sales_tw", *(() if with_rtd else ("rtd_streams",))):
        out = out.withColumn(name, F.lit(0).cast("bigint"))
    return out


def store_rollups(current: DataFrame, key: str, *rollups: DataFrame) -> DataFrame:
    """Upsert rollup rows into the territory stats they were computed from."""
    for rollup in rollups:
        measures = [c for c in current.columns if c in rollup.columns and c not in ("global_id", key)]
        current = upsert(current, rollup.select("global_id", key, *measures), ["global_id", key], measures)
    return current


def refresh_territories(territories: DataFrame, stats: DataFrame) -> DataFrame:
    """Patch the territory dimension with its totals, growth and rank."""
    totals = territory_totals(stats)
    measures = [c for c in totals.columns if c in territories.columns and c != "global_id"]
    return patch(territories, totals, ["global_id"], measures)


def territory_totals(stats: DataFrame) -> DataFrame:
    """Totals per territory, rollup rows included, ranked by this week."""
    measures = [m for m in MEASURES[:4] if m in stats.columns]
    sums = stats.groupBy("global_id").agg(*[F.sum(m).alias(m) for m in measures])
    return _ranked(sums, "global_id")


def overlap(df: DataFrame, item: str, member: str, other: str) -> DataFrame:
    """``100 * |A and B| / min(|A|, |B|)`` for every pair of items that share a member.

    Members with the same set of items are counted once per set, so a popular
    combination costs one row whatever its size. Half the pairs are built, then mirrored.
    """
    sets = df.groupBy(member).agg(F.sort_array(F.collect_set(item)).alias("__set"))
    kinds = sets.groupBy("__set").agg(F.count(F.lit(1)).alias("__n"))
    sizes = kinds.select(F.explode("__set").alias(item), "__n").groupBy(item).agg(F.sum("__n").alias("__size"))
    halves = kinds.select("__n", "__set", F.posexplode("__set").alias("__pos", item)).select(
        item, "__n", F.explode(F.slice("__set", F.col("__pos") + 2, F.size("__set"))).alias(other)
    )
    shared = halves.groupBy(item, other).agg(F.sum("__n").alias("instance_count"))
    both = shared.unionByName(shared.select(F.col(other).alias(item), F.col(item).alias(other), "instance_count"))
    mine = sizes.withColumnRenamed("__size", "__a")
    theirs = sizes.select(F.col(item).alias(other), F.col("__size").alias("__b"))
    least = F.least("__a", "__b").cast("decimal(18,0)")
    share = F.round(F.try_divide(F.col("instance_count").cast("decimal(18,0)") * 100, least), 0)
    return (
        both.join(mine, item)
        .join(theirs, other)
        .select(item, other, share.cast("int").alias("correlation"), "instance_count")
    )


def territory_daily(streams: DataFrame, stats: DataFrame, as_of: dt.date, days: int = 14) -> DataFrame:
    """Daily sums per territory over the entities that chart there.

    ``streams`` is long: (artist_id, date, global_id, streams).
    """
    recent = streams.filter(F.col("date") > F.lit(back(as_of, days)))
    daily = recent.groupBy("global_id", "artist_id", "date").agg(F.sum(F.coalesce("streams", F.lit(0))).alias("streams"))
    held = keep_keys(daily, stats, ["global_id", "artist_id"])
    return held.groupBy("global_id", "date").agg(F.sum("streams").alias("streams"))
