"""Derived views. The reference refreshes them by name without showing their text, so
the definitions here are choices: 7-day windows ending at the as-of date."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import back
from cadenza.functions.numeric import fraction_or_zero
from cadenza.operators.keys import rank_per_key
from cadenza.operators.moving import build_view, move_view, row_changes, slide


def entity_stats(streams: DataFrame, key: str, as_of: dt.date, days: int = 7) -> DataFrame:
    """This and last period's streams per entity and the fractional change, 0 for a zero base."""
    date, now, mid = F.col("date"), F.lit(as_of), F.lit(back(as_of, days))
    window = (date > F.lit(back(as_of, 2 * days))) & (date <= now)
    sums = (
        streams.filter(window)
        .groupBy(key)
        .agg(
            F.sum(F.when(date > mid, F.col("streams")).otherwise(0)).alias("tw_streams"),
            F.sum(F.when(date <= mid, F.col("streams")).otherwise(0)).alias("lw_streams"),
        )
    )
    return sums.withColumn("pct_chg", fraction_or_zero("tw_streams", "lw_streams"))


def _weeks(as_of: dt.date, days: int) -> tuple[Column, dict[str, Column]]:
    """The rows of both periods, and what each adds to either sum."""
    date, mid = F.col("date"), F.lit(back(as_of, days))
    inside = (date > F.lit(back(as_of, 2 * days))) & (date <= F.lit(as_of))
    now = lambda c: F.when(c, F.col("streams")).otherwise(0)
    return inside, {"tw_streams": now(date > mid), "lw_streams": now(date <= mid)}


def stats_state(streams: DataFrame, key: str, as_of: dt.date, days: int = 7) -> DataFrame:
    """What ``entity_stats`` needs to be moved on: its sums and the rows behind them."""
    inside, sums = _weeks(as_of, days)
    return build_view(streams.filter(inside), [key], sums)


def move_stats(state: DataFrame, held: DataFrame, fresh: DataFrame, key: str, was: dt.date, as_of: dt.date, days: int = 7) -> DataFrame:
    """The state at ``as_of``, from that at ``was`` (not later) and the table before and after its load.

    First the rows that the load changed within the old window move the sums, then the days
    that enter, leave or change sides. Both only read the dates of the two windows.
    """
    inside, sums = _weeks(was, days)
    state = move_view(state, row_changes(held.filter(inside), fresh.filter(inside), [key, "date"]), [key], sums)
    now, later = _weeks(as_of, days)
    edges = [(back(as_of, 2 * days), back(was, 2 * days)), (back(as_of, days), back(was, days)), (as_of, was)]
    moved = F.lit(False)
    for new, old in edges:
        moved = moved | ((F.col("date") > F.lit(old)) & (F.col("date") <= F.lit(new)))
    changes = slide(fresh.filter(moved & (inside | now)), {n: (sums[n], later[n]) for n in sums}, inside, now)
    return move_view(state, changes, [key], {n: F.col(n) for n in sums})


def stats_of(state: DataFrame, key: str) -> DataFrame:
    """``entity_stats`` from its state."""
    out = state.select(key, "tw_streams", "lw_streams")
    return out.withColumn("pct_chg", fraction_or_zero("tw_streams", "lw_streams"))


def reports_recent(reports: DataFrame, as_of: dt.date) -> DataFrame:
    """The report rows of the as-of date."""
    return reports.filter(F.col("report_date") == F.lit(as_of))


def track_counts(tracks: DataFrame) -> DataFrame:
    """Distinct songs per artist."""
    return tracks.select("artist_id", "song_id").distinct().groupBy("artist_id").agg(F.count(F.lit(1)).alias("track_count"))


def track_collections(tracks: DataFrame) -> DataFrame:
    """Distinct (song, collection) links."""
    return tracks.select("song_id", "collection_id").distinct()


def artist_tracks(tracks: DataFrame, song_stats: DataFrame) -> DataFrame:
    """Each artist's songs ranked by this week's streams."""
    held = tracks.select("artist_id", "song_id").distinct().join(
        song_stats.select("song_id", "tw_streams"), "song_id", "left"
    )
    order = [F.col("tw_streams").desc_nulls_last(), F.col("song_id").asc()]
    return rank_per_key(held, ["artist_id"], order, "rnk")


def denormalise(meta: DataFrame, key: str, parts: Sequence[DataFrame]) -> DataFrame:
    """The wide entity view: meta with stats, reports, profile and territory columns, one row each."""
    out = meta
    for part in parts:
        clash = [c for c in part.columns if c in out.columns and c != key]
        out = out.join(part.drop(*clash), key, "left")
    return out


def daily_report(songs: DataFrame, stats: DataFrame, reports: DataFrame, profiles: DataFrame, as_of: dt.date) -> DataFrame:
    """Songs of the latest report with their stats and profile."""
    latest = reports_recent(reports, as_of).select("song_id", "tw_rank", "signed", "report_date")
    return denormalise(latest.join(songs, "song_id"), "song_id", [stats, profiles])
