"""Genre dimension, daily genre streams and the derived genre views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import back
from cadenza.functions.numeric import percent_or_zero
from cadenza.operators.charts import ReentryRule, next_edition, sparkline
from cadenza.operators.keys import assign_ids, global_rank, not_in, rank_per_key
from cadenza.operators.maintain import replace_window
from cadenza.operators.moving import COUNT, build_view, move_view, row_changes
from cadenza.operators.reshape import unpack
from cadenza.operators.timegrid import streaks, weekly_sums
from cadenza.plans.rollups import overlap


def entity_genres(profiles: DataFrame, key: str = "artist_id", packed: str = "genres") -> DataFrame:
    """Distinct (key, genre) from slash-separated lists."""
    return unpack(profiles.select(key, packed), packed, "genre").select(key, "genre").distinct()


def new_genres(profiles: DataFrame, known: DataFrame, packed: str = "genres") -> DataFrame:
    """Genres in use that the dimension lacks."""
    used = unpack(profiles.select(packed).distinct(), packed, "genre").select("genre").distinct()
    return not_in(used, known, ["genre"])


def extend_genres(profiles: DataFrame, known: DataFrame, packed: str = "genres") -> DataFrame:
    """The genre dimension (genre, genre_id) with new genres numbered on."""
    return assign_ids(known, new_genres(profiles, known, packed), "genre", "genre_id")


def genre_daily(genres_of: DataFrame, streams: DataFrame, since: dt.date, key: str = "artist_id") -> DataFrame:
    """Streams per genre and day after ``since``; an entity counts in each of its genres.

    Streams are summed per entity and day before they fan out to genres.
    """
    recent = streams.filter(F.col("date") > F.lit(since))
    daily = recent.groupBy(key, "date").agg(F.sum("streams").alias("streams"))
    return daily.join(genres_of, key).groupBy("genre", "date").agg(F.sum("streams").alias("streams"))


def refresh_genre_streams(
    current: DataFrame, genres_of: DataFrame, streams: DataFrame, dimension: DataFrame, as_of: dt.date, days: int = 7
) -> DataFrame:
    """Replace the trailing window of the genre stream table."""
    since = back(as_of, days)
    fresh = genre_daily(genres_of, streams, since).join(dimension, "genre", "left")
    return replace_window(current, fresh.select(*current.columns), since)


def genre_artists(genres_of: DataFrame, stats: DataFrame, key: str = "artist_id") -> DataFrame:
    """Entities per genre ranked by this week's streams."""
    held = genres_of.join(stats.select(key, "tw_streams"), key, "left")
    order = [F.col("tw_streams").desc_nulls_last(), F.col(key).asc()]
    return rank_per_key(held, ["genre"], order, "rnk")


def genre_stats(genres_of: DataFrame, stats: DataFrame, key: str = "artist_id") -> DataFrame:
    """Per genre: this and last week, artist count, mean, ``volume`` and ``growth``.

    The reference leaves the last two undefined. Here volume is the genre's share of all
    genre streams in percent and growth the percent change on last week.
    """
    joined = genres_of.join(stats.select(key, "tw_streams", "lw_streams"), key)
    return genre_figures(genre_state(joined))


def genre_state(rows: DataFrame) -> DataFrame:
    """The sums and row counts by genre of (genre, tw_streams, lw_streams)."""
    return build_view(rows, ["genre"], _genre_sums())


def _genre_sums() -> dict[str, Column]:
    return {c: F.col(c) for c in ("tw_streams", "lw_streams")}


def move_genres(state: DataFrame, genres_of: DataFrame, held: DataFrame, fresh: DataFrame, key: str = "artist_id") -> DataFrame:
    """The genre sums after artists' stats went from ``held`` to ``fresh``: only artists whose
    numbers differ are joined with their genres. ``state`` is that of ``genre_state``."""
    columns = [key, "tw_streams", "lw_streams"]
    changes = row_changes(held.select(*columns), fresh.select(*columns), [key])
    return move_view(state, changes.join(genres_of, key), ["genre"], _genre_sums())


def genre_figures(sums: DataFrame) -> DataFrame:
    """The figures of ``genre_stats`` from the sums and row counts by genre."""
    sums = sums.withColumnRenamed(COUNT, "artists_count")
    total = sums.agg(F.sum("tw_streams")).scalar()
    return sums.withColumns(
        {
            "avg_tw_streams": F.try_divide(F.col("tw_streams"), F.col("artists_count")),
            "volume": F.round(F.try_divide(F.col("tw_streams") * F.lit(100.0), total), 6),
            "growth": percent_or_zero("tw_streams", "lw_streams"),
        }
    )


def genre_overlap(genres_of: DataFrame, key: str = "artist_id") -> DataFrame:
    """Overlap coefficient of every two genres that share an entity."""
    return overlap(genres_of, "genre", key, "c_genre")


def genre_sparklines(daily: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Recent daily sums per genre as JSON."""
    window = (F.col("date") > F.lit(back(as_of, days))) & (F.col("date") <= F.lit(as_of))
    return sparkline(daily.filter(window), ["genre"], "streams")


def long_term_genre_ranks(daily: DataFrame, dimension: DataFrame, as_of: dt.date, days: int = 365) -> DataFrame:
    """All genres ranked by positive weeks over a year; genres without streams have -1 and come last."""
    weeks = streaks(weekly_sums(daily, ["genre"], "streams", as_of, days), ["genre"], "streams")
    held = dimension.select("genre").join(weeks.select("genre", "num_positive_weeks"), "genre", "left")
    held = held.withColumn("num_positive_weeks", F.coalesce("num_positive_weeks", F.lit(-1)).cast("bigint"))
    return global_rank(held, [F.col("num_positive_weeks").desc(), F.col("genre").asc()], "rnk")


def genre_chart(daily: DataFrame, dimension: DataFrame, previous: DataFrame | None, rule: ReentryRule, as_of: dt.date) -> DataFrame:
    return next_edition(long_term_genre_ranks(daily, dimension, as_of), previous, ["genre"], rule, as_of)


def growing_genres(chart: DataFrame, stats: DataFrame) -> DataFrame:
    """Genres in the outer cut with their stats, best first."""
    listed = chart.filter("is_top_100").withColumn("is_new", F.col("should_notify") > 0)
    facts = stats.withColumnRenamed("avg_tw_streams", "avg_tw_streams_per_artist")
    return listed.join(facts, "genre", "left").orderBy("rnk")


def new_artists_in_genres(chart: DataFrame, artists: DataFrame, profiles: DataFrame) -> DataFrame:
    """Artists whose notice is up in some genre, ranked there today, and who have streams."""
    noted = chart.filter((F.col("should_notify") > 0) & F.col("rnk").isNotNull()).withColumnRenamed("rnk", "genre_rnk").drop("tw_streams")
    held = noted.join(artists.filter(F.col("tw_streams") > 0), "artist_id")
    return held.join(profiles.select("artist_id", "copyrights"), "artist_id", "left")
