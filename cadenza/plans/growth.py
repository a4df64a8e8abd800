"""Growth reports over weekly buckets."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import months_back
from cadenza.operators.keys import keep_keys
from cadenza.operators.timegrid import calendar_weekly_sums, streaks, weekly_sums

EIGHT_WEEKS = 64  # fixed value: days before the as-of date, both ends excluded

# The genre sets of the two long-term reports, their stream floors and months.
ROOTS_GENRES = [
    "alternative americana", "alternative country", "american folk revival", "bluegrass", "canadian americana",
    "canadian contemporary country", "canadian country", "canadian singer-songwriter", "classic texas country",
    "cosmic american", "denton tx indie", "folk", "jam band", "jamgrass", "kentucky indie", "kentucky roots",
    "mississippi indie", "modern country pop", "modern southern rock", "nashville singer-songwriter",
    "neo-traditional bluegrass", "new americana", "ok indie", "outlaw country", "progressive bluegrass", "red dirt",
    "roots americana", "roots rock", "saskatchewan indie", "singer-songwriter", "southern americana",
    "southern rock", "texas country", "tulsa indie", "west virginia indie",
]
INDIE_GENRES = [
    "alternative country", "alt z", "art pop", "classic country pop", "contemporary country", "country",
    "country dawn", "country pop", "country road", "country rock", "deep new americana", "dream pop", "electropop",
    "folk", "freak folk", "garage pop", "garage psych", "indiecoustica", "indie electropop", "indie folk",
    "modern alternative rock", "modern country rock", "modern rock", "neo-psychedelic", "new americana",
    "outlaw country", "post-punk", "red dirt", "roots americana", "vapor soul", "classic oklahoma country",
    "stomp and holler", "texas country", "oklahoma country", "pov: indie",
]
ROOTS_FLOOR = 50_000
INDIE_FLOOR = 100_000
LONG_TERM_MONTHS = 6


def eight_week_growth(
    streams: DataFrame,
    entities: DataFrame,
    key: str,
    as_of: dt.date,
    floor: int = 100_000,
    min_weeks: int = 4,
    days: int = EIGHT_WEEKS,
) -> DataFrame:
    """Unsigned entities above ``floor`` that grew in most of the last eight weeks.

    ``entities`` is the denormalised view (``key``, ``tw_streams``, ``signed``, …); its
    columns are returned with the streak measures. Not sorted: see :func:`by_strength`.
    Streams are summed to weeks before anything is joined, so an entity costs at most
    one row per week and map task in the shuffle, however hot it is.
    """
    chosen = entities.filter((F.col("tw_streams") > floor) & (F.col("signed") == F.lit(False)))
    strong = streaks(weekly_sums(streams, [key], "streams", as_of, days), [key], "streams").filter(
        (F.col("rolling_pct_chg") > 0) & (F.col("num_positive_weeks") > min_weeks)
    )
    return strong.join(chosen, key)


def by_strength(report: DataFrame, key: str) -> DataFrame:
    return report.orderBy(F.col("num_positive_weeks").desc(), F.col("rolling_pct_chg").desc(), F.col(key).asc())


def genre_set_growth(
    streams: DataFrame,
    genre_artists: DataFrame,
    entities: DataFrame,
    genres: Sequence[str],
    since: dt.date,
    floor: int,
    min_weeks: int = 10,
) -> DataFrame:
    """Unsigned artists of a genre set with more than ``min_weeks`` rising calendar weeks.

    An artist in several listed genres counts once. The first week counts when it has
    any streams.
    """
    members = genre_artists.filter(F.col("genre").isin(list(genres)))
    unsigned = entities.filter((F.col("signed") == F.lit(False)) & (F.col("tw_streams") > floor))
    chosen = keep_keys(unsigned, members, ["artist_id"])
    weeks = streaks(calendar_weekly_sums(streams, ["artist_id"], "streams", since), ["artist_id"], "streams", True)
    positive = weeks.select("artist_id", F.col("num_positive_weeks").alias("positive_weeks"))
    return positive.filter(F.col("positive_weeks") > min_weeks).join(chosen, "artist_id")


def indie_long_term(streams: DataFrame, genre_artists: DataFrame, entities: DataFrame, as_of: dt.date) -> DataFrame:
    """Half a year of rising weeks among indie genres."""
    since = months_back(as_of, LONG_TERM_MONTHS)
    return genre_set_growth(streams, genre_artists, entities, INDIE_GENRES, since, INDIE_FLOOR)


def roots_long_term(
    streams: DataFrame, genre_artists: DataFrame, entities: DataFrame, artist_tracks: DataFrame, songs: DataFrame, as_of: dt.date
) -> DataFrame:
    """The same among roots genres, with each artist's first and last release."""
    since = months_back(as_of, LONG_TERM_MONTHS)
    report = genre_set_growth(streams, genre_artists, entities, ROOTS_GENRES, since, ROOTS_FLOOR)
    return with_release_span(report, artist_tracks, songs)


def with_release_span(report: DataFrame, artist_tracks: DataFrame, songs: DataFrame) -> DataFrame:
    """Add the first and last release date over each artist's songs; artists without drop out."""
    tracks = keep_keys(artist_tracks, report, ["artist_id"])
    span = (
        tracks.join(songs.select("song_id", "release_date"), "song_id")
        .groupBy("artist_id")
        .agg(F.min("release_date").alias("min_release_date"), F.max("release_date").alias("max_release_date"))
    )
    return report.join(span, "artist_id")
