"""Projects (albums): dominant artist, images, daily and weekly totals, recent report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import back
from cadenza.functions.numeric import fraction_or_zero, lifetime_revenue, present, yearly_revenue
from cadenza.functions.text import contains_any_word
from cadenza.operators.keys import keep_keys, mode_per_key
from cadenza.operators.maintain import patch
from cadenza.session import materialise

# What makes an album a compilation, and what makes a project valid.
COMPILATION_WORDS = ["best of", "the greatest", "the best"]
MIN_TRACKS = 4
MIN_CONFIDENCE = 0.5


def project_meta(collections: DataFrame, tracks: DataFrame, album_type: str = "Album") -> DataFrame:
    """Each collection with its dominant artist, track count, that artist's share, and validity.

    ``tracks`` is the (song, artist, collection) map. Two aggregations on the ids alone
    find the artist, its count and the total; the descriptive columns join afterwards.
    """
    per_artist = tracks.groupBy("collection_id", "artist_id").agg(F.count(F.lit(1)).alias("n"))
    main = per_artist.groupBy("collection_id").agg(
        F.sum("n").alias("track_count"), F.min(F.struct((-F.col("n")).alias("n"), "artist_id")).alias("__m")
    )
    count = (-F.col("__m.n")).cast("decimal(18,0)")
    main = main.select(
        "collection_id",
        F.col("__m.artist_id").alias("artist_id"),
        "track_count",
        (-F.col("__m.n")).alias("num_artist_tracks"),
        F.round(count / F.col("track_count").cast("decimal(18,0)"), 1).cast("double").alias("confidence"),
    )
    out = main.join(collections, "collection_id")
    valid = (
        (F.col("num_artist_tracks") > MIN_TRACKS)
        & (F.col("confidence") > MIN_CONFIDENCE)
        & (F.col("type") == album_type)
        & ~contains_any_word(F.col("name"), COMPILATION_WORDS)
    )
    return out.withColumn("is_valid", F.coalesce(valid, F.lit(False)))


def project_images(projects: DataFrame, links: DataFrame, images: DataFrame) -> DataFrame:
    """Give projects without an image the most frequent one among their songs.

    ``links`` is (song_id, collection_id) per track, ``images`` is (song_id, image).
    """
    bare = projects.filter(F.col("image").isNull())
    # hashed, so that the links stream by and are not sorted beside the counts of the images
    used = keep_keys(links, bare, ["collection_id"], hashed=True).join(images.filter(present("image")), "song_id")
    best = mode_per_key(used, ["collection_id"], "image")
    return patch(projects, best, ["collection_id"], ["image"])


def project_daily(links: DataFrame, streams: DataFrame, as_of: dt.date, days: int = 10) -> DataFrame:
    """Daily streams per collection over the trailing days. ``links`` must be distinct."""
    recent = streams.filter(F.col("date") > F.lit(back(as_of, days)))
    daily = recent.groupBy("song_id", "date").agg(F.sum("streams").alias("streams"))
    # a few days a song: as the hashed side of the join, the links stream by and are not sorted
    return links.join(daily.hint("shuffle_hash"), "song_id").groupBy("collection_id", "date").agg(F.sum("streams").alias("streams"))


def project_weekly(links: DataFrame, stats: DataFrame) -> DataFrame:
    """Week totals, run-rate and lifetime revenue and growth per collection.

    ``stats`` is (song_id, tw_streams, lw_streams, rtd_oda_streams).
    """
    zero = F.lit(0)
    sums = (
        links.join(stats, "song_id")
        .groupBy("collection_id")
        .agg(*[F.sum(F.coalesce(c, zero)).alias(c) for c in ("tw_streams", "lw_streams", "rtd_oda_streams")])
    )
    return sums.withColumns(
        {
            "est_revenue_per_year": yearly_revenue("tw_streams"),
            "est_total_revenue": lifetime_revenue("rtd_oda_streams"),
            "pct_chg": fraction_or_zero("tw_streams", "lw_streams"),
        }
    )


def refresh_weekly(projects: DataFrame, weekly: DataFrame) -> DataFrame:
    """Patch the project dimension with the week's totals; projects without songs keep theirs."""
    measures = [c for c in weekly.columns if c != "collection_id"]
    return patch(projects, weekly, ["collection_id"], measures)


def project_recent(
    reports: DataFrame,
    songs: DataFrame,
    tracks: DataFrame,
    artists: DataFrame,
    collections: DataFrame,
    images: DataFrame,
    album_type: str = "Album",
) -> DataFrame:
    """The recent album report: modal genre, artist and image, totals, enough tracks of one artist.

    The (collection, song, artist) rows are counted once per combination; the totals and
    the three modes come from those counts.
    """
    albums = collections.filter(
        (F.col("type") == album_type) & ~contains_any_word(F.col("name"), COMPILATION_WORDS)
    )
    key = "collection_id"
    facts = (
        reports.select("song_id", "rtd_oda_streams", "tw_oda_streams")
        .join(songs.select("song_id", "core_genre"), "song_id")
        .join(images, "song_id")
    )
    wanted = tracks.filter(F.col(key).isNotNull() & F.col("artist_id").isNotNull()).join(albums.select(key), key, "left_semi")
    base = wanted.join(facts, "song_id")
    combos = base.groupBy(key, "artist_id", "core_genre", "image").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rtd_oda_streams").alias("rtd"), F.sum("tw_oda_streams").alias("tw")
    )
    combos = materialise(combos, "combos")

    def mode(value: str) -> DataFrame:
        counts = combos.groupBy(key, value).agg(F.sum(F.when(F.col(value).isNotNull(), F.col("n")).otherwise(0)).alias("n"))
        best = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), value)).alias("__b"))
        return best.select(key, F.col(f"__b.{value}").alias(value))

    per_artist = combos.groupBy(key, "artist_id").agg(F.sum("n").alias("n"), F.sum("rtd").alias("rtd"), F.sum("tw").alias("tw"))
    totals = per_artist.groupBy(key).agg(
        F.sum("rtd").alias("rtd_oda_streams"),
        F.sum("tw").alias("tw_streams"),
        F.sum("n").alias("rows"),
        F.min(F.struct((-F.col("n")).alias("n"), "artist_id")).alias("__m"),
    )
    share = F.try_divide((-F.col("__m.n")).cast("double"), F.col("rows").cast("double"))
    kept = totals.filter((F.col("rows") > MIN_TRACKS) & (share > MIN_CONFIDENCE)).select(
        key, "rtd_oda_streams", "tw_streams", F.col("__m.artist_id").alias("artist_id")
    )
    return (
        kept.join(albums, key)
        .join(mode("core_genre"), key)
        .join(mode("image"), key)
        .join(artists.select("artist_id", "artist"), "artist_id")
    )
