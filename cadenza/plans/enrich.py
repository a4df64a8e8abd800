"""Enrichment from landed service data: id maps, caches, lookups, patches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.functions.numeric import id_text, present
from cadenza.operators.keys import keep_keys, mode_per_key, not_in, top_per_key, with_fallback
from cadenza.operators.maintain import append, patch, upsert
from cadenza.operators.reshape import attributes_to_columns
from cadenza.sources.nested import with_audio_features

# Account kinds of the cross-platform directory.
ACCOUNT_KINDS = {
    1: "twitter_id",
    2: "instagram_id",
    3: "youtube_id",
    6: "gtrends_id",
    7: "soundcloud_id",
    16: "shazam_id",
    17: "genius_id",
    19: "tiktok_id",
    20: "twitch_id",
}
DEFAULT_COLOUR = "#000000"
RECACHE_SIZE = 2000  # fixed value


def platform_ids(wanted: DataFrame, directory: DataFrame) -> DataFrame:
    """One column per platform for every wanted target.

    ``directory`` is (target_id, type, account_id).
    """
    wide = attributes_to_columns(directory, ["target_id"], "type", "account_id", ACCOUNT_KINDS)
    return wanted.join(wide, "target_id", "left")


def refresh_id_map(current: DataFrame, artists: DataFrame, directory: DataFrame, incremental: bool = True) -> DataFrame:
    """Upsert the id map by artist; the incremental form only looks at unmapped artists.

    ``artists`` is (artist_id, target_id, …); the target id is kept as text.
    """
    todo = not_in(artists, current, ["artist_id"]) if incremental else artists
    found = platform_ids(todo, directory).withColumn("target_id", id_text("target_id"))
    return upsert(current, found.select(*[c for c in current.columns if c in found.columns]), ["artist_id"])


def profile_candidates(artists: DataFrame, cached: DataFrame, tracks: DataFrame, songs: DataFrame) -> DataFrame:
    """The platform id that most of an uncached, home artist's songs point to (null without songs)."""
    todo = not_in(artists.filter(F.col("is_global") == F.lit(False)), cached, ["artist_id"]).select("artist_id")
    seen = keep_keys(tracks, todo, ["artist_id"]).join(songs, "song_id")
    best = mode_per_key(seen.filter(F.col("platform_artist_id").isNotNull()), ["artist_id"], "platform_artist_id")
    return todo.join(best.select("artist_id", "platform_artist_id"), "artist_id", "left")


def extend_cache(cache: DataFrame, wanted: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Append landed objects for the wanted keys that the cache lacks. Blank keys are left out."""
    todo = not_in(wanted.filter(present(key)).select(key).distinct(), cache, [key])
    return append(cache, landed.join(todo, key, "left_semi").select(*[c for c in cache.columns if c in landed.columns]))


def enriched_tracks(wanted: DataFrame, tracks: DataFrame, albums: DataFrame, features: DataFrame) -> DataFrame:
    """Wanted songs (song_id, isrc) with flat track, album and audio columns.

    ``tracks``, ``albums`` and ``features`` are the flattened landed objects. Of several
    tracks with one code the most popular is taken; missing whole numbers are 0.
    """
    best = top_per_key(tracks, ["isrc"], "popularity", "track_id")
    about = albums.select("album_id", "album_name", "copyrights", F.col("label").alias("album_label"), "upc")
    rows = wanted.filter(present("isrc")).join(best, "isrc").join(about, "album_id", "left")
    return with_audio_features(rows, features)


def cache_songs(cache: DataFrame, songs: DataFrame, tracks: DataFrame, albums: DataFrame, features: DataFrame) -> DataFrame:
    """Enrich the songs the cache lacks and append them."""
    todo = not_in(songs, cache, ["song_id"])
    rows = enriched_tracks(todo, tracks, albums, features)
    return append(cache, rows.select(*[c for c in cache.columns if c in rows.columns]))


def song_facts(wanted: DataFrame, profiles: DataFrame, extra: DataFrame, reports: DataFrame, stats: DataFrame) -> DataFrame:
    """What is known per recording code: from the song profiles, else from the extra cache.

    Of several songs with one code the most streamed is kept.
    """
    keys = wanted.filter(present("isrc")).select("isrc")
    base = profiles.select("song_id", "isrc", "copyrights")
    base = base.join(reports.select("song_id", "signed"), "song_id", "left")
    base = base.join(stats.select("song_id", "tw_streams", "lw_streams", "pct_chg"), "song_id", "left")
    base = base.withColumn("signed", F.coalesce("signed", F.lit(False)))
    more = extra.select("isrc", "copyrights").withColumn("signed", F.lit(False))
    return top_per_key(with_fallback(keys, base, more, ["isrc"]), ["isrc"], "tw_streams", "song_id")


def artist_facts(wanted: DataFrame, profiles: DataFrame, artists: DataFrame, stats: DataFrame) -> DataFrame:
    """What is known per platform artist id, with zeros for missing numbers; the most streamed wins."""
    keys = wanted.filter(present("platform_artist_id")).select("platform_artist_id").distinct()
    held = profiles.select("platform_artist_id", "artist_id", "copyrights").join(keys, "platform_artist_id")
    held = held.join(artists.select("artist_id", "signed"), "artist_id", "left")
    held = held.join(stats.select("artist_id", "tw_streams", "lw_streams", "pct_chg"), "artist_id", "left")
    held = held.withColumn("signed", F.coalesce("signed", F.lit(False))).fillna(0, ["tw_streams", "lw_streams", "pct_chg"])
    return top_per_key(held, ["platform_artist_id"], "tw_streams", "artist_id")


def stalest(profiles: DataFrame, key: str, size: int = RECACHE_SIZE) -> DataFrame:
    """The ``size`` keys that were refreshed longest ago."""
    ages = profiles.groupBy(key).agg(F.min("last_updated").alias("last_updated"))
    return ages.orderBy(F.col("last_updated").asc_nulls_first(), F.col(key).asc()).limit(size)


def recache(profiles: DataFrame, fresh: DataFrame, key: str, columns: Sequence[str], now) -> DataFrame:
    """Patch the stalest profiles from freshly landed objects and stamp them."""
    chosen = fresh.join(stalest(profiles, key).select(key), key, "left_semi")
    stamped = chosen.withColumn("last_updated", F.lit(now)).fillna(0, [c for c in ("followers", "popularity") if c in columns])
    return patch(profiles, stamped, [key], [*columns, "last_updated"])


def patch_colours(entities: DataFrame, colours: DataFrame, key: str, default: str = DEFAULT_COLOUR) -> DataFrame:
    """Set the colour of rows that still have the default and whose image was analysed.

    ``colours`` is (image, colour), one row per image address.
    """
    bare = entities.filter((F.col("dominant_color") == default) & present("image")).select(key, "image")
    found = bare.join(colours, "image").select(key, F.col("colour").alias("dominant_color"))
    return patch(entities, found, [key], ["dominant_color"])
