"""Feed files to tables: clean, split, reshape, load."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import back, date_headers, header_date, parse_date
from cadenza.functions.numeric import id_text
from cadenza.functions.text import territory_key
from cadenza.operators.keys import assign_ids, first_per_key, rank_per_key
from cadenza.operators.maintain import Changes, append, change_only, insert_absent, patch, unique_delta, upsert
from cadenza.operators.reshape import melt_dates, melt_series
from cadenza.plans.views import track_collections, track_counts
from cadenza.session import materialise
from cadenza.sources.buckets import BucketedTable, Merge, upsert_buckets
from cadenza.sources.contracts import (
    ARTIST_COLUMNS,
    DAY_COLUMN,
    LIFETIME_PREFIX,
    PRIOR_DAY_COLUMN,
    SERIES_SUFFIX,
    SONG_COLUMNS,
    WEEKLY_COLUMNS,
)
from cadenza.sources.files import ORDINAL

LOOK_BACK = 20  # fixed value: days of stored streams a daily file is compared with
UNKNOWN = "Unknown"

ARTIST_META = [
    "tw_rank", "tw_oda_streams", "rtd_oda_streams", "tw_album_sales", "rtd_album_sales",
    "tw_digital_track_sales", "rtd_digital_track_sales", "tw_odv", "rtd_odv",
]
SONG_META = [
    "tw_rank", "tw_oda_streams", "rtd_oda_streams", "rtd_oda_streams_premium",
    "rtd_oda_streams_ad_supported", "tw_digital_track_sales", "atd_digital_track_sales", "tw_odv", "atd_odv",
]


def _whole(name: str) -> Column:
    return F.col(name).cast("double").cast("bigint").alias(name)


def _first_rows(df: DataFrame, key: str) -> DataFrame:
    """Rows with a key, the first of each key in file order, key as plain text."""
    named = df.withColumn(key, id_text(key)).filter(F.col(key).isNotNull())
    return first_per_key(named, [key], [F.col(ORDINAL).asc()])


def _or_unknown(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(UNKNOWN)).alias(name)


def daily_artists(raw: DataFrame, report_id: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A daily artist file to (meta, streams): one report row per artist, one row per artist and day."""
    dates = {header_date(h): h for h in date_headers(raw.columns)}
    rows = _first_rows(raw.withColumnsRenamed(ARTIST_COLUMNS), "unified_artist_id")
    meta = rows.select(
        "unified_artist_id",
        _or_unknown("artist"),
        *[_whole(c) for c in ARTIST_META],
        F.lit(False).alias("signed"),
        F.lit(report_id).cast("string").alias("report_id"),
        F.lit(next(iter(dates))).alias("report_date"),
    )
    return meta, melt_dates(rows, ["unified_artist_id"], dates, "streams")


def daily_songs(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A daily song file to (meta, streams) with total, premium and ad-supported streams."""
    series: dict[str, dict[dt.date, str]] = {}
    for name, suffix in SERIES_SUFFIX.items():
        heads = [c for c in raw.columns if c.endswith(suffix)]
        series[name] = {header_date(h.removesuffix(suffix)): h for h in heads}
    newest = next(iter(series["streams"]))
    rows = _first_rows(raw.withColumnsRenamed(SONG_COLUMNS), "unified_song_id")
    meta = rows.select(
        "unified_song_id",
        _or_unknown("artist"),
        _or_unknown("title"),
        "label",
        "core_genre",
        F.coalesce(parse_date(F.col("release_date")), F.lit(newest)).alias("release_date"),
        "isrc",
        *[_whole(c) for c in SONG_META],
        F.lit(False).alias("signed"),
        F.lit(newest).alias("report_date"),
    )
    return meta, melt_series(rows, ["unified_song_id"], series)


def territory_daily(raw: DataFrame, key: str, names: Sequence[str], date: dt.date, territory: str) -> tuple[DataFrame, DataFrame]:
    """A daily territory file to (meta, streams): the named day and the day before, in long layout."""
    source = {"UnifiedArtistID": "unified_artist_id", "UnifiedSongID": "unified_song_id", "Artist": "artist"}
    source |= {"Title": "title", "Top ISRC": "isrc"}
    rows = _first_rows(raw.withColumnsRenamed(source), key)
    required = [_or_unknown(n) if n in ("artist", "title") else F.col(n) for n in names]
    meta = rows.select(key, *required, F.lit(True).alias("is_global"))
    days = {date: DAY_COLUMN, back(date, 1): PRIOR_DAY_COLUMN}
    streams = melt_dates(rows, [key], days, "streams").withColumn("territory", F.lit(territory))
    return meta, streams


def territory_weekly(raw: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """Weekly territory files to stats; rank is the place in the file after removing repeats."""
    lifetime = next(c for c in raw.columns if re.match(re.escape(LIFETIME_PREFIX), c))
    source = {"UnifiedArtistID": "unified_artist_id", "UnifiedSongID": "unified_song_id", "Artist": "artist"}
    source |= {"Title": "title", "Top ISRC": "isrc", lifetime: "rtd_streams", **WEEKLY_COLUMNS}
    rows = raw.withColumnsRenamed(source).withColumn("country", territory_key(F.col("country")))
    rows = rows.withColumn(key, id_text(key))
    required = [_or_unknown(n) if n in ("artist", "title") else F.col(n) for n in names]
    whole = ["tw_streams", "lw_streams", "ytd_streams", "rtd_streams", "digital_song_sales_tw"]
    pct = F.replace("pct_chg", F.lit("%"), F.lit("")).cast("double").alias("pct_chg")
    rows = rows.select("country", key, *required, pct, *[_whole(c) for c in whole], ORDINAL)
    unique = first_per_key(rows, ["country", key], [F.col(ORDINAL).asc()])
    return rank_per_key(unique, ["country"], [F.col(ORDINAL).asc()], "rnk").drop(ORDINAL)


def _mapping(raw: DataFrame, names: dict[str, str], ids: Sequence[str], unique: Sequence[str]) -> DataFrame:
    rows = raw.withColumnsRenamed(names)
    rows = rows.withColumns({c: id_text(c) for c in ids})
    return first_per_key(rows, unique, [F.col(ORDINAL).asc()])


def mapping_links(raw: DataFrame) -> DataFrame:
    """Song, artist, collection triples."""
    names = {
        "UnifiedSongID": "unified_song_id",
        "Unified Artist ID": "unified_artist_id",
        "Unified Collection ID": "unified_collection_id",
    }
    ids = list(names.values())
    return _mapping(raw, names, ids, ids).select(*ids)


def mapping_artists(raw: DataFrame) -> DataFrame:
    names = {
        "Unified Artist ID": "unified_artist_id",
        "Primary Artist ID": "primary_artist_id",
        "Unified Artist Name": "unified_artist_name",
        "Primary Artist Name": "primary_artist_name",
    }
    ids = ["unified_artist_id", "primary_artist_id"]
    return _mapping(raw, names, ids, ids).select(*names.values())


def mapping_collections(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """Collections with name, type and release date (the as-of date where missing)."""
    names = {
        "Unified Collection ID": "unified_collection_id",
        "Unified Collection Name": "name",
        "Barcode Release Date": "release_date",
        "Collection Type": "type",
    }
    key = "unified_collection_id"
    rows = _mapping(raw, names, [key], [key])
    return rows.select(key, "name", F.coalesce(parse_date(F.col("release_date")), F.lit(as_of)).alias("release_date"), "type")


def mapping_songs(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per recording code; a missing title is empty."""
    names = {
        "UnifiedSongid": "unified_song_id",
        "ISRC": "isrc",
        "UnifiedSong Title": "title",
        "ISRC Release Date": "release_date",
    }
    rows = _mapping(raw, names, ["unified_song_id"], ["isrc"])
    return rows.select(
        "unified_song_id",
        "isrc",
        F.coalesce("title", F.lit("")).alias("title"),
        F.coalesce(parse_date(F.col("release_date")), F.lit(as_of)).alias("release_date"),
    )


@dataclass(frozen=True)
class Load:
    """The next state of the three tables a daily file touches, and what changed."""

    meta: DataFrame
    reports: DataFrame
    changes: Changes
    streams: DataFrame


def load_daily(
    meta: DataFrame,
    streams: DataFrame,
    tables: dict[str, DataFrame],
    natural: str,
    key: str,
    described: Sequence[str],
    compare: Sequence[str],
    as_of: dt.date,
) -> Load:
    """Upsert the dimension, append the report, write only changed stream rows.

    ``tables`` holds ``meta`` (``natural``, ``key``, described columns, ``is_global``),
    ``reports`` and ``streams``. New entities get the next surrogate ids. A file row
    marks its entity as no longer territory-only.
    """
    ids = assign_ids(tables["meta"].select(natural, key), meta, natural, key)
    known = patch_ids(tables["meta"], ids, natural, key)
    fresh = meta.join(ids, natural).select(natural, key, *described, F.lit(False).alias("is_global"))
    next_meta = upsert(known, fresh, [natural], [*described, "is_global"])
    report = meta.join(ids, natural).select(*[c for c in tables["reports"].columns if c in [*meta.columns, key]])
    delta = streams.join(ids, natural).drop(natural)
    delta = unique_delta(delta.select(key, "date", *[c for c in delta.columns if c not in (key, "date")]), [key, "date"])
    changes = change_only(tables["streams"], delta, [key, "date"], compare, back(as_of, LOOK_BACK))
    # the report of a day that is loaded again takes the place of the first one
    others = tables["reports"].filter(~F.col("report_date").eqNullSafe(F.lit(as_of)))
    return Load(next_meta, append(others, report), changes, changes.apply(tables["streams"]))


def patch_ids(meta: DataFrame, ids: DataFrame, natural: str, key: str) -> DataFrame:
    """The dimension with its ids; rows are unchanged where the id was set before."""
    return patch(meta, ids, [natural], [key], keep_on_null=True)


def load_territory_stats(current: DataFrame, stats: DataFrame, ids: DataFrame, territories: DataFrame, natural: str, key: str) -> DataFrame:
    """Upsert weekly stats by (territory, entity).

    ``territories`` is (name, global_id). Entities and territories are looked up by name.
    """
    measures = ["rnk", "tw_streams", "lw_streams", "pct_chg", "ytd_streams", "rtd_streams", "digital_song_sales_tw"]
    delta = (
        stats.join(ids, natural)
        .join(territories.select(F.col("name").alias("country"), "global_id"), "country")
        .select("global_id", key, *measures)
    )
    return upsert(current, unique_delta(delta, ["global_id", key]), ["global_id", key], measures)


def load_global_entities(current: DataFrame, stats: DataFrame, natural: str, described: Sequence[str]) -> DataFrame:
    """Add entities seen only in territory files; known ones stay as they are."""
    rows = stats.select(natural, *described).withColumn("is_global", F.lit(True))
    return insert_absent(current, rows, [natural], [F.col(c).asc_nulls_last() for c in described])


def load_territory_streams(current: DataFrame, files: DataFrame, key: str, since: dt.date | None = None) -> DataFrame:
    """Upsert (entity, date, territory) streams; the newest file's restatement wins.

    ``files`` carries ``file_date`` beside the key columns and streams. Files restate dates
    after ``since`` only; earlier ones pass by.
    """
    keys = [key, "date", "territory"]
    delta = unique_delta(files, keys, [F.col("file_date").desc()]).drop("file_date")
    return upsert(current, delta, keys, ["streams"], among=None if since is None else F.col("date") > F.lit(since))


def restate_territory_streams(table: BucketedTable, files: DataFrame, key: str) -> Merge:
    """The same on a table kept by buckets of its date: only those of restated dates take part.

    Columns that the files lack keep their values, and are null in new rows.
    """
    keys = [key, "date", "territory"]
    delta = materialise(unique_delta(files, keys, [F.col("file_date").desc()]).drop("file_date"), "restated")
    return upsert_buckets(table, delta, keys, ["streams"])


def refresh_track_counts(artists: DataFrame, tracks: DataFrame) -> DataFrame:
    """Set the distinct song count of every mapped artist."""
    return patch(artists, track_counts(tracks), ["artist_id"], ["track_count"])


def refresh_track_collections(current: DataFrame, tracks: DataFrame) -> DataFrame:
    keys = ["song_id", "collection_id"]
    return insert_absent(current, track_collections(tracks), keys, [F.col(k).asc() for k in keys])
