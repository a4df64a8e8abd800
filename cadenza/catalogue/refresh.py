"""Composite refreshes: rollups stored back, dimensions patched, caches filled, chart base sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cadenza.catalogue.domain import (
    AS_OF,
    ROLLUPS,
    Tables,
    all_stats,
    artist_stats,
    artists,
    home_stats,
    territory_stats,
    tracks,
)
from cadenza.catalogue.landing import track_objects
from cadenza.catalogue.projects import _LINKS, _WEEK, _song_facts
from cadenza.catalogue.registry import oracle, query, sql_percent
from cadenza.catalogue.territories import _FULL, _TOTAL, EX_HOME_ID, WORLD_ID, _ex, _ranked
from cadenza.functions.text import link
from cadenza.operators.maintain import patch
from cadenza.plans.enrich import cache_songs
from cadenza.plans.projects import project_weekly, refresh_weekly
from cadenza.plans.rollups import ex_home, refresh_territories, store_rollups, worldwide
from cadenza.plans.social import chart_base
from cadenza.plans.views import track_collections
from cadenza.sources.contracts import recent_date
from cadenza.sources.files import ORDINAL, head_rows
from cadenza.sources.nested import TRACK, parsed, track_rows
from cadenza.sources.tables import plain_text

_M = "tw_streams, lw_streams, rtd_streams"
_WORLD = _ranked(
    _FULL.format(k="artist_id", ex=_ex("artist_id"), home="home_stats", rtd="coalesce(e.rtd_streams, 0) + coalesce(h.rtd_streams, 0)"), "artist_id"
)


@query(
    "territory_store",
    oracle(
        f"SELECT global_id, artist_id, {_M} FROM territory_stats UNION ALL SELECT {EX_HOME_ID}, artist_id, {_M} FROM ({_ranked(_ex('artist_id'), 'artist_id')}) "
        f"UNION ALL SELECT {WORLD_ID}, artist_id, {_M} FROM ({_WORLD})"
    ),
)
def territory_store(spark, folder):
    """Ex-home and worldwide rows upserted beside the territories."""
    t = Tables(spark, folder)
    current = territory_stats(t)
    ex = ex_home(current, "artist_id", ROLLUPS, EX_HOME_ID)
    return store_rollups(current, "artist_id", ex, worldwide(ex, home_stats(t), "artist_id", WORLD_ID))


@query(
    "territory_patch",
    oracle(
        "SELECT n.n_nationkey AS global_id, n.n_name AS name, r.tw_streams, r.rnk, "
        f"CASE WHEN r.lw_streams = 0 THEN 0e0 ELSE {sql_percent('r.tw_streams', 'r.lw_streams')} END AS pct_chg FROM nation n LEFT JOIN ({_ranked(_TOTAL, 'global_id')}) r ON r.global_id = n.n_nationkey"
    ),
)
def territory_patch(spark, folder):
    t = Tables(spark, folder)
    places = t.nation.select(
        F.col("n_nationkey").alias("global_id"), F.col("n_name").alias("name"), F.lit(None).cast("bigint").alias("tw_streams"),
        F.lit(None).cast("int").alias("rnk"), F.lit(None).cast("double").alias("pct_chg"),
    )
    return refresh_territories(places, all_stats(t))


@query(
    "project_weekly_patch",
    oracle(
        "SELECT o.o_orderkey AS collection_id, CASE WHEN w.collection_id IS NULL THEN -1 ELSE w.tw END AS tw_streams, CASE WHEN w.collection_id IS NULL THEN -1 ELSE w.rtd END AS rtd_oda_streams "
        "FROM orders o LEFT JOIN (SELECT l.collection_id, CAST(sum(w.tw) AS BIGINT) AS tw, CAST(sum(w.rtd) AS BIGINT) AS rtd FROM links l JOIN week w ON w.song_id = l.song_id GROUP BY 1) w ON w.collection_id = o.o_orderkey",
        links=_LINKS, week=_WEEK,
    ),
)
def project_weekly_patch(spark, folder):
    """Projects without any line keep their stored numbers."""
    t = Tables(spark, folder)
    projects = t.orders.select(
        F.col("o_orderkey").alias("collection_id"), F.lit(-1).cast("bigint").alias("tw_streams"), F.lit(-1).cast("bigint").alias("rtd_oda_streams")
    )
    weekly = project_weekly(track_collections(tracks(t)), _song_facts(t)).select("collection_id", "tw_streams", "rtd_oda_streams")
    return refresh_weekly(projects, weekly)


@query(
    "cache_songs",
    oracle(
        "SELECT p_partkey AS song_id, CASE WHEN p_type = 'ECONOMY' THEN 'kept' ELSE CAST(p_partkey AS VARCHAR) END AS track_id, CASE WHEN p_type <> 'ECONOMY' THEN 'L ' || p_brand END AS copyrights, "
        "CASE WHEN p_type = 'ECONOMY' THEN NULL WHEN p_size < 25 THEN p_size ELSE 0 END AS key FROM part WHERE p_type = 'ECONOMY' OR p_partkey IN (SELECT l_partkey FROM lineitem)"
    ),
)
def cache_songs_query(spark, folder):
    """Sold songs missing from the cache get track, album and audio columns from landed objects."""
    t = Tables(spark, folder)
    flat = track_rows(parsed(track_objects(t), "json", TRACK).drop("json", "p_partkey"))
    albums = t.part.groupBy(F.col("p_brand").alias("album_id")).agg(F.count(F.lit(1)).alias("n")).select(
        "album_id", F.col("album_id").alias("album_name"), F.concat(F.lit("L "), F.col("album_id")).alias("copyrights"), F.lit("l").alias("label"), F.lit("u").alias("upc")
    )
    features = t.part.filter(F.col("p_size") < 25).select(F.col("p_partkey").cast("string").alias("id"), F.col("p_size").alias("key"))
    cache = t.part.filter(F.col("p_type") == "ECONOMY").select(
        F.col("p_partkey").alias("song_id"), F.lit("kept").alias("track_id"), F.lit(None).cast("string").alias("copyrights"), F.lit(None).cast("int").alias("key")
    )
    sold = t.lineitem.select(F.col("l_partkey").alias("song_id")).distinct()
    songs = sold.withColumn("isrc", F.concat(F.lit("I"), F.col("song_id").cast("string")))
    return cache_songs(cache, songs, flat, albums, features)


@query(
    "chart_base",
    oracle(
        "SELECT a.artist_id, a.artist, a.tw_streams, a.pct_chg, m.photo_id, m.audio_id, coalesce(a.lw_streams, 0) AS lw_streams FROM artists a "
        "JOIN (SELECT s_suppkey AS artist_id, CASE WHEN s_nationkey > 12 THEN s_nationkey END AS photo_id, CASE WHEN s_acctbal > 5000 THEN s_name END AS audio_id FROM supplier) m ON m.artist_id = a.artist_id "
        "WHERE a.signed = false AND (m.photo_id IS NOT NULL OR m.audio_id IS NOT NULL)"
    ),
)
def chart_base_query(spark, folder):
    t = Tables(spark, folder)
    ids = t.supplier.select(
        F.col("s_suppkey").alias("artist_id"), F.when(F.col("s_nationkey") > 12, F.col("s_nationkey")).alias("photo_id"),
        F.when(F.col("s_acctbal") > 5000, F.col("s_name")).alias("audio_id"),
    )
    return chart_base(artists(t), ids, artist_stats(t), ["photo_id", "audio_id"])


@query(
    "head_rows",
    oracle("SELECT l_orderkey, l_partkey, l_suppkey FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice LIMIT 100"),
)
def head_rows_query(spark, folder):
    """The first hundred rows of a feed, for a dry run."""
    t = Tables(spark, folder)
    place = F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return head_rows(t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", place.alias(ORDINAL))).drop(ORDINAL)


@query(
    "sql_parameters",
    oracle("SELECT p_partkey, p_name FROM part WHERE p_size > 20 AND p_brand IN ('Brand#1', 'Brand#2') AND p_type <> 'ECONOMY'"),
)
def sql_parameters(spark, folder):
    """A table scan with bound parameters."""
    t = Tables(spark, folder)
    text = "SELECT p_partkey, p_name FROM {part} WHERE p_size > :floor AND array_contains(:brands, p_brand) AND p_type <> :kind"
    return spark.sql(text, args={"floor": 20, "brands": F.array(F.lit("Brand#1"), F.lit("Brand#2")), "kind": F.lit("ECONOMY")}, part=t.part)


@query(
    "control_table",
    oracle(f"SELECT 'recent' AS name, '{AS_OF}' AS value UNION ALL SELECT DISTINCT o_orderpriority, '1999-01-01' FROM orders"),
)
def control_table(spark, folder):
    """The key/value control table with the as-of date moved to two days before the run."""
    t = Tables(spark, folder)
    names = t.orders.select(F.col("o_orderpriority").alias("name")).distinct()
    names = names.union(t.orders.agg(F.lit("recent").alias("name")))
    current = names.withColumn("value", F.lit("1999-01-01"))
    now = recent_date(AS_OF + dt.timedelta(2)).isoformat()
    delta = names.filter(F.col("name") == "recent").withColumn("value", F.lit(now))
    return patch(current, delta, ["name"], ["value"])


@query(
    "plain_text",
    oracle("SELECT event_id, replace(replace(props, '\"', ''), '''', '') AS props, 'https://example.org/users/' || CAST(user_id AS VARCHAR) AS url FROM events"),
)
def plain_text_query(spark, folder):
    """Quote characters removed for an export, and a link per row."""
    t = Tables(spark, folder)
    return plain_text(t.events.select("event_id", "props", link("https://example.org/users/", F.col("user_id")).alias("url")))
