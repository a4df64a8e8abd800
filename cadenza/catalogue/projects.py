"""Project (album) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.catalogue.domain import AS_OF, Tables, collections, images, region_tracks, song_streams, tracks
from cadenza.catalogue.registry import oracle, query, rounded, sql_fraction
from cadenza.operators.maintain import upsert
from cadenza.plans.ingest import refresh_track_collections, refresh_track_counts
from cadenza.plans.projects import project_daily, project_images, project_meta, project_recent, project_weekly
from cadenza.plans.views import entity_stats, track_collections

_VALID = "lower(c.name) NOT LIKE '%best of%' AND lower(c.name) NOT LIKE '%the greatest%' AND lower(c.name) NOT LIKE '%the best%'"
_META = {
    "per": "SELECT collection_id, artist_id, count(*) AS n FROM region_tracks GROUP BY 1, 2",
    "main": "SELECT *, row_number() OVER (PARTITION BY collection_id ORDER BY n DESC, artist_id) AS k, CAST(sum(n) OVER (PARTITION BY collection_id) AS BIGINT) AS total FROM per",
    "meta": (
        "SELECT m.collection_id, m.artist_id, c.name, c.release_date, c.type, m.total AS track_count, ((2 * m.n * 10 + m.total) // (2 * m.total)) / 10e0 AS confidence, m.n "
        "FROM main m JOIN collections c ON c.collection_id = m.collection_id WHERE m.k = 1"
    ),
}


@query(
    "project_meta",
    oracle(
        f"SELECT c.collection_id, c.artist_id, c.name, CAST(c.release_date AS VARCHAR) AS release_date, c.track_count, c.confidence, c.n > 4 AND c.confidence > 0.5 AND c.type = 'Album' AND {_VALID} AS is_valid FROM meta c",
        **_META,
    ),
)
def project_meta_query(spark, folder):
    t = Tables(spark, folder)
    out = project_meta(collections(t), region_tracks(t))
    return out.select("collection_id", "artist_id", "name", "release_date", "track_count", "confidence", "is_valid")


@query(
    "project_meta_upsert",
    oracle(
        "SELECT coalesce(s.collection_id, c.collection_id) AS collection_id, coalesce(c.artist_id, s.artist_id) AS artist_id, CASE WHEN s.collection_id IS NULL THEN c.type ELSE 'kept' END AS type, coalesce(c.track_count, s.track_count) AS track_count "
        "FROM (SELECT o_orderkey AS collection_id, -1 AS artist_id, 0 AS track_count FROM orders WHERE o_orderstatus = 'O') s FULL JOIN meta c ON c.collection_id = s.collection_id",
        **_META,
    ),
)
def project_meta_upsert(spark, folder):
    """New projects are inserted; known ones keep their type."""
    t = Tables(spark, folder)
    current = t.orders.filter(F.col("o_orderstatus") == "O").select(
        F.col("o_orderkey").alias("collection_id"), F.lit(-1).alias("artist_id"), F.lit("kept").alias("type"),
        F.lit(0).cast("bigint").alias("track_count"),
    )
    fresh = project_meta(collections(t), region_tracks(t)).select("collection_id", "artist_id", "type", "track_count")
    return upsert(current, fresh, ["collection_id"], ["artist_id", "track_count"])


@query(
    "project_image_mode",
    oracle(
        "SELECT p.o_orderkey AS collection_id, CASE WHEN p.o_orderstatus = 'O' THEN b.image ELSE 'cover' END AS image FROM orders p LEFT JOIN ("
        "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY collection_id ORDER BY n DESC, image) AS k FROM (SELECT t.collection_id, i.image, count(*) AS n FROM tracks t JOIN images i ON i.song_id = t.song_id WHERE i.image <> '' GROUP BY 1, 2)) WHERE k = 1"
        ") b ON b.collection_id = p.o_orderkey"
    ),
)
def project_image_mode(spark, folder):
    """Open orders have no cover yet and get their songs' most frequent image."""
    t = Tables(spark, folder)
    projects = t.orders.select(
        F.col("o_orderkey").alias("collection_id"), F.when(F.col("o_orderstatus") != "O", F.lit("cover")).alias("image")
    )
    return project_images(projects, tracks(t).select("song_id", "collection_id"), images(t))


_LINKS = "SELECT DISTINCT song_id, collection_id FROM tracks"


@query(
    "project_daily",
    oracle(f"SELECT l.collection_id, CAST(s.date AS VARCHAR) AS date, CAST(sum(s.streams) AS BIGINT) AS streams FROM song_streams s JOIN links l ON l.song_id = s.song_id WHERE s.date > DATE '{AS_OF}' - 10 GROUP BY 1, 2", links=_LINKS),
)
def project_daily_query(spark, folder):
    t = Tables(spark, folder)
    return project_daily(track_collections(tracks(t)), song_streams(t), AS_OF)


_WEEK = "SELECT song_id, CAST(sum(CASE WHEN date > DATE '{0}' - 365 AND date <= DATE '{0}' THEN streams ELSE 0 END) AS BIGINT) AS tw, CAST(sum(CASE WHEN date <= DATE '{0}' - 365 AND date > DATE '{0}' - 730 THEN streams ELSE 0 END) AS BIGINT) AS lw, CAST(sum(streams) AS BIGINT) AS rtd FROM song_streams GROUP BY 1".format(AS_OF)


def _song_facts(t: Tables):
    life = song_streams(t).groupBy("song_id").agg(F.sum("streams").alias("rtd_oda_streams"))
    stats = entity_stats(song_streams(t), "song_id", AS_OF, 365).drop("pct_chg")
    return life.join(stats, "song_id", "left")


@query(
    "project_weekly",
    oracle(
        "SELECT collection_id, tw_streams, lw_streams, rtd_oda_streams, round(tw_streams * 52 * 0.0056e0, 4) AS est_revenue_per_year, round(rtd_oda_streams * 0.0056e0, 4) AS est_total_revenue, "
        f"{sql_fraction('tw_streams', 'lw_streams')} AS pct_chg FROM (SELECT l.collection_id, CAST(sum(w.tw) AS BIGINT) AS tw_streams, CAST(sum(w.lw) AS BIGINT) AS lw_streams, CAST(sum(w.rtd) AS BIGINT) AS rtd_oda_streams FROM links l JOIN week w ON w.song_id = l.song_id GROUP BY 1)",
        links=_LINKS, week=_WEEK,
    ),
)
def project_weekly_query(spark, folder):
    t = Tables(spark, folder)
    out = project_weekly(track_collections(tracks(t)), _song_facts(t))
    return out.withColumns(rounded("est_revenue_per_year", "est_total_revenue", places=4))


_RECENT = {
    "week": _WEEK,
    "base": (
        "SELECT t.collection_id, t.artist_id, t.song_id, w.rtd, w.tw, p.p_type AS core_genre, i.image FROM region_tracks t JOIN week w ON w.song_id = t.song_id "
        f"JOIN part p ON p.p_partkey = t.song_id JOIN images i ON i.song_id = t.song_id JOIN collections c ON c.collection_id = t.collection_id WHERE c.type = 'Album' AND {_VALID}"
    ),
}


def _mode_sql(value: str) -> str:
    return f"SELECT collection_id, {value} FROM (SELECT collection_id, {value}, row_number() OVER (PARTITION BY collection_id ORDER BY count(*) DESC, {value}) AS k FROM base GROUP BY 1, 2) WHERE k = 1"


@query(
    "project_recent",
    oracle(
        "SELECT t.collection_id, t.rtd_oda_streams, t.tw_streams, c.name, CAST(c.release_date AS VARCHAR) AS release_date, g.core_genre, a.artist_id, r.r_name AS artist, i.image "
        "FROM (SELECT collection_id, CAST(sum(rtd) AS BIGINT) AS rtd_oda_streams, CAST(sum(tw) AS BIGINT) AS tw_streams, count(*) AS n FROM base GROUP BY 1) t "
        "JOIN ga a ON a.collection_id = t.collection_id JOIN gg g ON g.collection_id = t.collection_id JOIN gi i ON i.collection_id = t.collection_id JOIN collections c ON c.collection_id = t.collection_id JOIN region r ON r.r_regionkey = a.artist_id "
        "JOIN (SELECT collection_id, max(n) AS m FROM (SELECT collection_id, artist_id, count(*) AS n FROM base GROUP BY 1, 2) GROUP BY 1) x ON x.collection_id = t.collection_id WHERE t.n > 4 AND x.m / CAST(t.n AS DOUBLE) > 0.5",
        **_RECENT, ga=_mode_sql("artist_id"), gg=_mode_sql("core_genre"), gi=_mode_sql("image"),
    ),
)
def project_recent_query(spark, folder):
    t = Tables(spark, folder)
    reports = _song_facts(t).select("song_id", "rtd_oda_streams", F.coalesce("tw_streams", F.lit(0)).alias("tw_oda_streams"))
    songs = t.part.select(F.col("p_partkey").alias("song_id"), F.col("p_type").alias("core_genre"))
    artists = t.region.select(F.col("r_regionkey").alias("artist_id"), F.col("r_name").alias("artist"))
    out = project_recent(reports, songs, region_tracks(t), artists, collections(t), images(t))
    return out.select("collection_id", "rtd_oda_streams", "tw_streams", "name", "release_date", "core_genre", "artist_id", "artist", "image")


@query(
    "track_count_patch",
    oracle("SELECT s.s_suppkey AS artist_id, s.s_name AS artist, coalesce(c.n, -1) AS track_count FROM supplier s LEFT JOIN (SELECT artist_id, count(DISTINCT song_id) AS n FROM tracks GROUP BY 1) c ON c.artist_id = s.s_suppkey"),
)
def track_count_patch(spark, folder):
    t = Tables(spark, folder)
    people = t.supplier.select(F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist"), F.lit(-1).cast("bigint").alias("track_count"))
    return refresh_track_counts(people, tracks(t))


@query("track_collections", oracle("SELECT song_id, collection_id FROM links", links=_LINKS))
def track_collections_query(spark, folder):
    """Links of returned lines are stored already; the rest is added."""
    t = Tables(spark, folder)
    stored = t.lineitem.filter(F.col("l_returnflag") == "R").select(
        F.col("l_partkey").alias("song_id"), F.col("l_orderkey").alias("collection_id")
    ).distinct()
    return refresh_track_collections(stored, tracks(t))
