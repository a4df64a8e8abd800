"""Music tables derived from the given star schema, in Spark and as table expressions.

Songs are parts, artists are suppliers, territories are customer nations, collections
are orders, accounts are event users.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.catalogue.registry import cte, sql_fraction
from cadenza.operators.binned import build_model
from cadenza.plans.views import entity_stats
from cadenza.session import materialise

AS_OF = dt.date(2001, 6, 30)
EVENTS_AS_OF = dt.date(2024, 1, 31)
MODEL_EDGES = [0, 250, 500, 1000, 1500, 2000, 3000, 4000, 6000, 8000, 12000, 20000, 40000]
YEAR = 365


class Tables:
    """The tables of one folder, read on demand."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


cte("song_streams", "SELECT l_partkey AS song_id, CAST(l_shipdate AS DATE) AS date, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS streams FROM lineitem GROUP BY 1, 2")
cte("artist_streams", "SELECT l_suppkey AS artist_id, CAST(l_shipdate AS DATE) AS date, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS streams FROM lineitem GROUP BY 1, 2")


def _streams(t: Tables, source: str, key: str) -> DataFrame:
    rows = t.lineitem.select(
        F.col(source).alias(key), F.to_date("l_shipdate").alias("date"), F.col("l_quantity").cast("bigint").alias("q")
    )
    return rows.groupBy(key, "date").agg(F.sum("q").alias("streams"))


def song_streams(t: Tables) -> DataFrame:
    return _streams(t, "l_partkey", "song_id")


def artist_streams(t: Tables) -> DataFrame:
    return _streams(t, "l_suppkey", "artist_id")


def _stats_sql(table: str, key: str, days: int) -> str:
    inner = (
        f"SELECT {key}, CAST(sum(CASE WHEN date > DATE '{AS_OF}' - {days} THEN streams ELSE 0 END) AS BIGINT) AS tw_streams, "
        f"CAST(sum(CASE WHEN date <= DATE '{AS_OF}' - {days} THEN streams ELSE 0 END) AS BIGINT) AS lw_streams "
        f"FROM {table} WHERE date > DATE '{AS_OF}' - {2 * days} AND date <= DATE '{AS_OF}' GROUP BY 1"
    )
    return f"SELECT *, {sql_fraction('tw_streams', 'lw_streams')} AS pct_chg FROM ({inner})"


cte("artist_stats", _stats_sql("artist_streams", "artist_id", 7))
cte("song_stats", _stats_sql("song_streams", "song_id", YEAR))
cte("artists", "SELECT s.s_suppkey AS artist_id, s.s_name AS artist, s.s_acctbal < 0 AS signed, st.tw_streams, st.lw_streams, st.pct_chg FROM supplier s LEFT JOIN artist_stats st ON s.s_suppkey = st.artist_id")
cte("songs", "SELECT p.p_partkey AS song_id, p.p_name AS title, p.p_brand AS label, p.p_type AS core_genre, p.p_size < 10 AS signed, st.tw_streams, st.lw_streams, st.pct_chg FROM part p LEFT JOIN song_stats st ON p.p_partkey = st.song_id")


def artist_stats(t: Tables) -> DataFrame:
    return entity_stats(artist_streams(t), "artist_id", AS_OF)


def song_stats(t: Tables) -> DataFrame:
    """Yearly windows: a part sells too rarely for weeks."""
    return entity_stats(song_streams(t), "song_id", AS_OF, YEAR)


def artist_meta(t: Tables) -> DataFrame:
    return t.supplier.select(
        F.col("s_suppkey").alias("artist_id"), F.col("s_name").alias("artist"), (F.col("s_acctbal") < 0).alias("signed")
    )


def song_meta(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("song_id"),
        F.col("p_name").alias("title"),
        F.col("p_brand").alias("label"),
        F.col("p_type").alias("core_genre"),
        (F.col("p_size") < 10).alias("signed"),
    )


def artists(t: Tables) -> DataFrame:
    return artist_meta(t).join(artist_stats(t), "artist_id", "left")


def songs(t: Tables) -> DataFrame:
    return song_meta(t).join(song_stats(t), "song_id", "left")


cte("profiles", "SELECT s.s_suppkey AS artist_id, replace(p.p_name, ' ', '/') AS genres FROM supplier s JOIN part p ON s.s_suppkey = p.p_partkey")
cte("artist_genres", "SELECT DISTINCT artist_id, genre FROM (SELECT artist_id, unnest(string_split(genres, '/')) AS genre FROM profiles)")


def profiles(t: Tables) -> DataFrame:
    """A packed genre list per artist: the words of the part with the artist's number."""
    p = t.part.select(F.col("p_partkey").alias("artist_id"), F.replace("p_name", F.lit(" "), F.lit("/")).alias("genres"))
    return t.supplier.select(F.col("s_suppkey").alias("artist_id")).join(p, "artist_id")


cte("tracks", "SELECT DISTINCT l_partkey AS song_id, l_suppkey AS artist_id, l_orderkey AS collection_id FROM lineitem")


def tracks(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("song_id"), F.col("l_suppkey").alias("artist_id"), F.col("l_orderkey").alias("collection_id")
    ).distinct()


cte("region_tracks", "SELECT DISTINCT l.l_partkey AS song_id, n.n_regionkey AS artist_id, l.l_orderkey AS collection_id FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN nation n ON s.s_nationkey = n.n_nationkey")
cte("collections", "SELECT o_orderkey AS collection_id, CASE WHEN o_orderpriority = '1-URGENT' THEN 'The Best Of ' ELSE 'Album ' END || CAST(o_orderkey AS VARCHAR) AS name, CAST(o_orderdate AS DATE) AS release_date, CASE WHEN o_orderstatus = 'P' THEN 'Single' ELSE 'Album' END AS type FROM orders")
cte("images", "SELECT p_partkey AS song_id, CASE WHEN p_size = 1 THEN '' ELSE 'img/' || p_brand END AS image FROM part")


def region_tracks(t: Tables) -> DataFrame:
    """The map with supplier regions as artists, so that one artist can dominate an order."""
    where = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_regionkey")
    lines = t.lineitem.select("l_partkey", "l_suppkey", "l_orderkey")
    return lines.join(where, F.col("l_suppkey") == F.col("s_suppkey")).select(
        F.col("l_partkey").alias("song_id"), F.col("n_regionkey").alias("artist_id"), F.col("l_orderkey").alias("collection_id")
    ).distinct()


def collections(t: Tables) -> DataFrame:
    lead = F.when(F.col("o_orderpriority") == "1-URGENT", "The Best Of ").otherwise("Album ")
    return t.orders.select(
        F.col("o_orderkey").alias("collection_id"),
        F.concat(lead, F.col("o_orderkey").cast("string")).alias("name"),
        F.to_date("o_orderdate").alias("release_date"),
        F.when(F.col("o_orderstatus") == "P", "Single").otherwise("Album").alias("type"),
    )


def images(t: Tables) -> DataFrame:
    image = F.when(F.col("p_size") == 1, "").otherwise(F.concat(F.lit("img/"), F.col("p_brand")))
    return t.part.select(F.col("p_partkey").alias("song_id"), image.alias("image"))


HOME = 0
ROLLUPS = (23, 24)
_SPLIT = (
    f"CAST(sum(CASE WHEN d > DATE '{AS_OF}' - 365 THEN q ELSE 0 END) AS BIGINT) AS tw_streams, "
    f"CAST(sum(CASE WHEN d <= DATE '{AS_OF}' - 365 AND d > DATE '{AS_OF}' - 730 THEN q ELSE 0 END) AS BIGINT) AS lw_streams, "
    "CAST(sum(q) AS BIGINT) AS rtd_streams"
)
cte("sales", "SELECT c.c_nationkey AS global_id, l.l_suppkey AS artist_id, l.l_partkey AS song_id, CAST(l.l_shipdate AS DATE) AS d, CAST(l.l_quantity AS BIGINT) AS q FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey")
cte("all_stats", f"SELECT global_id, artist_id, {_SPLIT} FROM sales WHERE d <= DATE '{AS_OF}' GROUP BY 1, 2")
cte("territory_stats", f"SELECT * FROM all_stats WHERE global_id <> {HOME}")
cte("home_stats", f"SELECT * FROM all_stats WHERE global_id = {HOME}")


def sales(t: Tables) -> DataFrame:
    """Streams by territory, artist, song and day."""
    lines = t.lineitem.select(
        "l_orderkey",
        F.col("l_suppkey").alias("artist_id"),
        F.col("l_partkey").alias("song_id"),
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").cast("bigint").alias("streams"),
    )
    place = t.orders.select("o_orderkey", "o_custkey").join(
        t.customer.select("c_custkey", F.col("c_nationkey").alias("global_id")), F.col("o_custkey") == F.col("c_custkey")
    )
    return lines.join(place, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "global_id", "artist_id", "song_id", "date", "streams"
    )


def all_stats(t: Tables, key: str = "artist_id") -> DataFrame:
    d, q = F.col("date"), F.col("streams")
    year, two = F.lit(AS_OF - dt.timedelta(365)), F.lit(AS_OF - dt.timedelta(730))
    return (
        sales(t)
        .filter(d <= F.lit(AS_OF))
        .groupBy("global_id", key)
        .agg(
            F.sum(F.when(d > year, q).otherwise(0)).alias("tw_streams"),
            F.sum(F.when((d <= year) & (d > two), q).otherwise(0)).alias("lw_streams"),
            F.sum(q).alias("rtd_streams"),
        )
    )


def territory_stats(t: Tables, key: str = "artist_id") -> DataFrame:
    return all_stats(t, key).filter(F.col("global_id") != HOME)


def home_stats(t: Tables, key: str = "artist_id") -> DataFrame:
    return all_stats(t, key).filter(F.col("global_id") == HOME)


cte("points", "SELECT user_id AS account, CAST(ts AS DATE) AS date, CAST(sum(CAST(round(value) AS BIGINT)) AS BIGINT) AS gained, count(*) AS events FROM events GROUP BY 1, 2")
cte("followers", "SELECT account, date, CAST(sum(gained) OVER (PARTITION BY account ORDER BY date) AS BIGINT) AS followers, events FROM points")
_CASES = " ".join(
    f"WHEN followers > {lo} AND followers <= {hi} THEN {i}"
    for i, (lo, hi) in enumerate(zip(MODEL_EDGES, MODEL_EDGES[1:]), 1)
)
_LOWS = " ".join(f"WHEN {i} THEN {lo}e0" for i, lo in enumerate(MODEL_EDGES[:-1], 1))
_HIGHS = " ".join(f"WHEN {i} THEN {hi}e0" for i, hi in enumerate(MODEL_EDGES[1:], 1))
cte("day_gains", f"SELECT f.followers, p.gained, CASE {_CASES} END AS bin FROM followers f JOIN points p USING (account, date)")
cte("gain_model", f"SELECT CAST(count(*) AS INT) AS count, avg(gained) AS mean, stddev_samp(gained) AS std, CASE bin {_LOWS} END AS bin_min, CASE bin {_HIGHS} END AS bin_max FROM day_gains WHERE bin IS NOT NULL GROUP BY bin")


def points(t: Tables) -> DataFrame:
    """What every account gained per day, with its number of events."""
    return (
        t.events.select(
            F.col("user_id").alias("account"), F.to_date("ts").alias("date"), F.round("value").cast("bigint").alias("v")
        )
        .groupBy("account", "date")
        .agg(F.sum("v").alias("gained"), F.count(F.lit(1)).alias("events"))
    )


def followers(t: Tables) -> DataFrame:
    """Running totals per account, with the gap days the events leave."""
    w = Window.partitionBy("account").orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return points(t).select("account", "date", F.sum("gained").over(w).alias("followers"), "events", "gained")


def gain_model(t: Tables) -> DataFrame:
    """The stored model: built once, then read as a small table."""
    return materialise(build_model(followers(t), "followers", "gained", MODEL_EDGES), "model")


cte("dense", """
    SELECT g.account, g.date,
           coalesce(f.followers, lo.v + (hi.v - lo.v) * date_diff('day', lo.d, g.date) / date_diff('day', lo.d, hi.d)) AS followers
    FROM (SELECT account, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM followers GROUP BY account) g
    LEFT JOIN (SELECT account, date, CAST(followers AS DOUBLE) AS followers FROM followers) f ON f.account = g.account AND f.date = g.date
    LEFT JOIN LATERAL (SELECT max(x.date) AS d, CAST(max_by(x.followers, x.date) AS DOUBLE) AS v FROM followers x WHERE x.account = g.account AND x.date < g.date) lo ON true
    LEFT JOIN LATERAL (SELECT min(x.date) AS d, CAST(min_by(x.followers, x.date) AS DOUBLE) AS v FROM followers x WHERE x.account = g.account AND x.date > g.date) hi ON true
""")
