"""Keys, windows and reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.catalogue.domain import AS_OF, Tables, followers, points, song_streams, songs
from cadenza.catalogue.registry import oracle, query
from cadenza.functions.dates import back
from cadenza.operators.keys import (
    first_per_key,
    global_rank,
    large_groups,
    mode_per_key,
    rank_per_key,
    share_of_group,
    top_per_key,
    value_counts,
    with_fallback,
)
from cadenza.operators.reshape import attributes_to_columns, melt_columns, melt_dates, melt_series, pivot_dates
from cadenza.operators.segments import previous_row
from cadenza.operators.timegrid import densify, lagged

DAYS = [back(AS_OF, i) for i in range(14)]


def _cells(value: str = "streams", prefix: str = "d") -> str:
    return ", ".join(
        f"CAST(sum(CASE WHEN date = DATE '{d}' THEN {value} END) AS BIGINT) AS {prefix}{i}" for i, d in enumerate(DAYS)
    )


_WINDOW = f"date BETWEEN DATE '{DAYS[-1]}' AND DATE '{DAYS[0]}'"
_WIDE = f"SELECT song_id, {_cells()} FROM song_streams WHERE {_WINDOW} GROUP BY 1"


def wide_songs(t: Tables):
    """A daily file: one column per day, newest first."""
    wide = pivot_dates(song_streams(t), ["song_id"], DAYS, "streams")
    return wide.withColumnsRenamed({d.isoformat(): f"d{i}" for i, d in enumerate(DAYS)})


@query("long_to_wide", oracle(_WIDE))
def long_to_wide(spark, folder):
    return wide_songs(Tables(spark, folder))


@query(
    "wide_to_long",
    oracle(
        f"SELECT w.song_id, CAST(DATE '{AS_OF}' - i.i AS VARCHAR) AS date, coalesce(s.streams, 0) AS streams "
        f"FROM (SELECT DISTINCT song_id FROM song_streams WHERE {_WINDOW}) w, (SELECT CAST(unnest(range(14)) AS INT) AS i) i "
        f"LEFT JOIN song_streams s ON s.song_id = w.song_id AND s.date = DATE '{AS_OF}' - i.i"
    ),
)
def wide_to_long(spark, folder):
    """Fourteen day columns to rows, gaps as zero."""
    t = Tables(spark, folder)
    return melt_dates(wide_songs(t), ["song_id"], {d: f"d{i}" for i, d in enumerate(DAYS)}, "streams")


_FLAGS = {"streams": None, "premium": "A", "ad_supported": "R"}


@query(
    "wide_to_long_multi",
    oracle(
        f"SELECT w.song_id, CAST(DATE '{AS_OF}' - i.i AS VARCHAR) AS date, coalesce(s.a, 0) AS streams, coalesce(s.b, 0) AS premium, coalesce(s.c, 0) AS ad_supported "
        f"FROM (SELECT DISTINCT song_id FROM daily) w, (SELECT CAST(unnest(range(14)) AS INT) AS i) i "
        f"LEFT JOIN daily s ON s.song_id = w.song_id AND s.date = DATE '{AS_OF}' - i.i",
        daily=(
            "SELECT l_partkey AS song_id, CAST(l_shipdate AS DATE) AS date, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS a, "
            "CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS b, "
            "CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS c "
            f"FROM lineitem WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '{DAYS[-1]}' AND DATE '{DAYS[0]}' GROUP BY 1, 2"
        ),
    ),
)
def wide_to_long_multi(spark, folder):
    """Three parallel families of day columns to rows in one pass."""
    t = Tables(spark, folder)
    rows = t.lineitem.select(
        F.col("l_partkey").alias("song_id"), F.to_date("l_shipdate").alias("date"), "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("q"),
    ).filter(F.col("date").between(F.lit(DAYS[-1]), F.lit(DAYS[0])))
    cells = []
    for i, d in enumerate(DAYS):
        for name, flag in _FLAGS.items():
            here = F.col("date") == F.lit(d)
            cells.append(F.sum(F.when(here if flag is None else here & (F.col("l_returnflag") == flag), F.col("q"))).alias(f"{name}_{i}"))
    wide = rows.groupBy("song_id").agg(*cells)
    series = {name: {d: f"{name}_{i}" for i, d in enumerate(DAYS)} for name in _FLAGS}
    return melt_series(wide, ["song_id"], series)


_REGIONS = "SELECT l_suppkey AS artist_id, CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS a, CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS n, CAST(sum(CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT) END) AS BIGINT) AS r FROM lineitem GROUP BY 1"


@query(
    "territory_columns_to_rows",
    oracle(
        "SELECT artist_id, 'a' AS territory, coalesce(a, 0) AS streams FROM w UNION ALL SELECT artist_id, 'n', coalesce(n, 0) FROM w UNION ALL SELECT artist_id, 'r', coalesce(r, 0) FROM w",
        w=_REGIONS,
    ),
)
def territory_columns_to_rows(spark, folder):
    t = Tables(spark, folder)
    q = F.col("l_quantity").cast("bigint")
    cells = [F.sum(F.when(F.col("l_returnflag") == f.upper(), q)).alias(f) for f in ("a", "n", "r")]
    wide = t.lineitem.groupBy(F.col("l_suppkey").alias("artist_id")).agg(*cells)
    return melt_columns(wide, ["artist_id"], ["a", "n", "r"], "territory", "streams")


@query(
    "first_per_key",
    oracle(
        "SELECT l_partkey, l_orderkey, l_linenumber, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_extendedprice) AS k FROM lineitem) WHERE k = 1"
    ),
)
def first_per_key_query(spark, folder):
    t = Tables(spark, folder)
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"]
    lines = t.lineitem.select("l_partkey", "l_quantity", *order)
    return first_per_key(lines, ["l_partkey"], [F.col(c).asc() for c in order]).select(
        "l_partkey", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity"
    )


@query(
    "max_per_key",
    oracle("SELECT label, song_id, tw_streams FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY tw_streams DESC NULLS LAST, song_id) AS k FROM songs) WHERE k = 1"),
)
def max_per_key(spark, folder):
    t = Tables(spark, folder)
    return top_per_key(songs(t), ["label"], "tw_streams", "song_id").select("label", "song_id", "tw_streams")


@query(
    "mode_per_key",
    oracle(
        "SELECT l_suppkey, l_partkey, n FROM (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, l_partkey) AS k FROM (SELECT l_suppkey, l_partkey, count(*) AS n FROM lineitem GROUP BY 1, 2)) WHERE k = 1"
    ),
)
def mode_per_key_query(spark, folder):
    t = Tables(spark, folder)
    return mode_per_key(t.lineitem, ["l_suppkey"], "l_partkey")


@query(
    "share_of_group",
    oracle(
        "SELECT o_orderpriority, o_orderstatus, n, CAST(sum(n) OVER (PARTITION BY o_orderpriority) AS BIGINT) AS n_total, "
        "round(n / CAST(sum(n) OVER (PARTITION BY o_orderpriority) AS DOUBLE), 3) AS share FROM (SELECT o_orderpriority, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2)"
    ),
)
def share_of_group_query(spark, folder):
    t = Tables(spark, folder)
    counts = value_counts(t.orders, ["o_orderpriority", "o_orderstatus"], "n")
    return share_of_group(counts, ["o_orderpriority"], "n", "share", 3)


@query(
    "large_groups",
    oracle("SELECT account, CAST(date AS VARCHAR) AS date, followers FROM followers WHERE account IN (SELECT account FROM followers GROUP BY 1 HAVING count(*) > 27)"),
)
def large_groups_query(spark, folder):
    t = Tables(spark, folder)
    return large_groups(followers(t).select("account", "date", "followers"), ["account"], 27)


@query("global_rank", oracle("SELECT song_id, tw_streams, row_number() OVER (ORDER BY tw_streams DESC NULLS LAST, song_id) AS rnk FROM songs"))
def global_rank_query(spark, folder):
    t = Tables(spark, folder)
    order = [F.col("tw_streams").desc_nulls_last(), F.col("song_id").asc()]
    return global_rank(songs(t).select("song_id", "tw_streams"), order, "rnk")


@query("rank_per_key", oracle("SELECT label, song_id, tw_streams, row_number() OVER (PARTITION BY label ORDER BY tw_streams DESC NULLS LAST, song_id) AS rnk FROM songs"))
def rank_per_key_query(spark, folder):
    t = Tables(spark, folder)
    order = [F.col("tw_streams").desc_nulls_last(), F.col("song_id").asc()]
    return rank_per_key(songs(t).select("label", "song_id", "tw_streams"), ["label"], order, "rnk")


_DIR = "SELECT l_suppkey AS target_id, l_linenumber AS type, CAST(l_partkey AS VARCHAR) AS account_id FROM lineitem"
_KINDS = {1: "twitter_id", 2: "instagram_id", 3: "youtube_id", 6: "gtrends_id", 7: "soundcloud_id"}


def directory(t: Tables):
    return t.lineitem.select(
        F.col("l_suppkey").alias("target_id"), F.col("l_linenumber").alias("type"), F.col("l_partkey").cast("string").alias("account_id")
    )


@query(
    "id_map_pivot",
    oracle(
        "SELECT target_id, " + ", ".join(f"min(CASE WHEN type = {c} THEN account_id END) AS {n}" for c, n in _KINDS.items()) + " FROM d GROUP BY 1",
        d=_DIR,
    ),
)
def id_map_pivot(spark, folder):
    t = Tables(spark, folder)
    return attributes_to_columns(directory(t), ["target_id"], "type", "account_id", _KINDS)


@query(
    "lookup_fallback",
    oracle(
        "SELECT w.song_id, s.tw_streams, 'stats' AS source FROM w JOIN song_stats s ON w.song_id = s.song_id "
        "UNION ALL SELECT w.song_id, CAST(NULL AS BIGINT), 'catalogue' FROM w JOIN part p ON w.song_id = p.p_partkey WHERE w.song_id NOT IN (SELECT song_id FROM song_stats)",
        w="SELECT DISTINCT l_partkey AS song_id FROM lineitem",
    ),
)
def lookup_fallback(spark, folder):
    """Songs with recent streams from the stats, the others from the catalogue."""
    t = Tables(spark, folder)
    wanted = t.lineitem.select(F.col("l_partkey").alias("song_id"))
    held = songs(t).filter(F.col("tw_streams").isNotNull()).select("song_id", "tw_streams", F.lit("stats").alias("source"))
    rest = t.part.select(F.col("p_partkey").alias("song_id"), F.lit("catalogue").alias("source"))
    return with_fallback(wanted, held, rest, ["song_id"])


@query("densify_interpolate", oracle("SELECT account, CAST(date AS VARCHAR) AS date, round(followers, 6) AS followers FROM dense"))
def densify_interpolate(spark, folder):
    t = Tables(spark, folder)
    return densify(followers(t), "account", "followers").withColumn("followers", F.round("followers", 6))


@query(
    "day_lags",
    oracle(
        "SELECT account, CAST(date AS VARCHAR) AS date, round(followers - lag(followers, 1) OVER w, 6) AS day_gain, round(followers - lag(followers, 7) OVER w, 6) AS week_gain FROM dense WINDOW w AS (PARTITION BY account ORDER BY date)"
    ),
)
def day_lags(spark, folder):
    t = Tables(spark, folder)
    grid = densify(followers(t), "account", "followers")
    grid = lagged(lagged(grid, "account", "followers", 1, "__d"), "account", "followers", 7, "__w")
    return grid.select(
        "account", "date", F.round(F.col("followers") - F.col("__d"), 6).alias("day_gain"),
        F.round(F.col("followers") - F.col("__w"), 6).alias("week_gain"),
    )


@query(
    "previous_row",
    oracle(
        "SELECT account, CAST(date AS VARCHAR) AS date, gained, events, lag(gained) OVER w AS prev_gained, lag(events) OVER w AS prev_events FROM points WINDOW w AS (PARTITION BY account ORDER BY date)"
    ),
)
def previous_row_query(spark, folder):
    """Each account's day beside the one before, scanned in segments."""
    return previous_row(points(Tables(spark, folder)), ["account"], "date", ["gained", "events"])
