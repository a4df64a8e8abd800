"""Table maintenance: upsert, change-only, replace-window, patch.

The stored table is an earlier edition of the streams (lines with return flag R are
missing); the delta is the full edition of the newest part.
"""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from cadenza.catalogue.domain import AS_OF, Tables
from cadenza.catalogue.registry import oracle, query
from cadenza.functions.dates import back
from cadenza.operators.keys import assign_ids
from cadenza.operators.maintain import append, change_only, insert_absent, replace_window, unique_delta
from cadenza.plans.enrich import extend_cache, patch_colours, recache, refresh_id_map, stalest
from cadenza.plans.ingest import load_daily, load_global_entities, restate_territory_streams
from cadenza.session import scratch_dir
from cadenza.sources.buckets import BucketedTable, patch_buckets, upsert_buckets

SINCE = back(AS_OF, 20)
KEYS = ["song_id", "date"]
_CAST = "CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS streams, CAST(sum(CASE WHEN l_returnflag = 'A' THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS premium"
_FROM = "FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '%s'" % AS_OF
_STORED = f"SELECT l_partkey AS song_id, CAST(l_shipdate AS DATE) AS date, {_CAST} {_FROM} AND l_returnflag <> 'R' GROUP BY 1, 2"
_DELTA = f"SELECT l_partkey AS song_id, CAST(l_shipdate AS DATE) AS date, {_CAST} {_FROM} AND CAST(l_shipdate AS DATE) > DATE '{SINCE}' GROUP BY 1, 2"
_OUT = "song_id, CAST(date AS VARCHAR) AS date, streams, premium"


def _edition(rows):
    q = F.col("q")
    return rows.groupBy("song_id", "date").agg(
        F.sum(q).alias("streams"), F.sum(F.when(F.col("l_returnflag") == "A", q).otherwise(0)).alias("premium")
    )


def _lines(t: Tables):
    return t.lineitem.select(
        F.col("l_partkey").alias("song_id"), F.to_date("l_shipdate").alias("date"), "l_returnflag",
        F.col("l_quantity").cast("bigint").alias("q"),
    ).filter(F.col("date") <= F.lit(AS_OF))


def stored(t: Tables):
    return _edition(_lines(t).filter(F.col("l_returnflag") != "R"))


def kept(t: Tables) -> BucketedTable:
    """The stored edition as a table of 128 buckets of dates."""
    path = f"{scratch_dir(t.spark).rstrip('/')}/kept-{uuid.uuid4().hex}"
    return BucketedTable(path, ("date",), 128).write(stored(t))


def delta(t: Tables):
    return _edition(_lines(t).filter(F.col("date") > F.lit(SINCE)))


_FULL = "stored s FULL JOIN delta d ON s.song_id = d.song_id AND s.date = d.date"
_KEY = "coalesce(s.song_id, d.song_id) AS song_id, CAST(coalesce(s.date, d.date) AS VARCHAR) AS date"


@query(
    "upsert_keyed",
    oracle(
        f"SELECT {_KEY}, coalesce(d.streams, s.streams) AS streams, CASE WHEN s.song_id IS NULL THEN d.premium ELSE s.premium END AS premium FROM {_FULL}",
        stored=_STORED, delta=_DELTA,
    ),
)
def upsert_keyed(spark, folder):
    """Only the streams column is updated; premium is written for new keys alone. The table is
    kept by buckets of its date, and only those of the delta's dates are joined."""
    t = Tables(spark, folder)
    return upsert_buckets(kept(t), unique_delta(delta(t), KEYS), KEYS, ["streams"]).rows()


@query(
    "insert_absent",
    oracle(f"SELECT {_OUT} FROM stored UNION ALL SELECT {_OUT} FROM delta d WHERE NOT EXISTS (SELECT 1 FROM stored s WHERE s.song_id = d.song_id AND s.date = d.date)", stored=_STORED, delta=_DELTA),
)
def insert_absent_query(spark, folder):
    t = Tables(spark, folder)
    return insert_absent(stored(t), delta(t), KEYS, [F.col("streams").desc()])


_ACTION = "CASE WHEN s.song_id IS NULL THEN 'insert' WHEN d.streams IS DISTINCT FROM s.streams OR d.premium IS DISTINCT FROM s.premium THEN 'update' ELSE 'same' END"


def _changes(t: Tables):
    return change_only(stored(t), delta(t), KEYS, ["streams", "premium"], SINCE)


_MARKED = f"SELECT d.*, {_ACTION} AS action FROM delta d LEFT JOIN stored s ON s.song_id = d.song_id AND s.date = d.date"


@query(
    "change_only_counts",
    oracle("SELECT 'updates' AS name, count(*) AS value FROM m WHERE action = 'update' UNION ALL SELECT 'inserts', count(*) FROM m WHERE action = 'insert'", stored=_STORED, delta=_DELTA, m=_MARKED),
)
def change_only_counts(spark, folder):
    return _changes(Tables(spark, folder)).counts()


@query("change_only_rows", oracle("SELECT song_id, CAST(date AS VARCHAR) AS date, streams, premium, action FROM m", stored=_STORED, delta=_DELTA, m=_MARKED))
def change_only_rows(spark, folder):
    return _changes(Tables(spark, folder)).marked


@query(
    "change_only_apply",
    oracle(f"SELECT {_KEY}, coalesce(d.streams, s.streams) AS streams, coalesce(d.premium, s.premium) AS premium FROM {_FULL}", stored=_STORED, delta=_DELTA),
)
def change_only_apply(spark, folder):
    t = Tables(spark, folder)
    return _changes(t).apply(stored(t))


@query(
    "replace_window",
    oracle(f"SELECT {_OUT} FROM stored WHERE date <= DATE '{back(AS_OF, 7)}' UNION ALL SELECT {_OUT} FROM delta WHERE date > DATE '{back(AS_OF, 7)}'", stored=_STORED, delta=_DELTA),
)
def replace_window_query(spark, folder):
    t = Tables(spark, folder)
    return replace_window(stored(t), delta(t), back(AS_OF, 7))


@query(
    "patch_from",
    oracle(
        "SELECT s.song_id, CAST(s.date AS VARCHAR) AS date, coalesce(d.streams, s.streams) AS streams, s.premium FROM stored s LEFT JOIN delta d ON s.song_id = d.song_id AND s.date = d.date",
        stored=_STORED, delta=_DELTA,
    ),
)
def patch_from(spark, folder):
    t = Tables(spark, folder)
    return patch_buckets(kept(t), delta(t), KEYS, ["streams"]).rows()


@query("append_rows", oracle(f"SELECT {_OUT} FROM stored UNION ALL SELECT {_OUT} FROM delta", stored=_STORED, delta=_DELTA))
def append_rows(spark, folder):
    t = Tables(spark, folder)
    return append(stored(t), delta(t))


_RESTATED = "SELECT l_suppkey AS artist_id, CAST(l_shipdate AS DATE) AS date, l_returnflag AS territory, CAST(l_quantity AS BIGINT) AS streams, l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem"
_NEWEST = "SELECT artist_id, date, territory, streams FROM (SELECT *, row_number() OVER (PARTITION BY artist_id, date, territory ORDER BY l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_quantity DESC) AS k FROM restated WHERE %s) WHERE k = 1"


@query(
    "newest_restatement",
    oracle(
        "SELECT coalesce(n.artist_id, h.artist_id) AS artist_id, CAST(coalesce(n.date, h.date) AS VARCHAR) AS date, coalesce(n.territory, h.territory) AS territory, "
        "coalesce(n.streams, h.streams) AS streams, CASE WHEN h.artist_id IS NULL THEN NULL ELSE 100 * h.streams + 1 END AS premium FROM h FULL JOIN n ON n.artist_id = h.artist_id AND n.date = h.date AND n.territory = h.territory",
        restated=_RESTATED, h=_NEWEST % "l_linenumber = 1", n=_NEWEST % f"date > DATE '{SINCE}'",
    ),
)
def newest_restatement(spark, folder):
    """Files restate one (artist, day, territory) several times; the one of the highest order
    replaces the streams of a filled table, whose other column stays."""
    t = Tables(spark, folder)
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("artist_id"), F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("territory"),
        F.col("l_quantity").cast("bigint").alias("streams"), "l_linenumber",
        F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_quantity").alias("file_date"),
    )
    keys, newest = ["artist_id", "date", "territory"], [F.col("file_date").desc()]
    first = unique_delta(rows.filter("l_linenumber = 1").drop("l_linenumber"), keys, newest).drop("file_date")
    path = f"{scratch_dir(spark).rstrip('/')}/restated-{uuid.uuid4().hex}"
    table = BucketedTable(path, ("date",), 128).write(first.withColumn("premium", F.col("streams") * 100 + 1))
    files = rows.filter(F.col("date") > F.lit(SINCE)).drop("l_linenumber")
    return restate_territory_streams(table, files, "artist_id").rows()


@query(
    "assign_ids",
    oracle(
        "SELECT name, id FROM known UNION ALL SELECT p_name, (SELECT max(id) FROM known) + row_number() OVER (ORDER BY p_name) FROM (SELECT DISTINCT p_name FROM part WHERE p_name NOT IN (SELECT name FROM known))",
        known="SELECT p_name AS name, min(p_partkey) AS id FROM part WHERE p_type = 'ECONOMY' GROUP BY 1",
    ),
)
def assign_ids_query(spark, folder):
    """Surrogate ids for new names, continued after the stored ones."""
    t = Tables(spark, folder)
    names = t.part.select(F.col("p_name").alias("name"), "p_type", "p_partkey")
    known = names.filter(F.col("p_type") == "ECONOMY").groupBy("name").agg(F.min("p_partkey").alias("id"))
    return assign_ids(known, names, "name", "id")


_META = "SELECT s_name AS natural_key, s_suppkey AS entity_id, s_name AS artist, true AS is_global FROM supplier WHERE s_acctbal > 2000"


@query(
    "load_daily_meta",
    oracle(
        "SELECT natural_key, entity_id, artist, is_global FROM ("
        "SELECT s.s_name AS natural_key, coalesce(m.entity_id, (SELECT max(entity_id) FROM meta) + n.k) AS entity_id, s.s_name AS artist, false AS is_global "
        "FROM supplier s LEFT JOIN meta m ON m.natural_key = s.s_name LEFT JOIN fresh n ON n.s_name = s.s_name)",
        meta=_META,
        fresh="SELECT s_name, row_number() OVER (ORDER BY s_name) AS k FROM supplier WHERE s_name NOT IN (SELECT natural_key FROM meta)",
    ),
)
def load_daily_meta(spark, folder):
    """The dimension after a daily load: known artists renamed, new ones numbered on."""
    return _load(Tables(spark, folder)).meta


def _load(t: Tables):
    meta = t.supplier.filter(F.col("s_acctbal") > 2000).select(
        F.col("s_name").alias("natural_key"), F.col("s_suppkey").alias("entity_id"), F.col("s_name").alias("artist"), F.lit(True).alias("is_global")
    )
    named = t.supplier.select("s_suppkey", F.col("s_name").alias("natural_key"))
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("s_suppkey"), F.to_date("l_shipdate").alias("date"), "l_returnflag", F.col("l_quantity").cast("bigint").alias("q")
    ).filter(F.col("date") <= F.lit(AS_OF))
    now = rows.filter(F.col("date") > F.lit(SINCE)).groupBy("s_suppkey", "date").agg(F.sum("q").alias("streams"))
    old = rows.filter(F.col("l_returnflag") != "R").groupBy("s_suppkey", "date").agg(F.sum("q").alias("streams"))
    streams = now.join(named, "s_suppkey").select("natural_key", "date", "streams")
    held = old.join(named, "s_suppkey").join(meta, "natural_key").select("entity_id", "date", "streams")
    reports = meta.select("entity_id", F.lit(0).alias("tw_rank"), F.lit(back(AS_OF, 1)).alias("report_date"))
    today = named.select("natural_key", F.col("natural_key").alias("artist"), F.lit(1).alias("tw_rank"), F.lit(AS_OF).alias("report_date"))
    tables = {"meta": meta, "reports": reports, "streams": held}
    return load_daily(today, streams, tables, "natural_key", "entity_id", ["artist"], ["streams"], AS_OF)


_LOADED = (
    "SELECT m.entity_id, r.date, r.streams FROM (SELECT l_suppkey, CAST(l_shipdate AS DATE) AS date, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS streams "
    f"FROM lineitem WHERE CAST(l_shipdate AS DATE) <= DATE '{AS_OF}' AND %s GROUP BY 1, 2) r JOIN supplier s ON s.s_suppkey = r.l_suppkey JOIN %s m ON m.natural_key = s.s_name"
)


@query(
    "load_daily_counts",
    oracle(
        "SELECT 'updates' AS name, count(CASE WHEN h.entity_id IS NOT NULL AND h.streams IS DISTINCT FROM d.streams THEN 1 END) AS value FROM d LEFT JOIN h ON h.entity_id = d.entity_id AND h.date = d.date "
        "UNION ALL SELECT 'inserts', count(CASE WHEN h.entity_id IS NULL THEN 1 END) FROM d LEFT JOIN h ON h.entity_id = d.entity_id AND h.date = d.date",
        meta=_META,
        everyone="SELECT s.s_name AS natural_key, coalesce(m.entity_id, 1000000 + s.s_suppkey) AS entity_id FROM supplier s LEFT JOIN meta m ON m.natural_key = s.s_name",
        h=_LOADED % ("l_returnflag <> 'R'", "meta"),
        d=_LOADED % (f"CAST(l_shipdate AS DATE) > DATE '{SINCE}'", "everyone"),
    ),
)
def load_daily_counts(spark, folder):
    """How many stream rows a daily load inserts and updates."""
    return _load(Tables(spark, folder)).changes.counts()


_NUMBERED = (
    "SELECT s.s_suppkey, s.s_name AS natural_key, coalesce(m.entity_id, (SELECT max(entity_id) FROM meta) + n.k) AS entity_id "
    "FROM supplier s LEFT JOIN meta m ON m.natural_key = s.s_name LEFT JOIN fresh n ON n.s_name = s.s_name"
)
_FRESH = "SELECT s_name, row_number() OVER (ORDER BY s_name) AS k FROM supplier WHERE s_name NOT IN (SELECT natural_key FROM meta)"


@query(
    "load_daily_reports",
    oracle(
        f"SELECT entity_id, 0 AS tw_rank, '{back(AS_OF, 1)}' AS report_date FROM meta UNION ALL SELECT entity_id, 1, '{AS_OF}' FROM numbered",
        meta=_META, fresh=_FRESH, numbered=_NUMBERED,
    ),
)
def load_daily_reports(spark, folder):
    """The report after a daily load: the day before, and the day of the file."""
    return _load(Tables(spark, folder)).reports


@query(
    "load_daily_streams",
    oracle(
        "SELECT coalesce(d.entity_id, h.entity_id) AS entity_id, CAST(coalesce(d.date, h.date) AS VARCHAR) AS date, coalesce(d.streams, h.streams) AS streams "
        "FROM d FULL JOIN h ON h.entity_id = d.entity_id AND h.date = d.date",
        meta=_META, fresh=_FRESH, everyone=_NUMBERED,
        h=_LOADED % ("l_returnflag <> 'R'", "meta"),
        d=_LOADED % (f"CAST(l_shipdate AS DATE) > DATE '{SINCE}'", "everyone"),
    ),
)
def load_daily_streams(spark, folder):
    """The stored streams after a daily load: restated days take the file's values."""
    return _load(Tables(spark, folder)).streams.select("entity_id", "date", "streams")


@query(
    "load_global_entities",
    oracle(
        "SELECT s_name AS natural_key, CASE WHEN s_acctbal > 2000 THEN 'known ' || s_name ELSE s_name END AS artist, s_acctbal <= 2000 AS is_global FROM supplier"
    ),
)
def load_global_entities_query(spark, folder):
    """Artists that only territory files name join the dimension; known ones stay as they are."""
    t = Tables(spark, folder)
    known = t.supplier.filter(F.col("s_acctbal") > 2000).select(
        F.col("s_name").alias("natural_key"), F.concat(F.lit("known "), "s_name").alias("artist"), F.lit(False).alias("is_global")
    )
    each = t.supplier.select(F.col("s_name").alias("natural_key"), F.col("s_name").alias("artist"))
    return load_global_entities(known, each.unionByName(each), "natural_key", ["artist"])


_PROFILE = "SELECT c_custkey AS profile_id, c_mktsegment AS genres, CAST(round(c_acctbal) AS BIGINT) AS followers, DATE '2001-01-01' + CAST(c_nationkey AS INT) AS last_updated FROM customer"


def _profile_rows(t: Tables):
    return t.customer.select(
        F.col("c_custkey").alias("profile_id"), F.col("c_mktsegment").alias("genres"), F.round("c_acctbal").cast("bigint").alias("followers"),
        F.date_add(F.lit("2001-01-01").cast("date"), F.col("c_nationkey")).alias("last_updated"),
    )


_STALE = "SELECT profile_id, last_updated FROM p ORDER BY last_updated, profile_id LIMIT 100"


@query("stalest_profiles", oracle("SELECT profile_id, CAST(last_updated AS VARCHAR) AS last_updated FROM stale", p=_PROFILE, stale=_STALE))
def stalest_profiles(spark, folder):
    """The hundred profiles refreshed longest ago."""
    return stalest(_profile_rows(Tables(spark, folder)), "profile_id", 100)


@query(
    "recache_profiles",
    oracle(
        f"SELECT p.profile_id, p.genres, CASE WHEN b.n IS NULL THEN p.followers ELSE b.n END AS followers, CAST(CASE WHEN b.n IS NULL THEN p.last_updated ELSE DATE '{AS_OF}' END AS VARCHAR) AS last_updated "
        "FROM p LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders WHERE o_custkey IN (SELECT profile_id FROM stale) GROUP BY 1) b ON b.o_custkey = p.profile_id",
        p=_PROFILE,
        stale="SELECT profile_id FROM p ORDER BY last_updated, profile_id LIMIT 2000",
    ),
)
def recache_profiles(spark, folder):
    """Fresh order counts replace the followers of the stalest profiles that have any."""
    t = Tables(spark, folder)
    fresh = t.orders.groupBy(F.col("o_custkey").alias("profile_id")).agg(F.count(F.lit(1)).alias("followers"))
    return recache(_profile_rows(t), fresh, "profile_id", ["followers"], AS_OF)


@query(
    "colour_patch",
    oracle(
        "SELECT e.p_partkey AS song_id, e.image, CASE WHEN e.c = '#000000' AND e.image <> '' AND s.label IS NOT NULL THEN '#' || s.label ELSE e.c END AS dominant_color "
        "FROM (SELECT p_partkey, CASE WHEN p_size = 1 THEN '' ELSE p_brand END AS image, CASE WHEN p_type = 'ECONOMY' THEN '#000000' ELSE '#ffffff' END AS c FROM part) e "
        "LEFT JOIN (SELECT p_brand, CAST(min(p_size) AS VARCHAR) AS label FROM part GROUP BY 1) s ON s.p_brand = e.image"
    ),
)
def colour_patch(spark, folder):
    t = Tables(spark, folder)
    songs = t.part.select(
        F.col("p_partkey").alias("song_id"), F.when(F.col("p_size") == 1, "").otherwise(F.col("p_brand")).alias("image"),
        F.when(F.col("p_type") == "ECONOMY", "#000000").otherwise("#ffffff").alias("dominant_color"),
    )
    colours = t.part.groupBy(F.col("p_brand").alias("image")).agg(F.concat(F.lit("#"), F.min("p_size").cast("string")).alias("colour"))
    return patch_colours(songs, colours, "song_id")


_IDS = {1: "twitter_id", 2: "instagram_id", 3: "youtube_id", 6: "gtrends_id", 7: "soundcloud_id"}
_PIV = "SELECT l_suppkey AS target_id, " + ", ".join(
    f"min(CASE WHEN l_linenumber = {c} THEN CAST(l_partkey AS VARCHAR) END) AS {n}" for c, n in _IDS.items()
) + " FROM lineitem GROUP BY 1"


@query(
    "id_map_refresh",
    oracle(
        "SELECT s.s_suppkey AS artist_id, CASE WHEN s.s_acctbal < 0 THEN 'old' ELSE CAST(s.s_suppkey AS VARCHAR) END AS target_id, "
        + ", ".join(f"CASE WHEN s.s_acctbal < 0 THEN NULL ELSE p.{n} END AS {n}" for n in _IDS.values())
        + " FROM supplier s LEFT JOIN piv p ON p.target_id = s.s_suppkey",
        piv=_PIV,
    ),
)
def id_map_refresh(spark, folder):
    """Unmapped artists get their platform ids; mapped ones stay as they are."""
    t = Tables(spark, folder)
    blank = {n: F.lit(None).cast("string") for n in _IDS.values()}
    current = t.supplier.filter(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("artist_id"), F.lit("old").alias("target_id")).withColumns(blank)
    directory = t.lineitem.select(
        F.col("l_suppkey").alias("target_id"), F.col("l_linenumber").alias("type"), F.col("l_partkey").cast("string").alias("account_id")
    )
    people = t.supplier.select(F.col("s_suppkey").alias("artist_id"), F.col("s_suppkey").alias("target_id"))
    return refresh_id_map(current, people, directory)


@query(
    "cache_extend",
    oracle(
        "SELECT p_partkey AS song_id, p_name AS title FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem) OR p_size < 10"
    ),
)
def cache_extend(spark, folder):
    """Sold parts missing from a cache of the small ones are appended."""
    t = Tables(spark, folder)
    landed = t.part.select(F.col("p_partkey").cast("string").alias("song_id"), F.col("p_name").alias("title"))
    cache = t.part.filter(F.col("p_size") < 10).select(F.col("p_partkey").cast("string").alias("song_id"), F.col("p_name").alias("title"))
    wanted = t.lineitem.select(F.col("l_partkey").cast("string").alias("song_id"))
    out = extend_cache(cache, wanted, landed, "song_id")
    return out.withColumn("song_id", F.col("song_id").cast("bigint"))
