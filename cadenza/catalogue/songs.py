"""Song forms of the feed loads, and outside charts matched to own songs."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.catalogue.charting import chart_kinds
from cadenza.catalogue.domain import AS_OF, Tables, sales
from cadenza.catalogue.labelling import fuzzy_sql
from cadenza.catalogue.landing import DAYS
from cadenza.catalogue.registry import oracle, query
from cadenza.functions.dates import back
from cadenza.operators.reshape import pivot_dates
from cadenza.plans.ingest import daily_songs, load_daily, load_territory_stats, territory_daily, territory_weekly
from cadenza.plans.own_charts import own_chart
from cadenza.sources.contracts import DAY_COLUMN, LIFETIME_PREFIX, PRIOR_DAY_COLUMN, SERIES_SUFFIX, SONG_COLUMNS, WEEKLY_COLUMNS
from cadenza.sources.files import ORDINAL, sample_rows

#: Return flags behind each of the three series of a song: all, premium, ad-supported.
FLAGS = {"streams": ("A", "N", "R"), "premium": ("A",), "ad_supported": ("N",)}
_SUMS = ", ".join(
    f"CAST(sum(CASE WHEN l_returnflag IN ({', '.join(repr(f) for f in flags)}) THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS {name}"
    for name, flags in FLAGS.items()
)
_SONG_DAYS = f"SELECT l_partkey AS p_partkey, CAST(l_shipdate AS DATE) AS date, {_SUMS} FROM lineitem WHERE %s GROUP BY 1, 2"


def _song_days(t: Tables, where="true"):
    rows = t.lineitem.select(
        F.col("l_partkey").alias("p_partkey"), F.to_date("l_shipdate").alias("date"), "l_returnflag", "l_linenumber", F.col("l_quantity").cast("bigint").alias("q")
    )
    sums = [F.sum(F.when(F.col("l_returnflag").isin(*flags), F.col("q")).otherwise(0)).alias(name) for name, flags in FLAGS.items()]
    return rows.filter(where).groupBy("p_partkey", "date").agg(*sums)


def song_feed(t: Tables):
    """A daily song file: parts with three series of 14 days, some rows twice, some cells missing."""
    days = _song_days(t)
    wide = t.part.select("p_partkey", "p_name", "p_brand", "p_type", "p_size", F.col("p_partkey").cast("double").alias("n"))
    for name, suffix in SERIES_SUFFIX.items():
        heads = {d.isoformat(): d.strftime("%m/%d/%Y") + suffix for d in DAYS}
        wide = wide.join(pivot_dates(days, ["p_partkey"], DAYS, name).withColumnsRenamed(heads), "p_partkey", "left")
    given = {
        "Artist": F.when(F.col("p_size") != 1, F.col("p_brand")),
        "Title": F.when(F.col("p_size") != 2, F.col("p_name")),
        "Unified Song Id": F.when(F.col("p_size") != 3, F.col("n")).cast("string"),
        "Label Abbrev": F.col("p_brand"),
        "CoreGenre": F.col("p_type"),
        "Release_date": F.when(F.col("p_size") > 25, "03/05/1999").when(F.col("p_size") > 20, "1998-07-01"),
        "Top ISRC": F.concat(F.lit("I"), F.col("p_partkey").cast("string")),
    }
    plain = {c: (F.col("n") + i).cast("string") for i, c in enumerate(SONG_COLUMNS) if c not in given}
    series = [F.col(f"`{d.strftime('%m/%d/%Y')}{s}`").cast("string").alias(d.strftime("%m/%d/%Y") + s) for s in SERIES_SUFFIX.values() for d in DAYS]
    once = wide.select(*[({**given, **plain})[c].alias(c) for c in SONG_COLUMNS], *series, F.lit(1).alias("copy"))
    again = once.filter(F.col("CoreGenre") == "ECONOMY").withColumns({"copy": F.lit(2), "Title": F.lit("repeated")})
    return once.unionByName(again).withColumn(ORDINAL, F.struct("copy", "Unified Song Id")).drop("copy")


_AT = {c: i for i, c in enumerate(SONG_COLUMNS)}
_SONG_META = (
    "SELECT CAST(p_partkey AS VARCHAR) AS unified_song_id, CASE WHEN p_size = 1 THEN 'Unknown' ELSE p_brand END AS artist, CASE WHEN p_size = 2 THEN 'Unknown' ELSE p_name END AS title, "
    f"p_brand AS label, p_type AS core_genre, CASE WHEN p_size > 25 THEN '1999-03-05' WHEN p_size > 20 THEN '1998-07-01' ELSE '{AS_OF}' END AS release_date, 'I' || CAST(p_partkey AS VARCHAR) AS isrc, "
    f"p_partkey + {_AT['TW Rank']} AS tw_rank, p_partkey + {_AT['RTD On-Demand Audio Streams - Premium']} AS rtd_oda_streams_premium, p_partkey + {_AT['RTD On-Demand Audio Streams - Ad Supported']} AS rtd_oda_streams_ad_supported, "
    f"p_partkey + {_AT['ATD On-Demand Video']} AS atd_odv, false AS signed, '{AS_OF}' AS report_date FROM part WHERE p_size <> 3"
)


@query("ingest_song_meta", oracle(_SONG_META))
def ingest_song_meta(spark, folder):
    """The report rows of a daily song file: missing names and dates filled in, repeats and rows without a key gone."""
    meta, _ = daily_songs(song_feed(Tables(spark, folder)))
    return meta.select(
        "unified_song_id", "artist", "title", "label", "core_genre", "release_date", "isrc", "tw_rank",
        "rtd_oda_streams_premium", "rtd_oda_streams_ad_supported", "atd_odv", "signed", "report_date",
    )


@query(
    "ingest_song_streams",
    oracle(
        f"SELECT CAST(p.p_partkey AS VARCHAR) AS unified_song_id, CAST(DATE '{AS_OF}' - i.i AS VARCHAR) AS date, coalesce(d.streams, 0) AS streams, coalesce(d.premium, 0) AS premium, coalesce(d.ad_supported, 0) AS ad_supported "
        f"FROM part p CROSS JOIN (SELECT CAST(unnest(range(14)) AS INT) AS i) i LEFT JOIN d ON d.p_partkey = p.p_partkey AND d.date = DATE '{AS_OF}' - i.i WHERE p.p_size <> 3",
        d=_SONG_DAYS % "true",
    ),
)
def ingest_song_streams(spark, folder):
    """Total, premium and ad-supported streams of each song and day of the file."""
    return daily_songs(song_feed(Tables(spark, folder)))[1]


_HELD = _SONG_DAYS % "l_returnflag <> 'R' AND l_linenumber < 4"
_IDS = (
    "SELECT p.p_partkey, coalesce(m.song_id, (SELECT max(song_id) FROM known) + f.k) AS song_id FROM part p LEFT JOIN known m ON m.p_partkey = p.p_partkey "
    "LEFT JOIN (SELECT p_partkey, row_number() OVER (ORDER BY CAST(p_partkey AS VARCHAR)) AS k FROM part WHERE p_size <> 3 AND p_partkey NOT IN (SELECT p_partkey FROM known)) f ON f.p_partkey = p.p_partkey WHERE p.p_size <> 3"
)
_KNOWN = "SELECT p_partkey, p_partkey + 5000 AS song_id FROM part WHERE p_size > 10"
_FILE = (
    f"SELECT s.song_id, DATE '{AS_OF}' - i.i AS date, coalesce(d.streams, 0) AS streams, coalesce(d.premium, 0) AS premium, coalesce(d.ad_supported, 0) AS ad_supported "
    f"FROM ids s CROSS JOIN (SELECT CAST(unnest(range(14)) AS INT) AS i) i LEFT JOIN d ON d.p_partkey = s.p_partkey AND d.date = DATE '{AS_OF}' - i.i"
)
_STORED = "SELECT k.song_id, x.date, x.streams, x.premium, x.ad_supported FROM h x JOIN known k ON k.p_partkey = x.p_partkey"
_PARTS = {"d": _SONG_DAYS % "true", "h": _HELD, "known": _KNOWN, "ids": _IDS, "file": _FILE, "held": _STORED}


def _load(t: Tables):
    meta, streams = daily_songs(song_feed(t))
    code, known = F.col("p_partkey").cast("string"), t.part.filter("p_size > 10")
    stored = known.select(code.alias("unified_song_id"), (F.col("p_partkey") + 5000).alias("song_id"), F.col("p_name").alias("title"), F.lit(True).alias("is_global"))
    early = _song_days(t, "l_returnflag <> 'R' AND l_linenumber < 4")
    held = early.join(known.select("p_partkey"), "p_partkey").select((F.col("p_partkey") + 5000).alias("song_id"), "date", *FLAGS)
    reports = stored.select("song_id", F.lit(0).cast("bigint").alias("tw_rank"), F.lit(back(AS_OF, 1)).alias("report_date"))
    tables = {"meta": stored, "reports": reports, "streams": held}
    return load_daily(meta, streams, tables, "unified_song_id", "song_id", ["title"], list(FLAGS), AS_OF)


@query(
    "load_song_streams",
    oracle(
        "SELECT coalesce(f.song_id, s.song_id) AS song_id, CAST(coalesce(f.date, s.date) AS VARCHAR) AS date, coalesce(f.streams, s.streams) AS streams, coalesce(f.premium, s.premium) AS premium, "
        "coalesce(f.ad_supported, s.ad_supported) AS ad_supported FROM file f FULL JOIN held s ON s.song_id = f.song_id AND s.date = f.date",
        **_PARTS,
    ),
)
def load_song_streams(spark, folder):
    """The stored song streams after a daily load: all three series of restated days are replaced."""
    return _load(Tables(spark, folder)).streams.select("song_id", "date", *FLAGS)


@query(
    "load_song_counts",
    oracle(
        "SELECT 'updates' AS name, count(CASE WHEN s.song_id IS NOT NULL AND (s.streams, s.premium, s.ad_supported) IS DISTINCT FROM (f.streams, f.premium, f.ad_supported) THEN 1 END) AS value FROM file f LEFT JOIN held s ON s.song_id = f.song_id AND s.date = f.date "
        "UNION ALL SELECT 'inserts', count(CASE WHEN s.song_id IS NULL THEN 1 END) FROM file f LEFT JOIN held s ON s.song_id = f.song_id AND s.date = f.date",
        **_PARTS,
    ),
)
def load_song_counts(spark, folder):
    """A change in any of the three series is an update."""
    return _load(Tables(spark, folder)).changes.counts()


@query(
    "load_song_meta",
    oracle(
        "SELECT CAST(p.p_partkey AS VARCHAR) AS unified_song_id, coalesce(i.song_id, k.song_id) AS song_id, CASE WHEN p.p_size = 2 THEN 'Unknown' ELSE p.p_name END AS title, i.song_id IS NULL AS is_global "
        "FROM part p LEFT JOIN ids i ON i.p_partkey = p.p_partkey LEFT JOIN known k ON k.p_partkey = p.p_partkey WHERE i.song_id IS NOT NULL OR k.song_id IS NOT NULL",
        known=_KNOWN, ids=_IDS,
    ),
)
def load_song_meta(spark, folder):
    """The song dimension after a daily load: new songs are numbered on, songs of the file are no longer territory-only."""
    return _load(Tables(spark, folder)).meta


def _territory_songs(t: Tables):
    """A daily territory file of songs: two days, some names missing."""
    two = {AS_OF.isoformat(): DAY_COLUMN, back(AS_OF, 1).isoformat(): PRIOR_DAY_COLUMN}
    wide = pivot_dates(_song_days(t), ["p_partkey"], DAYS[:2], "streams").withColumnsRenamed(two)
    key = F.col("p_partkey").cast("double").cast("string")
    return t.part.join(wide, "p_partkey", "left").select(
        key.alias("UnifiedSongID"), F.when(F.col("p_size") > 5, F.col("p_name")).alias("Title"), F.when(F.col("p_size") > 9, F.col("p_brand")).alias("Artist"),
        F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("Top ISRC"), F.col(f"`{DAY_COLUMN}`").cast("string").alias(DAY_COLUMN), F.col(f"`{PRIOR_DAY_COLUMN}`").cast("string").alias(PRIOR_DAY_COLUMN),
        F.struct("p_partkey").alias(ORDINAL),
    )


@query(
    "ingest_territory_songs",
    oracle(
        f"SELECT CAST(p.p_partkey AS VARCHAR) AS unified_song_id, CAST(DATE '{AS_OF}' - i.i AS VARCHAR) AS date, coalesce(d.streams, 0) AS streams, 'north_land' AS territory FROM part p CROSS JOIN (SELECT CAST(unnest(range(2)) AS INT) AS i) i "
        f"LEFT JOIN d ON d.p_partkey = p.p_partkey AND d.date = DATE '{AS_OF}' - i.i",
        d=_SONG_DAYS % "true",
    ),
)
def ingest_territory_songs(spark, folder):
    """The named day and the day before, of each song of a territory."""
    return territory_daily(_territory_songs(Tables(spark, folder)), "unified_song_id", ["title", "artist", "isrc"], AS_OF, "north_land")[1]


@query(
    "ingest_territory_song_meta",
    oracle(
        "SELECT CAST(p_partkey AS VARCHAR) AS unified_song_id, CASE WHEN p_size > 5 THEN p_name ELSE 'Unknown' END AS title, CASE WHEN p_size > 9 THEN p_brand ELSE 'Unknown' END AS artist, "
        "'I' || CAST(p_partkey AS VARCHAR) AS isrc, true AS is_global FROM part"
    ),
)
def ingest_territory_song_meta(spark, folder):
    return territory_daily(_territory_songs(Tables(spark, folder)), "unified_song_id", ["title", "artist", "isrc"], AS_OF, "north_land")[0]


_YEARS = (
    "SELECT global_id, song_id, CAST(sum(CASE WHEN d > DATE '%(a)s' - 365 THEN q ELSE 0 END) AS BIGINT) AS tw, CAST(sum(CASE WHEN d <= DATE '%(a)s' - 365 AND d > DATE '%(a)s' - 730 THEN q ELSE 0 END) AS BIGINT) AS lw, "
    "CAST(sum(CASE WHEN year(d) = 2001 THEN q ELSE 0 END) AS BIGINT) AS ytd, CAST(sum(q) AS BIGINT) AS rtd, count(*) AS sold FROM sales GROUP BY 1, 2"
) % {"a": AS_OF}


def _weekly_songs(t: Tables):
    """Weekly territory files of songs with all their measures, best first per territory."""
    d, q = F.col("date"), F.col("streams")
    year, two = F.lit(back(AS_OF, 365)), F.lit(back(AS_OF, 730))
    sums = sales(t).groupBy("global_id", "song_id").agg(
        F.sum(F.when(d > year, q).otherwise(0)).alias("tw"), F.sum(F.when((d <= year) & (d > two), q).otherwise(0)).alias("lw"),
        F.sum(F.when(F.year(d) == 2001, q).otherwise(0)).alias("ytd"), F.sum(q).alias("rtd"), F.count(F.lit(1)).alias("sold"),
    )
    names = {v: k for k, v in WEEKLY_COLUMNS.items()}
    text = {"tw_streams": "tw", "lw_streams": "lw", "ytd_streams": "ytd", "digital_song_sales_tw": "sold"}
    return sums.select(
        F.concat(F.lit("North Land "), F.col("global_id").cast("string")).alias(names["country"]),
        F.col("song_id").cast("double").cast("string").alias("UnifiedSongID"),
        F.when(F.col("song_id") % 7 != 0, F.concat(F.lit("t"), F.col("song_id").cast("string"))).alias("Title"),
        F.lit(None).cast("string").alias("Artist"),
        F.concat(F.lit("I"), F.col("song_id").cast("string")).alias("Top ISRC"),
        *[F.col(c).cast("string").alias(names[k]) for k, c in text.items()],
        F.concat((F.col("tw") - F.col("lw")).cast("string"), F.lit("%")).alias(names["pct_chg"]),
        F.col("rtd").cast("string").alias(f"{LIFETIME_PREFIX} 2022"),
        F.struct((-F.col("tw")).alias("a"), F.col("song_id").alias("b")).alias(ORDINAL),
    )


@query(
    "ingest_weekly_songs",
    oracle(
        "SELECT 'north_land_' || CAST(global_id AS VARCHAR) AS country, CAST(song_id AS VARCHAR) AS unified_song_id, CASE WHEN song_id % 7 <> 0 THEN 't' || CAST(song_id AS VARCHAR) ELSE 'Unknown' END AS title, 'Unknown' AS artist, "
        "'I' || CAST(song_id AS VARCHAR) AS isrc, row_number() OVER (PARTITION BY global_id ORDER BY tw DESC, song_id) AS rnk, CAST(tw - lw AS DOUBLE) AS pct_chg, tw AS tw_streams, lw AS lw_streams, ytd AS ytd_streams, rtd AS rtd_streams, sold AS digital_song_sales_tw FROM y",
        y=_YEARS,
    ),
)
def ingest_weekly_songs(spark, folder):
    """Weekly song stats with every measure of the file; the rank is the place in it."""
    return territory_weekly(_weekly_songs(Tables(spark, folder)), "unified_song_id", ["title", "artist", "isrc"])


@query(
    "load_weekly_songs",
    oracle(
        "SELECT global_id, song_id, row_number() OVER (PARTITION BY global_id ORDER BY tw DESC, song_id) AS rnk, tw AS tw_streams, lw AS lw_streams, CAST(tw - lw AS DOUBLE) AS pct_chg, ytd AS ytd_streams, rtd AS rtd_streams, sold AS digital_song_sales_tw FROM y "
        "UNION ALL SELECT n_nationkey, p_partkey, 1, 2, 3, 4e0, 5, 6, 7 FROM nation JOIN part ON p_partkey % 25 = n_nationkey WHERE NOT EXISTS (SELECT 1 FROM y WHERE y.global_id = n_nationkey AND y.song_id = p_partkey)",
        y=_YEARS,
    ),
)
def load_weekly_songs(spark, folder):
    """Weekly song stats upserted by (territory, song) into a filled table; songs that the files lack stay."""
    t = Tables(spark, folder)
    stats = territory_weekly(_weekly_songs(t), "unified_song_id", ["title", "artist", "isrc"])
    ids = t.part.select(F.col("p_partkey").cast("string").alias("unified_song_id"), F.col("p_partkey").alias("song_id"))
    places = t.nation.select(F.concat(F.lit("north_land_"), F.col("n_nationkey").cast("string")).alias("name"), F.col("n_nationkey").alias("global_id"))
    whole = {"rnk": 1, "tw_streams": 2, "lw_streams": 3, "ytd_streams": 5, "rtd_streams": 6, "digital_song_sales_tw": 7}
    on = F.col("p_partkey") % 25 == F.col("n_nationkey")
    current = t.part.join(t.nation, on).select(
        F.col("n_nationkey").alias("global_id"), F.col("p_partkey").alias("song_id"), *[F.lit(v).cast("bigint").alias(k) for k, v in whole.items()], F.lit(4.0).alias("pct_chg")
    )
    return load_territory_stats(current, stats, ids, places, "unified_song_id", "song_id")


@query(
    "sample_rows",
    oracle(
        "SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders ORDER BY md5(CAST(o_orderkey AS VARCHAR) || '|' || o_orderstatus || '|' || o_orderpriority || '|42'), o_orderkey LIMIT 1000"
    ),
)
def sample_rows_query(spark, folder):
    """A thousand orders by chance, the same ones in every run."""
    return sample_rows(Tables(spark, folder).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority"))


_OWN = "SELECT p_partkey AS entity_id, 'S' || CAST(p_partkey AS VARCHAR) AS own_id, p_name || CASE WHEN p_size > 40 THEN ' y' ELSE '' END AS artist, CASE WHEN p_size <> 5 THEN p_brand || ' Records' END AS copyrights, p_size = 9 AS signed FROM part WHERE p_type <> 'SMALL'"
_LABELS = "SELECT DISTINCT p_brand AS label FROM part WHERE p_size = 3 AND p_type = 'ECONOMY'"
_ARTISTS = "SELECT DISTINCT p_name AS artist FROM part WHERE p_size = 4 AND p_brand = 'Brand#3'"
_UNIQUE = "SELECT user_id AS entity_id, strftime(ts, '%d') AS chart, min(event_type) AS type FROM events GROUP BY 1, 2"


@query(
    "own_chart",
    oracle(
        "SELECT u.entity_id, u.chart, u.type, c.chart_count, o.own_id, coalesce(o.signed, false) OR coalesce(EXISTS (SELECT 1 FROM labs l WHERE contains(lower(o.copyrights), lower(l.label))), false) OR coalesce(o.artist IN (SELECT t FROM f_out), false) AS signed "
        "FROM u JOIN (SELECT entity_id, count(*) AS chart_count FROM u GROUP BY 1) c ON c.entity_id = u.entity_id LEFT JOIN own o ON o.entity_id = u.entity_id",
        u=_UNIQUE, own=_OWN, labs=_LABELS, listed=_ARTISTS,
        **fuzzy_sql("f", "SELECT artist AS t FROM own", "SELECT artist AS t FROM listed", 0.95),
    ),
)
def own_chart_query(spark, folder):
    """Chart rows with the number of charts of their entity, its own id, and whether it is signed."""
    t = Tables(spark, folder)
    own = t.part.filter(F.col("p_type") != "SMALL").select(
        F.col("p_partkey").alias("entity_id"),
        F.concat(F.lit("S"), F.col("p_partkey").cast("string")).alias("own_id"),
        F.concat("p_name", F.when(F.col("p_size") > 40, " y").otherwise("")).alias("artist"),
        F.when(F.col("p_size") != 5, F.concat("p_brand", F.lit(" Records"))).alias("copyrights"),
        (F.col("p_size") == 9).alias("signed"),
    )
    labels = t.part.filter("p_size = 3 AND p_type = 'ECONOMY'").select(F.col("p_brand").alias("label")).distinct()
    listed = t.part.filter("p_size = 4 AND p_brand = 'Brand#3'").select(F.col("p_name").alias("artist")).distinct()
    out = own_chart(chart_kinds(t), [F.col("type").asc(), F.col("event_id").asc()], own, labels, listed)
    return out.select("entity_id", "chart", "type", "chart_count", "own_id", "signed")
