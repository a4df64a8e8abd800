"""Nested objects, file names, dates and the feed loads on derived frames."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cadenza.catalogue.domain import AS_OF, Tables, artist_streams
from cadenza.catalogue.registry import oracle, query
from cadenza.functions.dates import back, complete_date, parse_date, year_week_start
from cadenza.functions.numeric import id_text
from cadenza.operators.reshape import pivot_dates
from cadenza.plans.enrich import artist_facts, profile_candidates, song_facts
from cadenza.plans.ingest import daily_artists, load_territory_stats, mapping_artists, mapping_collections, mapping_links, mapping_songs, territory_daily, territory_weekly
from cadenza.sources.contracts import ARTIST_COLUMNS, DAY_COLUMN, LIFETIME_PREFIX, PRIOR_DAY_COLUMN, WEEKLY_COLUMNS
from cadenza.sources.files import ORDINAL, advance_marks, beyond_mark, daily_files, latest_per_territory, parse_mapping, unprocessed, weekly_files
from cadenza.sources.nested import (
    ALBUM,
    ARTIST,
    CHART,
    GENRE_ITEMS,
    TRACK,
    album_rows,
    artist_rows,
    chart_entries,
    genre_chart_rows,
    parsed,
    top_tracks,
    track_rows,
    with_audio_features,
)


@query("json_flatten", oracle("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events"))
def json_flatten(spark, folder):
    t = Tables(spark, folder)
    return parsed(t.events.select("event_id", "props"), "props", "k int").select("event_id", F.col("o.k").alias("k"))


def _pictures(height):
    """Three images of which the second is tallest; none for the smallest parts."""
    some = F.array(*[F.struct(h.cast("int").alias("height"), F.concat(F.lit(f"u{i}/"), height.cast("string")).alias("url")) for i, h in enumerate((height, height + 10, height + 5))])
    return F.when(height > 3, some).otherwise(F.array().cast(some_type()))


def some_type() -> str:
    return "array<struct<height:int,url:string>>"


def track_objects(t: Tables):
    """Parts as track objects in JSON text."""
    p = t.part
    song = F.struct(
        F.lit(1).alias("disc_number"),
        (F.col("p_size") * 1000).alias("duration_ms"),
        (F.col("p_type") == "ECONOMY").alias("explicit"),
        F.struct(F.concat(F.lit("I"), F.col("p_partkey").cast("string")).alias("isrc")).alias("external_ids"),
        F.col("p_partkey").cast("string").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_size").alias("popularity"),
        F.col("p_size").alias("track_number"),
        F.struct(
            F.col("p_brand").alias("id"),
            _pictures(F.col("p_size")).alias("images"),
            F.when(F.col("p_size") < 10, "1999").when(F.col("p_size") < 20, "1999-05").otherwise("1999-05-07").alias("release_date"),
            F.col("p_size").alias("total_tracks"),
            F.lit("album").alias("type"),
        ).alias("album"),
        F.when(F.col("p_size") > 5, F.array(F.struct(F.col("p_type").alias("id"), F.col("p_type").alias("name")), F.struct(F.lit("x").alias("id"), F.lit("y").alias("name"))))
        .otherwise(F.array().cast("array<struct<id:string,name:string>>"))
        .alias("artists"),
    )
    return p.select("p_partkey", F.to_json(song).alias("json"))


_IMAGE = "CASE WHEN p_size > 3 THEN 'u1/' || CAST(p_size AS VARCHAR) END"


@query(
    "track_objects",
    oracle(
        f"SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS track_id, 'I' || CAST(p_partkey AS VARCHAR) AS isrc, p_name AS name, p_size * 1000 AS duration_ms, p_type = 'ECONOMY' AS explicit, p_size AS popularity, p_brand AS album_id, 'album' AS album_type, "
        f"CASE WHEN p_size < 10 THEN '1999-01-01' WHEN p_size < 20 THEN '1999-05-01' ELSE '1999-05-07' END AS release_date, CASE WHEN p_size > 5 THEN p_type END AS platform_artist_id, {_IMAGE} AS image FROM part"
    ),
)
def track_objects_query(spark, folder):
    rows = track_rows(parsed(track_objects(Tables(spark, folder)), "json", TRACK).drop("json"))
    return rows.select("p_partkey", "track_id", "isrc", "name", "duration_ms", "explicit", "popularity", "album_id", "album_type", "release_date", "platform_artist_id", "image")


@query(
    "artist_objects",
    oracle(f"SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS platform_artist_id, p_name AS name, 7 AS followers, CASE WHEN p_size > 5 THEN replace(p_name, ' ', '/') END AS genres, p_size AS popularity, {_IMAGE} AS image FROM part"),
)
def artist_objects(spark, folder):
    t = Tables(spark, folder)
    thing = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.struct(F.lit(7).alias("total")).alias("followers"),
        F.when(F.col("p_size") > 5, F.split("p_name", " ")).otherwise(F.array().cast("array<string>")).alias("genres"),
        F.col("p_name").alias("name"),
        F.col("p_size").alias("popularity"),
        _pictures(F.col("p_size")).alias("images"),
    )
    rows = artist_rows(parsed(t.part.select("p_partkey", F.to_json(thing).alias("json")), "json", ARTIST).drop("json"))
    return rows.select("p_partkey", "platform_artist_id", "name", "followers", "genres", "popularity", "image")


@query(
    "album_objects",
    oracle("SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS album_id, p_name AS album_name, CASE WHEN p_size > 5 THEN 'P ' || p_brand || '/C ' || p_type END AS copyrights, p_brand AS label, CASE WHEN p_size > 9 THEN 'U' ELSE '' END AS upc, CASE WHEN p_size = 1 THEN '2000-01-01' ELSE '0199-01-01' END AS release_date FROM part"),
)
def album_objects(spark, folder):
    t = Tables(spark, folder)
    none = F.array().cast("array<struct<text:string>>")
    two = F.array(F.struct(F.concat(F.lit("P "), F.col("p_brand")).alias("text")), F.struct(F.concat(F.lit("C "), F.col("p_type")).alias("text")))
    thing = F.struct(
        F.col("p_partkey").cast("string").alias("id"),
        F.when(F.col("p_size") > 5, two).otherwise(none).alias("copyrights"),
        F.col("p_brand").alias("label"),
        F.struct(F.when(F.col("p_size") > 9, "U").alias("upc")).alias("external_ids"),
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") == 1, "0000").otherwise("0199").alias("release_date"),
    )
    rows = album_rows(parsed(t.part.select("p_partkey", F.to_json(thing).alias("json")), "json", ALBUM).drop("json"))
    return rows.select("p_partkey", "album_id", "album_name", "copyrights", "label", "upc", "release_date")


@query(
    "top_track",
    oracle(
        "SELECT artist_id, CAST(min_by(song_id, (-q, song_id)) AS VARCHAR) AS popular_track_id, 'A' || CAST(min_by(song_id, (-q, song_id)) AS VARCHAR) AS popular_album_id "
        "FROM (SELECT l_suppkey AS artist_id, l_partkey AS song_id, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS q FROM lineitem GROUP BY 1, 2) GROUP BY 1"
    ),
)
def top_track(spark, folder):
    """The first element of each supplier's ranked list of its ten best parts."""
    from cadenza.operators.keys import rank_per_key

    t = Tables(spark, folder)
    sums = t.lineitem.groupBy(F.col("l_suppkey").alias("artist_id"), F.col("l_partkey").alias("song_id")).agg(F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    ten = rank_per_key(sums, ["artist_id"], [F.col("q").desc(), F.col("song_id").asc()], "rnk").filter(F.col("rnk") <= 10)
    song = F.struct("rnk", F.col("song_id").cast("string").alias("id"), F.struct(F.concat(F.lit("A"), F.col("song_id").cast("string")).alias("id")).alias("album"))
    lists = ten.groupBy("artist_id").agg(F.array_sort(F.collect_list(song)).alias("tracks"))
    return top_tracks(lists, "tracks")


@query(
    "audio_features",
    oracle("SELECT p_partkey AS track_id, p_name AS name, CASE WHEN p_type = 'ECONOMY' THEN p_retailprice END AS tempo, CASE WHEN p_type = 'ECONOMY' THEN p_size ELSE 0 END AS key FROM part"),
)
def audio_features(spark, folder):
    t = Tables(spark, folder)
    features = t.part.filter(F.col("p_type") == "ECONOMY").select(
        F.col("p_partkey").alias("id"), F.col("p_retailprice").alias("tempo"), F.col("p_size").alias("key"), F.lit("u").alias("uri"), F.lit("audio").alias("type")
    )
    return with_audio_features(t.part.select(F.col("p_partkey").alias("track_id"), F.col("p_name").alias("name")), features)


_KIND = "CASE WHEN event_type IN ('click', 'view') THEN 'track' WHEN event_type = 'error' THEN 'album' ELSE 'artist' END"


@query(
    "chart_entries",
    oracle(
        f"SELECT event_id, k AS type, strftime(ts, '%d') AS chart, j AS position, CASE WHEN k = 'artist' THEN '' ELSE 'n' || CAST(event_id AS VARCHAR) END AS title, CASE WHEN k = 'artist' THEN 'n' || CAST(event_id AS VARCHAR) ELSE 'a/b' END AS artist, "
        f"CAST(user_id AS VARCHAR) AS entity_id, CAST(event_id + j AS INT) AS current_rank, CASE WHEN value > 10 THEN CAST(floor(value) AS BIGINT) ELSE 0 END AS streams FROM (SELECT *, {_KIND} AS k, CAST(unnest(range(2)) AS INT) AS j FROM events) WHERE j = 0 OR value <= 50"
    ),
)
def chart_entries_query(spark, folder):
    """A chart object of two entries per event; the second lacks required fields for high values."""
    t = Tables(spark, folder)
    kind = F.when(F.col("event_type").isin("click", "view"), "track").when(F.col("event_type") == "error", "album").otherwise("artist")

    def about(k):
        people = F.array(F.struct(F.lit("a").alias("name")), F.struct(F.lit("b").alias("name")))
        named = F.struct(
            F.concat(F.lit("n"), F.col("event_id").cast("string")).alias(f"{k}Name"),
            F.concat(F.lit(f"p:{k}:"), F.col("user_id").cast("string")).alias(f"{k}Uri"),
            people.alias("artists"),
        )
        return F.when(kind == k, named).alias(f"{k}Metadata")

    def entry(place, missing):
        facts = F.struct(
            (F.col("event_id") + place).cast("int").alias("currentRank"),
            F.when(F.col("value") > 10, F.struct(F.floor("value").alias("value"))).alias("rankingMetric"),
        )
        return F.struct(about("track"), about("album"), about("artist"), facts.alias("chartEntryData"), missing.alias("missingRequiredFields"))

    lead = F.when(kind == "track", "regional-daily").when(kind == "album", "album-daily").otherwise("artist-daily")
    entries = F.array(entry(0, F.lit(None).cast("boolean")), entry(1, F.col("value") > 50))
    charts = t.events.select(
        "event_id", lead.alias("category"), F.date_format("ts", "dd").alias("chart"), F.to_json(F.struct(entries.alias("entries"))).alias("json")
    )
    rows = chart_entries(parsed(charts, "json", CHART).drop("json"))
    return rows.select("event_id", "type", "chart", "position", "title", "artist", "entity_id", "current_rank", "streams")


@query(
    "genre_pages",
    oracle("SELECT event_type AS genre, CAST(event_id AS VARCHAR) AS item_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id, j) AS rank, user_id + j AS views, CASE WHEN event_id % 2 = 0 THEN event_id ELSE 0 END AS concurrents, event_id % 3 = 0 AS is_hot, 'e' || chr(769) || ' t' || CAST(event_id AS VARCHAR) AS title, 'n' || chr(771) || ' fi' AS artist FROM (SELECT *, unnest(range(2)) AS j FROM events)"),
)
def genre_pages(spark, folder):
    """Paged genre charts, a page of two items per event, to rows ranked over all pages."""
    t = Tables(spark, folder)

    def item(place):
        stats = F.struct(
            F.when(F.col("event_id") % 2 == 0, F.col("event_id")).alias("concurrents"), F.when(F.col("event_id") % 3 == 0, True).alias("hot"), (F.col("user_id") + place).alias("pageviews")
        )
        title = F.concat(F.lit("é t"), F.col("event_id").cast("string"))
        about = F.struct(F.col("event_id").alias("id"), title.alias("full_title"), F.lit("ñ ﬁ").alias("artist_names"), stats.alias("stats"))
        return F.struct(about.alias("item"))

    pages = t.events.select(F.col("event_type").alias("genre"), F.col("event_id").alias("page"), F.to_json(F.array(item(0), item(1))).alias("json"))
    return genre_chart_rows(parsed(pages, "json", GENRE_ITEMS, "items")).select("genre", "item_id", "rank", "views", "concurrents", "is_hot", "title", "artist")


_TEXT = "CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y') WHEN o_orderpriority = '1-URGENT' THEN strftime(o_orderdate, '%Y-%m') ELSE strftime(o_orderdate, '%Y-%m-%d') END"


@query(
    "partial_dates",
    oracle(f"SELECT o_orderkey, x || CASE length(x) WHEN 4 THEN '-01-01' WHEN 7 THEN '-01' ELSE '' END AS release_date FROM (SELECT o_orderkey, {_TEXT} AS x FROM orders)"),
)
def partial_dates(spark, folder):
    t = Tables(spark, folder)
    fmt = F.when(F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy")).when(F.col("o_orderpriority") == "1-URGENT", F.date_format("o_orderdate", "yyyy-MM")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", complete_date(fmt).alias("release_date"))


@query("two_format_dates", oracle("SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS d FROM orders"))
def two_format_dates(spark, folder):
    """Both file formats are read; other text gives null."""
    t = Tables(spark, folder)
    raw = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy")).when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise("n/a")
    return t.orders.select("o_orderkey", parse_date(raw).alias("d"))


_YW = "SELECT DISTINCT strftime(o_orderdate, '%Y') || lpad(CAST(1 + (dayofyear(o_orderdate) - 1) // 7 AS VARCHAR), 2, '0') AS yw FROM orders"


@query(
    "year_week_date",
    oracle(
        "SELECT yw, CAST(j + CAST((8 - isodow(j)) % 7 AS INT) + 7 * (CAST(substr(yw, 5) AS INT) - 1) AS VARCHAR) AS start FROM (SELECT yw, make_date(CAST(substr(yw, 1, 4) AS INT), 1, 1) AS j FROM w)",
        w=_YW,
    ),
)
def year_week_date(spark, folder):
    t = Tables(spark, folder)
    week = F.lpad((1 + F.floor((F.dayofyear("o_orderdate") - 1) / 7)).cast("string"), 2, "0")
    names = t.orders.select(F.concat(F.date_format("o_orderdate", "yyyy"), week).alias("yw")).distinct()
    return names.select("yw", year_week_start(F.col("yw")).alias("start"))


_PLACE = "replace(n.n_name, 'NATION_', 'North_Land_')"
_FILES = (
    f"SELECT DISTINCT {_PLACE} || '_Daily_Top' || CASE WHEN o.o_orderstatus = 'F' THEN '20k_Artists_' ELSE '50k_Songs_' END || strftime(o.o_orderdate, '%Y%m%d') || CASE WHEN o.o_orderpriority = '5-LOW' THEN '__NO_DATA' ELSE '' END || '.tsv' AS filename, "
    f"lower({_PLACE}) AS territory, replace({_PLACE}, '_', ' ') AS display_name, CAST(o.o_orderdate AS DATE) AS date, CASE WHEN o.o_orderstatus = 'F' THEN 'artists' ELSE 'songs' END AS kind, o.o_orderpriority = '5-LOW' AS empty "
    "FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey"
)


def file_names(t: Tables, weekly: bool = False):
    place = F.replace("n_name", F.lit("NATION_"), F.lit("North_Land_"))
    artists = F.col("o_orderstatus") == "F"
    if weekly:
        week = F.lpad((1 + F.floor((F.dayofyear("o_orderdate") - 1) / 7)).cast("string"), 2, "0")
        name = F.concat(place, F.when(artists, "_Top20kArtist_").otherwise("_Top50kSong_"), F.date_format("o_orderdate", "yyyy"), week)
    else:
        name = F.concat(place, F.when(artists, "_Daily_Top20k_Artists_").otherwise("_Daily_Top50k_Songs_"), F.date_format("o_orderdate", "yyyyMMdd"))
    tail = F.when(F.col("o_orderpriority") == "5-LOW", "__NO_DATA").otherwise("")
    place_of = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")
    return t.orders.join(place_of, F.col("o_custkey") == F.col("c_custkey")).select(F.concat(name, tail, F.lit(".tsv")).alias("filename")).distinct()


_DAILYF = "SELECT filename, territory, display_name, date, kind FROM files WHERE NOT empty"


@query("filename_meta", oracle(f"SELECT filename, territory, display_name, CAST(date AS VARCHAR) AS date, kind FROM ({_DAILYF})", files=_FILES))
def filename_meta(spark, folder):
    return daily_files(file_names(Tables(spark, folder)))


@query(
    "filename_meta_weekly",
    oracle(
        f"SELECT DISTINCT {_PLACE} || CASE WHEN o.o_orderstatus = 'F' THEN '_Top20kArtist_' ELSE '_Top50kSong_' END || yw || '.tsv' AS filename, lower({_PLACE}) AS territory, "
        "CAST(j + CAST((8 - isodow(j)) % 7 AS INT) + 7 * (CAST(substr(yw, 5) AS INT) - 1) AS VARCHAR) AS date, CASE WHEN o.o_orderstatus = 'F' THEN 'artists' ELSE 'songs' END AS kind "
        "FROM (SELECT *, strftime(o_orderdate, '%Y') || lpad(CAST(1 + (dayofyear(o_orderdate) - 1) // 7 AS VARCHAR), 2, '0') AS yw, make_date(CAST(year(o_orderdate) AS INT), 1, 1) AS j FROM orders WHERE o_orderpriority <> '5-LOW') o "
        "JOIN customer c ON c.c_custkey = o.o_custkey JOIN nation n ON n.n_nationkey = c.c_nationkey"
    ),
)
def filename_meta_weekly(spark, folder):
    return weekly_files(file_names(Tables(spark, folder), weekly=True)).drop("display_name")


@query("ledger_new_files", oracle(f"SELECT filename, CAST(date AS VARCHAR) AS date FROM ({_DAILYF}) WHERE date > DATE '1999-06-30' OR kind = 'songs'", files=_FILES))
def ledger_new_files(spark, folder):
    """The ledger holds the artist files of the first years."""
    files = daily_files(file_names(Tables(spark, folder)))
    ledger = files.filter((F.col("date") <= F.lit("1999-06-30").cast("date")) & (F.col("kind") == "artists")).select("filename")
    return unprocessed(files, ledger).select("filename", "date")


_NEWEST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY territory, kind ORDER BY date DESC, filename) AS k FROM ({_DAILYF})) WHERE k = 1"
MARK = dt.date(2001, 7, 30)


@query("latest_per_territory", oracle("SELECT territory, kind, filename, CAST(date AS VARCHAR) AS date FROM newest", files=_FILES, newest=_NEWEST))
def latest_per_territory_query(spark, folder):
    return latest_per_territory(daily_files(file_names(Tables(spark, folder)))).select("territory", "kind", "filename", "date")


def _marks(t: Tables):
    """Marks on one date for artists; songs were never processed."""
    files = daily_files(file_names(t)).select("territory", "kind").distinct()
    return files.withColumn("last_processed", F.when(F.col("kind") == "artists", F.lit(MARK)))


@query("beyond_mark", oracle(f"SELECT territory, kind, CAST(date AS VARCHAR) AS date FROM newest WHERE kind = 'songs' OR date > DATE '{MARK}'", files=_FILES, newest=_NEWEST))
def beyond_mark_query(spark, folder):
    t = Tables(spark, folder)
    return beyond_mark(daily_files(file_names(t)), _marks(t)).select("territory", "kind", "date")


@query(
    "marks_advanced",
    oracle(f"SELECT territory, kind, CAST(CASE WHEN kind = 'songs' OR date > DATE '{MARK}' THEN date ELSE DATE '{MARK}' END AS VARCHAR) AS last_processed FROM newest", files=_FILES, newest=_NEWEST),
)
def marks_advanced(spark, folder):
    t = Tables(spark, folder)
    marks = _marks(t)
    return advance_marks(marks, beyond_mark(daily_files(file_names(t)), marks))


# Feed frames as the files would hold them: wide, all text, repeats and gaps included.
DAYS = [back(AS_OF, i) for i in range(14)]


def artist_feed(t: Tables):
    """A daily artist file: suppliers with 14 day columns, some rows twice, some names and keys missing."""
    wide = pivot_dates(artist_streams(t), ["artist_id"], DAYS, "streams").withColumnsRenamed({d.isoformat(): d.strftime("%m/%d/%Y") for d in DAYS})
    base = t.supplier.join(wide, F.col("s_suppkey") == F.col("artist_id"), "left")
    total = F.col("s_suppkey").cast("double")
    given = {"Artist": F.when(F.col("s_acctbal") >= 0, F.col("s_name")), "UnifiedArtistID": F.when(F.col("s_nationkey") != 3, F.col("s_suppkey").cast("double")).cast("string")}
    plain = {c: total for c in ARTIST_COLUMNS if c not in given}
    once = base.select(*[v.alias(k) for k, v in {**given, **plain}.items()], *[F.col(d.strftime("%m/%d/%Y")).cast("string").alias(d.strftime("%m/%d/%Y")) for d in DAYS], F.lit(1).alias("copy"))
    again = once.withColumns({"copy": F.lit(2), "Artist": F.lit("repeated")})
    return once.unionByName(again).withColumn(ORDINAL, F.struct("copy", "UnifiedArtistID")).drop("copy")


@query(
    "ingest_artist_meta",
    oracle(f"SELECT CAST(s_suppkey AS VARCHAR) AS unified_artist_id, CASE WHEN s_acctbal >= 0 THEN s_name ELSE 'Unknown' END AS artist, s_suppkey AS tw_rank, s_suppkey AS rtd_odv, false AS signed, 'r1' AS report_id, '{AS_OF}' AS report_date FROM supplier WHERE s_nationkey <> 3"),
)
def ingest_artist_meta(spark, folder):
    meta, _ = daily_artists(artist_feed(Tables(spark, folder)), "r1")
    return meta.select("unified_artist_id", "artist", "tw_rank", "rtd_odv", "signed", "report_id", "report_date")


@query(
    "ingest_artist_streams",
    oracle(
        f"SELECT CAST(s.s_suppkey AS VARCHAR) AS unified_artist_id, CAST(DATE '{AS_OF}' - i.i AS VARCHAR) AS date, coalesce(a.streams, 0) AS streams FROM supplier s CROSS JOIN (SELECT CAST(unnest(range(14)) AS INT) AS i) i "
        f"LEFT JOIN artist_streams a ON a.artist_id = s.s_suppkey AND a.date = DATE '{AS_OF}' - i.i WHERE s.s_nationkey <> 3"
    ),
)
def ingest_artist_streams(spark, folder):
    return daily_artists(artist_feed(Tables(spark, folder)))[1]


_TW = f"SELECT c.c_nationkey AS nation, l.l_suppkey AS artist_id, CAST(sum(CASE WHEN CAST(l_shipdate AS DATE) > DATE '{AS_OF}' - 365 THEN CAST(l_quantity AS BIGINT) ELSE 0 END) AS BIGINT) AS tw, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS rtd FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1, 2"


def weekly_feed(t: Tables):
    """Weekly territory files in one frame, best first per territory."""
    from cadenza.catalogue.domain import sales

    q = F.col("streams")
    sums = sales(t).groupBy("global_id", "artist_id").agg(
        F.sum(F.when(F.col("date") > F.lit(back(AS_OF, 365)), q).otherwise(0)).alias("tw"), F.sum(q).alias("rtd")
    )
    names = {v: k for k, v in WEEKLY_COLUMNS.items()}
    return sums.select(
        F.concat(F.lit("North Land "), F.col("global_id").cast("string")).alias(names["country"]),
        F.col("artist_id").cast("string").alias("UnifiedArtistID"),
        F.lit(None).cast("string").alias("Artist"),
        F.lit("0").alias(names["digital_song_sales_tw"]),
        F.col("tw").cast("string").alias(names["tw_streams"]),
        F.lit("12.5%").alias(names["pct_chg"]),
        F.lit("1").alias(names["lw_streams"]),
        F.lit("2").alias(names["ytd_streams"]),
        F.col("rtd").cast("string").alias(f"{LIFETIME_PREFIX} 2022"),
        F.struct((-F.col("tw")).alias("a"), F.col("artist_id").alias("b")).alias(ORDINAL),
    )


@query(
    "ingest_weekly",
    oracle(
        "SELECT 'north_land_' || CAST(nation AS VARCHAR) AS country, CAST(artist_id AS VARCHAR) AS unified_artist_id, 'Unknown' AS artist, row_number() OVER (PARTITION BY nation ORDER BY tw DESC, artist_id) AS rnk, 12.5e0 AS pct_chg, tw AS tw_streams, 1 AS lw_streams, 2 AS ytd_streams, rtd AS rtd_streams, 0 AS digital_song_sales_tw FROM w",
        w=_TW,
    ),
)
def ingest_weekly(spark, folder):
    return territory_weekly(weekly_feed(Tables(spark, folder)), "unified_artist_id", ["artist"])


@query(
    "load_weekly",
    oracle(
        "SELECT nation AS global_id, artist_id, row_number() OVER (PARTITION BY nation ORDER BY tw DESC, artist_id) AS rnk, tw AS tw_streams, 1 AS lw_streams, 12.5e0 AS pct_chg, rtd AS rtd_streams FROM w "
        "UNION ALL SELECT n_nationkey, -1, 5, 6, 7, 8e0, 9 FROM nation",
        w=_TW,
    ),
)
def load_weekly(spark, folder):
    """Weekly stats upserted by (territory, entity); rows of entities not in the file stay."""
    t = Tables(spark, folder)
    stats = territory_weekly(weekly_feed(t), "unified_artist_id", ["artist"])
    ids = t.supplier.select(F.col("s_suppkey").cast("string").alias("unified_artist_id"), F.col("s_suppkey").alias("artist_id"))
    places = t.nation.select(F.concat(F.lit("north_land_"), F.col("n_nationkey").cast("string")).alias("name"), F.col("n_nationkey").alias("global_id"))
    held = {"artist_id": -1, "rnk": 5, "tw_streams": 6, "lw_streams": 7, "ytd_streams": 0, "rtd_streams": 9, "digital_song_sales_tw": 0}
    current = t.nation.select(F.col("n_nationkey").alias("global_id"), *[F.lit(v).cast("bigint").alias(k) for k, v in held.items()], F.lit(8.0).alias("pct_chg"))
    out = load_territory_stats(current, stats, ids, places, "unified_artist_id", "artist_id")
    return out.select("global_id", "artist_id", "rnk", "tw_streams", "lw_streams", "pct_chg", "rtd_streams")


@query(
    "ingest_territory_day",
    oracle(
        f"SELECT CAST(s.s_suppkey AS VARCHAR) AS unified_artist_id, CAST(DATE '{AS_OF}' - i.i AS VARCHAR) AS date, coalesce(a.streams, 0) AS streams, 'north_land' AS territory FROM supplier s CROSS JOIN (SELECT CAST(unnest(range(2)) AS INT) AS i) i "
        f"LEFT JOIN artist_streams a ON a.artist_id = s.s_suppkey AND a.date = DATE '{AS_OF}' - i.i"
    ),
)
def ingest_territory_day(spark, folder):
    t = Tables(spark, folder)
    two = {AS_OF.isoformat(): DAY_COLUMN, back(AS_OF, 1).isoformat(): PRIOR_DAY_COLUMN}
    wide = pivot_dates(artist_streams(t), ["artist_id"], DAYS[:2], "streams").withColumnsRenamed(two)
    raw = t.supplier.join(wide, F.col("s_suppkey") == F.col("artist_id"), "left").select(
        F.col("s_suppkey").cast("string").alias("UnifiedArtistID"), F.col("s_name").alias("Artist"), DAY_COLUMN, PRIOR_DAY_COLUMN,
        F.struct("s_suppkey").alias(ORDINAL),
    )
    return territory_daily(raw, "unified_artist_id", ["artist"], AS_OF, "north_land")[1]


@query(
    "ingest_mapping",
    oracle("SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS unified_song_id, CAST(l_suppkey AS VARCHAR) AS unified_artist_id, CAST(l_orderkey AS VARCHAR) AS unified_collection_id FROM lineitem"),
)
def ingest_mapping(spark, folder):
    """Ids that arrive as floats in text come out as whole numbers, repeats go."""
    t = Tables(spark, folder)
    raw = t.lineitem.select(
        F.col("l_partkey").cast("double").cast("string").alias("UnifiedSongID"),
        F.col("l_suppkey").cast("double").cast("string").alias("Unified Artist ID"),
        F.col("l_orderkey").cast("double").cast("string").alias("Unified Collection ID"),
        F.struct("l_shipdate", "l_linenumber", "l_extendedprice").alias(ORDINAL),
    )
    return mapping_links(raw)


def _ordinal(file, part, row):
    return F.struct(F.lit(file).alias("file"), F.lit(part).alias("part"), row.cast("bigint").alias("row")).alias(ORDINAL)


def _mapping_lines(rows, columns, *cells):
    """Two mapping files with the same rows, the second with its columns the other way round."""
    place = rows.columns[0]
    files = []
    for name, order in (("a.txt", 1), ("b.txt", -1)):
        head = "\t".join(columns[::order])
        lines = rows.select(F.lit(name).alias("file"), _ordinal(name, 1, F.col(place)), F.concat_ws("\t", *cells[::order]).alias("value"))
        first = _ordinal(name, 0, F.lit(0))
        files.append(rows.sparkSession.range(1).select(F.lit(name).alias("file"), first, F.lit(head).alias("value")).unionByName(lines))
    return parse_mapping(files[0].unionByName(files[1]), columns)


@query("ingest_mapping_artists", oracle("SELECT CAST(s_suppkey AS VARCHAR) AS unified_artist_id, CAST(s_nationkey AS VARCHAR) AS primary_artist_id, s_name AS unified_artist_name, 'no. ' || CAST(s_suppkey AS VARCHAR) AS primary_artist_name FROM supplier"))
def ingest_mapping_artists(spark, folder):
    """Quoted names and ids as floats, in two files whose headers differ in order."""
    t = Tables(spark, folder)
    columns = ["Unified Artist ID", "Primary Artist ID", "Unified Artist Name", "Primary Artist Name"]
    ids = [F.col(c).cast("double").cast("string") for c in ("s_suppkey", "s_nationkey")]
    names = [F.concat(F.lit('"'), "s_name", F.lit('"')), F.concat(F.lit("no.\\ "), F.col("s_suppkey").cast("string"))]
    return mapping_artists(_mapping_lines(t.supplier.select("s_suppkey", "s_nationkey", "s_name"), columns, *ids, *names))


@query(
    "ingest_mapping_collections",
    oracle(
        "SELECT CAST(o_orderkey AS VARCHAR) AS unified_collection_id, o_orderpriority AS name, "
        f"CASE WHEN o_orderkey % 3 = 0 THEN '{AS_OF}' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS release_date, o_orderstatus AS type FROM orders"
    ),
)
def ingest_mapping_collections(spark, folder):
    """Collections; a third have no release date and take the day of the run."""
    t = Tables(spark, folder)
    columns = ["Unified Collection ID", "Unified Collection Name", "Barcode Release Date", "Collection Type"]
    day = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.date_format(F.to_date("o_orderdate"), "MM/dd/yyyy"))
    rows = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_orderstatus")
    return mapping_collections(_mapping_lines(rows, columns, F.col("o_orderkey").cast("string"), F.col("o_orderpriority"), day, F.col("o_orderstatus")), AS_OF)


@query(
    "ingest_mapping_songs",
    oracle(f"SELECT CAST(p_partkey AS VARCHAR) AS unified_song_id, 'I' || CAST(p_partkey AS VARCHAR) AS isrc, CASE WHEN p_size < 10 THEN '' ELSE p_name END AS title, '{AS_OF}' AS release_date FROM part"),
)
def ingest_mapping_songs(spark, folder):
    """One row per recording code, some without a title."""
    t = Tables(spark, folder)
    columns = ["UnifiedSongid", "ISRC", "UnifiedSong Title", "ISRC Release Date"]
    code = F.concat(F.lit("I"), F.col("p_partkey").cast("string"))
    title = F.when(F.col("p_size") < 10, "").otherwise(F.col("p_name"))
    rows = t.part.select("p_partkey", "p_size", "p_name")
    return mapping_songs(_mapping_lines(rows, columns, F.col("p_partkey").cast("double").cast("string"), code, title, F.lit("")), AS_OF)


@query("id_text", oracle("SELECT l_orderkey, l_linenumber, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS id, CAST(l_suppkey AS VARCHAR) AS id2 FROM lineitem"))
def id_text_query(spark, folder):
    t = Tables(spark, folder)
    return t.lineitem.select("l_orderkey", "l_linenumber", id_text(F.col("l_quantity").cast("string")).alias("id"), id_text("l_suppkey").alias("id2"))


@query(
    "song_facts",
    oracle(
        "SELECT isrc, song_id, copyrights, signed, tw_streams FROM (SELECT *, row_number() OVER (PARTITION BY isrc ORDER BY tw_streams DESC NULLS LAST, song_id NULLS LAST) AS k FROM ("
        "SELECT CASE WHEN p.p_size < 40 THEN p.p_name END AS isrc, p.p_partkey AS song_id, p.p_brand AS copyrights, coalesce(p.p_type = 'ECONOMY', false) AS signed, s.tw_streams FROM part p LEFT JOIN song_stats s ON s.song_id = p.p_partkey WHERE p.p_size < 40 AND p.p_name LIKE '%ring%' "
        "UNION ALL SELECT p_name, NULL, min(p_brand), false, NULL FROM part WHERE p_name NOT LIKE '%ring%' GROUP BY 1)) WHERE k = 1"
    ),
)
def song_facts_query(spark, folder):
    """Codes (names here) with a profile take its most streamed song, others the extra cache."""
    from cadenza.catalogue.domain import song_stats

    t = Tables(spark, folder)
    wanted = t.part.select(F.col("p_name").alias("isrc"))
    mine = F.col("p_name").contains("ring")
    held = t.part.filter((F.col("p_size") < 40) & mine).select(F.col("p_partkey").alias("song_id"), F.col("p_name").alias("isrc"), F.col("p_brand").alias("copyrights"))
    extra = t.part.filter(~mine).groupBy(F.col("p_name").alias("isrc")).agg(F.min("p_brand").alias("copyrights"))
    reports = t.part.select(F.col("p_partkey").alias("song_id"), (F.col("p_type") == "ECONOMY").alias("signed"))
    return song_facts(wanted, held, extra, reports, song_stats(t)).select("isrc", "song_id", "copyrights", "signed", "tw_streams")


@query(
    "artist_facts",
    oracle(
        "SELECT platform_artist_id, artist_id, signed, tw_streams, pct_chg FROM (SELECT *, row_number() OVER (PARTITION BY platform_artist_id ORDER BY tw_streams DESC, artist_id) AS k FROM ("
        "SELECT CAST(s.s_nationkey AS VARCHAR) AS platform_artist_id, s.s_suppkey AS artist_id, s.s_acctbal < 0 AS signed, coalesce(x.tw_streams, 0) AS tw_streams, coalesce(x.pct_chg, 0e0) AS pct_chg FROM supplier s LEFT JOIN artist_stats x ON x.artist_id = s.s_suppkey)) WHERE k = 1"
    ),
)
def artist_facts_query(spark, folder):
    from cadenza.catalogue.domain import artist_meta, artist_stats

    t = Tables(spark, folder)
    held = t.supplier.select(F.col("s_nationkey").cast("string").alias("platform_artist_id"), F.col("s_suppkey").alias("artist_id"), F.lit("c").alias("copyrights"))
    wanted = t.nation.select(F.col("n_nationkey").cast("string").alias("platform_artist_id"))
    return artist_facts(wanted, held, artist_meta(t), artist_stats(t)).select("platform_artist_id", "artist_id", "signed", "tw_streams", "pct_chg")


@query(
    "profile_candidates",
    oracle(
        "SELECT s.s_suppkey AS artist_id, b.brand AS platform_artist_id FROM supplier s LEFT JOIN (SELECT * FROM (SELECT a, brand, row_number() OVER (PARTITION BY a ORDER BY n DESC, brand) AS k FROM ("
        "SELECT t.artist_id AS a, p.p_brand AS brand, count(*) AS n FROM (SELECT DISTINCT artist_id, song_id FROM tracks) t JOIN part p ON p.p_partkey = t.song_id GROUP BY 1, 2)) WHERE k = 1) b ON b.a = s.s_suppkey WHERE s.s_acctbal >= 0 AND s.s_nationkey <> 7"
    ),
)
def profile_candidates_query(spark, folder):
    from cadenza.catalogue.domain import tracks

    t = Tables(spark, folder)
    people = t.supplier.select(F.col("s_suppkey").alias("artist_id"), (F.col("s_acctbal") < 0).alias("is_global"))
    cached = t.supplier.filter(F.col("s_nationkey") == 7).select(F.col("s_suppkey").alias("artist_id"))
    songs = t.part.select(F.col("p_partkey").alias("song_id"), F.col("p_brand").alias("platform_artist_id"))
    links = tracks(t).select("artist_id", "song_id").distinct()
    return profile_candidates(people, cached, links, songs)
