"""Territory rollups and genres."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.catalogue.domain import (
    AS_OF,
    HOME,
    ROLLUPS,
    Tables,
    all_stats,
    artist_stats,
    artist_streams,
    artists,
    home_stats,
    profiles,
    sales,
    territory_stats,
)
from cadenza.catalogue.growth import _streak_sql, moved_stats
from cadenza.catalogue.registry import oracle, query, sql_percent
from cadenza.functions.dates import back
from cadenza.operators.charts import ARTIST_IN_GENRE_RULE, GENRE_RULE, ReentryRule, next_edition
from cadenza.plans.genres import (
    entity_genres,
    extend_genres,
    genre_artists,
    genre_chart,
    genre_daily,
    genre_overlap,
    genre_sparklines,
    genre_figures,
    genre_state,
    genre_stats,
    growing_genres,
    move_genres,
    new_artists_in_genres,
    new_genres,
    refresh_genre_streams,
)
from cadenza.plans.rollups import ex_home, overlap, territory_daily, territory_totals, worldwide
from cadenza.session import materialise

WORLD_ID, EX_HOME_ID = 67, 68
_PCT = f"CASE WHEN lw_streams = 0 THEN 0e0 ELSE {sql_percent('tw_streams', 'lw_streams')} END AS pct_chg"


def _ranked(inner: str, key: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY tw_streams DESC NULLS LAST, {key}) AS rnk, {_PCT} FROM ({inner})"


def _ex(key: str, source: str = "territory_stats") -> str:
    skip = ", ".join(map(str, ROLLUPS))
    return (
        f"SELECT {key}, CAST(sum(tw_streams) AS BIGINT) AS tw_streams, CAST(sum(lw_streams) AS BIGINT) AS lw_streams, "
        f"CAST(sum(rtd_streams) AS BIGINT) AS rtd_streams FROM {source} WHERE global_id NOT IN ({skip}) GROUP BY 1"
    )


_COLS = "tw_streams, lw_streams, rtd_streams, rnk, pct_chg"
_FULL = (
    "SELECT coalesce(e.{k}, h.{k}) AS {k}, coalesce(e.tw_streams, 0) + coalesce(h.tw_streams, 0) AS tw_streams, "
    "coalesce(e.lw_streams, 0) + coalesce(h.lw_streams, 0) AS lw_streams, {rtd} AS rtd_streams "
    "FROM ({ex}) e FULL JOIN {home} h ON e.{k} = h.{k}"
)
_SONG_STATS = (
    "SELECT global_id, song_id, CAST(sum(CASE WHEN d > DATE '%s' - 365 THEN q ELSE 0 END) AS BIGINT) AS tw_streams, "
    "CAST(sum(CASE WHEN d <= DATE '%s' - 365 AND d > DATE '%s' - 730 THEN q ELSE 0 END) AS BIGINT) AS lw_streams, "
    "CAST(sum(q) AS BIGINT) AS rtd_streams FROM sales WHERE d <= DATE '%s' GROUP BY 1, 2" % ((AS_OF,) * 4)
)


@query("territory_ex_home", oracle(f"SELECT {EX_HOME_ID} AS global_id, artist_id, {_COLS} FROM ({_ranked(_ex('artist_id'), 'artist_id')})"))
def territory_ex_home(spark, folder):
    t = Tables(spark, folder)
    out = ex_home(territory_stats(t), "artist_id", ROLLUPS, EX_HOME_ID)
    return out.select("global_id", "artist_id", *_COLS.split(", "))


@query(
    "territory_world",
    oracle(
        f"SELECT {WORLD_ID} AS global_id, artist_id, {_COLS}, 0 AS ytd_streams, 0 AS digital_song_sales_tw FROM ("
        + _ranked(_FULL.format(k="artist_id", ex=_ex("artist_id"), home="home_stats", rtd="coalesce(e.rtd_streams, 0) + coalesce(h.rtd_streams, 0)"), "artist_id")
        + ")"
    ),
)
def territory_world(spark, folder):
    t = Tables(spark, folder)
    ex = ex_home(territory_stats(t), "artist_id", ROLLUPS, EX_HOME_ID)
    out = worldwide(ex, home_stats(t), "artist_id", WORLD_ID)
    return out.select("global_id", "artist_id", *_COLS.split(", "), "ytd_streams", "digital_song_sales_tw")


@query(
    "territory_world_song",
    oracle(
        f"SELECT {WORLD_ID} AS global_id, song_id, {_COLS} FROM ("
        + _ranked(_FULL.format(k="song_id", ex=_ex("song_id", "foreign_stats"), home="own_stats", rtd="0"), "song_id")
        + ")",
        every=_SONG_STATS,
        foreign_stats=f"SELECT * FROM every WHERE global_id <> {HOME}",
        own_stats=f"SELECT * FROM every WHERE global_id = {HOME}",
    ),
)
def territory_world_song(spark, folder):
    """Songs worldwide: lifetime streams are not carried."""
    t = Tables(spark, folder)
    ex = ex_home(territory_stats(t, "song_id"), "song_id", ROLLUPS, EX_HOME_ID)
    out = worldwide(ex, home_stats(t, "song_id"), "song_id", WORLD_ID, with_rtd=False)
    return out.select("global_id", "song_id", *_COLS.split(", "))


_TOTAL = "SELECT global_id, CAST(sum(tw_streams) AS BIGINT) AS tw_streams, CAST(sum(lw_streams) AS BIGINT) AS lw_streams, CAST(sum(rtd_streams) AS BIGINT) AS rtd_streams FROM all_stats GROUP BY 1"


@query("territory_totals", oracle(f"SELECT global_id, {_COLS} FROM ({_ranked(_TOTAL, 'global_id')})"))
def territory_totals_query(spark, folder):
    return territory_totals(all_stats(Tables(spark, folder))).select("global_id", *_COLS.split(", "))


def _overlap_sql(item: str, member: str, other: str, table: str) -> str:
    return oracle(
        f"SELECT p.a AS {item}, p.b AS {other}, CAST(round(100.0 * p.n / least(x.n, y.n)) AS INT) AS correlation, p.n AS instance_count FROM pairs p JOIN sizes x ON x.i = p.a JOIN sizes y ON y.i = p.b",
        base=f"SELECT DISTINCT {item} AS i, {member} AS m FROM {table}",
        sizes="SELECT i, count(*) AS n FROM base GROUP BY 1",
        pairs="SELECT l.i AS a, r.i AS b, count(*) AS n FROM base l JOIN base r ON l.m = r.m AND l.i <> r.i GROUP BY 1, 2",
    )


_HEARD = f"(SELECT c_nationkey AS global_id, l_partkey AS song_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey WHERE CAST(l_shipdate AS DATE) > DATE '{AS_OF}' - 365)"


@query("territory_overlap", _overlap_sql("global_id", "song_id", "c_global_id", _HEARD))
def territory_overlap(spark, folder):
    """Overlap of the songs heard in two territories during the last year of data."""
    t = Tables(spark, folder)
    heard = sales(t).filter(F.col("date") > F.lit(back(AS_OF, 365))).select("global_id", "song_id").distinct()
    return overlap(heard, "global_id", "song_id", "c_global_id")


@query(
    "territory_daily",
    oracle(
        "SELECT s.global_id, CAST(s.d AS VARCHAR) AS date, CAST(sum(s.q) AS BIGINT) AS streams FROM sales s "
        f"JOIN (SELECT DISTINCT global_id, artist_id FROM territory_stats WHERE tw_streams > 50) c ON c.global_id = s.global_id AND c.artist_id = s.artist_id WHERE s.d > DATE '{AS_OF}' - 14 GROUP BY 1, 2"
    ),
)
def territory_daily_query(spark, folder):
    t = Tables(spark, folder)
    charting = territory_stats(t).filter(F.col("tw_streams") > 50)
    return territory_daily(sales(t), charting, AS_OF)


# Genres: the known dimension holds the words of the smallest parts.
_KNOWN = "SELECT DISTINCT unnest(string_split(p_name, ' ')) AS genre FROM part WHERE p_size = 1 AND p_type = 'ECONOMY' AND p_brand = 'Brand#1'"


def known_genres(t: Tables):
    few = (F.col("p_size") == 1) & (F.col("p_type") == "ECONOMY") & (F.col("p_brand") == "Brand#1")
    return t.part.filter(few).select(F.explode(F.split("p_name", " ")).alias("genre")).distinct()


@query("genre_new", oracle("SELECT DISTINCT genre FROM artist_genres WHERE genre NOT IN (SELECT genre FROM known)", known=_KNOWN))
def genre_new(spark, folder):
    t = Tables(spark, folder)
    return new_genres(profiles(t), known_genres(t))


@query(
    "genre_dimension",
    oracle(
        "SELECT genre, genre_id FROM k UNION ALL SELECT genre, coalesce((SELECT max(genre_id) FROM k), 0) + row_number() OVER (ORDER BY genre) FROM (SELECT DISTINCT genre FROM artist_genres WHERE genre NOT IN (SELECT genre FROM known))",
        known=_KNOWN,
        k="SELECT genre, CAST(ascii(genre) * 1000 + length(genre) AS BIGINT) AS genre_id FROM known",
    ),
)
def genre_dimension(spark, folder):
    """The dimension extended by the new genres, numbered on from the largest id."""
    t = Tables(spark, folder)
    ids = (F.ascii("genre") * 1000 + F.length("genre")).cast("bigint")
    return extend_genres(profiles(t), known_genres(t).withColumn("genre_id", ids))


_DAILY = "SELECT g.genre, s.date, CAST(sum(s.streams) AS BIGINT) AS streams FROM artist_streams s JOIN artist_genres g ON g.artist_id = s.artist_id GROUP BY 1, 2"
SINCE = back(AS_OF, 7)


def _daily(t: Tables, days: int = 10_000):
    return genre_daily(entity_genres(profiles(t)), artist_streams(t), back(AS_OF, days))


@query("genre_daily", oracle(f"SELECT genre, CAST(date AS VARCHAR) AS date, streams FROM daily WHERE date > DATE '{SINCE}'", daily=_DAILY))
def genre_daily_query(spark, folder):
    return _daily(Tables(spark, folder), 7)


@query(
    "genre_window_refresh",
    oracle(
        f"SELECT genre, CAST(date AS VARCHAR) AS date, CASE WHEN date > DATE '{SINCE}' THEN streams ELSE streams + 1 END AS streams, ascii(genre) AS genre_id FROM daily WHERE date > DATE '{back(AS_OF, 30)}'",
        daily=_DAILY,
    ),
)
def genre_window_refresh(spark, folder):
    """The last seven days are replaced; older rows (stored one too high) stay."""
    t = Tables(spark, folder)
    month = _daily(t, 30).withColumns({"streams": F.col("streams") + 1, "genre_id": F.ascii("genre")})
    dimension = entity_genres(profiles(t)).select("genre").distinct().withColumn("genre_id", F.ascii("genre"))
    return refresh_genre_streams(month, entity_genres(profiles(t)), artist_streams(t), dimension, AS_OF)


_RANKED = "SELECT g.genre, g.artist_id, s.tw_streams, row_number() OVER (PARTITION BY g.genre ORDER BY s.tw_streams DESC NULLS LAST, g.artist_id) AS rnk FROM artist_genres g LEFT JOIN artist_stats s ON s.artist_id = g.artist_id"


def _ranked_artists(t: Tables):
    return genre_artists(entity_genres(profiles(t)), artist_stats(t))


@query("genre_artists_rank", oracle(_RANKED))
def genre_artists_rank(spark, folder):
    return _ranked_artists(Tables(spark, folder)).select("genre", "artist_id", "tw_streams", "rnk")


_GSUM = "SELECT g.genre, CAST(sum(s.tw_streams) AS BIGINT) AS tw_streams, CAST(sum(s.lw_streams) AS BIGINT) AS lw_streams, count(*) AS artists_count FROM artist_genres g JOIN artist_stats s ON s.artist_id = g.artist_id GROUP BY 1"
_GSTATS = (
    "SELECT *, CAST(tw_streams AS DOUBLE) / artists_count AS avg_tw_streams, round(tw_streams * 100e0 / (SELECT sum(tw_streams) FROM gsum), 6) AS volume, "
    f"CASE WHEN lw_streams = 0 THEN 0e0 ELSE {sql_percent('tw_streams', 'lw_streams')} END AS growth FROM gsum"
)


@query("genre_stats", oracle(_GSTATS, gsum=_GSUM))
def genre_stats_query(spark, folder):
    t = Tables(spark, folder)
    return genre_stats(entity_genres(profiles(t)), artist_stats(t))


@query("genre_stats_moved", oracle(_GSTATS, gsum=_GSUM))
def genre_stats_moved(spark, folder):
    """The genre sums of a week ago, moved by the artists whose numbers differ."""
    t = Tables(spark, folder)
    genres, (held, fresh) = entity_genres(profiles(t)), moved_stats(t)
    state = materialise(genre_state(genres.join(held, "artist_id")), "genre-state")
    return genre_figures(move_genres(state, genres, held, materialise(fresh, "stats-state")))


@query("genre_overlap", _overlap_sql("genre", "artist_id", "c_genre", "artist_genres"))
def genre_overlap_query(spark, folder):
    return genre_overlap(entity_genres(profiles(Tables(spark, folder))))


@query(
    "genre_sparkline",
    oracle(
        "SELECT genre, '[' || string_agg('{\"date\":\"' || CAST(date AS VARCHAR) || '\",\"value\":' || CAST(streams AS VARCHAR) || '}', ',' ORDER BY date) || ']' AS sparkline "
        f"FROM daily WHERE date > DATE '{AS_OF}' - 30 AND date <= DATE '{AS_OF}' GROUP BY 1",
        daily=_DAILY,
    ),
)
def genre_sparkline(spark, folder):
    return genre_sparklines(_daily(Tables(spark, folder), 30), AS_OF)


# Genre charts over two editions; small cuts, as the data has few genres.
SMALL = ReentryRule(3, 6, GENRE_RULE.limit)
SMALL_ARTIST = ReentryRule(1, 3, ARTIST_IN_GENRE_RULE.limit)
BEFORE = back(AS_OF, 400)


def _dimension_sql() -> str:
    return "SELECT DISTINCT genre FROM artist_genres UNION SELECT genre FROM (" + _KNOWN + ")"


def _weekly_genre(as_of, name: str) -> dict:
    shift = int(back(as_of, 1).isoweekday() % 7)
    weekly = f"SELECT genre, date_trunc('week', date - {shift}) AS week, sum(streams) AS s FROM daily WHERE date > DATE '{back(as_of, 365)}' AND date < DATE '{as_of}' GROUP BY 1, 2"
    ranks = (
        "SELECT genre, n AS num_positive_weeks, row_number() OVER (ORDER BY n DESC, genre) AS rnk FROM (SELECT d.genre, coalesce(w.num_positive_weeks, -1) AS n "
        f"FROM dimension d LEFT JOIN ({_streak_sql('genre', 'weekly_' + name)}) w ON w.genre = d.genre)"
    )
    return {f"weekly_{name}": weekly, f"ranks_{name}": ranks}


def _state(ranks: str, prev: str | None, keys: list[str], rule: ReentryRule, as_of) -> str:
    never = f"DATE '{back(as_of, 1000)}'"
    i, o = rule.inner, rule.outer
    if prev is None:
        src = f"SELECT r.*, 0 AS n, {never} AS li, {never} AS lo FROM {ranks} r"
    else:
        on = " AND ".join(f"p.{k} = r.{k}" for k in keys)
        src = f"SELECT r.*, coalesce(p.should_notify, 0) AS n, coalesce(p.last_appearance_in_top_{i}, {never}) AS li, coalesce(p.last_appearance_in_top_{o}, {never}) AS lo FROM {ranks} r LEFT JOIN {prev} p ON {on}"
    now = f"DATE '{as_of}'"
    return (
        f"SELECT * EXCLUDE (n, li, lo), CASE WHEN n + 1 > {rule.limit} THEN 0 WHEN n > 0 OR (rnk <= {i} AND date_diff('day', li, {now}) >= 365) OR (rnk <= {o} AND date_diff('day', lo, {now}) >= 365) THEN n + 1 ELSE 0 END AS should_notify, "
        f"rnk <= {i} AS is_top_{i}, rnk <= {o} AS is_top_{o}, CASE WHEN rnk <= {i} THEN {now} ELSE li END AS last_appearance_in_top_{i}, CASE WHEN rnk <= {o} THEN {now} ELSE lo END AS last_appearance_in_top_{o} FROM ({src})"
    )


def _dimension(t: Tables):
    return entity_genres(profiles(t)).select("genre").union(known_genres(t)).distinct()


def genre_charts(t: Tables):
    """The chart after two editions, 400 days apart."""
    daily, dimension = _daily(t), _dimension(t)
    first = genre_chart(daily, dimension, None, SMALL, BEFORE)
    return genre_chart(daily, dimension, first, SMALL, AS_OF)


_TWO = {
    "daily": _DAILY,
    "dimension": _dimension_sql(),
    **_weekly_genre(BEFORE, "a"),
    **_weekly_genre(AS_OF, "b"),
    "chart_a": _state("ranks_a", None, ["genre"], SMALL, BEFORE),
    "chart_b": _state("ranks_b", "chart_a", ["genre"], SMALL, AS_OF),
}
_DATES = "EXCLUDE (last_appearance_in_top_%d, last_appearance_in_top_%d), CAST(last_appearance_in_top_%d AS VARCHAR) AS last_appearance_in_top_%d, CAST(last_appearance_in_top_%d AS VARCHAR) AS last_appearance_in_top_%d"


@query("chart_reentry_genre", oracle(f"SELECT * {_DATES % (3, 6, 3, 3, 6, 6)} FROM chart_b", **_TWO))
def chart_reentry_genre(spark, folder):
    return genre_charts(Tables(spark, folder))


@query(
    "growing_genres",
    oracle(
        "SELECT c.genre, c.rnk, c.num_positive_weeks, c.should_notify > 0 AS is_new, s.tw_streams, s.volume, s.growth, s.artists_count, s.avg_tw_streams AS avg_tw_streams_per_artist FROM chart_b c LEFT JOIN gstats s ON s.genre = c.genre WHERE c.is_top_6",
        gsum=_GSUM, gstats=_GSTATS, **_TWO,
    ),
)
def growing_genres_query(spark, folder):
    t = Tables(spark, folder)
    chart = genre_charts(t).withColumnRenamed("is_top_6", "is_top_100")
    out = growing_genres(chart, genre_stats(entity_genres(profiles(t)), artist_stats(t)))
    return out.select("genre", "rnk", "num_positive_weeks", "is_new", "tw_streams", "volume", "growth", "artists_count", "avg_tw_streams_per_artist")


_PREV = (
    "SELECT genre, artist_id, CAST(CASE WHEN artist_id IN (SELECT artist_id FROM artists WHERE signed) THEN 2 ELSE 0 END AS INT) AS should_notify, "
    f"DATE '{back(AS_OF, 30)}' AS last_appearance_in_top_1, DATE '{back(AS_OF, 500)}' AS last_appearance_in_top_3 FROM "
    "(SELECT genre, artist_id FROM artist_genres UNION ALL SELECT 'old ' || genre, artist_id FROM artist_genres)"
)
_CARRIED = (
    "SELECT * FROM state UNION ALL BY NAME SELECT genre, artist_id, should_notify, false AS is_top_1, false AS is_top_3, last_appearance_in_top_1, last_appearance_in_top_3 "
    "FROM prev p WHERE NOT EXISTS (SELECT 1 FROM ranked r WHERE r.genre = p.genre AND r.artist_id = p.artist_id)"
)


def artist_genre_chart(t: Tables):
    """A stored edition with running notices for signed artists and genres that are gone today, then today's ranks."""
    stored = entity_genres(profiles(t)).join(t.supplier.select(F.col("s_suppkey").alias("artist_id"), "s_acctbal"), "artist_id").select(
        "genre",
        "artist_id",
        F.when(F.col("s_acctbal") < 0, 2).otherwise(0).alias("should_notify"),
        F.lit(back(AS_OF, 30)).alias("last_appearance_in_top_1"),
        F.lit(back(AS_OF, 500)).alias("last_appearance_in_top_3"),
    )
    left = stored.withColumn("genre", F.concat(F.lit("old "), "genre"))
    return next_edition(_ranked_artists(t), stored.unionByName(left), ["genre", "artist_id"], SMALL_ARTIST, AS_OF)


_ARTIST_CHART = {"ranked": _RANKED, "prev": _PREV, "state": _state("ranked", "prev", ["genre", "artist_id"], SMALL_ARTIST, AS_OF), "chart": _CARRIED}


@query("chart_reentry_artist_genre", oracle(f"SELECT * {_DATES % (1, 3, 1, 1, 3, 3)} FROM chart", **_ARTIST_CHART))
def chart_reentry_artist_genre(spark, folder):
    return artist_genre_chart(Tables(spark, folder))


@query(
    "new_artists_in_genres",
    oracle(
        "SELECT c.artist_id, c.genre, a.artist, a.tw_streams, a.pct_chg, c.rnk AS genre_rnk, c.is_top_1, c.is_top_3, a.signed, p.genres AS copyrights "
        "FROM chart c JOIN artists a ON a.artist_id = c.artist_id LEFT JOIN profiles p ON p.artist_id = c.artist_id WHERE c.should_notify > 0 AND c.rnk IS NOT NULL AND a.tw_streams > 0",
        **_ARTIST_CHART,
    ),
)
def new_artists_in_genres_query(spark, folder):
    t = Tables(spark, folder)
    out = new_artists_in_genres(artist_genre_chart(t), artists(t), profiles(t).withColumnRenamed("genres", "copyrights"))
    return out.select("artist_id", "genre", "artist", "tw_streams", "pct_chg", "genre_rnk", "is_top_1", "is_top_3", "signed", "copyrights")
