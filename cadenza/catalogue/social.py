"""Binned model, follower charts, snapshots and rank charts over account statistics."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cadenza.catalogue.domain import EVENTS_AS_OF, MODEL_EDGES, Tables, followers, gain_model, song_stats
from cadenza.catalogue.registry import cte, oracle, query, rounded, sql_ratio
from cadenza.functions.dates import back
from cadenza.operators.binned import build_model, fit_model, lookup_bin
from cadenza.operators.keys import rank_per_key, top_per_key
from cadenza.plans.ranks import city_changes, city_summary, combined_ranks, genre_chart_changes, rank_changes, rank_improvement
from cadenza.plans.social import GainRule, follower_gain_chart, long_term_growth, snapshot_growth, viral_growth

E = EVENTS_AS_OF

cte("owner_rows", "SELECT p.p_partkey AS artist_id, p.p_name AS artist, CAST(p.p_size AS BIGINT) AS account, st.tw_streams FROM part p LEFT JOIN song_stats st ON st.song_id = p.p_partkey WHERE p.p_brand <> 'Brand#1'")
cte("owner", "SELECT * EXCLUDE k FROM (SELECT *, row_number() OVER (PARTITION BY account ORDER BY tw_streams DESC NULLS LAST, artist_id) AS k FROM owner_rows) WHERE k = 1")
cte("earlier", "SELECT DISTINCT p_partkey AS artist_id FROM part WHERE p_type = 'ECONOMY'")


def owner_rows(t: Tables):
    """Unsigned entities with their account: several share one, the most streamed owns it."""
    rows = t.part.filter(F.col("p_brand") != "Brand#1").select(
        F.col("p_partkey").alias("artist_id"), F.col("p_name").alias("artist"), F.col("p_size").cast("bigint").alias("account")
    )
    stats = song_stats(t).select(F.col("song_id").alias("artist_id"), "tw_streams")
    return rows.join(stats, "artist_id", "left")


def earlier(t: Tables):
    """The stored edition the charts compare with."""
    return t.part.filter(F.col("p_type") == "ECONOMY").select(F.col("p_partkey").alias("artist_id"))


def _fit(x: str, gain: str, table: str) -> str:
    inside = f"(v.{x} > m.bin_min AND v.{x} <= m.bin_max AND v.{x} < b.edge) OR (m.bin_min = b.edge AND v.{x} >= b.edge)"
    return (
        f"SELECT v.*, m.mean, m.std, (v.{gain} - m.mean) / m.std AS z FROM {table} v "
        f"LEFT JOIN (SELECT max(bin_min) AS edge FROM gain_model) b ON true LEFT JOIN gain_model m ON {inside}"
    )


def _dense(table: str) -> str:
    return f"""
    SELECT g.account, g.date, coalesce(f.v, lo.v + (hi.v - lo.v) * date_diff('day', lo.d, g.date) / date_diff('day', lo.d, hi.d)) AS v
    FROM (SELECT account, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM {table} GROUP BY account) g
    LEFT JOIN (SELECT account, date, CAST(followers AS DOUBLE) AS v FROM {table}) f ON f.account = g.account AND f.date = g.date
    LEFT JOIN LATERAL (SELECT max(x.date) AS d, CAST(max_by(x.followers, x.date) AS DOUBLE) AS v FROM {table} x WHERE x.account = g.account AND x.date < g.date) lo ON true
    LEFT JOIN LATERAL (SELECT min(x.date) AS d, CAST(min_by(x.followers, x.date) AS DOUBLE) AS v FROM {table} x WHERE x.account = g.account AND x.date > g.date) hi ON true
    """


def _window(days: int, where: str = "true") -> str:
    return f"SELECT account, date, followers FROM followers WHERE date > DATE '{back(E, days)}' AND account IN (SELECT account FROM owner) AND {where}"


@query("binned_model", oracle("SELECT count, round(mean, 6) AS mean, round(std, 6) AS std, bin_min, bin_max FROM gain_model"))
def binned_model(spark, folder):
    t = Tables(spark, folder)
    return build_model(followers(t), "followers", "gained", MODEL_EDGES).withColumns(rounded("mean", "std"))


@query("binned_fit", oracle("SELECT account, CAST(date AS VARCHAR) AS date, followers, gained, round(mean, 6) AS mean, round(std, 6) AS std, round(z, 6) AS z_score FROM f", v="SELECT f.account, f.date, f.followers, p.gained FROM followers f JOIN points p USING (account, date)", f=_fit("followers", "gained", "v")))
def binned_fit(spark, folder):
    t = Tables(spark, folder)
    out = fit_model(followers(t).drop("events"), gain_model(t), "followers", "gained")
    return out.withColumns(rounded("mean", "std", "z_score"))


@query(
    "binned_lookup",
    oracle(
        "SELECT f.account, CAST(f.date AS VARCHAR) AS date, f.followers, round(m.mean, 6) AS mean, round(m.std, 6) AS std FROM followers f LEFT JOIN gain_model m "
        "ON f.followers >= m.bin_min AND (f.followers < m.bin_max OR m.bin_max = (SELECT max(bin_max) FROM gain_model))"
    ),
)
def binned_lookup(spark, folder):
    t = Tables(spark, folder)
    return lookup_bin(followers(t).drop("events", "gained"), gain_model(t), "followers").withColumns(rounded("mean", "std"))


def _gains(k: float, keep: str, floor: str) -> dict:
    return {
        "grid": _dense("pts"),
        "lagged": "SELECT *, lag(v, 7) OVER (PARTITION BY account ORDER BY date) AS v7, row_number() OVER (PARTITION BY account ORDER BY date DESC) AS k, count(*) OVER (PARTITION BY account) AS n FROM grid",
        "g": f"SELECT account, v, v - v7 AS gain FROM lagged WHERE k = 1 AND v7 IS NOT NULL AND {keep} AND {floor}",
        "fitted": _fit("v", "gain", "g"),
        "hot": f"SELECT account, CAST(floor(v) AS BIGINT) AS followers, CAST(floor(gain) AS BIGINT) AS gain, round(z, 6) AS growth_score FROM fitted WHERE gain > mean + std * {k}",
    }


_CHART = "SELECT h.*, o.artist_id, o.artist, o.tw_streams, o.artist_id NOT IN (SELECT artist_id FROM earlier) AS is_new FROM hot h LEFT JOIN owner o ON o.account = h.account"
PHOTO = GainRule(16, 3, True, 1000, 7.0)
AUDIO = GainRule(16, 4, False, 1000, 7.0)
VIDEO = GainRule(21, 4, False, 1000, 7.0, drop_zero=True)


def _gain_chart(t: Tables, rule: GainRule, latest=None):
    out = follower_gain_chart(
        followers(t).select("account", "date", "followers"), owner_rows(t), gain_model(t), earlier(t), "account", "followers", E, rule, latest
    )
    return out.withColumns(rounded("growth_score"))


@query("follower_gain_photo", oracle(_CHART, pts=_window(16), **_gains(7.0, "n > 3", "v > 1000")))
def follower_gain_photo(spark, folder):
    """History is counted after filling gaps, the floor is on the last value."""
    return _gain_chart(Tables(spark, folder), PHOTO)


_LATEST = "SELECT account FROM followers GROUP BY 1 HAVING max_by(followers, date) > 1000"


def latest_followers(t: Tables):
    return followers(t).groupBy("account").agg(F.max_by("followers", "date").alias("followers_latest"))


@query(
    "follower_gain_audio",
    oracle(_CHART, latest=_LATEST, raw=_window(16, "account IN (SELECT account FROM latest)"), pts="SELECT * FROM raw WHERE account IN (SELECT account FROM raw GROUP BY 1 HAVING count(*) > 4)", **_gains(7.0, "true", "true")),
)
def follower_gain_audio(spark, folder):
    """History is counted before filling, the floor is on the account's latest count."""
    t = Tables(spark, folder)
    return _gain_chart(t, AUDIO, latest_followers(t))


@query(
    "follower_gain_video",
    oracle(_CHART, latest=_LATEST, raw=_window(21, "followers <> 0 AND account IN (SELECT account FROM latest)"), pts="SELECT * FROM raw WHERE account IN (SELECT account FROM raw GROUP BY 1 HAVING count(*) > 4)", **_gains(7.0, "true", "true")),
)
def follower_gain_video(spark, folder):
    t = Tables(spark, folder)
    return _gain_chart(t, VIDEO, latest_followers(t))


@query(
    "follower_long_term",
    oracle(
        "SELECT b.account, round(b.six, 6) AS six_month_z_score, round(b.two, 6) AS fourteen_day_z_score, CAST(l.date AS VARCHAR) AS recent_date, CAST(floor(l.v) AS BIGINT) AS followers, "
        "CAST(floor(l.v7) AS BIGINT) AS followers_7_days_ago, CAST(floor(l.gain) AS BIGINT) AS followers_gained, round_even((l.v - l.v7) / nullif(l.v7, 0) * 100, 2) AS followers_pct_chg, o.artist_id, o.artist, o.tw_streams, o.artist_id NOT IN (SELECT artist_id FROM earlier) AS is_new "
        "FROM best b JOIN (SELECT account, max(date) AS date, max_by(v, date) AS v, max_by(v7, date) AS v7, max_by(gain, date) AS gain FROM week GROUP BY 1) l ON l.account = b.account JOIN owner o ON o.account = b.account",
        raw=_window(186),
        pts="SELECT * FROM raw WHERE account IN (SELECT account FROM raw GROUP BY 1 HAVING count(*) > 4)",
        grid=_dense("pts"),
        day="SELECT *, coalesce(v - lag(v) OVER (PARTITION BY account ORDER BY date), 0) AS g FROM grid",
        rises="SELECT account, sum(CASE WHEN g > 0 AND g >= p THEN 1 ELSE 0 END) AS r FROM (SELECT *, coalesce(lag(g) OVER (PARTITION BY account ORDER BY date), 0) AS p FROM day) GROUP BY 1",
        week="SELECT * FROM (SELECT account, date, v, lag(v, 7) OVER (PARTITION BY account ORDER BY date) AS v7, v - lag(v, 7) OVER (PARTITION BY account ORDER BY date) AS gain FROM grid WHERE account IN (SELECT account FROM rises WHERE r > (SELECT avg(r) FROM rises))) WHERE v7 IS NOT NULL",
        fitted=_fit("v", "gain", "week"),
        best="SELECT account, avg(z) AS six, avg(CASE WHEN date > last - 14 THEN z END) AS two FROM (SELECT *, max(date) OVER (PARTITION BY account) AS last FROM fitted) GROUP BY 1 HAVING six > 0 AND two > 0 ORDER BY six DESC, account LIMIT 1000",
    ),
)
def follower_long_term(spark, folder):
    t = Tables(spark, folder)
    out = long_term_growth(
        followers(t).select("account", "date", "followers"), owner_rows(t), gain_model(t), earlier(t), "account", "followers", E
    )
    return out.withColumns(rounded("six_month_z_score", "fourteen_day_z_score"))


@query(
    "viral_growth",
    oracle(
        "SELECT s.account, round(s.z, 6) AS z_score, CAST(l.date AS VARCHAR) AS latest_date, l.v AS followers, CASE WHEN l.v7 IS NULL THEN 0 ELSE l.v - l.v7 END AS gain_7_day, o.artist_id AS song_id, o.artist AS title, o.artist_id NOT IN (SELECT artist_id FROM earlier) AS is_new "
        "FROM (SELECT account, avg(z) AS z FROM fitted GROUP BY 1 HAVING avg(z) > -0.2) s JOIN (SELECT account, max(date) AS date, max_by(v, date) AS v, max_by(coalesce(v7, -1), date) AS w, nullif(max_by(coalesce(v7, -1), date), -1) AS v7 FROM (SELECT *, lag(v, 7) OVER (PARTITION BY account ORDER BY date) AS v7 FROM day) GROUP BY 1) l ON l.account = s.account "
        "JOIN owner_rows o ON o.account = s.account",
        raw=_window(14, "followers > 0"),
        pts="SELECT * FROM raw WHERE account IN (SELECT account FROM raw GROUP BY 1 HAVING count(*) >= 5)",
        grid=_dense("pts"),
        day="SELECT account, date, CAST(floor(v) AS BIGINT) AS v, CAST(trunc(coalesce(v - lag(v) OVER (PARTITION BY account ORDER BY date), 0)) AS BIGINT) AS g FROM grid",
        fitted=_fit("v", "g", "day"),
    ),
)
def viral_growth_query(spark, folder):
    t = Tables(spark, folder)
    songs = owner_rows(t).select(F.col("artist_id").alias("song_id"), F.col("artist").alias("title"), "account")
    previous = earlier(t).withColumnRenamed("artist_id", "song_id")
    out = viral_growth(
        followers(t).select("account", "date", "followers"), songs, gain_model(t), previous, "account", "followers", E, min_score=-0.2
    )
    return out.withColumns(rounded("z_score"))


def _risen(column: str) -> str:
    return f"({sql_ratio(f't.{column}', f'l.{column}')} - 1) * 100"


@query(
    "snapshot_growth",
    oracle(
        "SELECT t.account, t.followers AS tw_followers, l.followers AS lw_followers, t.gained AS tw_gained, l.gained AS lw_gained, "
        f"round({_risen('followers')}, 6) AS followers_pct_chg, round({_risen('gained')}, 6) AS gained_pct_chg "
        f"FROM s t JOIN s l ON l.account = t.account AND l.date = DATE '{back(E, 10)}' WHERE t.date = DATE '{back(E, 3)}' AND t.followers >= 1500 AND l.followers <> 0 "
        f"AND (coalesce({_risen('followers')} > 15, false) OR coalesce({_risen('gained')} > 15, false)) AND t.account NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 0)",
        s="SELECT f.account, f.date, f.followers, p.gained FROM followers f JOIN points p USING (account, date)",
    ),
)
def snapshot_growth_query(spark, folder):
    """Two measures three and ten days back, days without gains included; accounts of signed suppliers drop out."""
    t = Tables(spark, folder)
    known = t.supplier.select(F.col("s_suppkey").alias("account"), (F.col("s_acctbal") < 0).alias("signed"))
    out = snapshot_growth(followers(t), known, "account", E, floor=1500, lead="followers", others=("gained",))
    return out.drop("signed").withColumns(rounded("followers_pct_chg", "gained_pct_chg"))


# Ranks per day over followers, events and gains, for the two compared days.
LATEST = dt.date(2024, 1, 30)
RANKS = {"rank_25_75": "followers", "rank_fb": "events", "rank_eg": "gained"}
cte(
    "rank_stat",
    "SELECT account, date, "
    + ", ".join(f"row_number() OVER (PARTITION BY date ORDER BY {v} DESC, account) AS {r}" for r, v in RANKS.items())
    + f" FROM (SELECT f.account, f.date, f.followers, p.events, p.gained FROM followers f JOIN points p USING (account, date)) WHERE date IN (DATE '{LATEST}', DATE '{back(LATEST, 7)}')",
)


def rank_stat(t: Tables):
    days = followers(t).filter(F.col("date").isin(LATEST, back(LATEST, 7)))
    out = days
    for rank, value in RANKS.items():
        out = rank_per_key(out, ["date"], [F.col(value).desc(), F.col("account").asc()], rank)
    return out.select("account", "date", *RANKS)


CAP, CLIMB = {"rank_25_75": 140, "rank_fb": 145, "rank_eg": 140}, 0


def _improve(rank: str) -> str:
    return (
        f"SELECT x.account, t.{rank} AS rnk, l.{rank} AS last_rnk, l.{rank} - t.{rank} AS rnk_chg, x.artist_id, x.artist, x.tw_streams, x.artist_id NOT IN (SELECT artist_id FROM earlier) AS is_new "
        f"FROM rank_stat t LEFT JOIN rank_stat l ON l.account = t.account AND l.date = DATE '{back(LATEST, 7)}' JOIN owner_rows x ON x.account = t.account "
        f"WHERE t.date = DATE '{LATEST}' AND t.{rank} < {CAP[rank]} AND (l.{rank} IS NULL OR l.{rank} - t.{rank} > {CLIMB})"
    )


def _improvement(t: Tables, ranks, rank: str):
    return rank_improvement(ranks, owner_rows(t), earlier(t), "account", rank, CAP[rank], LATEST, CLIMB)


@query("rank_improve", oracle(_improve("rank_25_75")))
def rank_improve(spark, folder):
    t = Tables(spark, folder)
    return _improvement(t, rank_stat(t), "rank_25_75")


@query("rank_improve_fanbase", oracle(_improve("rank_fb")))
def rank_improve_fanbase(spark, folder):
    t = Tables(spark, folder)
    return _improvement(t, rank_stat(t), "rank_fb")


@query("rank_improve_engagement", oracle(_improve("rank_eg")))
def rank_improve_engagement(spark, folder):
    t = Tables(spark, folder)
    return _improvement(t, rank_stat(t), "rank_eg")


@query(
    "ranks_combined",
    oracle(
        "SELECT r.artist_id, r.account, r.artist, r.tw_streams, r.rnk AS cm_rank, r.rnk_chg AS cm_rank_chg, f.rnk AS cm_fanbase_rank, f.rnk_chg AS cm_fanbase_rank_chg, e.rnk AS cm_engagement_rank, e.rnk_chg AS cm_engagement_rank_chg, "
        "r.artist_id NOT IN (SELECT artist_id FROM earlier) AS is_new FROM r JOIN f ON f.artist_id = r.artist_id JOIN e ON e.artist_id = r.artist_id",
        r=_improve("rank_25_75"), f=_improve("rank_fb"), e=_improve("rank_eg"),
    ),
)
def ranks_combined(spark, folder):
    t = Tables(spark, folder)
    ranks = rank_stat(t)
    return combined_ranks(*[_improvement(t, ranks, r) for r in RANKS], earlier(t))


# Track charts: accounts as tracks, event types as cities, ranked per city and day.
_OFFSETS = {"tp": 2, "lp": 3, "lw": 7}
_CITY = f"SELECT *, row_number() OVER (PARTITION BY city, date ORDER BY v DESC, track_id) AS rank FROM (SELECT user_id AS track_id, event_type AS city, CAST(ts AS DATE) AS date, count(*) AS v FROM events GROUP BY 1, 2, 3)"
_NATION = "SELECT *, row_number() OVER (PARTITION BY date ORDER BY v DESC, track_id) AS rank FROM (SELECT user_id AS track_id, CAST(ts AS DATE) AS date, count(*) AS v FROM events GROUP BY 1, 2)"


def track_chart(t: Tables, by_city: bool):
    places = ["city"] if by_city else []
    days = [back(E, n) for n in _OFFSETS.values()]
    rows = t.events.select(F.col("user_id").alias("track_id"), F.col("event_type").alias("city"), F.to_date("ts").alias("date"))
    counts = rows.filter(F.col("date").isin(days)).groupBy("track_id", *places, "date").agg(F.count(F.lit(1)).alias("v"))
    return rank_per_key(counts, [*places, "date"], [F.col("v").desc(), F.col("track_id").asc()], "rank")


def _changes(chart: str, keys: list[str]) -> str:
    on = {p: " AND ".join(f"{p}.{k} = t.{k}" for k in keys) for p in ("lp", "lw")}
    cols = ", ".join(f"t.{k}" for k in keys)
    parts = ", ".join(f"coalesce({p}.rank, 0) AS {p}_rank, {p}.rank - t.rank AS {p}_rank_chg, {p}.rank IS NULL AS {p}_is_new" for p in ("lp", "lw"))
    return (
        f"SELECT {cols}, t.rank, {parts} FROM {chart} t LEFT JOIN {chart} lp ON {on['lp']} AND lp.date = DATE '{back(E, 3)}' "
        f"LEFT JOIN {chart} lw ON {on['lw']} AND lw.date = DATE '{back(E, 7)}' WHERE t.date = DATE '{back(E, 2)}'"
    )


@query("rank_change_country", oracle("SELECT * FROM c", nation_chart=_NATION, c=_changes("nation_chart", ["track_id"])))
def rank_change_country(spark, folder):
    return rank_changes(track_chart(Tables(spark, folder), False), ["track_id"], E)


_CITY_OUT = (
    "SELECT c.*, length(c.city) AS market_rank, c.track_id IN (SELECT n.track_id FROM nation_chart n WHERE n.date = DATE '" + str(back(E, 2)) + "' AND n.rank <= 40) AS national_chart, l.label, coalesce(EXISTS (SELECT 1 FROM part x WHERE x.p_size = 2 AND x.p_brand = 'Brand#3' AND contains(l.label, split_part(x.p_name, ' ', 1))), false) AS signed "
    "FROM c LEFT JOIN lab l ON l.track_id = c.track_id"
)
_LAB = "SELECT track_id, label FROM (SELECT CAST(p_size AS BIGINT) AS track_id, p_name AS label, row_number() OVER (PARTITION BY p_size ORDER BY p_retailprice DESC, p_name) AS k FROM part) WHERE k = 1"
_CITY_ALL = {"city_chart": _CITY, "nation_chart": _NATION, "lab": _LAB}


def _city(t: Tables):
    chart = track_chart(t, True)
    national = track_chart(t, False).filter((F.col("date") == F.lit(back(E, 2))) & (F.col("rank") <= 40))
    markets = t.events.select(F.col("event_type").alias("city")).distinct().withColumn("market_rank", F.length("city"))
    labels_of = t.part.select(F.col("p_size").cast("bigint").alias("track_id"), F.col("p_name").alias("label"), F.col("p_retailprice").alias("popularity"))
    few = (F.col("p_size") == 2) & (F.col("p_brand") == "Brand#3")
    listed = t.part.filter(few).select(F.upper(F.substring_index("p_name", " ", 1)).alias("label"))
    return city_changes(chart, national, markets, labels_of, listed, E)


@query("rank_change_city", oracle(_CITY_OUT, **_CITY_ALL, c=_changes("city_chart", ["track_id", "city"])))
def rank_change_city(spark, folder):
    return _city(Tables(spark, folder))


@query(
    "rank_change_city_summary",
    oracle(
        "SELECT * EXCLUDE (k, city, market_rank), (SELECT count(*) FROM o x WHERE x.track_id = y.track_id) AS count FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY rank, city) AS k FROM o) y WHERE k = 1",
        **_CITY_ALL, c=_changes("city_chart", ["track_id", "city"]), o=_CITY_OUT,
    ),
)
def rank_change_city_summary(spark, folder):
    return city_summary(_city(Tables(spark, folder)))


@query(
    "genre_chart_change",
    oracle(
        "SELECT t.track_id, t.city AS genre, t.rank, l.rank AS lp_rank, l.rank - t.rank AS chg, l.rank IS NULL AS is_new, lab.label FROM city_chart t "
        f"LEFT JOIN city_chart l ON l.track_id = t.track_id AND l.city = t.city AND l.date = DATE '{back(E, 3)}' LEFT JOIN lab ON lab.track_id = t.track_id WHERE t.date = DATE '{back(E, 2)}'",
        **_CITY_ALL,
    ),
)
def genre_chart_change(spark, folder):
    """Places gained per (genre, track): a track in two genres is compared within each."""
    t = Tables(spark, folder)
    chart = track_chart(t, True).withColumnRenamed("city", "genre").drop("v")
    facts = t.part.select(F.col("p_size").cast("bigint").alias("track_id"), F.col("p_name").alias("label"), "p_retailprice")
    top = top_per_key(facts, ["track_id"], "p_retailprice", "label").select("track_id", "label")
    today = chart.filter(F.col("date") == F.lit(back(E, 2))).drop("date")
    before = chart.filter(F.col("date") == F.lit(back(E, 3)))
    return genre_chart_changes(today, before, top, "track_id")
