"""Growth, momentum, stats views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from cadenza.catalogue.domain import (
    AS_OF,
    Tables,
    artist_meta,
    artist_stats,
    artist_streams,
    artists,
    profiles,
    song_meta,
    song_stats,
    song_streams,
    songs,
    tracks,
)
from cadenza.catalogue.registry import finite, oracle, query, sql_percent, sql_ratio
from cadenza.functions.dates import back
from cadenza.operators.keys import global_rank
from cadenza.operators.reshape import pivot_dates
from cadenza.operators.timegrid import calendar_weekly_sums, streaks, weekly_sums
from cadenza.plans.genres import entity_genres
from cadenza.plans.growth import eight_week_growth, genre_set_growth, with_release_span
from cadenza.plans.momentum import daily_momentum, weekly_acceleration
from cadenza.plans.views import artist_tracks, daily_report, denormalise, move_stats, stats_of, stats_state, track_counts
from cadenza.session import materialise

DOW = int(back(AS_OF, 1).isoweekday() % 7)


def _weekly(table: str, key: str, days: int) -> str:
    return (
        f"SELECT {key}, date_trunc('week', date - {DOW}) AS week, sum(streams) AS s FROM {table} "
        f"WHERE date > DATE '{AS_OF}' - {days} AND date < DATE '{AS_OF}' GROUP BY 1, 2"
    )


def _streak_sql(key: str, weekly: str = "weekly", zero: bool = False) -> str:
    before = f"lag(s) OVER (PARTITION BY {key} ORDER BY week)"
    if zero:
        before = f"coalesce({before}, 0)"
    return (
        f"SELECT {key}, CAST(sum(CASE WHEN s > b THEN 1 ELSE 0 END) AS BIGINT) AS num_positive_weeks, "
        "CAST(sum(CAST(CASE WHEN p IS NULL THEN 0 WHEN p < -50 THEN -50 WHEN p > 50 THEN 50 ELSE p END AS DECIMAL(12,2))) AS DOUBLE) AS rolling_pct_chg "
        f"FROM (SELECT *, {sql_percent('s', 'b')} AS p FROM (SELECT *, {before} AS b FROM {weekly})) GROUP BY 1"
    )


def _growth_sql(key: str, table: str, entity: str, days: int, floor: int, weeks: int) -> str:
    return oracle(
        f"SELECT g.{key}, g.num_positive_weeks, g.rolling_pct_chg, e.tw_streams, e.pct_chg FROM strong g JOIN {entity} e ON g.{key} = e.{key} "
        f"WHERE e.tw_streams > {floor} AND e.signed = false AND g.rolling_pct_chg > 0 AND g.num_positive_weeks > {weeks}",
        weekly=_weekly(table, key, days),
        strong=_streak_sql(key),
    )


@query("growth_8w_artist", _growth_sql("artist_id", "artist_streams", "artists", 64, 0, 2))
def growth_8w_artist(spark, folder):
    t = Tables(spark, folder)
    out = eight_week_growth(artist_streams(t), artists(t), "artist_id", AS_OF, floor=0, min_weeks=2)
    return out.select("artist_id", "num_positive_weeks", "rolling_pct_chg", "tw_streams", "pct_chg")


SONG_DAYS = 1093


@query("growth_8w_song", _growth_sql("song_id", "song_streams", "songs", SONG_DAYS, 50, 4))
def growth_8w_song(spark, folder):
    """The same over three years: a part sells too rarely for eight weeks."""
    t = Tables(spark, folder)
    out = eight_week_growth(song_streams(t), songs(t), "song_id", AS_OF, floor=50, min_weeks=4, days=SONG_DAYS)
    return out.select("song_id", "num_positive_weeks", "rolling_pct_chg", "tw_streams", "pct_chg")


@query("weekly_aligned", oracle("SELECT artist_id, CAST(CAST(week AS DATE) AS VARCHAR) AS week, CAST(s AS BIGINT) AS streams FROM weekly", weekly=_weekly("artist_streams", "artist_id", 64)))
def weekly_aligned(spark, folder):
    t = Tables(spark, folder)
    return weekly_sums(artist_streams(t), ["artist_id"], "streams", AS_OF, 64)


SINCE = dt.date(2000, 12, 30)
_CAL = f"SELECT artist_id, date_trunc('week', date) AS week, sum(streams) AS s FROM artist_streams WHERE date > DATE '{SINCE}' GROUP BY 1, 2"


@query("weekly_calendar", oracle("SELECT artist_id, CAST(CAST(week AS DATE) AS VARCHAR) AS week, CAST(s AS BIGINT) AS streams FROM weekly", weekly=_CAL))
def weekly_calendar(spark, folder):
    t = Tables(spark, folder)
    return calendar_weekly_sums(artist_streams(t), ["artist_id"], "streams", SINCE)


@query(
    "positive_weeks_from_zero",
    oracle("SELECT artist_id, num_positive_weeks FROM strong", weekly=_CAL, strong=_streak_sql("artist_id", zero=True)),
)
def positive_weeks_from_zero(spark, folder):
    t = Tables(spark, folder)
    weekly = calendar_weekly_sums(artist_streams(t), ["artist_id"], "streams", SINCE)
    return streaks(weekly, ["artist_id"], "streams", True).select("artist_id", "num_positive_weeks")


GENRES = ["small", "red", "widget", "ring", "large"]
_IN = ", ".join(f"'{g}'" for g in GENRES)
_LTG = (
    "SELECT p.artist_id, p.num_positive_weeks AS positive_weeks, a.artist, a.tw_streams FROM strong p JOIN artists a ON p.artist_id = a.artist_id "
    f"WHERE a.signed = false AND a.tw_streams > 0 AND p.num_positive_weeks > 10 AND p.artist_id IN (SELECT artist_id FROM artist_genres WHERE genre IN ({_IN}))"
)


def _ltg(t: Tables):
    members = entity_genres(profiles(t))
    return genre_set_growth(artist_streams(t), members, artists(t), GENRES, SINCE, floor=0)


@query("ltg_genre_set", oracle(_LTG, weekly=_CAL, strong=_streak_sql("artist_id", zero=True)))
def ltg_genre_set(spark, folder):
    return _ltg(Tables(spark, folder)).select("artist_id", "positive_weeks", "artist", "tw_streams")


_SPAN = (
    "SELECT t.artist_id, min(CAST(o.o_orderdate AS DATE)) AS lo, max(CAST(o.o_orderdate AS DATE)) AS hi "
    "FROM (SELECT DISTINCT artist_id, collection_id FROM tracks) t JOIN orders o ON t.collection_id = o.o_orderkey GROUP BY 1"
)


@query(
    "ltg_genre_set_releases",
    oracle(
        "SELECT l.artist_id, l.positive_weeks, CAST(s.lo AS VARCHAR) AS min_release_date, CAST(s.hi AS VARCHAR) AS max_release_date FROM ltg l JOIN span s ON l.artist_id = s.artist_id",
        weekly=_CAL,
        strong=_streak_sql("artist_id", zero=True),
        ltg=_LTG,
        span=_SPAN,
    ),
)
def ltg_genre_set_releases(spark, folder):
    """Release dates are order dates, so the artist's collections stand in for songs."""
    t = Tables(spark, folder)
    links = tracks(t).select("artist_id", F.col("collection_id").alias("song_id")).distinct()
    releases = t.orders.select(F.col("o_orderkey").alias("song_id"), F.to_date("o_orderdate").alias("release_date"))
    out = with_release_span(_ltg(t), links, releases)
    return out.select("artist_id", "positive_weeks", "min_release_date", "max_release_date")


@query("entity_stats", oracle("SELECT * FROM artist_stats"))
def entity_stats_query(spark, folder):
    return artist_stats(Tables(spark, folder))


def moved_stats(t: Tables):
    """The stats of a week ago, from an edition without the returned lines, and as moved to today."""
    rows = t.lineitem.select(
        F.col("l_suppkey").alias("artist_id"), F.to_date("l_shipdate").alias("date"), F.col("l_returnflag") != "R", F.col("l_quantity").cast("bigint").alias("q")
    ).toDF("artist_id", "date", "early", "q")
    edition = lambda df: df.groupBy("artist_id", "date").agg(F.sum("q").alias("streams"))
    held, was = edition(rows.filter("early")), back(AS_OF, 7)
    state = materialise(stats_state(held, "artist_id", was), "stats-state")
    return state, move_stats(state, held, edition(rows), "artist_id", was, AS_OF)


@query("entity_stats_moved", oracle("SELECT * FROM artist_stats"))
def entity_stats_moved(spark, folder):
    """Last week's view brought to today by what a load and seven days have changed."""
    return stats_of(moved_stats(Tables(spark, folder))[1], "artist_id")


@query("entity_stats_song", oracle("SELECT * FROM song_stats"))
def entity_stats_song(spark, folder):
    return song_stats(Tables(spark, folder))


_COUNTS = "SELECT artist_id, count(DISTINCT song_id) AS track_count FROM tracks GROUP BY 1"


@query("track_count", oracle(_COUNTS))
def track_count(spark, folder):
    return track_counts(tracks(Tables(spark, folder)))


@query(
    "artist_tracks",
    oracle(
        "SELECT artist_id, song_id, tw_streams, row_number() OVER (PARTITION BY artist_id ORDER BY tw_streams DESC NULLS LAST, song_id) AS rnk "
        "FROM (SELECT DISTINCT t.artist_id, t.song_id, s.tw_streams FROM tracks t LEFT JOIN song_stats s ON t.song_id = s.song_id)"
    ),
)
def artist_tracks_query(spark, folder):
    t = Tables(spark, folder)
    return artist_tracks(tracks(t), song_stats(t)).select("artist_id", "song_id", "tw_streams", "rnk")


@query(
    "entity_denorm",
    oracle(
        "SELECT a.artist_id, a.artist, a.signed, a.tw_streams, a.lw_streams, a.pct_chg, p.genres, c.track_count, x.rtd_streams "
        "FROM artists a LEFT JOIN profiles p ON a.artist_id = p.artist_id LEFT JOIN counts c ON a.artist_id = c.artist_id LEFT JOIN life x ON a.artist_id = x.artist_id",
        counts=_COUNTS,
        life="SELECT artist_id, CAST(sum(streams) AS BIGINT) AS rtd_streams FROM artist_streams GROUP BY 1",
    ),
)
def entity_denorm(spark, folder):
    t = Tables(spark, folder)
    life = artist_streams(t).groupBy("artist_id").agg(F.sum("streams").alias("rtd_streams"))
    parts = [artist_stats(t), profiles(t), track_counts(tracks(t)), life]
    return denormalise(artist_meta(t), "artist_id", parts).select(
        "artist_id", "artist", "signed", "tw_streams", "lw_streams", "pct_chg", "genres", "track_count", "rtd_streams"
    )


# The day's song report: parts that sold on the as-of date.
def _report(t: Tables):
    day = song_streams(t).select("song_id", F.col("streams").alias("tw_rank"), F.col("date").alias("report_date"))
    return day.join(song_meta(t).select("song_id", "signed"), "song_id")


@query(
    "daily_report",
    oracle(
        "SELECT d.song_id, d.streams AS tw_rank, s.signed, CAST(d.date AS VARCHAR) AS report_date, s.title, s.tw_streams, s.pct_chg "
        f"FROM song_streams d JOIN songs s ON d.song_id = s.song_id WHERE d.date = DATE '{AS_OF}'"
    ),
)
def daily_report_query(spark, folder):
    t = Tables(spark, folder)
    names = song_meta(t).select("song_id", "title")
    plain = t.part.select(F.col("p_partkey").alias("song_id"), F.col("p_size").alias("size"))
    out = daily_report(names, song_stats(t), _report(t), plain, AS_OF)
    return out.select("song_id", "tw_rank", "signed", "report_date", "title", "tw_streams", "pct_chg")


def wide_artists(t: Tables):
    """A daily file by artist: 14 day columns newest first, zero where nothing was sold."""
    days = [back(AS_OF, i) for i in range(14)]
    names = [d.isoformat() for d in days]
    wide = pivot_dates(artist_streams(t), ["artist_id"], days, "streams").fillna(0)

    def total(part):
        return sum((F.col(n) for n in part[1:]), F.col(part[0]))

    return (
        wide.withColumn("tw_rolling_oda", total(names[:7]))
        .withColumn("lw_rolling_oda", total(names[7:]))
        .withColumn("tw_oda_streams", total(names[1:8]))
        .withColumn("lw_oda_streams", total(names[8:]))
    ), names


_DAY = ", ".join(f"CAST(sum(CASE WHEN date = DATE '{AS_OF}' - {i} THEN streams ELSE 0 END) AS BIGINT) AS d{i}" for i in range(14))
_WIDE = f"SELECT artist_id, {_DAY} FROM artist_streams WHERE date BETWEEN DATE '{AS_OF}' - 13 AND DATE '{AS_OF}' GROUP BY 1"


def _plus(lo: int, hi: int) -> str:
    return "(" + " + ".join(f"d{i}" for i in range(lo, hi)) + ")"


_M = (
    f"SELECT w.*, {sql_ratio('tw', 'lw')} - 1 AS pct_chg, {sql_ratio('twr', 'lwr')} - 1 AS roll, {sql_ratio('d0', 'd1')} - 1 AS c2, "
    f"{sql_ratio('d1', 'd2')} - 1 AS c3, pow({sql_ratio('d1', 'd7')}, 1e0/6) - 1 AS a7, pow({sql_ratio('d1', 'd4')}, 1e0/3) - 1 AS a4 "
    f"FROM (SELECT *, {_plus(0, 7)} AS twr, {_plus(7, 14)} AS lwr, {_plus(1, 8)} AS tw, {_plus(8, 14)} AS lw FROM wide) w"
)


def _fin(c: str) -> str:
    return f"CASE WHEN abs({c}) < CAST('Infinity' AS DOUBLE) THEN round({c}, 6) END"


@query(
    "momentum_daily",
    oracle(
        f"SELECT m.artist_id, a.artist, twr AS tw_rolling_oda, lwr AS lw_rolling_oda, {_fin('m.pct_chg')} AS pct_chg, {_fin('roll')} AS rolling_pct_chg, "
        f"{_fin('c2')} AS chg_2_day, {_fin('c3')} AS chg_3_day, {_fin('a7')} AS acc_7_day, {_fin('a4')} AS acc_4_day, nullif(d0, 0) AS newest, nullif(d13, 0) AS oldest "
        "FROM metrics m LEFT JOIN artists a ON m.artist_id = a.artist_id WHERE d1 >= 1 AND a.signed IS NOT TRUE AND coalesce(roll >= 0, false) AND ("
        "coalesce(c2 >= 0.15 AND c3 > 0, false) OR coalesce(c3 >= 0.25, false) OR coalesce(a7 >= 0.15 AND a4 > 0, false) "
        "OR coalesce(roll >= 0.5 AND lwr > 30, false) OR coalesce(a4 >= 0.15 AND c3 > 0, false))",
        wide=_WIDE,
        metrics=_M,
    ),
)
def momentum_daily(spark, folder):
    t = Tables(spark, folder)
    wide, names = wide_artists(t)
    out = daily_momentum(wide, artist_meta(t), artist_streams(t), "artist_id", AS_OF, names, floor=1, rolling_floor=30)
    return out.select(
        "artist_id",
        "artist",
        "tw_rolling_oda",
        "lw_rolling_oda",
        finite("pct_chg"),
        finite("rolling_pct_chg"),
        finite("2_day_chg").alias("chg_2_day"),
        finite("3_day_chg").alias("chg_3_day"),
        finite("7_day_acc").alias("acc_7_day"),
        finite("4_day_acc").alias("acc_4_day"),
        F.col(names[0]).alias("newest"),
        F.col(names[13]).alias("oldest"),
    )


_WEEK3 = (
    f"SELECT artist_id, {', '.join(f'CAST(sum(CASE WHEN date = DATE {chr(39)}{AS_OF}{chr(39)} - {i} THEN streams ELSE 0 END) AS BIGINT) AS d{i}' for i in range(21))} "
    f"FROM artist_streams WHERE date BETWEEN DATE '{AS_OF}' - 20 AND DATE '{AS_OF}' GROUP BY 1"
)
_A = (
    f"SELECT r.*, {sql_ratio('tw', 'lw')} - 1 AS pct, pow({sql_ratio('tw', 'l2w')}, 0.5e0) - 1 AS a3, pow({sql_ratio('d0', 'd6')}, 1e0/6) - 1 AS a7 "
    "FROM (SELECT *, row_number() OVER (ORDER BY tw DESC, artist_id) AS tw_rank, CASE WHEN lw = 0 THEN 0 ELSE row_number() OVER (ORDER BY lw DESC, artist_id) END AS lw_rank "
    f"FROM (SELECT *, {_plus(0, 7)} AS tw, {_plus(7, 14)} AS lw, {_plus(14, 21)} AS l2w FROM wide)) r"
)


@query(
    "accel_weekly",
    oracle(
        f"SELECT m.artist_id, tw AS tw_oda_streams, lw AS lw_oda_streams, l2w AS l2w_oda_streams, lw_rank = 0 AS is_new, CASE WHEN lw_rank <> 0 THEN lw_rank - tw_rank END AS rank_chg, "
        f"{_fin('pct')} AS pct_chg, {_fin('a3')} AS three_wk_acc, {_fin('a7')} AS seven_day_acc "
        "FROM metrics m JOIN artists a ON m.artist_id = a.artist_id WHERE a.signed IS NOT TRUE AND tw >= 50 AND ("
        "coalesce(pct >= 0.25 AND tw >= 200 AND lw >= 5, false) OR coalesce(pct >= 0.35 AND tw >= 100 AND lw >= 5, false) "
        "OR coalesce(a3 >= 0.15 AND tw >= 100 AND l2w >= 1 AND pct >= 0.15, false) OR coalesce(a7 >= 0.1 AND tw >= 100 AND d6 > 1, false) "
        "OR coalesce(a3 >= 0.2 AND tw >= 100 AND a7 > 0 AND pct >= 0.25, false) OR coalesce(tw >= 50 AND tw <= 100 AND a7 >= 0.15 AND d6 > 1, false) "
        "OR coalesce(a3 >= 0.15 AND tw >= 50 AND tw <= 100 AND a7 > 0 AND pct >= 0.4, false) OR coalesce(lw < 5 AND tw >= 100, false))",
        wide=_WEEK3,
        metrics=_A,
    ),
)
def accel_weekly(spark, folder):
    t = Tables(spark, folder)
    days = [back(AS_OF, i) for i in range(21)]
    names = [d.isoformat() for d in days]
    wide = pivot_dates(artist_streams(t), ["artist_id"], days, "streams").fillna(0)

    def total(part):
        return sum((F.col(n) for n in part[1:]), F.col(part[0]))

    wide = wide.select(
        "artist_id",
        *names[:7],
        total(names[:7]).alias("tw_oda_streams"),
        total(names[7:14]).alias("lw_oda_streams"),
        total(names[14:]).alias("l2w_oda_streams"),
    )
    wide = global_rank(wide, [F.col("tw_oda_streams").desc(), F.col("artist_id").asc()], "tw_rank")
    wide = global_rank(wide, [F.col("lw_oda_streams").desc(), F.col("artist_id").asc()], "lw_rank")
    wide = wide.withColumn("lw_rank", F.when(F.col("lw_oda_streams") == 0, 0).otherwise(F.col("lw_rank")))
    out = weekly_acceleration(wide, artist_meta(t), "artist_id", names[:7], unit=1)
    return out.select(
        "artist_id", "tw_oda_streams", "lw_oda_streams", "l2w_oda_streams", "is_new", "rank_chg",
        finite("pct_chg"), finite("three_wk_acc"), finite("seven_day_acc"),
    )
