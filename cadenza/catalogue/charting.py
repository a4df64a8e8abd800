"""Charts with state, chart assembly, notifications, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.catalogue.domain import AS_OF, Tables, artist_stats, profiles
from cadenza.catalogue.registry import oracle, query
from cadenza.catalogue.territories import _GSUM, _TWO, _daily, genre_charts
from cadenza.functions.dates import back
from cadenza.operators.charts import assemble_chart, display_change, fan_out, mark_new, next_streaks
from cadenza.plans.genres import entity_genres, genre_sparklines, genre_stats
from cadenza.plans.ranks import new_first
from cadenza.plans.views import reports_recent

_DAY = "CAST(ts AS DATE)"


def _entries(t: Tables):
    return t.events.select(
        F.col("event_id"), F.col("event_type").alias("type"), F.date_format("ts", "dd").alias("chart"), F.col("user_id").alias("entity_id")
    )


@query(
    "chart_is_new",
    oracle(
        f"SELECT user_id AS entity_id, n, user_id NOT IN (SELECT user_id FROM events WHERE {_DAY} = DATE '2024-01-29') AS is_new "
        f"FROM (SELECT user_id, count(*) AS n FROM events WHERE {_DAY} = DATE '2024-01-30' GROUP BY 1)"
    ),
)
def chart_is_new(spark, folder):
    """Accounts of one day, flagged when absent the day before (whose keys repeat)."""
    t = Tables(spark, folder)
    day = F.to_date("ts")
    today = t.events.filter(day == F.lit("2024-01-30").cast("date")).groupBy(F.col("user_id").alias("entity_id")).agg(F.count(F.lit(1)).alias("n"))
    before = t.events.filter(day == F.lit("2024-01-29").cast("date")).select(F.col("user_id").alias("entity_id"))
    return mark_new(today, before, ["entity_id"])


def chart_kinds(t: Tables):
    """Two kinds of charts whose rows have the same columns."""
    rows, first = _entries(t), F.col("type").isin("click", "view")
    return [rows.filter(first), rows.filter(~first)]


_UNIQUE = "SELECT user_id AS entity_id, strftime(ts, '%d') AS chart, min(event_type) AS type FROM events GROUP BY 1, 2"


@query(
    "chart_count",
    oracle("SELECT u.entity_id, u.chart, u.type, c.chart_count FROM u JOIN (SELECT entity_id, count(*) AS chart_count FROM u GROUP BY 1) c ON c.entity_id = u.entity_id", u=_UNIQUE),
)
def chart_count(spark, folder):
    """One row per account and chart, whatever the number of events, with the number of charts."""
    return assemble_chart(chart_kinds(Tables(spark, folder)), [F.col("type").asc(), F.col("event_id").asc()]).select("entity_id", "chart", "type", "chart_count")


_COUNT = "SELECT event_type AS type, user_id AS entity_id, count(DISTINCT strftime(ts, '%d')) AS chart_count FROM events GROUP BY 1, 2"


@query(
    "chart_streak",
    oracle(
        "SELECT k.entity_id, coalesce(p.n, 0) + 1 AS streak FROM (SELECT entity_id FROM c WHERE type = 'purchase' ORDER BY chart_count DESC, entity_id LIMIT 200) k "
        "LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) p ON p.user_id = k.entity_id",
        c=_COUNT,
    ),
)
def chart_streak(spark, folder):
    """The leading 200 accounts of one kind with their stored streak one longer."""
    t = Tables(spark, folder)
    rows = _entries(t).filter(F.col("type") == "purchase").select("entity_id", "chart").distinct()
    counts = rows.groupBy("entity_id").agg(F.count(F.lit(1)).alias("chart_count"))
    stored = _entries(t).filter(F.col("type") == "error").groupBy("entity_id").agg(F.count(F.lit(1)).alias("streak"))
    return next_streaks(counts, stored, "entity_id", "chart_count", "streak")


_FLAGGED = "SELECT genre FROM chart_b WHERE should_notify > 0"


@query(
    "notify_fanout",
    oracle(
        "SELECT c.c_custkey AS user_id, 'new_genre_ltg' AS n_type, f.genre, s.tw_streams, k.sparkline FROM customer c CROSS JOIN flagged f "
        "LEFT JOIN gsum s ON s.genre = f.genre LEFT JOIN spark k ON k.genre = f.genre",
        gsum=_GSUM, **_TWO, flagged=_FLAGGED,
        spark=(
            "SELECT genre, '[' || string_agg('{\"date\":\"' || CAST(date AS VARCHAR) || '\",\"value\":' || CAST(streams AS VARCHAR) || '}', ',' ORDER BY date) || ']' AS sparkline "
            f"FROM daily WHERE date > DATE '{back(AS_OF, 7)}' AND date <= DATE '{AS_OF}' GROUP BY 1"
        ),
    ),
)
def notify_fanout(spark, folder):
    """Every user (customer) is told about every flagged genre."""
    t = Tables(spark, folder)
    flagged = genre_charts(t).filter(F.col("should_notify") > 0).select("genre")
    stats = genre_stats(entity_genres(profiles(t)), artist_stats(t)).select("genre", "tw_streams")
    lines = genre_sparklines(_daily(t, 30), AS_OF, 7)
    items = flagged.join(stats, "genre", "left").join(lines, "genre", "left").withColumn("n_type", F.lit("new_genre_ltg"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"))
    return fan_out(users, items).select("user_id", "n_type", "genre", "tw_streams", "sparkline")


@query(
    "notify_json",
    oracle(
        "SELECT genre, '{\"genre\":\"' || genre || '\",\"tw_streams\":' || CAST(tw_streams AS VARCHAR) || '}' AS meta FROM gsum",
        gsum=_GSUM,
    ),
)
def notify_json(spark, folder):
    """The message body of a notification."""
    t = Tables(spark, folder)
    stats = genre_stats(entity_genres(profiles(t)), artist_stats(t))
    return stats.select("genre", F.to_json(F.struct("genre", "tw_streams")).alias("meta"))


@query(
    "reports_recent",
    oracle(f"SELECT song_id, streams FROM song_streams WHERE date = DATE '{AS_OF}'"),
)
def reports_recent_query(spark, folder):
    t = Tables(spark, folder)
    rows = t.lineitem.select(F.col("l_partkey").alias("song_id"), F.to_date("l_shipdate").alias("report_date"), F.col("l_quantity").cast("bigint").alias("q"))
    return reports_recent(rows, AS_OF).groupBy("song_id").agg(F.sum("q").alias("streams"))


@query(
    "rank_display",
    oracle(
        "SELECT a.user_id AS entity_id, coalesce(CAST(b.n - a.n AS VARCHAR), 'New') AS chg FROM (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1) a "
        "LEFT JOIN (SELECT user_id, count(*) AS n FROM events WHERE event_type = 'error' AND value > 20 GROUP BY 1) b ON b.user_id = a.user_id"
    ),
)
def rank_display(spark, folder):
    """A change as text, ``New`` where there is nothing to compare with."""
    t = Tables(spark, folder)

    def counts(where, name):
        return t.events.filter(where).groupBy(F.col("user_id").alias("entity_id")).agg(F.count(F.lit(1)).alias(name))

    now = counts(F.col("event_type") == "click", "now")
    old = counts((F.col("event_type") == "error") & (F.col("value") > 20), "old")
    out = now.join(old, "entity_id", "left").withColumn("rnk_chg", F.col("old") - F.col("now"))
    return new_first(out, "entity_id").select("entity_id", display_change(F.col("rnk_chg")).alias("chg"))
