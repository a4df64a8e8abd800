import datetime as dt
import random

from pyspark.sql import functions as F

from cadenza.operators.charts import (
    ARTIST_IN_GENRE_RULE,
    GENRE_RULE,
    assemble_chart,
    carry_absent,
    display_change,
    fan_out,
    mark_new,
    next_reentry,
    next_streaks,
    sparkline,
)
from cadenza.plans.projects import project_meta
from cadenza.plans.ranks import genre_chart_changes, rank_changes
from cadenza.plans.rollups import overlap
from cadenza.streaming.chart_state import step
from tests.conftest import rows

D = dt.date


def test_mark_new_takes_a_previous_edition_with_repeats(spark):
    now = spark.createDataFrame([("a",), ("b",)], "k string")
    before = spark.createDataFrame([("a",), ("a",)], "k string")
    assert rows(mark_new(now, before, ["k"])) == [("a", False), ("b", True)]


def test_streaks_grow_and_leavers_vanish(spark):
    counts = spark.createDataFrame([("a", 5), ("b", 4), ("c", 3)], "k string, n int")
    before = spark.createDataFrame([("a", 6), ("c", 2), ("x", 9)], "k string, streak int")
    assert rows(next_streaks(counts, before, "k", "n", "streak", size=2)) == [("a", 7), ("b", 1)]


def test_reentry_counts_up_and_resets(spark):
    ranks = spark.createDataFrame([("g", 15)], "k string, rnk int")
    day, state, seen = D(2024, 1, 1), None, []
    for i in range(9):
        state = next_reentry(ranks, state, ["k"], GENRE_RULE, day + dt.timedelta(i))
        state = spark.createDataFrame(state.collect(), state.schema)
        seen.append(state.first().should_notify)
    assert seen == [1, 2, 3, 4, 5, 6, 7, 0, 0]
    row = state.first()
    assert row.is_top_20 and row.is_top_100 and row.last_appearance_in_top_20 == D(2024, 1, 9)


def test_reentry_after_a_year_away(spark):
    rule = ARTIST_IN_GENRE_RULE
    ranks = spark.createDataFrame([("in", 5), ("recent", 5), ("outer", 40), ("out", 90)], "k string, rnk int")
    now = D(2024, 6, 1)
    before = spark.createDataFrame(
        [("in", 0, now - dt.timedelta(365), now), ("recent", 0, now - dt.timedelta(364), now), ("outer", 0, now, now - dt.timedelta(400)), ("out", 2, now, now)],
        "k string, should_notify int, last_appearance_in_top_10 date, last_appearance_in_top_50 date",
    )
    got = {r.k: r for r in next_reentry(ranks, before, ["k"], rule, now).collect()}
    assert {k: r.should_notify for k, r in got.items()} == {"in": 1, "recent": 0, "outer": 1, "out": 3}
    assert got["out"].last_appearance_in_top_50 == now and not got["out"].is_top_50


def test_streaming_step_equals_the_batch_rule(spark):
    rng = random.Random(3)
    rule, batch, state = GENRE_RULE, None, {}
    day = D(2020, 1, 1)
    for _ in range(12):
        day += dt.timedelta(rng.choice([1, 30, 200, 400]))
        ranks = {k: rng.choice([5, 50, 150]) for k in "abcd"}
        for k, r in ranks.items():
            state[k] = step(state.get(k), r, day, rule.inner, rule.outer, rule.limit)
        df = spark.createDataFrame(list(ranks.items()), "k string, rnk int")
        batch = next_reentry(df, batch, ["k"], rule, day)
        batch = spark.createDataFrame(batch.collect(), batch.schema)
    got = {r.k: (r.should_notify, r.last_appearance_in_top_20, r.last_appearance_in_top_100) for r in batch.collect()}
    assert got == state


def test_absent_keys_are_carried(spark):
    now = spark.createDataFrame([("a", 1)], "k string, n int")
    before = spark.createDataFrame([("a", 9), ("b", 2)], "k string, n int")
    assert rows(carry_absent(now, before, ["k"])) == [("a", 1), ("b", 2)]


def test_chart_assembly(spark):
    one = spark.createDataFrame([("a", "x", 1), ("a", "x", 2)], "entity_id string, chart string, pos int")
    two = spark.createDataFrame([("a", "y", 1), ("b", "y", 2)], "entity_id string, chart string, pos int")
    got = rows(assemble_chart([one, two], [F.col("pos")]), "entity_id", "chart", "pos", "chart_count")
    assert got == [("a", "x", 1, 2), ("a", "y", 1, 2), ("b", "y", 2, 1)]


def test_sparkline_is_in_date_order(spark):
    df = spark.createDataFrame([("g", D(2024, 1, 2), 5), ("g", D(2024, 1, 1), 4)], "k string, date date, s int")
    assert rows(sparkline(df, ["k"], "s")) == [("g", '[{"date":"2024-01-01","value":4},{"date":"2024-01-02","value":5}]')]


def test_fan_out_is_complete(spark):
    users = spark.range(50).withColumnRenamed("id", "u")
    items = spark.createDataFrame([("x",), ("y",)], "i string")
    got = fan_out(users, items)
    assert got.count() == 100 and got.distinct().count() == 100
    assert "CartesianProduct" not in got._jdf.queryExecution().executedPlan().toString()


def test_display_change(spark):
    df = spark.createDataFrame([(3,), (None,)], "c int")
    assert [r[0] for r in df.select(display_change(F.col("c"))).collect()] == ["3", "New"]


def test_rank_changes_zero_for_missing(spark):
    as_of = D(2024, 1, 10)
    chart = spark.createDataFrame([("a", D(2024, 1, 8), 3), ("a", D(2024, 1, 7), 9), ("b", D(2024, 1, 3), 1)], "t string, date date, rank int")
    got = rank_changes(chart, ["t"], as_of).first().asDict()
    assert got == {"t": "a", "rank": 3, "lp_rank": 9, "lp_rank_chg": 6, "lp_is_new": False, "lw_rank": 0, "lw_rank_chg": None, "lw_is_new": True}


def test_genre_change_stays_in_its_genre(spark):
    now = spark.createDataFrame([("t", "rock", 2), ("t", "pop", 5)], "id string, genre string, rank int")
    old = spark.createDataFrame([("t", "rock", 4)], "id string, genre string, rank int")
    facts = spark.createDataFrame([("t", 1)], "id string, streams int")
    assert rows(genre_chart_changes(now, old, facts, "id"), "genre", "chg", "is_new") == [("pop", None, True), ("rock", 2, False)]


def test_overlap_is_symmetric_and_bounded(spark):
    rng = random.Random(5)
    pairs = {(rng.randrange(6), rng.randrange(40)) for _ in range(120)}
    df = spark.createDataFrame(list(pairs) * 2, "t int, m int")
    got = {(r.t, r.o): (r.correlation, r.instance_count) for r in overlap(df, "t", "m", "o").collect()}
    sets = {t: {m for x, m in pairs if x == t} for t in range(6)}
    for a in sets:
        for b in sets:
            n = len(sets[a] & sets[b])
            if a != b and n:
                corr = int(100 * n / min(len(sets[a]), len(sets[b])) + 0.5)
                assert got[a, b] == (corr, n) == got[b, a]
            else:
                assert (a, b) not in got


def test_project_validity(spark):
    maps = [(s, 1, c) for c in (1, 2, 3, 4) for s in range(5)] + [(9, 2, 1), (8, 2, 4), (7, 2, 4), (6, 2, 4), (5, 2, 4), (4, 3, 4)]
    tracks = spark.createDataFrame(maps, "song_id int, artist_id int, collection_id int")
    about = [(1, "Songs", "Album"), (2, "THE BEST OF us", "Album"), (3, None, "Album"), (4, "Mixed", "Album")]
    names = spark.createDataFrame(about, "collection_id int, name string, type string")
    got = rows(project_meta(names, tracks), "collection_id", "artist_id", "track_count", "confidence", "is_valid")
    assert got == [(1, 1, 6, 0.8, True), (2, 1, 5, 1.0, False), (3, 1, 5, 1.0, False), (4, 1, 10, 0.5, False)]
