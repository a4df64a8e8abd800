import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from cadenza.operators.binned import above, build_model, fit_model, lookup_bin
from cadenza.operators.reshape import attributes_to_columns, melt_columns, melt_dates, melt_series, pivot_dates, unpack
from cadenza.operators.timegrid import densify, snapshots, streaks, week_gain, weekly_sums
from tests.conftest import rows

D = dt.date


def test_melt_and_pivot_are_inverse(spark):
    days = [D(2024, 1, 3), D(2024, 1, 2)]
    wide = spark.createDataFrame([("a", "5", None), ("b", None, "7")], "k string, `01/03/2024` string, `01/02/2024` string")
    names = {days[0]: "01/03/2024", days[1]: "01/02/2024"}
    long = melt_dates(wide, ["k"], names, "streams")
    assert rows(long) == [("a", days[1], 0), ("a", days[0], 5), ("b", days[1], 7), ("b", days[0], 0)]
    back = pivot_dates(long, ["k"], days, "streams")
    assert back.columns == ["k", "2024-01-03", "2024-01-02"]
    assert rows(back) == [("a", 5, 0), ("b", 0, 7)]


def test_melt_series_in_one_pass(spark):
    wide = spark.createDataFrame([("a", 1, 2, 3, 4)], "k string, t1 int, t2 int, p1 int, p2 int")
    d1, d2 = D(2024, 1, 1), D(2024, 1, 2)
    long = melt_series(wide, ["k"], {"total": {d1: "t1", d2: "t2"}, "premium": {d1: "p1", d2: "p2"}})
    assert rows(long) == [("a", d1, 1, 3), ("a", d2, 2, 4)]


def test_territory_columns(spark):
    wide = spark.createDataFrame([("a", 1, None)], "k string, japan int, korea int")
    assert rows(melt_columns(wide, ["k"], ["japan", "korea"], "territory", "streams")) == [("a", "japan", 1), ("a", "korea", 0)]


def test_attributes_take_one_row_per_key(spark):
    df = spark.createDataFrame([(1, 2, "b"), (1, 2, "a"), (1, 3, "y"), (2, 9, "q")], "t int, kind int, v string")
    assert rows(attributes_to_columns(df, ["t"], "kind", "v", {2: "photo", 3: "video"})) == [(1, "a", "y"), (2, None, None)]


def test_unpack(spark):
    df = spark.createDataFrame([("a", "x/y"), ("b", ""), ("c", None)], "k string, g string")
    assert rows(unpack(df, "g", "genre"), "k", "genre") == [("a", "x"), ("a", "y")]


def test_densify_fills_gaps_and_keeps_observed_points(spark):
    df = spark.createDataFrame(
        [("a", D(2024, 1, 1), 10), ("a", D(2024, 1, 5), 18), ("a", D(2024, 1, 6), 0), ("b", D(2024, 1, 9), 7)],
        "k string, date date, v int",
    )
    got = rows(densify(df, "k", "v"))
    assert got == [
        ("a", D(2024, 1, 1), 10.0), ("a", D(2024, 1, 2), 12.0), ("a", D(2024, 1, 3), 14.0), ("a", D(2024, 1, 4), 16.0),
        ("a", D(2024, 1, 5), 18.0), ("a", D(2024, 1, 6), 0.0), ("b", D(2024, 1, 9), 7.0),
    ]


def test_week_gain_needs_the_earlier_day(spark):
    data = [("a", D(2024, 1, 1), 10), ("a", D(2024, 1, 9), 18), ("b", D(2024, 1, 5), 1), ("b", D(2024, 1, 9), 2)]
    df = densify(spark.createDataFrame(data, "k string, date date, v int"), "k", "v")
    assert rows(week_gain(df, "k", "v", "gain")) == [("a", D(2024, 1, 9), 18.0, 7.0)]


def test_streaks_compare_with_the_previous_present_week(spark):
    weeks = [D(2024, 1, 1) + dt.timedelta(7 * i) for i in (0, 1, 3, 4)]
    df = spark.createDataFrame([("a", w, s) for w, s in zip(weeks, (100, 110, 330, 0))], "k string, week date, s bigint")
    got = rows(streaks(df, ["k"], "s"))
    assert got == [("a", 2, 10.0)]
    assert rows(streaks(df, ["k"], "s", first_counts=True), "num_positive_weeks") == [(3,)]


def test_streaks_zero_base_adds_nothing(spark):
    df = spark.createDataFrame([("a", D(2024, 1, 1), 0), ("a", D(2024, 1, 8), 50)], "k string, week date, s bigint")
    assert rows(streaks(df, ["k"], "s")) == [("a", 1, 0.0)]


def test_the_as_of_day_is_outside_the_growth_window(spark):
    as_of = D(2024, 3, 10)
    df = spark.createDataFrame([("a", as_of, 5), ("a", as_of - dt.timedelta(64), 5), ("a", as_of - dt.timedelta(1), 7)], "k string, date date, s bigint")
    assert rows(weekly_sums(df, ["k"], "s", as_of, 64), "s") == [(7,)]


def test_snapshots(spark):
    as_of = D(2024, 1, 10)
    df = spark.createDataFrame([("a", D(2024, 1, 7), 5), ("a", D(2023, 12, 31), 2), ("b", D(2024, 1, 7), 1)], "k string, date date, v int")
    assert rows(snapshots(df, ["k"], ["v"], {"tw": 3, "lw": 10}, as_of)) == [("a", 5, 2), ("b", 1, None)]


MODEL = [(3, 1.0, 2.0, 0.0, 10.0), (3, 5.0, 0.0, 10.0, 20.0), (3, 7.0, 1.0, 20.0, 100.0)]


def model(spark):
    return spark.createDataFrame(MODEL, "count int, mean double, std double, bin_min double, bin_max double")


def test_fit_bin_edges(spark):
    xs = [-1.0, 0.0, 0.5, 10.0, 10.5, 20.0, 20.5, 1000.0, 5e9, None]
    df = spark.createDataFrame([(x, 9.0) for x in xs], "x double, gain double")
    got = {r.x: (r.mean, r.z_score) for r in fit_model(df, model(spark), "x", "gain").collect()}
    assert got[-1.0] == (None, None) and got[0.0] == (None, None) and got[None] == (None, None)
    assert got[0.5] == (1.0, 4.0) and got[10.0] == (1.0, 4.0)
    assert got[10.5] == (5.0, None)
    assert got[20.0] == (7.0, 2.0) and got[1000.0] == (7.0, 2.0) and got[5e9] == (7.0, 2.0)


def test_lookup_is_closed_below(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (99.0,), (100.0,), (-1.0,)], "x double")
    got = {r.x: r.mean for r in lookup_bin(df, model(spark), "x").collect()}
    assert got == {0.0: 1.0, 10.0: 5.0, 99.0: 7.0, 100.0: 7.0, -1.0: None}


def test_build_model(spark):
    df = spark.createDataFrame([(5.0, 1.0), (10.0, 3.0), (11.0, 4.0), (0.0, 99.0), (30.0, 99.0)], "x double, g double")
    got = rows(build_model(df, "x", "g", [0, 10, 20]).withColumn("std", F.round("std", 6)))
    assert got == [(1, 4.0, None, 10.0, 20.0), (2, 2.0, 1.414214, 0.0, 10.0)]


def test_above_needs_a_bin(spark):
    df = spark.createDataFrame([(10.0, 1.0, 2.0), (5.0, 1.0, 2.0), (9.0, None, None)], "g double, mean double, std double")
    assert rows(above(df, "g", 2.0), "g") == [(10.0,)]


def test_previous_row_in_segments(spark):
    """The same as a window over the whole series, also where one key holds most rows."""
    import random

    from cadenza.operators.segments import _SEGMENT, previous_row, segmented

    rng = random.Random(3)
    data = [("hot", d, rng.choice([None, *range(9)]), d) for d in range(900)] + [(k, d, rng.randrange(9), d) for k in ["a", "b", None] for d in rng.sample(range(90), 40)]
    data += [("a", None, 5, None), ("one", 3, 4, 3)]
    df = spark.createDataFrame(data, "k string, d int, v int, w int").repartition(5)
    w = Window.partitionBy("k").orderBy(F.col("d").asc_nulls_first())
    want = df.withColumns({"prev_v": F.lag("v").over(w), "prev_w": F.lag("w").over(w)})
    assert rows(previous_row(df, ["k"], "d", ["v", "w"])) == rows(want)
    held = [r["count"] for r in segmented(df, ["k"], "d").groupBy(_SEGMENT).count().collect()]
    assert len(held) >= 3 and max(held) < 0.5 * len(data)
    assert previous_row(df.filter("false"), ["k"], "d", ["v"]).count() == 0
