import datetime as dt
import math

from pyspark.sql import functions as F

from cadenza.functions.dates import (
    aligned_week,
    back,
    chart_week,
    complete_date,
    date_headers,
    parse_date,
    year_week_start,
)
from cadenza.functions.numeric import (
    acceleration,
    clamp,
    exact_percent,
    fraction_or_zero,
    id_text,
    not_true,
    percent_or_zero,
    present,
    safe_ratio,
)
from tests.conftest import rows


def test_safe_ratio_zero_rules(spark):
    df = spark.createDataFrame([(6.0, 3.0), (5.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, None)], "a double, b double")
    got = [r[0] for r in df.select(safe_ratio("a", "b")).collect()]
    assert got[0] == 2.0 and math.isinf(got[1]) and got[2:] == [None, None, None]
    assert df.filter(safe_ratio("a", "b") >= 0.15).count() == 2


def test_acceleration(spark):
    df = spark.createDataFrame([(64, 1)], "a int, b int")
    assert df.select(acceleration("a", "b", 6)).first()[0] == 1.0


def test_percent_rounds_half_away_from_zero(spark):
    df = spark.createDataFrame([(1009, 800), (591, 800), (5, 0), (None, 3)], "a int, b int")
    got = [r[0] for r in df.select(exact_percent("a", "b").cast("string")).collect()]
    assert got == ["26.13", "-26.13", None, None]
    assert [r[0] for r in df.select(percent_or_zero("a", "b")).collect()] == [26.13, -26.13, 0.0, None]
    assert df.select(fraction_or_zero("a", "b")).first()[0] == 0.26


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-80.0,), (80.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in df.select(clamp("x", -50, 50)).collect()] == [-50, 50, 3, None]


def test_id_text_does_not_eat_zeros(spark):
    df = spark.createDataFrame([("1050.0",), ("1050",), ("10.0",), ("A10.0",), (None,)], "x string")
    assert [r[0] for r in df.select(id_text("x")).collect()] == ["1050", "1050", "10", "A10.0", None]


def test_three_valued_tests(spark):
    df = spark.createDataFrame([(True, ""), (False, None), (None, "x")], "f boolean, s string")
    assert [r[0] for r in df.select(not_true("f")).collect()] == [False, True, True]
    assert [r[0] for r in df.select(present("s")).collect()] == [False, False, True]


def test_aligned_weeks_cover_nine_full_buckets_on_every_weekday(spark):
    for shift in range(7):
        as_of = dt.date(2024, 3, 11) + dt.timedelta(shift)
        days = spark.createDataFrame([(back(as_of, i),) for i in range(1, 64)], "d date")
        buckets = days.groupBy(aligned_week(F.col("d"), as_of).alias("w")).agg(F.count("*").alias("n"), F.max("d").alias("last"))
        got = rows(buckets, "n", "last")
        assert len(got) == 9 and {n for n, _ in got} == {7}
        assert max(last for _, last in got) == back(as_of, 1)


def test_year_week_matches_first_monday_rule(spark):
    names, want = [], []
    for year in range(2015, 2031):
        first = dt.date(year, 1, 1)
        while first.weekday() != 0:
            first += dt.timedelta(1)
        for week in (1, 9, 52):
            names.append((f"{year}{week:02d}",))
            want.append(first + dt.timedelta(weeks=week - 1))
    got = [r[0] for r in spark.createDataFrame(names, "s string").select(year_week_start(F.col("s"))).collect()]
    assert got == want


def test_dates_in_text(spark):
    df = spark.createDataFrame([("02/03/2024",), ("2024-02-03",), ("soon",), (None,)], "s string")
    day = dt.date(2024, 2, 3)
    assert [r[0] for r in df.select(parse_date(F.col("s"))).collect()] == [day, day, None, None]
    df = spark.createDataFrame([("1999",), ("1999-05",), ("1999-05-07",), ("0000",), ("0000-01-01",)], "s string")
    got = [r[0] for r in df.select(complete_date(F.col("s"))).collect()]
    assert got == ["1999-01-01", "1999-05-01", "1999-05-07", "2000-01-01", "2000-01-01"]


def test_chart_week_ends_on_thursday():
    for shift in range(7):
        week = chart_week(dt.date(2024, 3, 11) + dt.timedelta(shift))
        assert week[0].weekday() == 3 and len(week) == 7 and week[0] - week[6] == dt.timedelta(6)


def test_date_headers():
    assert date_headers(["Artist", "03/01/2024", "2024-03-01", "TW Rank"]) == ["03/01/2024", "2024-03-01"]
