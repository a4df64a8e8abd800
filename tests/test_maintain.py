import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cadenza.operators.maintain import change_only, insert_absent, patch, replace_window, unique_delta, upsert
from cadenza.operators.moving import build_view, move_view, row_changes
from cadenza.plans.views import entity_stats, move_stats, stats_of, stats_state
from cadenza.sources.buckets import BucketedTable, insert_buckets, patch_buckets, upsert_buckets
from tests.conftest import rows

D = dt.date


def table(spark):
    return spark.createDataFrame(
        [("a", D(2024, 1, 1), 1, 1), ("a", D(2024, 1, 20), 2, 2), ("b", D(2024, 1, 20), 3, 3)],
        "k string, date date, streams int, premium int",
    )


def test_upsert_updates_listed_columns_even_with_null(spark):
    delta = spark.createDataFrame([("a", D(2024, 1, 20), None, 9), ("c", D(2024, 1, 20), 5, 6)], "k string, date date, streams int, premium int")
    got = rows(upsert(table(spark), delta, ["k", "date"], ["streams"]))
    assert ("a", D(2024, 1, 20), None, 2) in got and ("c", D(2024, 1, 20), 5, 6) in got and len(got) == 4


def test_upsert_is_idempotent(spark):
    delta = spark.createDataFrame([("a", D(2024, 1, 20), 7, 8)], "k string, date date, streams int, premium int")
    once = upsert(table(spark), delta, ["k", "date"])
    assert rows(upsert(once, delta, ["k", "date"])) == rows(once)


def test_on_update_touches_only_updated_rows(spark):
    current = spark.createDataFrame([("a", "x", True), ("b", "y", True)], "k string, name string, is_global boolean")
    delta = spark.createDataFrame([("a", "z"), ("c", "w")], "k string, name string")
    got = rows(upsert(current, delta, ["k"], on_update={"is_global": F.lit(False)}))
    assert got == [("a", "z", False), ("b", "y", True), ("c", "w", None)]


def test_repeated_delta_key_is_an_error_or_newest_wins(spark):
    delta = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "k string, v int, file int")
    with pytest.raises(Exception, match="repeated key"):
        unique_delta(delta, ["k"]).collect()
    assert rows(unique_delta(delta, ["k"], [F.col("file").desc()]), "v") == [(2,)]


def test_insert_absent(spark):
    delta = spark.createDataFrame([("a", D(2024, 1, 20), 9, 9), ("z", D(2024, 1, 1), 2, 2), ("z", D(2024, 1, 1), 1, 1)], "k string, date date, streams int, premium int")
    got = rows(insert_absent(table(spark), delta, ["k", "date"], [F.col("streams")]))
    assert len(got) == 4 and ("z", D(2024, 1, 1), 1, 1) in got and ("a", D(2024, 1, 20), 2, 2) in got


def test_change_only(spark):
    delta = spark.createDataFrame(
        [("a", D(2024, 1, 20), 2, 99), ("b", D(2024, 1, 20), 4, 3), ("c", D(2024, 1, 21), 1, 1)],
        "k string, date date, streams int, premium int",
    )
    since = D(2024, 1, 5)
    only = change_only(table(spark), delta, ["k", "date"], ["streams"], since)
    assert rows(only.counts()) == [("inserts", 1), ("updates", 1)]
    both = change_only(table(spark), delta, ["k", "date"], ["streams", "premium"], since)
    assert rows(both.counts()) == [("inserts", 1), ("updates", 2)]
    after = both.apply(table(spark))
    assert ("a", D(2024, 1, 1), 1, 1) in rows(after) and ("a", D(2024, 1, 20), 2, 99) in rows(after)
    again = change_only(after, delta, ["k", "date"], ["streams", "premium"], since)
    assert rows(again.counts()) == [("inserts", 0), ("updates", 0)]


def test_delta_older_than_the_look_back_is_an_error(spark):
    delta = spark.createDataFrame([("a", D(2024, 1, 1), 5, 5)], "k string, date date, streams int, premium int")
    with pytest.raises(Exception, match="before the look-back"):
        change_only(table(spark), delta, ["k", "date"], ["streams"], D(2024, 1, 5)).counts().collect()


def test_null_and_value_differ(spark):
    current = spark.createDataFrame([("a", None)], "k string, v int")
    delta = spark.createDataFrame([("a", 0)], "k string, v int")
    assert rows(change_only(current, delta, ["k"], ["v"]).counts()) == [("inserts", 0), ("updates", 1)]
    assert rows(change_only(current, current, ["k"], ["v"]).counts()) == [("inserts", 0), ("updates", 0)]


def test_replace_window(spark):
    fresh = spark.createDataFrame([("q", D(2024, 1, 20), 1, 1), ("q", D(2024, 1, 2), 1, 1)], "k string, date date, streams int, premium int")
    got = rows(replace_window(table(spark), fresh, D(2024, 1, 10)), "k", "date")
    assert got == [("a", D(2024, 1, 1)), ("q", D(2024, 1, 20))]


def test_patch_with_and_without_nulls(spark):
    current = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    delta = spark.createDataFrame([("a", None), ("c", "z")], "k string, v string")
    assert rows(patch(current, delta, ["k"], ["v"])) == [("a", None), ("b", "y")]
    assert rows(patch(current, delta, ["k"], ["v"], keep_on_null=True)) == [("a", "x"), ("b", "y")]


def test_only_the_given_part_is_joined(spark, tmp_path):
    days = [D(2024, 1, d) for d in (1, 2, 3)]
    stored = [(k, d, k) for k in (1, 2) for d in days]
    path = str(tmp_path / "t")
    spark.createDataFrame(stored, "id int, date date, v int").write.partitionBy("date").parquet(path)
    current = spark.read.parquet(path).select("id", "date", "v")
    delta = spark.createDataFrame([(1, days[2], 9), (3, days[2], 7)], "id int, date date, v int")
    late = F.col("date") > F.lit(days[1])
    out = upsert(current, delta, ["id", "date"], among=late)
    assert rows(out) == sorted([r for r in stored if r != (1, days[2], 1)] + [(1, days[2], 9), (3, days[2], 7)], key=str)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    passing = plan.split("Union")[1].split("FileScan")[0]
    assert "Exchange" not in passing and "Join" not in passing
    assert plan.count("PartitionFilters: [") == 2 and "PartitionFilters: []" not in plan
    assert plan.count("Exchange hashpartitioning") == 2
    patched = patch(current, delta.select("id", "date", "v"), ["id", "date"], ["v"], among=late)
    assert rows(patched) == sorted([r for r in stored if r != (1, days[2], 1)] + [(1, days[2], 9)], key=str)
    with pytest.raises(Exception, match="outside of the given part"):
        upsert(current, delta.withColumn("date", F.lit(days[0])), ["id", "date"], among=late).collect()


def kept(spark, tmp_path, rows, by=("k",), buckets=16, name="t"):
    df = spark.createDataFrame(rows, "k int, v int, w string")
    return BucketedTable(str(tmp_path / name), by, buckets).write(df)


def test_bucketed_merge_is_an_upsert(spark, tmp_path):
    held = [(i, i, "old") for i in range(300)] + [(None, 1, "old")]
    table = kept(spark, tmp_path, held)
    delta = spark.createDataFrame([(3, -3), (4, None), (1000, 7)], "k int, v int")
    merge = upsert_buckets(table, delta, ["k"])
    want = rows(upsert(spark.createDataFrame(held, "k int, v int, w string"), delta, ["k"]))
    assert rows(merge.rows()) == want and 1 <= len(merge.buckets) <= 3
    merge.apply()
    assert rows(table.read(spark).drop("bucket")) == want
    upsert_buckets(table, delta, ["k"]).apply()  # the same delta once more
    assert rows(table.read(spark).drop("bucket")) == want
    patched = patch_buckets(table, spark.createDataFrame([(5, "new"), (2000, "new")], "k int, w string"), ["k"], ["w"])
    assert [r for r in rows(patched.rows()) if r[2] == "new"] == [(5, 5, "new")] and patched.rows().count() == len(want)
    more = insert_buckets(table, spark.createDataFrame([(5, 0, "x"), (2001, 0, "x")], "k int, v int, w string"), ["k"], [F.col("v")])
    assert [r for r in rows(more.rows()) if r[2] == "x"] == [(2001, 0, "x")]


def test_untouched_buckets_are_neither_shuffled_nor_written(spark, tmp_path):
    table = kept(spark, tmp_path, [(i, i, "old") for i in range(300)])
    merge = upsert_buckets(table, spark.createDataFrame([(3, -3)], "k int, v int"), ["k"])
    plan = merge.untouched._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and f"NOT (bucket#" in plan.split("PartitionFilters")[1] and merge.buckets == table.touched(spark.createDataFrame([(3,)], "k int"))
    changed = merge.changed._jdf.queryExecution().executedPlan().toString()
    assert f"= {merge.buckets[0]})" in changed.split("PartitionFilters")[1]
    def files():
        return {str(p) for p in (tmp_path / "t").rglob("*.parquet")}
    before = files()
    merge.apply()
    gone = before - files()
    assert gone and all(f"bucket={merge.buckets[0]}/" in f for f in gone)


def test_buckets_must_follow_the_key(spark, tmp_path):
    table = kept(spark, tmp_path, [(1, 1, "a")], by=("w",))
    with pytest.raises(ValueError):
        upsert_buckets(table, spark.createDataFrame([(1, 2)], "k int, v int"), ["k"])


def test_a_moved_view_is_the_view_computed_again(spark):
    rng = random.Random(6)
    schema = "k int, g string, date int, v int"

    def some(n):
        return {k: (rng.choice(["a", "b", "c", None]), rng.randrange(10), rng.choice([None, *range(-5, 9)])) for k in rng.sample(range(60), n)}

    def frame(state):
        return spark.createDataFrame([(k, *r) for k, r in state.items()], schema)

    sums = {"total": F.col("v"), "late": F.when(F.col("date") > 4, F.col("v"))}
    state = some(40)
    view = build_view(frame(state), ["g"], sums)
    for _ in range(3):
        new = {k: r for k, r in state.items() if rng.random() > 0.2} | some(12)
        changes = row_changes(frame(state), frame(new), ["k"])
        assert changes.count() == sum((k in state) + (k in new) for k in {*state, *new} if state.get(k) != new.get(k))
        view = spark.createDataFrame(move_view(view, changes, ["g"], sums).collect(), view.schema)
        assert rows(view) == rows(build_view(frame(new), ["g"], sums))
        state = new
    gone = move_view(view, row_changes(frame(state), frame(state).filter("false"), ["k"]), ["g"], sums)
    assert gone.count() == 0
    with pytest.raises(ValueError):
        move_view(view.withColumn("total", F.col("total") / 2), changes, ["g"], sums)


def test_moved_stats(spark):
    rng = random.Random(8)
    start = dt.date(2024, 1, 1)
    days = [start + dt.timedelta(k) for k in range(40)]
    table = {(a, d): rng.randrange(1, 50) for a in range(8) for d in days if rng.random() < 0.5 and not (a == 7 and d > days[15])}

    def frame(state):
        return spark.createDataFrame([(a, d, n) for (a, d), n in state.items()], "artist_id int, date date, streams bigint")

    was = days[20]
    state = stats_state(frame(table), "artist_id", was)
    for as_of in (days[20], days[23], days[33], days[39]):
        fresh = {k: n for k, n in table.items() if rng.random() > 0.1} | {(a, rng.choice(days)): 1 for a in range(9)}
        state = move_stats(state, frame(table), frame(fresh), "artist_id", was, as_of)
        state = spark.createDataFrame(state.collect(), state.schema)
        assert rows(stats_of(state, "artist_id")) == rows(entity_stats(frame(fresh), "artist_id", as_of))
        table, was = fresh, as_of
