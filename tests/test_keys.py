import random

from pyspark.sql import functions as F

from cadenza.operators.keys import (
    assign_ids,
    first_per_key,
    global_rank,
    large_groups,
    mode_per_key,
    not_in,
    rank_per_key,
    top_per_key,
    with_fallback,
)
from tests.conftest import rows


def test_first_in_file_order_not_any(spark):
    df = spark.createDataFrame([("a", 3, "late"), ("a", 1, "first"), ("b", 2, "only")], "k string, n int, v string")
    assert rows(first_per_key(df, ["k"], [F.col("n")]), "k", "v") == [("a", "first"), ("b", "only")]


def test_first_per_key_prunes_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 3)
    plan = first_per_key(df, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_top_puts_nulls_last_and_breaks_ties(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 5, 3), ("a", 5, 2), ("b", None, 9)], "k string, m int, id int")
    assert rows(top_per_key(df, ["k"], "m", "id"), "k", "id") == [("a", 2), ("b", 9)]


def test_ranks_with_a_hot_key(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.5 else f"k{rng.randrange(20)}", rng.randrange(30), i) for i in range(3000)]
    df = spark.createDataFrame(data, "k string, m int, id int").repartition(6)
    order = [F.col("m").desc(), F.col("id").asc()]
    want = {}
    for k in {d[0] for d in data}:
        for n, d in enumerate(sorted((d for d in data if d[0] == k), key=lambda d: (-d[1], d[2])), 1):
            want[d[2]] = n
    got = {r.id: r.r for r in rank_per_key(df, ["k"], order, "r").collect()}
    assert got == want
    ranked = sorted(data, key=lambda d: (-d[1], d[2]))
    got = {r.id: r.r for r in global_rank(df, order, "r").collect()}
    assert got == {d[2]: n for n, d in enumerate(ranked, 1)}


def test_rank_per_key_takes_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, id int")
    assert rows(rank_per_key(df, ["k"], [F.col("id")], "r"), "id", "r") == [(1, 1), (2, 2), (3, 1)]


def test_mode_ignores_nulls_and_takes_the_smallest_on_ties(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", None), ("a", None), ("a", None)], "k string, v string")
    assert rows(mode_per_key(df, ["k"], "v"), "k", "v", "n") == [("a", "x", 1)]


def test_not_in_is_not_fooled_by_null(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    other = spark.createDataFrame([(1,), (None,)], "k int")
    assert rows(not_in(df, other, ["k"])) == [(2,)]


def test_large_groups(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "k string, n int")
    assert rows(large_groups(df, ["k"], 1)) == [("a", 1), ("a", 2)]


def test_fallback_only_for_unmatched(spark):
    wanted = spark.createDataFrame([("a",), ("b",), ("a",)], "k string")
    primary = spark.createDataFrame([("a", 1, 10)], "k string, v int, w int")
    second = spark.createDataFrame([("a", 9), ("b", 2)], "k string, v int")
    assert rows(with_fallback(wanted, primary, second, ["k"])) == [("a", 1, 10), ("b", 2, None)]


def test_assign_ids_continues(spark):
    known = spark.createDataFrame([("a", 7)], "k string, id bigint")
    new = spark.createDataFrame([("c",), ("b",), ("a",), ("b",)], "k string")
    assert rows(assign_ids(known, new, "k", "id")) == [("a", 7), ("b", 8), ("c", 9)]
    empty = spark.createDataFrame([], "k string, id bigint")
    assert rows(assign_ids(empty, new, "k", "id")) == [("a", 1), ("b", 2), ("c", 3)]
