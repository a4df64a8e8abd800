import datetime as dt
import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.operators.charts import GENRE_RULE
from cadenza.streaming.chart_state import reentry_stream
from cadenza.streaming.feeds import apply_batch, upsert_stream, watch_feed
from tests.conftest import rows

D = dt.date
SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "date", "streams")])


def drop_file(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("id\tdate\tstreams\n" + "".join("\t".join(map(str, x)) + "\n" for x in lines), encoding="utf-16")


def test_feed_folder_to_table(spark, tmp_path):
    folder, table, ckpt = tmp_path / "in", str(tmp_path / "table"), str(tmp_path / "ckpt")

    def run():
        feed = watch_feed(spark, str(folder), SCHEMA).select(
            F.col("id").cast("int").alias("id"), F.to_date("date").alias("date"), F.col("streams").cast("bigint").alias("streams"), "filename"
        )
        upsert_stream(feed, table, ckpt, ["id", "date"], ["streams"], [F.col("filename").desc()]).awaitTermination()
        return rows(spark.read.schema("id int, streams bigint, date date").parquet(table), "id", "date", "streams")

    drop_file(folder, "a_20240101.tsv", [(1, "2024-01-01", 5), (2, "2024-01-01", 6), (1, "2024-01-02", 7)])
    assert run() == [(1, D(2024, 1, 1), 5), (1, D(2024, 1, 2), 7), (2, D(2024, 1, 1), 6)]
    assert run() == [(1, D(2024, 1, 1), 5), (1, D(2024, 1, 2), 7), (2, D(2024, 1, 1), 6)]
    drop_file(folder, "b_20240102.tsv", [(1, "2024-01-02", 8), (3, "2024-01-02", 9)])
    drop_file(folder, "c_20240103.tsv", [(1, "2024-01-02", 10)])
    assert run() == [(1, D(2024, 1, 1), 5), (1, D(2024, 1, 2), 10), (2, D(2024, 1, 1), 6), (3, D(2024, 1, 2), 9)]


def test_a_batch_keeps_columns_it_does_not_have(spark, tmp_path):
    table = str(tmp_path / "table")
    full = "id int, streams bigint, premium bigint, date date"
    days = D(2024, 1, 1), D(2024, 1, 2)
    spark.createDataFrame([(1, 5, 50, days[0]), (2, 6, 60, days[0]), (1, 7, 70, days[1])], full).write.partitionBy("date").parquet(table)
    delta = spark.createDataFrame([(1, 9, days[0]), (3, 4, days[0])], "id int, streams bigint, date date")
    for counts in ([("inserts", 1), ("updates", 1)], [("inserts", 0), ("updates", 0)]):
        assert rows(apply_batch(delta, table, ["id", "date"], ["streams"], [F.col("streams").desc()])) == counts
        got = rows(spark.read.parquet(table), "id", "streams", "premium", "date")
        assert got == [(1, 7, 70, days[1]), (1, 9, 50, days[0]), (2, 6, 60, days[0]), (3, 4, None, days[0])]


def test_reentry_as_a_stream(spark, tmp_path):
    folder, ckpt = tmp_path / "ranks", str(tmp_path / "ckpt")
    folder.mkdir()
    got = []

    def run():
        ranks = spark.readStream.schema("k string, as_of date, rnk int").json(str(folder))
        out = reentry_stream(ranks, "k", GENRE_RULE)

        def keep(df, _):
            got.extend(tuple(r) for r in df.select("k", "as_of", "should_notify").collect())

        out.writeStream.foreachBatch(keep).option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start().awaitTermination()

    def edition(name, lines):
        (folder / name).write_text("\n".join(json.dumps(x) for x in lines))

    edition("1.json", [{"k": "g", "as_of": "2024-01-02", "rnk": 9}, {"k": "g", "as_of": "2024-01-01", "rnk": 9}, {"k": "h", "as_of": "2024-01-01", "rnk": 500}])
    run()
    edition("2.json", [{"k": "g", "as_of": "2024-01-03", "rnk": 400}])
    run()
    assert sorted(got) == [("g", D(2024, 1, 1), 1), ("g", D(2024, 1, 2), 2), ("g", D(2024, 1, 3), 3), ("h", D(2024, 1, 1), 0)]


def test_stream_and_batch_follow_the_same_rule_and_late_editions_are_left_out(spark, tmp_path):
    from cadenza.operators.charts import next_reentry

    folder, ckpt, got = tmp_path / "ranks", str(tmp_path / "ckpt"), {}
    folder.mkdir()
    ranks = [9, 400, 15, 90, 101, 3]
    days = [D(2022, 1, 1) + dt.timedelta(n) for n in (0, 1, 500, 501, 502, 990)]

    def run(name, lines):
        (folder / name).write_text("\n".join(json.dumps({"k": "g", "as_of": str(d), "rnk": r}) for d, r in lines))
        out = reentry_stream(spark.readStream.schema("k string, as_of date, rnk int").json(str(folder)), "k", GENRE_RULE)

        def keep(df, _):
            got.update({r.as_of: (r.should_notify, r.last_in, r.last_out) for r in df.collect()})

        out.writeStream.foreachBatch(keep).option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start().awaitTermination()

    run("1.json", list(zip(days, ranks))[:4])
    run("2.json", [(days[1], 1), (days[0] - dt.timedelta(9), 1)])
    run("3.json", list(zip(days, ranks))[4:])
    state, want = None, {}
    for day, rank in zip(days, ranks):
        state = next_reentry(spark.createDataFrame([("g", rank)], "k string, rnk int"), state, ["k"], GENRE_RULE, day)
        r = state.first()
        want[day] = (r.should_notify, r.last_appearance_in_top_20, r.last_appearance_in_top_100)
        state = spark.createDataFrame([r], state.schema)
    assert got == want


def test_streaks_as_a_stream(spark, tmp_path):
    """Edition by edition the same as from table to table; leavers leave no state, late editions no row."""
    import datetime as dt
    import json

    from cadenza.operators.charts import next_streaks
    from cadenza.streaming.streaks import STORE, streak_stream, use_keyed_timers

    before = spark.conf.get(STORE[0])
    use_keyed_timers(spark)
    day = dt.datetime(2024, 1, 1)
    charts = [["a", "b", "c"], ["a", "c"], ["b"], ["b", "c"], ["c"], ["c"]]
    folder = tmp_path / "in"
    folder.mkdir()
    try:
        stored = spark.createDataFrame([], "k string, streak int")
        got = []
        for i, keys in enumerate(charts):
            late = [{"k": "c", "edition": str(day)}] if i == 5 else []
            (folder / f"{i}.json").write_text("\n".join(json.dumps(x) for x in [{"k": k, "edition": str(day + dt.timedelta(i))} for k in keys] + late))
            source = spark.readStream.schema("k string, edition timestamp").json(str(folder))
            out = streak_stream(source, "k").writeStream.format("parquet").option("path", str(tmp_path / "out"))
            out.option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
            got = [(r.k, r.edition, r.streak) for r in spark.read.parquet(str(tmp_path / "out")).collect()]
            counts = spark.createDataFrame([(k, 1) for k in keys], "k string, n int")
            stored = spark.createDataFrame(next_streaks(counts, stored, "k", "n", "streak").collect(), "k string, streak int")
            now = {(r.k, day + dt.timedelta(i), r.streak) for r in stored.collect()}
            assert now == {g for g in got if g[1] == day + dt.timedelta(i)}
        assert len(got) == sum(map(len, charts))
        held = spark.read.format("statestore").option("stateVarName", "held").load(str(tmp_path / "state"))
        assert [r.key[0] for r in held.collect()] == ["c"]
    finally:
        spark.conf.set(STORE[0], before)
