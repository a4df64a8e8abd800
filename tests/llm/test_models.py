"""Classifiers, mixing, tokens and the pipeline."""

import os
import random
import re

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from cadenza.llm import ORACLES, QUERIES, bpe, hashed, langid, mixing, weak
from tests.llm.conftest import SCHEMA, as_rows, prose

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
needs_tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="needs the given tables")


@pytest.fixture(scope="module")
def library():
    ranks = bpe.read_ranks(VOCABULARY)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_words_merge_as_the_library_does(library):
    import regex

    ranks, cut = bpe.read_ranks(VOCABULARY), regex.compile(public_tokenizers.PATTERN)
    rng = random.Random(4)
    for _ in range(800):
        text = "".join(rng.choice("abtheinger dé üß漢字😀  \n\t\x1c12'sll!?") for _ in range(rng.randrange(0, 60)))
        assert [i for p in cut.findall(text) for i in bpe.merge_word(p.encode(), ranks)] == library.encode_ordinary(text)
    assert bpe.merge_word(b"ab" * 20_000, ranks) == library.encode_ordinary("ab" * 20_000)


def test_bpe_round_trip(docs, rows, library, monkeypatch):
    for size in (bpe.BLOCK_BYTES, 500):
        monkeypatch.setattr(bpe, "BLOCK_BYTES", size)
        out = bpe.decode(bpe.encode(docs, VOCABULARY, public_tokenizers.PATTERN), VOCABULARY)
        got = sorted(((r.id, list(r.ids), bytes(r.decoded)) for r in out.collect()), key=str)
        want = sorted(((r[0], library.encode_ordinary(r[1] or ""), (r[1] or "").encode()) for r in rows), key=str)
        assert got == want


def test_bpe_cuts_each_text_once(spark, rows):
    read = spark.sparkContext.accumulator(0)

    def seen(text):
        read.add(1)
        return text

    table = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3).select("doc_id", F.udf(seen, "string")("text").alias("text"))
    out = bpe.encode(table, VOCABULARY, public_tokenizers.PATTERN, ranges=7).collect()
    assert len(out) == len(rows) == read.value


@needs_tables
def test_languages_held_out(spark):
    docs = spark.read.parquet(f"{FOLDER.replace('0.001', '0.01')}/documents.parquet")
    out = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right, total = out.filter("lang = lang_pred").count(), out.count()
    assert total > 100 and right / total > 0.97


def test_language_edge_cases(docs, empty, crowded):
    out = langid.identify(docs).collect()
    assert len(out) == docs.count()
    by = {r.doc_id: r for r in out}
    for i in (300, 301, 302, 307, 309):
        assert (by[i].lang_pred, by[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("en", "de", "fr", "und") for r in out)
    assert langid.identify(empty).count() == 0
    assert langid.identify(crowded).count() == crowded.count()
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.identify(nothing).collect()} == {"und"}


def test_language_and_source_are_no_inputs(docs):
    model = langid.fit(docs, "doc_id", "text", "lang")
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit("yy"))
    assert as_rows(langid.predict(docs, model)) == as_rows(langid.predict(other, model))


@needs_tables
def test_quality_against_labels(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    out = weak.classify(docs).withColumnRenamed("quality", "score").join(labels, "doc_id")
    good, bad = out.filter("quality = 1"), out.filter("quality = 0")
    assert good.filter("kept").count() / good.count() > 0.98
    assert bad.filter("kept").count() / bad.count() < 0.1


def test_label_model_finds_accuracies():
    """Votes drawn from known rates: the estimates come near them."""
    rng = np.random.default_rng(2)
    n, k = 20_000, len(weak.LABELLERS)
    bad = rng.random(n) < 0.2
    recall = np.linspace(0.2, 0.8, k)
    fires = rng.random((n, k)) < np.where(bad[:, None], recall, 0.005)
    told = rng.random((n, k)) < 0.9
    cast = np.where(~told, 1, np.where(fires, 0, 2))
    code, count = np.unique(cast @ 3 ** np.arange(k), return_counts=True)
    model = weak.fit_labels(code, count.astype(float))
    assert abs(model.good - 0.8) < 0.02
    assert np.abs(model.table[:, 0, 0] - recall).max() < 0.05


def test_quality_edge_cases(docs, empty, crowded):
    out = {r.doc_id: r for r in weak.classify(docs).collect()}
    for i in (300, 301, 302, 309):
        assert out[i].quality == 0 and not out[i].kept
    assert weak.classify(empty).count() == 0
    assert weak.classify(crowded, carry=["kept"]).count() == crowded.count()


def test_rates_meet_targets(spark):
    rng = np.random.default_rng(0)
    p = rng.dirichlet([0.3, 0.3, 0.3], 3000)
    rows = [(i, 0, int(n), [float(x) for x in q]) for i, (q, n) in enumerate(zip(p, rng.integers(1, 900, 3000)))]
    held = spark.createDataFrame(rows, "id long, tag long, n_tokens long, posterior array<double>").cache()
    names, settings = ["a", "b", "c"], mixing.Settings(steps=300)
    plan = mixing.fit_rates(held, names, {"a": 0.6, "b": 0.3, "c": 0.1}, 500_000.0, settings)
    assert np.abs(plan.reached - plan.target).max() < 1e-3 * plan.target.sum()
    rate = mixing.rates(p, plan.history, settings)[:, 0]
    assert rate.min() >= 0
    assert np.allclose((rate * [r[2] for r in rows]) @ p, plan.reached)


def test_mixing_edge_cases(spark, docs, empty, crowded):
    labelled = docs.filter("doc_id is not null").select("doc_id", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b").alias("domain"))
    out = mixing.mix(docs, labelled, {"a": 0.5, "b": 0.5})
    assert out.count() == docs.count()
    assert out.filter("rate < 0 or copies < floor(rate) or copies > ceil(rate)").count() == 0
    assert mixing.mix(crowded, labelled, {"a": 1.0}).count() == crowded.count()
    assert mixing.mix(empty, labelled.limit(0), {"a": 1.0}).count() == 0
    assert mixing.mix(empty, labelled, {"a": 1.0}).count() == 0
    alone = mixing.mix(docs, labelled.limit(0), {"a": 1.0})
    assert {(r.rate, r.copies) for r in alone.collect()} == {(1.0, 1)}
    again = mixing.mix(docs, labelled, {"a": 0.5, "b": 0.5})
    assert as_rows(out, "id", "tag", "copies") == as_rows(again, "id", "tag", "copies")


def test_domains_of_weight_zero_go(spark):
    """No coin: what mostly belongs to a domain of weight 0 goes, all else stays."""
    rng = random.Random(5)
    texts = [prose(rng, rng.choice([30, 90, 400])).split(" ") for _ in range(240)]
    for t in texts[::6]:
        t.insert(rng.randrange(len(t)), rng.choice(["Scumbag,", "vermin."]))
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    # the last documents are not labelled
    labelled = docs.filter("doc_id < 180").select("doc_id", F.when(F.col("doc_id") % 6 == 0, "toxic").otherwise("clean").alias("domain"))
    out = mixing.mix(docs, labelled, corpus_pipeline.WEIGHTS).collect()
    assert {r.id for r in out if not r.copies} == set(range(0, 240, 6))
    assert {(r.rate, r.copies) for r in out if r.id % 6} == {(1.0, 1)}


@needs_tables
def test_toxic_documents_leave_the_pipeline(spark):
    folder = FOLDER.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    left = corpus_pipeline.mixture(spark, docs, folder).join(labels.filter("quality = 1"), "doc_id")
    assert left.filter("toxic = 1").count() == 0
    clean = labels.filter("quality = 1 and toxic = 0").count()
    assert left.filter("toxic = 0").select("doc_id").distinct().count() >= 0.99 * clean


def test_memory_of_the_votes_follows_the_chunk():
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(1)
    stock = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    texts = [" ".join(rng.choice(stock) for _ in range(300)) for _ in range(1500)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["tag", "text"])
    tracemalloc.start()
    rows = sum(out.num_rows for out in weak._vote_rows(iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and peak < 25e6


def test_memory_of_a_fit_is_some_bytes_a_feature():
    import tracemalloc

    rng = np.random.default_rng(2)
    shown = [np.sort(rng.choice(hashed.BUCKETS, 3000, replace=False)).astype(np.int32) for _ in range(800)]
    target = rng.dirichlet(np.ones(2), len(shown))
    tracemalloc.start()
    hashed.fit_linear(shown, target, rounds=2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 18 * sum(map(len, shown)), peak


def test_fit_is_that_of_whole_matrices(monkeypatch):
    """Rows with nothing shown and further signs among them; the answer does not follow what is laid out at a time."""
    rng = np.random.default_rng(3)
    shown = [np.sort(rng.choice(400, int(k), replace=False)).astype(np.int32) for k in [0, 1, 300, *rng.integers(0, 60, 60)]]
    n, classes = len(shown), 3
    target, extra = rng.dirichlet(np.ones(classes), n), rng.integers(0, 4, (n, 2)) + [0, 4]
    matrix = np.zeros((n, hashed.BUCKETS + 8))
    for i, own in enumerate(shown):
        matrix[i, own] = 1 / np.sqrt(max(len(own), 1))
        matrix[i, hashed.BUCKETS + extra[i]] = 1
    used = matrix.any(axis=0)
    x, weights, bias, seen = matrix[:, used], np.zeros((used.sum(), classes)), np.log(target.mean(axis=0) + 1e-6), 1e-8
    for _ in range(20):
        off = (hashed.softmax(x @ weights + bias) - target) / n
        gradient = x.T @ off + 0.05 * weights / n
        seen = seen + gradient**2
        weights, bias = weights - 0.5 * gradient / np.sqrt(seen), bias - off.sum(axis=0)
    fits = []
    for at_once in (1 << 17, 100, 1):
        monkeypatch.setattr(hashed, "FIT_AT_ONCE", at_once, raising=False)
        fits.append(hashed.fit_linear(shown, target, extra, 8, rounds=20, ridge=0.05))
        assert np.array_equal(fits[-1].weights, fits[0].weights) and np.array_equal(fits[-1].extra, fits[0].extra)
    assert np.allclose(np.concatenate([fits[0].weights, fits[0].extra])[used], weights, atol=1e-4) and np.allclose(fits[0].bias, bias)


def test_kernels_give_memory_back_at_their_end(monkeypatch):
    import pyarrow as pa

    from cadenza.llm import common, hashed

    times = []
    monkeypatch.setattr(common, "give_back", lambda: times.append(1))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["some words", None])], ["tag", "text"])
    for kernel in (common.giving_back(weak._vote_rows), hashed.feature_rows("text", "tag")):
        times.clear()
        tags = []
        for out in kernel(iter([batch, batch])):
            assert not times
            tags += out.column(0).to_pylist()
        assert tags == [1, 2, 1, 2] and times == [1]


def test_idle_workers_hold_no_freed_memory():
    """What numpy frees between live arrays goes back to the system too."""
    from pathlib import Path

    from cadenza.llm import common

    def held():
        return int(re.search(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())[1]) / 1024

    arrays = [np.ones(8_000) for _ in range(2_400)]  # 64 KB each, below what the C library maps by itself
    full, last = held(), arrays[-1]
    del arrays
    common.give_back()
    assert held() < full - 100 and last.sum() == 8_000


def test_carried_texts_travel_once(spark, docs):
    """The text of a document goes to the scorer in one column, carried or not."""
    carried = weak.classify(docs, carry=["text"])
    plain = weak.classify(docs)
    scan = re.search(r"MapInArrow run\((.*?)\)", carried._jdf.queryExecution().optimizedPlan().toString())[1]
    assert scan.count("text") == 1, scan
    assert as_rows(carried, "doc_id", "quality", "kept") == as_rows(plain, "doc_id", "quality", "kept")
    assert as_rows(carried, "doc_id", "text") == as_rows(docs, "doc_id", "text")


def test_mixture_stage_evens_out_languages(spark, tmp_path):
    """The fitted rates decide what goes on: a small language is repeated, the largest stays as it is."""
    rng = random.Random(12)
    stock = {lang: ["".join(rng.choice(letters) for _ in range(6)) for _ in range(60)] for lang, letters in (("aa", "abcdefgh"), ("bb", "pqrstuvw"))}
    rows = []
    for i in range(400):
        lang = "bb" if i % 10 == 0 else "aa"
        text = " ".join(rng.choice(stock[lang]) for _ in range(80))
        rows.append((i, text, lang, "s", len(text)))
    table = spark.createDataFrame(rows, SCHEMA)
    table.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    out = {r["lang"]: r["count"] for r in corpus_pipeline.mixture(spark, table, str(tmp_path)).groupBy("lang").count().collect()}
    want = 360 * (40 / 360) ** corpus_pipeline.EVENED
    assert out["aa"] >= 356 and abs(out["bb"] - want) < 0.15 * want


def test_stages_handle_odd_tables(spark, docs, empty, crowded, tmp_path):
    docs.select("doc_id").filter("doc_id is not null").select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic")).write.parquet(f"{tmp_path}/labels.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        for table in (docs, empty, crowded):
            out = stage(spark, table, str(tmp_path))
            got = out.count()
            assert got == 0 if table is empty else got >= 0
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == corpus_pipeline.COLUMNS


def test_scratch_tables_are_listed_and_deleted(spark):
    import os

    from cadenza.llm.common import listing, release, stored

    paths, other = [], []
    with listing(paths):
        kept = stored(spark.range(5), "listed")
        with listing(other):
            stored(spark.range(3), "listed-too")
    outside = stored(spark.range(2), "unlisted")
    assert kept.count() == 5 and len(paths) == 2 and len(other) == 1
    folders = [p.removeprefix("file:") for p in paths]
    assert all(map(os.path.isdir, folders))
    release(spark, paths)
    assert paths == [] and not any(map(os.path.isdir, folders)) and outside.count() == 2
    release(spark, other)  # what is gone already is no error


def test_near_duplicate_stage_keeps_one_of_each_group(spark, docs, rows):
    from tests.llm.test_exact_ops import brute_components

    unique = [r for r in rows if r[0] is not None and r[0] != 5]
    kept = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(unique, SCHEMA), "")
    want = sorted(i for i, _, c in brute_components(unique) if i == c)
    assert sorted(r.doc_id for r in kept.collect()) == want


def test_line_stage_against_brute_force(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, 30).replace("\n", " ") + "\nshared notice here\n" + prose(rng, 30), "en", f"s{i % 15}", 0) for i in range(45)]
    rows.append((90, "shared notice here", "en", "s1", 18))
    out = {r.doc_id: r for r in corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert set(out) == set(range(45))
    assert "shared notice here" in out[0].text
    assert all("shared notice here" not in out[i].text and out[i].n_chars == len(out[i].text) for i in range(1, 45))


def test_line_stage_finds_passages_on_few_sources(spark):
    """A passage on 3 to 5 of 20 sources goes but once; short lines, and what two sources share, stay."""
    passages = {n: f"this passage is planted on {n} sources" for n in (2, 3, 4, 5)}
    passages[6] = "本作品采用知识共享许可"
    held = lambda i: [p for n, p in passages.items() if i % 20 < n]
    rows = []
    for i in range(40):
        text = "\n".join([f"own words of the document {i}", "The end.", *(["Of this house"] if i % 20 < 8 else []), *held(i)])
        rows.append((i, text, "en", f"s{i % 20}", len(text)))
    out = {r.doc_id: r.text.split("\n") for r in corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, SCHEMA), "").collect()}
    assert len(out) == 40 and all("The end." in t for t in out.values())
    assert sum("Of this house" in t for t in out.values()) == 16
    assert [sum(p in t for t in out.values()) for p in passages.values()] == [4, 1, 1, 1, 1]


@needs_tables
def test_pipeline_follows_its_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, FOLDER).cache()
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3]
    assert as_rows(corpus_pipeline.run(spark, FOLDER)) == as_rows(docs)


def test_every_operator_has_a_query():
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@needs_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    import glob

    import duckdb

    from tools.check_oracles import table

    con = duckdb.connect()
    for path in glob.glob(f"{FOLDER}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    df = QUERIES[name](spark, FOLDER)
    cur = con.execute(ORACLES[name])
    assert table(df.columns, df.collect()) == table([d[0] for d in cur.description], cur.fetchall())
