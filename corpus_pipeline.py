"""A corpus pipeline: five stages, each on all that its predecessor kept.

``STAGES`` are (name, function); a function takes (spark, docs, sf_dir). All but the last
return the columns of ``documents``; the last returns the tokens of the documents.

A stage is given what its predecessor returned, written and read again. So the tables that
the predecessor cut its lineage with are no longer read, and are deleted when a stage begins.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cadenza.llm import jaccard, lines, mixing, queries, weak
from cadenza.llm.common import listing, release
from cadenza.session import materialise

#: Neither toxic documents nor what the first stage left of the low ones is to stay.
WEIGHTS = {"clean": 1.0, "toxic": 0.0, "low": 0.0}
#: The languages of the clean documents are mixed to their sizes to this power, so that small ones count more.
EVENED = 0.7
#: A passage that a few sources share is boilerplate; lines of few words are common by chance.
SPREAD = lines.Spread(long_sites=3)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


#: Folders of the tables that the last stage has written for itself.
_scratch: list[str] = []


def _stage(function):
    """A stage that first deletes the tables of the one before."""

    @functools.wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _scratch)
        with listing(_scratch):
            return function(spark, docs, sf_dir)

    return run_stage


@_stage
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; null and blank texts among them."""
    judged = weak.classify(docs, carry=COLUMNS)
    return judged.filter("kept").select(*COLUMNS)


@_stage
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go but for their first occurrence; a document that loses its last
    word by that goes too. ``n_chars`` follows the text."""
    out = lines.drop_boilerplate(docs.select(*COLUMNS), spread=SPREAD)
    emptied = (F.col("n_removed_lines") > 0) & ~F.col("text").rlike(r"\S")
    changed = F.when(F.col("n_removed_lines") > 0, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.filter(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", changed).select(*COLUMNS)


@_stage
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group that links connect, the document with the smallest id stays.

    Documents without words are linked with nothing and stay. Rows that repeat an id and a
    text are copies of each other: one of them stays.
    """
    of = jaccard.jaccard_components(docs.select("doc_id", "text"))
    # an id that repeats with other texts stays where it is the smallest of one of its groups
    first = of.filter(F.col("id").eqNullSafe(F.col("component_id")))
    chosen = first.groupBy(_key("id").alias("__key")).agg((F.min("n_shingles") > 0).alias("__worded"))
    kept = docs.select(*COLUMNS, _key("doc_id").alias("__key")).join(chosen.hint("merge"), "__key")
    copies = Window.partitionBy("__key", F.xxhash64("text")).orderBy(*COLUMNS[2:])
    once = kept.withColumn("__copy", F.row_number().over(copies))
    return once.filter((F.col("__copy") == 1) | ~F.col("__worded")).select(*COLUMNS)


def _key(column: str) -> Column:
    """An id as text, so that null ids meet too."""
    return F.coalesce(F.col(column).cast("string"), F.lit("null"))


def _language(lang: Column) -> Column:
    return F.concat(F.lit("clean "), F.coalesce(lang, F.lit("und")))


def language_domains(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled domains, the clean one by language."""
    of = docs.select("doc_id", "lang").distinct()
    domain = F.when(F.col("domain") == "clean", _language(F.col("lang"))).otherwise(F.col("domain"))
    return labels.join(of, "doc_id").select("doc_id", domain.alias("domain"))


def language_weights(docs: DataFrame) -> dict[str, float]:
    """Target weights: the largest language keeps its size, the others come nearer to it."""
    sizes = docs.groupBy(_language(F.col("lang")).alias("domain")).agg(F.sum(F.octet_length("text")).alias("size")).collect()
    others = {domain: weight for domain, weight in WEIGHTS.items() if domain != "clean"}
    return {r["domain"]: WEIGHTS["clean"] * float(r["size"] or 0) ** EVENED for r in sizes} | others


@_stage
def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as many times as its fitted rate says: tokens meet the target weights.

    Documents that are toxic or low for the most part go, all others stay; those of smaller
    languages are repeated until the tokens of the languages meet ``language_weights``.
    """
    labels = language_domains(docs, queries.label_domains(spark, sf_dir))
    mixed = mixing.mix(docs.select("doc_id", "text"), labels, language_weights(docs))
    # the fit may take a rate of the largest language a little below 1: that is no reason to drop a document
    copies = mixed.select("id", "tag", F.when(F.col("rate") > 0, F.greatest("copies", F.lit(1))).otherwise(F.col("copies")).alias("copies")).distinct()
    tagged = docs.select(*COLUMNS).withColumn("__tag", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("__tag") == F.col("tag"))
    taken = tagged.join(copies.hint("merge"), same).filter("copies > 0")
    return taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select(*COLUMNS)


@_stage
def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return queries.token_digests(docs.select("doc_id", "text"))


STAGES = [
    ("quality classifier", quality),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE", tokens),
]

#: The classifiers and the tokenizer cannot be said in SQL; tests hold line dedup and near
#: duplicates against brute force, the others against labels, round trip or odd tables.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-").lower())
    return STAGES[-1][1](spark, docs, sf_dir)
