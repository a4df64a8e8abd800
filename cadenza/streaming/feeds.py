"""Feed folders as streams: the file source's checkpoint is the ledger of processed files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from cadenza.operators.maintain import change_only, unique_delta, upsert
from cadenza.session import materialise
from cadenza.sources.tables import overwrite_dates


#: The counts of a batch and the actions that they count.
COUNTS = {"updates": "update", "inserts": "insert"}


def watch_feed(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.tsv", sep: str = "\t", encoding: str = "UTF-16"
) -> DataFrame:
    """New files of a folder as a stream, each row with its file name."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    rows = reader.options(header=True, sep=sep, encoding=encoding, multiLine=True).csv(folder)
    return rows.withColumn("filename", F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def _stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table with all of its columns; an empty one where nothing is stored yet."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.option("mergeSchema", True).parquet(path)


def apply_batch(
    delta: DataFrame, path: str, keys: Sequence[str], compare: Sequence[str], newest: Sequence[Column], date_col: str = "date"
) -> DataFrame:
    """Change-only upsert of one batch into a table kept by date. Returns the two counts.

    Only the date partitions that change are read and rewritten, through a copy in the
    shared scratch folder, with all the columns that the table has; columns that the batch
    lacks keep their values, and are null in new rows. Spark moves the finished partitions
    into place when the job commits; a batch that is run again writes the same table.
    """
    spark = delta.sparkSession
    values = [c for c in delta.columns if c not in keys and c != "filename"]
    clean = unique_delta(delta, keys, newest).select(*keys, *values)
    clean = materialise(clean, "delta")
    touched = [r[0] for r in clean.select(date_col).distinct().collect()]
    current = _stored(spark, path, clean.schema)
    fresh = {c: F.lit(None).cast(clean.schema[c].dataType) for c in values if c not in current.columns}
    current = current.withColumns(fresh).filter(F.col(date_col).isin(touched))
    marked = change_only(current.select(*keys, *values), clean, keys, compare, date_col=date_col)
    # the write of what changes counts it too, so the tables are compared once
    seen, action = Observation(), F.col("action")
    counted = [F.count(F.when(action == kind, 1)).alias(name) for name, kind in COUNTS.items()]
    changed = materialise(marked.marked.observe(seen, *counted).filter(action != "same"), "changed")
    dates = [r[0] for r in changed.select(date_col).distinct().collect()]
    if dates:
        held = current.filter(F.col(date_col).isin(dates))
        others = [F.lit(None).cast(held.schema[c].dataType).alias(c) for c in held.columns if c not in clean.columns]
        merged = upsert(held, changed.drop("action").select("*", *others), keys, values)
        overwrite_dates(materialise(merged, "merged"), path, date_col)
    return spark.createDataFrame([(name, seen.get[name]) for name in COUNTS], "name string, value long")


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    keys: Sequence[str],
    compare: Sequence[str],
    newest: Sequence[Column],
    date_col: str = "date",
) -> StreamingQuery:
    """Apply every new file to the table once, then stop (run it again for later files)."""

    def batch(df: DataFrame, _: int) -> None:
        apply_batch(df, path, keys, compare, newest, date_col)

    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
