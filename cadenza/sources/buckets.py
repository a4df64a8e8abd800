"""Tables kept by hash bucket of their key, merged bucket by bucket.

A table is a folder with a partition for each bucket, written and read by Spark as any other
partitioned table. Equal keys share a bucket, so a delta only concerns the buckets of its
own keys: the scan of the stored side is pruned to them, and all others pass by without
being read for a join, shuffled or written again. ``by`` may name a part of the key, such
as its date: a daily delta then touches as many buckets as it has dates.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.operators.maintain import insert_absent, patch, upsert
from cadenza.session import materialise

BUCKET = "bucket"


@dataclass(frozen=True)
class BucketedTable:
    """Where a table is, the columns that its buckets hash, and how many buckets there are."""

    path: str
    by: tuple[str, ...]
    buckets: int

    def bucket(self) -> Column:
        """Nulls hash like any value, so every row has a bucket."""
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows, with their bucket."""
        return spark.read.parquet(self.path)

    def write(self, df: DataFrame) -> BucketedTable:
        """The whole table. Rows meet by bucket in tasks of the advised size, a big bucket in several."""
        self._out(df).write.partitionBy(BUCKET).parquet(self.path)
        return self

    def _out(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, self.bucket()).hint("rebalance", F.col(BUCKET))

    def touched(self, delta: DataFrame) -> list[int]:
        """The buckets that the rows of ``delta`` belong to: no more values than there are buckets."""
        return sorted(r[0] for r in delta.select(self.bucket()).distinct().collect())

    def merge(self, spark: SparkSession, delta: DataFrame, change: Callable[[DataFrame], DataFrame]) -> Merge:
        """``change`` applied to the stored rows that share a bucket with ``delta``."""
        buckets = self.touched(delta)
        stored = self.read(spark)
        inside = F.col(BUCKET).isin(buckets)
        return Merge(self, buckets, stored.filter(~inside).drop(BUCKET), change(stored.filter(inside).drop(BUCKET)))


@dataclass(frozen=True)
class Merge:
    """The next state of a table: buckets that stay as they are, and the changed ones."""

    table: BucketedTable
    buckets: list[int]
    untouched: DataFrame
    changed: DataFrame

    def rows(self) -> DataFrame:
        return self.untouched.unionByName(self.changed)

    def apply(self) -> None:
        """Write the changed buckets in place of the old ones, by way of a copy in the shared folder.

        Run again after a failure, a merge of the same delta writes the same buckets.
        """
        copy = materialise(self.changed, "merged-buckets")
        out = self.table._out(copy).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(BUCKET).parquet(self.table.path)


def upsert_buckets(table: BucketedTable, delta: DataFrame, keys: Sequence[str], update: Sequence[str] | None = None) -> Merge:
    """``maintain.upsert`` on the buckets of a delta; ``keys`` must include what the buckets hash."""
    _covered(table, keys)
    return table.merge(delta.sparkSession, delta, lambda held: upsert(held, delta, keys, update))


def patch_buckets(table: BucketedTable, delta: DataFrame, keys: Sequence[str], columns: Sequence[str], keep_on_null: bool = False) -> Merge:
    """``maintain.patch`` on the buckets of a delta."""
    _covered(table, keys)
    return table.merge(delta.sparkSession, delta, lambda held: patch(held, delta, keys, columns, keep_on_null))


def insert_buckets(table: BucketedTable, delta: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> Merge:
    """``maintain.insert_absent`` on the buckets of a delta."""
    _covered(table, keys)
    return table.merge(delta.sparkSession, delta, lambda held: insert_absent(held, delta, keys, order))


def _covered(table: BucketedTable, keys: Sequence[str]) -> None:
    if not set(table.by) <= set(keys):
        raise ValueError(f"buckets hash {table.by}, which the key {tuple(keys)} does not hold")
