"""Parquet tables: versions, date partitions, exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.functions.text import strip_quotes


def _versions(spark: SparkSession, base: str) -> list[int]:
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    done = []
    for status in fs.listStatus(path):
        name = status.getPath().getName()
        success = jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name.startswith("v") and name[1:].isdigit() and fs.exists(success):
            done.append(int(name[1:]))
    return sorted(done)


def write_version(df: DataFrame, base: str, partition_by: Sequence[str] = ()) -> str:
    """Write the next version of a table beside the one that may be being read."""
    versions = _versions(df.sparkSession, base)
    path = f"{base.rstrip('/')}/v{(versions[-1] if versions else 0) + 1:06d}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    """The last completely written version."""
    versions = _versions(spark, base)
    if not versions:
        raise FileNotFoundError(f"no finished version under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/v{versions[-1]:06d}")


def overwrite_dates(df: DataFrame, path: str, date_col: str = "date") -> None:
    """Replace exactly the date partitions that ``df`` holds; the others stay untouched.

    Rows are gathered by date into tasks of the advised size: small dates share no file, a big
    date is written by as many tasks as its bytes ask for.
    """
    out = df.hint("rebalance", F.col(date_col))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(date_col).parquet(path)


def append_rows(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_all(df: DataFrame, path: str) -> None:
    """Full replace. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def plain_text(df: DataFrame) -> DataFrame:
    """Quote characters removed from every text column, for a bulk copy."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: strip_quotes(F.col(c)) for c in texts})


def export_csv(df: DataFrame, path: str, order: Sequence[Column] = (), single_file: bool = False) -> None:
    """A report as CSV with header, sorted over its part files.

    ``single_file`` is for reports that are short by construction (a top list).
    """
    out = df.orderBy(*order) if order else df
    if single_file:
        out = out.coalesce(1)
    out.write.mode("overwrite").csv(path, header=True)
