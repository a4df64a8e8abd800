"""What the operators of this subpackage share: tables cut from their lineage, and text keys."""

from __future__ import annotations

import ctypes
import functools
import gc
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.session import scratch_dir

#: Java's ASCII white space: space and U+0009 to U+000D.
SPACE = r"\s"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The folder is the one ``spark.checkpoint.dir`` names, so a lost executor takes
    nothing with it, and whatever reads the table twice sees the same rows.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    for paths in _listening:
        paths.append(path)
    return spark.read.schema(df.schema).parquet(path)


_listening: list[list[str]] = []


@contextmanager
def listing(paths: list[str]) -> Iterator[None]:
    """Adds to ``paths`` the folders of the tables that ``stored`` writes meanwhile."""
    _listening.append(paths)
    try:
        yield
    finally:
        _listening.remove(paths)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete these tables, which no later job may read: what was derived from them is written."""
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


Kernel = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def giving_back(run: Kernel) -> Kernel:
    """``run`` for ``mapInArrow``; at its end the worker gives back the memory that it no longer uses.

    Spark keeps workers for later tasks, and stages need several at a time: what an idle one
    holds adds to the memory of those that work.
    """

    @functools.wraps(run)
    def run_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return run_task


def give_back() -> None:
    """Free what is not used, and give the system what the allocators of Arrow and of C keep of it."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:  # not every C library has one
        trim(0)


def text_or_empty(column: str = "text") -> Column:
    """The whole text, empty for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the engine's fast path."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, upper, lower)
    )


def words(text: Column) -> Column:
    """The runs of anything but ASCII white space, in order."""
    return F.array_remove(F.split(text, rf"{SPACE}+"), "")
