"""Binned statistics model: build, fit as z-scores, look up.

A model is a small table ``(count, mean, std, bin_min, bin_max)`` with disjoint bins.
Values find their bin by an equi-join on the power of two they fall in plus a range
check, so Spark broadcasts a small model by its own size check and hash-joins a big one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TOP = 62


def _band(c: Column) -> Column:
    """Power-of-two band of a value: -1 below 1, up to 62."""
    return F.when(c < 1, F.lit(-1)).otherwise(F.least(F.floor(F.log2(F.greatest(c, F.lit(1.0)))), F.lit(_TOP))).cast("int")


def build_model(df: DataFrame, group_col: str, gain_col: str, edges: Sequence[float]) -> DataFrame:
    """Describe ``gain_col`` per bin ``(edge, next edge]`` of ``group_col``."""
    cuts = F.array(*[F.lit(float(e)) for e in edges])
    passed = F.size(F.filter(cuts, lambda e: e < F.col(group_col)))
    return (
        df.withColumn("__bin", passed)
        .filter((F.col("__bin") > 0) & (F.col("__bin") < len(edges)) & F.col(gain_col).isNotNull())
        .groupBy("__bin")
        .agg(
            F.count(gain_col).cast("int").alias("count"),
            F.avg(gain_col).alias("mean"),
            F.stddev_samp(gain_col).alias("std"),
        )
        .select(
            "count",
            "mean",
            "std",
            F.get(cuts, F.col("__bin") - 1).alias("bin_min"),
            F.get(cuts, F.col("__bin")).alias("bin_max"),
        )
    )


def _banded(model: DataFrame) -> DataFrame:
    """The model with a flag for the last bin, one row per band the bin touches."""
    bounds = model.agg(F.max("bin_min").alias("m")).select("m")
    last = model.select("*", (F.col("bin_min") == bounds.scalar()).alias("__is_last"))
    to = F.when(F.col("__is_last"), F.lit(_TOP)).otherwise(_band(F.col("bin_max")))
    return last.select(
        "mean",
        "std",
        F.col("bin_min").alias("__lo"),
        F.when(F.col("__is_last"), F.lit(float("inf"))).otherwise(F.col("bin_max")).alias("__hi"),
        "__is_last",
        bounds.scalar().alias("__open_from"),
        F.explode(F.sequence(_band(F.col("bin_min")), to)).alias("__band"),
    )


def fit_model(df: DataFrame, model: DataFrame, group_col: str, gain_col: str, z: str = "z_score") -> DataFrame:
    """Add ``mean``, ``std`` and the z-score of ``gain_col``.

    Bins are open below and closed above, except the last: it starts at its lower edge
    and has no upper end. Values outside all bins get nulls.
    """
    x = F.col("__x")
    inside = F.when(F.col("__is_last"), x >= F.col("__lo")).otherwise(
        (x > F.col("__lo")) & (x <= F.col("__hi")) & (x < F.col("__open_from"))
    )
    return _attach(df, model, group_col, inside).withColumn(
        z, F.try_divide(F.col(gain_col) - F.col("mean"), F.col("std"))
    )


def lookup_bin(df: DataFrame, model: DataFrame, column: str) -> DataFrame:
    """Add ``mean`` and ``std`` of the bin closed below and open above; beyond the last
    upper edge the last bin holds."""
    x = F.col("__x")
    inside = (x >= F.col("__lo")) & (x < F.col("__hi"))
    return _attach(df, model, column, inside)


def _attach(df: DataFrame, model: DataFrame, column: str, inside: Column) -> DataFrame:
    probe = df.withColumn("__x", F.col(column).cast("double")).withColumn("__b", _band(F.col("__x")))
    joined = probe.join(_banded(model), (F.col("__b") == F.col("__band")) & inside, "left")
    return joined.select(*df.columns, "mean", "std")


def above(df: DataFrame, gain_col: str, k: float) -> DataFrame:
    """Keep gains more than ``k`` standard deviations above the bin mean."""
    return df.filter(F.col(gain_col) > F.col("mean") + F.col("std") * k)
