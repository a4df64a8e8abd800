"""One row per key: first, top, mode, latest, and a rank over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import materialise

_SLOT = "__slot"


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key in ``order``.

    ``order`` must be total for a repeatable result: file ordinal, or a measure
    followed by an id. Catalyst prunes each map partition to one row per key
    before the shuffle (WindowGroupLimit), so a hot key costs one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(_SLOT, F.row_number().over(w)).filter(F.col(_SLOT) == 1).drop(_SLOT)


def top_per_key(df: DataFrame, keys: Sequence[str], measure: str, *ties: str) -> DataFrame:
    """Keep the row with the largest ``measure`` per key, nulls last, then ``ties`` ascending."""
    order = [F.col(measure).desc_nulls_last(), *(F.col(t).asc_nulls_last() for t in ties)]
    return first_per_key(df, keys, order)


def rank_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """1, 2, 3, … within every key, exact for keys of any size.

    The table is range-sorted on key and order, so one hot key is spread over many
    tasks; each row's rank is its place in the task plus the rows of the same key in
    earlier tasks. The sorted rows are written once, so pass only the columns you need.
    """
    slots = _sorted_slots(df, [F.col(k).asc_nulls_last() for k in keys], order)
    held = slots.groupBy("__task", *keys).agg(
        F.count(F.lit(1)).alias("__held"), F.min(_SLOT).alias("__first")
    )
    earlier = Window.partitionBy(*keys).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.withColumn("__before", F.coalesce(F.sum("__held").over(earlier), F.lit(0)))
    s, t = slots.alias("s"), starts.alias("t")
    same = [F.col(f"s.{k}").eqNullSafe(F.col(f"t.{k}")) for k in keys]
    place = F.col("__before") + F.col(f"s.{_SLOT}") - F.col("__first") + 1
    return s.join(t, [F.col("s.__task") == F.col("t.__task"), *same]).select(
        *[F.col(f"s.{c}").alias(c) for c in df.columns], place.cast("bigint").alias(name)
    )


def global_rank(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """1, 2, 3, … over the whole table without passing it through one task.

    Range-sort, materialise once so both uses see the same partitions, count the rows
    of each partition (one row per partition), and add the running offset. Pass only the
    columns you need.
    """
    slots = _sorted_slots(df, [], order)
    sizes = slots.groupBy("__task").agg(F.count(F.lit(1)).alias("__held"))
    offsets = sizes.select(
        "__task",
        (
            F.sum("__held").over(Window.orderBy("__task").rowsBetween(Window.unboundedPreceding, 0))
            - F.col("__held")
        ).alias("__before"),
    )
    return slots.join(offsets, "__task").select(
        *df.columns, (F.col("__before") + F.col(_SLOT) + 1).cast("bigint").alias(name)
    )


def _sorted_slots(df: DataFrame, lead: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """Range-sorted rows with their task number and their place inside it."""
    by = [*lead, *order]
    row = F.monotonically_increasing_id()
    sorted_rows = (
        df.repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .withColumn("__row", row)
        .withColumn("__task", F.shiftright("__row", 33).cast("int"))
        .withColumn(_SLOT, F.col("__row").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("__row")
    )
    return materialise(sorted_rows, "ranked")


def mode_per_key(df: DataFrame, keys: Sequence[str], value: str, count_name: str = "n") -> DataFrame:
    """The most frequent non-null ``value`` per key; ties go to the smallest value.

    Two aggregations with map-side combine; no group is ever sorted.
    """
    counts = df.groupBy(*keys, value).agg(F.count(value).alias(count_name))
    best = F.min(F.struct((-F.col(count_name)).alias("m"), F.col(value).alias("v")))
    return counts.groupBy(*keys).agg(best.alias("__b")).select(
        *keys, F.col("__b.v").alias(value), (-F.col("__b.m")).alias(count_name)
    )


def share_of_group(df: DataFrame, keys: Sequence[str], count_col: str, name: str, places: int) -> DataFrame:
    """Add the group total and each row's rounded share of it."""
    totals = df.groupBy(*keys).agg(F.sum(count_col).alias(f"{count_col}_total"))
    share = F.try_divide(F.col(count_col).cast("decimal(18,0)"), F.col(f"{count_col}_total").cast("decimal(18,0)"))
    return df.join(totals, list(keys)).withColumn(name, F.round(share, places).cast("double"))


def large_groups(df: DataFrame, keys: Sequence[str], more_than: int) -> DataFrame:
    """Rows of the groups that hold more than ``more_than`` rows."""
    big = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > more_than)
    return df.join(big.select(*keys), list(keys), "left_semi")


def value_counts(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def keep_keys(df: DataFrame, wanted: DataFrame, keys: Sequence[str], hashed: bool = False) -> DataFrame:
    """Rows of ``df`` whose key is in ``wanted``.

    An inner join with the distinct keys, not a semi join: Catalyst pushes a semi join
    below an aggregation, and then the raw rows of a hot key are shuffled unsummed.
    ``hashed`` keeps the distinct keys of a task in a hash table instead of sorting both sides.
    """
    keep = wanted.select(*keys).distinct()
    return df.join(keep.hint("shuffle_hash") if hashed else keep, list(keys))


def not_in(df: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key is absent from ``other``; nulls in ``other`` hide nothing."""
    return df.join(other.select(*keys), list(keys), "left_anti")


def with_fallback(wanted: DataFrame, primary: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Look ``wanted`` keys up in ``primary`` and only the unmatched ones in ``fallback``."""
    keys = list(keys)
    wanted = wanted.select(*keys).distinct()
    found = wanted.join(primary, keys)
    missed = not_in(wanted, primary, keys)
    return found.unionByName(missed.join(fallback, keys), allowMissingColumns=True)


def assign_ids(known: DataFrame, rows: DataFrame, key: str, id_col: str) -> DataFrame:
    """Surrogate ids for the keys of ``rows`` that ``known`` (key, id) lacks.

    New ids continue after the largest one, in key order. Returns ``known`` extended.
    """
    new = not_in(rows.select(key).distinct(), known, [key])
    top = known.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("top"))
    numbered = global_rank(new, [F.col(key).asc()], "__n")
    fresh = numbered.select(key, (F.col("__n") + top.scalar()).cast("bigint").alias(id_col))
    return known.select(key, F.col(id_col).cast("bigint").alias(id_col)).unionByName(fresh)
