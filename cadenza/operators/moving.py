"""Views of sums and counts that move with their table instead of being computed again.

A changed row takes its old values away from its group and brings the new ones. Summed by
group, these signed rows are a small table; added to the view they give its next state.
Groups whose last row goes leave the view. Sums must be of whole numbers or decimals, so
that what comes and goes cancels without rounding.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows behind a group.
COUNT = "n_rows"


def build_view(rows: DataFrame, group: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """``group``, the sum of each expression (null counts as nothing) and the number of rows."""
    totals = [F.sum(F.coalesce(c, F.lit(0))).alias(name) for name, c in sums.items()]
    return rows.groupBy(*group).agg(*totals, F.count(F.lit(1)).alias(COUNT))


def row_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Signed rows between two states of a part of a table: ``sign`` -1 for what goes, 1 for what comes.

    Both have the same columns and one row per key (null keys meet). Rows that are equal in
    all columns give nothing, so the cost downstream is that of the changes.
    """
    columns = new.columns
    rest = [c for c in columns if c not in keys]
    left = old.select(*[F.col(k).alias(f"__{k}") for k in keys], F.struct(*rest).alias("__old")).withColumn("__o", F.lit(True))
    right = new.select(*keys, F.struct(*rest).alias("__new")).withColumn("__n", F.lit(True))
    same = [F.col(f"__{k}").eqNullSafe(F.col(k)) for k in keys]
    both = right.join(left, same, "full")
    changed = both.filter(F.col("__o").isNull() | F.col("__n").isNull() | ~F.col("__old").eqNullSafe(F.col("__new")))
    side = lambda sign, there, key, row: F.when(there, F.struct(F.lit(sign).alias("sign"), *[F.col(key(k)).alias(k) for k in keys], *[F.col(row)[c].alias(c) for c in rest]))
    out = F.array_compact(F.array(side(-1, F.col("__o"), lambda k: f"__{k}", "__old"), side(1, F.col("__n"), lambda k: k, "__new")))
    return changed.select(F.explode(out).alias("__r")).select(F.col("__r.sign").alias("sign"), *[F.col(f"__r.{c}").alias(c) for c in columns])


def move_view(view: DataFrame, changes: DataFrame, group: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """The view after signed ``changes`` (a ``sign`` column beside the table's)."""
    _exact(view, sums)
    signed = {name: F.coalesce(c, F.lit(0)) * F.col("sign") for name, c in sums.items()}
    moved = changes.groupBy(*group).agg(*[F.sum(c).alias(name) for name, c in signed.items()], F.sum("sign").cast("long").alias(COUNT))
    moved = moved.filter(" OR ".join(f"`{name}` <> 0" for name in [*sums, COUNT]))
    values = [*sums, COUNT]
    new = moved.select(*[F.col(g).alias(f"__{g}") for g in group], *[F.col(v).alias(f"__d_{v}") for v in values])
    same = [F.col(g).eqNullSafe(F.col(f"__{g}")) for g in group]
    joined = view.withColumn("__v", F.lit(True)).join(new, same, "full")
    groups = [F.when(F.col("__v"), F.col(g)).otherwise(F.col(f"__{g}")).alias(g) for g in group]
    added = [(F.coalesce(F.col(v), F.lit(0)) + F.coalesce(F.col(f"__d_{v}"), F.lit(0))).cast(view.schema[v].dataType).alias(v) for v in values]
    return joined.select(*groups, *added).filter(F.col(COUNT) > 0)


def _exact(view: DataFrame, sums: Mapping[str, Column]) -> None:
    rough = [name for name in sums if isinstance(view.schema[name].dataType, T.FractionalType) and not isinstance(view.schema[name].dataType, T.DecimalType)]
    if rough:
        raise ValueError(f"sums of fractions drift when they are moved: {rough}")


def slide(rows: DataFrame, sums: Mapping[str, tuple[Column, Column]], was: Column, now: Column) -> DataFrame:
    """Signed rows for a view whose window moves: ``was`` and ``now`` say whether a row is in it.

    ``sums`` has each expression before and after. Only rows whose membership or values differ
    matter, so ``rows`` may be cut to them. The values become columns named as the sums.
    """
    side = lambda sign, there, k: F.when(there, F.struct(F.lit(sign).alias("sign"), *[F.coalesce(c[k], F.lit(0)).alias(name) for name, c in sums.items()]))
    both = F.explode(F.array_compact(F.array(side(-1, was, 0), side(1, now, 1))))
    kept = [c for c in rows.columns if c not in sums]
    return rows.select(*kept, both.alias("__r")).select(*kept, *[F.col(f"__r.{name}").alias(name) for name in ["sign", *sums]])
