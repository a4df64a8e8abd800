"""Exact dedup by distributed MSD radix partitioning.

A document is its key bytes behind their length. Level by level the next digit (a run of
bytes, wider at every level) splits each group; a group of one, or one whose bytes have
ended, is done. Counts are summed per group and digit before they are shuffled, so a
third of all rows being one text costs one partial row per map task. The rows that remain
are dealt by group and digit in a join, which adaptive execution splits where it is hot.
Equality is that of the bytes; no digest takes part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import ascii_lower, stored, text_or_empty

_GROUP, _KEY, _LEN, _DIGIT, _NEXT = "__group", "__key", "__len", "__digit", "__next"


def radix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: Sequence[str] = (),
    first_width: int = 64,
    growth: int = 8,
) -> DataFrame:
    """One row per document: id, ``carry``, ``keep_id``, ``group_size``, ``kept``.

    Texts are equal when they are the same after lower-casing A-Z. The row with the largest
    id stays; of rows that repeat id and text, one. Null text counts as empty; a null id
    stays only where its group has no other. Digits are ``first_width`` bytes, then
    ``growth`` times as wide at every level, so the longest text decides the number of
    levels by its logarithm. An empty table gives an empty table.
    """
    names = [id_col, *carry]
    key = ascii_lower(text_or_empty(text_col)).cast("binary")
    active = docs.select(
        *[F.col(c) for c in names], key.alias(_KEY), F.lit(None).cast("long").alias(_GROUP)
    ).withColumn(_LEN, F.octet_length(_KEY))
    at, width, done = 0, first_width, []
    while True:
        digit = F.substring(F.col(_KEY), at + 1, width)
        split = active.withColumn(_DIGIT, digit)
        groups = (
            split.groupBy(_GROUP, _LEN, _DIGIT)
            .agg(F.count(F.lit(1)).alias("group_size"), F.max(id_col).alias("keep_id"))
            .filter(F.col("group_size") > 1)
            .withColumn(_NEXT, F.monotonically_increasing_id())
        )
        groups = stored(groups, "radix-groups")
        a, g = split.alias("a"), groups.alias("g")
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"g.{c}")) for c in (_GROUP, _LEN, _DIGIT)]
        single = F.col(f"g.{_NEXT}").isNull()
        open_ = ~single & (F.col(f"a.{_LEN}") > at + width)
        level = a.join(g.hint("merge"), same, "left").select(
            *[F.col(f"a.{c}").alias(c) for c in names],
            F.when(single, F.col(f"a.{id_col}")).otherwise(F.col("g.keep_id")).alias("keep_id"),
            F.coalesce("g.group_size", F.lit(1).cast("long")).alias("group_size"),
            F.col(f"g.{_NEXT}").alias(_GROUP),
            F.col(f"a.{_LEN}").alias(_LEN),
            F.when(open_, F.col(f"a.{_KEY}")).alias(_KEY),
        )
        level = stored(level.withColumn("__row", F.monotonically_increasing_id()), "radix-level")
        done.append(_one_stays(level.filter(F.col(_KEY).isNull()), names, id_col))
        active = level.filter(F.col(_KEY).isNotNull()).select(*names, _KEY, _GROUP, _LEN)
        if active.isEmpty():
            break
        at, width = at + width, width * growth
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def _one_stays(rows: DataFrame, names: list[str], id_col: str) -> DataFrame:
    """Of the rows with the largest id of their group, the first written."""
    largest = F.col(id_col).eqNullSafe(F.col("keep_id"))
    first = (
        rows.filter(largest & (F.col("group_size") > 1))
        .groupBy(F.col(_GROUP).alias("__of"))
        .agg(F.min("__row").alias("__first"))
    )
    joined = rows.join(first, F.col(_GROUP) == F.col("__of"), "left")
    kept = (F.col("group_size") == 1) | F.coalesce(F.col("__row") == F.col("__first"), F.lit(False))
    return joined.select(*names, "keep_id", "group_size", kept.alias("kept"))
