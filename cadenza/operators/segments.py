"""Series whose longest one is too long for a task: scans in segments.

Rows are range-partitioned by key *and* order, so the rows of a hot key are spread over as
many tasks as its share asks for. A scan sees one segment, the rows of a key in one range;
what it needs of the segment before is one row, which a small table carries over.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cadenza.session import materialise

_SEGMENT, _FIRST, _BEFORE = "__segment", "__first", "__before"


def segmented(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """``df``, written once, with the range of each row; ranges follow the order of (keys, order).

    There are as many ranges as the session has shuffle partitions, of about equal rows.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *keys, order).withColumn(_SEGMENT, F.spark_partition_id())
    return materialise(ranged, "segments")


def previous_row(df: DataFrame, keys: Sequence[str], order: str, columns: Sequence[str], prefix: str = "prev_") -> DataFrame:
    """``df`` with the values that ``columns`` have in the row before, null in the first of a key.

    The same as ``lag`` over the whole series. (keys, order) must be unique; null keys are a
    series like any other, and rows without an order come first.
    """
    rows = segmented(df, keys, order)
    held = F.struct(*columns)
    within = Window.partitionBy(*keys, _SEGMENT).orderBy(F.col(order).asc_nulls_first())
    ends = rows.groupBy(*keys, _SEGMENT).agg(F.max_by(held, F.struct(F.col(order).isNotNull(), order)).alias(_BEFORE))
    carried = ends.withColumn(_BEFORE, F.lag(_BEFORE).over(Window.partitionBy(*keys).orderBy(_SEGMENT)))
    carried = carried.filter(F.col(_BEFORE).isNotNull())
    named = carried.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col(_SEGMENT).alias("__s"), F.lit(True).alias(_FIRST), _BEFORE)
    same = F.col(_SEGMENT) == F.col("__s")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__k_{k}"))
    inside = rows.withColumn("__lag", F.lag(held).over(within)).withColumn("__n", F.row_number().over(within))
    joined = inside.join(named, same & (F.col("__n") == 1), "left")
    before = F.when(F.col(_FIRST), F.col(_BEFORE)).otherwise(F.col("__lag"))
    return joined.select(*df.columns, *[before[c].alias(f"{prefix}{c}") for c in columns])
