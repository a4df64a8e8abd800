"""Shards by a k-d tree over document metadata, built with DataFrame operations only.

A narrow table (row number, size, coordinates) is written once. Level by level each node
takes the dimension in which it is widest and is cut where the bytes on its left reach its
share; the cut is a weighted median found by histograms, refined until it names one row.
The driver holds the cuts, one for each shard but one, and nothing else.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import stored, text_or_empty

BINS = 1 << 13
#: Rows numbered by one window at most: low bits of a row number.
SLOT_BITS = 16


def ordinal(column: str) -> Column:
    """Strings as numbers in their order, by their first seven bytes; null is -1."""
    head = F.substring(F.col(column).cast("string").cast("binary"), 1, 7)
    padded = F.rpad(F.hex(head), 14, "0")
    return F.coalesce(F.conv(padded, 16, 10).cast("long"), F.lit(-1).cast("long"))


def kd_shards(
    docs: DataFrame,
    shards: int = 24,
    id_col: str = "doc_id",
    text_col: str = "text",
    numbers: Sequence[str] = ("doc_id", "n_chars"),
    names: Sequence[str] = ("lang", "source"),
    target_bytes: int | None = None,
) -> DataFrame:
    """One row per document: id, ``size``, ``text_crc32``, ``shard``, ``slot``.

    The law is equal bytes: a node of ``k`` shards is cut where its left ``k // 2`` shards
    reach their part of its bytes, to the nearest row. ``target_bytes`` sets the number of
    shards by the corpus instead. ``numbers`` and ``names`` are the numeric and the text
    dimensions; a missing value is -1, lowest among counts. Equal rows and ties are
    told apart by the row number of the written table, so a hot source or a group of
    copies is cut like anything else. Slots are gapless from 0 within a shard. Null text
    has 8 bytes and checksum 0. An empty table gives an empty table.
    """
    text = text_or_empty(text_col)
    values = [F.coalesce(F.col(c).cast("long"), F.lit(-1).cast("long")) for c in numbers]
    values += [ordinal(c) for c in names]
    narrow = docs.select(
        F.col(id_col),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text.cast("binary")).cast("long").alias("text_crc32"),
        F.array(*values).alias("__dims"),
        F.monotonically_increasing_id().alias("__row"),
        F.lit(0).alias("__node"),
    )
    narrow = stored(narrow, "kd-rows")
    if target_bytes:
        total = narrow.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // target_bytes))
    return _slots(_split(narrow, len(values), shards), id_col)


def _split(rows: DataFrame, dims: int, shards: int) -> DataFrame:
    """``rows`` with the first shard of their box in ``__node``, one level of cuts at a time."""
    whole: list[int] | None = None
    level = {0: shards}
    while level := {first: count for first, count in level.items() if count > 1}:
        at = rows.filter(F.col("__node").isin(list(level)))
        ends = [F.struct(F.min(F.col("__dims")[d]).alias("lo"), F.max(F.col("__dims")[d]).alias("hi")) for d in range(dims)]
        stats = at.groupBy("__node").agg(F.sum("size").alias("size"), F.array(*ends).alias("ends")).collect()
        if not stats:
            return rows
        whole = whole or [max(1, e["hi"] - e["lo"]) for e in stats[0]["ends"]]
        widest, wanted = {}, {}
        for s in stats:
            first, wide = s["__node"], [e["hi"] - e["lo"] for e in s["ends"]]
            widest[first] = max(range(dims), key=lambda d: wide[d] / whole[d])
            lo, hi = s["ends"][widest[first]]
            wanted[first] = (lo, hi, s["size"] * (level[first] // 2) / level[first])
        cuts = _median_cuts(at, widest, wanted)
        table = _values(rows, "__node int, __dim int, __value bigint, __last bigint, __half int",
                        [(n, widest[n], *cuts[n], level[n] // 2) for n in cuts])
        own = F.get(F.col("__dims"), F.col("__dim"))
        left = (own < F.col("__value")) | ((own == F.col("__value")) & (F.col("__row") <= F.col("__last")))
        moved = rows.join(table, "__node", "left").withColumn(
            "__node", F.when(F.coalesce(left, F.lit(True)), F.col("__node")).otherwise(F.col("__node") + F.col("__half"))
        )
        rows = stored(moved.select(*rows.columns), "kd-level")
        level = {k: v for n, c in level.items() for k, v in ((n, c // 2), (n + c // 2, c - c // 2))}
    return rows


def _values(rows: DataFrame, schema: str, values: list[tuple]) -> DataFrame:
    """A few literal rows, at most one for each shard."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [c.split()[1] for c in schema.split(", ")]
    cells = ", ".join("(" + ", ".join(f"CAST({v!r} AS {k})" for v, k in zip(r, kinds, strict=True)) + ")" for r in values)
    return rows.sparkSession.sql(f"SELECT * FROM VALUES {cells} AS t({', '.join(names)})")


def _median_cuts(at: DataFrame, widest: dict[int, int], wanted: dict[int, tuple[int, int, float]]) -> dict[int, tuple[int, int]]:
    """Weighted medians of all boxes of a level: the value, then the last row on the left among its ties."""
    table = _values(at, "__node int, __dim int", list(widest.items()))
    keyed = at.join(table, "__node").select("__node", "__row", "size", F.get("__dims", F.col("__dim")).alias("__x"))
    found = _crossing(keyed, "__x", wanted)
    at_value = _values(at, "__node int, __value bigint", [(n, f[0]) for n, f in found.items()])
    tied = keyed.join(at_value, "__node").filter(F.col("__x") == F.col("__value"))
    ends = tied.groupBy("__node").agg(F.min("__row").alias("lo"), F.max("__row").alias("hi")).collect()
    among = {r["__node"]: (r["lo"], r["hi"], found[r["__node"]][1]) for r in ends}
    # the row that crosses goes to the side that it leaves nearer to its share
    return {n: (found[n][0], row if 2 * need >= held else row - 1) for n, (row, need, held) in _crossing(tied, "__row", among).items()}


def _crossing(rows: DataFrame, column: str, wanted: dict[int, tuple[int, int, float]]) -> dict[int, tuple[int, float, int]]:
    """For each box the value at which its bytes reach what it needs, what is still
    needed from that value on, and the bytes that the value holds."""
    state = {n: (lo, hi, need, 0) for n, (lo, hi, need) in wanted.items()}
    while True:
        steps = {n: (hi - lo) // BINS + 1 for n, (lo, hi, *_) in state.items()}
        table = _values(
            rows,
            "__node int, __lo bigint, __hi bigint, __step bigint, __need double",
            [(n, lo, hi, steps[n], float(need)) for n, (lo, hi, need, _) in state.items()],
        )
        inside = rows.join(table, "__node").filter(F.col(column).between(F.col("__lo"), F.col("__hi")))
        bins = inside.groupBy("__node", F.expr(f"({column} - __lo) div __step").alias("__bin")).agg(
            F.sum("size").alias("held"), F.first("__need").alias("need")
        )
        upto = F.sum("held").over(Window.partitionBy("__node").orderBy("__bin"))
        total = F.sum("held").over(Window.partitionBy("__node")).cast("double")
        hit = (
            bins.withColumn("upto", upto)
            .withColumn("goal", F.least("need", total))
            .filter((F.col("upto") >= F.col("goal")) & (F.col("upto") - F.col("held") < F.col("goal")))
            .collect()
        )
        for r in hit:
            lo, hi, *_ = state[r["__node"]]
            start = lo + r["__bin"] * steps[r["__node"]]
            rest = r["goal"] - (r["upto"] - r["held"])
            state[r["__node"]] = (start, min(hi, start + steps[r["__node"]] - 1), rest, r["held"])
        if max(steps.values()) == 1:
            return {n: (lo, rest, held) for n, (lo, _, rest, held) in state.items()}


def _slots(rows: DataFrame, id_col: str) -> DataFrame:
    """Gapless numbers within each shard; a window sees one block of rows of one shard."""
    rows = rows.withColumnRenamed("__node", "shard").withColumn("__block", F.shiftright("__row", SLOT_BITS))
    held = rows.groupBy("shard", "__block").agg(F.count(F.lit(1)).alias("__held"))
    before = Window.partitionBy("shard").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = held.select("shard", "__block", F.coalesce(F.sum("__held").over(before), F.lit(0)).alias("__start"))
    within = F.row_number().over(Window.partitionBy("shard", "__block").orderBy("__row"))
    numbered = rows.withColumn("__within", within).join(starts, ["shard", "__block"])
    slot = (F.col("__start") + F.col("__within") - 1).cast("long").alias("slot")
    return numbered.select(id_col, "size", "text_crc32", "shard", slot)


def write_shards(docs: DataFrame, placed: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """The documents as Parquet, a folder for each shard."""
    docs.join(placed.select(id_col, "shard", "slot"), id_col).write.partitionBy("shard").parquet(path)
