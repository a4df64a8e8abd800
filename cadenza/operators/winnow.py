"""Substring search by winnowed anchors.

A window slides over the pieces (``k`` bytes each) of a text, and the text gives only the
piece of least hash of each window. What a window gives depends on its bytes alone, so a
text that contains a pattern of at least one window gives all that the pattern gives: one of
the pattern's own minima is enough to find it. Longer patterns have wider windows, and a
text is only cut for the classes of patterns that are asked for. Spark joins the anchors.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The kernel travels with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: (bytes of a piece, pieces of a window), widest first. A class serves patterns of at least
#: piece + window - 1 bytes; the last ones, of one piece, serve what is too short for a window.
CLASSES = ((8, 57), (8, 17), (4, 9), (4, 3), (3, 1), (2, 1), (1, 1))
#: Bytes of text that a task works on at a time; a longer text is worked on alone.
TOGETHER = 1 << 22


def least_bytes(number: int) -> int:
    """Bytes of the shortest pattern that a class serves."""
    piece, window = CLASSES[number]
    return piece + window - 1


def class_of(pattern: Column) -> Column:
    """The number of the widest class that serves a pattern; null for an empty one."""
    size = F.octet_length(pattern)
    out = F.when(size >= least_bytes(0), 0)
    for number in range(1, len(CLASSES)):
        out = out.when(size >= least_bytes(number), number)
    return out


def window_minima(texts: DataFrame, text: str, keys: Sequence[str], classes: Sequence[int], own: str | None = None) -> DataFrame:
    """``keys`` and ``anchor`` for each distinct minimum of each text and each of ``classes``.

    ``own`` names a column with the only class of a row. About ``2 / (window + 1)`` of the
    places of a long text give a row. Null texts give none.
    """
    wanted = sorted(set(classes))
    fields = [texts.schema[k] for k in keys]
    chosen = F.col(own).cast("int") if own else F.lit(-1)
    rows = texts.select(*keys, F.coalesce(F.col(text), F.lit("")).cast("binary").alias("__bytes"), chosen.alias("__own"))

    def minima(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            body, only = batch.column(len(keys)), batch.column(len(keys) + 1).to_numpy(zero_copy_only=False)
            for first, data, ends in _pieces_of_work(body):
                for number in wanted:
                    at, anchors = _minima(data, ends, number)
                    if own:
                        mine = only[first + at] == number
                        at, anchors = at[mine], anchors[mine]
                    picked = pa.array(first + at)
                    columns = [batch.column(i).take(picked) for i in range(len(keys))]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(anchors)], [*keys, "anchor"])

    return rows.mapInArrow(minima, T.StructType([*fields, T.StructField("anchor", T.LongType())]))


def _pieces_of_work(body: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of whole texts: the first one's number, the bytes, and where each text ends."""
    sizes = pc.binary_length(body).to_numpy(zero_copy_only=False).astype(np.int64)
    first = 0
    while first < len(sizes):
        upto = np.cumsum(sizes[first:])
        count = max(1, int(np.searchsorted(upto, TOGETHER, side="right")))
        data = b"".join([body[i].as_py() for i in range(first, first + count)])
        yield first, np.frombuffer(data, np.uint8), upto[:count]
        first += count


def _minima(data: np.ndarray, ends: np.ndarray, number: int) -> tuple[np.ndarray, np.ndarray]:
    """For one class the texts and the values of their window minima, each value once a text."""
    piece, window = CLASSES[number]
    places = len(data) - least_bytes(number) + 1
    if places <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    packed = np.zeros(len(data) - piece + 1, np.uint64)
    for j in range(piece):
        packed |= data[j : j + len(packed)].astype(np.uint64) << np.uint64(8 * j)
    with np.errstate(over="ignore"):  # an order of the pieces that looks random, and tells all of them apart
        packed = (packed + np.uint64(piece)) * np.uint64(0x9E3779B97F4A7C15)
        packed ^= packed >> np.uint64(32)
        least = packed * np.uint64(0xD6E8FEB86659FD93)
    width = 1
    while 2 * width <= window:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < window:
        least = np.minimum(least[: places], least[window - width : window - width + places])
    owner = np.searchsorted(ends, np.arange(places), side="right")
    inside = np.arange(places) + least_bytes(number) <= ends[owner]
    new = inside.copy()
    new[1:] &= (least[1:places] != least[: places - 1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    at = np.flatnonzero(new)
    order = at[np.lexsort((least[at], owner[at]))]
    first = np.ones(len(order), bool)
    first[1:] = (owner[order][1:] != owner[order][:-1]) | (least[order][1:] != least[order][:-1])
    order = order[first]
    return owner[order], least[order].view(np.int64) ^ np.int64(number)


def anchored(patterns: DataFrame, pattern: str) -> tuple[DataFrame, list[int]]:
    """Distinct non-empty patterns, each with one ``anchor``, and the classes in use.

    Of a pattern's minima the one that fewest patterns have is its anchor.
    """
    listed = patterns.select(pattern).distinct().withColumn("__class", class_of(F.col(pattern))).filter("__class IS NOT NULL")
    used = [r[0] for r in listed.select("__class").distinct().collect()]  # one row a class
    each = window_minima(listed, pattern, [pattern], used, own="__class")
    common = each.groupBy("anchor").agg(F.count(F.lit(1)).alias("__df"))
    rarest = F.min(F.struct("__df", "anchor")).alias("__a")
    chosen = each.join(common, "anchor").groupBy(pattern).agg(rarest)
    return chosen.select(pattern, F.col("__a.anchor").alias("anchor")), used


def containment_pairs(parts: DataFrame, part: str, wholes: DataFrame, whole: str) -> DataFrame:
    """All pairs of distinct texts where ``part``, not empty, occurs in ``whole``."""
    wanted, used = anchored(parts, part)
    texts = wholes.select(whole).distinct()
    met = window_minima(texts, whole, [whole], used).join(wanted, "anchor").select(part, whole).distinct()
    return met.filter(F.contains(F.col(whole), F.col(part)))


def contains_any(df: DataFrame, text: str, patterns: DataFrame, pattern: str, flag: str) -> DataFrame:
    """Add ``flag``: does the lower-cased ``text`` contain any lower-cased pattern.

    One plan for lists and texts of any size: a text's minima, keyed by 16 bytes, meet the
    patterns' anchors in a join, which adaptive execution splits where an anchor is common.
    Candidates are tested on the text itself, equal texts once. Which classes of patterns
    there are is looked up when this is called. Null texts contain nothing.
    """
    lowered = F.lower(F.coalesce(F.col(text), F.lit("")))
    wanted, used = anchored(patterns.select(F.lower(pattern).alias("__p")), "__p")
    key = {"__k1": F.xxhash64("__t"), "__k2": F.xxhash64(F.lit(1), "__t")}
    texts = df.select(lowered.alias("__t")).withColumns(key)
    minima = window_minima(texts, "__t", ["__k1", "__k2"], used)
    met = minima.join(wanted, "anchor").select("__k1", "__k2", "__p").distinct()
    tested = texts.join(met, ["__k1", "__k2"]).filter(F.contains("__t", "__p"))
    hits = tested.select("__k1", "__k2", F.lit(True).alias("__hit")).distinct()
    keyed = df.withColumns({"__k1": F.xxhash64(lowered), "__k2": F.xxhash64(F.lit(1), lowered)})
    return (
        keyed.join(hits, ["__k1", "__k2"], "left")
        .withColumn(flag, F.coalesce("__hit", F.lit(False)))
        .select(*[c for c in df.columns if c != flag], flag)
    )
