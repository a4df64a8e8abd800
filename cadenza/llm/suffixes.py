"""Repeated byte strings by a distributed sparse suffix array.

A string of ``SPAN`` bytes has one suffix that speaks for it: the one that starts at its
smallest ``HEAD``-byte hash. Equal strings choose the same one, so only these suffixes are
sorted, about one in a hundred bytes. A suffix is a sequence of tokens: its first ``HEAD``
bytes, the bytes after them, and the bytes before it, as far as a string around it reaches.

Sampled splitters range-partition the suffixes by these leading tokens, so a very frequent
one is spread over several buckets. Each bucket sorts its own by multikey quicksort and
finds runs; runs at a bucket's ends are compared across the boundaries. Suffixes equal in
all tokens are repeated with all that is around them. Those equal in the first only have
their surroundings fetched, and the longest agreement of each is worked out in its group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cadenza.llm.common import stored, text_or_empty
from cadenza.llm.grams import BYTE_EXACT, Spans, _mixed, chunks

SPAN = 400
HEAD = 200
REACH = SPAN - HEAD
#: Rows that are sorted by the library's sort once a segment is this short.
SHORT = 2048
#: Different surroundings of one suffix that a task compares; more are dealt out by string.
GROUP = 20_000
#: Groups of so few are compared pair by pair, larger ones by the hashes of their strings.
FEW = 32

_U = np.uint64


def chosen_starts(data: np.ndarray, offsets: np.ndarray, spans: Spans) -> np.ndarray:
    """Starts of the suffixes that speak for some string of ``SPAN`` bytes, ascending."""
    n = len(data)
    if n < SPAN:
        return np.zeros(0, np.int64)
    at = np.arange(n - HEAD + 1)
    bits = _U(int(n).bit_length())
    rank = spans.hash(at, at + HEAD) >> bits << bits | at.astype(_U)  # the leftmost of equals
    width = REACH + 1
    padded = np.full(-(-(len(rank) + width) // width) * width, ~_U(0), _U)
    padded[: len(rank)] = rank
    blocks = padded.reshape(-1, width)
    upto = np.minimum.accumulate(blocks, axis=1).ravel()
    onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    strings = n - SPAN + 1
    least = np.minimum(onward[:strings], upto[width - 1 : width - 1 + strings])
    step = np.zeros(n + 1, np.int64)
    size = np.diff(offsets)
    first, long_ = offsets[:-1], size >= SPAN
    np.add.at(step, first[long_], 1)
    np.add.at(step, (first + size - SPAN + 1)[long_], -1)
    inside = np.cumsum(step)[:strings] > 0
    return np.unique(least[inside] & ((_U(1) << bits) - _U(1))).astype(np.int64)


def _member_type(id_type: T.DataType) -> T.StructType:
    return T.StructType().add("id", id_type).add("tag", "integer").add("pos", "long")


def _suffix_rows(id_type: pa.DataType):
    """Suffixes with their tokens. Those that a batch holds several times are one row, the
    first place and ``more``, so copies are few rows before they are shuffled."""
    member = pa.struct([("id", id_type), ("tag", pa.int32()), ("pos", pa.int64())])

    def places(ids: pa.Array, tags: pa.Array, doc: np.ndarray, pos: np.ndarray) -> pa.Array:
        at = pa.array(doc)
        return pa.StructArray.from_arrays([ids.take(at), tags.take(at), pa.array(pos)], fields=list(member))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, done = [], 0
            for piece, data, offsets in chunks(batch, "text"):
                spans = Spans(data, BYTE_EXACT)
                start = chosen_starts(data, offsets, spans)
                doc = np.searchsorted(offsets, start, side="right") - 1
                low, high = offsets[doc], offsets[doc + 1]
                head = spans.hash(start, start + HEAD)
                after = spans.hash(start + HEAD, np.minimum(start + SPAN, high))
                before = spans.hash(np.maximum(start - REACH, low), start)
                found.append((doc + done, start - low, *(t.view(np.int64) for t in (head, after, before))))
                done += piece.num_rows
            doc, pos, *tokens = (np.concatenate(x) for x in zip(*found)) if found else [np.zeros(0, np.int64)] * 5
            order = np.lexsort(tokens[::-1])
            doc, pos, tokens = doc[order], pos[order], [t[order] for t in tokens]
            first = np.ones(len(order), bool)
            first[1:] = np.any([t[1:] != t[:-1] for t in tokens], axis=0)
            at = np.flatnonzero(first)
            held = np.diff(np.append(at, len(order)))
            ids, tags = batch.column(0), batch.column(1)
            more = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(held - 1)), pa.int32()), places(ids, tags, doc[~first], pos[~first]), mask=pa.array(held == 1)
            )
            one = places(ids, tags, doc[at], pos[at])
            yield pa.RecordBatch.from_arrays([one, more, pa.array(held), *[pa.array(t[at]) for t in tokens]], ["one", "more", "held", "t0", "t1", "t2"])

    return run


def multikey_quicksort(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by their tokens: three-way splits on one token after the other."""
    n = len(columns[0])
    order, out = np.arange(n), np.empty(n, np.int64)
    todo = [(order, 0, 0)]
    while todo:
        rows, place, depth = todo.pop()
        if depth == len(columns) or len(rows) < 2:
            out[place : place + len(rows)] = rows
        elif len(rows) <= SHORT:
            out[place : place + len(rows)] = rows[np.lexsort([columns[d][rows] for d in range(len(columns) - 1, depth - 1, -1)])]
        else:
            token = columns[depth][rows]
            pivot = np.sort(token[:: max(1, len(token) // 31)])[15]
            less, more = token < pivot, token > pivot
            equal = ~(less | more)
            todo.append((rows[less], place, depth))
            todo.append((rows[equal], place + int(less.sum()), depth + 1))
            todo.append((rows[more], place + int(less.sum()) + int(equal.sum()), depth))
    return out


def _runs(held: np.ndarray, *sorted_columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the run of each row, and the suffixes in that run."""
    change = np.zeros(len(held), bool)
    for c in sorted_columns:
        change[1:] |= c[1:] != c[:-1]
    number = np.cumsum(change)
    return number, np.bincount(number, held).astype(np.int64)[number]


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sort a bucket; keep suffixes whose head is repeated in it, or may be beyond its ends."""
    some = [b for b in batches if b.num_rows]
    if not some:
        return
    rows = pa.Table.from_batches(some).combine_chunks()
    tokens = [rows.column(c).to_numpy() for c in ("t0", "t1", "t2")]
    order = multikey_quicksort(tokens)
    t0, t1, t2 = (t[order] for t in tokens)
    held = rows.column("held").to_numpy()[order]
    run, same_head = _runs(held, t0)
    _, same_all = _runs(held, t0, t1, t2)
    open_ = (run == run[0]) | (run == run[-1])
    keep = np.flatnonzero(open_ | (same_head > 1))
    kept = rows.take(pa.array(order[keep]))
    for column, name in ((same_head, "heads"), (same_all, "wholes"), (open_, "open")):
        kept = kept.append_column(name, pa.array(column[keep]))
    yield from kept.to_batches()


def repeated_suffixes(docs: DataFrame) -> DataFrame:
    """Suffixes whose head occurs more than once, with ``heads`` and ``wholes``, how often."""
    id_type = docs.schema["id"].dataType
    member = _member_type(id_type)
    shape = T.StructType().add("one", member).add("more", T.ArrayType(member)).add("held", "long").add("t0", "long").add("t1", "long").add("t2", "long")
    suffixes = docs.mapInArrow(_suffix_rows(to_arrow_type(id_type)), shape)
    found = T.StructType([*shape.fields]).add("heads", "long").add("wholes", "long").add("open", "boolean")
    sorted_ = stored(suffixes.repartitionByRange("t0", "t1", "t2").mapInArrow(_bucket, found), "suffix-runs")
    closed = sorted_.filter(~F.col("open")).drop("open")
    # across boundaries: runs at the ends of buckets are counted together, by partial sums
    ends = sorted_.filter("open").select(*shape.names)
    wholes = ends.groupBy("t0", "t1", "t2").agg(F.sum("held").alias("wholes"))
    heads = wholes.groupBy("t0").agg(F.sum("wholes").alias("heads")).filter("heads > 1")
    joined = ends.join(wholes.join(heads, "t0"), ["t0", "t1", "t2"]).select(*shape.names, "heads", "wholes")
    places = F.concat(F.array("one"), F.coalesce("more", F.array().cast(shape["more"].dataType)))
    each = closed.unionByName(joined).withColumn("place", F.explode(places))
    return each.select("place.id", "place.tag", "place.pos", "t0", "t1", "t2", "heads", "wholes")


def _surroundings(id_type: pa.DataType):
    names = ["id", "tag", "pos", "t0", "before", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, tags, texts, wanted = (batch.column(k) for k in range(4))
            rows, pos, head, before, after = [], [], [], [], []
            for i in range(batch.num_rows):
                text = texts[i].as_py().encode()
                for p, t0 in ((w["pos"], w["t0"]) for w in wanted[i].as_py()):
                    rows.append(i), pos.append(p), head.append(t0)
                    before.append(text[max(0, p - REACH) : p]), after.append(text[p + HEAD : p + SPAN])
            at = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(at), tags.take(at), pa.array(pos, pa.int64()), pa.array(head, pa.int64()), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                names,
            )

    return run


def _table(own: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of bytes, padded with zeros, and their lengths."""
    size = np.array([len(b) for b in own])
    table = np.zeros((len(own), REACH), np.uint8)
    flat = np.frombuffer(b"".join(own), np.uint8)
    row = np.repeat(np.arange(len(own)), size)
    table[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return table, size


def _ladder(before: list[bytes], after: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """For each row and each number of bytes before the head, the hash of the string that
    reaches so far back; and whether the row has as many bytes."""
    n = len(before)
    sides, sizes = [], []
    for own in ([b[::-1] for b in before], after):
        table, size = _table(own)
        with np.errstate(over="ignore"):
            step = _U(0x9E3779B97F4A7C15 | 1) ** np.arange(REACH, dtype=_U)
            sums = np.zeros((n, REACH + 1), _U)
            np.cumsum(BYTE_EXACT[table] * step, axis=1, out=sums[:, 1:])
        sides.append(sums), sizes.append(size)
    back = np.arange(REACH + 1)
    with np.errstate(over="ignore"):
        key = _mixed(sides[0] + _U(3) * _mixed(sides[1][:, ::-1]))
    return key, (back <= sizes[0][:, None]) & (REACH - back <= sizes[1][:, None])


def _by_pairs(before: list[bytes], after: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The reach in a small group, by comparing its rows."""
    common = []
    for own in ([b[::-1] for b in before], after):
        table, size = _table(own)
        same = np.logical_and.accumulate(table[:, None] == table[None], axis=2).sum(axis=2)
        common.append(np.minimum(same, np.minimum(size[:, None], size)))
    enough = common[0] + common[1] >= REACH
    np.fill_diagonal(enough, False)
    return (np.where(enough, c, -1).max(axis=1) for c in common)


def _agreement(before: list[bytes], after: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The furthest reach, back and on, of a repeated string around each row's head; -1 for none."""
    if len(before) <= FEW:
        return _by_pairs(before, after)
    key, there = _ladder(before, after)
    back, on = np.full(len(before), -1), np.full(len(before), -1)
    for k in range(REACH + 1):
        rows = np.flatnonzero(there[:, k])
        _, which, count = np.unique(key[rows, k], return_inverse=True, return_counts=True)
        rows = rows[count[which] > 1]
        back[rows] = np.maximum(back[rows], k)
        on[rows] = np.maximum(on[rows], REACH - k)
    return back, on


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by head: each group is compared once it is complete."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        head = held.column("t0").to_numpy()
        done = int(np.searchsorted(head, head[-1]))
        if done:
            yield _one_by_one(held.slice(0, done))
            held = held.slice(done)
    if held is not None and held.num_rows:
        yield _one_by_one(held)


def _one_by_one(rows: pa.Table) -> pa.RecordBatch:
    head = rows.column("t0").to_numpy()
    before, after = rows.column("before").to_pylist(), rows.column("after").to_pylist()
    edges = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1], [True]]))
    back, on = np.full(len(head), -1), np.full(len(head), -1)
    for a, b in zip(edges, edges[1:]):
        if b - a == 2:
            back[a:b], on[a:b] = _pair(before[a : a + 2], after[a : a + 2])
        else:
            back[a:b], on[a:b] = _agreement(before[a:b], after[a:b])
    kept = rows.select(["id", "tag", "pos"]).append_column("back", pa.array(back)).append_column("on", pa.array(on))
    return kept.combine_chunks().to_batches()[0]


def _pair(before: list[bytes], after: list[bytes]) -> tuple[int, int]:
    """The same for two rows, by comparing them."""
    back, on = (_common(x, y) for x, y in ((before[0][::-1], before[1][::-1]), (after[0], after[1])))
    return (back, on) if back + on >= REACH else (-1, -1)


def _common(x: bytes, y: bytes) -> int:
    n = min(len(x), len(y))
    differ = np.flatnonzero(np.frombuffer(x, np.uint8, n) != np.frombuffer(y, np.uint8, n))
    return int(differ[0]) if len(differ) else n


def _ladder_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every string around every head as a row: for groups too large for one task."""
    for batch in batches:
        for a in range(0, batch.num_rows, 256):
            some = batch.slice(a, 256)
            key, there = _ladder(some.column(4).to_pylist(), some.column(5).to_pylist())
            row, back = np.nonzero(there)
            at = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [*[some.column(k).take(at) for k in range(4)], pa.array(back.astype(np.int64)), pa.array(key[row, back].view(np.int64))],
                ["id", "tag", "pos", "t0", "back", "key"],
            )


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """id, tag, first and end (exclusive) of stretches covered by repeated strings."""
    id_type = docs.schema["id"].dataType
    suffixes = stored(repeated_suffixes(docs), "suffix-repeated")
    whole = suffixes.filter("wholes > 1")
    part = suffixes.filter("wholes = 1")
    full = whole.select("id", "tag", (F.col("pos") - REACH).alias("first"), (F.col("pos") + SPAN).alias("end"))
    # what a partly repeated suffix is compared with: the others like it, and one of each full run
    heads = part.select("t0").distinct()
    one = whole.groupBy("t0", "t1", "t2").agg(F.min(F.struct("id", "tag", "pos")).alias("one"))
    mates = one.join(heads, "t0").select("one.id", "one.tag", "one.pos", "t0")
    want = part.select("id", "tag", "pos", "t0").unionByName(mates)
    per_doc = want.groupBy("id", "tag").agg(F.collect_set(F.struct("pos", "t0")).alias("wanted"))
    a, b = docs.alias("a"), per_doc.alias("b")
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.tag") == F.col("b.tag"))
    texts = a.join(b.hint("merge"), same).select("a.id", "a.tag", "a.text", "b.wanted")
    shape = T.StructType().add("id", id_type).add("tag", "integer").add("pos", "long").add("t0", "long").add("before", "binary").add("after", "binary")
    around = stored(texts.mapInArrow(_surroundings(to_arrow_type(id_type)), shape).dropDuplicates(["id", "tag", "pos"]), "suffix-surroundings")
    sizes = around.groupBy("t0").agg(F.count(F.lit(1)).alias("rows"))
    crowded = stored(sizes.filter(F.col("rows") > GROUP).select("t0"), "suffix-crowded")
    reach = T.StructType(shape.fields[:3]).add("back", "long").add("on", "long")
    small = around.join(crowded, "t0", "left_anti").select(*shape.names)
    few = small.repartition("t0").sortWithinPartitions("t0").mapInArrow(_groups, reach)
    rungs = T.StructType(shape.fields[:4]).add("back", "long").add("key", "long")
    ladder = around.join(crowded, "t0", "left_semi").select(*shape.names).mapInArrow(_ladder_rows, rungs)
    twice = ladder.groupBy("t0", "back", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    many = ladder.join(twice, ["t0", "back", "key"]).groupBy("id", "tag", "pos").agg(F.max("back").alias("back"), (REACH - F.min("back")).alias("on"))
    agreed = few.unionByName(many).filter("back >= 0")
    edges = agreed.select("id", "tag", (F.col("pos") - F.col("back")).alias("first"), (F.col("pos") + HEAD + F.col("on")).alias("end"))
    return full.unionByName(edges)


def _cut(id_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for text, ranges in zip(batch.column(1), batch.column(2)):
                body = text.as_py().encode()
                keep, at, runs = [], 0, 0
                for r in sorted((max(0, r["first"]), min(len(body), r["end"])) for r in ranges.as_py() or ()):
                    if r[0] > at or not runs:
                        keep.append(body[at : r[0]])
                        runs += 1
                    at = max(at, r[1])
                keep.append(body[at:])
                kept.append(b"".join(keep))
                spans.append(runs)
                removed.append(len(body) - len(kept[-1]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())], ["id", "n_removed", "n_spans", "kept"]
            )

    return run


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``n_removed`` bytes, ``n_spans`` runs, and ``kept``, the rest.

    Each byte covered by a string of ``SPAN`` bytes that also starts anywhere else goes, in the
    same document or another, overlaps included; strings are those of the input. Texts are
    their UTF-8 bytes, null is empty, and shorter texts lose nothing. Rows that repeat are
    copies of each other and lose alike. An empty table gives an empty table. ``kept`` may
    end within a character.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.hash(text_col).alias("tag"), text_or_empty(text_col).alias("text"))
    ranges = repeated_ranges(rows).groupBy("id", "tag").agg(F.collect_set(F.struct("first", "end")).alias("ranges"))
    a, b = rows.alias("a"), ranges.alias("b")
    same = F.col("a.id").eqNullSafe(F.col("b.id")) & (F.col("a.tag") == F.col("b.tag"))
    id_type = rows.schema["id"].dataType
    shape = T.StructType().add("id", id_type).add("n_removed", "long").add("n_spans", "long").add("kept", "binary")
    joined = a.join(b.hint("merge"), same, "left").select("a.id", "a.text", "b.ranges")
    return joined.mapInArrow(_cut(to_arrow_type(id_type)), shape)
