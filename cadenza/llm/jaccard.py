"""N-gram Jaccard join by PartEnum signatures.

A document is the set of its distinct five-word shingles. Two sets with similarity t = 3/4
or more differ in at most (|r| + |s|) / 7 elements, so if the feature domain is cut into
partitions, all but that many of a set's partitions hold the same elements in both. The
partitions are as fine as the features: a signature is one feature, taken in one order of all
of them; the first k + 1 of a set, k being the number of differences allowed, must meet
those of any similar set. Frequent features come last in the order, where most sets never
get; which ones count as frequent decides the order, never the result.

Signatures that two sets share give candidates. Sets are first compared with the first
member of a bucket, in a large one with the member that is in most large ones; what these
links leave apart is then compared pair by pair, in buckets of at most ``BUCKET`` members.
Larger buckets serve only sets that have too few signatures outside of them, and pairs that
could be similar without their infrequent features, none of which they share there; these
are compared block by block. A candidate must pass a bound on its differences, taken from
counts of features by range; those that do are verified on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import giving_back, stored
from cadenza.llm.grams import _mixed, chunks, shingle_sets

SHINGLE = 5
#: Members that a bucket may have to be compared pair by pair.
BUCKET = 32
#: A feature is counted where a batch of documents has it so often, and frequent from FREQUENT
#: on; the most frequent ones are told to all tasks, at most MOST_FREQUENT.
OFTEN, FREQUENT, MOST_FREQUENT = 3, 24, 1 << 19
#: Of the signatures that decide, one in SPARE is enumerated beyond them.
SPARE = 16
#: A set is first compared with the leader of buckets that it shares so many signatures with.
MEETINGS = 3
#: A frequent feature's bucket is dealt to so many tasks.
SALTS = 256
#: Members of a large bucket that a task compares with as many others; so many of them are laid out at a time.
BLOCK, AT_ONCE = 1024, 64

#: Bits of the filter that picks the texts to verify, whatever their number.
FILTER_BITS = 1 << 23

_U = np.uint64
#: Signatures are cut to 48 bits; a chance meeting is one more candidate.
_CUT = _U(16)


def node_of(own: np.ndarray) -> np.uint64:
    """An identity of a set: sets with the same shingles have the same."""
    with np.errstate(over="ignore"):
        return _mixed(np.array([_mixed(own ^ _U(0x5851F42D4C957F2D)).sum(dtype=_U) + _U(len(own))], _U))[0]


def allowed(size: int) -> int:
    """Differences that a set can have with any similar set: the largest is a third larger."""
    return (size + 4 * size // 3) // 7


def signatures(own: np.ndarray, frequent: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Signatures of one set, whether each is of a frequent feature, and how many of them decide.

    ``own`` and ``frequent`` are ascending.
    """
    at = np.searchsorted(frequent, own)
    at[at == len(frequent)] = 0
    common = frequent[at] == own if len(frequent) else np.zeros(len(own), bool)
    need = allowed(len(own)) + 1
    most = need + 2 + need // SPARE
    rare = own[~common][:most]
    hot = own[common][: most - len(rare)]
    return np.concatenate([rare, hot]) >> _CUT, np.arange(len(rare) + len(hot)) >= len(rare), need


def sketch_of(own: np.ndarray) -> np.ndarray:
    """How many features are in each of equal ranges, about one range for two features."""
    bits = min(12, max(6, int(len(own)).bit_length() - 1))
    return np.minimum(np.bincount((own >> _U(64 - bits)).astype(np.int64), minlength=1 << bits), 255).astype(np.uint8)


def may_be_similar(a: np.ndarray, b: np.ndarray, n: int, m: int) -> bool:
    """False where the counts alone differ by more than similar sets can."""
    a, b = a.astype(np.int64), b.astype(np.int64)
    while len(a) > len(b):
        a = a[::2] + a[1::2]
    while len(b) > len(a):
        b = b[::2] + b[1::2]
    return 4 * min(n, m) >= 3 * max(n, m) and 7 * int(np.abs(a - b).sum()) <= n + m


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Identity and counts of each set; on the first row of a batch, the features that it has often."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size, node, sketches, fresh = [], [], [], {}
        for _, data, offsets in chunks(batch, "text"):
            for own in shingle_sets(data, offsets, SHINGLE):
                size.append(len(own))
                node.append(node_of(own) if len(own) else _U(0))
                sketches.append(sketch_of(own).tobytes() if len(own) else None)
                fresh.setdefault(int(node[-1]), own)  # copies count once
        feature, times = np.unique(np.concatenate(list(fresh.values())), return_counts=True)
        often = times >= OFTEN
        listed = pa.StructArray.from_arrays([pa.array(feature[often].view(np.int64)), pa.array(times[often].astype(np.int64))], ["feature", "times"])
        ends = np.full(len(size) + 1, len(listed), np.int32)
        ends[0] = 0
        size = np.array(size, np.int64)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                batch.column(1),
                pa.array(size),
                pa.array(np.array(node, _U).view(np.int64), mask=size == 0),
                pa.array(sketches, pa.binary()),
                pa.ListArray.from_arrays(pa.array(ends), listed),
            ],
            ["id", "tag", "n_shingles", "node", "sketch", "often"],
        )


def frequent_features(of: DataFrame) -> np.ndarray:
    """Features that are frequent by the counts of the batches, ascending; a bounded number."""
    counted = of.select(F.explode("often").alias("o")).groupBy("o.feature").agg(F.sum("o.times").alias("times"))
    most = counted.filter(F.col("times") >= FREQUENT).orderBy(F.desc("times"), "feature").limit(MOST_FREQUENT).select("feature")
    return np.sort(most.toPandas()["feature"].to_numpy(np.int64).view(_U))


def _signature_rows(frequent: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()  # copies in one task are emitted once
        for batch in batches:
            for _, data, offsets in chunks(batch, "text"):
                rows = []
                for own in shingle_sets(data, offsets, SHINGLE):
                    if not len(own) or (node := int(node_of(own).view(np.int64))) in done:
                        continue
                    done.add(node)
                    sig, hot, need = signatures(own, frequent)
                    rows.append((sig, np.where(hot, node % SALTS, -1), np.full(len(sig), node)))
                if rows:
                    sig, salt, node = (np.concatenate(x) for x in zip(*rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(sig.view(np.int64)), pa.array(salt.astype(np.int32)), pa.array(node)], ["sig", "salt", "node"]
                    )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by signature and node: one of each, where two nodes share the signature,
    with the first node of its bucket and the place in it.

    Buckets of frequent features are dealt to several tasks, pass whole and have a first
    node in each.
    """
    names = ["sig", "node", "leader", "place", "hot"]
    held = None  # the last row: whether it belongs to the signature before it, its leader and place
    for batch in batches:
        sig, salt, node = (batch.column(i).to_numpy() for i in range(3))
        if not len(sig):
            continue
        if held is not None:
            sig, salt, node = (np.concatenate([[h], x]) for h, x in zip(held, (sig, salt, node)))
        fresh = np.concatenate([[True], (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])])
        sig, salt, node = sig[fresh], salt[fresh], node[fresh]
        same = sig[1:] == sig[:-1]
        before = np.concatenate([[held is not None and held[3]], same])
        first = np.concatenate([[True], ~same])
        bucket = np.cumsum(first) - 1
        leader, start = node[first], np.flatnonzero(first)
        if held is not None:
            leader[0], start[0] = held[4], -held[5]
        leader, place = leader[bucket], np.arange(len(sig)) - start[bucket]
        keep = before | np.concatenate([same, [False]]) | (salt >= 0)
        held = sig[-1], salt[-1], node[-1], bool(before[-1]), leader[-1], int(place[-1])
        keep[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (sig, node, leader, place.astype(np.int32), salt >= 0)], names)
    if held is not None and (held[3] or held[1] >= 0):
        last = [pa.array([int(x)], pa.int64()) for x in (held[0], held[2], held[4])]
        yield pa.RecordBatch.from_arrays([*last, pa.array([held[5]], pa.int32()), pa.array([bool(held[1] >= 0)])], names)


def _meeting(most: int):
    """Of rows (sig, node, root, size, slack) sorted by signature and node: the pairs within a
    bucket of at most ``most`` members that are of about one size and in different components,
    and the smaller slack of the two."""

    def pairs(rows: list[np.ndarray]) -> pa.RecordBatch:
        sig, node, root, size, slack = rows
        start = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        members = np.diff(np.concatenate([start, [len(sig)]]))
        few = np.repeat((members > 1) & (members <= most), members)
        sig, node, root, size, slack = (x[few] for x in rows)
        found = []
        for d in range(1, most):
            a = np.flatnonzero(sig[d:] == sig[:-d])
            if not len(a):
                break
            b = a + d
            fits = (root[a] != root[b]) & (4 * size[a] >= 3 * size[b]) & (4 * size[b] >= 3 * size[a])
            found.append((node[a[fits]], node[b[fits]], np.minimum(slack[a[fits]], slack[b[fits]])))
        columns = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.int64)] * 3
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["u", "v", "x"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # rows of the last bucket; of a large one no more than tell that it is large
        for batch in batches:
            rows = [c.to_numpy() for c in batch.columns]
            if not len(rows[0]):
                continue
            if held is not None:
                rows = [np.concatenate(x) for x in zip(held, rows)]
            last = int(np.searchsorted(rows[0], rows[0][-1]))
            held = [x[last : last + most + 1].copy() for x in rows]
            if last:
                yield pairs([x[:last] for x in rows])
        if held is not None:
            yield pairs(held)

    return run


def _unlike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs that their counts do not rule out."""
    for batch in batches:
        n, m = batch.column(2).to_numpy(), batch.column(3).to_numpy()
        a, b = ([np.frombuffer(x.as_py(), np.uint8) for x in batch.column(k)] for k in (4, 5))
        keep = pa.array([may_be_similar(*row) for row in zip(a, b, n.tolist(), m.tolist())], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(keep) for k in (0, 1)], ["u", "v"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of texts whose sets are similar; equal texts on the left follow each other.

    What the hashes of shingles call similar is compared word by word.
    """
    last, own = None, None
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for i, (u, a, b) in enumerate(zip(batch.column(0), batch.column(2), batch.column(3))):
            if u != last:
                last, own = u, _set_of(a.as_py())
            other = _set_of(b.as_py())
            keep[i] = _linked(own, other) and _alike(a.as_py(), b.as_py())
        yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep)) for k in (0, 1)], ["u", "v"])


def _set_of(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    return shingle_sets(data, np.array([0, len(data)]), SHINGLE)[0]


def _linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= 75 * (len(a) + len(b) - both)


def _alike(a: str, b: str) -> bool:
    """Whether two texts link. Words are numbered as they are, so no hash takes part."""
    numbers: dict[bytes, int] = {}
    sets = []
    for text in (a, b):
        words = np.fromiter((numbers.setdefault(w, len(numbers)) for w in text.encode().lower().translate(_BLANKS).split(b" ") if w), np.int32)
        if len(words) < SHINGLE:
            words = np.concatenate([words, np.full(SHINGLE - len(words), -1, np.int32)])
        shingles = np.lib.stride_tricks.sliding_window_view(words, SHINGLE)
        sets.append(np.unique(np.ascontiguousarray(shingles).view(f"V{4 * SHINGLE}").ravel()))
    return _linked(*sets)


#: ASCII white space as blanks.
_BLANKS = bytes(32 if 9 <= b <= 13 else b for b in range(256))


def _plausible(pairs: DataFrame, sketches: DataFrame) -> DataFrame:
    a, b = (sketches.select(F.col("node").alias(c), F.col("n_shingles").alias(f"{c}_n"), F.col("sketch").alias(f"{c}_s")) for c in "uv")
    fits = 4 * F.least("u_n", "v_n") >= 3 * F.greatest("u_n", "v_n")
    sizes = pairs.join(a.drop("u_s").hint("merge"), "u").join(b.hint("merge"), "v").filter(fits)
    both = sizes.join(a.select("u", "u_s").hint("merge"), "u").select("u", "v", "u_n", "v_n", "u_s", "v_s")
    return stored(both.mapInArrow(giving_back(_unlike), "u long, v long"), "jaccard-pairs")


def _texts_of(pairs: DataFrame, of: DataFrame, rows: DataFrame) -> DataFrame:
    """One text for each node in ``pairs``.

    Texts are picked in the scan by a filter of fixed size over their hashes; few others
    pass it, and those that do are joined away.
    """
    nodes = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    reps = stored(of.join(nodes, "node").groupBy("node").agg(F.min("tag").alias("tag")), "jaccard-reps")
    slot = F.pmod("tag", F.lit(FILTER_BITS))
    words = reps.select(F.shiftright(slot, 3).cast("int").alias("byte"), slot.alias("slot"))
    words = words.groupBy("byte").agg(F.bit_or(F.expr("shiftleft(1, int(slot % 8))")).alias("bits")).collect()
    table = np.zeros(FILTER_BITS >> 3, np.uint8)
    for w in words:
        table[w["byte"]] = w["bits"]
    held = rows.sparkSession.sparkContext.broadcast(table)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.mod(batch.column(0).to_numpy(), FILTER_BITS)
            yield batch.filter(pa.array((held.value[slot >> 3] >> (slot & 7) & 1).astype(bool)))

    picked = rows.select("tag", "text").mapInArrow(giving_back(pick), "tag long, text string").groupBy("tag").agg(F.min("text").alias("text"))
    return stored(picked.join(reps.hint("merge"), "tag").select("node", "text"), "jaccard-texts")


def _verified(pairs: DataFrame, of: DataFrame, rows: DataFrame) -> DataFrame:
    texts = _texts_of(pairs, of, rows)
    a, b = (texts.select(F.col("node").alias(c), F.col("text").alias(f"{c}_text")) for c in "uv")
    both = pairs.join(a.hint("merge"), "u").join(b.hint("merge"), "v").select("u", "v", "u_text", "v_text")
    return stored(both.sortWithinPartitions("u").mapInArrow(giving_back(_similar), "u long, v long"), "jaccard-links")


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node that links reach: large star and small star in turn.

    Only minima are gathered at a node, so a component of any size is spread over the tasks.
    """
    edges = links.select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).filter("a <> b").distinct()
    edges = stored(edges, "component-edges")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(low, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a <> b").distinct(), "component-large")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(small.select("a", F.col("m").alias("b")))
        edges = stored(small.filter("a <> b").distinct(), "component-edges")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == before or not now[0]:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``id``, ``n_shingles``, ``component_id``.

    Words are runs of anything but ASCII white space, A-Z lower-cased. ``component_id`` is
    the smallest id that links of similarity 3/4 or more reach. Documents without words link with nothing. Shingles are 64-bit hashes. Rows that repeat
    are copies of each other; where all ids of a component are null, so is its id. An
    empty table gives an empty table.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text"))
    id_type = rows.schema["id"].dataType
    shape = T.StructType().add("id", id_type).add("tag", "long").add("n_shingles", "long").add("node", "long").add("sketch", "binary")
    shape.add("often", T.ArrayType(T.StructType().add("feature", "long").add("times", "long")))
    of = stored(rows.mapInArrow(giving_back(_nodes), shape), "jaccard-sets")
    frequent = frequent_features(of)
    emitted = rows.select("text").mapInArrow(giving_back(_signature_rows(frequent)), "sig long, salt int, node long")
    dealt = emitted.repartition("sig", "salt").sortWithinPartitions("sig", "node")
    shared = stored(dealt.mapInArrow(giving_back(_shared), "sig long, node long, leader long, place int, hot boolean"), "jaccard-shared")
    links = _links(shared, of, rows)
    root = components(links)
    least = of.filter(F.col("node").isNotNull()).groupBy("node").agg(F.min("id").alias("least"))
    place = least.join(root, "node", "left").withColumn("root", F.coalesce("root", "node"))
    first = place.groupBy("root").agg(F.min("least").alias("component_id"))
    named = place.join(first, "root").select(F.col("node").alias("of"), "component_id")
    out = of.select("id", "n_shingles", "node").join(named, F.col("node") == F.col("of"), "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select("id", "n_shingles", own.alias("component_id"))


def _links(shared: DataFrame, of: DataFrame, rows: DataFrame) -> DataFrame:
    """The verified links among sets that share a signature, enough to connect all that are similar."""
    sketches = of.filter(F.col("node").isNotNull()).groupBy("node").agg(F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch"))
    sketches = stored(sketches, "jaccard-sketches")
    rare, hot = shared.filter("not hot"), shared.filter("hot")
    many = hot.groupBy("sig").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BUCKET).select("sig")
    many = many.unionByName(rare.filter(F.col("place") == BUCKET).select("sig"))
    many = stored(many, "jaccard-many")
    crowded = stored(shared.select("sig", "node", "hot").join(many, "sig"), "jaccard-crowded")
    star = _star(rare, crowded)
    likely = _plausible(star, sketches)
    one = likely.groupBy("v").agg(F.min("u").alias("u")).select("u", "v")
    first = _verified(stored(one, "jaccard-first"), of, rows)
    root = components(first)
    rest = _rooted(_rooted(likely, root, "u", "ru"), root, "v", "rv").filter("ru <> rv").select("u", "v")
    linked = first.unionByName(_verified(stored(rest, "jaccard-rest"), of, rows))
    state = _state(sketches, hot, crowded, components(linked))
    few = rare.select("sig", "node").unionByName(hot.select("sig", "node").join(many, "sig", "left_anti"))
    few = few.join(state.select("node", "root", "size", "slack").hint("merge"), "node").select("sig", "node", "root", "size", "slack")
    met = few.repartition("sig").sortWithinPartitions("sig", "node").mapInArrow(giving_back(_meeting(BUCKET)), "u long, v long, x long")
    # a set whose signatures in large buckets are no more than its spare ones is found without
    # them, and shares as many others with any similar set as are left over, and one
    near = met.groupBy("u", "v").agg(F.count(F.lit(1)).alias("n"), F.max("x").alias("x")).filter("n > x").select("u", "v")
    placed = crowded.select("sig", "node", (F.row_number().over(Window.partitionBy("node").orderBy("hot", "sig")) - 1).alias("place"))
    far = _across(placed.join(state.drop("slack").hint("merge"), "node"), sketches)
    tested = star.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v"))
    cross = stored(near.unionByName(far).distinct().join(tested, ["u", "v"], "left_anti"), "jaccard-cross")
    return linked.unionByName(_verified(_plausible(cross, sketches), of, rows))


def _star(rare: DataFrame, crowded: DataFrame) -> DataFrame:
    """Pairs to compare first: the first member of a bucket beside those that meet it often, and
    in a large bucket the member that has most sets in its large buckets beside all others.

    Which pairs these are decides how soon sets are connected, never the result.
    """
    often = rare.select(F.col("leader").alias("u"), F.col("node").alias("v")).filter("u <> v")
    often = often.groupBy("u", "v").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MEETINGS).select("u", "v")
    members = crowded.groupBy("sig").agg(F.count(F.lit(1)).alias("members"))
    weight = crowded.join(members, "sig").groupBy("node").agg(F.sum("members").alias("weight"))
    centre = crowded.join(weight, "node").groupBy("sig").agg(F.max(F.struct("weight", "node")).alias("centre"))
    around = crowded.join(centre, "sig").select(F.col("centre.node").alias("u"), F.col("node").alias("v")).filter("u <> v")
    return stored(often.unionByName(around).distinct(), "jaccard-star")


def _state(sketches: DataFrame, hot: DataFrame, crowded: DataFrame, root: DataFrame) -> DataFrame:
    """For each set ``node``, ``root``, ``size`` and what its signatures leave open.

    ``slack``: how many in large buckets it can spare yet; ``lacks``: whether there are more than
    that. ``common``: features that it may share with a set that it meets in large buckets only.
    Where a set has a signature of a frequent feature, all its infrequent ones are enumerated, so
    two such sets share none of those outside of large buckets; ``open`` are sets without one.
    """
    hots = hot.groupBy("node").agg(F.count(F.lit(1)).alias("hots"))
    crowds = crowded.groupBy("node").agg(F.count(F.lit(1)).alias("crowds"), F.sum((~F.col("hot")).cast("long")).alias("rare_crowds"))
    # large buckets hold few of all sets; what is not in one gets nulls
    held = hots.join(crowds, "node", "full")
    held = sketches.select("node", F.col("n_shingles").alias("size")).join(held.hint("merge"), "node", "left")
    held = _rooted(held, root, "node", "root").fillna(0, ["hots", "crowds", "rare_crowds"])
    need, spare = _need("size"), _spare("size")
    rare = need + spare - F.col("hots") - F.col("rare_crowds")
    out = held.select(
        "node", "root", "size",
        F.greatest(spare - F.col("crowds"), F.lit(0)).alias("slack"),
        (F.col("crowds") > spare).alias("lacks"),
        # two features of a set may have one signature
        (F.col("size") - F.greatest(rare - 1, F.lit(0))).alias("common"),
        (F.col("hots") == 0).alias("open"),
    )
    return stored(out, "jaccard-state")


def _rooted(df: DataFrame, root: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with the component of a node, itself where no link reaches it."""
    known = root.select(F.col("node").alias(column), F.col("root").alias("__r"))
    return df.join(known, column, "left").withColumn(name, F.coalesce("__r", column)).drop("__r")


def _across(rows: DataFrame, sketches: DataFrame) -> DataFrame:
    """Pairs in large buckets, one of which lacks signatures outside: sets of about one size in
    different components that can have enough in common and whose counts are alike.

    Sets that share a signature outside of large buckets are found there. Similar ones have
    3/7 of their sizes in common, so both need as many ``common`` features, 3/4 of their own size
    at least. Of their signatures in large buckets, in order, the first that they share has no
    more before it in either set than can be spared: they meet there or in few others. Components
    meet first, so members of one never do.

    A bucket is cut into blocks, and two blocks are compared in one task, so a row is repeated
    once for ``BLOCK`` members of its bucket and no pair is a row before its counts are alike.
    """
    rows = rows.withColumn("common", F.when(F.col("open"), F.col("common")).otherwise(F.col("common") - F.col("place"))).drop("place")
    some = F.expr("open or 4 * common >= 3 * size")  # what is not meets only sets that are open
    of = [F.max("open").alias("all"), F.max("lacks").alias("lack"), (F.min("root") < F.max("root")).alias("apart"), F.count(F.lit(1)).alias("n"), F.count_if(some).alias("some")]
    buckets = rows.groupBy("sig").agg(*of).filter("lack and apart")
    blocks = F.ceil(F.when(F.col("all"), F.col("n")).otherwise(F.col("some")) / F.lit(BLOCK)).cast("int")
    met = rows.join(buckets.select("sig", "all", blocks.alias("blocks")), "sig").filter(F.col("all") | some)
    met = met.withColumn("own", F.pmod(F.xxhash64("node"), "blocks").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other"))
    met = met.select("node", "sig", "low", "high", "own", "root", "size", "common", "lacks", "open").join(sketches.select("node", "sketch").hint("merge"), "node")
    dealt = met.repartition("sig", "low", "high").sortWithinPartitions("sig", "low", "high")
    return dealt.mapInArrow(giving_back(_met), "u long, v long")


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs within two blocks of a bucket, of rows sorted by these."""
    held = None  # rows of the last two blocks
    for batch in batches:
        if not batch.num_rows:
            continue
        rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        keys = np.stack([rows.column(k).to_numpy() for k in ("sig", "low", "high")])
        start = np.concatenate([[0], np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1])
        for a, b in zip(start, start[1:]):
            yield from _alike_in(rows.slice(a, b - a))
        held = rows.slice(start[-1])
    if held is not None:
        yield from _alike_in(held)


def _alike_in(rows: pa.Table) -> Iterator[pa.RecordBatch]:
    """The pairs of two blocks, or of one, that have enough in common and that their counts do not rule out."""
    node, own, root, size, common, lacks, open_ = (rows.column(k).to_numpy() for k in ("node", "own", "root", "size", "common", "lacks", "open"))
    two = rows.column("low")[0] != rows.column("high")[0]
    sketch = [np.frombuffer(x.as_py(), np.uint8) for x in rows.column("sketch")]
    width = np.array([len(x) for x in sketch])
    for w in np.unique(width):
        left = np.flatnonzero(width == w)
        mine = np.stack([sketch[i] for i in left]).astype(np.int16)
        # sets of about one size have as many ranges, or one twice as many
        for wider in (w, 2 * w):
            right = np.flatnonzero(width == wider)
            if not len(right):
                continue
            theirs = mine if wider == w else np.stack([sketch[i] for i in right]).reshape(len(right), w, 2).sum(axis=2, dtype=np.int16)
            for first in range(0, len(left), AT_ONCE):
                a, b = left[first : first + AT_ONCE, None], right[None, :]
                fits = (root[a] != root[b]) & (lacks[a] | lacks[b]) & (4 * size[a] >= 3 * size[b]) & (4 * size[b] >= 3 * size[a])
                fits &= open_[a] | open_[b] | (7 * np.minimum(common[a], common[b]) >= 3 * (size[a] + size[b]))
                if wider == w:
                    fits &= a < b
                if two:
                    fits &= own[a] != own[b]
                i, j = np.nonzero(fits)
                i += first
                step = max(1, (1 << 20) // w)
                for k in range(0, len(i), step):
                    x, y = i[k : k + step], j[k : k + step]
                    apart = np.abs(mine[x] - theirs[y]).sum(axis=1, dtype=np.int64)
                    x, y = left[x], right[y]
                    near = 7 * apart <= size[x] + size[y]
                    u, v = node[x[near]], node[y[near]]
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], ["u", "v"])


def _need(size: str) -> Column:
    """Signatures of a set that decide."""
    return F.floor((F.col(size) + F.floor(4 * F.col(size) / 3)) / 7) + 1


def _spare(size: str) -> Column:
    """Signatures that a set enumerates beyond those that decide; a small one has few features."""
    return F.least(2 + F.floor(_need(size) / SPARE), F.col(size) - _need(size))
