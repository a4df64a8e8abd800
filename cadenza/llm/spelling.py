"""Spelling variants by k-d trees over letter-count vectors.

One replaced letter raises one count by one and lowers another, one inserted letter raises
one count: the vectors of near words are at most two apart. Words of each length have a k-d
tree whose nodes are split from histograms that Spark sums, level by level, until a leaf is
small enough for one task. A word visits the leaves of its own length and of the next whose
boxes it can reach by one raise and one drop, or by one raise. In a leaf a smaller tree
prunes its boxes the same way, and what is left is verified letter by letter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.llm.common import ascii_lower, stored, text_or_empty

#: Runs of Latin letters, once A-Z are lower-cased.
RUN = "[a-zÀ-ÿ]+"
#: Dimensions: a to z, and all other letters folded into the rest. Folding and capping only
#: bring vectors nearer, so no pair is lost.
LETTERS, DIMS, CAP = 26, 32, 100
#: Words of a leaf at most where they can be told apart, and how many leaves the driver may know.
LEAF, MOST_LEAVES = 4096, 1 << 15
#: Words that are compared one by one at the end of a search.
BUCKET = 128
#: Queries that go down a tree together in a leaf.
TOGETHER = 16_384


def corpus_words(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    altered: Callable[[Column, Column], Column] | None = None,
    least_length: int = 7,
    least_count: int = 2,
) -> DataFrame:
    """``word`` and ``n``, its occurrences, for words that are long and frequent enough.

    Words are maximal runs of Latin letters of the whole texts, A-Z lower-cased; ``altered``
    may change one, given the id and the run. Counts are summed per task before they are
    shuffled. Null texts have no words.
    """
    runs = F.regexp_extract_all(ascii_lower(text_or_empty(text_col)), F.lit(RUN), F.lit(0))
    each = docs.select(F.col(id_col).alias("__id"), F.explode(runs).alias("word"))
    if altered:
        each = each.withColumn("word", altered(F.col("__id"), F.col("word")))
    counts = each.filter(F.char_length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.col("n") >= least_count)


def spelling_variants(words: DataFrame, times: int = 10) -> DataFrame:
    """One row per word: ``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n``.

    ``words`` holds distinct words and their counts ``n``. ``n_near`` counts the words that
    differ by one inserted, deleted or replaced code point. A word's form is its near word of
    largest count (ties: first in code-point order) if that count is at least ``times`` its
    own, else null; the root follows forms to the last, the word itself if it has none. Case
    and marks count as letters like any other. Null and empty words are left out, further
    columns are not read. An empty table gives an empty table.
    """
    words = stored(words.filter(F.length("word") > 0).select("word", F.col("n").cast("long").alias("n")), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near")))
    near = near_words(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    form_n = -F.col("best.less")
    counts = form_n >= F.lit(times) * F.col("n")
    judged = words.join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(counts, F.col("best.near")).alias("form"),
        F.when(counts, form_n).alias("form_n"),
    )
    judged = stored(judged, "spelling-forms")
    roots = _roots(judged.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), judged, times)
    root = F.coalesce("root", "word").alias("root")
    return judged.join(roots, "word", "left").select("word", "form", root, "n", "n_near", "form_n")


def _roots(chains: DataFrame, judged: DataFrame, times: int) -> DataFrame:
    """The end of each chain of forms. A step multiplies the count, so the largest count bounds
    the steps, and each round doubles them."""
    most = judged.agg(F.max("n")).first()[0] or 1
    steps, done = 0, 1
    while times > 1 and times ** (steps + 1) <= most:
        steps += 1
    while done < steps:
        on = chains.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        chains = stored(chains.join(on, "root", "left").select("word", F.coalesce("__next", "root").alias("root")), "spelling-roots")
        done *= 2
    return chains


def near_words(words: DataFrame) -> DataFrame:
    """Each ordered pair of words that are one edit apart: ``word``, ``near``, ``near_n``.

    ``words`` is read several times, so it should be a stored table of distinct ``word`` and ``n``.
    """
    tree, roots = _grow(words)
    return (
        words.mapInArrow(_visits(tree, roots), "leaf int, part int, home boolean, word string, n long")
        .groupBy("leaf", "part")
        .applyInArrow(_leaf_pairs, "word string, near string, near_n long")
    )


# --- letter counts --------------------------------------------------------------------


def _by_length(words: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each length the places of its words and their code points, one row a word."""
    texts = words.to_pylist()
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    for size in np.unique(sizes).tolist():
        at = np.flatnonzero(sizes == size)
        joined = "".join([texts[i] for i in at.tolist()])
        codes = np.frombuffer(joined.encode("utf-32-le"), np.uint32).reshape(len(at), size)
        yield size, at, codes


def letter_counts(codes: np.ndarray) -> np.ndarray:
    """Counts of each dimension, one row a word."""
    latin = (codes >= 97) & (codes < 97 + LETTERS)
    dims = np.where(latin, codes - 97, LETTERS + codes % (DIMS - LETTERS)).astype(np.int64)
    flat = dims + np.arange(len(codes), dtype=np.int64)[:, None] * DIMS
    counts = np.bincount(flat.ravel(), minlength=len(codes) * DIMS).reshape(len(codes), DIMS)
    return np.minimum(counts, CAP).astype(np.int8)


# --- trees ----------------------------------------------------------------------------


@dataclass
class Tree:
    """Nodes as arrays: a split ``counts[dim] <= cut`` to ``left``, else ``right``; a leaf has no
    left node. Each node has the box of its words."""

    dim: list[int] = field(default_factory=list)
    cut: list[int] = field(default_factory=list)
    left: list[int] = field(default_factory=list)
    right: list[int] = field(default_factory=list)
    low: list[np.ndarray] = field(default_factory=list)
    high: list[np.ndarray] = field(default_factory=list)
    parts: list[int] = field(default_factory=list)

    def add(self) -> int:
        """A new leaf whose box is not known yet: it takes in everything."""
        for column, value in ((self.dim, -1), (self.cut, -1), (self.left, -1), (self.right, -1), (self.parts, 1)):
            column.append(value)
        self.low.append(np.zeros(DIMS, np.int8))
        self.high.append(np.full(DIMS, CAP, np.int8))
        return len(self.dim) - 1

    def split(self, node: int, dim: int, cut: int) -> tuple[int, int]:
        self.dim[node], self.cut[node] = dim, cut
        self.left[node], self.right[node] = self.add(), self.add()
        return self.left[node], self.right[node]

    def homes(self, root: int, counts: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out, work = np.zeros(len(counts), np.int32), [(root, np.arange(len(counts)))]
        while work:
            node, at = work.pop()
            if self.left[node] < 0:
                out[at] = node
            elif len(at):
                low = counts[at, self.dim[node]] <= self.cut[node]
                work += [(self.left[node], at[low]), (self.right[node], at[~low])]
        return out

    def reached(self, root: int, counts: np.ndarray, drops: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves with the vectors that get into their boxes by one raise and ``drops`` drops."""
        work = [(root, np.arange(len(counts)))]
        while work:
            node, at = work.pop()
            own = counts[at]
            raised = np.maximum(self.low[node] - own, 0).sum(axis=1, dtype=np.int32) <= 1
            dropped = np.maximum(own - self.high[node], 0).sum(axis=1, dtype=np.int32) <= drops
            at = at[raised & dropped]
            if len(at) and self.left[node] < 0:
                yield node, at
            elif len(at):
                work += [(self.left[node], at), (self.right[node], at)]


def _grow(words: DataFrame) -> tuple[Tree, dict[int, int]]:
    """The tree over all words, and its root for each length.

    One pass over the words for each level: the tasks send counts for each open node,
    dimension and value, and the driver gets one row for each open node.
    """
    held = words.groupBy(F.char_length("word").alias("length")).count().collect()  # as many rows as lengths
    tree, most = Tree(), max(LEAF, sum(r["count"] for r in held) // MOST_LEAVES)
    roots = {r["length"]: tree.add() for r in sorted(held)}
    open_ = set(roots.values())
    while open_:
        rows = _node_rows(words, tree, roots, open_).collect()
        open_ = set()
        for r in rows:
            node = r["node"]
            for box in r["boxes"]:
                tree.low[node][box["dim"]], tree.high[node][box["dim"]] = box["low"], box["high"]
            if r["held"] > most and r["best"]["smaller"] > 0:
                open_ |= set(tree.split(node, r["best"]["dim"], r["best"]["value"]))
            else:
                tree.parts[node] = -(-r["held"] // most)  # vectors that are all the same are dealt out by hash
    return tree, roots


def _node_rows(words: DataFrame, tree: Tree, roots: dict[int, int], open_: set[int]) -> DataFrame:
    """For each open node its size, its box and the split that leaves the larger smaller side."""
    known = np.array(sorted(open_), np.int64)

    def histograms(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sums = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            for length, _, codes in _by_length(batch.column(0)):
                counts = letter_counts(codes)
                home = tree.homes(roots[length], counts).astype(np.int64)
                mine = np.isin(home, known)
                if not mine.any():
                    continue
                flat = (home[mine, None] * DIMS + np.arange(DIMS)) * (CAP + 1) + counts[mine]
                new, times = np.unique(flat, return_counts=True)
                keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
                sums = np.bincount(at, weights=np.concatenate([sums, times]), minlength=len(keys)).astype(np.int64)
        cells, value = np.divmod(keys, CAP + 1)
        columns = [(cells // DIMS).astype(np.int32), (cells % DIMS).astype(np.int32), value.astype(np.int32), sums]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["node", "dim", "value", "held"])

    parts = words.select("word").mapInArrow(histograms, "node int, dim int, value int, held long")
    values = parts.groupBy("node", "dim", "value").agg(F.sum("held").alias("held"))
    dims = Window.partitionBy("node", "dim")  # a row for each value, so as many as a word has letters at most
    upto, whole = F.sum("held").over(dims.orderBy("value")), F.sum("held").over(dims)
    sided = values.withColumns({"upto": upto, "whole": whole}).withColumn("smaller", F.least("upto", F.col("whole") - F.col("upto")))
    boxes = sided.groupBy("node", "dim").agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.max("whole").alias("held"), F.max(F.struct("smaller", "value")).alias("best")
    )
    return boxes.groupBy("node").agg(
        F.max("held").alias("held"),
        F.collect_list(F.struct("dim", "low", "high")).alias("boxes"),
        F.max(F.struct(F.col("best.smaller").alias("smaller"), "dim", F.col("best.value").alias("value"))).alias("best"),
    )


# --- searches -------------------------------------------------------------------------


def _visits(tree: Tree, roots: dict[int, int]):
    """A row for each word in its own leaf, and one for each other leaf that it may have near words in."""

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, at, codes in _by_length(batch.column(0)):
                counts = letter_counts(codes)
                home, parts = tree.homes(roots[length], counts), np.array(tree.parts, np.int32)
                spread = (codes.astype(np.int64) * np.arange(1, 2 * length, 2)).sum(axis=1)
                part = (spread % parts[home]).astype(np.int32)
                yield _visit_rows(batch, at, home, part, True)
                places = [(node, who) for node, who in tree.reached(roots[length], counts, 1)]
                if length + 1 in roots:
                    places += [(node, who) for node, who in tree.reached(roots[length + 1], counts, 0)]
                for node, who in places:
                    for k in range(tree.parts[node]):
                        away = who[(home[who] != node) | (part[who] != k)]
                        if len(away):
                            yield _visit_rows(batch, at[away], np.full(len(away), node), np.full(len(away), k), False)

    return rows


def _visit_rows(batch: pa.RecordBatch, at: np.ndarray, leaf: np.ndarray, part: np.ndarray, home: bool) -> pa.RecordBatch:
    word, n = (c.take(pa.array(at)) for c in batch.columns)
    columns = [pa.array(leaf, pa.int32()), pa.array(part, pa.int32()), pa.array([home] * len(at)), word, n]
    return pa.RecordBatch.from_arrays(columns, ["leaf", "part", "home", "word", "n"])


def _leaf_pairs(rows: pa.Table) -> pa.Table:
    """All pairs of a word of the leaf and a word that visits it, one edit apart."""
    words, n = rows["word"].combine_chunks(), rows["n"].to_numpy()
    home = rows["home"].to_numpy()
    whole = {length: (at, codes) for length, at, codes in _by_length(words)}
    own = next((length for length, (at, _) in whole.items() if home[at].any()), None)
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if own is not None:
        at, codes = whole[own]
        points, letters = at[home[at]], codes[home[at]]
        search = _Search(letters)
        for a, b in search.replaced(codes):
            left.append(at[a])
            right.append(points[b])
        if own - 1 in whole:
            at, codes = whole[own - 1]
            for a, b in search.inserted(codes):
                left += [at[a], points[b]]
                right += [points[b], at[a]]
    word, near = np.concatenate(left), np.concatenate(right)
    return pa.table({"word": words.take(pa.array(word)), "near": words.take(pa.array(near)), "near_n": pa.array(n[near], pa.int64())})


class _Search:
    """A k-d tree over the words of a leaf, all of one length."""

    def __init__(self, letters: np.ndarray):
        self.letters, self.counts = letters, letter_counts(letters)
        self.tree, self.held = Tree(), {}
        work = [(self.tree.add(), np.arange(len(letters)))]
        while work:
            node, at = work.pop()
            own = self.counts[at]
            self.tree.low[node], self.tree.high[node] = own.min(axis=0), own.max(axis=0)
            dim = int(own.var(axis=0, dtype=np.float32).argmax())
            cut = int(np.median(own[:, dim]))
            cut -= cut == own[:, dim].max()
            low = own[:, dim] <= cut
            if len(at) <= BUCKET or not low.any():
                self.held[node] = at
            else:
                a, b = self.tree.split(node, dim, cut)
                work += [(a, at[low]), (b, at[~low])]

    def _close(self, codes: np.ndarray, drops: int, apart: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Queries and words of the leaf whose vectors are ``apart`` at most, in squares."""
        for first in range(0, len(codes), TOGETHER):
            counts = letter_counts(codes[first : first + TOGETHER])
            for node, who in self.tree.reached(0, counts, drops):
                mine = self.held[node]
                q, p = counts[who].astype(np.float32), self.counts[mine].astype(np.float32)
                squares = (q * q).sum(axis=1)[:, None] + (p * p).sum(axis=1) - 2 * (q @ p.T)
                a, b = np.nonzero(squares <= apart)
                if len(a):
                    yield who[a] + first, mine[b]

    def replaced(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs that differ in one place."""
        for a, b in self._close(codes, 1, 2):
            true = (codes[a] != self.letters[b]).sum(axis=1) == 1
            yield a[true], b[true]

    def inserted(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs in which the word of the leaf has one letter more: what the two have in common
        in front and at the end covers the shorter one."""
        size = codes.shape[1]
        for a, b in self._close(codes, 0, 1):
            short, long_ = codes[a], self.letters[b]
            front = np.logical_and.accumulate(short == long_[:, :size], axis=1).sum(axis=1)
            end = np.logical_and.accumulate((short == long_[:, 1:])[:, ::-1], axis=1).sum(axis=1)
            true = front + end >= size
            yield a[true], b[true]
