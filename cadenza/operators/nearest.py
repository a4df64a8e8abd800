"""The nearest entry of each text by edit distance: down a tree of all entries at once.

Entries that begin alike share the rows of the edit distance for what they share. So the
sorted entries of a block make a tree of characters, and the texts of a batch go down it
together: one array holds the rows of many (text, node), each as wide as the edits allow.
A row is left as soon as no entry below it can be near, or as near as what was found, by edits
so far and lengths. Where a node has one entry left, the counts of characters are compared
before going on.

Texts and entries are dealt in blocks, each pair of blocks is a unit of one task, and a task
holds the tree of one unit at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The kernel travels with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of a block, and its texts (fewer, where that gives work to all tasks).
BLOCK, TEXTS, FEW_TEXTS = 3 << 20, 1 << 14, 1 << 8
#: Texts that go down together at most, and cells of rows that are worked on at a time.
TOGETHER, CELLS = 1 << 12, 1 << 21
#: Cells of a row that are worked on one by one, each for all rows.
NARROW = 48
_EPS = 1e-9


def near_entries(texts: DataFrame, entries: DataFrame, floor: float) -> DataFrame:
    """``query``, ``entry`` and ``edits`` of the best valid entry in each block of entries, for texts with one at a ratio of ``floor``.

    ``texts`` has distinct ``query`` with ``strange``, ``entries`` distinct ``entry``; none is
    empty. Both are counted first, so they had better be written. Valid is what shares a
    3-gram, or a 2-gram with a strange query. Of equal ratios the smallest entry is the best.
    """
    spark = texts.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    across = _blocks(entries, "entry", sys.maxsize, 1)
    # a tree is built for each unit, so there are no more of them than keep all cores at work
    down = _blocks(texts, "query", TEXTS, -(-3 * spark.sparkContext.defaultParallelism // across))
    own = "pmod(xxhash64({}), {})"
    e_units = f"explode(transform(sequence(0, {down - 1}), x -> x * {across} + {own.format('entry', across)})) AS unit"
    q_units = f"explode(transform(sequence(0, {across - 1}), x -> x + {own.format('query', down)} * {across})) AS unit"
    e = entries.selectExpr("entry AS text", "false AS asked", "false AS strange", e_units)
    q = texts.selectExpr("query AS text", "true AS asked", "strange", q_units)
    dealt = e.unionByName(q).repartitionById(min(tasks, down * across), F.expr(f"int(unit % {tasks})")).sortWithinPartitions("unit", "asked", "text")

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, asked, strange in _units(batches):
            q, e, edits = best_of(held, asked, strange, floor)
            picked = [pa.array([asked[i] for i in q], pa.string()), pa.array([held[i] for i in e], pa.string()), pa.array(edits, pa.int32())]
            yield pa.RecordBatch.from_arrays(picked, ["query", "entry", "edits"])

    return dealt.mapInArrow(near, "query string, entry string, edits int")


def _blocks(texts: DataFrame, column: str, most: int, wanted: int) -> int:
    """How many blocks: enough for their sizes, and up to ``wanted`` if they don't get too small."""
    held, size = texts.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length(column)), F.lit(0))).first()
    return max(1, -(-held // most), -(-size // BLOCK), min(wanted, -(-held // FEW_TEXTS)))


def _units(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[list[str], list[str], list[bool]]]:
    """Entries, texts and whether these are strange, of each unit of sorted rows that has both."""
    unit, entries, asked, strange = None, [], [], []
    for batch in batches:
        each = batch.column(batch.schema.get_field_index("unit")).to_numpy()
        cuts = np.flatnonzero(each[1:] != each[:-1]) + 1
        for low, high in zip([0, *cuts], [*cuts, len(each)]):
            if low == high:
                continue
            if each[low] != unit:
                if entries and asked:
                    yield entries, asked, strange
                unit, entries, asked, strange = each[low], [], [], []
            part = batch.slice(low, high - low)
            text, mine, odd = (part.column(part.schema.get_field_index(c)).to_pylist() for c in ("text", "asked", "strange"))
            upto = sum(not x for x in mine)
            entries += text[:upto]
            asked += text[upto:]
            strange += odd[upto:]
    if entries and asked:
        yield entries, asked, strange


def best_of(entries: list[str], texts: list[str], strange: list[bool], floor: float) -> tuple[list[int], list[int], list[int]]:
    """Numbers of texts, each with that of its best valid entry and the edits. ``entries`` are sorted."""
    tree, out = Tree(entries), ([], [], [])
    by_length = sorted(range(len(texts)), key=lambda i: len(texts[i]))
    first = 0
    while first < len(by_length):
        shortest = len(texts[by_length[first]])
        longest = shortest + 8 + shortest // 8
        some = by_length[first : first + max(1, min(TOGETHER, CELLS // (4 * longest)))]
        some = [i for i in some if len(texts[i]) <= longest]
        first += len(some)
        asked = [texts[i] for i in some]
        q, e, edits = _Descent(tree, asked, floor, lambda a, b: _share_a_gram(asked[a], entries[b], strange[some[a]])).run()
        for column, values in zip(out, ([some[i] for i in q.tolist()], e.tolist(), edits.tolist())):
            column.extend(values)
    return out


def _share_a_gram(query: str, entry: str, strange: bool) -> bool:
    query, entry = f"-{query}-", f"-{entry}-"
    return any(query[i : i + size] in entry for size in ((3, 2) if strange else (3,)) for i in range(len(query) - size + 1))


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all texts, and how many each has."""
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return points, np.array([len(t) for t in texts], np.int64)


def _counted(points: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Four words of 64 bits for each text: bit ``c`` of word ``t`` tells of more than ``t`` characters of class ``c``.

    An inserted or a deleted character sets or clears one of them at most, a replaced one both.
    """
    out = np.zeros((len(sizes), 4), np.uint64)
    ends = np.cumsum(sizes)
    kind = (points * np.uint32(0x9E3779B1)) >> np.uint32(26)
    for low in range(0, len(sizes), TOGETHER):
        some = sizes[low : low + TOGETHER]
        at = np.repeat(np.arange(len(some)), some) * 64 + kind[ends[low] - sizes[low] : ends[low + len(some) - 1]]
        counts = np.bincount(at, minlength=64 * len(some)).reshape(-1, 64)
        for t in range(4):
            out[low : low + len(some), t] = np.packbits(counts > t, axis=1).view(np.uint64)[:, 0]
    return out


class Tree:
    """The characters of sorted, distinct, non-empty texts. A node with one text is a leaf, whose rest is read from the text."""

    def __init__(self, texts: list[str]) -> None:
        points, self.sizes = _codes(texts)
        self.bits = _counted(points, self.sizes)
        self.known = np.unique(points)
        kind = np.uint8 if len(self.known) < 250 else np.uint32
        #: Characters by number from 1 on; 0 stands for any other.
        self.codes = (np.searchsorted(self.known, points) + 1).astype(kind)
        self.starts = np.cumsum(self.sizes) - self.sizes
        held: dict[str, list[np.ndarray]] = {x: [] for x in ("char", "depth", "low", "high", "entry", "leaf", "parent")}
        alive, parent = np.arange(len(texts)), np.zeros(len(texts), np.int64)
        depth, nodes = 0, 1
        while len(alive):
            char = self.codes[self.starts[alive] + depth]
            new = np.ones(len(alive), bool)
            new[1:] = (char[1:] != char[:-1]) | (parent[1:] != parent[:-1])
            at = np.flatnonzero(new)
            number = np.cumsum(new) - 1
            depth += 1
            size, count = self.sizes[alive], np.diff([*at, len(alive)])
            # a text that ends here comes before those that go on
            ends = (size[at] == depth) | (count == 1)
            for name, value in (("char", char[at]), ("depth", np.full(len(at), depth)), ("low", np.minimum.reduceat(size, at)), ("high", np.maximum.reduceat(size, at)), ("entry", np.where(ends, alive[at], -1)), ("leaf", count == 1), ("parent", parent[at])):
                held[name].append(value)
            on = (count[number] > 1) & (size > depth)
            alive, parent = alive[on], (nodes + number)[on]
            nodes += len(at)
        joined = {name: np.concatenate([[0], *each]) for name, each in held.items()}
        self.char, self.leaf = joined["char"].astype(kind), joined["leaf"].astype(bool)
        self.depth, self.low, self.high, self.entry = (joined[x].astype(np.int32) for x in ("depth", "low", "high", "entry"))
        self.kids = np.bincount(joined["parent"][1:], minlength=nodes).astype(np.int64)
        # nodes are in the order of their parents
        self.first = np.cumsum(self.kids) - self.kids + 1


class _Descent:
    """A batch of texts on its way down. Row ``k`` of a text has a cell for each of its places from ``k - d`` to ``k + d``."""

    def __init__(self, tree: Tree, texts: list[str], floor: float, valid: Callable[[int, int], bool]) -> None:
        self.tree, self.valid = tree, valid
        points, sizes = _codes(texts)
        self.bits = _counted(points, sizes)
        #: One minus the ratio that each text asks for: first the floor, then what was found.
        self.slack = np.full(len(texts), 1 - floor)
        self.most = np.floor((1 - floor) * np.floor(sizes / floor + _EPS) + _EPS).astype(np.int32)
        self.d = d = int(self.most.max())
        self.width, self.dead = 2 * d + 1, d + 1
        self.kind = np.int8 if d <= 30 else np.int16 if d <= 8000 else np.int32
        self.sizes = sizes.astype(np.int32)
        self.stride = int(sizes.max()) + 3 * d + 2
        codes = np.searchsorted(tree.known, points).clip(max=len(tree.known) - 1)
        codes = np.where(tree.known[codes] == points, codes + 1, 0)
        self.codes = np.zeros(self.stride * len(texts) + self.width, tree.codes.dtype)
        within = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        self.codes[np.repeat(np.arange(len(texts)) * self.stride + d, sizes) + within] = codes
        none = np.zeros(0, np.int64)
        #: The best valid entry of each text that has one.
        self.best = (none, none, none)
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def run(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        most = max(1, CELLS // self.width)
        q = np.arange(len(self.sizes))
        row = np.minimum(np.where(np.arange(self.width) < self.d, self.dead, np.arange(self.width) - self.d), self.dead).astype(self.kind)
        work = [(q, np.zeros(len(q), np.int64), np.repeat(row[:, None], len(q), axis=1))]
        while work:
            q, node, rows = work.pop()
            # small pieces go on together
            while work and len(q) + len(work[-1][0]) <= most // 16:
                other = work.pop()
                q, node, rows = np.concatenate([q, other[0]]), np.concatenate([node, other[1]]), np.concatenate([rows, other[2]], axis=1)
            upto = np.cumsum(self.tree.kids[node])
            if upto[-1] > most and len(q) > 1:
                cut = max(1, int(np.searchsorted(upto, most, side="right")))
                if cut < len(q):
                    work.append((q[cut:], node[cut:], rows[:, cut:].copy()))
                    q, node, rows = q[:cut], node[:cut], rows[:, :cut]
            q, node, rows = self._below(q, node, rows)
            if len(q):
                work.append((q, node, rows))
            if self.waiting >= most // 2:
                self._finish()
            elif sum(len(x[0]) for x in self.found) >= most // 2:
                self._settle()
        self._finish()
        return self.best

    def _below(self, q: np.ndarray, node: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All rows one character on; what is left of them, without leaves."""
        tree, kids = self.tree, self.tree.kids[node]
        parent = np.repeat(np.arange(len(q)), kids)
        kid = np.repeat(tree.first[node] - np.cumsum(kids) + kids, kids) + np.arange(len(parent))
        q = q[parent]
        rows = self._step(rows[:, parent], q * self.stride + tree.depth[kid] - 1, tree.char[kid])
        n, high = self.sizes[q], tree.high[kid]
        may = self._least(rows, n - high, n - tree.low[kid]) <= self._allowed(q, n, high)
        q, kid, rows = q[may], kid[may], rows[:, may]
        entry, leaf = tree.entry[kid], tree.leaf[kid]
        if (at := np.flatnonzero(leaf)).size:
            at = at[self._alike(q[at], entry[at])]
            self.leaves.append((q[at], entry[at], tree.depth[kid[at]], rows[:, at]))
            self.waiting += len(at)
        if (at := np.flatnonzero((entry >= 0) & ~leaf)).size:
            self._ended(q[at], entry[at], rows[:, at])
        on = tree.kids[kid] > 0
        return q[on], kid[on], rows[:, on]

    def _finish(self) -> None:
        """Follow what waits at the leaves to the ends of their texts."""
        tree = self.tree
        if not self.waiting:
            return self._settle()
        q, entry, depth = (np.concatenate([x[i] for x in self.leaves]) for i in range(3))
        rows = np.concatenate([x[3] for x in self.leaves], axis=1)
        self.leaves, self.waiting = [], 0
        while len(q):
            over = depth == tree.sizes[entry]
            if over.any():
                self._ended(q[over], entry[over], rows[:, over])
                q, entry, depth, rows = q[~over], entry[~over], depth[~over], rows[:, ~over]
            rows = self._step(rows, q * self.stride + depth, tree.codes[tree.starts[entry] + depth])
            depth = depth + 1
            n, m = self.sizes[q], tree.sizes[entry].astype(np.int32)
            may = self._least(rows, n - m, n - m) <= self._allowed(q, n, m)
            q, entry, depth, rows = q[may], entry[may], depth[may], rows[:, may]
        self._settle()

    def _settle(self) -> None:
        """Of what was found, the best valid entry of each text; from now on nothing farther is followed."""
        if not self.found:
            return
        q, entry, edits = (np.concatenate([held, *(x[i] for x in self.found)]) for i, held in enumerate(self.best))
        known = np.arange(len(q)) < len(self.best[0])
        away = edits / np.maximum(self.sizes[q], self.tree.sizes[entry])
        order = np.lexsort((entry, away, q))
        first = np.flatnonzero(np.diff(q[order], prepend=-1))
        picked = []
        for low, high in zip(first.tolist(), [*first[1:].tolist(), len(order)]):
            good = (k for k in order[low:high] if known[k] or self.valid(int(q[k]), int(entry[k])))
            if (k := next(good, None)) is not None:
                picked.append(k)
        picked = np.array(picked, np.int64)
        self.best, self.found = (q[picked], entry[picked], edits[picked]), []
        self.slack[q[picked]] = away[picked]

    def _allowed(self, q: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """The edits that leave the ratio that is asked for, from entries of ``m`` characters at most."""
        return np.minimum(np.floor(self.slack[q] * np.maximum(n, m) + _EPS), self.most[q])

    def _step(self, rows: np.ndarray, at: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The next row of each: ``at`` is where the character of its first cell is."""
        if self.width > NARROW:
            unlike = self.codes[at + np.arange(self.width)[:, None]] != char
            out = rows + unlike
            out[:-1] = np.minimum(out[:-1], rows[1:] + 1)
            place = np.arange(self.width, dtype=self.kind)[:, None]
            return np.minimum(np.minimum.accumulate(out - place, axis=0) + place, self.dead).astype(self.kind)
        out, one = np.empty_like(rows), self.kind(1)
        for j in range(self.width):
            np.add(rows[j], self.codes[j:].take(at) != char, out=out[j], casting="unsafe")
            if j + 1 < self.width:
                np.minimum(out[j], rows[j + 1] + one, out=out[j])
            if j:
                np.minimum(out[j], out[j - 1] + one, out=out[j])
        return np.minimum(out, self.kind(self.dead), out=out)

    def _least(self, rows: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The fewest edits in all that each row leaves, for a text longer than an entry by ``low`` to ``high``."""
        far = 2 * self.d + 2
        low, high = (x.clip(-far, far).astype(self.kind) + self.kind(self.d) for x in (low, high))
        best = np.full(rows.shape[1], np.iinfo(self.kind).max, self.kind)
        for j in range(self.width):
            gap = np.maximum(low - self.kind(j), self.kind(j) - high)
            np.minimum(best, rows[j] + np.maximum(gap, self.kind(0)), out=best)
        return best

    def _alike(self, q: np.ndarray, entry: np.ndarray) -> np.ndarray:
        gone, come = np.zeros(len(q), np.int32), np.zeros(len(q), np.int32)
        for t in range(4):
            a, b = self.bits[:, t][q], self.tree.bits[:, t][entry]
            gone += np.bitwise_count(a & ~b)
            come += np.bitwise_count(b & ~a)
        return np.maximum(gone, come) <= self._allowed(q, self.sizes[q], self.tree.sizes[entry])

    def _ended(self, q: np.ndarray, entry: np.ndarray, rows: np.ndarray) -> None:
        """Entries that end here: the cell of the whole text has the edits, if it is in the row."""
        n, m = self.sizes[q], self.tree.sizes[entry]
        cell = n - m + self.d
        inside = (cell >= 0) & (cell < self.width)
        edits = rows[cell.clip(0, self.width - 1), np.arange(len(q))]
        near = inside & (edits <= self._allowed(q, n, m))
        if near.any():
            self.found.append((q[near], entry[near].astype(np.int64), edits[near].astype(np.int64)))
