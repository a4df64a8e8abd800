"""Array kernels over the bytes of a batch of texts, used inside Arrow-batched tasks.

A task sees Arrow record batches. They are cut into chunks of whole documents, and a
chunk is one byte array with document offsets; everything below works on that array, so
the memory of a task follows the chunk, not the table. A document longer than the limit is
a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time. The kernels hold some fifty bytes for each of them.
CHUNK_BYTES = 1 << 18

_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every input bit."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    _BYTE = _mixed(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))
    _LOWER = np.arange(256)
    _LOWER[65:91] += 32
    #: A random number per byte, the same for a letter in either case.
    BYTE_ANY_CASE = _BYTE[_LOWER]
    BYTE_EXACT = _BYTE
    _BASE = _U(0x9E3779B97F4A7C15 | 1)
    _KEY = _U(0xA0761D6478BD642F)
    _BASE_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True


def chunks(batch: pa.RecordBatch, text: str, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Pieces of a batch with their bytes and offsets; null texts are empty."""
    column = batch.column(batch.schema.get_field_index(text))
    if pa.types.is_string(column.type):
        column = column.cast(pa.large_string())
    elif pa.types.is_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if not n:
        return
    _, ends, body = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(body, dtype=np.uint8) if body is not None and body.size else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, n)
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


_powers = [np.ones(1, _U), np.ones(1, _U)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, kept by the task."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, _BASE_INVERSE)):
            steps = np.full(n, base, _U)
            steps[0] = 1
            with np.errstate(over="ignore"):
                _powers[i] = np.cumprod(steps, dtype=_U)
    return _powers[0][:n], _powers[1][:n]


class Spans:
    """Hashes of byte ranges of one chunk, by prefix sums: any range in constant time."""

    def __init__(self, data: np.ndarray, table: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, _U)
        with np.errstate(over="ignore"):
            np.cumsum(table[data] * up[:-1], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return _mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(_U))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the document of each."""
    solid = ~SPACE[data]
    start, end = solid.copy(), solid.copy()
    start[1:] &= ~solid[:-1]
    end[:-1] &= ~solid[1:]
    edges = offsets[1:-1]
    first = edges[edges < len(data)]
    start[first] = solid[first]
    last = edges[edges > 0] - 1
    end[last] = solid[last]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of words with A-Z lower-cased, eight bytes at a time.

    Each step mixes what came before without being linear in the bytes, so that there are no
    words made to collide, as there are for polynomials modulo a power of two.
    """
    folded = np.concatenate([_LOWER.astype(np.uint8)[data], np.zeros(8, np.uint8)])
    length, open_, at = ends - starts, np.arange(len(starts)), 0
    with np.errstate(over="ignore"):
        out = _mixed(length.astype(_U) * _BASE)
        while len(open_):
            block = folded[(starts[open_] + at)[:, None] + np.arange(8)].view("<u8").ravel()
            rest = np.minimum(length[open_] - at, 8).astype(_U)
            block = np.where(rest < 8, block & ((_U(1) << (_U(8) * (rest & _U(7)))) - _U(1)), block)
            out[open_] = _mixed(out[open_] * _BASE ^ _mixed(block + _KEY))
            at += 8
            open_ = open_[length[open_] > at]
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """For each document its distinct ``size``-word shingles, A-Z lower-cased, as sorted hashes.

    With fewer words the whole sequence is one shingle; without words there is none.
    """
    starts, ends, doc = word_spans(data, offsets)
    n = len(offsets) - 1
    held = np.bincount(doc, minlength=n)
    if not len(starts):
        return [np.zeros(0, _U)] * n
    word = word_hashes(data, starts, ends)
    first = np.concatenate([[0], np.cumsum(held)])
    whole = max(0, len(word) - size + 1)
    with np.errstate(over="ignore"):
        rolled = np.zeros(whole, _U)
        for j in range(size):
            rolled += word[j : j + whole] * _BYTE[2 * j]
        rolled = _mixed(rolled)
    out = []
    for d in range(n):
        a, b = first[d], first[d + 1]
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            with np.errstate(over="ignore"):
                own = (word[a:b] * _BYTE[1 : 2 * (b - a) : 2]).sum(dtype=_U) + _U(b - a)
            out.append(_mixed(np.array([own], _U)))
        else:
            out.append(np.zeros(0, _U))
    return out
