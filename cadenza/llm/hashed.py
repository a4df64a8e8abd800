"""Hashed presence features and linear scorers over them.

A document shows the buckets of its words (any case) and of its byte trigrams; each shown
bucket counts 1 / sqrt(number shown). Scorers are fitted on a bounded sample in the driver
and score every row in Arrow batches; their weights have a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from cadenza.llm.common import giving_back
from cadenza.llm.grams import BYTE_ANY_CASE, Spans, chunks, word_spans

BITS = 16
BUCKETS = 1 << BITS
#: Documents whose features are laid out at a time.
AT_ONCE = 64
#: Features that a step of a fit lays out at a time, whole rows of them.
FIT_AT_ONCE = 1 << 17


def shown_buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Pieces of a chunk: first document, and (document, bucket) of each feature shown, in order."""
    n = len(offsets) - 1
    starts, ends, word_doc = word_spans(data, offsets)
    word = (Spans(data, BYTE_ANY_CASE).hash(starts, ends) >> np.uint64(64 - BITS)).astype(np.int64)
    doc = np.repeat(np.arange(n), np.diff(offsets))
    wide = data.astype(np.uint32)
    tri = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - BITS) if len(data) > 2 else np.zeros(0, np.uint32)
    inside = doc[2:] == doc[:-2] if len(data) > 2 else np.zeros(0, bool)
    tri_doc, tri = doc[2:][inside] if len(data) > 2 else doc[:0], tri[inside].astype(np.int64)
    word_at, tri_at = (np.searchsorted(d, np.arange(0, n + AT_ONCE, AT_ONCE)) for d in (word_doc, tri_doc))
    for k, first in enumerate(range(0, n, AT_ONCE)):
        shown = np.zeros(AT_ONCE * BUCKETS, bool)
        w, t = slice(word_at[k], word_at[k + 1]), slice(tri_at[k], tri_at[k + 1])
        shown[(word_doc[w] - first) * BUCKETS + word[w]] = True
        shown[(tri_doc[t] - first) * BUCKETS + tri[t]] = True
        cells = np.flatnonzero(shown)
        yield first, cells >> BITS, cells & (BUCKETS - 1)


@dataclass
class Linear:
    """Weights by bucket and class, by further sign and class, and a bias.

    The logits are sums over what is shown; a further sign counts 1.
    """

    weights: np.ndarray
    extra: np.ndarray
    bias: np.ndarray

    def logits(self, data: np.ndarray, offsets: np.ndarray, extra: np.ndarray | None = None) -> np.ndarray:
        out = np.zeros((len(offsets) - 1, self.weights.shape[1]))
        for first, doc, bucket in shown_buckets(data, offsets):
            n = min(AT_ONCE, len(out) - first)
            held = np.maximum(np.bincount(doc, minlength=n), 1)
            for c in range(out.shape[1]):
                out[first : first + n, c] = np.bincount(doc, self.weights[bucket, c], minlength=n) / np.sqrt(held)
        return out + self.bias + (0 if extra is None else self.extra[extra].sum(axis=1))


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def feature_rows(text: str, *keep: str, extra=None):
    """A function for ``mapInArrow``: the columns ``keep``, the shown buckets of each text, and
    the further signs that ``extra`` finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in chunks(batch, text):
                own = []
                for first, doc, bucket in shown_buckets(data, offsets):
                    n = min(AT_ONCE, len(offsets) - 1 - first)
                    at = np.searchsorted(doc, np.arange(n + 1))
                    own += [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(at, at[1:])]
                columns = [piece.column(piece.schema.get_field_index(c)) for c in keep]
                columns.append(pa.array(own, pa.binary()))
                if extra:
                    signs = extra(data, offsets).astype(np.int32)
                    columns.append(pa.array([s.tobytes() for s in signs], pa.binary()))
                yield pa.RecordBatch.from_arrays(columns, [*keep, "shown", *(["extra"] if extra else [])])

    return giving_back(run)


def fit_linear(
    shown: list[np.ndarray],
    target: np.ndarray,
    extra: np.ndarray | None = None,
    extra_size: int = 0,
    rounds: int = 150,
    ridge: float = 1e-4,
    rate: float = 0.5,
) -> Linear:
    """Multinomial logistic regression on soft targets by full adaptive-gradient steps.

    The rows are ordered by the caller, so the result is the same in every run. Features are
    kept as one number each and laid out ``FIT_AT_ONCE`` at a time; sums are taken in the order of
    the rows, so the result does not depend on that number.
    """
    n, classes = target.shape
    further = np.zeros((n, 0), np.int64) if extra is None else BUCKETS + extra.astype(np.int64)
    known = np.zeros(BUCKETS + extra_size, bool)
    for own in shown:
        known[own] = True
    known[further.ravel()] = True
    used = np.flatnonzero(known)
    rank = np.cumsum(known, dtype=np.int32) - np.int32(1)
    size = np.array([len(s) for s in shown])
    ends = np.concatenate([[0], np.cumsum(size)])
    place = np.empty(ends[-1], np.int32)
    for own, a, b in zip(shown, ends, ends[1:]):
        place[a:b] = rank[own]
    further = rank[further].astype(np.intp)
    scale = 1 / np.sqrt(np.maximum(size, 1))
    cuts = [0]
    while cuts[-1] < n:
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(ends, ends[cuts[-1]] + FIT_AT_ONCE, "right")) - 1))
    weights, bias = np.zeros((classes, len(used))), np.log(target.mean(axis=0) + 1e-6)
    seen = np.full((classes, len(used)), 1e-8)
    for _ in range(rounds):
        gradient = np.zeros((classes, len(used)))
        off = np.empty((n, classes))
        for a, b in zip(cuts, cuts[1:]):
            at = place[ends[a] : ends[b]].astype(np.intp)
            doc, signs = np.repeat(np.arange(b - a), size[a:b]), np.repeat(np.arange(b - a), further.shape[1])
            doc, value = np.concatenate([doc, signs]), np.repeat(scale[a:b], size[a:b])
            logits = np.empty((b - a, classes))
            for c in range(classes):
                held = np.concatenate([weights[c][at] * value, weights[c][further[a:b].ravel()]])
                logits[:, c] = np.bincount(doc, held, minlength=b - a)
            off[a:b] = (softmax(logits + bias) - target[a:b]) / n
            for c in range(classes):
                np.add.at(gradient[c], at, np.repeat(off[a:b, c] * scale[a:b], size[a:b]))
                np.add.at(gradient[c], further[a:b].ravel(), np.repeat(off[a:b, c], further.shape[1]))
        gradient += ridge * weights / n
        seen += gradient**2
        weights -= rate * gradient / np.sqrt(seen)
        bias = bias - off.sum(axis=0)
    full = np.zeros((BUCKETS + extra_size, classes), np.float32)
    full[used] = weights.T
    return Linear(full[:BUCKETS], full[BUCKETS:], bias)
