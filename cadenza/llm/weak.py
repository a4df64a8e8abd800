"""A quality classifier without hand labels.

Overlapping heuristic labellers vote good, bad or nothing on every document. Documents with
the same votes are alike to the label model, so the corpus is counted by vote pattern, at
most 3^labellers rows, and expectation-maximisation over these counts estimates how each
labeller votes on good and on bad documents. The posteriors are the soft labels of a hashed
linear scorer, which is fitted on a bounded sample and judges every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import giving_back, stored
from cadenza.llm.grams import BYTE_ANY_CASE, SPACE, Spans, chunks, word_spans
from cadenza.llm.hashed import Linear, feature_rows, fit_linear, softmax

GOOD, BAD, NONE = 1, -1, 0

_KIND = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "stop": b".?;:",
    "comma": b",",
    "shout": b"!",
    "markup": b"<>[\\]^{|}~",
    "symbol": b"#$%&*+<=>@[\\]^_`{|}~/",
}


def text_counts(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Per document: bytes of each kind, words, words equal to the one before, distinct words
    and distinct three-word windows."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    out = {}
    for name, members in _KIND.items():
        flag = np.zeros(256, bool)
        flag[list(members)] = True
        out[name] = np.bincount(doc[flag[data]], minlength=n)
    out["other"] = np.bincount(doc[data >= 128], minlength=n)
    out["solid"] = np.bincount(doc[~SPACE[data]], minlength=n)
    starts, ends, word_doc = word_spans(data, offsets)
    word = Spans(data, BYTE_ANY_CASE).hash(starts, ends)
    out["words"] = held = np.bincount(word_doc, minlength=n)
    first = np.concatenate([[0], np.cumsum(held)])
    with np.errstate(over="ignore"):
        triple = word[:-2] * np.uint64(3) + word[1:-1] * np.uint64(5) + word[2:] * np.uint64(7) if len(word) > 2 else word[:0]
    windows, distinct, different = np.maximum(held - 2, 0), np.zeros(n, np.int64), np.zeros(n, np.int64)
    for d in np.flatnonzero(held):
        different[d] = len(np.unique(word[first[d] : first[d + 1]]))
        if windows[d]:
            distinct[d] = len(np.unique(triple[first[d] : first[d + 1] - 2]))
    same = (word[1:] == word[:-1]) & (word_doc[1:] == word_doc[:-1])
    out["stutter"] = np.bincount(word_doc[1:][same], minlength=n)
    return out | {"windows": windows, "distinct": distinct, "different": different}


#: Limits of the bins of each measure; a document shows one bin of each to the scorer.
BINS = (0.001, 0.003, 0.01, 0.03, 0.06, 0.1, 0.2, 0.3, 0.4, 0.5, 0.7, 0.9, 0.95, 0.98, 0.99, 1.5, 2.5, 3.5, 5.0, 7.5, 12.0)


def measures(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """What the labellers look at, each a ratio."""

    def share(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a / np.maximum(b, 1)

    letters = c["upper"] + c["lower"] + c["other"]
    return {
        "symbols": share(c["symbol"], c["words"]),
        "markup": share(c["markup"], c["words"]),
        "shouts": share(c["shout"], c["words"]),
        "capitals": share(c["upper"], letters),
        "sentences": share(c["stop"], c["words"]),
        "repeats": share(c["windows"] - c["distinct"], c["windows"]),
        "stutter": share(c["stutter"], c["words"]),
        "vocabulary": share(c["different"], c["words"]),
        "word_length": share(c["solid"], c["words"]),
        "prose": share(letters + c["comma"] + c["stop"], c["solid"]),
    }


def measure_bins(c: dict[str, np.ndarray]) -> np.ndarray:
    """Documents by measures: the number of the bin."""
    return np.stack([np.digitize(m, BINS) + k * (len(BINS) + 1) for k, m in enumerate(measures(c).values())], axis=1)


def votes(c: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The labellers: for each document bad, good, or nothing where it is too short to tell."""

    def judge(bad: np.ndarray, told: np.ndarray) -> np.ndarray:
        return np.where(~told, NONE, np.where(bad, BAD, GOOD)).astype(np.int8)

    m, any_, some, many = measures(c), c["words"] > 0, c["words"] >= 8, c["words"] >= 30
    return {
        "symbols": judge(m["symbols"] > 0.3, any_),
        "markup": judge(m["markup"] > 0.2, any_),
        "shouts": judge(m["shouts"] > 0.2, any_),
        "capitals": judge(m["capitals"] > 0.4, some),
        "sentences": judge((m["sentences"] < 0.01) | (m["sentences"] > 0.5), many),
        "repeats": judge(m["repeats"] > 0.4, some),
        "stutter": judge(m["stutter"] > 0.3, some),
        "vocabulary": judge(c["different"] < 2 * np.sqrt(c["words"]), many),
        "word_length": judge((m["word_length"] < 2.5) | (m["word_length"] > 12), some),
        "prose": judge(m["prose"] < 0.85, any_),
    }


LABELLERS = ("symbols", "markup", "shouts", "capitals", "sentences", "repeats", "stutter", "vocabulary", "word_length", "prose")


def _vote_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, data, offsets in chunks(batch, "text"):
            cast = np.stack([v + 1 for v in votes(text_counts(data, offsets)).values()], axis=1)
            code = cast.astype(np.int64) @ 3 ** np.arange(cast.shape[1])
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(code.astype(np.int32))], ["tag", "votes"])


@dataclass
class LabelModel:
    """The share of good documents, and how each labeller votes on bad and on good ones."""

    good: float
    table: np.ndarray  # labeller, class, vote; 1 where none is cast
    patterns: np.ndarray
    posterior: np.ndarray

    def accuracy(self) -> dict[str, float]:
        """Of the votes that a labeller casts, the expected part that is right."""
        right = self.table[:, 0, 0] * (1 - self.good) + self.table[:, 1, 2] * self.good
        return dict(zip(LABELLERS, right.tolist(), strict=True))


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, smooth: float = 0.5, false_bad: float = 0.02) -> LabelModel:
    """Expectation-maximisation over pattern counts, started from any vote for bad.

    A labeller that cannot tell says nothing. Each is held to be a cautious one: on good
    documents it votes bad in at most ``false_bad`` of the cases. Without that, labellers of
    one kind of fault, which agree among themselves, would outvote all the others.
    """
    cast = patterns[:, None] // 3 ** np.arange(len(LABELLERS)) % 3
    posterior = np.where((cast == 0).any(axis=1), 0.1, 0.9)
    for _ in range(rounds):
        weight = np.stack([counts * (1 - posterior), counts * posterior])
        good = weight[1].sum() / counts.sum()
        table = np.empty((len(LABELLERS), 2, 3))
        for k in range(len(LABELLERS)):
            for y in range(2):
                bad, _, fine = np.bincount(cast[:, k], weight[y], minlength=3) + smooth
                rate = bad / (bad + fine)
                table[k, y] = (min(rate, false_bad) if y else rate), 1, 1 - (min(rate, false_bad) if y else rate)
        logs = np.log(table)
        score = sum(logs[k, 1, cast[:, k]] - logs[k, 0, cast[:, k]] for k in range(len(LABELLERS)))
        logit = score + np.log(max(good, 1e-9)) - np.log(max(1 - good, 1e-9))
        fresh = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        settled = np.abs(fresh - posterior).max() < 1e-6
        posterior = fresh
        if settled:
            break
    return LabelModel(float(good), table, patterns, posterior)


@dataclass(frozen=True)
class Settings:
    """``sample_rows`` bounds the fit of the scorer; documents under ``threshold`` are rejected."""

    sample_rows: int = 2500
    threshold: float = 0.5


@dataclass
class Quality:
    labels: LabelModel
    scorer: Linear


def fit(docs: DataFrame, id_col: str, text_col: str, settings: Settings = Settings()) -> Quality | None:
    """Label model over all documents, scorer on those whose hashed text is smallest.

    Half of the sample is drawn from patterns that the label model finds bad, as far as
    there are as many.
    """
    tagged = docs.filter(F.length(F.trim(text_col)) > 0).select(F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text"))
    cast = stored(tagged.mapInArrow(giving_back(_vote_rows), "tag long, votes int"), "weak-votes")
    counted = cast.groupBy("votes").count().collect()
    if not counted:
        return None
    counted.sort()
    labels = fit_labels(np.array([r["votes"] for r in counted]), np.array([r["count"] for r in counted], float))
    posterior = dict(zip(labels.patterns.tolist(), labels.posterior.tolist(), strict=True))
    bad = [v for v, p in posterior.items() if p < 0.5]
    some = None
    for part in (F.col("votes").isin(bad), ~F.col("votes").isin(bad)):
        half = cast.filter(part).distinct().orderBy("tag").limit(settings.sample_rows // 2)
        some = half if some is None else some.unionByName(half)
    texts = tagged.join(some, "tag").groupBy("tag", "votes").agg(F.min("text").alias("text"))
    extra = lambda data, offsets: measure_bins(text_counts(data, offsets))
    rows = texts.mapInArrow(feature_rows("text", "tag", "votes", extra=extra), "tag long, votes int, shown binary, extra binary").collect()
    rows.sort(key=lambda r: r["tag"])
    shown = [np.frombuffer(r["shown"], np.int32) for r in rows]
    bins = np.array([np.frombuffer(r["extra"], np.int32) for r in rows])
    good = np.array([posterior[r["votes"]] for r in rows])
    return Quality(labels, fit_linear(shown, np.stack([1 - good, good], axis=1), bins, len(LABELLERS) * (len(BINS) + 1)))


def classify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: Sequence[str] = (), settings: Settings = Settings()
) -> DataFrame:
    """One row per document: id, ``carry``, ``quality`` (0 to 1), ``kept``.

    A null or blank text has quality 0 and is rejected. Every row is judged on its whole
    text alone, so equal texts get equal answers. An empty table gives an empty table.
    """
    names = list(dict.fromkeys([id_col, *carry]))
    model = fit(docs, id_col, text_col, settings)
    # a text that is carried travels to the tasks once
    text = text_col if text_col in names else "__text"
    rows = docs.select(*[F.col(f"`{c}`") for c in names], *([F.col(text_col).alias(text)] if text not in names else []))
    if model is None:
        return rows.select(*names, F.lit(0.0).alias("quality"), F.lit(False).alias("kept"))
    scorer = model.scorer
    shape = T.StructType([rows.schema[c] for c in names]).add("quality", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in chunks(batch, text):
                good = softmax(scorer.logits(data, offsets, measure_bins(text_counts(data, offsets))))[:, 1]
                solid = np.concatenate([[0], np.cumsum(~SPACE[data])])
                good = np.where(solid[offsets[1:]] > solid[offsets[:-1]], good, 0.0)
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(names)], pa.array(good)], [*names, "quality"])

    return rows.mapInArrow(giving_back(run), shape).withColumn("kept", F.col("quality") >= settings.threshold)
