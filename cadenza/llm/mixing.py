"""Mixing documents to target weights by soft membership.

A classifier fitted on a labelled table gives every document a posterior over domains, so
its tokens belong to several domains in part. Nonnegative rates, one per document, are
fitted by projected-gradient least squares until the expected tokens of the domains,
sum(rate * tokens * posterior), meet the targets. The rates live with the documents: what
passes through the driver in a step is one number per domain, and a rate follows from the
posterior and the numbers of the earlier steps.

A domain of weight 0 is not mixed but left out: a document that belongs to such domains for
the most part has rate 0, and only the others are fitted to the targets.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import giving_back, stored
from cadenza.llm.grams import BYTE_ANY_CASE, Spans, chunks, word_spans
from cadenza.llm.hashed import Linear, feature_rows, fit_linear, softmax


@dataclass(frozen=True)
class Settings:
    """``rows_per_domain`` bounds the classifier's sample, ``steps`` the gradient steps.

    A word marks a domain where ``mark_docs`` of at most ``mark_rows`` documents of it or more
    show it, and ``mark_ratio`` times the share of the other domains' documents that do.
    ``ridge`` keeps the scorer from knowing its sample by heart instead of by such words.

    The fit ends when no domain is off its target by more than ``tolerance`` of the budget.
    ``pull`` draws rates to 1 where the targets leave room.
    """

    rows_per_domain: int = 800
    mark_rows: int = 2500
    mark_docs: int = 4
    mark_ratio: float = 50.0
    ridge: float = 0.05
    steps: int = 60
    tolerance: float = 1e-4
    pull: float = 1e-5


@dataclass
class Mix:
    """Domains, their tokens before and after, the targets, and the steps that lead there."""

    domains: list[str]
    natural: np.ndarray
    target: np.ndarray
    reached: np.ndarray
    history: np.ndarray  # steps by domains: the error that each step saw


_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def letter_words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Document and hash of each run of letters, in any case."""
    starts, ends, doc = word_spans(np.where(_LETTER[data], data, np.uint8(32)), offsets)
    return doc, Spans(data, BYTE_ANY_CASE).hash(starts, ends).view(np.int64)


def _word_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, data, offsets in chunks(batch, "text"):
            doc, word = letter_words(data, offsets)
            order = np.lexsort((word, doc))
            doc, word = doc[order], word[order]
            new = np.ones(len(doc), bool)
            new[1:] = (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])
            yield pa.RecordBatch.from_arrays([piece.column(0).take(pa.array(doc[new])), pa.array(word[new])], ["domain", "word"])


@dataclass
class Marks:
    """Words that mark a domain: sorted hashes, and for each the number of its domain."""

    words: np.ndarray
    domain: np.ndarray
    domains: int

    def signs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Documents by domains: a sign for each domain, one of two by whether a word of it is there."""
        seen = np.zeros((len(offsets) - 1, self.domains), np.int64)
        if len(self.words):
            doc, word = letter_words(data, offsets)
            at = np.minimum(np.searchsorted(self.words, word), len(self.words) - 1)
            hit = self.words[at] == word
            seen[doc[hit], self.domain[at[hit]]] = 1
        return seen + 2 * np.arange(self.domains)


def find_marks(texts: DataFrame, names: Sequence[str], settings: Settings) -> Marks:
    """Words of ``texts`` (``domain``, ``text``) that mark one domain; no word marks two.

    A scorer over all features of a long text hardly sees the one word that tells.
    """
    size = {r["domain"]: r["count"] for r in texts.groupBy("domain").count().collect()}
    shows = texts.select("domain", "text").mapInArrow(giving_back(_word_rows), "domain string, word long")
    counts = shows.groupBy("word").agg(*[F.sum((F.col("domain") == n).cast("long")).alias(f"n{k}") for k, n in enumerate(names)])
    total, every = sum(F.col(f"n{k}") for k in range(len(names))), sum(size.values())
    mark = F.lit(None).cast("int")
    for k, n in enumerate(names):
        own, rest = F.col(f"n{k}"), total - F.col(f"n{k}")
        # half a document more in the rest: few documents must not tell
        apart = own * (every - size[n]) >= settings.mark_ratio * (rest + 0.5) * size[n]
        mark = F.when((own >= settings.mark_docs) & apart, k).otherwise(mark)
    found = sorted((r["word"], r["mark"]) for r in counts.select("word", mark.alias("mark")).filter("mark is not null").collect())
    return Marks(np.array([w for w, _ in found], np.int64), np.array([m for _, m in found], np.int64), len(names))


def fit_classifier(
    docs: DataFrame, labelled: DataFrame, id_col: str, text_col: str, settings: Settings
) -> tuple[list[str], Linear, Marks] | None:
    """Softmax scorer of ``labelled`` (id, ``domain``), on the rows of each domain whose hashed text
    is smallest, with the words that mark a domain as further signs."""
    known = labelled.filter(F.col("domain").isNotNull() & F.col(id_col).isNotNull()).select(id_col, "domain").distinct()
    texts = docs.filter(F.length(F.trim(text_col)) > 0).select(F.col(id_col), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text"))
    found = stored(texts.select(id_col, "tag").join(known, id_col).select("domain", "tag").distinct(), "mix-labelled")
    names = sorted(r["domain"] for r in found.select("domain").distinct().collect())
    if not names:
        return None

    def smallest(n: int) -> DataFrame:
        some = None
        for name in names:
            part = found.filter(F.col("domain") == name).orderBy("tag").limit(n)
            some = part if some is None else some.unionByName(part)
        return texts.join(some, "tag").groupBy("domain", "tag").agg(F.min("text").alias("text"))

    marks = find_marks(smallest(settings.mark_rows), names, settings)
    chosen = smallest(settings.rows_per_domain)
    rows = chosen.mapInArrow(feature_rows("text", "domain", "tag", extra=marks.signs), "domain string, tag long, shown binary, extra binary").collect()
    rows.sort(key=lambda r: (r["tag"], r["domain"]))
    target = np.array([[r["domain"] == n for n in names] for r in rows], float)
    shares = {r["domain"]: r["count"] for r in found.groupBy("domain").count().collect()}
    signs = np.array([np.frombuffer(r["extra"], np.int32) for r in rows])
    model = fit_linear([np.frombuffer(r["shown"], np.int32) for r in rows], target, signs, 2 * len(names), ridge=settings.ridge)
    # the sample is even by domain where it can be; the prior is that of the labelled table
    sampled = target.sum(axis=0)
    model.bias = model.bias + np.log([shares[n] for n in names]) - np.log(sampled)
    return names, model, marks


def posteriors(docs: DataFrame, names: Sequence[str], model: Linear, marks: Marks, id_col: str, text_col: str) -> DataFrame:
    """id, ``tag``, ``n_tokens`` (words), ``posterior`` in the order of ``names``."""
    rows = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tag"), F.col(text_col).alias("text"))
    shape = T.StructType([rows.schema["id"]]).add("tag", "long").add("n_tokens", "long").add("posterior", T.ArrayType(T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, data, offsets in chunks(batch, "text"):
                tokens = np.bincount(word_spans(data, offsets)[2], minlength=len(offsets) - 1).astype(np.int64)
                p = softmax(model.logits(data, offsets, marks.signs(data, offsets)))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, p.size + 1, len(names), dtype=np.int32)), pa.array(p.ravel()))
                yield pa.RecordBatch.from_arrays([piece.column(0), piece.column(1), pa.array(tokens), lists], ["id", "tag", "n_tokens", "posterior"])

    return rows.mapInArrow(giving_back(run), shape)


def rates(posterior: np.ndarray, history: np.ndarray, settings: Settings) -> np.ndarray:
    """The rates after the steps of ``history``: accelerated gradient steps, cut off at 0."""
    size = 1 / (1 + settings.pull)
    rate = ahead = np.ones(len(posterior))
    momentum = 1.0
    for error in history:
        fresh = np.maximum(ahead - size * (posterior @ error + settings.pull * (ahead - 1)), 0)
        following = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead, rate = fresh + (momentum - 1) / following * (fresh - rate), fresh
        momentum = following
    return np.stack([rate, ahead], axis=1)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def left_out(names: Sequence[str], weights: Mapping[str, float]) -> np.ndarray:
    """Which domains have no weight while others have some."""
    none = np.array([weights.get(n, 0.0) <= 0 for n in names])
    return none & ~none.all()


def belongs(posterior: np.ndarray, out: np.ndarray) -> np.ndarray:
    """Which documents the domains ``out`` do not hold over half of."""
    return posterior[:, out].sum(axis=1) <= 0.5


def _totals(held: DataFrame, out: np.ndarray, history: np.ndarray, settings: Settings) -> np.ndarray:
    """Expected domain tokens at the rates reached, and at the point ahead of them, without the documents left out."""
    width = len(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, width))
        for batch in batches:
            p, n = _matrix(batch.column(1), width), batch.column(0).to_numpy()
            total += (rates(p, history, settings) * (n * belongs(p, out))[:, None]).T @ p
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(2 * width, dtype=np.int32)), pa.array(total.ravel())], ["cell", "held"])

    parts = held.select("n_tokens", "posterior").mapInArrow(giving_back(run), "cell int, held double")
    sums = {r["cell"]: r["held"] for r in parts.groupBy("cell").agg(F.sum("held").alias("held")).collect()}
    return np.array([sums.get(k, 0.0) for k in range(2 * width)]).reshape(2, width)


def fit_rates(held: DataFrame, names: Sequence[str], weights: Mapping[str, float], budget: float | None, settings: Settings) -> Mix:
    """Steps until the expected domain totals meet ``weights`` of the budget.

    Errors are divided by the natural size of their domain: by the Gershgorin bound the
    step size 1 / (1 + pull) then holds for any posteriors. Without a budget, the domain of
    the largest weight keeps its natural size. A domain without tokens cannot be filled.
    Natural sizes are those of the documents that are not left out; what these hold of a
    domain of weight 0 is no error.
    """
    none = np.zeros((0, len(names)))
    out = left_out(names, weights)
    natural = _totals(held, out, none, settings)[0]
    share = np.array([max(0.0, weights.get(n, 0.0)) for n in names])
    share = share / share.sum() if share.sum() else natural / max(natural.sum(), 1)
    first = int(share.argmax())
    target = share * (budget if budget is not None else natural[first] / share[first])
    history, reached = none, natural
    total = max(target.sum(), 1.0)
    ahead = natural
    for _ in range(settings.steps):
        if np.abs(reached - target)[~out].max() <= settings.tolerance * total:
            break
        error = np.where((natural > 0) & ~out, (ahead - target) / np.maximum(natural, 1e-9), 0.0)
        history = np.vstack([history, error])
        reached, ahead = _totals(held, out, history, settings)
    return Mix(list(names), natural, target, reached, history)


def mix(
    docs: DataFrame,
    labelled: DataFrame,
    weights: Mapping[str, float],
    id_col: str = "doc_id",
    text_col: str = "text",
    budget: float | None = None,
    settings: Settings = Settings(),
) -> DataFrame:
    """One row per document: ``id``, ``tag``, ``n_tokens``, ``posterior`` (a map), ``rate``, ``copies``.

    ``labelled`` has the id and ``domain`` of some documents. ``copies`` rounds a rate up or
    down by a number drawn from the hash of id and text, so that it is right on average and
    the same in every run. Null and blank texts have no tokens; their posterior is the
    prior. Without any labelled text every rate is 1. Where domains of weight 0 hold over half
    of the posterior, rate and copies are 0. An empty table gives an empty table.
    """
    fitted = fit_classifier(docs, labelled, id_col, text_col, settings)
    if fitted is None:
        tokens = F.size(F.array_remove(F.split(F.coalesce(F.col(text_col), F.lit("")), r"\s+"), "")).cast("long")
        return docs.select(
            F.col(id_col).alias("id"), F.xxhash64(text_col).alias("tag"), tokens.alias("n_tokens"),
            F.create_map().cast("map<string,double>").alias("posterior"), F.lit(1.0).alias("rate"), F.lit(1).cast("long").alias("copies"),
        )
    names, model, marks = fitted
    held = stored(posteriors(docs, names, model, marks, id_col, text_col), "mix-posteriors")
    plan = fit_rates(held, names, weights, budget, settings)
    shape = T.StructType([*held.schema.fields, T.StructField("rate", T.DoubleType())])
    width, history, out = len(names), plan.history, left_out(names, weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = _matrix(batch.column(3), width)
            rate = rates(p, history, settings)[:, 0] * belongs(p, out)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rate)], [f.name for f in shape])

    rated = held.mapInArrow(giving_back(run), shape)
    drawn = F.pmod(F.xxhash64(F.lit("copies"), "id", "tag"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = F.floor("rate") + F.when(drawn < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    posterior = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), "posterior")
    return rated.select("id", "tag", "n_tokens", posterior.alias("posterior"), "rate", copies.cast("long").alias("copies"))
