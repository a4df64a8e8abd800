"""Language identification with a string kernel.

Two texts are compared by the byte n-grams that both hold (n = 1, 2, 3 together, presence
only), divided by the root of their numbers of n-grams: the blended-spectrum presence
kernel. Landmark texts give its Nystroem map; kernel ridge regression, one against the
rest, is solved on a bounded sample of labelled rows. All texts are then scored in batches:
a presence matrix times the landmarks' matrix gives the kernel values, and these times the
solved weights the decision of each language.

The feature space is that of the n-grams of the landmarks, at most ``max_landmarks`` texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.grams import chunks

UNKNOWN = "und"
#: Letters a-z, all bytes of other scripts, one sign for anything else; the last parts texts.
_SIGNS = 27 + 128 + 1
_SIGN = np.zeros(256, np.int64)
_SIGN[97:123] = np.arange(1, 27)
_SIGN[65:91] = np.arange(1, 27)
_SIGN[128:] = 27 + np.arange(128)
_END = _SIGNS - 1
GRAMS = _SIGNS + _SIGNS**2 + _SIGNS**3
#: Cells of a presence matrix at a time.
CELLS = 1 << 22


@dataclass(frozen=True)
class Settings:
    """Bounds of the fit: sample rows and landmarks for each language, and over all."""

    rows_per_lang: int = 300
    max_rows: int = 6000
    max_landmarks: int = 160
    ridge: float = 1e-2


@dataclass
class Model:
    langs: list[str]
    grams: np.ndarray  # codes of the features, ascending
    landmarks: np.ndarray  # features by landmarks, scaled columns
    weights: np.ndarray  # landmarks by languages
    bias: np.ndarray


def gram_codes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the 1-, 2- and 3-grams of a chunk and the document of each; none crosses documents."""
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(offsets))
    sign = np.append(_SIGN[data], [_END, _END])
    pair = sign[:-1] * _SIGNS + sign[1:]
    triple = pair[:-1] * _SIGNS + sign[2:]
    last = np.append(doc, [-1, -1])
    two, three = last[1:-1] == doc, (last[2:] == doc)
    codes = np.concatenate([sign[:-2], _SIGNS + pair[:-1][two], _SIGNS + _SIGNS**2 + triple[three]])
    return codes, np.concatenate([doc, doc[two], doc[three]])


def _sample_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece, data, offsets in chunks(batch, "text"):
            codes, doc = gram_codes(data, offsets)
            order = np.argsort(doc, kind="stable")
            bounds = np.searchsorted(doc[order], np.arange(len(offsets)))
            own = [np.unique(codes[order[a:b]]).astype(np.int32).tobytes() for a, b in zip(bounds, bounds[1:])]
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(own, pa.binary())], ["lang", "grams"])


def held_out(id_col: str = "doc_id") -> Column:
    """One id in five, by checksum; a null id counts as the empty text, which is held out."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % 5 == 0


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, settings: Settings = Settings()) -> Model | None:
    """The model of a bounded sample: of each language the rows whose hashed ids are smallest."""
    usable = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
    narrow = usable.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.xxhash64(id_col, text_col).alias("tag"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("tag", "id"))
    chosen = narrow.withColumn("rank", rank).filter(F.col("rank") <= settings.rows_per_lang).orderBy("rank", "tag", "lang").limit(settings.max_rows)
    full = usable.select(F.xxhash64(id_col, text_col).alias("t"), F.col(text_col).alias("text"))
    texts = chosen.select("lang", "tag").distinct().join(full, F.col("tag") == F.col("t"))
    once = texts.groupBy("lang", "tag").agg(F.min("text").alias("text"))
    rows = once.select("lang", "text").mapInArrow(_sample_grams, "lang string, grams binary").collect()
    rows = sorted(((r["lang"], bytes(r["grams"])) for r in rows if r["grams"]))
    return _solve([r[0] for r in rows], [np.frombuffer(r[1], np.int32) for r in rows], settings) if rows else None


def _solve(langs: list[str], sets: list[np.ndarray], settings: Settings) -> Model:
    names = sorted(set(langs))
    of = np.array([names.index(x) for x in langs])
    share = max(1, settings.max_landmarks // len(names))
    marks = np.concatenate([np.flatnonzero(of == k)[:: max(1, int((of == k).sum()) // share)][:share] for k in range(len(names))])
    grams = np.unique(np.concatenate([sets[i] for i in marks]))
    shown = np.zeros((len(sets), len(grams)), np.float32)
    for i, own in enumerate(sets):
        at = np.searchsorted(grams, own)
        at[at == len(grams)] = 0
        shown[i, at[grams[at] == own]] = 1
    scaled = shown / np.sqrt(np.maximum(shown.sum(axis=1, keepdims=True), 1))
    landmarks = scaled[marks].T.copy()
    kernel = scaled @ landmarks
    values, vectors = np.linalg.eigh((kernel[marks] + kernel[marks].T).astype(np.float64) / 2)
    real = values > 1e-6 * values.max()
    root = vectors[:, real] / np.sqrt(values[real])
    map_ = kernel.astype(np.float64) @ root
    centre = map_.mean(axis=0)
    target = np.where(of[:, None] == np.arange(len(names)), 1.0, -1.0)
    level = target.mean(axis=0)
    gram = (map_ - centre).T @ (map_ - centre)
    gram += settings.ridge * len(sets) / len(gram) * np.eye(len(gram))
    solved = np.linalg.solve(gram, (map_ - centre).T @ (target - level))
    return Model(names, grams, landmarks, (root @ solved).astype(np.float32), (level - centre @ solved).astype(np.float32))


def _decisions(model: Model, place: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Documents by languages, for one chunk."""
    n, width = len(offsets) - 1, len(model.grams)
    codes, doc = gram_codes(data, offsets)
    at = place[codes]
    known = at >= 0
    shown = np.zeros((n, width), np.float32)
    shown[doc[known], at[known]] = 1
    norm = np.sqrt(np.maximum(shown.sum(axis=1, keepdims=True), 1))
    return ((shown @ model.landmarks) / norm) @ model.weights + model.bias


def predict(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``lang_pred``, ``score``: the language of every whole text.

    A null text, or one without a letter, is ``und`` with score 0, and so is every text where
    there was nothing to learn from. The score is the decision, from -1 to 1, moved to 0 to 1.
    """
    letters = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col(id_col), F.col(text_col).alias("text"), letters.alias("letters"))
    if model is None:
        return rows.select(id_col, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shape = T.StructType([rows.schema[id_col]]).add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = np.full(GRAMS, -1, np.int32)
        place[model.grams] = np.arange(len(model.grams))
        names = np.array([*model.langs, UNKNOWN], dtype=object)
        for batch in batches:
            for piece, data, offsets in chunks(batch, "text"):
                step = max(1, CELLS // len(model.grams))
                best, score = [], []
                for a in range(0, len(offsets) - 1, step):
                    some = offsets[a : a + step + 1]
                    found = _decisions(model, place, data[some[0] : some[-1]], some - some[0])
                    best.append(found.argmax(axis=1))
                    score.append(np.clip((found.max(axis=1) + 1) / 2, 0, 1))
                letters = piece.column(2).to_numpy(zero_copy_only=False).astype(bool)
                lang = np.where(letters, np.concatenate(best), len(model.langs))
                value = np.where(letters, np.concatenate(score).astype(np.float64), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(names[lang], pa.string()), pa.array(value)], [id_col, "lang_pred", "score"]
                )

    return rows.mapInArrow(run, shape)


def identify(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", settings: Settings = Settings()
) -> DataFrame:
    """One row per document: id, ``held_out``, ``lang_pred``, ``score``.

    The sample is drawn from rows with a language and a text that are not held out; language,
    source and id take no part in a prediction. Every row is scored, repeated ones as often
    as they occur. An empty table gives an empty table.
    """
    model = fit(docs, id_col, text_col, lang_col, settings)
    out = predict(docs, model, id_col, text_col)
    return out.select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
