"""Quality rules with adaptive thresholds, in DataFrame operations only.

The measures of a text are taken within its row. Quantile sketches of four ratios are built
per language and source, merged upwards to language and corpus, and give every group its
own limits; a join then filters. The sketches merge by aggregation, so a source that holds
a third of all rows is one partial sketch per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored, text_or_empty, words

SYMBOLS = "[#*$%&|<>]"
RATIOS = ("symbols", "dup_lines", "repeats", "word_length")


@dataclass(frozen=True)
class Fence:
    """A limit from the sketch of a ratio: ``high + width * (high - low)``, both quantiles.

    Where they are equal, so that the sketch tells no spread, it is ``high + slack``. A
    ``lower`` fence lies as far below ``low``.
    """

    low: float
    high: float
    width: float
    slack: float
    lower: bool = False


@dataclass(frozen=True)
class Fences:
    """The fences of the four ratios. A group with fewer than ``min_rows`` rows that pass the
    base rule takes the limits of its language, a small language those of the corpus."""

    symbols: Fence = Fence(0.5, 0.9, 3.0, 0.25)
    dup_lines: Fence = Fence(0.5, 0.98, 2.0, 0.5)
    repeats: Fence = Fence(0.5, 0.95, 8.0, 0.35)
    word_length: Fence = Fence(0.25, 0.75, 4.5, 2.0, lower=True)
    min_rows: int = 200
    sketch_k: int = 200


BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def measures(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts of every whole text; null and empty texts have zeros."""
    text = text_or_empty(text_col)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"\S"))
    df = docs.withColumn("__words", words(text)).withColumn("__lines", lines)
    n = F.size("__words")
    windows = F.greatest(n - 2, F.lit(0))
    triple = F.arrays_zip(
        F.slice("__words", F.lit(1), windows).alias("a"),
        F.slice("__words", F.lit(2), windows).alias("b"),
        F.slice("__words", F.lit(3), windows).alias("c"),
    )
    places = F.when(windows > 0, F.sequence(F.lit(0), windows - 1)).otherwise(F.array().cast("array<int>"))
    df = df.withColumn("__sorted", F.sort_array(F.arrays_zip(triple.alias("key"), places.alias("at"))))
    df = df.withColumn("__twice", _repeated("__sorted"))
    covered = F.aggregate(
        "__twice",
        F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("total")),
        lambda acc, at: F.struct(at.alias("last"), (acc.total + F.least(F.lit(3), at - acc.last)).alias("total")),
        lambda acc: acc.total,
    )
    return df.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in BASE],
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("__words", "")).cast("long").alias("word_chars"),
        (F.char_length(text) - F.char_length(F.regexp_replace(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        covered.alias("n_repeat_words"),
        F.size("__lines").cast("long").alias("n_lines"),
    )


def _repeated(column: str) -> Column:
    """Places of the windows that equal a neighbour in sorted order, ascending."""
    z = F.col(column)

    def equals_neighbour(x: Column, i: Column) -> Column:
        before = F.get(z, i - 1)["key"] == x["key"]
        after = F.get(z, i + 1)["key"] == x["key"]
        return F.coalesce(before, F.lit(False)) | F.coalesce(after, F.lit(False))

    return F.sort_array(F.transform(F.filter(z, equals_neighbour), lambda x: x["at"]))


def ratios() -> dict[str, Column]:
    """The four ratios, null where a text has no word."""
    return {
        "symbols": F.col("n_symbols") / F.nullif(F.col("n_words"), F.lit(0)),
        "dup_lines": F.col("n_dup_lines") / F.nullif(F.col("n_lines"), F.lit(0)),
        "repeats": F.col("n_repeat_words") / F.nullif(F.col("n_words"), F.lit(0)),
        "word_length": F.col("word_chars") / F.nullif(F.col("n_words"), F.lit(0)),
    }


def base_failed() -> Column:
    """Under 50 words, or over half of the words in repeated three-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def limits(measured: DataFrame, lang_col: str, source_col: str, fences: Fences) -> DataFrame:
    """One row per language and source with its limits, and for each ratio whether a spread
    in its sketch decided (``by_sketch_...``) or the slack.

    The sketches hold the rows that pass the base rule; a group without any has the limits
    of its language or of the corpus, and no limits where nothing passes.
    """
    k = F.lit(fences.sketch_k)
    passed, values = ~base_failed(), ratios()
    sketch = lambda r: F.kll_sketch_agg_double(F.when(passed, values[r]), k).alias(r)
    per_group = measured.groupBy(lang_col, source_col).agg(F.count(F.when(passed, 1)).alias("rows"), *[sketch(r) for r in RATIOS])
    merged = lambda prefix: [F.kll_merge_agg_double(r, k).alias(f"{prefix}_{r}") for r in RATIOS]
    per_lang = per_group.groupBy(F.col(lang_col).alias("__lang")).agg(F.sum("rows").alias("lang_rows"), *merged("lang"))
    corpus = per_group.agg(*merged("all")).first()  # four sketches of a few kilobytes
    g = per_group.join(per_lang, F.col(lang_col).eqNullSafe(F.col("__lang")))
    g = g.withColumns({f"all_{r}": F.lit(corpus[f"all_{r}"]) for r in RATIOS})
    out = [F.col(lang_col), F.col(source_col)]
    for r in RATIOS:
        chosen = (
            F.when(F.col("rows") >= fences.min_rows, F.col(r))
            .when(F.col("lang_rows") >= fences.min_rows, F.col(f"lang_{r}"))
            .otherwise(F.col(f"all_{r}"))
        )
        g, fence = g.withColumn(f"__s_{r}", chosen), getattr(fences, r)
        some = F.kll_sketch_get_n_double(f"__s_{r}") > 0
        low, high = (F.when(some, F.kll_sketch_get_quantile_double(f"__s_{r}", F.lit(q))) for q in (fence.low, fence.high))
        reach = F.when(high > low, fence.width * (high - low)).otherwise(F.lit(fence.slack))
        out += [(high + reach).alias(f"max_{r}"), (high > low).alias(f"by_sketch_{r}")]
        if fence.lower:
            out.append((low - reach).alias(f"min_{r}"))
    return g.select(*out)


def quality_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    fences: Fences = Fences(),
    carry: Sequence[str] = (),
) -> DataFrame:
    """One row per document: id, the counts, ``base_failed``, ``kept``.

    The base rule rejects under 50 words, or over half of the words in repeated three-word
    windows. What passes is rejected where one of its ratios lies beyond the limits of its
    language and source, which follow the quantiles of the rows that pass there. Null languages and sources are groups like any other; a text
    without words fails the base rule. Rows that repeat count as often as they occur. An
    empty table gives an empty table.
    """
    named = docs.select(
        F.col(id_col), *[F.col(c) for c in carry], F.col(lang_col).alias("__l"), F.col(source_col).alias("__s"),
        F.col(text_col).alias("__text"),
    )
    measured = stored(measures(named, "__text").drop("__text"), "rule-measures")
    bounds = limits(measured, "__l", "__s", fences).select(
        F.col("__l").alias("__bl"), F.col("__s").alias("__bs"), *[f"max_{r}" for r in RATIOS], "min_word_length"
    )
    base = base_failed()
    inside = F.lit(True)
    for r, value in ratios().items():
        inside = inside & F.coalesce(value <= F.col(f"max_{r}"), F.lit(True))
    inside = inside & F.coalesce(ratios()["word_length"] >= F.col("min_word_length"), F.lit(True))
    joined = measured.join(bounds, F.col("__l").eqNullSafe(F.col("__bl")) & F.col("__s").eqNullSafe(F.col("__bs")))
    return joined.select(id_col, *carry, *BASE, base.alias("base_failed"), (~base & inside).alias("kept"))
