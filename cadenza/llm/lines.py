"""Line dedup by distinct-site spread, in DataFrame operations only.

Every line is a 128-bit hash. HyperLogLog sketches of its sites merge by aggregation, one
partial sketch per line and map task. Lines well above the threshold are boilerplate by
their sketch, lines well below are not, and lines near it get an exact count of distinct
sites. Of a boilerplate line the first occurrence in the corpus stays, all others go.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import stored

HASH = ("h1", "h2")


@dataclass(frozen=True)
class Spread:
    """Lines on ``min_sites`` sites or more are boilerplate.

    Estimates within ``margin`` of the threshold are counted again exactly; at 2^lg_k
    registers the sketch's standard error is 1.04 / sqrt(2^lg_k), here 1.6 %, and below a
    few hundred sites it counts exactly.

    With ``long_sites``, lines of ``long_words`` words or more are boilerplate from so many
    sites on, and lines of fewer than ``least_words`` words never are. A letter of a script
    that writes no spaces counts as a word.
    """

    min_sites: int = 12
    margin: float = 0.25
    lg_k: int = 12
    long_sites: int | None = None
    long_words: int = 5
    least_words: int = 3


_UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}"
_WORD = rf"[{_UNSPACED}]|[^\s{_UNSPACED}]+"


def sites_needed(line: Column, spread: Spread) -> Column:
    """From how many sites on a line is boilerplate; null for never."""
    if spread.long_sites is None:
        return F.lit(spread.min_sites)
    words = F.regexp_count(line, F.lit(_WORD))
    return F.when(words >= spread.long_words, spread.long_sites).when(words >= spread.least_words, spread.min_sites)


def text_lines(docs: DataFrame, text_col: str, site_col: str, *keys: str, spread: Spread = Spread()) -> DataFrame:
    """The lines that can be boilerplate, with more than white space: keys, place, hash, site, sites needed."""
    pieces = docs.select(*keys, F.col(site_col).alias("site"), F.posexplode(F.split(F.col(text_col), "\n")).alias("place", "line"))
    line = F.regexp_replace("line", r"^\s+|\s+$", "")
    full = pieces.select(*keys, "site", "place", line.alias("line")).filter(F.length("line") > 0)
    return full.withColumn("need", sites_needed(F.col("line"), spread)).filter("need is not null").select(
        *keys, "site", "place", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "need"
    )


def boilerplate(lines: DataFrame, spread: Spread = Spread()) -> DataFrame:
    """Hashes of the lines on as many distinct sites as they need or more; null sites are no site."""
    sketched = lines.groupBy(*HASH).agg(
        F.hll_sketch_agg("site", F.lit(spread.lg_k)).alias("sketch"), F.count(F.lit(1)).alias("rows"), F.max("need").alias("need")
    )
    # a line on n sites has n rows at least: rare lines need no estimate
    often = sketched.filter(F.col("rows") >= F.col("need"))
    sites = often.select(*HASH, "need", F.hll_sketch_estimate("sketch").alias("sites"))
    judged = stored(sites, "line-sites")
    high = F.col("need") * (1 + spread.margin)
    low = F.col("need") * (1 - spread.margin)
    near = judged.filter((F.col("sites") >= low) & (F.col("sites") <= high)).select(*HASH)
    exact = (
        lines.join(near, list(HASH), "left_semi")
        .select(*HASH, "need", "site")
        .distinct()
        .groupBy(*HASH)
        .agg(F.count("site").alias("sites"), F.max("need").alias("need"))
        .filter(F.col("sites") >= F.col("need"))
    )
    return judged.filter(F.col("sites") > high).select(*HASH).unionByName(exact.select(*HASH))


def drop_boilerplate(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    site_col: str = "source",
    spread: Spread = Spread(),
) -> DataFrame:
    """``docs`` with boilerplate lines taken out of the text, and ``n_removed_lines``.

    The first occurrence of a line (smallest id, then place) stays. A line is compared
    without the white space around it; blank lines stay. Null texts stay null. Rows that
    repeat an id and a text lose the same lines, those that repeat an id with another
    text are told apart by their text; a null id comes first. Other columns pass through;
    a column ``n_removed_lines`` of the input is replaced, all others keep their names. An
    empty table gives an empty table.
    """
    tag = F.xxhash64(F.col(text_col))
    named = docs.select(F.col(id_col).alias("id"), tag.alias("tag"), F.col(text_col).alias("t"), F.col(site_col).alias("s"))
    lines = text_lines(named, "t", "s", "id", "tag", spread=spread)
    spread_lines = stored(boilerplate(lines, spread), "line-boilerplate")
    at = F.struct("id", "tag", "place")
    hits = stored(lines.drop("site", "need").join(spread_lines, list(HASH), "left_semi"), "line-hits")
    first = hits.groupBy(*HASH).agg(F.min(at).alias("first"))
    gone = (
        hits.join(first, list(HASH))
        .filter(~at.eqNullSafe(F.col("first")))
        .groupBy(F.col("id").alias("__id"), F.col("tag").alias("__of"))
        .agg(F.array_sort(F.collect_set("place")).alias("__gone"))
    )
    # a row travels as one struct, so that no name of its columns can clash
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "n_removed_lines"])
    mark = docs.select(row.alias("row"), F.col(id_col).alias("id"), tag.alias("tag"))
    same = F.col("id").eqNullSafe(F.col("__id")) & F.col("tag").eqNullSafe(F.col("__of"))
    joined = mark.join(gone.hint("merge"), same, "left").withColumn("every", F.split(F.col("row")[text_col], "\n"))
    lost = F.coalesce("__gone", F.array().cast("array<int>"))
    # line 0 is item 1; a removed place is matched by its number, in one hashed set operation
    keep = F.array_except(F.sequence(F.lit(0), F.size("every") - 1), lost)
    old = F.col("row")[text_col]
    text = F.when(F.size(lost) > 0, F.array_join(F.transform(keep, lambda i: F.get(F.col("every"), i)), "\n")).otherwise(old)
    return joined.select(
        *[(text if c == text_col else F.col("row")[c]).alias(c) for c in docs.columns if c != "n_removed_lines"],
        F.size(lost).cast("long").alias("n_removed_lines"),
    )
