"""Text expressions for matching and cleaning."""

from __future__ import annotations

import sys
import unicodedata

import pandas as pd

from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The vectorised helpers travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def match_key(c: Column) -> Column:
    """Letters and digits only, lower case; null becomes empty."""
    return F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"[^\p{L}\p{N}]", ""))


def territory_key(c: Column) -> Column:
    """``Hong Kong`` -> ``hong_kong``."""
    return F.replace(F.lower(c), F.lit(" "), F.lit("_"))


def contains_any_word(c: Column, words: list[str]) -> Column:
    """True where any of ``words`` occurs, whatever the case; null stays null."""
    found = F.lit(False)
    for word in words:
        found = found | F.contains(F.lower(c), F.lit(word.lower()))
    return found


def strip_quotes(c: Column) -> Column:
    """Drop both kinds of quote characters before an export."""
    return F.translate(c, "'\"", "")


def link(base: str, c: Column) -> Column:
    """The address of an entity under ``base``; null without an id."""
    return F.concat(F.lit(base), c.cast("string"))


def _collapse(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, r"\s+", " "))


def clean_name(c: Column) -> Column:
    """An artist name as a lookup query."""
    c = F.translate(F.replace(c, F.lit("&"), F.lit(" ")), "[],", "")
    return F.substring(F.substring_index(c, "Feat.", 1), 1, 100)


def clean_artist(c: Column) -> Column:
    """The artist half of a title-and-artist query."""
    c = F.replace(F.translate(c, "&,()[]", "    "), F.lit("Feat."), F.lit(" "))
    c = F.substring_index(F.substring_index(c, " ~ ", 1), " - ", 1)
    return F.substring(_collapse(c), 1, 37)


def clean_title(c: Column) -> Column:
    """The title half of a title-and-artist query."""
    c = F.substring_index(F.translate(c, "&,()[]", "    "), "Feat.", 1)
    c = F.substring_index(F.trim(c), " - ", 1)
    return F.substring(_collapse(c), 1, 37)


def bare_title(c: Column) -> Column:
    """A catalogue title cut at the first bracket or triple space."""
    return F.substring_index(F.substring_index(c, "(", 1), "   ", 1)


@F.pandas_udf(T.StringType())
def nfkd(texts: pd.Series) -> pd.Series:
    return texts.map(lambda s: unicodedata.normalize("NFKD", s), na_action="ignore")


def _common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, one machine word per character of ``b``."""
    spots: dict[str, int] = {}
    for i, ch in enumerate(a):
        spots[ch] = spots.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for ch in b:
        hit = row & spots.get(ch, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _ratio(a: str | None, b: str | None) -> float | None:
    if a is None or b is None:
        return None
    total = len(a) + len(b)
    return 2.0 * _common_length(a, b) / total if total else 1.0


@F.pandas_udf(T.DoubleType())
def indel_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """``2 * LCS / (len + len)``: the similarity that counts insertions and deletions only."""
    return pd.Series([_ratio(a, b) for a, b in zip(left, right)], dtype="float64")
