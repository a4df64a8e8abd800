"""Signed-status classification: label substrings, exact names, fuzzy names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.editjoin import fuzzy_best
from cadenza.operators.winnow import contains_any
from cadenza.session import materialise


def mark_by_substring(df: DataFrame, text: str, labels: DataFrame, label: str = "label") -> DataFrame:
    """Signed when already signed or when a listed label occurs in ``text``."""
    return contains_any(df, text, labels, label, "__sub").withColumn("signed", _or_signed(F.col("__sub"))).drop("__sub")


def _or_signed(found: Column) -> Column:
    return F.coalesce(F.col("signed"), F.lit(False)) | found


def mark_by_name(df: DataFrame, signed_artists: DataFrame, artist: str = "artist") -> DataFrame:
    """Signed when the artist is on the list; otherwise unchanged."""
    listed = signed_artists.select(F.col("artist").alias("__on")).filter(F.col("__on").isNotNull()).distinct()
    joined = df.join(listed, df[artist] == listed["__on"], "left")
    return joined.withColumn("signed", F.when(F.col("__on").isNotNull(), F.lit(True)).otherwise(F.col("signed"))).drop("__on")


def _mark_by_score(df: DataFrame, column: str, entries: DataFrame, entry: str, cut: float, strict: bool) -> DataFrame:
    """Only texts of rows that are still unsigned are searched; ``df`` is read more than once."""
    hits = fuzzy_best(df.filter(~F.coalesce("signed", F.lit(False))), column, entries, entry, cut)
    if strict:
        hits = hits.filter(F.col("score") > cut)
    hits = hits.select(F.col(column), F.lit(True).alias("__fuzzy"))
    return (
        df.join(hits, column, "left")
        .withColumn("signed", _or_signed(F.coalesce("__fuzzy", F.lit(False))))
        .select(*df.columns)
    )


def signed_cascade(df: DataFrame, labels: DataFrame, signed_artists: DataFrame, text: str = "copyrights") -> DataFrame:
    """Already signed, else a label in the copyright text, else an artist score of 0.95."""
    marked = materialise(mark_by_substring(df, text, labels), "signed-marked")
    return _mark_by_score(marked, "artist", signed_artists, "artist", 0.95, strict=False)


def signed_cascade_songs(df: DataFrame, labels: DataFrame, signed_artists: DataFrame) -> DataFrame:
    """A listed label inside the song's label, else a label score above 0.9, else a listed artist."""
    marked = materialise(mark_by_substring(df, "label", labels), "signed-marked")
    scored = _mark_by_score(marked, "label", labels, "label", 0.9, strict=True)
    return mark_by_name(scored, signed_artists)


def newly_signed(df: DataFrame, signed_artists: DataFrame) -> DataFrame:
    """Signed, named artists that are not listed yet."""
    new = df.filter(F.col("signed") & F.col("artist").isNotNull()).select("artist").distinct()
    return new.join(signed_artists.select("artist"), "artist", "left_anti")


def signed_patch(reports: DataFrame, texts: DataFrame, labels: DataFrame, key: str, as_of, text: str = "copyrights") -> DataFrame:
    """Mark the unsigned rows of the ``as_of`` report whose copyright text names a label.

    ``texts`` holds one copyright text per ``key``.
    """
    today = F.col("report_date").eqNullSafe(F.lit(as_of))
    latest = reports.filter(today & ~F.col("signed"))
    checked = contains_any(latest.select(key).join(texts, key), text, labels, "label", "__hit")
    hits = checked.filter("__hit").select(key, F.lit(True).alias("__hit")).distinct()
    # only the report of the day takes part in the join; earlier ones pass without a shuffle
    day = reports.filter(today).join(hits, key, "left").withColumn("signed", F.coalesce("__hit", F.col("signed")))
    return reports.filter(~today).unionByName(day.select(*reports.columns))
