"""Feed files: readers, file-name metadata, ledger and high-water marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.functions.dates import year_week_start
from cadenza.functions.text import territory_key
from cadenza.operators.keys import first_per_key, not_in

ORDINAL = "file_ordinal"

# File-name forms of the territory feeds.
DAILY_NAME = r"^(.+)_Daily_Top(20k_Artists|50k_Songs)_(\d{8})\.tsv$"
WEEKLY_NAME = r"^(.+)_Top(20kArtist|50kSong)_(\d{6})\.tsv$"
NO_DATA = "__NO_DATA"


def _file_order() -> Column:
    """Position of a row in its file: file, block, then row within the task."""
    row = F.monotonically_increasing_id()
    return F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), row.alias("row"))


def read_feed(spark: SparkSession, paths: str | Sequence[str], sep: str = ",") -> DataFrame:
    """A UTF-16 file with a header; all columns text, plus the row's place in the file.

    Whole-file parsing is the only right way for this encoding, so one task reads one
    file; the rows are dealt out again behind the scan.
    """
    reader = spark.read.options(header=True, encoding="UTF-16", multiLine=True, sep=sep)
    rows = reader.csv(paths if isinstance(paths, str) else list(paths))
    return rows.select("*", _file_order().alias(ORDINAL)).repartition(ORDINAL)


def read_tab_feed(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    return read_feed(spark, paths, sep="\t")


def read_mapping(spark: SparkSession, paths: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Tab-separated text with backslashes and double quotes removed before the split.

    Every file has its own header; the named columns are found by it in each.
    """
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    return parse_mapping(lines.select("value", F.col("_metadata.file_path").alias("file"), _file_order().alias(ORDINAL)), columns)


def parse_mapping(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lines (``value``, ``file``, ordinal) as the named columns, aligned by each file's header.

    Lines with more fields than their header are dropped, shorter ones padded with nulls,
    repeats of the header left out. A file that lacks a column is an error.

    Lines are dealt by their place, so that what a task sorts later does not follow the size of
    a file or of a split of it. A join on the file would gather each file in one task; headers
    are one row for a file, so they are broadcast.
    """
    clean = lines.select("file", ORDINAL, F.translate("value", '\\"', "").alias("line")).filter(F.length("line") > 0)
    clean = clean.hint("rebalance", F.col(ORDINAL))
    headers = clean.groupBy("file").agg(F.min_by("line", ORDINAL).alias("header"))
    names = F.split("header", "\t")
    places = [F.array_position(names, F.lit(c)) for c in columns]
    missing = F.concat_ws(", ", *[F.when(p == 0, F.lit(c)) for c, p in zip(columns, places)])
    checked = F.when(missing == "", F.array(*places)).otherwise(F.raise_error(F.concat(F.lit("missing in "), "file", F.lit(": "), missing)))
    known = headers.select("file", "header", F.size(names).alias("width"), checked.alias("places"))
    fields = F.split("line", "\t")
    held = clean.join(F.broadcast(known), "file").filter((F.col("line") != F.col("header")) & (F.size(fields) <= F.col("width")))
    return held.select(*[_field(fields, F.col("places")[i] - 1).alias(c) for i, c in enumerate(columns)], ORDINAL)


def _field(fields: Column, i: Column) -> Column:
    value = F.get(fields, i.cast("int"))
    return F.when(F.length(value) > 0, value)


def union_variants(first: DataFrame, *more: DataFrame) -> DataFrame:
    """Regional variants of one table, columns matched by name."""
    for df in more:
        first = first.unionByName(df, allowMissingColumns=True)
    return first


def list_files(spark: SparkSession, folder: str, pattern: str = "*.tsv") -> DataFrame:
    """(filename, path) of a folder without reading file contents."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return found.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "path")


def _file_facts(files: DataFrame, form: str, date: Column, kind: Column) -> DataFrame:
    name = F.col("filename")
    return (
        files.filter(name.rlike(form) & ~F.contains(name, F.lit(NO_DATA)))
        .withColumn("__place", F.regexp_extract(name, form, 1))
        .withColumns(
            {
                "territory": territory_key(F.col("__place")),
                "display_name": F.replace("__place", F.lit("_"), F.lit(" ")),
                "date": date,
                "kind": kind,
            }
        )
        .drop("__place")
    )


def _kind(form: str) -> Column:
    return F.when(F.contains(F.regexp_extract("filename", form, 2), F.lit("Artist")), "artists").otherwise("songs")


def daily_files(files: DataFrame) -> DataFrame:
    """Territory, date and kind of daily files; other names and no-data files are left out."""
    date = F.to_date(F.regexp_extract("filename", DAILY_NAME, 3), "yyyyMMdd")
    return _file_facts(files, DAILY_NAME, date, _kind(DAILY_NAME))


def weekly_files(files: DataFrame) -> DataFrame:
    """The same for weekly files, whose date is the first day of the named week."""
    date = year_week_start(F.regexp_extract("filename", WEEKLY_NAME, 3))
    return _file_facts(files, WEEKLY_NAME, date, _kind(WEEKLY_NAME))


def unprocessed(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files the ledger does not list."""
    return not_in(files, ledger, ["filename"])


def latest_per_territory(files: DataFrame) -> DataFrame:
    """The newest file of every territory and kind."""
    return first_per_key(files, ["territory", "kind"], [F.col("date").desc(), F.col("filename").asc()])


def beyond_mark(files: DataFrame, marks: DataFrame) -> DataFrame:
    """The latest files that are newer than their territory's mark, or have none.

    ``marks`` is (territory, kind, last_processed); unknown territories drop out.
    """
    m = marks.select("territory", "kind", "last_processed")
    joined = latest_per_territory(files).join(m, ["territory", "kind"])
    return joined.filter(F.col("last_processed").isNull() | (F.col("date") > F.col("last_processed"))).drop("last_processed")


def advance_marks(marks: DataFrame, done: DataFrame) -> DataFrame:
    """Marks moved to the processed files' dates."""
    new = done.groupBy("territory", "kind").agg(F.max("date").alias("__d"))
    return marks.join(new, ["territory", "kind"], "left").select(
        "territory", "kind", F.coalesce("__d", "last_processed").alias("last_processed")
    )


def head_rows(df: DataFrame, n: int = 100) -> DataFrame:
    """The first rows in file order, for a dry run."""
    return df.orderBy(ORDINAL).limit(n)


def sample_rows(df: DataFrame, n: int = 1000, seed: int = 42) -> DataFrame:
    """A repeatable random sample for a dry run: the rows whose text has the least digests.

    Ties, which only equal texts have, are broken by the columns; only ``n`` rows of each task are sorted.
    """
    told = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in df.columns if c != ORDINAL]
    digest = F.md5(F.concat_ws("|", *told, F.lit(str(seed))).cast("binary"))
    return df.orderBy(digest, *[F.col(c).asc() for c in df.columns if c != ORDINAL]).limit(n)
