"""Small documents that hold every awkward case, and helpers."""

import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = [
    "der", "the", "haus", "tree", "ligne", "perro", "and", "of", "was", "with", "blue", "river", "stone", "cloud", "paper", "green",
    "river", "mountain", "quiet", "window", "garden", "letter", "winter", "summer", "music", "silver", "engine", "market", "island",
]


def prose(rng, n):
    """``n`` words in sentences and lines."""
    out = []
    for i in range(n):
        w = rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "ing", "er", "ly"])
        out.append(w.capitalize() + ("," if i % 11 == 3 else ".\n" if i % 17 == 16 else "." if i % 9 == 8 else ""))
    return " ".join(out).replace("\n ", "\n")


def corpus():
    """Rows with nulls in every column, empty and very long texts, ties, repeats, near copies."""
    rng = random.Random(7)
    texts = [prose(rng, rng.choice([3, 8, 40, 120, 300])) for _ in range(60)]
    passage = prose(rng, 90)
    shared = "All rights reserved by the house of letters, see the notice."
    rows = []
    for i, t in enumerate(texts):
        if i % 5 == 0:
            t = t + "\n" + shared
        if i % 7 == 0:
            t = t + "\n" + passage
        rows.append([i, t, ["en", "de", "fr"][i % 3], f"src{i % 9}", len(t)])
    for i in range(12):  # near copies of one long text, in other cases too
        w = texts[3].split(" ") if len(texts[3]) > 200 else prose(random.Random(3), 200).split(" ")
        w = list(w)
        w[i % len(w)] = f"changed{i}"
        t = " ".join(w)
        rows.append([100 + i, t.upper() if i % 4 == 0 else t, "en", "src0", len(t)])
    for i in range(6):  # exact copies
        rows.append([200 + i, texts[1], "en", f"src{i}", len(texts[1])])
    long_ = prose(rng, 9000)
    rows += [
        [300, None, "en", "src1", None],
        [301, "", "en", "src1", 0],
        [302, " \n\t ", None, None, 4],
        [303, long_, "en", None, len(long_)],
        [304, long_[1000:], None, "src2", len(long_) - 1000],
        [305, "a" * 3000, "de", "src2", 3000],
        [306, "ab" * 900, "de", "src2", 1800],
        [307, "12 34 !! ##", "de", "src2", 11],
        [308, "漢字 ÄÖÜ Straße 😀 naïve café", "de", "src2", 27],
        [309, None, None, None, None],
        [None, texts[2], "en", "src3", len(texts[2])],
        [None, "nobody knows this one", "en", "src3", 21],
        [5, texts[5], "fr", "src5", len(texts[5])],
        [5, "another text under an id that repeats", "fr", "src5", 38],
    ]
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def crowded(docs):
    """With columns whose names operators use themselves."""
    names = ["tag", "id", "node", "sig", "row", "size", "shard", "slot", "kept", "line", "word", "block", "rate", "copies", "rank", "n_removed_lines", "__tag", "__id", "__of", "__gone", "__every", "__text", "row", "every"]
    return docs.withColumns({c: F.lit(1) for c in names})


def as_rows(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
