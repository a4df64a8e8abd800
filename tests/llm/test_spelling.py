"""Spelling variants against edit distances of all pairs."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from cadenza.llm import queries, spelling
from tests.llm.conftest import as_rows

WORDS = "word string, n long"


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, times=10):
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= times * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def vocabulary(seed, n, letters="abcdeé", lengths=(7, 8, 9)):
    rng, out = random.Random(seed), {}
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.choice(lengths)))
        out[w] = 10 ** rng.randrange(5) * rng.randrange(1, 9)
        for _ in range(rng.randrange(4)):  # words around it
            i, c = rng.randrange(len(w)), rng.choice(letters)
            out[rng.choice([w[:i] + w[i + 1 :], w[:i] + c + w[i:], w[:i] + c + w[i + 1 :]])] = rng.randrange(1, 9)
    return out


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


@pytest.mark.parametrize("leaf,bucket", [(4096, 128), (40, 4), (1, 1)])
def test_variants(spark, monkeypatch, leaf, bucket):
    monkeypatch.setattr(spelling, "LEAF", leaf)
    monkeypatch.setattr(spelling, "BUCKET", bucket)
    counts = vocabulary(leaf, 500 if leaf > 1 else 60)
    counts |= {"a" * 300: 5, "a" * 301: 60, "a" * 299 + "b": 5, "zz": 1, "z": 900, "漢字漢字": 3, "漢字字漢": 50, "漢字漢": 700, "😀bcdefg": 2, "bcdefg": 40}
    counts |= {"".join(p): 1 for p in ("abcabcd", "bacabcd", "cababcd", "dcbabca", "abcdabc")}  # one vector, no pair
    words = spark.createDataFrame(list(counts.items()), WORDS).repartition(3)
    assert as_rows(spelling.spelling_variants(words), *COLUMNS) == brute(counts)


def test_long_chains(spark):
    chain = {"abcdefg" + "x" * k: 10**k for k in range(9)}
    words = spark.createDataFrame([*chain.items(), (None, 5), ("", 7)], WORDS)
    out = {r.word: r for r in spelling.spelling_variants(words).collect()}
    assert sorted(out) == sorted(chain) and {r.root for r in out.values()} == {"abcdefg" + "x" * 8}


def test_words_of_the_corpus(spark, docs, rows, empty):
    def altered(doc_id, run):
        h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
        return run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run

    found = Counter()
    for r in rows:
        text = (r[1] or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        run = ""
        for c in text + " ":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
            elif run:
                found[altered(r[0], run)] += 1
                run = ""
    want = {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}
    got = spelling.corpus_words(docs, altered=queries.drop_letter)
    assert {r.word: r.n for r in got.collect()} == want
    assert as_rows(spelling.spelling_variants(got), *COLUMNS) == brute(want)
    assert spelling.spelling_variants(spelling.corpus_words(empty)).count() == 0


def test_clashing_names(spark):
    extra = spark.createDataFrame([("abcdefg", 20, 1, 2, 3), ("abcdefh", 2, 1, 2, 3)], "word string, n int, root int, near int, best int")
    assert as_rows(spelling.spelling_variants(extra), *COLUMNS) == brute({"abcdefg": 20, "abcdefh": 2})


def test_vectors_bound_edits():
    rng = np.random.default_rng(1)
    for _ in range(200):
        w = rng.choice([97, 98, 122, 224, 230, 255, 0x6F22], 150)
        i, c = rng.integers(0, 150), rng.choice([97, 122, 229])
        longer, other = np.insert(w, i, c), w.copy()
        other[i] = c
        a, b, d = (spelling.letter_counts(x[None].astype(np.uint32))[0].astype(int) for x in (w, longer, other))
        assert np.abs(a - b).sum() <= 1 and (b >= a).all()
        assert np.maximum(d - a, 0).sum() <= 1 and np.maximum(a - d, 0).sum() <= 1
