"""Exact dedup, repeated strings, near copies, lines and rules against brute force."""

import hashlib
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cadenza.llm import exact, jaccard, lines, rules, shards, suffixes
from tests.llm.conftest import SCHEMA, as_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key(v):
    return tuple((x is None, str(x)) for x in v)


def test_radix_dedup(docs, rows):
    groups = defaultdict(list)
    for r in rows:
        groups[(r[1] or "").translate(LOWER)].append(r[0])
    want = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        for i in ids:
            want[(i, keep, len(ids))] += 1
    for width, growth in ((64, 8), (1, 2)):
        got = exact.radix_dedup(docs, first_width=width, growth=growth).collect()
        assert Counter((r.doc_id, r.keep_id, r.group_size) for r in got) == want
        assert sum(r.kept for r in got) == len(groups)
        assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_radix_dedup_keeps_one_of_repeated_rows(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (1, "X"), (2, "y")], "doc_id long, text string")
    got = exact.radix_dedup(df).collect()
    assert Counter((r.doc_id, r.kept) for r in got) == {(1, True): 1, (1, False): 2, (2, True): 1}


def brute_repeats(rows, span):
    seen = Counter()
    bodies = [(r[0], (r[1] or "").encode()) for r in rows]
    for _, b in bodies:
        seen.update(b[s : s + span] for s in range(len(b) - span + 1))
    out = []
    for i, b in bodies:
        gone = np.zeros(len(b), bool)
        for s in range(len(b) - span + 1):
            if seen[b[s : s + span]] > 1:
                gone[s : s + span] = True
        runs = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum()) if len(b) else 0
        out.append((i, int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=key)


def digests(df):
    return sorted(((r.id, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()), key=key)


def test_repeated_strings(docs, rows):
    assert digests(suffixes.drop_repeats(docs)) == brute_repeats(rows, suffixes.SPAN)


def test_repeated_strings_in_crowded_groups(docs, rows, monkeypatch):
    monkeypatch.setattr(suffixes, "GROUP", 2)
    assert digests(suffixes.drop_repeats(docs)) == brute_repeats(rows, suffixes.SPAN)


def test_partial_overlaps(spark):
    rng = np.random.default_rng(5)
    base = bytes(rng.integers(97, 123, 3000, dtype=np.uint8)).decode()
    texts = [base[:900], base[500:1400], base[980:1400] + "zz" + base[100:650], base[:399], base[1:401], "q" + base[1:402], base[2000:2450] * 2]
    rows = [[i, t] for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert digests(suffixes.drop_repeats(df)) == brute_repeats(rows, suffixes.SPAN)


def test_multikey_quicksort():
    rng = np.random.default_rng(1)
    columns = [rng.integers(0, k, 9000) for k in (5, 40, 7)]
    order = suffixes.multikey_quicksort(columns)
    got = list(zip(*(c[order] for c in columns)))
    assert got == sorted(zip(*columns))
    assert sorted(order.tolist()) == list(range(9000))


def brute_components(rows):
    sets, n = [], len(rows)
    for r in rows:
        w = WORD.findall((r[1] or "").translate(LOWER))
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    least = {}
    for i in range(n):
        ids = [rows[j][0] for j in range(n) if find(j) == find(i) and rows[j][0] is not None]
        least[i] = (min(ids) if ids else None) if sets[i] else rows[i][0]
    return sorted(((rows[i][0], len(sets[i]), least[i]) for i in range(n)), key=key)


def test_jaccard_components(docs, rows):
    assert as_rows(jaccard.jaccard_components(docs), "id", "n_shingles", "component_id") == brute_components(rows)


def test_jaccard_components_in_large_buckets(spark, monkeypatch):
    """Frequent features, unsafe sets and small buckets, at the edge of the threshold."""
    import random

    rng = random.Random(11)
    passage = [f"p{i}" for i in range(40)]
    base = [f"b{i}" for i in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randrange(0, 14)):
            w[rng.randrange(len(w))] = f"x{rng.randrange(40)}"
        rows.append([i, " ".join(w)])
    for i in range(60):
        own = [f"u{i}_{k}" for k in range(rng.randrange(2, 90))]
        rows.append([100 + i, " ".join(own + passage)])
    for i in range(30):
        rows.append([300 + i, " ".join(f"s{rng.randrange(3)}" for _ in range(rng.randrange(1, 9)))])
    monkeypatch.setattr(jaccard, "BUCKET", 4)
    monkeypatch.setattr(jaccard, "FREQUENT", 10)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(jaccard.jaccard_components(df), "id", "n_shingles", "component_id") == brute_components(rows)


def test_jaccard_of_near_copies_compares_few_pairs(spark, monkeypatch):
    """Near copies of a text, of which most are too far from it and from each other to link."""
    import random

    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = [[0, " ".join(base)]]
    for i in range(1, 240):
        w = list(base)
        for at in rng.sample(range(0, 150, 5), rng.choice([2, 3, 4, 5, 6, 8, 9, 10])):
            w[at] = f"x{i}_{at}"
        rows.append([i, " ".join(w)])
    compared, plain = {}, jaccard.stored

    def counting(df, label):
        out = plain(df, label)
        compared[label] = compared.get(label, 0) + out.count()
        return out

    monkeypatch.setattr(jaccard, "stored", counting)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert as_rows(jaccard.jaccard_components(df), "id", "n_shingles", "component_id") == brute_components(rows)
    assert compared["jaccard-star"] + compared["jaccard-cross"] < 8 * len(rows), compared


def test_large_buckets_are_compared_in_blocks(spark, monkeypatch):
    """Near copies of which no two link: large buckets give no row for each pair, whatever the blocks."""
    import random

    rng = random.Random(17)
    base = [f"b{i}" for i in range(150)]
    rows = [[0, " ".join(base)]]
    for i in range(1, 200):
        w = list(base)
        for at in rng.sample(range(0, 150, 5), rng.choice([4, 5, 5, 6, 6])):
            w[at] = f"x{i}_{at}"
        rows.append([i, " ".join(w)])
    for i in range(40):  # what differs from the text in the same places links
        w = rows[1 + i][1].split(" ")
        w[148] = f"y{i}"
        rows.append([1000 + i, " ".join(w)])
    made, plain = [], jaccard._across

    def counting(*given):
        out = plain(*given)
        made.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "_across", counting)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute_components(rows)
    for block in (1024, 50, 7):
        monkeypatch.setattr(jaccard, "BLOCK", block, raising=False)
        assert as_rows(jaccard.jaccard_components(df), "id", "n_shingles", "component_id") == expected
    assert max(made) < 4 * len(rows), made


def test_counts_are_compared_as_one_by_one():
    """What a task says of two blocks, for sets of all sizes, is what the conditions say of each pair."""
    rng = np.random.default_rng(9)
    base = np.unique(rng.integers(0, 1 << 63, 700, dtype=np.uint64) * np.uint64(2))
    sets = [np.sort(rng.choice(base, n, replace=False)) for n in rng.integers(20, 700, 120)]
    sets += [np.delete(s, rng.choice(len(s), len(s) // 9, replace=False)) for s in sets]
    n = len(sets)
    size = np.array([len(s) for s in sets])
    root, common = rng.integers(0, 60, n), size - rng.integers(0, size // 5)
    lacks, open_, own = rng.random(n) < 0.4, rng.random(n) < 0.2, rng.integers(0, 2, n).astype(np.int32)
    sketches = [jaccard.sketch_of(s) for s in sets]
    for low, high in ((0, 0), (0, 1)):
        found = set()
        columns = {"node": np.arange(n), "sig": np.zeros(n, np.int64), "low": np.full(n, low), "high": np.full(n, high), "own": own if high else 0 * own,
                   "root": root, "size": size, "common": common, "lacks": lacks, "open": open_}
        batch = pa.RecordBatch.from_pydict({**columns, "sketch": [x.tobytes() for x in sketches]})
        for out in jaccard._met(iter([batch.slice(0, 100), batch.slice(100)])):
            pairs = list(zip(out.column("u").to_pylist(), out.column("v").to_pylist()))
            assert not found & set(pairs)
            found |= set(pairs)
        expected = {
            (i, j)
            for i in range(n)
            for j in range(i + 1, n)
            if (not high or own[i] != own[j])
            and root[i] != root[j]
            and (lacks[i] or lacks[j])
            and (open_[i] or open_[j] or 7 * min(common[i], common[j]) >= 3 * (size[i] + size[j]))
            and jaccard.may_be_similar(sketches[i], sketches[j], int(size[i]), int(size[j]))
        }
        assert found == expected and expected


def test_signatures_meet():
    """Any two similar sets share one of the signatures that decide."""
    rng = np.random.default_rng(3)
    none = np.zeros(0, np.uint64)
    for size in [*range(1, 40), 100, 127, 128, 129, 400, 511, 513, 3000]:
        for _ in range(30):
            own = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
            drop = rng.integers(0, size // 4 + 1)
            other = np.delete(own, rng.choice(len(own), drop, replace=False))
            room = max(0, int((len(other) - 3 * (len(own) + 0) / 4) / 0.75))
            extra = rng.integers(0, 1 << 63, rng.integers(0, room + 1), dtype=np.uint64)
            other = np.unique(np.concatenate([other, extra]))
            both = len(np.intersect1d(own, other))
            if not len(other) or 100 * both < 75 * (len(own) + len(other) - both):
                continue
            a, b = (jaccard.signatures(s, none) for s in (own, other))
            assert set(a[0].tolist()) & set(b[0].tolist()), (size, drop)


def test_line_dedup(docs, rows):
    spread = lines.Spread(min_sites=4)
    sites, places = defaultdict(set), defaultdict(list)
    strip = lambda s: s.strip(" \t\n\x0b\f\r")
    for n, r in enumerate(rows):
        for k, line in enumerate((r[1] or "").split("\n") if r[1] is not None else []):
            if strip(line):
                sites[strip(line)].add(r[3])
                places[strip(line)].append(((r[0] is not None, r[0] or 0), k, n))
    gone = defaultdict(set)
    for line, where in places.items():
        if len(sites[line] - {None}) >= 4:
            first = min(w[:2] for w in where)
            for w in where:
                if w[:2] != first:
                    gone[w[2]].add(w[1])
    want = []
    for n, r in enumerate(rows):
        text = r[1] if r[1] is None else "\n".join(x for k, x in enumerate(r[1].split("\n")) if k not in gone[n])
        want.append((r[0], text, len(gone[n])))
    assert any(g for g in gone.values())
    got = as_rows(lines.drop_boilerplate(docs, spread=spread), "doc_id", "text", "n_removed_lines")
    assert got == sorted(want, key=key)


def test_line_dedup_counts_exactly_near_the_threshold(spark):
    rows = [(d, f"seen on {n} sites\nown {n} {d}", f"s{d}", 1) for n in (5, 6, 7) for d in range(n)]
    df = spark.createDataFrame([(i, *r[1:]) for i, r in enumerate(rows)], "doc_id long, text string, source string, n_chars long")
    got = lines.drop_boilerplate(df, spread=lines.Spread(min_sites=6, margin=0.5))
    assert got.agg({"n_removed_lines": "sum"}).first()[0] == 5 + 6


def test_rule_counts(docs, rows):
    want = []
    for r in rows:
        t = r[1] or ""
        w = WORD.findall(t)
        seen, dup = set(), 0
        for line in t.split("\n"):
            if WORD.search(line):
                dup += line in seen
                seen.add(line)
        count, covered = Counter(zip(w, w[1:], w[2:])), set()
        for k in range(len(w) - 2):
            if count[tuple(w[k : k + 3])] > 1:
                covered |= {k, k + 1, k + 2}
        failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
        want.append((r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(covered), failed))
    out = rules.quality_rules(docs)
    assert as_rows(out, "doc_id", *rules.BASE, "base_failed") == sorted(want, key=key)
    assert not out.filter("kept and base_failed").count()


def thue_morse(letters, n):
    return "".join(letters[k.bit_count() & 1] for k in range(n))


def test_words_made_to_collide_are_told_apart(spark):
    """Thue-Morse words have the same value under any polynomial modulo a power of two."""
    texts = [thue_morse("ab", 1024), thue_morse("ba", 1024), thue_morse("ab", 1024).upper(), "a b", "a  B"]
    out = {r.id: r for r in jaccard.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [out[i].component_id for i in range(5)] == [0, 1, 0, 3, 3]
    assert jaccard._alike("x y z", "X\ty z") and not jaccard._alike(texts[0], texts[1]) and not jaccard._alike("a b c", "a b c d e")


def test_rules_follow_their_group(spark):
    """A source whose documents all hold symbols has other limits than one without."""
    import random

    from tests.llm.conftest import prose

    rng = random.Random(2)
    made = []
    for i in range(600):
        t = prose(rng, 120)
        if i % 2:
            t = " ".join(w + "#" for w in t.split(" "))
        made.append((i, t, "en", "marked" if i % 2 else "plain", len(t)))
    odd = " ".join(w + "#" for w in prose(rng, 120).split(" "))
    made.append((1000, odd, "en", "plain", len(odd)))
    kept = {r.doc_id: r.kept for r in rules.quality_rules(spark.createDataFrame(made, SCHEMA)).collect()}
    assert not kept[1000]
    assert all(v for k, v in kept.items() if k < 1000)


def test_rules_against_exact_quantiles(spark):
    """Groups that a sketch holds whole have the limits of their sorted ratios."""
    import math
    import random

    from tests.llm.conftest import prose

    rng = random.Random(12)
    made = []
    for i in range(360):
        t = prose(rng, rng.choice([40, 60, 90, 200]))
        if i % 9 == 0:
            t = t.replace("the", "###")
        if i % 11 == 0:
            t += "\n" + "\n".join([prose(rng, 6)] * rng.randrange(2, 9))
        if i % 13 == 0:
            t = t.replace(" ", "longish ")
        made.append((i, t, ["en", "de"][i % 2], f"s{i % 3}" if i % 30 else f"tiny{i}", len(t)))
    fences = rules.Fences(min_rows=40)
    out = {r.doc_id: r for r in rules.quality_rules(spark.createDataFrame(made, SCHEMA), fences=fences).collect()}

    def ratios(r):
        t = made[r.doc_id][1]
        lines = sum(1 for x in t.split("\n") if WORD.search(x))
        return r.n_symbols / r.n_words, r.n_dup_lines / lines, r.n_repeat_words / r.n_words, r.word_chars / r.n_words

    def at(values, q):
        return sorted(values)[max(0, math.ceil(q * len(values)) - 1)]

    held = defaultdict(list)
    for i, _, lang, source, _ in made:
        if not out[i].base_failed:
            for key_ in ((lang, source), lang, None):
                held[key_].append(ratios(out[i]))
    decided = 0
    for i, _, lang, source, _ in made:
        rows = next(held[k] for k in ((lang, source), lang, None) if len(held[k]) >= 40 or k is None)
        inside = True
        for value, name, column in zip(ratios(out[i]), rules.RATIOS, zip(*rows)):
            f = getattr(fences, name)
            low, high = at(column, f.low), at(column, f.high)
            reach = f.width * (high - low) if high > low else f.slack
            decided += high > low
            inside &= value <= high + reach and (not f.lower or value >= low - reach)
        assert out[i].kept == (inside and not out[i].base_failed)
    assert decided > len(made) and 0 < sum(r.kept for r in out.values()) < sum(not r.base_failed for r in out.values())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the given tables")
def test_sketches_decide_most_groups(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    measured = rules.measures(docs).cache()
    bounds = rules.limits(measured, "lang", "source", rules.Fences()).collect()
    large = {(r.lang, r.source) for r in measured.filter(~rules.base_failed()).groupBy("lang", "source").count().filter("count >= 200").collect()}
    mine = [r for r in bounds if (r.lang, r.source) in large]
    assert mine and all(2 * sum(r[f"by_sketch_{name}"] for r in mine) > len(mine) for name in ("dup_lines", "repeats", "word_length"))
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    judged = rules.quality_rules(docs).join(labels, "doc_id").filter("not base_failed")
    share = {r.quality: r.kept for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept")).collect()}
    assert share[1] > 0.98 and share[0] < 0.05


def test_kd_shards(docs, rows):
    import zlib

    out = shards.kd_shards(docs, 5).collect()
    size = lambda t: len((t or "").encode()) + 8
    want = sorted(((r[0], size(r[1]), zlib.crc32((r[1] or "").encode())) for r in rows), key=key)
    assert sorted(((r.doc_id, r["size"], r.text_crc32) for r in out), key=key) == want
    held = defaultdict(int)
    slots = defaultdict(list)
    for r in out:
        held[r.shard] += r["size"]
        slots[r.shard].append(r.slot)
    assert set(held) <= set(range(5))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(w[1] for w in want)
    assert max(held.values()) <= sum(held.values()) / 5 + 3 * largest


def test_kd_shards_are_even_on_equal_rows(spark):
    df = spark.createDataFrame([(1, "same", "en", "s", 4)] * 480, SCHEMA)
    out = shards.kd_shards(df, 24)
    assert {r["count"] for r in out.groupBy("shard").count().collect()} == {20}
    by_size = shards.kd_shards(df, target_bytes=480)
    assert by_size.select("shard").distinct().count() == 12


@pytest.mark.parametrize(
    "operator",
    [exact.radix_dedup, suffixes.drop_repeats, jaccard.jaccard_components, lines.drop_boilerplate, rules.quality_rules, shards.kd_shards],
)
def test_empty_tables_and_clashing_names(operator, empty, crowded):
    assert operator(empty).count() == 0
    assert operator(crowded).count() == crowded.count()
