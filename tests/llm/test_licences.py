"""Licence scans against a scan of all places of all texts."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

from cadenza.llm import licences
from cadenza.llm.licences import TEMPLATES, Template
from tests.llm.conftest import SCHEMA, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, templates=TEMPLATES, rare=licences.RARE):
    """Every start of every template in every text."""
    texts = [words(r[1]) for r in rows]
    having = {w: sum(w in set(t) for t in texts) for t in templates for w in t.words()}
    weight = {w: math.floor((math.log((len(texts) + 1) / (n + 1)) + 1) * 1e6 + 0.5) for w, n in having.items()}
    out = []
    for r, text in zip(rows, texts, strict=True):
        places = []
        for t in templates:
            body, keys = t.words(), t.keys()
            chosen = set(sorted(set(body), key=lambda w: (having[w], body.index(w)))[: 1 if t.base else rare])
            total = sum(weight[w] for w in body if w in chosen)
            for s in range(len(text)):
                got = sum(weight[w] for q, w in enumerate(body) if w in chosen and text[s + q : s + q + 1] == [w])
                if got and got * 1000 >= t.share * total and all(text[s + k : s + k + len(p)] == p for k, p in keys):
                    places.append((s, t.label, t.base, len(body), round(got / total, 9)))
        out.append((r[0], len(text), sorted(places)))
    return sorted(out, key=str)


def found(df):
    return sorted(((r.doc_id, r.n_words, [(*p[:4], round(p.share, 9)) for p in r.places]) for r in df.collect()), key=str)


def planted(rows):
    rng, out = random.Random(11), [list(r) for r in rows]
    bodies = [t.body for t in TEMPLATES]
    for i, body in enumerate(bodies):
        changed = body.split()
        changed[rng.randrange(len(changed))] = "other"
        out += [
            [1000 + i, f"{prose(rng, 20)}\n/* {body.upper()} */ {prose(rng, 5)}", "en", "s", 0],
            [1100 + i, body, "en", "s", 0],
            [1200 + i, " ".join(changed) + ". " + body.replace(" ", ", "), "en", "s", 0],
            [1300 + i, body.rsplit(" ", 1)[0], "en", "s", 0],
        ]
    out += [
        [1400, "MIT License MIT-License mit\tlicense, the mit  licens", "en", "s", 0],
        [1401, "cc by cc by cc", "en", "s", 0],
        [1402, "gnu general public licenseß and ÀPACHE LICENSE", "en", "s", 0],
        [1403, "apache license " * 3000, "en", "s", 0],
    ]
    return out


def test_every_place_is_found(spark, rows):
    rows = planted(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(licences.find_licences(docs)) == brute(rows)


def test_rare_words_follow_the_table(spark):
    """The word that all documents share is looked up for no clause that has rarer ones."""
    clause = Template("own", "common alpha common beta common gamma delta", ("alpha common beta",), 500)
    rows = [[i, "common common word", None, None, None] for i in range(30)]
    rows += [[50, "common alpha common beta something gamma delta", None, None, None], [51, "alpha common beta", None, None, None], [52, "common alpha beta", None, None, None]]
    docs = spark.createDataFrame(rows, SCHEMA)
    lookup, _ = licences._index(docs, "text", [clause], 3)
    assert sorted(lookup) == [b"alpha", b"delta", b"gamma"]
    for rare in (1, 3, 9):
        assert found(licences.find_licences(docs, templates=[clause], rare=rare)) == brute(rows, [clause], rare)


def test_empty_table_and_clashing_names(spark, docs, empty, rows):
    assert licences.find_licences(empty).count() == 0
    crowded = docs.withColumns({c: F.lit(1) for c in ("word", "n_words", "places", "start", "template", "weight", "label", "__row", "__text", "__id")})
    assert found(licences.find_licences(crowded)) == brute(rows)


def test_templates_are_bounded(docs):
    long_ = Template("x", " ".join(f"w{i}" for i in range(licences.MOST_WORDS + 1)), ())
    with pytest.raises(ValueError):
        licences.find_licences(docs, templates=[long_])


def test_no_text_is_shuffled(docs):
    plan = licences.find_licences(docs)._jdf.queryExecution().executedPlan().toString()
    exchanged = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanged and not any("__text" in line for line in exchanged)
