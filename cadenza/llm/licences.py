"""Licence scans by a positional index of rare licence words.

A template is a clause of a licence, or a phrase that names one. The index holds, for the
words of each template that fewest documents have, their places in it. A document looks up
each of its words once; a word at place ``p`` that a template has at place ``q`` puts the
template's start at ``p - q``, and postings that agree on a start are one place. A place
counts where the weights of its words reach the template's share and every mandatory key
phrase stands in the text where the template has it.

A task holds the index, whose size the templates bound, and one text at a time. What it finds
are rows of (document, template, start): Spark sums them by place, and places by document.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadenza.llm.common import text_or_empty

#: Words by which a clause is looked up, the rarest first.
RARE = 6
#: Words of all templates together; every task holds the index, so it has a bound.
MOST_WORDS = 50_000


@dataclass(frozen=True)
class Template:
    """``phrases`` must stand in a text where ``body`` has them; ``share`` is that of the rare
    words' weight, in thousandths. A ``base`` template names a licence and is its own phrase."""

    label: str
    body: str
    phrases: tuple[str, ...]
    share: int = 600
    base: bool = False

    def words(self) -> list[str]:
        return self.body.split()

    def keys(self) -> list[tuple[int, list[str]]]:
        """The places and words of the mandatory phrases."""
        own, out = self.words(), []
        for phrase in self.phrases:
            p = phrase.split()
            out.append((next(i for i in range(len(own)) if own[i : i + len(p)] == p), p))
        return out


def named(label: str, phrase: str) -> Template:
    return Template(label, phrase, (phrase,), 1000, True)


# fixed values: the four phrases, and clauses of public licences
BASE = (
    named("gpl", "gnu general public license"),
    named("apache", "apache license"),
    named("cc-by", "cc by"),
    named("mit", "mit license"),
)
CLAUSES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template(
        "apache-2.0",
        "you may not use this file except in compliance with the license you may obtain a copy of the license at",
        ("except in compliance with the license",),
    ),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
        ("any person obtaining a copy of this software and associated documentation",),
    ),
    Template(
        "bsl-1.0",
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation",
        ("any person or organization obtaining a copy of the software",),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
        ("redistribution and use in source and binary forms",),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
        ("for any purpose with or without fee",),
    ),
    Template(
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable",
        ("will the authors be held liable",),
    ),
    Template("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    Template("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu",
        ("you can redistribute it and or modify it under the terms of the gnu",),
    ),
    Template("lgpl", "under the terms of the gnu lesser general public license", ("gnu lesser general public license",)),
    Template("agpl", "under the terms of the gnu affero general public license", ("gnu affero general public license",)),
    Template(
        "mpl-2.0",
        "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("mozilla public license",),
    ),
    Template("epl", "made available under the terms of the eclipse public license", ("eclipse public license",)),
    Template(
        "unlicense",
        "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software",),
    ),
    Template("cc0", "waived all copyright and related or neighboring rights to this work", ("copyright and related or neighboring rights",)),
    Template("cc-by-nc", "licensed under cc by nc 4 0", ("cc by nc",)),
    Template("cc-by-sa", "licensed under cc by sa 4 0", ("cc by sa",)),
    Template(
        "cc-by",
        "licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution 4 0 international",),
    ),
)
TEMPLATES = BASE + CLAUSES


def find_licences(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    templates: Sequence[Template] = TEMPLATES,
    rare: int = RARE,
) -> DataFrame:
    """One row per document: id, ``n_words``, ``places``.

    ``places`` are structs of ``start`` (in words, from 0), ``label``, ``base``, ``n_words``
    and ``share`` (of the rare words' weight, above 0 to 1), in that order; empty where
    nothing was found. All places count, overlapping ones too. A word's weight falls with the
    share of documents that have it, and words are as rare as the table says: the rarest words
    of a template are those that fewest documents hold, ties in the template's order. Null and
    empty texts have no words and no places. Repeated rows and ids, and null ids, each give
    their own row; further columns are not read. An empty table gives an empty table.
    """
    held = sum(len(t.words()) for t in templates)
    if held > MOST_WORDS:
        raise ValueError(f"the templates have {held} words, more than {MOST_WORDS}")
    lookup, of = _index(docs, text_col, templates, rare)
    rows = docs.select(F.col(id_col).alias("__id"), F.monotonically_increasing_id().alias("__row"), text_or_empty(text_col).alias("__text"))
    field = T.StructField("__id", docs.schema[id_col].dataType)
    postings = rows.mapInArrow(_postings(lookup, templates), T.StructType([field, *_POSTING]))
    agreed = postings.groupBy("__id", "__row", "n_words", "template", "start").agg(F.sum("weight").alias("got"))
    known = F.broadcast(docs.sparkSession.createDataFrame(of, "template int, label string, base boolean, length int, total long, share int"))
    place = F.struct("start", "label", "base", F.col("length").alias("n_words"), (F.col("got") / F.col("total")).alias("share"))
    counted = F.col("got") * 1000 >= F.col("total") * F.col("share")
    places = agreed.join(known, "template", "left").groupBy("__id", "__row", "n_words").agg(F.sort_array(F.collect_list(F.when(counted, place))).alias("places"))
    return places.select(F.col("__id").alias(id_col), "n_words", "places")


_POSTING = [T.StructField(c, T.LongType()) for c in ("__row", "n_words", "start", "weight")] + [T.StructField("template", T.IntegerType())]

#: Bytes of words as they are or lower-cased, all others as blanks: what lies beyond ASCII is part of a word.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def _words(text: pa.Scalar) -> list[bytes]:
    return text.as_buffer().to_pybytes().translate(_FOLD).split()


def _postings(lookup: dict[bytes, list[tuple[int, int, int]]], templates: Sequence[Template]):
    """A row for each rare word of a template at a start whose key phrases stand in the text, and
    one without a template for each document."""
    keys = [[(k, [w.encode() for w in p]) for k, p in t.keys()] for t in templates]
    rare = set(lookup)

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n_words, starts, weights, of = [], [], [], [], []
            for k, text in enumerate(batch.column(2)):
                words = _words(text)
                found = [(-1, None, 0)]
                if not rare.isdisjoint(words):
                    for p, w in enumerate(words):
                        for template, place, weight in lookup.get(w, ()):
                            s = p - place
                            if s >= 0 and all(words[s + q : s + q + len(phrase)] == phrase for q, phrase in keys[template]):
                                found.append((template, s, weight))
                for template, s, weight in found:
                    at.append(k)
                    n_words.append(len(words))
                    starts.append(s)
                    weights.append(weight)
                    of.append(template)
            ids, row = batch.column(0).take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64()))
            longs = [pa.array(c, pa.int64()) for c in (n_words, starts, weights)]
            yield pa.RecordBatch.from_arrays([ids, row, *longs, pa.array(of, pa.int32())], ["__id", *(f.name for f in _POSTING)])

    return rows


def _index(docs: DataFrame, text_col: str, templates: Sequence[Template], rare: int) -> tuple[dict, list[tuple]]:
    """Places and weights of the rare words of each template, by word; and what makes a place count.

    Counts cover all documents: each task sends one row for each word of the templates.
    """
    vocabulary = {w.encode() for t in templates for w in t.words()}

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = dict.fromkeys([b"", *vocabulary], 0)
        for batch in batches:
            held[b""] += batch.num_rows
            for text in batch.column(0):
                for w in vocabulary.intersection(_words(text)):
                    held[w] += 1
        yield pa.RecordBatch.from_arrays([pa.array([w.decode() for w in held]), pa.array(list(held.values()), pa.int64())], ["word", "n"])

    counts = docs.select(text_or_empty(text_col)).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    held = {r["word"]: r["n"] for r in counts.collect()}  # as many rows as the templates have words
    lookup: dict[bytes, list[tuple[int, int, int]]] = {}
    of = []
    for i, t in enumerate(templates):
        words = t.words()
        first = {w: words.index(w) for w in words}
        chosen = set(sorted(first, key=lambda w: (held.get(w, 0), first[w]))[: 1 if t.base else rare])
        weights = {w: _weight(held.get("", 0), held.get(w, 0)) for w in chosen}
        for place, w in enumerate(words):
            if w in chosen:
                lookup.setdefault(w.encode(), []).append((i, place, weights[w]))
        of.append((i, t.label, t.base, len(words), sum(weights[w] for w in words if w in chosen), t.share))
    return lookup, of


def _weight(documents: int, having: int) -> int:
    """Inverse document frequency in millionths, above 0 for a word that all have."""
    return math.floor((math.log((documents + 1) / (having + 1)) + 1) * 1_000_000 + 0.5)
