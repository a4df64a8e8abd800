"""The operators and the pipeline as named queries over the given tables, with SQL where it can say them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from cadenza.llm import bpe, exact, jaccard, langid, licences, lines, mixing, rules, shards, spelling, suffixes, weak, whiten
from cadenza.llm.common import ascii_lower, text_or_empty

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("op1_suffix_dedup")
def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = suffixes.drop_repeats(documents(spark, folder))
    size = F.octet_length("kept").cast("long") + F.col("n_removed")
    return out.select(F.col("id").alias("doc_id"), size.alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_kd_shards")
def op2_kd_shards(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.kd_shards(documents(spark, folder), 24)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op3_quality_classifier")
def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return weak.classify(documents(spark, folder))


@query(
    "op4_ngram_jaccard",
    """
    WITH RECURSIVE words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
      FROM documents
    ),
    shingles AS (
      SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                          WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
      FROM words
    ),
    sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
    common AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
    links AS (
      SELECT u, v FROM common c JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
    ),
    reach AS (SELECT doc_id AS u, doc_id AS v FROM documents UNION SELECT r.u, l.v FROM reach r JOIN links l ON l.u = r.v)
    SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id
    FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN (SELECT u, min(v) AS component_id FROM reach GROUP BY 1) r ON r.u = d.doc_id
    """,
)
def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.jaccard_components(documents(spark, folder)).withColumnRenamed("id", "doc_id")


@query(
    "op5_exact_dedup",
    """
    WITH t AS (
      SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body FROM documents
    )
    SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
           doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
    FROM t WINDOW w AS (PARTITION BY body)
    """,
)
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    digest = F.unhex(F.sha2(ascii_lower(text_or_empty()).cast("binary"), 256))
    out = exact.radix_dedup(docs.withColumn("digest", digest), carry=["digest"])
    return out.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query(
    "op8_line_dedup",
    """
    WITH pieces AS (
      SELECT doc_id, source, unnest(string_split(text, chr(10))) AS raw, unnest(range(len(string_split(text, chr(10))))) AS place FROM documents
    ),
    lines AS (SELECT doc_id, source, place, raw, regexp_replace(raw, '^[ \\t\\n\\x0B\\f\\r]+|[ \\t\\n\\x0B\\f\\r]+$', '', 'g') AS line FROM pieces),
    spread AS (SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 12),
    judged AS (
      SELECT l.doc_id, l.place, l.raw,
             s.line IS NOT NULL AND row_number() OVER (PARTITION BY l.line ORDER BY l.doc_id, l.place) > 1 AS gone
      FROM lines l LEFT JOIN spread s ON l.line = s.line
    ),
    rebuilt AS (
      SELECT doc_id, coalesce(string_agg(raw, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '') AS kept_text,
             count(*) FILTER (WHERE gone) AS n_removed_lines
      FROM judged GROUP BY doc_id
    )
    SELECT d.doc_id, coalesce(r.n_removed_lines, 0) AS n_removed_lines,
           CASE WHEN d.text IS NULL THEN NULL ELSE r.kept_text END AS text
    FROM documents d LEFT JOIN rebuilt r ON d.doc_id = r.doc_id
    """,
)
def op8_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.drop_boilerplate(documents(spark, folder)).select("doc_id", "n_removed_lines", "text")


#: Domains of the labelled table, and the share of tokens that each is to have.
WEIGHTS = {"clean": 0.93, "toxic": 0.02, "low": 0.05}


def label_domains(spark: SparkSession, folder: str) -> DataFrame:
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    low, toxic = F.col("quality") == 0, F.col("toxic") == 1
    return labels.select("doc_id", F.when(low, "low").when(toxic, "toxic").otherwise("clean").alias("domain"))


@query("op6_source_mixing")
def op6_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(documents(spark, folder), label_domains(spark, folder), WEIGHTS)
    return mixed.select(
        F.col("id").alias("doc_id"),
        "n_tokens",
        *[F.col("posterior")[d].alias(f"p_{d}") for d in WEIGHTS],
        "rate",
        "copies",
    )


@query("op7_byte_bpe")
def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return token_digests(documents(spark, folder))


VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def token_digests(docs: DataFrame) -> DataFrame:
    vocabulary = public_tokenizers.path(VOCABULARY)
    both = bpe.decode(bpe.encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary)
    return both.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_quality_rules")
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return rules.quality_rules(documents(spark, folder))


@query("op10_language_id")
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(documents(spark, folder))


def _licence_sql() -> str:
    """The same places by plain joins: words of documents with places of templates."""
    quoted = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    templates, phrases = [], []
    for i, t in enumerate(licences.TEMPLATES):
        templates.append(f"({i}, '{t.label}', {str(t.base).lower()}, {t.share}, {1 if t.base else licences.RARE}, {quoted(t.words())})")
        phrases += [f"({i}, {place}, {quoted(words)})" for place, words in t.keys()]
    return f"""
    WITH templates(t, label, base, share, rare, body) AS (VALUES {", ".join(templates)}),
    phrases(t, place, body) AS (VALUES {", ".join(phrases)}),
    words AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
      FROM documents
    ),
    spots AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM words),
    held AS (SELECT word, count(DISTINCT doc_id) AS n FROM spots GROUP BY 1),
    postings AS (SELECT t, label, base, share, rare, unnest(body) AS word, unnest(range(len(body))) AS q FROM templates),
    weighed AS (
      SELECT p.*, coalesce(h.n, 0) AS n_docs, min(q) OVER (PARTITION BY t, p.word) AS first_q,
             CAST(floor((ln(((SELECT count(*) FROM documents) + 1) / (coalesce(h.n, 0) + 1)) + 1) * 1000000 + 0.5) AS BIGINT) AS weight
      FROM postings p LEFT JOIN held h ON h.word = p.word
    ),
    looked_up AS (SELECT * FROM (SELECT *, dense_rank() OVER (PARTITION BY t ORDER BY n_docs, first_q) AS nth FROM weighed) WHERE nth <= rare),
    totals AS (SELECT t, sum(weight) AS total FROM looked_up GROUP BY 1),
    agreed AS (
      SELECT s.doc_id, l.t, any_value(l.label) AS label, any_value(l.base) AS base, any_value(l.share) AS share, s.p - l.q AS start, sum(l.weight) AS got
      FROM spots s JOIN looked_up l ON s.word = l.word WHERE s.p >= l.q GROUP BY s.doc_id, l.t, s.p - l.q
    ),
    places AS (
      SELECT a.doc_id, a.label, a.base, a.start, a.got / x.total AS share
      FROM agreed a JOIN totals x ON x.t = a.t JOIN phrases f ON f.t = a.t JOIN words d ON d.doc_id = a.doc_id
      WHERE a.got * 1000 >= a.share * x.total AND d.w[a.start + f.place + 1:a.start + f.place + len(f.body)] = f.body
    )
    SELECT d.doc_id, len(d.w) AS n_words, count(p.start) FILTER (WHERE p.base) AS n_base,
           min(p.start) FILTER (WHERE p.base) AS first_word, max(p.start) FILTER (WHERE p.base) AS last_word,
           coalesce(string_agg(DISTINCT p.label, ',' ORDER BY p.label) FILTER (WHERE p.base), '') AS base_labels,
           coalesce(string_agg(DISTINCT p.label, ',' ORDER BY p.label), '') AS labels, coalesce(max(p.share), 0) AS score
    FROM words d LEFT JOIN places p ON p.doc_id = d.doc_id GROUP BY d.doc_id, len(d.w)
    """


@query("op11_licence_scan", _licence_sql())
def op11_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.find_licences(documents(spark, folder))
    base = F.filter("places", lambda p: p["base"])
    starts = F.transform(base, lambda p: p["start"])
    joined = lambda places: F.array_join(F.array_sort(F.array_distinct(F.transform(places, lambda p: p["label"]))), ",")
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("places")).alias("labels"),
        F.coalesce(F.array_max(F.transform("places", lambda p: p["share"])), F.lit(0.0)).alias("score"),
    )


@query(
    "op12_spelling_variants",
    """
    WITH RECURSIVE crc AS (
      SELECT list_transform(range(256), lambda i: list_reduce([CAST(i AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
               lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t
    ),
    runs AS (
      SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run
      FROM documents
    ),
    counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 7 GROUP BY ALL),
    bytes AS (
      SELECT *, flatten(list_transform(string_split(concat(doc_id, ':', run), ''),
                  lambda c: CASE WHEN unicode(c) < 128 THEN [CAST(unicode(c) AS BIGINT)] ELSE [192 | (unicode(c) >> 6), 128 | (unicode(c) & 63)] END)) AS b
      FROM counted
    ),
    hashed AS (
      SELECT doc_id, run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
      FROM bytes CROSS JOIN crc
    ),
    words AS (
      SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word, CAST(sum(n) AS BIGINT) AS n
      FROM hashed GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7
    ),
    cuts AS (
      SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
    ),
    near AS (
      SELECT a.word, b.word AS near, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
      UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word
    ),
    best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM near GROUP BY 1),
    forms AS (
      SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.near_n >= 10 * w.n THEN b.near END AS form, CASE WHEN b.near_n >= 10 * w.n THEN b.near_n END AS form_n
      FROM words w LEFT JOIN best b ON b.word = w.word
    ),
    chain AS (SELECT word, word AS root, form AS next FROM forms UNION ALL SELECT c.word, f.word, f.form FROM chain c JOIN forms f ON f.word = c.next)
    SELECT f.word, f.form, c.root, f.n, f.n_near, f.form_n FROM forms f JOIN chain c ON c.word = f.word AND c.next IS NULL
    """,
)
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(spelling.corpus_words(documents(spark, folder), altered=drop_letter))


def drop_letter(id_: Column, run: Column) -> Column:
    """A run without one code point where 31 divides its checksum; a null id counts as empty text."""
    h = F.crc32(F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), run).cast("binary")).cast("long")
    at = (h % F.char_length(run)).cast("int")
    return F.when(h % 31 == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.char_length(run)))).otherwise(run)


@query("op13_embedding_whitening")
def op13_embedding_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten.whiten(spark.read.parquet(f"{folder}/embeddings.parquet"))
