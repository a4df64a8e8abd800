"""Signed status and entity matching."""

from __future__ import annotations

from pyspark.sql import functions as F

from cadenza.catalogue.domain import AS_OF, Tables
from cadenza.catalogue.registry import oracle, query, rounded
from cadenza.functions.text import bare_title, clean_artist, clean_name, clean_title, match_key, nfkd
from cadenza.operators.editjoin import fuzzy_best
from cadenza.operators.labels import (
    mark_by_name,
    mark_by_substring,
    newly_signed,
    signed_cascade,
    signed_cascade_songs,
    signed_patch,
)
from cadenza.operators.matching import pair_match, resolve_names, resolve_tracks
from cadenza.operators.winnow import contains_any

_HIT = "EXISTS (SELECT 1 FROM benchmark b WHERE length(b.text) > 0 AND contains(lower(d.text), lower(b.text)))"


@query("substring_flag", oracle(f"SELECT d.doc_id, {_HIT} AS found FROM documents d"))
def substring_flag(spark, folder):
    """Whole documents against the benchmark passages as a list."""
    t = Tables(spark, folder)
    return contains_any(t.documents.select("doc_id", "text"), "text", t.benchmark, "text", "found").select("doc_id", "found")


_LABELS = "SELECT DISTINCT split_part(p_name, ' ', 1) AS label FROM part WHERE p_size < 5"
_SONGS = "SELECT p_partkey AS song_id, p_name AS copyrights, p_brand AS artist, p_type = 'ECONOMY' AS signed FROM part"


def label_list(t: Tables):
    return t.part.filter(F.col("p_size") < 5).select(F.substring_index("p_name", " ", 1).alias("label")).distinct()


def song_rows(t: Tables):
    return t.part.select(
        F.col("p_partkey").alias("song_id"), F.col("p_name").alias("copyrights"), F.col("p_brand").alias("artist"),
        (F.col("p_type") == "ECONOMY").alias("signed"),
    )


_SUB = "EXISTS (SELECT 1 FROM labels l WHERE contains(lower(s.copyrights), lower(l.label)))"


@query("signed_substring", oracle(f"SELECT s.song_id, s.signed OR {_SUB} AS signed FROM songs_in s", labels=_LABELS, songs_in=_SONGS))
def signed_substring(spark, folder):
    t = Tables(spark, folder)
    return mark_by_substring(song_rows(t), "copyrights", label_list(t)).select("song_id", "signed")


_LISTED = "SELECT DISTINCT p_brand AS artist FROM part WHERE p_size = 7 AND p_type <> 'ECONOMY'"


def signed_list(t: Tables):
    return t.part.filter((F.col("p_size") == 7) & (F.col("p_type") != "ECONOMY")).select(F.col("p_brand").alias("artist")).distinct()


@query("signed_exact", oracle("SELECT s.song_id, s.signed OR s.artist IN (SELECT artist FROM listed) AS signed FROM songs_in s", songs_in=_SONGS, listed=_LISTED))
def signed_exact(spark, folder):
    t = Tables(spark, folder)
    return mark_by_name(song_rows(t), signed_list(t)).select("song_id", "signed")


@query("signed_append", oracle("SELECT DISTINCT artist FROM songs_in WHERE signed AND artist NOT IN (SELECT artist FROM listed)", songs_in=_SONGS, listed=_LISTED))
def signed_append(spark, folder):
    t = Tables(spark, folder)
    return newly_signed(song_rows(t), signed_list(t))


@query(
    "signed_patch",
    oracle(
        f"SELECT r.song_id, CAST(r.report_date AS VARCHAR) AS report_date, r.signed OR (r.report_date = DATE '{AS_OF}' AND {_SUB.replace('s.copyrights', 'p.p_name')}) AS signed "
        "FROM (SELECT DISTINCT l_partkey AS song_id, CAST(l_shipdate AS DATE) AS report_date, false AS signed FROM lineitem) r JOIN part p ON p.p_partkey = r.song_id",
        labels=_LABELS,
    ),
)
def signed_patch_query(spark, folder):
    t = Tables(spark, folder)
    reports = t.lineitem.select(F.col("l_partkey").alias("song_id"), F.to_date("l_shipdate").alias("report_date"), F.lit(False).alias("signed")).distinct()
    texts = t.part.select(F.col("p_partkey").alias("song_id"), F.col("p_name").alias("copyrights"))
    return signed_patch(reports, texts, label_list(t), "song_id", AS_OF)


def _key(c: str) -> str:
    return f"lower(regexp_replace(coalesce({c}, ''), '[^\\p{{L}}\\p{{N}}]', '', 'g'))"


def fuzzy_sql(tag: str, queries: str, entries: str, cut: float) -> dict[str, str]:
    """Brute-force SQL of the fuzzy match between two one-column sources (column ``t``)."""
    gram = "SELECT {c}, unnest(list_distinct(list_transform(range(1, length({c}) + 4 - {n}), lambda i: substr('-' || {c} || '-', CAST(i AS INT), {n})))) AS g FROM (SELECT DISTINCT {c} FROM {s})"
    pairs = "SELECT DISTINCT a.q, b.e FROM {a} a JOIN {b} b ON a.g = b.g"
    p = tag
    return {
        f"{p}_q": f"SELECT DISTINCT t, {_key('t')} AS q FROM ({queries})",
        f"{p}_e": f"SELECT {_key('t')} AS e, min(t) AS m FROM ({entries}) WHERE {_key('t')} <> '' GROUP BY 1",
        f"{p}_qn": f"SELECT DISTINCT q FROM {p}_q WHERE q <> ''",
        f"{p}_q3": gram.format(c="q", n=3, s=f"{p}_qn"),
        f"{p}_e3": gram.format(c="e", n=3, s=f"{p}_e"),
        f"{p}_q2": gram.format(c="q", n=2, s=f"{p}_qn"),
        f"{p}_e2": gram.format(c="e", n=2, s=f"{p}_e"),
        f"{p}_p3": pairs.format(a=f"{p}_q3", b=f"{p}_e3"),
        f"{p}_p2": pairs.format(a=f"{p}_q2", b=f"{p}_e2"),
        f"{p}_all": f"SELECT * FROM {p}_p3 UNION ALL SELECT * FROM {p}_p2 WHERE q NOT IN (SELECT q FROM {p}_p3)",
        f"{p}_best": (
            "SELECT q, e, ratio FROM (SELECT q, e, ratio, row_number() OVER (PARTITION BY q ORDER BY (q = e) DESC, ratio DESC, e) AS k FROM "
            f"(SELECT q, e, round(1 - levenshtein(q, e) / CAST(greatest(length(q), length(e)) AS DOUBLE), 12) AS ratio FROM {p}_all)) WHERE k = 1"
        ),
        f"{p}_hit": (
            f"SELECT z.t, n.m AS match, b.ratio + CASE WHEN contains(b.e, b.q) THEN least((1 - b.ratio) * (exp(length(b.q) / 10e0) - 1), (1 - b.ratio) / 2) ELSE 0e0 END AS score "
            f"FROM {p}_best b JOIN {p}_e n ON n.e = b.e JOIN {p}_q z ON z.q = b.q"
        ),
        f"{p}_out": f"SELECT * FROM {p}_hit WHERE score >= {cut}",
    }


@query(
    "fuzzy_best",
    oracle(
        "SELECT t AS url, match, round(score, 6) AS score FROM f_out",
        **fuzzy_sql("f", "SELECT url AS t FROM pages WHERE url LIKE 'https%'", "SELECT url AS t FROM pages WHERE url LIKE 'http:%'", 0.75),
    ),
)
def fuzzy_best_query(spark, folder):
    """Secure page addresses against the plain ones."""
    pages = Tables(spark, folder).pages.select("url")
    left = pages.filter(F.col("url").startswith("https"))
    right = pages.filter(F.col("url").startswith("http:"))
    return fuzzy_best(left, "url", right, "url", 0.75).withColumns(rounded("score"))


_NAMES = "SELECT DISTINCT p_name AS t FROM part"
_ENTRIES = "SELECT CASE WHEN p_size < 2 THEN 'The ' || p_name WHEN p_size < 3 THEN p_name || ' x' WHEN p_size > 49 THEN p_name END AS t FROM part WHERE p_size < 3 OR p_size > 49"


@query(
    "name_resolution",
    oracle(
        "SELECT t AS name, match, round(score, 6) AS score, stage FROM (SELECT *, row_number() OVER (PARTITION BY t ORDER BY stage, score DESC, match) AS k FROM ("
        f"SELECT n.t, e.t AS match, 1e0 AS score, 1 AS stage FROM ({_NAMES}) n JOIN (SELECT DISTINCT t FROM ({_ENTRIES})) e ON e.t = n.t UNION ALL SELECT t, match, score, 2 FROM a_out UNION ALL SELECT substr(t, 5), match, score, 3 FROM b_out)) WHERE k = 1",
        **fuzzy_sql("a", _NAMES, _ENTRIES, 0.9),
        **fuzzy_sql("b", f"SELECT 'The ' || t AS t FROM ({_NAMES})", _ENTRIES, 0.9),
    ),
)
def name_resolution(spark, folder):
    t = Tables(spark, folder)
    some = t.part.filter((F.col("p_size") < 3) | (F.col("p_size") > 49))
    entries = some.select(
        F.when(F.col("p_size") < 2, F.concat(F.lit("The "), F.col("p_name")))
        .when(F.col("p_size") < 3, F.concat(F.col("p_name"), F.lit(" x")))
        .otherwise(F.col("p_name"))
        .alias("entry")
    )
    names = t.part.select(F.col("p_name").alias("name"))
    return resolve_names(names, "name", entries, "entry").withColumns(rounded("score"))


_CASC_LABELS = "SELECT DISTINCT p_brand AS label FROM part WHERE p_size = 3 AND p_type = 'ECONOMY'"
_CASC_ARTISTS = "SELECT DISTINCT p_name AS artist FROM part WHERE p_size = 4 AND p_brand = 'Brand#3'"
_CASC_ROWS = "SELECT p_partkey AS artist_id, CASE WHEN p_size > 40 THEN p_name || ' y' ELSE p_name END AS artist, CASE WHEN p_size <> 5 THEN p_brand || ' Records' END AS copyrights, p_size = 9 AS signed FROM part"


@query(
    "signed_cascade",
    oracle(
        "SELECT r.artist_id, r.signed OR coalesce(EXISTS (SELECT 1 FROM labs l WHERE contains(lower(r.copyrights), lower(l.label))), false) OR r.artist IN (SELECT t FROM f_out) AS signed FROM rws r",
        labs=_CASC_LABELS, listed=_CASC_ARTISTS, rws=_CASC_ROWS,
        **fuzzy_sql("f", "SELECT artist AS t FROM rws", "SELECT artist AS t FROM listed", 0.95),
    ),
)
def signed_cascade_query(spark, folder):
    t = Tables(spark, folder)
    labels = t.part.filter((F.col("p_size") == 3) & (F.col("p_type") == "ECONOMY")).select(F.col("p_brand").alias("label")).distinct()
    listed = t.part.filter((F.col("p_size") == 4) & (F.col("p_brand") == "Brand#3")).select(F.col("p_name").alias("artist")).distinct()
    rows = t.part.select(
        F.col("p_partkey").alias("artist_id"),
        F.when(F.col("p_size") > 40, F.concat("p_name", F.lit(" y"))).otherwise(F.col("p_name")).alias("artist"),
        F.when(F.col("p_size") != 5, F.concat("p_brand", F.lit(" Records"))).alias("copyrights"),
        (F.col("p_size") == 9).alias("signed"),
    )
    return signed_cascade(rows, labels, listed).select("artist_id", "signed")


_SONG_ROWS = "SELECT p_partkey AS song_id, p_name AS label, p_brand AS artist, false AS signed FROM part"
_SONG_LABELS = "SELECT DISTINCT p_name || ' co' AS label FROM part WHERE p_size = 3 UNION SELECT DISTINCT p_name FROM part WHERE p_size = 4 AND p_brand = 'Brand#2'"


@query(
    "signed_cascade_songs",
    oracle(
        "SELECT r.song_id, EXISTS (SELECT 1 FROM labs l WHERE contains(lower(r.label), lower(l.label))) OR r.label IN (SELECT t FROM f_out WHERE score > 0.9) OR r.artist IN (SELECT artist FROM listed) AS signed FROM rws r",
        labs=_SONG_LABELS, listed="SELECT DISTINCT p_brand AS artist FROM part WHERE p_size = 9 AND p_type = 'ECONOMY'", rws=_SONG_ROWS,
        **fuzzy_sql("f", "SELECT label AS t FROM rws", "SELECT label AS t FROM labs", 0.9),
    ),
)
def signed_cascade_songs_query(spark, folder):
    t = Tables(spark, folder)
    co = t.part.filter(F.col("p_size") == 3).select(F.concat("p_name", F.lit(" co")).alias("label"))
    plain = t.part.filter((F.col("p_size") == 4) & (F.col("p_brand") == "Brand#2")).select(F.col("p_name").alias("label"))
    listed = t.part.filter((F.col("p_size") == 9) & (F.col("p_type") == "ECONOMY")).select(F.col("p_brand").alias("artist"))
    rows = t.part.select(F.col("p_partkey").alias("song_id"), F.col("p_name").alias("label"), F.col("p_brand").alias("artist"), F.lit(False).alias("signed"))
    return signed_cascade_songs(rows, co.union(plain).distinct(), listed).select("song_id", "signed")


def _lcs(a: str, b: str) -> str:
    """Longest common subsequence length of two texts, row by row over the characters of ``b``."""
    inner = (
        "list_reduce(list_concat([[0]], list_transform(range(1, length({a}) + 1), lambda k: [CAST(k AS INT)])), "
        "lambda r, k: list_append(r, greatest(prev[k[1] + 1], r[len(r)], prev[k[1]] + CASE WHEN unicode(substr({a}, k[1], 1)) = c[1] THEN 1 ELSE 0 END)))"
    ).format(a=a)
    return (
        f"list_reduce(list_concat([list_transform(range(0, length({a}) + 1), lambda z: 0)], list_transform(range(1, length({b}) + 1), lambda j: [unicode(substr({b}, CAST(j AS INT), 1))])), "
        f"lambda prev, c: {inner})[length({a}) + 1]"
    )


def _ratio(a: str, b: str) -> str:
    return f"(2e0 * {_lcs(a, b)} / (length({a}) + length({b})))"


_CAT = "SELECT p_partkey AS song_id, lower(p_brand) AS na, lower(p_name || CASE WHEN p_size < 10 THEN ' (live)' ELSE '' END) AS nt FROM part"
_WANT = "SELECT DISTINCT p_type || ' ' || p_brand AS artist, replace(p_name, 'e', '') || 's' AS title FROM part WHERE p_size < 30"


@query(
    "pair_match",
    oracle(
        "SELECT w.artist, w.title, min(c.song_id) AS song_id FROM (SELECT artist, title, lower(artist) AS a, lower(title) AS q FROM want) w "
        "JOIN near n ON n.q = w.q JOIN cat c ON c.nt = n.nt JOIN alike x ON x.a = w.a AND x.na = c.na GROUP BY 1, 2",
        cat=_CAT, want=_WANT,
        names="SELECT DISTINCT nt FROM cat",
        near=(
            "SELECT q, nt FROM (SELECT DISTINCT lower(title) AS q FROM want) CROSS JOIN (SELECT nt, nt AS v FROM names UNION SELECT nt, split_part(split_part(nt, '(', 1), '   ', 1) FROM names) "
            f"WHERE {_ratio('q', 'v')} > 0.75"
        ),
        alike=f"SELECT a, na FROM (SELECT DISTINCT lower(artist) AS a FROM want) CROSS JOIN (SELECT DISTINCT na FROM cat) WHERE contains(a, na) OR contains(na, a) OR {_ratio('a', 'na')} > 0.75",
    ),
)
def pair_match_query(spark, folder):
    """Misspelt titles with an artist that contains the catalogue's, some catalogue titles bracketed."""
    t = Tables(spark, folder)
    live = F.when(F.col("p_size") < 10, " (live)").otherwise("")
    catalogue = t.part.select(F.col("p_partkey").alias("song_id"), F.col("p_brand").alias("artist"), F.concat("p_name", live).alias("title"))
    want = t.part.filter(F.col("p_size") < 30).select(
        F.concat_ws(" ", "p_type", "p_brand").alias("artist"), F.concat(F.replace("p_name", F.lit("e"), F.lit("")), F.lit("s")).alias("title")
    )
    return pair_match(want, catalogue.withColumn("place", F.col("song_id")), "song_id", "place")


_TRACKS = "SELECT p_partkey AS track_id, 'I' || CAST(p_partkey AS VARCHAR) AS isrc, p_name AS name, p_brand AS artist FROM part WHERE p_size < 20"
_WISH = "SELECT DISTINCT CASE WHEN p_size < 25 THEN 'I' || CAST(p_partkey AS VARCHAR) END AS isrc, replace(p_brand, '#', ' no ') AS artist, p_name || 's' AS title FROM part"


@query(
    "staged_match",
    oracle(
        "SELECT isrc, artist, title, track_id, round(score, 6) AS score, stage FROM (SELECT *, row_number() OVER (PARTITION BY isrc, artist, title ORDER BY stage, score DESC, track_id) AS k FROM ("
        "SELECT w.*, t.track_id, 1e0 AS score, 1 AS stage FROM wish w JOIN trk t ON t.isrc = w.isrc "
        f"UNION ALL SELECT w.*, t.track_id, a.score, 2 FROM wish w JOIN a_out a ON a.t = w.title JOIN trk t ON {_key('t.name')} = {_key('a.match')} AND {_key('t.artist')} = {_key('w.artist')} "
        f"UNION ALL SELECT w.*, t.track_id, least(a.score, b.score), 3 FROM wish w JOIN a_out a ON a.t = w.title JOIN b_out b ON b.t = w.artist JOIN trk t ON {_key('t.name')} = {_key('a.match')} AND {_key('t.artist')} = {_key('b.match')} WHERE a.score >= 0.8 AND b.score >= 0.8 "
        f"UNION ALL SELECT w.*, t.track_id, b.score, 4 FROM wish w JOIN b_out b ON b.t = w.artist JOIN trk t ON {_key('t.name')} = {_key('w.title')} AND {_key('t.artist')} = {_key('b.match')})) WHERE k = 1",
        trk=_TRACKS, wish=_WISH,
        **fuzzy_sql("a", "SELECT title AS t FROM wish", "SELECT name AS t FROM trk", 0.75),
        **fuzzy_sql("b", "SELECT artist AS t FROM wish", "SELECT artist AS t FROM trk", 0.75),
    ),
)
def staged_match(spark, folder):
    t = Tables(spark, folder)
    code = F.concat(F.lit("I"), F.col("p_partkey").cast("string"))
    landed = t.part.filter(F.col("p_size") < 20).select(F.col("p_partkey").alias("track_id"), code.alias("isrc"), F.col("p_name").alias("name"), F.col("p_brand").alias("artist"))
    wish = t.part.select(
        F.when(F.col("p_size") < 25, code).alias("isrc"), F.replace("p_brand", F.lit("#"), F.lit(" no ")).alias("artist"), F.concat("p_name", F.lit("s")).alias("title")
    )
    return resolve_tracks(wish, landed).withColumns(rounded("score"))


@query("match_key", oracle(f"SELECT doc_id, md5({_key('text')}) AS key FROM documents"))
def match_key_query(spark, folder):
    """Whole documents reduced to letters and digits."""
    return Tables(spark, folder).documents.select("doc_id", F.md5(match_key(F.col("text"))).alias("key"))


@query("text_nfkd", oracle("SELECT doc_id, md5(strip_accents(text)) AS plain FROM documents"))
def text_nfkd(spark, folder):
    """Compatibility decomposition, shown with its combining marks removed."""
    plain = F.regexp_replace(nfkd(F.col("text")), r"\p{M}", "")
    return Tables(spark, folder).documents.select("doc_id", F.md5(plain).alias("plain"))


_RAW = "' [x] ' || s_name || ', (live) & co - ' || CAST(s_suppkey AS VARCHAR) || ' Feat. someone ~ other'"


@query(
    "query_cleaning",
    oracle(
        f"SELECT s_suppkey, substr(split_part(replace(replace(replace(replace({_RAW}, '[', ''), ',', ''), ']', ''), '&', ' '), 'Feat.', 1), 1, 100) AS name, "
        f"substr(trim(regexp_replace(split_part(split_part(replace(replace(replace(replace(replace(replace(replace({_RAW}, '[', ''), ']', ''), '&', ' '), 'Feat.', ' '), ',', ' '), '(', ' '), ')', ' '), ' ~ ', 1), ' - ', 1), '\\s+', ' ', 'g')), 1, 37) AS artist, "
        f"substr(trim(regexp_replace(split_part(trim(split_part(replace(replace(replace(replace(replace(replace({_RAW}, '[', ''), ']', ''), '&', ' '), ',', ' '), '(', ' '), ')', ' '), 'Feat.', 1)), ' - ', 1), '\\s+', ' ', 'g')), 1, 37) AS title, "
        f"split_part(split_part({_RAW}, '(', 1), '   ', 1) AS bare FROM supplier"
    ),
)
def query_cleaning(spark, folder):
    """Names and titles with brackets, guests and separators made into lookup texts."""
    t = Tables(spark, folder)
    raw = F.concat(F.lit(" [x] "), F.col("s_name"), F.lit(", (live) & co - "), F.col("s_suppkey").cast("string"), F.lit(" Feat. someone ~ other"))
    return t.supplier.select("s_suppkey", clean_name(raw).alias("name"), clean_artist(raw).alias("artist"), clean_title(raw).alias("title"), bare_title(raw).alias("bare"))
