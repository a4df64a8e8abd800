"""Entity matching by blocked joins that lose no match above the asked-for score.

Names and titles are scored by edit distance against a stored index (``editjoin``), whose
searches see only what the stage before left over. (artist, title) pairs are scored by
insertions and deletions: candidates share one of their rarest bigrams, as many as are
needed so that two texts above the threshold must have one of them in common.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadenza.functions.text import bare_title, indel_ratio, match_key
from cadenza.operators.editjoin import index_entries, padded_grams, search
from cadenza.operators.keys import first_per_key
from cadenza.operators.winnow import containment_pairs
from cadenza.session import materialise


def _rare_prefix(texts: DataFrame, floor: float) -> DataFrame:
    """The rarest bigrams of each text ``t``, enough to meet every text of indel ratio > ``floor``.

    With ``n`` and ``m`` characters and a common subsequence of ``L``, the edits destroy at
    most ``2(n-L) + (m-L)`` of the ``n+1`` padded bigrams. ``L > floor(n+m)/2`` and
    ``m >= n * floor / (2 - floor)`` bound the survivors from below, so that many may be left out.
    """
    n = F.length("t").cast("double")
    shortest = n * F.lit(floor / (2 - floor))
    survive = F.lit(1.0) + (F.lit(1.5 * floor) - 1) * (n + shortest)
    keep = n + 1 - F.greatest(F.floor(survive + F.lit(1e-9)), F.lit(1)) + 1
    each = texts.withColumn("gram", F.explode(padded_grams(F.col("t"), 2)))
    rarity = each.groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    ranked = F.row_number().over(Window.partitionBy("t").orderBy("df", "gram"))
    return each.join(rarity, "gram").withColumn("__nth", ranked).filter(F.col("__nth") <= keep).drop("df", "__nth").distinct()


def _bigram_prefixes(left: DataFrame, right: DataFrame, floor: float) -> tuple[DataFrame, DataFrame]:
    """(query, gram) and (entry, gram): pairs with an indel ratio above ``floor`` share a gram.

    One table of the distinct texts of both sides holds the prefixes, written once.
    """
    if floor <= 2 / 3:
        raise ValueError("the bigram bound needs a floor above 2/3")
    sides = left.select(F.col("query").alias("t"), F.lit(True).alias("asked")).unionByName(right.select(F.col("entry").alias("t"), F.lit(False).alias("asked")))
    texts = sides.groupBy("t").agg(F.max("asked").alias("asked"), F.max(~F.col("asked")).alias("held"))
    prefixes = materialise(_rare_prefix(texts, floor), "bigram-prefixes")
    return (
        prefixes.filter("asked").select(F.col("t").alias("query"), "gram"),
        prefixes.filter("held").select(F.col("t").alias("entry"), "gram"),
    )


def _near(floor: float) -> Column:
    """Lengths of ``query`` and ``entry`` that allow an indel ratio above ``floor``."""
    n, m = F.length("query"), F.length("entry")
    return 2 * F.least(n, m) > F.lit(floor) * (n + m)


def indel_pairs(left: DataFrame, right: DataFrame, floor: float) -> DataFrame:
    """All (query, entry) pairs of distinct texts with an indel ratio above ``floor`` (> 2/3)."""
    asked, index = _bigram_prefixes(left, right, floor)
    met = asked.join(index, "gram").filter(_near(floor)).select("query", "entry").distinct()
    return met.withColumn("ratio", indel_ratio("query", "entry")).filter(F.col("ratio") > floor)


def artist_pairs(left: DataFrame, right: DataFrame, floor: float) -> DataFrame:
    """(a, na) of distinct names whose indel ratio exceeds ``floor``, or one contains the other."""
    close = indel_pairs(left.select(F.col("a").alias("query")), right.select(F.col("na").alias("entry")), floor)
    return (
        close.select(F.col("query").alias("a"), F.col("entry").alias("na"))
        .unionByName(containment_pairs(left, "a", right, "na"))
        .unionByName(containment_pairs(right, "na", left, "a").select("a", "na"))
        .distinct()
    )


def pair_match(
    rows: DataFrame, catalogue: DataFrame, catalogue_id: str, order: str, floor: float = 0.75
) -> DataFrame:
    """(artist, title) of ``rows`` to an id of ``catalogue`` (artist, title, id, order).

    The title ratio must exceed ``floor``, against the catalogue title or against its
    bare form. The artist ratio must exceed ``floor``, or one (non-empty) name contain the
    other. The first hit in catalogue order wins.

    Artist names are paired first, on the few distinct names. Titles then meet on artist
    *and* rare bigram, so neither a popular artist nor a common bigram brings many
    candidates together. Names, titles and their prefixes are written once.
    """
    want = rows.select(
        "artist", "title", F.lower("artist").alias("a"), F.lower("title").alias("query")
    ).distinct()
    want = materialise(want.filter(F.col("a").isNotNull() & F.col("query").isNotNull()), "pair-wanted")
    have = (
        catalogue.select(
            F.col(catalogue_id), F.col(order).alias("__order"), F.lower("artist").alias("na"), F.lower("title").alias("__nt")
        )
        .groupBy("na", "__nt")
        .agg(F.min(F.struct("__order", catalogue_id)).alias("__first"))
    )
    spelled = have.withColumn("entry", F.explode(F.array_distinct(F.array("__nt", bare_title(F.col("__nt"))))))
    spelled = materialise(spelled.groupBy("na", "entry").agg(F.min("__first").alias("__first")), "pair-spelled")
    known = materialise(artist_pairs(want.select("a").distinct(), spelled.select("na").distinct(), floor), "pair-artists")
    asked, index = _bigram_prefixes(want, spelled, floor)
    sought = want.select("a", "query").distinct().join(known, "a")
    left = sought.select("na", "query").distinct().join(asked, "query")
    right = spelled.select("na", "entry").join(index, "entry")
    met = left.join(right, ["na", "gram"]).filter(_near(floor)).select("na", "query", "entry").distinct()
    met = materialise(met, "pair-met")
    alike = met.select("query", "entry").distinct().filter(indel_ratio("query", "entry") > floor)
    hits = met.join(alike, ["query", "entry"]).join(spelled, ["na", "entry"])
    per_name = hits.groupBy("na", "query").agg(F.min("__first").alias("__f"))
    first = sought.join(per_name, ["na", "query"]).groupBy("a", "query").agg(F.min("__f").alias("__f"))
    return want.join(first, ["a", "query"]).select(
        "artist", "title", F.col(f"__f.{catalogue_id}").alias(catalogue_id)
    )


def first_stage(*stages: DataFrame, keys: list[str], ties: list[Column]) -> DataFrame:
    """Union of resolution stages; per key the first stage that has a hit wins."""
    union = None
    for number, stage in enumerate(stages, 1):
        part = stage.withColumn("stage", F.lit(number))
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    return first_per_key(union, keys, [F.col("stage").asc(), *ties])


def resolve_names(queries: DataFrame, query_col: str, entries: DataFrame, entry_col: str, cut: float = 0.9) -> DataFrame:
    """Exact name, else fuzzy at ``cut``, else the same with "The " in front.

    One index of the entries serves both searches; each stage sees what the one before left.
    """
    index = index_entries(entries, entry_col, cut)
    names = materialise(queries.select(query_col).filter(F.col(query_col).isNotNull()).distinct(), "resolve-names")
    listed = entries.select(F.col(entry_col).alias("match")).distinct()
    exact = names.join(listed, F.col(query_col) == F.col("match")).select(query_col, "match", F.lit(1.0).alias("score"))
    left = names.join(exact.select(query_col), query_col, "left_anti")
    fuzzy = materialise(search(index, left, query_col), "resolve-fuzzy")
    the = left.join(fuzzy.select(query_col), query_col, "left_anti").withColumn("__the", F.concat(F.lit("The "), F.col(query_col)))
    retry = the.join(materialise(search(index, the, "__the"), "resolve-retry"), "__the").select(query_col, "match", "score")
    staged = [part.withColumn("stage", F.lit(k)) for k, part in enumerate((exact, fuzzy, retry), 1)]
    return staged[0].unionByName(staged[1]).unionByName(staged[2])


def resolve_tracks(wanted: DataFrame, tracks: DataFrame) -> DataFrame:
    """(isrc, artist, title) to a landed track (track_id, isrc, name, artist).

    Stages: equal isrc; title score of 0.75 among tracks of the same artist name; title
    and artist both 0.8; artist score of 0.75 among tracks of the same title. Each stage
    searches for what the one before left; each index is built once.
    """
    key = ["isrc", "artist", "title"]
    w = wanted.select(*key).distinct().withColumn("__w", F.monotonically_increasing_id())
    w = materialise(w.withColumns({"__n": match_key(F.col("title")), "__a": match_key(F.col("artist"))}), "tracks-wanted")
    names = {"__tn": match_key(F.col("name")), "__ta": match_key(F.col("artist"))}
    t = materialise(tracks.withColumns(names).select("track_id", F.col("isrc").alias("__isrc"), "name", F.col("artist").alias("__artist"), "__tn", "__ta"), "tracks-landed")

    def stage(number: int, hits: DataFrame) -> DataFrame:
        """Per wanted row the best score, ties by id; written, as the next stage leaves these out."""
        hits = first_per_key(hits.select("__w", "track_id", "score"), ["__w"], [F.col("score").desc(), F.col("track_id").asc()])
        return materialise(hits.withColumn("stage", F.lit(number)), "tracks-stage")

    def matched(index, texts: DataFrame, column: str, of: str) -> DataFrame:
        found = search(index, texts, column)
        return materialise(found.select(column, match_key(F.col("match")).alias(of), F.col("score").alias(f"{of}_score")), "tracks-scores")

    same_name, same_artist = F.col("__mn") == F.col("__tn"), F.col("__ma") == F.col("__ta")
    done = [stage(1, w.join(t, F.col("isrc") == F.col("__isrc")).withColumn("score", F.lit(1.0)))]
    left = w.join(done[0], "__w", "left_anti")
    titled = left.join(matched(index_entries(t, "name", 0.75), left, "title", "__mn"), "title")
    done.append(stage(2, titled.join(t, same_name & (F.col("__a") == F.col("__ta"))).withColumn("score", F.col("__mn_score"))))
    left = left.join(done[1], "__w", "left_anti")
    artists = matched(index_entries(t, "__artist", 0.75), left, "artist", "__ma")
    both = titled.join(done[1], "__w", "left_anti").join(artists, "artist").filter("__mn_score >= 0.8 AND __ma_score >= 0.8")
    done.append(stage(3, both.join(t, same_name & same_artist).withColumn("score", F.least("__mn_score", "__ma_score"))))
    left = left.join(done[2], "__w", "left_anti")
    by_artist = left.join(artists, "artist").join(t, (F.col("__n") == F.col("__tn")) & same_artist)
    done.append(stage(4, by_artist.withColumn("score", F.col("__ma_score"))))
    union = done[0]
    for part in done[1:]:
        union = union.unionByName(part)
    return w.join(union, "__w").select(*key, "track_id", "score", "stage")
