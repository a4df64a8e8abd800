"""Edit-distance joins by segments, and searches for the nearest entry in a stored index.

An entry of ``m`` characters may be ``d`` edits away from a text at a given ratio. Cut into
more than ``d`` segments, it leaves one untouched, and the text holds that segment near its
own place. So an entry keeps its ``d + 1`` rarest segments, a text asks for what it has at
the places where each segment can lie, and the join is on one key of (ratio, length, segment
number, segment). A bit for each (character, occurrence) bounds the edits from below: it is
part of the join condition, so only pairs that can be near leave the join.

That finds all pairs. Texts that are much alike share their segments with most others, so a
search, which asks for the best entry only, goes down a tree of the entries (``nearest``).

The index is a table in the shared folder. More entries extend it; all searches share it.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.text import match_key
from cadenza.operators.keys import first_per_key
from cadenza.operators.nearest import near_entries
from cadenza.operators.winnow import containment_pairs
from cadenza.session import materialise

GRAM_SIZES = (3, 2)  # fixed values: tried in this order
#: Ratios that are tried before an asked-for one well below: most texts have a nearer entry, at less cost.
#: The more entries there are, the nearer the nearest; at a high ratio few others are met beside it.
NEARER = (0.92, 0.89, 0.86, 0.82)
#: Segments beyond ``d + 1``, so that the most common ones need not be looked up.
SPARE = 2
#: 64-bit words of the bits of a text.
WORDS = 4
_EPS = 1e-9


def char_grams(c: Column, size: int) -> Column:
    """All overlapping pieces of ``size`` characters, in one pass over the text."""
    return F.regexp_extract_all(c, F.lit("(?s)(?=(.{%d}))" % size), F.lit(1))


def padded_grams(c: Column, size: int) -> Column:
    return char_grams(F.concat(F.lit("-"), c, F.lit("-")), size)


def marks(text: str) -> Column:
    """The bits of a text column: one, by hash, for each character and number of its occurrence.

    An inserted or a deleted character sets or clears one of them at most, a replaced one both.
    """
    ordered = f"array_join(array_sort(regexp_extract_all({text}, '(?s).', 0)), '')"
    runs = rf"regexp_extract_all({ordered}, '(?s)(.)\\1*', 0)"
    each = f"flatten(transform({runs}, r -> transform(sequence(1, length(r)), k -> pmod(xxhash64(substr(r, 1, k)), {64 * WORDS}))))"
    word = "aggregate(filter({each}, p -> p div 64 = {w}), 0L, (held, p) -> held | shiftleft(1L, int(p % 64)))"
    return F.expr("array(" + ", ".join(word.format(each=each, w=w) for w in range(WORDS)) + ")")


def fewest_edits(a: str, b: str) -> str:
    """A lower bound of the edit distance, by the bits of two texts."""
    gone = " + ".join(f"bit_count({a}[{w}] & ~{b}[{w}])" for w in range(WORDS))
    come = " + ".join(f"bit_count({b}[{w}] & ~{a}[{w}])" for w in range(WORDS))
    return f"greatest({gone}, {come})"


def most_edits(n: str, m: str, floor: float | str) -> str:
    """Edits between texts of ``n`` and ``m`` characters that leave a ratio of ``floor``."""
    return f"int(floor((1 - double({floor})) * greatest({n}, {m}) + {_EPS}))"


def _may_be_near(n: str, m: str, a: str, b: str, floor: float | str) -> str:
    """What lengths and bits tell of two texts, as a join condition."""
    allowed = most_edits(n, m, floor)
    return f"abs({n} - {m}) <= {allowed} AND {fewest_edits(a, b)} <= {allowed}"


def _kept(m: str, floor: float) -> str:
    """How many segments an entry keeps: one more than the edits that it may be away from any text."""
    return f"int(floor((1 - double({floor})) * floor({m} / double({floor}) + {_EPS}) + {_EPS}) + 1)"


def _cut(m: str, floor: float) -> str:
    """How many segments it is cut into."""
    return f"least({m}, {_kept(m, floor)} + {SPARE})"


def _start(number: str) -> str:
    return f"int({number} * m div of)"


def entry_segments(entries: DataFrame, floor: float) -> DataFrame:
    """``key``, ``entry``, ``m`` and ``marks`` for the segments that each entry keeps.

    ``entries`` has distinct ``entry`` texts with their ``marks``. Which segments are kept is
    free; the rarest ones among these entries meet the fewest texts.
    """
    each = entries.selectExpr("entry", "marks", "length(entry) AS m").selectExpr("*", f"{_cut('m', floor)} AS of", f"{_kept('m', floor)} AS kept")
    each = each.selectExpr("*", "explode(sequence(0, of - 1)) AS i")
    piece = f"substr(entry, {_start('i')} + 1, {_start('(i + 1)')} - {_start('i')})"
    keyed = each.selectExpr("entry", "marks", "m", "kept", f"xxhash64(double({floor}), m, i, {piece}) AS key")
    common = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("df"))
    # an entry has few segments, so they fit one array
    own = keyed.join(common.hint("merge"), "key").groupBy("entry", "marks", "m", "kept").agg(F.expr("sort_array(collect_list(struct(df, key))) AS s"))
    return own.selectExpr("explode(slice(s, 1, kept).key) AS key", "entry", "m", "marks")


def asked_segments(texts: DataFrame, floor: float) -> DataFrame:
    """``key``, ``query``, ``n`` and ``marks`` for all that a text has where a segment can lie.

    With ``d`` edits in all, of which ``n - m`` only change the length, what stands before a
    segment moves it by half the others at most.
    """
    lengths = f"sequence(int(greatest(ceil(double({floor}) * length(query) - {_EPS}), 1)), int(floor(length(query) / double({floor}) + {_EPS})))"
    each = texts.selectExpr("query", "marks", "length(query) AS n", f"explode({lengths}) AS m")
    each = each.selectExpr("*", f"{most_edits('n', 'm', floor)} AS d", f"{_cut('m', floor)} AS of")
    each = each.selectExpr("*", "explode(sequence(0, of - 1)) AS i")
    each = each.selectExpr("*", f"{_start('i')} AS at", f"{_start('(i + 1)')} - {_start('i')} AS size")
    low, high = "greatest(at - (d - n + m) div 2, 0)", "least(at + (d + n - m) div 2, n - size)"
    each = each.selectExpr("query", "marks", "n", "m", "i", "size", f"int({low}) AS low", f"int({high}) AS high").filter("low <= high")
    each = each.selectExpr("query", "marks", "n", "m", "i", "size", "explode(sequence(low, high)) AS at")
    return each.selectExpr(f"xxhash64(double({floor}), m, i, substr(query, at + 1, size)) AS key", "query", "n", "marks")


def met_pairs(texts: DataFrame, segments: DataFrame, floor: float) -> DataFrame:
    """(query, entry) that share a segment and may have a ratio of ``floor``, as far as bits and lengths tell."""
    q, e = asked_segments(texts, floor).alias("q"), segments.alias("e")
    may = F.expr("q.key = e.key AND " + _may_be_near("q.n", "e.m", "q.marks", "e.marks", floor))
    # pairs are few bytes but much work to rate, so they are dealt over all tasks
    tasks = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the size of a file says little about what its texts ask for: never broadcast that
    return q.join(e.hint("merge"), may).select("query", "entry").repartition(tasks, "query", "entry").distinct()


def edit_pairs(queries: DataFrame, entries: DataFrame, floor: float) -> DataFrame:
    """All (query, entry, ratio) of distinct, non-empty texts with an edit ratio of ``floor`` or more (above 0.5)."""
    if floor <= 0.5:
        raise ValueError("at a ratio of 0.5 no segment needs to be left")
    texts = _with_marks(queries, "query")
    return _rated(met_pairs(texts, entry_segments(_with_marks(entries, "entry"), floor), floor), floor)


def _with_marks(texts: DataFrame, column: str) -> DataFrame:
    return texts.select(column).filter(F.length(column) > 0).distinct().withColumn("marks", marks(column))


def _rated(pairs: DataFrame, floor: float | str) -> DataFrame:
    """The ratio of each pair that reaches ``floor``; the distance is only followed as far as that allows."""
    longer = "greatest(length(query), length(entry))"
    return _with_ratio(pairs.selectExpr("*", f"levenshtein(query, entry, {most_edits(longer, longer, floor)} + 1) AS edits").filter("edits >= 0"), floor)


def _with_ratio(pairs: DataFrame, floor: float | str) -> DataFrame:
    longer = "greatest(length(query), length(entry))"
    return pairs.selectExpr("*", f"round(1 - edits / {longer}, 12) AS ratio").filter(f"ratio >= double({floor})").drop("edits")


# --- the index --------------------------------------------------------------------------


@dataclass(frozen=True)
class EntryIndex:
    """``entries`` has (entry, match): match keys with the smallest text of each.
    ``grams`` has the 3-grams that occur in entries. Searches try the ratios ``floors``."""

    cut: float
    floors: tuple[float, ...]
    entries: DataFrame
    grams: DataFrame

    def at(self, floor: float) -> DataFrame:
        """The segments that the entries keep at a ratio of ``floor``, for a join of all pairs."""
        return entry_segments(self.entries.select("entry", marks("entry").alias("marks")), floor)


def _keyed_entries(entries: DataFrame, column: str) -> DataFrame:
    texts = entries.select(F.col(column).alias("match")).distinct().withColumn("entry", match_key(F.col("match")))
    return texts.filter(F.length("entry") > 0).groupBy("entry").agg(F.min("match").alias("match"))


def _entry_grams(entries: DataFrame) -> DataFrame:
    return materialise(entries.select(F.explode(padded_grams(F.col("entry"), GRAM_SIZES[0])).alias("gram")).distinct(), "edit-grams")


def index_entries(entries: DataFrame, column: str, cut: float) -> EntryIndex:
    """Write the index of the texts of ``column``, for searches at ``cut``."""
    if 2 * cut - 1 <= 0:
        raise ValueError("a cut of 0.5 or less matches anything that shares one gram")
    held = materialise(_keyed_entries(entries, column), "edit-entries")
    floors = (*(f for f in NEARER if f > cut + 0.05), cut)
    return EntryIndex(cut, floors, held, _entry_grams(held))


def extend_index(index: EntryIndex, entries: DataFrame, column: str) -> EntryIndex:
    """The index with more entries: only their grams are cut and written. A new text that shares
    its key with an old one counts if it is smaller."""
    more = materialise(_keyed_entries(entries, column), "edit-entries")
    new = more.join(index.entries, "entry", "left_anti")
    both = index.entries.unionByName(more).groupBy("entry").agg(F.min("match").alias("match"))
    return replace(
        index,
        entries=materialise(both, "edit-entries"),
        grams=index.grams.unionByName(_entry_grams(new)),
    )


# --- the best entry -----------------------------------------------------------------------


def substring_bonus(query: Column, entry: Column, ratio: Column) -> Column:
    """Extra score when the whole query occurs in the entry: at most half the missing rest."""
    rest = F.lit(1.0) - ratio
    weight = F.exp(F.length(query) / F.lit(10.0)) - 1
    return F.when(F.contains(entry, query), F.least(rest * weight, rest / 2)).otherwise(F.lit(0.0))


def _share_a_gram(size: int) -> Column:
    return F.arrays_overlap(padded_grams(F.col("query"), size), padded_grams(F.col("entry"), size))


def _valid(pairs: DataFrame) -> DataFrame:
    """Pairs that share a 3-gram, or a 2-gram where the query's 3-grams occur in no entry (``strange``)."""
    wide, narrow = GRAM_SIZES
    return pairs.filter(_share_a_gram(wide) | (F.col("strange") & _share_a_gram(narrow)))


def _best(pairs: DataFrame) -> DataFrame:
    return first_per_key(pairs.select("query", "entry", "ratio"), ["query"], [F.col("ratio").desc(), F.col("entry").asc()])


def _by_bonus(todo: DataFrame, index: EntryIndex) -> DataFrame:
    """The best entry below the cut, for queries that some entry contains.

    Such an entry of ``m`` characters has the ratio ``n / m``, so the best one has that at
    least: only pairs at that ratio are rated. What shares a gram meets in a join on it.
    """
    floor = 2 * index.cut - 1
    inside = containment_pairs(todo, "query", index.entries, "entry").filter(f"length(query) >= double({floor}) * length(entry) - {_EPS}")
    shortest = _valid(inside.join(todo, "query")).groupBy("query", "strange").agg(F.min(F.length("entry")).alias("m"))
    asked = materialise(shortest.withColumn("marks", marks("query")).selectExpr("query", "marks", "strange", "round(length(query) / m, 12) AS least"), "edit-inside")
    # bits are much work to make, and mostly there is nothing to compare
    marked = materialise(index.entries.select("entry", marks("entry").alias("marks")).filter(F.lit(not asked.isEmpty())), "edit-marks")
    parts = []
    for size, some in zip(GRAM_SIZES, (~F.col("strange"), F.col("strange")), strict=True):
        q = asked.filter(some).withColumn("gram", F.explode(F.array_distinct(padded_grams(F.col("query"), size)))).alias("q")
        e = marked.select("entry", "marks", F.explode(F.array_distinct(padded_grams(F.col("entry"), size))).alias("gram")).alias("e")
        may = F.expr("q.gram = e.gram AND " + _may_be_near("length(query)", "length(entry)", "q.marks", "e.marks", "least"))
        parts.append(q.join(e.hint("merge"), may).select("query", "entry", "least"))
    return _best(_rated(parts[0].unionByName(parts[1]).distinct(), "least"))


def search(index: EntryIndex, queries: DataFrame, column: str) -> DataFrame:
    """The best entry for every distinct text of ``column`` that scores the index's cut: ``(column, match, score)``.

    Equal keys come first, then pairs at the nearer ratios, then at the cut, each search for
    what the ones before left over; what each finds is written, so nothing is searched twice.
    At last come queries that are part of an entry: only they can reach the cut by the bonus.
    """
    texts = queries.select(F.col(column)).distinct().withColumn("query", match_key(F.col(column))).filter(F.length("query") > 0)
    grams = texts.select("query", F.explode(padded_grams(F.col("query"), GRAM_SIZES[0])).alias("gram")).distinct()
    known = grams.join(index.grams, "gram", "left_semi").select("query").distinct().withColumn("known", F.lit(True))
    asked = texts.join(known, "query", "left").select(column, "query", F.col("known").isNull().alias("strange"))
    asked = materialise(asked, "edit-queries")
    todo = asked.select("query", "strange").dropDuplicates(["query"])
    same = F.col("query") == F.col("entry")
    found = [todo.join(index.entries.select("entry"), same).select("query", "entry", F.lit(1.0).alias("ratio"))]
    todo = materialise(todo.join(index.entries.select("entry"), same, "left_anti"), "edit-todo")
    for floor in index.floors:
        best = materialise(_best(_with_ratio(near_entries(todo, index.entries, floor), floor)), "edit-best")
        found.append(best)
        todo = materialise(todo.join(best.select("query"), "query", "left_anti"), "edit-todo")
    found.append(_by_bonus(todo, index))
    score = F.col("ratio") + substring_bonus(F.col("query"), F.col("entry"), F.col("ratio"))
    scored = reduce(DataFrame.unionByName, found).join(index.entries.select("entry", "match"), "entry").withColumn("score", score)
    return scored.filter(F.col("score") >= index.cut).join(asked.select(column, "query"), "query").select(column, "match", "score")


def fuzzy_best(queries: DataFrame, query_col: str, entries: DataFrame, entry_col: str, cut: float) -> DataFrame:
    """The best entry for every distinct query that scores at least ``cut``: ``(query_col, match, score)``.

    Score = edit ratio of the best entry plus the substring bonus. The best entry is the one
    of largest ratio among those that share a 3-gram; queries whose 3-grams occur in no entry
    are searched by 2-grams. The bonus gives at most half of what is missing, so only ratios
    of ``2 * cut - 1`` and more can get there. Ties go to the smallest text.
    """
    return search(index_entries(entries, entry_col, cut), queries, query_col)

