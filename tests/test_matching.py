import math
import random

from pyspark.sql import functions as F

from cadenza.functions.text import clean_artist, clean_name, clean_title, contains_any_word, indel_ratio, match_key, nfkd
from cadenza.operators import editjoin, nearest, winnow
from cadenza.operators.editjoin import edit_pairs, extend_index, fuzzy_best, index_entries, search
from cadenza.operators.labels import mark_by_name, newly_signed, signed_cascade, signed_cascade_songs, signed_patch
from cadenza.operators.matching import first_stage, indel_pairs, pair_match, resolve_names, resolve_tracks
from cadenza.operators.winnow import contains_any, containment_pairs
from tests.conftest import rows


def words(seed, n, alphabet="abcde", low=1, high=12):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(alphabet) for _ in range(rng.randint(low, high))) for _ in range(n)})


def grams(t, n):
    t = f"-{t}-"
    return {t[i : i + n] for i in range(len(t) - n + 1)}


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def ratio_of(a, b):
    return round(1 - edit_distance(a, b) / max(len(a), len(b)), 12)


def lcs(a, b):
    row = [0] * (len(a) + 1)
    for ch in b:
        new = [0]
        for i, c in enumerate(a):
            new.append(max(new[-1], row[i + 1], row[i] + (c == ch)))
        row = new
    return row[-1]


def column(spark, values, name):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def test_edit_pairs_lose_nothing(spark):
    left, right = words(1, 90) + ["", "naïve", "ééé", "漢字kana", "a" * 40], words(2, 90) + ["naive", "eee", "漢字kan", "a" * 37 + "bcd"]
    for floor in (0.9, 0.75, 0.6, 0.51):
        got = {(r.query, r.entry): r.ratio for r in edit_pairs(column(spark, left, "query"), column(spark, right, "entry"), floor).collect()}
        assert got == {(a, b): ratio_of(a, b) for a in left for b in right if a and b and ratio_of(a, b) >= floor}


def test_bits_bound_the_edits(spark):
    rng = random.Random(3)
    pairs = [(a, "".join(rng.choice(["", c, c, c, c + "x", "é", "😀"]) for c in a)) for a in words(20, 200, "aab😀", 1, 30)]
    df = spark.createDataFrame(pairs, "a string, b string").withColumns({"ma": editjoin.marks("a"), "mb": editjoin.marks("b")})
    for r in df.selectExpr("a", "b", editjoin.fewest_edits("ma", "mb") + " AS least").collect():
        assert r.least <= edit_distance(r.a, r.b)


def test_few_pairs_meet(spark):
    """On page addresses, which are much alike, a search rates few of all pairs, over all its ratios."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url")
    key = match_key(F.col("url"))
    todo = editjoin._with_marks(pages.filter(F.col("url").startswith("https")).select(key.alias("query")), "query").cache()
    index = index_entries(pages.filter(F.col("url").startswith("http:")), "url", 0.75)
    every, met = todo.count() * index.entries.count(), 0
    for floor in index.floors:
        pairs = editjoin.met_pairs(todo, index.at(floor), floor).cache()
        met += pairs.count()
        todo = todo.join(editjoin._rated(pairs, floor).select("query").distinct(), "query", "left_anti").cache()
    assert met < 0.05 * every and todo.count() < 20


def test_near_entries_are_found_before_far_ones(spark):
    """Texts that are alike by their common parts: where a near entry exists, the others are not met."""
    rng = random.Random(4)
    hosts = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(6)) for _ in range(40)]
    plain = [f"http{rng.choice(hosts)}examplecomen{rng.randrange(10**4)}utmsourcefeed" for _ in range(800)]
    asked = column(spark, [p.replace("http", "https") for p in plain[:400]], "query")
    todo = editjoin._with_marks(asked, "query").cache()
    index, met = index_entries(column(spark, plain, "e"), "e", 0.75), 0
    at_once = editjoin.met_pairs(todo, index.at(0.82), 0.82).count()
    for floor in index.floors:
        pairs = editjoin.met_pairs(todo, index.at(floor), floor).cache()
        met += pairs.count()
        todo = todo.join(editjoin._rated(pairs, floor).select("query").distinct(), "query", "left_anti").cache()
    assert todo.count() == 0 and 4 * met < at_once, (met, at_once)


def nearest_by_force(texts, entries, strange):
    """For each text one minus its best ratio, and that entry."""
    out = {}
    for t, odd in zip(texts, strange):
        near = [(1 - ratio_of(t, e), e) for e in entries if grams(t, 3) & grams(e, 3) or odd and grams(t, 2) & grams(e, 2)]
        if near:
            out[t] = min(near)
    return out


def test_a_tree_gives_the_nearest_entries(spark, monkeypatch):
    rng = random.Random(14)
    long_ = ["".join(rng.choice("abc") for _ in range(rng.randint(90, 130))) for _ in range(5)]
    texts = sorted({*words(15, 60), *words(16, 30, "ab", 1, 25), *long_, "naïve", "ééé", "漢字kana", "a" * 40})
    entries = sorted({*words(17, 60), *words(18, 30, "ab", 1, 25), *(t[:40] + t[44:] for t in long_), "naive", "漢字kan", "a" * 37 + "bcd"})
    strange = [k % 3 == 0 for k in range(len(texts))]
    nearest_ = nearest_by_force(texts, entries, strange)
    for floor in (0.92, 0.75, 0.51):
        want = {t: e for t, (away, e) in nearest_.items() if 1 - away >= floor}
        for cells in (1 << 10, 1 << 21):  # in many pieces, and in one
            monkeypatch.setattr(nearest, "CELLS", cells)
            q, e, edits = nearest.best_of(entries, texts, strange, floor)
            assert {texts[a]: entries[b] for a, b in zip(q, e)} == want and len(q) == len(want)
            assert edits == [edit_distance(texts[a], entries[b]) for a, b in zip(q, e)]


def test_blocks_of_texts_and_entries_meet_once(spark, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 100)
    monkeypatch.setattr(nearest, "TEXTS", 20)
    left, right = words(19, 80, "abcd", 3, 10), words(20, 150, "abcd", 3, 10)
    found = nearest.near_entries(column(spark, left, "query").withColumn("strange", F.lit(False)), column(spark, right, "entry"), 0.7).collect()
    best = {}
    for r in found:
        assert r.edits == edit_distance(r.query, r.entry)
        best[r.query] = min(best.get(r.query, (1, "")), (1 - ratio_of(r.query, r.entry), r.entry))
    assert best == {t: (away, e) for t, (away, e) in nearest_by_force(left, right, [False] * len(left)).items() if 1 - away >= 0.7}
    assert len({(r.query, r.entry) for r in found}) == len(found) > len(best)


def test_texts_share_the_rows_of_a_search(monkeypatch):
    """On addresses that are much alike, a search at all its ratios follows fewer rows than there are pairs."""
    rng = random.Random(21)
    hosts = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(6)) for _ in range(30)]
    made = lambda kind: sorted({f"{kind}{rng.choice(hosts)}examplecom{rng.choice(['en', 'de'])}{rng.randrange(10**5)}{rng.choice(['', 'html', 'top'])}" for _ in range(2000)})
    left, right, rows_met = made("https"), made("http"), []
    step = nearest._Descent._step
    monkeypatch.setattr(nearest._Descent, "_step", lambda self, rows, at, char: (rows_met.append(rows.shape[1]), step(self, rows, at, char))[1])
    todo = left
    for floor in (*editjoin.NEARER, 0.75):
        q, _, _ = nearest.best_of(right, todo, [False] * len(todo), floor)
        todo = [t for k, t in enumerate(todo) if k not in set(q)]
    assert not todo and sum(rows_met) < len(left) * len(right), sum(rows_met) / len(left) / len(right)


def test_a_search_joins_no_segments(spark, monkeypatch):
    """Segments of texts that are much alike meet in more rows than there are pairs."""
    monkeypatch.setattr(editjoin, "met_pairs", None)
    plain = [f"httpexamplecomen{k * 7919 % 10**6}html" for k in range(300)]
    got = {r.q: r.match for r in fuzzy_best(column(spark, [p.replace("http", "https") for p in plain[::2]], "q"), "q", column(spark, plain, "e"), "e", 0.95).collect()}
    assert got == {p.replace("http", "https"): p for p in plain[::2]}


def test_an_index_takes_more_entries(spark):
    left, right = words(5, 60, "abcd", 3, 10), words(6, 200, "abcd", 3, 10)
    whole = index_entries(column(spark, right, "e"), "e", 0.75)
    grown = extend_index(index_entries(column(spark, right[::2], "e"), "e", 0.75), column(spark, right[1::2] + right[:9], "e"), "e")
    asked = column(spark, left, "q")
    assert rows(search(grown, asked, "q")) == rows(search(whole, asked, "q"))
    held = {r.entry: r.n for r in grown.at(0.75).groupBy("entry").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert sorted(held) == right and all(n <= len(t) for t, n in held.items())


def test_misspelt_names(spark):
    got = rows(fuzzy_best(column(spark, ["kendrik lamar", "the weekend"], "q"), "q", column(spark, ["kendrick lamar", "the weeknd"], "e"), "e", 0.75))
    assert [(q, m, round(s, 2)) for q, m, s in got] == [("kendrik lamar", "kendrick lamar", 0.92), ("the weekend", "the weeknd", 0.9)]


def test_indel_pairs_lose_nothing(spark):
    left, right = words(3, 80, "abc"), words(4, 80, "abc")
    got = {(r.query, r.entry) for r in indel_pairs(column(spark, left, "query"), column(spark, right, "entry"), 0.75).collect()}
    want = {(a, b) for a in left for b in right if 2 * lcs(a, b) / (len(a) + len(b)) > 0.75}
    assert got == want and len(want) > 20


def test_indel_ratio(spark):
    pairs = [("kitten", "sitting"), ("", ""), ("a", ""), ("abc", "abc"), (None, "a"), ("naïve", "naive")]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = [r[0] for r in df.select(indel_ratio("a", "b")).collect()]
    assert got[:4] == [2 * 4 / 13, 1.0, 0.0, 1.0] and got[4] is None and got[5] == 0.8


def test_fuzzy_best_against_brute_force(spark):
    left, right = words(5, 120, "abcd", 3, 10), words(6, 300, "abcd", 3, 10)
    got = {r.q: (r.match, round(r.score, 9)) for r in fuzzy_best(column(spark, left, "q"), "q", column(spark, right, "e"), "e", 0.75).collect()}
    want = {}
    for a in left:
        if a in right:
            want[a] = (a, 1.0)
            continue
        size = 3 if any(grams(a, 3) & grams(b, 3) for b in right) else 2
        near = [b for b in right if grams(a, size) & grams(b, size)]
        if not near:
            continue
        best = min(near, key=lambda b: (-ratio_of(a, b), b))
        ratio = ratio_of(a, best)
        bonus = min((1 - ratio) * (math.exp(len(a) / 10) - 1), (1 - ratio) / 2) if a in best else 0
        if ratio + bonus >= 0.75:
            want[a] = (best, round(ratio + bonus, 9))
    assert got == want and len(want) > 5


def test_fuzzy_ignores_case_spaces_and_empty_queries(spark):
    got = rows(fuzzy_best(column(spark, ["The  BEATLES!", "", None, "??"], "q"), "q", column(spark, ["the beatles", "other"], "e"), "e", 0.9))
    assert got == [("The  BEATLES!", "the beatles", 1.0)]


def test_name_resolution_stages(spark):
    entries = column(spark, ["Weeknd", "The Doors", "Radiohead"], "e")
    got = {r.q: (r.match, r.stage) for r in resolve_names(column(spark, ["Weeknd", "Doors", "radio-head", "nobody"], "q"), "q", entries, "e").collect()}
    assert got["Weeknd"] == ("Weeknd", 1) and got["radio-head"] == ("Radiohead", 2) and got["Doors"] == ("The Doors", 3)
    assert "nobody" not in got


def test_track_stages(spark):
    tracks = spark.createDataFrame(
        [(1, "I1", "Hello", "Adele"), (2, "I1", "Hello", "Adele"), (3, "I3", "Waterloo", "ABBA"), (4, None, "Fernando", "ABBA"), (5, "I5", "Yesterday", "The Beatles")],
        "track_id int, isrc string, name string, artist string",
    )
    wanted = spark.createDataFrame(
        [("I1", "x", "y"), (None, "abba", "Waterlo"), ("I9", "abbba", "Fernandos"), (None, "The Beatle", "yesterday"), (None, None, "Hello"), (None, "nobody", None)],
        "isrc string, artist string, title string",
    )
    got = {(r.isrc, r.artist, r.title): (r.track_id, r.stage) for r in resolve_tracks(wanted, tracks).collect()}
    assert got == {("I1", "x", "y"): (1, 1), (None, "abba", "Waterlo"): (3, 2), ("I9", "abbba", "Fernandos"): (4, 3), (None, "The Beatle", "yesterday"): (5, 3)}


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange ")


def test_stages_are_not_planned_again(spark):
    """What a stage found is a table for the next one, so plans stay small."""
    from cadenza.catalogue import QUERIES

    for name, most in (("staged_match", 40), ("name_resolution", 40), ("pair_match", 40), ("fuzzy_best", 40)):
        assert exchanges(QUERIES[name](spark, "/root/testdata/sf0.001")) <= most


def test_pair_match_takes_the_first_row_too(spark):
    catalogue = spark.createDataFrame(
        [("Adele", "Hello (Live)", 1, 0), ("Adele", "Hello", 2, 1), ("Other", "Hello", 3, 2), ("ABBA", "Waterloo", 4, 3)],
        "artist string, title string, id int, place int",
    )
    want = spark.createDataFrame([("adele & friends", "Helo"), ("Nobody", "Hello"), ("abba", "Waterlo")], "artist string, title string")
    got = rows(pair_match(want, catalogue, "id", "place"), "artist", "id")
    assert got == [("abba", 4), ("adele & friends", 1)]


def test_pair_match_against_brute_force(spark):
    rng = random.Random(9)
    names, titles = words(10, 25, "abc", 1, 6), words(11, 40, "abcd", 3, 9)
    catalogue = [(rng.choice(names), rng.choice(titles) + rng.choice(["", " (x)", "   y"]), i) for i in range(300)]
    want = sorted({(rng.choice(names) + rng.choice(["", "c"]), rng.choice(titles) + rng.choice(["", "d"])) for _ in range(80)})

    def ratio(a, b):
        return 2 * lcs(a, b) / (len(a) + len(b))

    best = {}
    for a, t in want:
        for na, nt, i in catalogue:
            bare = nt.split("(")[0].split("   ")[0]
            if (ratio(a, na) > 0.75 or a in na or na in a) and max(ratio(t, nt), ratio(t, bare)) > 0.75:
                best[a, t] = i
                break
    df = spark.createDataFrame(want, "artist string, title string")
    held = spark.createDataFrame(catalogue, "artist string, title string, id int").withColumn("place", F.col("id"))
    got = {(r.artist, r.title): r.id for r in pair_match(df, held, "id", "place").collect()}
    assert got == best and len(best) > 20


def test_containment_pairs(spark):
    parts, wholes = words(12, 60, "ab", 1, 8), words(13, 60, "ab", 1, 12)
    got = {tuple(r) for r in containment_pairs(column(spark, parts + [""], "p"), "p", column(spark, wholes, "w"), "w").collect()}
    assert got == {(p, w) for p in parts for w in wholes if p in w}


def test_first_stage_wins(spark):
    one = spark.createDataFrame([("a", 5)], "k string, id int")
    two = spark.createDataFrame([("a", 1), ("b", 2), ("b", 1)], "k string, id int")
    assert rows(first_stage(one, two, keys=["k"], ties=[F.col("id")]), "k", "id", "stage") == [("a", 5, 1), ("b", 1, 2)]


def test_substring_flag(spark):
    texts = words(7, 150, "ab ", 0, 30) + [None, "", "ACME music", "xx"]
    patterns = words(8, 25, "ab ", 1, 7) + ["Acme", "x"]
    df = column(spark, texts, "t")
    for some in (patterns, patterns[-5:]):
        want = {t: any(p.lower() in (t or "").lower() for p in some) for t in texts}
        got = contains_any(df, "t", column(spark, some, "label"), "label", "f")
        assert {r.t: r.f for r in got.collect()} == want


def test_substring_flag_of_long_patterns(spark):
    """Patterns of all classes, cut out of texts at random places, some of them changed."""
    rng = random.Random(4)
    alphabet = "abcdefgh é漢"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 400))) for _ in range(60)] + ["ab" * 90, "a" * 100]
    cut = [t[i : i + n] for t in texts[:40] for n in (1, 2, 3, 5, 6, 9, 14, 30, 70, 120) for i in [rng.randrange(len(t) + 1)]]
    some = [p if k % 3 else p[: len(p) // 2] + "z" + p[len(p) // 2 :] for k, p in enumerate(cut)]
    long_ = [p for p in some if len(p) > 8] + ["ba" * 40, "a" * 99 + "b"]
    for patterns in (long_, ["ab" * 32, "a" * 64], [p for p in some if len(p) > 60]):
        want = [any(p and p in t for p in patterns) for t in texts]
        got = contains_any(column(spark, texts, "t").withColumn("k", F.monotonically_increasing_id()), "t", column(spark, patterns, "label"), "label", "f")
        assert {r.t: r.f for r in got.collect()} == dict(zip(texts, want))


def test_a_text_emits_its_window_minima_only(spark):
    rng = random.Random(5)
    text = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(50_000))
    df = column(spark, [text, "short"], "t").withColumn("n", F.length("t"))
    for number, (piece, window) in enumerate(winnow.CLASSES[:4]):
        held = winnow.window_minima(df, "t", ["n"], [number]).groupBy("n").count().collect()
        assert all(r["count"] <= 1.1 * 2 / (window + 1) * r.n + 1 for r in held) and max(r.n for r in held) == 50_000
    plan = contains_any(df, "t", column(spark, ["tiny", "ab"], "p"), "p", "f")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty_label_list(spark):
    df = column(spark, ["a", None], "t")
    assert rows(contains_any(df, "t", column(spark, [], "label"), "label", "f"), "f") == [(False,), (False,)]


def artists(spark):
    return spark.createDataFrame(
        [("Drake", None, False), ("Drakee", "2024 Acme Music", False), ("New", "own", None), ("Old", "own", True), ("Known!", "x", False)],
        "artist string, copyrights string, signed boolean",
    )


def test_signed_cascade(spark):
    labels, listed = column(spark, ["acme"], "label"), column(spark, ["known", "Somebody"], "artist")
    got = {r.artist: r.signed for r in signed_cascade(artists(spark), labels, listed).collect()}
    assert got == {"Drake": False, "Drakee": True, "New": False, "Old": True, "Known!": True}


def test_signed_cascade_songs(spark):
    songs = spark.createDataFrame([("Columbia NY", "a"), ("Columbya", "b"), ("indie", "c"), ("indie", "d"), (None, "e")], "label string, artist string").withColumn("signed", F.lit(False))
    labels, listed = column(spark, ["Columbia"], "label"), column(spark, ["d", None], "artist")
    got = {r.artist: r.signed for r in signed_cascade_songs(songs, labels, listed).collect()}
    assert got == {"a": True, "b": False, "c": False, "d": True, "e": False}


def test_signed_by_name_and_list_growth(spark):
    listed = column(spark, ["Drake", None], "artist")
    marked = mark_by_name(artists(spark), listed)
    assert {r.artist: r.signed for r in marked.collect()}["Drake"] is True
    assert rows(newly_signed(marked, listed)) == [("Old",)]


def test_signed_patch_touches_the_latest_report_only(spark):
    import datetime as dt

    day, before = dt.date(2024, 1, 2), dt.date(2024, 1, 1)
    reports = spark.createDataFrame([(1, day, False), (1, before, False), (2, day, False)], "id int, report_date date, signed boolean")
    texts = spark.createDataFrame([(1, "Acme"), (2, "own")], "id int, copyrights string")
    got = rows(signed_patch(reports, texts, column(spark, ["acme"], "label"), "id", day))
    assert got == [(1, before, False), (1, day, True), (2, day, False)]


def test_query_texts(spark):
    df = column(spark, ["[A], B & C Feat. D"], "s")
    assert df.select(clean_name(F.col("s"))).first()[0] == "A B   C "
    df = column(spark, ["Ab (Cd) & Ef Feat. Gh ~ x - y"], "s")
    assert df.select(clean_artist(F.col("s"))).first()[0] == "Ab Cd Ef Gh"
    assert df.select(clean_title(F.col("s"))).first()[0] == "Ab Cd Ef"
    assert column(spark, ["A-b C!"], "s").select(match_key(F.col("s"))).first()[0] == "abc"
    assert column(spark, ["ﬁ é"], "s").select(nfkd(F.col("s"))).first()[0] == "fi é"


def test_compilation_words(spark):
    df = column(spark, ["The Best Of X", "plain", None], "s")
    got = [r[0] for r in df.select(contains_any_word(F.col("s"), ["best of"])).collect()]
    assert got == [True, False, None]
