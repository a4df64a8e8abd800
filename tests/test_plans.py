import datetime as dt

import pytest
import math
import random

from pyspark.sql import functions as F

from cadenza.plans.enrich import cache_songs, patch_colours, profile_candidates, recache, song_facts, stalest
from cadenza.plans.genres import entity_genres, genre_stats, long_term_genre_ranks, refresh_genre_streams
from cadenza.functions.dates import months_back
from cadenza.plans.growth import eight_week_growth, genre_set_growth, indie_long_term, roots_long_term
from cadenza.plans.momentum import acceleration_metrics, acceleration_rule, momentum_metrics, momentum_rule
from cadenza.plans.projects import project_daily, project_images
from cadenza.plans.ranks import RANK_CAPS, rank_improvement
from cadenza.plans.rollups import ex_home, territory_daily, worldwide
from cadenza.plans.social import AUDIO_RULE, PHOTO_RULE, VIDEO_RULE, GainRule, follower_gain_chart, snapshot_growth, weekly_gains
from cadenza.plans.views import entity_stats
from tests.conftest import rows

D = dt.date
NOW = D(2024, 3, 10)


def ratio(a, b):
    if b:
        return a / b
    return math.inf if a > 0 else math.nan


def test_momentum_rule_against_plain_python(spark):
    rng = random.Random(2)
    days = [f"d{i}" for i in range(8)]
    data = []
    for i in range(400):
        d = [rng.choice([0, 90, 100, 110, 115, 120, 130, 200, 500]) for _ in days]
        data.append((i, *d, *(rng.choice([0, 60_000, 100_001, 160_000]) for _ in range(4))))
    cols = ["id", *days, "tw_oda_streams", "lw_oda_streams", "tw_rolling_oda", "lw_rolling_oda"]
    df = spark.createDataFrame(data, cols)
    got = {r.id for r in momentum_metrics(df, days).filter(momentum_rule()).select("id").collect()}
    want = set()
    for row in data:
        r = dict(zip(cols, row))
        roll = ratio(r["tw_rolling_oda"], r["lw_rolling_oda"]) - 1
        c2, c3 = ratio(r["d0"], r["d1"]) - 1, ratio(r["d1"], r["d2"]) - 1
        a7, a4 = ratio(r["d1"], r["d7"]) ** (1 / 6) - 1, ratio(r["d1"], r["d4"]) ** (1 / 3) - 1
        signs = [c2 >= 0.15 and c3 > 0, c3 >= 0.25, a7 >= 0.15 and a4 > 0, roll >= 0.5 and r["lw_rolling_oda"] > 100_000, a4 >= 0.15 and c3 > 0]
        if roll >= 0 and any(signs):
            want.add(r["id"])
    assert got == want and 20 < len(want) < 380


def test_acceleration_rule_against_plain_python(spark):
    rng = random.Random(4)
    days = [f"d{i}" for i in range(7)]
    data = []
    for i in range(500):
        d = [rng.choice([0, 900, 1001, 2000, 4000]) for _ in days]
        weeks = [rng.choice(v) for v in ([50_000, 90_000, 100_000, 150_000, 250_000], [0, 4_000, 60_000, 100_000, 140_000], [0, 900, 50_000, 90_000])]
        data.append((i, *d, *weeks, rng.choice([0, 1, 5]), 3))
    cols = ["id", *days, "tw_oda_streams", "lw_oda_streams", "l2w_oda_streams", "lw_rank", "tw_rank"]
    df = acceleration_metrics(spark.createDataFrame(data, cols), days)
    got = {r.id for r in df.filter(acceleration_rule("d6")).select("id").collect()}
    want = set()
    for row in data:
        r = dict(zip(cols, row))
        tw, lw, l2w = r["tw_oda_streams"], r["lw_oda_streams"], r["l2w_oda_streams"]
        pct, a3, a7, old = ratio(tw, lw) - 1, ratio(tw, l2w) ** 0.5 - 1, ratio(r["d0"], r["d6"]) ** (1 / 6) - 1, r["d6"]
        big, mid = tw >= 100_000, 50_000 <= tw <= 100_000
        signs = [
            pct >= 0.25 and tw >= 200_000 and lw >= 5_000, pct >= 0.35 and big and lw >= 5_000,
            a3 >= 0.15 and big and l2w >= 1_000 and pct >= 0.15, a7 >= 0.1 and big and old > 1_000,
            a3 >= 0.2 and big and a7 > 0 and pct >= 0.25, mid and a7 >= 0.15 and old > 1_000,
            a3 >= 0.15 and mid and a7 > 0 and pct >= 0.4, lw < 5_000 and big,
        ]
        if any(signs):
            want.add(r["id"])
    assert got == want and 50 < len(want) < 480
    new = rows(df.filter("lw_rank = 0").limit(1), "is_new", "rank_chg")
    assert new == [(True, None)]


def daily(spark, series, end=NOW - dt.timedelta(1)):
    data = [(k, end - dt.timedelta(len(v) - 1 - i), x) for k, v in series.items() for i, x in enumerate(v)]
    return spark.createDataFrame(data, "artist_id string, date date, streams bigint")


def test_eight_week_growth_needs_both_signs(spark):
    def by_week(weeks):
        return [w for w in weeks for _ in range(7)]

    series = {
        "up": by_week([10, 11, 12, 13, 14, 15, 16, 17, 18]),
        "few": by_week([10, 11, 12, 13, 14, 9, 8, 8, 8]),
        "signed": by_week([10, 11, 12, 13, 14, 15, 16, 17, 18]),
        "small": by_week([10, 11, 12, 13, 14, 15, 16, 17, 18]),
    }
    people = [("up", 200_000, False), ("few", 200_000, False), ("signed", 200_000, True), ("small", 5, False), ("silent", 200_000, None)]
    entities = spark.createDataFrame(people, "artist_id string, tw_streams bigint, signed boolean")
    got = rows(eight_week_growth(daily(spark, series), entities, "artist_id", NOW), "artist_id", "num_positive_weeks")
    assert got == [("up", 8)]


def test_genre_set_counts_an_artist_once(spark):
    weeks = [x for i in range(13) for x in [100 + i] * 7]
    streams = daily(spark, {"a": weeks, "b": weeks})
    genres = spark.createDataFrame([("a", "folk"), ("a", "country"), ("b", "metal")], "artist_id string, genre string")
    people = spark.createDataFrame([("a", 100, False), ("b", 100, False)], "artist_id string, tw_streams bigint, signed boolean")
    got = genre_set_growth(streams, genres, people, ["folk", "country"], NOW - dt.timedelta(180), floor=50)
    assert [r.artist_id for r in got.collect()] == ["a"] and got.first().positive_weeks >= 12


def test_named_genre_reports(spark):
    weeks = [x for i in range(13) for x in [100 + i] * 7]
    streams = daily(spark, {"a": weeks, "b": weeks}, end=NOW)
    genres = spark.createDataFrame([("a", "folk"), ("b", "dream pop")], "artist_id string, genre string")
    people = spark.createDataFrame([("a", 60_000, False), ("b", 200_000, False)], "artist_id string, tw_streams bigint, signed boolean")
    tracks = spark.createDataFrame([("a", 1), ("a", 2)], "artist_id string, song_id int")
    songs = spark.createDataFrame([(1, D(2020, 1, 1)), (2, D(2021, 1, 1))], "song_id int, release_date date")
    assert rows(indie_long_term(streams, genres, people, NOW), "artist_id") == [("b",)]
    got = rows(roots_long_term(streams, genres, people, tracks, songs, NOW), "artist_id", "min_release_date", "max_release_date")
    assert got == [("a", D(2020, 1, 1), D(2021, 1, 1))]
    assert months_back(D(2024, 8, 31), 6) == D(2024, 2, 29) and months_back(D(2024, 3, 1), 6) == D(2023, 9, 1)


def followers(spark, series):
    data = [(k, NOW - dt.timedelta(n), v) for k, points in series.items() for n, v in points]
    return spark.createDataFrame(data, "account string, date date, followers bigint")


def test_history_before_and_after_filling(spark):
    stats = followers(spark, {"sparse": [(1, 9000), (9, 8000)], "dense": [(i, 9000 - i) for i in range(1, 10)], "old": [(i, 1) for i in range(20, 30)]})
    wanted = spark.createDataFrame([("sparse",), ("dense",), ("old",)], "account string")
    after = weekly_gains(stats, wanted, "account", "followers", NOW, GainRule(16, 3, True, 5000, 2.0))
    assert rows(after, "account", "gain") == [("dense", 7.0), ("sparse", 875.0)]
    before = weekly_gains(stats, wanted, "account", "followers", NOW, GainRule(16, 4, False, 5000, 2.0))
    assert rows(before, "account") == [("dense",)]


@pytest.mark.parametrize(
    ("rule", "days", "points", "filled", "floor", "zero"),
    [(PHOTO_RULE, 16, 3, True, 5000, False), (AUDIO_RULE, 16, 4, False, 2000, False), (VIDEO_RULE, 21, 4, False, 1000, True)],
)
def test_platform_rules_at_their_limits(spark, rule, days, points, filled, floor, zero):
    """The last value must exceed the floor, the history the number of points, within the look-back."""
    past = [(days - 1, floor - 7), *[(i, floor - i) for i in range(2, points + 1)]]
    series = {
        "above": [*past, (1, floor + 1)],
        "at": [*past, (1, floor)],
        "short": [(i, floor + 9) for i in range(1, points + 1)],
        "early": [(days, floor + 9), *[(i, floor + 9) for i in range(1, points + 1)]],
        "gap": [(1, floor + 9), (9, floor + 5)],
        "zeros": [(1, floor + 9), *[(i, 0) for i in range(2, 10)]],
    }
    wanted = spark.createDataFrame([(k,) for k in series], "account string")
    got = {r.account for r in weekly_gains(followers(spark, series), wanted, "account", "followers", NOW, rule).collect()}
    assert got == {"above"} | ({"gap"} if filled else set()) | (set() if zero else {"zeros"})
    assert rule.sigmas == (2.5 if rule is AUDIO_RULE else 2.0)


@pytest.mark.parametrize(("kind", "cap"), [("rank_25_75", 50_000), ("rank_fb", 150_000), ("rank_eg", 50_000)])
def test_rank_caps(spark, kind, cap):
    week = NOW - dt.timedelta(7)
    data = [("in", NOW, cap - 1), ("in", week, cap + 1000), ("out", NOW, cap), ("out", week, cap + 5000), ("slow", NOW, cap - 2), ("slow", week, cap + 998)]
    ranks = spark.createDataFrame(data, f"account string, date date, {kind} int")
    people = spark.createDataFrame([(1, "in"), (2, "out"), (3, "slow")], "artist_id int, account string")
    none = spark.createDataFrame([], "artist_id int")
    got = rank_improvement(ranks, people, none, "account", kind, RANK_CAPS[kind], NOW)
    assert rows(got, "account") == [("in",)]


def test_gain_chart_names_the_biggest_owner(spark):
    stats = followers(spark, {"x": [(i, 10_000 - 100 * i) for i in range(1, 10)], "y": [(i, 10_000 - i) for i in range(1, 10)]})
    people = [("a", 5, "x"), ("b", 50, "x"), ("c", None, "x"), ("d", 1, "y"), ("e", 1, "")]
    entities = spark.createDataFrame(people, "artist_id string, tw_streams bigint, account string")
    model = spark.createDataFrame([(9, 10.0, 50.0, 0.0, 1e6)], "count int, mean double, std double, bin_min double, bin_max double")
    previous = spark.createDataFrame([("zz",), ("zz",)], "artist_id string")
    got = follower_gain_chart(stats, entities, model, previous, "account", "followers", NOW, GainRule(16, 3, True, 5000, 2.0))
    assert rows(got, "account", "artist_id", "followers", "gain", "growth_score", "is_new") == [("x", "b", 9900, 700, 13.8, True)]


def test_snapshot_growth_zero_and_missing_weeks(spark):
    tw, lw = NOW - dt.timedelta(3), NOW - dt.timedelta(10)
    data = [
        ("up", tw, 200_000, 50, 10), ("up", lw, 100_000, 50, 10),
        ("zero", tw, 200_000, 50, 10), ("zero", lw, 0, 50, 10),
        ("new", tw, 900_000, 50, 10),
        ("fans", tw, 100_000, 50, 12), ("fans", lw, 100_000, 50, 10),
        ("pop", tw, 100_000, 5, 10), ("pop", lw, 100_000, 0, 10),
        ("flat", tw, 100_000, 50, 10), ("flat", lw, 100_000, 50, 10),
        ("signed", tw, 300_000, 50, 10), ("signed", lw, 100_000, 50, 10),
    ]
    stats = spark.createDataFrame(data, "account string, date date, monthly_listeners bigint, popularity int, followers bigint")
    known = spark.createDataFrame([("signed", True), ("up", False)], "account string, signed boolean")
    got = rows(snapshot_growth(stats, known, "account", NOW), "account")
    assert got == [("fans",), ("pop",), ("up",)]


def test_rank_improvement_keeps_new_and_climbers(spark):
    week = NOW - dt.timedelta(7)
    data = [("up", NOW, 100), ("up", NOW, 90), ("up", week, 5000), ("flat", NOW, 100), ("flat", week, 900), ("new", NOW, 7), ("far", NOW, 60_000), ("gone", week, 3)]
    ranks = spark.createDataFrame(data, "account string, date date, rank_fb int")
    people = spark.createDataFrame([(i, a) for i, a in enumerate(["up", "flat", "new", "far", "gone"])], "artist_id int, account string")
    none = spark.createDataFrame([], "artist_id int")
    got = rank_improvement(ranks, people, none, "account", "rank_fb", 50_000, NOW)
    assert rows(got, "account", "rnk", "last_rnk", "rnk_chg") == [("new", 7, None, None), ("up", 100, 5000, 4900)]


def test_rollups_leave_stored_rollup_rows_out(spark):
    stats = spark.createDataFrame(
        [(1, "a", 10, 0), (2, "a", 5, 5), (67, "a", 999, 999), (68, "b", 999, 1), (1, "c", 1, 4)],
        "global_id int, artist_id string, tw_streams bigint, lw_streams bigint",
    ).withColumn("rtd_streams", F.lit(1).cast("bigint"))
    ex = ex_home(stats, "artist_id", [67, 68], 68)
    assert rows(ex, "artist_id", "tw_streams", "rnk", "pct_chg", "global_id") == [("a", 15, 1, 200.0, 68), ("c", 1, 2, -75.0, 68)]
    home = spark.createDataFrame([("d", 7, 0, 3)], "artist_id string, tw_streams bigint, lw_streams bigint, rtd_streams bigint")
    world = worldwide(ex, home, "artist_id", 67)
    assert rows(world, "artist_id", "tw_streams", "rtd_streams", "rnk", "pct_chg", "ytd_streams") == [
        ("a", 15, 2, 1, 200.0, 0), ("c", 1, 1, 3, -75.0, 0), ("d", 7, 3, 2, 0.0, 0)
    ]


def test_territory_days_count_charting_entities_only(spark):
    streams = spark.createDataFrame([("a", NOW, 1, 5), ("b", NOW, 1, 7), ("a", NOW, 2, 9), ("a", D(2024, 1, 1), 1, 4), ("a", NOW, 1, None)], "artist_id string, date date, global_id int, streams bigint")
    stats = spark.createDataFrame([(1, "a")], "global_id int, artist_id string")
    assert rows(territory_daily(streams, stats, NOW), "global_id", "streams") == [(1, 5)]


def test_genre_views(spark):
    people = spark.createDataFrame([("a", "folk/pop"), ("b", "pop"), ("c", None)], "artist_id string, genres string")
    members = entity_genres(people)
    stats = spark.createDataFrame([("a", 30, 10), ("b", 10, 0)], "artist_id string, tw_streams bigint, lw_streams bigint")
    got = rows(genre_stats(members, stats), "genre", "tw_streams", "artists_count", "avg_tw_streams", "growth")
    assert got == [("folk", 30, 1, 30.0, 200.0), ("pop", 40, 2, 20.0, 300.0)]
    dimension = spark.createDataFrame([("folk", 1), ("pop", 2), ("silent", 3)], "genre string, genre_id int")
    streams = spark.createDataFrame([("a", NOW, 5), ("b", NOW, 2)], "artist_id string, date date, streams bigint")
    stored = spark.createDataFrame([("folk", NOW, 99, 1), ("folk", D(2024, 1, 1), 4, 1)], "genre string, date date, streams bigint, genre_id int")
    fresh = refresh_genre_streams(stored, members, streams, dimension, NOW)
    assert rows(fresh, "genre", "date", "streams") == [("folk", D(2024, 1, 1), 4), ("folk", NOW, 5), ("pop", NOW, 7)]
    weekly = spark.createDataFrame([("pop", NOW - dt.timedelta(n), s) for n, s in ((2, 9), (9, 5))], "genre string, date date, streams bigint")
    ranks = rows(long_term_genre_ranks(weekly, dimension, NOW), "genre", "num_positive_weeks", "rnk")
    assert ranks == [("folk", -1, 2), ("pop", 1, 1), ("silent", -1, 3)]


def test_stats_windows_touch(spark):
    streams = daily(spark, {"a": list(range(1, 16))}, end=NOW)
    got = rows(entity_stats(streams, "artist_id", NOW), "tw_streams", "lw_streams", "pct_chg")
    assert got == [(sum(range(9, 16)), sum(range(2, 9)), 1.4)]


def test_recache_takes_the_stalest(spark):
    profiles = spark.createDataFrame([("a", D(2024, 1, 1), 5), ("a", D(2024, 2, 1), 5), ("b", None, 6), ("c", D(2024, 1, 2), 7)], "id string, last_updated date, followers int")
    assert rows(stalest(profiles, "id", 2), "id") == [("a",), ("b",)]
    one = profiles.filter("id != 'a'")
    fresh = spark.createDataFrame([("b", None), ("c", 70)], "id string, followers int")
    assert rows(recache(one, fresh, "id", ["followers"], NOW)) == [("b", NOW, 0), ("c", NOW, 70)]


def test_colours_replace_the_default_only(spark):
    songs = spark.createDataFrame([(1, "u", "#000000"), (2, "u", "#111111"), (3, "", "#000000"), (4, "w", "#000000")], "id int, image string, dominant_color string")
    colours = spark.createDataFrame([("u", "#abcdef")], "image string, colour string")
    assert rows(patch_colours(songs, colours, "id"), "id", "dominant_color") == [(1, "#abcdef"), (2, "#111111"), (3, "#000000"), (4, "#000000")]


def test_profile_candidate_is_the_most_frequent_id(spark):
    people = spark.createDataFrame([(1, False), (2, False), (3, True), (4, False)], "artist_id int, is_global boolean")
    cached = spark.createDataFrame([(4,), (None,)], "artist_id int")
    tracks = spark.createDataFrame([(1, 10), (1, 11), (1, 12), (3, 10)], "artist_id int, song_id int")
    songs = spark.createDataFrame([(10, "p"), (11, "q"), (12, "q")], "song_id int, platform_artist_id string")
    assert rows(profile_candidates(people, cached, tracks, songs)) == [(1, "q"), (2, None)]


def test_song_facts_prefer_the_profile_with_most_streams(spark):
    wanted = spark.createDataFrame([("X",), ("Y",), ("",), (None,), ("X",)], "isrc string")
    profiles = spark.createDataFrame([(1, "X", "c1"), (2, "X", "c2")], "song_id int, isrc string, copyrights string")
    extra = spark.createDataFrame([("X", "no"), ("Y", "yes")], "isrc string, copyrights string")
    reports = spark.createDataFrame([(2, True)], "song_id int, signed boolean")
    stats = spark.createDataFrame([(1, 5, 1, 0.1), (2, 9, 1, 0.1)], "song_id int, tw_streams int, lw_streams int, pct_chg double")
    got = rows(song_facts(wanted, profiles, extra, reports, stats), "isrc", "song_id", "copyrights", "signed")
    assert got == [("X", 2, "c2", True), ("Y", None, "yes", False)]


def test_cache_songs_adds_only_missing_ones(spark):
    cache = spark.createDataFrame([(1, "t1", 0)], "song_id int, track_id string, key int")
    songs = spark.createDataFrame([(1, "A"), (2, "B"), (3, None)], "song_id int, isrc string")
    tracks = spark.createDataFrame([("B", "t2", 5, "al"), ("B", "t3", 9, "al"), ("A", "t9", 1, "al")], "isrc string, track_id string, popularity int, album_id string")
    albums = spark.createDataFrame([("al", "n", "c", "l", "u")], "album_id string, album_name string, copyrights string, label string, upc string")
    features = spark.createDataFrame([("t2", 4)], "id string, key int")
    assert rows(cache_songs(cache, songs, tracks, albums, features)) == [(1, "t1", 0), (2, "t3", 0)]


def plan_without_broadcast(spark, make):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = make()
        return rows(out), out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_project_daily_does_not_sort_the_links(spark):
    links = spark.createDataFrame([(1, 10), (2, 10), (1, 11), (3, 12), (None, 13)], "song_id int, collection_id int")
    streams = [(1, NOW, 5), (1, NOW, 2), (2, NOW, 1), (1, D(2024, 3, 9), 4), (3, D(2024, 2, 1), 9), (None, NOW, 8)]
    streams = spark.createDataFrame(streams, "song_id int, date date, streams long")
    got, plan = plan_without_broadcast(spark, lambda: project_daily(links, streams, NOW))
    assert got == [(10, D(2024, 3, 9), 4), (10, NOW, 8), (11, D(2024, 3, 9), 4), (11, NOW, 7)]
    assert "ShuffledHashJoin" in plan and "Sort " not in plan


def test_project_images_does_not_sort_the_links(spark):
    projects = spark.createDataFrame([(10, None), (11, None), (12, "cover"), (13, None), (None, None)], "collection_id int, image string")
    links = [(1, 10), (2, 10), (3, 10), (3, 10), (1, 11), (4, 11), (1, 12), (1, None), (None, 13)]
    links = spark.createDataFrame(links, "song_id int, collection_id int")
    images = spark.createDataFrame([(1, "b"), (2, "b"), (3, "a"), (4, ""), (None, "c")], "song_id int, image string")
    got, plan = plan_without_broadcast(spark, lambda: project_images(projects, links, images))
    assert got == [(10, "a"), (11, "b"), (12, "cover"), (13, None), (None, None)]
    # one sorted join less: only songs and the patched projects are sorted
    assert plan.count("ShuffledHashJoin") == 1 and plan.count("SortMergeJoin") == 2
