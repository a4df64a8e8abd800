import datetime as dt

import pytest
from pyspark.sql import functions as F

from cadenza.plans.ingest import (
    daily_artists,
    daily_songs,
    load_daily,
    mapping_artists,
    mapping_collections,
    mapping_links,
    mapping_songs,
    territory_daily,
    territory_weekly,
)
from cadenza.plans.momentum import chart_week_columns
from cadenza.plans.reports import long_term_report, rank_reports
from cadenza.sources.contracts import (
    ARTIST_COLUMNS,
    SERIES_SUFFIX,
    SONG_COLUMNS,
    TERRITORIES,
    ContractError,
    artist_contract,
    check_columns,
    history_dates,
    song_contract,
)
from cadenza.sources.files import head_rows, list_files, read_feed, read_mapping, read_tab_feed, sample_rows, union_variants
from cadenza.sources.nested import IMAGES, chart_kind, joined_texts, largest_image
from cadenza.sources.tables import append_rows, export_csv, overwrite_dates, plain_text, read_latest, replace_all, write_version
from tests.conftest import rows

D = dt.date
RUN = D(2024, 3, 16)


def write_utf16(path, header, lines, sep=","):
    text = "\n".join(sep.join(map(str, line)) for line in [header, *lines]) + "\n"
    path.write_text(text, encoding="utf-16")
    return str(path)


def artist_file(path, lines):
    header = artist_contract(RUN)
    plain = [c for c in ARTIST_COLUMNS if c not in ("Artist", "UnifiedArtistID")]
    out = []
    for name, key, days in lines:
        cells = {"Artist": name, "UnifiedArtistID": key, **{c: i for i, c in enumerate(plain)}}
        out.append([cells[c] for c in ARTIST_COLUMNS] + days)
    return write_utf16(path, header, out)


def test_territories_are_complete():
    assert sum(map(len, TERRITORIES.values())) == 47


def test_artist_file_end_to_end(spark, tmp_path):
    days = [str(100 + i) for i in range(14)]
    days[3] = ""
    path = artist_file(tmp_path / "a.csv", [("Björk", "12.0", days), ("", "7.0", days), ("again", "12.0", days), ("nobody", "", days)])
    raw = check_columns(read_feed(spark, path), artist_contract(RUN), "artist")
    meta, streams = daily_artists(raw, "r")
    assert rows(meta, "unified_artist_id", "artist", "signed", "report_id", "report_date") == [
        ("12", "Björk", False, "r", D(2024, 3, 14)), ("7", "Unknown", False, "r", D(2024, 3, 14)),
    ]
    assert streams.count() == 28
    got = {(r.unified_artist_id, r.date): r.streams for r in streams.collect()}
    assert got["12", D(2024, 3, 14)] == 100 and got["12", D(2024, 3, 11)] == 0 and got["7", D(2024, 3, 1)] == 113


def test_song_file_end_to_end(spark, tmp_path):
    header = song_contract(RUN)
    cells = {c: 1 for c in SONG_COLUMNS} | {"Artist": "A", "Title": "", "Unified Song Id": "1050.0", "Release_date": "", "Label Abbrev": "L", "CoreGenre": "G", "Top ISRC": "I"}
    for i, d in enumerate(history_dates(RUN)):
        for j, s in enumerate(SERIES_SUFFIX.values()):
            cells[d.strftime("%m/%d/%Y") + s] = 1000 * j + i
    path = write_utf16(tmp_path / "s.csv", header, [[cells[c] for c in header]])
    meta, streams = daily_songs(check_columns(read_feed(spark, path), header, "song"))
    assert rows(meta, "unified_song_id", "title", "release_date") == [("1050", "Unknown", D(2024, 3, 14))]
    assert ("1050", D(2024, 3, 13), 1, 1001, 2001) in rows(streams, "unified_song_id", "date", "streams", "premium", "ad_supported")


def test_contract_names_what_is_missing(spark):
    df = spark.createDataFrame([(1,)], "`TW Rank` int")
    with pytest.raises(ContractError, match="LW Rank"):
        check_columns(df, artist_contract(RUN), "artist")


def test_territory_files(spark, tmp_path):
    header = ["Country", "UnifiedArtistID", "Artist", "Streaming On-Demand Total - Current Day", "Streaming On-Demand Total - Prior Day"]
    path = write_utf16(tmp_path / "d.tsv", header, [["Hong Kong", 5, "", 10, ""], ["Hong Kong", 5, "x", 99, 99]], "\t")
    meta, streams = territory_daily(read_tab_feed(spark, path), "unified_artist_id", ["artist"], D(2024, 3, 10), "hong_kong")
    assert rows(meta) == [("5", "Unknown", True)]
    assert rows(streams, "unified_artist_id", "date", "streams", "territory") == [("5", D(2024, 3, 9), 0, "hong_kong"), ("5", D(2024, 3, 10), 10, "hong_kong")]
    header = ["Country", "UnifiedArtistID", "Artist", "Digital Song Sales - TP", "Streaming On-Demand Total - TP",
              "Streaming On-Demand Total - % Change LP", "Streaming On-Demand Total - LP", "Streaming On-Demand Total - YTD", "Streaming On-Demand Total - ATD 2022"]
    lines = [["Hong Kong", 9, "Z", 1, 50, "-3.5%", 2, 3, 4], ["Hong Kong", 8, "Y", 1, 50, "7%", 2, 3, 4], ["Hong Kong", 9, "Z", 1, 1, "0%", 2, 3, 4]]
    path = write_utf16(tmp_path / "w.tsv", header, lines, "\t")
    stats = territory_weekly(read_tab_feed(spark, path), "unified_artist_id", ["artist"])
    assert rows(stats, "country", "unified_artist_id", "rnk", "pct_chg", "rtd_streams") == [("hong_kong", "8", 2, 7.0, 4), ("hong_kong", "9", 1, -3.5, 4)]


def test_mapping_files(spark, tmp_path):
    (tmp_path / "us.txt").write_text('UnifiedSongID\tUnified Artist ID\tUnified Collection ID\n1\t"2"\t3\\\n1\t2\t3\n4\t5\n6\t7\t8\t9\n\n')
    (tmp_path / "can.txt").write_text("UnifiedSongID\tUnified Artist ID\tUnified Collection ID\n1050.0\t2.0\t\n")
    ids = ["UnifiedSongID", "Unified Artist ID", "Unified Collection ID"]
    raw = union_variants(read_mapping(spark, str(tmp_path / "us.txt"), ids), read_mapping(spark, str(tmp_path / "can.txt"), ids))
    assert rows(mapping_links(raw)) == [("1", "2", "3"), ("1050", "2", None), ("4", "5", None)]
    (tmp_path / "a.txt").write_text("Unified Artist ID\tPrimary Artist ID\tUnified Artist Name\tPrimary Artist Name\n1\t2\tfirst\tp\n1\t2\tsecond\tp\n")
    assert rows(mapping_artists(read_mapping(spark, str(tmp_path / "a.txt"), ["Unified Artist ID", "Primary Artist ID", "Unified Artist Name", "Primary Artist Name"])), "unified_artist_name") == [("first",)]
    (tmp_path / "c.txt").write_text("Unified Collection ID\tBarcodes\tUnified Collection Name\tBarcode Release Date\tCollection Type\n1\tb\tn\t02/03/2020\tAlbum\n2\tb\tm\t\tSingle\n")
    got = rows(mapping_collections(read_mapping(spark, str(tmp_path / "c.txt"), ["Unified Collection ID", "Barcodes", "Unified Collection Name", "Barcode Release Date", "Collection Type"]), RUN))
    assert got == [("1", "n", D(2020, 2, 3), "Album"), ("2", "m", RUN, "Single")]
    (tmp_path / "s.txt").write_text("UnifiedSongid\tISRC\tUnifiedSong Title\tISRC Release Date\n1\tX\t\t\n2\tX\tt\t01/01/2020\n")
    assert rows(mapping_songs(read_mapping(spark, str(tmp_path / "s.txt"), ["UnifiedSongid", "ISRC", "UnifiedSong Title", "ISRC Release Date"]), RUN)) == [("1", "X", "", RUN)]


def test_lines_of_one_mapping_file_are_spread(spark, tmp_path):
    (tmp_path / "m.txt").write_text("UnifiedSongID\tUnified Artist ID\tUnified Collection ID\n" + "".join(f"{i}\t{i % 7}\t{i % 11}\n" for i in range(20000)))
    ids = ["UnifiedSongID", "Unified Artist ID", "Unified Collection ID"]
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16KB", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        held = read_mapping(spark, str(tmp_path / "m.txt"), ids).groupBy(F.spark_partition_id()).count().collect()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert sum(r["count"] for r in held) == 20000 and max(r["count"] for r in held) < 10000


def test_mapping_files_follow_their_own_headers(spark, tmp_path):
    (tmp_path / "1.txt").write_text("A\tB\n1\t2\n")
    (tmp_path / "2.txt").write_text("B\tC\tA\n4\tx\t3\n5\n")
    both = [str(tmp_path / "1.txt"), str(tmp_path / "2.txt")]
    assert rows(read_mapping(spark, both, ["A", "B"]), "A", "B") == [("1", "2"), ("3", "4"), (None, "5")]
    with pytest.raises(Exception, match="missing in .*1.txt: C"):
        read_mapping(spark, both, ["A", "C"]).collect()


def test_daily_load_twice_changes_nothing(spark):
    meta = spark.createDataFrame([("n1", "A"), ("n2", "B")], "nat string, artist string").withColumn("report_date", F.lit(RUN))
    streams = spark.createDataFrame([("n1", D(2024, 3, 14), 5), ("n2", D(2024, 3, 14), 6)], "nat string, date date, streams int")
    tables = {
        "meta": spark.createDataFrame([("n1", 10, "old", True)], "nat string, id bigint, artist string, is_global boolean"),
        "reports": spark.createDataFrame([], "id bigint, report_date date"),
        "streams": spark.createDataFrame([(10, D(2024, 3, 14), 4)], "id bigint, date date, streams int"),
    }
    load = load_daily(meta, streams, tables, "nat", "id", ["artist"], ["streams"], RUN)
    assert rows(load.meta, "nat", "id", "artist", "is_global") == [("n1", 10, "A", False), ("n2", 11, "B", False)]
    assert rows(load.changes.counts()) == [("inserts", 1), ("updates", 1)]
    assert rows(load.streams) == [(10, D(2024, 3, 14), 5), (11, D(2024, 3, 14), 6)]
    assert rows(load.reports) == [(10, RUN), (11, RUN)]
    after = {"meta": load.meta, "reports": load.reports, "streams": load.streams}
    again = load_daily(meta, streams, after, "nat", "id", ["artist"], ["streams"], RUN)
    assert rows(again.changes.counts()) == [("inserts", 0), ("updates", 0)]
    assert rows(again.meta, "nat", "id") == [("n1", 10), ("n2", 11)]


def test_dry_run_samples(spark, tmp_path):
    path = write_utf16(tmp_path / "x.csv", ["a"], [[i] for i in range(300)])
    raw = read_feed(spark, path)
    assert [int(r.a) for r in head_rows(raw, 5).collect()] == [0, 1, 2, 3, 4]
    one, two = (rows(sample_rows(raw.select("a"), 50), "a") for _ in range(2))
    assert one == two and len(one) == 50


def test_listing_reads_no_content(spark, tmp_path):
    for name in ("Japan_Top20kArtist_202405.tsv", "x.txt"):
        (tmp_path / name).write_text("a")
    files = list_files(spark, str(tmp_path))
    assert rows(files, "filename") == [("Japan_Top20kArtist_202405.tsv",)]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_versions_and_partitions(spark, tmp_path):
    base = str(tmp_path / "t")
    one = spark.createDataFrame([(D(2024, 1, 1), 1), (D(2024, 1, 2), 2)], "date date, v int")
    write_version(one, base)
    write_version(read_latest(spark, base).withColumn("v", F.col("v") + 1), base)
    assert rows(read_latest(spark, base)) == [(D(2024, 1, 1), 2), (D(2024, 1, 2), 3)]
    path = str(tmp_path / "p")
    append_rows(one, path, ["date"])
    overwrite_dates(one.filter("v = 2").withColumn("v", F.lit(9)), path)
    assert rows(spark.read.schema("date date, v int").parquet(path), "date", "v") == [(D(2024, 1, 1), 1), (D(2024, 1, 2), 9)]
    replace_all(one.limit(1), str(tmp_path / "r"))
    with pytest.raises(FileNotFoundError):
        read_latest(spark, str(tmp_path / "none"))


def test_exports(spark, tmp_path):
    df = spark.createDataFrame([("it's \"x\"", 1), ("b", 3), ("c", 2)], "s string, n int")
    assert rows(plain_text(df), "s") == [("b",), ("c",), ("its x",)]
    path = str(tmp_path / "report")
    export_csv(plain_text(df), path, [F.col("n").desc()], single_file=True)
    part = next((tmp_path / "report").glob("part-*.csv"))
    assert part.read_text().splitlines() == ["s,n", "b,3", "c,2", "its x,1"]
    assert len(rank_reports()) == 4 and long_term_report().top_list


def test_nested_helpers(spark):
    df = spark.createDataFrame([([(64, "s"), (640, "l"), (300, "m")],), ([],)], f"i {IMAGES}")
    assert [r[0] for r in df.select(largest_image(F.col("i"))).collect()] == ["l", None]
    df = spark.createDataFrame([([("P",), ("C",)],), ([],)], "c array<struct<text:string>>")
    assert [r[0] for r in df.select(joined_texts(F.col("c"), "text")).collect()] == ["P/C", None]
    df = spark.createDataFrame([("regional-us",), ("viral",), ("album-x",), ("city",)], "c string")
    assert [r[0] for r in df.select(chart_kind(F.col("c"))).collect()] == ["track", "track", "album", "artist"]


def test_chart_week_columns():
    assert chart_week_columns(D(2024, 3, 10))[0] == "03/07/2024"
