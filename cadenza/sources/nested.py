"""Nested service objects to flat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import complete_date
from cadenza.functions.text import nfkd
from cadenza.operators.keys import rank_per_key

IMAGES = "array<struct<height:int,url:string>>"
TRACK = (
    "disc_number int, duration_ms int, explicit boolean, external_ids struct<isrc:string>, "
    "external_urls struct<web:string>, href string, id string, is_local boolean, name string, popularity int, "
    "preview_url string, track_number int, uri string, "
    f"album struct<id:string,images:{IMAGES},release_date:string,total_tracks:int,type:string>, "
    "artists array<struct<id:string,name:string>>"
)
ARTIST = (
    "id string, external_urls struct<web:string>, followers struct<total:bigint>, genres array<string>, "
    f"href string, name string, popularity int, uri string, images {IMAGES}"
)
ALBUM = (
    "id string, copyrights array<struct<text:string>>, label string, external_ids struct<upc:string>, "
    f"genres array<string>, name string, images {IMAGES}, href string, release_date string, popularity int"
)
_FACTS = (
    "appearancesOnChart int, consecutiveAppearancesOnChart int, currentRank int, entryDate string, entryRank int, "
    "entryStatus string, peakDate string, peakRank int, previousRank int, rankingMetric struct<value:bigint>"
)


def _facts_struct() -> str:
    return "struct<" + ",".join(f.strip().replace(" ", ":", 1) for f in _FACTS.split(", ")) + ">"


def _meta_struct(kind: str) -> str:
    return (
        f"struct<{kind}Name:string,{kind}Uri:string,displayImageUri:string,"
        "artists:array<struct<name:string>>,labels:array<struct<name:string>>>"
    )


CHART = (
    "entries array<struct<"
    + ",".join(f"{k}Metadata:{_meta_struct(k)}" for k in ("track", "album", "artist"))
    + f",chartEntryData:{_facts_struct()},missingRequiredFields:boolean>>"
)
GENRE_ITEMS = (
    "array<struct<item:struct<id:bigint,full_title:string,artist_names:string,"
    "stats:struct<concurrents:bigint,hot:boolean,pageviews:bigint>>>>"
)


def parsed(df: DataFrame, json: str, schema: str, name: str = "o") -> DataFrame:
    """Add the object of a JSON text column."""
    return df.withColumn(name, F.from_json(json, schema))


def largest_image(images: Column) -> Column:
    """Address of the image with the greatest height; null without images."""
    tallest = F.array_sort(images, lambda a, b: b["height"] - a["height"])
    return F.get(tallest, F.lit(0))["url"]


def joined_texts(items: Column, field: str) -> Column:
    """Field of every list element joined by ``/``; null for an empty list."""
    texts = F.transform(items, lambda i: F.coalesce(i[field], F.lit("")))
    return F.when(F.size(items) > 0, F.array_join(texts, "/"))


def track_rows(df: DataFrame, o: str = "o") -> DataFrame:
    """One flat row per track object."""
    c = F.col(o)
    return df.select(
        *[x for x in df.columns if x != o],
        c["id"].alias("track_id"),
        c["external_ids"]["isrc"].alias("isrc"),
        c["name"].alias("name"),
        c["disc_number"].alias("disc_number"),
        c["track_number"].alias("track_number"),
        c["duration_ms"].alias("duration_ms"),
        c["explicit"].alias("explicit"),
        c["popularity"].alias("popularity"),
        c["preview_url"].alias("preview_url"),
        c["album"]["id"].alias("album_id"),
        c["album"]["type"].alias("album_type"),
        c["album"]["total_tracks"].alias("total_tracks"),
        complete_date(c["album"]["release_date"]).alias("release_date"),
        F.get(c["artists"], F.lit(0))["id"].alias("platform_artist_id"),
        largest_image(c["album"]["images"]).alias("image"),
    )


def artist_rows(df: DataFrame, o: str = "o") -> DataFrame:
    """One flat row per artist object, genres packed by ``/``."""
    c = F.col(o)
    return df.select(
        *[x for x in df.columns if x != o],
        c["id"].alias("platform_artist_id"),
        c["name"].alias("name"),
        c["external_urls"]["web"].alias("url"),
        c["followers"]["total"].alias("followers"),
        F.when(F.size(c["genres"]) > 0, F.array_join(c["genres"], "/")).alias("genres"),
        c["href"].alias("api_url"),
        c["popularity"].alias("popularity"),
        c["uri"].alias("uri"),
        largest_image(c["images"]).alias("image"),
    )


def album_rows(df: DataFrame, o: str = "o") -> DataFrame:
    """One flat row per album object, copyright texts and genres packed by ``/``."""
    c = F.col(o)
    return df.select(
        *[x for x in df.columns if x != o],
        c["id"].alias("album_id"),
        c["name"].alias("album_name"),
        joined_texts(c["copyrights"], "text").alias("copyrights"),
        c["label"].alias("label"),
        F.coalesce(c["external_ids"]["upc"], F.lit("")).alias("upc"),
        F.when(F.size(c["genres"]) > 0, F.array_join(c["genres"], "/")).alias("genres"),
        largest_image(c["images"]).alias("image"),
        complete_date(c["release_date"]).alias("release_date"),
        c["popularity"].alias("popularity"),
    )


def top_tracks(df: DataFrame, tracks: str) -> DataFrame:
    """Track and album id of the first element of each ranked track list; empty lists give no row."""
    first = F.get(F.col(tracks), F.lit(0))
    return df.filter(F.size(tracks) > 0).select(
        *[c for c in df.columns if c != tracks],
        first["id"].alias("popular_track_id"),
        first["album"]["id"].alias("popular_album_id"),
    )


def chart_kind(category: Column) -> Column:
    """Entity kind of a chart category."""
    return (
        F.when(category.startswith("regional") | category.startswith("viral"), "track")
        .when(category.startswith("album"), "album")
        .otherwise("artist")
    )


def chart_entries(df: DataFrame, chart: str = "o") -> DataFrame:
    """Complete entries of chart objects, one row each; ``df`` has ``category`` or is all tracks."""
    keep = [c for c in df.columns if c != chart]
    kind = chart_kind(F.col("category")) if "category" in df.columns else F.lit("track")
    rows = df.withColumn("type", kind).select(*keep, "type", F.posexplode(F.col(chart)["entries"]).alias("position", "e"))
    rows = rows.filter(~F.coalesce(F.col("e.missingRequiredFields"), F.lit(False)))

    def of_kind(pick) -> Column:
        return (
            F.when(F.col("type") == "track", pick("track")).when(F.col("type") == "album", pick("album")).otherwise(pick("artist"))
        )

    names = of_kind(lambda k: F.col(f"e.{k}Metadata.{k}Name"))
    uri = of_kind(lambda k: F.col(f"e.{k}Metadata.{k}Uri"))
    performers = of_kind(lambda k: joined_texts(F.col(f"e.{k}Metadata.artists"), "name"))
    labels = of_kind(lambda k: joined_texts(F.col(f"e.{k}Metadata.labels"), "name"))
    image = of_kind(lambda k: F.col(f"e.{k}Metadata.displayImageUri"))
    is_artist = F.col("type") == "artist"
    facts = {
        "appearances_on_chart": "appearancesOnChart",
        "consecutive_appearances_on_chart": "consecutiveAppearancesOnChart",
        "current_rank": "currentRank",
        "entry_date": "entryDate",
        "entry_rank": "entryRank",
        "entry_status": "entryStatus",
        "peak_date": "peakDate",
        "peak_rank": "peakRank",
        "previous_rank": "previousRank",
    }
    blank = F.lit("")
    return rows.select(
        *keep,
        "type",
        "position",
        F.when(is_artist, blank).otherwise(names).alias("title"),
        F.when(is_artist, names).otherwise(F.coalesce(performers, blank)).alias("artist"),
        F.coalesce(labels, blank).alias("copyrights"),
        F.coalesce(image, blank).alias("image"),
        F.coalesce(F.get(F.split(uri, ":"), F.lit(2)), blank).alias("entity_id"),
        *[F.col(f"e.chartEntryData.{src}").alias(name) for name, src in facts.items()],
        F.coalesce(F.col("e.chartEntryData.rankingMetric.value"), F.lit(0)).alias("streams"),
    )


def genre_chart_rows(pages: DataFrame, items: str = "items") -> DataFrame:
    """Genre-chart pages (genre, page, items) to rows with a running rank over all pages."""
    rows = pages.select("genre", "page", F.posexplode(items).alias("position", "i"))
    stats = F.col("i.item.stats")
    flat = rows.select(
        "genre",
        "page",
        "position",
        F.col("i.item.id").cast("string").alias("item_id"),
        F.coalesce(stats["concurrents"], F.lit(0)).alias("concurrents"),
        F.coalesce(stats["hot"], F.lit(False)).alias("is_hot"),
        F.coalesce(stats["pageviews"], F.lit(0)).alias("views"),
        nfkd(F.col("i.item.full_title")).alias("title"),
        nfkd(F.col("i.item.artist_names")).alias("artist"),
    )
    return rank_per_key(flat, ["genre"], [F.col("page").asc(), F.col("position").asc()], "rank").drop("page", "position")


def with_audio_features(tracks: DataFrame, features: DataFrame) -> DataFrame:
    """Left join of audio features on the track id; missing whole numbers become 0."""
    f = features.drop("uri", "track_href", "duration_ms", "type").withColumnRenamed("id", "track_id")
    out = tracks.join(f, "track_id", "left")
    whole = ["disc_number", "duration_ms", "popularity", "track_number", "total_tracks", "key", "mode", "time_signature"]
    return out.fillna(0, [c for c in whole if c in out.columns])
