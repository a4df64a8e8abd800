"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
    BENCH_CPUS     local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cadenza.catalogue import QUERIES  # noqa: E402
from cadenza.session import local_session  # noqa: E402

HEADLINE = [
    "growth_8w_artist",
    "growth_8w_song",
    "momentum_daily",
    "accel_weekly",
    "ltg_genre_set",
    "upsert_keyed",
    "change_only_counts",
    "newest_restatement",
    "wide_to_long_multi",
    "territory_world",
    "territory_overlap",
    "genre_daily",
    "chart_reentry_genre",
    "project_meta",
    "project_recent",
    "entity_denorm",
    "artist_tracks",
    "densify_interpolate",
    "follower_gain_photo",
    "follower_long_term",
    "ranks_combined",
    "chart_entries",
    "substring_flag",
    "signed_patch",
    "pair_match",
    "ingest_mapping",
    "fuzzy_best",
    "name_resolution",
    "staged_match",
    "signed_cascade",
    "signed_cascade_songs",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").selectExpr("sum(l_quantity)").collect()
    took = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    scale = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    result = {"metric": "headline_queries_total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": scale}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
