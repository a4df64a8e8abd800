"""Report exports: a name, an order, and whether it is short by construction."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.sources.tables import export_csv


@dataclass(frozen=True)
class Report:
    name: str
    order: tuple[Column, ...]
    top_list: bool = False

    def export(self, df: DataFrame, folder: str) -> str:
        path = f"{folder.rstrip('/')}/{self.name}"
        export_csv(df, path, self.order, single_file=self.top_list)
        return path


def growth_score_reports() -> list[Report]:
    """The three weekly gain charts, best score first."""
    return [
        Report(name, (F.col("growth_score").desc_nulls_last(), F.col("artist_id").asc()))
        for name in ("photo_follower_growth", "audio_follower_growth", "video_follower_growth")
    ]


def rank_reports() -> list[Report]:
    """The three rank charts and the combined one, new entries first."""
    single = [
        Report(name, (F.col("rnk_chg").desc_nulls_first(), F.col("artist_id").asc()))
        for name in ("rank_growth", "fanbase_growth", "engagement_growth")
    ]
    both = Report("ranks_combined", (F.col("cm_rank_chg").desc_nulls_first(), F.col("artist_id").asc()))
    return [*single, both]


def long_term_report() -> Report:
    return Report("follower_long_term_growth", (F.col("six_month_z_score").desc(), F.col("artist_id").asc()), True)
