"""Charts of outside services, matched to own entities and checked for signed ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from cadenza.operators.charts import assemble_chart
from cadenza.operators.labels import signed_cascade


def own_chart(
    entries: Sequence[DataFrame], order: Sequence[Column], own: DataFrame, labels: DataFrame, signed_artists: DataFrame, entity: str = "entity_id"
) -> DataFrame:
    """Union of chart kinds, one row per (entity, chart) with its number of charts, own id and signed status.

    ``own`` has one row per ``entity`` with its own id, ``artist``, ``copyrights`` and ``signed``;
    entities that are not own keep their rows with nulls there and are not signed. A row is
    signed by what is stored, by a listed label in its copyright text, or by its artist's name.
    """
    chart = assemble_chart(entries, order, entity).join(own, entity, "left")
    return signed_cascade(chart, labels, signed_artists)
