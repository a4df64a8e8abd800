"""Every operator as a named query over the given tables."""

from cadenza.catalogue import (  # noqa: F401
    charting,
    growth,
    labelling,
    landing,
    projects,
    shapes,
    refresh,
    social,
    songs,
    territories,
    upkeep,
)
from cadenza.catalogue.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
