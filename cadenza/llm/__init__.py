"""Operators for training-data corpora, and their queries."""

import sys

from pyspark import cloudpickle

# The functions that run in tasks travel with the plan, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from cadenza.llm.queries import ORACLES, QUERIES  # noqa: E402

__all__ = ["ORACLES", "QUERIES"]
