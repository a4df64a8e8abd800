"""The re-entry rule as keyed streaming state: one edition of ranks after the other."""

from __future__ import annotations

import datetime as dt
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from cadenza.operators.charts import AWAY_DAYS, NEVER_DAYS, ReentryRule

cloudpickle.register_pickle_by_value(sys.modules[__name__])

State = tuple[int, dt.date, dt.date]


def step(state: State | None, rank: int, as_of: dt.date, inner: int, outer: int, limit: int) -> State:
    """The state of a key after an edition in which it has ``rank``."""
    never = as_of - dt.timedelta(NEVER_DAYS)
    notify, last_in, last_out = state or (0, never, never)
    inside, charted = rank <= inner, rank <= outer
    back_in = inside and (as_of - last_in).days >= AWAY_DAYS
    back_out = charted and (as_of - last_out).days >= AWAY_DAYS
    if notify + 1 > limit:
        nxt = 0
    elif notify > 0 or back_in or back_out:
        nxt = notify + 1
    else:
        nxt = 0
    return nxt, as_of if inside else last_in, as_of if charted else last_out


def reentry_stream(ranks: DataFrame, key: str, rule: ReentryRule) -> DataFrame:
    """Chart rows from a stream of (key, edition date ``as_of``, ``rnk``).

    State per key is four values. Editions that arrive together are taken in date order; one
    that is not newer than the last one of its key is late or repeated, and is left out.
    """
    inner, outer, limit = rule.inner, rule.outer, rule.limit

    def advance(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now: State | None = None
        last = dt.date.min
        if state.exists:
            notify, last_in, last_out, last = state.get
            now = (notify, last_in, last_out)
        rows = []
        for part in parts:
            rows.extend(zip(part["as_of"], part["rnk"]))
        out = []
        for as_of, rank in sorted(rows):
            if as_of <= last:
                continue
            last = as_of
            now = step(now, int(rank), as_of, inner, outer, limit)
            out.append((k[0], as_of, int(rank), *now))
        state.update((*now, last))
        yield pd.DataFrame(out, columns=[key, "as_of", "rnk", "should_notify", "last_in", "last_out"])

    kind = dict(ranks.dtypes)[key]
    return ranks.groupBy(key).applyInPandasWithState(
        advance,
        f"{key} {kind}, as_of date, rnk int, should_notify int, last_in date, last_out date",
        "should_notify int, last_in date, last_out date, edition date",
        "append",
        GroupStateTimeout.NoTimeout,
    )
