"""Next-version-of-a-table functions: upsert, change-only, replace-window, patch.

Spark tables are not updated in place. Each function returns the next state of the
table; ``sources.tables`` writes it, rewriting only the date partitions that changed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.operators.keys import first_per_key, not_in


def unique_delta(delta: DataFrame, keys: Sequence[str], newest: Sequence[Column] | None = None) -> DataFrame:
    """A delta with one row per key.

    With ``newest`` the first row in that order wins (several files may restate one
    key). Without it a repeated key is an error, raised when the rows are computed.
    """
    if newest is not None:
        return first_per_key(delta, keys, newest)
    rest = [c for c in delta.columns if c not in keys]
    packed = delta.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("__n"), F.any_value(F.struct(*(rest or keys))).alias("__row")
    )
    repeated = F.concat(F.lit("repeated key in delta: "), F.to_json(F.struct(*keys)))
    checked = packed.filter(F.when(F.col("__n") > 1, F.raise_error(repeated)).otherwise(F.lit(True)))
    return checked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in delta.columns])


def upsert(
    current: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    on_update: Mapping[str, Column] | None = None,
    among: Column | None = None,
) -> DataFrame:
    """Insert the new keys of ``delta`` and update only the listed columns of the old ones.

    Listed columns take the delta's value even when it is null; the others keep theirs.
    ``on_update`` sets further columns on updated rows. ``delta`` must have unique keys.
    Plain key equality keeps both sides where earlier steps on the key, or bucketing, put
    them; null keys never match and are kept as they are.

    ``among`` is a condition on stored columns that holds for every row of the delta, such
    as its dates: only stored rows that meet it take part in the join, the others pass by
    without a shuffle. A delta row that does not meet it is an error.
    """
    if among is not None:
        inside = F.coalesce(among, F.lit(False))
        checked = delta.filter(F.when(~inside, F.raise_error(F.lit("delta row outside of the given part"))).otherwise(F.lit(True)))
        merged = upsert(current.filter(inside), checked, keys, update, on_update)
        return current.filter(~inside).unionByName(merged)
    keys = list(keys)
    on_update = dict(on_update or {})
    values = [c for c in delta.columns if c not in keys]
    update = values if update is None else list(update)
    new = delta.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in values], F.lit(True).alias("__d"))
    joined = current.withColumn("__c", F.lit(True)).join(new, keys, "full")
    fresh, both = F.col("__c").isNull(), F.col("__c").isNotNull() & F.col("__d").isNotNull()
    out = []
    for name in current.columns:
        value = F.col(name)
        if name in values:
            value = F.when(fresh, F.col(f"__new_{name}")).otherwise(value)
            if name in update:
                value = F.when(both, F.col(f"__new_{name}")).otherwise(value)
        if name in on_update:
            value = F.when(both, on_update[name]).otherwise(value)
        out.append(value.alias(name))
    return joined.select(*out)


def insert_absent(current: DataFrame, delta: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Add only the keys that ``current`` lacks; the first in ``order`` wins."""
    new = first_per_key(not_in(delta, current, keys), keys, order)
    return current.unionByName(new, allowMissingColumns=True)


@dataclass(frozen=True)
class Changes:
    """A delta split by what it does to the table: ``action`` is insert, update or same."""

    marked: DataFrame
    keys: tuple[str, ...]
    values: tuple[str, ...]
    among: Column | None = None

    def rows(self, action: str) -> DataFrame:
        return self.marked.filter(F.col("action") == action).select(*self.keys, *self.values)

    def counts(self) -> DataFrame:
        """Two rows: how many updates, how many inserts."""
        total = self.marked.agg(
            F.count(F.when(F.col("action") == "update", 1)).alias("updates"),
            F.count(F.when(F.col("action") == "insert", 1)).alias("inserts"),
        )
        return total.select(F.expr("stack(2, 'updates', updates, 'inserts', inserts) as (name, value)"))

    def apply(self, current: DataFrame) -> DataFrame:
        """The table with the changes; dates before the look-back pass by without a shuffle."""
        changed = self.marked.filter(F.col("action") != "same").select(*self.keys, *self.values)
        return upsert(current, changed, self.keys, self.values, among=self.among)


def change_only(
    current: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    compare: Sequence[str],
    since: dt.date | None = None,
    date_col: str = "date",
) -> Changes:
    """Split ``delta`` into inserts, updates where a compared value differs, and the rest.

    ``since`` prunes the stored side to dates after it (a partition filter on a table
    kept by date). A delta row that old would look new, so it is an error instead.
    """
    keys, values = list(keys), [c for c in delta.columns if c not in keys]
    among = None if since is None else F.col(date_col) > F.lit(since)
    if among is not None:
        current = current.filter(among)
        too_old = F.concat(F.lit("delta row before the look-back: "), F.col(date_col).cast("string"))
        delta = delta.filter(
            F.when(F.col(date_col) <= F.lit(since), F.raise_error(too_old)).otherwise(F.lit(True))
        )
    kept = current.select(*keys, *[F.col(c).alias(f"__old_{c}") for c in compare], F.lit(True).alias("__known"))
    differs = F.lit(False)
    for c in compare:
        differs = differs | ~F.col(c).eqNullSafe(F.col(f"__old_{c}"))
    action = F.when(F.col("__known").isNull(), "insert").when(differs, "update").otherwise("same")
    marked = delta.join(kept, keys, "left").select(*keys, *values, action.alias("action"))
    return Changes(marked, tuple(keys), tuple(values), among)


def replace_window(current: DataFrame, fresh: DataFrame, since: dt.date, date_col: str = "date") -> DataFrame:
    """Drop everything dated after ``since`` and put the fresh rows of that window in its place."""
    after = F.col(date_col) > F.lit(since)
    return current.filter(~after).unionByName(fresh.filter(after), allowMissingColumns=True)


def patch(
    current: DataFrame,
    delta: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    keep_on_null: bool = False,
    among: Column | None = None,
) -> DataFrame:
    """Set ``columns`` of the rows that ``delta`` (unique keys) matches; no row is added.

    ``keep_on_null`` leaves the stored value where the delta's is null. Stored rows that do
    not meet ``among`` pass by without a shuffle.
    """
    if among is not None:
        inside = F.coalesce(among, F.lit(False))
        changed = patch(current.filter(inside), delta, keys, columns, keep_on_null)
        return current.filter(~inside).unionByName(changed)
    keys = list(keys)
    new = delta.select(*keys, *[F.col(c).alias(f"__new_{c}") for c in columns], F.lit(True).alias("__hit"))
    out = []
    for c in current.columns:
        value = F.col(c)
        if c in columns:
            theirs = F.col(f"__new_{c}")
            value = F.coalesce(theirs, value) if keep_on_null else F.when(F.col("__hit"), theirs).otherwise(value)
        out.append(value.alias(c))
    return current.join(new, keys, "left").select(*out)


def append(current: DataFrame, rows: DataFrame) -> DataFrame:
    return current.unionByName(rows, allowMissingColumns=True)
