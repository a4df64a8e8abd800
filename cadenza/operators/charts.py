"""Charts that remember: new entries, streaks, re-entry notices, fan-out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.functions.dates import back
from cadenza.operators.keys import first_per_key

AWAY_DAYS = 365  # fixed values: absence that makes a return news, and the stand-in for "never"
NEVER_DAYS = 1000


def mark_new(edition: DataFrame, previous: DataFrame, keys: Sequence[str], flag: str = "is_new") -> DataFrame:
    """Flag the rows whose key was not in the previous edition."""
    keys = list(keys)
    seen = previous.select(*keys).distinct().withColumn("__seen", F.lit(True))
    return edition.join(seen, keys, "left").withColumn(flag, F.col("__seen").isNull()).drop("__seen")


def next_streaks(
    counts: DataFrame, previous: DataFrame, key: str, by: str, streak: str, size: int = 200
) -> DataFrame:
    """The ``size`` leading keys with their streak one longer; leavers drop out."""
    top = counts.select(key, by).distinct().orderBy(F.col(by).desc(), F.col(key).asc()).limit(size)
    return top.join(previous.select(key, streak), key, "left").select(
        key, (F.coalesce(F.col(streak), F.lit(0)) + 1).alias(streak)
    )


@dataclass(frozen=True)
class ReentryRule:
    """Inner and outer chart size, and for how many editions a notice stays up."""

    inner: int
    outer: int
    limit: int

    def names(self) -> tuple[str, str, str, str]:
        i, o = self.inner, self.outer
        return f"is_top_{i}", f"is_top_{o}", f"last_appearance_in_top_{i}", f"last_appearance_in_top_{o}"


GENRE_RULE = ReentryRule(20, 100, 7)
ARTIST_IN_GENRE_RULE = ReentryRule(10, 50, 3)


def next_reentry(
    ranks: DataFrame, previous: DataFrame | None, keys: Sequence[str], rule: ReentryRule, as_of: dt.date
) -> DataFrame:
    """The next chart state from the last one and the current ranks (column ``rnk``).

    A key that enters either cut after a year away starts a notice, which counts up once
    per edition and goes out after ``rule.limit``.
    """
    keys = list(keys)
    is_in, is_out, last_in, last_out = rule.names()
    if previous is None:
        state = ranks.withColumns(
            {"should_notify": F.lit(None).cast("int"), last_in: F.lit(None).cast("date"), last_out: F.lit(None).cast("date")}
        )
    else:
        state = ranks.join(previous.select(*keys, "should_notify", last_in, last_out), keys, "left")
    never = F.lit(back(as_of, NEVER_DAYS))
    state = state.withColumns(
        {
            "should_notify": F.coalesce("should_notify", F.lit(0)),
            last_in: F.coalesce(F.col(last_in), never),
            last_out: F.coalesce(F.col(last_out), never),
            is_in: F.col("rnk") <= rule.inner,
            is_out: F.col("rnk") <= rule.outer,
        }
    )
    now = F.lit(as_of)

    def returned(inside: str, last: str) -> Column:
        return F.col(inside) & (F.datediff(now, F.col(last)) >= AWAY_DAYS)

    n = F.col("should_notify")
    notify = (
        F.when(n + 1 > rule.limit, 0)
        .when((n > 0) | returned(is_in, last_in) | returned(is_out, last_out), n + 1)
        .otherwise(0)
    )
    return state.withColumns(
        {
            "should_notify": notify,
            last_in: F.when(F.col(is_in), now).otherwise(F.col(last_in)),
            last_out: F.when(F.col(is_out), now).otherwise(F.col(last_out)),
        }
    )


def carry_absent(state: DataFrame, previous: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keep the stored rows of keys that have no rank today, as a keyed upsert would."""
    kept = previous.join(state.select(*keys), list(keys), "left_anti")
    return state.unionByName(kept, allowMissingColumns=True)


def next_edition(ranks: DataFrame, previous: DataFrame | None, keys: Sequence[str], rule: ReentryRule, as_of: dt.date) -> DataFrame:
    """The stored chart after an edition: the new state, and the last one of keys without a rank today.

    A kept row has no rank and is in neither cut; its last appearances stay, so that a later
    return is known as one. Its notice rests until then.
    """
    state = next_reentry(ranks, previous, keys, rule, as_of)
    if previous is None:
        return state
    is_in, is_out, *_ = rule.names()
    out = F.lit(False)
    gone = previous.drop(*[c for c in ranks.columns if c not in keys], is_in, is_out).withColumns({is_in: out, is_out: out})
    return carry_absent(state, gone, keys)


def assemble_chart(entries: Sequence[DataFrame], order: Sequence[Column], entity: str = "entity_id") -> DataFrame:
    """Union of chart kinds, one row per (entity, chart), with the number of charts per entity."""
    union = entries[0]
    for more in entries[1:]:
        union = union.unionByName(more, allowMissingColumns=True)
    unique = first_per_key(union, [entity, "chart"], order)
    counts = unique.groupBy(entity).agg(F.count(F.lit(1)).alias("chart_count"))
    return unique.join(counts, entity)


def sparkline(daily: DataFrame, keys: Sequence[str], value: str, name: str = "sparkline") -> DataFrame:
    """JSON list of (date, value) per key, oldest first. Bounded by the days kept."""
    point = F.struct(F.col("date").alias("date"), F.col(value).alias("value"))
    points = daily.filter(F.col("date").isNotNull())
    return points.groupBy(*keys).agg(F.to_json(F.array_sort(F.collect_list(point))).alias(name))


def fan_out(users: DataFrame, items: DataFrame, spread: int | None = None) -> DataFrame:
    """Every user with every item, as an equi-join on a spread key.

    The users are dealt over ``spread`` slots, the shuffle partitions of the session unless
    given, and the (few) items repeated in each, so the product is built by many tasks and
    Spark picks the join by size.
    """
    spread = spread or int(users.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = users.withColumn("__slot", F.pmod(F.xxhash64(*users.columns), F.lit(spread)).cast("int"))
    each = items.withColumn("__slot", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))
    return dealt.join(each, "__slot").drop("__slot")


def rank_change(rank: Column, before: Column) -> Column:
    """Places gained; null where there was no earlier rank (new)."""
    return before - rank


def display_change(change: Column) -> Column:
    """The change as text, ``New`` for a null."""
    return F.coalesce(change.cast("string"), F.lit("New"))
