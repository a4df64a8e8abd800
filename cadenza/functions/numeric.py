"""Ratios and growth measures with the zero and null rules spelled out."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

STREAM_VALUE = 0.0056  # fixed value: revenue per stream
WEEKS_PER_YEAR = 52


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b``; a positive number over zero is infinite, zero over zero and nulls are null.

    Infinity passes every ``>=`` threshold and null passes none, which is what the
    report filters rely on.
    """
    a, b = _col(a).cast("double"), _col(b).cast("double")
    return (
        F.when(b != 0, F.try_divide(a, b))
        .when((b == 0) & (a > 0), F.lit(float("inf")))
        .when((b == 0) & (a < 0), F.lit(float("-inf")))
    )


def change(new: Column | str, old: Column | str) -> Column:
    """Fractional change, 0.25 for a quarter more."""
    return safe_ratio(new, old) - 1


def acceleration(new: Column | str, old: Column | str, steps: int) -> Column:
    """Mean growth per step over ``steps`` steps."""
    return F.pow(safe_ratio(new, old), F.lit(1.0 / steps)) - 1


def exact_percent(new: Column | str, old: Column | str) -> Column:
    """``100 * (new - old) / old`` as a decimal, rounded half away from zero at two
    places; null where ``old`` is null or zero."""
    new, old = _col(new).cast("decimal(18,0)"), _col(old).cast("decimal(18,0)")
    return F.round(F.try_divide((new - old) * F.lit(100).cast("decimal(3,0)"), old), 2)


def percent_or_zero(new: Column | str, old: Column | str) -> Column:
    """:func:`exact_percent` with 0 where nothing was streamed before."""
    return F.when(_col(old) == 0, F.lit(0.0)).otherwise(exact_percent(new, old).cast("double"))


def fraction_or_zero(new: Column | str, old: Column | str, places: int = 2) -> Column:
    """``(new - old) / old`` rounded, 0 where ``old`` is 0. Real division throughout."""
    new, old = _col(new).cast("decimal(18,0)"), _col(old).cast("decimal(18,0)")
    return F.when(old == 0, F.lit(0.0)).otherwise(
        F.round(F.try_divide(new - old, old), places).cast("double")
    )


def clamp(c: Column | str, low: float, high: float) -> Column:
    """``c`` kept within ``[low, high]``; null stays null."""
    c = _col(c)
    return F.when(c < low, F.lit(low)).when(c > high, F.lit(high)).otherwise(c)


def yearly_revenue(week_streams: Column | str) -> Column:
    """Revenue per year at the pace of one week."""
    return _col(week_streams) * F.lit(WEEKS_PER_YEAR) * F.lit(STREAM_VALUE)


def lifetime_revenue(streams: Column | str) -> Column:
    return _col(streams) * F.lit(STREAM_VALUE)


def id_text(c: Column | str) -> Column:
    """A natural key as text, without the ``.0`` a float column leaves behind."""
    c = _col(c)
    whole = c.try_cast("decimal(38,4)").try_cast("bigint").cast("string")
    return F.coalesce(whole, c.cast("string"))


def present(c: Column | str) -> Column:
    """True for a value that is neither null nor empty."""
    return F.coalesce(F.length(_col(c)) > 0, F.lit(False))


def not_true(c: Column | str) -> Column:
    """Three-valued ``is not true``: keeps false and null."""
    return ~F.coalesce(_col(c), F.lit(False))


def any_present(*columns: Column | str) -> Column:
    """True where at least one of the ids is not null."""
    return F.coalesce(*[_col(c).cast("string") for c in columns]).isNotNull()
