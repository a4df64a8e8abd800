"""Calendar expressions. Every operator takes an explicit as-of date."""

from __future__ import annotations

import calendar
import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Days from a weekday (Monday first) back to the end of the last chart week.
CHART_WEEK_LAG = (4, 5, 6, 7, 8, 9, 3)


def day(value: dt.date | str) -> dt.date:
    return dt.date.fromisoformat(value) if isinstance(value, str) else value


def back(as_of: dt.date | str, days: int) -> dt.date:
    return day(as_of) - dt.timedelta(days=days)


def months_back(as_of: dt.date | str, months: int) -> dt.date:
    """The same day some months earlier, or the last day of a shorter month."""
    d = day(as_of)
    year, month = divmod(d.year * 12 + d.month - 1 - months, 12)
    return dt.date(year, month + 1, min(d.day, calendar.monthrange(year, month + 1)[1]))


def aligned_week(date: Column, as_of: dt.date | str) -> Column:
    """Start of the 7-day bucket of ``date`` when buckets end on the day before ``as_of``."""
    shift = (back(as_of, 1).weekday() + 1) % 7
    return F.trunc(F.date_sub(date, shift), "week")


def calendar_week(date: Column) -> Column:
    """Monday of the week of ``date``."""
    return F.trunc(date, "week")


def parse_date(c: Column) -> Column:
    """``MM/dd/yyyy``, else ``yyyy-MM-dd``, else null."""
    return F.coalesce(
        F.to_date(F.try_to_timestamp(c, F.lit("M/d/yyyy"))),
        F.to_date(F.try_to_timestamp(c, F.lit("yyyy-M-d"))),
    )


def complete_date(c: Column) -> Column:
    """Fill a year or year-month text up to a full date; year 0 becomes 2000."""
    full = (
        F.when(F.length(c) == 4, F.concat(c, F.lit("-01-01")))
        .when(F.length(c) == 7, F.concat(c, F.lit("-01")))
        .otherwise(c)
    )
    return F.when(full == "0000-01-01", F.lit("2000-01-01")).otherwise(full)


def year_week_start(c: Column) -> Column:
    """``YYYYWW`` -> first Monday of the year plus ``WW - 1`` weeks."""
    year, week = F.substring(c, 1, 4).cast("int"), F.substring(c, 5, 2).cast("int")
    first = F.next_day(F.date_sub(F.make_date(year, F.lit(1), F.lit(1)), 1), "MON")
    return F.date_add(first, (week - 1) * 7)


def chart_week(as_of: dt.date | str) -> list[dt.date]:
    """The seven days of the last finished chart week, newest first."""
    end = back(as_of, CHART_WEEK_LAG[day(as_of).weekday()])
    return [back(end, i) for i in range(7)]


def date_headers(columns: list[str]) -> list[str]:
    """Those column names that are dates in either file format."""
    found = []
    for name in columns:
        for fmt in ("%m/%d/%Y", "%Y-%m-%d"):
            try:
                dt.datetime.strptime(name, fmt)
            except ValueError:
                continue
            found.append(name)
            break
    return found


def header_date(name: str) -> dt.date:
    fmt = "%m/%d/%Y" if "/" in name else "%Y-%m-%d"
    return dt.datetime.strptime(name, fmt).date()
