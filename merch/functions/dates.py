"""Calendar expressions. Every date comes from a column or parameter, never from the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_end(d: Column) -> Column:
    return F.last_day(d)


def week_end(d: Column) -> Column:
    """The Sunday that closes the week of ``d``."""
    return F.date_add(d, F.lit(6) - F.weekday(d))


def previous_month_end(d: Column) -> Column:
    return F.date_sub(F.trunc(d, "MM"), 1)


def year_before(d: Column) -> Column:
    return F.add_months(d, -12)


def yesterday(d: Column) -> Column:
    return F.date_sub(d, 1)


def year_month(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def parse_day(text: Column) -> Column:
    return F.try_to_date(text, "yyyy-MM-dd") if hasattr(F, "try_to_date") else F.to_date(text, "yyyy-MM-dd")


def month_number(d: Column) -> Column:
    """Months since year 0, so that differences count calendar months."""
    return F.year(d) * 12 + F.month(d) - 1


def month_from_number(m: Column) -> Column:
    """First day of a month given as ``month_number``."""
    return F.make_date(F.floor(m / 12).cast("int"), (m % 12 + 1).cast("int"), F.lit(1))


def next_month_ends(d: Column, periods: int) -> Column:
    """Array of the ``periods`` month ends after the month of ``d``."""
    return F.transform(
        F.sequence(F.lit(1), F.lit(periods)),
        lambda k: F.last_day(F.add_months(F.trunc(d, "MM"), k)),
    )


def next_sundays(sunday: Column, periods: int) -> Column:
    """Array of the ``periods`` Sundays after ``sunday``."""
    return F.transform(F.sequence(F.lit(1), F.lit(periods)), lambda k: F.date_add(sunday, k * 7))


def calendar_features(d: Column) -> dict[str, Column]:
    return {
        "day_of_week": F.weekday(d),
        "day_of_month": F.day(d),
        "week_of_year": F.weekofyear(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year_progress": F.dayofyear(d) / F.lit(365.0),
    }
