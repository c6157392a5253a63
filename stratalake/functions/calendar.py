"""Calendar attributes of a date (EXP-13..19, 21)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(day: Column) -> Column:
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def week_number(day: Column) -> Column:
    """Weeks start on Sunday and the week of January 1st is week 1 (so a year may reach 54)."""
    shift = F.dayofweek(F.trunc(day, "year")) - 2
    return F.floor((F.dayofyear(day) + shift) / 7).cast("int") + 1


def is_weekend(day: Column) -> Column:
    return F.dayofweek(day).isin(1, 7)


def years_between(start: Column, end: Column) -> Column:
    """Year boundaries crossed, not birthdays passed."""
    return F.year(end) - F.year(start)


def attributes(day: Column) -> dict[str, Column]:
    """Columns of the date dimension, in order."""
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "quarter_name": F.concat(F.lit("Q"), F.quarter(day).cast("string")),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "day_of_month": F.dayofmonth(day),
        "day_of_week": F.dayofweek(day),
        "day_name": F.date_format(day, "EEEE"),
        "week_number": week_number(day),
        "is_weekend": is_weekend(day),
    }
