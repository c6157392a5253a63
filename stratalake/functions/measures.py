"""Ratios, averages and change tests on exact decimals (EXP-10..12, 27, 28, FLT-3, AGG-9)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

HUNDRED = Decimal("100.0")


def percent(part: Column, whole: Column, kind: str = "decimal(5,2)") -> Column:
    """NULL where the whole is zero."""
    return (part * F.lit(HUNDRED) / F.nullif(whole, F.lit(0).cast("decimal(1,0)"))).cast(kind)


def whole_average(value: Column, kind: str = "decimal(6,2)") -> Column:
    """Average of whole numbers cut to a whole number; an aggregate."""
    return F.call_function("div", F.sum(value), F.nullif(F.count(value), F.lit(0))).cast(kind)


def recovery_rate(paid: Column, covered: Column, total: Column) -> Column:
    """Percentage of a bill that was paid or covered."""
    rate = ((paid + covered) * F.lit(HUNDRED) / F.nullif(total, F.lit(0).cast("decimal(1,0)"))).cast("decimal(10,2)")
    return F.when(total > 0, rate).otherwise(F.lit(0).cast("decimal(10,2)"))


# Fixed value: how text is compared where letter case and trailing blanks do not count.
COLLATION = "UTF8_LCASE_RTRIM"


def differs(left: Column, right: Column, blank, ignore_case: bool = False) -> Column:
    """Inequality in which NULL equals ``blank``. With ``ignore_case``, text is compared by ``COLLATION``."""
    a, b = F.coalesce(left, F.lit(blank)), F.coalesce(right, F.lit(blank))
    if ignore_case and isinstance(blank, str):
        a, b = F.collate(a, COLLATION), F.collate(b, COLLATION)
    return a != b
