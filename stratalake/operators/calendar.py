"""The date dimension (GEN-1)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import calendar as C


def calendar_between(bounds: DataFrame) -> DataFrame:
    """One row per day from ``first_day`` to ``last_day`` of the single row of ``bounds``."""
    days = bounds.select(F.explode(F.sequence("first_day", "last_day")).alias("_day"))
    return days.select(*[c.alias(name) for name, c in C.attributes(F.col("_day")).items()])


def dim_date(spark: SparkSession, first_day: date, last_day: date, existing: DataFrame | None = None) -> DataFrame:
    """All days of the range; days already in ``existing`` are kept as they are."""
    bounds = spark.range(1).select(F.lit(first_day).alias("first_day"), F.lit(last_day).alias("last_day"))
    days = calendar_between(bounds)
    if existing is None:
        return days
    return existing.unionByName(days.join(existing.select("date_key"), "date_key", "left_anti"))
