"""Constraints and quality counters (CON-1..6, AGG-11, AGG-14). All return DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.facts import Lookup, unknown_ids


def duplicates(df: DataFrame, *keys: str, count_as: str = "rows") -> DataFrame:
    """Keys that occur more than once."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_as)).where(F.col(count_as) > 1)


def null_counters(columns: Sequence[str], prefix: str = "null_") -> dict[str, Column]:
    return {f"{prefix}{c}": F.count_if(F.col(c).isNull()) for c in columns}


def failure_counters(conditions: Mapping[str, Column]) -> dict[str, Column]:
    """Rows that break a condition; an undecided (NULL) condition passes."""
    return {name: F.count_if(~F.coalesce(ok, F.lit(True))) for name, ok in conditions.items()}


def length_counters(limits: Mapping[str, int]) -> dict[str, Column]:
    return failure_counters({f"long_{c}": F.length(c) <= n for c, n in limits.items()})


def flag_sums(flags: Mapping[str, Column]) -> list[Column]:
    """One counter per flag, NULL (not 0) over an empty table."""
    return [F.sum(F.when(bad, 1).otherwise(0)).alias(name) for name, bad in flags.items()]


def count_violations(df: DataFrame, counters: Mapping[str, Column]) -> DataFrame:
    """(check_name, violations) of all counters from one scan."""
    totals = df.agg(*[c.cast("long").alias(name) for name, c in counters.items()])
    return totals.unpivot([], list(counters), "check_name", "violations")


def orphans(fact: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """(check_name, violations) per foreign key: rows whose key is set but unknown to the dimension."""
    found = unknown_ids(fact, {look.on: look.dim.select(look.key_col) for look in lookups})
    return found.select(F.col("lookup").alias("check_name"),
                        (F.col("missing_rows") - F.col("null_rows")).alias("violations"))
