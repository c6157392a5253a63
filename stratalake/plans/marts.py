"""Visits per day and department, kept so that reports need not read the fact (VIEW-1, VIEW-3, AGG-5).

Counts and sums are added up and key sets or-ed, so any report over days and departments follows from these two
small tables, distinct patients and doctors included. A refresh reads only the months of the fact that were
rewritten since the last one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.measures import percent
from stratalake.operators.distinct import key_sets, set_sizes
from stratalake.plans import run
from stratalake.sources.snapshots import Layout, Store

GROUPS = ["date_key", "department_key"]
KINDS = {"patient": "patient_key", "doctor": "doctor_key"}
# The statuses that reports count, by the column that counts them.
STATUSES = {"completed": "Completed", "cancelled": "Cancelled", "no_shows": "No-Show", "scheduled": "Scheduled"}
SCHEMAS = {
    "visit_totals": (
        "date_key int, department_key bigint, visits bigint, completed bigint, cancelled bigint, no_shows bigint, scheduled bigint, "
        "fees decimal(38,2), paid_visits bigint, minutes bigint, timed_visits bigint"),
    "visit_keys": "date_key int, department_key bigint, kind string, bucket bigint, keys bigint",
    "visit_sources": "part int, run string",
}
_LAYOUT = Layout(None, "date_key div 100", "department_key", "date_key")
LAYOUTS = {"visit_totals": _LAYOUT, "visit_keys": _LAYOUT}


def visit_totals(appointments: DataFrame) -> DataFrame:
    return appointments.groupBy(*GROUPS).agg(
        F.count("appointment_key").alias("visits"),
        *[F.count_if(F.col("appointment_status") == label).alias(name) for name, label in STATUSES.items()],
        F.sum("consultation_fee").cast("decimal(38,2)").alias("fees"), F.count("consultation_fee").alias("paid_visits"),
        F.sum("duration_minutes").alias("minutes"), F.count("duration_minutes").alias("timed_visits"))


def visit_keys(appointments: DataFrame) -> DataFrame:
    return key_sets(appointments, GROUPS, KINDS)


def _report(totals: DataFrame, keys: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str], measures: Sequence[Column],
            names: Mapping[str, str]) -> DataFrame:
    """Sums and key counts per combination of a dimension's attributes, which goes by its smallest key."""
    members = dim.select(key, *attrs).withColumn("_group", F.min(key).over(Window.partitionBy(*attrs)))
    groups = members.select(key, "_group")
    sums = totals.join(groups, key).groupBy("_group").agg(*measures)
    sizes = set_sizes(keys.join(groups, key), ["_group"], names)
    labels = members.where(F.col(key) == F.col("_group")).select("_group", *attrs)
    return sums.join(sizes, "_group", "left").join(labels, "_group").select(
        *attrs, *[c for c in sums.columns if c != "_group"], *[F.coalesce(c, F.lit(0)).alias(c) for c in names.values()])


def _money(total_name: str) -> list[Column]:
    return [
        F.sum("fees").alias(total_name),
        (F.sum("fees") / F.nullif(F.sum("paid_visits"), F.lit(0))).cast("decimal(14,6)").cast("decimal(10,2)").alias("avg_consultation_fee"),
        F.call_function("div", F.sum("minutes"), F.nullif(F.sum("timed_visits"), F.lit(0))).cast("decimal(6,2)").alias("avg_duration_minutes"),
    ]


def _rate(column: str, name: str) -> Column:
    return percent(F.sum(column), F.sum("visits")).alias(name)


def monthly_appointments(totals: DataFrame, keys: DataFrame, dates: DataFrame) -> DataFrame:
    """The report of the same name in ``plans.reports``, from daily totals and key sets."""
    return _report(totals, keys, dates, "date_key", ["year", "quarter_name", "month", "month_name"], [
        F.sum("visits").alias("total_appointments"), *[F.sum(c).alias(c) for c in STATUSES],
        _rate("completed", "completion_rate_pct"), _rate("cancelled", "cancellation_rate_pct"),
        *_money("total_consultation_revenue")], {"patient": "unique_patients"})


def department_summary(totals: DataFrame, keys: DataFrame, departments: DataFrame) -> DataFrame:
    """The report of the same name in ``plans.reports``, from daily totals and key sets."""
    attrs = ["department_id", "department_name", "building", "floor", "head_doctor"]
    return _report(totals, keys, departments, "department_key", attrs, [
        F.sum("visits").alias("total_appointments"), *[F.sum(c).alias(c) for c in ("completed", "cancelled", "no_shows")],
        _rate("completed", "completion_rate_pct"), *_money("total_revenue")],
        {"patient": "unique_patients", "doctor": "active_doctors"})


def open_marts(spark: SparkSession, root: str) -> Store:
    # runs of the "marts" layer held bitmaps of another form; the first refresh of this layer reads all months
    return Store(spark, root, "daily_marts", {name: T.StructType.fromDDL(ddl) for name, ddl in SCHEMAS.items()}, LAYOUTS)


def refresh(spark: SparkSession, root: str, at: datetime, id_type: str = "int", buckets: int = 1) -> list[int]:
    """Bring the daily tables up to the published fact; returns the months that were read for it."""
    gold, marts = run.open_layer(spark, root, "gold", id_type), open_marts(spark, root)
    parts = gold.parts("fact_appointments")
    known = marts.table("visit_sources")
    done = set() if known is None else {(r["part"], r["run"]) for r in known.collect()}  # a row per month
    changed = [p for p in parts if (p.part, p.run) not in done]
    if not changed and known is not None:
        return []
    rows, name = gold.read("fact_appointments", changed), f"run-{at:%Y%m%d%H%M%S}-v{(gold.latest() or {'version': 0})['version']}"
    tables = {t: marts.write_parts(name, t, make(rows), buckets=buckets)[0] for t, make in (("visit_totals", visit_totals), ("visit_keys", visit_keys))}
    sources = spark.createDataFrame([(p.part, p.run) for p in parts], SCHEMAS["visit_sources"])
    tables["visit_sources"] = marts.write(name, "visit_sources", sources.coalesce(1))[0]
    marts.publish(name, tables, at)
    return [p.part for p in changed]
