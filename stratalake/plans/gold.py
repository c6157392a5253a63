"""Clean tables into the star schema."""

from __future__ import annotations

from collections.abc import Mapping
from contextlib import nullcontext
from datetime import date, datetime
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake import schemas as S
from stratalake.functions.calendar import date_key
from stratalake.functions.measures import recovery_rate
from stratalake.operators.calendar import dim_date
from stratalake.operators.dimensions import scd1_merge, scd2_merge
from stratalake.operators.facts import Lookup, fact_changes, lookup_keys
from stratalake.operators.keys import assign_keys
from stratalake.operators.merge import KEEP, SIDE, Staged, split_slices, unstaged
from stratalake.session import Staging

Tables = Mapping[str, DataFrame]

# Days the date dimension covers unless told otherwise.
FIRST_DAY, LAST_DAY = date(2010, 1, 1), date(2035, 12, 31)


class Run(NamedTuple):
    """What every load of one run shares."""

    spark: SparkSession
    as_of: date
    load_ts: datetime
    id_type: str = "int"
    first_day: date = FIRST_DAY
    last_day: date = LAST_DAY
    ignore_case: bool = False
    staged: Staged = unstaged


def load_dates(run: Run, old: DataFrame) -> DataFrame:
    return dim_date(run.spark, run.first_day, run.last_day, old)


def load_overwritten(run: Run, old: DataFrame, snapshot: DataFrame, highest: int = 0) -> DataFrame:
    """Departments, treatments and insurance: key first, id second, audit time last."""
    key, id_col, *attrs, _ = old.columns
    return scd1_merge(old, snapshot, id_col, attrs, key, run.load_ts, run.staged, highest)


def load_versioned(run: Run, old: DataFrame, snapshot: DataFrame, tracked: Mapping[str, object], highest: int = 0) -> DataFrame:
    """Patients and doctors; ``highest`` is the largest key given so far."""
    key, id_col, *attrs = old.columns[:-4]
    return scd2_merge(old, snapshot, id_col, attrs, tracked, key, run.as_of, run.load_ts, run.ignore_case,
                      run.staged, highest)


def appointment_source(appointments: DataFrame) -> DataFrame:
    return appointments.withColumnRenamed("status", "appointment_status").withColumn(
        "date_key", date_key(F.col("appointment_date")))


def bill_source(bills: DataFrame) -> DataFrame:
    wide = {c: F.col(c).cast("decimal(18,2)")
            for c in ("total_amount", "insurance_covered", "patient_paid", "outstanding_amount")}
    return bills.withColumns({**wide, "date_key": date_key(F.col("bill_date"))})


def appointment_lookups(dims: Tables) -> list[Lookup]:
    return [
        Lookup(dims["dim_date"], "date_key", "date_key", "date_key"),
        Lookup(dims["dim_patient"], "patient_id", "patient_id", "patient_key"),
        Lookup(dims["dim_doctor"], "doctor_id", "doctor_id", "doctor_key"),
        Lookup(dims["dim_department"], "department_id", "department_id", "department_key"),
        Lookup(dims["dim_treatment"], "treatment_id", "treatment_id", "treatment_key"),
    ]


def bill_lookups(dims: Tables) -> list[Lookup]:
    return [
        Lookup(dims["dim_date"], "date_key", "date_key", "date_key"),
        Lookup(dims["dim_patient"], "patient_id", "patient_id", "patient_key"),
        Lookup(dims["dim_doctor"], "doctor_id", "doctor_id", "doctor_key"),
        Lookup(dims["dim_treatment"], "treatment_id", "treatment_id", "treatment_key"),
        Lookup(dims["dim_insurance"], "insurance_id", "insurance_id", "insurance_key"),
    ]


# The cleaned table that each dimension and fact comes from, and the tracked attributes of those that keep history.
DIMENSIONS: dict[str, tuple[str, Mapping[str, object] | None]] = {
    "dim_department": ("departments", None), "dim_treatment": ("treatments", None), "dim_insurance": ("insurance_providers", None),
    "dim_patient": ("patients", S.PATIENT_TRACKED), "dim_doctor": ("doctors", S.DOCTOR_TRACKED),
}
FACTS = {"fact_appointments": "appointments", "fact_billing": "bills"}


class FactLoad(NamedTuple):
    """What loads one fact: its source with the columns of the fact, and the look-ups of its dimensions."""

    source: DataFrame
    id_col: str
    key_col: str
    mutable: Mapping[str, object]
    lookups: list[Lookup]


def fact_lookups(name: str, dims: Tables) -> list[Lookup]:
    return appointment_lookups(dims) if name == "fact_appointments" else bill_lookups(dims)


def fact_load(name: str, clean: DataFrame, dims: Tables) -> FactLoad:
    if name == "fact_appointments":
        return FactLoad(appointment_source(clean), "appointment_id", "appointment_key", S.VISIT_MUTABLE, appointment_lookups(dims))
    return FactLoad(bill_source(clean), "bill_id", "billing_key", S.BILL_MUTABLE, bill_lookups(dims))


def fact_delta(run: Run, name: str, old: DataFrame, load: FactLoad, highest: int, slices: int = 1) -> DataFrame:
    """The rows of a fact that this load changes or adds, as they will be stored; all others stay as they are.

    New rows look up their keys in so many ``slices``, one after another, because every look-up in a large dimension
    shuffles them whole.
    """
    stored = old.drop("recovery_rate")
    rows = fact_changes(stored, load.source, load.id_col, load.mutable, load.lookups, run.load_ts, run.ignore_case)
    rows = rows.where(F.col("_class") != KEEP)
    source = [c for c in rows.columns if c in load.source.columns or c == "dwh_load_date"]
    with run.staged.inner() if isinstance(run.staged, Staging) else nullcontext(run.staged) as staged:
        changed, unseen = split_slices(rows, stored.columns, source, staged, load.id_col, slices)
        found = []
        for side, new in unseen.items():
            found.append(staged(lookup_keys(new, load.lookups)))
            if isinstance(staged, Staging):
                staged.remove(SIDE, side)
        added = assign_keys(reduce(DataFrame.unionByName, found), load.id_col, load.key_col, highest)
        delta = changed.unionByName(added.select(*stored.columns))
        if "recovery_rate" in old.columns:
            delta = with_recovery_rate(delta)
        return run.staged(delta.select(*old.columns))


def with_recovery_rate(bills: DataFrame) -> DataFrame:
    return bills.withColumn("recovery_rate", recovery_rate(
        F.col("patient_paid"), F.col("insurance_covered"), F.col("total_amount")))


# Conditions every stored fact row meets; NULL passes.
def fact_conditions(table: str) -> dict[str, Column]:
    if table == "fact_appointments":
        return {"fee_not_negative": F.col("consultation_fee") >= 0, "duration_positive": F.col("duration_minutes") > 0}
    if table == "fact_billing":
        return {
            "total_positive": F.col("total_amount") > 0,
            "covered_not_negative": F.col("insurance_covered") >= 0,
            "paid_not_negative": F.col("patient_paid") >= 0,
            "outstanding_not_negative": F.col("outstanding_amount") >= 0,
        }
    return {}
