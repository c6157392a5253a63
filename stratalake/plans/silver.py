"""Cleaning rules of the seven raw tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake import schemas as S
from stratalake.functions.calendar import years_between
from stratalake.functions.casts import DATE_FORMATS, to_date, to_decimal, to_int
from stratalake.functions.text import code_map, joined_name
from stratalake.operators.cleaning import ACCEPTED, Rules, clean_by_slice
from stratalake.operators.merge import Staged, unstaged


def _tidy(*names: str) -> dict[str, Column]:
    return {c: F.trim(c) for c in names}


def _ids(id_type: str, *names: str) -> dict[str, Column]:
    return {f"_{c}": to_int(F.col(c), id_type) for c in names}


def _dates(formats: Sequence[str], *names: str) -> dict[str, Column]:
    return {f"_{c}": to_date(F.col(c), formats) for c in names}


def _value(name: str) -> Column:
    return F.col(f"_{name}")


def _values(*names: str) -> dict[str, Column]:
    return {c: _value(c) for c in names}


def _bad(name: str) -> tuple[str, Column]:
    return f"invalid {name}", _value(name).isNull()


def _missing(name: str) -> tuple[str, Column]:
    return f"missing {name}", F.col(name).isNull()


def patients(id_type: str, as_of: date, formats: Sequence[str] = DATE_FORMATS) -> Rules:
    return Rules(
        "patients", S.RAW["patients"],
        {**_ids(id_type, "patient_id"), **_dates(formats, "birth_date")}, "_patient_id",
        [_bad("patient_id"), _missing("first_name")],
        "registration_date",
        {
            **_values("patient_id"), **_tidy("first_name", "last_name"),
            "full_name": joined_name(F.col("first_name"), F.col("last_name")),
            "gender": code_map(F.col("gender"), S.GENDER, "Other"),
            **_values("birth_date"),
            "age": years_between(_value("birth_date"), F.lit(as_of)),
            **_tidy("blood_type", "city", "country", "phone"),
            "email": F.lower(F.trim("email")),
            "registration_date": to_date(F.col("registration_date"), formats),
            "insurance_status": code_map(F.col("insurance_status"), S.INSURED, "Inactive"),
        },
    )


def doctors(id_type: str, as_of: date, formats: Sequence[str] = DATE_FORMATS) -> Rules:
    return Rules(
        "doctors", S.RAW["doctors"], _ids(id_type, "doctor_id"), "_doctor_id",
        [_bad("doctor_id"), _missing("first_name")],
        "hire_date",
        {
            **_values("doctor_id"), **_tidy("first_name", "last_name"),
            "full_name": joined_name(F.col("first_name"), F.col("last_name")),
            **_tidy("specialization"), "department_id": to_int(F.col("department_id"), id_type), **_tidy("qualification"),
            "hire_date": to_date(F.col("hire_date"), formats),
            "status": code_map(F.col("status"), S.ACTIVE, "Inactive"),
            **_tidy("phone"),
        },
    )


def departments(id_type: str, as_of: date, formats: Sequence[str] = DATE_FORMATS) -> Rules:
    return Rules(
        "departments", S.RAW["departments"], _ids(id_type, "department_id"), "_department_id",
        [_bad("department_id"), _missing("department_name")],
        "established_date",
        {
            **_values("department_id"), **_tidy("department_name", "building", "floor", "head_doctor"),
            "established_date": to_date(F.col("established_date"), formats),
        },
    )


def treatments(id_type: str, as_of: date, formats: Sequence[str] = DATE_FORMATS) -> Rules:
    return Rules(
        "treatments", S.RAW["treatments"], _ids(id_type, "treatment_id"), "_treatment_id",
        [_bad("treatment_id"), _missing("treatment_name")],
        None,
        {
            **_values("treatment_id"), **_tidy("treatment_name", "treatment_type"),
            "diagnosis_code": F.upper(F.trim("diagnosis_code")), **_tidy("diagnosis_name"),
            "standard_cost": to_decimal(F.col("standard_cost"), 10, 2),
            "duration_minutes": to_int(F.col("duration_minutes")),
        },
    )


def insurance_providers(id_type: str, as_of: date, formats: Sequence[str] = DATE_FORMATS) -> Rules:
    return Rules(
        "insurance_providers", S.RAW["insurance_providers"], _ids(id_type, "insurance_id"), "_insurance_id",
        [_bad("insurance_id"), _missing("provider_name")],
        None,
        {
            **_values("insurance_id"), **_tidy("provider_name", "plan_type"),
            "coverage_pct": to_decimal(F.col("coverage_pct"), 5, 2),
            "max_coverage_amount": to_decimal(F.col("max_coverage_amount"), 12, 2),
            "status": code_map(F.col("status"), S.ACTIVE, "Inactive"),
        },
    )


def appointments(id_type: str, as_of: date, formats: Sequence[str] = DATE_FORMATS) -> Rules:
    ids = ("doctor_id", "department_id", "treatment_id")
    return Rules(
        "appointments", S.RAW["appointments"],
        {**_ids(id_type, "appointment_id", "patient_id"), **_dates(formats, "appointment_date")}, "_appointment_id",
        [_bad("appointment_id"), _bad("appointment_date"), _bad("patient_id")],
        "appointment_date",
        {
            **_values("appointment_id", "patient_id"), **{c: to_int(F.col(c), id_type) for c in ids},
            **_values("appointment_date"),
            **_tidy("appointment_time"),
            "duration_minutes": to_int(F.col("duration_minutes")),
            "status": code_map(F.col("status"), S.VISIT_STATUS),
            "consultation_fee": to_decimal(F.col("consultation_fee"), 10, 2),
            **_tidy("notes"),
        },
    )


def bills(id_type: str, as_of: date, formats: Sequence[str] = DATE_FORMATS) -> Rules:
    ids = ("appointment_id", "patient_id", "doctor_id", "insurance_id", "treatment_id")

    def amount(name: str) -> Column:
        return F.coalesce(to_decimal(F.col(name), 12, 2), F.lit(0).cast("decimal(12,2)"))

    return Rules(
        "bills", S.RAW["bills"],
        {**_ids(id_type, "bill_id"), **_dates(formats, "bill_date"), "_total_amount": to_decimal(F.col("total_amount"), 12, 2)},
        "_bill_id",
        [_bad("bill_id"), ("invalid or non-positive total_amount", ~(_value("total_amount") > 0)), _bad("bill_date")],
        "bill_date",
        {
            **_values("bill_id"), **{c: to_int(F.col(c), id_type) for c in ids},
            **_values("bill_date", "total_amount"),
            **{c: amount(c) for c in ("insurance_covered", "patient_paid", "outstanding_amount")},
            "payment_status": code_map(F.col("payment_status"), S.PAYMENT_STATUS),
        },
    )


RULES: dict[str, Callable[..., Rules]] = {
    "patients": patients, "doctors": doctors, "departments": departments, "treatments": treatments,
    "insurance_providers": insurance_providers, "appointments": appointments, "bills": bills,
}


def clean_table(name: str, bronze: DataFrame, as_of: date, load_ts: datetime, id_type: str = "int",
                formats: Sequence[str] = DATE_FORMATS, staged: Staged = unstaged):
    """(accepted in its declared schema, rejected) of one raw table. Dates are read as ISO days or in ``formats``;
    ``staged`` may write the judged rows by verdict, so that both results come from one pass."""
    accepted, rejected = clean_slices(name, bronze, as_of, load_ts, id_type, formats, staged, 1)
    return accepted[ACCEPTED], rejected


def clean_slices(name: str, bronze: DataFrame, as_of: date, load_ts: datetime, id_type: str, formats: Sequence[str],
                 staged: Staged, slices: int) -> tuple[dict[str, DataFrame], DataFrame]:
    """As ``clean_table``, with the accepted rows by verdict in so many slices of the ids."""
    accepted, rejected = clean_by_slice(bronze, RULES[name](id_type, as_of, formats), load_ts, staged, slices)
    return {verdict: S.conform(rows, name, id_type) for verdict, rows in accepted.items()}, rejected


def reject_log(rejected: Mapping[str, DataFrame]) -> DataFrame:
    """All tables' rejected rows, numbered uniquely within the run."""
    rows = reduce(DataFrame.unionByName, rejected.values())
    return S.conform(rows.withColumn("rejected_id", F.monotonically_increasing_id() + 1), "rejected_rows")


def reject_counts(log: DataFrame) -> DataFrame:
    """Rejected rows per table and reason, by table and the most frequent first; one row per pair, so the sort is small."""
    counts = log.groupBy("source_table", "rejection_reason").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy("source_table", F.desc("count"), "rejection_reason")
