"""Data-quality reports over the star schema (DQ-1..7)."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.checks import count_violations, duplicates, flag_sums, null_counters

# The result sets of the quality step, as they are published.
REPORTS = {
    "row_counts": "tbl string, rows bigint",
    "null_keys_appointments": "null_date_key bigint, null_patient_key bigint, null_doctor_key bigint, null_department_key bigint, null_treatment_key bigint",
    "null_keys_billing": "null_date_key bigint, null_patient_key bigint, null_doctor_key bigint, null_treatment_key bigint, null_insurance_key bigint",
    "invalid_visits": "negative_fees bigint, zero_duration bigint",
    "invalid_bills": "zero_total bigint, negative_outstanding bigint, negative_covered bigint",
    "several_current_patients": "patient_id bigint, current_rows bigint",
    "several_current_doctors": "doctor_id bigint, current_rows bigint",
    "date_range_appointments": "earliest_appointment date, latest_appointment date",
    "date_range_billing": "earliest_bill date, latest_bill date",
}
APPOINTMENT_KEYS = ["date_key", "patient_key", "doctor_key", "department_key", "treatment_key"]
BILL_KEYS = ["date_key", "patient_key", "doctor_key", "treatment_key", "insurance_key"]


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(tbl, rows) of every table."""
    counts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("tbl"), "rows")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def null_keys(fact: DataFrame, keys: list[str]) -> DataFrame:
    return fact.agg(*flag_sums({f"null_{c}": F.col(c).isNull() for c in keys}))


def invalid_visits(appointments: DataFrame) -> DataFrame:
    return appointments.agg(*flag_sums({
        "negative_fees": F.col("consultation_fee") < 0,
        "zero_duration": F.col("duration_minutes") <= 0,
    }))


def invalid_bills(bills: DataFrame) -> DataFrame:
    return bills.agg(*flag_sums({
        "zero_total": F.col("total_amount") <= 0,
        "negative_outstanding": F.col("outstanding_amount") < 0,
        "negative_covered": F.col("insurance_covered") < 0,
    }))


def several_current(dim: DataFrame, id_col: str) -> DataFrame:
    """Ids with more than one current version."""
    return duplicates(dim.where("is_current"), id_col, count_as="current_rows")


def date_range(fact: DataFrame, dates: DataFrame, first: str, last: str) -> DataFrame:
    """First and last day of a fact; the days are reduced to one row per key before the join."""
    used = fact.select("date_key").distinct().join(dates.select("date_key", "full_date"), "date_key")
    return used.agg(F.min("full_date").alias(first), F.max("full_date").alias(last))


def quality_reports(gold: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    visits, bills, dates = gold["fact_appointments"], gold["fact_billing"], gold["dim_date"]
    return {
        "row_counts": row_counts(gold),
        "null_keys_appointments": null_keys(visits, APPOINTMENT_KEYS),
        "null_keys_billing": null_keys(bills, BILL_KEYS),
        "invalid_visits": invalid_visits(visits),
        "invalid_bills": invalid_bills(bills),
        "several_current_patients": several_current(gold["dim_patient"], "patient_id"),
        "several_current_doctors": several_current(gold["dim_doctor"], "doctor_id"),
        "date_range_appointments": date_range(visits, dates, "earliest_appointment", "latest_appointment"),
        "date_range_billing": date_range(bills, dates, "earliest_bill", "latest_bill"),
    }


def violations(gold: Mapping[str, DataFrame]) -> DataFrame:
    """(check_name, violations) of everything that should be zero; one scan per fact."""
    visits, bills = gold["fact_appointments"], gold["fact_billing"]
    current = {"patient": gold["dim_patient"], "doctor": gold["dim_doctor"]}
    parts = [
        count_violations(visits, {
            **null_counters(APPOINTMENT_KEYS, "appointments_null_"),
            "appointments_negative_fees": F.count_if(F.col("consultation_fee") < 0),
            "appointments_zero_duration": F.count_if(F.col("duration_minutes") <= 0),
        }),
        count_violations(bills, {
            **null_counters(BILL_KEYS, "billing_null_"),
            "billing_zero_total": F.count_if(F.col("total_amount") <= 0),
            "billing_negative_outstanding": F.count_if(F.col("outstanding_amount") < 0),
            "billing_negative_covered": F.count_if(F.col("insurance_covered") < 0),
        }),
        *[several_current(dim, f"{name}_id").agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(f"several_current_{name}s").alias("check_name"), "violations") for name, dim in current.items()],
    ]
    return reduce(DataFrame.unionByName, parts)
