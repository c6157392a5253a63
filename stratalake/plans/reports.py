"""Reporting views (VIEW-1..5). Each returns a lazy DataFrame over the star schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.measures import percent, whole_average


def _by_attributes(fact: DataFrame, dim: DataFrame, key: str, attrs: Sequence[str],
                   measures: Sequence[Column]) -> DataFrame:
    """Aggregate the facts per combination of dimension attributes.

    The facts are grouped by one number per combination (its smallest key) and the attributes
    are joined to the result, so the shuffled rows carry no attribute text.
    """
    members = dim.select(key, *attrs).withColumn("_group", F.min(key).over(Window.partitionBy(*attrs)))
    totals = fact.join(members.select(key, "_group"), key).groupBy("_group").agg(*measures)
    labels = members.where(F.col(key) == F.col("_group")).select("_group", *attrs)
    return totals.join(labels, "_group").select(*attrs, *[c for c in totals.columns if c != "_group"])


def _status_count(column: str, label: str, name: str) -> Column:
    return F.count_if(F.col(column) == label).alias(name)


def _status_percent(label: str, name: str) -> Column:
    return percent(F.count_if(F.col("appointment_status") == label), F.count("appointment_key")).alias(name)


def _visit_money(total_name: str) -> list[Column]:
    return [
        F.sum("consultation_fee").alias(total_name),
        F.avg("consultation_fee").cast("decimal(10,2)").alias("avg_consultation_fee"),
        whole_average(F.col("duration_minutes")).alias("avg_duration_minutes"),
        F.count_distinct("patient_key").alias("unique_patients"),
    ]


def monthly_appointments(appointments: DataFrame, dates: DataFrame) -> DataFrame:
    return _by_attributes(appointments, dates, "date_key", ["year", "quarter_name", "month", "month_name"], [
        F.count("appointment_key").alias("total_appointments"),
        _status_count("appointment_status", "Completed", "completed"),
        _status_count("appointment_status", "Cancelled", "cancelled"),
        _status_count("appointment_status", "No-Show", "no_shows"),
        _status_count("appointment_status", "Scheduled", "scheduled"),
        _status_percent("Completed", "completion_rate_pct"),
        _status_percent("Cancelled", "cancellation_rate_pct"),
        *_visit_money("total_consultation_revenue"),
    ])


def doctor_performance(appointments: DataFrame, doctors: DataFrame) -> DataFrame:
    """Only visits loaded under a doctor's current version count."""
    current = doctors.where("is_current").withColumnRenamed("full_name", "doctor_name")
    attrs = ["doctor_id", "doctor_name", "specialization", "qualification", "status"]
    return _by_attributes(appointments, current, "doctor_key", attrs, [
        F.count("appointment_key").alias("total_appointments"),
        _status_count("appointment_status", "Completed", "completed_appointments"),
        _status_count("appointment_status", "Cancelled", "cancelled_appointments"),
        _status_percent("Completed", "completion_rate_pct"),
        *_visit_money("total_revenue"),
    ])


def department_summary(appointments: DataFrame, departments: DataFrame) -> DataFrame:
    """``active_doctors`` counts the doctor versions seen, whatever their status."""
    attrs = ["department_id", "department_name", "building", "floor", "head_doctor"]
    return _by_attributes(appointments, departments, "department_key", attrs, [
        F.count("appointment_key").alias("total_appointments"),
        _status_count("appointment_status", "Completed", "completed"),
        _status_count("appointment_status", "Cancelled", "cancelled"),
        _status_count("appointment_status", "No-Show", "no_shows"),
        _status_percent("Completed", "completion_rate_pct"),
        *_visit_money("total_revenue"),
        F.count_distinct("doctor_key").alias("active_doctors"),
    ])


def billing_recovery(bills: DataFrame, providers: DataFrame) -> DataFrame:
    providers = providers.withColumnsRenamed({"coverage_pct": "contracted_coverage_pct", "status": "provider_status"})
    attrs = ["insurance_id", "provider_name", "plan_type", "contracted_coverage_pct", "provider_status"]
    return _by_attributes(bills, providers, "insurance_key", attrs, [
        F.count("billing_key").alias("total_bills"),
        *[_status_count("payment_status", label, f"{label.lower()}_bills")
          for label in ("Paid", "Partial", "Pending", "Overdue")],
        F.sum("total_amount").alias("total_billed"),
        F.sum("insurance_covered").alias("total_insurance_covered"),
        F.sum("patient_paid").alias("total_patient_paid"),
        F.sum("outstanding_amount").alias("total_outstanding"),
        F.avg("recovery_rate").cast("decimal(5,2)").alias("avg_recovery_rate_pct"),
        percent(F.sum("insurance_covered"), F.sum("total_amount")).alias("actual_coverage_pct"),
    ])


PATIENT_ATTRS = ["patient_id", "full_name", "gender", "age", "blood_type", "country", "insurance_status",
                 "registration_date"]


def patient_analysis(patients: DataFrame, appointments: DataFrame, bills: DataFrame, dates: DataFrame) -> DataFrame:
    """Visits and bills per current patient, as the join of both facts would sum them.

    That join pairs every visit of a patient with every bill, so each fee counts once per bill
    and each bill once per visit. The pairs are never built: both facts are aggregated per
    patient first and the sums multiplied by the other side's row count.
    """
    return _patient_report(patients, appointments, bills, dates, paired=True)


def patient_analysis_exact(patients: DataFrame, appointments: DataFrame, bills: DataFrame,
                           dates: DataFrame) -> DataFrame:
    """The same report with every fee and every bill counted once."""
    return _patient_report(patients, appointments, bills, dates, paired=False)


def _patient_report(patients, appointments, bills, dates, paired: bool) -> DataFrame:
    visits = (
        appointments.join(dates.select("date_key", "full_date"), "date_key", "left")
        .groupBy("patient_key").agg(
            F.count("appointment_key").alias("_visits"),
            F.count_if(F.col("appointment_status") == "Completed").alias("_completed"),
            F.sum("consultation_fee").alias("_fees"),
            F.min("full_date").alias("_first"),
            F.max("full_date").alias("_last"),
        )
    )
    invoices = bills.groupBy("patient_key").agg(
        F.count("billing_key").alias("_bills"),
        F.sum("total_amount").alias("_billed"),
        F.sum("patient_paid").alias("_paid"),
        F.sum("outstanding_amount").alias("_outstanding"),
    )

    def times(amount: str, other: str) -> Column:
        factor = F.greatest(F.coalesce(F.col(other), F.lit(1)), F.lit(1)).cast("decimal(12,0)") if paired else F.lit(1)
        return (F.col(amount) * factor).cast("decimal(38,2)")

    return (
        patients.where("is_current").select("patient_key", *PATIENT_ATTRS)
        .join(visits, "patient_key", "left").join(invoices, "patient_key", "left")
        .groupBy(*PATIENT_ATTRS).agg(
            F.coalesce(F.sum("_visits"), F.lit(0)).alias("total_appointments"),
            F.coalesce(F.sum("_completed"), F.lit(0)).alias("completed_appointments"),
            F.sum(times("_fees", "_bills")).alias("total_consultation_fees"),
            F.coalesce(F.sum("_bills"), F.lit(0)).alias("total_bills"),
            F.sum(times("_billed", "_visits")).alias("lifetime_billed"),
            F.sum(times("_paid", "_visits")).alias("lifetime_paid"),
            F.sum(times("_outstanding", "_visits")).alias("total_outstanding"),
            F.min("_first").alias("first_visit_date"),
            F.max("_last").alias("last_visit_date"),
        )
    )


def create_views(gold) -> dict[str, DataFrame]:
    """All five reports (and the exact patient report) over a gold layer, also as temporary views."""
    views = {
        "vw_monthly_appointments": monthly_appointments(gold["fact_appointments"], gold["dim_date"]),
        "vw_doctor_performance": doctor_performance(gold["fact_appointments"], gold["dim_doctor"]),
        "vw_department_summary": department_summary(gold["fact_appointments"], gold["dim_department"]),
        "vw_billing_recovery": billing_recovery(gold["fact_billing"], gold["dim_insurance"]),
        "vw_patient_analysis": patient_analysis(gold["dim_patient"], gold["fact_appointments"],
                                                gold["fact_billing"], gold["dim_date"]),
        "vw_patient_analysis_exact": patient_analysis_exact(gold["dim_patient"], gold["fact_appointments"],
                                                            gold["fact_billing"], gold["dim_date"]),
    }
    for name, view in views.items():
        view.createOrReplaceTempView(name)
    return views
