from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from stratalake.operators import checks
from stratalake.operators.calendar import dim_date
from stratalake.operators.facts import Lookup
from stratalake.plans import quality, reports

VISITS = "appointment_key long, date_key int, patient_key long, doctor_key long, department_key long, " \
         "appointment_status string, duration_minutes int, consultation_fee decimal(10,2)"
BILLS = "billing_key long, date_key int, patient_key long, insurance_key long, payment_status string, " \
        "total_amount decimal(18,2), insurance_covered decimal(18,2), patient_paid decimal(18,2), " \
        "outstanding_amount decimal(18,2), recovery_rate decimal(10,2)"
PATIENTS = "patient_key long, patient_id int, full_name string, gender string, age int, blood_type string, country string, " \
           "insurance_status string, registration_date date, is_current boolean"


def visits(spark, *rows):
    return spark.createDataFrame([(*r[:-1], Decimal(r[-1]) if r[-1] is not None else None) for r in rows], VISITS)


def bill(key, patient, total, paid=0, left=0, provider=1, status="Paid", covered=0, rate="0"):
    return (key, 20240101, patient, provider, status, Decimal(total), Decimal(covered), Decimal(paid), Decimal(left), Decimal(rate))


def person(key, pid, name="n", current=True):
    return (key, pid, name, None, 30, "A+", "Italy", "Active", date(2020, 1, 1), current)


def days(spark):
    return dim_date(spark, date(2024, 1, 1), date(2024, 3, 31))


def test_patient_with_two_visits_and_three_bills(spark):
    fact = visits(spark, (1, 20240101, 1, 1, 1, "Completed", 10, "100"), (2, 20240203, 1, 1, 1, "No-Show", 10, "50"),
                  (3, 20240105, 9, 1, 1, "Completed", 10, "7"))
    money = spark.createDataFrame([bill(i, 1, 8, 5, 3) for i in range(3)], BILLS)
    people = spark.createDataFrame([person(1, 1), person(2, 2, "idle"), person(9, 3, "old", False)], PATIENTS)
    faithful = reports.patient_analysis(people, fact, money, days(spark)).orderBy("patient_id").collect()
    assert [r["patient_id"] for r in faithful] == [1, 2]  # only current versions
    assert tuple(faithful[0])[8:] == (2, 1, Decimal("450.00"), 3, Decimal("48.00"), Decimal("30.00"), Decimal("18.00"),
                                      date(2024, 1, 1), date(2024, 2, 3))
    assert tuple(faithful[1])[8:] == (0, 0, None, 0, None, None, None, None, None)
    exact = reports.patient_analysis_exact(people, fact, money, days(spark)).orderBy("patient_id").first()
    assert tuple(exact)[8:13] == (2, 1, Decimal("150.00"), 3, Decimal("24.00"))


def test_patient_factor_equals_the_literal_join(spark):
    fact = visits(spark, *[(i, 20240101 + i % 28, i * i % 7, 1, 1, "Completed" if i % 3 else "No-Show", 10,
                            None if i % 5 == 0 else str(i)) for i in range(60)])
    money = spark.createDataFrame([bill(i, i % 9, i + 1, i, 1) for i in range(25)], BILLS)
    people = spark.createDataFrame([person(k, k % 4, "same") for k in range(11)], PATIENTS)  # several keys per id
    joined = (
        people.join(fact, "patient_key", "left").join(money.drop("date_key"), "patient_key", "left")
        .join(days(spark).select("date_key", "full_date"), "date_key", "left").groupBy(*reports.PATIENT_ATTRS).agg(
            F.count_distinct("appointment_key"), F.count_distinct(F.when(F.col("appointment_status") == "Completed", F.col("appointment_key"))),
            F.sum("consultation_fee"), F.count_distinct("billing_key"), F.sum("total_amount"), F.sum("patient_paid"),
            F.sum("outstanding_amount"), F.min("full_date"), F.max("full_date")))
    ours = reports.patient_analysis(people, fact, money, days(spark))
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, joined.collect()))


def test_monthly_and_department(spark):
    fact = visits(spark, (1, 20240101, 1, 1, 1, "Completed", 10, "100"), (2, 20240102, 1, 2, 1, "Cancelled", 15, None),
                  (3, 20240131, 2, 1, 1, "Scheduled", None, "50.01"), (4, 20240201, 1, 1, 2, "Late", 3, "1"))
    jan, feb = reports.monthly_appointments(fact, days(spark)).orderBy("month").collect()
    assert tuple(jan) == (2024, "Q1", 1, "January", 3, 1, 1, 0, 1, Decimal("33.33"), Decimal("33.33"), Decimal("150.01"),
                          Decimal("75.01"), Decimal("12.00"), 2)
    assert tuple(feb)[4:10] == (1, 0, 0, 0, 0, Decimal("0.00"))
    wards = spark.createDataFrame([(1, 1, "w", None, "1", None), (2, 1, "w", None, "1", None)],
                                  "department_key long, department_id int, department_name string, building string, floor string, head_doctor string")
    row = reports.department_summary(fact, wards).collect()
    assert len(row) == 1 and tuple(row[0])[5:9] == (4, 1, 1, 0) and tuple(row[0])[-2:] == (2, 2)


def test_doctor_report_counts_current_versions_only(spark):
    fact = visits(spark, (1, 20240101, 1, 1, 1, "Completed", 10, "100"), (2, 20240102, 1, 2, 1, "Completed", 15, "60"))
    doctors = spark.createDataFrame([(1, 5, "Dr", "Heart", None, "Active", False), (2, 5, "Dr", "Lung", None, "Active", True)],
                                    "doctor_key long, doctor_id int, full_name string, specialization string, qualification string, status string, is_current boolean")
    row = reports.doctor_performance(fact, doctors).collect()
    assert [tuple(r)[:6] for r in row] == [(5, "Dr", "Lung", None, "Active", 1)] and row[0]["total_revenue"] == Decimal("60.00")


def test_billing_report(spark):
    money = spark.createDataFrame([bill(1, 1, 100, 50, 20, status="Paid", covered=30, rate="80"),
                                   bill(2, 1, 50, 0, 50, status="Overdue", covered=0, rate="0.01")], BILLS)
    firms = spark.createDataFrame([(1, 1, "p", "PPO", Decimal("80"), "Active")],
                                  "insurance_key long, insurance_id int, provider_name string, plan_type string, coverage_pct decimal(5,2), status string")
    row = reports.billing_recovery(money, firms).first()
    assert tuple(row) == (1, "p", "PPO", Decimal("80.00"), "Active", 2, 1, 0, 0, 1, Decimal("150.00"), Decimal("30.00"),
                          Decimal("50.00"), Decimal("70.00"), Decimal("40.01"), Decimal("20.00"))


def test_one_group_holding_most_rows(spark):
    """A third and more of all visits belong to one patient, one doctor and one month."""
    fact = spark.range(60_000).select(
        F.col("id").alias("appointment_key"), F.lit(20240101).alias("date_key"),
        F.when(F.col("id") < 40_000, 1).otherwise(F.col("id")).alias("patient_key"), F.lit(1).alias("doctor_key"),
        F.lit(1).alias("department_key"), F.lit("Completed").alias("appointment_status"), F.lit(10).alias("duration_minutes"),
        F.lit(1).cast("decimal(10,2)").alias("consultation_fee"))
    row = reports.monthly_appointments(fact, days(spark)).first()
    assert (row["total_appointments"], row["unique_patients"]) == (60_000, 20_001)


def test_quality_counters(spark):
    fact = visits(spark, (1, 20240101, None, 1, 1, "x", 0, "-1"), (2, None, None, 1, 1, "x", 5, "1"))
    assert quality.null_keys(fact, ["date_key", "patient_key"]).first()[0:2] == (1, 2)
    assert tuple(quality.invalid_visits(fact).first()) == (1, 1)
    assert tuple(quality.invalid_visits(fact.where("false")).first()) == (None, None)  # NULL, not 0, without rows
    people = spark.createDataFrame([person(1, 7), person(2, 7), person(3, 8), person(4, 8, current=False)], PATIENTS)
    assert [tuple(r) for r in quality.several_current(people, "patient_id").collect()] == [(7, 2)]
    assert tuple(quality.date_range(fact, days(spark), "a", "z").first()) == (date(2024, 1, 1), date(2024, 1, 1))
    assert sorted(map(tuple, quality.row_counts({"a": fact, "b": fact.where("false")}).collect())) == [("a", 2), ("b", 0)]


def test_constraints(spark):
    fact = visits(spark, (1, 20240101, None, 1, 1, "long status", 0, "-1"), (1, 20240102, 3, 4, 1, "x", None, None))
    found = checks.count_violations(fact, {
        **checks.null_counters(["patient_key"]), **checks.length_counters({"appointment_status": 5}),
        **checks.failure_counters({"fee": F.col("consultation_fee") >= 0, "time": F.col("duration_minutes") > 0})})
    assert {r["check_name"]: r["violations"] for r in found.collect()} == {
        "null_patient_key": 1, "long_appointment_status": 1, "fee": 1, "time": 1}
    assert [tuple(r) for r in checks.duplicates(fact, "appointment_key").collect()] == [(1, 2)]
    doctors = spark.createDataFrame([(1,)], "doctor_key long")
    people = spark.createDataFrame([(9,)], "patient_key long")
    lost = checks.orphans(fact, [Lookup(doctors, "doctor_key", "doctor_key", "doctor_key"),
                                 Lookup(people, "patient_key", "patient_key", "patient_key")])
    assert {r["check_name"]: r["violations"] for r in lost.collect()} == {"doctor_key": 1, "patient_key": 1}
