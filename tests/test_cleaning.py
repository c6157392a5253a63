import json
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from stratalake import schemas as S
from stratalake.operators.cleaning import keep_newest
from stratalake.plans import silver
from stratalake.sources.delimited import load_bronze, read_delimited

AS_OF, TS = date(2024, 1, 1), datetime(2024, 1, 1)


def cleaned(spark, table, *rows):
    raw = spark.createDataFrame([[r.get(c) for c in S.RAW[table]] for r in rows], ", ".join(f"{c} string" for c in S.RAW[table]))
    accepted, rejected = silver.clean_table(table, raw, AS_OF, TS)
    return ([r.asDict() for r in accepted.orderBy(accepted.columns[0]).collect()],
            [(r["rejection_reason"], json.loads(r["raw_row_json"])) for r in rejected.orderBy("raw_row_json").collect()])


def test_patients(spark):
    good, bad = cleaned(
        spark, "patients",
        {"patient_id": "abc", "first_name": "A"}, {"patient_id": "x"}, {"patient_id": "8"},
        {"patient_id": "1", "first_name": " Ann ", "last_name": "Lee ", "gender": "m", "email": " ANN@X.org ",
         "birth_date": "2000-12-31", "registration_date": "2020-01-01", "insurance_status": "y"},
        {"patient_id": "01", "first_name": "Anna", "last_name": "Lee", "registration_date": "2022-01-01"},
        {"patient_id": "2", "first_name": " "},
        {"patient_id": "3", "first_name": "C", "last_name": "D", "gender": " FEMALE ", "birth_date": "2000-12-31"})
    assert bad == [("missing first_name", {"patient_id": "8"}), ("invalid patient_id", {"patient_id": "abc", "first_name": "A"}),
                   ("invalid patient_id; missing first_name", {"patient_id": "x"})]
    first, blank, third = good
    assert (first["patient_id"], first["full_name"], first["registration_date"]) == (1, "Anna Lee", date(2022, 1, 1))
    assert (blank["first_name"], blank["full_name"], blank["gender"], blank["insurance_status"]) == ("", None, "Other", "Inactive")
    assert (third["gender"], third["age"], third["dwh_load_date"]) == ("Female", 24, TS)


def test_appointments_and_bills(spark):
    good, bad = cleaned(
        spark, "appointments",
        {"appointment_id": "1", "patient_id": "1", "appointment_date": "2024-02-30"},
        {"appointment_id": "2", "patient_id": "1", "appointment_date": "20240115", "status": "canceled", "duration_minutes": "x",
         "consultation_fee": "1.235"})
    assert [b[0] for b in bad] == ["invalid appointment_date"]
    assert (good[0]["appointment_date"], good[0]["status"], good[0]["duration_minutes"], good[0]["consultation_fee"]) == (
        date(2024, 1, 15), "Cancelled", None, Decimal("1.24"))
    good, bad = cleaned(
        spark, "bills",
        *[{"bill_id": str(i), "bill_date": "2024-01-01", "total_amount": t} for i, t in enumerate(["0", "-5", "x", None, "0.004"])],
        {"bill_id": "b", "bill_date": "never", "total_amount": "0"},
        {"bill_id": "9", "bill_date": "2024-01-01", "total_amount": "10", "patient_paid": "x", "payment_status": "Waived "})
    assert sorted(b[0] for b in bad) == ["invalid bill_id; invalid or non-positive total_amount; invalid bill_date"] + [
        "invalid or non-positive total_amount"] * 5
    assert [g["bill_id"] for g in good] == [9]
    assert (good[0]["insurance_covered"], good[0]["patient_paid"], good[0]["payment_status"]) == (Decimal("0"), Decimal("0"), "Waived")


def test_other_tables(spark):
    good, bad = cleaned(spark, "treatments", {"treatment_id": "1", "treatment_name": "a", "diagnosis_code": " icd-1 ",
                                              "standard_cost": "n/a"}, {"treatment_id": "2"})
    assert (good[0]["diagnosis_code"], good[0]["standard_cost"]) == ("ICD-1", None) and bad[0][0] == "missing treatment_name"
    good, _ = cleaned(spark, "insurance_providers", {"insurance_id": "1", "provider_name": "p", "coverage_pct": "1000",
                                                     "status": "Discontinued"})
    assert (good[0]["coverage_pct"], good[0]["status"]) == (None, "Inactive")
    good, bad = cleaned(spark, "doctors", {"doctor_id": "1", "first_name": "a", "status": "On Leave"},
                        {"doctor_id": "2", "first_name": "b", "status": "a", "department_id": "x"})
    assert [(g["status"], g["department_id"]) for g in good] == [("Inactive", None), ("Active", None)] and not bad
    assert cleaned(spark, "departments", {"department_id": "1"})[1][0][0] == "missing department_name"


def test_newest_row_with_one_id_holding_most_rows(spark):
    rows = spark.range(30_000).select(
        F.when(F.col("id") < 20_000, 1).otherwise(F.col("id")).alias("key"),
        F.when(F.col("id") % 5 != 0, F.lpad((F.col("id") % 1000).cast("string"), 4, "0")).alias("at"), "id")
    kept = keep_newest(rows, [F.col("key")], "at", rows.columns)
    assert kept.count() == 10_001
    assert kept.where("key = 1").collect()[0]["id"] == 999  # newest text wins, NULL loses, ties go to the smallest row
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # once in the map tasks, once after the shuffle


def test_delimited_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y,z\n1,"a,b",c\r\n2,b\n3,c,d,e\n4,,\n')
    rows = read_delimited(spark, str(tmp_path / "a.csv"), ["p", "q", "r"])
    assert sorted(tuple(r) for r in rows.na.fill("-").collect()) == [
        ("1", "a,b", "c", "-"), ("2", "b", "-", "2,b"), ("3", "c", "d", "3,c,d,e"), ("4", "-", "-", "-")]
    assert len(rows.where("malformed_line IS NOT NULL").select("p").collect()) == 2


def test_quotes_and_backslashes(spark, tmp_path):
    (tmp_path / "q.csv").write_text('p,q\n"He said ""hi"", ok",x\n"C:\\dir\\",y\n"",z\n')
    rows = read_delimited(spark, str(tmp_path / "q.csv"), ["p", "q"]).collect()
    assert [tuple(r) for r in rows] == [('He said "hi", ok', "x", None), ("C:\\dir\\", "y", None), (None, "z", None)]


def test_malformed_lines_are_rejected_and_audit_columns_added(spark, tmp_path):
    (tmp_path / "departments.csv").write_text("any,header,will,do,here,x\n1,Heart,East,2nd,Dr. B,1991-01-01\n2,Short\n")
    bronze = load_bronze(spark, str(tmp_path), TS, {"departments": S.RAW["departments"]})["departments"]
    assert {tuple(r) for r in bronze.select("dwh_source", "dwh_load_date").collect()} == {("departments.csv", TS)}
    assert bronze.dtypes == [(f.name, f.dataType.simpleString()) for f in S.bronze_schema("departments")]
    accepted, rejected = silver.clean_table("departments", bronze, AS_OF, TS)
    assert [r["department_id"] for r in accepted.collect()] == [1]
    log = silver.reject_log({"departments": rejected})
    row = log.collect()[0]
    assert row["rejection_reason"] == "malformed row" and json.loads(row["raw_row_json"])["malformed_line"] == "2,Short"
    assert [tuple(r) for r in silver.reject_counts(log).collect()] == [("bronze.departments", "malformed row", 1)]


def test_reject_counts_come_in_order(spark):
    log = spark.createDataFrame([(t, r) for t, r, n in (("b", "x", 2), ("b", "y", 5), ("a", "z", 1), ("b", "w", 2), ("a", "x", 7)) for _ in range(n)],
                                "source_table string, rejection_reason string").repartition(4)
    assert [tuple(r) for r in silver.reject_counts(log).collect()] == [("a", "x", 7), ("a", "z", 1), ("b", "y", 5), ("b", "w", 2), ("b", "x", 2)]


def test_a_date_is_parsed_once_per_row(spark):
    """The plan names the parser of each format once, whatever uses the day."""
    raw = spark.createDataFrame([], ", ".join(f"{c} string" for c in S.RAW["bills"])).repartition(1)
    accepted, rejected = silver.clean_table("bills", raw, AS_OF, TS)
    for df in (accepted, rejected):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("gettimestamp") == 3 and plan.count("as date)") <= 6
