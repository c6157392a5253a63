from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from stratalake import schemas as S
from stratalake.functions import calendar as C
from stratalake.functions import casts, measures, text


def values(spark, inputs, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("c"))).collect()]


def test_to_int(spark):
    got = values(spark, ["7", " 7 ", "007", "-3", "12.5", "x", "", "99999999999", None], casts.to_int)
    assert got == [7, 7, 7, -3, None, None, None, None, None]
    assert values(spark, ["99999999999"], lambda c: casts.to_int(c, "bigint")) == [99999999999]


def test_to_date(spark):
    got = values(spark, ["2024-01-15", "20240115", "01/15/2024", " 2024-01-15 ", "1/15/2024", "2024/01/15", "2024-02-30", "19800230", "soon", "", None],
                 casts.to_date)
    assert got == [date(2024, 1, 15)] * 6 + [None] * 5
    bad = ["2024-01-15 garbage", "2024-01-15Tfoo", "2024-05", "12024-01-01", "2024-01-15 25:99", "0000-01-01", "20240115x"]
    assert values(spark, bad, casts.to_date) == [None] * len(bad)
    assert values(spark, ["2024-01-15 10:30", "2024-01-15T10:30:59.5"], casts.to_date) == [date(2024, 1, 15)] * 2
    assert values(spark, ["15.01.2024"], lambda c: casts.to_date(c, ("dd.MM.yyyy",))) == [date(2024, 1, 15)]


def test_to_decimal(spark):
    got = values(spark, ["1.235", " 2 ", "-0.005", "n/a", "1e3", "1E3", "123456789.00", None], lambda c: casts.to_decimal(c, 10, 2))
    assert got == [Decimal("1.24"), Decimal("2.00"), Decimal("-0.01"), None, None, None, None, None]
    assert values(spark, ["1000"], lambda c: casts.to_decimal(c, 5, 2)) == [None]


@pytest.mark.parametrize("labels, default, inputs, expected", [
    (S.GENDER, "Other", ["m", " FEMALE ", "Male", "F", "x", None], ["Male", "Female", "Male", "Female", "Other", "Other"]),
    (S.INSURED, "Inactive", ["y", "YES", "1", " active", "no", None], ["Active"] * 4 + ["Inactive"] * 2),
    (S.ACTIVE, "Inactive", ["a", "Active ", "On Leave", "Discontinued", None], ["Active"] * 2 + ["Inactive"] * 3),
    (S.VISIT_STATUS, None, ["complete", "Completed", "scheduled", "canceled", "CANCELLED", "noshow", "No-Show", " Late ", None],
     ["Completed", "Completed", "Scheduled", "Cancelled", "Cancelled", "No-Show", "No-Show", "Late", None]),
    (S.PAYMENT_STATUS, None, ["PAID", "partial ", "pending", "OverDue", " Waived", None],
     ["Paid", "Partial", "Pending", "Overdue", "Waived", None]),
])
def test_code_maps(spark, labels, default, inputs, expected):
    assert values(spark, inputs, lambda c: text.code_map(c, labels, default)) == expected


def test_joined_name_is_null_when_a_part_is(spark):
    assert values(spark, [" Ann ", None], lambda c: text.joined_name(c, F.lit(" Lee"))) == ["Ann Lee", None]


def test_calendar(spark):
    # date, date key, weekday, week of year, weekend
    known = [(date(2023, 1, 1), 20230101, 1, 1, True), (date(2023, 1, 7), 20230107, 7, 1, True),
             (date(2023, 1, 8), 20230108, 1, 2, True), (date(2024, 12, 31), 20241231, 3, 53, False),
             (date(2000, 12, 31), 20001231, 1, 54, True)]
    df = spark.createDataFrame([(k[0],) for k in known], "c date")
    c = F.col("c")
    got = df.select("c", C.date_key(c), F.dayofweek(c), C.week_number(c), C.is_weekend(c)).orderBy("c").collect()
    assert [tuple(r) for r in got] == sorted(known)
    row = df.where("c = '2023-01-08'").select(*[v.alias(n) for n, v in C.attributes(c).items()]).first()
    assert (row["quarter_name"], row["month_name"], row["day_name"]) == ("Q1", "January", "Sunday")
    assert list(row.asDict()) == S.columns("dim_date")


def test_age_counts_year_boundaries(spark):
    assert values(spark, [date(2000, 12, 31), None], lambda c: C.years_between(c, F.lit(date(2024, 1, 1))), "date") == [24, None]


def test_percent_and_average(spark):
    df = spark.createDataFrame([(1, 3), (2, 4), (None, 4)], "c int, d int")
    c = F.col("c")
    row = df.agg(measures.percent(F.count("c"), F.count("d")), measures.whole_average(F.col("d")),
                 measures.whole_average(c)).first()
    assert tuple(row) == (Decimal("66.67"), Decimal("3.00"), Decimal("1.00"))
    none = df.where("d > 9").agg(measures.percent(F.count("c"), F.count("d")), measures.whole_average(c)).first()
    assert tuple(none) == (None, None)
    assert values(spark, [-3, -4], measures.whole_average, "int") == [Decimal("-3.00")]  # cut, not floored


def test_recovery_rate(spark):
    df = spark.createDataFrame([(Decimal("40"), Decimal("20"), Decimal("90")), (Decimal("1"), Decimal("0"), Decimal("0"))],
                               "p decimal(18,2), v decimal(18,2), t decimal(18,2)")
    got = df.select(measures.recovery_rate(F.col("p"), F.col("v"), F.col("t"))).collect()
    assert [r[0] for r in got] == [Decimal("66.67"), Decimal("0.00")]


def test_differs(spark):
    df = spark.createDataFrame([(0, None, ""), (1, "a", "b"), (2, None, "a"), (3, None, None), (4, "A ", "a")],
                               "i int, a string, b string").orderBy("i")
    assert [r[0] for r in df.select(measures.differs(F.col("a"), F.col("b"), "")).collect()] == [False, True, True, False, True]
    assert [r[0] for r in df.select(measures.differs(F.col("a"), F.col("b"), "", True)).collect()] == [
        False, True, True, False, False]


def test_declared_schemas(spark):
    assert S.columns("fact_billing")[-2:] == ["recovery_rate", "dwh_load_date"]
    assert S.required("patients") == ["patient_id", "first_name", "last_name"]
    assert S.lengths("departments")["floor"] == 20
    empty = S.empty(spark, "dim_doctor", "bigint")
    assert empty.schema["department_id"].dataType.simpleString() == "bigint" and empty.count() == 0
