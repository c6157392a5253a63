"""The star schema's tables in the roles of the care-provider tables.

customer is the patient, supplier the doctor, nation the department, part the treatment, region
the insurance provider, a line item of an order the appointment and the order itself the bill.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions.calendar import date_key
from stratalake.operators.calendar import calendar_between
from stratalake.operators.cleaning import keep_newest
from stratalake.plans.gold import with_recovery_rate

LOAD_1, LOAD_2 = datetime(1998, 7, 1), datetime(1999, 7, 1)
DAY_1, DAY_2 = date(1995, 1, 1), date(1998, 7, 1)


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def money(column: str, kind: str = "decimal(12,2)") -> Column:
    return F.col(column).cast(kind)


def line_items(spark: SparkSession, folder: str) -> DataFrame:
    """One row per order and line number: the newest shipment, ties settled by the other columns."""
    items = read(spark, folder, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    return keep_newest(items, [F.col(k) for k in keys], "l_shipdate", [c for c in items.columns if c not in keys])


def appointments(spark: SparkSession, folder: str) -> DataFrame:
    """Typed appointments: line items joined to their orders and their supplier's nation."""
    items = line_items(spark, folder).select(
        F.col("l_orderkey").alias("o_orderkey"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("appointment_id"),
        F.col("l_suppkey").alias("doctor_id"),
        F.col("l_partkey").alias("treatment_id"),
        F.col("l_quantity").cast("int").alias("duration_minutes"),
        F.when(F.col("l_returnflag") == "A", "Completed").when(F.col("l_returnflag") == "R", "No-Show")
        .when(F.col("l_linestatus") == "O", "Scheduled").otherwise("Cancelled").alias("appointment_status"),
        money("l_extendedprice", "decimal(10,2)").alias("consultation_fee"),
        F.col("l_linestatus").alias("appointment_time"),
    )
    orders = read(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("patient_id"), F.col("o_orderdate").cast("date").alias("appointment_date"))
    suppliers = read(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("doctor_id"), F.col("s_nationkey").alias("department_id"))
    return items.join(orders, "o_orderkey").drop("o_orderkey").join(suppliers, "doctor_id").withColumn(
        "date_key", date_key(F.col("appointment_date")))


def bills(spark: SparkSession, folder: str) -> DataFrame:
    """Typed bills, one per order. A fifth, two fifths, … of a total is covered; the status says
    how much of the rest is paid. Every eleventh bill names no provider."""
    order = F.col("o_orderkey")
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    status = F.col("o_orderstatus")
    covered = F.call_function("div", cents * (order % 5), F.lit(5))
    paid = F.when(status == "F", F.col("_rest")).when(status == "P", F.shiftright("_rest", 1)).otherwise(F.lit(0))

    def amount(units: Column) -> Column:
        return (units.cast("decimal(18,0)") * F.expr("0.01")).cast("decimal(18,2)")

    rows = read(spark, folder, "orders").select(
        order.alias("bill_id"), (order * 8 + 1).alias("appointment_id"), F.col("o_custkey").alias("patient_id"),
        (order % 10).alias("doctor_id"), (order % 200).alias("treatment_id"),
        F.when(order % 11 != 0, F.col("o_custkey") % 5).alias("insurance_id"),
        F.col("o_orderdate").cast("date").alias("bill_date"),
        F.when(status == "F", "Paid").when(status == "P", "Partial").when(order % 3 == 0, "Overdue")
        .otherwise("Pending").alias("payment_status"),
        status.alias("o_orderstatus"), cents.alias("_cents"), covered.alias("_covered"),
    )
    rows = rows.withColumn("_rest", F.col("_cents") - F.col("_covered")).withColumn("_paid", paid)
    rows = rows.withColumns({
        "total_amount": amount(F.col("_cents")),
        "insurance_covered": amount(F.col("_covered")),
        "patient_paid": amount(F.col("_paid")),
        "outstanding_amount": amount(F.col("_rest") - F.col("_paid")),
        "date_key": date_key(F.col("bill_date")),
    })
    return rows.drop("_cents", "_covered", "_rest", "_paid", "o_orderstatus")


def fact_appointments(spark: SparkSession, folder: str) -> DataFrame:
    """Appointments whose ids serve as keys."""
    return appointments(spark, folder).withColumnsRenamed({
        "appointment_id": "appointment_key", "patient_id": "patient_key", "doctor_id": "doctor_key",
        "department_id": "department_key", "treatment_id": "treatment_key"})


def fact_billing(spark: SparkSession, folder: str) -> DataFrame:
    """Bills that name a provider, with their recovery rate; ids serve as keys."""
    return with_recovery_rate(bills(spark, folder).where("insurance_id IS NOT NULL")).withColumnsRenamed({
        "bill_id": "billing_key", "patient_id": "patient_key", "doctor_id": "doctor_key",
        "treatment_id": "treatment_key", "insurance_id": "insurance_key"})


def dates(spark: SparkSession, folder: str) -> DataFrame:
    """Every day of the years the orders fall into."""
    span = read(spark, folder, "orders").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"))
    return calendar_between(span.select(
        F.trunc(F.col("first").cast("date"), "year").alias("first_day"),
        F.date_sub(F.add_months(F.trunc(F.col("last").cast("date"), "year"), 12), 1).alias("last_day")))


def departments(spark: SparkSession, folder: str) -> DataFrame:
    region = read(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return read(spark, folder, "nation").join(region, "n_regionkey").select(
        F.col("n_nationkey").alias("department_key"), F.col("n_nationkey").alias("department_id"),
        F.col("n_name").alias("department_name"), F.col("r_name").alias("building"),
        F.concat(F.lit("Floor "), (F.col("n_nationkey") % 4).cast("string")).alias("floor"),
        F.when(F.col("n_nationkey") % 6 != 0, F.concat(F.lit("Head of "), F.col("n_name"))).alias("head_doctor"))


def providers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("r_regionkey")
    return read(spark, folder, "region").select(
        key.alias("insurance_key"), key.alias("insurance_id"), F.col("r_name").alias("provider_name"),
        F.when(key % 2 == 0, "PPO").otherwise("HMO").alias("plan_type"),
        (key * 10 + 50).cast("decimal(5,2)").alias("coverage_pct"),
        F.when(key == 3, "Inactive").otherwise("Active").alias("status"))


def patients(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return read(spark, folder, "customer").select(
        key.alias("patient_key"), key.alias("patient_id"), F.col("c_name").alias("full_name"),
        F.when(key % 3 == 0, "Male").when(key % 3 == 1, "Female").otherwise("Other").alias("gender"),
        (key % 90).cast("int").alias("age"),
        F.when(key % 4 != 0, "A+").alias("blood_type"),
        F.concat(F.lit("Country "), (F.col("c_nationkey") % 5).cast("string")).alias("country"),
        F.col("c_mktsegment").alias("insurance_status"),
        F.lit(date(1990, 1, 1)).alias("registration_date"),
        F.lit(True).alias("is_current"))


# ---------------------------------------------------------------------------------------------
# Untidy text versions of the tables, as the raw layer would deliver them. Each is a FROM clause
# over a numbered table plus one SQL expression per raw column; the rows picked by ``again`` occur
# a second time with some columns changed. The expressions are plain enough for any SQL engine.

_ISO = "CAST(1940 + k % 70 AS STRING) || '-' || lpad(CAST(1 + k % 12 AS STRING), 2, '0') || '-' || " \
       "lpad(CAST(1 + k % 28 AS STRING), 2, '0')"
_DAY = "CAST(1 + k % 28 AS STRING)"
# Text that looks like a date but is none, or is one with a time of day.
_NEARLY_DATE = ("WHEN {n} % 47 = 0 THEN '2024-01-15 garbage' WHEN {n} % 53 = 0 THEN '2024-05' WHEN {n} % 59 = 0 THEN '12024-01-15' "
                "WHEN {n} % 67 = 0 THEN '2024-01-15 25:30' WHEN {n} % 79 = 0 THEN ' 2001-02-03 10:30:00 ' ")
_MIXED_DATE = (
    "CASE WHEN k % 41 = 0 THEN 'unknown' WHEN k % 43 = 0 THEN '1980-02-30' "
    + _NEARLY_DATE.format(n="k") +
    "WHEN k % 5 = 0 THEN CAST(1940 + k % 70 AS STRING) || lpad(CAST(1 + k % 12 AS STRING), 2, '0') "
    f"|| lpad({_DAY}, 2, '0') "
    f"WHEN k % 5 = 1 THEN lpad(CAST(1 + k % 12 AS STRING), 2, '0') || '/' || lpad({_DAY}, 2, '0') || '/' "
    f"|| CAST(1940 + k % 70 AS STRING) ELSE {_ISO} END"
)


def _dirty_id(prefix: str) -> str:
    return (f"CASE WHEN k % 97 = 0 THEN '{prefix}' || CAST(k AS STRING) WHEN k % 89 = 0 THEN NULL "
            "ELSE ' ' || CAST(k AS STRING) || ' ' END")


def _yearly(start: int) -> str:
    return f"CAST({start} + k % 14 AS STRING) || '-0' || CAST(1 + k % 9 AS STRING) || '-15'"


UNTIDY: dict[str, dict] = {
    "patients": {
        "from": "(SELECT *, c_custkey AS k FROM customer)",
        "columns": {
            "patient_id": _dirty_id("P"),
            "first_name": "CASE WHEN k % 53 = 0 THEN NULL WHEN k % 59 = 0 THEN '  ' "
                          "ELSE ' ' || substr(c_name, 1, instr(c_name, '#') - 1) || ' ' END",
            "last_name": "CASE WHEN k % 37 = 0 THEN NULL ELSE substr(c_name, instr(c_name, '#') + 1) || '  ' END",
            "gender": "CASE k % 6 WHEN 0 THEN 'm' WHEN 1 THEN ' F ' WHEN 2 THEN 'MALE' WHEN 3 THEN 'female' "
                      "WHEN 4 THEN 'x' ELSE NULL END",
            "birth_date": _MIXED_DATE,
            "blood_type": "CASE k % 4 WHEN 0 THEN ' A+' WHEN 1 THEN 'O- ' WHEN 2 THEN 'AB+' ELSE NULL END",
            "city": "' City ' || CAST(c_nationkey AS STRING)",
            "country": "'Country ' || CAST(c_nationkey % 5 AS STRING) || ' '",
            "phone": "'+1' || lpad(CAST(k AS STRING), 9, '0')",
            "email": "upper(' ' || c_name || '@Mail.example ')",
            "registration_date": _yearly(2010),
            "insurance_status": "CASE k % 7 WHEN 0 THEN 'yes' WHEN 1 THEN 'Y ' WHEN 2 THEN '1' WHEN 3 THEN 'active' "
                                "WHEN 4 THEN 'no' WHEN 5 THEN NULL ELSE ' Active' END",
        },
        "again": "k % 7 = 0",
        "changed": {"patient_id": "'0' || CAST(k AS STRING)", "city": "'Moved'",
                    "registration_date": "CASE WHEN k % 2 = 0 THEN '2025-01-01' ELSE NULL END"},
    },
    "doctors": {
        "from": "(SELECT *, s_suppkey AS k FROM supplier)",
        "columns": {
            "doctor_id": _dirty_id("D"),
            "first_name": "CASE WHEN k % 53 = 0 THEN NULL ELSE substr(s_name, 1, instr(s_name, '#') - 1) END",
            "last_name": "' ' || substr(s_name, instr(s_name, '#') + 1)",
            "specialization": "' Nation ' || CAST(s_nationkey AS STRING)",
            "department_id": "CASE WHEN k % 13 = 0 THEN 'none' ELSE CAST(s_nationkey AS STRING) END",
            "qualification": "CASE k % 3 WHEN 0 THEN 'MD ' WHEN 1 THEN ' PhD' ELSE NULL END",
            "hire_date": _MIXED_DATE,
            "status": "CASE k % 5 WHEN 0 THEN 'active' WHEN 1 THEN ' a' WHEN 2 THEN 'On Leave' WHEN 3 THEN 'Inactive' "
                      "ELSE NULL END",
            "phone": "'+2' || lpad(CAST(k AS STRING), 9, '0')",
        },
        "again": "k % 9 = 0",
        "changed": {"hire_date": "'2024-03-01'", "status": "'A'"},
    },
    "departments": {
        "from": "(SELECT *, s_suppkey AS k FROM supplier)",
        "columns": {
            "department_id": _dirty_id("W"),
            "department_name": "CASE WHEN k % 31 = 0 THEN NULL ELSE ' Ward of ' || s_name END",
            "building": "CASE k % 3 WHEN 0 THEN 'Main ' WHEN 1 THEN ' East' ELSE NULL END",
            "floor": "' ' || CAST(k % 4 AS STRING)",
            "head_doctor": "'Dr. ' || CAST(k AS STRING) || ' '",
            "established_date": _MIXED_DATE,
        },
        "again": "k % 8 = 0",
        "changed": {"established_date": "'2024-03-01'", "building": "'New'"},
    },
    "treatments": {
        "from": "(SELECT *, p_partkey AS k FROM part)",
        "columns": {
            "treatment_id": _dirty_id("T"),
            "treatment_name": "CASE WHEN k % 53 = 0 THEN NULL ELSE ' ' || p_name END",
            "treatment_type": "p_type || ' '",
            "diagnosis_code": "' icd-' || CAST(p_size AS STRING) || ' '",
            "diagnosis_name": "CASE WHEN k % 6 = 0 THEN NULL ELSE p_brand END",
            "standard_cost": "CASE WHEN k % 19 = 0 THEN 'n/a' WHEN k % 23 = 0 THEN '123456789.00' "
                             "WHEN k % 29 = 0 THEN '1e3' WHEN k % 11 = 0 THEN '1.235' "
                             "ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) END",
            "duration_minutes": "CASE WHEN k % 17 = 0 THEN 'long' ELSE ' ' || CAST(15 + k % 90 AS STRING) END",
        },
        "again": "k % 10 = 0",
        "changed": {"treatment_name": "'Again ' || p_name", "standard_cost": "'77.70'"},
    },
    "insurance_providers": {
        "from": "(SELECT *, c_custkey AS k FROM customer)",
        "columns": {
            "insurance_id": _dirty_id("I"),
            "provider_name": "CASE WHEN k % 53 = 0 THEN NULL ELSE c_name || ' ' END",
            "plan_type": "' ' || c_mktsegment",
            "coverage_pct": "CASE WHEN k % 15 = 0 THEN '1000' WHEN k % 16 = 0 THEN NULL "
                            "ELSE CAST(k % 101 AS STRING) || '.125' END",
            "max_coverage_amount": "CASE WHEN k % 21 = 0 THEN 'unlimited' "
                                   "ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS STRING) END",
            "status": "CASE k % 4 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'a ' WHEN 2 THEN 'Discontinued' ELSE NULL END",
        },
        "again": "k % 12 = 0",
        "changed": {"provider_name": "'Again ' || c_name"},
    },
    "appointments": {
        "from": "(SELECT *, l_orderkey * 8 + l_linenumber AS k FROM lineitem JOIN orders ON l_orderkey = o_orderkey)",
        "columns": {
            "appointment_id": _dirty_id("A"),
            "patient_id": "CASE WHEN l_partkey % 71 = 0 THEN 'x' ELSE CAST(o_custkey AS STRING) END",
            "doctor_id": "' ' || CAST(l_suppkey AS STRING)",
            "department_id": "CAST(l_suppkey % 10 AS STRING)",
            "treatment_id": "CAST(l_partkey AS STRING)",
            "appointment_date": "CASE WHEN l_partkey % 61 = 0 THEN '2024-02-30' " + _NEARLY_DATE.format(n="l_partkey") +
                                "ELSE CAST(CAST(l_shipdate AS DATE) AS STRING) END",
            "appointment_time": "' 0' || CAST(l_linenumber AS STRING) || ':30 '",
            "duration_minutes": "CASE WHEN l_partkey % 17 = 0 THEN 'short' "
                                "ELSE CAST(CAST(l_quantity AS INT) AS STRING) END",
            "status": "CASE l_partkey % 9 WHEN 0 THEN 'complete' WHEN 1 THEN ' Completed' WHEN 2 THEN 'SCHEDULED ' "
                      "WHEN 3 THEN 'canceled' WHEN 4 THEN 'Cancelled' WHEN 5 THEN 'noshow' WHEN 6 THEN 'no-show' "
                      "WHEN 7 THEN ' Late ' ELSE NULL END",
            "consultation_fee": "CASE WHEN l_partkey % 37 = 0 THEN 'free' "
                                "ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END",
            "notes": "CASE WHEN l_partkey % 3 = 0 THEN ' ' || l_returnflag || l_linestatus ELSE NULL END",
        },
        "again": None,  # the line items themselves repeat
    },
    "bills": {
        "from": "(SELECT *, o_orderkey AS k FROM orders)",
        "columns": {
            "bill_id": _dirty_id("B"),
            "appointment_id": "CAST(k * 8 + 1 AS STRING)",
            "patient_id": "CAST(o_custkey AS STRING)",
            "doctor_id": "CAST(k % 10 AS STRING)",
            "insurance_id": "CASE WHEN k % 11 = 0 THEN NULL ELSE CAST(o_custkey % 5 AS STRING) END",
            "treatment_id": "CAST(k % 200 AS STRING)",
            "bill_date": "CASE WHEN k % 73 = 0 THEN 'soon' " + _NEARLY_DATE.format(n="k") + "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END",
            "total_amount": "CASE WHEN k % 59 = 0 THEN '0' WHEN k % 61 = 0 THEN '-5' WHEN k % 67 = 0 THEN 'n/a' "
                            "WHEN k % 71 = 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END",
            "insurance_covered": "CASE WHEN k % 3 = 0 THEN NULL ELSE ' ' || CAST(k % 1000 AS STRING) || '.5 ' END",
            "patient_paid": "CASE WHEN k % 4 = 0 THEN 'x' ELSE CAST(k % 500 AS STRING) END",
            "outstanding_amount": "CAST(k % 250 AS STRING) || '.25'",
            "payment_status": "CASE k % 6 WHEN 0 THEN 'paid' WHEN 1 THEN ' Partial' WHEN 2 THEN 'PENDING ' "
                              "WHEN 3 THEN 'overdue' WHEN 4 THEN ' Waived ' ELSE NULL END",
        },
        "again": "k % 13 = 0",
        "changed": {"bill_date": "'2001-12-31'", "payment_status": "'paid'"},
    },
}


def _replaced(base: Mapping[str, str], changed: Mapping[str, str]) -> list[str]:
    return [f"{changed.get(name, text)} AS {name}" for name, text in base.items()]


# Two loads of a whole run: rows that only the second delivers, rows that it no longer delivers, and what it changes.
LOADS = {1: "k % 8 <> 3", 2: "k % 8 <> 5"}
_SECOND = {
    "patients": {"city": "CASE WHEN k % 10 = 0 THEN 'Second' ELSE {} END",
                 "first_name": "CASE WHEN k % 6 = 0 THEN 'Renamed' ELSE {} END"},  # not tracked
    "doctors": {"status": "CASE WHEN k % 4 = 0 THEN 'active' ELSE {} END"},
    "appointments": {"status": "CASE WHEN l_partkey % 4 = 0 THEN 'complete' ELSE {} END",
                     "consultation_fee": "CASE WHEN l_partkey % 11 = 0 THEN '77.70' ELSE {} END"},
    "bills": {"patient_paid": "CASE WHEN k % 6 = 0 THEN '1.25' ELSE {} END"},
}


def untidy_sql(table: str, load: int | None = None) -> str:
    """The raw table as one SELECT over the star schema; with ``load``, as the first or second of two loads delivers it."""
    spec = UNTIDY[table]
    columns, kept = dict(spec["columns"]), "true"
    if load and table in _SECOND:
        kept = LOADS[load]
        # a missing last name would break a constraint and stop the run
        columns |= {"last_name": f"coalesce({columns['last_name']}, 'Unknown')"} if "last_name" in columns else {}
        if load == 2:
            columns |= {c: sql.format(columns[c]) for c, sql in _SECOND[table].items()}
    sql = f"SELECT {', '.join(_replaced(columns, {}))} FROM {spec['from']} AS t WHERE {kept}"
    if spec["again"]:
        sql += (f" UNION ALL SELECT {', '.join(_replaced(columns, spec['changed']))} "
                f"FROM {spec['from']} AS t WHERE {spec['again']} AND {kept}")
    return sql


def untidy(spark: SparkSession, folder: str, table: str, load: int | None = None) -> DataFrame:
    """The raw table as a DataFrame."""
    spec = UNTIDY[table]
    names = [n for n in ("customer", "supplier", "part", "orders", "lineitem") if n in spec["from"]]
    text = untidy_sql(table, load)
    for name in names:  # pass the tables as arguments instead of registering views
        text = text.replace(f"FROM {name}", f"FROM {{{name}}}").replace(f"JOIN {name} ", f"JOIN {{{name}}} ")
    return spark.sql(text, **{name: read(spark, folder, name) for name in names})
