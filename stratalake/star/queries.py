"""Registered queries: every operator over the whole star schema."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import schemas as S
from stratalake.functions.calendar import date_key
from stratalake.operators import checks
from stratalake.operators.dimensions import history_of_changes, scd1_merge, scd2_merge
from stratalake.operators.facts import Lookup, fact_upsert, lookup_misses
from stratalake.operators.keys import assign_keys
from stratalake.plans import gold, marts, quality, reports, run, silver
from stratalake.session import shared_dir, shuffles_removed, stage
from stratalake.sources.delimited import load_bronze
from stratalake.star import tables as star
from stratalake.star.tables import DAY_1, DAY_2, LOAD_1, LOAD_2

AS_OF = date(2024, 6, 30)
FACT_SPLIT = "date_key < 19990101"
FIRST_DATE = "date_key >= 19960101"
# What joins with the second load, and what the second load no longer delivers.
NEW_NATION, OLD_NATION = 9, 8
NEW_BRAND, OLD_BRAND = "'Brand#9'", "'Brand#8'"
SOURCE_ROWS = 1 << 18  # of a delimited file, which one task reads because it is compressed


def portable(df: DataFrame) -> DataFrame:
    """Results in types every client prints alike: exact decimals become doubles only here,
    dates and timestamps ISO text, flags 0/1."""
    def plain(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.TimestampType):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.BooleanType):
            c = c.cast("int")
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema.fields])


# Reports ---------------------------------------------------------------------------------------

def monthly_appointments(spark: SparkSession, folder: str) -> DataFrame:
    return reports.monthly_appointments(star.fact_appointments(spark, folder), star.dates(spark, folder))


def doctor_performance(spark: SparkSession, folder: str) -> DataFrame:
    """Visits before the second load carry the doctor version of the first load."""
    first, second = _doctor_loads(spark, folder)
    second = stage(second)
    versions = first.where("is_current").withColumn("load", F.lit(1)).unionByName(
        second.where("is_current").withColumn("load", F.lit(2))).select("doctor_id", "load", "doctor_key")
    visits = star.appointments(spark, folder).withColumn(
        "load", F.when(F.col("appointment_date") < F.lit(DAY_2), 1).otherwise(2))
    fact = visits.join(versions, ["doctor_id", "load"]).withColumnsRenamed(
        {"appointment_id": "appointment_key", "patient_id": "patient_key"})
    return reports.doctor_performance(fact.drop("doctor_id"), second)


def department_summary(spark: SparkSession, folder: str) -> DataFrame:
    return reports.department_summary(star.fact_appointments(spark, folder), star.departments(spark, folder))


def billing_recovery(spark: SparkSession, folder: str) -> DataFrame:
    return reports.billing_recovery(star.fact_billing(spark, folder), star.providers(spark, folder))


def _marts(report: Callable, spark: SparkSession, folder: str, dim: DataFrame) -> DataFrame:
    """A report from the daily tables alone."""
    visits = star.fact_appointments(spark, folder)
    return report(stage(marts.visit_totals(visits)), stage(marts.visit_keys(visits)), dim)


def monthly_appointments_marts(spark: SparkSession, folder: str) -> DataFrame:
    return _marts(marts.monthly_appointments, spark, folder, star.dates(spark, folder))


def department_summary_marts(spark: SparkSession, folder: str) -> DataFrame:
    return _marts(marts.department_summary, spark, folder, star.departments(spark, folder))


def _patients(report: Callable, spark: SparkSession, folder: str) -> DataFrame:
    return report(star.patients(spark, folder), star.fact_appointments(spark, folder),
                  star.fact_billing(spark, folder), star.dates(spark, folder))


def patient_analysis(spark: SparkSession, folder: str) -> DataFrame:
    return _patients(reports.patient_analysis, spark, folder)


def patient_analysis_exact(spark: SparkSession, folder: str) -> DataFrame:
    return _patients(reports.patient_analysis_exact, spark, folder)


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    """The calendar of the orders' years with the number of bills on each day."""
    per_day = star.bills(spark, folder).groupBy("date_key").agg(F.count(F.lit(1)).alias("n_bills"))
    return star.dates(spark, folder).join(per_day, "date_key", "left").na.fill(0, ["n_bills"])


# Cleaning --------------------------------------------------------------------------------------

def _cleaned(table: str, spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return silver.clean_table(table, star.untidy(spark, folder, table), AS_OF, LOAD_1, "bigint")


def _clean_query(table: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: _cleaned(table, spark, folder)[0].drop("dwh_load_date")


def _rejects(spark: SparkSession, folder: str) -> DataFrame:
    rejected = [_cleaned(table, spark, folder)[1] for table in S.BRONZE_TABLES]
    return reduce(DataFrame.unionByName, rejected)


def reject_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _rejects(spark, folder).drop("rejected_at")


def reject_counts(spark: SparkSession, folder: str) -> DataFrame:
    return silver.reject_counts(_rejects(spark, folder))


def silver_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.row_counts({f"silver.{t}": _cleaned(t, spark, folder)[0] for t in S.BRONZE_TABLES})


def dedup_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return star.line_items(spark, folder)


def _bronze_query(table: str) -> Callable[[SparkSession, str], DataFrame]:
    """A raw table written as a delimited file and loaded back with audit columns."""
    def load(spark: SparkSession, folder: str) -> DataFrame:
        source = _write_sources(spark, {table: star.untidy(spark, folder, table)})
        return load_bronze(spark, source, LOAD_1, {table: S.RAW[table]})[table]
    return load


def _write_sources(spark: SparkSession, tables: Mapping[str, DataFrame]) -> str:
    source = f"{shared_dir(spark)}/sources-{uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.write.options(header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, compression="lz4",
                           maxRecordsPerFile=SOURCE_ROWS).csv(f"{source}/{name}.csv")
    return source


def _whole_run(spark: SparkSession, folder: str, root: str, as_of: date, stamp: datetime, load: int | None = None) -> None:
    raw = {name: star.untidy(spark, folder, name, load) for name in S.BRONZE_TABLES}
    if load is None:  # a missing last name would break a constraint and stop the run
        raw |= {name: raw[name].withColumn("last_name", F.coalesce("last_name", F.lit("Unknown"))) for name in ("patients", "doctors")}
    with shuffles_removed(spark):
        source = _write_sources(spark, raw)
    run.run_pipeline(spark, source, root, as_of, stamp, id_type="bigint",
                     first_day=date(1995, 1, 1), last_day=date(2002, 12, 31), buckets=2, consume=True)


def warehouse_load(spark: SparkSession, folder: str) -> DataFrame:
    """All seven raw tables through files, cleaning, star schema and publication; rows per published table."""
    root = f"{shared_dir(spark)}/warehouse-{uuid.uuid4().hex}"
    _whole_run(spark, folder, root, AS_OF, LOAD_1)
    published = [
        run.open_layer(spark, root, layer, "bigint").log()
        .select(F.explode("tables").alias("tbl", "rows")).withColumn("tbl", F.concat(F.lit(f"{layer}."), "tbl"))
        for layer in ("bronze", "silver", "gold")
    ]
    return reduce(DataFrame.unionByName, published)


def warehouse_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Every row of the published facts and of the dimensions that keep history, as text, after two whole loads."""
    root = f"{shared_dir(spark)}/warehouse-{uuid.uuid4().hex}"
    _whole_run(spark, folder, root, DAY_1, LOAD_1, 1)
    _whole_run(spark, folder, root, DAY_2, LOAD_2, 2)
    published = run.gold_tables(spark, root, "bigint")
    return reduce(DataFrame.unionByName, [
        published[name].select(F.lit(name).alias("tbl"), F.concat_ws("|", *[
            F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in published[name].columns]).alias("content"))
        for name in ("dim_patient", "dim_doctor", "fact_appointments", "fact_billing")])


# Keys and dimension merges ---------------------------------------------------------------------

def surrogate_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys from 101 on over ids so far apart that each falls into a range of its own."""
    ids = star.read(spark, folder, "orders").select((F.col("o_orderkey") * 1_000_003 - 5).alias("id"))
    return assign_keys(ids, "id", "order_key", 100)


def _scd1(spark: SparkSession, first: DataFrame, second: DataFrame, id_col: str, key_col: str) -> DataFrame:
    attrs = [c for c in first.columns if c != id_col]
    empty = spark.createDataFrame([], T.StructType(
        [T.StructField(key_col, T.LongType()), *first.schema.fields, T.StructField("dwh_load_date", T.TimestampType())]))
    dim = stage(scd1_merge(empty, first, id_col, attrs, key_col, LOAD_1))
    return scd1_merge(dim, second, id_col, attrs, key_col, LOAD_2, stage)


def scd1_treatments(spark: SparkSession, folder: str) -> DataFrame:
    parts = star.read(spark, folder, "part").withColumn("k", F.col("p_partkey"))
    return _scd1(
        spark,
        parts.where(f"p_brand <> {NEW_BRAND}").select(
            F.col("k").alias("treatment_id"), F.col("p_name").alias("treatment_name"),
            star.money("p_retailprice", "decimal(10,2)").alias("standard_cost")),
        parts.where(f"p_brand <> {OLD_BRAND}").select(
            F.col("k").alias("treatment_id"), F.when(F.col("k") % 4 != 0, F.col("p_name")).alias("treatment_name"),
            (star.money("p_retailprice", "decimal(10,2)") + F.when(F.col("k") % 5 == 0, 100).otherwise(0))
            .cast("decimal(10,2)").alias("standard_cost")),
        "treatment_id", "treatment_key")


def scd1_departments(spark: SparkSession, folder: str) -> DataFrame:
    wards = star.read(spark, folder, "supplier").withColumn("k", F.col("s_suppkey"))
    return _scd1(
        spark,
        wards.where(f"s_nationkey <> {NEW_NATION}").select(
            F.col("k").alias("department_id"), F.col("s_name").alias("department_name"),
            F.lit("Main").alias("building")),
        wards.where(f"s_nationkey <> {OLD_NATION}").select(
            F.col("k").alias("department_id"), F.col("s_name").alias("department_name"),
            F.when(F.col("k") % 3 == 0, "East").otherwise("Main").alias("building")),
        "department_id", "department_key")


def scd1_insurance(spark: SparkSession, folder: str) -> DataFrame:
    firms = star.read(spark, folder, "customer").withColumn("k", F.col("c_custkey"))
    return _scd1(
        spark,
        firms.where(f"c_nationkey <> {NEW_NATION}").select(
            F.col("k").alias("insurance_id"), F.col("c_name").alias("provider_name"),
            F.col("c_mktsegment").alias("plan_type")),
        firms.where(f"c_nationkey <> {OLD_NATION}").select(
            F.col("k").alias("insurance_id"), F.col("c_name").alias("provider_name"),
            F.when(F.col("k") % 6 == 0, "NEW").otherwise(F.col("c_mktsegment")).alias("plan_type")),
        "insurance_id", "insurance_key")


def _scd2(spark: SparkSession, first: DataFrame, second: DataFrame, id_col: str, tracked: dict,
          key_col: str) -> tuple[DataFrame, DataFrame]:
    """The dimension after the first and after the second load."""
    attrs = [c for c in first.columns if c != id_col]
    history = T.StructType.fromDDL("effective_date date, end_date date, is_current boolean, dwh_load_date timestamp")
    empty = spark.createDataFrame([], T.StructType(
        [T.StructField(key_col, T.LongType()), *first.schema.fields, *history.fields]))
    dim = stage(scd2_merge(empty, first, id_col, attrs, tracked, key_col, DAY_1, LOAD_1))
    return dim, scd2_merge(dim, second, id_col, attrs, tracked, key_col, DAY_2, LOAD_2, staged=stage)


def _patient_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    people = star.read(spark, folder, "customer").withColumn("k", F.col("c_custkey"))
    k, city = F.col("k"), F.concat(F.lit("City "), F.col("c_nationkey").cast("string"))
    country = F.concat(F.lit("Country "), (F.col("c_nationkey") % 5).cast("string"))
    first = people.where(f"c_nationkey <> {NEW_NATION}").select(
        k.alias("patient_id"), F.col("c_name").alias("full_name"), F.when(k % 13 != 0, city).alias("city"),
        country.alias("country"), F.col("c_mktsegment").alias("insurance_status"))
    second = people.where(f"c_nationkey <> {OLD_NATION}").select(
        k.alias("patient_id"),
        F.when(k % 3 == 0, F.concat("c_name", F.lit(" II"))).otherwise(F.col("c_name")).alias("full_name"),
        F.when(k % 13 == 0, "").when(k % 11 == 0, "Moved").otherwise(city).alias("city"),
        country.alias("country"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 7 == 0, "CHANGED").otherwise(F.col("c_mktsegment"))
        .alias("insurance_status"))
    return _scd2(spark, first, second, "patient_id", S.PATIENT_TRACKED, "patient_key")


def _doctor_loads(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    staff = star.read(spark, folder, "supplier").withColumn("k", F.col("s_suppkey"))
    k, nation = F.col("k"), F.col("s_nationkey")

    def snapshot(field: Column, department: Column, status: Column) -> DataFrame:
        return staff.select(
            k.alias("doctor_id"), F.col("s_name").alias("full_name"),
            F.concat(F.lit("Field "), field.cast("string")).alias("specialization"),
            department.cast("int").alias("department_id"),
            F.when(k % 3 == 0, "MD").when(k % 3 == 1, "PhD").alias("qualification"), status.alias("status"))

    first = snapshot(nation, F.when(k % 4 != 0, nation), F.lit("Active"))
    second = snapshot(F.when(k % 5 == 0, nation + 1).otherwise(nation), F.when(k % 4 != 0, nation).otherwise(0),
                      F.when(k % 6 == 1, "Inactive").otherwise("Active"))
    return _scd2(spark, first, second, "doctor_id", S.DOCTOR_TRACKED, "doctor_key")


def scd2_patients(spark: SparkSession, folder: str) -> DataFrame:
    return _patient_loads(spark, folder)[1]


def scd2_doctors(spark: SparkSession, folder: str) -> DataFrame:
    return _doctor_loads(spark, folder)[1]


def scd2_event_history(spark: SparkSession, folder: str) -> DataFrame:
    """Versions that one merge per day of each user's last event would leave."""
    newest = F.max_by("event_type", F.struct("ts", "event_id")).alias("event_type")
    daily = star.read(spark, folder, "events").withColumn("day", F.col("ts").cast("date")) \
        .groupBy("user_id", "day").agg(newest)
    return history_of_changes(daily, "user_id", "day", {"event_type": ""})


def point_in_time_lookup(spark: SparkSession, folder: str) -> DataFrame:
    """Bills per insurance status that was valid on the bill's day.

    Bills are summed per patient and day before the version join, which so meets at most
    one row per patient and day however many bills a patient has.
    """
    versions = _patient_loads(spark, folder)[1].select("patient_id", "insurance_status", "effective_date", "end_date")
    daily = star.bills(spark, folder).groupBy("patient_id", "bill_date").agg(
        F.count(F.lit(1)).alias("_bills"), F.sum("total_amount").alias("_billed"))
    valid = (F.col("effective_date") <= F.col("bill_date")) & (
        F.col("end_date").isNull() | (F.col("bill_date") < F.col("end_date")))
    return daily.join(versions, "patient_id").where(valid).groupBy("insurance_status").agg(
        F.sum("_bills").alias("n_bills"), F.sum("_billed").alias("total_billed"))


# Facts -----------------------------------------------------------------------------------------

def _dims(spark: SparkSession, folder: str, keyed: bool = True) -> dict[str, DataFrame]:
    """Dimensions with gaps: patients of one nation, treatments of one brand, provider 4 and the year
    1995 are missing.
    With ``keyed`` the ids with gaps get dense keys and are written first, as loaded dimensions would be."""
    def dim(table: str, id_col: str, name: str, kept: str = "true", gaps: bool = False) -> DataFrame:
        ids = star.read(spark, folder, table).where(kept).select(F.col(id_col).alias(f"{name}_id"))
        if keyed and gaps:
            return stage(assign_keys(ids, f"{name}_id", f"{name}_key"))
        return ids.withColumn(f"{name}_key", F.col(f"{name}_id").cast("long") + 1)

    return {
        "dim_date": star.dates(spark, folder).where(FIRST_DATE),
        "dim_patient": dim("customer", "c_custkey", "patient", f"c_nationkey <> {NEW_NATION}", gaps=True).withColumn(
            "is_current", F.lit(True)),
        "dim_doctor": dim("supplier", "s_suppkey", "doctor").withColumn("is_current", F.lit(True)),
        "dim_department": dim("nation", "n_nationkey", "department"),
        "dim_treatment": dim("part", "p_partkey", "treatment", f"p_brand <> {NEW_BRAND}", gaps=True),
        "dim_insurance": dim("region", "r_regionkey", "insurance", "r_regionkey <> 4"),
    }


def _empty_fact(spark: SparkSession, table: str, *without: str) -> DataFrame:
    return S.empty(spark, table, "bigint").drop(*without)


def fact_appointments_upsert(spark: SparkSession, folder: str) -> DataFrame:
    visits = stage(star.appointments(spark, folder).drop("appointment_date"))
    key = F.col("appointment_id")
    changed = visits.withColumns({
        "appointment_status": F.when(key % 4 == 0, "Completed").otherwise(F.col("appointment_status")),
        "consultation_fee": F.when(key % 9 != 0, F.col("consultation_fee")),
        "duration_minutes": F.col("duration_minutes") + F.when(key % 5 == 0, 1).otherwise(0),
        "treatment_id": F.col("treatment_id") + F.when(key % 7 == 0, 1).otherwise(0),
    })
    dims = _dims(spark, folder)
    lookups = gold.appointment_lookups(dims)
    fact = _empty_fact(spark, "fact_appointments")
    for source, stamp in ((visits.where(FACT_SPLIT), LOAD_1), (changed, LOAD_2)):
        fact = fact_upsert(fact, source, "appointment_id", S.VISIT_MUTABLE, lookups, "appointment_key", stamp,
                           staged=stage)
    return fact


def fact_billing_upsert(spark: SparkSession, folder: str) -> DataFrame:
    bills = stage(star.bills(spark, folder).drop("bill_date"))
    key = F.col("bill_id")
    changed = bills.withColumns({
        "payment_status": F.when(key % 4 == 0, "Paid").otherwise(F.col("payment_status")),
        "patient_paid": (F.col("patient_paid") + F.when(key % 6 == 0, F.col("outstanding_amount")).otherwise(0))
        .cast("decimal(18,2)"),
        "outstanding_amount": F.when(key % 6 == 0, 0).otherwise(F.col("outstanding_amount")).cast("decimal(18,2)"),
    })
    lookups = gold.bill_lookups(_dims(spark, folder))
    fact = _empty_fact(spark, "fact_billing", "recovery_rate")
    for source, stamp in ((bills.where(FACT_SPLIT), LOAD_1), (changed, LOAD_2)):
        fact = fact_upsert(fact, source, "bill_id", S.BILL_MUTABLE, lookups, "billing_key", stamp, staged=stage)
    return gold.with_recovery_rate(fact)


def fact_load_misses(spark: SparkSession, folder: str) -> DataFrame:
    dims = _dims(spark, folder, keyed=False)
    visits = lookup_misses(star.appointments(spark, folder), gold.appointment_lookups(dims))
    bills = lookup_misses(star.bills(spark, folder), gold.bill_lookups(dims))
    return visits.withColumn("fact", F.lit("fact_appointments")).unionByName(
        bills.withColumn("fact", F.lit("fact_billing")))


# Quality and constraints -----------------------------------------------------------------------

def dq_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    return quality.row_counts({
        "gold.dim_date": star.dates(spark, folder),
        "gold.dim_patient": star.patients(spark, folder),
        "gold.dim_doctor": star.read(spark, folder, "supplier"),
        "gold.dim_department": star.departments(spark, folder),
        "gold.dim_treatment": star.read(spark, folder, "part"),
        "gold.dim_insurance": star.providers(spark, folder),
        "gold.fact_appointments": star.fact_appointments(spark, folder),
        "gold.fact_billing": star.fact_billing(spark, folder),
    })


def _partly_keyed(rows: DataFrame, lookups: Sequence[Lookup]) -> DataFrame:
    """Keys of all dimensions, NULL where the look-up misses."""
    for look in lookups:
        if look.on == look.key_col:
            known = look.ids().withColumn("_known", F.lit(True))
            rows = rows.join(known, look.on, "left").withColumn(look.on, F.when(F.col("_known"), F.col(look.on))).drop("_known")
        else:
            rows = rows.join(look.pairs(), look.on, "left")
    return rows


def dq_null_keys_appointments(spark: SparkSession, folder: str) -> DataFrame:
    fact = _partly_keyed(star.appointments(spark, folder), gold.appointment_lookups(_dims(spark, folder, keyed=False)))
    return quality.null_keys(fact, quality.APPOINTMENT_KEYS)


def dq_null_keys_billing(spark: SparkSession, folder: str) -> DataFrame:
    fact = _partly_keyed(star.bills(spark, folder), gold.bill_lookups(_dims(spark, folder, keyed=False)))
    return quality.null_keys(fact, quality.BILL_KEYS)


def _spoiled_visits(spark: SparkSession, folder: str) -> DataFrame:
    return star.fact_appointments(spark, folder).withColumns({
        "consultation_fee": F.col("consultation_fee") - 2000, "duration_minutes": F.col("duration_minutes") - 3})


def _spoiled_bills(spark: SparkSession, folder: str) -> DataFrame:
    return star.fact_billing(spark, folder).withColumns({
        "total_amount": F.col("total_amount") - 5000, "outstanding_amount": F.col("outstanding_amount") - 10,
        "insurance_covered": F.col("insurance_covered") - 20})


def dq_invalid_visits(spark: SparkSession, folder: str) -> DataFrame:
    return quality.invalid_visits(_spoiled_visits(spark, folder))


def dq_invalid_bills(spark: SparkSession, folder: str) -> DataFrame:
    return quality.invalid_bills(_spoiled_bills(spark, folder))


def dq_several_current(spark: SparkSession, folder: str) -> DataFrame:
    people = star.patients(spark, folder)
    return quality.several_current(people.unionByName(people.where("country = 'Country 3'")), "patient_id")


def dq_several_current_doctors(spark: SparkSession, folder: str) -> DataFrame:
    staff = star.read(spark, folder, "supplier").select(F.col("s_suppkey").alias("doctor_id"), F.lit(True).alias("is_current"))
    old = staff.withColumn("is_current", F.lit(False))
    return quality.several_current(staff.unionByName(staff.where("doctor_id % 7 = 0")).unionByName(old), "doctor_id")


def dq_date_range_appointments(spark: SparkSession, folder: str) -> DataFrame:
    return quality.date_range(star.fact_appointments(spark, folder), star.dates(spark, folder),
                              "earliest_appointment", "latest_appointment")


def dq_date_range_billing(spark: SparkSession, folder: str) -> DataFrame:
    return quality.date_range(star.fact_billing(spark, folder), star.dates(spark, folder),
                              "earliest_bill", "latest_bill")


def primary_key_violations(spark: SparkSession, folder: str) -> DataFrame:
    return checks.duplicates(star.read(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


def not_null_violations(spark: SparkSession, folder: str) -> DataFrame:
    people, staff = _cleaned("patients", spark, folder)[0], _cleaned("doctors", spark, folder)[0]
    return checks.count_violations(people, checks.null_counters(["patient_id", "first_name", "last_name"], "patients_")) \
        .unionByName(checks.count_violations(staff, checks.null_counters(["doctor_id", "department_id"], "doctors_")))


def not_null_violations_facts(spark: SparkSession, folder: str) -> DataFrame:
    """Required columns of cleaned appointments and bills."""
    return reduce(DataFrame.unionByName, (
        checks.count_violations(_cleaned(table, spark, folder)[0], checks.null_counters(S.required(table), f"{table}_"))
        for table in ("appointments", "bills")))


def check_violations(spark: SparkSession, folder: str) -> DataFrame:
    visits = checks.failure_counters(gold.fact_conditions("fact_appointments"))
    bills = checks.failure_counters(gold.fact_conditions("fact_billing"))
    return checks.count_violations(_spoiled_visits(spark, folder), visits).unionByName(
        checks.count_violations(_spoiled_bills(spark, folder), bills))


def length_violations(spark: SparkSession, folder: str) -> DataFrame:
    return checks.count_violations(_cleaned("patients", spark, folder)[0], checks.length_counters(
        {"first_name": 100, "full_name": 17, "city": 6, "phone": 30}))


def foreign_key_orphans(spark: SparkSession, folder: str) -> DataFrame:
    fact = star.fact_appointments(spark, folder)
    dims = {
        "dim_date": star.dates(spark, folder).where(FIRST_DATE),
        "dim_patient": star.read(spark, folder, "customer").where(f"c_nationkey <> {NEW_NATION}").select(
            F.col("c_custkey").alias("patient_key")),
        "dim_doctor": star.read(spark, folder, "supplier").select(F.col("s_suppkey").alias("doctor_key")),
        "dim_department": star.departments(spark, folder),
        "dim_treatment": star.read(spark, folder, "part").where(f"p_brand <> {NEW_BRAND}").select(
            F.col("p_partkey").alias("treatment_key")),
    }
    return checks.orphans(fact, [look._replace(on=look.key_col) for look in gold.appointment_lookups(dims)])


def foreign_key_orphans_billing(spark: SparkSession, folder: str) -> DataFrame:
    dims = {
        "dim_date": star.dates(spark, folder).where(FIRST_DATE),
        "dim_patient": star.read(spark, folder, "customer").where(f"c_nationkey <> {NEW_NATION}").select(
            F.col("c_custkey").alias("patient_key")),
        "dim_doctor": star.read(spark, folder, "supplier").select(F.col("s_suppkey").alias("doctor_key")),
        "dim_treatment": star.read(spark, folder, "part").where(f"p_brand <> {NEW_BRAND}").select(
            F.col("p_partkey").alias("treatment_key")),
        "dim_insurance": star.providers(spark, folder).where("insurance_key <> 4"),
    }
    return checks.orphans(star.fact_billing(spark, folder), [look._replace(on=look.key_col) for look in gold.bill_lookups(dims)])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "monthly_appointments": monthly_appointments,
    "doctor_performance": doctor_performance,
    "department_summary": department_summary,
    "billing_recovery": billing_recovery,
    "monthly_appointments_marts": monthly_appointments_marts,
    "department_summary_marts": department_summary_marts,
    "patient_analysis": patient_analysis,
    "patient_analysis_exact": patient_analysis_exact,
    "dim_date": dim_date,
    **{f"clean_{table}": _clean_query(table) for table in S.BRONZE_TABLES},
    "reject_rows": reject_rows,
    "reject_counts": reject_counts,
    "silver_row_counts": silver_row_counts,
    "dedup_lineitem": dedup_lineitem,
    **{f"bronze_{table}_csv": _bronze_query(table) for table in S.BRONZE_TABLES},
    "warehouse_load": warehouse_load,
    "warehouse_two_loads": warehouse_two_loads,
    "surrogate_keys": surrogate_keys,
    "scd1_treatments": scd1_treatments,
    "scd1_departments": scd1_departments,
    "scd1_insurance": scd1_insurance,
    "scd2_patients": scd2_patients,
    "scd2_doctors": scd2_doctors,
    "scd2_event_history": scd2_event_history,
    "point_in_time_lookup": point_in_time_lookup,
    "fact_appointments_upsert": fact_appointments_upsert,
    "fact_billing_upsert": fact_billing_upsert,
    "fact_load_misses": fact_load_misses,
    "dq_row_counts": dq_row_counts,
    "dq_null_keys_appointments": dq_null_keys_appointments,
    "dq_null_keys_billing": dq_null_keys_billing,
    "dq_invalid_visits": dq_invalid_visits,
    "dq_invalid_bills": dq_invalid_bills,
    "dq_several_current": dq_several_current,
    "dq_several_current_doctors": dq_several_current_doctors,
    "not_null_violations_facts": not_null_violations_facts,
    "foreign_key_orphans_billing": foreign_key_orphans_billing,
    "dq_date_range_appointments": dq_date_range_appointments,
    "dq_date_range_billing": dq_date_range_billing,
    "primary_key_violations": primary_key_violations,
    "not_null_violations": not_null_violations,
    "check_violations": check_violations,
    "length_violations": length_violations,
    "foreign_key_orphans": foreign_key_orphans,
}


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def wrapped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: portable(query(spark, folder))

    return {name: wrapped(query) for name, query in QUERIES.items()}
