"""The SQL each registered query is compared with, written for DuckDB without using the library.

Only the raw text rows (``untidy_sql``) are shared, because they are input, not result.
Percentages and averages are computed from whole cents so that no floating point takes part.
"""

from __future__ import annotations

from stratalake.schemas import RAW
from stratalake.star.tables import untidy_sql


def _with(*ctes: str, select: str) -> str:
    return f"WITH {', '.join(ctes)} {select}"


# Percentage with two decimals, rounded half up, of two whole numbers.
def _pct(part: str, whole: str) -> str:
    return f"CAST((20000 * CAST({part} AS HUGEINT) + {whole}) // (2 * {whole}) AS DOUBLE) / 100"


# Average with two decimals, rounded half up, of whole cents.
def _avg(cents: str, n: str) -> str:
    return f"CAST((2 * CAST({cents} AS HUGEINT) + {n}) // (2 * {n}) AS DOUBLE) / 100"


def _cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS BIGINT)"


ITEMS = """items AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus) = 1)"""

VISITS = ITEMS + """, visits AS (
  SELECT l_orderkey * 8 + l_linenumber AS appointment_id, o_custkey AS patient_id, l_suppkey AS doctor_id,
         s_nationkey AS department_id, l_partkey AS treatment_id, CAST(o_orderdate AS DATE) AS day,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key, l_linestatus AS appointment_time,
         CASE WHEN l_returnflag = 'A' THEN 'Completed' WHEN l_returnflag = 'R' THEN 'No-Show'
              WHEN l_linestatus = 'O' THEN 'Scheduled' ELSE 'Cancelled' END AS status,
         CAST(l_quantity AS INT) AS minutes, CAST(l_extendedprice AS DECIMAL(10,2)) AS fee
  FROM items JOIN orders ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey)"""

BILLS = """bill_cents AS (
  SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS total, 
         CAST(round(o_totalprice * 100) AS BIGINT) * (o_orderkey % 5) // 5 AS covered FROM orders),
bill_parts AS (
  SELECT *, CASE o_orderstatus WHEN 'F' THEN total - covered WHEN 'P' THEN (total - covered) // 2 ELSE 0 END AS paid
  FROM bill_cents),
bills AS (
  SELECT o_orderkey AS bill_id, o_orderkey * 8 + 1 AS appointment_id, o_custkey AS patient_id,
         o_orderkey % 10 AS doctor_id, o_orderkey % 200 AS treatment_id,
         CASE WHEN o_orderkey % 11 <> 0 THEN o_custkey % 5 END AS insurance_id, CAST(o_orderdate AS DATE) AS day,
         CAST(strftime(o_orderdate, '%Y%m%d') AS INT) AS date_key,
         CASE WHEN o_orderstatus = 'F' THEN 'Paid' WHEN o_orderstatus = 'P' THEN 'Partial'
              WHEN o_orderkey % 3 = 0 THEN 'Overdue' ELSE 'Pending' END AS status,
         total, covered, paid, total - covered - paid AS outstanding
  FROM bill_parts)"""

DATES = """days AS (
  SELECT CAST(d AS DATE) AS d FROM (SELECT date_trunc('year', min(o_orderdate)) AS a,
         date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS b FROM orders) AS span,
         generate_series(span.a, span.b, INTERVAL 1 DAY) AS s(d)),
dates AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, d AS full_date, CAST(year(d) AS INT) AS year,
         CAST(quarter(d) AS INT) AS quarter, 'Q' || CAST(quarter(d) AS VARCHAR) AS quarter_name,
         CAST(month(d) AS INT) AS month, monthname(d) AS month_name, CAST(day(d) AS INT) AS day_of_month,
         CAST(dayofweek(d) + 1 AS INT) AS day_of_week, dayname(d) AS day_name,
         CAST((dayofyear(d) + dayofweek(date_trunc('year', d)) - 1) // 7 + 1 AS INT) AS week_number,
         CASE WHEN dayofweek(d) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
  FROM days)"""

_MONEY = f"""CAST(sum(fee) AS DOUBLE) AS {{total}}, {_avg('sum(' + _cents('fee') + ')', 'count(fee)')} AS avg_consultation_fee,
  CAST(sum(minutes) // count(minutes) AS DOUBLE) AS avg_duration_minutes,
  count(DISTINCT patient_id) AS unique_patients"""


def _count(label: str, name: str) -> str:
    return f"count(CASE WHEN v.status = '{label}' THEN 1 END) AS {name}"


def _rate(label: str, name: str) -> str:
    share = f"count(CASE WHEN v.status = '{label}' THEN 1 END)"
    return f"{_pct(share, 'count(*)')} AS {name}"


MONTHLY = _with(VISITS, DATES, select=f"""
SELECT year, quarter_name, month, month_name, count(*) AS total_appointments, {_count('Completed', 'completed')},
  {_count('Cancelled', 'cancelled')}, {_count('No-Show', 'no_shows')}, {_count('Scheduled', 'scheduled')},
  {_rate('Completed', 'completion_rate_pct')}, {_rate('Cancelled', 'cancellation_rate_pct')},
  {_MONEY.format(total='total_consultation_revenue')}
FROM visits v JOIN dates USING (date_key) GROUP BY year, quarter_name, month, month_name""")

# Loads of the doctor dimension.
DOCTOR_LOADS = """d1 AS (
  SELECT s_suppkey AS id, s_name AS full_name, 'Field ' || CAST(s_nationkey AS VARCHAR) AS specialization,
         CASE WHEN s_suppkey % 4 <> 0 THEN s_nationkey END AS department_id,
         CASE s_suppkey % 3 WHEN 0 THEN 'MD' WHEN 1 THEN 'PhD' END AS qualification, 'Active' AS status,
         row_number() OVER (ORDER BY s_suppkey) AS key FROM supplier),
d2 AS (
  SELECT s_suppkey AS id, s_name AS full_name,
         'Field ' || CAST(CASE WHEN s_suppkey % 5 = 0 THEN s_nationkey + 1 ELSE s_nationkey END AS VARCHAR) AS specialization,
         CASE WHEN s_suppkey % 4 <> 0 THEN s_nationkey ELSE 0 END AS department_id,
         CASE s_suppkey % 3 WHEN 0 THEN 'MD' WHEN 1 THEN 'PhD' END AS qualification,
         CASE WHEN s_suppkey % 6 = 1 THEN 'Inactive' ELSE 'Active' END AS status FROM supplier),
doctor_changes AS (
  SELECT d2.id FROM d1 JOIN d2 USING (id) WHERE coalesce(d1.specialization, '') <> coalesce(d2.specialization, '')
    OR coalesce(d1.department_id, 0) <> coalesce(d2.department_id, 0) OR coalesce(d1.status, '') <> coalesce(d2.status, ''))"""

DOCTORS = _with(VISITS, DOCTOR_LOADS, select=f"""
, current AS (
  SELECT id, full_name, specialization, qualification, status, DATE '1995-01-01' AS since FROM d1
   WHERE id NOT IN (SELECT id FROM doctor_changes)
  UNION ALL
  SELECT id, full_name, specialization, qualification, status, DATE '1998-07-01' FROM d2
   WHERE id IN (SELECT id FROM doctor_changes))
SELECT c.id AS doctor_id, c.full_name AS doctor_name, c.specialization, c.qualification, c.status,
  count(*) AS total_appointments, {_count('Completed', 'completed_appointments')},
  {_count('Cancelled', 'cancelled_appointments')}, {_rate('Completed', 'completion_rate_pct')},
  {_MONEY.format(total='total_revenue')}
FROM visits v JOIN current c ON v.doctor_id = c.id AND v.day >= c.since
GROUP BY c.id, c.full_name, c.specialization, c.qualification, c.status""")

DEPARTMENTS = _with(VISITS, select=f"""
SELECT department_id, n_name AS department_name, r_name AS building,
  'Floor ' || CAST(department_id % 4 AS VARCHAR) AS floor,
  CASE WHEN department_id % 6 <> 0 THEN 'Head of ' || n_name END AS head_doctor,
  count(*) AS total_appointments, {_count('Completed', 'completed')}, {_count('Cancelled', 'cancelled')},
  {_count('No-Show', 'no_shows')}, {_rate('Completed', 'completion_rate_pct')},
  {_MONEY.format(total='total_revenue')}, count(DISTINCT doctor_id) AS active_doctors
FROM visits v JOIN nation ON department_id = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY department_id, n_name, r_name""")

_RECOVERY = "(20000 * CAST(paid + covered AS HUGEINT) + total) // (2 * total)"

RECOVERY = _with(BILLS, select=f"""
SELECT r_regionkey AS insurance_id, r_name AS provider_name,
  CASE WHEN r_regionkey % 2 = 0 THEN 'PPO' ELSE 'HMO' END AS plan_type,
  CAST(r_regionkey * 10 + 50 AS DOUBLE) AS contracted_coverage_pct,
  CASE WHEN r_regionkey = 3 THEN 'Inactive' ELSE 'Active' END AS provider_status, count(*) AS total_bills,
  count(CASE WHEN status = 'Paid' THEN 1 END) AS paid_bills, count(CASE WHEN status = 'Partial' THEN 1 END) AS partial_bills,
  count(CASE WHEN status = 'Pending' THEN 1 END) AS pending_bills, count(CASE WHEN status = 'Overdue' THEN 1 END) AS overdue_bills,
  CAST(sum(total) AS DOUBLE) / 100 AS total_billed, CAST(sum(covered) AS DOUBLE) / 100 AS total_insurance_covered,
  CAST(sum(paid) AS DOUBLE) / 100 AS total_patient_paid, CAST(sum(outstanding) AS DOUBLE) / 100 AS total_outstanding,
  {_avg(f'sum({_RECOVERY})', 'count(*)')} AS avg_recovery_rate_pct, {_pct('sum(covered)', 'sum(total)')} AS actual_coverage_pct
FROM bills JOIN region ON insurance_id = r_regionkey GROUP BY r_regionkey, r_name""")

_PATIENT_COLUMNS = """c_custkey AS patient_id, c_name AS full_name,
  CASE c_custkey % 3 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END AS gender, CAST(c_custkey % 90 AS INT) AS age,
  CASE WHEN c_custkey % 4 <> 0 THEN 'A+' END AS blood_type, 'Country ' || CAST(c_nationkey % 5 AS VARCHAR) AS country,
  c_mktsegment AS insurance_status, '1990-01-01' AS registration_date"""

# The literal join of both facts.
PATIENTS = _with(VISITS, BILLS, select=f"""
SELECT {_PATIENT_COLUMNS}, count(DISTINCT v.appointment_id) AS total_appointments,
  count(DISTINCT CASE WHEN v.status = 'Completed' THEN v.appointment_id END) AS completed_appointments,
  CAST(sum(CAST(fee AS DECIMAL(18,2))) AS DOUBLE) AS total_consultation_fees, count(DISTINCT b.bill_id) AS total_bills,
  CAST(sum(total) AS DOUBLE) / 100 AS lifetime_billed, CAST(sum(paid) AS DOUBLE) / 100 AS lifetime_paid,
  CAST(sum(outstanding) AS DOUBLE) / 100 AS total_outstanding,
  CAST(min(v.day) AS VARCHAR) AS first_visit_date, CAST(max(v.day) AS VARCHAR) AS last_visit_date
FROM customer LEFT JOIN visits v ON c_custkey = v.patient_id
LEFT JOIN (SELECT * FROM bills WHERE insurance_id IS NOT NULL) b ON c_custkey = b.patient_id
GROUP BY c_custkey, c_name, c_nationkey, c_mktsegment""")

PATIENTS_EXACT = _with(VISITS, BILLS, select=f"""
SELECT {_PATIENT_COLUMNS}, coalesce(n, 0) AS total_appointments, coalesce(done, 0) AS completed_appointments,
  CAST(fees AS DOUBLE) AS total_consultation_fees, coalesce(m, 0) AS total_bills,
  CAST(t AS DOUBLE) / 100 AS lifetime_billed, CAST(p AS DOUBLE) / 100 AS lifetime_paid,
  CAST(o AS DOUBLE) / 100 AS total_outstanding, a AS first_visit_date, z AS last_visit_date
FROM customer LEFT JOIN (
  SELECT patient_id, count(*) AS n, count(CASE WHEN status = 'Completed' THEN 1 END) AS done, sum(fee) AS fees,
         CAST(min(day) AS VARCHAR) AS a, CAST(max(day) AS VARCHAR) AS z FROM visits GROUP BY patient_id) v
  ON c_custkey = v.patient_id
LEFT JOIN (
  SELECT patient_id, count(*) AS m, sum(total) AS t, sum(paid) AS p, sum(outstanding) AS o FROM bills
  WHERE insurance_id IS NOT NULL GROUP BY patient_id) b ON c_custkey = b.patient_id""")

CALENDAR = _with(DATES, select="""
SELECT date_key, CAST(full_date AS VARCHAR) AS full_date, year, quarter, quarter_name, month, month_name, day_of_month,
  day_of_week, day_name, week_number, is_weekend, coalesce(n, 0) AS n_bills
FROM dates LEFT JOIN (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1) o ON full_date = d""")


# Cleaning --------------------------------------------------------------------------------------

def _int(c: str) -> str:
    return f"TRY_CAST({c} AS BIGINT)"


def _date(c: str) -> str:
    """The whole text is an ISO day, one with a time of day, or one of the other three forms."""
    day = f"regexp_extract(trim({c}), '^(\\d{{4}}-\\d{{1,2}}-\\d{{1,2}})([ T]\\d{{1,2}}:\\d{{2}}(:\\d{{2}}(\\.\\d+)?)?)?$', 1)"
    timed = f"(length({day}) = length(trim({c})) OR TRY_CAST(trim({c}) AS TIMESTAMP) IS NOT NULL)"
    others = " ".join(f"WHEN regexp_full_match(trim({c}), '{shape}') THEN CAST(try_strptime(trim({c}), '{form}') AS DATE)" for shape, form in (
        ("\\d{8}", "%Y%m%d"), ("\\d{1,2}/\\d{1,2}/\\d{4}", "%m/%d/%Y"), ("\\d{4}/\\d{1,2}/\\d{1,2}", "%Y/%m/%d")))
    return f"CASE WHEN {day} <> '' AND {timed} THEN TRY_CAST({day} AS DATE) {others} END"


def _dec(c: str, p: int, s: int) -> str:
    return f"CASE WHEN {c} NOT LIKE '%e%' THEN TRY_CAST({c} AS DECIMAL({p},{s})) END"


def _text(c: str) -> str:
    return f"CAST({c} AS VARCHAR)"


# The labels of the status codes below, which results must show.
_ACTIVE = "CASE WHEN upper(trim(status)) IN ('ACTIVE', 'A') THEN 'Active' ELSE 'Inactive' END AS status"

# table -> (id column, [(reason, SQL that is true for a bad row)], order column, projection)
_CLEAN = {
    "patients": (
        "patient_id",
        [("invalid patient_id", f"{_int('patient_id')} IS NULL"), ("missing first_name", "first_name IS NULL")],
        "registration_date",
        f"""{_int('patient_id')} AS patient_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
        trim(first_name) || ' ' || trim(last_name) AS full_name,
        CASE WHEN upper(trim(gender)) IN ('M', 'MALE') THEN 'Male' WHEN upper(trim(gender)) IN ('F', 'FEMALE') THEN 'Female'
             ELSE 'Other' END AS gender,
        {_text(_date('birth_date'))} AS birth_date, CAST(2024 - year({_date('birth_date')}) AS INT) AS age,
        trim(blood_type) AS blood_type, trim(city) AS city, trim(country) AS country, trim(phone) AS phone,
        lower(trim(email)) AS email, {_text(_date('registration_date'))} AS registration_date,
        CASE WHEN upper(trim(insurance_status)) IN ('YES', 'Y', '1', 'ACTIVE') THEN 'Active' ELSE 'Inactive' END
          AS insurance_status"""),
    "doctors": (
        "doctor_id",
        [("invalid doctor_id", f"{_int('doctor_id')} IS NULL"), ("missing first_name", "first_name IS NULL")],
        "hire_date",
        f"""{_int('doctor_id')} AS doctor_id, trim(first_name) AS first_name, trim(last_name) AS last_name,
        trim(first_name) || ' ' || trim(last_name) AS full_name, trim(specialization) AS specialization,
        {_int('department_id')} AS department_id, trim(qualification) AS qualification,
        {_text(_date('hire_date'))} AS hire_date, {_ACTIVE}, trim(phone) AS phone"""),
    "departments": (
        "department_id",
        [("invalid department_id", f"{_int('department_id')} IS NULL"),
         ("missing department_name", "department_name IS NULL")],
        "established_date",
        f"""{_int('department_id')} AS department_id, trim(department_name) AS department_name, trim(building) AS building,
        trim(floor) AS floor, trim(head_doctor) AS head_doctor, {_text(_date('established_date'))} AS established_date"""),
    "treatments": (
        "treatment_id",
        [("invalid treatment_id", f"{_int('treatment_id')} IS NULL"), ("missing treatment_name", "treatment_name IS NULL")],
        None,
        f"""{_int('treatment_id')} AS treatment_id, trim(treatment_name) AS treatment_name,
        trim(treatment_type) AS treatment_type, upper(trim(diagnosis_code)) AS diagnosis_code,
        trim(diagnosis_name) AS diagnosis_name, CAST({_dec('standard_cost', 10, 2)} AS DOUBLE) AS standard_cost,
        TRY_CAST(duration_minutes AS INT) AS duration_minutes"""),
    "insurance_providers": (
        "insurance_id",
        [("invalid insurance_id", f"{_int('insurance_id')} IS NULL"), ("missing provider_name", "provider_name IS NULL")],
        None,
        f"""{_int('insurance_id')} AS insurance_id, trim(provider_name) AS provider_name, trim(plan_type) AS plan_type,
        CAST({_dec('coverage_pct', 5, 2)} AS DOUBLE) AS coverage_pct,
        CAST({_dec('max_coverage_amount', 12, 2)} AS DOUBLE) AS max_coverage_amount, {_ACTIVE}"""),
    "appointments": (
        "appointment_id",
        [("invalid appointment_id", f"{_int('appointment_id')} IS NULL"),
         ("invalid appointment_date", f"{_date('appointment_date')} IS NULL"),
         ("invalid patient_id", f"{_int('patient_id')} IS NULL")],
        "appointment_date",
        f"""{_int('appointment_id')} AS appointment_id, {_int('patient_id')} AS patient_id, {_int('doctor_id')} AS doctor_id,
        {_int('department_id')} AS department_id, {_int('treatment_id')} AS treatment_id,
        {_text(_date('appointment_date'))} AS appointment_date, trim(appointment_time) AS appointment_time,
        TRY_CAST(duration_minutes AS INT) AS duration_minutes,
        CASE upper(trim(status)) WHEN 'COMPLETED' THEN 'Completed' WHEN 'COMPLETE' THEN 'Completed'
          WHEN 'SCHEDULED' THEN 'Scheduled' WHEN 'CANCELLED' THEN 'Cancelled' WHEN 'CANCELED' THEN 'Cancelled'
          WHEN 'NO-SHOW' THEN 'No-Show' WHEN 'NOSHOW' THEN 'No-Show' ELSE trim(status) END AS status,
        CAST({_dec('consultation_fee', 10, 2)} AS DOUBLE) AS consultation_fee, trim(notes) AS notes"""),
    "bills": (
        "bill_id",
        [("invalid bill_id", f"{_int('bill_id')} IS NULL"),
         ("invalid or non-positive total_amount", f"coalesce({_dec('total_amount', 12, 2)}, 0) <= 0"),
         ("invalid bill_date", f"{_date('bill_date')} IS NULL")],
        "bill_date",
        f"""{_int('bill_id')} AS bill_id, {_int('appointment_id')} AS appointment_id, {_int('patient_id')} AS patient_id,
        {_int('doctor_id')} AS doctor_id, {_int('insurance_id')} AS insurance_id, {_int('treatment_id')} AS treatment_id,
        {_text(_date('bill_date'))} AS bill_date, CAST({_dec('total_amount', 12, 2)} AS DOUBLE) AS total_amount,
        coalesce(CAST({_dec('insurance_covered', 12, 2)} AS DOUBLE), 0) AS insurance_covered,
        coalesce(CAST({_dec('patient_paid', 12, 2)} AS DOUBLE), 0) AS patient_paid,
        coalesce(CAST({_dec('outstanding_amount', 12, 2)} AS DOUBLE), 0) AS outstanding_amount,
        CASE upper(trim(payment_status)) WHEN 'PAID' THEN 'Paid' WHEN 'PARTIAL' THEN 'Partial'
          WHEN 'PENDING' THEN 'Pending' WHEN 'OVERDUE' THEN 'Overdue' ELSE trim(payment_status) END AS payment_status"""),
}


def _clean(table: str, keep: str = "true", load: int | None = None) -> str:
    """Accepted rows of a raw table, newest per id."""
    key, checks, newest, projection = _CLEAN[table]
    bad = " OR ".join(f"({sql})" for _, sql in checks)
    order = ([f"{newest} DESC NULLS LAST"] if newest else []) + [
        f"{c} ASC NULLS FIRST" for c in RAW[table] if c != newest]
    return (f"SELECT {projection} FROM (SELECT *, row_number() OVER (PARTITION BY {_int(key)} ORDER BY {', '.join(order)}) AS rn "
            f"FROM ({untidy_sql(table, load)}) AS raw WHERE NOT ({bad}) AND ({keep})) AS ranked WHERE rn = 1")


def _rejects(table: str, keep: str = "true") -> str:
    _, checks, _, _ = _CLEAN[table]
    bad = " OR ".join(f"({sql})" for _, sql in checks)
    reasons = ", ".join(f"CASE WHEN {sql} THEN '{reason}' END" for reason, sql in checks)
    fields = ", ".join(f"""CASE WHEN {c} IS NOT NULL THEN '"{c}":"' || {c} || '"' END""" for c in RAW[table])
    return (f"SELECT 'bronze.{table}' AS source_table, concat_ws('; ', {reasons}) AS rejection_reason, "
            f"'{{' || concat_ws(',', {fields}) || '}}' AS raw_row_json FROM ({untidy_sql(table)}) AS raw "
            f"WHERE ({bad}) AND ({keep})")


_ALL_REJECTS = " UNION ALL ".join(f"({_rejects(t)})" for t in RAW)

_LOADED = ", ".join(f"s_{t} AS MATERIALIZED ({_clean(t, 'true')})" for t in RAW)
_RAW_COUNTS = " UNION ALL ".join(
    f"SELECT 'bronze.{t}' AS tbl, count(*) AS rows FROM ({untidy_sql(t)}) AS raw" for t in RAW)
_SILVER_COUNTS = " UNION ALL ".join(f"SELECT 'silver.{t}', count(*) FROM s_{t}" for t in RAW)
_REJECT_COUNT = " UNION ALL ".join(f"({_rejects(t, 'true')})" for t in RAW)

WAREHOUSE = f"""WITH {_LOADED}
{_RAW_COUNTS} UNION ALL {_SILVER_COUNTS}
UNION ALL SELECT 'silver.rejected_rows', count(*) FROM ({_REJECT_COUNT}) AS r
UNION ALL SELECT 'gold.dim_date', CAST(DATE '2003-01-01' - DATE '1995-01-01' AS BIGINT)
UNION ALL SELECT 'gold.dim_department', count(*) FROM s_departments
UNION ALL SELECT 'gold.dim_treatment', count(*) FROM s_treatments
UNION ALL SELECT 'gold.dim_insurance', count(*) FROM s_insurance_providers
UNION ALL SELECT 'gold.dim_patient', count(*) FROM s_patients
UNION ALL SELECT 'gold.dim_doctor', count(*) FROM s_doctors
UNION ALL SELECT 'gold.fact_appointments', count(*) FROM s_appointments
  WHERE patient_id IN (SELECT patient_id FROM s_patients) AND doctor_id IN (SELECT doctor_id FROM s_doctors)
    AND department_id IN (SELECT department_id FROM s_departments)
    AND treatment_id IN (SELECT treatment_id FROM s_treatments)
    AND appointment_date BETWEEN '1995-01-01' AND '2002-12-31'
UNION ALL SELECT 'gold.fact_billing', count(*) FROM s_bills
  WHERE patient_id IN (SELECT patient_id FROM s_patients) AND doctor_id IN (SELECT doctor_id FROM s_doctors)
    AND treatment_id IN (SELECT treatment_id FROM s_treatments)
    AND insurance_id IN (SELECT insurance_id FROM s_insurance_providers)
    AND bill_date BETWEEN '1995-01-01' AND '2002-12-31'"""


# Dimension merges ------------------------------------------------------------------------------

def _scd1(first: str, second: str, id_col: str, key_col: str, attrs: str) -> str:
    names = attrs.split(", ")
    taken = ", ".join(f"CASE WHEN s2.id IS NOT NULL THEN s2.{a} ELSE s1.{a} END AS {a}" for a in names)
    return f"""WITH s1 AS ({first}), s2 AS ({second}), old AS (SELECT *, row_number() OVER (ORDER BY id) AS key FROM s1)
    SELECT old.key AS {key_col}, old.id AS {id_col}, {taken.replace('s1.', 'old.')},
           CASE WHEN s2.id IS NOT NULL THEN '1999-07-01 00:00:00' ELSE '1998-07-01 00:00:00' END AS dwh_load_date
    FROM old LEFT JOIN s2 ON old.id = s2.id
    UNION ALL
    SELECT (SELECT count(*) FROM s1) + row_number() OVER (ORDER BY id), id, {attrs}, '1999-07-01 00:00:00'
    FROM s2 WHERE id NOT IN (SELECT id FROM s1)"""


SCD1_TREATMENTS = _scd1(
    "SELECT p_partkey AS id, p_name AS treatment_name, CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS DOUBLE) AS standard_cost "
    "FROM part WHERE p_brand <> 'Brand#9'",
    "SELECT p_partkey AS id, CASE WHEN p_partkey % 4 <> 0 THEN p_name END AS treatment_name, "
    "CAST(CAST(p_retailprice AS DECIMAL(10,2)) + CASE WHEN p_partkey % 5 = 0 THEN 100 ELSE 0 END AS DOUBLE) AS standard_cost "
    "FROM part WHERE p_brand <> 'Brand#8'",
    "treatment_id", "treatment_key", "treatment_name, standard_cost")
SCD1_DEPARTMENTS = _scd1(
    "SELECT s_suppkey AS id, s_name AS department_name, 'Main' AS building FROM supplier WHERE s_nationkey <> 9",
    "SELECT s_suppkey AS id, s_name AS department_name, CASE WHEN s_suppkey % 3 = 0 THEN 'East' ELSE 'Main' END AS building "
    "FROM supplier WHERE s_nationkey <> 8",
    "department_id", "department_key", "department_name, building")
SCD1_INSURANCE = _scd1(
    "SELECT c_custkey AS id, c_name AS provider_name, c_mktsegment AS plan_type FROM customer WHERE c_nationkey <> 9",
    "SELECT c_custkey AS id, c_name AS provider_name, CASE WHEN c_custkey % 6 = 0 THEN 'NEW' ELSE c_mktsegment END AS plan_type "
    "FROM customer WHERE c_nationkey <> 8",
    "insurance_id", "insurance_key", "provider_name, plan_type")

PATIENT_LOADS = """p1 AS (
  SELECT c_custkey AS id, c_name AS full_name,
         CASE WHEN c_custkey % 13 <> 0 THEN 'City ' || CAST(c_nationkey AS VARCHAR) END AS city,
         'Country ' || CAST(c_nationkey % 5 AS VARCHAR) AS country, c_mktsegment AS insurance_status,
         row_number() OVER (ORDER BY c_custkey) AS key FROM customer WHERE c_nationkey <> 9),
p2 AS (
  SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN c_name || ' II' ELSE c_name END AS full_name,
         CASE WHEN c_custkey % 13 = 0 THEN '' WHEN c_custkey % 11 = 0 THEN 'Moved'
              ELSE 'City ' || CAST(c_nationkey AS VARCHAR) END AS city,
         'Country ' || CAST(c_nationkey % 5 AS VARCHAR) AS country,
         CASE WHEN c_custkey % 17 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS insurance_status
  FROM customer WHERE c_nationkey <> 8),
patient_changes AS (
  SELECT p2.id FROM p1 JOIN p2 USING (id) WHERE coalesce(p1.city, '') <> coalesce(p2.city, '')
    OR p1.country <> p2.country OR coalesce(p1.insurance_status, '') <> coalesce(p2.insurance_status, ''))"""


def _scd2(old: str, new: str, changes: str, key_col: str, id_col: str, attrs: str) -> str:
    return f"""
SELECT key AS {key_col}, id AS {id_col}, {attrs}, '1995-01-01' AS effective_date,
  CASE WHEN id IN (SELECT id FROM {changes}) THEN '1998-07-01' END AS end_date,
  CASE WHEN id IN (SELECT id FROM {changes}) THEN 0 ELSE 1 END AS is_current, '1998-07-01 00:00:00' AS dwh_load_date
FROM {old}
UNION ALL
SELECT (SELECT count(*) FROM {old}) + row_number() OVER (ORDER BY id), id, {attrs}, '1998-07-01', NULL, 1, '1999-07-01 00:00:00'
FROM {new} WHERE id NOT IN (SELECT id FROM {old}) OR id IN (SELECT id FROM {changes})"""


_PATIENT_ATTRS = "full_name, city, country, insurance_status"
SCD2_PATIENTS = _with(PATIENT_LOADS, select=_scd2(
    "p1", "p2", "patient_changes", "patient_key", "patient_id", _PATIENT_ATTRS))
SCD2_DOCTORS = _with(DOCTOR_LOADS, select=_scd2(
    "d1", "d2", "doctor_changes", "doctor_key", "doctor_id",
    "full_name, specialization, department_id, qualification, status"))

EVENT_HISTORY = """WITH daily AS (
  SELECT user_id, CAST(ts AS DATE) AS day, event_type FROM events
  QUALIFY row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) = 1),
marked AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY day) AS before FROM daily),
starts AS (SELECT * FROM marked WHERE before IS NULL OR before <> event_type),
versions AS (SELECT user_id, event_type, day, lead(day) OVER (PARTITION BY user_id ORDER BY day) AS next FROM starts)
SELECT user_id, event_type, CAST(day AS VARCHAR) AS effective_date, CAST(next AS VARCHAR) AS end_date,
       CASE WHEN next IS NULL THEN 1 ELSE 0 END AS is_current FROM versions"""

POINT_IN_TIME = _with(BILLS, PATIENT_LOADS, "versions AS (" + _scd2(
    "p1", "p2", "patient_changes", "patient_key", "patient_id", _PATIENT_ATTRS) + ")", select="""
SELECT insurance_status, count(*) AS n_bills, CAST(sum(total) AS DOUBLE) / 100 AS total_billed
FROM bills JOIN versions v ON bills.patient_id = v.patient_id AND CAST(effective_date AS DATE) <= day
  AND (end_date IS NULL OR day < CAST(end_date AS DATE))
GROUP BY insurance_status""")


# Facts -----------------------------------------------------------------------------------------

DIMS = """k_patient AS (SELECT c_custkey AS patient_id, row_number() OVER (ORDER BY c_custkey) AS patient_key
  FROM customer WHERE c_nationkey <> 9),
k_doctor AS (SELECT s_suppkey AS doctor_id, row_number() OVER (ORDER BY s_suppkey) AS doctor_key FROM supplier),
k_department AS (SELECT n_nationkey AS department_id, row_number() OVER (ORDER BY n_nationkey) AS department_key FROM nation),
k_treatment AS (SELECT p_partkey AS treatment_id, row_number() OVER (ORDER BY p_partkey) AS treatment_key
  FROM part WHERE p_brand <> 'Brand#9'),
k_insurance AS (SELECT r_regionkey AS insurance_id, row_number() OVER (ORDER BY r_regionkey) AS insurance_key
  FROM region WHERE r_regionkey <> 4)"""

VISIT_FACT = _with(VISITS, DIMS, select="""
, changed AS (
  SELECT * REPLACE (CASE WHEN appointment_id % 4 = 0 THEN 'Completed' ELSE status END AS status,
                    CASE WHEN appointment_id % 9 <> 0 THEN fee END AS fee,
                    minutes + CASE WHEN appointment_id % 5 = 0 THEN 1 ELSE 0 END AS minutes,
                    treatment_id + CASE WHEN appointment_id % 7 = 0 THEN 1 ELSE 0 END AS treatment_id) FROM visits),
f1 AS (
  SELECT *, row_number() OVER (ORDER BY appointment_id) AS appointment_key
  FROM visits JOIN k_patient USING (patient_id) JOIN k_doctor USING (doctor_id) JOIN k_department USING (department_id)
       JOIN k_treatment USING (treatment_id) WHERE date_key BETWEEN 19960101 AND 19981231),
updated AS (
  SELECT f1.*, c.status AS new_status, c.minutes AS new_minutes, c.fee AS new_fee,
         coalesce(f1.status, '') <> coalesce(c.status, '') OR coalesce(f1.minutes, -1) <> coalesce(c.minutes, -1)
         OR coalesce(f1.fee, -1) <> coalesce(c.fee, -1) AS moved
  FROM f1 JOIN changed c USING (appointment_id)),
added AS (
  SELECT *, (SELECT count(*) FROM f1) + row_number() OVER (ORDER BY appointment_id) AS appointment_key
  FROM changed JOIN k_patient USING (patient_id) JOIN k_doctor USING (doctor_id) JOIN k_department USING (department_id)
       JOIN k_treatment USING (treatment_id)
  WHERE date_key >= 19960101 AND appointment_id NOT IN (SELECT appointment_id FROM f1))
SELECT appointment_key, appointment_id, date_key, patient_key, doctor_key, department_key, treatment_key, appointment_time,
  new_status AS appointment_status, new_minutes AS duration_minutes, CAST(new_fee AS DOUBLE) AS consultation_fee,
  CASE WHEN moved THEN '1999-07-01 00:00:00' ELSE '1998-07-01 00:00:00' END AS dwh_load_date FROM updated
UNION ALL
SELECT appointment_key, appointment_id, date_key, patient_key, doctor_key, department_key, treatment_key, appointment_time,
  status, minutes, CAST(fee AS DOUBLE), '1999-07-01 00:00:00' FROM added""")

_BILL_OUT = f"""billing_key, bill_id, appointment_id, date_key, patient_key, doctor_key, treatment_key, insurance_key,
  status AS payment_status, CAST(total AS DOUBLE) / 100 AS total_amount, CAST(covered AS DOUBLE) / 100 AS insurance_covered,
  CAST(paid AS DOUBLE) / 100 AS patient_paid, CAST(outstanding AS DOUBLE) / 100 AS outstanding_amount,
  CAST({_RECOVERY} AS DOUBLE) / 100 AS recovery_rate"""

BILL_FACT = _with(BILLS, DIMS, select=f"""
, changed AS (
  SELECT * REPLACE (CASE WHEN bill_id % 4 = 0 THEN 'Paid' ELSE status END AS status,
                    paid + CASE WHEN bill_id % 6 = 0 THEN outstanding ELSE 0 END AS paid,
                    CASE WHEN bill_id % 6 = 0 THEN 0 ELSE outstanding END AS outstanding) FROM bills),
f1 AS (
  SELECT *, row_number() OVER (ORDER BY bill_id) AS billing_key
  FROM bills JOIN k_patient USING (patient_id) JOIN k_doctor USING (doctor_id) JOIN k_treatment USING (treatment_id)
       JOIN k_insurance USING (insurance_id) WHERE date_key BETWEEN 19960101 AND 19981231),
updated AS (
  SELECT f1.* REPLACE (c.status AS status, c.paid AS paid, c.outstanding AS outstanding),
         f1.status <> c.status OR f1.paid <> c.paid OR f1.outstanding <> c.outstanding AS moved
  FROM f1 JOIN changed c USING (bill_id)),
added AS (
  SELECT *, (SELECT count(*) FROM f1) + row_number() OVER (ORDER BY bill_id) AS billing_key
  FROM changed JOIN k_patient USING (patient_id) JOIN k_doctor USING (doctor_id) JOIN k_treatment USING (treatment_id)
       JOIN k_insurance USING (insurance_id)
  WHERE date_key >= 19960101 AND bill_id NOT IN (SELECT bill_id FROM f1))
SELECT {_BILL_OUT}, CASE WHEN moved THEN '1999-07-01 00:00:00' ELSE '1998-07-01 00:00:00' END AS dwh_load_date FROM updated
UNION ALL SELECT {_BILL_OUT}, '1999-07-01 00:00:00' FROM added""")


# A whole run, twice ------------------------------------------------------------------------------

def _differ(names: dict[str, str]) -> str:
    return " OR ".join(f"coalesce(x.{c}, {blank}) <> coalesce(y.{c}, {blank})" for c, blank in names.items())


def _versions(name: str, table: str, id_col: str, tracked: dict[str, str]) -> str:
    """<name>1 and <name>2 (both loads), <name>_changes and <name>_dim (all versions, with key)."""
    loads = ", ".join(f"{name}{n} AS MATERIALIZED (SELECT * RENAME ({id_col} AS id) FROM ("
                      + _clean(table, load=n).replace("2024 - year", f"{year} - year") + "))" for n, year in ((1, 1995), (2, 1998)))
    ranked = f"{name}_old AS (SELECT *, row_number() OVER (ORDER BY id) AS key FROM {name}1)"
    changes = f"{name}_changes AS (SELECT x.id FROM {name}1 x JOIN {name}2 y ON x.id = y.id WHERE {_differ(tracked)})"
    return f"""{loads}, {ranked}, {changes}, {name}_dim AS (
  SELECT *, '1995-01-01' AS effective_date, CASE WHEN id IN (SELECT id FROM {name}_changes) THEN '1998-07-01' END AS end_date,
         id NOT IN (SELECT id FROM {name}_changes) AS is_current, '1998-07-01 00:00:00' AS dwh_load_date FROM {name}_old
  UNION ALL BY NAME
  SELECT *, (SELECT count(*) FROM {name}1) + row_number() OVER (ORDER BY id) AS key, '1998-07-01' AS effective_date, NULL AS end_date,
         true AS is_current, '1999-07-01 00:00:00' AS dwh_load_date FROM {name}2
  WHERE id NOT IN (SELECT id FROM {name}1) OR id IN (SELECT id FROM {name}_changes))"""


def _keyed(name: str, table: str, id_col: str) -> str:
    """Keys of a dimension that both loads deliver alike."""
    return f"{name}_dim AS MATERIALIZED (SELECT {id_col} AS id, row_number() OVER (ORDER BY {id_col}) AS key, true AS is_current FROM ({_clean(table)}))"


def _loaded(name: str, table: str, id_col: str, day: str, dims: dict[str, str], tracked: dict[str, str]) -> str:
    """<name>_fact: the fact after both loads, with fact_key and dwh_load_date."""
    def found(load: int) -> str:
        keys = {**dims} if load == 2 else {d: i for d, i in dims.items()}
        joins = " ".join(f"JOIN (SELECT id AS {d}_id_, key AS {d}_key FROM {d}_{'old' if load == 1 and d in ('p', 'd') else 'dim'} "
                         + ("" if load == 1 and d in ("p", "d") else "WHERE is_current") + f") {d}k ON {d}_id_ = {i}" for d, i in keys.items())
        return (f"SELECT s.*, CAST(strftime(CAST({day} AS DATE), '%Y%m%d') AS INT) AS date_key, {', '.join(f'{d}_key' for d in dims)} "
                f"FROM {name}{load} s {joins} WHERE {day} BETWEEN '1995-01-01' AND '2002-12-31'")

    moved = f"(y.{id_col} IS NOT NULL AND ({_differ(tracked)}))"
    taken = ", ".join(f"CASE WHEN {moved} THEN y.{c} ELSE x.{c} END AS {c}" for c in tracked)
    return f"""{name}1 AS MATERIALIZED ({_clean(table, load=1)}), {name}2 AS MATERIALIZED ({_clean(table, load=2)}),
{name}_first AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {id_col}) AS fact_key FROM ({found(1)})),
{name}_fact AS (
  SELECT x.* REPLACE ({taken}), CASE WHEN {moved} THEN '1999-07-01 00:00:00' ELSE '1998-07-01 00:00:00' END AS dwh_load_date
  FROM {name}_first x LEFT JOIN {name}2 y ON x.{id_col} = y.{id_col}
  UNION ALL BY NAME
  SELECT *, (SELECT count(*) FROM {name}_first) + row_number() OVER (ORDER BY {id_col}) AS fact_key, '1999-07-01 00:00:00' AS dwh_load_date
  FROM ({found(2)}) WHERE {id_col} NOT IN (SELECT {id_col} FROM {name}_first))"""


def _content(table: str, source: str, columns: str) -> str:
    parts = ", '|', ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns.split(", "))
    return f"SELECT '{table}' AS tbl, concat({parts}) AS content FROM {source}"


def _amount(c: str, kind: str) -> str:
    return f"CAST({c} AS {kind})"


_CENTS = {c: f"CAST({c} * 100 AS HUGEINT)" for c in ("patient_paid", "insurance_covered", "total_amount")}
_TWICE_RECOVERY = (f"CASE WHEN total_amount > 0 THEN CAST((20000 * ({_CENTS['patient_paid']} + {_CENTS['insurance_covered']}) + {_CENTS['total_amount']}) "
                   f"// (2 * {_CENTS['total_amount']}) AS DECIMAL(18,0)) * 0.01 ELSE 0 END")
TWO_LOADS = "WITH " + ",\n".join((
    _versions("p", "patients", "patient_id", {"insurance_status": "''", "city": "''", "country": "''"}),
    _versions("d", "doctors", "doctor_id", {"specialization": "''", "department_id": "0", "status": "''"}),
    _keyed("dep", "departments", "department_id"), _keyed("t", "treatments", "treatment_id"),
    _keyed("i", "insurance_providers", "insurance_id"),
    _loaded("a", "appointments", "appointment_id", "appointment_date",
            {"p": "patient_id", "d": "doctor_id", "dep": "department_id", "t": "treatment_id"},
            {"status": "''", "duration_minutes": "-1", "consultation_fee": "-1"}),
    _loaded("b", "bills", "bill_id", "bill_date",
            {"p": "patient_id", "d": "doctor_id", "t": "treatment_id", "i": "insurance_id"},
            {"payment_status": "''", "total_amount": "-1", "insurance_covered": "-1", "patient_paid": "-1", "outstanding_amount": "-1"}),
    "b_money AS (SELECT * REPLACE (" + ", ".join(f"CAST({c} AS DECIMAL(18,2)) AS {c}" for c in (
        "total_amount", "insurance_covered", "patient_paid", "outstanding_amount")) + ") FROM b_fact)",
)) + "\n" + "\nUNION ALL ".join((
    _content("dim_patient", "p_dim", "key, id, first_name, last_name, full_name, gender, birth_date, age, blood_type, city, country, "
             "insurance_status, registration_date, effective_date, end_date, is_current, dwh_load_date"),
    _content("dim_doctor", "d_dim", "key, id, first_name, last_name, full_name, specialization, department_id, qualification, hire_date, "
             "status, effective_date, end_date, is_current, dwh_load_date"),
    _content("fact_appointments", "(SELECT * REPLACE (CAST(consultation_fee AS DECIMAL(10,2)) AS consultation_fee) FROM a_fact)",
             "fact_key, appointment_id, date_key, p_key, d_key, dep_key, t_key, appointment_time, status, duration_minutes, "
             "consultation_fee, dwh_load_date"),
    _content("fact_billing", f"(SELECT *, CAST({_TWICE_RECOVERY} AS DECIMAL(10,2)) AS recovery_rate FROM b_money)",
             "fact_key, bill_id, appointment_id, date_key, p_key, d_key, t_key, i_key, payment_status, total_amount, insurance_covered, "
             "patient_paid, outstanding_amount, recovery_rate, dwh_load_date"),
))


def _misses(fact: str, cte: str, lookups: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{column}' AS lookup, count(*) AS missing_rows, count(DISTINCT coalesce(CAST({column} AS VARCHAR), 'none')) "
        f"AS missing_ids, '{fact}' AS fact FROM {cte} WHERE {column} IS NULL OR {column} NOT IN ({known})"
        for column, known in lookups.items())


_KNOWN = {"date_key": "SELECT date_key FROM dates WHERE date_key >= 19960101",
          **{f"{n}_id": f"SELECT {n}_id FROM k_{n}" for n in ("patient", "doctor", "department", "treatment", "insurance")}}
_VISIT_IDS = ("date_key", "patient_id", "doctor_id", "department_id", "treatment_id")
_BILL_IDS = ("date_key", "patient_id", "doctor_id", "treatment_id", "insurance_id")

MISSES = _with(VISITS, BILLS, DATES, DIMS, select=_misses(
    "fact_appointments", "visits", {c: _KNOWN[c] for c in _VISIT_IDS}) + " UNION ALL " + _misses(
    "fact_billing", "bills", {c: _KNOWN[c] for c in _BILL_IDS}))


def _null_keys(cte: str, ids: tuple[str, ...]) -> str:
    return "SELECT " + ", ".join(
        f"(SELECT count(*) FROM {cte} WHERE {c} IS NULL OR {c} NOT IN ({_KNOWN[c]})) AS null_{c.replace('_id', '_key')}"
        for c in ids)


def _broken(cte: str, conditions: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS violations FROM {cte} WHERE {bad}" for name, bad in conditions.items())


_ORPHANS = {"date_key": ("date_key", _KNOWN["date_key"]),
            "patient_key": ("patient_id", "SELECT c_custkey FROM customer WHERE c_nationkey <> 9"),
            "doctor_key": ("doctor_id", "SELECT s_suppkey FROM supplier"),
            "department_key": ("department_id", "SELECT n_nationkey FROM nation"),
            "treatment_key": ("treatment_id", "SELECT p_partkey FROM part WHERE p_brand <> 'Brand#9'")}

ORACLES: dict[str, str] = {
    "monthly_appointments": MONTHLY,
    "doctor_performance": DOCTORS,
    "department_summary": DEPARTMENTS,
    "billing_recovery": RECOVERY,
    "patient_analysis": PATIENTS,
    "patient_analysis_exact": PATIENTS_EXACT,
    "monthly_appointments_marts": MONTHLY,
    "department_summary_marts": DEPARTMENTS,
    "dim_date": CALENDAR,
    **{f"clean_{table}": _clean(table) for table in RAW},
    "reject_rows": _ALL_REJECTS,
    "reject_counts": f"SELECT source_table, rejection_reason, count(*) AS count FROM ({_ALL_REJECTS}) AS r GROUP BY 1, 2",
    "silver_row_counts": " UNION ALL ".join(
        f"SELECT 'silver.{t}' AS tbl, count(*) AS rows FROM ({_clean(t)}) AS c" for t in RAW),
    "dedup_lineitem": _with(ITEMS, select="SELECT * FROM items"),
    **{f"bronze_{table}_csv": f"SELECT *, CAST(NULL AS VARCHAR) AS malformed_line, '{table}.csv' AS dwh_source, "
                              f"'1998-07-01 00:00:00' AS dwh_load_date FROM ({untidy_sql(table)}) AS raw" for table in RAW},
    "warehouse_load": WAREHOUSE,
    "warehouse_two_loads": TWO_LOADS,
    "surrogate_keys": "SELECT o_orderkey * 1000003 - 5 AS id, 100 + row_number() OVER (ORDER BY o_orderkey) AS order_key "
                      "FROM orders",
    "scd1_treatments": SCD1_TREATMENTS,
    "scd1_departments": SCD1_DEPARTMENTS,
    "scd1_insurance": SCD1_INSURANCE,
    "scd2_patients": SCD2_PATIENTS,
    "scd2_doctors": SCD2_DOCTORS,
    "scd2_event_history": EVENT_HISTORY,
    "point_in_time_lookup": POINT_IN_TIME,
    "fact_appointments_upsert": VISIT_FACT,
    "fact_billing_upsert": BILL_FACT,
    "fact_load_misses": MISSES,
    "dq_row_counts": _with(VISITS, BILLS, DATES, select="""
SELECT 'gold.dim_date' AS tbl, count(*) AS rows FROM dates UNION ALL SELECT 'gold.dim_patient', count(*) FROM customer
UNION ALL SELECT 'gold.dim_doctor', count(*) FROM supplier UNION ALL SELECT 'gold.dim_department', count(*) FROM nation
UNION ALL SELECT 'gold.dim_treatment', count(*) FROM part UNION ALL SELECT 'gold.dim_insurance', count(*) FROM region
UNION ALL SELECT 'gold.fact_appointments', count(*) FROM visits
UNION ALL SELECT 'gold.fact_billing', count(*) FROM bills WHERE insurance_id IS NOT NULL"""),
    "dq_null_keys_appointments": _with(VISITS, DATES, DIMS, select=_null_keys("visits", _VISIT_IDS)),
    "dq_null_keys_billing": _with(BILLS, DATES, DIMS, select=_null_keys("bills", _BILL_IDS)),
    "dq_invalid_visits": _with(VISITS, select="""
SELECT CAST(sum(CASE WHEN fee - 2000 < 0 THEN 1 ELSE 0 END) AS BIGINT) AS negative_fees,
       CAST(sum(CASE WHEN minutes - 3 <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_duration FROM visits"""),
    "dq_invalid_bills": _with(BILLS, select="""
SELECT CAST(sum(CASE WHEN total <= 500000 THEN 1 ELSE 0 END) AS BIGINT) AS zero_total,
       CAST(sum(CASE WHEN outstanding < 1000 THEN 1 ELSE 0 END) AS BIGINT) AS negative_outstanding,
       CAST(sum(CASE WHEN covered < 2000 THEN 1 ELSE 0 END) AS BIGINT) AS negative_covered
FROM bills WHERE insurance_id IS NOT NULL"""),
    "dq_several_current": "SELECT c_custkey AS patient_id, CAST(2 AS BIGINT) AS current_rows FROM customer WHERE c_nationkey % 5 = 3",
    "dq_several_current_doctors": "SELECT s_suppkey AS doctor_id, CAST(2 AS BIGINT) AS current_rows FROM supplier WHERE s_suppkey % 7 = 0",
    "not_null_violations_facts": f"WITH a AS ({_clean('appointments')}), b AS ({_clean('bills')}) " + _broken("a", {
        f"appointments_{c}": f"{c} IS NULL" for c in ("appointment_id", "patient_id", "doctor_id", "department_id", "treatment_id",
                                                      "appointment_date")}) + " UNION ALL " + _broken("b", {
        f"bills_{c}": f"{c} IS NULL" for c in ("bill_id", "appointment_id", "patient_id", "doctor_id", "treatment_id", "bill_date",
                                               "total_amount")}),
    "foreign_key_orphans_billing": _with(BILLS, DATES, select=_broken(
        "(SELECT * FROM bills WHERE insurance_id IS NOT NULL) AS b", {
            "date_key": f"date_key NOT IN ({_KNOWN['date_key']})",
            "patient_key": "patient_id NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 9)",
            "doctor_key": "doctor_id NOT IN (SELECT s_suppkey FROM supplier)",
            "treatment_key": "treatment_id NOT IN (SELECT p_partkey FROM part WHERE p_brand <> 'Brand#9')",
            "insurance_key": "insurance_id NOT IN (SELECT r_regionkey FROM region WHERE r_regionkey <> 4)"})),
    "dq_date_range_appointments": _with(VISITS, select="SELECT CAST(min(day) AS VARCHAR) AS earliest_appointment, "
                                        "CAST(max(day) AS VARCHAR) AS latest_appointment FROM visits"),
    "dq_date_range_billing": _with(BILLS, select="SELECT CAST(min(day) AS VARCHAR) AS earliest_bill, "
                                   "CAST(max(day) AS VARCHAR) AS latest_bill FROM bills "
                                   "WHERE insurance_id IS NOT NULL"),
    "primary_key_violations": "SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1",
    "not_null_violations": f"WITH p AS ({_clean('patients')}), d AS ({_clean('doctors')}) " + _broken("p", {
        f"patients_{c}": f"{c} IS NULL" for c in ("patient_id", "first_name", "last_name")}) + " UNION ALL " + _broken("d", {
        f"doctors_{c}": f"{c} IS NULL" for c in ("doctor_id", "department_id")}),
    "check_violations": _with(VISITS, BILLS, select=_broken("visits", {
        "fee_not_negative": "fee < 2000", "duration_positive": "minutes <= 3"}) + " UNION ALL " + _broken(
        "(SELECT * FROM bills WHERE insurance_id IS NOT NULL) AS b", {
            "total_positive": "total <= 500000", "covered_not_negative": "covered < 2000", "paid_not_negative": "paid < 0",
            "outstanding_not_negative": "outstanding < 1000"})),
    "length_violations": f"WITH p AS ({_clean('patients')}) " + _broken("p", {
        "long_first_name": "length(first_name) > 100", "long_full_name": "length(full_name) > 17",
        "long_city": "length(city) > 6", "long_phone": "length(phone) > 30"}),
    "foreign_key_orphans": _with(VISITS, DATES, select=_broken("visits", {
        key: f"{column} NOT IN ({known})" for key, (column, known) in _ORPHANS.items()})),
}
