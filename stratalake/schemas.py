"""Declared tables: raw columns, typed schemas, code labels, tracked attributes."""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Holds the whole line of a raw row that has too few or too many fields.
MALFORMED = "malformed_line"

# Raw columns of each delimited file, in file order.
RAW = {
    "patients": ["patient_id", "first_name", "last_name", "gender", "birth_date", "blood_type", "city", "country",
                 "phone", "email", "registration_date", "insurance_status"],
    "doctors": ["doctor_id", "first_name", "last_name", "specialization", "department_id", "qualification",
                "hire_date", "status", "phone"],
    "departments": ["department_id", "department_name", "building", "floor", "head_doctor", "established_date"],
    "treatments": ["treatment_id", "treatment_name", "treatment_type", "diagnosis_code", "diagnosis_name",
                   "standard_cost", "duration_minutes"],
    "insurance_providers": ["insurance_id", "provider_name", "plan_type", "coverage_pct", "max_coverage_amount",
                            "status"],
    "appointments": ["appointment_id", "patient_id", "doctor_id", "department_id", "treatment_id",
                     "appointment_date", "appointment_time", "duration_minutes", "status", "consultation_fee",
                     "notes"],
    "bills": ["bill_id", "appointment_id", "patient_id", "doctor_id", "insurance_id", "treatment_id", "bill_date",
              "total_amount", "insurance_covered", "patient_paid", "outstanding_amount", "payment_status"],
}

# Code labels. Codes are compared after trimming and upper-casing.
GENDER = {"Male": ["M", "MALE"], "Female": ["F", "FEMALE"]}
INSURED = {"Active": ["YES", "Y", "1", "ACTIVE"]}
ACTIVE = {"Active": ["ACTIVE", "A"]}
VISIT_STATUS = {"Completed": ["COMPLETED", "COMPLETE"], "Scheduled": ["SCHEDULED"],
                "Cancelled": ["CANCELLED", "CANCELED"], "No-Show": ["NO-SHOW", "NOSHOW"]}
PAYMENT_STATUS = {"Paid": ["PAID"], "Partial": ["PARTIAL"], "Pending": ["PENDING"], "Overdue": ["OVERDUE"]}

# Attributes whose change matters, with the value that stands for NULL.
PATIENT_TRACKED = {"insurance_status": "", "city": "", "country": ""}
DOCTOR_TRACKED = {"specialization": "", "department_id": 0, "status": ""}
VISIT_MUTABLE = {"appointment_status": "", "duration_minutes": -1, "consultation_fee": -1}
BILL_MUTABLE = {"payment_status": "", "total_amount": -1, "insurance_covered": -1, "patient_paid": -1,
                "outstanding_amount": -1}

# The declared tables. Business ids are BIGINT here and take the type that a run asks for.
SILVER = {
    "patients": """
        patient_id BIGINT NOT NULL, first_name VARCHAR(100) NOT NULL, last_name VARCHAR(100) NOT NULL,
        full_name VARCHAR(200), gender VARCHAR(20), birth_date DATE, age INT, blood_type VARCHAR(10),
        city VARCHAR(100), country VARCHAR(100), phone VARCHAR(30), email VARCHAR(150), registration_date DATE,
        insurance_status VARCHAR(20), dwh_load_date TIMESTAMP""",
    "doctors": """
        doctor_id BIGINT NOT NULL, first_name VARCHAR(100) NOT NULL, last_name VARCHAR(100) NOT NULL,
        full_name VARCHAR(200), specialization VARCHAR(100), department_id BIGINT, qualification VARCHAR(100),
        hire_date DATE, status VARCHAR(20), phone VARCHAR(30), dwh_load_date TIMESTAMP""",
    "departments": """
        department_id BIGINT NOT NULL, department_name VARCHAR(100) NOT NULL, building VARCHAR(50),
        floor VARCHAR(20), head_doctor VARCHAR(100), established_date DATE, dwh_load_date TIMESTAMP""",
    "treatments": """
        treatment_id BIGINT NOT NULL, treatment_name VARCHAR(150) NOT NULL, treatment_type VARCHAR(100),
        diagnosis_code VARCHAR(20), diagnosis_name VARCHAR(150), standard_cost DECIMAL(10,2),
        duration_minutes INT, dwh_load_date TIMESTAMP""",
    "insurance_providers": """
        insurance_id BIGINT NOT NULL, provider_name VARCHAR(150) NOT NULL, plan_type VARCHAR(50),
        coverage_pct DECIMAL(5,2), max_coverage_amount DECIMAL(12,2), status VARCHAR(20),
        dwh_load_date TIMESTAMP""",
    "appointments": """
        appointment_id BIGINT NOT NULL, patient_id BIGINT NOT NULL, doctor_id BIGINT NOT NULL,
        department_id BIGINT NOT NULL, treatment_id BIGINT NOT NULL, appointment_date DATE NOT NULL,
        appointment_time VARCHAR(20), duration_minutes INT, status VARCHAR(30), consultation_fee DECIMAL(10,2),
        notes VARCHAR(500), dwh_load_date TIMESTAMP""",
    "bills": """
        bill_id BIGINT NOT NULL, appointment_id BIGINT NOT NULL, patient_id BIGINT NOT NULL,
        doctor_id BIGINT NOT NULL, insurance_id BIGINT, treatment_id BIGINT NOT NULL, bill_date DATE NOT NULL,
        total_amount DECIMAL(12,2) NOT NULL, insurance_covered DECIMAL(12,2), patient_paid DECIMAL(12,2),
        outstanding_amount DECIMAL(12,2), payment_status VARCHAR(30), dwh_load_date TIMESTAMP""",
    "rejected_rows": """
        rejected_id BIGINT NOT NULL, source_table VARCHAR(50) NOT NULL, rejection_reason VARCHAR(300) NOT NULL,
        raw_row_json STRING, rejected_at TIMESTAMP NOT NULL""",
}
GOLD = {
    "dim_date": """
        date_key INT NOT NULL, full_date DATE NOT NULL, year INT, quarter INT, quarter_name VARCHAR(5),
        month INT, month_name VARCHAR(20), day_of_month INT, day_of_week INT, day_name VARCHAR(20),
        week_number INT, is_weekend BOOLEAN""",
    "dim_department": """
        department_key BIGINT NOT NULL, department_id BIGINT NOT NULL, department_name VARCHAR(100) NOT NULL,
        building VARCHAR(50), floor VARCHAR(20), head_doctor VARCHAR(100), established_date DATE,
        dwh_load_date TIMESTAMP""",
    "dim_treatment": """
        treatment_key BIGINT NOT NULL, treatment_id BIGINT NOT NULL, treatment_name VARCHAR(150) NOT NULL,
        treatment_type VARCHAR(100), diagnosis_code VARCHAR(20), diagnosis_name VARCHAR(150),
        standard_cost DECIMAL(10,2), duration_minutes INT, dwh_load_date TIMESTAMP""",
    "dim_insurance": """
        insurance_key BIGINT NOT NULL, insurance_id BIGINT NOT NULL, provider_name VARCHAR(150) NOT NULL,
        plan_type VARCHAR(50), coverage_pct DECIMAL(5,2), max_coverage_amount DECIMAL(12,2),
        status VARCHAR(20), dwh_load_date TIMESTAMP""",
    "dim_patient": """
        patient_key BIGINT NOT NULL, patient_id BIGINT NOT NULL, first_name VARCHAR(100) NOT NULL,
        last_name VARCHAR(100) NOT NULL, full_name VARCHAR(200), gender VARCHAR(20), birth_date DATE, age INT,
        blood_type VARCHAR(10), city VARCHAR(100), country VARCHAR(100), insurance_status VARCHAR(20),
        registration_date DATE, effective_date DATE NOT NULL, end_date DATE, is_current BOOLEAN NOT NULL,
        dwh_load_date TIMESTAMP""",
    "dim_doctor": """
        doctor_key BIGINT NOT NULL, doctor_id BIGINT NOT NULL, first_name VARCHAR(100) NOT NULL,
        last_name VARCHAR(100) NOT NULL, full_name VARCHAR(200), specialization VARCHAR(100),
        department_id BIGINT, qualification VARCHAR(100), hire_date DATE, status VARCHAR(20),
        effective_date DATE NOT NULL, end_date DATE, is_current BOOLEAN NOT NULL, dwh_load_date TIMESTAMP""",
    "fact_appointments": """
        appointment_key BIGINT NOT NULL, appointment_id BIGINT NOT NULL, date_key INT NOT NULL,
        patient_key BIGINT NOT NULL, doctor_key BIGINT NOT NULL, department_key BIGINT NOT NULL,
        treatment_key BIGINT NOT NULL, appointment_time VARCHAR(20), appointment_status VARCHAR(30),
        duration_minutes INT, consultation_fee DECIMAL(10,2), dwh_load_date TIMESTAMP""",
    "fact_billing": """
        billing_key BIGINT NOT NULL, bill_id BIGINT NOT NULL, appointment_id BIGINT NOT NULL,
        date_key INT NOT NULL, patient_key BIGINT NOT NULL, doctor_key BIGINT NOT NULL,
        treatment_key BIGINT NOT NULL, insurance_key BIGINT NOT NULL, payment_status VARCHAR(30),
        total_amount DECIMAL(18,2) NOT NULL, insurance_covered DECIMAL(18,2) NOT NULL,
        patient_paid DECIMAL(18,2) NOT NULL, outstanding_amount DECIMAL(18,2) NOT NULL,
        recovery_rate DECIMAL(10,2), dwh_load_date TIMESTAMP""",
}
BUSINESS_IDS = {"patient_id", "doctor_id", "department_id", "treatment_id", "insurance_id", "appointment_id", "bill_id"}

BRONZE_TABLES = tuple(RAW)
SILVER_TABLES = tuple(SILVER)
GOLD_TABLES = tuple(GOLD)


@cache
def declared(table: str) -> T.StructType:
    """The table as declared, text lengths and required columns included."""
    return T.StructType.fromDDL(SILVER.get(table) or GOLD[table])


def columns(table: str) -> list[str]:
    return declared(table).names


def required(table: str) -> list[str]:
    return [f.name for f in declared(table) if not f.nullable]


def lengths(table: str) -> dict[str, int]:
    return {f.name: f.dataType.length for f in declared(table) if isinstance(f.dataType, T.VarcharType)}


def schema(table: str, id_type: str = "int") -> T.StructType:
    """The stored schema, in which every column may be NULL and text has any length, since counters check both while a
    table is written; business ids are ``int`` unless a larger source asks for ``bigint``."""
    def kind(field: T.StructField) -> T.DataType:
        if field.name in BUSINESS_IDS:
            return T.LongType() if id_type == "bigint" else T.IntegerType()
        return T.StringType() if isinstance(field.dataType, T.VarcharType) else field.dataType

    return T.StructType([T.StructField(f.name, kind(f)) for f in declared(table)])


def bronze_schema(table: str) -> T.StructType:
    """All text, the unreadable line if there was one, and the audit columns."""
    text = [*RAW[table], MALFORMED, "dwh_source"]
    return T.StructType.fromDDL(", ".join([*(f"{c} string" for c in text), "dwh_load_date timestamp"]))


def layer_schemas(layer: str, id_type: str = "int") -> dict[str, T.StructType]:
    if layer == "bronze":
        return {name: bronze_schema(name) for name in BRONZE_TABLES}
    return {name: schema(name, id_type) for name in (SILVER_TABLES if layer == "silver" else GOLD_TABLES)}


def empty(spark: SparkSession, table: str, id_type: str = "int") -> DataFrame:
    """A table that has no snapshot yet (SNK-4)."""
    return spark.createDataFrame([], schema(table, id_type)).limit(0)  # the limit tells Spark that there are no rows


def conform(df: DataFrame, table: str, id_type: str = "int") -> DataFrame:
    """The declared columns in the declared order and types (SNK-1)."""
    return df.to(schema(table, id_type))
