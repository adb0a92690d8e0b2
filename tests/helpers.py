"""Small literal tables for the unit tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

VISIT = {
    "row_no": "bigint", "patient_id": "string", "patient_name": "string", "dos": "date", "visit_stage": "string",
    "provider": "string", "facility": "string", "payer_type": "string", "payer": "string", "referral_source": "string",
    "visit_type": "string", "last_billed": "decimal(18,2)", "primary_allowed": "decimal(18,2)",
    "primary_not_allowed": "decimal(18,2)", "primary_paid": "decimal(18,2)", "secondary_paid": "decimal(18,2)",
    "patient_paid": "decimal(18,2)", "total_paid": "decimal(18,2)", "written_off": "decimal(18,2)",
    "current_balance": "decimal(18,2)",
}
CLAIM = {
    "row_no": "bigint", "patient_id": "string", "patient_name": "string", "dob": "date", "service_date": "date",
    "first_bill_date": "date", "office": "string", "charges": "decimal(18,2)", "adjustments": "decimal(18,2)",
    "patient_payments": "decimal(18,2)", "insurance_payments": "decimal(18,2)", "current_balance": "decimal(18,2)",
}


def _table(spark, schema, defaults, rows):
    def value(name, v):
        if v is None:
            return None
        if schema[name].startswith("decimal"):
            return Decimal(str(v))
        return dt.date.fromisoformat(v) if schema[name] == "date" else v

    data = []
    for i, row in enumerate(rows):
        full = {**defaults, "row_no": i + 1, **row}
        data.append(tuple(value(name, full.get(name)) for name in schema))
    return spark.createDataFrame(data, ", ".join(f"{n} {t}" for n, t in schema.items()))


def visits(spark, *rows):
    defaults = {
        "patient_id": "p1", "patient_name": "Doe, Jane", "dos": "2025-09-01", "visit_stage": "Closed", "provider": "A",
        "facility": "North Clinic", "payer_type": "Auto", "payer": "X", "referral_source": "R", "visit_type": "COM PT",
        "last_billed": 100, "primary_allowed": 40, "primary_not_allowed": 60, "primary_paid": 0, "secondary_paid": 0,
        "patient_paid": 0, "total_paid": 0, "written_off": 0, "current_balance": 0,
    }
    return _table(spark, VISIT, defaults, rows)


def claims(spark, *rows):
    defaults = {
        "patient_id": "p1", "patient_name": "JANE DOE", "dob": "1980-01-01", "service_date": "2025-09-01",
        "office": "34 - MAIN OFFICE", "charges": 100, "adjustments": 0, "patient_payments": 0,
        "insurance_payments": 0, "current_balance": 0,
    }
    return _table(spark, CLAIM, defaults, rows)


def as_dicts(df):
    return [r.asDict() for r in df.collect()]
