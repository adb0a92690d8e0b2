"""Logical tables: file header text -> column name and kind."""

from __future__ import annotations

MONEY, DATE, TEXT = "money", "date", "text"

# header in the export, column name in this package, kind
VISIT_FIELDS = (
    ("Patient Account Number", "patient_id", TEXT),
    ("Patient", "patient_name", TEXT),
    ("DOS", "dos", DATE),
    ("Visit Stage", "visit_stage", TEXT),
    ("Provider", "provider", TEXT),
    ("Visit Type", "visit_type", TEXT),
    ("Visit Facility", "facility", TEXT),
    ("Primary Insurance Type", "payer_type", TEXT),
    ("Case Primary Insurance", "payer", TEXT),
    ("Referral Source", "referral_source", TEXT),
    ("Last Billed", "last_billed", MONEY),
    ("Primary Allowed", "primary_allowed", MONEY),
    ("Primary Not Allowed", "primary_not_allowed", MONEY),
    ("Primary Insurance Paid", "primary_paid", MONEY),
    ("Secondary Insurance Paid", "secondary_paid", MONEY),
    ("Patient Paid", "patient_paid", MONEY),
    ("Total Paid", "total_paid", MONEY),
    ("Pt. Written Off", "written_off", MONEY),
    ("Pt. Current Balance", "current_balance", MONEY),
    ("Total Pat. Res.", "patient_responsibility", MONEY),
    ("Copay", "copay", MONEY),
    ("Hanging", "hanging", MONEY),
    ("Expected Reimbursement", "expected_reimbursement", MONEY),
    ("Last Remit Date", "last_remit_date", DATE),
)

CLAIM_FIELDS = (
    ("Patient Name (First Last)", "patient_name", TEXT),
    ("Patient Birth Date", "dob", DATE),
    ("Service Date", "service_date", DATE),
    ("First Bill Date", "first_bill_date", DATE),
    ("Office Key and Practice Name", "office", TEXT),
    ("Charges", "charges", MONEY),
    ("Adjustments", "adjustments", MONEY),
    ("Patient Payments", "patient_payments", MONEY),
    ("Insurance Payments", "insurance_payments", MONEY),
    ("Current Balance", "current_balance", MONEY),
)

# position-based: the deposit export has no usable header
DEPOSIT_FIELDS = (
    "account",
    "txn_date",
    "txn_type",
    "num",
    "customer",
    "vendor",
    "memo",
    "cleared",
    "amount",
)

LOAD_LOG_DDL = "table_name string, source_id string, modified timestamp, loaded_at timestamp"

REQUIRED_VISIT_COLUMNS = (
    "patient_id",
    "dos",
    "visit_stage",
    "provider",
    "facility",
    "payer_type",
    "primary_allowed",
    "total_paid",
)
OPTIONAL_VISIT_COLUMNS = (
    "payer",
    "patient_paid",
    "primary_paid",
    "secondary_paid",
    "written_off",
    "visit_type",
    "referral_source",
    "last_billed",
)
METRIC_COLUMNS = (
    "patient_id",
    "dos",
    "visit_stage",
    "provider",
    "facility",
    "payer_type",
    "primary_allowed",
    "patient_paid",
    "primary_paid",
    "secondary_paid",
    "total_paid",
    "written_off",
)
PROFILED_MONEY = (
    "primary_allowed",
    "total_paid",
    "patient_paid",
    "primary_paid",
    "written_off",
    "last_billed",
)
PATIENT_SHEET_COLUMNS = ("Patient Account Number", "Patient", "Date of Birth")
