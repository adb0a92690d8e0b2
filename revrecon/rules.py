"""Fixed values of the domain: lists, thresholds and lookup tables the results depend on."""

from __future__ import annotations

# --- Fixed values: visit stages -------------------------------------------------------------
BILLING_STAGES = ("Review", "Open", "Closed")
OPERATIONAL_STAGES = ("No Show", "Patient Canceled", "Center Canceled", "Not Started")
CANCELED_STAGES = ("Patient Canceled", "Center Canceled")
VALID_STAGES = (
    "Closed",
    "Open",
    "Review",
    "In Progress",
    "Not Started",
    "Patient Canceled",
    "Center Canceled",
    "No Show",
)
# Stages that never count as an uncollected claim.
UNCOLLECTED_EXCLUDED_STAGES = ("Not Started", "Patient Canceled", "Center Canceled")

# --- Fixed values: thresholds ---------------------------------------------------------------
REVIEW_ATTENTION_DAYS = 14
OUTSTANDING_AR_DAYS = 30
OLD_OPEN_DAYS = 90
SNAPSHOT_MAX_AGE_DAYS = 14
COLLECTION_RATE_FLOOR = 70.0
WRITE_OFF_CEILING = 15.0
DEPOSIT_FLAG_PCT = 5.0
LEDGER_FLAG_PCT = 10.0
FLAG_AMOUNT = 500.0
DEPOSIT_HIGH_AMOUNT = 2000.0
LEDGER_HIGH_AMOUNT = 5000.0

# --- Fixed values: receivable age buckets (label, first day, last day or None) ---------------
AGE_BUCKETS = (
    ("31-60 days", 31, 60),
    ("61-90 days", 61, 90),
    ("91-120 days", 91, 120),
    ("120+ days", 121, None),
)

# --- Fixed values: facility names -----------------------------------------------------------
UNKNOWN_FACILITY = "Unknown"

# --- Fixed values: ledger -------------------------------------------------------------------
NON_PATIENT_KEYWORDS = (
    "capital call",
    "transfer",
    "deficit deposit",
    "sublease",
    "loan",
    "owner",
    "contribution",
)
PL_SECTIONS = {"Income": "Income", "Expenses": "Expense"}
PL_CLOSING_LABELS = (
    "Cost of Goods Sold",
    "Gross Profit",
    "Net Income",
    "Total Expenses",
    "Total Income",
    "Net Ordinary Income",
)
PL_KEY_LINES = ("Total for Income", "Total for Expenses", "Net Income", "Contract labor")

# --- Fixed values: causes listed with a flagged month ----------------------------------------
DEPOSIT_CAUSES_LEDGER_HIGH = (
    "Deposits not yet recorded in the visit system",
    "Non-patient deposits (loans, transfers)",
    "Timing difference - payment received before visit closed",
)
DEPOSIT_CAUSES_VISITS_HIGH = (
    "Visit payments not yet deposited",
    "Refunds or chargebacks in the ledger",
    "Credit card processing delays",
)
PL_CAUSES_LEDGER_HIGH = (
    "Insurance payments received but not posted to visits in the visit system",
    "Payments for older visits (before the visit system date range)",
    "Timing difference - ledger records when deposited, the visit system when posted",
)
PL_CAUSES_VISITS_HIGH = (
    "Visit payments not yet reflected in the ledger",
    "Refunds or adjustments in the ledger",
    "Possible data entry discrepancy",
)

# --- Fixed values: column-name patterns of protected health information ----------------------
PHI_PATTERNS = (
    "patient name",
    "patient (first",
    "birth date",
    "dob",
    "office key",
    "practice name",
    "provider profile",
    "provider (first",
)
PHI_KEEP = ("patient account number", "service date")
UNMATCHED = "UNMATCHED"
CLOSE_MATCH = "CLOSE_MATCH"

# --- Fixed values: notes on one-sided records ------------------------------------------------
VISITS_ONLY_NOTE = "In visits but NOT in claims - possible billing delay or data entry issue"
CLAIMS_ONLY_NOTE = "In claims but NOT in visits - UNMATCHED patient or data discrepancy"
