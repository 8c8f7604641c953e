"""Fixed values of the subscriber data model: domains, orders, limits.

These must equal the published data contract for results to agree.
"""

from __future__ import annotations

# --- fixed values: domains -------------------------------------------------
YES_NO = ["Yes", "No"]
GENDERS = ["Female", "Male"]
LINES = ["No phone service", "No", "Yes"]
INTERNET = ["DSL", "Fiber optic", "No"]
ADDON_STATES = ["No internet service", "No", "Yes"]
CONTRACTS = ["Month-to-month", "One year", "Two year"]
PAYMENT_METHODS = [
    "Electronic check",
    "Mailed check",
    "Bank transfer (automatic)",
    "Credit card (automatic)",
]
AUTOMATIC_PAYMENTS = ["Bank transfer (automatic)", "Credit card (automatic)"]

# --- fixed values: columns -------------------------------------------------
KEY = "customerID"
KEY_PATTERN = r"^\d{4}-[A-Z]{5}$"
TARGET = "Churn"
ADDONS = [
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
]
SERVICES = ["PhoneService", "MultipleLines", *ADDONS]
RAW_COLUMNS = [
    "customerID",
    "gender",
    "SeniorCitizen",
    "Partner",
    "Dependents",
    "tenure",
    "PhoneService",
    "MultipleLines",
    "InternetService",
    "OnlineSecurity",
    "OnlineBackup",
    "DeviceProtection",
    "TechSupport",
    "StreamingTV",
    "StreamingMovies",
    "Contract",
    "PaperlessBilling",
    "PaymentMethod",
    "MonthlyCharges",
    "TotalCharges",
    "Churn",
]
NUMERIC_TYPES = {
    "SeniorCitizen": "tinyint",
    "tenure": "smallint",
    "MonthlyCharges": "float",
    "TotalCharges": "float",
}

# --- fixed values: tenure ranges, right-closed -----------------------------
TENURE_UPPER = [12, 24, 48, 72]
TENURE_LABELS = ["0-12m", "13-24m", "25-48m", "49-72m"]

# --- fixed values: encoder blocks ------------------------------------------
NUMERIC = ["tenure", "MonthlyCharges", "TotalCharges"]
DERIVED_NUMERIC = ["services_count", "avg_monthly_spend", "monthly_spend_gap"]
DERIVED_FLAGS = ["has_internet", "has_phone", "auto_payment"]
ORDINAL = {"Contract": CONTRACTS}
DERIVED_ORDINAL = {"tenure_bucket": TENURE_LABELS}
BINARY = {
    "gender": GENDERS,
    "Partner": YES_NO,
    "Dependents": YES_NO,
    "PhoneService": YES_NO,
    "PaperlessBilling": YES_NO,
}
NOMINAL = {
    "MultipleLines": LINES,
    "InternetService": INTERNET,
    **{addon: ADDON_STATES for addon in ADDONS},
    "PaymentMethod": PAYMENT_METHODS,
}

# --- fixed values: audit and scoring ---------------------------------------
SENSITIVE = ["gender", "SeniorCitizen", "Partner", "Dependents"]
IMPACT_RATIO_MIN = 0.80
PARITY_GAP_MAX = 0.10
ODDS_GAP_MAX = 0.10
CALIBRATION_MAX = 0.05
THRESHOLD_GRID = [i / 100 for i in range(5, 96)]
DEFAULT_THRESHOLD = 0.5
TOP_FRACTION = 0.10
