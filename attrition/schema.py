"""Customer table schema, value domains and feature lists.

Everything in the "fixed values" blocks must equal the values the original
pipeline uses, otherwise encodings, segments and features differ.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Raw customer schema (21 columns, in this order).
# ---------------------------------------------------------------------------
RAW_SCHEMA = T.StructType([
    T.StructField("customer_id", T.StringType(), False),
    T.StructField("gender", T.StringType()),
    T.StructField("senior_citizen", T.IntegerType()),
    T.StructField("partner", T.StringType()),
    T.StructField("dependents", T.StringType()),
    T.StructField("tenure", T.IntegerType()),
    T.StructField("contract", T.StringType()),
    T.StructField("internet_service", T.StringType()),
    T.StructField("online_security", T.StringType()),
    T.StructField("tech_support", T.StringType()),
    T.StructField("online_backup", T.StringType()),
    T.StructField("device_protection", T.StringType()),
    T.StructField("streaming_tv", T.StringType()),
    T.StructField("streaming_movies", T.StringType()),
    T.StructField("phone_service", T.StringType()),
    T.StructField("multiple_lines", T.StringType()),
    T.StructField("paperless_billing", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("monthly_charges", T.DoubleType()),
    T.StructField("total_charges", T.DoubleType()),
    T.StructField("churn", T.IntegerType()),
])
RAW_COLUMNS = [f.name for f in RAW_SCHEMA.fields]
ID_COL = "customer_id"
TARGET = "churn"

# ---------------------------------------------------------------------------
# Add-on service columns counted by num_services.
# ---------------------------------------------------------------------------
SERVICE_COLS = [
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
]

# ---------------------------------------------------------------------------
# Categorical domains.
# ---------------------------------------------------------------------------
INTERNET = ["DSL", "Fiber optic", "No"]
ADDON_VALUES = ["No", "No internet service", "Yes"]
LINES_VALUES = ["No", "No phone service", "Yes"]
PAYMENT_METHODS = [
    "Bank transfer (automatic)",
    "Credit card (automatic)",
    "Electronic check",
    "Mailed check",
]

# ---------------------------------------------------------------------------
# Tenure buckets (right-closed edges, labels).
# ---------------------------------------------------------------------------
TENURE_EDGES = [0, 6, 12, 24, 48, 72]
TENURE_LABELS = ["0-6m", "6-12m", "12-24m", "24-48m", "48+m"]

# ---------------------------------------------------------------------------
# Risk segments (right-closed edges on the probability).
# ---------------------------------------------------------------------------
RISK_LABELS = ["Low Risk", "Medium Risk", "High Risk"]

# ---------------------------------------------------------------------------
# Feature lists of the model matrix.
# ---------------------------------------------------------------------------
# Columns holding text that the binary map turns into 0/1.
BINARY_TEXT_COLS = ["gender", "partner", "dependents", "phone_service", "paperless_billing"]
BINARY_MAP = {"Yes": 1, "No": 0, "Male": 1, "Female": 0}
ORDINAL_MAPS = {"contract": {"Month-to-month": 0, "One year": 1, "Two year": 2}}
OHE_COLS = [
    "internet_service",
    "payment_method",
    "multiple_lines",
    "online_security",
    "online_backup",
    "device_protection",
    "tech_support",
    "streaming_tv",
    "streaming_movies",
    "tenure_bucket",
]

# Declared one-hot domains (sorted as the data-driven fit sorts them;
# tenure_bucket keeps its category order, as the categorical dtype does).
OHE_DOMAINS = {
    "internet_service": sorted(INTERNET),
    "payment_method": sorted(PAYMENT_METHODS),
    "multiple_lines": sorted(LINES_VALUES),
    "online_security": sorted(ADDON_VALUES),
    "online_backup": sorted(ADDON_VALUES),
    "device_protection": sorted(ADDON_VALUES),
    "tech_support": sorted(ADDON_VALUES),
    "streaming_tv": sorted(ADDON_VALUES),
    "streaming_movies": sorted(ADDON_VALUES),
    "tenure_bucket": list(TENURE_LABELS),
}
