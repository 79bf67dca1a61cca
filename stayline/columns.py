"""Fixed values of the customer table: columns, levels, names and parameters."""

# Public header name of each column, in file order.
PUBLIC_NAME = {
    "customer_id": "customerID",
    "gender": "gender",
    "senior_citizen": "SeniorCitizen",
    "partner": "Partner",
    "dependents": "Dependents",
    "tenure": "tenure",
    "phone_service": "PhoneService",
    "multiple_lines": "MultipleLines",
    "internet_service": "InternetService",
    "online_security": "OnlineSecurity",
    "online_backup": "OnlineBackup",
    "device_protection": "DeviceProtection",
    "tech_support": "TechSupport",
    "streaming_tv": "StreamingTV",
    "streaming_movies": "StreamingMovies",
    "contract": "Contract",
    "paperless_billing": "PaperlessBilling",
    "payment_method": "PaymentMethod",
    "monthly_charges": "MonthlyCharges",
    "total_charges_raw": "TotalCharges",
    "churn": "Churn",
}

KEY = "customer_id"

NUMERIC = ["tenure", "monthly_charges", "total_charges"]

CATEGORICAL = [
    "gender", "senior_citizen", "partner", "dependents", "phone_service", "multiple_lines",
    "internet_service", "online_security", "online_backup", "device_protection", "tech_support",
    "streaming_tv", "streaming_movies", "contract", "paperless_billing", "payment_method",
]

# Two-level text columns mapped to 0/1.
BINARY = ["gender", "partner", "dependents", "phone_service", "paperless_billing"]
BINARY_CODES = {"Yes": 1, "No": 0, "Male": 1, "Female": 0}

# Columns expanded to one indicator per level.
MULTI_LEVEL = [
    "multiple_lines", "internet_service", "online_security", "online_backup", "device_protection",
    "tech_support", "streaming_tv", "streaming_movies", "contract", "payment_method",
]

ADDONS = [
    "online_security", "online_backup", "device_protection", "tech_support",
    "streaming_tv", "streaming_movies",
]

# Features passed through, in vector order; the indicators and the engineered ones follow.
KEPT_FEATURES = [
    "gender", "senior_citizen", "partner", "dependents", "tenure", "phone_service",
    "paperless_billing", "monthly_charges", "total_charges",
]
ENGINEERED = {
    "avg_monthly_charges": "AvgMonthlyCharges",
    "charge_per_tenure": "ChargePerTenure",
    "has_streaming": "HasStreaming",
    "has_security": "HasSecurity",
    "num_addon_services": "NumAddonServices",
}
SCALED = ["tenure", "MonthlyCharges", "TotalCharges", "AvgMonthlyCharges", "ChargePerTenure"]

CORRELATED = [
    "tenure", "monthly_charges", "total_charges", "senior_citizen", "gender", "partner",
    "dependents", "phone_service", "paperless_billing", "label",
]

CLASSES = ["No", "Yes"]

TENURE_EDGES = [0, 12, 24, 48, 72]
TENURE_LABELS = ["0-12m", "13-24m", "25-48m", "49-72m"]

# Risk tiers: key-figure tiers are closed on the left, chart tiers on the right.
HIGH_RISK, MEDIUM_RISK = 0.7, 0.4
BAND_EDGES = [0.0, 0.3, 0.5, 0.7, 1.0]
RISK_LABELS = ["Very Low (<30%)", "Low (30-50%)", "Medium (50-70%)", "High (≥70%)"]
PRIORITY_LABELS = ["Low Risk", "Watch", "At-Risk", "Critical"]

# Campaign parameters.
COST_SHARE, RETENTION, MEDIUM_WEIGHT, MONTHS = 0.15, 0.35, 0.2, 12

# Weights of the model selection score.
SELECTION_WEIGHTS = {"f1": 0.4, "roc_auc": 0.4, "recall": 0.2}
METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc"]

SEED = 42


def public(name: str) -> str:
    """Feature name of a column."""
    if name == "total_charges":
        return "TotalCharges"
    return ENGINEERED.get(name) or PUBLIC_NAME[name]
