"""Column lists, spelling maps and bounds of the loan-application table."""

from pyspark.sql import types as T

# --- fixed values: the table's columns -------------------------------------
EXPECTED_COLUMNS = [
    "age", "gender", "marital_status", "education", "monthly_salary",
    "employment_type", "years_of_employment", "company_type", "house_type",
    "monthly_rent", "family_size", "dependents", "school_fees", "college_fees",
    "travel_expenses", "groceries_utilities", "other_monthly_expenses",
    "existing_loans", "current_emi_amount", "credit_score", "bank_balance",
    "emergency_fund", "emi_scenario", "requested_amount", "requested_tenure",
    "emi_eligibility", "max_monthly_emi",
]
TARGET_CLASS = "emi_eligibility"
TARGET_AMOUNT = "max_monthly_emi"
REQUEST_COLUMNS = [c for c in EXPECTED_COLUMNS if c not in (TARGET_CLASS, TARGET_AMOUNT)]
KEY_COLUMNS = ["application_id", "customer_id"]

NUMERIC_COLUMNS = [
    "age", "monthly_salary", "years_of_employment", "monthly_rent",
    "family_size", "dependents", "school_fees", "college_fees",
    "travel_expenses", "groceries_utilities", "other_monthly_expenses",
    "current_emi_amount", "credit_score", "bank_balance", "emergency_fund",
    "requested_amount", "requested_tenure", "max_monthly_emi",
]
CATEGORICAL_COLUMNS = [
    "gender", "marital_status", "education", "employment_type",
    "company_type", "house_type", "existing_loans", "emi_scenario",
]
ENCODED_COLUMNS = CATEGORICAL_COLUMNS + ["credit_score_band"]
EXPENSE_COLUMNS = [
    "monthly_rent", "school_fees", "college_fees", "travel_expenses",
    "groceries_utilities", "other_monthly_expenses", "current_emi_amount",
]
ZERO_FILL_COLUMNS = [
    "school_fees", "college_fees", "travel_expenses", "other_monthly_expenses",
    "current_emi_amount", "years_of_employment", "dependents", "emergency_fund",
]
CAP_COLUMNS = [
    "monthly_salary", "bank_balance", "emergency_fund", "requested_amount",
    "current_emi_amount", "school_fees", "college_fees", "travel_expenses",
    "groceries_utilities", "other_monthly_expenses", "monthly_rent",
    "max_monthly_emi",
]
NON_NEGATIVE_COLUMNS = [
    "monthly_rent", "school_fees", "college_fees", "travel_expenses",
    "groceries_utilities", "other_monthly_expenses", "current_emi_amount",
    "emergency_fund", "bank_balance",
]
INTEGER_COLUMNS = ["age", "family_size", "dependents"]
CRITICAL_COLUMNS = ["requested_amount", "requested_tenure"]
TITLE_COLUMNS = ["marital_status", "house_type", "education", "existing_loans"]
FLAGGED_COLUMNS = [
    "credit_score", "bank_balance", "emergency_fund", "education", "monthly_rent",
]
FLAG_COLUMNS = [f"{c}_missing" for c in FLAGGED_COLUMNS]

# --- fixed values: bounds ---------------------------------------------------
DOMAIN_BOUNDS = {
    "age": (18, 80),
    "credit_score": (300, 900),
    "family_size": (1, 20),
    "dependents": (0, 10),
    "years_of_employment": (0, 45),
    "requested_tenure": (1, 360),
}
AUDIT_BOUNDS = {
    "age": (18, 80),
    "credit_score": (300, 900),
    "monthly_salary": (0, None),
    "family_size": (1, 20),
    "dependents": (0, 10),
    "years_of_employment": (0, 45),
    "requested_tenure": (1, 360),
    "monthly_rent": (0, None),
    "bank_balance": (0, None),
    "emergency_fund": (0, None),
    "max_monthly_emi": (0, None),
    "requested_amount": (0, None),
}
NO_CREDIT_SCORE = 300
CAP_PROBABILITIES = (0.01, 0.99)
SALARY_BRACKETS = [
    (20000, "0-20k"), (40000, "20-40k"), (60000, "40-60k"),
    (80000, "60-80k"), (100000, "80-100k"), (None, "100k+"),
]
CREDIT_BANDS = [(599, "Poor"), (649, "Fair"), (749, "Good"), (900, "Excellent")]
AUTO_APPROVE, AUTO_REJECT = 0.85, 0.40
EMI_MIN, EMI_MAX = 500.0, 34750.0
MIN_TRAINING_ROWS, MAX_UPLOAD_ROWS = 1000, 500

# --- fixed values: spellings ------------------------------------------------
CURRENCY_MARKS = ["₹", "Rs", "rs", ",", "%", "$"]
NULL_STRINGS = [
    "nan", "Nan", "NaN", "NAN", "none", "None", "NONE", "null", "Null", "NULL",
    "na", "Na", "NA", "n/a", "N/A", "N/a", "", " ", "--", "-", "?",
]
# text that a CSV reader of the pandas family takes for a missing value
CSV_NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
SUSPICIOUS_LABELS = ["nan", "none", "null", "na", "n/a", "--", "", "unknown"]
HIDDEN_NULLS = [
    "nan", "none", "null", "na", "n/a", "NaN", "None", "Null", "NA", "N/A",
    "Nan", "--", "-", "?", "",
]
GENDER_ABBREVIATIONS = ["M", "F", "m", "f"]
POSITIVE_LABEL = "Eligible"
NEGATIVE_LABELS = ["Not_Eligible", "Not Eligible", "Not_eligible", "Not eligible"]
ACCEPTED_LABELS = [POSITIVE_LABEL] + NEGATIVE_LABELS
RENT_FREE_HOUSES = ["Own", "own", "OWN", "Family", "family", "FAMILY"]
VALUE_MAPS = {
    "gender": {
        "male": "Male", "female": "Female", "MALE": "Male", "FEMALE": "Female",
        "M": "Male", "F": "Female", "m": "Male", "f": "Female",
    },
    "employment_type": {
        "self-employed": "Self-Employed", "Self-employed": "Self-Employed",
        "SELF-EMPLOYED": "Self-Employed", "self employed": "Self-Employed",
        "Self Employed": "Self-Employed",
    },
    "company_type": {
        "MNC": "Mnc", "mnc": "Mnc", "mid-size": "Mid-Size", "Mid-size": "Mid-Size",
        "MID-SIZE": "Mid-Size", "midsize": "Mid-Size", "Mid Size": "Mid-Size",
        "large indian": "Large Indian", "LARGE INDIAN": "Large Indian",
    },
    "emi_scenario": {
        "Personal Loan EMI": "Personal Loan Emi",
        "Home Appliances EMI": "Home Appliances Emi",
        "Education EMI": "Education Emi",
        "Vehicle EMI": "Vehicle Emi",
        "E-commerce Shopping EMI": "E-Commerce Shopping Emi",
        "E-Commerce Shopping EMI": "E-Commerce Shopping Emi",
        "e-commerce shopping emi": "E-Commerce Shopping Emi",
    },
    "existing_loans": {
        "yes": "Yes", "no": "No", "YES": "Yes", "NO": "No", "y": "Yes", "n": "No",
    },
    "marital_status": {
        "married": "Married", "single": "Single",
        "MARRIED": "Married", "SINGLE": "Single",
    },
    "house_type": {
        "rented": "Rented", "own": "Own", "family": "Family",
        "RENTED": "Rented", "OWN": "Own", "FAMILY": "Family",
    },
}
ALLOWED_VALUES = {
    "gender": ["Male", "Female"],
    "marital_status": ["Married", "Single"],
    "house_type": ["Own", "Rented", "Family"],
    "existing_loans": ["Yes", "No"],
    "employment_type": ["Private", "Government", "Self-Employed"],
}

# --- fixed values: engineered features --------------------------------------
ENGINEERED_FEATURES = [
    "expense_ratio", "emi_burden_ratio", "requested_emi_monthly",
    "requested_emi_ratio", "total_emi_ratio", "disposable_income",
    "savings_ratio", "emergency_months",
    "credit_score_band", "credit_score_ord",
    "loan_to_income_ratio", "loan_to_balance_ratio",
    "credit_x_income", "employment_stability",
    "has_emergency_fund", "is_renter", "high_credit", "low_expense_burden",
    "log_bank_balance", "log_monthly_salary", "log_requested_amount",
]
ENGINEERED_NUMERIC = [c for c in ENGINEERED_FEATURES if c != "credit_score_band"]
DRIFT_ENGINEERED = [
    "expense_ratio", "emi_burden_ratio", "loan_to_income_ratio", "credit_score_band",
]
CORRELATION_COLUMNS = [c for c in NUMERIC_COLUMNS if c != TARGET_AMOUNT] + [
    TARGET_CLASS, TARGET_AMOUNT,
]
DISTRIBUTION_COLUMNS = [
    "age", "monthly_salary", "credit_score", "bank_balance", "emergency_fund",
    "years_of_employment", "requested_amount", "requested_tenure", "monthly_rent",
]
SIGNIFICANCE_COLUMNS = [
    "credit_score", "monthly_salary", "bank_balance", "age", "years_of_employment",
]
APPROVAL_CATEGORIES = [
    "gender", "marital_status", "education", "employment_type", "house_type",
    "company_type",
]

# --- fixed values: serving --------------------------------------------------
CACHE_PREFIX = "emi:features"
CACHE_TTL_SECONDS = 86400
CACHE_HASH_CHARS = 16
LATENCY_BOUNDS = [0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0]
HIT_RATE_STEPS = [(0.8, "green"), (0.5, "yellow"), (0.0, "red")]

_REQUEST_DOUBLES = set(NUMERIC_COLUMNS) - {"age", "family_size", "dependents"}
REQUEST_SCHEMA = T.StructType(
    [T.StructField("customer_id", T.StringType())]
    + [
        T.StructField(
            c,
            T.DoubleType() if c in _REQUEST_DOUBLES
            else T.IntegerType() if c in INTEGER_COLUMNS
            else T.StringType(),
        )
        for c in REQUEST_COLUMNS
    ]
)
EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])
