"""Names, thresholds, patterns and replacement texts of the data contract.

These are fixed values: results are only right if they are exactly these. Everything else in the package takes them
as defaults and can be given others.
"""

# Keys
CUSTOMER = "Customer_ID"
SNAPSHOT = "snapshot_date"
LOAN = "loan_id"
CUSTOMER_KEY = (CUSTOMER, SNAPSHOT)
LOAN_KEY = (LOAN, SNAPSHOT)

# Raw files and the bronze tables they become
RAW_FILES = {
    "feature_clickstream.csv": "clickstream",
    "feature_attributes.csv": "attributes",
    "feature_financials.csv": "financials",
    "lms_loan_daily.csv": "loan_daily",
}

# Column groups
CLICK_FEATURES = tuple(f"fe_{i}" for i in range(1, 21))
ATTRIBUTE_COLUMNS = (CUSTOMER, "Age", "Occupation", SNAPSHOT)
FINANCIAL_AMOUNTS = (
    "Annual_Income",
    "Monthly_Inhand_Salary",
    "Changed_Credit_Limit",
    "Outstanding_Debt",
    "Credit_Utilization_Ratio",
    "Total_EMI_per_month",
    "Amount_invested_monthly",
    "Monthly_Balance",
)
FINANCIAL_COUNTS = (
    "Num_Bank_Accounts",
    "Num_Credit_Card",
    "Interest_Rate",
    "Num_of_Loan",
    "Delay_from_due_date",
    "Num_of_Delayed_Payment",
    "Num_Credit_Inquiries",
)
LOAN_DATES = ("loan_start_date", SNAPSHOT)
LOAN_COUNTS = ("tenure", "installment_num", "loan_amt")
LOAN_AMOUNTS = ("due_amt", "paid_amt", "overdue_amt", "balance")
LOAN_COLUMNS = (
    LOAN,
    CUSTOMER,
    "loan_start_date",
    "tenure",
    "installment_num",
    "loan_amt",
    "due_amt",
    "paid_amt",
    "overdue_amt",
    "balance",
    SNAPSHOT,
)

# Format patterns
INTEGER_PATTERN = r"^-?\d+$"
INTEGER_DIGITS_PATTERN = r"^-?[0-9]+$"
DECIMAL_PATTERN = r"^\d+(\.\d+)?$"
DECIMAL_DIGITS_PATTERN = r"^[0-9]+(\.[0-9]+)?$"
DATE_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
BLANK_PATTERN = r"^\s*$"
PAYMENT_BEHAVIOUR_PATTERN = r"^[a-zA-Z0-9_\s-]+$"
YEARS_PATTERN = r"(\d+)\s*Years?"
MONTHS_PATTERN = r"(\d+)\s*Months?"

# Replacement texts
UNKNOWN = "unknown"
UNKNOWN_MIN_PAYMENT = "Unknown"
NOT_MEASURED_CODE = "NM"
NOT_MEASURED = "Not Measured"
NOT_SPECIFIED = "Not Specified"
OTHER = "other"
PLACEHOLDER = "_"

# Attribute features
AGE_RANGE = (18, 90)

# Click-stream features
SIGMAS = 3

# Financial features
FINANCIAL_CAPS = {
    "Annual_Income": 2000000,
    "Num_of_Loan": 20,
    "Num_Bank_Accounts": 20,
    "Num_Credit_Inquiries": 30,
}
IMPUTED_COLUMNS = ("Amount_invested_monthly", "Num_of_Loan", "Monthly_Balance")
UNKNOWN_FLAGS = {
    "credit_mix_unknown_flag": ("Credit_Mix", UNKNOWN),
    "payment_behaviour_unknown_flag": ("Payment_Behaviour", UNKNOWN),
    "payment_min_not_measured_flag": ("Payment_of_Min_Amount", NOT_MEASURED),
}
FINANCIAL_RATIOS = {
    "emi_to_income_ratio": ("Total_EMI_per_month", "Monthly_Inhand_Salary"),
    "debt_to_income_ratio": ("Outstanding_Debt", "Annual_Income"),
    "investment_to_income_ratio": ("Amount_invested_monthly", "Monthly_Inhand_Salary"),
    "loan_per_card_ratio": ("Num_of_Loan", "Num_Credit_Card"),
    "credit_inquiries_per_account": ("Num_Credit_Inquiries", "Num_Bank_Accounts"),
    "credit_limit_change_ratio": ("Changed_Credit_Limit", "Monthly_Inhand_Salary"),
}
LOGGED_COLUMNS = ("Annual_Income", "Outstanding_Debt")
GROUPED_COLUMN = "Payment_Behaviour"
RARE_BELOW = 100
FINANCIAL_SUMMARY_COLUMNS = (
    "Annual_Income",
    "log_Annual_Income",
    "Outstanding_Debt",
    "log_Outstanding_Debt",
    "debt_to_income_ratio",
    "emi_to_income_ratio",
    "investment_to_income_ratio",
    "loan_per_card_ratio",
    "credit_inquiries_per_account",
    "credit_limit_change_ratio",
    "Credit_Utilization_Ratio",
    "Credit_History_Months",
)

# Loan features
PAYMENT_RATIO_CAP = 2.0
LARGE_BALANCE_ABOVE = 8000
CONSTANT_TENURE = 10
LOAN_DECIMALS = 4
LOAN_SUMMARY_COLUMNS = (
    "payment_ratio",
    "payment_ratio_clipped",
    "percent_paid",
    "log_overdue_amt",
    "balance_to_loan_ratio",
)
LOAN_FLAGS = ("underpaid_flag", "has_overdue_flag", "large_balance_flag", "constant_tenure_flag")

# Label definition
DPD = 30
MOB = 6
FIRST_LABEL_MONTH = "2023-01-01"
LAST_LABEL_MONTH = "2024-12-01"
LABEL_TYPES = {
    LOAN: "string",
    CUSTOMER: "string",
    "loan_start_date": "date",
    "tenure": "int",
    "installment_num": "int",
    "loan_amt": "float",
    "due_amt": "float",
    "paid_amt": "float",
    "overdue_amt": "float",
    "balance": "float",
    SNAPSHOT: "date",
}
LABEL_COLUMNS = (LOAN, CUSTOMER, "label", "label_def", SNAPSHOT)
