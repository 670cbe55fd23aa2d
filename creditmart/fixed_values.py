"""Values the results depend on. They are data, not choices of this code base."""

# ---- fixed values -----------------------------------------------------------

# calendar of a default run, first and last month
FIRST_MONTH = "2023-01-01"
LAST_MONTH = "2024-12-01"

# raw file stem -> folder of its bronze table
BRONZE_FOLDERS = {
    "lms_loan_daily": "lms",
    "features_attributes": "features/attributes",
    "features_financials": "features/financials",
    "feature_clickstream": "features/clickstream",
}

# identifier and format patterns
CUSTOMER_ID_PATTERN = r"^CUS_0x[0-9A-Fa-f]+$"
SSN_PATTERN = r"^\d{3}-\d{2}-\d{4}$"
YEARS_PATTERN = r"(\d+)\s+Years?"
MONTHS_PATTERN = r"(\d+)\s+Months?"

# characters removed from numbers: underscore, comma, dollar sign, white space
NUMBER_NOISE = "_,$ \t\n\x0b\f\r"

# earliest snapshot date accepted
EARLIEST_SNAPSHOT = "2020-01-01"

# accepted ranges (inclusive)
AGE_RANGE = (18, 100)
ANNUAL_INCOME_PLAUSIBLE = (1000, 10000000)
ANNUAL_INCOME_RANGE = (10000, 10000000)
MONTHLY_SALARY_PLAUSIBLE = (100, 1000000)
MONTHLY_SALARY_RANGE = (1000, 100000)
CREDIT_UTILIZATION_RANGE = (0, 1)
INTEREST_RATE_RANGE = (0, 100)
CREDIT_HISTORY_MONTHS_RANGE = (0, 600)

# capped age: below 0 -> 18, above 150 -> 65
AGE_FLOOR, AGE_BELOW_FLOOR = 0, 18
AGE_CEILING, AGE_ABOVE_CEILING = 150, 65

# accepted categories
PAYMENT_BEHAVIOURS = [
    "High_spent_Medium_value_payments",
    "High_spent_Small_value_payments",
    "Low_spent_Medium_value_payments",
    "Low_spent_Small_value_payments",
    "High_spent_Large_value_payments",
    "Low_spent_Large_value_payments",
]
MINIMUM_PAYMENT_ANSWERS = ["Yes", "No"]
CREDIT_MIXES = ["Bad", "Good", "Standard"]
CREDIT_MIX_PLACEHOLDER = "_"
LOAN_TYPE_PLACEHOLDER = "Not Specified"
LOAN_TYPE_MARK = "Loan"
# Types that get a column of their own; a run may name others.
LOAN_TYPES = [
    "Auto Loan",
    "Credit-Builder Loan",
    "Debt Consolidation Loan",
    "Home Equity Loan",
    "Mortgage Loan",
    "Payday Loan",
    "Personal Loan",
    "Student Loan",
]

# occupations counted as professionals, managers, executives and technicians
PMET_OCCUPATIONS = [
    "LAWYER", "DOCTOR", "ACCOUNTANT", "MANAGER", "SCIENTIST", "ARCHITECT",
    "TEACHER", "ENGINEER", "DEVELOPER", "MEDIA_MANAGER", "JOURNALIST",
]

# columns kept out of the gold features
NON_PREDICTIVE_COLUMNS = [
    "SSN", "valid_ssn", "Name", "Payment_of_Min_Amount",
    "valid_payment_of_min_amount", "Credit_Mix", "valid_credit_mix",
    "Credit_History_Age", "valid_credit_history_age", "Type_of_Loan",
    "valid_type_of_loan",
]

# clickstream features and their look-back window in days
CLICK_FEATURES = [f"fe_{i}" for i in range(1, 21)]
LOOK_BACK_DAYS = 180

# default label: 30 days past due at month 6; the sweep around it
LABEL_DPD, LABEL_MOB = 30, 6
SWEEP_DPD = (30, 60, 90)
SWEEP_MOB = (3, 6, 9)

# time split: name, first and last snapshot month
TIME_SPLITS = [
    ("train", "2023-01-01", "2023-09-01"),
    ("validation", "2023-10-01", "2023-11-01"),
    ("test", "2023-12-01", "2024-01-01"),
]
