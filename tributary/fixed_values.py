"""Fixed values.

Everything here is a constant that results depend on: column lists, code
lists, thresholds and report texts.  Every operator takes these as defaults of
arguments, so other data sets pass their own.
"""

# --- fixed values: columns -------------------------------------------------

CANONICAL_COLUMNS = [
    "employee_id", "first_name", "last_name", "email",
    "department", "job_title", "hire_date", "country",
    "employment_type", "manager_id", "source", "company_origin",
]

ROSTER_COLUMNS = [
    "employee_id", "first_name", "last_name", "email", "department",
    "job_title", "hire_date", "country", "employment_type", "manager_id",
]

PAYROLL_COLUMNS = [
    "employee_id", "source", "base_salary", "currency",
    "pay_frequency", "bonus_target_pct", "effective_date",
]

BENEFIT_TAGS = [
    "employee_id", "plan_type", "coverage_level",
    "enrollment_date", "premium_employee", "premium_employer",
]

# nested object -> flattened name -> canonical name
NESTED_RENAMES = {
    "employee_identifier": "employee_id",
    "name_first": "first_name",
    "name_last": "last_name",
    "contact_email": "email",
    "assignment_department": "department",
    "assignment_role": "job_title",
    "assignment_location": "country",
    "assignment_hire_timestamp": "hire_date",
    "manager_employee_id": "manager_id",
}

NESTED_SCHEMA = (
    "employees array<struct<"
    "employee_identifier: string, "
    "name: struct<first: string, last: string>, "
    "contact: struct<email: string>, "
    "assignment: struct<department: string, role: string, location: string, hire_timestamp: string>, "
    "manager: struct<employee_id: string>, "
    "employment_type: string>>"
)

# --- fixed values: code lists ----------------------------------------------

ROSTER_A = "globaltech_hris"
ROSTER_B = "acquiredco_hris"
PAYROLL = "payroll"
BENEFITS = "benefits"

COMPANY_A = "GlobalTech"
COMPANY_B = "AcquiredCo"
COMPANY_UNKNOWN = "Unknown"

ORIGIN_BY_SOURCE = {ROSTER_A: COMPANY_A, ROSTER_B: COMPANY_B}

SOURCE_PRIORITY = {ROSTER_A: 1, ROSTER_B: 2, PAYROLL: 3, BENEFITS: 4}
LOWEST_PRIORITY = 99

EMPLOYMENT_CODES = {"FT": "Full-Time", "PT": "Part-Time", "CONTRACTOR": "Contractor"}

FREQUENCY_MULTIPLIER = {"Annual": 1.0, "Monthly": 12.0, "Bi-Weekly": 26.0}

USD_RATE = {"USD": 1.0, "EUR": 1.08, "GBP": 1.27}

DEPARTMENTS = [
    "Customer Success", "Strategy", "Human Resources", "Data Science", "Marketing",
    "Communications", "Legal", "Engineering", "Business Development", "Product",
    "Manufacturing", "Quality Assurance", "Sales", "DevOps", "Information Technology",
    "Operations", "Finance", "Supply Chain",
]

# texts that delimited files and workbooks use for "missing"
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# --- fixed values: thresholds ----------------------------------------------

PAGE_SIZE = 100
ID_WIDTH = 6
MATCH_SCORE = 88
CANDIDATE_SCORE = 75
CANDIDATE_LIMIT = 5
DATE_WINDOW_DAYS = 30
FIRST_DATE = "1970-01-01"
QUALITY_THRESHOLD = 0.95
MAX_FAILED_CHECKS = 2
GHOST_LIMIT = 0.75
MIN_GOLDEN_ROWS = 1000
TOP_COUNTRIES = 15
HISTOGRAM_BINS = 20
DAYS_PER_YEAR = 365.25
ENROLLMENT_TARGET = 80

# --- fixed values: patterns and report texts -------------------------------

ID_PATTERN = r"^(GT|AC)-\d{6}$"
EMAIL_PATTERN = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

METHOD_EMAIL = "exact_email"
METHOD_FUZZY = "fuzzy_name_date"
METHOD_UNIQUE = "unique"

FLAG_OK = "ok"
FLAG_OUT_OF_RANGE = "out_of_range"

ACTION_VERIFY = "VERIFY_HIRE_DATE"
ACTION_REVIEW = "MANUAL_REVIEW"

GHOST_NAME = "N/A (payroll-only record)"
GHOST_REASON = "No matching HRIS employee record"

GOLDEN_FOLDER = "golden_employees.parquet"
GHOST_FILE = "ghost_employees.csv"
REVIEW_FILE = "probable_matches_review.csv"
REPORT_FILE = "quality_report.csv"
REPORT_PAGE = "quality_report.html"

PASS_COLOUR = "#d4edda"
FAIL_COLOUR = "#f8d7da"

# description of each check of the standard suite, in report order
CHECK_TEXTS = {
    "NOT NULL: employee_id": "Every golden record must have an employee_id",
    "UNIQUE: employee_id": "employee_ids must be unique after deduplication",
    "REGEX: employee_id": "employee_ids must follow the GT-XXXXXX or AC-XXXXXX format",
    "NOT NULL: first_name": "Every employee must have a first name",
    "NOT NULL: last_name": "Every employee must have a last name",
    "NOT NULL: email": "At least 90% of employees should have an email address",
    "REGEX: email": "Email addresses must be in a valid format",
    "UNIQUE: email": "Email addresses must be unique after deduplication",
    "NOT NULL: hire_date": "Every employee must have a hire date",
    "DATE RANGE: hire_date": "Hire dates must fall between 1970-01-01 and today",
    "NOT NULL: department": "Every employee must be assigned to a department",
    "VALUES IN SET: department": "All department values must match the approved taxonomy",
    "COLUMN PRESENT: source_systems":
        "Dedup step must annotate each record with its contributing source systems",
    "MIN ROW COUNT": "Golden dataset must contain at least 1,000 employee records",
    "GHOST RATE: payroll vs HRIS": "Payroll records with no HRIS match should stay below 75%",
}
