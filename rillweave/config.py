"""Configuration of the integration pipeline.

Every operator takes its parameters explicitly; the dataclass only bundles the
values the default HR instance runs with.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

# --- fixed values: results must equal these -------------------------------------

STANDARD_COLUMNS = (
    "employee_id", "first_name", "last_name", "email", "department",
    "job_title", "hire_date", "country", "employment_type", "manager_id",
    "base_salary", "currency", "pay_frequency", "bonus_target_pct",
    "effective_date", "plan_type", "coverage_level", "enrollment_date",
    "premium_employee", "premium_employer", "source_system",
    "payroll_company_source",
)

HRIS = "globaltech_hris"
API = "acquiredco_api"
PAYROLL = "payroll"
BENEFITS = "benefits"

# Load order; it decides ties between sources of equal priority.
SOURCE_ORDER = (HRIS, API, PAYROLL, BENEFITS)

SOURCE_PRIORITY = {HRIS: 1, API: 2, PAYROLL: 3, BENEFITS: 4}
UNKNOWN_PRIORITY = 99

ID_NAMESPACE = {HRIS: "GT", API: "AC", PAYROLL: "GT", BENEFITS: "GT"}

REQUIRED_FIELDS = {
    HRIS: ("employee_id", "first_name", "last_name", "email"),
    API: ("employee_id", "first_name", "last_name", "email"),
    PAYROLL: ("employee_id", "base_salary"),
    BENEFITS: ("employee_id",),
}

FX_TO_USD = {"USD": 1.00, "EUR": 1.09, "GBP": 1.27}

PERIODS_PER_YEAR = {"Annual": 1, "Monthly": 12, "Bi-Weekly": 26, "Bi-weekly": 26, "Weekly": 52}

EMPLOYMENT_TYPES = {
    "FT": "Full-Time",
    "PT": "Part-Time",
    "CT": "Contractor",
    "Full-Time": "Full-Time",
    "Part-Time": "Part-Time",
    "Contractor": "Contractor",
    "Full Time": "Full-Time",
    "Part Time": "Part-Time",
}

STANDARD_DEPARTMENTS = (
    "Engineering", "Marketing", "Human Resources", "Finance", "Operations",
    "Product", "Sales", "IT", "Legal", "Data Science", "DevOps",
    "Business Development", "Strategy", "Manufacturing", "Executive",
    "Customer Success", "Research & Development", "Accounting",
    "Communications", "Quality Assurance", "Supply Chain",
)

DEPARTMENT_CODES = {
    "ENG-01": "Engineering", "ENG-02": "Engineering",
    "MKT-01": "Marketing", "MKT-02": "Marketing", "MKT-03": "Marketing",
    "HR-01": "Human Resources", "HR-02": "Human Resources",
    "FIN-01": "Finance", "FIN-02": "Finance",
    "OPS-01": "Operations", "OPS-02": "Operations",
    "PROD-01": "Product", "PROD-02": "Product",
    "SALES-01": "Sales", "SALES-02": "Sales",
    "IT-01": "IT", "IT-02": "IT",
    "LEGAL-01": "Legal",
    "DS-01": "Data Science",
    "DEVOPS-01": "DevOps",
    "BD-01": "Business Development",
    "STRAT-01": "Strategy",
    "MFG-01": "Manufacturing",
    "EXEC-01": "Executive",
    "CS-01": "Customer Success",
    "RD-01": "Research & Development",
}
DEPARTMENT_CODE_SHAPE = r"^[A-Z]+-\d{2,}$"

DEPARTMENT_ALIASES = {
    "HR": "Human Resources",
    "Tech": "Engineering",
    "R&D": "Research & Development",
    "Acctg": "Accounting",
    "Mktg": "Marketing",
    "Biz Dev": "Business Development",
    "Cust Succ": "Customer Success",
    "Information Technology": "IT",
}

NULL_SENTINELS = ("", "nan", "<NA>", "None")

EMPLOYEE_ID_PATTERN = r"^(GT|AC)-\d{6}$"
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"

GHOST_REASON = "Payroll record with no matching HRIS entry"

# --- end of fixed values ---------------------------------------------------------


@dataclass(frozen=True)
class DateRule:
    """One accepted date layout: its shape, and its groups in year-month-day order.

    ``iso=None`` marks text that is in that order already. A month may be a name.
    """

    shape: str
    iso: str | None = None


# A month that fits the month's place decides between m/d and d/m: 03/04/2020 is 4 March,
# 25/12/2020 is 25 December. So every text has one shape, and the first one decides.
DATE_RULES = (
    DateRule(r"^\d{4}-\d{1,2}-\d{1,2}(?:T\d{1,2}:\d{1,2}:\d{1,2})?$"),
    DateRule(r"^(0?[1-9]|1[0-2])/(\d{1,2})/(\d{4})$", "$3-$1-$2"),
    DateRule(r"(?i)^(\d{1,2})-(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)-(\d{4})$", "$3-$2-$1"),
    DateRule(r"^(\d{1,2})/(0?[1-9]|1[0-2])/(\d{4})$", "$3-$2-$1"),
    DateRule(r"^(0?[1-9]|1[0-2])-(\d{1,2})-(\d{4})$", "$3-$1-$2"),
)

_MONTH_NAME = (
    "(jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|"
    "sept?(?:ember)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)

# Layouts outside the strict list which a lenient parser reads as well.
EXTRA_DATE_RULES = (
    DateRule(r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?$"),
    DateRule(r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    DateRule(r"^(\d{1,2})-(0?[1-9]|1[0-2])-(\d{4})$", "$3-$2-$1"),
    DateRule(r"^(\d{4})/(\d{1,2})/(\d{1,2})$", "$1-$2-$3"),
    DateRule(rf"(?i)^{_MONTH_NAME} (\d{{1,2}}),? (\d{{4}})$", "$3-$1-$2"),
    DateRule(rf"(?i)^(\d{{1,2}}) {_MONTH_NAME} (\d{{4}})$", "$3-$2-$1"),
    DateRule(r"^(\d{4})$"),
)


def merged_departments() -> dict[str, str]:
    """Exact spellings of all departments; standard names win over codes, codes over aliases."""
    exact = dict(DEPARTMENT_ALIASES)
    shape = re.compile(DEPARTMENT_CODE_SHAPE)
    exact.update({code: name for code, name in DEPARTMENT_CODES.items() if shape.match(code)})
    exact.update({name: name for name in STANDARD_DEPARTMENTS})
    return exact


@dataclass(frozen=True)
class SkewPolicy:
    """When a key counts as hot: when it has at least one in ``share`` of the rows.

    Then a list of hot keys is bounded by arithmetic, whatever the data: at most ``share`` keys
    have that many rows, twice as many with the error of a sketch. No other key can make a
    task of a shuffle much larger than one in ``share`` of the rows.
    """

    share: int = 1_024
    scatter: int = 4_096
    block_rows: int = 2_000


@dataclass(frozen=True)
class IntegrationConfig:
    standard_columns: tuple[str, ...] = STANDARD_COLUMNS
    source_order: tuple[str, ...] = SOURCE_ORDER
    source_priority: dict[str, int] = field(default_factory=lambda: dict(SOURCE_PRIORITY))
    id_namespace: dict[str, str] = field(default_factory=lambda: dict(ID_NAMESPACE))
    required_fields: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(REQUIRED_FIELDS))
    fx_to_usd: dict[str, float] = field(default_factory=lambda: dict(FX_TO_USD))
    periods_per_year: dict[str, int] = field(default_factory=lambda: dict(PERIODS_PER_YEAR))
    employment_types: dict[str, str] = field(default_factory=lambda: dict(EMPLOYMENT_TYPES))
    departments: dict[str, str] = field(default_factory=merged_departments)
    standard_departments: tuple[str, ...] = STANDARD_DEPARTMENTS
    null_sentinels: tuple[str, ...] = NULL_SENTINELS
    date_rules: tuple[DateRule, ...] = DATE_RULES + EXTRA_DATE_RULES
    valid_employment_types: tuple[str, ...] = ("Full-Time", "Part-Time", "Contractor")
    valid_currencies: tuple[str, ...] = ("USD", "EUR", "GBP")
    salary_min_usd: int = 15_000
    salary_max_usd: int = 10_000_000
    hire_date_min: str = "1970-01-01"
    employee_id_pattern: str = EMPLOYEE_ID_PATTERN
    email_pattern: str = EMAIL_PATTERN
    quality_threshold: float = 0.95
    gate_max_failures: int = 2
    fuzzy_threshold: int = 88
    date_window_days: int = 30
    null_is_missing: bool = False
    skew: SkewPolicy = field(default_factory=SkewPolicy)

    def __post_init__(self) -> None:
        """A window or threshold of zero stands for the default."""
        for name in ("fuzzy_threshold", "date_window_days"):
            if not getattr(self, name):
                object.__setattr__(self, name, getattr(type(self), name))


DEFAULT = IntegrationConfig()
