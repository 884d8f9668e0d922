"""Table contract and quality rules (plain frozen dataclasses)."""

from __future__ import annotations

from dataclasses import dataclass, field

from tabrix.functions.nulls import DEFAULT_NULL_TOKENS


@dataclass(frozen=True)
class TableContract:
    """Expected layout of a table: names, column roles and the target."""

    columns: tuple[str, ...]
    numerical_columns: tuple[str, ...] = ()
    categorical_columns: tuple[str, ...] = ()
    target_column: str | None = None
    number_of_columns: int | None = None

    def __post_init__(self):
        for name in ("columns", "numerical_columns", "categorical_columns"):
            value = getattr(self, name)
            if isinstance(value, str) or not isinstance(value, (tuple, list)):
                raise TypeError(f"contract key '{name}' must be a list of names")
            object.__setattr__(self, name, tuple(value))
        if self.number_of_columns is None:
            object.__setattr__(self, "number_of_columns", len(self.columns))
        if not isinstance(self.number_of_columns, int):
            raise TypeError("contract key 'number_of_columns' must be an int")


@dataclass(frozen=True)
class SumCheck:
    parts: tuple[str, ...]
    total: str
    max_ratio: float
    tolerance: float = 0.0


@dataclass(frozen=True)
class TemporalCheck:
    earlier: str
    later: str
    max_ratio: float


@dataclass(frozen=True)
class QualityRules:
    """Thresholds of the data-quality checks (defaults: the reference's base env)."""

    null_tokens: tuple[str, ...] = DEFAULT_NULL_TOKENS
    max_duplicate_ratio: float = 0.02
    critical_missing: dict = field(default_factory=dict)  # column -> max missing share
    enforce_target_values: bool = True
    target_allowed_values: tuple[str, ...] = ("Y", "N")
    numeric_bounds: dict = field(default_factory=dict)  # column -> (min|None, max|None)
    sum_check: SumCheck | None = None
    temporal_check: TemporalCheck | None = None
    strict_column_match: bool = True
    fail_on_extra_columns: bool = False
    check_types: bool = False  # number columns hold numbers, category columns do not


# The claims table contract of the studied pipeline (column
# names, roles and target), in its own order.
CLAIMS_COLUMNS = (
    "months_as_customer", "age", "policy_number", "policy_bind_date", "policy_state",
    "policy_csl", "policy_deductable", "policy_annual_premium", "umbrella_limit", "insured_zip",
    "insured_sex", "insured_education_level", "insured_occupation", "insured_hobbies",
    "insured_relationship", "capital-gains", "capital-loss", "incident_date", "incident_type",
    "collision_type", "incident_severity", "authorities_contacted", "incident_state",
    "incident_city", "incident_location", "incident_hour_of_the_day",
    "number_of_vehicles_involved", "property_damage", "bodily_injuries", "witnesses",
    "police_report_available", "total_claim_amount", "injury_claim", "property_claim",
    "vehicle_claim", "auto_make", "auto_model", "auto_year", "fraud_reported",
)
CLAIMS_NUMERICAL = (
    "months_as_customer", "age", "policy_number", "policy_deductable", "policy_annual_premium",
    "umbrella_limit", "insured_zip", "capital-gains", "capital-loss", "incident_hour_of_the_day",
    "number_of_vehicles_involved", "bodily_injuries", "witnesses", "total_claim_amount",
    "injury_claim", "property_claim", "vehicle_claim", "auto_year",
)
CLAIMS_CATEGORICAL = (
    "policy_bind_date", "policy_state", "policy_csl", "insured_sex", "insured_education_level",
    "insured_occupation", "insured_hobbies", "insured_relationship", "incident_date",
    "incident_type", "collision_type", "incident_severity", "authorities_contacted",
    "incident_state", "incident_city", "incident_location", "property_damage",
    "police_report_available", "auto_make", "auto_model", "fraud_reported",
)
CLAIMS_CONTRACT = TableContract(columns=CLAIMS_COLUMNS, numerical_columns=CLAIMS_NUMERICAL,
                                categorical_columns=CLAIMS_CATEGORICAL,
                                target_column="fraud_reported", number_of_columns=39)

# Quality thresholds of the base environment.
CLAIMS_RULES = QualityRules(
    max_duplicate_ratio=0.02,
    critical_missing={"authorities_contacted": 0.20, "collision_type": 0.45,
                      "property_damage": 0.45, "police_report_available": 0.45},
    target_allowed_values=("Y", "N"),
    numeric_bounds={"age": (18, 100), "incident_hour_of_the_day": (0, 23),
                    "number_of_vehicles_involved": (1, 10), "bodily_injuries": (0, 5),
                    "witnesses": (0, 10), "auto_year": (1990, 2035)},
    sum_check=SumCheck(("injury_claim", "property_claim", "vehicle_claim"), "total_claim_amount",
                       0.01),
    temporal_check=TemporalCheck("policy_bind_date", "incident_date", 0.02),
)
# Text columns normalised, then combined into one text feature.
CLAIMS_TEXT_COLUMNS = ("insured_occupation", "insured_hobbies", "incident_location",
                       "incident_city", "auto_make", "auto_model")
