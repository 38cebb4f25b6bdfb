"""Configuration objects for preparation and forecasting."""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Must equal the source system's for identical results.
# Columns removed from raw vacancy rows (unknown names are ignored).
DENY_COLUMNS = (
    "driver_licence_e", "accommodation_housing", "disabled", "inner_info_metro_ids",
    "retraining_grant", "date_time_change_inner_info", "payment_meals",
    "retraining_capability", "caring_workers", "federal_district",
    "payment_sports_activities", "job_benefits", "retraining_condition",
    "additional_info", "metro_station", "incentive_compensation_transport_compensation",
    "premium_size", "driver_licence_c", "driver_licence_b", "premium_type",
    "career_perspective", "workers_with_disabled_children", "dms", "released_persons",
    "driver_licence_d", "drive_licences", "social_protecteds_social_protected",
    "single_parent", "vouchers_health_institutions", "retraining_grant_value",
    "requirements_id_priority_category", "need_medcard", "driver_licence_a",
    "vac_url", "accommodation_capability", "is_uzbekistan_recruitment",
)
# Title keyword of engineering vacancies ("engineer"), matched case-insensitively.
TITLE_KEYWORD = "инженер"
# Header names that look like a title column, listed when `title` is missing.
TITLE_LOOKALIKES = ("title", "название", "наименование")
# Date columns and their mistake flags, in processing order.
DATE_COLUMNS = (
    ("date_creation", "date_creation_mistake"),
    ("date_posted", "date_posted_mistake"),
    ("date_inactivation", None),
    ("date_last_updated", None),
    ("date_modify_inner_info", "date_modify_inner_info_mistake"),
)
# Categorical columns encoded after `industry`.
CATEGORICAL_COLUMNS = ("employment_type", "education_requirements_education_type",
                       "region", "profession", "organization")
# Numeric columns binned into quantile bins.
NUMERIC_COLUMNS = ("base_salary_min", "base_salary_max", "experience_requirements")
# Columns the forecasting stage needs.
REQUIRED_FOR_FORECAST = ("date_creation_processed", "date_end", "work_places", "industry")
# Span end when no end date is known, and duration bounds (days).
DEFAULT_DURATION_DAYS = 77
DURATION_MIN_DAYS = 1
DURATION_MAX_DAYS = 365
# Analysis window on the creation date (both ends inclusive, upper at midnight).
DATE_LO = "2018-08-01"
DATE_HI = "2021-07-31"
# Target encoding: categories with fewer rows are shrunk towards the global mean.
MIN_SAMPLES = 10
NUM_BINS = 10
# ----------------------------------------------------------------------------


@dataclass
class PrepConfig:
    """Preparation parameters (API-01); defaults reproduce the source system."""
    title_keyword: str | None = TITLE_KEYWORD
    deny_columns: tuple = DENY_COLUMNS
    date_columns: tuple = DATE_COLUMNS
    categorical_columns: tuple = CATEGORICAL_COLUMNS
    numeric_columns: tuple = NUMERIC_COLUMNS
    date_lo: str = DATE_LO
    date_hi: str = DATE_HI
    default_duration_days: int = DEFAULT_DURATION_DAYS
    min_samples: int = MIN_SAMPLES
    num_bins: int = NUM_BINS
    target: str = "work_places"
    # Encoding maps are broadcast up to this many bytes in total, and joined by shuffle beyond.
    broadcast_max_bytes: int = 64 << 20
    drop_original: bool = False
    # Formats of date text, tried in order (Q18); None infers them per column from the data,
    # DATE_FORMATS takes the library's without looking.
    date_formats: tuple | None = None
    # Columns by name and line breaks inside quoted fields, for one more pass over the lines;
    # off, all files must have one header, and rows with line breaks are broken.
    multiline: bool = True


@dataclass
class ForecastConfig:
    """Forecasting parameters (API-02/03)."""
    grid: list = field(default_factory=lambda: [
        {"freq": "W", "outlier_removal": False},
        {"freq": "W", "outlier_removal": True},
        {"freq": "2W", "outlier_removal": False},
        {"freq": "M", "outlier_removal": False},
    ])
    min_activity: int = 5
    min_points: int = 20
    horizon: int = 6
    top_k: int = 5
    anomaly_threshold: float = 2.0
    outlier_threshold: float = 3.0
    total_cap: float = 80000.0
    repair_window: int = 8
    min_forecast_points: int = 25
    train_fraction: float = 0.8
    seed: int = 42
    interpolation: str = "cubic"
    leak_free: bool = False
    step: str = "freq"  # or "month" (monthly steps whatever the frequency)
    # Validation on the last rows of each series instead of the last fifth, over so many
    # origins, each that many rows before the next.
    validation_periods: int | None = None
    validation_origins: int = 1
    # Anomaly detection and repair before forecasting.
    repair: bool = True
    # A stated configuration, e.g. {"freq": "M", "outlier_removal": False}, instead of the search.
    config: dict | None = None
