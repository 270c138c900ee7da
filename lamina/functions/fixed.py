"""Results depend on these matching the published contract exactly."""

# Two-letter code -> full name.
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas",
    "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho",
    "IL": "Illinois", "IN": "Indiana", "IA": "Iowa", "KS": "Kansas",
    "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland",
    "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota", "MS": "Mississippi",
    "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada",
    "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico", "NY": "New York",
    "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma",
    "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island", "SC": "South Carolina",
    "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah",
    "VT": "Vermont", "VA": "Virginia", "WA": "Washington", "WV": "West Virginia",
    "WI": "Wisconsin", "WY": "Wyoming", "DC": "District of Columbia",
    "PR": "Puerto Rico", "GU": "Guam", "VI": "Virgin Islands",
}

# Column-name fragments that select columns for each cleaning step.
STATE_COLUMN = "state"
STATE_ALTERNATIVES = ["location", "jurisdiction", "state_name"]
DATE_KEYWORDS = ["date", "week", "time", "period"]
NUMERIC_KEYWORDS = ["case", "death", "hosp", "vaccin", "dose", "count", "total", "rate", "specimen"]
NON_NEGATIVE_KEYWORDS = ["case", "death", "hosp", "dose", "vaccin"]

# Null fills.
FILL_NUMBER = 0.0
FILL_STRING = "Unknown"

# Datasets and their de-duplication keys.
CASES = "covid_cases_weekly_state"
VACCINATIONS = "covid_vaccinations_jurisdiction"
RESPIRATORY_DEATHS = "provisional_flu_pneumonia_covid_deaths"
FLU_COVERAGE = "flu_vaccination_coverage"
DATASETS = [CASES, VACCINATIONS, RESPIRATORY_DEATHS, FLU_COVERAGE]
DEDUP_KEYS = {
    CASES: ["start_date", "end_date", "state"],
    VACCINATIONS: ["date", "location"],
    RESPIRATORY_DEATHS: ["week_ending_date", "jurisdiction", "age_group"],
    FLU_COVERAGE: ["year_season", "month", "geography", "dimension"],
}

# Expectation suites per dataset: (type, arguments).
ROW_COUNT = "expect_table_row_count_to_be_between"
COLUMN_EXISTS = "expect_column_to_exist"
NOT_NULL = "expect_column_values_to_not_be_null"
BETWEEN = "expect_column_values_to_be_between"
DEFAULT_SUITE = [(ROW_COUNT, {"min_value": 1})]
SUITES = {
    CASES: [
        (ROW_COUNT, {"min_value": 1}),
        (COLUMN_EXISTS, {"column": "state"}),
        (NOT_NULL, {"column": "state", "mostly": 0.95}),
        (BETWEEN, {"column": "new_cases", "min_value": 0, "mostly": 0.99}),
        (BETWEEN, {"column": "new_deaths", "min_value": 0, "mostly": 0.99}),
    ],
    VACCINATIONS: [
        (ROW_COUNT, {"min_value": 1}),
        (COLUMN_EXISTS, {"column": "location"}),
        (BETWEEN, {"column": "administered", "min_value": 0, "mostly": 0.95}),
        (BETWEEN, {"column": "series_complete_yes", "min_value": 0, "mostly": 0.95}),
    ],
    RESPIRATORY_DEATHS: [
        (ROW_COUNT, {"min_value": 1}),
        (COLUMN_EXISTS, {"column": "jurisdiction"}),
        (BETWEEN, {"column": "covid_19_deaths", "min_value": 0, "mostly": 0.99}),
    ],
    FLU_COVERAGE: [
        (ROW_COUNT, {"min_value": 1}),
        (COLUMN_EXISTS, {"column": "geography"}),
        (BETWEEN, {"column": "coverage_estimate", "min_value": 0, "max_value": 100, "mostly": 0.95}),
    ],
}

# Indicator coefficients: share of new cases taken to hospital and to intensive care.
HOSPITAL_SHARE = 0.05
INTENSIVE_CARE_SHARE = 0.01

# Indicator tables. Counts are DOUBLE in the gold layer and BIGINT in the warehouse.
GOLD_SCHEMAS = {
    "kpi_incidence_by_region":
        "region STRING, state STRING, total_cases DOUBLE, total_deaths DOUBLE, incidence_rate DOUBLE, "
        "mortality_rate DOUBLE, report_date DATE, updated_at TIMESTAMP",
    "kpi_cases_per_day":
        "report_date DATE, state STRING, new_cases DOUBLE, cumulative_cases DOUBLE, updated_at TIMESTAMP",
    "kpi_deaths_per_day":
        "report_date DATE, state STRING, new_deaths DOUBLE, cumulative_deaths DOUBLE, updated_at TIMESTAMP",
    "kpi_hospitalizations_by_region":
        "region STRING, state STRING, hospitalized DOUBLE, icu_patients DOUBLE, report_date DATE, "
        "updated_at TIMESTAMP",
    "kpi_vaccination_vs_cases":
        "state STRING, report_date DATE, doses_administered DOUBLE, fully_vaccinated DOUBLE, new_cases DOUBLE, "
        "vaccination_rate DOUBLE, updated_at TIMESTAMP",
    "kpi_temporal_evolution_by_state":
        "state STRING, report_date DATE, metric_name STRING, metric_value DOUBLE, updated_at TIMESTAMP",
}
WAREHOUSE_SCHEMAS = {
    "kpi_incidence_by_region":
        "region VARCHAR(100) NOT NULL, state VARCHAR(50), total_cases BIGINT, total_deaths BIGINT, "
        "incidence_rate DOUBLE, mortality_rate DOUBLE, report_date DATE, updated_at TIMESTAMP",
    "kpi_cases_per_day":
        "report_date DATE NOT NULL, state VARCHAR(50), new_cases BIGINT, cumulative_cases BIGINT, "
        "updated_at TIMESTAMP",
    "kpi_deaths_per_day":
        "report_date DATE NOT NULL, state VARCHAR(50), new_deaths BIGINT, cumulative_deaths BIGINT, "
        "updated_at TIMESTAMP",
    "kpi_hospitalizations_by_region":
        "region VARCHAR(100), state VARCHAR(50), hospitalized BIGINT, icu_patients BIGINT, report_date DATE, "
        "updated_at TIMESTAMP",
    "kpi_vaccination_vs_cases":
        "state VARCHAR(50), report_date DATE, doses_administered BIGINT, fully_vaccinated BIGINT, "
        "new_cases BIGINT, vaccination_rate DOUBLE, updated_at TIMESTAMP",
    "kpi_temporal_evolution_by_state":
        "state VARCHAR(50) NOT NULL, report_date DATE NOT NULL, metric_name VARCHAR(100), metric_value DOUBLE, "
        "updated_at TIMESTAMP",
}
RUN_METADATA_SCHEMA = (
    "layer VARCHAR(20) NOT NULL, job_name VARCHAR(100), source VARCHAR(200), records_processed BIGINT, "
    "records_rejected BIGINT, duration_seconds DOUBLE, status VARCHAR(20), run_timestamp TIMESTAMP"
)
RUN_METADATA_DEFAULTS = {
    "source": "lamina", "records_processed": 0, "records_rejected": 0,
    "duration_seconds": 0.0, "status": "success",
}

# Ingestion log and document registry.
INGESTION_LOG_SCHEMA = (
    "source STRING NOT NULL, filename STRING NOT NULL, ingestion_time TIMESTAMP NOT NULL, file_size BIGINT, "
    "format STRING NOT NULL, status STRING NOT NULL, dataset_key STRING, record_count BIGINT, object_name STRING"
)
INGESTION_LOG_DEFAULTS = {
    "source": "unknown", "filename": "unknown", "file_size": 0, "format": "unknown", "status": "unknown",
}
REGISTRY_DEFAULTS = {
    "source": "", "filename": "", "file_size": 0, "format": "pdf", "category": "mmwr", "local_path": "",
    "status": "success",
}
MANIFEST_FILE_SCHEMA = (
    "source STRING, filename STRING, ingestion_time STRING, file_size BIGINT, format STRING, status STRING, "
    "dataset_key STRING, record_count BIGINT, local_path STRING, object_name STRING, pagination STRING, "
    "category STRING, content_hash STRING"
)
MANIFEST_SCHEMA = (
    "extraction_time STRING, mode STRING, total_files BIGINT, total_size_bytes BIGINT, "
    "files ARRAY<STRUCT<" + MANIFEST_FILE_SCHEMA.replace(" STRING", ": STRING").replace(" BIGINT", ": BIGINT") + ">>"
)

# Extraction limits per mode, and the page size ceiling.
MODES = {
    "sample": {"max_rows": 1000, "max_pages": 5, "pagination": "offset"},
    "full": {"max_rows": None, "max_pages": None, "pagination": "keyset"},
}
MAX_PAGE_SIZE = 50_000

# Document text limits.
FULL_TEXT_CHARS = 10_000
PREVIEW_CHARS = 500
PAGE_SEPARATOR = "\n\n"

# Names of the national row, as tested by the serving queries.
NATIONAL = ["US", "UNITED STATES"]
NATIONAL_EXCLUDED = ["US", "UNITED STATES", "USA"]

# Upper bounds of the job-duration histogram, in seconds; +Inf is added after them.
DURATION_BOUNDS = [1, 5, 10, 30, 60, 120, 300, 600, 1800]

# Row-limit ranges of the serving queries.
LIMITS = {"top_states": (1, 50), "regional": (1, 100), "dashboard": (1, 500)}
