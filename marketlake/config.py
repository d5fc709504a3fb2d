"""Fixed reference values.

FIXED VALUES — these must equal the reference's registries for the results to
match (countries, skills, sectors, workforce sizes, exchange rates, as-of date,
plausible salary band, unknown label, fact grain, silver columns, page limits,
retention rules, freshness limit).  They are small lookup tables, broadcast on use.
"""

# Fixed as-of date of the survey source and default watermark.
AS_OF_DATE = "2026-06-15"

# First day of the day-partitioned micro-batch schedule.
BACKFILL_START = "2026-06-16"

# Plausible normalised annual salary band (EUR), inclusive.
EUR_MIN = 1000.0
EUR_MAX = 500000.0

# Exchange rates to EUR; an unknown currency counts as 1.0.
EXCHANGE_RATES = {
    "EUR": 1.0,
    "USD": 0.92,
    "GBP": 1.17,
    "JPY": 0.0067,
    "CAD": 0.68,
    "AUD": 0.62,
}

# iso2, name, region, currency (iso3)
COUNTRIES = [
    ("FR", "France", "Europe", "EUR"),
    ("DE", "Germany", "Europe", "EUR"),
    ("GB", "United Kingdom", "Europe", "GBP"),
    ("ES", "Spain", "Europe", "EUR"),
    ("IT", "Italy", "Europe", "EUR"),
    ("NL", "Netherlands", "Europe", "EUR"),
    ("US", "United States", "North America", "USD"),
    ("CA", "Canada", "North America", "CAD"),
    ("AU", "Australia", "Oceania", "AUD"),
]

# normalised label, group
SKILLS = [
    ("python", "language"),
    ("javascript", "language"),
    ("typescript", "language"),
    ("java", "language"),
    ("go", "language"),
    ("rust", "language"),
    ("sql", "database"),
    ("react", "framework"),
    ("django", "framework"),
    ("docker", "devops"),
    ("kubernetes", "devops"),
    ("aws", "cloud"),
]

SECTORS = ["Software", "Finance", "E-commerce", "Healthtech", "Gaming", "Consulting", "Telecom"]
WORKFORCE_SIZES = ["1-50", "51-200", "201-1000", "1001-5000", "5000+"]

# Registered salary sources, then the popularity sources (never in the fact).
SALARY_SOURCES = ["adzuna", "indeed", "glassdoor", "so_survey"]
POPULARITY_SOURCES = ["github_trending", "google_trends"]
ALL_SOURCES = SALARY_SOURCES + POPULARITY_SOURCES

UNKNOWN_COMPANY = "Unknown"
FACT_GRAIN = ["date_posted", "country_iso2", "skill", "company", "source"]
SALARY_COLS = ["source", "date_posted", "country_iso2", "skill", "company",
               "salary_eur", "min_salary_eur", "max_salary_eur"]

# Tokens a pandas CSV reader turns into missing values (pandas default list).
CSV_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                 "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
                 "n/a", "nan", "null"]

# Pagination defaults of the indicator API.
PAGE_DEFAULT_LIMIT = 50
PAGE_MAX_LIMIT = 500

# Retention policy per layer: (cold after days, expire after days or None).
RETENTION = {
    "bronze": (30, 90),
    "silver": (30, None),
    "gold": (90, None),
}

FRESHNESS_MAX_HOURS = 25
