"""Scalar Column functions (B1-B21): native Catalyst expressions only."""

from .country import map_country_iso2, resolve_countries, resolve_with_table  # noqa: F401
from .dates import date_parts, month_start, timestamp_to_date_coerce  # noqa: F401
from .money import (  # noqa: F401
    avg_cents, avg_tenths, cents, fill_zero_int, nan_to_null, normalize_currency,
    parse_salary_range, range_midpoint_strict, rate_to_eur, round1, round2,
    row_mean_skipna, thousands_int, to_decimal_12_2, usd_prefix_amount,
)
from .text import (  # noqa: F401
    fill_unknown_company, fold_country, fold_lower, indicator_pk, indicator_sk,
    na_tokens_to_null, normalize_skill_label, split_skill_list, struct_field_or_null,
)
