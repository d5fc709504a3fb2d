"""Label, key and filter-literal functions (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from ._util import as_col, shared


def normalize_skill_label(c) -> Column:
    """Trim, lower, runs of non ``[a-z0-9]`` -> '_', strip '_', empty -> null.

    'Node.js' -> 'node_js', 'Python/C++' -> 'python_c', 'C#' -> 'c'.
    """
    low = F.lower(as_col(c))
    s = F.regexp_replace(F.regexp_replace(low, "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.nullif(F.when(low.rlike("[^a-z0-9]"), s).otherwise(low), F.lit(""))  # most labels have nothing to replace


def fill_unknown_company(c) -> Column:
    """Null or '' company -> 'Unknown'."""
    return F.coalesce(F.nullif(as_col(c), F.lit("")), F.lit(config.UNKNOWN_COMPANY))


def fold_country(value: str | None) -> str | None:
    """The API upper-cases a country filter."""
    return value.upper() if value else value


def fold_lower(value: str | None) -> str | None:
    """The API lower-cases skill and source filters."""
    return value.lower() if value else value


def indicator_pk(country) -> Column:
    """Partition key of a hot indicator, ``country#XX``."""
    return F.concat(F.lit("country#"), as_col(country))


def indicator_sk(skill) -> Column:
    """Sort key of a hot indicator, ``skill#yy``."""
    return F.concat(F.lit("skill#"), as_col(skill))


def struct_field_or_null(c, field: str) -> Column:
    """``obj.field`` when the value is an object, else null.

    Under an explicit schema a non-object value parses to null (PERMISSIVE),
    so plain struct access has the reference semantics.
    """
    return as_col(c).getField(field)


def na_tokens_to_null(c) -> Column:
    """A3: the text tokens a pandas CSV reader treats as missing -> null."""
    x = as_col(c)
    tokens = shared("na_tokens", lambda: [F.lit(t) for t in config.CSV_NA_TOKENS])
    return F.when(~x.isin(*tokens), x)


def split_skill_list(c, sep: str = ";") -> Column:
    """G1: 'a;b;;c' -> normalised labels, empty parts dropped, null labels dropped later."""
    parts = F.filter(F.split(F.coalesce(as_col(c), F.lit("")), sep, -1), lambda x: x != "")
    return F.transform(parts, normalize_skill_label)
