"""Date parsing and date parts (Column -> Column), independent of session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

_ZONE_SUFFIX = r"(Z|[+-][0-9]{2}:?[0-9]{2})$"


def timestamp_to_date_coerce(c) -> Column:
    """Timestamp text -> ISO date string; unparsable -> null.

    A zoned value ('...T09:00:00Z') gives its UTC calendar date; a value
    without zone gives its own calendar date.  Neither depends on the session
    time zone.
    """
    x = as_col(c)
    instant = F.try_to_timestamp(x)
    utc_day = F.date_from_unix_date(F.floor(F.unix_micros(instant) / F.lit(86_400_000_000)).cast("int"))
    local_day = F.to_date(x.try_cast("timestamp_ntz"))
    return F.when(x.rlike(_ZONE_SUFFIX), utc_day).otherwise(local_day).cast("string")


def date_parts(date_str) -> dict[str, Column]:
    """Day, month, quarter, year, weekday (Monday = 0) of an ISO date string."""
    d = F.to_date(as_col(date_str))
    return {
        "day": F.dayofmonth(d).cast("int"),
        "month": F.month(d).cast("int"),
        "quarter": F.quarter(d).cast("int"),
        "year": F.year(d).cast("int"),
        "day_week": F.weekday(d).cast("int"),
    }


def month_start(ts) -> Column:
    """First day of the month of a timestamp or date, as an ISO date string."""
    return F.trunc(F.to_date(as_col(ts)), "month").cast("string")
