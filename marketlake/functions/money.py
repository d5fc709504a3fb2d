"""Salary text parsing, currency conversion and rounding (Column -> Column).

Everything here is a native Catalyst expression: no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config
from ._util import as_col, lit_map

# FIXED PATTERNS: a decimal number as Python's float() accepts it (white space at its
# ends, a sign, an exponent), and the parts of a salary text.
_NUMBER_RE = r"^[\s\p{Z}]*([+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)[\s\p{Z}]*$"
_SPACES = "\u00a0 "
_CODE_RE = "^([A-Za-z]{3})"
_THOUSAND_RE = "(?i)k(?=$|[^0-9])"

# From here on a double has no cents left to round, and its cents leave bigint.
_NO_CENTS = 1e14


def _rounded(x: Column, parts: int) -> Column:
    # floor() is a bigint; larger values are whole already
    return F.when(F.abs(x) < _NO_CENTS, F.floor(x * parts + 0.5) / parts).otherwise(x)


def round2(c) -> Column:
    """Half-up rounding to cents, ``floor(x*100+0.5)/100``.

    Gives the same bits in Spark and DuckDB (plain ``round`` and decimal casts
    differ between engines at half-cent ties).  Values of 1e14 and more stay.
    """
    return _rounded(as_col(c), 100)


def round1(c) -> Column:
    return _rounded(as_col(c), 10)


def cents(c) -> Column:
    """Integer cents of a value (half-up), as bigint: exact and order-free to sum.
    A value whose cents a bigint does not hold is refused, not clipped."""
    x = as_col(c)
    fits = F.when(F.abs(x) < 9e16, F.floor(x * 100 + 0.5).cast("bigint"))
    return F.coalesce(fits, F.when(x.isNotNull(), F.raise_error(F.concat(F.lit("no cents of "), x.cast("string"))).cast("bigint")))


def avg_cents(c, count_col: Column | None = None) -> Column:
    """Average of ``c`` rounded to cents, computed from an integer cent sum.

    ``avg(double)`` depends on summation order; summing integer cents does not,
    so the result is identical on every partitioning and in every engine.
    Nulls are skipped (``count(c)``).
    """
    x = as_col(c)
    n = count_col if count_col is not None else F.count(x)
    return F.floor(F.sum(cents(x)).cast("double") / n + 0.5) / 100


def avg_tenths(c) -> Column:
    """Average rounded to one decimal, from an integer sum of tenths."""
    x = as_col(c)
    return F.floor(F.sum(F.floor(x * 10 + 0.5).cast("bigint")).cast("double") / F.count(x) + 0.5) / 10


def rates_map() -> Column:
    return lit_map((k, float(v)) for k, v in config.EXCHANGE_RATES.items())


def rate_to_eur(currency) -> Column:
    """B2: currency code -> EUR rate; unknown currency -> 1.0."""
    return F.coalesce(F.try_element_at(rates_map(), as_col(currency)), F.lit(1.0))


def parse_number(c) -> Column:
    """Text -> double as float() reads it; anything it would reject -> null.

    One reference to the input (regexp_extract + nullif), so callers can pass
    large expressions without duplicating them in the plan.
    """
    return F.nullif(F.regexp_extract(as_col(c), _NUMBER_RE, 1), F.lit("")).cast("double")


def _plain_number(c: Column) -> Column:
    """``parse_number`` of a text of digits and points alone, without its regular expression."""
    return F.nullif(c, F.lit("")).try_cast("double")


def _thousands(c: Column) -> Column:
    """Each ``k`` that no digit follows as ``000``; texts without one are not searched."""
    return F.when(F.lower(c).contains("k"), F.regexp_replace(c, _THOUSAND_RE, "000")).otherwise(c)


_SYMBOL_CURRENCY = (("€", "EUR"), ("£", "GBP"), ("$", "USD"))


def _first_symbol(s: Column) -> Column:
    """The first of €, £, $ (in that priority) present in ``s``, or null."""
    out = None
    for sym, _code in _SYMBOL_CURRENCY:
        out = (F.when(s.contains(sym), F.lit(sym)) if out is None else out.when(s.contains(sym), F.lit(sym)))
    return out


def _inline(_name: str, value: Column) -> Column:
    return value


class _Staged:
    """Keeps a parser's intermediates as columns of ``df``, each in a projection of
    its own: Catalyst does not inline a costly expression that is used twice, so
    every regular expression runs once per row."""

    def __init__(self, df, prefix: str):
        self.df, self.prefix, self.names = df, prefix, []

    def __call__(self, name: str, value: Column) -> Column:
        self.names.append(f"__{self.prefix}_{name}")
        self.df = self.df.withColumn(self.names[-1], value)
        return F.col(self.names[-1])


def _currency_eur(text: Column, stage) -> Column:
    """B1; ``stage(name, column)`` says what becomes of an intermediate."""
    sym = stage("sym", _first_symbol(text))
    bare = text
    for space in _SPACES:
        bare = F.replace(bare, F.lit(space), F.lit(""))
    s1 = stage("s1", F.replace(bare, F.coalesce(sym, F.lit("")), F.lit("")))
    code = stage("code", F.when(s1 < "A", F.lit("")).otherwise(F.regexp_extract(s1, _CODE_RE, 1)))  # no letter comes before A
    by_symbol = F.coalesce(F.try_element_at(lit_map(_SYMBOL_CURRENCY), sym), F.lit("EUR"))
    currency = F.when(code != "", F.upper(code)).otherwise(by_symbol)
    amount = F.when(code != "", F.substring(s1, F.lit(4), F.length(s1))).otherwise(s1)
    digits = _thousands(F.replace(amount, F.lit(","), F.lit("")))
    return round2(_plain_number(F.regexp_replace(digits, "[^0-9.]", "")) * rate_to_eur(currency))


def normalize_currency(c) -> Column:
    """B1: salary text ('€40k', '$50,000', 'GBP60k', '45 000') -> EUR, 2 dp.

    A leading three-letter code overrides the symbol; ``k`` becomes ``000``
    textually (so ``40.5k`` is 40.5); commas vanish; unparsable -> null.
    """
    return _currency_eur(as_col(c), _inline)


def with_normalized_currency(df, src: str | Column, dst: str):
    """B1 with staged intermediates: ``df`` plus ``dst`` = normalize_currency(src)."""
    stage = _Staged(df, dst)
    value = _currency_eur(src if isinstance(src, Column) else F.col(f"`{src}`"), stage)
    return stage.df.withColumn(dst, value).drop(*stage.names)


def usd_prefix_amount(c) -> Column:
    """USD amount (a number, or its text) -> EUR as the text path ``USD{v}`` gives.

    Text that is a number counts by its size, the sign being lost; other text
    keeps its digits ('1,234' is 1234), and without digits it is null.
    """
    text = as_col(c).cast("string")
    digits = F.regexp_replace(_thousands(F.replace(text, F.lit(","), F.lit(""))), "[^0-9.]", "")
    return round2(F.coalesce(F.abs(parse_number(text)), _plain_number(digits)) * F.lit(config.EXCHANGE_RATES["USD"]))


def _range_value(p: Column) -> Column:
    """One part of a range: 'k'/'K' suffix is x1000, unparsable -> null."""
    bare = F.when(p.endswith(F.lit("k")) | p.endswith(F.lit("K")), F.substring(p, F.lit(1), F.length(p) - 1))
    return F.when(bare.isNotNull(), parse_number(bare) * 1000).otherwise(parse_number(p))


def _range_bounds(text: Column, stage) -> tuple[Column, Column]:
    """B4; ``stage(name, column)`` says what becomes of an intermediate."""
    s = text
    for sign in (" ", *[sym for sym, _ in _SYMBOL_CURRENCY]):
        s = F.replace(s, F.lit(sign), F.lit(""))
    v = stage("vals", F.filter(F.transform(F.split(s, "[–\\-]", -1), _range_value), lambda x: x.isNotNull()))
    n = F.size(v)
    return F.when(n.isin(1, 2), v[0]).cast("double"), F.when(n == 2, v[1]).when(n == 1, v[0]).cast("double")


def parse_salary_range(c) -> Column:
    """B4: '40k–60k€' -> struct(min, max).

    Spaces and currency symbols are removed, the text is split on en dash or
    hyphen, ``k`` parts are x1000, unparsable parts are skipped.  Two values
    give (a, b) unswapped, one gives (a, a), anything else (null, null).
    """
    lo, hi = _range_bounds(as_col(c), _inline)
    return F.struct(lo.alias("min"), hi.alias("max"))


def with_salary_range(df, src: str | Column, lo: str, hi: str):
    """B4 with the parsed values staged as one column."""
    stage = _Staged(df, lo)
    a, b = _range_bounds(src if isinstance(src, Column) else F.col(f"`{src}`"), stage)
    return stage.df.withColumn(lo, a).withColumn(hi, b).drop(*stage.names)


def row_mean_skipna(lo, hi) -> Column:
    """Mean of two values ignoring missing ones, 2 dp."""
    a, b = as_col(lo), as_col(hi)
    return round2(F.coalesce((a + b) / 2, a, b))


def range_midpoint_strict(lo, hi) -> Column:
    """(lo + hi) / 2, null if either is null, 2 dp."""
    return round2((as_col(lo) + as_col(hi)) / 2)


def thousands_int(c) -> Column:
    """B10: '12,345' -> 12345 (bigint). A bad value raises under ANSI, like astype(int)."""
    return F.regexp_replace(as_col(c).cast("string"), ",", "").cast("bigint")


def fill_zero_int(c) -> Column:
    """Missing -> 0, as bigint."""
    return F.coalesce(as_col(c), F.lit(0)).cast("bigint")


def nan_to_null(c) -> Column:
    """NaN -> null (Spark keeps NaN apart from null; one NaN poisons avg/max)."""
    x = as_col(c)
    return F.when(~F.isnan(x), x)


def to_decimal_12_2(c) -> Column:
    """2-dp decimal as the warehouse stores it (half-up first, then exact cast)."""
    return round2(c).cast("decimal(12,2)")
