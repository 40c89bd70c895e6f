"""Column functions shared by every layer.

Conventions: money stays an exact decimal, ratios are doubles computed from operands
cast to double first, and every count is a bigint. A ratio never divides by zero; which
value it takes instead is stated by the function's name.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Order- and line-level amounts. 18 digits keep the value in one machine word; an amount
# that does not fit raises under ANSI mode instead of being cut.
MONEY = "decimal(18,2)"
# Sums of MONEY over many rows.
MONEY_SUM = "decimal(28,2)"

# The placeholders used for missing attribution fields.
DIRECT_SOURCE = "(direct)"
NO_MEDIUM = "(none)"
NO_CAMPAIGN = "(not set)"

# Fixed value: the text hashed in place of a null key part.
NULL_KEY_PART = "_dbt_utils_surrogate_key_null_"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(_column(value), F.lit(""))


def blank_to(value: Column | str, placeholder: str) -> Column:
    return F.coalesce(blank_to_null(value), F.lit(placeholder))


def normalize_email(value: Column | str) -> Column:
    """Lower-cased and trimmed; an address that is empty after that is missing."""
    return blank_to_null(F.trim(F.lower(_column(value))))


def minor_to_major(value: Column | str) -> Column:
    """Cents to currency units. The scale is kept, not rounded to two digits."""
    return (_column(value).cast("decimal(18,2)") / F.lit(100)).cast("decimal(20,4)")


def surrogate_key(*parts: Column | str) -> Column:
    """MD5 over the key parts as text, joined by a dash."""
    texts = [F.coalesce(_column(p).cast("string"), F.lit(NULL_KEY_PART)) for p in parts]
    return F.md5(F.concat_ws("-", *texts))


def days_between(start: Column | str, end: Column | str) -> Column:
    return F.datediff(_column(end), _column(start))


def month_starts_between(start: Column | str, end: Column | str) -> Column:
    """Month boundaries crossed, so 31 January to 1 February is one month."""
    first, last = _column(start), _column(end)
    return (F.year(last) * 12 + F.month(last)) - (F.year(first) * 12 + F.month(first))


def month_start(value: Column | str) -> Column:
    return F.trunc(_column(value), "month")


def _double(value: Column | str) -> Column:
    return _column(value).cast("double")


def ratio_or_null(numerator: Column | str, denominator: Column | str) -> Column:
    """Null unless the denominator is positive."""
    bottom = _column(denominator)
    return F.when(bottom > 0, _double(numerator) / _double(bottom))


def ratio_or_zero(numerator: Column | str, denominator: Column | str) -> Column:
    """Zero unless the denominator is positive."""
    return F.coalesce(ratio_or_null(numerator, denominator), F.lit(0.0))


def ratio_of_sums(numerator: Column, denominator: Column) -> Column:
    """Null only when the denominator is zero or missing; negative ones divide."""
    return F.try_divide(_double(numerator), _double(denominator))


def mean(value: Column | str) -> Column:
    """Exact sum divided once, so the result does not depend on task order."""
    column = _column(value)
    return F.try_divide(F.sum(column).cast("double"), F.count(column).cast("double"))


def mean_of_ratios(value: Column | str) -> Column:
    """Mean of a double column, summed as a decimal with all digits of a ratio for the same reason."""
    return mean(_column(value).cast("decimal(38,20)"))


def earliest(time: str, tie: str) -> Column:
    """What to order by for the first row: by time, rows without one last, then by ``tie``."""
    return F.struct(F.col(time).isNull(), F.col(time), F.col(tie))


def flag_any(condition: Column) -> Column:
    """1 if any row of the group meets the condition, else 0."""
    return F.max(F.when(condition, 1).otherwise(0))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def cents(value: Column | str) -> Column:
    """An amount as a whole number of cents; an amount with a part of a cent raises."""
    hundredfold = _column(value) * 100
    whole = hundredfold.cast("bigint")
    inexact = F.raise_error(F.concat(F.lit("not a whole number of cents: "), _column(value).cast("string")))
    return F.when(hundredfold != whole, inexact).otherwise(whole)


def money(total_cents: Column | str) -> Column:
    return (_column(total_cents).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY_SUM)


def sum_money(value: Column | str) -> Column:
    """Exact sum of amounts with two decimals.

    Cents are summed as bigints: wide decimal sums leave Spark's fixed-width path and take
    about twice as long. A bigint holds 92 quadrillion units; past that ANSI mode raises.
    """
    return money(F.sum(cents(value)))


def mean_money(value: Column | str) -> Column:
    return F.try_divide(sum_money(value).cast("double"), F.count(_column(value)).cast("double"))


def zero_if_null(value: Column | str) -> Column:
    return F.coalesce(_column(value), F.lit(0))
