"""Column-expression helpers: ``str | Column -> Column``.

All of them are built-in Spark expressions, so they stay inside
whole-stage codegen.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must match the source system.
SILVER_MONEY = "decimal(10,2)"  # money as landed
MONEY = "decimal(12,2)"  # money in gold, wide enough for sums
UNFULFILLED_STATUSES = ("canceled", "unavailable")  # statuses never counted as revenue


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: str | Column) -> Column:
    """Free text: trim spaces at both ends, empty -> NULL. Inner line breaks stay."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def enum(c: str | Column) -> Column:
    """Enumerated code: lower case, trimmed."""
    return F.lower(F.trim(_col(c)))


def surrogate_key(*cols: str | Column) -> Column:
    """Deterministic SHA-256 key over ``concat_ws('||', ...)``.

    NULL parts are skipped by ``concat_ws``, so ('a', NULL) hashes like ('a');
    NULL natural keys are rejected by the constraint checks instead.
    """
    return F.sha2(F.concat_ws("||", *[_col(c) for c in cols]), 256)


def short_key(c: str | Column) -> Column:
    """A text key as bytes that are equal where the keys are: a surrogate key as its 32 bytes, any other text as its own bytes
    after one that sets it apart (or after two, so that it never has 32)."""
    text = _col(c)
    digest = F.when((F.length(text) == 64) & (F.lower(text) == text), F.unhex(text))  # NULL for what is not hexadecimal
    tag = F.when(F.octet_length(text) == 31, F.lit(b"\x01\x00")).otherwise(F.lit(b"\x00"))
    return F.coalesce(digest, F.concat(tag, text.cast("binary")))


def date_key(c: str | Column) -> Column:
    """yyyyMMdd as INT."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def is_fulfilled(status: str | Column = "order_status",
                 unfulfilled: tuple[str, ...] = UNFULFILLED_STATUSES) -> Column:
    return ~_col(status).isin(*unfulfilled)


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den, NULL (not an error under ANSI) when den is 0."""
    return _col(num) / F.nullif(_col(den), F.lit(0))


def pct(num: str | Column, den: str | Column, scale: int) -> Column:
    """100 * num / den rounded HALF_UP, as DOUBLE; NULL when den is 0.

    Operands are taken to DOUBLE first so the result does not depend on
    decimal precision rules.
    """
    return F.round(F.lit(100.0) * _col(num).cast("double")
                   / F.nullif(_col(den).cast("double"), F.lit(0.0)), scale)


def any_null(cols: list[str]) -> Column:
    """OR of ``isNull`` over several columns."""
    return reduce(operator.or_, [F.col(c).isNull() for c in cols])


# ---- exact rounded ratios -------------------------------------------------
# ROUND of a DOUBLE near a decimal tie depends on the engine, so rounded
# averages and percentages are computed in DECIMAL: operands are cast to
# bounded precision so the quotient keeps >= 14 fractional digits, then
# rounded HALF_UP (away from zero on ties).

SUM_MONEY = "decimal(22,2)"  # sum of gold money
ROUNDED_MONEY = "decimal(18,2)"  # a rounded money average


def exact_ratio(num: str | Column, den: str | Column, scale: int, mult: int = 1) -> Column:
    """ROUND(mult * num / den, scale) as DOUBLE, NULL when den is 0 or NULL.

    num and den are counts or money (at most 2 decimals)."""
    n = (_col(num).cast("decimal(22,2)") * F.lit(mult)).cast("decimal(24,2)")
    d = F.nullif(_col(den).cast("decimal(22,2)"), F.lit(0))
    return F.round(n / d, scale).cast("double")


def exact_avg(c: str | Column, scale: int = 2) -> Column:
    """ROUND(AVG(c), scale) as DOUBLE; c is INT or DECIMAL."""
    col = _col(c)
    return exact_ratio(F.sum(col), F.count(col), scale)


def avg_money(c: str | Column) -> Column:
    """ROUND(AVG(money), 2) as DECIMAL(18,2), computed exactly."""
    col = _col(c)
    q = F.sum(col).cast(SUM_MONEY) / F.nullif(F.count(col), F.lit(0)).cast("decimal(20,0)")
    return F.round(q, 2).cast(ROUNDED_MONEY)


def money_ratio(num: str | Column, den: str | Column) -> Column:
    """ROUND(num / den, 2) as DECIMAL(18,2) (money per unit)."""
    q = _col(num).cast(SUM_MONEY) / F.nullif(_col(den), F.lit(0)).cast("decimal(20,0)")
    return F.round(q, 2).cast(ROUNDED_MONEY)
