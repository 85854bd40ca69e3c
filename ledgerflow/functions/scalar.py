"""Scalar helpers (PRJ-3..5, SC-1..3). All are built-in Spark expressions, so
they stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c) -> Column:
    """Money as exact decimal so sums do not depend on addition order."""
    return col_(c).cast(MONEY)


def revenue(price="l_extendedprice", discount="l_discount") -> Column:
    """Line revenue ``price * (1 - discount)`` in exact decimal."""
    return money(price) * (F.lit(1) - money(discount))


def revenue_units(price="l_extendedprice", discount="l_discount") -> Column:
    """Line revenue as an exact bigint in units of 1e-4 (cents x percent).

    Same value as ``revenue()``: both sides are rounded as money first (a
    double times 100 would round 1.005 down), but sums run on the long fast
    path instead of 38-digit decimals. Use it only for sums over small
    groups (an order's lines); larger totals go through ``units_to_money``
    first so they cannot overflow.
    """
    def hundredths(c) -> Column:
        # Two decimals by now: scaling a double by 100 and rounding is exact.
        return F.round(money(c).cast("double") * 100).cast("bigint")
    return hundredths(price) * (F.lit(100) - hundredths(discount))


def units_to_money(c) -> Column:
    """bigint 1e-4 units -> exact decimal(25,4)."""
    return col_(c).cast("decimal(20,0)") * F.lit(0.0001).cast("decimal(4,4)")


def as_double(c) -> Column:
    return col_(c).cast("double")


# --- PRJ-3 -------------------------------------------------------------------
def safe_div(a, b) -> Column:
    """Zero or NULL divisor gives NULL, never an error (ANSI mode included)."""
    return F.try_divide(col_(a), col_(b))


# --- PRJ-4 -------------------------------------------------------------------
def get_or(c, key, default, kind: str = "json") -> Column:
    """Missing-key access with a default.

    ``kind`` says what the column is: ``json`` (a string, read at ``$.key``),
    ``map`` (by key) or ``struct`` (by field, which the schema must have).
    Absent key, NULL value and NULL container give ``default``.
    """
    c = col_(c)
    if kind == "json":
        value = F.get_json_object(c, f"$.{key}")
    elif kind == "map":
        value = F.try_element_at(c, F.lit(key))
    elif kind == "struct":
        value = c.getField(key)
    else:
        raise ValueError(f"unknown kind {kind}")
    return F.coalesce(value, F.lit(default))


def null_safe_eq(a, b) -> Column:
    return col_(a).eqNullSafe(col_(b))


# --- PRJ-5 -------------------------------------------------------------------
def parse_typed(c, type_name: str, fmt: str | None = None) -> tuple[Column, Column]:
    """(value, reason). Reason is set only when non-NULL text fails to parse."""
    c = col_(c)
    if type_name in ("date", "timestamp", "timestamp_ntz") and fmt:
        value = F.try_to_timestamp(c, F.lit(fmt)).cast(type_name)
    else:
        value = c.try_cast(type_name)
    reason = F.when(c.isNotNull() & value.isNull(),
                    F.concat(F.lit(f"not a {type_name}: "), c.cast("string")))
    return value, reason


# --- SC-1 --------------------------------------------------------------------
def month_start(c) -> Column:
    """First day of the month as DATE (works on timestamp and timestamp_ntz)."""
    return F.trunc(F.to_date(col_(c)), "month")


def week_start(c) -> Column:
    """Monday of the ISO week as DATE."""
    return F.date_trunc("week", F.to_date(col_(c))).cast("date")


def months_between_whole(later, earlier) -> Column:
    """Whole calendar months between two month-start dates."""
    a, b = F.to_date(col_(later)), F.to_date(col_(earlier))
    return ((F.year(a) - F.year(b)) * 12 + F.month(a) - F.month(b)).cast("int")


# --- SC-3 --------------------------------------------------------------------
def to_local(c, from_tz: str, to_tz: str) -> Column:
    """Wall-clock conversion of a zone-less timestamp between two zones."""
    return F.convert_timezone(F.lit(from_tz), F.lit(to_tz), col_(c).cast("timestamp_ntz"))
