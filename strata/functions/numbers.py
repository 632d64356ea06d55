"""Numeric helpers returning Columns.

Spark 4 runs with ANSI mode on: a malformed cast or a division by zero
raises.  The reference relied on the lenient behaviour (null), so every
helper here uses ``try_cast`` / ``try_divide`` instead of turning ANSI off.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    """A string is a literal column name (dots and spaces allowed, SURVEY
    H12); pass a Column for nested fields."""
    return F.col("`" + c.replace("`", "``") + "`") if isinstance(c, str) else c


def safe_cast(c, to: str) -> Column:
    """Malformed -> null instead of an ANSI error."""
    return _col(c).try_cast(to)


def parse_number(c, decimal_comma: bool = True, thousands: str | None = None,
                 to: str = "double") -> Column:
    """Locale number text -> number.

    Drops ``%``, turns the decimal comma into a dot, removes anything that
    is not a digit, dot or minus sign, then ``try_cast``.  With
    ``thousands="."`` a German ``1.234,5`` parses as 1234.5.
    """
    x = F.replace(_col(c), F.lit("%"), F.lit(""))
    if thousands:
        x = F.replace(x, F.lit(thousands), F.lit(""))
    if decimal_comma:
        x = F.replace(x, F.lit(","), F.lit("."))
    return safe_cast(F.regexp_replace(x, r"[^0-9.\-]", ""), to)


def ratio(num, den) -> Column:
    """Null when the denominator is 0 or null."""
    return F.try_divide(_col(num), _col(den))


def pct(num, den) -> Column:
    """Percentage, null on a zero denominator."""
    return F.try_divide(_col(num), _col(den)) * F.lit(100)


def zero_if_null(c, to: str = "double") -> Column:
    """Cast leniently, null -> 0."""
    return F.coalesce(_col(c).try_cast(to), F.lit(0).cast(to))


def row_sum(cols, null_as_zero: bool = True, to: str = "double") -> Column:
    """C11: sum across columns of one row."""
    parts = [zero_if_null(c, to) if null_as_zero else _col(c) for c in cols]
    if not parts:
        return F.lit(0).cast(to)
    return reduce(add, parts)


def abs_diff(a, b) -> Column:
    """C14."""
    return F.abs(_col(a) - _col(b))


def allocate(part, total, measure) -> Column:
    """part/total * measure, 0 when the total is 0."""
    return F.when(_col(total) == 0, F.lit(0.0)).otherwise(
        F.try_divide(_col(part), _col(total)) * _col(measure))


def one_vs_rest(label, cls) -> Column:
    """Binary label for one class."""
    return (_col(label) == F.lit(cls)).cast("int")


def money(c) -> Column:
    """Exact money arithmetic: sums of DECIMAL(18,2) do not depend on the
    order in which partitions are added, unlike sums of doubles."""
    return _col(c).cast("decimal(18,2)")


def money_sum(c) -> Column:
    """Sum as exact decimal, returned as double."""
    return F.sum(money(c)).cast("double")
