"""Exact decimal arithmetic: half-up ratios, percentages, rounding casts and bands.

Operand precisions are chosen so that a division keeps 14 or more fraction digits before
the final rounding; doubles never take part.
"""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from armazem.functions.text import blank_to_null

MONEY = "decimal(10,2)"
TOTAL = "decimal(28,2)"


def money(c: Column) -> Column:
    return c.cast(MONEY)


def total(c: Column) -> Column:
    """Published type of a summed amount."""
    return c.cast(TOTAL)


def quotient(amount: Column, count: Column, places: int = 2) -> Column:
    """amount / count rounded half up; NULL when count is zero."""
    exact = amount.cast("decimal(24,2)") / F.nullif(count.cast("decimal(13,0)"), F.lit(0))
    return F.round(exact, places).cast(f"decimal(18,{places})")


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    """100 * part / whole rounded half up; NULL when whole is zero."""
    hundredfold = (F.lit(100) * part.cast(TOTAL)).cast("decimal(24,2)")
    exact = hundredfold / F.nullif(whole.cast("decimal(22,2)"), F.lit(0))
    return F.round(exact, places).cast(f"decimal(9,{places})")


def number(c: Column) -> Column:
    """Text measure to exact number, blank meaning missing."""
    return blank_to_null(c.cast("string")).cast("decimal(12,4)")


def whole(c: Column) -> Column:
    """Nearest integer, halves away from zero (a bare cast would truncate)."""
    return F.round(c, 0).cast("int")


def band(c: Column, limits: Sequence[tuple[int, str]], above: str) -> Column:
    """Label of the first inclusive upper limit that holds the value."""
    (first, label), *rest = limits
    chain = F.when(c <= first, label)
    for limit, label in rest:
        chain = chain.when(c <= limit, label)
    return chain.otherwise(above)


def count_where(condition: Column) -> Column:
    return F.count_if(condition)
