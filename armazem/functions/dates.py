"""Calendar expressions."""

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(ts: Column) -> Column:
    """YYYYMMDD as an integer; cheaper than formatting and parsing text."""
    return F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)


def year_month(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def days_between(start: Column, end: Column) -> Column:
    """Calendar days from start to end; the time of day is ignored."""
    return F.datediff(end.cast("date"), start.cast("date"))


def weekday_number(d: Column) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(d) - 1


def pick_name(names: Sequence[str], position: Column) -> Column:
    """The position-th name, counting from one."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)
