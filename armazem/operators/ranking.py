"""Shares and ranks over already aggregated rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from armazem.functions.numbers import percent


def share_of_all(measure: Column) -> Column:
    """Percentage of the sum over all rows. For short, aggregated results: the window has
    no partition, so every row passes through one task."""
    return percent(measure, F.sum(measure).over(W.partitionBy()))


def ordered(report: DataFrame, *order: Column | str) -> DataFrame:
    """Sort a short report. Its few groups end in one partition, which saves the sampling
    pass of a distributed sort; not for results that grow with the facts. What made the groups
    stays parallel: only finished rows are dealt to the one partition."""
    return report.repartition(1).sortWithinPartitions(*order)


def top(rows: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows; every task keeps only its own n candidates."""
    return rows.orderBy(*order).limit(n)


def desc(column: str) -> Column:
    """Descending, missing values first."""
    return F.col(column).desc_nulls_first()


def asc(column: str) -> Column:
    """Ascending, missing values last."""
    return F.col(column).asc_nulls_last()
