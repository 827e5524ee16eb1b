"""Roll-ups and cubes over additive measures."""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rollup_sets(*elements: str | tuple[str, ...]) -> list[list[str]]:
    """Grouping sets of a roll-up; a tuple is one composite element."""
    flat = [(e,) if isinstance(e, str) else e for e in elements]
    return [
        [column for element in flat[:depth] for column in element]
        for depth in range(len(flat), -1, -1)
    ]


def cube_sets(*columns: str) -> list[list[str]]:
    sets: list[list[str]] = [[]]
    for column in columns:
        sets += [s + [column] for s in sets]
    return sets


def total_flag(column: str) -> str:
    return f"all_{column}"


def added_up(
    totals: DataFrame, sets: Sequence[Sequence[str]], measures: Iterable[str]
) -> DataFrame:
    """Add already reduced rows up for every grouping set.

    Each grouped column gets a flag ``all_<column>``: 1 where the row is a total over it.
    """
    keys = list(dict.fromkeys(column for s in sets for column in s))
    return totals.groupingSets([[F.col(c) for c in s] for s in sets], *keys).agg(
        *[F.sum(n).alias(n) for n in measures],
        *[F.grouping(k).alias(total_flag(k)) for k in keys],
    )


def grouped_totals(
    rows: DataFrame, sets: Sequence[Sequence[str]], measures: Mapping[str, Column]
) -> DataFrame:
    """Aggregate raw rows to the leaf level once, then add the leaves up.

    Expanding the raw rows would multiply them by the number of sets before the shuffle;
    here only the leaf groups are expanded. Measures must be additive (sums and counts).
    """
    keys = list(dict.fromkeys(column for s in sets for column in s))
    leaves = rows.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    return added_up(leaves, sets, measures)


def labelled(column: str, label: str) -> Column:
    """The group value, or the label where the row totals over the column."""
    return F.when(F.col(total_flag(column)) == 1, label).otherwise(F.col(column))
