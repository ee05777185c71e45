"""Data tests: each gives the rows that violate it (DQ-1..8)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique(df: DataFrame, column: str) -> DataFrame:
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def relationships(df: DataFrame, column: str, parent: DataFrame, to: str) -> DataFrame:
    """Non-null children without a parent (JN-14)."""
    child = df.filter(F.col(column).isNotNull())
    keys = parent.select(F.col(to).alias("_parent")).distinct()
    return child.join(keys, child[column] == keys["_parent"], "left_anti")


def accepted_values(df: DataFrame, column: str, values: list, where: Column | str | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return rows.filter(~F.col(column).isin(values))


def accepted_range(df: DataFrame, column: str, least=None, most=None, inclusive: bool = True) -> DataFrame:
    """Values outside the range; null passes."""
    x, out = F.col(column), F.lit(False)
    if least is not None:
        out = out | ((x < least) if inclusive else (x <= least))
    if most is not None:
        out = out | ((x > most) if inclusive else (x >= most))
    return df.filter(out)


def duplicates_differ(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """AGG-4: keys whose rows differ in a value, where null counts as a value.

    Least and greatest value and the number of nulls tell as much as a distinct count of each column
    and take one pass without expanding the rows.
    """
    aggs, differs = [F.count("*").alias("n")], F.lit(False)
    for v in values:
        aggs += [F.min(v).alias(f"_lo_{v}"), F.max(v).alias(f"_hi_{v}"), F.count(v).alias(f"_n_{v}")]
        differs = differs | (F.col(f"_lo_{v}") != F.col(f"_hi_{v}"))
        differs = differs | ((F.col(f"_n_{v}") > 0) & (F.col(f"_n_{v}") < F.col("n")))
    grains = df.groupBy(*keys).agg(*aggs)
    return grains.filter((F.col("n") > 1) & F.coalesce(differs, F.lit(False))).select(*keys, "n")


def is_missing(column: str) -> Column:
    """DQ-1 as a condition of a row that violates it."""
    return F.col(column).isNull()


def is_beyond(column: str, least=None, most=None) -> Column:
    """DQ-6 as a condition; null passes."""
    x, out = F.col(column), F.lit(False)
    if least is not None:
        out = out | (x < least)
    if most is not None:
        out = out | (x > most)
    return F.coalesce(out, F.lit(False))


def is_other_than(column: str, values: list) -> Column:
    """DQ-5 as a condition; null passes."""
    return F.coalesce(~F.col(column).isin(values), F.lit(False))


@dataclass(frozen=True)
class Test:
    """``find(rows, ref)`` gives the violations; ``severity`` is error or warn.

    A test of single rows may give the condition that ``where()`` makes in place of ``find``; a runner
    counts all of a model's in one pass.
    """

    __test__ = False  # not a pytest class

    name: str
    find: Callable[[DataFrame, Callable[[str], DataFrame]], DataFrame] | None = None
    severity: str = "error"
    where: Callable[[], Column] | None = None

    def violations(self, df: DataFrame, ref) -> DataFrame:
        return self.find(df, ref) if self.find is not None else df.filter(self.where())
