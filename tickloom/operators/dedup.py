"""One row of each key: the latest, or the first observed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def one_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """WIN-6..9: the first row of each key in the order, which must be total to be repeatable."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def _rest(df: DataFrame, but: list[str]) -> list:
    return [F.col(c) for c in df.columns if c not in but]


def latest(df: DataFrame, keys: list[str], at: str = "loaded_at") -> DataFrame:
    """WIN-6: the row loaded last; equal times are ordered by all other columns."""
    return one_per_key(df, keys, [F.desc(at), *_rest(df, [*keys, at])])


def first_observed(df: DataFrame, keys: list[str], at: str = "loaded_at", tie: list[str] | None = None) -> DataFrame:
    """WIN-7, WIN-8: the row loaded first; equal times are ordered by ``tie``, or all other columns."""
    rest = [F.col(c) for c in tie] if tie else _rest(df, [*keys, at])
    return one_per_key(df, keys, [F.asc(at), *rest])
