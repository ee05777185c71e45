"""As-of joins of facts to the versions of a slowly changing dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .dedup import one_per_key


def _versions(dim: DataFrame, prefix: str) -> DataFrame:
    return dim.select(
        F.col("symbol").alias(f"{prefix}symbol"),
        F.col("scd_id").alias(f"{prefix}id"),
        F.to_date("valid_from").alias(f"{prefix}from"),
        F.to_date("valid_to").alias(f"{prefix}to"),
    )


def asof_strict(fact: DataFrame, dim: DataFrame, date: str) -> DataFrame:
    """JN-2: ``ticker_key`` of the version whose days [valid_from, valid_to) hold the date, or null.

    An equi-join on the symbol with a range as residual: Spark broadcasts the versions where their
    measured size allows and sorts both sides otherwise.
    """
    v = _versions(dim, "_v_")
    inside = (
        (fact["symbol"] == v["_v_symbol"])
        & (fact[date] >= v["_v_from"])
        & (v["_v_to"].isNull() | (fact[date] < v["_v_to"]))
    )
    return fact.join(v, inside, "left").select(*[fact[c] for c in fact.columns], F.col("_v_id").alias("ticker_key"))


def asof_with_fallback(fact: DataFrame, dim: DataFrame, date: str) -> DataFrame:
    """JN-1: as ``asof_strict``, else the symbol's earliest version.

    VER-9: ``is_ticker_attrs_assumed`` is false for a real match, true for the fallback and null for
    a symbol that the dimension lacks.
    """
    strict = asof_strict(fact, dim, date).withColumnRenamed("ticker_key", "_real")
    first = one_per_key(dim, ["symbol"], [F.asc("valid_from"), F.asc("scd_id")]).select(
        F.col("symbol").alias("_f_symbol"), F.col("scd_id").alias("_first")
    )
    joined = strict.join(first, strict["symbol"] == first["_f_symbol"], "left")
    return joined.select(
        *[F.col(c) for c in fact.columns],
        F.coalesce("_real", "_first").alias("ticker_key"),
        F.when(F.col("_real").isNotNull(), F.lit(False))
        .when(F.col("_first").isNotNull(), F.lit(True))
        .alias("is_ticker_attrs_assumed"),
    )
