"""SRC-9: an exported price history (text) as typed rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_number(c: str) -> Column:
    return F.regexp_replace(F.col(c), ",", "").cast("double")


def parse_volume(c: str) -> Column:
    """Digits with a K, M or B suffix, or none, cut to a whole number; blank is null."""
    raw = F.upper(F.trim(F.col(c)))
    unit = F.when(raw.endswith("K"), 1e3).when(raw.endswith("M"), 1e6).when(raw.endswith("B"), 1e9)
    digits = F.regexp_replace(F.regexp_replace(raw, "[KMB]$", ""), ",", "")
    number = F.when(digits != "", digits).cast("double")
    return (number * F.coalesce(unit, F.lit(1.0))).cast("bigint")


def parse_percent(c: str) -> Column:
    return F.regexp_replace(F.col(c), "%", "").cast("double")


def normalise(export: DataFrame, index_name: str) -> DataFrame:
    """Columns Date, Price, Open, High, Low, Vol., Change % as an index price history."""
    renamed = export.select(*[F.col(f"`{c}`").alias(c.strip("﻿").replace(".", "").replace(" %", "")) for c in export.columns])
    return renamed.select(
        F.lit(index_name).alias("index_name"),
        F.to_date("Date", "MM/dd/yyyy").alias("date"),
        parse_number("Open").alias("open"),
        parse_number("High").alias("high"),
        parse_number("Low").alias("low"),
        parse_number("Price").alias("close"),
        parse_volume("Vol").alias("volume"),
        parse_percent("Change").alias("change_pct"),
    )


def read_export(spark: SparkSession, path: str, index_name: str) -> DataFrame:
    """An exported CSV file; all columns are read as text, a byte order mark is no part of a name."""
    return normalise(spark.read.csv(path, header=True, encoding="UTF-8", quote='"'), index_name)


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: a normalised CSV file with its declared schema."""
    from ..schemas import INDEX_PRICE_HISTORY

    return spark.read.csv(path, header=True, schema=INDEX_PRICE_HISTORY, dateFormat="yyyy-MM-dd")
