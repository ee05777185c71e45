"""SRC-13: a calendar, one row for each day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def dim_date(spark: SparkSession, start: str = "2000-01-01", end: str = "2035-12-31") -> DataFrame:
    """Days from start up to, but without, end. Weeks are ISO weeks; Sunday is day 1."""
    days = spark.sql(f"select explode(sequence(date'{start}', date_sub(date'{end}', 1))) as date")
    d = F.col("date")
    return days.select(
        "date",
        *[f(d).cast("bigint").alias(n) for n, f in (("year", F.year), ("quarter", F.quarter), ("month", F.month), ("day", F.day))],
        F.dayofweek(d).cast("bigint").alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.weekofyear(d).cast("bigint").alias("week_of_year"),
        (d == F.last_day(d)).alias("is_month_end"),
        (d == F.last_day(F.add_months(F.trunc(d, "quarter"), 2))).alias("is_quarter_end"),
        (d == F.make_date(F.year(d), F.lit(12), F.lit(31))).alias("is_year_end"),
    )
