"""The raw tables of a market, shaped from a star schema of orders.

A nation is a ticker and a region its sector; each order is one version of the nation's price of the
day, so several orders on one day are restatements. Rows carry the same values as the SQL in
``plans.oracle``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

INDEX = "IDX100"
#: Days at which the ticker list is observed.
STATES = (dt.date(1996, 1, 1), dt.date(1998, 1, 1), dt.date(2000, 1, 1))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, symbol, nk, sector_name, sector_code, date, loaded_at, px, bal: one row for each order.

    The order table streams past; which of the other sides are broadcast is left to their sizes.
    """
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    customer = read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    nation = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    places = nation.join(region, nation["n_regionkey"] == region["r_regionkey"])
    joined = orders.join(customer, orders["o_custkey"] == customer["c_custkey"]).join(
        places, F.col("c_nationkey") == F.col("n_nationkey")
    )
    k = F.col("o_orderkey")
    return joined.select(
        k.alias("k"),
        F.col("n_name").alias("symbol"),
        F.col("n_nationkey").alias("nk"),
        F.col("r_name").alias("sector_name"),
        (F.col("r_regionkey") + 100).cast("string").alias("sector_code"),
        F.to_date("o_orderdate").alias("date"),
        F.expr("timestampadd(SECOND, o_orderkey, o_orderdate)").alias("loaded_at"),
        F.col("o_totalprice").alias("px"),
        F.col("c_acctbal").alias("bal"),
    )


def stock_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, px = F.col("k"), F.col("px")
    day = Window.partitionBy("symbol", "date")
    return quotes(spark, sf_dir).select(
        k.cast("string").alias("history_id"),
        "symbol",
        "date",
        (px + (k % 3) - 1).alias("open"),
        (px + (k % 7)).alias("high"),
        (px - (k % 5)).alias("low"),
        px.alias("close"),
        (k % 1000).cast("bigint").alias("volume"),
        (((k % 7) < (k % 3) - 1) | (-(k % 5) > (k % 3) - 1)).alias("is_anomaly"),
        (k == F.max("k").over(day)).alias("is_latest"),
        "loaded_at",
    )


def index_constituents(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quotes(spark, sf_dir)
    level = q.groupBy("date").agg(F.max("px").alias("current_index"))  # a row for each day
    k = F.col("k")
    return q.join(level, "date").select(
        F.lit(INDEX).alias("index_name"),
        "symbol",
        F.col("date").alias("snapshot_date"),
        "current_index",
        (k % 100).cast("double").alias("idx_weight"),
        (k % 21 - 10).cast("double").alias("idx_point"),
        F.col("bal").alias("market_cap_m"),
        (k % 50).cast("double").alias("freefloat_m"),
        (k % 77).cast("double").alias("shares_m"),
        "loaded_at",
    )


def sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("k")
    return quotes(spark, sf_dir).select(
        "sector_code",
        "sector_name",
        (k % 9).cast("bigint").alias("advance"),
        (k % 8).cast("bigint").alias("decline"),
        (k % 3).cast("bigint").alias("unchanged"),
        F.col("px").alias("turnover"),
        (k % 500).cast("double").alias("market_cap_b"),
        F.col("date").alias("snapshot_date"),
        "loaded_at",
    )


def screener(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, px = F.col("k"), F.col("px")
    return quotes(spark, sf_dir).select(
        "symbol",
        F.col("sector_code").alias("sector"),
        F.when(k % 4 == 0, "GEM").otherwise("Main Board").alias("listed_in"),
        (px * 10).alias("market_cap"),
        px.alias("price"),
        F.when(k % 11 != 0, (k % 40 - 5).cast("double")).alias("pe_ratio"),
        (k % 12).cast("double").alias("dividend_yield"),
        (k % 100).cast("double").alias("free_float"),
        (k % 5000).cast("double").alias("volume_avg_30d"),
        (k % 90 - 45).cast("double").alias("change_1y_pct"),
        F.col("date").alias("snapshot_date"),
        "loaded_at",
    )


def tickers(spark: SparkSession, sf_dir: str, state: int) -> DataFrame:
    """The attributes observed at a state (1 to 3): renames, a changed flag, two vanished symbols."""
    nation = read(spark, sf_dir, "nation")
    nk = F.col("n_nationkey")
    renamed = F.lit(state >= 2) & (nk % 3 == 0)
    rows = nation.select(
        F.col("n_name").alias("symbol"),
        F.when(renamed, F.concat("n_name", F.lit(" LTD"))).otherwise(F.col("n_name")).alias("name"),
        (F.col("n_regionkey") + 100).cast("string").alias("sector_code"),
        (F.lit(state >= 3) & (nk % 2 == 0)).alias("is_etf"),
        F.lit(False).alias("is_debt"),
        (nk % 4 == 0).alias("is_gem"),
        F.lit(True).alias("is_margin_eligible"),
        nk.alias("nk"),
    )
    return rows.filter(~(F.lit(state >= 3) & (nk % 10 == 9))).drop("nk")


def raw_symbols(spark: SparkSession, sf_dir: str, state: int) -> DataFrame:
    """The same as a feed gives it: with the sector's name, spaced and cased as it comes."""
    region = read(spark, sf_dir, "region").select((F.col("r_regionkey") + 100).cast("string").alias("c"), "r_name")
    t = tickers(spark, sf_dir, state)
    return t.join(region, t["sector_code"] == region["c"]).select(
        "symbol", "name", F.concat(F.lit(" "), F.lower("r_name")).alias("sector_name"),
        "is_etf", "is_debt", "is_gem", "is_margin_eligible",
    )


def index_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open, high, low and close of all orders of a day, as an index's price history."""
    q = quotes(spark, sf_dir)
    return q.groupBy("date").agg(
        F.lit(INDEX).alias("index_name"),
        F.min_by("px", "k").alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", "k").alias("close"),
        F.count("*").alias("volume"),
    )
