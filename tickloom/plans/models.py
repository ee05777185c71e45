"""The warehouse's models: each a function of ``ref``, which gives the DataFrames it reads.

Inventory identifiers are given in the docstrings. Every window chain keeps one entity key, so its
rows are shuffled once by that key and sorted once, whatever number of measures is taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rolling as R
from ..operators.asof import asof_strict, asof_with_fallback
from ..operators.dedup import first_observed, latest, one_per_key
from ..sources.market import INDEX

PRICE = ["symbol", "date", "open", "high", "low", "close", "volume", "is_anomaly"]
YEAR = 252
QUARTER = 63
#: Models that read one index, the last parameter of their functions.
OF_INDEX = ("int_market_returns", "int_sector_returns", "fact_cross_sectional_rankings")


# -- staging -----------------------------------------------------------------------------------


def stg_stock_history(ref) -> DataFrame:
    """PRJ-1"""
    return ref("stock_history").select("history_id", *PRICE, "is_latest", "loaded_at")


def stg_index_constituents(ref) -> DataFrame:
    """PRJ-1"""
    return ref("index_constituents")


def stg_sectors(ref) -> DataFrame:
    """PRJ-1"""
    return ref("sectors")


def stg_screener(ref) -> DataFrame:
    """PRJ-2"""
    return ref("screener").withColumnRenamed("sector", "sector_code_raw")


def stg_index_price_history(ref) -> DataFrame:
    """PRJ-1, SRC-8"""
    return ref("index_prices")


def stg_symbols(ref) -> DataFrame:
    """JN-3, WIN-9: attributes with the code of their sector, matched by its normalised name."""
    norm = lambda c: F.upper(F.trim(F.col(c)))
    codes = ref("stg_sectors").select(norm("sector_name").alias("_name"), "sector_code", "snapshot_date").distinct()
    codes = one_per_key(codes, ["_name"], [F.desc("snapshot_date"), F.desc("sector_code")]).drop("snapshot_date")
    s = ref("symbols")
    return s.join(codes, norm("sector_name") == codes["_name"], "left").select(
        "symbol", "name", "sector_code", "is_etf", "is_debt", "is_gem", "is_margin_eligible"
    )


# -- dimensions --------------------------------------------------------------------------------


def dim_sectors(ref) -> DataFrame:
    """FV-1, AGG-3: the name that each code had last."""
    return ref("stg_sectors").groupBy("sector_code").agg(
        F.max_by("sector_name", F.struct("snapshot_date", "sector_name")).alias("sector_name")
    )


def dim_indices(ref) -> DataFrame:
    """AGG-3"""
    return ref("stg_index_constituents").select("index_name").distinct()


# -- latest-known facts ------------------------------------------------------------------------


def fact_ohlcv(ref) -> DataFrame:
    """FLT-1, JN-1"""
    rows = ref("stg_stock_history").filter("is_latest").select(*PRICE)
    return asof_with_fallback(rows, ref("dim_tickers"), "date")


def fact_restatement_history(ref) -> DataFrame:
    """AGG-1, JN-1"""
    versions = ref("stg_stock_history").groupBy("symbol", "date").agg(
        F.count("*").alias("restatement_count"),
        F.min("loaded_at").alias("first_loaded_at"),
        F.max("loaded_at").alias("last_loaded_at"),
    )
    return asof_with_fallback(versions, ref("dim_tickers"), "date")


def fact_index_membership(ref) -> DataFrame:
    """WIN-6, JN-2"""
    rows = latest(ref("stg_index_constituents"), ["index_name", "symbol", "snapshot_date"]).drop("loaded_at")
    return asof_strict(rows, ref("dim_tickers"), "snapshot_date")


def fact_valuation_daily(ref) -> DataFrame:
    """WIN-6, JN-2, PRJ-3"""
    rows = latest(ref("stg_screener"), ["symbol", "snapshot_date"]).drop("loaded_at", "sector_code_raw")
    return asof_strict(rows.withColumnRenamed("snapshot_date", "date"), ref("dim_tickers"), "date")


def fact_sector_daily(ref) -> DataFrame:
    """WIN-6, PRJ-3"""
    rows = latest(ref("stg_sectors"), ["sector_code", "snapshot_date"]).drop("loaded_at", "sector_name")
    return rows.withColumnRenamed("snapshot_date", "date")


def fact_index_ohlcv(ref) -> DataFrame:
    """PRJ-4"""
    return ref("stg_index_price_history").select("index_name", "date", "open", "high", "low", "close", "volume")


# -- point-in-time -----------------------------------------------------------------------------


def int_ohlcv_pit(ref) -> DataFrame:
    """WIN-8, VER-8, LAG-2, LAG-4, WAG-2, JN-1: the first version of each day and its returns."""
    rows = first_observed(ref("stg_stock_history"), ["symbol", "date"], tie=["history_id"]).select(*PRICE)
    w, close = R.ordered("symbol"), F.col("close")
    rows = rows.withColumn("daily_return_pct", R.change(close, w))
    rows = rows.select(
        "*",
        F.stddev_samp("daily_return_pct").over(R.last_rows(200, "symbol")).alias("rolling_vol_200"),
        R.change(close, w, QUARTER).alias("trailing_return_63d"),
    )
    return asof_with_fallback(rows, ref("dim_tickers"), "date")


def int_index_constituents_pit(ref) -> DataFrame:
    """WIN-7, JN-1"""
    rows = first_observed(ref("stg_index_constituents"), ["index_name", "symbol", "snapshot_date"]).drop("loaded_at")
    return asof_with_fallback(rows, ref("dim_tickers"), "snapshot_date").drop("is_ticker_attrs_assumed")


def int_screener_pit(ref) -> DataFrame:
    """WIN-7, JN-1"""
    rows = first_observed(ref("stg_screener"), ["symbol", "snapshot_date"])
    rows = rows.select("symbol", F.col("snapshot_date").alias("date"), "market_cap", "price", "pe_ratio")
    return asof_with_fallback(rows, ref("dim_tickers"), "date").drop("is_ticker_attrs_assumed")


# -- measures of tickers -----------------------------------------------------------------------


def int_technical_indicators(ref) -> DataFrame:
    """WAG-1..4, LAG-1, LAG-3, LAG-7, LAG-8, JN-10: all in one pass over each symbol's latest rows."""
    w = R.ordered("symbol")
    n = lambda k: R.last_rows(k, "symbol")
    close, r = F.col("close"), F.col("daily_return_pct")
    # dealt by symbol once, for all windows and the pass over the series
    base = ref("stg_stock_history").filter("is_latest").select("symbol", "date", "close").repartition("symbol")
    before = F.lag("close").over(w)
    base = base.select(
        "*",
        R.change(close, w).alias("daily_return_pct"),
        F.coalesce(F.greatest(close - before, F.lit(0.0)), F.lit(0.0)).alias("_gain"),
        F.coalesce(F.greatest(before - close, F.lit(0.0)), F.lit(0.0)).alias("_loss"),
    )
    mid, upper, lower = R.bollinger(close, n(20))
    flat = base.select(
        "symbol",
        "date",
        "close",
        "daily_return_pct",
        *[F.avg(close).over(n(k)).alias(f"ma_{k}") for k in (20, 50, 200)],
        R.rsi(F.col("_gain"), F.col("_loss"), n(14)).alias("rsi_14"),
        upper.alias("bollinger_upper"),
        mid.alias("bollinger_mid"),
        lower.alias("bollinger_lower"),
        *[F.stddev_samp(r).over(n(k)).alias(f"rolling_vol_{k}") for k in (20, 50, 200)],
        R.change(close, w, 5).alias("trailing_return_5d"),
        R.change(close, w, YEAR).alias("trailing_return_252d"),
    )
    return R.macd(flat, dealt=True)


def int_drawdown(ref) -> DataFrame:
    """WAG-5"""
    top = F.max("close").over(R.ordered("symbol").rowsBetween(Window.unboundedPreceding, 0))
    rows = ref("stg_stock_history").filter("is_latest").select("symbol", "date", "close", top.alias("top"))
    return rows.select("symbol", "date", F.try_divide(F.col("close") - F.col("top"), F.col("top")).alias("max_drawdown_pct"))


def fact_technical_indicators(ref) -> DataFrame:
    """LAG-6, JN-11, PRJ-5"""
    side = F.signum(F.col("ma_50") - F.col("ma_200"))
    was = F.lag(side).over(R.ordered("symbol"))
    event = F.when((was <= 0) & (side > 0), "golden_cross").when((was >= 0) & (side < 0), "death_cross")
    rows = ref("int_technical_indicators").withColumn("ma_crossover_event", event)
    keys = ref("fact_ohlcv").select("symbol", "date", "ticker_key")
    return rows.join(ref("int_drawdown"), ["symbol", "date"], "left").join(keys, ["symbol", "date"], "left")


# -- market and sectors ------------------------------------------------------------------------


def int_market_returns(ref, index: str = INDEX) -> DataFrame:
    """FV-2, FLT-2, FLT-3, LAG-2, LAG-4. One row for each day is left before the unpartitioned window."""
    rows = ref("int_index_constituents_pit").filter(F.col("index_name") == index).filter("current_index is not null")
    level = rows.groupBy(F.col("snapshot_date").alias("date")).agg(F.min_by("current_index", "symbol").alias("current_index"))
    w = Window.orderBy("date")
    x = F.col("current_index")
    return level.select(
        "*", R.change(x, w).alias("daily_return_pct"), R.change(x, w, QUARTER).alias("trailing_return_63d")
    )


def _sector_codes(ref) -> DataFrame:
    return ref("dim_tickers").select(F.col("scd_id").alias("ticker_key"), "sector_code")


def int_sector_returns(ref, index: str = INDEX) -> DataFrame:
    """JN-4, JN-5, LAG-5, AGG-2, WAG-11: returns weighted by the capitalisation of the day before."""
    returns = ref("int_ohlcv_pit").join(_sector_codes(ref), "ticker_key").select(
        "ticker_key", "date", "daily_return_pct", "sector_code"
    )
    caps = ref("int_index_constituents_pit").filter(F.col("index_name") == index).select(
        "ticker_key",
        F.col("snapshot_date").alias("date"),
        F.lag("market_cap_m").over(R.ordered("ticker_key", order="snapshot_date")).alias("cap"),
    )
    both = returns.join(caps, ["ticker_key", "date"]).filter("daily_return_pct is not null and cap > 0")
    daily = both.groupBy("sector_code", "date").agg(
        (F.sum(F.col("daily_return_pct") * F.col("cap")) / F.sum("cap")).alias("daily_return_pct")
    )
    w = R.last_rows(QUARTER, "sector_code")
    return daily.withColumn("trailing_return_63d", R.compound(F.col("daily_return_pct"), w, QUARTER))


def related(ref) -> DataFrame:
    """JN-7, JN-8: a ticker's returns beside the market's and its sector's."""
    r = ref("int_ohlcv_pit").join(_sector_codes(ref), "ticker_key").select(
        "ticker_key", "symbol", "date", F.col("daily_return_pct").alias("r"), "sector_code"
    )
    m = ref("int_market_returns").select("date", F.col("daily_return_pct").alias("m"))
    s = ref("int_sector_returns").select("sector_code", "date", F.col("daily_return_pct").alias("s"))
    return r.join(m, "date", "left").join(s, ["sector_code", "date"], "left")


def int_ticker_relationships(ref) -> DataFrame:
    """WAG-6..9, FLT-6"""
    return relationships(related(ref))


def relationships(rows: DataFrame, n: int = YEAR, least: int | None = None) -> DataFrame:
    """Beta and correlation of r to m (and s) over n rows of a symbol, given ``least`` values."""
    least = n if least is None else least

    def make(v):
        r, m, s = v["r"], v["m"], v["s"]
        return {
            "beta_full_252d": R.beta(r, m, n, least),
            "beta_upside_252d": R.beta(r, m, n, least, m >= 0),
            "beta_downside_252d": R.beta(r, m, n, least, m < 0),
            "corr_vs_index_252d": R.correlation(r, m, n, least),
            "corr_vs_sector_252d": R.correlation(r, s, n, least),
        }

    new = ["beta_full_252d", "beta_upside_252d", "beta_downside_252d", "corr_vs_index_252d", "corr_vs_sector_252d"]
    rows = rows.select("ticker_key", "symbol", "date", "r", "m", "s")
    return R.with_series(rows, ["symbol"], "date", n - 1, make, new).drop("r", "m", "s")


def int_sector_correlation(ref) -> DataFrame:
    """JN-6, WAG-10, FLT-6"""
    s = ref("int_sector_returns").select("sector_code", "date", "daily_return_pct")
    a = s.select(F.col("sector_code").alias("sector_code_a"), "date", F.col("daily_return_pct").alias("a"))
    b = s.select(F.col("sector_code").alias("sector_code_b"), "date", F.col("daily_return_pct").alias("b"))
    pairs = a.join(b, "date").filter(F.col("sector_code_a") < F.col("sector_code_b"))
    pairs = pairs.select("sector_code_a", "sector_code_b", "date", "a", "b")

    def make(v):
        return {"correlation_252d": R.correlation(v["a"], v["b"], YEAR)}

    keys = ["sector_code_a", "sector_code_b"]
    return R.with_series(pairs, keys, "date", YEAR - 1, make, ["correlation_252d"]).drop("a", "b")


def fact_sector_rotation(ref) -> DataFrame:
    """JN-7, WIN-5"""
    market = ref("int_market_returns").select("date", F.col("trailing_return_63d").alias("_m"))
    rows = ref("int_sector_returns").join(market, "date", "left").select(
        "sector_code",
        "date",
        F.col("trailing_return_63d").alias("sector_return_63d"),
        (F.col("trailing_return_63d") - F.col("_m")).alias("relative_strength_vs_market_63d"),
    )
    rank, quintile = R.rank_and_quintile(F.col("relative_strength_vs_market_63d"), "date", True, "sector_code")
    return rows.select("*", rank.alias("rotation_rank"), quintile.alias("rotation_quintile"))


def fact_cross_sectional_rankings(ref, index: str = INDEX) -> DataFrame:
    """JN-9, FLT-7, WIN-1..4"""
    universe = ref("int_index_constituents_pit").filter(F.col("index_name") == index).filter("ticker_key is not null")
    universe = universe.select("ticker_key", F.col("snapshot_date").alias("date")).distinct()
    price = ref("int_ohlcv_pit").select("ticker_key", "date", F.col("trailing_return_63d").alias("momentum_63d"), "rolling_vol_200")
    market = ref("int_market_returns").select("date", F.col("trailing_return_63d").alias("_m"))
    value = ref("int_screener_pit").select("ticker_key", "date", F.when(F.col("pe_ratio") > 0, F.col("pe_ratio")).alias("pe_ratio"))
    rows = universe.join(price, ["ticker_key", "date"], "left").join(value, ["ticker_key", "date"], "left")
    rows = rows.join(market, "date", "left")
    rows = rows.withColumn("relative_strength_63d", F.col("momentum_63d") - F.col("_m")).drop("_m")
    ranked = [
        ("momentum_63d", "momentum_63d", True),
        ("relative_strength_63d", "relative_strength_63d", True),
        ("pe_ratio", "pe_ratio", False),
        ("rolling_vol_200", "low_vol", False),
    ]
    # dealt by day before the chain of windows, which all lie within a day
    rows = rows.repartition("date")
    new = []
    for column, name, descending in ranked:
        rank, quintile = R.rank_and_quintile(F.col(column), "date", descending, "ticker_key")
        new += [rank.alias(f"{name}_rank"), quintile.alias(f"{name}_quintile")]
    return rows.select("*", *new)


def _pass(name: str):
    def build(ref) -> DataFrame:
        return ref(name)

    build.__doc__ = "PRJ-4"
    return build


fact_sector_correlation = _pass("int_sector_correlation")
fact_ticker_relationships = _pass("int_ticker_relationships")
