"""The singular data tests T1 to T31 and generic ones: violations, and their DuckDB forms."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import quality as Q
from ..sources.market import INDEX

#: The day that counts as today; a registered query never reads a clock.
TODAY = dt.date(2001, 12, 31)


@dataclass(frozen=True)
class Check:
    """A test of a model; ``sql`` gives its violations in DuckDB, for those that are registered queries."""

    model: str
    test: Q.Test
    sql: str | None = None


def _check(model: str, name: str, find, sql: str | None, severity: str = "error") -> Check:
    return Check(model, Q.Test(name, find, severity), sql)


def overlapping(dim: DataFrame, far: dt.date) -> DataFrame:
    """T1: pairs of versions of a symbol whose validity overlaps."""
    end = F.coalesce(F.col("valid_to"), F.lit(far))
    a = dim.select("symbol", F.col("scd_id").alias("a"), F.col("valid_from").alias("af"), end.alias("at"))
    b = dim.select("symbol", F.col("scd_id").alias("b"), F.col("valid_from").alias("bf"), end.alias("bt"))
    return a.join(b, "symbol").filter((F.col("a") != F.col("b")) & (F.col("af") < F.col("bt")) & (F.col("at") > F.col("bf")))


def assumed_wrongly(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """T9, T12: rows said to match a version that does not hold on their day."""
    v = dim.select(F.col("scd_id").alias("ticker_key"), "valid_from", "valid_to")
    inside = (F.col("date") >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col("date") < F.col("valid_to")))
    return fact.join(v, "ticker_key").filter(~F.col("is_ticker_attrs_assumed") & ~inside)


def close_of_both(ref) -> DataFrame:
    p = ref("int_ohlcv_pit").select("symbol", "date", F.col("close").alias("pit"))
    f = ref("fact_ohlcv").select("symbol", "date", "close")
    r = ref("fact_restatement_history").select("symbol", "date", "restatement_count")
    return p.join(f, ["symbol", "date"]).join(r, ["symbol", "date"])


def never_differs(ref) -> DataFrame:
    """T20: one row where restated days exist and none differs between first and latest."""
    facts = close_of_both(ref).agg(
        F.count(F.when(F.col("restatement_count") > 1, 1)).alias("restated"),
        F.count(F.when((F.col("restatement_count") > 1) & (F.col("pit") != F.col("close")), 1)).alias("differ"),
    )
    return facts.filter("restated > 0 and differ = 0")


def beyond_universe(rankings: DataFrame, ref) -> DataFrame:
    """T5"""
    pit = ref("int_index_constituents_pit").filter(F.col("index_name") == INDEX)
    size = pit.groupBy(F.col("snapshot_date").alias("date")).agg(F.countDistinct("ticker_key").alias("n"))
    return rankings.join(size, "date").filter("momentum_63d_rank > n")


def late_returns(ind: DataFrame, ref) -> DataFrame:
    """T25: rows from the 253rd on without a 252-day return."""
    from ..functions.rolling import ordered

    n = F.row_number().over(ordered("symbol"))
    return ind.select("symbol", "date", "trailing_return_252d", n.alias("n")).filter("n > 252 and trailing_return_252d is null")


def constant_price_correlated(rel: DataFrame, ref) -> DataFrame:
    """T26: correlations where a ticker's price never moved."""
    flat = ref("int_ohlcv_pit").groupBy("ticker_key").agg(
        F.count("*").alias("n"), F.min("close").alias("lo"), F.max("close").alias("hi"), F.min("date").alias("d0"), F.max("date").alias("d1")
    )
    flat = flat.filter("n >= 252 and lo = hi")
    found = rel.join(flat, "ticker_key").filter("date between d0 and d1")
    return found.filter("corr_vs_index_252d is not null or corr_vs_sector_252d is not null")


def against_membership(val: DataFrame, ref) -> DataFrame:
    """T27"""
    m = ref("fact_index_membership").select("symbol", F.col("snapshot_date").alias("date"), "market_cap_m")
    return val.join(m, ["symbol", "date"]).filter("abs(market_cap - market_cap_m) > 1.0")


def against_close(val: DataFrame, ref) -> DataFrame:
    """T28"""
    f = ref("fact_ohlcv").select("symbol", "date", "close")
    return val.join(f, ["symbol", "date"]).filter("abs(price - close) > 0.01")


def _dup_sql(table: str, keys: str, values: list[str]) -> str:
    counts = " or ".join(f"count(distinct {v}) + cast(count({v}) < count(*) as int) > 1" for v in values)
    return f"select {keys} from {table} group by {keys} having count(*) > 1 and ({counts})"


_CONSTITUENT = ["current_index", "idx_weight", "idx_point", "market_cap_m", "freefloat_m", "shares_m"]
_SCREEN = ["sector_code_raw", "listed_in", "market_cap", "price", "pe_ratio", "dividend_yield", "free_float", "volume_avg_30d", "change_1y_pct"]
_SECTOR = ["advance", "decline", "unchanged", "turnover", "market_cap_b"]
_ORDER = "not (high >= low and high >= open and high >= close and low <= open and low <= close)"
_WRONG = """select 1 from {0} f join dim_tickers t on f.ticker_key = t.scd_id where f.is_ticker_attrs_assumed = false
    and not (f.date >= t.valid_from and (t.valid_to is null or f.date < t.valid_to))"""
_BOTH = "from int_ohlcv_pit p join fact_ohlcv f using (symbol, date) join versions v using (symbol, date)"


def checks(today: dt.date = TODAY) -> list[Check]:
    """All tests, with the day that counts as today."""

    def not_future(t: str, model: str, column: str = "date", sql_model: str | None = None) -> Check:
        sql = f"select 1 from {sql_model or model} where {column} > date '{today}'"
        return _check(model, f"{t}_no_future_dates", lambda df, ref: df.filter(F.col(column) > F.lit(today)), sql)

    return [
        _check("dim_tickers", "t01_no_overlap", lambda df, ref: overlapping(df, today),
               f"""select 1 from dim_tickers a join dim_tickers b on a.symbol = b.symbol and a.scd_id <> b.scd_id
                   and a.valid_from < coalesce(b.valid_to, date '{today}') and coalesce(a.valid_to, date '{today}') > b.valid_from"""),
        _check("dim_tickers", "t02_one_open_version", lambda df, ref: df.filter("valid_to is null").groupBy("symbol").count().filter("count > 1"),
               "select symbol from dim_tickers where valid_to is null group by symbol having count(*) > 1"),
        not_future("t03", "fact_cross_sectional_rankings"),
        _check("fact_cross_sectional_rankings", "t04_pe_exclusion",
               lambda df, ref: df.filter("(pe_ratio is null or pe_ratio <= 0) and (pe_ratio_rank is not null or pe_ratio_quintile is not null)"),
               "select 1 from fact_cross_sectional_rankings where (pe_ratio is null or pe_ratio <= 0) and (pe_ratio_rank is not null or pe_ratio_quintile is not null)"),
        _check("fact_cross_sectional_rankings", "t05_rank_within_universe", beyond_universe,
               """select 1 from fact_cross_sectional_rankings r join (select snapshot_date as date, count(distinct ticker_key) as n
                  from int_index_constituents_pit where index_name = 'IDX100' group by 1) u using (date) where r.momentum_63d_rank > u.n"""),
        not_future("t06", "fact_index_membership", "snapshot_date"),
        _check("fact_ohlcv", "t07_high_low", lambda df, ref: df.filter(f"coalesce(is_anomaly, false) = false and {_ORDER}"),
               f"select 1 from fact_ohlcv where is_anomaly is distinct from true and {_ORDER}"),
        not_future("t08", "fact_ohlcv"),
        _check("fact_ohlcv", "t09_assumed_correct", lambda df, ref: assumed_wrongly(df, ref("dim_tickers")), _WRONG.format("fact_ohlcv")),
        _check("fact_ohlcv", "t10_assumed_prevalence", lambda df, ref: df.filter("is_ticker_attrs_assumed"), "select 1 from fact_ohlcv where is_ticker_attrs_assumed", "warn"),
        not_future("t11", "fact_restatement_history"),
        _check("fact_restatement_history", "t12_assumed_correct", lambda df, ref: assumed_wrongly(df, ref("dim_tickers")), _WRONG.format("fact_restatement_history")),
        _check("fact_restatement_history", "t13_assumed_prevalence", lambda df, ref: df.filter("is_ticker_attrs_assumed"), "select 1 from fact_restatement_history where is_ticker_attrs_assumed", "warn"),
        _check("fact_sector_correlation", "t14_canonical_order", lambda df, ref: df.filter("sector_code_a >= sector_code_b"), "select 1 from int_sector_correlation where sector_code_a >= sector_code_b"),
        not_future("t15", "fact_sector_correlation", sql_model="int_sector_correlation"),
        not_future("t16", "fact_sector_daily"),
        not_future("t17", "fact_sector_rotation"),
        not_future("t18", "fact_ticker_relationships", sql_model="int_ticker_relationships"),
        not_future("t19", "fact_valuation_daily"),
        _check("int_ohlcv_pit", "t20_can_differ", lambda df, ref: never_differs(ref),
               f"""select 1 from (select count(*) filter (where restatement_count > 1) as r,
                   count(*) filter (where restatement_count > 1 and p.close <> f.close) as d {_BOTH}) where r > 0 and d = 0""", "warn"),
        _check("int_ohlcv_pit", "t21_equal_unless_restated", lambda df, ref: close_of_both(ref).filter("restatement_count = 1 and pit <> close"),
               f"select 1 {_BOTH} where restatement_count = 1 and p.close <> f.close"),
        _check("int_sector_correlation", "t22_canonical_order", lambda df, ref: df.filter("sector_code_a >= sector_code_b"), "select 1 from int_sector_correlation where sector_code_a >= sector_code_b"),
        _check("int_technical_indicators", "t23_bollinger_order", lambda df, ref: df.filter("bollinger_upper < bollinger_mid or bollinger_mid < bollinger_lower"),
               "select 1 from int_technical_indicators where bollinger_upper < bollinger_mid or bollinger_mid < bollinger_lower"),
        _check("int_technical_indicators", "t24_macd_histogram", lambda df, ref: df.filter("abs(macd_histogram - (macd_line - macd_signal)) > 0.0001"),
               "select 1 from int_technical_indicators where abs(macd_histogram - (macd_line - macd_signal)) > 0.0001"),
        _check("int_technical_indicators", "t25_return_available", late_returns,
               """select 1 from (select trailing_return_252d, row_number() over (partition by symbol order by date) as n
                  from int_technical_indicators) where n > 252 and trailing_return_252d is null"""),
        _check("int_ticker_relationships", "t26_zero_variance", constant_price_correlated,
               """select 1 from (select ticker_key, min(date) as d0, max(date) as d1 from int_ohlcv_pit group by 1
                  having count(*) >= 252 and count(distinct close) = 1) c join int_ticker_relationships r using (ticker_key)
                  where r.date between c.d0 and c.d1 and (r.corr_vs_index_252d is not null or r.corr_vs_sector_252d is not null)"""),
        _check("fact_valuation_daily", "t27_market_cap", against_membership,
               """select 1 from fact_valuation_daily v join fact_index_membership m on v.symbol = m.symbol and v.date = m.snapshot_date
                  where abs(v.market_cap - m.market_cap_m) > 1.0""", "warn"),
        _check("fact_valuation_daily", "t28_price", against_close,
               "select 1 from fact_valuation_daily v join fact_ohlcv f on v.symbol = f.symbol and v.date = f.date where abs(v.price - f.close) > 0.01", "warn"),
        _check("stg_index_constituents", "t29_duplicates", lambda df, ref: Q.duplicates_differ(df, ["index_name", "symbol", "snapshot_date"], _CONSTITUENT),
               _dup_sql("index_constituents", "index_name, symbol, snapshot_date", _CONSTITUENT), "warn"),
        _check("stg_screener", "t30_duplicates", lambda df, ref: Q.duplicates_differ(df, ["symbol", "snapshot_date"], _SCREEN),
               _dup_sql("screener", "symbol, snapshot_date", ["sector", *_SCREEN[1:]]), "warn"),
        _check("stg_sectors", "t31_duplicates", lambda df, ref: Q.duplicates_differ(df, ["sector_code", "snapshot_date"], _SECTOR),
               _dup_sql("sectors", "sector_code, snapshot_date", _SECTOR), "warn"),
        *_generic(),
    ]


def _generic() -> list[Check]:
    """DQ-1..6: generic tests of the models' columns and grains; they run with the project."""
    out: list[Check] = []

    def of(
        model: str, required: str = "", grain: str = "", from_0: str = "", ticker: str = "", day: str = "",
        parents: dict | None = None, ranges: dict | None = None, values: dict | None = None, unique: str = "", warn: str = "",
    ) -> None:
        """``warn`` names tests that report only; ``ranges`` and ``values`` are by column."""

        def add(name: str, find=None, where=None) -> None:
            out.append(Check(model, Q.Test(name, find, "warn" if name in warn.split() else "error", where)))

        for c in required.split():
            add(f"not_null_{c}", where=lambda c=c: Q.is_missing(c))
        for c in unique.split():
            add(f"unique_{c}", lambda df, ref, c=c: Q.unique(df, c))
        if grain:
            add(f"unique_{grain.replace(' ', '_')}", lambda df, ref: Q.unique_combination(df, grain.split()))
        for c, (least, most) in {**{c: (0, None) for c in from_0.split()}, **(ranges or {})}.items():
            add(f"range_{c}", where=lambda c=c, a=least, b=most: Q.is_beyond(c, a, b))
        for c, of_ in (values or {}).items():
            add(f"accepted_{c}", where=lambda c=c, v=of_: Q.is_other_than(c, v))
        to = {**({ticker: ("dim_tickers", "scd_id")} if ticker else {}), **({day: ("dim_date", "date")} if day else {}), **(parents or {})}
        for c, (parent, key) in to.items():
            add(f"relationship_{c}", lambda df, ref, c=c, p=parent, k=key: Q.relationships(df, c, ref(p), k))

    bars = "open high low close volume"
    index = {"index_name": ("dim_indices", "index_name")}
    sector = {"sector_code": ("dim_sectors", "sector_code")}
    pair = {"sector_code_a": sector["sector_code"], "sector_code_b": sector["sector_code"]}
    betas = {f"beta_{k}_252d": (-10, 10) for k in ("full", "upside", "downside")}
    corrs = {f"corr_vs_{k}_252d": (-1, 1) for k in ("index", "sector")}
    fifths = [1, 2, 3, 4, 5]
    holding = "idx_weight market_cap_m freefloat_m shares_m current_index"

    of("stg_stock_history", "history_id symbol date", unique="history_id")
    of("stg_index_constituents", "symbol index_name snapshot_date")
    of("stg_sectors", "sector_code snapshot_date")
    of("stg_screener", "symbol snapshot_date")
    of("stg_index_price_history", "index_name date", "index_name date")
    of("stg_symbols", "symbol sector_code", warn="not_null_sector_code")
    of("dim_tickers", "sector_code", "symbol valid_from", unique="scd_id", parents=sector, warn="not_null_sector_code")
    of("dim_date", "date", unique="date")
    of("dim_sectors", "sector_code", unique="sector_code")
    of("dim_indices", "index_name", unique="index_name")
    of("int_drawdown", "symbol date", "symbol date", ranges={"max_drawdown_pct": (None, 0.0001)})
    of("int_index_constituents_pit", "index_name ticker_key snapshot_date", "index_name symbol snapshot_date", holding,
       "ticker_key", "snapshot_date", index, warn="not_null_ticker_key")
    of("int_market_returns", "date current_index", "date", "current_index", day="date")
    of("int_ohlcv_pit", "ticker_key date is_ticker_attrs_assumed", "symbol date", f"{bars} rolling_vol_200", "ticker_key", "date")
    of("int_screener_pit", "ticker_key date", "symbol date", "market_cap price", "ticker_key", "date",
       ranges={"pe_ratio": (-1000, 1000)}, warn="not_null_ticker_key range_pe_ratio")
    of("int_sector_correlation", "sector_code_a sector_code_b date", "sector_code_a sector_code_b date", day="date", parents=pair,
       ranges={"correlation_252d": (-1, 1)})
    of("int_sector_returns", "sector_code date", "sector_code date", day="date", parents=sector)
    of("int_technical_indicators", "symbol date", "symbol date", "rolling_vol_20 rolling_vol_50 rolling_vol_200", ranges={"rsi_14": (0, 100)})
    for name in ("int_ticker_relationships", "fact_ticker_relationships"):
        of(name, "ticker_key symbol date", "ticker_key date", "", "ticker_key", "date", ranges=betas | corrs,
           warn=" ".join(f"range_{c}" for c in betas))
    of("fact_ohlcv", "ticker_key date is_ticker_attrs_assumed", "symbol date", bars, "ticker_key", "date")
    of("fact_restatement_history", "ticker_key date restatement_count is_ticker_attrs_assumed", "symbol date", "", "ticker_key", "date",
       ranges={"restatement_count": (1, None)})
    of("fact_index_membership", "index_name ticker_key snapshot_date", "index_name symbol snapshot_date", holding,
       "ticker_key", "snapshot_date", index, warn="not_null_ticker_key")
    of("fact_index_ohlcv", "index_name date", "index_name date", bars, day="date", parents=index)
    of("fact_sector_daily", "sector_code date", "sector_code date", "advance decline unchanged turnover market_cap_b", day="date", parents=sector)
    of("fact_valuation_daily", "ticker_key date", "symbol date", "market_cap price", "ticker_key", "date",
       ranges={"pe_ratio": (-1000, 1000), "dividend_yield": (0, 100), "free_float": (0, 100)},
       warn="not_null_ticker_key range_pe_ratio range_dividend_yield range_free_float")
    of("fact_cross_sectional_rankings", "ticker_key date", "ticker_key date", "", "ticker_key", "date",
       values={f"{c}_quintile": fifths for c in ("momentum_63d", "relative_strength_63d", "pe_ratio", "low_vol")})
    of("fact_sector_correlation", "sector_code_a sector_code_b date", "sector_code_a sector_code_b date", day="date", parents=pair,
       ranges={"correlation_252d": (-1, 1)})
    of("fact_sector_rotation", "sector_code date", "sector_code date", day="date", parents=sector, values={"rotation_quintile": fifths})
    of("fact_technical_indicators", "ticker_key symbol date max_drawdown_pct", "symbol date", "", "ticker_key", "date",
       values={"ma_crossover_event": ["golden_cross", "death_cross"]})
    return out
