"""The registered queries of the warehouse, each beside its DuckDB form."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import rolling as R
from ..operators import quality as Q
from ..operators.asof import asof_strict, asof_with_fallback
from ..operators.merge import Table, merge_upsert, with_buffer
from ..operators.versioning import delisted, diff, empty_dimension, ohlcv_hash, scd2, supersede, symbol_hash
from ..sources import calendar, market, seed
from ..sources.storage import shared_path, written
from ..streaming.ingest import ingest_available
from . import models
from .checks import checks
from .oracle import query
from .registry import Model, Project

#: Today, for the registered data tests: so that some rows lie after it.
AS_OF = dt.date(2001, 7, 1)

_TABLES = {"dim_date", "dim_sectors", "dim_indices", "int_drawdown", "int_market_returns", "int_sector_returns"}
_INCREMENTAL = {
    "int_ohlcv_pit": ("symbol", "date"),
    "int_technical_indicators": ("symbol", "date"),
    "int_ticker_relationships": ("ticker_key", "date"),
    "int_sector_correlation": ("sector_code_a", "sector_code_b", "date"),
    "fact_cross_sectional_rankings": ("ticker_key", "date"),
    "fact_technical_indicators": ("symbol", "date"),
}
#: Models without a date, and those whose date column has another name (SNK-12).
_UNDATED = {"dim_tickers", "dim_date", "dim_sectors", "dim_indices", "stg_symbols"}
_BY = {n: "snapshot_date" for n in ("stg_sectors", "stg_screener", "stg_index_constituents", "fact_index_membership", "int_index_constituents_pit")}
MODEL_NAMES = ["dim_tickers", "dim_date"] + [
    n for n in vars(models) if n.startswith(("stg_", "dim_", "int_", "fact_"))
]
#: What a query of a model reads in several branches: written once before.
STAGED = {
    "int_ticker_relationships": ("dim_tickers", "int_ohlcv_pit", "int_index_constituents_pit"),
    "int_sector_correlation": ("dim_tickers", "int_sector_returns"),
    "fact_sector_rotation": ("dim_tickers", "int_index_constituents_pit"),
    "fact_cross_sectional_rankings": ("dim_tickers", "int_index_constituents_pit"),
    "int_sector_returns": ("dim_tickers",),
}
#: Data tests that the star schema's made-up values break, as account balances stand for capitalisations.
ONLY_WARN = frozenset(
    (m, t)
    for m, t in (
        ("fact_index_membership", "range_market_cap_m"),
        ("int_index_constituents_pit", "range_market_cap_m"),
    )
)


def dim_tickers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SNK-11: the dimension after three snapshots."""
    dim = None
    for i, day in enumerate(market.STATES, 1):
        source = market.tickers(spark, sf_dir, i)
        dim = scd2(empty_dimension(spark, source) if dim is None else dim, source, day)
    return dim


def project(
    spark: SparkSession, sf_dir: str, staged: tuple[str, ...] = (), today: dt.date = AS_OF, index: str = market.INDEX
) -> Project:
    """The warehouse over the tables of a folder; ``index`` names the market's index (FLT-2)."""
    sources = {n: (lambda f=getattr(market, n): f(spark, sf_dir)) for n in ("stock_history", "index_constituents", "sectors", "screener", "index_prices")}
    sources["symbols"] = lambda: market.raw_symbols(spark, sf_dir, 3)
    return warehouse(spark, sources, lambda: dim_tickers(spark, sf_dir), staged, today, index, only_warn=ONLY_WARN)


def store_project(spark: SparkSession, store, seed_csv: str, today: dt.date, index: str = market.INDEX) -> Project:
    """The warehouse over a store of raw tables, with the index's price history from a seed file (SRC-8)."""
    sources = {n: (lambda n=n: store.read(n)) for n in ("stock_history", "index_constituents", "sectors", "screener")}
    sources["symbols"] = lambda: store.read("symbols").filter("is_latest")
    sources["index_prices"] = lambda: seed.read_seed(spark, seed_csv)
    return warehouse(spark, sources, today=today, index=index)


def warehouse(
    spark: SparkSession,
    sources: dict[str, Callable[[], DataFrame]],
    first_dimension: Callable[[], DataFrame] | None = None,
    staged: tuple[str, ...] = (),
    today: dt.date = AS_OF,
    index: str = market.INDEX,
    calendar_from: str = "1990-01-01",
    only_warn: frozenset = frozenset(),
) -> Project:
    """All models over raw tables by name.

    The dimension of tickers begins as ``first_dimension`` gives it, or empty, and every build takes a
    snapshot of the current attributes at ``today``.
    """

    def snapshot(ref, before):
        if before is None and first_dimension is not None:
            return first_dimension()
        source = ref("stg_symbols")
        return scd2(empty_dimension(spark, source) if before is None else before, source, today)

    tests: dict[str, list] = {}
    for check in checks(today):
        tests.setdefault(check.model, []).append(check.test)
    built = []
    for name in MODEL_NAMES:
        build = getattr(models, name, None)
        if name == "dim_tickers":
            kind, build = "snapshot", snapshot
        elif name == "dim_date":
            kind, build = "table", lambda ref: calendar.dim_date(spark, calendar_from)
        else:
            kind = "table" if name in _TABLES or name.startswith("fact_") else "view"
        if name in _INCREMENTAL:
            kind = "incremental"
        if name in models.OF_INDEX:
            build = lambda ref, f=build: f(ref, index)
        by = None if name in _UNDATED else _BY.get(name, "date")
        cluster = ("symbol", "ticker_key", "sector_code", "sector_code_a")
        built.append(Model(name, build, kind, _INCREMENTAL.get(name, ()), tuple(tests.get(name, ())), by, cluster))
    return Project(built, sources, staged, written, only_warn)


# -- queries whose columns read alike in both engines --------------------------------------------

_r9 = lambda *names: [f"round({n}, 9) as {n}" for n in names]
_per = lambda *names: [f"round({n} / close, 9) as {n}_ratio" for n in names]
_big = lambda *names: [f"cast({n} as bigint) as {n}" for n in names]
_KEY = ["ticker_key", "symbol", "date"]
_IND = ["symbol", "date"]

#: name -> (model or source, columns)
SELECTS: dict[str, tuple[str, list[str]]] = {
    "stg_stock_history": ("stock_history", ["history_id", *models.PRICE, "is_latest"]),
    "stg_screener": ("screener", ["symbol", "sector as sector_code_raw", "listed_in", "market_cap", "price", "pe_ratio", "snapshot_date"]),
    "stg_sectors": ("sectors", ["sector_code", "sector_name", "advance", "decline", "unchanged", "turnover", "market_cap_b", "snapshot_date"]),
    "stg_index_constituents": ("index_constituents", ["index_name", "symbol", "snapshot_date", "current_index", "idx_weight", "idx_point", "market_cap_m", "freefloat_m", "shares_m"]),
    "dim_tickers_scd2": ("dim_tickers", ["symbol", "name", "sector_code", "is_etf", "is_debt", "is_gem", "is_margin_eligible", "scd_id", "updated_at", "valid_from", "valid_to"]),
    "fact_ohlcv": ("fact_ohlcv", [*_KEY, "open", "high", "low", "close", "volume", "is_anomaly", "is_ticker_attrs_assumed"]),
    "fact_restatement_history": ("fact_restatement_history", [*_KEY, "restatement_count", "first_loaded_at", "last_loaded_at", "is_ticker_attrs_assumed"]),
    "fact_index_membership": ("fact_index_membership", ["index_name", "symbol", "snapshot_date", "ticker_key", "current_index", "idx_weight", "idx_point", "market_cap_m", "freefloat_m", "shares_m"]),
    "fact_valuation_daily": ("fact_valuation_daily", [*_KEY, "market_cap", "price", "pe_ratio", "dividend_yield", "free_float", "volume_avg_30d", "change_1y_pct", "listed_in"]),
    "fact_sector_daily": ("fact_sector_daily", ["sector_code", "date", "advance", "decline", "unchanged", "turnover", "market_cap_b"]),
    "fact_index_ohlcv": ("index_prices", ["index_name", "date", "open", "high", "low", "close", "volume"]),
    "int_ohlcv_pit": ("int_ohlcv_pit", [*_KEY, "open", "high", "low", "close", "volume", "is_anomaly", *_r9("daily_return_pct", "rolling_vol_200", "trailing_return_63d"), "is_ticker_attrs_assumed"]),
    "int_index_constituents_pit": ("int_index_constituents_pit", ["index_name", "symbol", "snapshot_date", "ticker_key", "current_index", "idx_weight", "idx_point", "market_cap_m", "freefloat_m", "shares_m"]),
    "int_screener_pit": ("int_screener_pit", [*_KEY, "market_cap", "price", "pe_ratio"]),
    "returns_daily": ("int_technical_indicators", [*_IND, *_r9("daily_return_pct")]),
    "trailing_returns": ("int_technical_indicators", [*_IND, *_r9("trailing_return_5d", "trailing_return_252d")]),
    "sma": ("int_technical_indicators", [*_IND, *_per("ma_20", "ma_50", "ma_200")]),
    "rolling_vol": ("int_technical_indicators", [*_IND, *_r9("rolling_vol_20", "rolling_vol_50", "rolling_vol_200")]),
    "bollinger": ("int_technical_indicators", [*_IND, *_per("bollinger_upper", "bollinger_mid", "bollinger_lower")]),
    "rsi_14": ("int_technical_indicators", [*_IND, *_r9("rsi_14")]),
    "ema_truncated": ("int_technical_indicators", [*_IND, *_per("ema_12", "ema_26")]),
    "macd": ("int_technical_indicators", [*_IND, *_per("macd_line", "macd_signal", "macd_histogram")]),
    "ma_crossover": ("fact_technical_indicators", [*_IND, "ma_crossover_event"]),
    "drawdown": ("int_drawdown", [*_IND, *_r9("max_drawdown_pct")]),
    "fact_technical_indicators": ("fact_technical_indicators", [*_KEY, *_r9("daily_return_pct"), *_per("ma_20", "ma_50", "ma_200", "macd_line", "macd_signal", "macd_histogram", "bollinger_upper", "bollinger_mid", "bollinger_lower"), *_r9("rsi_14", "rolling_vol_20", "rolling_vol_50", "rolling_vol_200", "trailing_return_5d", "trailing_return_252d", "max_drawdown_pct"), "ma_crossover_event"]),
    "int_market_returns": ("int_market_returns", ["date", "current_index", *_r9("daily_return_pct", "trailing_return_63d")]),
    "int_sector_returns": ("int_sector_returns", ["sector_code", "date", *_r9("daily_return_pct")]),
    "compound_63d": ("int_sector_returns", ["sector_code", "date", "round(ln(1 + trailing_return_63d), 9) as log_return_63d"]),
    "beta_252": ("int_ticker_relationships", [*_KEY, *_r9("beta_full_252d", "beta_upside_252d", "beta_downside_252d")]),
    "corr_vs_index": ("int_ticker_relationships", [*_KEY, *_r9("corr_vs_index_252d")]),
    "corr_vs_sector": ("int_ticker_relationships", [*_KEY, *_r9("corr_vs_sector_252d")]),
    "fact_ticker_relationships": ("int_ticker_relationships", [*_KEY, *_r9("beta_full_252d", "beta_upside_252d", "beta_downside_252d", "corr_vs_index_252d", "corr_vs_sector_252d")]),
    "sector_correlation": ("int_sector_correlation", ["sector_code_a", "sector_code_b", "date", *_r9("correlation_252d")]),
    "sector_rotation": ("fact_sector_rotation", ["sector_code", "date", "round(ln(1 + sector_return_63d), 9) as sector_log_return_63d", *_big("rotation_rank", "rotation_quintile")]),
    "cross_sectional_rankings": ("fact_cross_sectional_rankings", ["ticker_key", "date", *_r9("momentum_63d", "relative_strength_63d", "rolling_vol_200"), "pe_ratio", *_big("momentum_63d_rank", "momentum_63d_quintile", "relative_strength_63d_rank", "relative_strength_63d_quintile", "pe_ratio_rank", "pe_ratio_quintile", "low_vol_rank", "low_vol_quintile")]),
}


def _select(name: str) -> Callable[[SparkSession, str], DataFrame]:
    model, columns = SELECTS[name]
    return lambda spark, sf_dir: project(spark, sf_dir, STAGED.get(model, ())).ref(model).selectExpr(*columns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: _select(n) for n in SELECTS}
ORACLE: dict[str, str] = {n: query(f"select {', '.join(c)} from {m}") for n, (m, c) in SELECTS.items()}


def register(name: str, sql: str | None):
    def add(f):
        QUERIES[name] = f
        if sql is not None:
            ORACLE[name] = query(sql)
        return f

    return add


# -- dimensions and sources -----------------------------------------------------------------------


@register(
    "dim_date",
    """select cast(d as date) as date, year(d) as year, quarter(d) as quarter, month(d) as month, day(d) as day,
       dayofweek(d) + 1 as day_of_week, dayname(d) as day_name, week(d) as week_of_year,
       cast(d as date) = last_day(d) as is_month_end,
       cast(d as date) = last_day(date_trunc('quarter', d) + interval 2 month) as is_quarter_end,
       month(d) = 12 and day(d) = 31 as is_year_end
       from (select unnest(generate_series(timestamp '2000-01-01', timestamp '2035-12-30', interval 1 day)) as d)""",
)
def _dim_date(spark, sf_dir):
    return calendar.dim_date(spark)


@register("dim_sectors", "select sector_code, arg_max(sector_name, snapshot_date) as sector_name from sectors group by sector_code")
def _dim_sectors(spark, sf_dir):
    return project(spark, sf_dir).ref("dim_sectors")


@register("dim_indices", "select distinct index_name from index_constituents")
def _dim_indices(spark, sf_dir):
    return project(spark, sf_dir).ref("dim_indices")


@register(
    "stg_symbols_sector_map",
    """select t.symbol, t.name, m.sector_code, t.is_etf, t.is_debt, t.is_gem, t.is_margin_eligible
       from (select s.*, ' ' || lower(r_name) as sector_name from ticker_states s join region on cast(100 + r_regionkey as varchar) = s.sector_code where s.s = 3) t
       left join (select upper(trim(sector_name)) as n, arg_max(sector_code, snapshot_date) as sector_code from sectors group by 1) m
       on upper(trim(t.sector_name)) = m.n""",
)
def _stg_symbols(spark, sf_dir):
    return project(spark, sf_dir).ref("stg_symbols")


_EXPORT = [
    ("01/04/2010", "9,500.25", "9,400.00", "9,550.75", "9,390.10", "1.5M", "-0.35%"),
    ("01/05/2010", "1,234.50", "1,230.00", "1,240.00", "1,229.99", "2K", "1.05%"),
    ("12/31/2012", "17000", "16,900", "17,010", "16,890", "", "0%"),
    ("02/29/2016", "31,369.51", "31,400.00", "31,500.00", "31,300.00", "0.25B", "-1.10%"),
    ("07/01/2019", "33,901.58", "33,900.00", "34,000.00", "33,800.00", "12,345", "2.5%"),
]


@register(
    "seed_parse",
    """select * from (values
        ('IDX100', date '2010-01-04', 9400.0::double, 9550.75::double, 9390.1::double, 9500.25::double, 1500000::bigint, -0.35::double),
        ('IDX100', date '2010-01-05', 1230.0, 1240.0, 1229.99, 1234.5, 2000, 1.05),
        ('IDX100', date '2012-12-31', 16900.0, 17010.0, 16890.0, 17000.0, null, 0.0),
        ('IDX100', date '2016-02-29', 31400.0, 31500.0, 31300.0, 31369.51, 250000000, -1.1),
        ('IDX100', date '2019-07-01', 33900.0, 34000.0, 33800.0, 33901.58, 12345, 2.5)
    ) t(index_name, date, open, high, low, close, volume, change_pct)""",
)
def _seed_parse(spark, sf_dir):
    columns = ["Date", "Price", "Open", "High", "Low", "Vol.", "Change %"]
    return seed.normalise(spark.createDataFrame(_EXPORT, columns), market.INDEX)


# -- versions -------------------------------------------------------------------------------------

_HASH = """sha256(concat_ws('|', symbol, strftime(date, '%Y-%m-%d'), printf('%.4f', open), printf('%.4f', high),
    printf('%.4f', low), printf('%.4f', close), cast(volume as varchar), case when is_anomaly then 'True' else 'False' end))"""


@register("row_hash_ohlcv", f"select history_id, {_HASH} as row_hash from stock_history")
def _row_hash(spark, sf_dir):
    return market.stock_history(spark, sf_dir).select("history_id", ohlcv_hash().alias("row_hash"))


@register(
    "row_hash_symbol",
    """select s.symbol, s.s as state, sha256(concat_ws('|', s.symbol, name, ' ' || lower(r_name),
         case when is_etf then 'True' else 'False' end, 'False', case when is_gem then 'True' else 'False' end, 'True')) as row_hash
       from ticker_states s join region on cast(100 + r_regionkey as varchar) = s.sector_code""",
)
def _row_hash_symbol(spark, sf_dir):
    parts = [
        market.raw_symbols(spark, sf_dir, i).select("symbol", F.lit(i).alias("state"), symbol_hash().alias("row_hash"))
        for i in (1, 2, 3)
    ]
    return parts[0].union(parts[1]).union(parts[2])


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("row_hash", ohlcv_hash())


def _first_prices(spark, sf_dir):
    from ..operators.dedup import first_observed

    return first_observed(market.stock_history(spark, sf_dir), ["symbol", "date"], tie=["history_id"])


@register(
    "diff_new_changed",
    f"""with old as (select symbol, date, {_HASH} as h from first_prices where date < date '2000-01-01'),
        fresh as (select symbol, date, {_HASH} as h from latest_prices where date >= date '1997-01-01')
        select f.symbol, f.date, case when o.h is null then 'new' when o.h <> f.h then 'changed' else 'same' end as change
        from fresh f left join old o using (symbol, date)""",
)
def _diff(spark, sf_dir):
    old = _hashed(_first_prices(spark, sf_dir).filter(F.col("date") < dt.date(2000, 1, 1)))
    fresh = market.stock_history(spark, sf_dir).filter("is_latest").filter(F.col("date") >= dt.date(1997, 1, 1))
    return diff(_hashed(fresh), old, ["symbol", "date"]).select("symbol", "date", "change")


@register(
    "diff_delisted",
    "select symbol from (select symbol from ticker_states where s = 2) a where symbol not in (select symbol from ticker_states where s = 3)",
)
def _delisted(spark, sf_dir):
    return delisted(market.tickers(spark, sf_dir, 3), market.tickers(spark, sf_dir, 2), ["symbol"])


@register(
    "supersede_guard",
    """select p.symbol, p.date, not (v.restatement_count > 1 and p.loaded_at < timestamp '1998-01-01') as is_latest,
       case when v.restatement_count > 1 and p.loaded_at < timestamp '1998-01-01' then timestamp '1998-01-01' end as superseded_at
       from (select * from stock_history qualify row_number() over (partition by symbol, date order by loaded_at, history_id) = 1) p
       join versions v using (symbol, date)""",
)
def _supersede(spark, sf_dir):
    at = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    rows = _first_prices(spark, sf_dir).select("symbol", "date", F.lit(True).alias("is_latest"), "loaded_at")
    rows = rows.withColumn("superseded_at", F.lit(None).cast("timestamp_ntz"))
    gone = market.stock_history(spark, sf_dir).groupBy("symbol", "date").count().filter("count > 1")
    return supersede(rows, gone, ["symbol", "date"], at, at).drop("loaded_at")


@register(
    "pit_vs_latest_diff",
    """select p.symbol, p.date, p.close as pit_close, f.close as latest_close, v.restatement_count
       from int_ohlcv_pit p join fact_ohlcv f using (symbol, date) join versions v using (symbol, date) where p.close <> f.close""",
)
def _pit_vs_latest(spark, sf_dir):
    p = project(spark, sf_dir)
    a = p.ref("int_ohlcv_pit").select("symbol", "date", F.col("close").alias("pit_close"))
    b = p.ref("fact_ohlcv").select("symbol", "date", F.col("close").alias("latest_close"))
    c = p.ref("fact_restatement_history").select("symbol", "date", "restatement_count")
    return a.join(b, ["symbol", "date"]).join(c, ["symbol", "date"]).filter("pit_close <> latest_close")


@register(
    "asof_strict",
    """select f.symbol, f.date, r.scd_id as ticker_key from latest_prices f left join dim_tickers r
       on f.symbol = r.symbol and f.date >= r.valid_from and (r.valid_to is null or f.date < r.valid_to)""",
)
def _asof_strict(spark, sf_dir):
    rows = market.stock_history(spark, sf_dir).filter("is_latest").select("symbol", "date")
    return asof_strict(rows, dim_tickers(spark, sf_dir), "date")


@register("asof_with_fallback", "select symbol, date, ticker_key, is_ticker_attrs_assumed from fact_ohlcv")
def _asof_fallback(spark, sf_dir):
    rows = market.stock_history(spark, sf_dir).filter("is_latest").select("symbol", "date")
    return asof_with_fallback(rows, dim_tickers(spark, sf_dir), "date")


@register(
    "merge_upsert",
    """select symbol, date, close from latest_prices where date < date '1998-01-01'
       union all select symbol, date, close from first_prices where date >= date '1998-01-01'""",
)
def _merge(spark, sf_dir):
    target = market.stock_history(spark, sf_dir).filter("is_latest").filter(F.col("date") < dt.date(1999, 1, 1))
    batch = _first_prices(spark, sf_dir).filter(F.col("date") >= dt.date(1998, 1, 1))
    columns = ["symbol", "date", "close"]
    return merge_upsert(target.select(*columns), batch.select(*columns), ["symbol", "date"])


@register(
    "incremental_indicators",
    """select symbol, date, round(ma_200 / close, 9) as ma_200_ratio, round(trailing_return_252d, 9) as trailing_return_252d,
       round(macd_signal / close, 9) as macd_signal_ratio
       from (select *, row_number() over (partition by symbol order by date desc) as e from int_technical_indicators) where e <= 30""",
)
def _incremental(spark, sf_dir):
    """The last 30 rows of each symbol, computed from a buffer of rows that the longest chain needs."""
    rows = market.stock_history(spark, sf_dir).filter("is_latest")
    buffered = with_buffer(rows, "symbol", "date", 30, 89 + 179 + models.YEAR)
    written = buffered.filter("_write").select("symbol", "date")
    batch = models.int_technical_indicators(lambda _: buffered)
    return batch.join(written, ["symbol", "date"], "left_semi").selectExpr(
        "symbol", "date", *_per("ma_200"), *_r9("trailing_return_252d"), *_per("macd_signal")
    )


@register("stream_ingest", "select symbol, date, close from latest_prices")
def _stream(spark, sf_dir):
    """Orders arrive as files; the newest version of each nation and day is kept."""
    orders = market.read(spark, sf_dir, "orders")
    customer = market.read(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = market.read(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    def shape(batch: DataFrame) -> DataFrame:
        joined = batch.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        return joined.select(
            F.col("n_name").alias("symbol"), F.to_date("o_orderdate").alias("date"), F.col("o_totalprice").alias("close"), F.col("o_orderkey").alias("k")
        )

    table = Table(spark, shared_path(spark, "prices"), "date", ("symbol",))
    done = ingest_available(spark, sf_dir, "orders.parquet", orders.schema, shape, table, ["symbol", "date"], "k")
    return done.select("symbol", "date", "close")


# -- a denser market: events as bars --------------------------------------------------------------


@register(
    "event_bars",
    """with bars as (select event_type as symbol, cast(ts as date) as date, arg_max(value, event_id) as close, count(*) as volume
         from events group by 1, 2)
       select symbol, date, volume, round(avg(close) over w5 / avg(close) over w20, 9) as ma_5_to_20,
         round(stddev_samp(close) over w20 / avg(close) over w20, 9) as spread_20
       from bars window w5 as (partition by symbol order by date rows between 4 preceding and current row),
         w20 as (partition by symbol order by date rows between 19 preceding and current row)""",
)
def _event_bars(spark, sf_dir):
    bars = market.read(spark, sf_dir, "events").groupBy(F.col("event_type").alias("symbol"), F.to_date("ts").alias("date")).agg(
        F.max_by("value", "event_id").alias("close"), F.count("*").alias("volume")
    )
    w5, w20, x = R.last_rows(5, "symbol"), R.last_rows(20, "symbol"), F.col("close")
    return bars.select(
        "symbol",
        "date",
        "volume",
        F.round(F.try_divide(F.avg(x).over(w5), F.avg(x).over(w20)), 9).alias("ma_5_to_20"),
        F.round(F.try_divide(F.stddev_samp(x).over(w20), F.avg(x).over(w20)), 9).alias("spread_20"),
    )


# -- data tests -----------------------------------------------------------------------------------


def _count(name: str, find, sql: str) -> None:
    @register(name, f"select count(*) as violations from ({sql})")
    def run(spark, sf_dir):
        return find(project(spark, sf_dir, ("dim_tickers",)).ref).agg(F.count("*").alias("violations"))


_count("dq_not_null", lambda ref: Q.not_null(ref("stg_screener"), "pe_ratio"), "select 1 from screener where pe_ratio is null")
_count("dq_unique", lambda ref: Q.unique(ref("stg_stock_history"), "symbol"), "select symbol from stock_history group by 1 having count(*) > 1")
_count(
    "dq_unique_combination",
    lambda ref: Q.unique_combination(ref("stg_stock_history"), ["symbol", "date"]),
    "select symbol, date from stock_history group by 1, 2 having count(*) > 1",
)
_count(
    "dq_relationships",
    lambda ref: Q.relationships(ref("stg_stock_history"), "symbol", ref("dim_tickers").filter("valid_to is null"), "symbol"),
    "select 1 from stock_history where symbol not in (select symbol from dim_tickers where valid_to is null)",
)
_count(
    "dq_accepted_values",
    lambda ref: Q.accepted_values(ref("stg_screener"), "listed_in", ["Main Board"], "price > 1000"),
    "select 1 from screener where price > 1000 and listed_in not in ('Main Board')",
)
_count(
    "dq_accepted_range",
    lambda ref: Q.accepted_range(ref("int_technical_indicators"), "rsi_14", 30, 70),
    "select 1 from int_technical_indicators where rsi_14 < 30 or rsi_14 > 70",
)

for _check in checks(AS_OF):
    if _check.sql is not None:
        _count(f"dq_{_check.test.name}", lambda ref, c=_check: c.test.find(ref(c.model), ref), _check.sql)
