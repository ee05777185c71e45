"""DuckDB forms of the models: common table expressions, put together as a query needs them."""

from __future__ import annotations

import re


def _decayed(x: str, alpha: str, n: int) -> str:
    """Mean of x over rows b that are less than n before row a, weighted by (1 - alpha)^distance."""
    weight, near = f"power(1 - {alpha}, a.n - b.n)", f"filter (where a.n - b.n < {n})"
    return f"sum(b.{x} * {weight}) {near} / sum({weight}) {near}"


def _asof(rows: str, date: str, fallback: bool = True) -> str:
    inside = f"f.symbol = r.symbol and f.{date} >= r.valid_from and (r.valid_to is null or f.{date} < r.valid_to)"
    if not fallback:
        return f"select f.*, r.scd_id as ticker_key from {rows} f left join dim_tickers r on {inside}"
    first = "(select symbol, arg_min(scd_id, valid_from) as scd_id from dim_tickers group by symbol)"
    return f"""select f.*, coalesce(r.scd_id, e.scd_id) as ticker_key,
        case when r.scd_id is not null then false when e.scd_id is not null then true end as is_ticker_attrs_assumed
        from {rows} f left join dim_tickers r on {inside} left join {first} e on f.symbol = e.symbol"""


def _one(rows: str, keys: str, order: str) -> str:
    return f"select * from {rows} qualify row_number() over (partition by {keys} order by {order}) = 1"


def _rank(x: str, name: str, order: str, tie: str = "ticker_key") -> str:
    by = f"partition by date, {x} is null order by {x} {order}"
    return (
        f"case when {x} is not null then rank() over ({by}) end as {name}_rank, "
        f"case when {x} is not null then ntile(5) over ({by}, {tie}) end as {name}_quintile"
    )


def _corr(x: str, y: str, window: str, guard: str) -> str:
    c = f"round(corr({x}, {y}) over {window}, 12)"
    return f"case when {guard} and {c} between -1 and 1 then {c} end"




def _beta(x: str, m: str) -> str:
    return f"case when count({x}) over w >= 252 then covar_samp({x}, {m}) over w / nullif(var_samp({m}) over w, 0) end"


_UP = "case when m >= 0 then {} end"
_DOWN = "case when m < 0 then {} end"
_BY = "partition by symbol order by date"

CTES: dict[str, str] = {
    "quotes": """select o_orderkey as k, n_name as symbol, n_nationkey as nk, r_name as sector_name,
        cast(100 + r_regionkey as varchar) as sector_code, cast(o_orderdate as date) as date,
        o_orderdate + to_seconds(o_orderkey) as loaded_at, o_totalprice as px, c_acctbal as bal
        from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey
        join region on n_regionkey = r_regionkey""",
    "stock_history": """select cast(k as varchar) as history_id, symbol, date, px + (k % 3) - 1 as open,
        px + (k % 7) as high, px - (k % 5) as low, px as close, cast(k % 1000 as bigint) as volume,
        (k % 7) < (k % 3) - 1 or -(k % 5) > (k % 3) - 1 as is_anomaly,
        k = max(k) over (partition by symbol, date) as is_latest, loaded_at from quotes""",
    "index_constituents": """select 'IDX100' as index_name, symbol, date as snapshot_date,
        max(px) over (partition by date) as current_index, cast(k % 100 as double) as idx_weight,
        cast(k % 21 - 10 as double) as idx_point, bal as market_cap_m, cast(k % 50 as double) as freefloat_m,
        cast(k % 77 as double) as shares_m, loaded_at from quotes""",
    "sectors": """select sector_code, sector_name, cast(k % 9 as bigint) as advance, cast(k % 8 as bigint) as decline,
        cast(k % 3 as bigint) as unchanged, px as turnover, cast(k % 500 as double) as market_cap_b,
        date as snapshot_date, loaded_at from quotes""",
    "screener": """select symbol, sector_code as sector, case when k % 4 = 0 then 'GEM' else 'Main Board' end as listed_in,
        px * 10 as market_cap, px as price, case when k % 11 = 0 then null else cast(k % 40 - 5 as double) end as pe_ratio,
        cast(k % 12 as double) as dividend_yield, cast(k % 100 as double) as free_float,
        cast(k % 5000 as double) as volume_avg_30d, cast(k % 90 - 45 as double) as change_1y_pct,
        date as snapshot_date, loaded_at from quotes""",
    "ticker_states": """select n_name as symbol, s, eff,
        case when n_nationkey % 3 = 0 and s >= 2 then n_name || ' LTD' else n_name end as name,
        cast(100 + n_regionkey as varchar) as sector_code, n_nationkey % 2 = 0 and s >= 3 as is_etf,
        false as is_debt, n_nationkey % 4 = 0 as is_gem, true as is_margin_eligible
        from nation, (values (1, date '1996-01-01'), (2, date '1998-01-01'), (3, date '2000-01-01')) v(s, eff)
        where not (n_nationkey % 10 = 9 and s = 3)""",
    "dim_tickers": """select v.symbol, name, sector_code, is_etf, is_debt, is_gem, is_margin_eligible,
        md5(v.symbol || '|' || cast(eff as varchar)) as scd_id, eff as updated_at, eff as valid_from,
        coalesce(lead(eff) over (partition by v.symbol order by eff), g.gone) as valid_to
        from (select *, lag(name) over u as pn, lag(is_etf) over u as pe, lag(s) over u as ps from ticker_states
              window u as (partition by symbol order by s)) v
        left join (select symbol, date '2000-01-01' as gone from ticker_states group by symbol having max(s) < 3) g
            on v.symbol = g.symbol
        where ps is null or pn <> name or pe <> is_etf""",
    "latest_prices": "select symbol, date, open, high, low, close, volume, is_anomaly from stock_history where is_latest",
    "fact_ohlcv": _asof("latest_prices", "date"),
    "versions": """select symbol, date, count(*) as restatement_count, min(loaded_at) as first_loaded_at,
        max(loaded_at) as last_loaded_at from stock_history group by symbol, date""",
    "fact_restatement_history": _asof("versions", "date"),
    "latest_constituents": f"select * exclude (loaded_at) from ({_one('index_constituents', 'index_name, symbol, snapshot_date', 'loaded_at desc')})",
    "fact_index_membership": _asof("latest_constituents", "snapshot_date", False),
    "latest_screener": f"select * exclude (loaded_at, sector, snapshot_date), snapshot_date as date from ({_one('screener', 'symbol, snapshot_date', 'loaded_at desc')})",
    "fact_valuation_daily": _asof("latest_screener", "date", False),
    "fact_sector_daily": f"select * exclude (loaded_at, sector_name, snapshot_date), snapshot_date as date from ({_one('sectors', 'sector_code, snapshot_date', 'loaded_at desc, advance, decline, unchanged, turnover, market_cap_b, sector_name')})",
    "first_prices": f"select symbol, date, open, high, low, close, volume, is_anomaly from ({_one('stock_history', 'symbol, date', 'loaded_at, history_id')})",
    "first_returns": f"""select *, (close - lag(close) over w) / nullif(lag(close) over w, 0) as daily_return_pct
        from first_prices window w as ({_BY})""",
    "first_derived": f"""select *, stddev_samp(daily_return_pct) over (w rows between 199 preceding and current row) as rolling_vol_200,
        (close - lag(close, 63) over w) / nullif(lag(close, 63) over w, 0) as trailing_return_63d
        from first_returns window w as ({_BY})""".replace("(w rows", f"({_BY} rows"),
    "int_ohlcv_pit": _asof("first_derived", "date"),
    "first_constituents": f"select * exclude (loaded_at) from ({_one('index_constituents', 'index_name, symbol, snapshot_date', 'loaded_at')})",
    "int_index_constituents_pit": f"select * exclude (is_ticker_attrs_assumed) from ({_asof('first_constituents', 'snapshot_date')})",
    "first_screener": f"select symbol, snapshot_date as date, market_cap, price, pe_ratio from ({_one('screener', 'symbol, snapshot_date', 'loaded_at')})",
    "int_screener_pit": f"select * exclude (is_ticker_attrs_assumed) from ({_asof('first_screener', 'date')})",
    "steps": f"""select symbol, date, close, (close - lag(close) over w) / nullif(lag(close) over w, 0) as daily_return_pct,
        coalesce(greatest(close - lag(close) over w, 0), 0) as gain, coalesce(greatest(lag(close) over w - close, 0), 0) as loss
        from latest_prices window w as ({_BY})""",
    "rolled": f"""select symbol, date, close, daily_return_pct,
        avg(close) over w20 as ma_20, avg(close) over w50 as ma_50, avg(close) over w200 as ma_200,
        avg(gain) over w14 as g, avg(loss) over w14 as l, stddev_samp(close) over w20 as sd,
        stddev_samp(daily_return_pct) over w20 as rolling_vol_20, stddev_samp(daily_return_pct) over w50 as rolling_vol_50,
        stddev_samp(daily_return_pct) over w200 as rolling_vol_200,
        (close - lag(close, 5) over w) / nullif(lag(close, 5) over w, 0) as trailing_return_5d,
        (close - lag(close, 252) over w) / nullif(lag(close, 252) over w, 0) as trailing_return_252d
        from steps window w as ({_BY}), w14 as ({_BY} rows between 13 preceding and current row),
        w20 as ({_BY} rows between 19 preceding and current row), w50 as ({_BY} rows between 49 preceding and current row),
        w200 as ({_BY} rows between 199 preceding and current row)""",
    "numbered": f"select symbol, date, close, row_number() over ({_BY}) as n from latest_prices",
    "emas": f"""select a.symbol, a.date, a.n, {_decayed('close', '2.0/13', 90)} as ema_12, {_decayed('close', '2.0/27', 180)} as ema_26
        from numbered a join numbered b on a.symbol = b.symbol and b.n between a.n - 179 and a.n group by a.symbol, a.date, a.n""",
    "macd_line": "select symbol, date, n, ema_12, ema_26, ema_12 - ema_26 as macd_line from emas",
    "macd_signal": f"""select a.symbol, a.date, {_decayed('macd_line', '0.2', 90)} as macd_signal
        from macd_line a join macd_line b on a.symbol = b.symbol and b.n between a.n - 89 and a.n group by a.symbol, a.date""",
    "macd": "select l.*, macd_signal from macd_line l join macd_signal using (symbol, date)",
    "int_technical_indicators": """select r.symbol, r.date, r.close, r.daily_return_pct, ma_20, ma_50, ma_200,
        case when l = 0 and g = 0 then null when l = 0 then 100 else 100 - 100 / (1 + g / l) end as rsi_14,
        ma_20 + 2 * sd as bollinger_upper, ma_20 as bollinger_mid, ma_20 - 2 * sd as bollinger_lower,
        rolling_vol_20, rolling_vol_50, rolling_vol_200, trailing_return_5d, trailing_return_252d,
        ema_12, ema_26, macd_line, macd_signal, macd_line - macd_signal as macd_histogram
        from rolled r join macd using (symbol, date)""",
    "int_drawdown": f"""select symbol, date, (close - max(close) over w) / nullif(max(close) over w, 0) as max_drawdown_pct
        from latest_prices window w as ({_BY} rows between unbounded preceding and current row)""",
    "fact_technical_indicators": f"""select i.*, d.max_drawdown_pct, o.ticker_key,
        case when lag(sign(ma_50 - ma_200)) over w <= 0 and sign(ma_50 - ma_200) > 0 then 'golden_cross'
             when lag(sign(ma_50 - ma_200)) over w >= 0 and sign(ma_50 - ma_200) < 0 then 'death_cross' end as ma_crossover_event
        from int_technical_indicators i left join int_drawdown d using (symbol, date) left join fact_ohlcv o using (symbol, date)
        window w as (partition by i.symbol order by i.date)""",
    "market_level": """select snapshot_date as date, arg_min(current_index, symbol) as current_index
        from int_index_constituents_pit where index_name = 'IDX100' and current_index is not null group by snapshot_date""",
    "int_market_returns": """select date, current_index,
        (current_index - lag(current_index) over w) / nullif(lag(current_index) over w, 0) as daily_return_pct,
        (current_index - lag(current_index, 63) over w) / nullif(lag(current_index, 63) over w, 0) as trailing_return_63d
        from market_level window w as (order by date)""",
    "weights": """select ticker_key, snapshot_date as date,
        lag(market_cap_m) over (partition by ticker_key order by snapshot_date) as cap
        from int_index_constituents_pit where index_name = 'IDX100'""",
    "sector_daily": """select t.sector_code, o.date, sum(daily_return_pct * cap) / sum(cap) as daily_return_pct
        from int_ohlcv_pit o join dim_tickers t on o.ticker_key = t.scd_id
        join weights w on o.ticker_key = w.ticker_key and o.date = w.date
        where daily_return_pct is not null and cap > 0 group by t.sector_code, o.date""",
    "int_sector_returns": """select *, case when count(case when daily_return_pct > -1 then 1 end) over w = 63
        then exp(sum(case when daily_return_pct > -1 then ln(1 + daily_return_pct) end) over w) - 1 end as trailing_return_63d
        from sector_daily window w as (partition by sector_code order by date rows between 62 preceding and current row)""",
    "related": """select o.ticker_key, o.symbol, o.date, o.daily_return_pct as r, m.daily_return_pct as m, s.daily_return_pct as s
        from int_ohlcv_pit o join dim_tickers t on o.ticker_key = t.scd_id left join int_market_returns m on o.date = m.date
        left join int_sector_returns s on t.sector_code = s.sector_code and o.date = s.date""",
    "int_ticker_relationships": f"""select ticker_key, symbol, date, {_beta('r', 'm')} as beta_full_252d,
        {_beta(_UP.format('r'), _UP.format('m'))} as beta_upside_252d,
        {_beta(_DOWN.format('r'), _DOWN.format('m'))} as beta_downside_252d,
        {_corr('r', 'm', 'w', 'count(r) over w >= 252')} as corr_vs_index_252d,
        {_corr('r', 's', 'w', 'count(r) over w >= 252')} as corr_vs_sector_252d
        from related window w as ({_BY} rows between 251 preceding and current row)""",
    "sector_pairs": """select a.sector_code as sector_code_a, b.sector_code as sector_code_b, a.date,
        a.daily_return_pct as x, b.daily_return_pct as y from int_sector_returns a join int_sector_returns b
        on a.date = b.date and a.sector_code < b.sector_code""",
    "int_sector_correlation": f"""select sector_code_a, sector_code_b, date, {_corr('x', 'y', 'w', 'true')} as correlation_252d
        from sector_pairs window w as (partition by sector_code_a, sector_code_b order by date rows between 251 preceding and current row)""",
    "rotation": """select s.sector_code, s.date, s.trailing_return_63d as sector_return_63d,
        s.trailing_return_63d - m.trailing_return_63d as relative_strength_vs_market_63d
        from int_sector_returns s left join int_market_returns m on s.date = m.date""",
    "fact_sector_rotation": f"select *, {_rank('relative_strength_vs_market_63d', 'rotation', 'desc', 'sector_code')} from rotation",
    "universe": """select u.ticker_key, u.date, p.trailing_return_63d as momentum_63d,
        p.trailing_return_63d - m.trailing_return_63d as relative_strength_63d,
        case when v.pe_ratio > 0 then v.pe_ratio end as pe_ratio, p.rolling_vol_200
        from (select distinct ticker_key, snapshot_date as date from int_index_constituents_pit
              where index_name = 'IDX100' and ticker_key is not null) u
        left join int_ohlcv_pit p on u.ticker_key = p.ticker_key and u.date = p.date
        left join int_market_returns m on u.date = m.date
        left join int_screener_pit v on u.ticker_key = v.ticker_key and u.date = v.date""",
    "fact_cross_sectional_rankings": f"""select *, {_rank('momentum_63d', 'momentum_63d', 'desc')},
        {_rank('relative_strength_63d', 'relative_strength_63d', 'desc')}, {_rank('pe_ratio', 'pe_ratio', 'asc')},
        {_rank('rolling_vol_200', 'low_vol', 'asc')} from universe""",
    "index_prices": """select 'IDX100' as index_name, date, arg_min(px, k) as open, max(px) as high, min(px) as low,
        arg_max(px, k) as close, count(*) as volume from quotes group by date""",
}


def query(final: str) -> str:
    """The final select with the expressions that it and they read, in order."""
    needed: list[str] = []

    def visit(sql: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"(?:from|join|,)\s+\(*\s*{name}\b", sql):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(final)
    if not needed:
        return final
    head = "with " + ",\n".join(f"{n} as ({CTES[n]})" for n in needed)
    own = final.lstrip()
    return f"{head},\n{own[5:]}" if own.startswith("with ") else f"{head}\n{final}"
