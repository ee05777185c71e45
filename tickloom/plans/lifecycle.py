"""Registered queries of what keeps state: the raw store, a feed's run, seeds, partitions, builds.

Each works in a new folder of the shared storage and returns what it then reads there.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_observed
from ..operators.merge import Table
from ..operators.versioning import ohlcv_hash, symbol_hash
from ..sources import feeds, market, seed
from ..sources.storage import shared_path
from . import models
from .catalog import _HASH, dim_tickers, project, register
from .registry import Model, Project

_T = [dt.datetime(2002, 1, d, 12) for d in (1, 2, 3)]
_FIRST, _LAST = dt.date(1998, 1, 1), dt.date(1999, 1, 1)


def _at(i: int):
    return F.lit(_T[i]).cast("timestamp")


def _store(spark: SparkSession) -> feeds.ParquetStore:
    store = feeds.open_store("parquet", spark, shared_path(spark, "raw"))
    store.ensure()
    return store


def _first(spark, sf_dir) -> DataFrame:
    return first_observed(market.stock_history(spark, sf_dir), ["symbol", "date"], tie=["history_id"])


def _hashed(rows: DataFrame) -> DataFrame:
    required = ["symbol", "date", "open", "high", "low", "close", "volume", "is_anomaly"]
    return rows.select(*required).withColumn("row_hash", ohlcv_hash())


@register(
    "raw_store_prices",
    f"""with a as (select *, {_HASH} as h from first_prices where date < date '{_LAST}'),
        b as (select *, {_HASH} as h from latest_prices where date >= date '{_FIRST}')
        select a.symbol, a.date, a.close, b.h is null or b.h = a.h as is_latest, b.h is not null and b.h <> a.h as closed
        from a left join b using (symbol, date)
        union all
        select b.symbol, b.date, b.close, true, false from b left join a using (symbol, date) where a.h is null or a.h <> b.h""",
)
def _raw_store_prices(spark, sf_dir):
    """SNK-1, SNK-2, SNK-4, SRC-1, SRC-12, VER-3: two loads that overlap for a year."""
    store, keys = _store(spark), ["symbol", "date"]
    store.ingest("stock_history", _hashed(_first(spark, sf_dir).filter(F.col("date") < F.lit(_LAST))), keys, "history_id", _at(0), False)
    latest = market.stock_history(spark, sf_dir).filter("is_latest").filter(F.col("date") >= F.lit(_FIRST))
    store.ingest("stock_history", _hashed(latest), keys, "history_id", _at(1), False)
    return store.read("stock_history").select("symbol", "date", "close", "is_latest", F.col("superseded_at").isNotNull().alias("closed"))


@register(
    "raw_store_hashes",
    f"""select symbol, date, {_HASH} as row_hash from first_prices where symbol in ('NATION_3', 'NATION_7')""",
)
def _raw_store_hashes(spark, sf_dir):
    """SRC-10: the latest hashes of a symbol, of two symbols here."""
    store = _store(spark)
    store.ingest("stock_history", _hashed(_first(spark, sf_dir)), ["symbol", "date"], "history_id", _at(0), False)
    parts = [store.latest_hashes("stock_history", ["symbol", "date"], s) for s in ("NATION_3", "NATION_7")]
    return parts[0].union(parts[1])


@register(
    "raw_store_symbols",
    """select symbol, name, is_etf, since as loaded, until = 3 as is_latest
       from (select symbol, name, is_etf, min(s) as since, max(s) as until from ticker_states group by symbol, name, is_etf)""",
)
def _raw_store_symbols(spark, sf_dir):
    """SNK-3, SNK-5, SRC-11, VER-5: three loads of the ticker list; some change, two vanish."""
    store = _store(spark)
    columns = ["symbol", "name", "sector_name", "is_etf", "is_debt", "is_gem", "is_margin_eligible", "row_hash"]
    for i in (1, 2, 3):
        rows = market.raw_symbols(spark, sf_dir, i).withColumn("row_hash", symbol_hash()).select(*columns)
        store.ingest("symbols", rows, ["symbol"], "ticker_attr_id", _at(i - 1), True)
    loaded = (F.dayofmonth("loaded_at")).alias("loaded")
    return store.read("symbols").select("symbol", "name", "is_etf", loaded, "is_latest")


@register(
    "raw_store_snapshots",
    """select 'index_constituents' as name, strftime(snapshot_date, '%Y-%m') as part, 2 * count(*) as n from index_constituents group by all
       union all select 'screener', strftime(snapshot_date, '%Y-%m'), count(*) from screener group by all
       union all select 'sectors', strftime(snapshot_date, '%Y-%m'), count(*) from sectors group by all""",
)
def _raw_store_snapshots(spark, sf_dir):
    """SNK-6..8, SNK-12: rows of each partition; a table that is loaded twice has its rows twice."""
    store, out = _store(spark), []
    loads = {"index_constituents": 2, "screener": 1, "sectors": 1}
    for name, times in loads.items():
        for _ in range(times):
            store.append(name, getattr(market, name)(spark, sf_dir))
        part = store.table(name).part_of().alias("part")
        out.append(store.read(name).groupBy(part).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "part", "n"))
    return reduce(DataFrame.union, out)


@register(
    "table_pruning",
    f"""select strftime(date, '%Y-%m') as part, count(*) as n, cast(sum(cast(close as decimal(20, 2))) as double) as total from latest_prices
        where date >= date '{_LAST}' group by 1""",
)
def _table_pruning(spark, sf_dir):
    """SNK-12: a merge into a table by month; the months from a day on are read alone."""
    table = Table(spark, shared_path(spark, "prices"), "date", ("symbol",))
    columns = ["symbol", "date", F.col("close").cast("decimal(20,2)").alias("close")]
    table.replace(_first(spark, sf_dir).select(*columns))
    table.merge(market.stock_history(spark, sf_dir).filter("is_latest").select(*columns), ["symbol", "date"])
    rows = table.read(since=_LAST)
    return rows.groupBy(table.part_of().alias("part")).agg(F.count("*").alias("n"), F.sum("close").cast("double").alias("total"))


@register(
    "seed_csv",
    "select index_name, date, open, high, low, close, volume from index_prices",
)
def _seed_csv(spark, sf_dir):
    """SRC-8: an index's price history through a CSV file with the declared schema."""
    path = shared_path(spark, "seed")
    rows = market.index_prices(spark, sf_dir).select("index_name", "date", "open", "high", "low", "close", "volume", F.lit(None).cast("double").alias("change_pct"))
    rows.write.csv(path, header=True, dateFormat="yyyy-MM-dd")
    return seed.read_seed(spark, path).drop("change_pct")


@register(
    "margin_eligible",
    """select n_name as symbol, n_nationkey % 3 = 0 or n_nationkey % 4 = 0 as is_margin_eligible from nation""",
)
def _margin_eligible(spark, sf_dir):
    """SRC-3, SRC-4"""
    nation = market.read(spark, sf_dir, "nation").select(F.col("n_name").alias("symbol"), F.col("n_nationkey").alias("k"))
    eligible = feeds.eligible_symbols([nation.filter("k % 3 = 0"), nation.filter("k % 4 = 0")])
    return feeds.with_eligibility(nation.select("symbol"), eligible)


class _StarFeed:
    """A feed over the star schema: six tickers, one of which can't be fetched, and no screener."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def constituents(self, index: str) -> DataFrame:
        return market.read(self.spark, self.sf_dir, "nation").filter("n_nationkey < 6").select(F.col("n_name").alias("symbol"))

    def symbols(self) -> DataFrame:
        return market.raw_symbols(self.spark, self.sf_dir, 3).drop("is_margin_eligible")

    def eligible(self) -> list[DataFrame]:
        return [market.read(self.spark, self.sf_dir, "nation").filter("n_nationkey % 2 = 0").select(F.col("n_name").alias("symbol"))]

    def sectors(self) -> DataFrame:
        return market.read(self.spark, self.sf_dir, "region").select(
            F.format_string("%d.0", F.col("r_regionkey") + 100).alias("sector_code"), F.col("r_name").alias("sector_name")
        )

    def screener(self) -> DataFrame:
        raise ConnectionError("down")

    def prices(self, symbols: DataFrame):
        history = _first(self.spark, self.sf_dir)

        def fetch(name: str) -> DataFrame:
            if name == "NATION_2":
                raise ConnectionError("down")
            return history.filter(F.col("symbol") == name).drop("symbol")

        for row in sorted(symbols.collect()):  # the members of an index
            yield row["symbol"], lambda name=row["symbol"]: fetch(name)


@register(
    "feed_run",
    """select 'index_constituents' as name, count(*) as n, 0 as eligible from nation where n_nationkey < 6
       union all select 'symbols', count(*), count(*) filter (where n_nationkey % 2 = 0) from nation where n_nationkey % 10 <> 9
       union all select 'sectors', count(*), 0 from region
       union all select 'screener', 0, 0
       union all select 'stock_history', count(*), 0 from first_prices
           where symbol in (select n_name from nation where n_nationkey < 6 and n_name <> 'NATION_2')
       union all select 'skipped', 2, 0""",
)
def _feed_run(spark, sf_dir):
    """SRC-2..7, SNK-13: one run of a feed; the rows of each raw table and the number of skipped parts."""
    store = _store(spark)
    report = feeds.run_ingest(store, _StarFeed(spark, sf_dir), [market.INDEX], _T[0])
    out = []
    for name in ("index_constituents", "symbols", "sectors", "screener", "stock_history"):
        rows = store.read(name)
        eligible = F.count_if("is_margin_eligible") if name == "symbols" else F.lit(0).cast("bigint")
        out.append(rows.agg(F.lit(name).alias("name"), F.count("*").alias("n"), eligible.alias("eligible")))
    out.append(spark.range(1).select(F.lit("skipped").alias("name"), F.lit(len(report.skipped)).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("eligible")))
    return reduce(DataFrame.union, out)


@register(
    "incremental_build",
    "select symbol, date, ticker_key, close, round(daily_return_pct, 9) as daily_return_pct from int_ohlcv_pit",
)
def _incremental_build(spark, sf_dir):
    """SNK-9..11, FLT-4: a model built up to a day, then from that day on."""
    path, since = shared_path(spark, "build"), dt.date(1998, 6, 1)
    for before in (since, None):
        history = market.stock_history(spark, sf_dir)
        raw = history if before is None else history.filter(F.col("date") < F.lit(before))
        sources = {"stock_history": lambda raw=raw: raw}
        parts = [
            Model("dim_tickers", lambda ref, old: dim_tickers(spark, sf_dir) if old is None else old, "snapshot"),
            Model("stg_stock_history", models.stg_stock_history, by="date"),
            Model("int_ohlcv_pit", models.int_ohlcv_pit, "incremental", ("symbol", "date"), (), "date", ("symbol",)),
        ]
        built = Project(parts, sources)
        built.build(spark, path, None if before else since)
    rows = built.models["int_ohlcv_pit"].table(spark, path).read()
    return rows.select("symbol", "date", "ticker_key", "close", F.round("daily_return_pct", 9).alias("daily_return_pct"))


def _masked(sign: str) -> str:
    r, m = f"case when m {sign} 0 then r end", f"case when m {sign} 0 then m end"
    return f"case when count({r}) over w >= 20 then covar_samp({r}, {m}) over w / nullif(var_samp({m}) over w, 0) end"


@register(
    "beta_masked_short",
    f"""select ticker_key, symbol, date, round({_masked('>=')}, 9) as beta_upside, round({_masked('<')}, 9) as beta_downside
        from related window w as (partition by symbol order by date rows between 89 preceding and current row)""",
)
def _beta_masked_short(spark, sf_dir):
    """WAG-7, WAG-8 over 90 rows with 20 values, which a sparse market reaches too."""
    p = project(spark, sf_dir, ("dim_tickers", "int_ohlcv_pit", "int_index_constituents_pit"))
    return models.relationships(models.related(p.ref), 90, 20).selectExpr(
        "ticker_key", "symbol", "date", "round(beta_upside_252d, 9) as beta_upside", "round(beta_downside_252d, 9) as beta_downside"
    )
