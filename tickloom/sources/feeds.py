"""Feeds and writers of the raw tables (SRC-2..7, SRC-10..12, SNK-1..8, SNK-13).

A feed is any object with ``constituents(index)``, ``symbols()``, ``eligible()``, ``sectors()`` and
``screener()``, each giving a DataFrame, and ``prices(symbols)``, which gives for each ticker its name
and a function that fetches its rows. A store keeps the raw tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import Table
from ..operators.versioning import changes, ohlcv_hash, supersede, symbol_hash, versions_of
from ..schemas import RAW, conform
from .storage import written


class IngestFailed(Exception):
    """A run that must not be taken for a success."""


def sector_code(c: Column) -> Column:
    """``14.0`` and 14 as "14"; other text as it is; null stays null."""
    number = c.cast("string").try_cast("double")
    whole = number.isNotNull() & ~F.isnan(number) & (number == F.floor(number))
    return F.when(whole, number.cast("bigint").cast("string")).when(F.isnan(number), None).otherwise(c.cast("string"))


def eligible_symbols(tables: list[DataFrame]) -> DataFrame | None:
    """SRC-4: the union of the symbols of several tables."""
    if not tables:
        return None
    return reduce(DataFrame.unionByName, [t.select("symbol") for t in tables]).distinct()


def with_eligibility(symbols: DataFrame, eligible: DataFrame | None) -> DataFrame:
    """SRC-3: whether each symbol is in the set; none is where the set could not be had."""
    if eligible is None:
        return symbols.withColumn("is_margin_eligible", F.lit(False))
    marks = eligible.select(F.col("symbol").alias("_e")).distinct()
    joined = symbols.join(marks, symbols["symbol"] == marks["_e"], "left")
    return joined.withColumn("is_margin_eligible", F.col("_e").isNotNull()).drop("_e")


class ParquetStore:
    """The raw tables as Parquet files by month; a load adds files, a closed version rewrites its month."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def table(self, name: str) -> Table:
        by = next((c for c in ("date", "snapshot_date") if c in RAW[name].names), None)
        return Table(self.spark, f"{self.path}/{name}", by, ("symbol",))

    def ensure(self) -> None:
        """SNK-1: every table exists, empty at first."""
        for name, schema in RAW.items():
            if not self.table(name).version():
                self.table(name).create(schema)

    def read(self, name: str) -> DataFrame:
        """SRC-1, SRC-12: a table that does not exist reads as empty."""
        table = self.table(name)
        return table.read() if table.version() else self.spark.createDataFrame([], RAW[name])

    def latest_hashes(self, name: str, keys: list[str], symbol: str | None = None) -> DataFrame:
        """SRC-10 (of one symbol), SRC-11"""
        rows = self.read(name).filter("is_latest")
        return (rows if symbol is None else rows.filter(F.col("symbol") == symbol)).select(*keys, "row_hash")

    def first_changed(self, name: str, after: dt.datetime) -> dt.date | None:
        """The first day with a version loaded or closed after a time: where the next build begins."""
        by, at = self.table(name).by, F.lit(after).cast("timestamp")
        moved = (F.col("loaded_at") > at) | (F.col("superseded_at") > at)
        return self.read(name).filter(moved).agg(F.min(by)).first()[0]

    def append(self, name: str, rows: DataFrame) -> None:
        """SNK-6..8: snapshots are added as they come; rows loaded twice are there twice."""
        self.table(name).append(conform(rows, RAW[name]))

    def ingest(self, name: str, rows: DataFrame, keys: list[str], id_column: str, now: Column, delist: bool) -> None:
        """SNK-2..5: new versions are added as files; only months with a closed version are rewritten.

        Both are one version of the table, so no crash can leave two latest rows of a key.
        """
        table, schema = self.table(name), RAW[name]
        known = table.read(None if delist else table.parts_in(rows))
        found, gone = changes(known.filter("is_latest").select(*keys, "row_hash"), rows, keys, delist)
        found = written("found", found)  # the months and the new rows come from one comparison
        gone = gone(found)
        touched = table.parts_in(gone) if table.by else (["all"] if not gone.isEmpty() else [])
        closed = {"rows": supersede(table.read(touched), gone, keys, now, now)} if touched else None
        table.change(closed, conform(versions_of(found, id_column, now), schema), touched)


#: SNK-13: stores by name.
STORES = {"parquet": ParquetStore}


def open_store(kind: str, spark: SparkSession, path: str):
    if kind not in STORES:
        raise ValueError(f"unknown store {kind!r}; known: {', '.join(sorted(STORES))}")
    return STORES[kind](spark, path)


@dataclass
class RunReport:
    """What a run skipped, and how many price rows were valid."""

    skipped: list[str] = field(default_factory=list)
    valid_prices: int = 0


def run_ingest(store, feed, indices: list[str], now: dt.datetime) -> RunReport:
    """One run: snapshots, ticker attributes and prices.

    Constituents are required; attributes, sectors and screener are skipped when their feed fails.
    Malformed price rows (a null in a required field) are left out; no valid row at all is fatal.
    """
    report, at = RunReport(), F.lit(now).cast("timestamp")
    today = F.to_date(at)
    store.ensure()
    members = []
    for index in indices:
        rows = feed.constituents(index)
        if rows is None or rows.isEmpty():
            raise IngestFailed(f"no constituents of {index}")
        store.append(
            "index_constituents",
            rows.withColumn("index_name", F.lit(index)).withColumn("snapshot_date", today).withColumn("loaded_at", at),
        )
        members.append(rows)

    def optional(name: str, work) -> None:
        try:
            work()
        except Exception as problem:  # a feed may fail in any way
            report.skipped.append(f"{name}: {problem}")

    def attributes() -> None:
        try:
            eligible = eligible_symbols(feed.eligible())
        except Exception as problem:
            report.skipped.append(f"eligible: {problem}")
            eligible = None
        rows = feed.symbols()
        if rows is None or rows.isEmpty():
            raise ValueError("no symbols")
        rows = with_eligibility(rows, eligible).withColumn("row_hash", symbol_hash())
        columns = ["symbol", "name", "sector_name", "is_etf", "is_debt", "is_gem", "is_margin_eligible", "row_hash"]
        store.ingest("symbols", rows.select(*columns), ["symbol"], "ticker_attr_id", at, True)

    def snapshot(name: str, rows: DataFrame) -> None:
        if "sector" in rows.columns:
            rows = rows.withColumn("sector", sector_code(F.col("sector")))
        store.append(name, rows.withColumn("snapshot_date", today).withColumn("loaded_at", at))

    optional("symbols", attributes)
    optional("sectors", lambda: snapshot("sectors", feed.sectors()))
    optional("screener", lambda: snapshot("screener", feed.screener()))

    required = ["symbol", "date", "open", "high", "low", "close", "volume", "is_anomaly"]
    parts = []
    for name, fetched in feed.prices(eligible_symbols(members)):
        try:  # a ticker whose fetch fails, or whose rows are malformed, is left out
            rows = fetched()
            if rows is None or rows.isEmpty():
                raise ValueError("no history")
            parts.append(rows.withColumn("symbol", F.lit(name)).select(*required) if name is not None else rows.select(*required))
        except Exception as problem:
            report.skipped.append(f"prices of {name}: {problem}")
    prices = reduce(DataFrame.unionByName, parts).dropna() if parts else None
    report.valid_prices = prices.count() if parts else 0
    if not report.valid_prices:
        raise IngestFailed("no price row")
    store.ingest(
        "stock_history", prices.withColumn("row_hash", ohlcv_hash()), ["symbol", "date"], "history_id", at, False
    )
    return report
