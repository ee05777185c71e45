import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.sources import calendar, feeds, seed

NOW = dt.datetime(2024, 1, 8, 12)


def test_seed_file_with_byte_order_mark(spark, tmp_path):
    text = '﻿"Date","Price","Open","High","Low","Vol.","Change %"\n"01/04/2010","9,500.25","9,400.00","9,550.75","9,390.10","1.5M","-0.35%"\n"01/05/2010","10","10","11","9","","0%"\n'
    (tmp_path / "x.csv").write_text(text, encoding="utf-8")
    got = seed.read_export(spark, f"file://{tmp_path}/x.csv", "I").orderBy("date").collect()
    assert tuple(got[0]) == ("I", dt.date(2010, 1, 4), 9400.0, 9550.75, 9390.1, 9500.25, 1500000, -0.35)
    assert got[1]["volume"] is None


def test_volume_forms(spark):
    df = spark.createDataFrame([("1.5M",), ("2k",), (" 3B ",), ("",), ("1,234",), (None,)], "v string")
    assert [r[0] for r in df.select(seed.parse_volume("v")).collect()] == [1500000, 2000, 3000000000, None, 1234, None]


def test_calendar(spark):
    df = calendar.dim_date(spark)
    assert df.count() == 13148
    day = df.filter("date = date'2020-12-31'").first()
    assert (day["week_of_year"], day["day_of_week"], day["day_name"]) == (53, 5, "Thursday")
    assert day["is_year_end"] and day["is_quarter_end"] and day["is_month_end"]


def test_sector_codes(spark):
    df = spark.createDataFrame([(14.0,), (float("nan"),), (None,), (14.5,)], "c double")
    assert [r[0] for r in df.select(feeds.sector_code(F.col("c"))).collect()] == ["14", None, None, "14.5"]
    text = spark.createDataFrame([("14",), ("0807",), ("AB",)], "c string")
    assert [r[0] for r in text.select(feeds.sector_code(F.col("c"))).collect()][2] == "AB"


class Feed:
    def __init__(self, spark, **over):
        self.spark, self.over = spark, over

    def frame(self, name, rows, schema):
        got = self.over.get(name, rows)
        if isinstance(got, Exception):
            raise got
        return self.spark.createDataFrame(got, schema)

    def constituents(self, index):
        return self.frame("constituents", [("A",), ("B",)], "symbol string")

    def symbols(self):
        rows = [("A", "a", "Cement", False, False, False), ("B", "b", "Oil", False, False, False)]
        return self.frame("symbols", rows, "symbol string, name string, sector_name string, is_etf boolean, is_debt boolean, is_gem boolean")

    def eligible(self):
        return [self.frame("eligible", [("A",)], "symbol string")]

    def sectors(self):
        return self.frame("sectors", [("807", "Cement")], "sector_code string, sector_name string")

    def screener(self):
        return self.frame("screener", [("A", 14.0)], "symbol string, sector double")

    def prices(self, symbols):
        day = dt.date(2024, 1, 5)
        rows = [("A", day, 1.0, 2.0, 1.0, 1.5, 10, False), ("B", day, None, 2.0, 1.0, 1.5, 10, False)]
        shape = "symbol string, date date, open double, high double, low double, close double, volume long, is_anomaly boolean"
        wanted = sorted(r["symbol"] for r in symbols.collect())
        for s in wanted:
            yield s, lambda s=s: self.frame(f"prices {s}", [r for r in self.over.get("prices", rows) if r[0] == s], shape).drop("symbol")


def store(spark, tmp_path):
    return feeds.open_store("parquet", spark, f"file://{tmp_path}/raw")


def test_a_run_and_its_repeat(spark, tmp_path):
    s = store(spark, tmp_path)
    report = feeds.run_ingest(s, Feed(spark), ["I"], NOW)
    assert report.skipped == [] and report.valid_prices == 1  # a malformed row is left out
    feeds.run_ingest(s, Feed(spark), ["I"], NOW + dt.timedelta(days=1))
    assert s.read("stock_history").count() == 1
    assert s.read("index_constituents").count() == 4  # snapshots are never merged
    assert {(r["symbol"], r["is_margin_eligible"]) for r in s.read("symbols").collect()} == {("A", True), ("B", False)}
    assert {r["sector"] for r in s.read("screener").collect()} == {"14"}
    assert s.read("sectors").first()["turnover"] is None
    assert s.latest_hashes("stock_history", ["symbol", "date"]).count() == 1


def test_failures(spark, tmp_path):
    s = store(spark, tmp_path)
    with pytest.raises(feeds.IngestFailed):
        feeds.run_ingest(s, Feed(spark, constituents=[]), ["I"], NOW)
    with pytest.raises(feeds.IngestFailed):
        feeds.run_ingest(s, Feed(spark, prices=[]), ["I"], NOW)
    report = feeds.run_ingest(s, Feed(spark, symbols=ValueError("down"), sectors=ValueError("down"), eligible=ValueError("down")), ["I"], NOW)
    assert [x.split(":")[0] for x in report.skipped if "prices" not in x] == ["eligible", "symbols", "sectors"]


def test_a_ticker_that_fails_is_left_out(spark, tmp_path):
    s = store(spark, tmp_path)
    report = feeds.run_ingest(s, Feed(spark, **{"prices B": ValueError("down")}), ["I"], NOW)
    assert report.skipped == ["prices of B: down"] and report.valid_prices == 1
    assert s.latest_hashes("stock_history", ["symbol"], "A").count() == 1
    assert s.latest_hashes("stock_history", ["symbol"], "B").count() == 0
    with pytest.raises(feeds.IngestFailed):
        feeds.run_ingest(s, Feed(spark, **{"prices A": ValueError("down"), "prices B": ValueError("down")}), ["I"], NOW)


def test_a_load_leaves_the_files_of_other_months(spark, tmp_path):
    s = store(spark, tmp_path)
    row = lambda day, close: ("A", day, 1.0, 9.0, 1.0, close, 10, False)
    jan, feb, mar = dt.date(2024, 1, 5), dt.date(2024, 2, 5), dt.date(2024, 3, 5)
    feeds.run_ingest(s, Feed(spark, prices=[row(jan, 1.5), row(feb, 2.5)]), ["I"], NOW)
    before = s.table("stock_history").parts()
    feeds.run_ingest(s, Feed(spark, prices=[row(feb, 2.75), row(mar, 3.5)]), ["I"], NOW + dt.timedelta(days=60))
    after = s.table("stock_history").parts()
    assert after["2024-01"] == before["2024-01"] and after["2024-02"] != before["2024-02"] and "2024-03" in after
    got = {(r["date"], r["close"], r["is_latest"]) for r in s.read("stock_history").collect()}
    assert got == {(jan, 1.5, True), (feb, 2.5, False), (feb, 2.75, True), (mar, 3.5, True)}


def test_missing_table_reads_as_empty(spark, tmp_path):
    assert store(spark, tmp_path).read("symbols").count() == 0


def test_from_feed_to_facts(spark, tmp_path):
    """Two runs of a feed, the seed file and the warehouse over them."""
    from tickloom.plans import catalog

    s = store(spark, tmp_path)
    seed_csv = tmp_path / "seed.csv"
    seed_csv.write_text("index_name,date,open,high,low,close,volume,change_pct\nI,2024-01-05,1,3,1,2,10,0.5\n")
    row = lambda day, close: ("A", day, 1.0, 9.0, 1.0, close, 10, False)
    first, second = dt.date(2024, 1, 5), dt.date(2024, 1, 8)
    feeds.run_ingest(s, Feed(spark, prices=[row(first, 1.5)]), ["I"], NOW)
    later = NOW + dt.timedelta(days=1)
    feeds.run_ingest(s, Feed(spark, prices=[row(first, 1.75), row(second, 2.0)]), ["I"], later)
    assert s.first_changed("stock_history", NOW) == first and s.first_changed("stock_history", later) is None
    project = catalog.store_project(spark, s, f"file://{seed_csv}", later.date(), "I")
    for name in [n for n in project.models if n not in ("fact_ohlcv", "stg_stock_history", "stg_symbols", "stg_sectors", "dim_tickers", "dim_date", "dim_sectors", "stg_index_price_history", "fact_index_ohlcv", "fact_restatement_history", "int_ohlcv_pit", "dim_indices", "stg_index_constituents")]:
        del project.models[name]
    done = project.build(spark, f"file://{tmp_path}/w")
    table = lambda n: project.models[n].table(spark, f"file://{tmp_path}/w").read()
    assert {(r["date"], r["close"], r["is_ticker_attrs_assumed"]) for r in table("fact_ohlcv").collect()} == {(first, 1.75, True), (second, 2.0, True)}
    assert {(r["date"], r["close"]) for r in table("int_ohlcv_pit").collect()} == {(first, 1.5), (second, 2.0)}
    assert {r["restatement_count"] for r in table("fact_restatement_history").collect()} == {1, 2}
    assert table("fact_index_ohlcv").count() == 1 and table("dim_tickers").count() == 2
    assert not done.failed - {"fact_index_ohlcv"} and done.violations["int_ohlcv_pit", "t21_equal_unless_restated"] == 0


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace as N

    from tickloom.sources.storage import shared_path

    session = N(conf=N(get=lambda key, default: None), sparkContext=N(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_path(session, "x")
