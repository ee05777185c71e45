"""Queries against their SQL at a small scale, the project runner, and the plans' shape."""

import dataclasses
import datetime as dt
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tickloom.plans import catalog, checks, models
from tickloom.plans.registry import Model, Project
from tickloom.operators.quality import Test, not_null

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_query_matches_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    sql = duck.sql(entry.oracle_sql()[name])
    assert sorted(sql.columns) == columns
    at = [sql.columns.index(c) for c in columns]
    assert got == sorted(repr(tuple(r[i] for i in at)) for r in sql.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_project_orders_builds_and_tests(spark, tmp_path):
    seen = []

    def model(name, *reads, tests=(), kind="view"):
        def build(ref):
            seen.append(name)
            df = spark.range(3) if not reads else ref(reads[0])
            for r in reads[1:]:
                df = df.join(ref(r), "id")
            return df

        return Model(name, build, kind, ("id",), tests)

    bad = Test("bad", lambda df, ref: df)
    warn = Test("warn", lambda df, ref: df, "warn")
    fine = Test("fine", lambda df, ref: not_null(df, "id"))
    parts = [model("d", "b", "c"), model("b", "a", tests=(bad,), kind="table"), model("c", "a", tests=(warn, fine), kind="incremental"), model("a"), model("e", "d")]
    project = Project(parts, {})
    order = project.order()
    assert order.index("a") < order.index("b") < order.index("d") < order.index("e")
    done = project.build(spark, f"file://{tmp_path}/w")
    assert done.failed == {"b"} and done.skipped == {"d", "e"}
    assert done.violations == {("b", "bad"): 3, ("c", "warn"): 3, ("c", "fine"): 0}


N_DAYS = 560


def daily_market(spark, days):
    """Raw tables of three tickers in two sectors over so many weekdays; the last day is no restatement."""
    start, dates = dt.date(2020, 1, 1), []
    while len(dates) < days:
        if start.weekday() < 5:
            dates.append(start)
        start += dt.timedelta(1)
    prices, members, sectors, screen, index = [], [], [], [], []
    for d, day in enumerate(dates):
        at = dt.datetime.combine(day, dt.time(18))
        level = 1000 + 40 * math.sin(d / 9) + d / 5
        index.append((day, "IDX100", level, level + 5, level - 5, level + 1, 1000 + d))
        for k, symbol in enumerate("ABC"):
            x = 100 * (k + 1) + 20 * math.sin(d / (7 + k)) + 7 * math.cos(d * (k + 1) / 5)
            again = d % 50 == 0 and d + 1 < days
            prices.append((f"{symbol}{d}", symbol, day, x, x + 2, x - 2, x, 100 + d, False, not again, at))
            if again:
                prices.append((f"{symbol}{d}r", symbol, day, x, x + 2, x - 2, x + 1, 100 + d, False, True, at + dt.timedelta(hours=5)))
            members.append(("IDX100", symbol, day, level, 10.0 * k, 1.0, 500.0 + 10 * k + d, 100.0, 50.0, at))
            screen.append((symbol, "10", "Main Board", 500.0 + 10 * k + d, x, 5.0 + k, 2.0, 30.0, 900.0, 1.0, day, at))
        for c, n in (("10", "Cement"), ("20", "Oil")):
            sectors.append((c, n, 1, 2, 3, 5.0, 9.0, day, at))
    make = spark.createDataFrame
    schema = {
        "stock_history": (prices, "history_id string, symbol string, date date, open double, high double, low double, close double, volume long, is_anomaly boolean, is_latest boolean, loaded_at timestamp"),
        "index_constituents": (members, "index_name string, symbol string, snapshot_date date, current_index double, idx_weight double, idx_point double, market_cap_m double, freefloat_m double, shares_m double, loaded_at timestamp"),
        "sectors": (sectors, "sector_code string, sector_name string, advance long, decline long, unchanged long, turnover double, market_cap_b double, snapshot_date date, loaded_at timestamp"),
        "screener": (screen, "symbol string, sector string, listed_in string, market_cap double, price double, pe_ratio double, dividend_yield double, free_float double, volume_avg_30d double, change_1y_pct double, snapshot_date date, loaded_at timestamp"),
        "index_prices": (index, "date date, index_name string, open double, high double, low double, close double, volume long"),
        "symbols": ([(s, s.lower(), n, False, False, False, True) for s, n in zip("ABC", (" cement", "Cement", "OIL "))], "symbol string, name string, sector_name string, is_etf boolean, is_debt boolean, is_gem boolean, is_margin_eligible boolean"),
    }
    return {n: (lambda rows=rows, shape=shape: make(rows, shape)) for n, (rows, shape) in schema.items()}, dates[-1]


def market_project(spark, days, tested=True):
    sources, last = daily_market(spark, days)
    first = lambda: catalog.scd2(catalog.empty_dimension(spark, symbols()), symbols(), dt.date(2020, 2, 1))
    symbols = lambda: spark.createDataFrame([(s, s.lower(), c, False, False, False, True) for s, c in zip("ABC", ("10", "10", "20"))], "symbol string, name string, sector_code string, is_etf boolean, is_debt boolean, is_gem boolean, is_margin_eligible boolean")
    project = catalog.warehouse(spark, sources, first, today=last)
    if not tested:
        project.models = {n: dataclasses.replace(m, tests=()) for n, m in project.models.items()}
    return project, last


def rows_of(project, spark, path, name):
    df = project.models[name].table(spark, path).read()
    rounded = [F.round(c, 9).alias(c) if k == "double" else F.col(c) for c, k in df.dtypes]
    return sorted(map(repr, df.select(*rounded).collect()))


def test_whole_project_builds_and_then_a_day_more(spark, tmp_path):
    """All models and all tests; then one new day reads and writes its months only, and equals a full build."""
    path, full = f"file://{tmp_path}/w", f"file://{tmp_path}/full"
    project, _ = market_project(spark, N_DAYS - 1)
    done = project.build(spark, path)
    assert not done.failed and not done.skipped
    assert set(project.models) == set(catalog.MODEL_NAMES) and {"dim_tickers", "dim_date"} <= set(project.models)
    assert ("dim_tickers", "t01_no_overlap") in done.violations and ("dim_tickers", "t02_one_open_version") in done.violations
    assert len(done.violations) == sum(len(m.tests) for m in project.models.values())
    merged = [m for m in project.models.values() if m.kind == "incremental"]
    before = {m.name: m.table(spark, path).parts() for m in merged}

    project, last = market_project(spark, N_DAYS, tested=False)
    project.build(spark, path, since=last)
    market_project(spark, N_DAYS, tested=False)[0].build(spark, full)
    for m in merged:
        after = m.table(spark, path).parts()
        assert {p for p in after if after[p] != before[m.name].get(p)} == {f"{last:%Y-%m}"}, m.name
    for name, m in project.models.items():
        if m.kind != "view":
            assert rows_of(project, spark, path, name) == rows_of(project, spark, full, name), name
    table = project.models["int_ticker_relationships"].table(spark, path).read()
    assert table.filter("beta_full_252d is not null and corr_vs_sector_252d is not null").count() > 500
    early = project.models["int_ohlcv_pit"].table(spark, path).read(since=last)
    assert early.inputFiles() and all(f"_part={last:%Y-%m}" in f for f in early.inputFiles())


def test_the_star_schema_s_project_plans(spark):
    project = catalog.project(spark, SF)
    assert set(project.models) == set(catalog.MODEL_NAMES)
    order = project.order()
    assert order.index("stg_stock_history") < order.index("int_ohlcv_pit") < order.index("int_ticker_relationships")


def generic(kind):
    return [c for c in checks.checks() if c.test.name.startswith(kind) and c.sql is None]


def test_every_model_has_its_generic_tests():
    names = {(c.model, c.test.name) for c in checks.checks()}
    assert len(names) == len(checks.checks())
    assert len(generic("not_null")) == 70 and len(generic("relationship")) == 40 and len(generic("accepted")) == 6
    assert len(generic("range")) == 58 and len(generic("unique")) == 27


def test_indicators_shuffle_once_by_symbol(spark, capsys):
    """One exchange by symbol serves all windows of the indicator pass and the grouped EMA."""
    rows = spark.createDataFrame([("A", dt.date(2020, 1, 1), 1.0, True)], "symbol string, date date, close double, is_latest boolean")
    models.int_technical_indicators(lambda _: rows).explain()
    plan = capsys.readouterr().out
    assert plan.count("Exchange hashpartitioning(symbol") == 1
