"""Each data test against rows that break it, in Spark and, where it has one, in its SQL."""

import datetime as dt

import duckdb
import pytest

from tickloom.plans import checks

D = dt.date
TODAY = D(2020, 6, 1)
LATE = D(2020, 6, 2)

DIM = "symbol string, scd_id string, valid_from date, valid_to date, sector_code string"
OHLCV = "symbol string, date date, ticker_key string, open double, high double, low double, close double, volume long, is_anomaly boolean, is_ticker_attrs_assumed boolean"
RESTATED = "symbol string, date date, ticker_key string, restatement_count long, is_ticker_attrs_assumed boolean"
RANKS = "ticker_key string, date date, pe_ratio double, pe_ratio_rank long, pe_ratio_quintile long, momentum_63d_rank long"
PIT = "index_name string, snapshot_date date, ticker_key string"
PAIR = "sector_code_a string, sector_code_b string, date date"
IND = "symbol string, date date, bollinger_upper double, bollinger_mid double, bollinger_lower double, macd_line double, macd_signal double, macd_histogram double, trailing_return_252d double"
REL = "ticker_key string, date date, corr_vs_index_252d double, corr_vs_sector_252d double"
PRICE_PIT = "symbol string, ticker_key string, date date, close double"
VALUE = "symbol string, date date, market_cap double, price double"
MEMBER = "symbol string, snapshot_date date, market_cap_m double"

d1, d2 = D(2020, 1, 1), D(2020, 2, 1)


def bar(symbol="A", day=d1, key="k", low=1.0, high=3.0, close=2.0, anomaly=False, assumed=False):
    return (symbol, day, key, 2.0, high, low, close, 10, anomaly, assumed)


def days(n):
    return [d1 + dt.timedelta(i) for i in range(n)]


INDICATORS = [("A", d, 3.0, 2.0, 1.0, 1.0, 0.4, 0.6, None if i < 252 else 0.1) for i, d in enumerate(days(255))]

#: test -> (violations, tables: (schema, rows) by model, and by another name that its SQL reads)
CASES = {
    "t01_no_overlap": (2, {"dim_tickers": (DIM, [("A", "1", d1, D(2020, 3, 1), "x"), ("A", "2", d2, None, "x"), ("B", "3", d1, d2, "x"), ("B", "4", d2, None, "x")])}),
    "t02_one_open_version": (1, {"dim_tickers": (DIM, [("A", "1", d1, None, "x"), ("A", "2", d2, None, "x"), ("B", "3", d1, None, "x")])}),
    "t04_pe_exclusion": (3, {"fact_cross_sectional_rankings": (RANKS, [("a", d1, None, 1, None, 1), ("b", d1, -1.0, None, 2, 1), ("c", d1, 0.0, 1, 1, 1), ("d", d1, 5.0, 1, 1, 1), ("e", d1, None, None, None, 1)])}),
    "t05_rank_within_universe": (1, {"fact_cross_sectional_rankings": (RANKS, [("a", d1, None, None, None, 2), ("b", d1, None, None, None, 3), ("c", d1, None, None, None, None)]),
                                      "int_index_constituents_pit": (PIT, [("IDX100", d1, "a"), ("IDX100", d1, "b"), ("IDX100", d1, "b"), ("OTHER", d1, "c")])}),
    "t07_high_low": (4, {"fact_ohlcv": (OHLCV, [bar(), bar(low=2.5), bar(high=1.5), bar(high=1.5, anomaly=True), bar(close=9.0, anomaly=None), bar(close=0.5)])}),
    "t09_assumed_correct": (2, {"fact_ohlcv": (OHLCV, [bar(key="1"), bar(key="1", day=D(2020, 3, 1)), bar(key="2", day=d1), bar(key="2", day=d1, assumed=True), bar(key="1", day=d2, assumed=True)]),
                                 "dim_tickers": (DIM, [("A", "1", d1, d2, "x"), ("A", "2", d2, None, "x")])}),
    "t12_assumed_correct": (1, {"fact_restatement_history": (RESTATED, [("A", d1, "1", 1, False), ("A", d2, "1", 1, False), ("A", d1, "2", 1, True)]),
                                 "dim_tickers": (DIM, [("A", "1", d1, d2, "x"), ("A", "2", d2, None, "x")])}),
    "t14_canonical_order": (2, {"fact_sector_correlation": (PAIR, [("a", "b", d1), ("b", "a", d1), ("a", "a", d1)]), "int_sector_correlation": (PAIR, [("a", "b", d1), ("b", "a", d1), ("a", "a", d1)])}),
    "t20_can_differ": (1, {"int_ohlcv_pit": (PRICE_PIT, [("A", "k", d1, 2.0), ("A", "k", d2, 2.0)]), "fact_ohlcv": (OHLCV, [bar(), bar(day=d2)]),
                            "fact_restatement_history": (RESTATED, [("A", d1, "k", 2, False), ("A", d2, "k", 1, False)])}),
    "t21_equal_unless_restated": (1, {"int_ohlcv_pit": (PRICE_PIT, [("A", "k", d1, 2.5), ("A", "k", d2, 2.5)]), "fact_ohlcv": (OHLCV, [bar(), bar(day=d2)]),
                                       "fact_restatement_history": (RESTATED, [("A", d1, "k", 2, False), ("A", d2, "k", 1, False)])}),
    "t22_canonical_order": (1, {"int_sector_correlation": (PAIR, [("a", "b", d1), ("b", "a", d1)])}),
    "t23_bollinger_order": (2, {"int_technical_indicators": (IND, [("A", d1, 3.0, 2.0, 1.0, 0.0, 0.0, 0.0, None), ("A", d2, 1.0, 2.0, 1.0, 0.0, 0.0, 0.0, None), ("B", d1, 3.0, 2.0, 2.5, 0.0, 0.0, 0.0, None), ("B", d2, None, 2.0, None, 0.0, 0.0, 0.0, None)])}),
    "t24_macd_histogram": (1, {"int_technical_indicators": (IND, [("A", d1, 3.0, 2.0, 1.0, 1.0, 0.4, 0.6, None), ("A", d2, 3.0, 2.0, 1.0, 1.0, 0.4, 0.7, None), ("B", d1, 3.0, 2.0, 1.0, None, 0.4, 0.7, None)])}),
    "t25_return_available": (1, {"int_technical_indicators": (IND, INDICATORS[:-1] + [(*INDICATORS[-1][:-1], None)])}),
    "t26_zero_variance": (2, {"int_ohlcv_pit": (PRICE_PIT, [("A", "k", d, 2.0) for d in days(252)] + [("B", "m", d, float(i)) for i, d in enumerate(days(252))]),
                               "int_ticker_relationships": (REL, [("k", days(252)[-1], 0.5, None), ("k", days(252)[-2], None, 0.1), ("k", days(252)[0], None, None), ("m", days(252)[-1], 0.5, 0.5)])}),
    "t27_market_cap": (1, {"fact_valuation_daily": (VALUE, [("A", d1, 10.0, 1.0), ("A", d2, 12.0, 1.0)]), "fact_index_membership": (MEMBER, [("A", d1, 10.5), ("A", d2, 10.5)])}),
    "t28_price": (1, {"fact_valuation_daily": (VALUE, [("A", d1, 10.0, 2.005), ("A", d2, 12.0, 2.02)]), "fact_ohlcv": (OHLCV, [bar(), bar(day=d2)])}),
}

#: Names under which the tests' SQL reads a model.
ALSO = {"fact_restatement_history": "versions"}


@pytest.fixture(scope="module")
def all_checks():
    return {c.test.name: c for c in checks.checks(TODAY)}


def run_both(spark, check, tables):
    frames = {n: spark.createDataFrame(rows, schema) for n, (schema, rows) in tables.items()}
    found = check.test.violations(frames[check.model], lambda n: frames[n]).count()
    con = duckdb.connect()
    for n, frame in frames.items():
        arrow = frame.toArrow()  # noqa: F841
        con.sql(f"create table {n} as select * from arrow")
        if n in ALSO:
            con.sql(f"create view {ALSO[n]} as select * from {n}")
    return found, con.sql(f"select count(*) from ({check.sql})").fetchall()[0][0]


@pytest.mark.parametrize("name", sorted(CASES))
def test_violations_are_found(spark, all_checks, name):
    n, tables = CASES[name]
    assert run_both(spark, all_checks[name], tables) == (n, n)
    clean = {m: (schema, []) for m, (schema, _) in tables.items()}
    assert run_both(spark, all_checks[name], clean) == (0, 0)


def test_dates_after_today_are_found(spark, all_checks):
    names = [n for n in all_checks if n.endswith("no_future_dates")]
    assert len(names) == 9
    for name in names:
        check = all_checks[name]
        c = "snapshot_date" if "snapshot_date" in check.sql else "date"
        tables = {check.model: (f"{c} date", [(TODAY,), (LATE,), (None,)])}
        if "int_" in check.sql:
            tables[check.sql.split()[3]] = tables[check.model]
        assert run_both(spark, check, tables) == (1, 1), name


def test_duplicates_that_differ_are_found(spark, all_checks):
    """Nulls count as a value; equal rows don't."""
    for name in ("t29_duplicates", "t30_duplicates", "t31_duplicates"):
        check = all_checks[name]
        table = check.sql.split(" from ")[1].split()[0]
        keys = check.sql.split("group by ")[1].split(" having")[0].split(", ")
        values = {"t29_duplicates": checks._CONSTITUENT, "t30_duplicates": checks._SCREEN, "t31_duplicates": checks._SECTOR}[name]
        schema = ", ".join([f"{k} string" for k in keys] + [f"{v} double" for v in values])
        row = lambda k, *v: (*[k] * len(keys), *v)
        one, two = [1.0] * len(values), [1.0] * (len(values) - 1)
        rows = [row("same", *one), row("same", *one), row("null", *one), row("null", *two, None), row("both", *two, None), row("both", *two, None), row("apart", *two, 2.0), row("apart", *one)]
        sql_schema = schema.replace("sector_code_raw", "sector")
        frame = spark.createDataFrame(rows, schema)
        assert sorted(r[0] for r in check.test.violations(frame, None).collect()) == ["apart", "null"]
        con = duckdb.connect()
        arrow = spark.createDataFrame(rows, sql_schema).toArrow()  # noqa: F841
        con.sql(f"create table {table} as select * from arrow")
        assert sorted(r[0] for r in con.sql(check.sql).fetchall()) == ["apart", "null"]


def test_assumed_rows_are_reported(spark, all_checks):
    for name, model, schema, row in (("t10_assumed_prevalence", "fact_ohlcv", OHLCV, lambda a: bar(assumed=a)), ("t13_assumed_prevalence", "fact_restatement_history", RESTATED, lambda a: ("A", d1, "k", 1, a))):
        check = all_checks[name]
        assert check.test.severity == "warn"
        assert run_both(spark, check, {model: (schema, [row(True), row(False), row(None)])}) == (1, 1)
