import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from tickloom.functions import rolling as R
from tickloom.plans.models import relationships


def series(spark, values, symbol="A"):
    day = dt.date(2020, 1, 1)
    rows = [(symbol, day + dt.timedelta(i), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "symbol string, date date, x double")


def column(df, c):
    return [r[c] for r in df.orderBy("date").select(c).collect()]


def test_change_guards_zero_and_null(spark):
    df = series(spark, [0, 5, 10, None, 4]).withColumn("r", R.change(F.col("x"), R.ordered("symbol")))
    assert column(df, "r") == [None, None, 1.0, None, None]


def test_rsi_edges(spark):
    w = R.last_rows(14, "symbol")

    def last(values):
        before = F.lag("x").over(R.ordered("symbol"))
        gain = F.coalesce(F.greatest(F.col("x") - before, F.lit(0.0)), F.lit(0.0))
        loss = F.coalesce(F.greatest(before - F.col("x"), F.lit(0.0)), F.lit(0.0))
        df = series(spark, values).withColumn("g", gain).withColumn("l", loss)
        return column(df.withColumn("rsi", R.rsi(F.col("g"), F.col("l"), w)), "rsi")[-1]

    assert last([5] * 20) is None
    assert last(range(1, 20)) == 100.0
    assert last(range(20, 1, -1)) == 0.0


def test_compound_needs_a_whole_window(spark):
    for n, bad in ((62, None), (63, None), (64, None), (64, 30)):
        values = [0.01] * n
        if bad is not None:
            values[bad] = -1.0
        df = series(spark, values).withColumn("c", R.compound(F.col("x"), R.last_rows(63, "symbol"), 63))
        got = column(df, "c")[-1]
        if n < 63 or bad is not None:
            assert got is None
        else:
            assert math.isclose(got, 1.01**63 - 1, rel_tol=1e-12)


def test_beta_and_correlation_edges(spark):
    n = 260
    rng = np.random.default_rng(0)
    m = rng.normal(0.001, 0.01, n)
    day = dt.date(2020, 1, 1)

    def rows(symbol, r, market):
        return [(symbol, symbol, day + dt.timedelta(i), float(a), float(b), float(b)) for i, (a, b) in enumerate(zip(r, market))]

    data = rows("SAME", m, m) + rows("FLAT", [0.0] * n, m) + rows("UP", 2 * abs(m), abs(m)) + rows("SHORT", m[:251], m[:251])
    df = spark.createDataFrame(data, "ticker_key string, symbol string, date date, r double, m double, s double")
    got = {(r["symbol"], (r["date"] - day).days): r for r in relationships(df).collect()}
    assert got["SAME", 250]["beta_full_252d"] is None and math.isclose(got["SAME", 251]["beta_full_252d"], 1.0)
    assert got["SAME", 259]["corr_vs_index_252d"] == 1.0
    assert got["FLAT", 259]["corr_vs_index_252d"] is None and got["FLAT", 259]["beta_full_252d"] == 0.0
    assert math.isclose(got["UP", 259]["beta_upside_252d"], 2.0) and got["SAME", 259]["beta_upside_252d"] is None
    assert all(r["corr_vs_sector_252d"] is None for (s, _), r in got.items() if s == "SHORT")


def brute_measures(r, m, n, least):
    """Of the last n pairs: beta (all, up, down) and correlation, by definition; null as nan."""
    out = []
    for i in range(len(r)):
        a, b = r[max(0, i - n + 1) : i + 1], m[max(0, i - n + 1) : i + 1]
        row = []
        for mask in (np.ones(len(b), bool), b >= 0, b < 0):
            x, y = np.where(mask, a, np.nan), np.where(mask, b, np.nan)
            both, alone = ~np.isnan(x) & ~np.isnan(y), ~np.isnan(y)
            if (~np.isnan(x)).sum() < least or both.sum() < 2 or alone.sum() < 2 or np.ptp(y[alone]) == 0:
                row.append(np.nan)
            else:
                row.append(np.cov(x[both], y[both])[0, 1] / np.var(y[alone], ddof=1))
        both = ~np.isnan(a) & ~np.isnan(b)
        flat = both.sum() < 2 or np.ptp(a[both]) == 0 or np.ptp(b[both]) == 0
        row.append(np.nan if flat or (~np.isnan(a)).sum() < least else np.corrcoef(a[both], b[both])[0, 1])
        out.append(row)
    return np.array(out)


def test_measures_match_their_definition(spark):
    """Betas up and down have values here; series cross batches of every size; nulls and flat runs occur."""
    rng = np.random.default_rng(7)
    day = dt.date(2020, 1, 1)
    data, want = [], {}
    for symbol in ("A", "B", "C"):
        n = int(rng.integers(60, 90))
        r, m = rng.normal(0, 0.02, n), rng.normal(0, 0.01, n)
        r[rng.random(n) < 0.1] = np.nan
        m[rng.random(n) < 0.05] = np.nan
        r[20:45] = 0.1
        want[symbol] = brute_measures(r, m, 12, 3)
        for i in range(n):
            a, b = (None if np.isnan(v) else float(v) for v in (r[i], m[i]))
            data.append((symbol, symbol, day + dt.timedelta(i), a, b, b))
    df = spark.createDataFrame(data, "ticker_key string, symbol string, date date, r double, m double, s double")
    names = ["beta_full_252d", "beta_upside_252d", "beta_downside_252d", "corr_vs_index_252d"]
    for size in ("10000", "7"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        try:
            rows = relationships(df, 12, 3).collect()
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        assert len(rows) == len(data)
        for row in rows:
            got = np.array([np.nan if row[c] is None else row[c] for c in names])
            np.testing.assert_allclose(got, want[row["symbol"]][(row["date"] - day).days], rtol=1e-9, atol=1e-11)
    up, down = want["A"][:, 1], want["A"][:, 2]
    assert (~np.isnan(up)).sum() > 20 and (~np.isnan(down)).sum() > 20


def test_truncated_ema_matches_the_sum():
    x = np.array([3.0, np.nan, 5.0, 8.0, 13.0, np.nan, 21.0])
    got = R.truncated_ema(x, 0.2, 4)
    for i in range(len(x)):
        pairs = [(x[i - k], 0.8**k) for k in range(4) if i - k >= 0 and not np.isnan(x[i - k])]
        want = sum(a * b for a, b in pairs) / sum(b for _, b in pairs)
        assert math.isclose(got[i], want, rel_tol=1e-14)
    assert np.isnan(R.truncated_ema(np.array([np.nan, 1.0]), 0.5, 3)[0])


def test_emas_over_groups(spark):
    df = series(spark, range(1, 40)).union(series(spark, range(40, 1, -1), "B"))
    got = R.with_emas(df, "symbol", "date", {"e": ("x", 2.0 / 13, 90), "f": ("e", 0.2, 9)})
    assert got.count() == 78 and got.filter("e is null or f is null").count() == 0


def test_rank_gaps_and_quintiles(spark):
    rows = [(f"s{i}", "d", v) for i, v in enumerate([5.0, 5.0, 4.0, 3.0, 2.0, 1.0, 1.0, None])]
    df = spark.createDataFrame(rows, "k string, date string, x double")
    rank, quintile = R.rank_and_quintile(F.col("x"), "date", True, "k")
    got = df.select("k", rank.alias("r"), quintile.alias("q")).orderBy("k").collect()
    assert [r["r"] for r in got] == [1, 1, 3, 4, 5, 6, 6, None]
    assert [r["q"] for r in got] == [1, 1, 2, 2, 3, 4, 5, None]
