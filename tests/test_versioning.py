import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from tickloom.operators import versioning as V
from tickloom.schemas import STOCK_HISTORY, SYMBOLS, conform

D = dt.date(2024, 1, 5)
T0, T1 = dt.datetime(2024, 1, 6, 10), dt.datetime(2024, 1, 7, 10)


def prices(spark, rows):
    frame = spark.createDataFrame(
        rows, "symbol string, date date, open double, high double, low double, close double, volume long, is_anomaly boolean"
    )
    return frame.withColumn("row_hash", V.ohlcv_hash())


def at(t):
    return F.lit(t).cast("timestamp")


AAA = ("AAA", D, 481.99, 496.0, 474.01, 481.38, 4496408, False)


def test_hash_is_the_digest_of_the_joined_fields(spark):
    text = "AAA|2024-01-05|481.9900|496.0000|474.0100|481.3800|4496408|False"
    assert prices(spark, [AAA]).first()["row_hash"] == hashlib.sha256(text.encode()).hexdigest()
    changed = prices(spark, [(*AAA[:5], 999.99, *AAA[6:])]).first()["row_hash"]
    assert changed != prices(spark, [AAA]).first()["row_hash"]
    assert prices(spark, []).columns[-1] == "row_hash"


def test_diff_new_changed_same(spark):
    fresh = prices(spark, [AAA, ("BBB", *AAA[1:]), ("CCC", *AAA[1:])])
    rows = fresh.collect()
    current = spark.createDataFrame(
        [("AAA", D, rows[0]["row_hash"]), ("BBB", D, "stale"), ("GONE", D, "x")], "symbol string, date date, row_hash string"
    )
    got = {r["symbol"]: r["change"] for r in V.diff(fresh, current, ["symbol", "date"]).collect()}
    assert got == {"AAA": "same", "BBB": "changed", "CCC": "new"}
    gone = V.delisted(fresh, current, ["symbol"])
    assert [r["symbol"] for r in gone.collect()] == ["GONE"]
    nothing = prices(spark, [])
    assert V.diff(nothing, current, ["symbol", "date"]).count() == 0
    assert V.delisted(nothing, current, ["symbol"]).count() == 3


def test_ingest_keeps_history_and_one_latest_row(spark):
    table = conform(spark.createDataFrame([], STOCK_HISTORY), STOCK_HISTORY)
    keys = ["symbol", "date"]
    one = V.ingest(table, prices(spark, [AAA, ("BBB", *AAA[1:])]), keys, "history_id", at(T0)).cache()
    assert one.count() == 2 and one.filter("is_latest").count() == 2
    again = V.ingest(one, prices(spark, [AAA]), keys, "history_id", at(T1))
    assert again.count() == 2
    two = V.ingest(one, prices(spark, [(*AAA[:5], 500.0, *AAA[6:])]), keys, "history_id", at(T1)).collect()
    aaa = sorted((r["close"], r["is_latest"], r["superseded_at"] is not None) for r in two if r["symbol"] == "AAA")
    assert aaa == [(481.38, False, True), (500.0, True, False)]
    assert [r["is_latest"] for r in two if r["symbol"] == "BBB"] == [True]


def test_supersede_spares_rows_of_this_run(spark):
    rows = [("A", True, T0), ("A", True, T1), ("B", True, T0)]
    table = spark.createDataFrame(rows, "symbol string, is_latest boolean, loaded_at timestamp").withColumn(
        "superseded_at", F.lit(None).cast("timestamp")
    )
    gone = spark.createDataFrame([("A",), ("A",)], "symbol string")
    got = V.supersede(table, gone, ["symbol"], at(T1), at(T1)).collect()
    assert sorted((r["symbol"], r["loaded_at"], r["is_latest"]) for r in got) == [("A", T0, False), ("A", T1, True), ("B", T0, True)]


def test_attribute_delisting(spark):
    table = spark.createDataFrame([], SYMBOLS)
    row = lambda s, n: (s, n, "Cement", False, False, False, True)
    feed = lambda *r: spark.createDataFrame(
        list(r), "symbol string, name string, sector_name string, is_etf boolean, is_debt boolean, is_gem boolean, is_margin_eligible boolean"
    ).withColumn("row_hash", V.symbol_hash())
    one = V.ingest(table, feed(row("A", "a"), row("B", "b")), ["symbol"], "ticker_attr_id", at(T0), True).cache()
    two = V.ingest(one, feed(row("A", "a2")), ["symbol"], "ticker_attr_id", at(T1), True)
    assert sorted((r["symbol"], r["name"], r["is_latest"]) for r in two.collect()) == [("A", "a", False), ("A", "a2", True), ("B", "b", False)]


def test_scd2_changes_gaps_and_nulls(spark):
    def state(*rows):
        return spark.createDataFrame(list(rows), "symbol string, name string, is_etf boolean")

    days = [dt.date(2020, 1, 1), dt.date(2020, 2, 1), dt.date(2020, 3, 1), dt.date(2020, 4, 1)]
    states = [state(("A", "a", None), ("B", "b", True)), state(("A", "a", None), ("B", "b2", True)), state(("A", "a", False)), state(("A", "a", False), ("B", "b2", True))]
    dim = V.empty_dimension(spark, states[0])
    for day, s in zip(days, states):
        dim = V.scd2(dim, s, day).cache()
    got = [(r["symbol"], r["valid_from"], r["valid_to"]) for r in dim.collect()]
    assert len(got) == 5
    assert set(got) == {
        ("A", days[0], days[2]), ("A", days[2], None), ("B", days[0], days[1]), ("B", days[1], days[2]), ("B", days[3], None)
    }
    assert len({r["scd_id"] for r in dim.collect()}) == 5


def test_a_null_that_moves_is_a_change(spark):
    rows = spark.createDataFrame(
        [("A", None, "X", True, True, True, True), ("A", "X", None, True, True, True, True)],
        "symbol string, name string, sector_name string, is_etf boolean, is_debt boolean, is_gem boolean, is_margin_eligible boolean",
    )
    assert rows.select(V.symbol_hash().alias("h")).distinct().count() == 2
    text = "A|None|X|True|True|True|True"
    assert rows.select(V.symbol_hash().alias("h")).first()["h"] == hashlib.sha256(text.encode()).hexdigest()
    assert prices(spark, [(*AAA[:5], None, 1, False), (*AAA[:4], None, AAA[5], 1, False)]).select("row_hash").distinct().count() == 2


def test_plan_grows_by_one_join_for_a_snapshot(spark):
    source = spark.createDataFrame([("A", "a", None)], "symbol string, name string, is_etf boolean")
    dim, joins = V.empty_dimension(spark, source), []
    for i in range(6):
        dim = V.scd2(dim, source, D + dt.timedelta(i))
        joins.append(dim._jdf.queryExecution().analyzed().toString().count("Join "))
    assert joins == [1, 2, 3, 4, 5, 6]
    row = dim.first()
    assert row["valid_from"] == row["updated_at"] == D and dim.count() == 1


def test_conform(spark):
    rows = spark.createDataFrame([("A",)], "symbol string")
    with pytest.raises(KeyError):
        conform(rows, STOCK_HISTORY)
