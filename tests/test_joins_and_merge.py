import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickloom.operators import dedup, merge, quality
from tickloom.operators.asof import asof_strict, asof_with_fallback

D = dt.date


def dim(spark):
    rows = [
        ("A", "a1", D(2020, 1, 1), D(2020, 3, 1)), ("A", "a2", D(2020, 3, 1), D(2020, 3, 1)), ("A", "a3", D(2020, 3, 1), None),
        ("B", "b1", D(2020, 2, 1), D(2020, 4, 1)),
    ]
    return spark.createDataFrame(rows, "symbol string, scd_id string, valid_from date, valid_to date")


def test_asof_half_open_days_and_fallback(spark):
    facts = spark.createDataFrame(
        [("A", D(2019, 5, 1)), ("A", D(2020, 1, 1)), ("A", D(2020, 2, 29)), ("A", D(2020, 3, 1)), ("B", D(2020, 4, 1)), ("C", D(2020, 1, 1)), (None, D(2020, 1, 1))],
        "symbol string, date date",
    )
    strict = {(r["symbol"], r["date"]): r["ticker_key"] for r in asof_strict(facts, dim(spark), "date").collect()}
    assert strict == {
        ("A", D(2019, 5, 1)): None, ("A", D(2020, 1, 1)): "a1", ("A", D(2020, 2, 29)): "a1", ("A", D(2020, 3, 1)): "a3",
        ("B", D(2020, 4, 1)): None, ("C", D(2020, 1, 1)): None, (None, D(2020, 1, 1)): None,
    }
    both = {(r["symbol"], r["date"]): (r["ticker_key"], r["is_ticker_attrs_assumed"]) for r in asof_with_fallback(facts, dim(spark), "date").collect()}
    assert both["A", D(2019, 5, 1)] == ("a1", True) and both["B", D(2020, 4, 1)] == ("b1", True)
    assert both["A", D(2020, 3, 1)] == ("a3", False) and both["C", D(2020, 1, 1)] == (None, None)


def test_first_and_latest_with_ties(spark):
    rows = [("A", 1, "x", 1.0), ("A", 1, "w", 2.0), ("A", 2, "v", 3.0), ("B", 5, "z", None)]
    df = spark.createDataFrame(rows, "symbol string, loaded_at int, history_id string, v double")
    first = {r["symbol"]: r["history_id"] for r in dedup.first_observed(df, ["symbol"], tie=["history_id"]).collect()}
    last = {r["symbol"]: r["history_id"] for r in dedup.latest(df, ["symbol"]).collect()}
    assert first == {"A": "w", "B": "z"} and last == {"A": "v", "B": "z"}


def test_merge_replaces_inserts_and_never_matches_null(spark):
    target = spark.createDataFrame([(1, "old"), (2, "stay"), (None, "null")], "k int, v string")
    batch = spark.createDataFrame([(1, "new", 9), (3, "add", 9), (None, "null2", 9)], "k int, v string, w int")
    got = merge.merge_upsert(target, batch, ["k"])
    assert got.columns == ["k", "v", "w"]
    assert {(r["v"], r["w"]) for r in got.collect()} == {("new", 9), ("add", 9), ("null2", 9), ("stay", None), ("null", None)}


def test_versions_of_a_table(spark, tmp_path):
    table = merge.Table(spark, f"file://{tmp_path}/t")
    assert table.version() == 0
    for i in range(4):
        table.merge(spark.createDataFrame([(i % 2, i)], "k int, v int"), ["k"])
    assert table.versions() == [3, 4]  # old versions go, and their files
    assert sorted((r["k"], r["v"]) for r in table.read().collect()) == [(0, 2), (1, 3)]
    assert len(list((tmp_path / "t" / "data").iterdir())) == merge.KEPT


def months(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date date, v int")


def test_only_touched_partitions_change(spark, tmp_path):
    table = merge.Table(spark, f"file://{tmp_path}/t", "date", ("symbol",))
    table.merge(months(spark, [("A", D(2020, 1, 5), 1), ("B", D(2020, 2, 5), 2), ("A", D(2020, 3, 5), 3), ("A", None, 4)]), ["symbol", "date"])
    before = table.parts()
    assert sorted(before) == ["2020-01", "2020-02", "2020-03", "none"]
    table.merge(months(spark, [("B", D(2020, 2, 5), 20), ("C", D(2020, 2, 6), 5), ("C", D(2020, 4, 1), 6)]), ["symbol", "date"])
    after = table.parts()
    assert {p for p in after if after[p] != before.get(p)} == {"2020-02", "2020-04"}
    assert sorted(r["v"] for r in table.read().collect()) == [1, 3, 4, 5, 6, 20]
    assert sorted(r["v"] for r in table.read(since=D(2020, 3, 20)).collect()) == [3, 4, 6]
    assert sorted(r["v"] for r in table.read(["2020-02"]).collect()) == [5, 20]
    files = {f for of in after.values() for f in of}
    table.append(months(spark, [("Z", D(2020, 2, 7), 7)]))
    assert files <= {f for of in table.parts().values() for f in of}  # an append leaves all files
    wide = months(spark, [("A", D(2020, 1, 5), 9)]).withColumn("w", F.lit("new"))
    table.merge(wide, ["symbol", "date"])
    assert sorted(((r["v"], r["w"]) for r in table.read().collect()), key=repr) == sorted([(9, "new"), (20, None), (5, None), (7, None), (3, None), (6, None), (4, None)], key=repr)
    with pytest.raises(ValueError):
        table.merge(wide, ["symbol"])


def test_empty_tables(spark, tmp_path):
    table = merge.Table(spark, f"file://{tmp_path}/t", "date")
    table.replace(months(spark, []))
    assert table.read().count() == 0 and table.version() == 1
    table.merge(months(spark, [("A", D(2020, 1, 5), 1)]), ["symbol", "date"])
    table.merge(months(spark, []), ["symbol", "date"])
    assert table.read().count() == 1


def test_quality(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), ("b", 5.0), (None, 2.0)], "k string, v double")
    parent = spark.createDataFrame([("a",)], "p string")
    count = lambda x: x.count()
    assert count(quality.not_null(df, "v")) == 1
    assert count(quality.unique(df, "k")) == 1
    assert count(quality.unique_combination(df, ["k", "v"])) == 0
    assert [r["k"] for r in quality.relationships(df, "k", parent, "p").collect()] == ["b"]
    assert count(quality.accepted_values(df, "k", ["a"])) == 1
    assert count(quality.accepted_values(df, "k", ["a"], "v < 2")) == 0
    assert count(quality.accepted_range(df, "v", 1, 2)) == 1
    assert count(quality.accepted_range(df, "v", 1, 2, inclusive=False)) == 3
    assert count(df.filter(quality.is_missing("v"))) == 1 and count(df.filter(quality.is_other_than("k", ["a"]))) == 1
    assert count(df.filter(quality.is_beyond("v", 1, 2))) == 1 and count(df.filter(quality.is_beyond("v", 2))) == 1
    dup = spark.createDataFrame([("a", 1, None), ("a", 1, "x"), ("b", 2, "y"), ("b", 2, "y"), ("c", 3, None)], "k string, v int, w string")
    assert [r["k"] for r in quality.duplicates_differ(dup, ["k"], ["v", "w"]).collect()] == ["a"]


def test_buffer_rows(spark):
    df = spark.range(10).select(F.lit("A").alias("s"), F.col("id").alias("d"))
    got = merge.with_buffer(df, "s", "d", 3, 4)
    assert sorted(r["d"] for r in got.collect()) == list(range(3, 10))
    assert sorted(r["d"] for r in got.filter("_write").collect()) == [7, 8, 9]


def test_unknown_store(spark):
    from tickloom.sources.feeds import open_store

    with pytest.raises(ValueError):
        open_store("nowhere", spark, "/tmp/x")
