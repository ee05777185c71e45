"""Row hashes, diffs and supersession of the versioned raw tables, and SCD-2 snapshots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _truth(c: str) -> Column:
    return F.when(F.col(c), "True").otherwise("False")


def _text(c: str) -> Column:
    """A word for null, so that a null that moves to another field is a change."""
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def _fixed(c: str) -> Column:
    """Four decimals. Exact for prices of up to four decimals; ties of longer ones round half up."""
    x = F.col(c).cast("double")
    return F.when(x.isNull(), "nan").otherwise(F.format_string("%.4f", x))


def ohlcv_hash() -> Column:
    """VER-1: sha256 of the fields of a price row, joined by bars."""
    return F.sha2(
        F.concat_ws(
            "|",
            _text("symbol"),
            F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit("None")),
            _fixed("open"),
            _fixed("high"),
            _fixed("low"),
            _fixed("close"),
            F.coalesce(F.col("volume").cast("bigint").cast("string"), F.lit("None")),
            _truth("is_anomaly"),
        ),
        256,
    )


def symbol_hash() -> Column:
    """VER-2: sha256 of the attributes of a ticker."""
    flags = [_truth(c) for c in ("is_etf", "is_debt", "is_gem", "is_margin_eligible")]
    return F.sha2(F.concat_ws("|", _text("symbol"), _text("name"), _text("sector_name"), *flags), 256)


def diff(fresh: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """VER-4: fresh rows with ``change``: new, changed or same. Rows missing from fresh are no change.

    ``current`` has the keys and row_hash of the latest rows.
    """
    old = current.select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("row_hash").alias("_old"))
    on = [fresh[k] == old[f"_k_{k}"] for k in keys]
    change = F.when(F.col("_old").isNull(), "new").when(F.col("_old") != F.col("row_hash"), "changed").otherwise("same")
    return fresh.join(old, on, "left").select(*[fresh[c] for c in fresh.columns], change.alias("change"))


def delisted(fresh: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """VER-5: keys of latest rows that fresh lacks."""
    return current.join(fresh, keys, "left_anti").select(*keys)


def supersede(table: DataFrame, gone: DataFrame, keys: list[str], run_started: Column, now: Column) -> DataFrame:
    """VER-6, SNK-4, SNK-5: close the latest rows of the keys that were loaded before the run began."""
    marks = gone.select(*[F.col(k).alias(f"_g_{k}") for k in keys]).distinct().withColumn("_gone", F.lit(True))
    on = [table[k] == marks[f"_g_{k}"] for k in keys]
    close = F.coalesce(F.col("_gone"), F.lit(False)) & F.col("is_latest") & (F.col("loaded_at") < run_started)
    return table.join(marks, on, "left").select(
        *[
            F.when(close, F.lit(False)).otherwise(F.col("is_latest")).alias(c)
            if c == "is_latest"
            else F.when(close, now).otherwise(F.col("superseded_at")).alias(c)
            if c == "superseded_at"
            else table[c]
            for c in table.columns
        ]
    )


def changes(current: DataFrame, fresh: DataFrame, keys: list[str], delist: bool = False):
    """New and changed fresh rows (VER-4), and a function of them that gives the keys to close (VER-5).

    ``current`` has the keys and row_hash of the latest rows. With ``delist`` the keys that fresh lacks
    are closed too: all of them, where fresh is empty.
    """
    found = diff(fresh, current, keys).filter("change <> 'same'")

    def gone(found: DataFrame) -> DataFrame:
        changed = found.filter("change = 'changed'").select(*keys)
        return changed.unionByName(delisted(fresh, current, keys)) if delist else changed

    return found, gone


def versions_of(found: DataFrame, id_column: str, now: Column) -> DataFrame:
    """New and changed rows as latest versions."""
    return (
        found.drop("change")
        .withColumn(id_column, F.expr("uuid()"))
        .withColumn("is_latest", F.lit(True))
        .withColumn("loaded_at", now)
        .withColumn("superseded_at", F.lit(None).cast("timestamp"))
    )


def ingest(table: DataFrame, fresh: DataFrame, keys: list[str], id_column: str, now: Column, delist: bool = False) -> DataFrame:
    """SNK-2..5: the table's next state, in one plan: changed (and delisted) keys closed, new rows added.

    ``fresh`` has a row_hash. An empty fresh changes nothing, unless ``delist`` closes all that it lacks.
    """
    found, gone = changes(table.filter("is_latest").select(*keys, "row_hash"), fresh, keys, delist)
    added = versions_of(found, id_column, now)
    return supersede(table, gone(found), keys, now, now).unionByName(added.select(*table.columns))


CHECKED = ("name", "sector_code", "is_etf", "is_debt", "is_gem", "is_margin_eligible")


def empty_dimension(spark, source: DataFrame) -> DataFrame:
    return spark.createDataFrame([], source.schema).select(
        *source.columns,
        F.lit("").alias("scd_id"),
        F.lit(None).cast("date").alias("updated_at"),
        F.lit(None).cast("date").alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )


def scd2(dim: DataFrame, source: DataFrame, now: dt.date, checked: tuple[str, ...] = CHECKED) -> DataFrame:
    """VER-7: the dimension after a snapshot of the source at ``now``.

    Changed (null-safe) or vanished open versions are closed, changed, new and returning symbols get
    a version, updated_at ``now``; all else stays. One full outer join, so a plan of several snapshots
    grows by one join for each.
    """
    columns = source.columns
    at = F.lit(now).cast("date")
    open_ = F.col("valid_to").isNull() & F.col("scd_id").isNotNull()
    s = source.select(*[F.col(c).alias(f"_s_{c}") for c in columns])
    # a closed version has no key, meets nothing and passes through
    both = dim.withColumn("_open", F.when(F.col("valid_to").isNull(), F.col("symbol")))
    both = both.join(s, both["_open"] == s["_s_symbol"], "full_outer")
    differs = F.lit(False)
    for c in checked:
        if c in columns:
            differs = differs | ~F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    missing = F.col("_s_symbol").isNull()
    had = F.col("scd_id").isNotNull()
    until = F.when(open_ & (missing | differs), at).otherwise(F.col("valid_to"))
    old = F.struct(*[F.col(c) for c in columns], "scd_id", "updated_at", "valid_from", until.alias("valid_to"))
    key = F.md5(F.concat_ws("|", F.col("_s_symbol"), at.cast("string")))
    new = F.struct(
        *[F.col(f"_s_{c}").alias(c) for c in columns],
        key.alias("scd_id"),
        at.alias("updated_at"),
        at.alias("valid_from"),
        F.lit(None).cast("date").alias("valid_to"),
    )
    versions = F.filter(
        F.array(F.when(had, old), F.when(~missing & (~had | differs), new)), lambda v: v.isNotNull()
    )
    return both.select(F.explode(versions).alias("v")).select("v.*")
