"""Micro-batches of price versions, merged into the table of latest prices as they arrive.

Each batch is reduced to one version of a key before it meets the table, and the table's next
version is written aside and then named, so a batch that is run again after a failure gives the
same state. Row-count windows are no streaming operation; measures are batch jobs over the table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import Table


def newest(df: DataFrame, keys: list[str], version: str) -> DataFrame:
    """The row of the greatest version of each key, by an aggregate that is combined map-side."""
    rest = [c for c in df.columns if c not in keys]
    picked = F.max_by(F.struct(*rest), F.col(version)).alias("_v")
    return df.groupBy(*keys).agg(picked).select(*keys, "_v.*")


def merge_batch(table: Table, batch: DataFrame, keys: list[str], version: str) -> None:
    """Upsert the versions that are newer than the table's; only the batch's partitions are touched."""
    fresh = newest(batch, keys, version)
    if table.version():
        old = table.read(table.parts_in(fresh)).select(*keys, F.col(version).alias("_old"))
        fresh = fresh.join(old, keys, "left").filter(F.col("_old").isNull() | (F.col(version) > F.col("_old"))).drop("_old")
    table.merge(fresh, keys)


def ingest_available(
    spark: SparkSession,
    folder: str,
    glob: str,
    schema,
    shape: Callable[[DataFrame], DataFrame],
    table: Table,
    keys: list[str],
    version: str,
) -> DataFrame:
    """Read all files that have arrived, in micro-batches, shape and merge them; the table after that."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).option("maxFilesPerTrigger", 8).parquet(folder)
    query = (
        stream.writeStream.foreachBatch(lambda batch, _: merge_batch(table, shape(batch), keys, version))
        .option("checkpointLocation", f"{table.path}/_offsets")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return table.read()
