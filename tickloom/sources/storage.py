"""Where state that all machines read is kept."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder named by spark.checkpoint.dir, which goes when the application ends.

    A local session without that setting gets a temporary folder; on a cluster that is an error, as
    each machine would write to its own disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="state-")
    folder = f"{root.rstrip('/')}/state-{spark.sparkContext.applicationId}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return f"{folder}/{label}-{uuid.uuid4().hex}"


def written(label: str, rows: DataFrame) -> DataFrame:
    """The rows written aside once and read back: for what several branches of a query read."""
    path = shared_path(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)
