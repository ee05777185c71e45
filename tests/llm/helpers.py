"""Small tables with the cases that every operator must define."""

import pandas as pd
from pyspark.sql import functions as F

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def docs(spark, rows, clash=()):
    """(doc_id, text) rows, with lang and source, and extra columns of the given names."""
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    frame = frame.withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string"))
    for name in clash:
        frame = frame.withColumn(name, F.lit("extra"))
    return frame


def collected(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def by_id(df, column):
    return {r["doc_id"]: r[column] for r in df.collect()}


def words(rng, n):
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randrange(3, 9))) for _ in range(n)]


def parquet(path):
    return pd.read_parquet(path)


SF = "/root/testdata/sf0.001"
