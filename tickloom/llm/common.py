"""What the text operators share: shared storage, native string rules, batch helpers."""

from __future__ import annotations

import hashlib
import json
import mmap
import re
import tempfile
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: An odd factor that spreads keys over the high bits.
MIX = 0x9E3779B97F4A7C15
#: bytes.translate / str.translate tables that lower-case A-Z alone.
LOWER_STR = {ord(a): b for a, b in zip(UPPER, LOWER)}
LOWER_BYTES = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


#: Session settings for tables whose rows may be long texts: batches between Parquet, the JVM and
#: Python hold few rows, so their buffers stay small. Neither exists as an option of a reader.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    "spark.sql.parquet.columnarReaderBatchSize": "256",
}
#: What the settings were before a text query, for ``restore``.
_before: dict[str, str | None] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table with long texts; the session reads in small batches until ``restore``."""
    for key, value in BATCHES.items():
        _before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def restore(spark: SparkSession) -> None:
    """Put back the settings that ``table`` has changed; a query of other tables calls it first."""
    while _before:
        key, value = _before.popitem()
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def shared_folder(spark: SparkSession) -> str:
    """A folder of this application in the one that driver and executors share, spark.checkpoint.dir.

    It goes when the application ends. Where no folder is named a local session gets a temporary one;
    on a cluster that is an error, as each machine would write to its own disk.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    current = context._jsc.sc().getCheckpointDir()
    if root is None and current.isDefined():
        root = current.get()
    if root is None:
        if not re.match(r"local($|\[)", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        root = "file://" + tempfile.mkdtemp(prefix="shared-")
    if not current.isDefined():
        context.setCheckpointDir(root)
    folder = f"{root.rstrip('/')}/text-{context.applicationId}"
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(where)
    fs.deleteOnExit(where)
    return folder


def shared_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage and survives lost executors."""
    return materialised(df, label)[0]


def materialised(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """The same with the path, for one who knows when the rows are no longer read."""
    spark = df.sparkSession
    path = shared_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a path of the shared folder."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def publish(spark: SparkSession, data: bytes, label: str) -> str:
    """Put a file in the shared folder and hand it to every executor, present and future.

    Named after its content, so a repeated call sends nothing again. Workers open
    ``SparkFiles.get(name)`` and memory-map it.
    """
    name = f"{label}-{hashlib.sha256(data).hexdigest()[:24]}.bin"
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/{name}")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        part = jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark)}/.{name}-{uuid.uuid4().hex}")
        out = fs.create(part)
        step = 1 << 22
        for at in range(0, len(data), step):
            out.write(bytearray(data[at : at + step]))
        out.close()
        fs.rename(part, path)
    spark.sparkContext.addFile(path.toString())
    return name


def packed(head: dict, parts: dict[str, np.ndarray]) -> bytes:
    """A file of named arrays, each at a multiple of eight bytes, that ``mapped`` opens."""
    head, at = {**head, "parts": {}}, 0
    for name, a in parts.items():
        head["parts"][name] = [a.dtype.str, at, len(a)]
        at += -(-a.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    return b"".join(
        [len(text).to_bytes(8, "little"), text, *(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in parts.values())]
    )


def mapped(path: str) -> tuple[dict, dict[str, np.ndarray]]:
    """The head and the arrays of a file, memory-mapped."""
    with open(path, "rb") as f:
        data = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
    size = int.from_bytes(data[:8], "little")
    head = json.loads(data[8 : 8 + size])
    return head, {name: np.frombuffer(data, kind, n, 8 + size + at) for name, (kind, at, n) in head["parts"].items()}


def slot_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where a table of 2^bits slots looks for a key first."""
    return (keys.astype(np.uint64) * np.uint64(MIX) >> np.uint64(64 - bits)).astype(np.int64)


def slots_for(keys: np.ndarray, bits: int) -> np.ndarray:
    """A free slot for each key by linear probing, all keys at once."""
    slots, taken = slot_of(keys, bits), np.zeros(1 << bits, bool)
    todo = np.arange(len(keys))
    while len(todo):
        free = todo[~taken[slots[todo]]]
        _, first = np.unique(slots[free], return_index=True)
        won = free[first]
        taken[slots[won]] = True
        todo = np.setdiff1d(todo, won, assume_unique=True)
        slots[todo] = (slots[todo] + 1) & ((1 << bits) - 1)
    return slots


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. ``lower`` does just that to an ASCII string, and faster."""
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """crc32(doc_id as text) mod 5 is 0; a null id counts as held out: nothing is learnt from it."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def slices(lengths: Sequence[int | None], most: int) -> Iterator[tuple[int, int]]:
    """Consecutive (start, stop) row ranges of at most ``most`` units, but one row at least."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + (n or 0) > most:
            yield start, i
            start, total = i, 0
        total += n or 0
    if len(lengths) > start:
        yield start, len(lengths)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each range, one after the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def id_key(doc_id: str = "doc_id") -> Column:
    """The id as a long that deals rows to runs, null and what is no number before all."""
    return F.coalesce(F.col(doc_id).try_cast("long"), F.lit(-(1 << 63)))


def id_bounds(docs: DataFrame, pieces: int) -> list[int]:
    """At most pieces - 1 ids that part the documents into runs of like number, from the ids alone."""
    shares = [i / pieces for i in range(1, pieces)]
    if not shares:
        return []
    found = docs.select(id_key().alias("key")).agg(F.percentile_approx("key", shares, 10_000).alias("b")).first()
    return sorted({int(b) for b in found["b"] or []})


def piece_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are <= key, looked up in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))
    count = lambda a: F.size(F.filter(a, lambda b: b <= key))
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    group = count(longs(bounds[::step]))
    inner = F.array(*[longs(bounds[i : i + step]) for i in range(0, len(bounds), step)])
    return F.when(group == 0, 0).otherwise((group - 1) * step + count(F.get(inner, group - 1)))
