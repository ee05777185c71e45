"""Line deduplication across documents.

A line's key is the line without white space at its ends, A-Z lower-cased. Keys are hashed to 128
bits and exploded with their positions; documents are counted per hash in two steps, so a line that
most documents share is summed before it is shuffled by its hash. Keys found in ``min_docs``
documents or more lose all lines but those of the largest doc_id. What stays is reassembled by
position.

Lines are split and hashed as bytes in Arrow batches; counting and joins are Spark's.

Defined cases: a null or empty text is one empty line, which is never a key; a line repeated within
a document counts once; rows that repeat a doc_id are one document for the counts and each keeps its
own row; a null doc_id neither counts nor loses lines. Other columns are ignored or, in
``dedup_documents``, kept.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, materialise, slices, table

MIN_CHARS = 40
MIN_DOCS = 5
#: White space [\x20\x09-\x0D], stripped from both ends.
BLANK = b"\x20\x09\x0a\x0b\x0c\x0d"
BATCH_BYTES = 1_000_000
#: Spark's xxhash64 of a string: XXH64 with this seed, as a signed long.
SEED = 42


def line_hash(line: bytes, min_chars: int) -> bytes | None:
    """MD5 of the key; None for a key that is too short to count."""
    key = line.strip(BLANK)
    if len(key) < min_chars or (not key.isascii() and len(key.decode()) < min_chars):
        return None
    return hashlib.md5(key.translate(LOWER_BYTES)).digest()


def _text_hash(raw: bytes) -> int:
    h = xxhash.xxh64_intdigest(raw, SEED)
    return h - (1 << 64) if h >> 63 else h


def line_keys(docs: DataFrame, min_chars: int) -> DataFrame:
    """_id, _text_hash, pos, h: each line that has a key."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).cast(pa.binary())
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                rows, hashes, places, found = [], [], [], []
                for i, raw in enumerate(texts.slice(start, stop - start).to_pylist(), start):
                    if not raw:
                        continue
                    got = [(n, h) for n, line in enumerate(raw.split(b"\n")) if (h := line_hash(line, min_chars))]
                    if got:
                        rows += [i] * len(got)
                        hashes += [_text_hash(raw)] * len(got)
                        places += [n for n, _ in got]
                        found += [h for _, h in got]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows, pa.int64())),
                        pa.array(hashes, pa.int64()),
                        pa.array(places, pa.int32()),
                        pa.array(found, pa.binary()),
                    ],
                    names=["_id", "_text_hash", "pos", "h"],
                )

    known = docs.filter(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return known.mapInArrow(run, f"_id {kind}, _text_hash long, pos int, h binary")


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """_id, _text_hash, _lost: positions of the lines that the document with that text loses."""
    # the texts are split and hashed again for the join: writing the keys of all lines for it takes
    # disk and, under file://, three processes that Hadoop forks off an executor's JVM for each file
    keyed = line_keys(docs, min_chars)
    common = (
        keyed.select("_id", "h")
        .distinct()
        .groupBy("h")
        .agg(F.count("*").alias("n"), F.max("_id").alias("keeper"))
        .filter(F.col("n") >= min_docs)
        .select("h", "keeper")
    )
    # written aside, so that both sides of the join are plain exchanges: where one hash has very
    # many rows, they can be split, each part meeting the one row of the hash; in files of full size
    common = materialise(common.hint("rebalance"), "common-lines")
    return (
        keyed.join(common, "h")
        .filter(F.col("_id") < F.col("keeper"))
        .groupBy("_id", "_text_hash")
        .agg(F.collect_list("pos").alias("_lost"))
    )


def _marked(docs: DataFrame, min_chars: int, min_docs: int) -> tuple[DataFrame, Column]:
    """The documents beside the places of lines that they lose, null where they lose nothing."""
    lost = repeated_lines(docs.select("doc_id", "text"), min_chars, min_docs)
    same = (docs["doc_id"] == lost["_id"]) & (F.xxhash64(docs["text"]) == lost["_text_hash"])
    return docs.join(lost, same, "left"), lost["_lost"]


def without_lines(raw: bytes, lost: list[int]) -> tuple[bytes, int, int]:
    """What stays, the number of lines before, and of lines that went."""
    lines, gone = raw.split(b"\n"), set(lost)
    return b"\n".join([x for i, x in enumerate(lines) if i not in gone]), len(lines), len(gone)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped, text (of the lines that stay)."""
    marked, lost = _marked(docs.select("doc_id", "text"), min_chars, min_docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                raws = texts.slice(start, stop - start).to_pylist()
                places = batch.column(2).slice(start, stop - start).to_pylist()
                got = [without_lines(r or b"", p or ()) for r, p in zip(raws, places)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array([g[1] for g in got], pa.int64()),
                        pa.array([g[2] for g in got], pa.int64()),
                        pa.array([g[0] for g in got], pa.binary()).cast(pa.string()),
                    ],
                    names=["doc_id", "n_lines", "n_dropped", "text"],
                )

    rows = marked.select("doc_id", "text", lost.alias("lost"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_lines long, n_dropped long, text string")


def dedup_documents(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """All documents in their own columns; texts that lose lines are rewritten, others left as they are."""
    marked, lost = _marked(docs, min_chars, min_docs)
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            field = batch.schema.field(at)
            texts = batch.column(at).cast(pa.binary())
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                part = batch.slice(start, stop - start)
                raws = texts.slice(start, stop - start).to_pylist()
                places = part.column(part.num_columns - 1).to_pylist()
                columns = part.columns[:-1]
                if any(places):
                    kept = [without_lines(r, p)[0] if p and r is not None else r for r, p in zip(raws, places)]
                    columns[at] = pa.array(kept, pa.binary()).cast(field.type)
                yield pa.RecordBatch.from_arrays(columns, names=docs_columns)

    docs_columns = docs.columns
    return marked.select(*[docs[c] for c in docs_columns], lost.alias("_lost_lines")).mapInArrow(run, docs.schema)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


QUERIES = {"op2_line_dedup": op2_line_dedup}

ORACLE_SQL = {
    "op2_line_dedup": r"""
with lines as (
    select doc_id, i, l[i] as line,
           translate(trim(l[i], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as k
    from (
        select doc_id, l, unnest(range(1, len(l) + 1)) as i
        from (select doc_id, string_split(coalesce(text, ''), chr(10)) as l from documents)
    )
), common as (
    select k, max(doc_id) as keeper from lines
    where length(k) >= 40 group by k having count(distinct doc_id) >= 5
), judged as (
    select doc_id, i, line, common.k is not null and doc_id <> keeper as lost
    from lines left join common using (k)
)
select doc_id, count(*) as n_lines, cast(count(*) filter (where lost) as bigint) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not lost), '')) as kept_sha256
from judged group by doc_id
"""
}
