"""Token ids in Simple-8b files.

Ids are packed into 64-bit words: the low four bits select how many values of how many bits the
other 60 hold (a selector for each packing), and selector 0 is an escape: the next word holds one
value of up to 64 bits. Every ``BLOCK`` ids a new word begins, and a segment's payload starts with
the word offset of each block, so blocks decode on their own and all words of a segment at once.

A file set is a directory of Parquet files whose rows are segments, written by Spark's own writer (a
lost executor's files are committed once or not at all, on any store): ``part`` and ``segment`` in
order of doc_id, ``first`` (ids of the part before the segment), ``n_ids``, the documents' ids and
lengths, and the payload. Parts are ranges of doc_id.

Texts are encoded whole by the tokenizers library, by the vocabulary file's steps but for those that
cannot change an id (``_tokenizers``).

Defined cases: a null text is empty and has the end id alone; a null doc_id comes first; rows that
share a doc_id are ordered by text; rows whose ids are null or no numbers are one part; an empty table is an empty file set. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_bounds, id_key, piece_of, shared_path, slices, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
END = 1
BLOCK = 1024
#: Characters of the texts of a segment, one text at least.
SEGMENT_CHARS = 1_000_000

#: Values and bits of selectors 1 to 15; selector 0 is the escape.
PACKINGS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]


def pack(values: np.ndarray, block: int = BLOCK) -> bytes:
    """Block count, word offsets of the blocks and of the end (all 64 bits), then the words.

    In each block the packing that takes most of the next values is chosen, for all blocks at once.
    """
    values = np.ascontiguousarray(values, np.uint64)
    n = len(values)
    starts = np.arange(0, n, block)
    ends = np.minimum(starts + block, n)
    owner_end = np.repeat(ends, ends - starts)
    # how many values from each place fit the best packing; a block's last word may be part-filled
    left = (owner_end - np.arange(n)).astype(np.int32)
    most = int(values.max()) if n else 0
    small = values.astype(np.uint32) if most < 1 << 32 else values
    need = np.zeros(n, np.uint8)  # the tightest packing that holds a value
    for _, bits in PACKINGS:
        if most >> bits:
            need += small >= small.dtype.type(1 << bits)
    # the tightest packing whose number of next values all fit; what a block lacks counts as fitting
    need = np.pad(np.pad(need, (0, -n % block)).reshape(-1, block), ((0, 0), (0, PACKINGS[0][0] - 1)))
    wide, reach, largest = need.ravel(), 1, sum(1 for _, bits in PACKINGS if most >> bits)
    selector = np.zeros(wide.size, np.int8)
    for i in reversed(range(len(PACKINGS))):
        more = PACKINGS[i][0] - reach  # no more than reach: two windows make up the next
        if more:
            wide = np.append(np.maximum(wide[:-more], wide[more:]), wide[-more:])
            reach += more
        if i <= largest:
            np.copyto(selector, np.int8(i + 1), where=wide <= i)
    selector = selector.reshape(need.shape)[:, :block].ravel()[:n]
    take = np.minimum(np.array([1] + [count for count, _ in PACKINGS], np.int32)[selector], left)
    # hop from word to word in all blocks together
    places, blocks = [], []
    at, live = starts.copy(), np.arange(len(starts))
    while len(live):
        places.append(at[live])
        blocks.append(live)
        at[live] += take[at[live]]
        live = live[at[live] < ends[live]]
    place = np.concatenate(places or [np.zeros(0, np.int64)])
    of = np.concatenate(blocks or [np.zeros(0, np.int64)])
    order = np.argsort(place, kind="stable")
    place, of = place[order], of[order]
    chosen = selector[place]
    width = np.where(chosen == 0, 2, 1)
    word_at = np.cumsum(width) - width
    words = np.zeros(int(width.sum()), np.uint64)
    padded = np.concatenate((values, np.zeros(60, np.uint64)))
    for s in np.unique(chosen).tolist():
        mine = np.flatnonzero(chosen == s)
        if s == 0:
            words[word_at[mine] + 1] = values[place[mine]]
            continue
        count, bits = PACKINGS[s - 1]
        at, n_taken = place[mine], take[place[mine]]
        for full, some in ((True, np.flatnonzero(n_taken == count)), (False, np.flatnonzero(n_taken < count))):
            first = at[some]
            word = np.full(len(some), s, np.uint64)
            for k in range(count):
                value = padded[first + k]
                if not full:
                    value = np.where(k < n_taken[some], value, np.uint64(0))
                word |= value << np.uint64(4 + k * bits)
            words[word_at[mine[some]]] = word
    offsets = np.zeros(len(starts) + 1, np.uint64)
    offsets[1:] = np.cumsum(np.bincount(of, width, len(starts))).astype(np.uint64)
    return np.array([len(starts)], "<u8").tobytes() + offsets.astype("<u8").tobytes() + words.astype("<u8").tobytes()


def _unpack_words(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All values of all words, and how many each word has; escapes' payload words have none."""
    n = len(words)
    tags = (words & np.uint64(15)).astype(np.int64)
    counts = np.array([1] + [c for c, _ in PACKINGS] + [0])[tags]
    payload = np.zeros(n, bool)
    if (tags == 0).any():  # the word behind an escape is a value, whatever its low bits
        for i in np.flatnonzero(tags == 0).tolist():
            if not payload[i]:
                payload[i + 1] = True
    counts[payload] = 0
    at = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in np.unique(tags[~payload]).tolist():
        mine = np.flatnonzero((tags == s) & ~payload)
        if s == 0:
            out[at[mine]] = words[mine + 1]
            continue
        count, bits = PACKINGS[s - 1]
        mask = np.uint64((1 << bits) - 1)
        for k in range(count):
            out[at[mine] + k] = words[mine] >> np.uint64(4 + k * bits) & mask
    return out, counts


def _parts(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    offsets = np.frombuffer(data, "<u8", n + 1, 8).astype(np.int64)
    return offsets, np.frombuffer(data, "<u8", int(offsets[-1]), 8 * (n + 2))


def unpack(data: bytes, n: int, block: int = BLOCK) -> np.ndarray:
    """The n values of a payload."""
    offsets, words = _parts(data)
    values, counts = _unpack_words(words)
    ends = np.concatenate(([0], np.cumsum(counts)))[offsets]
    # what a block's last word has beyond the block is padding
    sizes = np.minimum(block, n - block * np.arange(len(offsets) - 1))
    if np.array_equal(np.diff(ends), sizes):
        return values
    keep = np.arange(len(values)) - np.repeat(ends[:-1], np.diff(ends)) < np.repeat(sizes, np.diff(ends))
    return values[keep]


def unpack_block(data: bytes, n: int, k: int, block: int = BLOCK) -> np.ndarray:
    """The values of block k alone."""
    offsets, words = _parts(data)
    values, _ = _unpack_words(words[offsets[k] : offsets[k + 1]])
    return values[: min(block, n - k * block)]


# -- ids of texts --------------------------------------------------------------------------------


#: The steps of ``VOCABULARY``: words are matched without any blank, then their bytes become characters.
_NFC, _BLANKS, _LOWER = {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}
_WORDS = {
    "type": "Split",
    "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
#: ASCII that stands for itself neither as a blank nor as a byte.
_control = re.compile(r"[\x00-\x08\x0e-\x1f\x7f]")


def _sequence(kind: str, steps: list[dict]) -> dict:
    return {"type": "Sequence", kind: steps}


@cache
def _tokenizers(path: str) -> tuple:
    """The library's tokenizers for texts of printable ASCII and blanks, and for all others.

    Both are the file's without steps that change no id. Blanks need not become spaces, as the words'
    pattern drops them all; ASCII is in normal form C, and its printable bytes are their own
    characters. Special tokens are found in the raw text. A file of other steps is taken as it is.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    plain = other = {}
    if (
        spec["normalizer"] == _sequence("normalizers", [_NFC, _BLANKS, _LOWER])
        and spec["pre_tokenizer"] == _sequence("pretokenizers", [_WORDS, _BYTES])
        and not any(t["normalized"] for t in spec["added_tokens"])
    ):
        plain = {"normalizer": _LOWER, "pre_tokenizer": _WORDS}
        other = {"normalizer": _sequence("normalizers", [_NFC, _LOWER])}
    made = []
    for steps in (plain, other):
        tokenizer = Tokenizer.from_str(json.dumps(spec | steps))
        tokenizer.no_truncation()
        tokenizer.no_padding()
        made.append(tokenizer)
    return tuple(made)


def encode_texts(texts: list[str | None], vocabulary: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the whole texts and how many each has, by the tokenizers library."""
    plain, other = _tokenizers(vocabulary)
    texts = [t or "" for t in texts]
    is_plain = np.array([t.isascii() and not _control.search(t) for t in texts], bool)
    ids: list = [None] * len(texts)
    for tokenizer, mine in ((plain, np.flatnonzero(is_plain).tolist()), (other, np.flatnonzero(~is_plain).tolist())):
        coded = tokenizer.encode_batch_fast([texts[i] for i in mine], add_special_tokens=False)
        for i, e in zip(mine, coded):
            ids[i] = np.array(e.ids, np.int32)
    return np.concatenate([*ids, np.zeros(0, np.int32)]), np.array([len(x) for x in ids], np.int64)


def write_token_files(docs: DataFrame, path: str, vocabulary: str = VOCABULARY, end: int = END, parts: int | None = None) -> None:
    """Encode the texts, each ended by ``end``, and write them in ascending order of doc_id."""
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    # bounds from the ids alone: a range partitioning would read the texts once more to sample them
    part = piece_of(id_key(), id_bounds(docs, parts)).cast("int")
    ordered = (
        docs.select("doc_id", "text", part.alias("part"))
        .repartitionById(parts, F.col("part"))
        .sortWithinPartitions("doc_id", "text")
        .select("doc_id", "text")
    )

    def run(batches):
        part, segment, first = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            texts = batch.column(1)
            for start, stop in slices(pc.binary_length(texts).to_pylist(), SEGMENT_CHARS):
                flat, sizes = encode_texts(texts.slice(start, stop - start).to_pylist(), vocabulary)
                ids = np.insert(flat, np.cumsum(sizes), end)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([part], pa.int32()),
                        pa.array([segment], pa.int32()),
                        pa.array([first], pa.int64()),
                        pa.array([len(ids)], pa.int64()),
                        pa.ListArray.from_arrays(pa.array([0, stop - start], pa.int32()), batch.column(0).slice(start, stop - start)),
                        pa.array([(sizes + 1).tolist()], pa.list_(pa.int64())),
                        pa.array([pack(ids)], pa.binary()),
                    ],
                    names=["part", "segment", "first", "n_ids", "doc_ids", "lengths", "payload"],
                )
                segment, first = segment + 1, first + len(ids)

    ordered.mapInArrow(
        run, f"part int, segment int, first long, n_ids long, doc_ids array<{kind}>, lengths array<long>, payload binary"
    ).write.parquet(path)


def map_token_files(spark: SparkSession, path: str, use, schema: str) -> DataFrame:
    """Rows that ``use(doc_ids, starts, sizes, ids)`` makes of each segment, as an Arrow batch."""
    files = spark.read.parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()  # a row for each part
    base, total = {}, 0
    for row in sorted(sizes):
        base[row["part"]] = total
        total += row["n"]

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                part, _, first, n, doc_ids, lengths, payload = (c[row] for c in batch.columns)
                lengths = lengths.values.to_numpy()
                starts = base[part.as_py()] + first.as_py() + np.cumsum(lengths) - lengths
                yield use(doc_ids.values, starts, lengths, unpack(payload.as_py(), n.as_py()))

    return files.mapInArrow(run, schema)


def _id_type(files: DataFrame) -> str:
    return files.schema["doc_ids"].dataType.elementType.simpleString()


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before), token_ids array<long>, in no order of rows."""

    def rows(doc_ids, starts, sizes, ids):
        ends = np.concatenate(([0], np.cumsum(sizes)))
        lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids.astype(np.int64)))
        return pa.RecordBatch.from_arrays([doc_ids, pa.array(starts), lists], names=["doc_id", "start", "token_ids"])

    kind = _id_type(spark.read.parquet(path))
    return map_token_files(spark, path, rows, f"doc_id {kind}, start long, token_ids array<long>")


def _checked(doc_ids, starts, sizes, ids):
    flat = ids.astype("<u4")
    ends = np.cumsum(sizes)
    sums = [zlib.crc32(flat[a:b]) for a, b in zip((ends - sizes).tolist(), ends.tolist())]
    return pa.RecordBatch.from_arrays(
        [doc_ids, pa.array(starts), pa.array(sizes), pa.array(sums, pa.int64())],
        names=["doc_id", "start", "n_tokens", "ids_crc32"],
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "token-files")
    write_token_files(table(spark, sf_dir, "documents"), path)
    kind = _id_type(spark.read.parquet(path))
    return map_token_files(spark, path, _checked, f"doc_id {kind}, start long, n_tokens long, ids_crc32 long")


QUERIES = {"op10_token_files": op10_token_files}

ORACLE_SQL: dict[str, str] = {}
