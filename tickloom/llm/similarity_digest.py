"""Similarity digests of improbable features.

Each window of ``WINDOW`` bytes of a text has an entropy; classes of entropy that are rare over all
windows of all documents rank first, and those of very low entropy after all others. The rarest
window of every ``NEIGHBOURHOOD`` successive ones is selected (the first of equals), hashed, and put
into a chain of Bloom filters, ``FILTER_FEATURES`` to a filter. Two digests are alike as far as their
filters share more bits than chance gives: for each filter of the shorter chain, the best overlap
with a filter of the other, normalised between chance (0) and all bits of the smaller (1), weighted
by the filters' features.

Defined cases: a null text is empty; an empty text has no window, thus no filter, and is like an
empty text alone; any other text has a feature at least, as a text of fewer bytes than a window is
one window, ended by zero bytes; equal texts have equal digests; a null doc_id sorts before all
others, one that is no number next to it; rows that share a doc_id are ordered
by text, and a table of one row follows itself. Long texts are read in segments that give the same
features. Rows whose ids are null or no numbers are one piece. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_bounds, id_key, piece_of, slices, table

WINDOW = 16
NEIGHBOURHOOD = 32
FILTER_BITS = 2048
FILTER_FEATURES = 160
HASHES = 5
#: Windows of less entropy in bits rank last; a window of one repeated byte has none.
LEAST_ENTROPY = 1.5
SEGMENT = 500_000
BATCH_BYTES = 1_000_000
#: Parts of a bit that tell classes of entropy apart.
_PARTS = 64
_MOST = 4 * WINDOW * _PARTS  # log2(WINDOW) * WINDOW
_G = np.array([0] + [round(c * np.log2(c) * _PARTS) for c in range(1, WINDOW + 1)], np.int32)
_PAD = WINDOW + NEIGHBOURHOOD
_NEVER = np.int64(1 << 20)


def _crowding(data: np.ndarray) -> np.ndarray:
    """For each window, the sum of c * log2(c) over its bytes' counts: WINDOW times (4 - entropy)."""
    n = len(data)
    after, before = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
    for d in range(1, WINDOW):
        same = (data[d:] == data[:-d]).view(np.uint8)
        after[:-d] += same
        before[d:] += same
    # leaving the window: the first byte, counted with what follows it; entering: the one behind
    leave = _G[after[: n - WINDOW] + 1] - _G[after[: n - WINDOW]]
    enter = _G[before[WINDOW:] + 1] - _G[before[WINDOW:]]
    first = _G[np.bincount(data[:WINDOW], minlength=256)].sum()
    out = np.empty(n - WINDOW + 1, np.int32)
    out[0] = first
    np.cumsum(enter - leave, out=out[1:])
    out[1:] += first
    return out


class _Units:
    """Texts of a batch laid out one after the other, padded, long ones in overlapping segments."""

    def __init__(self, raws: list[bytes]):
        parts, at = [], 0
        #: text, place in data, first window there, windows [s, e) that count, last window there
        self.spans: list[tuple[int, int, int, int, int, int]] = []
        for text, raw in enumerate(raws):
            raw = raw.ljust(WINDOW, b"\0") if raw else raw
            windows = max(0, len(raw) - WINDOW + 1)
            for s in range(0, windows, SEGMENT):
                e = min(s + SEGMENT, windows)
                lo, hi = max(0, s - NEIGHBOURHOOD + 1), min(windows, e + NEIGHBOURHOOD - 1)
                self.spans.append((text, at, lo, s, e, hi))
                part = raw[lo : hi + WINDOW - 1] + bytes(_PAD)
                parts.append(part)
                at += len(part)
        self.data = np.frombuffer(b"".join(parts), np.uint8)


def entropy_classes(raws: list[bytes]) -> np.ndarray:
    """Number of windows of each class in the texts."""
    total = np.zeros(_MOST + 1, np.int64)
    units = _Units(raws)
    if not units.spans:
        return total
    crowd = _crowding(units.data)
    for _, at, lo, s, e, _ in units.spans:
        total += np.bincount(crowd[at + s - lo : at + e - lo], minlength=_MOST + 1)
    return total


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of each class of entropy, the rarest first and low ones last, from all windows of all documents."""

    def count(batches):
        total = np.zeros(_MOST + 1, np.int64)
        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                total += entropy_classes([r or b"" for r in texts.slice(start, stop - start).to_pylist()])
        got = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(got), pa.array(total[got])], names=["class", "n"])

    rows = docs.select("text").mapInArrow(count, "class long, n long").groupBy("class").agg(F.sum("n").alias("n")).collect()
    counts = np.full(_MOST + 1, np.iinfo(np.int64).max)
    for r in rows:
        counts[r["class"]] = r["n"]
    rank = np.empty(_MOST + 1, np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(_MOST + 1)
    low = np.arange(_MOST + 1) > WINDOW * _PARTS * (np.log2(WINDOW) - LEAST_ENTROPY)
    return np.where(low, rank + _MOST + 1, rank)


def _mixed(blocks: np.ndarray) -> np.ndarray:
    """64-bit hashes of 16-byte windows."""
    k = blocks.view("<u8")
    h = k[:, 0] * np.uint64(0x9E3779B97F4A7C15) ^ (k[:, 1] + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ h >> np.uint64(32)


def digests(raws: list[bytes], rank: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text: filters (rows of 256 bytes) and the features in each."""
    owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    units = _Units(raws)
    if units.spans:
        data = units.data
        key = np.full(len(data), _NEVER, np.int64)
        crowd = _crowding(data)
        for _, at, lo, _, _, hi in units.spans:
            key[at : at + hi - lo] = rank[crowd[at : at + hi - lo]]
        key = key << 32 | np.arange(len(key))
        width, least = 1, key
        while width < NEIGHBOURHOOD:  # least of each `width` windows from here on, doubled
            step = min(width, NEIGHBOURHOOD - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        # windows before the first: their neighbourhoods hold it too
        head = np.minimum.accumulate(key[: NEIGHBOURHOOD - 1])
        place = np.concatenate((head, least)) & 0xFFFFFFFF
        place = np.unique(place)
        place = place[key[place] >> 32 < _NEVER]
        for text, at, lo, s, e, _ in units.spans:
            a, b = np.searchsorted(place, (at + s - lo, at + e - lo))
            mine = place[a:b]
            owners.append(np.full(len(mine), text))
            blocks = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[mine]
            hashes.append(_mixed(np.ascontiguousarray(blocks)))
    owner, h = np.concatenate(owners), np.concatenate(hashes)
    # the first of each feature of a text, in order of place
    order = np.lexsort((np.arange(len(h)), h, owner))
    again = np.zeros(len(h), bool)
    again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    owner, h = owner[~again], h[~again]
    order = np.argsort(owner, kind="stable")
    owner, h = owner[order], h[order]
    sizes = np.bincount(owner, minlength=len(raws))
    filters = -(-sizes // FILTER_FEATURES)
    base = np.cumsum(filters) - filters
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = base[owner] + nth // FILTER_FEATURES
    bits = np.zeros((int(filters.sum()), FILTER_BITS), bool)
    for k in range(HASHES):
        bits[row, (h >> np.uint64(11 * k)).astype(np.int64) % FILTER_BITS] = True
    packed = np.packbits(bits, axis=1)
    held = np.bincount(row, minlength=len(packed))
    return [(packed[b : b + f], held[b : b + f]) for b, f in zip(base.tolist(), filters.tolist())]


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 (as alike as by chance, or less) to 1."""
    if len(a[0]) > len(b[0]) or (len(a[0]) == len(b[0]) and a[1].sum() > b[1].sum()):
        a, b = b, a
    if not len(a[0]):
        return float(not len(b[0]))
    x, y = a[0].view(np.uint64), b[0].view(np.uint64)
    ones_x = np.bitwise_count(x).sum(axis=1, dtype=np.int64)
    ones_y = np.bitwise_count(y).sum(axis=1, dtype=np.int64)
    best = np.zeros(len(x))
    for i in range(len(x)):
        shared = np.bitwise_count(x[i] & y).sum(axis=1, dtype=np.int64)
        chance = ones_x[i] * ones_y / FILTER_BITS
        most = np.minimum(ones_x[i], ones_y)
        best[i] = ((shared - chance) / np.maximum(most - chance, 1e-9)).max()
    return float(np.clip((np.clip(best, 0, 1) * a[1]).sum() / a[1].sum(), 0, 1))


def to_string(digest: tuple[np.ndarray, np.ndarray]) -> str:
    """Features of each filter (16 bits each) and the filters, in base 64."""
    filters, held = digest
    return f"{len(filters)}:" + base64.b64encode(struct.pack(f"<{len(held)}H", *held) + filters.tobytes()).decode()


def from_string(text: str) -> tuple[np.ndarray, np.ndarray]:
    n, _, rest = text.partition(":")
    data = base64.b64decode(rest)
    held = np.frombuffer(data, "<u2", int(n)).astype(np.int64)
    return np.frombuffer(data[2 * int(n) :], np.uint8).reshape(int(n), FILTER_BITS // 8), held


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by as many from the start of the next text."""
    tail = len(text) // 4
    return text[: len(text) - tail] + following[:tail]


# -- each document beside the next --------------------------------------------------------------


def dealt_in_order(docs: DataFrame, pieces: int) -> DataFrame:
    """piece, tail, doc_id, text: runs of documents in order of id, each ended by its successor.

    Pieces start at ids of documents, so a piece's successor is the document of the next bound, sent
    to both; the last piece is followed by the first document.
    """
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), id_key().alias("key"))
    first = keyed.agg(F.min("key")).first()[0] or 0
    bounds = id_bounds(docs, pieces) or [first]  # each bound is the id of a document
    piece = piece_of(F.col("key"), bounds)
    row = lambda p, tail: F.struct(p.cast("int").alias("piece"), F.lit(tail).alias("tail"))
    starts = F.get(F.array(*[F.lit(b).cast("long") for b in bounds]), F.col("piece") - 1) == F.col("key")
    none = F.array().cast("array<struct<piece:int,tail:int>>")
    sent = F.concat(
        F.array(row(F.col("piece"), 0)),
        F.when(starts, F.array(row(F.col("piece") - 1, 1))).otherwise(none),
        F.when(F.col("key") == first, F.array(row(F.lit(len(bounds)), 1))).otherwise(none),
    )
    placed = keyed.withColumn("piece", piece.cast("int")).withColumn("sent", F.explode(sent))
    # ids of one key (nulls, no numbers) are in order of the id itself
    placed = placed.select("sent.piece", "sent.tail", "doc_id", "key", "text")
    return (
        placed.repartitionById(pieces, F.col("piece"))
        .sortWithinPartitions("piece", "tail", "key", "doc_id", "text")
        .select("piece", "tail", "doc_id", "text")
    )


def _followed(batches):
    """(doc_id, text, next text) of the rows of a partition in order."""
    waiting, at = None, None  # the last document of a piece, whose successor has not come yet
    for batch in batches:
        for piece, tail, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
            if waiting is not None:
                if piece != at:
                    raise AssertionError(f"piece {at} has no successor")
                yield (*waiting, text)
                waiting = None
            if not tail:
                waiting, at = (doc, text), piece
    if waiting is not None:
        raise AssertionError(f"piece {at} has no successor")


def fingerprint_with_next(docs: DataFrame, pieces: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    spark = docs.sparkSession
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rank = rarity(docs)
    kind = docs.schema["doc_id"].dataType

    def out(rows):
        texts: list[str] = []
        follows = []
        for i, (_, text, after) in enumerate(rows):
            texts.append(text)
        for i, (_, _, after) in enumerate(rows):
            if i + 1 < len(rows) and after is rows[i + 1][1]:
                follows.append(i + 1)
            else:
                follows.append(len(texts))
                texts.append(after)
        changed = [edited(text, after) for _, text, after in rows]
        raws = [t.encode(errors="replace") for t in texts + changed]
        got = []
        for start, stop in slices([len(r) for r in raws], BATCH_BYTES):
            got += digests(raws[start:stop], rank)
        base = len(texts)
        names = [to_string(g) for g in got]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], schema.field(0).type),
                pa.array([len(r[1]) for r in rows], pa.int64()),
                pa.array([hashlib.sha256(r).hexdigest() for r in raws[base:]], pa.string()),
                pa.array(names[: len(rows)], pa.string()),
                pa.array(names[base:], pa.string()),
                pa.array([likeness(got[i], got[base + i]) for i in range(len(rows))], pa.float64()),
                pa.array([likeness(got[i], got[f]) for i, f in enumerate(follows)], pa.float64()),
            ],
            schema=schema,
        )

    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema(
        [("doc_id", to_arrow_type(kind)), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
         ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()),
         ("near_next", pa.float64())]
    )

    def run(batches):
        rows, size = [], 0
        for row in _followed(batches):
            rows.append(row)
            size += len(row[1])
            if size >= BATCH_BYTES:
                yield out(rows)
                rows, size = [], 0
        if rows:
            yield out(rows)

    return dealt_in_order(docs, pieces).mapInArrow(
        run,
        f"doc_id {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )


def op8_similarity_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_next(table(spark, sf_dir, "documents"))


QUERIES = {"op8_similarity_digest": op8_similarity_digest}

ORACLE_SQL: dict[str, str] = {}
