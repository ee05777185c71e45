"""SimHash near-duplicates by tiled exact comparison.

Documents get 64-bit fingerprints; equal fingerprints become one row before any comparison. Two
fingerprints within ``radius`` bits agree on all bits of at least ``blocks - radius`` of ``blocks``
blocks, so each is dealt once to every choice of so many blocks, and only those that share a choice
meet. Within such a bucket fingerprints lie in tiles of one population count: tile pairs whose counts
differ by more than the radius are skipped, all others are compared exactly, with exclusive-or and
bit counts. A bucket of more than ``tile`` fingerprints is dealt over pairs of tiles of that size. A
task gives no more links than nodes (a spanning forest), and components spread by joins.

Defined cases: a null or wordless text has fingerprint zero and is linked like any other; a text of
fewer than three words is one shingle; a null doc_id is fingerprinted and linked but names no
component, which is null where all its documents' ids are null; repeated rows give repeated rows.
``near_dedup`` tells rows apart by doc_id and text. Other columns are ignored or, there, kept.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LOWER_BYTES, materialise, ranges, slices, table
from .components import components

SHINGLE = 3
RADIUS = 2
BLOCKS = 4
TILE = 4096
SEED = 42
BATCH_BYTES = 1_000_000
#: Most rows of a tile, and row pairs that are compared at once.
STEP = 512
CELLS = 1_000_000


def shingle_hashes(raw: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """XXH64 of each shingle of the text with A-Z lower-cased, repeats included."""
    words = raw.translate(LOWER_BYTES).split() if raw else []
    if not words:
        return np.zeros(0, np.uint64)
    flat = b" ".join(words)
    n = len(words)
    if n <= width:
        return np.array([xxhash.xxh64_intdigest(flat, SEED)], np.uint64)
    sizes = np.fromiter(map(len, words), np.int64, n) + 1
    ends = np.cumsum(sizes)
    starts = (ends - sizes)[: n - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(flat[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, len(starts))


def simhash(raw: bytes | None, width: int = SHINGLE) -> int:
    """Bits set in over half of the shingle hashes; zero for no words."""
    hashes = shingle_hashes(raw, width)
    if not len(hashes):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id, fp (the 64 bits as a signed long)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            sizes = pc.binary_length(texts).to_pylist()
            for start, stop in slices(sizes, BATCH_BYTES):
                got = [simhash(raw, width) for raw in texts.slice(start, stop - start).to_pylist()]
                fp = np.array(got, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(fp)], names=["doc_id", "fp"]
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp long")


def _block_masks(blocks: int, radius: int) -> list[int]:
    """A mask, as a signed long, for each choice of blocks that must agree."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    part = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(part[i] for i in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _dealt(distinct: DataFrame, blocks: int, radius: int, tile: int) -> DataFrame:
    """fp and the bucket (choice, key, t, u) it is compared in; lone fingerprints are gone."""
    masks = F.array(*[F.lit(m) for m in _block_masks(blocks, radius)])
    keyed = distinct.select("fp", F.posexplode(masks).alias("choice", "mask")).select(
        "fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("key")
    )
    crowded = keyed.groupBy("choice", "key").agg(F.count("*").alias("n")).filter("n > 1")
    met = keyed.join(crowded, ["choice", "key"])
    tiles = F.ceil(F.col("n") / tile).cast("int")
    met = met.select("fp", "choice", "key", tiles.alias("tiles"), F.bit_count("fp").cast("int").alias("ones"))
    # a crowded bucket's tiles hold fingerprints of one population count; they meet near ones only
    mine = F.struct(F.col("ones"), F.expr("cast(pmod(xxhash64(fp), tiles) as int)").alias("part"))
    others = F.flatten(
        F.transform(
            F.sequence(F.greatest(F.col("ones") - radius, F.lit(0)), F.least(F.col("ones") + radius, F.lit(64))),
            lambda o: F.transform(
                F.sequence(F.lit(0), F.col("tiles") - 1), lambda p: F.struct(o.alias("ones"), p.alias("part"))
            ),
        )
    )
    whole = F.struct(F.lit(-1).alias("ones"), F.lit(0).alias("part"))
    pairs = F.when(
        F.col("tiles") > 1,
        F.transform(others, lambda o: F.struct(F.least(mine, o).alias("t"), F.greatest(mine, o).alias("u"))),
    ).otherwise(F.array(F.struct(whole.alias("t"), whole.alias("u"))))
    return met.select("fp", "choice", "key", F.explode(pairs).alias("pair")).select("choice", "key", "pair", "fp")


def _roots(n: int, a: np.ndarray, b: np.ndarray, root: np.ndarray | None = None) -> np.ndarray:
    """Smallest place reachable from each of n places, beginning from the trees of ``root``."""
    root = np.arange(n) if root is None else root
    while len(a):
        least = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], least)
        np.minimum.at(new, root[b], least)
        new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    return root


@dataclass
class TilePairs:
    """Tiles [start, stop) of rows, and for each tile the tiles [itself, near) that it is compared with."""

    start: np.ndarray
    stop: np.ndarray
    near: np.ndarray
    compared: int
    skipped: int


def tile_pairs(buckets: np.ndarray, ones: np.ndarray, radius: int) -> TilePairs:
    """Tiles of rows in order of (bucket, population count).

    A tile holds at most ``STEP`` rows of one bucket and one population count. Of the later tiles of
    its bucket, those whose counts are beyond the radius are skipped.
    """
    n = len(buckets)
    place = np.concatenate(([0], np.cumsum(buckets[1:] != buckets[:-1]))) if n else np.zeros(0, np.int64)
    key = place * 256 + ones
    edge = np.concatenate(([True], key[1:] != key[:-1])) if n else np.zeros(0, bool)
    first = np.flatnonzero(edge)
    nth = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
    start = np.flatnonzero(edge | (nth % STEP == 0))
    stop = np.append(start[1:], n)
    of = key[start]
    near = np.searchsorted(of, of + radius, side="right")
    last = np.searchsorted(of, (of // 256 + 1) * 256)
    near = np.minimum(near, last)
    me = np.arange(len(start))
    return TilePairs(start, stop, near, int((near - me).sum()), int((last - near).sum()))


def compare_tiles(buckets: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within buckets: (fingerprint, its tree's root).

    Rows of a bucket come together. Fingerprints that lie in several buckets have a place in each.
    """
    order = np.lexsort((np.bitwise_count(fps), buckets))
    buckets, fps = buckets[order], fps[order]
    tiles = tile_pairs(buckets, np.bitwise_count(fps).astype(np.int64), radius)
    root = np.arange(len(fps))
    mine = np.repeat(np.arange(len(tiles.start)), tiles.near - np.arange(len(tiles.start)))
    other = ranges(np.arange(len(tiles.start)), tiles.near - np.arange(len(tiles.start)))
    width = tiles.stop - tiles.start
    cells = width[mine] * width[other]
    for begin, end in slices(cells.tolist(), CELLS):  # the rows of some tile pairs, all against all
        a, b, n = mine[begin:end], other[begin:end], cells[begin:end]
        k = ranges(np.zeros(len(n), np.int64), n)
        wide = np.repeat(width[b], n)
        x = np.repeat(tiles.start[a], n) + k // wide
        y = np.repeat(tiles.start[b], n) + k % wide
        near = (np.bitwise_count(fps[x] ^ fps[y]) <= radius) & (x < y)
        root = _roots(len(fps), x[near], y[near], root)
    child = np.flatnonzero(root != np.arange(len(fps)))
    return fps[child], fps[root[child]]


def links(distinct: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE) -> DataFrame:
    """a, b: links that join all fingerprints within the radius, directly or through others."""
    dealt = _dealt(distinct, blocks, radius, tile)
    order = ["choice", "key", "pair"]
    dealt = dealt.repartition(*order).sortWithinPartitions(*order).select(
        F.xxhash64(*order).alias("bucket"), "fp"
    )

    def run(batches):
        held_g, held_f = np.zeros(0, np.int64), np.zeros(0, np.uint64)

        def out(g, f):
            a, b = compare_tiles(g, f, radius)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            held_g = np.concatenate((held_g, batch.column(0).to_numpy(zero_copy_only=False)))
            held_f = np.concatenate((held_f, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)))
            if not len(held_g):
                continue
            first = int(np.flatnonzero(held_g == held_g[-1])[0])  # the last bucket may go on
            if first:
                yield out(held_g[:first], held_f[:first])
                held_g, held_f = held_g[first:], held_f[first:]
        if len(held_g):
            yield out(held_g, held_f)

    return dealt.mapInArrow(run, "a long, b long").distinct()


def hex64(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def near_duplicates(
    docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE
) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id reachable by links, itself included."""
    fps = materialise(fingerprints(docs, width), "fingerprints")
    first = fps.groupBy("fp").agg(F.min("doc_id").alias("first"))
    tree = components(links(first.select("fp"), radius, blocks, tile))
    linked = first.join(tree, first["fp"] == tree["node"], "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component")
    )
    # of a component, then of each of its fingerprints: the smallest id
    least = linked.groupBy("component").agg(F.min("first").alias("component_id"))
    named = linked.join(least, "component").select(F.col("fp").alias("_fp"), "component_id")
    return fps.join(named, fps["fp"] == named["_fp"], "left").select("doc_id", "fp", "component_id")


def near_dedup(
    docs: DataFrame, width: int = SHINGLE, radius: int = RADIUS, blocks: int = BLOCKS, tile: int = TILE
) -> DataFrame:
    """The documents, in their own columns, with one row of each component.

    A row is a document, known by its doc_id and text: of the rows of a component the one with the
    smallest doc_id stays (null after all others; of equal ids the least hash of the text), and of
    rows that agree in both one. Rows that share a doc_id and are unlike both stay.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    key = [
        F.col("doc_id").isNull().alias("_no_id"),
        F.coalesce(F.col("doc_id"), F.lit(0).cast(kind)).alias("_id"),
        F.xxhash64("text").alias("_text"),
    ]
    names = ["_no_id", "_id", "_text"]
    rows = docs.select(F.struct(*key).alias("doc_id"), "text")
    found = near_duplicates(rows, width, radius, blocks, tile).filter(F.col("component_id") != F.col("doc_id"))
    gone = found.select("doc_id.*").distinct()
    keyed = docs.select(*key, F.struct(*docs.columns).alias("row"))
    return keyed.join(gone, names, "left_anti").dropDuplicates(names).select("row.*")


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", hex64(F.col("fp")).alias("fingerprint"), "component_id"
    )


QUERIES = {"op3_simhash_dedup": op3_simhash_dedup}

ORACLE_SQL: dict[str, str] = {}
