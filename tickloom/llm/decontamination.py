"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items go into suffix automata (one for each shard of items, built by the
executors), written as flat arrays that workers memory-map. Documents stream past them: for each word
the automaton gives the longest suffix that occurs in an item, and where that reaches a window
(``window`` words, or a whole shorter item) the words of the window are hit. A document is
contaminated when hit words make up ``coverage`` of it or more.

A file of a shard takes about 100 bytes for each of its words. At most ``MOST_SHARDS`` files are sent
out at a time; a larger benchmark is matched in several passes over the documents.

Defined cases: a null or wordless text has no words and is clean; a null item text or one without
words has no windows; a null ``item_id`` marks words as hit but is in no list of items; item ids
that repeat count once; document rows are judged one by one, so repeated rows repeat their result;
a null ``doc_id`` is kept. Other columns of either table are ignored. No document is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import MIX, mapped, materialise, packed, publish, ranges, slices, slots_for, table

WINDOW = 13
COVERAGE = (1, 20)
#: Words of a shard, as its texts' length tells; its automaton has at most twice as many states.
SHARD_WORDS = 100_000
WORD_LENGTH = 6
#: Shards that are sent to the executors at a time.
MOST_SHARDS = 64
BATCH_BYTES = 1_000_000

#: Bytes of words: digits, ASCII letters (lower-cased) and all bytes beyond ASCII.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
_ALL = (1 << 64) - 1


def words_of(raw: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the text with A-Z lower-cased."""
    return raw.translate(_WORD_BYTES).split() if raw else []


class Builder:
    """All substrings of several word sequences, as states with suffix links."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]

    def _state(self, length: int, link: int, after: dict[int, int]) -> int:
        self.next.append(after)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _split(self, parent: int, word: int, child: int) -> int:
        """A copy of ``child`` for the strings that are only one word longer than ``parent``."""
        copy = self._state(self.length[parent] + 1, self.link[child], dict(self.next[child]))
        self.link[child] = copy
        while parent >= 0 and self.next[parent].get(word) == child:
            self.next[parent][word] = copy
            parent = self.link[parent]
        return copy

    def extend(self, last: int, word: int) -> int:
        known = self.next[last].get(word)
        if known is not None:
            exact = self.length[known] == self.length[last] + 1
            return known if exact else self._split(last, word, known)
        new = self._state(self.length[last] + 1, 0, {})
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            child = self.next[at][word]
            exact = self.length[child] == self.length[at] + 1
            self.link[new] = child if exact else self._split(at, word, child)
        return new

    def windows(self, codes: list[int], size: int) -> set[int]:
        """The states that hold the windows of that many words.

        The match is never longer than a window, so a step climbs one link at most.
        """
        out, state = set(), 0
        for i, code in enumerate(codes):
            state = self.next[state][code]
            if self.length[self.link[state]] >= size:
                state = self.link[state]
            if i + 1 >= size:
                out.add(state)
        return out


def _joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of some texts."""
    return np.cumsum([0, *map(len, texts)], dtype=np.int32), np.frombuffer(b"".join(texts), np.uint8)


def hash_words(at: np.ndarray, raw: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hashes of words, none empty, that lie between offsets: a polynomial of their bytes, mixed."""
    at = at.astype(np.int64)
    sizes = np.diff(at)
    if not len(sizes):
        return np.zeros(0, np.uint64)
    powers = np.cumprod(np.full(int(sizes.max()), MIX + 2 * seed & _ALL, np.uint64))
    terms = (raw[at[0] : at[-1]].astype(np.uint64) + np.uint64(1)) * powers[ranges(np.zeros(len(sizes), np.int64), sizes)]
    h = np.add.reduceat(terms, at[:-1] - at[0])
    h ^= h >> np.uint64(32)
    h *= np.uint64(MIX)
    return h ^ h >> np.uint64(29)


def build_automaton(items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> bytes:
    """The automaton of some items as a file of arrays.

    Words have codes in order of a hash whose seed keeps them apart. Transitions are an open table of
    (state, code). Each state has the windows that it holds, and the nearest state up its links that
    holds any.
    """
    vocab = sorted({w for _, words in items for w in words})
    seed = 0
    while len(np.unique(hashes := hash_words(*_joined(vocab), seed))) < len(vocab):
        seed += 1
    vocab = [vocab[i] for i in np.argsort(hashes).tolist()]
    code = {w: i for i, w in enumerate(vocab)}
    coded = [[code[w] for w in words] for _, words in items]
    made = Builder()
    for codes in coded:
        last = 0
        for c in codes:
            last = made.extend(last, c)
    found: dict[tuple[int, int], list[int]] = {}
    for place, codes in enumerate(coded):
        size = min(window, len(codes))
        for state in made.windows(codes, size):
            found.setdefault((state, size), []).append(place)
    order = sorted(found)
    n = len(made.next)
    first = np.searchsorted([s for s, _ in order], np.arange(n + 1)).astype(np.int32)
    near = np.zeros(n, np.int32)  # the state itself or the next one up that holds a window, 0 for none
    up = np.zeros(n, np.int32)
    for s in np.argsort(made.length, kind="stable").tolist()[1:]:
        up[s] = near[made.link[s]]
        near[s] = s if first[s + 1] > first[s] else up[s]
    keys = [s << 32 | c for s, after in enumerate(made.next) for c in after]
    bits = max(4, (2 * len(keys)).bit_length())
    slots = slots_for(np.array(keys, np.int64), bits)
    table_keys, table_to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
    table_keys[slots], table_to[slots] = keys, [t for after in made.next for t in after.values()]
    word_at, word_bytes = _joined(vocab)
    item_at, item_bytes = _joined([(i or "").encode() for i, _ in items])
    return packed(
        {"bits": bits, "seed": seed, "least": min((z for _, z in order), default=0)},
        {
            "keys": table_keys,
            "to": table_to,
            "link": np.maximum(made.link, 0).astype(np.int32),
            "length": np.array(made.length, np.int32),
            "first": first,
            "near": near,
            "up": up,
            "size": np.array([z for _, z in order], np.int32),
            "item_first": np.cumsum([0, *(len(found[k]) for k in order)], dtype=np.int32),
            "items": np.array([p for k in order for p in found[k]], np.int32),
            "hashes": np.sort(hashes),
            "word_at": word_at,
            "word_bytes": word_bytes,
            "item_at": item_at,
            "item_bytes": item_bytes,
            "item_null": np.array([i is None for i, _ in items], np.int8),
        },
    )


class Words:
    """The words of some texts: each text's places in the list of distinct words."""

    def __init__(self, raws: list[bytes | None]):
        split = [words_of(raw) for raw in raws]
        self.sizes = [len(w) for w in split]
        coded = pa.array(chain.from_iterable(split), pa.binary()).dictionary_encode()
        self.distinct = coded.dictionary
        self.index = coded.indices.to_numpy()
        self._hashes: dict[int, np.ndarray] = {}

    def hashes(self, seed: int) -> np.ndarray:
        if seed not in self._hashes:
            n = len(self.distinct)
            at, raw = (np.frombuffer(x, k) for x, k in zip(self.distinct.buffers()[1:], (np.int32, np.uint8))) if n else _joined([])
            self._hashes[seed] = hash_words(at[: n + 1], raw, seed)
        return self._hashes[seed]


class Automaton:
    """A shard's automaton, memory-mapped."""

    def __init__(self, path: str):
        head, parts = mapped(path)
        self.shift, self.mask, self.seed, self.least = 64 - head["bits"], (1 << head["bits"]) - 1, head["seed"], head["least"]
        self.parts = parts
        self.view = {n: memoryview(a) for n, a in parts.items() if len(a)}
        at, raw = parts["word_at"], parts["word_bytes"]
        self.words = pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(raw)])

    def codes(self, words: Words) -> np.ndarray:
        """The code of each word of the texts, -1 for words that no item has."""
        hashes, known = words.hashes(self.seed), self.parts["hashes"]
        code = np.full(len(hashes), -1, np.int64)
        if len(known):
            place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
            here = np.flatnonzero(known[place] == hashes)
            same = pc.equal(words.distinct.take(pa.array(here)), self.words.take(pa.array(place[here])))
            here = here[same.to_numpy(zero_copy_only=False)]
            code[here] = place[here]
        return code[words.index]

    def item(self, place: int) -> str | None:
        if self.view["item_null"][place]:
            return None
        at = self.view["item_at"]
        return self.parts["item_bytes"][at[place] : at[place + 1]].tobytes().decode()

    def scan(self, codes: np.ndarray, hits: list[tuple[int, int]], items: set[str]) -> int:
        """Add the hit word ranges [start, stop) and items of a text; the longest match of a window or more."""
        least = self.least
        if not least or len(codes) < least:
            return 0
        # a window lies within a run of known words; most runs are too short for one
        edges = np.concatenate(([-1], np.flatnonzero(codes < 0), [len(codes)]))
        view, shift, mask = self.view, self.shift, self.mask
        keys, to, link, length, first, near, up, size = (view[n] for n in ("keys", "to", "link", "length", "first", "near", "up", "size"))
        seen: set[int] = set()
        longest = 0
        for run in np.flatnonzero(np.diff(edges) > least).tolist():
            begin, end = int(edges[run]) + 1, int(edges[run + 1])
            state = matched = 0
            for i, code in enumerate(codes[begin:end].tolist(), begin):
                while True:
                    key = state << 32 | code
                    slot = (key * MIX & _ALL) >> shift
                    while (there := keys[slot]) != key and there >= 0:
                        slot = slot + 1 & mask
                    if there >= 0 or not state:
                        break
                    state = link[state]
                    matched = length[state]
                if there < 0:
                    continue
                state = to[slot]
                matched += 1
                if matched < least:
                    continue
                if matched > longest:
                    longest = matched
                holder = near[state]
                while holder:
                    for w in range(first[holder], first[holder + 1]):
                        if size[w] <= matched:
                            hits.append((i + 1 - size[w], i + 1))
                            seen.add(w)
                    holder = up[holder]
        if seen:
            of, place = view["item_first"], view["items"]
            got = {self.item(p) for p in {place[k] for w in seen for k in range(of[w], of[w + 1])}}
            items.update(got - {None})
        return longest


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching ranges as one."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


@cache
def _automaton(name: str) -> Automaton:
    """Opened once in a worker; its pages come and go as the system needs."""
    return Automaton(SparkFiles.get(name))


def compile_benchmark(benchmark: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> list[str]:
    """Names of the shards' files; ``send`` hands them to the executors.

    Items are dealt to shards by hash and built by the executors; the driver passes on one shard's
    file at a time.
    """
    spark = benchmark.sparkSession
    rows = benchmark.filter("text is not null").select(F.col("item_id").cast("string").alias("item"), "text")
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-size // (shard_words * WORD_LENGTH)))
    dealt = rows.distinct().select(
        F.pmod(F.xxhash64("text", "item"), F.lit(shards)).alias("shard"), "item", F.encode("text", "UTF-8").alias("raw")
    )

    def build(items: pa.Table) -> pa.Table:
        split = [(i, words_of(raw)) for i, raw in zip(items["item"].to_pylist(), items["raw"].to_pylist())]
        data = build_automaton([x for x in sorted(split, key=lambda x: x[0] or "") if x[1]], window)
        return pa.table({"data": pa.array([data], pa.large_binary()).cast(pa.binary())})

    built = materialise(dealt.groupBy("shard").applyInArrow(build, "data binary"), "shards")
    return [publish(spark, bytes(row["data"]), "windows") for row in built.toLocalIterator()]


@dataclass
class Found:
    """What all shards have found in a text."""

    n_words: int
    hits: list[tuple[int, int]] = field(default_factory=list)
    items: set[str] = field(default_factory=set)
    longest: int = 0

    @property
    def n_hit(self) -> int:
        return sum(b - a for a, b in self.hits)


#: What passes from one group of shards to the next.
_SPAN = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])
_FOUND = T.StructType(
    [
        T.StructField("hits", T.ArrayType(_SPAN)),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField("longest", T.IntegerType()),
    ]
)


def find_in(raws: list[bytes | None], names: list[str], before: list[dict] | None = None) -> list[Found]:
    """What the shards find in the texts, added to what others have found before."""
    words = Words(raws)
    found = [Found(n) for n in words.sizes]
    for f, b in zip(found, before or ()):
        f.hits, f.items, f.longest = [(h["start"], h["stop"]) for h in b["hits"]], set(b["items"]), b["longest"]
    ends = np.cumsum([0, *words.sizes]).tolist()
    for name in names:
        automaton = _automaton(name)
        codes = automaton.codes(words)
        for i, f in enumerate(found):
            f.longest = max(f.longest, automaton.scan(codes[ends[i] : ends[i + 1]], f.hits, f.items))
    for f in found:
        f.hits = merged(f.hits)
    return found


def _scanned(docs: DataFrame, names: list[str], finish, schema, most_shards: int) -> DataFrame:
    """The batches that ``finish(rows, texts, found)`` makes once all shards have been met."""
    at, width = docs.columns.index("text"), len(docs.columns)
    extra = "_found" + "_" * max(map(len, docs.columns))
    between = T.StructType([*docs.schema.fields, T.StructField(extra, _FOUND)])
    columns = between.names
    groups = [names[i : i + most_shards] for i in range(0, len(names), most_shards)] or [[]]

    def scan(group: list[str], first: bool, last: bool):
        def run(batches):
            for batch in batches:
                texts = batch.column(at).cast(pa.binary())
                for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_BYTES):
                    part = batch.slice(start, stop - start)
                    raws = texts.slice(start, stop - start).to_pylist()
                    found = find_in(raws, group, None if first else part.column(width).to_pylist())
                    rows = part.columns[:width]
                    if last:
                        yield finish(pa.RecordBatch.from_arrays(rows, schema=pa.schema(list(part.schema)[:width])), raws, found)
                    else:
                        state = [
                            {"hits": [{"start": a, "stop": b} for a, b in f.hits], "items": sorted(f.items), "longest": f.longest}
                            for f in found
                        ]
                        yield pa.RecordBatch.from_arrays([*rows, pa.array(state, kind)], names=columns)

        return run

    kind = pa.struct(
        [("hits", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("items", pa.list_(pa.string())), ("longest", pa.int32())]
    )
    frame = docs
    for k, group in enumerate(groups):
        if k + 1 < len(groups):
            frame = materialise(frame.mapInArrow(scan(group, k == 0, False), between), "scanned")
    return frame.mapInArrow(scan(groups[-1], len(groups) == 1, True), schema)


def _char_spans(raw: bytes, spans: list[tuple[int, int]]) -> list[dict]:
    """Word ranges as code point ranges of the text."""
    flat = np.frombuffer(raw.translate(_WORD_BYTES), np.uint8) != 32
    edge = np.diff(np.concatenate(([0], flat, [0])).astype(np.int8))
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    points = np.concatenate(([0], np.cumsum(np.frombuffer(raw, np.uint8) & 0xC0 != 0x80)))
    return [{"start": int(points[starts[a]]), "stop": int(points[stops[b - 1]])} for a, b in spans]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: tuple[int, int] = COVERAGE,
    shard_words: int = SHARD_WORDS,
    most_shards: int = MOST_SHARDS,
) -> DataFrame:
    """doc_id, n_words, n_hit, longest, items, spans (code points, stop excluded), contaminated.

    ``longest`` is the longest match in words, 0 where none is as long as the shortest window.
    """
    names = compile_benchmark(benchmark, window, shard_words)
    part, whole = coverage
    kind = docs.schema["doc_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def judged(rows, raws, found):
        return pa.RecordBatch.from_arrays(
            [
                rows.column(0),
                pa.array([f.n_words for f in found], pa.int64()),
                pa.array([f.n_hit for f in found], pa.int64()),
                pa.array([f.longest for f in found], pa.int64()),
                pa.array([sorted(f.items) for f in found], pa.list_(pa.string())),
                pa.array([_char_spans(r, f.hits) if f.hits else [] for r, f in zip(raws, found)], span),
                pa.array([f.n_hit > 0 and whole * f.n_hit >= part * f.n_words for f in found], pa.bool_()),
            ],
            names=["doc_id", "n_words", "n_hit", "longest", "items", "spans", "contaminated"],
        )

    return _scanned(
        docs.select("doc_id", "text"),
        names,
        judged,
        f"doc_id {kind}, n_words long, n_hit long, longest long, items array<string>, "
        "spans array<struct<start:long,stop:long>>, contaminated boolean",
        most_shards,
    )


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    coverage: tuple[int, int] = COVERAGE,
    span_words: int | None = None,
    shard_words: int = SHARD_WORDS,
    most_shards: int = MOST_SHARDS,
) -> DataFrame:
    """The documents, in their own columns, without what the benchmark covers.

    Documents over the coverage limit go. Of the others, hit spans of ``span_words`` words or more
    are cut out of the text; None cuts nothing, so clean documents stay as they are.
    """
    names = compile_benchmark(benchmark, window, shard_words)
    part, whole = coverage
    at = docs.columns.index("text")

    def kept(rows, raws, found):
        stay, changed = [], False
        for i, (raw, f) in enumerate(zip(raws, found)):
            if f.n_hit and whole * f.n_hit >= part * f.n_words:
                continue
            stay.append(i)
            cut = [x for x in f.hits if span_words is not None and x[1] - x[0] >= span_words]
            if cut:
                text = raw.decode()
                for c in reversed(_char_spans(raw, cut)):
                    text = text[: c["start"]] + text[c["stop"] :]
                raws[i], changed = text.encode(), True
        if changed:
            texts = pa.array(raws, pa.binary()).cast(rows.schema.field(at).type)
            rows = rows.set_column(at, rows.schema.field(at), texts)
        return rows.take(pa.array(stay, pa.int64()))

    return _scanned(docs, names, kept, docs.schema, most_shards)


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        "contaminated",
    )


QUERIES = {"op1_decontamination": op1_decontamination}

ORACLE_SQL = {
    "op1_decontamination": r"""
with d as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
), b as (
    select item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from benchmark
), wide as (
    select item_id, w, least(13, len(w)) as size from b where len(w) > 0
), windows as (
    select distinct item_id, size, array_to_string(w[i : i + size - 1], ' ') as gram
    from (select item_id, w, size, unnest(range(1, len(w) - size + 2)) as i from wide)
), grams as (
    select doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') as gram
    from (
        select doc_id, w, size, unnest(range(1, len(w) - size + 2)) as i
        from d, (select distinct size from wide) where len(w) >= size
    )
), found as (
    select doc_id, i, size, item_id from grams join windows using (size, gram)
), hit as (
    select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(i, i + size)) as p from (select distinct doc_id, i, size from found))
    group by doc_id
), items as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as listed
    from (select distinct doc_id, cast(item_id as varchar) as item from found) group by doc_id
)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(listed, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join hit using (doc_id) left join items using (doc_id)
"""
}
