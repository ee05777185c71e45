"""BPE encoding with a minimal acyclic transducer of frequent words, and decoding.

Words are counted over all documents. The most frequent ones (at most ``lexicon_words``) and their
token ids are compiled on the driver into an acyclic automaton whose equal suffixes are shared; its
arcs carry numbers that add up to a word's place, which names its ids. Workers memory-map the file
and walk all distinct words of a batch through it at once. Words that it does not hold are merged
exactly, so the lexicon's size changes speed and never a result.

The vocabulary file describes a word BPE: NFC, lower case, a pattern of words, bytes as characters,
a suffix on the last one. Special tokens in a text are their own ids, as the file says.

Defined cases: a null text is empty and has no ids; a null ``token_ids`` decodes to the empty text;
ids outside the vocabulary are skipped in decoding; documents are coded row by row, so ties and
repeated rows repeat. Other columns are ignored. No row is shuffled but (word, count).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections import Counter
from functools import cache, lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import mapped, materialised, packed, publish, ranges, remove_path, slices, slot_of, slots_for, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
LEXICON_WORDS = 200_000
#: Longer words (in bytes) are left to the merges.
WORD_BYTES = 48
BATCH_CHARS = 1_000_000
BATCH_IDS = 1_000_000
#: Distinct words a worker counts before it passes the counts on.
COUNTED = 200_000
#: Merged words that a worker remembers.
REMEMBERED = 100_000

#: Contractions of the vocabulary's word pattern (fixed values), without their apostrophe.
_CONTRACTIONS = "s|t|re|ve|m|ll|d"
#: Classes of code points beyond the basic plane make a pattern slow; few texts need them.
_BASIC = 0xFFFF


def _char_class(test, top: int) -> str:
    """Code points up to ``top`` that pass the test, as the inside of a character class."""
    out, start = [], None
    for cp in range(top + 2):
        ok = cp <= top and test(chr(cp))
        if ok and start is None:
            start = cp
        elif not ok and start is not None:
            out.append(f"\\U{start:08x}-\\U{cp - 1:08x}")
            start = None
    return "".join(out)


@cache
def _patterns(top: int) -> tuple[re.Pattern, re.Pattern]:
    """Words of a text with code points up to ``top``; code points that Python doesn't know."""
    kind = unicodedata.category
    letter = _char_class(lambda c: kind(c)[0] == "L", top)
    number = _char_class(lambda c: kind(c)[0] == "N", top)
    blank = _char_class(lambda c: c.isspace() and not "\x1c" <= c <= "\x1f", top)
    return (
        re.compile(rf"[{letter}]+|'(?:{_CONTRACTIONS})|[{number}]|[^{blank}{letter}{number}]+"),
        re.compile(f"[{_char_class(lambda c: kind(c) == 'Cn', top)}]"),
    )


_ascii_words = re.compile(rf"[a-z]+|'(?:{_CONTRACTIONS})|[0-9]|[^\x09-\x0d a-z0-9]+")


class WordBpe:
    """A vocabulary file: words of a text, exact merges of a word, tokens of ids."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab = model["vocab"]
        suffix = self.suffix = model["end_of_word_suffix"]
        self.path = path
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self._special = re.compile("|".join(f"({re.escape(t)})" for t in self.special)) if self.special else None
        tokens = [""] * (1 + max(chain(vocab.values(), self.special.values())))
        for token, i in chain(vocab.items(), self.special.items()):
            tokens[i] = token
        self.tokens = pa.array(tokens, pa.string())
        char = _byte_chars()
        self.inner = [vocab[c] for c in char]
        self.final = [vocab[c + suffix] for c in char]
        #: a pair of ids -> its rank and, in the low 32 bits, the id that it merges to
        self.merges: dict[int, int] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.merges[vocab[a] << 32 | vocab[b]] = rank << 32 | vocab[a + b]

    def words(self, text: str) -> list[str]:
        if self._special is not None and "<" in text and self._special.search(text):
            out: list[str] = []
            at = 0
            for m in self._special.finditer(text):
                out += self._words(text[at : m.start()])
                out.append(m[0])
                at = m.end()
            return out + self._words(text[at:])
        return self._words(text)

    def _words(self, text: str) -> list[str]:
        if text.isascii():
            return _ascii_words.findall(text.lower())
        # the tokenizers library lower-cases each character by itself: no final sigma
        lower = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        # NFC may lead beyond the basic plane, so the pattern is chosen by what it gives
        basic = len(lower.encode("utf-16-le", "surrogatepass")) == 2 * len(lower)
        words, unknown = _patterns(_BASIC if basic else sys.maxunicode)
        return _library_words(self.path, text) if unknown.search(lower) else words.findall(lower)

    def merge(self, word: bytes) -> list[int]:
        """Token ids of one word: the pair of least rank merges first, the leftmost of equals."""
        ids = [self.inner[b] for b in word[:-1]]
        ids.append(self.final[word[-1]])
        # one result; long words by a heap, as their pairs would be searched too often
        return self._merge_long(ids) if len(ids) > 200 else self._merge_short(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        get, none = self.merges.get, 1 << 62
        pairs = [get(a << 32 | b, none) for a, b in zip(ids, ids[1:])]
        while pairs:
            least = min(pairs)
            if least == none:
                break
            i = pairs.index(least)
            ids[i] = least & 0xFFFFFFFF
            del ids[i + 1]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(ids[i] << 32 | ids[i + 1], none)
            if i:
                pairs[i - 1] = get(ids[i - 1] << 32 | ids[i], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        n, get = len(ids), self.merges.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (m := get(ids[i] << 32 | ids[j])) is not None:
                heapq.heappush(heap, (m >> 32, i, ids[i], ids[j], m & 0xFFFFFFFF))

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [x for x in ids if x >= 0]


@cache
def _library(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _library_words(path: str, text: str) -> list[str]:
    """Words where a code point is newer than Python's tables: by the library's own."""
    whole, place = _library(path), {c: i for i, c in enumerate(_byte_chars())}
    got = whole.pre_tokenizer.pre_tokenize_str(whole.normalizer.normalize_str(text))
    return [bytes(place[c] for c in word).decode(errors="surrogateescape") for word, _ in got]


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself, or the next from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@cache
def _bpe(path: str) -> WordBpe:
    return WordBpe(path)


# -- the transducer ----------------------------------------------------------------------------


def compile_lexicon(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """A file with the minimal automaton of the words and each word's ids.

    Words come sorted. Only the last word's path is open; what no later word can change is replaced
    by an equal state where there is one. A state is (final, arcs); its number of words gives the
    additive outputs of the arcs into later siblings.
    """
    known: dict[tuple, int] = {}
    arcs_of: list[tuple[bool, tuple[tuple[int, int], ...]]] = []
    size_of: list[int] = []

    def close(final: bool, arcs: list[tuple[int, int]]) -> int:
        key = (final, tuple(arcs))
        state = known.get(key)
        if state is None:
            state = known[key] = len(arcs_of)
            arcs_of.append(key)
            size_of.append(final + sum(size_of[t] for _, t in arcs))
        return state

    # the open path: [byte that leads here, final, closed arcs]
    path: list[list] = [[0, False, []]]
    last = b""
    for word, _ in entries:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        while len(path) > common + 1:
            byte, final, arcs = path.pop()
            path[-1][2].append((byte, close(final, arcs)))
        for byte in word[common:]:
            path.append([byte, False, []])
        path[-1][1] = True
        last = word
    while len(path) > 1:
        byte, final, arcs = path.pop()
        path[-1][2].append((byte, close(final, arcs)))
    root = close(path[0][1], path[0][2])

    keys, targets, adds = [], [], []
    for state, (final, arcs) in enumerate(arcs_of):
        add = int(final)
        for byte, target in arcs:
            keys.append(state << 8 | byte)
            targets.append(target)
            adds.append(add)
            add += size_of[target]
    bits = max(4, (2 * len(keys)).bit_length())
    slots = slots_for(np.array(keys, np.int64), bits)
    table_keys = np.full(1 << bits, -1, np.int64)
    table_to = np.zeros(1 << bits, np.int32)
    table_add = np.zeros(1 << bits, np.int32)
    table_keys[slots], table_to[slots], table_add[slots] = keys, targets, adds
    ends = np.cumsum([len(ids) for _, ids in entries], dtype=np.int64)
    parts = {
        "keys": table_keys,
        "to": table_to,
        "add": table_add,
        "final": np.array([f for f, _ in arcs_of], np.int8),
        "starts": np.concatenate(([0], ends)).astype(np.int64),
        "ids": np.array([i for _, ids in entries for i in ids], np.int32),
    }
    return packed({"root": root, "bits": bits}, parts)


class Lexicon:
    """A compiled lexicon, memory-mapped."""

    def __init__(self, path: str):
        head, parts = mapped(path)
        self.root, self.bits = head["root"], head["bits"]
        for name, part in parts.items():
            setattr(self, name, part)

    def find(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Places of words (bytes of ``data`` between offsets), -1 for words it doesn't hold."""
        n, mask = len(offsets) - 1, (1 << self.bits) - 1
        sizes = np.diff(offsets)
        state = np.full(n, self.root, np.int64)
        place = np.zeros(n, np.int64)
        live = np.flatnonzero((sizes > 0) & (sizes <= WORD_BYTES))
        dead = np.ones(n, bool)
        dead[live] = False
        step = 0
        while len(live):
            key = state[live] << 8 | data[offsets[live] + step]
            slot = slot_of(key, self.bits)
            there = self.keys[slot]
            miss = np.flatnonzero((there != key) & (there >= 0))
            while len(miss):
                slot[miss] = (slot[miss] + 1) & mask
                there[miss] = self.keys[slot[miss]]
                miss = miss[(there[miss] != key[miss]) & (there[miss] >= 0)]
            ok = there == key
            dead[live[~ok]] = True
            live, slot = live[ok], slot[ok]
            state[live] = self.to[slot]
            place[live] += self.add[slot]
            step += 1
            live = live[sizes[live] > step]
        return np.where(dead | (self.final[state] == 0), -1, place)


@lru_cache(2)
def _lexicon(name: str) -> Lexicon:
    return Lexicon(SparkFiles.get(name))


# -- over documents ----------------------------------------------------------------------------


def word_counts(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """word, n: over all documents, without special tokens. Counted before anything is shuffled."""

    def count(batches):
        bpe, counts = _bpe(vocabulary), Counter()

        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                text = text.as_py()
                if not text:
                    continue
                words = bpe.words(text)
                for at in range(0, len(words), COUNTED):
                    counts.update(words[at : at + COUNTED])
                    if len(counts) >= COUNTED:
                        yield out()
                        counts = Counter()
        if counts:
            yield out()

    special = [*_bpe(vocabulary).special]
    counted = docs.select("text").mapInArrow(count, "word string, n long").filter(~F.col("word").isin(special))
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocabulary: str = VOCABULARY, lexicon_words: int = LEXICON_WORDS) -> str:
    """Compile the frequent words of the documents; the name of the file that executors get.

    The least count that keeps at most ``lexicon_words`` words is found from a histogram of counts
    (eighths of powers of two), so the driver never gets more words than that.
    """
    fits = (F.octet_length("word") <= WORD_BYTES) & (F.col("n") > 1)
    counts, path = materialised(word_counts(docs, vocabulary).filter(fits), "words")
    level = F.floor(F.log2("n") * 8).cast("int")
    rows = counts.groupBy(level.alias("level")).count().collect()
    total, least = 0, None
    for row in sorted(rows, reverse=True):
        total += row["count"]
        if total > lexicon_words:
            break
        least = row["level"]
    words = [] if least is None else counts.filter(level >= least).select("word").toArrow().column(0).to_pylist()
    remove_path(docs.sparkSession, path)
    bpe = _bpe(vocabulary)
    coded = sorted(w.encode() for w in words)
    return publish(docs.sparkSession, compile_lexicon([(w, bpe.merge(w)) for w in coded]), "lexicon")


def _encode_words(words: list[str], bpe: WordBpe, lexicon: Lexicon, memory: dict) -> tuple[np.ndarray, np.ndarray]:
    """Flat ids of the words and each word's number of ids."""
    if not words:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    try:
        column = pa.array(words, pa.string())
    except (UnicodeEncodeError, pa.ArrowInvalid):
        column = pa.array([w.encode(errors="surrogateescape") for w in words], pa.binary())
    coded = column.dictionary_encode()
    distinct = coded.dictionary
    n = len(distinct)
    offsets = np.frombuffer(distinct.buffers()[1], np.int32)[: n + 1].astype(np.int64)
    data = np.frombuffer(distinct.buffers()[2], np.uint8)
    place = lexicon.find(data, offsets)
    held = np.flatnonzero(place >= 0)
    size = np.zeros(n, np.int64)
    size[held] = lexicon.starts[place[held] + 1] - lexicon.starts[place[held]]
    fresh = np.flatnonzero(place < 0)
    merged = []
    raw = data.tobytes()
    for i in fresh.tolist():
        word = raw[offsets[i] : offsets[i + 1]]
        ids = memory.get(word)
        if ids is None:
            special = bpe.special.get(word.decode(errors="replace"))
            ids = memory[word] = np.array([special] if special is not None else bpe.merge(word), np.int32)
            if len(memory) > REMEMBERED:
                memory.clear()
        merged.append(ids)
        size[i] = len(ids)
    # a pool with the ids of each distinct word: those of the lexicon, then the merged ones
    pool_held = lexicon.ids[ranges(lexicon.starts[place[held]], size[held])]
    pool = np.concatenate([pool_held, *merged]) if merged else pool_held
    start = np.zeros(n, np.int64)
    start[held] = np.cumsum(size[held]) - size[held]
    start[fresh] = len(pool_held) + np.cumsum(size[fresh]) - size[fresh]
    index = coded.indices.to_numpy()
    return pool[ranges(start[index], size[index])], size[index]


def _encoded(texts: pa.Array, bpe: WordBpe, lexicon: Lexicon, memory: dict) -> pa.ListArray:
    """Lists of the ids of the texts."""
    words, counts = [], []
    for text in texts.to_pylist():
        got = bpe.words(text) if text else []
        words += got
        counts.append(len(got))
    ids, sizes = _encode_words(words, bpe, lexicon, memory)
    ends = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))


def _decoded(lists: pa.ListArray, tokens: pa.StringArray) -> pa.StringArray:
    """The tokens of the ids of each list, joined by spaces; a null list is empty."""
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
    ids = lists.flatten().to_numpy(zero_copy_only=False)
    good = (ids >= 0) & (ids < len(tokens))
    ends = np.concatenate(([0], np.cumsum(good)))[np.concatenate(([0], np.cumsum(sizes)))]
    named = tokens.take(pa.array(ids[good]))
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), named), " ")


def encode(docs: DataFrame, vocabulary: str = VOCABULARY, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, token_ids array<int>."""
    return _coded(docs, vocabulary, lexicon_words, [], "")


def decode(coded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, token_ids, text: the tokens of all ids, special ones too, joined by spaces."""
    kind = coded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        tokens = _bpe(vocabulary).tokens
        for batch in batches:
            lists = batch.column(1)
            for start, stop in slices(pc.list_value_length(lists).to_pylist(), BATCH_IDS):
                part = lists.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), part, _decoded(part, tokens)],
                    names=["doc_id", "token_ids", "text"],
                )

    return coded.select("doc_id", "token_ids").mapInArrow(run, f"doc_id {kind}, token_ids array<int>, text string")


def _coded(docs: DataFrame, vocabulary: str, lexicon_words: int, more: list, schema: str) -> DataFrame:
    """doc_id, token_ids and what the functions in ``more`` make of the lists, in the same pass."""
    name = build_lexicon(docs, vocabulary, lexicon_words)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        bpe, lexicon, memory = _bpe(vocabulary), _lexicon(name), {}
        for batch in batches:
            texts = batch.column(1)
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_CHARS):
                lists = _encoded(texts.slice(start, stop - start), bpe, lexicon, memory)
                columns = [batch.column(0).slice(start, stop - start), lists, *(f(lists, bpe) for f in more)]
                yield pa.RecordBatch.from_arrays(columns, names=[f"c{i}" for i in range(len(columns))])

    made = docs.select("doc_id", "text").mapInArrow(run, f"c0 {kind}, c1 array<int>{schema}")
    return made.withColumnsRenamed({"c0": "doc_id", "c1": "token_ids"})


def _sha256(texts: pa.StringArray) -> pa.Array:
    return pa.array([hashlib.sha256(t).hexdigest() for t in texts.cast(pa.binary()).to_pylist()], pa.string())


def _ids_sha256(lists: pa.ListArray, bpe: WordBpe) -> pa.Array:
    text = pa.ListArray.from_arrays(lists.offsets, lists.values.cast(pa.string()))
    return _sha256(pc.binary_join(text, " "))


def encode_with_digests(docs: DataFrame, vocabulary: str = VOCABULARY, lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """doc_id, token_ids, n_tokens, ids_sha256 (of the ids joined by spaces), decoded_sha256.

    A batch's ids are decoded in the worker that has made them, as ``decode`` does.
    """
    more = [_ids_sha256, lambda lists, bpe: _sha256(_decoded(lists, bpe.tokens))]
    coded = _coded(docs, vocabulary, lexicon_words, more, ", c2 string, c3 string")
    return coded.select(
        "doc_id",
        "token_ids",
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.col("c2").alias("ids_sha256"),
        F.col("c3").alias("decoded_sha256"),
    )


def op5_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_with_digests(table(spark, sf_dir, "documents")).drop("token_ids")


QUERIES = {"op5_transducer_bpe": op5_transducer_bpe}

ORACLE_SQL: dict[str, str] = {}
