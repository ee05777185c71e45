"""Language identification by rank-order profiles.

A profile is the ``top`` most frequent character n-grams (one to three letters, words padded by a
space) of a language, in order, counted over all documents that may be learnt from. A document's own
most frequent n-grams are compared to each profile by the out-of-place distance: the sum over its
n-grams of how far their ranks lie apart, or ``top`` where the profile lacks the n-gram.

Defined cases: a null text or one without a letter is ``und`` with score 0, as is everything where no
language could be learnt; a null lang is never learnt; equal counts rank by the n-gram's code points
and equal distances by the language's name; a null doc_id counts as held out; repeated rows repeat.
Other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import held_out, mapped, packed, publish, ranges, slices, table

TOP = 400
BATCH_CHARS = 1_000_000
#: Distinct n-grams a worker counts before it passes the counts on.
COUNTED = 1_000_000
UNKNOWN = "und"
_BITS = 21
_SPACE = 32


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


def ngrams(text: str | None) -> np.ndarray:
    """The n-grams of a text as numbers (21 bits a code point), repeats included.

    What is not a letter is a space; spaces at word ends belong to n-grams, but none is only a space
    or holds one inside. Empty where the text has no letter.
    """
    if not text:
        return np.zeros(0, np.int64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    ok = _letters()[points]
    if not ok.any():
        return np.zeros(0, np.int64)
    points = np.where(ok, points, _SPACE)
    keep = ok.copy()
    keep[1:] |= ok[:-1]  # one space after each word
    points, ok = points[keep], ok[keep]
    points = np.concatenate(([_SPACE], points, [_SPACE]))
    ok = np.concatenate(([False], ok, [False]))
    one = points[ok]
    two = (points[:-1] | points[1:] << _BITS)[ok[:-1] | ok[1:]]
    three = (points[:-2] | points[1:-1] << _BITS | points[2:] << 2 * _BITS)[ok[1:-1]]
    return np.concatenate((one, two, three))


def pieces(text: str | None) -> Iterator[str]:
    """A long text in parts that end at a space, so that no n-gram is cut and memory is bounded."""
    at, n = 0, len(text or "")
    while n - at > BATCH_CHARS and (space := text.find(" ", at + BATCH_CHARS)) >= 0:
        yield text[at:space]
        at = space
    if n > at:
        yield text[at:]


def ranked(text: str | None, top: int = TOP) -> np.ndarray:
    """The most frequent n-grams of a text, in order."""
    grams, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for i, piece in enumerate(pieces(text)):
        g, c = _counted([ngrams(piece)])
        grams, counts = (g, c) if i == 0 else _counted([grams, g], [counts, c])
    return grams[np.lexsort((grams, -counts))[:top]]


def _counted(parts: list[np.ndarray], weights: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers and their counts."""
    flat = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    if weights is None:
        flat.sort()
        edges = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1]))) if len(flat) else np.zeros(0, int)
        return flat[edges], np.diff(np.concatenate((edges, [len(flat)])))
    grams, place = np.unique(flat, return_inverse=True)
    return grams, np.bincount(place, np.concatenate(weights), len(grams)).astype(np.int64) if parts else place


def learn_profiles(docs: DataFrame, top: int = TOP) -> dict[str, np.ndarray]:
    """Language -> its n-grams in order of frequency, from the text and lang of all the documents."""

    def count(batches):
        held: dict[str, list] = {}
        size = 0

        def out():
            names, grams, counts = [], [], []
            for lang, (g, c) in held.items():
                g, c = _counted(g, c)
                names.append(pa.array([lang] * len(g), pa.string()))
                grams.append(g)
                counts.append(c)
            return pa.RecordBatch.from_arrays(
                [pa.concat_arrays(names), pa.array(np.concatenate(grams)), pa.array(np.concatenate(counts))],
                names=["lang", "gram", "n"],
            )

        for batch in batches:
            langs = batch.column(1).to_pylist()
            texts = batch.column(0)
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_CHARS):
                mine: dict[str, list[np.ndarray]] = {}
                for lang, text in zip(langs[start:stop], texts.slice(start, stop - start).to_pylist()):
                    mine.setdefault(lang, []).append(ngrams(text))
                for lang, parts in mine.items():
                    g, c = _counted(parts)
                    both = held.setdefault(lang, ([], []))
                    both[0].append(g)
                    both[1].append(c)
                    size += len(g)
                if size > COUNTED:
                    for lang, (g, c) in held.items():
                        g, c = _counted(g, c)
                        held[lang] = ([g], [c])
                    size = sum(len(g[0]) for g, _ in held.values())
                    if size > COUNTED // 2:
                        yield out()
                        held, size = {}, 0
        if held:
            yield out()

    rows = docs.select("text", "lang").filter("text is not null and lang is not null")
    counts = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    best = counts.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    found: dict[str, list[tuple[int, int]]] = {}
    for lang, gram, rank in best.select("lang", "gram", "rank").toLocalIterator():
        found.setdefault(lang, []).append((rank, gram))
    return {k: np.array([g for _, g in sorted(v)], np.int64) for k, v in sorted(found.items())}


class Profiles:
    """The profiles turned about: for each n-gram the languages that have it and its rank there.

    A language takes at most ``top`` entries, 5 KB, in a file that workers memory-map.
    """

    def __init__(self, head: dict, parts: dict[str, np.ndarray]):
        self.names, self.top = head["names"], head["top"]
        self.grams, self.first, self.lang, self.rank = (parts[n] for n in ("grams", "first", "lang", "rank"))

    @staticmethod
    def compiled(profiles: dict[str, np.ndarray], top: int = TOP) -> bytes:
        names = sorted(profiles)
        sizes = [len(profiles[n]) for n in names]
        flat = np.concatenate([*(profiles[n] for n in names), np.zeros(0, np.int64)])
        lang = np.repeat(np.arange(len(names)), sizes)
        order = np.lexsort((lang, flat))
        grams, first = np.unique(flat[order], return_index=True)
        return packed(
            {"names": names, "top": top},
            {
                "grams": grams,
                "first": np.append(first, len(flat)).astype(np.int64),
                "lang": lang[order].astype(np.int32),
                "rank": ranges(np.zeros(len(sizes), np.int64), np.array(sizes, np.int64))[order].astype(np.int32),
            },
        )

    @staticmethod
    @cache
    def opened(name: str) -> Profiles:
        return Profiles(*mapped(SparkFiles.get(name)))

    def judge(self, text: str | None) -> tuple[str, float]:
        """The language at the least distance; the score is its lead: 1 - least / next least."""
        mine = ranked(text, self.top)
        if not len(mine) or not self.names:
            return UNKNOWN, 0.0
        at = np.minimum(np.searchsorted(self.grams, mine), max(len(self.grams) - 1, 0))
        mine_at = np.flatnonzero(self.grams[at] == mine) if len(self.grams) else np.zeros(0, np.int64)
        at = at[mine_at]
        size = self.first[at + 1] - self.first[at]
        entry = ranges(self.first[at], size)
        # every n-gram is ``top`` out of place but where a profile has it
        nearer = self.top - np.abs(self.rank[entry] - np.repeat(mine_at, size))
        total = self.top * len(mine) - np.bincount(self.lang[entry], nearer, len(self.names)).astype(np.int64)
        best = int(np.argmin(total))
        others = np.delete(total, best)
        least = int(others.min()) if len(others) else self.top * len(mine)
        return self.names[best], float(np.clip(1 - total[best] / least, 0, 1)) if least else 0.0


def identify(docs: DataFrame, profiles: dict[str, np.ndarray], top: int = TOP) -> DataFrame:
    """doc_id, lang_pred, score from the text alone."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    name = publish(docs.sparkSession, Profiles.compiled(profiles, top), "profiles")

    def run(batches):
        model = Profiles.opened(name)
        for batch in batches:
            texts = batch.column(1)
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_CHARS):
                got = [model.judge(t) for t in texts.slice(start, stop - start).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(start, stop - start),
                        pa.array([g[0] for g in got], pa.string()),
                        pa.array([g[1] for g in got], pa.float64()),
                    ],
                    names=["doc_id", "lang_pred", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = learn_profiles(docs.filter(~held_out()))
    return identify(docs, profiles).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


QUERIES = {"op6_language_id": op6_language_id}

ORACLE_SQL: dict[str, str] = {}
