"""URL filters: a bit-parallel wildcard automaton.

Glob rules over the canonical URL (host, a separator, path) are packed into words of 64 bits, one
bit for each state of each pattern. All patterns run at once over all URLs of a batch, one code point
at a time: ``D = ((D << 1) & accepts[c]) | (D & stays[c])``, where ``accepts`` has the states that a
code point leads into and ``stays`` those of a wildcard that it may be part of.

A rule (verdict, host, path) becomes two globs, ``host|path*`` and ``*.host|path*``; ``*`` before
the separator takes no separator. ``*`` and ``?`` (no slash) in a rule are wildcards too. Of the rules that fit
a URL the longest wins (by host and path together, then by host, then the first given). Memory is
bounded by the batch and the rules: a URL more when it fits, one at least.

Defined cases: a null URL or one without ``://`` has an empty host and path and fits no rule; repeated
rows repeat; a null page_id is kept. Other columns are ignored. No row is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, LOWER, slices, table

#: Parts host and path in a canonical URL; no URL's host can hold it, as it ends at a slash.
SEPARATOR = "/"
#: Code points and words of states that are in memory for a batch.
BATCH_CELLS = 4_000_000
DEFAULT = "allow"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def parse_rule(text: str) -> Rule:
    """``block example.com/en/`` -> its parts."""
    verdict, _, where = text.strip().partition(" ")
    at = where.index("/")
    return Rule(verdict, where[:at], where[at:])


#: The rules of the registered query (fixed values).
RULES = (
    "allow com/",
    "block example.com/en/",
    "allow www.example.com/en/",
    "block net/es/",
    "block net/fr/",
)


class GlobAutomaton:
    """Bit masks of several globs; a glob is a list of items: a code point, ANY, or a star."""

    ANY, STAR_HOST, STAR = -1, -2, -3

    def __init__(self, globs: list[list[int]]):
        states, finals = [], []
        for glob in globs:
            states.append(("start", None))
            for item in glob:
                if item in (self.STAR, self.STAR_HOST):
                    states[-1] = (*states[-1][:2], item)
                else:
                    states.append(("on", item))
            finals.append(len(states) - 1)
        points = sorted({s[1] for s in states if s[0] == "on" and s[1] >= 0} | {ord(SEPARATOR)})
        self.points = np.array(points, np.int64)  # classes of code points; the last class is all others
        self.words = -(-len(states) // 64) if states else 1
        n = len(points) + 1
        self.accepts = np.zeros((n, self.words), np.uint64)
        self.stays = np.zeros((n, self.words), np.uint64)
        self.start = np.zeros(self.words, np.uint64)
        self.finals = finals
        slash = points.index(ord(SEPARATOR))
        for i, state in enumerate(states):
            w, bit = i // 64, np.uint64(1) << np.uint64(i % 64)
            if state[0] == "start":
                self.start[w] |= bit
            elif state[1] == self.ANY:
                self.accepts[:, w] |= bit
                self.accepts[slash, w] &= ~bit
            else:
                self.accepts[points.index(state[1]), w] |= bit
            if len(state) == 3:
                self.stays[:, w] |= bit
                if state[2] == self.STAR_HOST:
                    self.stays[slash, w] &= ~bit

    def run(self, texts: list[str]) -> np.ndarray:
        """Which glob fits which whole text."""
        fits = np.zeros((len(texts), len(self.finals)), bool)
        order = np.argsort([len(t) for t in texts], kind="stable")
        sizes = [len(texts[i]) for i in order]
        start = 0
        while start < len(order):  # texts of like length together, so that padding stays small
            stop = start + 1
            # a URL takes its padded code points and a few copies of the states
            while stop < len(order) and (stop + 1 - start) * (sizes[stop] + 1 + 8 * self.words) <= BATCH_CELLS:
                stop += 1
            chosen = order[start:stop]
            fits[chosen] = self._run([texts[i] for i in chosen], sizes[start:stop])
            start = stop
        return fits

    def _run(self, texts: list[str], sizes: list[int]) -> np.ndarray:
        widest = sizes[-1]
        points = np.frombuffer(
            "".join(t.ljust(widest, SEPARATOR) for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32
        ).reshape(len(texts), widest)
        at = np.searchsorted(self.points, points)
        other = len(self.points)
        at = np.where(self.points[np.minimum(at, other - 1)] == points, at, other)
        state = np.tile(self.start, (len(texts), 1))
        one, top = np.uint64(1), np.uint64(63)
        alive = 0  # texts are sorted by length: those before are done
        for t in range(widest):
            alive = int(np.searchsorted(sizes, t, side="right"))
            d, c = state[alive:], at[alive:, t]
            moved = d << one
            moved[:, 1:] |= d[:, :-1] >> top
            state[alive:] = (moved & self.accepts[c]) | (d & self.stays[c])
        bits = np.array(self.finals, np.int64)
        return (state[:, bits // 64] >> (bits % 64).astype(np.uint64) & one).astype(bool)


class RuleSet:
    """Rules, compiled; ``verdicts`` gives each URL its winning rule's place or -1."""

    def __init__(self, rules: list[Rule]):
        self.rules = sorted(rules, key=lambda r: (-len(r.name), -len(r.host)))
        globs = []
        for rule in self.rules:
            for lead in ([], [GlobAutomaton.STAR_HOST, ord(".")]):
                globs.append(lead + self._items(rule.host, True) + [ord(SEPARATOR)] + self._items(rule.path, False) + [GlobAutomaton.STAR])
        self.automaton = GlobAutomaton(globs)

    @staticmethod
    def _items(text: str, host: bool) -> list[int]:
        star = GlobAutomaton.STAR_HOST if host else GlobAutomaton.STAR
        return [star if c == "*" else GlobAutomaton.ANY if c == "?" else ord(c) for c in text]

    def winners(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        if not self.rules or not hosts:
            return np.full(len(hosts), -1)
        fits = self.automaton.run([h + SEPARATOR + p for h, p in zip(hosts, paths)])
        fits = fits[:, 0::2] | fits[:, 1::2]
        return np.where(fits.any(axis=1), fits.argmax(axis=1), -1)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or end, A-Z lower-cased."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def judge_urls(pages: DataFrame, rules: list[Rule], default: str = DEFAULT) -> DataFrame:
    """page_id, host, path, rule (null where none fits), verdict."""
    kind = pages.schema["page_id"].dataType.simpleString()
    known = RuleSet(rules)

    def run(batches):
        for batch in batches:
            hosts, paths = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for start, stop in slices([len(h) + len(p) + 1 for h, p in zip(hosts, paths)], BATCH_CELLS):
                won = known.winners(hosts[start:stop], paths[start:stop]).tolist()
                part = batch.slice(start, stop - start)
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns,
                        pa.array([None if w < 0 else known.rules[w].name for w in won], pa.string()),
                        pa.array([default if w < 0 else known.rules[w].verdict for w in won], pa.string()),
                    ],
                    names=["page_id", "host", "path", "rule", "verdict"],
                )

    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    return parts.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), [parse_rule(r) for r in RULES])


QUERIES = {"op9_url_filter": op9_url_filter}

ORACLE_SQL = {
    "op9_url_filter": r"""
with u as (
    select page_id,
           translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
    from pages
), r as (
    select * from (values ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
        ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
    ) r(verdict, host, path)
), fit as (
    select u.page_id, arg_max(r.host || r.path, length(r.host || r.path)) as rule,
           arg_max(r.verdict, length(r.host || r.path)) as verdict
    from u join r on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path)
    group by u.page_id
)
select u.page_id, u.host, u.path, fit.rule, coalesce(fit.verdict, 'allow') as verdict
from u left join fit using (page_id)
"""
}
