import random

import numpy as np
import xxhash

from tests.llm.helpers import collected, docs, words
from tickloom.llm import simhash_dedup as S
from tickloom.llm.components import components

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_fingerprint(text):
    w = [x for x in (text or "").translate(LOW).replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if x]
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_groups(fps, radius=2):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def near_texts(rng):
    base = words(rng, 400)
    texts = []
    for _ in range(6):
        t = [rng.choice(base) for _ in range(300)]
        for k in range(4):
            u = list(t)
            for _ in range(k):
                u[rng.randrange(len(u))] = rng.choice(base)
            texts.append(" ".join(u))
    return texts + ["", None, "one", "one two", "One\ttwo\x0bTHREE", "one two three", "é ü", "x " * 100_000]


def test_components_match_brute_force(spark):
    texts = near_texts(random.Random(3))
    rows = [(1000 - i, t) for i, t in enumerate(texts)] + [(1000, texts[0]), (None, texts[0]), (None, "alone in the world")]
    fps = [brute_fingerprint(t) for _, t in rows]
    ids = [i for i, _ in rows]
    groups = brute_groups(fps)
    least = {g: min([i for i, h in zip(ids, groups) if h == g and i is not None], default=None) for g in groups}
    got = S.near_duplicates(docs(spark, rows, ("fp", "component_id", "first", "node")))
    as_signed = lambda v: v - (1 << 64) if v >> 63 else v
    assert collected(got, "doc_id", "fp", "component_id") == sorted(
        ((i, as_signed(f), least[g]) for i, f, g in zip(ids, fps, groups)), key=repr
    )


def test_one_of_each_group_stays(spark):
    rows = [(5, "a b c d"), (9, "a b c d"), (2, "a b c d"), (2, "a b c d"), (7, "other words entirely here"), (None, "a b c d"), (8, None)]
    got = S.near_dedup(docs(spark, rows, ("component_id", "count", "_id", "fp")))
    assert got.columns == ["doc_id", "text", "lang", "source", "component_id", "count", "_id", "fp"]
    assert collected(got, "doc_id", "text") == sorted([(2, "a b c d"), rows[4], (8, None)], key=repr)
    assert S.near_dedup(docs(spark, [])).count() == 0


def test_rows_that_share_an_id_are_told_apart_by_text(spark):
    a, b, c = "one text of some words", "quite another one with others", "and a third that is unlike both"
    rows = [(1, a), (2, a), (2, b), (3, b), (3, c), (3, c), (None, c), (None, "no id but alone"), (None, "no id but alone"), (None, None), (4, None), (4, "")]
    got = collected(S.near_dedup(docs(spark, rows)), "doc_id", "text")
    brute = {}
    for i, t in rows:  # a null text and an empty one have one fingerprint
        group, mine = brute_fingerprint(t), (i is None, i or 0)
        if group not in brute or mine < brute[group][0]:
            brute[group] = (mine, i, t)
    want = [(i, t) for _, i, t in brute.values()]
    assert sorted(i for i, _ in got if i is not None) == sorted(i for i, _ in want if i is not None)
    assert [x for x in got if x[1]] == sorted([x for x in want if x[1]], key=repr)
    assert len(got) == len(want)


def test_links_of_crowded_buckets(spark):
    """Buckets far beyond the tile give the same components as all pairs."""
    rng = np.random.default_rng(1)
    seeds = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fps = set()
    for s in seeds:
        for _ in range(60):
            x = int(s)
            for _ in range(int(rng.integers(0, 4))):
                x ^= 1 << int(rng.integers(0, 64))
            fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long")
    groups = brute_groups(fps)
    for tile in (8, 4096):
        tree = {r["node"]: r["component"] for r in components(S.links(frame, tile=tile)).collect()}
        label = [tree.get(x, x) for x in signed]
        same = {}
        for a, b in zip(groups, label):
            assert same.setdefault(a, b) == b
        assert len(set(label)) == len(set(groups))


def test_compare_tiles_is_exact():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, 400, dtype=np.uint64)
    fps = np.unique(np.concatenate([base, base ^ np.uint64(3), base ^ np.uint64(1 << 40)]))
    for step in (2, 512):
        for buckets in (np.zeros(len(fps), np.int64), np.sort(rng.integers(-5, 5, len(fps)))):
            a, b = S.compare_tiles(buckets, fps, 2)
            tree = dict(zip(a.tolist(), b.tolist()))
            for k in set(buckets.tolist()):
                mine = [int(x) for x in fps[buckets == k]]
                groups = brute_groups(mine)
                assert len({tree.get(x, x) for x in mine}) == len(set(groups))
    assert S.compare_tiles(np.zeros(0, np.int64), np.zeros(0, np.uint64), 2)[0].tolist() == []


def test_tiles_of_a_registered_table_are_compared_and_skipped(spark):
    """The query's own buckets: pairs of tiles near in population count are compared, others skipped."""
    frame = S.table(spark, "/root/testdata/check_s", "documents").filter("octet_length(text) < 3000")
    rows = S._dealt(S.fingerprints(frame).select("fp").distinct(), S.BLOCKS, S.RADIUS, S.TILE)
    rows = rows.selectExpr("xxhash64(choice, key, pair) as g", "fp").toPandas()
    buckets, fps = rows["g"].to_numpy(), rows["fp"].to_numpy().view(np.uint64)
    ones = np.bitwise_count(fps).astype(np.int64)
    order = np.lexsort((ones, buckets))
    buckets, ones, fps = buckets[order], ones[order], fps[order]
    tiles = S.tile_pairs(buckets, ones, S.RADIUS)
    assert tiles.compared > 0 and tiles.skipped > 0
    want = [(b, x) for b, x in zip(buckets.tolist(), fps.tolist())]
    near = set()
    for i in range(len(want)):
        j = i + 1
        while j < len(want) and want[j][0] == want[i][0]:
            if bin(want[i][1] ^ want[j][1]).count("1") <= S.RADIUS:
                near.add((want[i][1], want[j][1]))
            j += 1
    a, b = S.compare_tiles(buckets, fps, S.RADIUS)
    label = lambda pairs: {r["node"]: r["component"] for r in components(spark.createDataFrame([(x - (1 << 63), y - (1 << 63)) for x, y in pairs], "a long, b long")).collect()}
    assert label(near) == label(zip(a.tolist(), b.tolist()))


def test_components_of_a_long_chain(spark):
    n = 300
    order = list(range(n))
    random.Random(4).shuffle(order)
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1000), (2000, 2001)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert all(got[i] == 0 for i in range(1, n)) and got[2001] == 2000
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
