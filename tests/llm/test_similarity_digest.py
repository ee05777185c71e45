import hashlib
from collections import Counter

import numpy as np

from tests.llm.helpers import SF, docs, parquet
from tickloom.llm import similarity_digest as S

RANK = np.arange(S._MOST + 1)[::-1].copy()


def text(seed, n, letters=14):
    return bytes(np.random.default_rng(seed).integers(97, 97 + letters, n).astype(np.uint8))


def crowding(window):
    return sum(int(S._G[c]) for c in Counter(window).values())


def brute_windows(raw):
    raw = raw.ljust(S.WINDOW, b"\0") if raw else raw
    return [raw[i : i + S.WINDOW] for i in range(len(raw) - S.WINDOW + 1)]


def brute_rank(raws):
    """The rarest class first, classes of low entropy after all others."""
    counts = Counter(crowding(w) for raw in raws for w in brute_windows(raw))
    low = lambda c: c > S.WINDOW * S._PARTS * (4 - S.LEAST_ENTROPY)
    order = sorted(range(S._MOST + 1), key=lambda c: (low(c), counts.get(c, float("inf")), c))
    return {c: i for i, c in enumerate(order)}


def brute_features(raw, rank):
    """Of each run of windows (runs cut at the ends) the one of least (rank, place); distinct, in order."""
    windows = brute_windows(raw)
    keys = [(rank[crowding(w)], i) for i, w in enumerate(windows)]
    runs = [keys[max(0, s) : s + S.NEIGHBOURHOOD] for s in range(1 - S.NEIGHBOURHOOD, len(keys))] if keys else []
    places = {min(run)[1] for run in runs}
    hashes = [int(S._mixed(np.frombuffer(windows[p], np.uint8).reshape(1, -1).copy())[0]) for p in sorted(places)]
    return list(dict.fromkeys(hashes))


def brute_chain(raw, rank):
    """Sets of bits, and the features in each."""
    f = brute_features(raw, rank)
    parts = [f[i : i + S.FILTER_FEATURES] for i in range(0, len(f), S.FILTER_FEATURES)]
    return [({(x >> (11 * k)) % S.FILTER_BITS for x in p for k in range(S.HASHES)}, len(p)) for p in parts]


def brute_likeness(a, b):
    if (len(a), sum(n for _, n in a)) > (len(b), sum(n for _, n in b)):
        a, b = b, a
    if not a:
        return float(not b)
    total = 0.0
    for x, n in a:
        scores = []
        for y, _ in b:
            chance = len(x) * len(y) / S.FILTER_BITS
            scores.append((len(x & y) - chance) / max(min(len(x), len(y)) - chance, 1e-9))
        total += n * min(1.0, max(0.0, max(scores)))
    return min(1.0, total / sum(n for _, n in a))


def bits(digest):
    return [(set(np.flatnonzero(np.unpackbits(f)).tolist()), int(n)) for f, n in zip(*digest)]


SMALL = [text(9, n) for n in range(0, 101, 7)] + [b"a" * n for n in (1, 15, 16, 17, 100)] + [b"b" * 5000, b"-=" * 40, b"x\0y"]


def test_digests_match_brute_force(monkeypatch):
    raws = [text(1, 4000), b"short", b"", text(2, 60), text(3, 100, 2), b"-" * 300, text(1, 4000), *SMALL]
    rank = brute_rank(raws)
    array = np.array([rank[c] for c in range(S._MOST + 1)])
    whole = S.digests(raws, array)
    assert [bits(d) for d in whole] == [brute_chain(raw, rank) for raw in raws]
    assert [len(d[0]) > 0 for d in whole] == [len(r) > 0 for r in raws]
    monkeypatch.setattr(S, "SEGMENT", 111)
    for a, b in zip(whole, S.digests(raws, array)):
        assert np.array_equal(a[0], b[0]) and np.array_equal(a[1], b[1])


def test_entropy_classes_are_counted_exactly():
    raws = [text(5, 500), text(6, 47), text(7, 48), *SMALL]
    want = Counter(crowding(w) for raw in raws for w in brute_windows(raw))
    got = S.entropy_classes(raws)
    assert {int(i): int(got[i]) for i in np.flatnonzero(got)} == dict(want)


def test_one_method_for_all_lengths():
    """Two bytes more leave a text like itself at every length; repeated bytes are told apart."""
    for n in range(30, 70):
        one, two = S.digests([text(n, n), text(n, n) + b"zq"], RANK)
        assert S.likeness(one, two) > 0.6
    a, b, none, few = S.digests([b"a" * 100, b"b" * 5000, b"", b"a" * 3], RANK)
    assert S.likeness(a, b) < 0.1 and S.likeness(a, none) == 0 == S.likeness(none, b) and S.likeness(few, few) == 1


def test_likeness():
    a, b = text(1, 20_000), text(2, 20_000)
    half = a[:10_000] + b[10_000:]
    da, db, dh, de = S.digests([a, b, half, b""], RANK)
    assert S.likeness(da, da) == 1.0 and S.likeness(da, db) < 0.1 and 0.3 < S.likeness(da, dh) < 0.7
    assert S.likeness(de, de) == 1.0 and S.likeness(de, da) == 0.0
    again = S.from_string(S.to_string(da))
    assert S.likeness(again, da) == 1.0 and S.to_string(again) == S.to_string(da)


def check(frame, rows):
    rows = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))
    texts = [r[1] or "" for r in rows]
    after = texts[1:] + texts[:1]
    want = sorted(
        ((r[0], len(t), hashlib.sha256(S.edited(t, a).encode()).hexdigest()) for r, t, a in zip(rows, texts, after)), key=repr
    )
    got = frame.collect()
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == want
    return got


def test_every_document_meets_its_successor(spark):
    rows = [(i * 3 % 97, f"text {i} é " * (i % 7)) for i in range(60)] + [(None, "null id, long enough to have some windows in it"), (5, None), (5, "b"), (5, "a")]
    for pieces in (1, 4, 50):
        got = check(S.fingerprint_with_next(docs(spark, rows, ("piece", "tail", "key")), pieces), rows)
        assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    check(S.fingerprint_with_next(docs(spark, [(None, "null"), (9, "nine"), (5, "five")]), 1), [(None, "null"), (9, "nine"), (5, "five")])
    one = S.fingerprint_with_next(docs(spark, [(1, "alone " * 30)]), 3).first()
    assert one["near_next"] == 1.0
    assert S.fingerprint_with_next(docs(spark, []), 3).count() == 0


def test_ids_that_are_no_numbers(spark):
    rows = [("b", "text of b"), ("a", "text of a"), (None, "null"), ("c", None)]
    frame = spark.createDataFrame(rows, "doc_id string, text string")
    got = {r["doc_id"]: r["edited_sha256"] for r in S.fingerprint_with_next(frame, 3).collect()}
    order = [None, "a", "b", "c"]
    by = dict(rows)
    for i, d in enumerate(order):
        t, after = by[d] or "", by[order[(i + 1) % 4]] or ""
        assert got[d] == hashlib.sha256(S.edited(t, after).encode()).hexdigest()


def test_whole_query_against_brute_force(spark, tmp_path):
    """Digests and both likenesses, with ranks counted over all texts."""
    rows = [(3 * i, raw.decode()) for i, raw in enumerate(SMALL)] + [(1, None), (4, "é" * 40), (7, text(1, 9000).decode()), (8, text(1, 8000).decode())]
    docs(spark, rows, ("key",)).coalesce(3).write.parquet(f"file://{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in check(S.op8_similarity_digest(spark, f"file://{tmp_path}"), rows)}
    rows = sorted((i, t or "") for i, t in rows)
    rank = brute_rank([t.encode() for _, t in rows])
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        mine, other, changed = (brute_chain(x.encode(), rank) for x in (t, after, S.edited(t, after)))
        assert bits(S.from_string(got[i]["fingerprint"])) == mine
        assert bits(S.from_string(got[i]["edited_fingerprint"])) == changed
        assert abs(got[i]["near_edited"] - brute_likeness(mine, changed)) < 1e-9
        assert abs(got[i]["near_next"] - brute_likeness(mine, other)) < 1e-9


def test_query(spark):
    d = parquet(f"{SF}/documents.parquet")
    got = check(S.op8_similarity_digest(spark, SF), list(zip(d.doc_id, d.text)))
    assert np.mean([r["near_edited"] > r["near_next"] for r in got]) > 0.97
    by = dict(zip(d.doc_id, d.text))
    seen = {}
    for r in got:
        assert seen.setdefault(by[r["doc_id"]], r["fingerprint"]) == r["fingerprint"]
