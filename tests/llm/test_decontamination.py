import hashlib
import random
import re

from tests.llm.helpers import SF, collected, docs, parquet, words
from tickloom.llm import decontamination as D

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(texts, items, window=13):
    """Hit words and items of each text, by comparing all windows."""
    split = lambda t: WORD.findall((t or "").translate(LOW))
    grams = {}
    for item, text in items:
        w = split(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(g) for g in grams}
    out = []
    for text in texts:
        w, hit, found = split(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                of = grams.get(tuple(w[i : i + n]))
                if of:
                    hit.update(range(i, i + n))
                    found |= of
        out.append((len(w), len(hit), sorted(str(f) for f in found if f is not None)))
    return out


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_random_texts_match_brute_force(spark):
    rng = random.Random(5)
    pool = words(rng, 12)
    pick = lambda n: " ".join(rng.choice(pool) for _ in range(n))
    items = [(i, pick(rng.choice([1, 2, 5, 12, 13, 14, 30]))) for i in range(12)] + [(None, pick(15)), (3, pick(20)), (99, None), (98, "...")]
    texts = [pick(rng.randrange(0, 80)) for _ in range(30)]
    texts += [items[5][1].upper() + "! " + pick(10), "", None, "é ÉÀ " + items[2][1], " ".join([pick(5), items[13][1], pick(400)])]
    rows = list(enumerate(texts)) + [(0, texts[0]), (None, texts[3])]
    want = brute([t for _, t in rows], items)
    for shard, most in ((1, 64), (1, 3), (10_000, 64)):  # many automata, in one pass or several, or one for all
        got = D.find_contamination(docs(spark, rows, ("n_hit", "items")), bench(spark, items), shard_words=shard, most_shards=most)
        got = collected(got, "doc_id", "n_words", "n_hit", "items", "contaminated")
        assert got == sorted(
            ((i, n, h, f, h > 0 and 20 * h >= n) for (i, _), (n, h, f) in zip(rows, want)), key=repr
        )


def test_coverage_limit_and_removal(spark):
    item = " ".join(f"w{i}" for i in range(20))
    low = item + " " + " ".join(f"x{i}" for i in range(381))  # 20 of 401 words
    at = item + " " + " ".join(f"x{i}" for i in range(380))  # 20 of 400 words
    rows = [(1, low), (2, at), (3, "clean"), (4, None)]
    b = bench(spark, [(1, item)])
    kept = D.decontaminate(docs(spark, rows, ("spans",)), b)
    assert kept.columns == ["doc_id", "text", "lang", "source", "spans"]
    assert collected(kept, "doc_id", "text") == sorted([(1, low), (3, "clean"), (4, None)], key=repr)
    cut = D.decontaminate(docs(spark, rows), b, span_words=15)
    assert dict(collected(cut, "doc_id", "text"))[1] == low[len(item) :]


def test_many_shards_of_decontaminate(spark):
    rng = random.Random(6)
    pool = words(rng, 3000)
    items = [(i, " ".join(rng.choice(pool) for _ in range(20))) for i in range(40)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(100))) for i in range(20)]
    rows += [(100 + i, rows[i][1] + " " + t) for i, t in items[:8]]
    for most in (2, 64):
        kept = D.decontaminate(docs(spark, rows, ("_found",)), bench(spark, items), shard_words=10, most_shards=most)
        assert collected(kept, "doc_id", "text") == sorted(rows[:20], key=repr)


def test_shards_are_opened_once(tmp_path, monkeypatch):
    names = []
    for k in range(10):
        data = D.build_automaton([(str(k), D.words_of(b"item %d has these words" % k))])
        (tmp_path / f"s{k}").write_bytes(data)
        names.append(f"s{k}")
    opened = []
    monkeypatch.setattr(D.SparkFiles, "get", lambda n: opened.append(n) or str(tmp_path / n))
    D._automaton.cache_clear()
    for _ in range(5):
        found = D.find_in([b"xx item 3 has these words yy", None], names)
        assert found[0].items == {"3"} and found[0].hits == [(1, 6)] and found[1].n_words == 0
    assert sorted(opened) == names
    D._automaton.cache_clear()


def test_repetitive_texts_take_linear_time(tmp_path, monkeypatch):
    """A word that repeats 100,000 times, as an item and as a text."""
    import time

    def seconds(n):
        began = time.process_time()
        (tmp_path / f"r{n}").write_bytes(D.build_automaton([("1", [b"word"] * n)]))
        found = D.Automaton(str(tmp_path / f"r{n}"))
        hits, items = [], set()
        words = D.Words([b"word " * n])
        assert found.scan(found.codes(words), hits, items) == n and items == {"1"}
        assert D.merged(hits) == [(0, n)]
        return time.process_time() - began

    seconds(1000)
    small, large = seconds(20_000), seconds(100_000)
    assert large < 12 * small + 1


def test_long_text_and_spans(spark):
    item = " ".join(f"w{i}" for i in range(14))
    text = "é" * 200_000 + " ü " + "word " * 60_000 + item + " end"
    got = D.find_contamination(docs(spark, [(1, text)]), bench(spark, [(7, item)])).first()
    assert (got["n_hit"], got["longest"], got["items"]) == (14, 14, ["7"])
    span = got["spans"][0]
    assert text[span["start"] : span["stop"]] == item


def test_empty_tables(spark):
    none = docs(spark, [])
    assert D.find_contamination(none, bench(spark, [(1, "a b")])).count() == 0
    got = D.find_contamination(docs(spark, [(1, "a b")]), bench(spark, [])).first()
    assert (got["n_words"], got["n_hit"], got["contaminated"]) == (2, 0, False)


def test_query_matches_brute_force(spark):
    d, b = parquet(f"{SF}/documents.parquet"), parquet(f"{SF}/benchmark.parquet")
    want = brute(list(d.text), list(zip(b.item_id, b.text)))
    got = {r["doc_id"]: r for r in D.op1_decontamination(spark, SF).collect()}
    for i, (n, h, f) in zip(d.doc_id, want):
        r = got[i]
        sha = hashlib.sha256(",".join(f).encode()).hexdigest()
        assert (r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"]) == (n, h, len(f), sha)
