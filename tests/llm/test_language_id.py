import zlib
from collections import Counter

from tests.llm.helpers import SF, by_id, docs, parquet
from tickloom.llm import language_id as I


def brute_grams(text):
    out = Counter()
    word = ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
        elif word:
            out.update(word)
            padded = f" {word} "
            out.update(padded[i : i + 2] for i in range(len(padded) - 1))
            out.update(padded[i : i + 3] for i in range(len(padded) - 2))
            word = ""
    return out


def code(gram):
    return sum(ord(c) << (21 * i) for i, c in enumerate(gram))


def brute_rank(counts, top):
    return [code(g) for g, _ in sorted(counts.items(), key=lambda x: (-x[1], code(x[0])))[:top]]


def test_ranks_match_brute_force():
    for text in ("Hello, wörld! a b  c", "x", "One1two 漢字 ß", "1 2 3", "", None, "na " * 5000):
        assert I.ranked(text, 50).tolist() == brute_rank(brute_grams(text), 50)


def test_profiles_and_distance_match_brute_force(spark):
    d = parquet(f"{SF}/documents.parquet")
    open_ = d[[zlib.crc32(str(i).encode()) % 5 != 0 for i in d.doc_id]]
    profiles = {}
    for lang, rows in open_.groupby("lang"):
        total = Counter()
        for t in rows.text:
            total += brute_grams(t)
        profiles[lang] = brute_rank(total, I.TOP)
    want = {}
    for i, t in zip(d.doc_id, d.text):
        mine = brute_rank(brute_grams(t), I.TOP)
        if not mine:
            want[i] = "und"
            continue
        far = {n: sum(abs(k - p.index(g)) if g in p else I.TOP for k, g in enumerate(mine)) for n, p in profiles.items()}
        want[i] = min(sorted(far), key=far.get)
    got = I.op6_language_id(spark, SF)
    assert by_id(got, "lang_pred") == want
    assert by_id(got, "held_out") == {i: zlib.crc32(str(i).encode()) % 5 == 0 for i in d.doc_id}


def test_held_out_accuracy(spark):
    sf = SF.replace("0.001", "0.01")
    d = parquet(f"{sf}/documents.parquet").set_index("doc_id")
    rows = [r for r in I.op6_language_id(spark, sf).collect() if r["held_out"] and d.lang[r["doc_id"]]]
    assert sum(r["lang_pred"] == d.lang[r["doc_id"]] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_defined_cases(spark):
    rows = [(1, None), (2, "123 !!"), (3, "hello"), (3, "hello"), (None, "hello"), (4, "")]
    d = docs(spark, rows, ("lang_pred", "score", "gram"))
    got = sorted(((r["doc_id"], r["lang_pred"]) for r in I.identify(d, I.learn_profiles(d)).collect()), key=repr)
    assert got == sorted([(1, "und"), (2, "und"), (3, "en"), (3, "en"), (None, "en"), (4, "und")], key=repr)
    assert I.learn_profiles(docs(spark, [])) == {}
    assert {r["lang_pred"] for r in I.identify(d, {}).collect()} == {"und"}
    assert I.identify(docs(spark, []), {}).count() == 0


def test_many_languages_are_no_refusal(spark):
    words = lambda k: " ".join("abcdefghijklmnop"[int(c, 16)] for c in f"{k:04x}") + " " + "".join("qrstuvwxyzäöüßéç"[int(c, 16)] for c in f"{k * 7919 % 65536:04x}")
    rows = [(k, words(k)) for k in range(2500)]
    d = docs(spark, rows).drop("lang").selectExpr("*", "concat('l', doc_id) as lang")
    got = by_id(I.identify(d, I.learn_profiles(d)), "lang_pred")
    profiles = {f"l{k}": brute_rank(brute_grams(t), I.TOP) for k, t in rows}
    for k in (0, 7, 1234, 2499):
        mine = profiles[f"l{k}"]
        far = {n: sum(abs(i - p.index(g)) if g in p else I.TOP for i, g in enumerate(mine)) for n, p in profiles.items()}
        assert got[k] == min(sorted(far), key=far.get)
