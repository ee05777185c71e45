import random
import zlib

import numpy as np

from tests.llm.helpers import by_id, docs, parquet, words
from tickloom.llm import toxicity as X


def corpus(n=600, seed=1):
    rng = random.Random(seed)
    pool, bad = words(rng, 300), ["scumbag", "vileword", "nastything"]
    rows, toxic = [], {}
    for i in range(n):
        text = [rng.choice(pool) for _ in range(rng.randrange(20, 60))]
        if toxic.setdefault(i, int(rng.random() < 0.15)):
            text[rng.randrange(len(text))] = rng.choice(bad) + rng.choice(["", "s", "ly"])
        rows.append((i, " ".join(text)))
    return rows, toxic


def label(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_learns_from_positives_and_unlabelled(spark):
    rows, toxic = corpus()
    labels = label(spark, [(i, 1, t) for i, t in toxic.items() if i % 2] + [(1, None, None), (None, 0, 1)])
    d = docs(spark, rows, ("score", "positive"))
    model = X.learn_open(d, labels)
    got = by_id(X.score(d, model), "score")
    right = [(got[i] >= 0.5) == bool(t) for i, t in toxic.items()]
    assert sum(right) >= 0.97 * len(right)
    kept = X.reject_toxic(d, model)
    assert kept.columns == d.columns
    assert {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s < 0.5}


def test_score_is_the_sum_of_features(spark):
    model = X.Model({b"bad ": 2.0, b"badl": 1.0, b"good ": -3.0}, -0.5)
    for text in ("Bad day", "badly good", "", None, "b\xe4d \ud83d\ude00 badlyness"):
        total = -0.5 + sum(model.weights.get(f, 0) for f in X.features_of(text))
        assert abs(model.score(text) - 1 / (1 + np.exp(-total))) < 1e-12


def test_risk_estimator_separates_with_the_prior():
    rng = np.random.default_rng(0)
    n = 400
    positive = np.arange(2 * n) < n
    hidden = np.where(positive, True, rng.random(2 * n) < 0.2)  # a fifth of the unlabelled is positive
    pairs = [(i, 0 if h else 1) for i, h in enumerate(hidden)]
    rows, cols = np.array(pairs).T
    w, b = X.fit_nnpu(rows, cols, 2 * n, positive, np.ones(2), 0.2)
    assert w[0] + b > 0 > w[1] + b


def test_defined_cases(spark):
    d = docs(spark, [(1, None), (2, ""), (2, ""), (None, "some text")], ("predicted",))
    for labels in ([], [(1, 1, 0)], [(77, 1, 1)]):
        model = X.learn(d, label(spark, labels))
        assert not model.learnt and {r["score"] for r in X.score(d, model).collect()} == {0.0}
    assert X.score(d, model).count() == 4
    empty = docs(spark, [])
    model = X.learn(empty, label(spark, [(1, 1, 1)]))
    assert X.score(empty, model).count() == 0 and X.reject_toxic(empty, model).count() == 0
    long = docs(spark, [(1, "word " * 300_000 + "bad")])
    assert X.score(long, X.Model({b"bad ": 9.0}, -1.0)).first()["predicted"] == 1


def brute_model_score(model, text):
    """The sigmoid of the bias and the weights of the distinct words and prefixes of a text."""
    low = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in (text or "").lower())
    parts = set()
    for w in (x.encode() for x in low.split(" ")):
        if w:
            parts |= {w + b" ", w[:4], w[:5], w[:6]}
    total = model.bias + sum(model.weights.get(f, 0.0) for f in parts)
    return 1 / (1 + np.exp(-np.clip(total, -40, 40)))


def test_query_against_brute_force(spark):
    """Whole query: scores from the model, and the held-out rule."""
    sf = "/root/testdata/sf0.01"
    rows = {r["doc_id"]: r for r in X.op7_toxicity(spark, sf).collect()}
    d = parquet(f"{sf}/documents.parquet")
    assert len(rows) == len(d)
    model = X.learn_open(X.table(spark, sf, "documents"), X.table(spark, sf, "labels"))
    for i, t in zip(d.doc_id, d.text):
        r = rows[i]
        assert abs(r["score"] - brute_model_score(model, t)) < 1e-9
        assert r["predicted"] == int(r["score"] >= 0.5)
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)


def test_held_out_labels(spark):
    """Where nothing was learnt; a hundredth of this table has too few toxic rows to learn from."""
    sf = "/root/testdata/sf0.1"
    rows = {r["doc_id"]: r for r in X.op7_toxicity(spark, sf).collect()}
    labels = parquet(f"{sf}/labels.parquet")
    held = [(rows[i]["predicted"], t) for i, t in zip(labels.doc_id, labels.toxic) if rows[i]["held_out"]]
    toxic = [p for p, t in held if t == 1]
    clean = [p for p, t in held if t == 0]
    assert len(toxic) >= 50 and np.mean(toxic) >= 0.9 and np.mean(clean) <= 0.02
