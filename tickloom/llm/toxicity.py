"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier learns from documents confirmed toxic and from unlabelled text, drawn from all
documents that may be learnt from. It minimises the risk corrected by the class prior,
``prior * E_p[l(f)] + max(0, E_u[l(-f)] - prior * E_p[l(-f)])``, with numpy; where the second part
turns negative its gradient is reversed. The prior is the share of toxic rows among the labelled.
Features are the distinct words of a text and their first bytes (inflected words share those), kept
where they are significantly more or less frequent in toxic text, and scaled by their log-ratio.

The fit uses at most ``positives`` toxic documents and ``unlabelled`` others, the first by a hash of
doc_id, and all features of theirs that are significant; scoring reads whole texts of all documents.

Defined cases: a null or wordless text scores as a text without features; without a toxic row to
learn from every score is 0; a null label or doc_id is not learnt from; a doc_id that is labelled
more than once is toxic if any of its rows says so; repeated rows repeat. Other columns are ignored
or, in ``reject_toxic``, kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import held_out, materialised, remove_path, slices, table

POSITIVES = 3_000
UNLABELLED = 9_000
#: Bytes of a word that are features besides the word.
PREFIXES = (4, 5, 6)
#: Least significance of a feature, in standard deviations: of some 100,000 words that have nothing to
#: do with toxicity a handful pass by chance. A feature of one or two documents tells those documents
#: and no kind, however few the toxic ones are.
LEAST_Z = 4.0
LEAST_DOCS = 3
STEPS = 300
RATE = 0.05
DECAY = 1e-3
BATCH_CHARS = 500_000

#: ASCII that is no letter or digit parts words.
_WORD_BYTES = bytes(b if chr(b).isalnum() or b >= 128 else 32 for b in range(256))


def words_of(text: str | None) -> set[bytes]:
    return set(text.lower().encode(errors="replace").translate(_WORD_BYTES).split()) if text else set()


def features_of(text: str | None) -> set[bytes]:
    """Distinct words, each ended by a space, and their prefixes."""
    words = words_of(text)
    out = {w + b" " for w in words}
    for n in PREFIXES:
        out.update({w[:n] for w in words})
    return out


@dataclass
class Model:
    """Weights of features; the score is the sigmoid of their sum."""

    weights: dict[bytes, float]
    bias: float
    learnt: bool = True

    def score(self, text: str | None) -> float:
        if not self.learnt:
            return 0.0
        get, total, seen = self.weights.get, self.bias, set()
        for w in words_of(text):
            total += get(w + b" ", 0.0)
            seen.add(w[:4])
            seen.add(w[:5])
            seen.add(w[:6])
        for p in seen:
            total += get(p, 0.0)
        return float(1 / (1 + np.exp(-np.clip(total, -40, 40))))


def fit_nnpu(
    rows: np.ndarray, cols: np.ndarray, n_rows: int, positive: np.ndarray, scale: np.ndarray, prior: float
) -> tuple[np.ndarray, float]:
    """Weights and bias of the corrected risk's minimum, by full-batch Adam with logistic loss."""
    n = len(scale)
    theta, m, v = np.zeros(n + 1), np.zeros(n + 1), np.zeros(n + 1)
    theta[n] = np.log(prior / (1 - prior))
    n_p, n_u = max(1, int(positive.sum())), max(1, int((~positive).sum()))
    values = scale[cols]
    for step in range(1, STEPS + 1):
        f = np.bincount(rows, values * theta[cols], n_rows) + theta[n]
        up = 1 / (1 + np.exp(-np.clip(f, -40, 40)))  # derivative of l(-f); l(f) has up - 1
        as_negative = np.logaddexp(0, f)
        rest = as_negative[~positive].sum() / n_u - prior * as_negative[positive].sum() / n_p
        slope = np.zeros(n_rows)
        if rest >= 0:
            slope[positive] = prior * (up[positive] - 1) / n_p - prior * up[positive] / n_p
            slope[~positive] = up[~positive] / n_u
        else:  # the unlabelled part is overfitted: climb out of it
            slope[positive] = prior * up[positive] / n_p
            slope[~positive] = -up[~positive] / n_u
        grad = np.append(np.bincount(cols, values * slope[rows], n), slope.sum())
        grad[:n] += DECAY * theta[:n]
        m = 0.9 * m + 0.1 * grad
        v = 0.999 * v + 0.001 * grad * grad
        theta -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return theta[:n] * scale, float(theta[n])


def _feature_rows(batches):
    for batch in batches:
        classes = batch.column(0).to_pylist()
        texts = batch.column(1)
        for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_CHARS):
            kinds, found = [], []
            for kind, text in zip(classes[start:stop], texts.slice(start, stop - start).to_pylist()):
                got = features_of(text)
                found += got
                kinds += [kind] * len(got)
            yield pa.RecordBatch.from_arrays(
                [pa.array(kinds, pa.bool_()), pa.array(found, pa.binary())], names=["positive", "feature"]
            )


def learn(
    docs: DataFrame,
    labels: DataFrame,
    positives: int = POSITIVES,
    unlabelled: int = UNLABELLED,
) -> Model:
    """The model of the documents and labels given; hold rows out before."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = known.agg(F.count("*").alias("n"), F.sum((F.col("toxic") == 1).cast("long")).alias("p")).first()
    if not share["n"] or not share["p"]:
        return Model({}, 0.0, learnt=False)
    prior = min(max(share["p"] / share["n"], 1e-4), 1 - 1e-4)
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = docs.select("doc_id").filter("doc_id is not null").distinct()
    toxic = known.filter("toxic = 1").select("doc_id").join(ids, "doc_id", "left_semi").orderBy(*order).limit(positives)
    drawn = ids.orderBy(*order).limit(unlabelled)
    picked = toxic.withColumn("positive", F.lit(True)).union(drawn.withColumn("positive", F.lit(False)))
    picked, drawn_ids = materialised(picked, "picked")  # at most positives + unlabelled ids
    chosen = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    chosen = chosen.select("doc_id", "positive", "text").dropDuplicates(["doc_id", "positive"])
    sample, drawn_texts = materialised(chosen, "sample")
    model = _learn_from(sample, prior)
    for path in (drawn_ids, drawn_texts):
        remove_path(docs.sparkSession, path)
    return model


def _learn_from(sample: DataFrame, prior: float) -> Model:
    """The model of a bounded table of positive, text."""
    sizes = {r["positive"]: r["count"] for r in sample.groupBy("positive").count().collect()}
    n_p, n_u = sizes.get(True, 0), sizes.get(False, 0)
    if not n_p or not n_u:
        return Model({}, 0.0, learnt=False)
    counts = (
        sample.select("positive", "text")
        .mapInArrow(_feature_rows, "positive boolean, feature binary")
        .groupBy("feature")
        .agg(F.sum(F.col("positive").cast("long")).alias("p"), F.sum((~F.col("positive")).cast("long")).alias("u"))
    )
    both = (F.col("p") + F.col("u") + 1.0) / (n_p + n_u + 2.0)
    apart = (F.col("p") / n_p) - (F.col("u") / n_u)
    z = F.abs(apart) / F.sqrt(both * (1 - both) * (1 / n_p + 1 / n_u))
    # the features of a bounded sample, significant ones only
    rows = sorted(counts.filter(F.col("p") + F.col("u") >= LEAST_DOCS).filter(z >= LEAST_Z).collect())
    if not rows:
        return Model({}, float(np.log(prior / (1 - prior))))
    names = [bytes(r["feature"]) for r in rows]
    p = (np.array([r["p"] for r in rows]) + 0.5) / (n_p + 1)
    u = (np.array([r["u"] for r in rows]) + 0.5) / (n_u + 1)
    scale = np.log(p / u)
    place = {f: i for i, f in enumerate(names)}

    def reduce(batches):
        for batch in batches:
            got = [[place[f] for f in features_of(t.as_py()) if f in place] for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(got, pa.list_(pa.int32()))], names=["positive", "found"]
            )

    coded = sample.select("positive", "text").mapInArrow(reduce, "positive boolean, found array<int>").toPandas()
    coded = coded.sort_values("positive", kind="stable")
    sizes = coded["found"].map(len).to_numpy()
    cols = np.concatenate([*coded["found"], np.zeros(0, np.int32)]).astype(np.int64)
    weights, bias = fit_nnpu(
        np.repeat(np.arange(len(coded)), sizes), cols, len(coded), coded["positive"].to_numpy(bool), scale, prior
    )
    return Model({f: float(w) for f, w in zip(names, weights) if w}, bias)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score, predicted."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            texts = batch.column(1)
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_CHARS):
                got = [model.score(t) for t in texts.slice(start, stop - start).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, stop - start), pa.array(got, pa.float64())], names=["doc_id", "score"]
                )

    scored = docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def learn_open(docs: DataFrame, labels: DataFrame, **how) -> Model:
    """Learn from the rows that are not held out."""
    return learn(docs.filter(~held_out()), labels.filter(~held_out()), **how)


def reject_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The documents, in their own columns, whose score is under one half."""
    at = docs.columns.index("text")

    def run(batches):
        for batch in batches:
            texts = batch.column(at)
            keep: list[bool] = []
            for start, stop in slices(pc.binary_length(texts).to_pylist(), BATCH_CHARS):
                keep += [model.score(t) < 0.5 for t in texts.slice(start, stop - start).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = learn_open(docs, table(spark, sf_dir, "labels"))
    return score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


QUERIES = {"op7_toxicity": op7_toxicity}

ORACLE_SQL: dict[str, str] = {}
