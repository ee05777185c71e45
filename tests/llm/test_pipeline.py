"""Each stage and the whole pipeline against plain Python versions."""

import hashlib

import corpus_pipeline as P
from tests.llm import test_decontamination, test_line_dedup, test_simhash_dedup
from tests.llm.helpers import SF, collected, docs, parquet
from tickloom.llm import toxicity
from tickloom.llm.common import materialise


def brute(spark):
    d, b = parquet(f"{SF}/documents.parquet"), parquet(f"{SF}/benchmark.parquet")
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    model = toxicity.learn_open(frame, spark.read.parquet(f"{SF}/labels.parquet"))
    rows = [(i, t) for i, t in zip(d.doc_id, d.text) if model.score(t) < 0.5]
    yield rows
    rows = [(i, k) for i, _, _, k in test_line_dedup.brute(rows)]
    yield rows
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0))
    groups = test_simhash_dedup.brute_groups([test_simhash_dedup.brute_fingerprint(t) for _, t in rows])
    rows = [r for k, r in enumerate(rows) if groups[k] == k]
    yield rows
    found = test_decontamination.brute([t for _, t in rows], list(zip(b.item_id, b.text)))
    rows = [r for r, (n, h, _) in zip(rows, found) if not (h and 20 * h >= n)]
    yield rows


def test_stages_match_plain_versions(spark):
    frame = spark.read.parquet(f"{SF}/documents.parquet")
    columns = frame.columns
    for (name, stage), want in zip(P.STAGES[:-1], brute(spark)):
        frame = materialise(stage(spark, frame, SF), name)
        assert frame.columns == columns
        assert collected(frame, "doc_id", "text") == sorted(want, key=repr), name
    last = P.run(spark, SF)
    from tokenizers import Tokenizer

    from tickloom.llm.transducer_bpe import VOCABULARY

    t = Tokenizer.from_file(VOCABULARY)
    ids = {i: t.encode(x, add_special_tokens=False).ids for i, x in want}
    assert {r["doc_id"]: list(r["token_ids"]) for r in last.collect()} == ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in last.collect():
        assert r["ids_sha256"] == sha(" ".join(map(str, ids[r["doc_id"]])))


def test_settings_are_put_back(spark):
    """Text queries read in small batches; a query of the warehouse finds the session as it was."""
    import __spark_entry__ as entry
    from tickloom.llm.common import BATCHES

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    entry.queries()["dim_date"](spark, SF)
    before = spark.conf.get(key)
    entry.queries()["op9_url_filter"](spark, SF)
    assert spark.conf.get(key) == BATCHES[key] != before
    entry.queries()["dim_date"](spark, SF)
    assert spark.conf.get(key) == before


def test_unlike_texts_that_share_an_id_pass_all_stages(spark):
    rows = [(1, "the first text of some words here"), (2, "the first text of some words here"), (2, "quite another one that is unlike it")]
    frame = docs(spark, rows)
    for name, stage in P.STAGES[:-1]:
        frame = materialise(stage(spark, frame, SF), name)
    assert collected(frame, "doc_id", "text") == sorted([rows[0], rows[2]], key=repr)


def test_stages_on_odd_tables(spark):
    odd = docs(spark, [(1, None), (1, None), (2, ""), (None, "x"), (3, "some clean text here")], ("n_chars", "component_id", "score"))
    for frame in (odd, odd.limit(0)):
        before = frame
        for name, stage in P.STAGES[:-1]:
            before = materialise(stage(spark, before, SF), name)
            assert before.columns == odd.columns
        assert P.STAGES[-1][1](spark, before, SF).count() == before.count()
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "simhash_dedup", "decontamination", "bpe"]


def test_a_cluster_without_a_shared_folder_is_an_error():
    from types import SimpleNamespace as N

    import pytest

    from tickloom.llm.common import shared_folder

    java = N(sc=lambda: N(getCheckpointDir=lambda: N(isDefined=lambda: False)))
    session = N(conf=N(get=lambda key, default: None), sparkContext=N(master="local-cluster[2,1,1024]", _jsc=java))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(session)
