import random

import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import SF, collected, docs, parquet
from tickloom.llm import transducer_bpe as T


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(T.VOCABULARY)


ODD = [
    "Hello, World! it's I'LL 42 ''s '", "ΑΣ ΣΑΣ İstanbul", "e\u0301 é \u0041\u030a", "<|endoftext|>a<|startoftext|><|x|>",
    "\x1c\x1d a\x85b\xa0c", "漢字 ½ ² Ⅷ", "😀😀 𝐀𝐁 text", "\u0378 unknown \u1c89 \ua7dc", "", None, " \n\t ", "ab" * 3000 + "the" * 200,
]


def test_merges_match_the_library(library):
    bpe = T.WordBpe(T.VOCABULARY)
    rng = random.Random(1)
    texts = [t for t in ODD if t]
    for _ in range(1500):
        texts.append("".join(chr(c) for c in (rng.choice([rng.randrange(32, 127), rng.randrange(0x250), rng.randrange(0xD800), rng.randrange(0xE000, 0x110000)]) for _ in range(rng.randrange(1, 12)))))
    for text in texts:
        ids = [i for w in bpe.words(text) for i in ([bpe.special[w]] if w in bpe.special else bpe.merge(w.encode()))]
        assert ids == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_every_code_point_in_context(library):
    """Blocks of code points of one plane, each in several contexts: the ids are the library's."""
    bpe = T.WordBpe(T.VOCABULARY)
    texts = []
    for at in [*range(0, 0xD800, 16), *range(0xE000, 0x32000, 16), *range(0xE0000, 0xE0200, 16), 0xF0000, 0x10FFF0]:
        texts.append(" ".join(f"a{c}b {c}! '{c}d 1{c}2" for c in map(chr, range(at, at + 16))))
    for c in "\uFA6C\uFACF\uFACF\uFAD0\uFAD5\uFAD7\u2ADC":  # NFC leads to other planes, or splits
        texts += [f"x {c}! y", f"a{c}b", c]
    memory = {}
    got = library.encode_batch_fast(texts, add_special_tokens=False)
    for text, want in zip(texts, got):
        ids = []
        for w in bpe.words(text):
            if w not in memory:
                raw = w.encode(errors="surrogateescape")
                memory[w] = [bpe.special[w]] if w in bpe.special else bpe.merge(raw)
            ids += memory[w]
        assert ids == want.ids, repr(text)


def test_both_merges_agree():
    bpe = T.WordBpe(T.VOCABULARY)
    rng = random.Random(4)
    for _ in range(200):
        word = "".join(rng.choice(["the", "ing", "ab", "z", "é", "aaa"]) for _ in range(rng.randrange(1, 120))).encode()
        ids = [bpe.inner[b] for b in word[:-1]] + [bpe.final[word[-1]]]
        assert bpe._merge_short(list(ids)) == bpe._merge_long(list(ids))


def test_lexicon_finds_its_words_and_no_others(tmp_path):
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) + rng.choice(["", "ing", "tion"]) for _ in range(800)})
    entries = [(w.encode(), [i, i + 1][: 1 + i % 2]) for i, w in enumerate(words)]
    data = T.compile_lexicon(entries)
    (tmp_path / "x").write_bytes(data)
    lexicon = T.Lexicon(str(tmp_path / "x"))
    assert len(lexicon.final) < sum(len(w) for w in words) / 3  # suffixes are shared
    asked = words + [w + "x" for w in words] + [w[:-1] for w in words] + ["", "zzz", "a" * 60]
    raw = "".join(asked).encode()
    import numpy as np

    offsets = np.cumsum([0] + [len(w) for w in asked])
    got = lexicon.find(np.frombuffer(raw, np.uint8), offsets)
    place = {w: i for i, w in enumerate(words)}
    assert got.tolist() == [place.get(w, -1) for w in asked]
    for w, ids in entries[:50]:
        k = place[w.decode()]
        assert lexicon.ids[lexicon.starts[k] : lexicon.starts[k + 1]].tolist() == ids


def test_documents_match_the_library(spark, library):
    rows = list(enumerate(ODD)) + [(0, ODD[0]), (None, "null id"), (50, "the the the")]
    want = sorted(((i, library.encode(t or "", add_special_tokens=False).ids) for i, t in rows), key=repr)
    for size in (0, 3, 100_000):  # whatever the lexicon holds
        coded = T.encode(docs(spark, rows, ("token_ids", "word", "n")), lexicon_words=size)
        assert collected(coded, "doc_id", "token_ids") == want
    texts = collected(T.decode(coded), "doc_id", "text")
    assert texts == sorted(((i, library.decode(ids, skip_special_tokens=False)) for i, ids in want), key=repr)


def test_decode_of_nulls_and_foreign_ids(spark, library):
    rows = [(1, None), (2, []), (3, [320, -1, 10**6, 49407])]
    got = T.decode(spark.createDataFrame(rows, "doc_id long, token_ids array<int>"))
    assert collected(got, "doc_id", "text") == [(1, ""), (2, ""), (3, library.decode([320, 49407], skip_special_tokens=False))]


def test_empty_table(spark):
    assert T.encode_with_digests(docs(spark, [])).count() == 0 and T.encode(docs(spark, [])).count() == 0


def test_query_counts(spark, library):
    d = parquet(f"{SF}/documents.parquet")
    got = dict(collected(T.op5_transducer_bpe(spark, SF), "doc_id", "n_tokens"))
    assert got == {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in zip(d.doc_id, d.text)}
