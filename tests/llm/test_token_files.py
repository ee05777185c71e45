import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import SF, collected, docs, parquet
from tickloom.llm import token_files as K


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 70_000), st.integers(0, 2**64 - 1)), max_size=400), st.integers(1, 70))
def test_packing_round_trip(values, block):
    v = np.array(values, np.uint64)
    data = K.pack(v, block)
    assert np.array_equal(K.unpack(data, len(v), block), v)
    for k in range(-(-len(v) // block)):
        assert np.array_equal(K.unpack_block(data, len(v), k, block), v[k * block : (k + 1) * block])


def greedy(values, block):
    """The words one after the other: each by the packing that takes most of a block's next values."""
    words, offsets = [], [0]
    for start in range(0, len(values), block):
        rest = values[start : start + block]
        while rest:
            for s, (count, bits) in enumerate(K.PACKINGS, 1):
                if all(v < 1 << bits for v in rest[:count]):
                    words.append(s + sum(v << 4 + k * bits for k, v in enumerate(rest[:count])))
                    rest = rest[count:]
                    break
            else:
                words += [0, rest[0]]
                rest = rest[1:]
        offsets.append(len(words))
    return np.array([len(offsets) - 1, *offsets, *words], "<u8").tobytes()


@pytest.mark.parametrize("block", [1, 7, 60, 1024])
@pytest.mark.parametrize("bits", [1, 4, 16, 31, 60, 64])
def test_packing_is_greedy(bits, block):
    rng = random.Random(bits)
    for n in (0, 1, 59, 60, 61, 1025, 2500):
        values = [rng.getrandbits(rng.randint(1, bits)) if rng.random() < 0.9 else 0 for _ in range(n)]
        assert K.pack(np.array(values, np.uint64), block) == greedy(values, block)


def test_packing_is_dense():
    assert len(K.pack(np.zeros(1024, np.uint64))) == 8 * (1 + 2 + 18)  # 60 ones-bit values a word
    assert len(K.pack(np.full(1024, 2**60, np.uint64))) == 8 * (1 + 2 + 2048)  # escapes


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(K.VOCABULARY)


def test_files_hold_all_ids_in_order(spark, tmp_path, library):
    rows = [(i * 7 % 101, f"Text number {i}, it's <|endoftext|> é 漢 \u0378" * (i % 5)) for i in range(80)]
    rows += [(None, "null id"), (3, None), (3, "b"), (3, "a"), (200, ""), (201, "word " * 50_000)]
    path = f"file://{tmp_path}/out"
    K.write_token_files(docs(spark, rows, ("part", "segment")), path, parts=5)
    ordered = sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] is not None, r[1] or ""))
    want, at = [], 0
    for i, t in ordered:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        want.append((i, at, ids))
        at += len(ids)
    assert collected(K.read_token_files(spark, path), "doc_id", "start", "token_ids") == sorted(want, key=repr)


def test_whole_texts_are_the_library_s(library):
    texts = ["x \uFACF! y", "a\uFA6Cb", "\u0378 \U0002FFFF", None, "", "\ud7ff " * 5, "a" * 5000]
    ids, sizes = K.encode_texts(texts)
    want = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])
    assert K.encode_texts([])[0].tolist() == []


def the_library_s(texts, library):
    ids, sizes = K.encode_texts(texts, library[0])
    want = [e.ids for e in library[1].encode_batch_fast(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(w) for w in want]
    for text, at, size, w in zip(texts, (np.cumsum(sizes) - sizes).tolist(), sizes.tolist(), want):
        assert ids[at : at + size].tolist() == w, repr(text)


def test_steps_that_change_no_id_are_left_out(library):
    """Blanks are not replaced, ASCII has neither NFC nor bytes; the ids are the whole file's for all code points."""
    plain, other = (json.loads(t.to_str()) for t in K._tokenizers(K.VOCABULARY))
    assert plain["normalizer"]["type"] == "Lowercase" and plain["pre_tokenizer"]["type"] == "Split"
    assert [n["type"] for n in other["normalizer"]["normalizers"]] == ["NFC", "Lowercase"]
    ascii = [chr(c) for c in range(128)]
    texts = [" ".join(f"x{a}{b}Y '{a}{b}S 1{a}{b}2" for b in ascii) for a in ascii]
    texts += [f"X{a}{b}'S" for a in ascii for b in ascii]  # most of them plain
    for at in [*range(0, 0xD800, 16), *range(0xE000, 0x32000, 16), *range(0xE0000, 0xE0200, 16), 0xF0000, 0x10FFF0]:
        texts.append(" ".join(f"a{c}b {c}! '{c}D 1{c}2" for c in map(chr, range(at, at + 16))))
    rng = random.Random(5)
    bits = ["<|endoftext|>", "<|ENDOFTEXT|>", " <|startoftext|>", "<|", "'RE", "'s", "\r\n", "\t ", "\x1c", "\x7f", "\u2028", "Ab", "9", "é", "e\u0301", "Σ", "İ", "."]
    texts += ["".join(rng.choices(bits[: rng.choice([8, len(bits)])], k=rng.randrange(1, 30))) for _ in range(3000)]
    the_library_s(texts, (K.VOCABULARY, library))


@pytest.mark.parametrize("change", ["words of blanks", "case kept", "normalized tokens"])
def test_a_file_of_other_steps_is_taken_as_it_is(tmp_path, change):
    with open(K.VOCABULARY, encoding="utf-8") as f:
        spec = json.load(f)
    if change == "words of blanks":
        spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"\s+|\S+"
    elif change == "case kept":
        del spec["normalizer"]["normalizers"][2]
    else:
        spec["added_tokens"].append(spec["added_tokens"][0] | {"id": 49408, "content": "a b", "normalized": True, "special": False})
    path = tmp_path / "other.json"
    path.write_text(json.dumps(spec), encoding="utf-8")
    texts = ["a  b", "A\t\nB ABC", "é  e\u0301 A\u2028b", "\x00 a b"]
    the_library_s(texts, (str(path), Tokenizer.from_file(str(path))))


def test_ids_that_are_no_numbers(spark, tmp_path):
    frame = spark.createDataFrame([("b", "x y"), ("a", "x"), (None, "")], "doc_id string, text string")
    K.write_token_files(frame, f"file://{tmp_path}/s", parts=3)
    got = collected(K.read_token_files(spark, f"file://{tmp_path}/s"), "doc_id", "start")
    assert sorted(got, key=lambda r: r[1]) == [(None, 0), ("a", 1), ("b", 3)]


def test_empty_table(spark, tmp_path):
    K.write_token_files(docs(spark, []), f"file://{tmp_path}/none", parts=3)
    assert K.read_token_files(spark, f"file://{tmp_path}/none").count() == 0


def test_query(spark, library):
    d = parquet(f"{SF}/documents.parquet").sort_values("doc_id")
    want, at = [], 0
    for i, t in zip(d.doc_id, d.text):
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert collected(K.op10_token_files(spark, SF), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)
