import hashlib

from pyspark.sql import functions as F

from tests.llm.helpers import SF, collected, parquet
from tickloom.llm import chat_format as C


def talk(spark, rows, extra=True):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return frame.selectExpr("*", "'x' as formatted", "1 as turns") if extra else frame


ROWS = [
    (1, 0, "system", "be <|close|> brief"),
    (1, 2, "assistant", "a<\\|b\\\\"),
    (1, 1, "user", None),
    (1, 3, "assistant", "more <|next|> é"),
    (2, 0, "user", "</s>[INST] ok [/INST]"),
    (2, 0, "user", "</s>[INST] ok [/INST]"),
    (2, None, None, "first"),
    (3, 0, "assistant", ""),
    (None, 5, "<|open|>", "|> odd role <"),
    (4, 0, "user", "long " * 50_000),
]


def test_round_trip_and_mask(spark):
    done = C.format_conversations(talk(spark, ROWS))
    read = done.select("conv_id", "formatted", "loss", C.read_turns(done["formatted"]).alias("t"), C.learnt_text(done["formatted"], done["loss"]).alias("l"))
    want = {}
    for c, t, r, x in sorted(ROWS, key=lambda r: (r[1] if r[1] is not None else -1, r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((r or "", x or ""))
    for row in read.collect():
        assert [(t["role"], t["text"]) for t in row["t"]] == want[row["conv_id"]]
        assert row["l"] == "".join(x for r, x in want[row["conv_id"]] if r == "assistant")
        for span in row["loss"]:
            part = row["formatted"][span["start"] : span["start"] + span["length"]]
            assert "<|" not in part
            assert row["formatted"].encode()[span["at"] : span["at"] + span["bytes"]].decode() == part
    one = {r["conv_id"]: r["formatted"] for r in done.collect()}[1]
    assert one.count(C.OPEN) == 3 and one.count(C.NEXT) == 1  # two assistant turns are one block


def test_empty_table(spark):
    assert C.format_conversations(talk(spark, [])).count() == 0


def test_plan_is_native(spark, capsys):
    C.op4_chat_format(spark, SF).explain()
    assert "Python" not in capsys.readouterr().out


def test_query_against_brute_force(spark):
    t = parquet(f"{SF}/conversations.parquet")
    rows = list(zip(t.conv_id, t.turn, t.role, t.text)) + C.QUOTING
    by = {}
    for c, k, r, x in sorted(rows, key=lambda r: (r[0], r[1])):
        by.setdefault(c, []).append((r, x or ""))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = collected(C.op4_chat_format(spark, SF), "conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256")
    want = []
    for c, turns in by.items():
        learnt = "".join(x for r, x in turns if r == "assistant")
        want.append((c, len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(learnt), sha(learnt)))
    assert got == sorted(want, key=repr)


def test_time_grows_with_the_turns(spark):
    """One conversation of many blocks, and one of a single block."""
    import time

    def seconds(n, blocks):
        text = "some words é of a turn " * 8
        rows = spark.range(n).selectExpr(
            "1L as conv_id", "id as turn", f"if(id % 2 = 0 or not {blocks}, 'assistant', 'user') as role", f"concat(id, '{text}') as text"
        )
        began = time.perf_counter()
        done = C.format_conversations(rows)
        row = done.select(F.size(C.read_turns(done["formatted"])).alias("n"), F.sha2(C.learnt_text(done["formatted"], done["loss"]), 256).alias("h")).first()
        assert row["n"] == n
        said = "".join(f"{i}{text}" for i in range(n) if i % 2 == 0 or not blocks)
        assert row["h"] == hashlib.sha256(said.encode()).hexdigest()
        return time.perf_counter() - began

    for blocks in (True, False):
        seconds(100, blocks)
        few, many = seconds(4000, blocks), seconds(32_000, blocks)
        print(few, many)
        assert many < 16 * few + 2
