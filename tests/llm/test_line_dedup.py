from collections import defaultdict

from tests.llm.helpers import collected, docs
from tickloom.llm import line_dedup as L

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"


def brute(rows, least=40, most=5):
    holders = defaultdict(set)
    key = lambda x: x.strip(BLANK).translate(LOW)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if i is not None and len(key(line)) >= least:
                holders[key(line)].add(i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if i is None or len(holders[key(x)]) < most or max(holders[key(x)]) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def sample():
    line, other = "This is a LINE that many documents share, é over forty", "y" * 40
    short = "z" * 39
    rows = [(i, f"own {i}\n  {line if i % 2 else line.swapcase().swapcase().upper().replace('É', 'é')}\t\n\n{short}\n{other if i < 4 else ''}") for i in range(8)]
    rows += [(100, f"{line}\n{line}\nlast"), (100, f"{line}\nother text"), (101, None), (102, ""), (None, line), (103, "\n\n")]
    rows += [(3, rows[3][1]), (104, "q" * 300_000 + "\n" + other)]
    return rows


def test_matches_brute_force(spark):
    rows = sample()
    got = L.dedup_lines(docs(spark, rows, ("h", "pos")))
    assert collected(got, "doc_id", "n_lines", "n_dropped", "text") == brute(rows)


def test_documents_keep_their_columns(spark):
    rows = sample()
    clash = ("_id", "_lost", "h", "n_lines", "_text_hash")
    got = L.dedup_documents(docs(spark, rows, clash))
    assert got.columns == ["doc_id", "text", "lang", "source", *clash]
    texts = sorted(((r["doc_id"], r["text"] or "") for r in got.collect()), key=repr)
    assert texts == sorted(((i, k) for i, _, _, k in brute(rows)), key=repr)
    assert {r["_lost"] for r in got.collect()} == {"extra"}
    assert [r["text"] for r in got.collect() if r["doc_id"] == 101] == [None]


def test_empty_table(spark):
    assert L.dedup_lines(docs(spark, [])).count() == 0
    assert L.dedup_documents(docs(spark, [])).count() == 0


def test_only_repeated_lines_are_written_aside(spark, monkeypatch):
    """Not the keys of all lines: what is written is a row for each line that is dropped somewhere, in one small file."""
    written, write = [], L.materialise
    monkeypatch.setattr(L, "materialise", lambda df, label: written.append(write(df, label)) or written[-1])
    rows = sample() + [(1000 + i, f"a line of document {i} alone, over forty characters") for i in range(200)]
    assert collected(L.dedup_lines(docs(spark, rows)), "doc_id", "n_lines", "n_dropped", "text") == brute(rows)
    assert [(x.columns, x.count(), len(x.inputFiles())) for x in written] == [(["h", "keeper"], 2, 1)]
