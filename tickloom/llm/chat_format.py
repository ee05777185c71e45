"""Chat formatting with DataFrame expressions only.

The turns of a conversation are collected as structs, sorted, and adjacent turns of one role are
merged into blocks by array expressions. A block is ``<|open|>role<|head|>text<|close|>``, where
``<|next|>`` parts merged turns, so the turns can be read back. A backslash in a text or role is
doubled and ``<|`` becomes ``<\\|``, so no text can hold a mark, whatever control strings it quotes.
The loss mask is a list of ranges of the formatted text, in code points and in bytes: each assistant
turn's text. Where a turn begins is a running sum over the turns before; what an array needs of
another is looked up by place, so time grows with the turns and not with their square.

Defined cases: a null text is empty; a null role is the empty role; turns sort by (turn, role,
text), nulls first, so ties and repeated rows have one order and all stay; rows with a null conv_id
are one conversation. Other columns are ignored. A conversation is one row of the output, so its
turns meet in one task; conversations are dealt by a hash of conv_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table

OPEN, HEAD, NEXT, CLOSE = "<|open|>", "<|head|>", "<|next|>", "<|close|>"
LEARNT = "assistant"


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once for all that ``use`` looks up in it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def merge_turns(turns: Column) -> Column:
    """array<struct<role, text>> -> array<struct<role, texts>>: adjacent turns of one role together."""

    def blocks(turns: Column) -> Column:
        n = F.size(turns)
        places = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
        first = F.filter(places, lambda i: (i == 0) | (F.get(turns, i - 1)["role"] != F.get(turns, i)["role"]))
        return _let(
            first,
            lambda first: F.transform(
                first,
                lambda start, k: F.struct(
                    F.get(turns, start)["role"].alias("role"),
                    F.transform(
                        F.sequence(start, F.coalesce(F.get(first, k + 1), n) - 1), lambda i: F.get(turns, i)["text"]
                    ).alias("texts"),
                ),
            ),
        )

    return _let(turns, blocks)


def format_conversations(conversations: DataFrame, learnt: str = LEARNT) -> DataFrame:
    """conv_id, formatted, loss: array<struct<start, length, at, bytes>> from 0: code points, then bytes."""
    turns = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    shielded = turns.select(
        "*",
        escaped(F.col("role")).alias("role_out"),
        escaped(F.col("text")).alias("text_out"),
        (F.lag("role").over(order).isNull() | (F.lag("role").over(order) != F.col("role"))).alias("opens"),
        (F.lead("role").over(order).isNull() | (F.lead("role").over(order) != F.col("role"))).alias("closes"),
    )

    def where(size) -> tuple[Column, Column]:
        """Where a turn's text begins, and its size."""
        lead = F.when(F.col("opens"), len(OPEN) + size("role_out") + len(HEAD)).otherwise(len(NEXT))
        whole = (lead + size("text_out") + F.when(F.col("closes"), len(CLOSE)).otherwise(0)).cast("long")
        before = F.sum(whole).over(order.rowsBetween(Window.unboundedPreceding, 0)) - whole
        return before + lead, size("text_out").cast("long")

    (start, length), (at, size) = where(F.length), where(F.octet_length)
    placed = shielded.select(
        "conv_id",
        F.struct(
            start.alias("start"), F.col("role_out").alias("role"), F.col("text_out").alias("text"), length.alias("length"), at.alias("at"), size.alias("bytes")
        ).alias("turn"),
    )
    # a turn begins after all before it, so the sorted structs are in order of the turns
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    formatted = F.array_join(
        F.transform(
            merge_turns(F.col("turns")),
            lambda b: F.concat(F.lit(OPEN), b["role"], F.lit(HEAD), F.array_join(b["texts"], NEXT), F.lit(CLOSE)),
        ),
        "",
    )
    mask = F.transform(
        F.filter("turns", lambda t: t["role"] == escaped(F.lit(learnt))),
        lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"), t["at"].alias("at"), t["bytes"].alias("bytes")),
    )
    return gathered.select("conv_id", formatted.alias("formatted"), mask.alias("loss"))


def read_turns(formatted: Column) -> Column:
    """array<struct<role, text>> of the turns in a formatted text."""
    raw = F.filter(F.split(formatted, r"<\|close\|>", -1), lambda b: b != "")
    blocks = F.transform(
        raw,
        lambda b: F.struct(
            unescaped(F.replace(F.substring_index(b, HEAD, 1), F.lit(OPEN), F.lit(""))).alias("role"),
            F.split(F.substring_index(b, HEAD, -1), r"<\|next\|>", -1).alias("texts"),
        ),
    )
    return F.flatten(
        F.transform(
            blocks,
            lambda b: F.transform(b["texts"], lambda t: F.struct(b["role"].alias("role"), unescaped(t).alias("text"))),
        )
    )


def learnt_text(formatted: Column, loss: Column) -> Column:
    """What the mask covers, unescaped, nothing between; cut by bytes, which no search precedes."""
    return _let(
        formatted.cast("binary"),
        lambda raw: F.array_join(
            F.transform(
                loss,
                lambda s: unescaped(F.substring(raw, (s["at"] + 1).cast("int"), s["bytes"].cast("int")).cast("string")),
            ),
            "",
        ),
    )


#: A conversation whose texts quote control strings.
QUOTING = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ", ".join(f"({c}L, {t}L, '{r}', '{x}')" for c, t, r, x in QUOTING)
    quoting = spark.sql(f"select * from values {rows} as t(conv_id, turn, role, text)")
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    done = format_conversations(conversations.unionByName(quoting))
    read = done.select(
        "conv_id",
        F.length("formatted").cast("long").alias("formatted_chars"),
        read_turns(F.col("formatted")).alias("turns"),
        learnt_text(F.col("formatted"), F.col("loss")).alias("learnt"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


QUERIES = {"op4_chat_format": op4_chat_format}

ORACLE_SQL = {
    "op4_chat_format": r"""
with t as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -7, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), s as (
    select *, replace(replace(role, '\', '\\'), '<|', '<\|') as role_out,
           replace(replace(text, '\', '\\'), '<|', '<\|') as text_out,
           row_number() over (partition by conv_id order by turn nulls first, role, text) as i,
           lag(role) over (partition by conv_id order by turn nulls first, role, text) as before
    from t
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by i) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(sum(length(text_out) + case when before is not distinct from role then 8
                else 8 + length(role_out) + 8 + 9 end) as bigint) as formatted_chars
from s group by conv_id
"""
}
