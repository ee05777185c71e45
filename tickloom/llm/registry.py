"""The queries of this package and, where SQL can express them, their DuckDB forms."""

from __future__ import annotations

from . import (
    chat_format,
    common,
    decontamination,
    language_id,
    line_dedup,
    simhash_dedup,
    similarity_digest,
    token_files,
    toxicity,
    transducer_bpe,
    url_filter,
)

_MODULES = (
    decontamination,
    line_dedup,
    simhash_dedup,
    chat_format,
    transducer_bpe,
    language_id,
    toxicity,
    similarity_digest,
    url_filter,
    token_files,
)


def queries():
    return {name: f for m in _MODULES for name, f in m.QUERIES.items()}


def oracle_sql():
    return {name: sql for m in _MODULES for name, sql in m.ORACLE_SQL.items()}


def restore(spark):
    """Put back the session settings that the text queries have changed."""
    common.restore(spark)
