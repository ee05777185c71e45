"""Schemas of the raw tables: types, which columns must be present, and the column order of a write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_KINDS = {
    "s": T.StringType(),
    "d": T.DateType(),
    "f": T.DoubleType(),
    "i": T.LongType(),
    "b": T.BooleanType(),
    "t": T.TimestampType(),
}


def _schema(text: str) -> T.StructType:
    """``symbol:s! open:f`` -> fields; ``!`` marks a column that must not be null."""
    fields = []
    for item in text.split():
        name, kind = item.split(":")
        fields.append(T.StructField(name, _KINDS[kind[0]], not kind.endswith("!")))
    return T.StructType(fields)


STOCK_HISTORY = _schema(
    "history_id:s! symbol:s! date:d! open:f! high:f! low:f! close:f! volume:i! is_anomaly:b! row_hash:s! "
    "is_latest:b! loaded_at:t! superseded_at:t"
)
INDEX_CONSTITUENTS = _schema(
    "index_name:s! symbol:s! snapshot_date:d! current_index:f idx_weight:f idx_point:f market_cap_m:f "
    "freefloat_m:f shares_m:f loaded_at:t!"
)
SYMBOLS = _schema(
    "ticker_attr_id:s! symbol:s! name:s! sector_name:s! is_etf:b! is_debt:b! is_gem:b! is_margin_eligible:b! "
    "row_hash:s! is_latest:b! loaded_at:t! superseded_at:t"
)
SECTORS = _schema(
    "sector_code:s! sector_name:s! advance:i decline:i unchanged:i turnover:f market_cap_b:f snapshot_date:d! loaded_at:t!"
)
SCREENER = _schema(
    "symbol:s! sector:s listed_in:s market_cap:f price:f pe_ratio:f dividend_yield:f free_float:f "
    "volume_avg_30d:f change_1y_pct:f snapshot_date:d! loaded_at:t!"
)
INDEX_PRICE_HISTORY = _schema("index_name:s date:d open:f high:f low:f close:f volume:i change_pct:f")

#: SRC-1: the raw tables by name.
RAW = {
    "stock_history": STOCK_HISTORY,
    "index_constituents": INDEX_CONSTITUENTS,
    "symbols": SYMBOLS,
    "sectors": SECTORS,
    "screener": SCREENER,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns in the schema's order and types. Missing optional ones are null, required ones an error."""
    missing = [f.name for f in schema if f.name not in df.columns and not f.nullable]
    if missing:
        raise KeyError(f"required columns are missing: {', '.join(missing)}")
    return df.select(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema
        ]
    )
