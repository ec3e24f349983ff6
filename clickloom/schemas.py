"""Spark schemas of every table the library reads or writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT = T.StringType()
_TIME = T.TimestampNTZType()
_REAL = T.DoubleType()
_INT = T.LongType()

_EVENT_BODY = (
    ("event_type", _TEXT),
    ("product_id", _TEXT),
    ("category_id", _TEXT),
    ("user_id", _TEXT),
    ("user_session", _TEXT),
    ("category_code", _TEXT),
    ("brand", _TEXT),
    ("price", _REAL),
)

RAW = _schema(("event_time", _TEXT), *_EVENT_BODY)
BRONZE = _schema(("source_event_time", _TIME), *_EVENT_BODY)
SILVER = BRONZE

GOLD = _schema(
    ("source_event_time", _TIME),
    ("category_id", _TEXT),
    ("user_session", _TEXT),
    ("user_id", _TEXT),
    ("event_type", _TEXT),
    ("product_id", _TEXT),
    ("category_code", _TEXT),
    ("brand", _TEXT),
    ("price", _REAL),
    ("total_views", _INT),
    ("total_carts", _INT),
    ("net_cart_count", _INT),
    ("cart_to_view_ratio", _REAL),
    ("unique_categories", _INT),
    ("unique_products", _INT),
    ("session_duration_sec", _REAL),
    ("label", T.ByteType()),
)

SPLIT_MAP = _schema(
    ("user_session", _TEXT),
    ("session_start_time", _TIME),
    ("session_end_time", _TIME),
    ("split", _TEXT),
)

REPLAY_EVENT = _schema(
    ("source_event_time", _TEXT),
    *_EVENT_BODY,
    ("replay_time", _TEXT),
    ("source", _TEXT),
    ("event_id", _TEXT),
)

VOCABULARY = _schema(("column", _TEXT), ("value", _TEXT), ("code", _INT))


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast and order columns to a declared schema; a bad value is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def require_columns(df: DataFrame, names) -> None:
    for name in names:
        if name not in df.columns:
            raise ValueError(f"missing: {name}")
