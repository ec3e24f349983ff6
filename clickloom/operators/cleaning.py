"""Row-wise cleaning from raw text to silver events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas
from clickloom.functions import scalars as S


def parse_times(raw: DataFrame) -> DataFrame:
    return raw.withColumn("event_time", S.parse_utc_text(F.col("event_time")))


def allowed_type() -> Column:
    """True only for an allowed type; a NULL type is not allowed."""
    return F.coalesce(F.col("event_type").isin(*C.EVENT_TYPES), F.lit(False))


def keep_allowed_types(df: DataFrame) -> DataFrame:
    return df.filter(allowed_type())


def to_bronze(raw: DataFrame, *carry: str) -> DataFrame:
    """Raw text rows to the bronze layout; ``carry`` keeps order columns."""
    typed = parse_times(raw).withColumnRenamed("event_time", "source_event_time")
    body = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schemas.BRONZE]
    return keep_allowed_types(typed).select(*body, *carry)


def normalise_types(df: DataFrame) -> DataFrame:
    declared = {f.name: f.dataType for f in schemas.SILVER}
    return df.select(
        *[
            F.col(c).try_cast(declared[c]).alias(c) if c in declared else F.col(c)
            for c in df.columns
        ]
    )


def category_policy(
    df: DataFrame, policy: str = "keep", value: str = "unknown"
) -> DataFrame:
    if policy == "keep":
        return df
    if policy != "fill":
        raise ValueError(f"unsupported category policy {policy!r}: keep or fill")
    if "category_code" not in df.columns:
        return df
    return df.fillna({"category_code": value})


def has_required() -> Column:
    present = F.lit(True)
    for name in C.REQUIRED_COLUMNS:
        present = present & F.col(name).isNotNull()
    return present


def has_valid_price() -> Column:
    return F.col("price").isNull() | (F.col("price") > 0.0)


def keep_required(df: DataFrame) -> DataFrame:
    schemas.require_columns(df, C.REQUIRED_COLUMNS)
    return df.filter(has_required())


def keep_valid_price(df: DataFrame) -> DataFrame:
    return df.filter(has_valid_price())


def clean(bronze: DataFrame, policy: str = "keep", value: str = "unknown") -> DataFrame:
    """Types, category policy, required fields, price, in that order."""
    typed = category_policy(normalise_types(bronze), policy, value)
    return keep_valid_price(keep_required(typed))


def raw_counts(raw: DataFrame) -> DataFrame:
    """One row: input, accepted and type-rejected rows of a raw frame."""
    return raw.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(allowed_type()).alias("accepted_rows"),
        F.count_if(~allowed_type()).alias("rejected_rows"),
    )


def clean_counts(bronze: DataFrame) -> DataFrame:
    """One row: how many bronze rows each cleaning rule rejects."""
    typed = normalise_types(bronze)
    complete, priced = has_required(), has_valid_price()
    return typed.agg(
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(~complete).alias("rejected_required"),
        F.count_if(complete & ~priced).alias("rejected_price"),
        F.count_if(complete & priced).alias("valid_rows"),
    )


def observed(df: DataFrame, name: str, **measures: Column):
    """Attach counters that are filled by whichever job runs the frame."""
    watch = Observation(name)
    columns = [column.alias(label) for label, column in measures.items()]
    return df.observe(watch, *columns), watch


def exploration_fill(df: DataFrame, value: str = "Unknown") -> DataFrame:
    """Fill unknown category and brand, drop rows that have no session."""
    filled = df.fillna({"category_code": value, "brand": value})
    return filled.dropna(subset=["user_session"])
