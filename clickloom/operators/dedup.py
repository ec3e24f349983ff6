"""Duplicate removal and deterministic order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas


def keep_first(df: DataFrame, order: list[Column], keys=C.EVENT_KEY) -> DataFrame:
    """The first row of every key in ``order``.

    The ``rank == 1`` filter becomes a window group limit below the shuffle,
    so each map task sends at most one row per key however many copies it has.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def duplicate_counts(df: DataFrame, keys=C.EVENT_KEY) -> DataFrame:
    """One row: rows, distinct keys and surplus copies."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return per_key.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("input_rows"),
        F.count(F.lit(1)).alias("unique_rows"),
        F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("duplicate_rows"),
    )


def sort_canonical(df: DataFrame) -> DataFrame:
    """Global order on the event key (range shuffle, parallel sort)."""
    schemas.require_columns(df, C.EVENT_KEY)
    return df.orderBy(*C.EVENT_KEY)


def replay_order(df: DataFrame, *ties: str) -> DataFrame:
    """Rows ordered by session and time inside range partitions.

    Sorting is global; ``ties`` keeps equal instants in arrival order.
    """
    return df.orderBy("user_session", "source_event_time", *ties)


def full_row_duplicates(df: DataFrame) -> DataFrame:
    """One row: rows that repeat an earlier row in every column."""
    distinct = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    return distinct.agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("duplicate_rows")
    )
