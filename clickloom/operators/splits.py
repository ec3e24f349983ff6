"""Time-ordered train/validation/test split of sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas
from clickloom.operators.ordered import TASK_ROWS, dense_index
from clickloom.operators.sessions import SESSION, session_index


def time_ranked_sessions(
    silver: DataFrame, cutoff: str | None = None, limit: int = TASK_ROWS
) -> DataFrame:
    """Session index with ``rank`` (0-based by start, then session)."""
    index = session_index(silver).drop("event_count")
    if cutoff is not None:
        early = F.col("session_start_time") < F.lit(cutoff).cast("timestamp_ntz")
        index = index.filter(early)
    return dense_index(index, ["session_start_time", SESSION], "rank", limit=limit)


def split_sessions(
    silver: DataFrame, cutoff: str | None = C.SESSION_CUTOFF, limit: int = TASK_ROWS
) -> DataFrame:
    """Split map, unsorted; an empty scope is an error.

    The two boundaries are truncated shares of the session count, so ten
    sessions give 8/1/1.
    """
    ranked = time_ranked_sessions(silver, cutoff, limit)
    if ranked.isEmpty():
        raise ValueError("no session starts before the cutoff")
    total = F.col("rank_total").cast("double")
    split = (
        F.when(F.col("rank") < F.floor(total * F.lit(C.TRAIN_SHARE)), "train")
        .when(F.col("rank") < F.floor(total * F.lit(C.TRAIN_VAL_SHARE)), "val")
        .otherwise("test")
    )
    return ranked.withColumn("split", split).select(*schemas.SPLIT_MAP.names)
