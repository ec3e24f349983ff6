"""Raw rows to replay events, with a reject branch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas
from clickloom.functions import scalars as S

RAW_REQUIRED = (
    "event_time",
    "event_type",
    "product_id",
    "category_id",
    "user_id",
    "user_session",
)


def raw_problem() -> Column:
    """Why a raw row cannot be replayed, NULL if it can."""
    problem = F.lit(None).cast("string")
    unreadable = _instant().isNull()
    problem = F.when(unreadable, "unreadable event_time").otherwise(problem)
    known = F.coalesce(F.col("event_type").isin(*C.EVENT_TYPES), F.lit(False))
    problem = F.when(~known, "event_type not allowed").otherwise(problem)
    for name in reversed(RAW_REQUIRED):
        blank = S.blank_to_null(F.col(name).cast("string")).isNull()
        problem = F.when(blank, f"{name} is missing").otherwise(problem)
    return problem


def _instant() -> Column:
    """Text with `` UTC``, ``Z``, an offset or no zone, as zone-less UTC."""
    text = F.col("event_time").cast("string")
    return S.parse_iso(F.replace(text, F.lit(" UTC"), F.lit("")))


def normalise(
    raw: DataFrame, replay_time: Column | None = None, carry=(), fail: bool = False
) -> DataFrame:
    """Replay events of the good rows; ``fail`` makes a bad row an error."""
    judged = raw.withColumn("_problem", raw_problem())
    if fail:
        stop = F.raise_error(F.concat(F.lit("bad raw row: "), F.col("_problem")))
        judged = judged.withColumn(
            "_problem", F.when(F.col("_problem").isNotNull(), stop.cast("string"))
        )
    good = judged.filter(F.col("_problem").isNull())
    sent = replay_time
    if sent is None:
        sent = S.iso_text(F.date_trunc("second", F.current_timestamp()))
    typed = good.withColumn("source_event_time", S.iso_text(_instant()))
    text = {
        n: S.blank_to_null(F.col(n).cast("string"))
        for n in ("category_code", "brand")
    }
    price = S.nan_to_null(F.col("price").cast("double"))
    typed = typed.withColumns({**text, "price": price})
    identity = [F.col(n) for n in C.EVENT_KEY]
    return typed.withColumns(
        {
            "replay_time": sent,
            "source": F.lit("replay"),
            "event_id": S.event_id(*identity),
        }
    ).select(*schemas.REPLAY_EVENT.names, *carry)


def rejects(raw: DataFrame) -> DataFrame:
    """The bad rows with the reason."""
    judged = raw.withColumn("reason", raw_problem())
    return judged.filter(F.col("reason").isNotNull())
