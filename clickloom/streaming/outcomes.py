"""Outcomes of logged predictions while predictions and purchases still arrive.

Both streams meet in a semi join over a time interval: a prediction leaves once,
with its first purchase, and never once per purchase. Both watermarks together
bound the state: a prediction is held until its window closes, a purchase until
no open window can reach it. What has closed without a purchase is known from
the watermark the stream has reached.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import scalars as S
from clickloom.operators import monitoring
from clickloom.operators.sessions import SESSION
from clickloom.streaming.sinks import batch_table, drain, table_exists

DELAY_SECONDS = 600


def _slice(micros, horizon_seconds: int):
    return F.floor(micros / F.lit(max(horizon_seconds, 1) * C.MICROS))


def _salt(row, salts: int):
    return F.pmod(F.xxhash64(row), F.lit(salts)).cast("int")


def purchase_hits(
    predictions: DataFrame,
    purchases: DataFrame,
    horizon_seconds: int = C.HORIZON_SECONDS,
    delay_seconds: int = DELAY_SECONDS,
    salts: int = 1,
) -> DataFrame:
    """Stream of (prediction_id, instant) with a purchase inside the window.

    Rows of either stream may be ``delay_seconds`` behind its newest time.
    A session is cut into slices of time as long as the horizon: a prediction
    lies in one of them, a purchase goes to the two that its predictions may lie
    in. Sessions that are busy inside a slice can be dealt over ``salts`` keys
    more; their purchases go to each of them. Predictions without a session, an
    id or a known mode, and events other than purchases, are left out.
    """
    known = F.col("evaluation_mode").isin(
        monitoring.REPLAY_MODE, monitoring.BACKFILL_MODE
    )
    whole = known & F.col(SESSION).isNotNull() & F.col("prediction_id").isNotNull()
    delay = f"{delay_seconds} seconds"
    instant = monitoring.prediction_instant().cast("timestamp")
    paid = S.epoch_micros(F.col("instant"))
    earliest, latest = paid - horizon_seconds * C.MICROS, paid - 1
    reached = F.sequence(_slice(earliest, horizon_seconds), _slice(latest, horizon_seconds))
    asked = predictions.filter(whole).select(
        "prediction_id",
        F.col("evaluation_mode").alias("lane"),
        F.col(SESSION).alias("session"),
        instant.alias("instant"),
        _slice(S.epoch_micros(instant), horizon_seconds).alias("slice"),
        _salt("prediction_id", salts).alias("salt"),
    )
    bought = monitoring.purchase_lanes(purchases).select(
        F.col("evaluation_mode").alias("bought_lane"),
        F.col(SESSION).alias("bought_session"),
        F.col("instant").cast("timestamp").alias("bought"),
        F.explode(reached).alias("bought_slice"),
    )
    dealt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    bought = bought.withColumn("bought_salt", dealt)
    asked, bought = asked.withWatermark("instant", delay), bought.withWatermark("bought", delay)
    same = (
        (F.col("lane") == F.col("bought_lane"))
        & (F.col("session") == F.col("bought_session"))
        & (F.col("slice") == F.col("bought_slice"))
        & (F.col("salt") == F.col("bought_salt"))
    )
    within = (F.col("bought") > F.col("instant")) & (
        F.col("bought") <= F.col("instant") + F.expr(f"INTERVAL {horizon_seconds} SECONDS")
    )
    return asked.join(bought, same & within, "leftsemi").select("prediction_id", "instant")


def follow(
    hits: DataFrame, path: str, checkpoint: str
) -> None:
    """Store the hits that are there, and the time up to which windows closed.

    A repeated batch replaces its own hits. Runs on from ``checkpoint``.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch_table(batch, f"{path}/hits", batch_id)

    query = drain(hits, write, checkpoint)
    reached = [p["eventTime"].get("watermark") for p in query.recentProgress]
    reached = max((r for r in reached if r), default=None)
    if reached is not None:
        mark = hits.sparkSession.range(1).select(F.lit(reached).alias("watermark"))
        mark.write.mode("append").parquet(f"{path}/closed")


def closed_until(spark: SparkSession, path: str):
    """The watermark the stream has reached; None before the first batch."""
    if not table_exists(spark, f"{path}/closed"):
        return None
    marks = spark.read.schema("watermark string").parquet(f"{path}/closed")
    time = F.to_timestamp("watermark").cast("timestamp_ntz")
    return marks.agg(F.max(time)).first()[0]


def settled(
    predictions: DataFrame, path: str, horizon_seconds: int = C.HORIZON_SECONDS
) -> DataFrame:
    """The predictions with their outcome, as far as the stream has come.

    Open windows have NULL in all three columns, also where a purchase is known
    already: the outcome is filled when the window closes.
    """
    spark = predictions.sparkSession
    until = closed_until(spark, path)
    hits = spark.read.schema("prediction_id string, instant timestamp").parquet(f"{path}/hits")
    found = hits.select("prediction_id").distinct().withColumn("_hit", F.lit(1))
    end = S.epoch_micros(monitoring.prediction_instant()) + horizon_seconds * C.MICROS
    known = F.col("evaluation_mode").isin(
        monitoring.REPLAY_MODE, monitoring.BACKFILL_MODE
    )
    closed = F.lit(False)
    if until is not None:
        closed = known & F.col(SESSION).isNotNull() & (end <= S.epoch_micros(F.lit(until)))
    kept = [c for c in predictions.columns if c not in monitoring.OUTCOME]
    actual = F.when(closed, F.coalesce("_hit", F.lit(0)))
    truth = F.timestamp_micros(F.when(closed, end)).cast("timestamp_ntz")
    guess = (F.col("purchase_probability") >= 0.5).cast("int")
    return (
        predictions.join(found, "prediction_id", "left")
        .select(*kept, actual.alias("actual_purchase"), truth.alias("ground_truth_time"))
        .withColumn("is_correct_prediction", F.col("actual_purchase") == guess)
    )
