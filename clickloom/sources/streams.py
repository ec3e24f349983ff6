"""Streaming sources of replay events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import schemas

# Rows of one trigger are bounded, and with them what one key gets at a time.
OFFSETS_PER_TRIGGER = 2_000_000
BYTES_PER_TRIGGER = 2 << 30


def topic_events(
    spark: SparkSession,
    servers: str,
    topic: str,
    offsets_per_trigger: int = OFFSETS_PER_TRIGGER,
) -> DataFrame:
    """Events of a Kafka topic from the earliest offset, with arrival order."""
    messages = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", offsets_per_trigger)
        .load()
    )
    return decode(messages.withColumn("arrival", F.col("offset")))


def decode(messages: DataFrame, schema: T.StructType = schemas.REPLAY_EVENT):
    """JSON values to event columns; unreadable text becomes a NULL event."""
    text = F.col("value").cast("string")
    parsed = messages.withColumn("_event", F.from_json(text, schema))
    extra = [c for c in ("arrival",) if c in messages.columns]
    return parsed.select("_event.*", *extra, text.alias("_text"))


def readable(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("event_id").isNotNull()).drop("_text")


def dead_letters(decoded: DataFrame) -> DataFrame:
    """Messages that hold no event, as text with a reason."""
    broken = decoded.filter(F.col("event_id").isNull())
    return broken.select(
        F.col("_text").alias("value"), F.lit("unreadable_event").alias("reason")
    )


def file_events(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    form: str = "parquet",
    files_per_trigger: int | None = None,
    bytes_per_trigger: int = BYTES_PER_TRIGGER,
) -> DataFrame:
    """Files that appear in a folder, a bounded number or size per trigger.

    Spark takes one of the two bounds: without a number of files, the bytes.
    """
    reader = spark.readStream.schema(schema).format(form)
    if files_per_trigger is None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    else:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)
