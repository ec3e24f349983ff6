"""The layer jobs: raw, bronze, silver, split map, gold, model frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas
from clickloom.functions import scalars as S
from clickloom.operators import cleaning, dedup, encoding, gold, splits
from clickloom.session import cut_lineage
from clickloom.sinks import tables as sinks
from clickloom.sources import raw_csv
from clickloom.sources import tables as sources


def ingest(
    spark: SparkSession,
    raw_folder: str,
    bronze_path: str,
    profile: str | None = None,
    start: str | None = None,
    end: str | None = None,
    replay: str | None = None,
    keep_order: bool = True,
) -> dict[str, int]:
    """Raw CSV months to a bronze table; returns the stage counters.

    Counters ride on the last stage of the writing job, so a repeated task is not
    counted twice. ``keep_order`` also stores the position
    of each row in the input, which the first-survivor rule needs.
    """
    raw = raw_csv.read_window(
        spark, raw_folder, profile, start, end, ordered=keep_order, replay=replay
    )
    watched, watch = cleaning.observed(
        raw,
        "ingest",
        input_rows=F.count(F.lit(1)),
        rejected_rows=F.count_if(~cleaning.allowed_type()),
    )
    carry = raw_csv.ORDER if keep_order else ()
    written = sinks.write_bronze(cleaning.to_bronze(watched, *carry), bronze_path)
    return {**watch.get, "output_rows": written}


def input_order(bronze: DataFrame) -> tuple[DataFrame, list[str]]:
    if set(raw_csv.ORDER) <= set(bronze.columns):
        return bronze, list(raw_csv.ORDER)
    return sources.with_stored_order(bronze)


def silver_events(
    bronze: DataFrame, order: list[str], policy: str = "keep"
) -> DataFrame:
    """Clean rows, first survivor per event key, in the silver layout."""
    clean = cleaning.clean(bronze, policy)
    first = dedup.keep_first(clean, [F.col(c) for c in order])
    return first.select(*schemas.SILVER.names)


def refine(spark: SparkSession, bronze_path: str, silver_path: str) -> dict[str, int]:
    """Bronze table to silver table, sorted on the event key.

    The reject counters are an aggregate of their own: counters that ride below
    a shuffle would count a re-run map task twice.
    """
    bronze, order = input_order(sources.read_table(spark, bronze_path))
    written = sinks.write_silver(silver_events(bronze, order), silver_path)
    counts = cleaning.clean_counts(bronze).first()
    return {
        "input_rows": counts["input_rows"],
        "rejected_rows": counts["input_rows"] - counts["valid_rows"],
        "duplicate_rows": counts["valid_rows"] - written,
        "output_rows": written,
    }


def assign_splits(
    spark: SparkSession,
    silver_path: str,
    map_path: str,
    cutoff: str | None = C.SESSION_CUTOFF,
) -> int:
    """Silver table to a split map sorted by session."""
    silver = sources.read_table(spark, silver_path)
    return sinks.write_split_map(splits.split_sessions(silver, cutoff), map_path)


def build_gold(
    spark: SparkSession,
    silver_path: str,
    map_path: str,
    gold_path: str,
    horizon_seconds: int = C.HORIZON_SECONDS,
    cutoff: str | None = C.SESSION_CUTOFF,
) -> dict[str, int]:
    """Silver and split map to gold snapshots, one folder per split."""
    silver = sources.read_table(spark, silver_path, schemas.SILVER)
    split_map = sources.read_table(spark, map_path, schemas.SPLIT_MAP)
    rows = gold.gold(silver, split_map, horizon_seconds, cutoff)
    return sinks.write_gold(rows, gold_path)


def model_inputs(splits_by_name: dict[str, DataFrame]):
    """Encoded frames of all splits and the train-fitted vocabulary."""
    vocabulary = encoding.fit_vocabulary(splits_by_name["train"])
    frames = {
        name: encoding.encode(encoding.model_frame(frame), vocabulary)
        for name, frame in splits_by_name.items()
    }
    return frames, vocabulary


def retrain_raw(log: DataFrame, as_of: str, days: int = C.RETRAIN_DAYS) -> DataFrame:
    """The last days of the replay log in the raw layout."""
    time = S.parse_iso(F.col("source_event_time").cast("string"))
    end = F.lit(as_of).cast("timestamp_ntz")
    window = (time > end - F.expr(f"INTERVAL {int(days)} DAYS")) & (time <= end)
    recent = log.filter(window)
    return recent.select(
        S.format_utc_text(time).alias("event_time"),
        *[n for n in schemas.RAW.names if n != "event_time"],
    )


def retrain_events(log: DataFrame, as_of: str, days: int = C.RETRAIN_DAYS) -> DataFrame:
    """The last days of the replay log, typed, with fractions of seconds.

    A log in date folders is pruned to the folders the window touches.
    """
    end = F.lit(as_of).cast("timestamp_ntz")
    first = end - F.expr(f"INTERVAL {int(days)} DAYS")
    if "event_date" in log.columns:
        log = log.filter(F.col("event_date").between(F.to_date(first), F.to_date(end)))
    time = F.col("source_event_time")
    if dict(log.dtypes)["source_event_time"] == "string":
        time = S.parse_iso(time)
    typed = log.withColumn("source_event_time", time.cast("timestamp_ntz"))
    recent = (F.col("source_event_time") > first) & (F.col("source_event_time") <= end)
    return typed.filter(recent).select(*schemas.SILVER.names)


def retrain_gold(
    log: DataFrame,
    as_of: str,
    days: int = C.RETRAIN_DAYS,
    horizon_seconds: int = C.HORIZON_SECONDS,
) -> tuple[DataFrame, DataFrame]:
    """Gold rows and a new split map from the retraining window.

    The log holds one row per event id, and an id names one event key, so
    ordering by the id leaves nothing to chance. The cleaned window is stored
    once: the split map and the gold rows both read it.
    """
    recent = retrain_events(log, as_of, days)
    silver = cut_lineage(silver_events(recent, list(C.EVENT_KEY)))
    split_map = splits.split_sessions(silver, cutoff=None)
    return gold.gold(silver, split_map, horizon_seconds, cutoff=None), split_map
