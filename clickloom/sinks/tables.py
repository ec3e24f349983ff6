"""Batch sinks of the layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas
from clickloom.functions import scalars as S
from clickloom.operators.cleaning import observed

def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> int:
    """Snappy parquet; returns the rows written, counted by the writing job.

    An empty frame still leaves a readable table with its schema.
    """
    watched, watch = observed(df, "written", rows=F.count(F.lit(1)))
    try:
        watched.write.mode(mode).option("compression", "snappy").parquet(path)
    except AnalysisException as error:
        if "PATH_ALREADY_EXISTS" in str(error):
            raise FileExistsError(f"{path} already holds a table") from error
        raise
    return watch.get["rows"]


def write_bronze(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    return write_table(df, path, mode)


def write_silver(df: DataFrame, path: str) -> int:
    """Rows in canonical order; an existing table is an error."""
    ordered = schemas.conform(df, schemas.SILVER).orderBy(*C.EVENT_KEY)
    return write_table(ordered, path)


def write_split_map(split_map: DataFrame, path: str, mode: str = "overwrite") -> int:
    ordered = schemas.conform(split_map, schemas.SPLIT_MAP).orderBy("user_session")
    return write_table(ordered, path, mode)


def write_gold(gold: DataFrame, path: str) -> dict[str, int]:
    """One pass into ``split=train|val|test``; an empty split still exists."""
    counts = {s: F.count_if(F.col("split") == s) for s in C.SPLITS}
    watched, watch = observed(gold, "gold", **counts)
    watched.write.partitionBy("split").mode("errorifexists").parquet(path)
    written = watch.get
    empty = gold.sparkSession.createDataFrame([], schemas.GOLD)
    for split in C.SPLITS:
        if not written[split]:
            empty.write.mode("overwrite").parquet(f"{path}/split={split}")
    return written


def write_slices(df: DataFrame, label: str, path: str) -> None:
    """CSV with header, one folder per time slice; unlabelled rows are left out."""
    labelled = df.filter(F.col(label).isNotNull())
    labelled.write.partitionBy(label).option("header", True).csv(path)


def to_messages(events: DataFrame, key: str = "user_session") -> DataFrame:
    """Key and JSON value of every event; NULL fields stay, times are ISO text."""
    fields = [
        S.iso_text(F.col(name)).alias(name) if kind == "timestamp_ntz" else F.col(name)
        for name, kind in events.dtypes
    ]
    value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
    return events.select(F.col(key).alias("key"), value.alias("value"))


def publish(events: DataFrame, form: str, **options: str) -> int:
    """Write keyed messages to a topic (or a file sink); returns their number."""
    messages = to_messages(events)
    watched, watch = observed(messages, "published", rows=F.count(F.lit(1)))
    watched.write.format(form).options(**options).mode("append").save()
    return watch.get["rows"]


def write_report(report: DataFrame, path: str) -> None:
    """One-row JSON report with its fields in name order."""
    report.select(*sorted(report.columns)).coalesce(1).write.mode("overwrite").json(path)
