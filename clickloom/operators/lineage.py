"""Manifest hash and row counts of stored inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.sources.tables import read_gold, read_table


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row: md5 over sorted ``path|size|mtime`` lines, and the file count.

    Only file metadata is read; the binary source prunes the content.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length", F.unix_micros("modificationTime").alias("modified"))
    )
    root = path.rstrip("/") + "/"
    start = F.instr("path", root)
    below = F.substr(F.col("path"), start + F.lit(len(root)))
    inner = F.when(start > 0, below).otherwise(F.col("path"))
    line = F.concat_ws("|", inner, F.col("length"), F.col("modified"))
    lines = F.sort_array(F.collect_list(F.concat(line, F.lit("\n"))))
    return files.agg(
        F.md5(F.concat_ws("", lines).cast("binary")).alias("manifest_hash"),
        F.count(F.lit(1)).alias("file_count"),
    )


def training_lineage(
    spark: SparkSession,
    gold_path: str,
    split_map_path: str,
    window_start: str | None = None,
    window_end: str | None = None,
    revision: str | None = None,
) -> DataFrame:
    """One row of input facts of a training run."""
    record = manifest(spark, gold_path).withColumns(
        {
            "window_start_utc": F.lit(window_start or ""),
            "window_end_utc": F.lit(window_end or ""),
            "data_revision": F.lit(revision or ""),
            "gold_path": F.lit(gold_path),
            "split_map_path": F.lit(split_map_path),
            "recorded_at": F.current_timestamp(),
        }
    )
    for split in C.SPLITS:
        rows = read_gold(spark, gold_path, split).count()
        record = record.withColumn(f"rows_{split}", F.lit(rows))
    sessions = read_table(spark, split_map_path).count()
    return record.withColumn("rows_split_map", F.lit(sessions))
