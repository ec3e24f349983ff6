"""Parquet scans with the checks the layers ask for."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas


def read_table(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """File, folder or glob; a missing path is an error."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"no parquet at {path}") from error
        raise


def stored_order() -> list[Column]:
    """Position of a row in a parquet table: file, then row number."""
    return [F.col("_metadata.file_path"), F.col("_metadata.row_index")]


def with_stored_order(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """Carry the stored position as columns, for first-survivor rules."""
    names = ["_file", "_position"]
    columns = {name: c for name, c in zip(names, stored_order())}
    return df.withColumns(columns), names


def read_gold(spark: SparkSession, path: str, split: str) -> DataFrame:
    return read_table(spark, f"{path.rstrip('/')}/split={split}", schemas.GOLD)


def read_gold_splits(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """All three splits; an empty one is an error."""
    frames = {split: read_gold(spark, path, split) for split in C.SPLITS}
    for split, frame in frames.items():
        if frame.isEmpty():
            raise ValueError(f"gold split {split} is empty")
    return frames
