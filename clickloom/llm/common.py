"""What the corpus operators share: inputs, folds and batch sizes."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DOCUMENT = ("doc_id", "text", "lang", "source", "n_chars")
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id is in part 0."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % parts


def keyed_texts(docs: DataFrame, *more: Column) -> DataFrame:
    """(doc_id, text) with null texts as empty ones, and nothing else."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
        *more,
    )


def bounded(df: DataFrame, rows: int, total: int, *key: Column) -> DataFrame:
    """About 95% of ``rows`` rows of ``total``, by hash of the key; all if fewer.

    Nothing is sorted and no task gathers the rows.
    """
    if total <= rows:
        return df
    share = int(0.95 * rows / total * (1 << 40))
    return df.filter(F.pmod(F.xxhash64(*key), F.lit(1 << 40)) < share)


def hand_back() -> None:
    """Give freed memory of this process back to the machine, as far as it can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def map_batches(
    df: DataFrame, task: Callable[[Iterator[pa.RecordBatch]], Iterator], schema: str
) -> DataFrame:
    """``mapInArrow`` with batches small enough for long texts.

    The two batch limits are session settings that Spark reads when it plans
    the query; larger values are lowered, smaller ones are left.
    """
    conf = df.sparkSession.conf
    for name, most in (
        ("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
        ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES),
    ):
        now = conf.get(name, None)
        if now is None or not now.lstrip("-").isdigit() or not 0 < int(now) <= most:
            conf.set(name, str(most))

    def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Workers are used again: a task hands back the memory it has freed."""
        try:
            yield from task(batches)
        finally:
            hand_back()

    return df.mapInArrow(released, schema)


def sum_matrices(
    rows: DataFrame,
    shape: tuple[int, int],
    add: Callable[[np.ndarray, pa.RecordBatch], None],
) -> np.ndarray:
    """The sum of a matrix that ``add`` fills from batches, one matrix a task.

    A task sends one row per line of its matrix; lines are added up in the order
    of their tasks, as they arrive where they are dealt to. Only the sum, of the
    given shape, reaches the driver.
    """
    height, width = shape

    def lines(places, parts, matrix: np.ndarray) -> pa.RecordBatch:
        ends = np.arange(0, matrix.size + 1, width, dtype=np.int32)
        line = pa.ListArray.from_arrays(pa.array(ends), pa.array(matrix.ravel()))
        numbers = [pa.array(x, pa.int32()) for x in (places, parts)]
        return pa.RecordBatch.from_arrays([*numbers, line], ["d", "part", "line"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                add(total, batch)
        part = TaskContext.get().partitionId()
        yield lines(range(height), [part] * height, total)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            found = batch.column(2).flatten().to_numpy().reshape(-1, width)
            for d, line in zip(batch.column(0).to_pylist(), found, strict=True):
                total[d] = total[d] + line if d in total else line.copy()
        for d in sorted(total):
            yield lines([d], [0], total[d])

    schema = "d int, part int, line array<double>"
    dealt = map_batches(rows, task, schema).repartition("d")
    merged = map_batches(dealt.sortWithinPartitions("d", "part"), merge, schema)
    matrix = np.zeros(shape)
    for line in merged.collect():
        matrix[line["d"]] = line["line"]
    return matrix


class Memo:
    """Two-generation cache: at most ``2 * size`` entries, the used ones stay."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def put(self, key, value):
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value

    def find(self, keys) -> tuple[dict, list]:
        """A dict with the known keys, and the list of unknown ones."""
        known, unknown = {}, []
        young, old = self.young, self.old
        for key in keys:
            value = young.get(key)
            if value is None:
                value = old.get(key)
                if value is None:
                    unknown.append(key)
                    continue
                self.put(key, value)
                young, old = self.young, self.old
            known[key] = value
        return known, unknown
