"""Monthly raw CSV files: selection by name, typed scan, header audit."""

from __future__ import annotations

import csv
import re
from collections import defaultdict
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom import constants as C
from clickloom import schemas

# Raw file names carry the year, the month name and a free suffix.
FILE_PATTERN = r"^(\d{4})-([A-Za-z]{3})(-.*)?\.csv(\.gz)?$"
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()

# Order columns a raw scan can carry into bronze.
ORDER = ("raw_month", "raw_file", "raw_block", "raw_row")
HEAD_ROWS = 100_000


def month_number(text: str) -> int:
    """``YYYY-MM`` as year * 100 + month."""
    match = re.fullmatch(r"(\d+)-(\d+)", text)
    if not match or not 1 <= int(match[2]) <= 12:
        raise ValueError(f"not a month: {text!r}, write YYYY-MM")
    return int(match[1]) * 100 + int(match[2])


def window_bounds(
    profile: str | None = None, start: str | None = None, end: str | None = None
) -> tuple[int, int] | None:
    """Inclusive month bounds; None selects every supported file."""
    if bool(start) != bool(end):
        raise ValueError("give both ends of the window or neither")
    if not start:
        name = (profile or "training").lower()
        if name not in C.WINDOW_PROFILES:
            known = ", ".join(sorted(C.WINDOW_PROFILES))
            raise ValueError(f"unknown window profile {name!r}, known: {known}")
        if C.WINDOW_PROFILES[name] is None:
            return None
        start, end = C.WINDOW_PROFILES[name]
    bounds = month_number(start), month_number(end)
    if bounds[0] > bounds[1]:
        raise ValueError(f"window ends before it starts: {start} to {end}")
    return bounds


def with_month(files: DataFrame, name: str = "name") -> DataFrame:
    """Add ``month`` (year * 100 + month) from the file name, else NULL."""
    year = F.regexp_extract(name, FILE_PATTERN, 1)
    word = F.lower(F.regexp_extract(name, FILE_PATTERN, 2))
    months = F.array(*[F.lit(m) for m in MONTHS])
    position = F.array_position(months, word)
    number = F.try_add(year.try_cast("int") * 100, position.cast("int"))
    return files.withColumn("month", F.when(position > 0, number))


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, name, length, modified)`` of the files in a folder.

    The binary source lists files; the content column is pruned, not read.
    """
    try:
        listed = spark.read.format("binaryFile").load(folder)
    except AnalysisException as error:
        raise FileNotFoundError(f"no such folder: {folder}") from error
    return listed.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        "length",
        F.col("modificationTime").alias("modified"),
    )


def select_files(
    spark: SparkSession,
    folder: str,
    profile: str | None = None,
    start: str | None = None,
    end: str | None = None,
) -> DataFrame:
    """Supported files of the window, ordered by month and name."""
    bounds = window_bounds(profile, start, end)
    files = with_month(list_files(spark, folder)).filter(F.col("month").isNotNull())
    if bounds is not None:
        files = files.filter(F.col("month").between(*bounds))
    return files.orderBy("month", "name")


def forbid_replay_source(folder: str, replay: str) -> None:
    """Training must not read the replay file, its folder or below it."""

    def parts(path):
        return [p for p in unquote(urlparse(path).path).split("/") if p not in ("", ".")]

    target, source = parts(folder), parts(replay)
    home = source[:-1]
    if target == source or target[: len(home)] == home:
        raise ValueError(f"training input {folder} belongs to the replay source")


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first line with text of a split, if the split starts its file. The
    rest of the split is never asked for."""
    for batch in batches:
        if batch.num_rows and batch.column(1)[0].as_py():
            return
        for at, line in enumerate(batch.column(2).to_pylist()):
            if line.strip():
                yield batch.slice(at, 1).select([0, 2])
                return


@contextmanager
def _one_split_a_task(spark: SparkSession) -> Iterator[None]:
    """Splits are not packed together while a job of the block is planned."""
    name = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, spark.conf.get("spark.sql.files.maxPartitionBytes"))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def header_columns(spark: SparkSession, paths: list[str]) -> dict[str, list[str]]:
    """Column names of every file, in the order of ``paths``, in one job.

    A task reads the start of one split, so neither the number nor the size of
    the files makes it long. Files without a line have no columns.
    """
    lines = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
    )
    with _one_split_a_task(spark):
        found = lines.mapInArrow(_first_lines, "path string, value string").collect()
    by_path = {unquote(urlparse(r["path"]).path): r["value"] for r in found}
    return {path: _names(by_path.get(unquote(urlparse(path).path))) for path in paths}


def _names(line: str | None) -> list[str]:
    if line is None:
        return []
    return next(csv.reader([line.removeprefix("\ufeff")]))


def read_files(spark: SparkSession, paths: list[str], ordered: bool = False):
    """Typed scan by header name; an unreadable price fails the read.

    Files that share a header are one scan. gzip files cannot be split, so
    their rows are spread before anything else runs on them.
    """
    by_header = defaultdict(list)
    for path, header in header_columns(spark, paths).items():
        by_header[tuple(header)].append(path)
    scans = [_scan(spark, h, group, ordered) for h, group in by_header.items()]
    return reduce(DataFrame.unionByName, scans)


def _scan(spark, header, paths, ordered):
    for name in schemas.RAW.names:
        if name not in header:
            raise ValueError(f"missing: {name}")
    layout = T.StructType(
        [
            T.StructField(n, schemas.RAW[n].dataType if n in schemas.RAW.names
                          else T.StringType())
            for n in header
        ]
    )
    reader = spark.read.schema(layout).option("header", True).option("mode", "FAILFAST")
    rows = reader.csv(paths)
    columns = [F.col(n) for n in schemas.RAW.names]
    if ordered:
        rows = with_month(rows.withColumn("raw_file", F.col("_metadata.file_name")),
                          "raw_file")
        columns += [
            F.col("month").alias("raw_month"),
            F.col("raw_file"),
            F.col("_metadata.file_block_start").alias("raw_block"),
            F.monotonically_increasing_id().alias("raw_row"),
        ]
    rows = rows.select(*columns)
    if any(path.endswith(".gz") for path in paths):
        spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(spread)
    return rows


def read_window(
    spark: SparkSession,
    folder: str,
    profile: str | None = None,
    start: str | None = None,
    end: str | None = None,
    ordered: bool = False,
    replay: str | None = None,
) -> DataFrame:
    """Raw rows of the selected months.

    With ``ordered`` the rows carry month, file, split offset and a number that
    grows inside a split; together they give the position in the input.
    """
    if replay is not None:
        forbid_replay_source(folder, replay)
    paths = [r["path"] for r in select_files(spark, folder, profile, start, end)
             .select("path").collect()]
    if not paths:
        raise FileNotFoundError(f"{folder} holds no raw file of the window")
    return read_files(spark, paths, ordered)


def first_rows(
    spark: SparkSession, path: str, rows: int, most: int = HEAD_ROWS
) -> DataFrame:
    """The first rows of a raw file in file order (the replay feature).

    Up to ``most`` rows are taken split by split until there are enough, so the
    rest of the file is not read; they pass the driver. More rows, and gzip
    files, are found by their position in the whole file.
    """
    ordered = read_files(spark, [path], ordered=True)
    if rows <= most and not path.endswith(".gz"):
        taken = ordered.take(rows)
        blocks = [r["raw_block"] for r in taken]
        if blocks == sorted(blocks):
            return spark.createDataFrame(taken, ordered.schema).drop(*ORDER)
    return ordered.orderBy("raw_block", "raw_row").limit(rows).drop(*ORDER)


def audit_headers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Per file: column count, extra and missing columns, order match."""
    headers = [
        (path.rsplit("/", 1)[-1], columns)
        for path, columns in header_columns(spark, paths).items()
    ]
    found = spark.createDataFrame(headers, "file string, columns array<string>")
    declared = F.array(*[F.lit(n) for n in schemas.RAW.names])
    columns = F.col("columns")
    known = F.filter(columns, lambda c: F.array_contains(declared, c))
    missing = F.array_sort(F.array_except(declared, columns))
    return found.select(
        "file",
        F.size(columns).alias("column_count"),
        (F.size(missing) == 0).alias("complete"),
        F.array_sort(F.array_except(columns, declared)).alias("extra"),
        missing.alias("missing"),
        (known == declared).alias("in_order"),
    )
