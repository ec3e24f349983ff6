"""``events`` as a clickstream: row-wise renaming, no rows left out.

Sessions are user weeks. Payments report purchases twice, the second time with
brand ``dup`` and a later input order, so duplicates exist to be removed; some
times, categories and prices are unusable, so the cleaning rules have work.
"""

from __future__ import annotations

from collections import defaultdict

from pyarrow import fs
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import scalars as S
from clickloom.operators import cleaning, dedup, gold, sessions
from clickloom.session import prepare, scratch_path

WEEK_MICROS = 7 * 24 * 3600 * 1_000_000
HORIZON = 6 * 3600
CSV_FILES = 8
PIECE_ROWS = 250_000
BLOCK_BYTES = 4 << 20
CUTOFF = "2024-01-25T00:00:00"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/events.parquet")


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw text rows plus ``input_order``."""
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    week = F.floor(S.epoch_micros(F.col("ts")) / F.lit(WEEK_MICROS))
    kind = F.col("event_type")
    time = F.when(k == 77, "not a time").otherwise(S.format_utc_text(F.col("ts")))
    price = F.when(F.col("value") < 1, F.lit(0.0)).when(
        F.col("value") <= 200, F.col("value")
    )
    shaped = events(spark, sf_dir).select(
        time.alias("event_time"),
        F.when(kind == "click", "cart")
        .when(kind == "error", "remove_from_cart")
        .otherwise(kind)
        .alias("event_type"),
        F.concat(F.lit("p"), k).alias("product_id"),
        F.when(k != 13, F.concat(F.lit("c"), k % 10)).alias("category_id"),
        F.concat(F.lit("u"), "user_id").alias("user_id"),
        F.concat(F.lit("u"), "user_id", F.lit("-w"), week).alias("user_session"),
        F.when(k % 3 != 0, F.concat(F.lit("cat."), k % 7)).alias("category_code"),
        F.when(k % 4 != 0, F.concat(F.lit("brand-"), k % 5)).alias("brand"),
        price.alias("price"),
        (F.col("event_id") * 2).alias("input_order"),
    )
    again = shaped.filter(F.col("event_type") == "purchase").withColumns(
        {"brand": F.lit("dup"), "input_order": F.col("input_order") + 1}
    )
    return shaped.unionByName(again)


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.to_bronze(raw(spark, sf_dir), "input_order")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaning.clean(bronze(spark, sf_dir))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = dedup.keep_first(clean(spark, sf_dir), [F.col("input_order")])
    return first.select(*schemas.SILVER.names)


def snapshots(spark: SparkSession, sf_dir: str, horizon: int = HORIZON) -> DataFrame:
    return gold.snapshots(silver(spark, sf_dir), horizon, sizes=sizes(spark, sf_dir))


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows per session: an upper bound of the silver rows, and cheap."""
    return sessions.session_sizes(raw(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold rows with a score computed from the features."""
    signal = (
        F.col("total_views")
        + 2 * F.col("total_carts")
        + 3 * F.col("unique_products")
        + F.coalesce("price", F.lit(0.0)) / F.lit(10.0)
    )
    return snapshots(spark, sf_dir).withColumn("score", signal / (signal + 25.0))


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction log: one prediction per event, two evaluation modes."""
    late = F.length("product_id") * F.expr("INTERVAL 1 SECOND")
    first = F.col("unique_products") == 0
    return scored(spark, sf_dir).select(
        S.event_id(
            F.col("user_session"),
            S.iso_text(F.col("source_event_time")),
            F.col("event_type"),
            F.col("product_id"),
            F.col("user_id"),
        ).alias("prediction_id"),
        "user_session",
        (F.col("source_event_time") + late).alias("prediction_time"),
        F.col("score").alias("purchase_probability"),
        F.when(first, "fallback").otherwise("model").alias("prediction_mode"),
        F.when(F.col("event_type") == "view", "demo_replay")
        .otherwise("offline_backfill")
        .alias("evaluation_mode"),
        "source_event_time",
        (F.col("source_event_time") + F.expr("INTERVAL 2 SECONDS")).alias(
            "replay_time"
        ),
    )


def replayed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver events as the stream saw them, two seconds after they happened."""
    shifted = F.col("source_event_time") + F.expr("INTERVAL 2 SECONDS")
    return silver(spark, sf_dir).withColumn("replay_time", shifted)


def monthly_csv(spark: SparkSession, sf_dir: str, rows_per_piece: int = PIECE_ROWS) -> str:
    """Write the raw rows as month-named CSV files and return the folder.

    A row's file is its input order modulo ``CSV_FILES``; rows of a file are in
    input order. The files are as long as the table, so they are sorted and
    written in pieces of about ``rows_per_piece`` rows, which are then put
    together byte by byte.
    """
    part = F.pmod("input_order", F.lit(CSV_FILES)).alias("part")
    rows = raw(spark, sf_dir).select(*schemas.RAW.names, "input_order", part)
    pieces = max(CSV_FILES, -(-rows.count() // rows_per_piece))
    rows = rows.repartitionByRange(pieces, "part", "input_order")
    rows = rows.sortWithinPartitions("part", "input_order").drop("input_order")
    staged, folder = scratch_path(spark, "staged"), scratch_path(spark, "raw")
    rows.write.partitionBy("part").option("header", False).csv(staged)
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path
    system = path(staged).getFileSystem(conf)
    system.mkdirs(path(folder))
    root = system.makeQualified(path(folder)).toString()
    found = defaultdict(list)
    for status in system.globStatus(path(f"{staged}/part=*/part-*.csv")) or ():
        number = int(status.getPath().getParent().getName().removeprefix("part="))
        found[number].append(status.getPath().toString())
    files = [
        (f"{root}/2024-Jan-{number:05d}.csv", sorted(names))
        for number, names in found.items()
    ]
    if files:  # names of pieces begin with the number of their range
        listed = spark.createDataFrame(files, "target string, pieces array<string>")
        listed.repartition(len(files), "target").foreach(_join_pieces)
    return folder


def _join_pieces(file: Row) -> None:
    """The header line and the pieces of a file, a block at a time."""
    system, target = fs.FileSystem.from_uri(file["target"])
    with system.open_output_stream(target) as out:
        out.write(f"{','.join(schemas.RAW.names)}\n".encode())
        for name in file["pieces"]:
            with system.open_input_stream(fs.FileSystem.from_uri(name)[1]) as piece:
                while block := piece.read(BLOCK_BYTES):
                    out.write(block)
