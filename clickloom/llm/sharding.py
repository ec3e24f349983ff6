"""Shards behind a fixed number of virtual slots.

A record's slot is a hash of its id. A slot-to-shard map, stored with a
version, says where each slot lies; rebalancing edits the map by moving whole
slots, so records keep their slot for ever and only moved slots are copied.
"""

from __future__ import annotations

from bisect import bisect_left, insort

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import keyed_texts
from clickloom.session import scratch_path

SLOTS = 4096
SHARDS = 8
MAP_SCHEMA = "virtual_slot int, shard int"


def virtual_slot(doc_id: Column, slots: int = SLOTS) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(slots)).cast("int")


def first_map(shards: int = SHARDS, slots: int = SLOTS) -> list[int]:
    """Version 0: slots dealt in turn."""
    return [slot % shards for slot in range(slots)]


def rebalance(shard_of: list[int], weights: list[int], shards: int) -> list[int]:
    """The map with as few slots moved as bring the shards' weights together.

    A slot goes from the heaviest to the lightest shard, the one whose weight
    is nearest to half of their difference, as long as that narrows it.
    ``shards`` may be larger or smaller than before; slots of shards that are
    gone move first. Ties fall to the smaller slot and shard.
    """
    edited = list(shard_of)
    totals = [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]
    homeless = []
    for slot, shard in enumerate(edited):
        if shard < shards:
            totals[shard] += weights[slot]
            insort(held[shard], (weights[slot], slot))
        else:
            homeless.append((weights[slot], slot))
    for weight, slot in sorted(homeless, reverse=True):
        to = totals.index(min(totals))
        edited[slot], totals[to] = to, totals[to] + weight
        insort(held[to], (weight, slot))
    for _ in range(4 * len(edited)):
        a, b = totals.index(max(totals)), totals.index(min(totals))
        gap = totals[a] - totals[b]
        at = bisect_left(held[a], (gap // 2, -1))
        near = [x for x in held[a][max(0, at - 1) : at + 1] if 0 < x[0] < gap]
        if not near:
            break
        weight, slot = min(near, key=lambda x: (abs(2 * x[0] - gap), x[1]))
        held[a].remove((weight, slot))
        insort(held[b], (weight, slot))
        totals[a], totals[b], edited[slot] = totals[a] - weight, totals[b] + weight, b
    return edited


def write_map(spark: SparkSession, folder: str, version: int, shard_of: list[int]) -> None:
    """One small table per version; a version is never written twice."""
    rows = spark.createDataFrame(list(enumerate(shard_of)), MAP_SCHEMA)
    rows.coalesce(1).write.parquet(f"{folder}/version={version}")


def read_map(spark: SparkSession, folder: str, version: int) -> DataFrame:
    return spark.read.schema(MAP_SCHEMA).parquet(f"{folder}/version={version}")


def slot_weights(sized: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows per slot: at most ``slots`` rows reach the driver."""
    found = sized.groupBy("virtual_slot").agg(
        F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")
    )
    weights, counts = [0] * slots, [0] * slots
    for row in found.collect():
        weights[row["virtual_slot"]] = row["size"]
        counts[row["virtual_slot"]] = row["n"]
    return weights, counts


def shard_documents(
    docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, folder: str | None = None
) -> DataFrame:
    """Every row's shard and its place there, by bytes.

    Two maps are written to ``folder``: version 0, and version 1 edited for the
    bytes found. Only ids and sizes are shuffled, by slot; a row's place is the
    number of rows in the shard's earlier slots plus its rank within its slot.

    Null texts have size 1, null ids share a slot, repeated rows are kept (they
    share a slot and get places of their own), an empty table gives no rows,
    and other columns are ignored.
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "slot-map")
    sized = keyed_texts(docs).select(
        "doc_id",
        (F.octet_length("text") + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        virtual_slot(F.col("doc_id"), slots).alias("virtual_slot"),
    )
    weights, counts = slot_weights(sized.select("virtual_slot", "size"), slots)
    write_map(spark, folder, 0, first_map(shards, slots))
    write_map(spark, folder, 1, rebalance(first_map(shards, slots), weights, shards))
    ahead, places = [0] * shards, []
    for row in sorted(read_map(spark, folder, 1).collect()):
        places.append((row["virtual_slot"], row["shard"], ahead[row["shard"]]))
        ahead[row["shard"]] += counts[row["virtual_slot"]]
    places = spark.createDataFrame(places, "virtual_slot int, shard int, ahead long")
    rank = F.row_number().over(
        Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size")
    )
    placed = sized.withColumn("rank", rank).join(F.broadcast(places), "virtual_slot")
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("ahead") + F.col("rank") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )
