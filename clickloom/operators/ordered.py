"""Running sums, row numbers and exact quantiles without one-task sorts.

A window whose key holds very many rows would put them all in one task. Here
such a key is cut into ordered range partitions: local running sums inside each
one, plus the totals of the earlier ones (at most one row per key and
partition). Keys whose size was checked to be small take the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom.session import cut_lineage

TASK_ROWS = 1_000_000
CHUNK = "_chunk"
PLACE_BITS = 33  # of ``monotonically_increasing_id``


def null_safe_join(left: DataFrame, right: DataFrame, keys, how: str = "inner"):
    """Join on keys that may be NULL; the keys of ``left`` are kept."""
    renamed = right.withColumnsRenamed({key: f"_right_{key}" for key in keys})
    match = [F.col(key).eqNullSafe(F.col(f"_right_{key}")) for key in keys]
    joined = left.join(renamed, match, how)
    return joined.drop(*[f"_right_{key}" for key in keys])


def range_chunks(df: DataFrame, order: Sequence) -> DataFrame:
    """Number balanced, ordered range partitions in a stored column.

    The result is stored because a second run could sample other bounds.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = df.repartitionByRange(parts, *order)
    return cut_lineage(spread.withColumn(CHUNK, F.spark_partition_id()))


def largest_group(df: DataFrame, keys: Sequence[str]) -> int:
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.agg(F.max("rows").alias("rows")).first()["rows"] or 0


def running_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    sums: dict[str, str],
    limit: int = TASK_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Add inclusive running sums of columns, and their totals, per key.

    ``sums`` maps a new column to the summed one; ``<new>_total`` is the sum
    over the whole key. NULL is a key like any other; ``order`` should be total.
    ``largest`` is a proven bound of the rows of one key; without it the rows
    are stored and counted.
    """
    keys = list(keys)
    if largest is not None and largest <= limit:
        return _plain_sums(df, keys, order, sums)
    stored = cut_lineage(df)
    if largest_group(stored, keys) <= limit:
        return _plain_sums(stored, keys, order, sums)
    return _chunked_sums(stored, keys, order, sums)


def _plain_sums(df, keys, order, sums):
    upto = Window.partitionBy(*keys).orderBy(*order)
    upto = upto.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    return df.select(
        "*",
        *[F.sum(c).over(upto).alias(name) for name, c in sums.items()],
        *[F.sum(c).over(whole).alias(f"{name}_total") for name, c in sums.items()],
    )


def _chunked_sums(df, keys, order, sums):
    chunked = range_chunks(df, [*keys, *order])
    totals = chunked.groupBy(*keys, CHUNK).agg(
        *[F.sum(c).alias(f"_sum_{name}") for name, c in sums.items()]
    )
    earlier = Window.partitionBy(*keys).orderBy(CHUNK)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys,
        CHUNK,
        *[
            F.coalesce(F.sum(f"_sum_{name}").over(earlier), F.lit(0)).alias(
                f"_before_{name}"
            )
            for name in sums
        ],
        *[F.sum(f"_sum_{name}").over(whole).alias(f"{name}_total") for name in sums],
    )
    local = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    local = local.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = chunked.select(
        "*", *[F.sum(c).over(local).alias(f"_local_{name}") for name, c in sums.items()]
    )
    joined = null_safe_join(inside, offsets, [*keys, CHUNK])
    return joined.select(
        *df.columns,
        *[
            (F.col(f"_local_{name}") + F.col(f"_before_{name}")).alias(name)
            for name in sums
        ],
        *[f"{name}_total" for name in sums],
    )


def dense_index(
    df: DataFrame,
    order: Sequence,
    name: str,
    keys: Sequence[str] = (),
    limit: int = TASK_ROWS,
) -> DataFrame:
    """Add the 0-based position in ``order`` per key and ``<name>_total`` rows."""
    largest = None
    if not keys:
        df = cut_lineage(df)
        largest = df.count()
        if largest > limit:
            return _ranged_index(df, order, name, largest)
    ones = df.withColumn("_one", F.lit(1).cast("long"))
    counted = running_sums(ones, keys, order, {name: "_one"}, limit, largest)
    return counted.withColumn(name, F.col(name) - 1).drop("_one")


def _ranged_index(df, order, name, rows):
    """Positions from one range shuffle: rows are numbered where they lie sorted.

    A number holds its partition's in the bits above ``PLACE_BITS``; a row per
    partition says how many rows lie before it.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    placed = cut_lineage(ranged.withColumn(CHUNK, F.monotonically_increasing_id()))
    chunk = F.shiftright(CHUNK, PLACE_BITS)
    sizes = placed.groupBy(chunk.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
    upto = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_before")
    offsets = F.broadcast(cut_lineage(sizes.select("_part", before)))
    place = F.col(CHUNK) - F.shiftleft("_part", PLACE_BITS) + F.col("_before")
    return placed.join(offsets, chunk == F.col("_part")).select(
        *df.columns, place.alias(name), F.lit(rows).cast("long").alias(f"{name}_total")
    )


def exact_quantiles(
    df: DataFrame,
    value: str,
    probabilities: dict[str, float],
    keys: Sequence[str] = (),
    limit: int = TASK_ROWS,
) -> DataFrame:
    """Linear-interpolated exact quantiles per key, one column each.

    Works on (value, count) pairs, so repeated values cost nothing.
    """
    keys = list(keys)
    present = df.select(*keys, F.col(value).cast("double").alias("_value"))
    present = present.filter(F.col("_value").isNotNull() & ~F.isnan("_value"))
    counts = present.groupBy(*keys, "_value").agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_sums(counts, keys, ["_value"], {"_upto": "_n"}, limit)
    before = F.col("_upto") - F.col("_n")

    def at(position):
        holds = (before <= position) & (position < F.col("_upto"))
        return F.max(F.when(holds, F.col("_value")))

    columns = []
    for label, p in probabilities.items():
        position = (F.col("_upto_total") - 1) * F.lit(float(p))
        low, high = at(F.floor(position)), at(F.ceil(position))
        part = F.max(position - F.floor(position))
        columns.append((low + part * (high - low)).alias(label))
    return ranked.groupBy(*keys).agg(*columns)
