"""Left lookups that broadcast only tables of a checked size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import cut_lineage

BROADCAST_ROWS = 500_000
ROWS_PER_SALT = 2_000_000


def at_most(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def left_lookup(
    df: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    small: bool | None = None,
    limit: int = BROADCAST_ROWS,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """Left join to a table with unique keys.

    Beyond the broadcast limit the join is by key plus salt. Only keys counted
    above ``rows_per_salt`` rows have more than one salt, as many as their size
    asks for, and only their table rows are repeated.
    """
    on = list(on)
    if small is None:
        small = at_most(table, limit)
    if small:
        return df.join(F.broadcast(table), on, "left")
    sizes = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_rows"))
    hot = cut_lineage(
        sizes.filter(F.col("_rows") > rows_per_salt).select(
            *on, F.ceil(F.col("_rows") / rows_per_salt).cast("int").alias("_salts")
        )
    )
    if at_most(hot, BROADCAST_ROWS):
        hot = F.broadcast(hot)
    salts = F.coalesce("_salts", F.lit(1))
    drawn = F.pmod(F.xxhash64(*df.columns), salts).cast("int")
    salted = df.join(hot, on, "left").withColumn("_salt", drawn).drop("_salts")
    every = F.explode(F.sequence(F.lit(0), salts - 1))
    copies = table.join(hot, on, "left").withColumn("_salt", every).drop("_salts")
    return salted.join(copies, [*on, "_salt"], "left").drop("_salt")
