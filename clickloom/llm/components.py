"""Connected components of a graph whose edges never leave the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.session import cut_lineage

ROUNDS = 60


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours (larger or smaller ones) of each node on its least one."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = both if large else edges
    least = near.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    hung = near.join(least, "a")
    if large:
        out = hung.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        return out.distinct()
    out = hung.select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = least.select("a", F.col("m").alias("b"))
    return out.unionAll(own).filter("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b); root is the least node.

    Alternating large and small stars; each round is written to the shared
    folder, so a lost executor costs one round. Loops and repeated edges are
    allowed; no edges give no rows.
    """
    tidy = edges.select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).filter("a <> b")
    now, before = cut_lineage(tidy.distinct()), None
    for _ in range(ROUNDS):
        mark = now.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
        ).first()
        if mark == before or not mark[0]:
            break
        before = mark
        now = cut_lineage(_star(_star(now, True), False))
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(roots)
