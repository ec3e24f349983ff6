"""Point-in-time session snapshots with the purchase-within-horizon label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas
from clickloom.functions import scalars as S
from clickloom.operators import sessions as scan
from clickloom.operators.ordered import CHUNK
from clickloom.operators.sessions import SESSION, SESSION_ROWS
from clickloom.session import cut_lineage

_ORDER = list(C.EVENT_KEY[1:])

def _counters() -> dict[str, Column]:
    return {
        "total_views": S.is_type("view"),
        "total_carts": S.is_type("cart"),
        "total_removes": S.is_type("remove_from_cart"),
        "unique_products": F.col("_new_product"),
        "unique_categories": F.col("_new_category"),
    }


def _extended_counters() -> dict[str, Column]:
    """Prices are summed from the session's least one, which keeps the variance
    from cancelling; they stay doubles of any size."""
    above = F.col("price") - F.col("_least_price")
    viewed = (F.col("event_type") == "view") & F.col("price").isNotNull()
    return {
        "total_carts": S.is_type("cart"),
        "total_removes": S.is_type("remove_from_cart"),
        "_viewed": viewed.cast("long"),
        "_spent": F.when(viewed, above),
        "_squared": F.when(viewed, above * above),
        "_branded": F.col("brand").isNotNull().cast("long"),
    }


def _with_helpers(silver: DataFrame) -> DataFrame:
    return silver.withColumns(
        {
            "_us": S.epoch_micros(F.col("source_event_time")),
            "_category": S.category_value(F.col("category_code"), F.col("category_id")),
        }
    )


def _whole_previous(rows: DataFrame, keys) -> DataFrame:
    inside = Window.partitionBy(*keys).orderBy(*_ORDER)
    return rows.withColumn("_previous", F.lag("_us").over(inside))


def _chunked_previous(rows: DataFrame, chunks: DataFrame, keys) -> DataFrame:
    ends = chunks.groupBy(*keys).agg(F.max("_us").alias("_end"))
    in_order = Window.partitionBy(SESSION).orderBy(CHUNK)
    ends = ends.select(*keys, F.lag("_end").over(in_order).alias("_before"))
    joined = _whole_previous(rows, keys).join(scan.small(ends), keys)
    previous = F.coalesce("_previous", "_before")
    return joined.withColumn("_previous", previous).drop("_before")


def snapshots(
    silver: DataFrame,
    horizon_seconds: int = C.HORIZON_SECONDS,
    cutoff: str | None = None,
    split_map: DataFrame | None = None,
    limit: int = SESSION_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """One gold row per silver event; with a split map also its ``split``.

    All windows share the session partitioning, so an ordinary session costs
    one shuffle. The start window reuses the order the product flag needed, and
    scope is applied before the other windows run.
    """
    bought = F.col("event_type") == "purchase"
    in_scope = F.lit(True)
    if cutoff is not None:
        in_scope = F.col("_start") < F.lit(cutoff).cast("timestamp_ntz")

    def whole(rows, keys):
        rows = scan.flag_first(rows, keys, _ORDER, {"_new_product": "product_id"})
        start = scan.session_start(keys, ["product_id", *_ORDER])
        rows = rows.withColumn("_start", start).filter(in_scope)
        if split_map is not None:
            rows = rows.join(split_map.select(SESSION, "split"), SESSION)
        rows = scan.flag_first(rows, keys, _ORDER, {"_new_category": "_category"})
        rows = scan.prior_sums(rows, keys, _ORDER, _counters())
        next_purchase = scan.next_instant(keys, F.col("_us"), bought)
        return _finish(
            rows.withColumn("_next", next_purchase), horizon_seconds, split_map
        )

    def chunked(chunks, keys):
        products = scan.first_chunks(chunks, "product_id")
        categories = scan.first_chunks(chunks, "_category")
        offsets = _counter_offsets(chunks, products, categories)
        edges = scan.chunk_edges(chunks, "_us", bought)
        rows = scan.add_hot_start(chunks).filter(in_scope)
        if split_map is not None:
            rows = rows.join(_hot_splits(split_map, chunks), SESSION)
        rows = rows.repartition(*keys)
        rows = scan.flag_first(rows, keys, _ORDER, {"_new_product": "product_id"})
        rows = scan.keep_new(rows, "_new_product", "product_id", products)
        rows = scan.flag_first(rows, keys, _ORDER, {"_new_category": "_category"})
        rows = scan.keep_new(rows, "_new_category", "_category", categories)
        rows = scan.prior_sums(rows, keys, _ORDER, _counters())
        rows = scan.add_offsets(rows, offsets, list(_counters()))
        rows = scan.next_instant_chunked(rows, edges, "_us", bought, "_next")
        return _finish(rows, horizon_seconds, split_map)

    return scan.scan_sessions(
        _with_helpers(silver), _ORDER, whole, chunked, limit, sizes
    )


def _counter_offsets(chunks, products, categories) -> DataFrame:
    """Counters over earlier chunks; a value counts in its first chunk only."""
    typed = {n: m for n, m in _counters().items() if not n.startswith("unique")}
    totals = scan.small(scan.chunk_totals(chunks, typed))
    for name, firsts in (("products", products), ("categories", categories)):
        new = firsts.groupBy(SESSION, CHUNK).agg(
            F.count(F.lit(1)).alias(f"unique_{name}")
        )
        totals = totals.join(scan.small(new), [SESSION, CHUNK], "left")
    return scan.small(scan.chunk_offsets(totals.fillna(0), list(_counters())))


def _hot_splits(split_map: DataFrame, chunks: DataFrame) -> DataFrame:
    hot = scan.small(chunks.select(SESSION).distinct())
    assigned = split_map.select(SESSION, "split")
    return scan.small(assigned.join(hot, SESSION, "left_semi"))


def _finish(rows: DataFrame, horizon_seconds: int, split_map) -> DataFrame:
    views, carts = F.col("total_views"), F.col("total_carts")
    elapsed = F.col("_us") - S.epoch_micros(F.col("_start"))
    soon = F.col("_next") - F.col("_us") <= horizon_seconds * C.MICROS
    computed = {
        "net_cart_count": carts - F.col("total_removes"),
        "cart_to_view_ratio": S.cart_view_ratio(views, carts),
        "session_duration_sec": elapsed / F.lit(float(C.MICROS)),
        "label": F.coalesce(soon, F.lit(False)).cast("byte"),
    }
    extra = [] if split_map is None else ["split"]
    return rows.withColumns(computed).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in schemas.GOLD], *extra
    )


def extended_snapshots(
    silver: DataFrame, limit: int = SESSION_ROWS, sizes: DataFrame | None = None
) -> DataFrame:
    """Further features over strictly earlier rows, keyed like gold rows."""

    def whole(rows, keys):
        least = F.min("price").over(Window.partitionBy(*keys))
        rows = rows.withColumn("_least_price", least)
        rows = scan.prior_sums(rows, keys, _ORDER, _extended_counters())
        return _finish_extended(_whole_previous(rows, keys))

    def chunked(chunks, keys):
        least = chunks.groupBy(SESSION).agg(F.min("price").alias("_least_price"))
        chunks = chunks.join(scan.small(least), SESSION)
        names = list(_extended_counters())
        totals = scan.chunk_totals(chunks, _extended_counters())
        offsets = scan.small(scan.chunk_offsets(totals, names))
        rows = chunks.repartition(*keys)
        rows = scan.prior_sums(rows, keys, _ORDER, _extended_counters())
        rows = scan.add_offsets(rows, offsets, names)
        return _finish_extended(_chunked_previous(rows, chunks, keys))

    return scan.scan_sessions(
        _with_helpers(silver), _ORDER, whole, chunked, limit, sizes
    )


def _finish_extended(rows: DataFrame) -> DataFrame:
    carts, removes = F.col("total_carts"), F.col("total_removes")
    viewed = F.when(F.col("_viewed") > 0, F.col("_viewed"))
    above = F.col("_spent") / viewed
    mean = F.col("_least_price") + above
    spread = F.col("_squared") / viewed - above * above
    gap = (F.col("_us") - F.col("_previous")) / F.lit(float(C.MICROS))
    rate = F.when(carts == 0, F.lit(0.0)).otherwise(
        removes.cast("double") / F.when(carts != 0, carts)
    )
    return rows.select(
        *C.EVENT_KEY,
        removes.alias("total_removes"),
        rate.alias("cart_remove_rate"),
        mean.alias("avg_price_viewed"),
        gap.alias("time_since_last_event_sec"),
        (F.col("_branded") > 0).cast("int").alias("has_brand_info"),
        F.sqrt(F.when(spread > 0, spread).when(spread <= 0, 0.0)).alias("price_std"),
    )


def check_split_labels(split_map: DataFrame) -> None:
    """Fail on an empty map or a split name outside train, val, test."""
    wrong = split_map.filter(
        F.col("split").isNull() | ~F.col("split").isin(*C.SPLITS)
    ).select("split")
    row = wrong.first()
    if row is not None:
        raise ValueError(f"unknown split {row['split']!r}")
    if split_map.isEmpty():
        raise ValueError("the split map is empty")


def uncovered_sessions(
    index: DataFrame, split_map: DataFrame, cutoff: str | None = None
) -> DataFrame:
    """Sessions on one side only: ``unmapped`` in silver, ``unknown`` in map.

    ``index`` is the session index of the silver rows.
    """
    if cutoff is not None:
        start = F.col("session_start_time")
        index = index.filter(start < F.lit(cutoff).cast("timestamp_ntz"))
    known, present = split_map.select(SESSION), index.select(SESSION)
    unmapped = present.join(known, SESSION, "left_anti")
    unknown = known.join(present, SESSION, "left_anti")
    return unmapped.withColumn("problem", F.lit("unmapped")).unionByName(
        unknown.withColumn("problem", F.lit("unknown"))
    )


def check_coverage(index, split_map, cutoff: str | None = None) -> None:
    """Fail unless map and in-scope silver hold the same sessions."""
    row = uncovered_sessions(index, split_map, cutoff).first()
    if row is None:
        return
    if row["problem"] == "unmapped":
        raise ValueError(f"session {row[SESSION]} has no split")
    raise ValueError(f"split map names session {row[SESSION]}, absent from silver")


def gold(
    silver: DataFrame,
    split_map: DataFrame,
    horizon_seconds: int = C.HORIZON_SECONDS,
    cutoff: str | None = C.SESSION_CUTOFF,
    limit: int = SESSION_ROWS,
) -> DataFrame:
    """Checked gold snapshots with their split.

    One stored session index serves the coverage check and the size check.
    """
    check_split_labels(split_map)
    index = cut_lineage(scan.session_index(silver))
    check_coverage(index, split_map, cutoff)
    return snapshots(silver, horizon_seconds, cutoff, split_map, limit, index)
