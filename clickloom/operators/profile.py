"""Descriptive statistics of an event table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.ordered import exact_quantiles, null_safe_join
from clickloom.operators.sessions import SESSION

# The reported price quantiles.
QUANTILES = {
    "p25": 0.25,
    "p50": 0.5,
    "p75": 0.75,
    "p90": 0.9,
    "p95": 0.95,
    "p99": 0.99,
}


def missing_values(df: DataFrame) -> DataFrame:
    """Missing count and percentage of every column, one pass."""
    counted = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    rows = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("field"), F.col(c).alias("missing_count"))
                for c in df.columns
            ]
        )
    )
    listed = counted.select("_rows", rows.alias("_f")).select("_rows", "_f.*")
    share = F.col("missing_count") * 100.0 / F.when(F.col("_rows") > 0, F.col("_rows"))
    return listed.select("field", "missing_count", share.alias("missing_pct"))


def value_counts(df: DataFrame, value: Column | str, name: str) -> DataFrame:
    """Rows per non-missing value."""
    value = F.col(value) if isinstance(value, str) else value
    named = df.select(value.alias(name)).filter(F.col(name).isNotNull())
    return named.groupBy(name).agg(F.count(F.lit(1)).alias("rows"))


def top_values(df, value, name: str, k: int) -> DataFrame:
    """The ``k`` most frequent values, ties by value."""
    return value_counts(df, value, name).orderBy(F.col("rows").desc(), name).limit(k)


def month_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, F.date_format("source_event_time", "yyyy-MM"), "month")


def top_days(df: DataFrame, k: int = 15) -> DataFrame:
    day = F.date_format("source_event_time", "yyyy-MM-dd")
    return top_values(df, day, "day", k)


def hour_counts(df: DataFrame) -> DataFrame:
    return value_counts(df, F.hour("source_event_time"), "hour")


def type_shares(df: DataFrame) -> DataFrame:
    counts = value_counts(df, "event_type", "event_type")
    everything = counts.agg(F.sum("rows").alias("n")).scalar()
    return counts.withColumn("share_pct", F.col("rows") * 100.0 / everything)


def price_stats(df: DataFrame) -> DataFrame:
    price = F.col("price")
    return df.agg(
        F.count(price).alias("price_count"),
        F.avg(price).alias("price_mean"),
        F.stddev_pop(price).alias("price_std"),
        F.min(price).alias("price_min"),
        F.max(price).alias("price_max"),
        F.count_if(price.isNull()).alias("price_null"),
        F.count_if(price <= 0).alias("price_non_positive"),
    )


def price_quantiles(df: DataFrame, probabilities=None) -> DataFrame:
    return exact_quantiles(df, "price", probabilities or QUANTILES)


def rows_above_quantile(df: DataFrame, p: float = 0.99) -> DataFrame:
    """Rows priced above the exact quantile."""
    bound = exact_quantiles(df, "price", {"bound": p}).scalar()
    return df.agg(F.count_if(F.col("price") > bound).alias("rows_above"))


def time_ranges(df: DataFrame, by: str) -> DataFrame:
    """Rows and time range per file (or any other label)."""
    return df.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("source_event_time").alias("start_time"),
        F.max("source_event_time").alias("end_time"),
    )


def overall_range(ranges: DataFrame, by: str, label: str = "all") -> DataFrame:
    """The ranges of ``time_ranges`` and one more row for all of them."""
    whole = ranges.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
    )
    return ranges.unionByName(whole.withColumn(by, F.lit(label)))


def session_profile(df: DataFrame) -> DataFrame:
    span = F.unix_micros(F.col("last_event_time").cast("timestamp")) - F.unix_micros(
        F.col("first_event_time").cast("timestamp")
    )
    sessions = df.filter(F.col(SESSION).isNotNull()).groupBy(SESSION).agg(
        F.count(F.lit(1)).alias("event_count"),
        F.min("source_event_time").alias("first_event_time"),
        F.max("source_event_time").alias("last_event_time"),
    )
    return sessions.withColumn("duration_minutes", span / F.lit(60_000_000.0))


def top_sessions(df: DataFrame, k: int = 20) -> DataFrame:
    return session_profile(df).orderBy(
        F.col("event_count").desc(), F.col("duration_minutes").desc(), SESSION
    ).limit(k)


def distinct_entities(df: DataFrame) -> DataFrame:
    """One row of distinct counts, NULL not counted.

    Each column is read and made distinct by itself: one aggregate with three
    distinct counts would send every row three times.
    """
    names = {
        SESSION: "unique_sessions",
        "user_id": "unique_users",
        "product_id": "unique_products",
    }
    parts = [
        df.select(column).distinct().agg(F.count(column).alias("n"))
        .select(F.lit(name).alias("name"), "n")
        for column, name in names.items()
    ]
    counts = reduce(DataFrame.unionByName, parts)
    held = [F.max(F.when(F.col("name") == n, F.col("n"))).alias(n) for n in names.values()]
    return counts.agg(*held)


def session_medians(df: DataFrame) -> DataFrame:
    """Exact medians of session length and duration."""
    sessions = session_profile(df)
    measures = F.explode(
        F.array(
            F.struct(
                F.lit("event_count").alias("metric"),
                F.col("event_count").cast("double").alias("value"),
            ),
            F.struct(
                F.lit("duration_minutes").alias("metric"),
                F.col("duration_minutes").alias("value"),
            ),
        )
    )
    listed = sessions.select(measures.alias("_m")).select("_m.*")
    return exact_quantiles(listed, "value", {"median": 0.5}, keys=["metric"])


def describe_numbers(df: DataFrame, columns) -> DataFrame:
    """Count, mean, sample deviation, min, quartiles and max per column."""
    listed = _unpivot_numbers(df, columns)
    basic = listed.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = {"q1": 0.25, "q2": 0.5, "q3": 0.75}
    return basic.join(
        exact_quantiles(listed, "value", quartiles, keys=["column"]), "column", "left"
    )


def describe_texts(df: DataFrame, columns) -> DataFrame:
    """Count, distinct values and the most frequent value per text column."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column"), F.col(c).alias("value"))
                for c in columns
            ]
        )
    )
    listed = df.select(pairs.alias("_p")).select("_p.*")
    listed = listed.filter(F.col("value").isNotNull())
    counts = listed.groupBy("column", "value").agg(F.count(F.lit(1)).alias("freq"))
    ranked = Window.partitionBy("column").orderBy(F.col("freq").desc(), "value")
    top = counts.withColumn("_rank", F.row_number().over(ranked))
    top = top.filter(F.col("_rank") == 1).select(
        "column", F.col("value").alias("top"), F.col("freq").alias("top_count")
    )
    totals = counts.groupBy("column").agg(
        F.sum("freq").alias("count"), F.count(F.lit(1)).alias("unique")
    )
    return totals.join(top, "column")


def _unpivot_numbers(df: DataFrame, columns) -> DataFrame:
    pairs = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"), F.col(c).cast("double").alias("value")
                )
                for c in columns
            ]
        )
    )
    return df.select(pairs.alias("_p")).select("_p.*")


def correlations(df: DataFrame, columns) -> DataFrame:
    """Pearson correlation of every column pair, one aggregation."""
    columns = list(columns)
    pairs = [(a, b) for a in columns for b in columns]
    row = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}")
            for a, b in pairs
        ]
    )
    cells = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(a).alias("left"),
                    F.lit(b).alias("right"),
                    F.col(f"`{a}|{b}`").alias("correlation"),
                )
                for a, b in pairs
            ]
        )
    )
    return row.select(cells.alias("_c")).select("_c.*")


def histogram(
    df: DataFrame, value: str = "price", bins: int = 50, clip: float | None = None
) -> DataFrame:
    """Equal-width bins with their edges, empty ones included.

    ``clip`` moves values above that quantile onto it. Without a value there is
    no range and no bin.
    """
    numbers = df.select(F.col(value).cast("double").alias("v"))
    numbers = numbers.filter(F.col("v").isNotNull() & ~F.isnan("v"))
    if clip is not None:
        top = exact_quantiles(numbers, "v", {"top": clip}).scalar()
        numbers = numbers.select(F.least("v", top).alias("v"))
    span = F.struct(F.min("v").alias("low"), F.max("v").alias("high"))
    span = numbers.agg(span.alias("span")).scalar()
    low, high = span.getField("low"), span.getField("high")
    placed = numbers.select(bin_of(F.col("v"), low, high, bins).alias("bin"))
    counts = placed.groupBy("bin").agg(F.count(F.lit(1)).alias("rows"))
    flat = high == low
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low)

    def edge(number: Column) -> Column:
        return start + width * number / F.lit(float(bins))

    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(F.broadcast(counts), "bin", "left")
        .select(
            "bin",
            F.coalesce("rows", F.lit(0)).alias("rows"),
            edge(F.col("bin")).alias("low"),
            edge(F.col("bin") + 1).alias("high"),
        )
        .filter("low IS NOT NULL")
    )


def bin_of(value: Column, low: Column, high: Column, bins: int) -> Column:
    """0-based equal-width bin; a single-point range is widened by one half.

    Values outside the range fall into the end bins; no value has no bin.
    """
    flat = high == low
    start = F.when(flat, low - 0.5).otherwise(low)
    width = F.when(flat, F.lit(1.0)).otherwise(high - low)
    raw = F.floor((value - start) * F.lit(float(bins)) / width)
    placed = F.greatest(F.lit(0), F.least(raw, F.lit(bins - 1))).cast("int")
    return F.when(raw.isNotNull(), placed)


def box_stats(
    df: DataFrame, by: str = "event_type", value: str = "price"
) -> DataFrame:
    """Quartiles, whiskers (1.5 IQR, clipped to data) and outliers per group."""
    quartiles = exact_quantiles(
        df, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys=[by]
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    bounds = quartiles.withColumns(
        {"_low": F.col("q1") - reach, "_high": F.col("q3") + reach}
    )
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(
        F.count(F.lit(1)).alias("_n")
    )
    inside = F.col(value).between(F.col("_low"), F.col("_high"))
    return (
        null_safe_join(counts, bounds, [by], "left")
        .groupBy(by, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col(value))).alias("whisker_low"),
            F.max(F.when(inside, F.col(value))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("_n"))), F.lit(0)).alias("outliers"),
        )
    )


def head_per_file(df: DataFrame, file: str, order, k: int) -> DataFrame:
    """The first ``k`` rows of every file (a sampling report)."""
    ranked = Window.partitionBy(file).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(ranked))
        .filter(F.col("_rank") <= k)
        .drop("_rank")
    )
