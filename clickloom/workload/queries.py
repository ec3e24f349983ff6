"""Every operator as a query over the given tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas
from clickloom.functions import scalars as S
from clickloom.operators import (
    cleaning,
    dedup,
    encoding,
    evaluation,
    gold,
    lineage,
    monitoring,
    profile,
    replay,
    rolling,
    sessions,
    splits,
)
from clickloom.operators.ordered import dense_index
from clickloom.plans import lake, scoring, training
from clickloom.session import cut_lineage, scratch_path
from clickloom.sinks import tables as sinks
from clickloom.sources import raw_csv, streams
from clickloom.sources import tables as sources
from clickloom.streaming import outcomes, session_state, sinks as stream_sinks
from clickloom.workload import adapter as A
from clickloom.workload.oracle import RETRAIN_AS_OF, STREAM_TTL

QUERIES = {}
EVENT = list(schemas.SILVER.names)
TRIGGERS, FILES_PER_PART, ROWS_PER_FILE = 4, 2, 250_000
TRIALS = 2
SLICES = [
    ("week1", "2024-01-01", "2024-01-08"),
    ("week2", "2024-01-08", "2024-01-15"),
    ("week3", "2024-01-15", "2024-01-22"),
    ("week4", "2024-01-22", "2024-02-01"),
]


_TEXTS = [f.name for f in schemas.SILVER if f.dataType.simpleString() == "string"]


def query(function):
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


# Scans, sinks and the layers.


@query
def raw_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = A.monthly_csv(spark, sf_dir)
    return raw_csv.read_window(spark, folder, start="2024-01", end="2024-02")


@query
def raw_header_audit(spark, sf_dir):
    folder = A.monthly_csv(spark, sf_dir)
    files = raw_csv.select_files(spark, folder, "all").collect()
    found = raw_csv.audit_headers(spark, [f["path"] for f in files])
    names = {c: F.array_join(c, ",") for c in ("extra", "missing")}
    return found.withColumns(names)


@query
def bronze_from_csv(spark, sf_dir):
    folder, target = A.monthly_csv(spark, sf_dir), scratch_path(spark, "bronze")
    lake.ingest(spark, folder, target, start="2024-01", end="2024-01")
    return sources.read_table(spark, target).select(*EVENT)


@query
def bronze_events(spark, sf_dir):
    return A.bronze(spark, sf_dir).select(*EVENT)


@query
def silver_events(spark, sf_dir):
    return dedup.sort_canonical(A.silver(spark, sf_dir))


def _tables(spark, sf_dir):
    """Bronze, silver and split map tables in fresh folders."""
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    ordered = A.bronze(spark, sf_dir).select(
        *EVENT,
        F.lit(202401).alias("raw_month"),
        F.lit("2024-Jan.csv").alias("raw_file"),
        F.lit(0).cast("long").alias("raw_block"),
        F.col("input_order").alias("raw_row"),
    )
    sinks.write_bronze(ordered, bronze)
    lake.refine(spark, bronze, silver)
    mapped = scratch_path(spark, "splits")
    lake.assign_splits(spark, silver, mapped, A.CUTOFF)
    return silver, mapped


def _gold_table(spark, sf_dir):
    silver, mapped = _tables(spark, sf_dir)
    target = scratch_path(spark, "gold")
    lake.build_gold(spark, silver, mapped, target, A.HORIZON, A.CUTOFF)
    return target, mapped


@query
def silver_from_bronze(spark, sf_dir):
    silver, _ = _tables(spark, sf_dir)
    return sources.read_table(spark, silver)


@query
def gold_tables(spark, sf_dir):
    target, _ = _gold_table(spark, sf_dir)
    parts = [
        sources.read_gold(spark, target, s).withColumn("split", F.lit(s))
        for s in C.SPLITS
    ]
    return reduce(DataFrame.unionByName, parts)


@query
def lineage_record(spark, sf_dir):
    target, mapped = _gold_table(spark, sf_dir)
    return lineage.training_lineage(spark, target, mapped, "2024-01", "2024-01")


# Cleaning, duplicates and scalar functions.


@query
def raw_counts(spark, sf_dir):
    return cleaning.raw_counts(A.raw(spark, sf_dir))


@query
def clean_counts(spark, sf_dir):
    return cleaning.clean_counts(A.bronze(spark, sf_dir))


@query
def duplicate_counts(spark, sf_dir):
    return dedup.duplicate_counts(A.clean(spark, sf_dir))


@query
def category_filled(spark, sf_dir):
    return cleaning.clean(A.bronze(spark, sf_dir), "fill").select(*EVENT)


@query
def replay_events(spark, sf_dir):
    sent = S.iso_text(S.parse_utc_text(F.col("event_time")))
    return replay.normalise(A.raw(spark, sf_dir), sent)


@query
def replay_rejects(spark, sf_dir):
    rejected = replay.rejects(A.raw(spark, sf_dir))
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def replay_messages(spark, sf_dir):
    """Replay events published as keyed messages and read back from them."""
    sent = S.iso_text(S.parse_utc_text(F.col("event_time")))
    events = dedup.replay_order(replay.normalise(A.raw(spark, sf_dir), sent))
    path = scratch_path(spark, "topic")
    sinks.publish(events, "json", path=path)
    return streams.readable(streams.decode(spark.read.json(path, "key string, value string")))


@query
def dead_letters(spark, sf_dir):
    """Raw rows as messages; those with a malformed time are cut short."""
    whole = sinks.to_messages(A.raw(spark, sf_dir).withColumn("event_id", F.lit("e")))
    broken = F.col("value").contains("not a time")
    text = F.when(broken, F.lit("{broken")).otherwise(F.col("value"))
    decoded = streams.decode(whole.select(text.alias("value")))
    letters = streams.dead_letters(decoded)
    return letters.groupBy("value", "reason").agg(F.count(F.lit(1)).alias("rows"))


@query
def first_raw_rows(spark, sf_dir):
    folder = A.monthly_csv(spark, sf_dir)
    first = raw_csv.select_files(spark, folder, "all").first()["path"]
    return raw_csv.first_rows(spark, first, 200)


@query
def event_times_utc(spark, sf_dir):
    text = S.iso_text_utc(S.iso_text(F.col("source_event_time")))
    silver = A.silver(spark, sf_dir).select(text.alias("time_text"))
    return silver.groupBy("time_text").agg(F.count(F.lit(1)).alias("rows"))


@query
def session_id_check(spark, sf_dir):
    valid = S.is_session_id(F.col("user_session")).alias("valid")
    return A.raw(spark, sf_dir).groupBy(valid).agg(F.count(F.lit(1)).alias("rows"))


@query
def time_slices(spark, sf_dir):
    label = S.slice_label(F.col("source_event_time"), SLICES).alias("slice")
    return A.silver(spark, sf_dir).groupBy(label).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("user_session").alias("sessions"),
    )


@query
def time_slice_csv(spark, sf_dir):
    label = S.slice_label(F.col("source_event_time"), SLICES)
    path = scratch_path(spark, "slices")
    sinks.write_slices(A.silver(spark, sf_dir).withColumn("slice", label), "slice", path)
    return spark.read.schema(schemas.SILVER).option("header", True).csv(path)


@query
def exploration_fill(spark, sf_dir):
    filled = cleaning.exploration_fill(A.raw(spark, sf_dir))
    return filled.groupBy("category_code", "brand").agg(
        F.count(F.lit(1)).alias("rows")
    )


@query
def full_row_duplicates(spark, sf_dir):
    """Whole rows; cart events are sent twice, so there is something to count."""
    rows = A.bronze(spark, sf_dir).select(*EVENT)
    again = rows.filter(F.col("event_type") == "cart")
    return dedup.full_row_duplicates(rows.unionAll(again))


@query
def distinct_rows(spark, sf_dir):
    return A.bronze(spark, sf_dir).select(*EVENT).distinct()


# Sessions, splits and gold.


@query
def session_index(spark, sf_dir):
    return sessions.session_index(A.silver(spark, sf_dir)).drop("event_count")


@query
def time_ranked_sessions(spark, sf_dir):
    ranked = splits.time_ranked_sessions(A.silver(spark, sf_dir), A.CUTOFF)
    return ranked.drop("rank_total")


@query
def session_split_map(spark, sf_dir):
    return splits.split_sessions(A.silver(spark, sf_dir), A.CUTOFF)


@query
def events_in_scope(spark, sf_dir):
    sizes = A.sizes(spark, sf_dir)
    return sessions.in_scope(A.silver(spark, sf_dir), A.CUTOFF, sizes=sizes)


@query
def split_coverage(spark, sf_dir):
    silver = cut_lineage(A.silver(spark, sf_dir))
    index = sessions.session_index(silver)
    return gold.uncovered_sessions(index, splits.split_sessions(silver, A.CUTOFF))


@query
def gold_snapshots(spark, sf_dir):
    return A.snapshots(spark, sf_dir)


@query
def gold_short_horizon(spark, sf_dir):
    return A.snapshots(spark, sf_dir, C.HORIZON_SECONDS)


def _gold_with_split(spark, sf_dir):
    """Silver is a stored layer: it is read for the index, the map and gold."""
    silver = cut_lineage(A.silver(spark, sf_dir))
    split_map = splits.split_sessions(silver, A.CUTOFF)
    return gold.gold(silver, split_map, A.HORIZON, A.CUTOFF)


@query
def gold_with_split(spark, sf_dir):
    return _gold_with_split(spark, sf_dir)


@query
def extended_features(spark, sf_dir):
    rows = gold.extended_snapshots(
        A.silver(spark, sf_dir), sizes=A.sizes(spark, sf_dir)
    )
    # a sum of doubles may end on either side of a half: step past it
    nudged = {c: F.col(c) + F.lit(1e-9) for c in ("avg_price_viewed", "price_std")}
    rows = rows.withColumns(nudged)
    return rounded(rounded(rows, 6, "avg_price_viewed"), 4, "price_std")


@query
def retrain_gold(spark, sf_dir):
    """The window is read from the log that the stream has written."""
    log = spark.read.parquet(_stream(spark, sf_dir)["log"])
    rows, _ = lake.retrain_gold(log, RETRAIN_AS_OF, horizon_seconds=A.HORIZON)
    return rows


# Encoding and evaluation.


@query
def model_frame(spark, sf_dir):
    return encoding.model_frame(A.snapshots(spark, sf_dir))


@query
def vocabulary(spark, sf_dir):
    rows = _gold_with_split(spark, sf_dir)
    return encoding.fit_vocabulary(rows.filter(F.col("split") == "train"))


@query
def encoded_features(spark, sf_dir):
    rows = cut_lineage(_gold_with_split(spark, sf_dir))
    words = encoding.fit_vocabulary(rows.filter(F.col("split") == "train"))
    return encoding.encode(encoding.model_frame(rows, "split"), words)


@query
def pr_curve(spark, sf_dir):
    return rounded(evaluation.pr_curve(A.scored(spark, sf_dir)), 9, "precision", "recall")


_METRICS = ("pr_auc", "average_precision", "precision", "recall", "f1")


@query
def pr_summary(spark, sf_dir):
    return rounded(evaluation.metrics(A.scored(spark, sf_dir)), 6, *_METRICS)


@query
def metrics_at_half(spark, sf_dir):
    rows = evaluation.metrics(A.scored(spark, sf_dir), threshold=0.5)
    return rounded(rows, 6, *_METRICS)


@query
def metrics_by_type(spark, sf_dir):
    rows = evaluation.metrics(A.scored(spark, sf_dir), ["event_type"], threshold=0.5)
    return rounded(rows, 6, *_METRICS)


@query
def best_event_type(spark, sf_dir):
    table = metrics_by_type(spark, sf_dir)
    best = evaluation.best_model(table, order="event_type")
    return best.select("event_type", "pr_auc")


@query
def gate_verdicts(spark, sf_dir):
    table = metrics_by_type(spark, sf_dir).select("event_type", "pr_auc")
    production = table.filter(F.col("event_type") == "view").select("pr_auc")
    forced = F.col("event_type") == "purchase"
    audit = F.when(forced, F.lit("reviewer"))
    asked = table.withColumns(
        {
            "floor": F.lit(0.1),
            "production_pr_auc": F.when(
                F.col("event_type") != "view", production.scalar()
            ),
            "override": forced,
            **{name: audit for name in evaluation.AUDIT_COLUMNS},
        }
    )
    return evaluation.gate_verdict(asked).select("event_type", "rule", "passed")


@query
def seeded_sample(spark, sf_dir):
    return evaluation.seeded_sample(encoding.model_frame(A.snapshots(spark, sf_dir)))


# Profiling.


@query
def missing_values(spark, sf_dir):
    raw = A.raw(spark, sf_dir).select(*schemas.RAW.names)
    return rounded(profile.missing_values(raw), 6, "missing_pct")


@query
def type_counts(spark, sf_dir):
    return profile.value_counts(A.silver(spark, sf_dir), "event_type", "event_type")


@query
def type_shares(spark, sf_dir):
    return rounded(profile.type_shares(A.silver(spark, sf_dir)), 6, "share_pct")


@query
def month_counts(spark, sf_dir):
    return profile.month_counts(A.silver(spark, sf_dir))


@query
def top_days(spark, sf_dir):
    return profile.top_days(A.silver(spark, sf_dir))


@query
def hour_counts(spark, sf_dir):
    return profile.hour_counts(A.silver(spark, sf_dir))


@query
def top_brands(spark, sf_dir):
    return profile.top_values(A.silver(spark, sf_dir), "brand", "brand", 20)


@query
def top_categories(spark, sf_dir):
    rows = A.silver(spark, sf_dir)
    return profile.top_values(rows, "category_code", "category_code", 20)


@query
def price_stats(spark, sf_dir):
    stats = profile.price_stats(A.raw(spark, sf_dir))
    return rounded(stats, 6, "price_mean", "price_std")


@query
def price_quantiles(spark, sf_dir):
    marks = profile.price_quantiles(A.silver(spark, sf_dir))
    return rounded(marks, 6, *marks.columns)


@query
def rows_above_p99(spark, sf_dir):
    return profile.rows_above_quantile(A.silver(spark, sf_dir))


@query
def time_ranges(spark, sf_dir):
    return profile.time_ranges(A.silver(spark, sf_dir), "event_type")


@query
def file_time_ranges(spark, sf_dir):
    folder = A.monthly_csv(spark, sf_dir)
    rows = raw_csv.read_window(spark, folder, "all", ordered=True)
    ranges = profile.time_ranges(cleaning.to_bronze(rows, "raw_file"), "raw_file")
    return profile.overall_range(ranges, "raw_file")


@query
def head_per_file(spark, sf_dir):
    folder = A.monthly_csv(spark, sf_dir)
    rows = raw_csv.read_window(spark, folder, "all", ordered=True)
    first = profile.head_per_file(rows, "raw_file", ["raw_block", "raw_row"], 100)
    return first.select(*schemas.RAW.names, "raw_file")


@query
def session_profile(spark, sf_dir):
    return profile.session_profile(A.silver(spark, sf_dir))


@query
def top_sessions(spark, sf_dir):
    return profile.top_sessions(A.silver(spark, sf_dir))


@query
def session_medians(spark, sf_dir):
    return rounded(profile.session_medians(A.silver(spark, sf_dir)), 6, "median")


@query
def distinct_entities(spark, sf_dir):
    return profile.distinct_entities(A.silver(spark, sf_dir))


@query
def describe_numbers(spark, sf_dir):
    rows = profile.describe_numbers(A.snapshots(spark, sf_dir), C.NUMERIC_FEATURES)
    return rounded(rows, 4, "mean", "std", "q1", "q2", "q3")


@query
def describe_texts(spark, sf_dir):
    return profile.describe_texts(A.silver(spark, sf_dir), _TEXTS)


@query
def correlations(spark, sf_dir):
    rows = profile.correlations(A.snapshots(spark, sf_dir), C.NUMERIC_FEATURES)
    return rounded(rows, 6, "correlation")


@query
def price_histogram(spark, sf_dir):
    return rounded(profile.histogram(A.silver(spark, sf_dir)), 6, "low", "high")


@query
def price_histogram_clipped(spark, sf_dir):
    rows = profile.histogram(A.silver(spark, sf_dir), bins=60, clip=0.99)
    return rounded(rows, 6, "low", "high")


@query
def price_box(spark, sf_dir):
    return rounded(profile.box_stats(A.silver(spark, sf_dir)), 6, "q1", "median", "q3")


# Monitoring.


@query
def drift(spark, sf_dir):
    """Gold rows of sessions that start in the first half against the rest."""
    viewed = extended_features(spark, sf_dir).select(*C.EVENT_KEY, "avg_price_viewed")
    rows = A.snapshots(spark, sf_dir).join(viewed, list(C.EVENT_KEY))
    rows = cut_lineage(rows.withColumn("no_value", F.lit(None).cast("double")))
    began = F.timestamp_micros(
        S.epoch_micros(F.col("source_event_time"))
        - F.round(F.col("session_duration_sec") * 1e6).cast("long")
    ).cast("timestamp_ntz")
    span = rows.agg(F.min(began).alias("a"), F.max(began).alias("b")).first()
    middle = F.lit(span["a"] + (span["b"] - span["a"]) / 2).cast("timestamp_ntz")
    features = ["cart_to_view_ratio", "session_duration_sec", "avg_price_viewed"]
    features += ["no_value"]
    shifts = monitoring.drift(
        rows.filter(began < middle), rows.filter(began >= middle), features
    )
    return rounded(shifts, 6, "psi", "kl")


def _labelled(spark, sf_dir):
    log = cut_lineage(A.predictions(spark, sf_dir))
    return monitoring.label_outcomes(log, A.replayed(spark, sf_dir), A.HORIZON)


@query
def prediction_outcomes(spark, sf_dir):
    return _labelled(spark, sf_dir)


@query
def online_metrics(spark, sf_dir):
    return rounded(monitoring.online_metrics(_labelled(spark, sf_dir)), 6, *_METRICS)


@query
def online_coverage(spark, sf_dir):
    rows = monitoring.coverage(_labelled(spark, sf_dir))
    return rounded(rows, 6, "outcome_coverage", "fallback_rate")


@query
def online_metrics_as_of(spark, sf_dir):
    """The last full day before the cutoff only."""
    rows = monitoring.online_metrics(_labelled(spark, sf_dir), as_of=A.CUTOFF)
    return rounded(rows, 6, *_METRICS)


@query
def score_drift(spark, sf_dir):
    """Histograms of two parts of the log, kept as one table, merged."""
    log = cut_lineage(A.predictions(spark, sf_dir))
    cutoff = F.lit(A.CUTOFF).cast("timestamp_ntz")
    earlier = F.col("prediction_time") < cutoff
    kept = cut_lineage(rolling.score_histograms(log.filter(earlier)))
    fresh = rolling.score_histograms(log.filter(~earlier))
    kept = cut_lineage(rolling.merge_hourly(kept, fresh))
    return rounded(rolling.score_drift(kept), 6, "kl")


@query
def degradation_alerts(spark, sf_dir):
    return monitoring.degradation_alerts(online_metrics(spark, sf_dir))


@query
def metric_alerts(spark, sf_dir):
    labelled = cut_lineage(_labelled(spark, sf_dir))
    quality = rounded(monitoring.online_metrics(labelled), 6, *_METRICS)
    known = monitoring.coverage(labelled)
    shifts = rolling.score_drift(rolling.score_histograms(labelled))
    return monitoring.metric_alerts(
        quality,
        rounded(known, 6, "outcome_coverage", "fallback_rate"),
        rounded(shifts, 6, "kl"),
    )


@query
def prediction_gaps(spark, sf_dir):
    rows = monitoring.gaps(A.predictions(spark, sf_dir))
    return rounded(rows, 6, "p50", "p95", "p99")


@query
def prediction_latency(spark, sf_dir):
    rows = monitoring.latency(A.predictions(spark, sf_dir), "source_event_time")
    return rounded(rows, 6, "p50", "p95", "p99")


# Streams.


def _arrivals(spark, sf_dir, delay=None):
    """Replay events with a clock and the order of arrival."""
    clean = A.clean(spark, sf_dir)
    time = F.col("source_event_time")
    clean = clean.withColumn("_clock", time if delay is None else time + delay)
    order = ["_clock", *C.EVENT_KEY[2:], "user_session", "input_order"]
    numbered = dense_index(clean, order, "arrival").drop("arrival_total")
    identity = [F.col("user_session"), S.iso_text(time)]
    identity += [F.col(c) for c in C.EVENT_KEY[2:]]
    return numbered.select(
        *EVENT,
        F.col("_clock").alias("replay_time"),
        F.lit("replay").alias("source"),
        S.event_id(*identity).alias("event_id"),
        "arrival",
    )


def _arriving(spark, arrivals, base, name="in"):
    """The arrivals as a stream of TRIGGERS triggers, earlier ones first.

    A trigger has as many files, and so tasks, as its rows ask for; no file is empty
    unless the whole trigger is, so that no trigger takes files of the next one.
    """
    arrivals = cut_lineage(arrivals)
    newest = arrivals.agg(F.max("arrival")).first()[0]
    rows = 0 if newest is None else newest + 1
    files = max(FILES_PER_PART, -(-rows // (TRIGGERS * ROWS_PER_FILE)))
    files = max(1, min(files, rows // TRIGGERS))
    starts = [-(-rows * number // TRIGGERS) for number in range(TRIGGERS + 1)]
    arrival = F.col("arrival")
    for low, high in zip(starts, starts[1:]):
        some = arrivals.filter((arrival >= low) & (arrival < high))
        dealt = some.repartitionById(files, F.pmod("arrival", F.lit(files)).cast("int"))
        dealt.write.mode("append").parquet(f"{base}/{name}")
    return streams.file_events(
        spark, f"{base}/{name}", arrivals.schema, files_per_trigger=files
    )


def _stream(spark, sf_dir, late_seconds=C.LATE_THRESHOLD_SECONDS, delay=None):
    """Run the arrivals through the session tracker; returns the sink paths."""
    base = scratch_path(spark, "stream")
    source = _arriving(spark, _arrivals(spark, sf_dir, delay), base)
    tracked = session_state.track_sessions(source, STREAM_TTL, late_seconds)
    paths = {name: f"{base}/{name}" for name in ("log", "late", "serving")}
    write = stream_sinks.route(paths["log"], paths["late"], paths["serving"])
    stream_sinks.drain(tracked, write, f"{base}/checkpoint")
    return paths


_SERVING = [
    "user_session",
    "source_event_time",
    "event_type",
    "product_id",
    "serving_total_views",
    "serving_total_carts",
    "serving_total_removes",
    "serving_unique_products",
    "serving_unique_categories",
    "serving_session_duration_sec",
    "serving_price",
]


def _accepted(spark, paths):
    rows = stream_sinks.serving_rows(spark, paths["serving"])
    return rows.filter(F.col("status") == session_state.ACCEPTED)


@query
def stream_serving_rows(spark, sf_dir):
    return _accepted(spark, _stream(spark, sf_dir)).select(*_SERVING)


@query
def stream_latest_states(spark, sf_dir):
    rows = _accepted(spark, _stream(spark, sf_dir))
    return scoring.latest_states(rows).select(*_SERVING)


@query
def stream_statuses(spark, sf_dir):
    rows = stream_sinks.serving_rows(spark, _stream(spark, sf_dir)["serving"])
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))


@query
def stream_replay_log(spark, sf_dir):
    log = spark.read.parquet(_stream(spark, sf_dir)["log"])
    return log.select("event_id", *EVENT, "source")


@query
def stream_late_events(spark, sf_dir):
    """Cart events arrive four hours late; the late sink holds the messages."""
    held_up = F.when(F.col("event_type") == "cart", F.expr("INTERVAL 4 HOURS"))
    delay = F.coalesce(held_up, F.expr("INTERVAL 0 HOURS"))
    paths = _stream(spark, sf_dir, late_seconds=3600, delay=delay)
    return spark.read.parquet(paths["late"]).select("key", "value")


@query
def stream_outcomes(spark, sf_dir):
    """Predictions and purchases arrive as two streams, in four triggers each."""
    base = scratch_path(spark, "outcomes")
    log = cut_lineage(A.predictions(spark, sf_dir))
    bought = A.replayed(spark, sf_dir).filter("event_type = 'purchase'")
    asked = dense_index(log, ["prediction_time", "prediction_id"], "arrival")
    sold = dense_index(bought, ["replay_time", *C.EVENT_KEY], "arrival")
    hits = outcomes.purchase_hits(
        _arriving(spark, asked.drop("arrival_total"), base, "asked"),
        _arriving(spark, sold.drop("arrival_total"), base, "bought"),
        A.HORIZON,
    )
    outcomes.follow(hits, f"{base}/outcomes", f"{base}/checkpoint")
    return outcomes.settled(log, f"{base}/outcomes", A.HORIZON)


# Training and scoring.


def _trained(spark, sf_dir):
    target, _ = _gold_table(spark, sf_dir)
    frames, words = lake.model_inputs(sources.read_gold_splits(spark, target))
    model, threshold, report = training.run(frames, trials=TRIALS)
    return model, words, threshold, report


@query
def train_report(spark, sf_dir):
    path = scratch_path(spark, "report")
    sinks.write_report(_trained(spark, sf_dir)[3], path)
    return spark.read.json(path)


@query
def stream_scores(spark, sf_dir):
    """The newest state of every session in a trigger is scored in the stream."""
    model, words, _, _ = _trained(spark, sf_dir)
    base = scratch_path(spark, "stream")
    source = _arriving(spark, _arrivals(spark, sf_dir), base)
    tracked = session_state.track_sessions(source, STREAM_TTL)
    facts = {"horizon_minutes": A.HORIZON // 60, "model_version": "1"}
    write = stream_sinks.score_stream(
        training.BucketingModel(model), words, facts, f"{base}/scores"
    )
    stream_sinks.drain(tracked, write, f"{base}/checkpoint")
    return spark.read.parquet(f"{base}/scores")


@query
def scored_sessions(spark, sf_dir):
    """Every raw session asks for a score; rejected ones have no state."""
    model, words, threshold, _ = _trained(spark, sf_dir)
    path = scratch_path(spark, "bundle")
    training.save_bundle(model, words, threshold, path)
    model, words, facts = training.load_bundle(spark, path)
    states = scoring.latest_states(_accepted(spark, _stream(spark, sf_dir)))
    asked = A.raw(spark, sf_dir).select("user_session")
    return scoring.score(
        asked, states, words, training.BucketingModel(model), facts
    )
