"""Per-batch routing of tracked events; every write may be repeated."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.plans.scoring import latest_states, score
from clickloom.session import cut_lineage
from clickloom.sinks.tables import to_messages
from clickloom.streaming.session_state import ACCEPTED, LATE, REJECTED

LOG_COLUMNS = (
    "event_id",
    "source_event_time",
    "replay_time",
    "event_type",
    "product_id",
    "category_id",
    "user_id",
    "user_session",
    "category_code",
    "brand",
    "price",
    "source",
)
DAYS_LISTED = 1_000
ROWS_PER_FILE = 1_000_000


def table_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).exists(target)


def spread_days(dated: DataFrame, rows_per_file: int) -> DataFrame:
    """Deal each day over as many tasks as its counted rows ask for.

    The table of days is as short as the calendar, so it is broadcast; it also
    says how many tasks there are in all.
    """
    files = F.ceil(F.count(F.lit(1)) / rows_per_file).cast("int").alias("_files")
    days = dated.groupBy("event_date").agg(files)
    tasks = days.agg(F.sum("_files")).first()[0] or 1
    number = F.pmod(F.xxhash64("event_id"), F.col("_files")).cast("int")
    same = F.col("event_date").eqNullSafe(F.col("_day"))
    named = F.broadcast(days.withColumnRenamed("event_date", "_day"))
    dealt = dated.join(named, same).withColumn("_file", number)
    return dealt.repartition(tasks, "event_date", "_file").drop("_day", "_files", "_file")


def append_new(
    events: DataFrame,
    path: str,
    rows_per_file: int = ROWS_PER_FILE,
    stored: bool = False,
) -> None:
    """Append rows whose ``event_id`` the log does not hold yet.

    The id is a hash over the event time too, so a repeat has the same date:
    only the date folders of the batch's own dates are read. A date is written
    by as many tasks as its rows ask for, also if it is the only one. Whole rows
    are compared by id only if hashes of the ids say that some may be repeats.
    The rows are read several times; ``stored`` says that they are persisted.
    """
    spark = events.sparkSession
    dated = events.withColumn("event_date", F.to_date("source_event_time"))
    held = [] if stored else [dated.persist()]
    try:
        ids, log = dated.select("event_id"), None
        if table_exists(spark, path):
            days = dated.select("event_date").distinct()
            listed = [r[0] for r in days.limit(DAYS_LISTED + 1).collect()]
            if not listed:
                return
            log = spark.read.schema("event_id string, event_date date").parquet(path)
            if len(listed) <= DAYS_LISTED:
                log = log.filter(F.col("event_date").isin(listed))
            else:
                log = log.join(days, "event_date", "left_semi")
            log = log.select("event_id")
            ids = ids.unionByName(log)
        if _may_repeat(ids):
            dated = dated.dropDuplicates(["event_id"])
            if log is not None:
                dated = dated.join(log, "event_id", "left_anti")
            held.append(dated.persist())
        stamped = spread_days(dated, rows_per_file).withColumn(
            "created_at", F.current_timestamp()
        )
        stamped.write.mode("append").partitionBy("event_date").parquet(path)
    finally:
        for frame in held:
            frame.unpersist()


def _may_repeat(ids: DataFrame) -> bool:
    """Whether two ids have one hash; equal ids always have."""
    counts = ids.groupBy(F.xxhash64("event_id")).agg(F.count(F.lit(1)).alias("rows"))
    return not counts.filter("rows > 1").isEmpty()


def compact_log(
    spark: SparkSession, path: str, days: Sequence, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Rewrite the given days (dates or ISO texts) of a log with few files each.

    The rows are copied to the shared folder first and only these days' folders
    are replaced, so a job that fails can be repeated from the copy. No stream
    may write to the log meanwhile.
    """
    named = [F.lit(str(day)).cast("date") for day in days]
    kept = cut_lineage(spark.read.parquet(path).filter(F.col("event_date").isin(named)))
    (
        spread_days(kept, rows_per_file)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("event_date")
        .parquet(path)
    )


def batch_table(df: DataFrame, path: str, batch_id: int) -> None:
    """A folder per batch: a repeated batch replaces its own rows."""
    df.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")


def late_events(tracked: DataFrame) -> DataFrame:
    """Late events without the internal status, with their reason."""
    return tracked.filter(F.col("status") == LATE).select(*LOG_COLUMNS, "late_reason")


def dead_letters(tracked: DataFrame) -> DataFrame:
    """Rejected messages with their reason: the text as it came, or the fields."""
    fields = F.to_json(
        F.struct("event_id", "user_session", "event_type", "product_id", "arrival"),
        {"ignoreNullFields": "false"},
    )
    return tracked.filter(F.col("status") == REJECTED).select(
        F.coalesce("message", fields).alias("value"), "reason"
    )


def route(
    log: str,
    late: str,
    serving: str,
    dead: str | None = None,
    commits: str | None = None,
):
    """``foreachBatch`` function: replay log, late messages, serving rows, and
    dead letters if there is a place for them.

    Every sink may be written again after a failure: the log takes unseen ids
    only, the others replace the batch's folder. With ``commits`` a batch leaves
    a record when all its sinks are written, and is not written once more.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if commits is not None and table_exists(spark, f"{commits}/batch_id={batch_id}"):
            return
        batch = batch.persist()
        try:
            accepted = batch.filter(F.col("status") == ACCEPTED)
            append_new(accepted.select(*LOG_COLUMNS), log, stored=True)
            batch_table(to_messages(late_events(batch)), late, batch_id)
            tracked = batch.filter(F.col("status") != REJECTED)
            batch_table(tracked.drop("message", "reason"), serving, batch_id)
            if dead is not None:
                batch_table(dead_letters(batch), dead, batch_id)
            if commits is not None:
                counts = batch.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))
                batch_table(counts.coalesce(1), commits, batch_id)
        finally:
            batch.unpersist()

    return write


def score_stream(model, vocabulary: DataFrame, meta: dict, path: str):
    """``foreachBatch`` function: score the newest state of each session."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()  # the states are read twice
        try:
            states = latest_states(batch.filter(F.col("status") == ACCEPTED))
            asked = states.select("user_session")
            answers = score(asked, states, vocabulary, model, meta)
            batch_table(answers, path, batch_id)
        finally:
            batch.unpersist()

    return write


def drain(stream: DataFrame, write, checkpoint: str):
    """Process everything that is there, then stop."""
    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def serving_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
