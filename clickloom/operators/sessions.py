"""Per-session ordered scans that survive a session holding most of the rows.

Ordinary sessions are hashed to one task each and scanned with windows. A
session above ``limit`` rows is cut into ordered chunks; every chunk is scanned
on its own and corrected with what the earlier (or later) chunks hold. Both
paths run the same window code and give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.ordered import CHUNK, null_safe_join, range_chunks
from clickloom.session import cut_lineage

SESSION = "user_session"
SESSION_ROWS = 2_000_000
BROADCAST_SESSIONS = 20_000
BROADCAST_CHUNKS = 100_000


def session_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy(SESSION).agg(F.count(F.lit(1)).alias("event_count"))


def hot_sessions(sizes: DataFrame, limit: int = SESSION_ROWS) -> DataFrame | None:
    """Sessions above the row limit, stored, or None when there is none.

    They are marked for broadcast only if they were counted to be few.
    """
    rows = F.col("event_count")
    above = (rows > limit) & F.col(SESSION).isNotNull()
    if not sizes.agg(F.count_if(above)).first()[0]:
        return None
    return small(sizes.filter(above).select(SESSION), BROADCAST_SESSIONS)


def scan_sessions(
    df: DataFrame,
    order: Sequence[str],
    scan_whole,
    scan_chunks,
    limit: int = SESSION_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Run ``scan_whole`` on ordinary sessions, ``scan_chunks`` on hot ones.

    ``sizes`` holds ``event_count`` per session, or an upper bound of it; it is
    counted if not given.
    """
    hot = hot_sessions(session_sizes(df) if sizes is None else sizes, limit)
    if hot is None:
        return scan_whole(df.repartition(SESSION), [SESSION])
    cold_rows = df.join(hot, SESSION, "left_anti").select(*df.columns)
    hot_rows = df.join(hot, SESSION, "left_semi").select(*df.columns)
    chunks = range_chunks(hot_rows, [SESSION, *order])
    whole = scan_whole(cold_rows.repartition(SESSION), [SESSION])
    return whole.unionByName(scan_chunks(chunks, [SESSION, CHUNK]).drop(CHUNK))


def next_instant(keys: Sequence[str], micros: Column, marked: Column) -> Column:
    """Earliest marked instant strictly after the row's own instant.

    The order runs backwards in time, so the frame only ever grows.
    """
    later = Window.partitionBy(*keys).orderBy((-micros).asc())
    later = later.rangeBetween(Window.unboundedPreceding, -1)
    return F.min(F.when(marked, micros)).over(later)


def _prior(keys: Sequence[str], order: Sequence[str]):
    window = Window.partitionBy(*keys).orderBy(*order)
    return window.rowsBetween(Window.unboundedPreceding, -1)


def prior_sums(df, keys, order, measures: dict[str, Column]) -> DataFrame:
    """Add running sums over strictly earlier rows of the same keys."""
    earlier = _prior(keys, order)
    return df.select(
        "*",
        *[
            F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(name)
            for name, m in measures.items()
        ],
    )


def small(df: DataFrame, most: int = BROADCAST_CHUNKS) -> DataFrame:
    """Store a table of short rows and mark it for broadcast if it has few.

    There is one row per hot session, or per (session, chunk): chunks are range
    partitions, so no more than hot sessions plus partitions. A longer table is
    joined by its key like any other.
    """
    stored = cut_lineage(df)
    return F.broadcast(stored) if stored.count() <= most else stored


def chunk_offsets(totals: DataFrame, names: Sequence[str]) -> DataFrame:
    """Per (session, chunk): the sums over all earlier chunks of the session."""
    earlier = Window.partitionBy(SESSION).orderBy(CHUNK)
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(
        SESSION,
        CHUNK,
        *[
            F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_before_{name}")
            for name in names
        ],
    )


def chunk_totals(chunks: DataFrame, measures: dict[str, Column]) -> DataFrame:
    return chunks.groupBy(SESSION, CHUNK).agg(
        *[F.sum(m).alias(name) for name, m in measures.items()]
    )


def add_offsets(df: DataFrame, offsets: DataFrame, names: Sequence[str]) -> DataFrame:
    """Turn sums within a chunk into sums within the session."""
    joined = df.join(offsets, [SESSION, CHUNK])
    fixed = {n: F.col(n) + F.col(f"_before_{n}") for n in names}
    return joined.withColumns(fixed).select(*df.columns)


def flag_first(df, keys, order, values: dict[str, str]) -> DataFrame:
    """Flag (1/0) the first row of each value within the keys."""
    return df.select(
        "*",
        *[
            (
                F.row_number().over(
                    Window.partitionBy(*keys, value).orderBy(*order)
                )
                == 1
            )
            .cast("long")
            .alias(flag)
            for flag, value in values.items()
        ],
    )


def first_chunks(chunks: DataFrame, value: str) -> DataFrame:
    """The earliest chunk of every value of a session, stored."""
    seen = chunks.groupBy(SESSION, value).agg(F.min(CHUNK).alias(CHUNK))
    return cut_lineage(seen)


def keep_new(df: DataFrame, flag: str, value: str, firsts: DataFrame) -> DataFrame:
    """Clear the flag of values an earlier chunk of the session already has.

    The lookup is keyed by chunk too, so it is never hot, and it reuses the
    (session, chunk) partitioning of the rows.
    """
    known = firsts.withColumn("_first", F.lit(1).cast("long"))
    joined = null_safe_join(df, known, [SESSION, CHUNK, value], "left")
    fixed = F.col(flag) * F.coalesce(F.col("_first"), F.lit(0))
    return joined.withColumn(flag, fixed).select(*df.columns)


def chunk_edges(chunks: DataFrame, micros: str, marked: Column) -> DataFrame:
    """Marked instants in later chunks, one row per (session, chunk).

    ``_inner`` serves rows before the last instant of the chunk, ``_edge`` rows
    at it. One instant may span chunks, so a chunk offers two candidates to
    earlier ones: its first mark, and its first mark after its start.
    """
    at = F.col(micros)
    bounds = small(
        chunks.groupBy(SESSION, CHUNK).agg(
            F.min(at).alias("_low"),
            F.max(at).alias("_high"),
            F.min(F.when(marked, at)).alias("_mark"),
        )
    )
    later_mark = (
        chunks.filter(marked)
        .join(bounds, [SESSION, CHUNK])
        .filter(at > F.col("_low"))
        .groupBy(SESSION, CHUNK)
        .agg(F.min(at).alias("_mark_later"))
    )
    marks = bounds.join(small(later_mark), [SESSION, CHUNK], "left")
    behind = Window.partitionBy(SESSION).orderBy(F.col(CHUNK).desc())
    behind = behind.rowsBetween(Window.unboundedPreceding, -1)
    inner = marks.select(
        SESSION, CHUNK, "_high", F.min("_mark").over(behind).alias("_inner")
    )
    probes = marks.select(
        SESSION, F.col(CHUNK), F.col("_high").alias("_at"), F.lit(False).alias("_is")
    )
    candidates = marks.select(
        SESSION,
        F.lit(None).cast("int").alias(CHUNK),
        F.explode(F.array("_mark", "_mark_later")).alias("_at"),
        F.lit(True).alias("_is"),
    ).filter(F.col("_at").isNotNull())
    edge = (
        probes.unionByName(candidates)
        .withColumn("_edge", next_instant([SESSION], F.col("_at"), F.col("_is")))
        .filter(~F.col("_is"))
        .select(SESSION, CHUNK, "_edge")
    )
    return small(inner.join(edge, [SESSION, CHUNK]))


def next_instant_chunked(
    df: DataFrame, edges: DataFrame, micros: str, marked: Column, name: str
) -> DataFrame:
    """``next_instant`` over whole sessions for rows that are cut into chunks."""
    at = F.col(micros)
    local = df.withColumn("_local", next_instant([SESSION, CHUNK], at, marked))
    joined = local.join(edges, [SESSION, CHUNK])
    beyond = F.when(at < F.col("_high"), F.col("_inner")).otherwise(F.col("_edge"))
    return joined.select(*df.columns, F.coalesce("_local", beyond).alias(name))


def add_next_instant(
    df: DataFrame,
    micros: str,
    marked: Column,
    name: str,
    limit: int = SESSION_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Add the session's earliest marked instant strictly after each row."""

    def whole(rows, keys):
        return rows.withColumn(name, next_instant(keys, F.col(micros), marked))

    def chunked(chunks, keys):
        edges = chunk_edges(chunks, micros, marked)
        rows = chunks.repartition(*keys)
        return next_instant_chunked(rows, edges, micros, marked, name)

    return scan_sessions(df, [micros], whole, chunked, limit, sizes).select(
        *df.columns, name
    )


def session_index(df: DataFrame) -> DataFrame:
    """First and last event time and row count of every session."""
    return df.groupBy(SESSION).agg(
        F.min("source_event_time").alias("session_start_time"),
        F.max("source_event_time").alias("session_end_time"),
        F.count(F.lit(1)).alias("event_count"),
    )


def session_start(keys: Sequence[str], order: Sequence[str] = ()) -> Column:
    """First event time of the session.

    ``order`` may name the sort another window needs anyway; the frame is the
    whole session, so it changes nothing but saves a sort.
    """
    window = Window.partitionBy(*keys)
    if order:
        window = window.orderBy(*order)
    window = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.min("source_event_time").over(window)


def add_hot_start(chunks: DataFrame) -> DataFrame:
    """Add ``_start`` to rows of hot sessions, of which there are few."""
    starts = chunks.groupBy(SESSION).agg(F.min("source_event_time").alias("_start"))
    return chunks.join(small(starts), SESSION)


def in_scope(
    df: DataFrame,
    cutoff: str,
    limit: int = SESSION_ROWS,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """Keep whole sessions whose first event is before the cutoff."""
    early = F.col("_start") < F.lit(cutoff).cast("timestamp_ntz")

    def whole(rows, keys):
        return rows.withColumn("_start", session_start(keys)).filter(early)

    def chunked(chunks, keys):
        return add_hot_start(chunks).filter(early)

    kept = scan_sessions(df, ["source_event_time"], whole, chunked, limit, sizes)
    return kept.select(*df.columns)
