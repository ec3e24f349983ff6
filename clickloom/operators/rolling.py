"""Day-long windows, one hour apart, over a prediction log.

The log is kept as hourly states that merge by addition: counts of each score
and histograms of the scores. A day is a range of 24 hourly states.

Precision-recall areas need the scores of a window in order. Windows are taken
in blocks of ``BLOCK``: a block's hours are sorted by score once and all its
windows are swept together, so a row is sent to one or two blocks and not to 24
windows. Blocks with more scores than a task should hold are cut at score
bounds; the counts above each cut come in as head rows, so that every piece is
swept on its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickloom.operators.evaluation import confusion_metrics
from clickloom.operators.ordered import TASK_ROWS

DAY = 24
WEEK = 7 * DAY
BLOCK = 48
MODE = "evaluation_mode"
HOUR_MICROS = 3_600_000_000
# Bins of the score histogram and the least share of a bin.
SCORE_BINS = 10
SHARE_FLOOR = 0.001

_SWEPT = f"{MODE} string, window_hour long, gained double, stepped double"


def hour_number(time: Column) -> Column:
    """Hours since the epoch, downwards."""
    micros = F.unix_micros(time.cast("timestamp"))
    return F.floor(micros / F.lit(HOUR_MICROS)).cast("long")


def hour_time(number: Column) -> Column:
    return F.timestamp_micros(number * F.lit(HOUR_MICROS)).cast("timestamp_ntz")


def hourly_scores(labelled: DataFrame) -> DataFrame:
    """(evaluation_mode, hour, score, positives, rows) of model predictions with
    a known outcome; a missing score is the lowest."""
    model = labelled.filter(
        (F.col("prediction_mode") == "model") & F.col("actual_purchase").isNotNull()
    )
    score = F.coalesce(F.col("purchase_probability").cast("double"), F.lit(float("-inf")))
    return model.groupBy(
        MODE, hour_number(F.col("prediction_time")).alias("hour"), score.alias("score")
    ).agg(
        F.sum(F.col("actual_purchase").cast("long")).alias("positives"),
        F.count(F.lit(1)).alias("rows"),
    )


def merge_hourly(kept: DataFrame, fresh: DataFrame) -> DataFrame:
    """One state out of two of the same kind (scores or histograms)."""
    counts = [c for c in ("positives", "rows") if c in fresh.columns]
    keys = [c for c in fresh.columns if c not in counts]
    both = kept.select(fresh.columns).unionAll(fresh)
    return both.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in counts])


def _windows_of(hour: str, length: int = DAY) -> Column:
    return F.explode(F.sequence(F.col(hour) - (length - 1), F.col(hour)))


def window_counts(hourly: DataFrame, threshold: float) -> DataFrame:
    """Totals and counts above the threshold per mode and window.

    Scores collapse to one row per hour before windows are made of them.
    """
    above = F.col("score") >= threshold
    per_hour = hourly.groupBy(MODE, "hour").agg(
        F.sum("positives").alias("positives"),
        F.sum("rows").alias("rows"),
        F.coalesce(F.sum(F.when(above, F.col("positives"))), F.lit(0)).alias("hits"),
        F.coalesce(F.sum(F.when(above, F.col("rows"))), F.lit(0)).alias("taken"),
    )
    return (
        per_hour.withColumn("window_hour", _windows_of("hour"))
        .groupBy(MODE, "window_hour")
        .agg(*[F.sum(c).alias(c) for c in ("positives", "rows", "hits", "taken")])
    )


class _Sweep:
    """Running hits and rows of the windows of one block, scores falling."""

    def __init__(self, block: int):
        self.block = block
        self.hits, self.taken = np.zeros(BLOCK), np.zeros(BLOCK)
        self.gained, self.stepped = np.zeros(BLOCK), np.zeros(BLOCK)

    def _by_window(self, hour: np.ndarray, counts: np.ndarray) -> np.ndarray:
        first = (hour - self.block * BLOCK)[:, None] - np.arange(BLOCK)
        return np.where((first >= 0) & (first < DAY), counts[:, None], 0).astype(float)

    def start(self, hour, positives, rows) -> None:
        self.hits += self._by_window(hour, positives).sum(axis=0)
        self.taken += self._by_window(hour, rows).sum(axis=0)

    def add(self, hour, score, positives, rows) -> None:
        new = np.flatnonzero(np.r_[True, score[1:] != score[:-1]])
        hits = np.add.reduceat(self._by_window(hour, positives), new, axis=0)
        taken = np.add.reduceat(self._by_window(hour, rows), new, axis=0)
        hits_to = self.hits + np.cumsum(hits, axis=0)
        taken_to = self.taken + np.cumsum(taken, axis=0)
        before = taken_to - taken
        precision = hits_to / np.maximum(taken_to, 1)
        earlier = np.where(before > 0, (hits_to - hits) / np.maximum(before, 1), 1.0)
        self.gained += (hits * (precision + earlier) / 2).sum(axis=0)
        self.stepped += (hits * precision).sum(axis=0)
        self.hits, self.taken = hits_to[-1], taken_to[-1]

    def windows(self) -> tuple[np.ndarray, ...]:
        seen = np.flatnonzero(self.taken > 0)
        return self.block * BLOCK + seen, self.gained[seen], self.stepped[seen]


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per window of rows sorted by mode, block, piece, head first, score.

    Only the rows of the last score of a batch wait for the next one.
    """
    names = ("block", "piece", "head", "hour", "score", "positives", "rows")
    key, sweep, waiting = None, None, None

    def leave():
        hours, gained, stepped = sweep.windows()
        columns = [pa.array([key[0]] * len(hours), pa.string()), hours, gained, stepped]
        fields = [c.split()[0] for c in _SWEPT.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=fields)

    for batch in batches:
        if not batch.num_rows:
            continue
        table = dict(zip(batch.schema.names, batch.columns, strict=True))
        modes = table[MODE].to_numpy(zero_copy_only=False)
        part = {n: table[n].to_numpy(zero_copy_only=False) for n in names}
        change = np.flatnonzero(
            np.r_[
                True,
                (modes[1:] != modes[:-1])
                | (part["block"][1:] != part["block"][:-1])
                | (part["piece"][1:] != part["piece"][:-1]),
            ]
        )
        for low, high in zip(change, np.r_[change[1:], len(modes)], strict=True):
            now = (modes[low], part["block"][low], part["piece"][low])
            if now != key:
                if sweep is not None:
                    if waiting is not None:
                        sweep.add(*waiting)
                    yield leave()
                key, sweep, waiting = now, _Sweep(int(now[1])), None
            run = {n: part[n][low:high] for n in names}
            head = run["head"]
            if head.any():
                sweep.start(*(run[n][head] for n in ("hour", "positives", "rows")))
            rows = [run[n][~head] for n in ("hour", "score", "positives", "rows")]
            if waiting is not None:
                rows = [np.r_[a, b] for a, b in zip(waiting, rows, strict=True)]
            score = rows[1]
            if not len(score):
                continue
            last = int(np.flatnonzero(np.r_[True, score[1:] != score[:-1]])[-1])
            if last:
                sweep.add(*(r[:last] for r in rows))
            waiting = [r[last:] for r in rows]
    if sweep is not None:
        if waiting is not None:
            sweep.add(*waiting)
        yield leave()


def _score_cuts(hourly: DataFrame, limit: int) -> list[float]:
    """Scores that cut every block into pieces of about ``limit`` rows.

    A block reads the hours of one block and the day after it, so never more
    than two blocks' rows.
    """
    blocks = hourly.groupBy(MODE, F.floor(F.col("hour") / BLOCK).alias("b"))
    largest = blocks.count().agg(F.max("count")).first()[0] or 0
    pieces = -(-2 * largest // limit)
    if pieces < 2:
        return []
    shares = [k / pieces for k in range(1, pieces)]
    cuts = hourly.agg(F.percentile_approx("score", shares, 10_000)).first()[0]
    return sorted(set(cuts))


def _piece(score: Column, cuts: list[float]) -> Column:
    """0 for scores from the highest cut on, then 1, 2, .. downwards."""
    if not cuts:
        return F.lit(0)
    above = F.filter(F.array(*map(F.lit, cuts)), lambda cut: score >= cut)
    return F.lit(len(cuts)) - F.size(above)


def _dealt(hourly: DataFrame, cuts: list[float]) -> DataFrame:
    """The rows of every block, with the head rows of its lower pieces."""
    block = F.explode(
        F.array_distinct(
            F.array(
                F.floor((F.col("hour") - (DAY - 1)) / BLOCK),
                F.floor(F.col("hour") / BLOCK),
            )
        )
    )
    columns = [MODE, "hour", "score", "positives", "rows"]
    pieces = hourly.select(*columns, _piece(F.col("score"), cuts).alias("piece"))
    rows = pieces.withColumn("head", F.lit(False))
    if cuts:
        sums = pieces.groupBy(MODE, "hour", "piece").agg(
            F.sum("positives").alias("positives"), F.sum("rows").alias("rows")
        )
        lower = F.explode(F.sequence(F.col("piece") + 1, F.lit(len(cuts))))
        heads = (
            sums.filter(F.col("piece") < len(cuts))
            .withColumn("piece", lower)
            .groupBy(MODE, "hour", "piece")
            .agg(F.sum("positives").alias("positives"), F.sum("rows").alias("rows"))
            .select(
                MODE, "hour", F.lit(0.0).alias("score"), "positives", "rows", "piece",
                F.lit(True).alias("head"),
            )
        )
        rows = rows.unionByName(heads)
    return rows.withColumn("block", block)


def window_areas(hourly: DataFrame, limit: int = TASK_ROWS) -> DataFrame:
    """(mode, window_hour, gained, stepped): sums of new hits times the mean
    precision of their step, and times the precision after it."""
    dealt = _dealt(hourly, _score_cuts(hourly, limit))
    keys = [MODE, "block", "piece"]
    order = [*keys, F.col("head").desc(), F.col("score").desc()]
    swept = dealt.repartition(*keys).sortWithinPartitions(*order)
    sums = swept.mapInArrow(_sweep, _SWEPT)
    return sums.groupBy(MODE, "window_hour").agg(
        F.sum("gained").alias("gained"), F.sum("stepped").alias("stepped")
    )


def metrics(
    hourly: DataFrame,
    threshold: float = 0.5,
    as_of=None,
    limit: int = TASK_ROWS,
) -> DataFrame:
    """24-hour quality of each mode, one window per hour, from hourly scores.

    With ``as_of`` only the window of the 24 full hours before it is computed,
    from those hours alone. Empty windows have no row.
    """
    if as_of is not None:
        end = hour_number(F.lit(as_of).cast("timestamp_ntz"))
        hourly = hourly.filter((F.col("hour") >= end - DAY) & (F.col("hour") < end))
    counts = window_counts(hourly, threshold)
    areas = window_areas(hourly, limit)
    if as_of is not None:
        counts = counts.filter(F.col("window_hour") == end - DAY)
    joined = counts.join(areas, [MODE, "window_hour"], "left")
    total = F.col("positives")

    def area(column: str, without: float) -> Column:
        share = F.coalesce(F.col(column), F.lit(0.0)) / F.when(total > 0, total)
        return F.coalesce(share, F.lit(without))

    found = joined.select(
        MODE,
        hour_time(F.col("window_hour")).alias("window_start"),
        area("gained", 0.5).alias("pr_auc"),
        area("stepped", 0.0).alias("average_precision"),
        F.lit(float(threshold)).alias("threshold"),
        F.col("hits").alias("tp"),
        (F.col("taken") - F.col("hits")).alias("fp"),
        (total - F.col("hits")).alias("fn"),
        (F.col("rows") - total - F.col("taken") + F.col("hits")).alias("tn"),
    )
    return confusion_metrics(found)


def score_histograms(log: DataFrame, bins: int = SCORE_BINS) -> DataFrame:
    """(evaluation_mode, hour, bin, rows) of model scores, equal bins of 0 to 1.

    A small table to keep: ``merge_hourly`` adds what a later log brings.
    """
    model = log.filter(
        (F.col("prediction_mode") == "model") & F.col("purchase_probability").isNotNull()
    )
    raw = F.floor(F.col("purchase_probability") * bins)
    place = F.greatest(F.lit(0), F.least(raw, F.lit(bins - 1))).cast("int")
    return model.groupBy(
        MODE, hour_number(F.col("prediction_time")).alias("hour"), place.alias("bin")
    ).agg(F.count(F.lit(1)).alias("rows"))


def score_drift(histograms: DataFrame, bins: int = SCORE_BINS) -> DataFrame:
    """(evaluation_mode, window_start, kl): each day's scores against the week
    before it.

    The divergence of the day from the week, on shares of at least
    ``SHARE_FLOOR``. Windows without scores in the day or in the week before
    have no row.
    """
    names = [f"n{i}" for i in range(bins)]
    counts = [F.sum(F.when(F.col("bin") == i, F.col("rows"))) for i in range(bins)]
    hourly = histograms.groupBy(MODE, "hour").agg(
        *[F.coalesce(n, F.lit(0)).alias(name) for n, name in zip(counts, names, strict=True)]
    )
    starts = hourly.select(MODE, _windows_of("hour").alias("hour")).distinct()
    marked = hourly.select(MODE, "hour", F.lit(False).alias("start"), *names).unionByName(
        starts.select(
            MODE, "hour", F.lit(True).alias("start"),
            *[F.lit(0).cast("long").alias(n) for n in names],
        )
    )
    in_time = Window.partitionBy(MODE).orderBy("hour")
    day, week = in_time.rangeBetween(0, DAY - 1), in_time.rangeBetween(-WEEK, -1)
    summed = marked.select(
        MODE,
        "hour",
        "start",
        F.array(*[F.sum(n).over(week) for n in names]).alias("p"),
        F.array(*[F.sum(n).over(day) for n in names]).alias("q"),
    ).filter("start")

    def shares(side: str) -> Column:
        counts = F.transform(side, lambda n: F.coalesce(n, F.lit(0)).cast("double"))
        total = F.aggregate(counts, F.lit(0.0), lambda a, n: a + n)
        floored = F.transform(counts, lambda n: F.greatest(n / total, F.lit(SHARE_FLOOR)))
        return F.when(total > 0, floored)

    def normal(side: str) -> Column:
        total = F.aggregate(side, F.lit(0.0), lambda a, n: a + n)
        return F.transform(side, lambda n: n / total)

    mass = summed.select(MODE, "hour", shares("p").alias("p"), shares("q").alias("q"))
    mass = mass.filter("p IS NOT NULL AND q IS NOT NULL")
    mass = mass.select(MODE, "hour", normal("p").alias("p"), normal("q").alias("q"))
    terms = F.zip_with("p", "q", lambda p, q: p * F.log(p / q))
    return mass.select(
        MODE,
        hour_time(F.col("hour")).alias("window_start"),
        F.aggregate(terms, F.lit(0.0), lambda a, x: a + x).alias("kl"),
    )
