"""Precision-recall evaluation of scored rows as DataFrame aggregations.

Rows first collapse to (score, positives, rows); everything else works on
distinct scores. ``keys`` evaluates many models or periods in one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.operators.ordered import TASK_ROWS, running_sums


def score_counts(
    scored: DataFrame,
    keys: Sequence[str] = (),
    score: str = "score",
    label: str = C.LABEL,
) -> DataFrame:
    return scored.groupBy(*keys, F.col(score).alias("score")).agg(
        F.sum(F.col(label).cast("long")).alias("positives"),
        F.count(F.lit(1)).alias("rows"),
    )


def _ratio(top, bottom, empty: float):
    return F.when(bottom == 0, F.lit(empty)).otherwise(
        top.cast("double") / F.when(bottom != 0, bottom)
    )


def curve_steps(
    counts: DataFrame,
    keys: Sequence[str] = (),
    limit: int = TASK_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """One row per distinct score: hits and rows at or above it, P, R and F1.

    The previous step is the running sum without the row's own share, so no
    further ordered pass is needed.
    """
    ranked = running_sums(
        counts,
        keys,
        [F.col("score").desc()],
        {"hits": "positives", "taken": "rows"},
        limit,
        largest,
    )
    total = F.col("hits_total")
    before_hits = F.col("hits") - F.col("positives")
    before_taken = F.col("taken") - F.col("rows")
    precision = F.col("hits").cast("double") / F.col("taken")
    recall = _ratio(F.col("hits"), total, 1.0)
    stepped = ranked.withColumns(
        {
            "precision": precision,
            "recall": recall,
            "precision_before": _ratio(before_hits, before_taken, 1.0),
            "recall_before": F.when(before_taken == 0, F.lit(0.0)).otherwise(
                _ratio(before_hits, total, 1.0)
            ),
        }
    )
    p, r = F.col("precision"), F.col("recall")
    return stepped.withColumn("f1", 2 * (p * r) / (p + r + F.lit(1e-10)))


def pr_curve(
    scored: DataFrame,
    keys: Sequence[str] = (),
    score: str = "score",
    label: str = C.LABEL,
    limit: int = TASK_ROWS,
) -> DataFrame:
    """The curve over all distinct scores plus its end point (1, 0)."""
    steps = curve_steps(score_counts(scored, keys, score, label), keys, limit)
    points = steps.select(
        *keys, F.col("score").alias("threshold"), "precision", "recall"
    )
    end = steps.select(*keys).distinct() if keys else steps.limit(1).select()
    ends = end.select(
        *keys,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return points.unionByName(ends)


def metrics_from_counts(
    counts: DataFrame,
    keys: Sequence[str] = (),
    threshold: float | None = None,
    limit: int = TASK_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """PR-AUC, average precision and the confusion matrix at a threshold.

    Without a threshold the F1-optimal one is used, the lowest on a tie.
    """
    steps = curve_steps(counts, keys, limit, largest)
    gain = F.col("recall") - F.col("recall_before")
    mean_precision = (F.col("precision") + F.col("precision_before")) / 2
    best = F.max(F.struct("f1", (-F.col("score")).alias("s"), "hits", "taken"))
    if threshold is None:
        chosen = F.coalesce(-F.col("_best.s"), F.lit(C.FALLBACK_PROBABILITY))
        hits, taken = F.col("_best.hits"), F.col("_best.taken")
    else:
        chosen = F.lit(float(threshold))
        hits, taken = F.col("_hits"), F.col("_taken")
    above = F.col("score") >= F.lit(0.0 if threshold is None else float(threshold))
    summed = steps.groupBy(*keys).agg(
        F.sum(gain * mean_precision).alias("pr_auc"),
        F.sum(gain * F.col("precision")).alias("average_precision"),
        best.alias("_best"),
        F.coalesce(F.sum(F.when(above, F.col("positives"))), F.lit(0)).alias("_hits"),
        F.coalesce(F.sum(F.when(above, F.col("rows"))), F.lit(0)).alias("_taken"),
        F.max("hits_total").alias("_positives"),
        F.max("taken_total").alias("_rows"),
    )
    counted = summed.select(
        *keys,
        "pr_auc",
        "average_precision",
        chosen.alias("threshold"),
        hits.alias("tp"),
        (taken - hits).alias("fp"),
        (F.col("_positives") - hits).alias("fn"),
        (F.col("_rows") - F.col("_positives") - taken + hits).alias("tn"),
    )
    return confusion_metrics(counted)


def confusion_metrics(counted: DataFrame) -> DataFrame:
    """Add precision, recall and F1 to rows with tp, fp and fn."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.withColumns(
        {
            "precision": _ratio(tp, tp + fp, 0.0),
            "recall": _ratio(tp, tp + fn, 0.0),
            "f1": _ratio(2 * tp, 2 * tp + fp + fn, 0.0),
        }
    )


def metrics(
    scored: DataFrame,
    keys: Sequence[str] = (),
    score: str = "score",
    label: str = C.LABEL,
    threshold: float | None = None,
    limit: int = TASK_ROWS,
) -> DataFrame:
    counts = score_counts(scored, keys, score, label)
    return metrics_from_counts(counts, keys, threshold, limit)


def best_threshold(scored: DataFrame, keys: Sequence[str] = (), **columns):
    return metrics(scored, keys, **columns).select(*keys, "threshold")


def best_model(model_metrics: DataFrame, order: str = "candidate_order") -> DataFrame:
    """The row with the highest PR-AUC, the earliest candidate on a tie."""
    return model_metrics.orderBy(F.col("pr_auc").desc(), F.col(order)).limit(1)


AUDIT_COLUMNS = ("override_by", "override_reason", "override_time")


def gate_verdict(candidates: DataFrame) -> DataFrame:
    """Add ``passed`` and ``rule`` to candidate rows.

    Needs ``pr_auc, production_pr_auc, floor, override`` and the audit columns.
    An override without full audit is an error that names the field.
    """
    checks = F.lit(False)
    for name in reversed(AUDIT_COLUMNS):
        message = F.lit(f"an override needs {name}")
        checks = F.when(F.col(name).isNull(), F.raise_error(message).cast("boolean")
        ).otherwise(checks)
    audited = F.when(F.col("override"), ~F.coalesce(checks, F.lit(False)))
    production = F.col("production_pr_auc")
    rule = (
        F.when(F.coalesce(audited, F.lit(False)), "override")
        .when(production.isNull(), "first_model")
        .when(F.col("pr_auc") < F.col("floor"), "below_floor")
        .when(F.col("pr_auc") >= production, "not_worse")
        .otherwise("worse")
    )
    passed = F.col("rule").isin("override", "first_model", "not_worse")
    return candidates.withColumn("rule", rule).withColumn("passed", passed)


def seeded_sample(
    df: DataFrame, rows: int = C.SAMPLE_ROWS, seed: int = 42
) -> DataFrame:
    """At most ``rows`` rows, the same ones for the same seed."""
    return df.orderBy(F.xxhash64(F.lit(seed), *df.columns), *df.columns).limit(rows)
