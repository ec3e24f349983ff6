"""Drift, outcome labelling and online quality of logged predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import scalars as S
from clickloom.operators import rolling
from clickloom.operators.ordered import TASK_ROWS, exact_quantiles
from clickloom.operators.profile import bin_of
from clickloom.operators.sessions import SESSION, SESSION_ROWS, add_next_instant
from clickloom.session import cut_lineage

# Bins, floor and alert bands of the drift report.
DRIFT_BINS = 10
SHARE_FLOOR = 0.001
WARN_BAND = 0.1
RETRAIN_BAND = 0.2
PR_AUC_ALERT = 0.7

REPLAY_MODE = "demo_replay"
BACKFILL_MODE = "offline_backfill"
OUTCOME = ("actual_purchase", "ground_truth_time", "is_correct_prediction")


def drift(
    expected: DataFrame, actual: DataFrame, features, bins: int = DRIFT_BINS
) -> DataFrame:
    """PSI and KL divergence of each feature between two frames.

    Both sides are binned on the expected range; values beyond it count in the
    end bins. A feature without any expected value has no scores and no bands.
    """
    features = list(features)
    extremes = expected.agg(
        *[F.min(F.col(f).cast("double")).alias(f"low_{f}") for f in features],
        *[F.max(F.col(f).cast("double")).alias(f"high_{f}") for f in features],
    ).first()

    def binned(df, side):
        cells = [
            F.struct(
                F.lit(f).alias("feature"),
                bin_of(
                    F.col(f).cast("double"),
                    F.lit(extremes[f"low_{f}"]),
                    F.lit(extremes[f"high_{f}"]),
                    bins,
                ).alias("bin"),
            )
            for f in features
            if extremes[f"low_{f}"] is not None
        ]
        if not cells:
            return df.sparkSession.createDataFrame(
                [], "feature string, bin int, n long, side string"
            )
        listed = df.select(F.explode(F.array(*cells)).alias("_c")).select("_c.*")
        counted = listed.filter(F.col("bin").isNotNull()).groupBy("feature", "bin")
        return counted.agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))

    both = binned(expected, "e").unionByName(binned(actual, "a"))
    grid = both.select("feature").distinct().select(
        "feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    sides = both.groupBy("feature", "bin").agg(
        F.sum(F.when(F.col("side") == "e", F.col("n"))).alias("e"),
        F.sum(F.when(F.col("side") == "a", F.col("n"))).alias("a"),
    )
    filled = grid.join(sides, ["feature", "bin"], "left").fillna(0, ["e", "a"])
    per_feature = Window.partitionBy("feature")

    def share(column):
        total = F.sum(column).over(per_feature)
        part = F.col(column).cast("double") / F.when(total > 0, total)
        return F.greatest(F.coalesce(part, F.lit(0.0)), F.lit(SHARE_FLOOR))

    shares = filled.select("feature", share("e").alias("p"), share("a").alias("q"))
    mass = shares.withColumns(
        {
            "p1": F.col("p") / F.sum("p").over(per_feature),
            "q1": F.col("q") / F.sum("q").over(per_feature),
        }
    )
    scores = mass.groupBy("feature").agg(
        F.sum((F.col("q") - F.col("p")) * F.log(F.col("q") / F.col("p"))).alias("psi"),
        F.sum(F.col("p1") * F.log(F.col("p1") / F.col("q1"))).alias("kl"),
    )
    asked = F.explode(F.array(*map(F.lit, features))).alias("feature")
    named = expected.sparkSession.range(1).select(asked)
    scores = named.join(scores, "feature", "left")
    psi_band = (
        F.when(F.col("psi").isNull(), None)
        .when(F.col("psi") >= RETRAIN_BAND, "retrain")
        .when(F.col("psi") >= WARN_BAND, "warn")
        .otherwise("stable")
    )
    kl_band = (
        F.when(F.col("kl").isNull(), None)
        .when(F.col("kl") > RETRAIN_BAND, "retrain")
        .when(F.col("kl") > WARN_BAND, "warn")
        .otherwise("stable")
    )
    return scores.withColumns({"psi_band": psi_band, "kl_band": kl_band})


def prediction_instant():
    """Where the window of a prediction starts: on the source's own time line
    for backfill, else when it was made."""
    backfill = F.col("evaluation_mode") == BACKFILL_MODE
    return F.when(backfill, F.col("source_event_time")).otherwise(
        F.col("prediction_time")
    )


def purchase_lanes(events: DataFrame) -> DataFrame:
    """(user_session, evaluation_mode, instant): each purchase on both time
    lines. Purchases without a session are left out."""
    purchase = (F.col("event_type") == "purchase") & F.col(SESSION).isNotNull()
    lanes = F.explode(
        F.array(
            F.struct(F.lit(REPLAY_MODE).alias("m"), F.col("replay_time").alias("t")),
            F.struct(
                F.lit(BACKFILL_MODE).alias("m"), F.col("source_event_time").alias("t")
            ),
        )
    )
    listed = events.filter(purchase).select(SESSION, lanes.alias("_l"))
    return listed.select(
        SESSION, F.col("_l.m").alias("evaluation_mode"), F.col("_l.t").alias("instant")
    )


def label_outcomes(
    predictions: DataFrame,
    events: DataFrame,
    horizon_seconds: int = C.HORIZON_SECONDS,
    as_of=None,
    limit: int = SESSION_ROWS,
) -> DataFrame:
    """Fill ``actual_purchase``, ``is_correct_prediction``, ``ground_truth_time``.

    Replay predictions look at ``replay_time`` of purchases after
    ``prediction_time``; backfill ones stay on ``source_event_time``. Both are
    one ordered scan per session and mode, never prediction x purchase pairs.
    An open window at ``as_of`` with no purchase so far stays NULL, and so does
    a prediction without a session or with a mode that is neither. The ground
    truth time is the end of the window, and NULL as long as that is open.
    """
    known_mode = F.col("evaluation_mode").isin(REPLAY_MODE, BACKFILL_MODE)
    lane = F.concat("evaluation_mode", F.lit("|"), SESSION)
    instant = S.epoch_micros(prediction_instant())
    asked = predictions.withColumns(
        {"_us": instant, "_session": F.col(SESSION), SESSION: lane}
    ).withColumn("_bought", F.lit(False))
    bought = purchase_lanes(events).select(
        lane.alias(SESSION), S.epoch_micros(F.col("instant")).alias("_us")
    )
    bought = bought.withColumn("_bought", F.lit(True)).distinct()
    scanned = add_next_instant(
        asked.unionByName(bought, allowMissingColumns=True),
        "_us",
        F.col("_bought"),
        "_next",
        limit,
    ).filter(~F.col("_bought"))
    end = F.col("_us") + horizon_seconds * C.MICROS
    hit = F.col("_next") <= end
    actual = F.when(hit, 1).otherwise(0)
    closed = end
    if as_of is not None:
        known = S.epoch_micros(F.lit(as_of).cast("timestamp_ntz"))
        closed = F.when(end <= known, end)
        actual = (
            F.when(hit & (F.col("_next") <= known), 1).when(end <= known, 0)
        )
    asked_for = known_mode & F.col("_session").isNotNull()
    actual = F.when(asked_for, actual)
    truth = F.timestamp_micros(F.when(asked_for, closed)).cast("timestamp_ntz")
    guess = (F.col("purchase_probability") >= 0.5).cast("int")
    kept = [
        F.col("_session").alias(SESSION) if c == SESSION else F.col(c)
        for c in predictions.columns
        if c not in OUTCOME
    ]
    return scanned.select(
        *kept, actual.alias("actual_purchase"), truth.alias("ground_truth_time")
    ).withColumn("is_correct_prediction", F.col("actual_purchase") == guess)


def _day_windows(hour: str):
    """The 24 one-day windows, one hour apart, that hold an hour bucket."""
    first = F.col(hour) - F.expr("INTERVAL 23 HOURS")
    return F.explode(F.sequence(first, F.col(hour), F.expr("INTERVAL 1 HOUR")))


def online_metrics(
    labelled: DataFrame, limit: int = TASK_ROWS, as_of=None
) -> DataFrame:
    """24-hour metrics every hour and evaluation mode, fallback rows excluded.

    The hourly score counts are stored and swept in blocks of windows; with
    ``as_of`` only the last full day before it is read and computed.
    """
    if as_of is not None:
        end = F.date_trunc("hour", F.lit(as_of).cast("timestamp_ntz"))
        end = end.cast("timestamp_ntz")
        time = F.col("prediction_time")
        labelled = labelled.filter((time >= end - F.expr("INTERVAL 24 HOURS")) & (time < end))
    hourly = cut_lineage(rolling.hourly_scores(labelled))
    return rolling.metrics(hourly, 0.5, as_of, limit)


def coverage(labelled: DataFrame) -> DataFrame:
    """Per mode and 24-hour window: outcome coverage and fallback rate."""
    hourly = labelled.groupBy(
        "evaluation_mode",
        F.date_trunc("hour", "prediction_time").cast("timestamp_ntz").alias("_hour"),
    ).agg(
        F.count(F.lit(1)).alias("predictions"),
        F.count("actual_purchase").alias("known"),
        F.count_if(F.col("prediction_mode") == "fallback").alias("fallbacks"),
    )
    windowed = hourly.withColumn("window_start", _day_windows("_hour"))
    summed = windowed.groupBy("evaluation_mode", "window_start").agg(
        F.sum("predictions").alias("predictions"),
        F.sum("known").alias("known"),
        F.sum("fallbacks").alias("fallbacks"),
    )
    return summed.select(
        "evaluation_mode",
        "window_start",
        "predictions",
        (F.col("known") / F.col("predictions")).alias("outcome_coverage"),
        (F.col("fallbacks") / F.col("predictions")).alias("fallback_rate"),
    )


def degradation_alerts(quality: DataFrame, bound: float = PR_AUC_ALERT) -> DataFrame:
    """Windows whose PR-AUC and that of the hour before are below the bound."""
    by_mode = Window.partitionBy("evaluation_mode").orderBy("window_start")
    marked = quality.withColumns(
        {
            "_before": F.lag("pr_auc").over(by_mode),
            "_at": F.lag("window_start").over(by_mode),
        }
    )
    consecutive = F.col("_at") == F.col("window_start") - F.expr("INTERVAL 1 HOUR")
    low = (F.col("pr_auc") < bound) & (F.col("_before") < bound)
    return marked.filter(consecutive & low).select(
        "evaluation_mode", "window_start", "pr_auc"
    )


#: Metric, whether low or high values are bad, bound, hours in a row.
ALERT_RULES = (
    ("pr_auc", "low", 0.7, 2),
    ("f1", "low", 0.5, 2),
    ("kl", "high", 0.15, 1),
    ("outcome_coverage", "low", 0.8, 1),
    ("fallback_rate", "high", 0.05, 2),
)


def metric_alerts(*metrics: DataFrame) -> DataFrame:
    """(evaluation_mode, window_start, rule, value) of every broken alert rule.

    ``metrics`` are hourly tables that hold some of the rules' columns. Where a
    rule asks for two hours, the hour before must break it too.
    """
    keys = ["evaluation_mode", "window_start"]
    found = None
    for table in metrics:
        held = [name for name, *_ in ALERT_RULES if name in table.columns]
        numbers = [F.col(name).cast("double").alias(name) for name in held]
        long = table.select(*keys, *numbers).unpivot(keys, held, "rule", "value")
        found = long if found is None else found.unionByName(long)
    bad, hours = F.lit(False), F.lit(1)
    for name, side, bound, count in ALERT_RULES:
        broken = F.col("value") < bound if side == "low" else F.col("value") > bound
        bad = F.when(F.col("rule") == name, broken).otherwise(bad)
        hours = F.when(F.col("rule") == name, F.lit(count)).otherwise(hours)
    in_order = Window.partitionBy("evaluation_mode", "rule").orderBy("window_start")
    marked = found.withColumns({"_bad": bad, "_hours": hours}).withColumns(
        {
            "_before": F.lag("_bad").over(in_order),
            "_at": F.lag("window_start").over(in_order),
        }
    )
    follows = F.col("_at") == F.col("window_start") - F.expr("INTERVAL 1 HOUR")
    enough = (F.col("_hours") == 1) | (F.col("_before") & follows)
    return marked.filter(F.col("_bad") & enough).select(*keys, "rule", "value")


def gaps(predictions: DataFrame) -> DataFrame:
    """Latency (since the replay) and freshness (since the event) per mode."""
    kinds = {"latency": "replay_time", "freshness": "source_event_time"}
    parts = [
        latency(predictions, since).withColumn("gap", F.lit(gap))
        for gap, since in kinds.items()
    ]
    return parts[0].unionByName(parts[1])


def latency(
    predictions: DataFrame, since: str = "replay_time", keys=("evaluation_mode",)
) -> DataFrame:
    """p50/p95/p99 seconds from ``since`` to the prediction."""
    spent = S.epoch_micros(F.col("prediction_time")) - S.epoch_micros(F.col(since))
    seconds = predictions.select(*keys, (spent / F.lit(1e6)).alias("seconds"))
    marks = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
    return exact_quantiles(seconds, "seconds", marks, keys=list(keys))
