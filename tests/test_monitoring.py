from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import lineage, monitoring
from clickloom.plans import lake
from data import START, event, plain_gold, random_events, silver

LOG = (
    "prediction_id string, user_session string, prediction_time timestamp_ntz, "
    "source_event_time timestamp_ntz, purchase_probability double, "
    "prediction_mode string, evaluation_mode string"
)


def prediction(i, session, seconds, source=None, p=0.4, mode="model", lane="demo_replay"):
    at = START + dt.timedelta(seconds=seconds)
    shown = START + dt.timedelta(seconds=seconds if source is None else source)
    return (f"p{i}", session, at, shown, p, mode, lane)


def replayed(spark, rows, delay=2):
    shift = F.expr(f"INTERVAL {delay} SECONDS")
    return silver(spark, rows).withColumn("replay_time", F.col("source_event_time") + shift)


@pytest.mark.parametrize("limit", [10**6, 20])
def test_outcomes_equal_the_plain_rule(spark, limit):
    rnd = random.Random(2)
    rows = random_events(2, rows=400, span=900)
    asked = [
        prediction(
            i, rnd.choice(["hot", "hot", "s1", "s2", "none"]), rnd.randrange(900),
            rnd.randrange(900), rnd.random(),
            lane=rnd.choice(["demo_replay", "offline_backfill"]),
        )
        for i in range(200)
    ]
    frame = spark.createDataFrame(asked, LOG)
    found = monitoring.label_outcomes(frame, replayed(spark, rows), 60, limit=limit)
    expected = {}
    for name, session, at, source, p, _, lane in asked:
        start, shift = (at, 2) if lane == "demo_replay" else (source, 0)
        bought = any(
            r[5] == session and r[1] == "purchase"
            and 0 < (r[0] + dt.timedelta(seconds=shift) - start).total_seconds() <= 60
            for r in rows
        )
        expected[name] = (session, int(bought), (p >= 0.5) == bought)
    assert {
        r["prediction_id"]: (
            r["user_session"], r["actual_purchase"], r["is_correct_prediction"]
        )
        for r in found.collect()
    } == expected


def test_open_windows_stay_unknown(spark):
    rows = [event("a", 30, "purchase"), event("b", 500, "purchase")]
    frame = spark.createDataFrame(
        [prediction(0, "a", 0), prediction(1, "b", 0), prediction(2, "b", 450)], LOG
    )
    as_of = (START + dt.timedelta(seconds=400)).isoformat()
    found = monitoring.label_outcomes(frame, replayed(spark, rows, 0), 100, as_of=as_of)
    got = {r["prediction_id"]: r["actual_purchase"] for r in found.collect()}
    assert got == {"p0": 1, "p1": 0, "p2": None}


def test_drift_equals_the_formula(spark):
    rnd = random.Random(3)
    old = [rnd.gauss(0, 1) for _ in range(500)]
    new = [rnd.gauss(0.8, 1.3) for _ in range(400)]
    frame = lambda v: spark.createDataFrame([(x, 1.0) for x in v], "x double, c double")
    rows = {r["feature"]: r for r in monitoring.drift(frame(old), frame(new), ["x", "c"]).collect()}
    edges = np.linspace(min(old), max(old), 11)
    inside = np.clip(new, min(old), max(old))
    share = lambda v: np.clip(np.histogram(v, edges)[0] / len(v), 0.001, None)
    p, q = share(old), share(inside)
    assert rows["x"]["psi"] == pytest.approx(np.sum((q - p) * np.log(q / p)))
    p, q = p / p.sum(), q / q.sum()
    assert rows["x"]["kl"] == pytest.approx(np.sum(p * np.log(p / q)))
    assert rows["x"]["psi_band"] == "retrain" and rows["c"]["psi_band"] == "stable"


def test_alerts_need_two_hours_in_a_row(spark):
    hours = [(0, 0.6), (1, 0.9), (2, 0.6), (3, 0.5), (5, 0.1)]
    frame = spark.createDataFrame(
        [("m", START + dt.timedelta(hours=h), v) for h, v in hours],
        "evaluation_mode string, window_start timestamp_ntz, pr_auc double",
    )
    rows = monitoring.degradation_alerts(frame).collect()
    assert [r["window_start"] for r in rows] == [START + dt.timedelta(hours=3)]


def test_manifest_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "table")
    spark.range(5).coalesce(1).write.parquet(path)
    first = lineage.manifest(spark, path).first()
    assert first["file_count"] == 1
    assert lineage.manifest(spark, path).first() == first
    spark.range(5).coalesce(1).write.mode("append").parquet(path)
    second = lineage.manifest(spark, path).first()
    assert second["file_count"] == 2 and second["manifest_hash"] != first["manifest_hash"]


def test_retraining_uses_only_the_window(spark):
    day = 86400
    rows = [event("old", 0), event("s", 8 * day), event("s", 8 * day + 60, "purchase")]
    rows += [event(f"x{i}", 9 * day + i) for i in range(9)]
    frame, split_map = lake.retrain_gold(
        silver(spark, rows), (START + dt.timedelta(days=10)).isoformat()
    )
    assert split_map.count() == 10 and frame.count() == 11
    expected = plain_gold(rows, 600)
    for r in frame.filter("user_session = 's'").collect():
        key = ("s", r["source_event_time"], r["event_type"], r["product_id"])
        assert r["label"] == expected[key][-1]


def test_retraining_reads_only_the_days_it_needs(spark, tmp_path):
    """Date folders are pruned, fractions of a second are kept."""
    rows = [event(f"s{d}", d * 86400 + 0.25 + k, "view", f"p{k}") for d in range(12) for k in range(3)]
    rows += [event("s9", 9 * 86400 + 0.5, "purchase")]
    log = silver(spark, rows).withColumn("event_date", F.to_date("source_event_time"))
    log.write.partitionBy("event_date").parquet(str(tmp_path / "log"))
    stored = spark.read.parquet(str(tmp_path / "log"))
    as_of = (START + dt.timedelta(days=10)).isoformat()
    recent = lake.retrain_events(stored, as_of, 3)
    plan = recent._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan.replace("\n", "")
    assert {r["user_session"] for r in recent.collect()} == {"s7", "s8", "s9"}
    frame, _ = lake.retrain_gold(stored, as_of, 3, 600)
    times = sorted(r["source_event_time"] for r in frame.filter("user_session = 's9'").collect())
    assert [t.microsecond for t in times] == [250000, 500000, 250000, 250000]
    first = frame.filter("user_session = 's9'").orderBy("source_event_time").first()
    assert first["label"] == 1
