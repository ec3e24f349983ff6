from __future__ import annotations

import datetime as dt
import random

import pytest

from clickloom.operators import monitoring
from clickloom.sources import streams
from clickloom.streaming import outcomes
from clickloom.streaming.sinks import drain
from clickloom.workload import queries
from data import START, event, silver
from pyspark.sql import functions as F

LOG = (
    "prediction_id string, user_session string, prediction_time timestamp_ntz, "
    "source_event_time timestamp_ntz, purchase_probability double, "
    "prediction_mode string, evaluation_mode string"
)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def case(seed=5, span=4000):
    rnd = random.Random(seed)
    lanes = ["demo_replay", "offline_backfill", "other", None]
    asked = []
    for i in range(160):
        seconds = rnd.randrange(span)
        asked.append((
            f"p{i}", rnd.choice(["hot", "hot", "s1", "s2", None]), at(seconds + 3), at(seconds),
            rnd.random(), "model", rnd.choice(lanes[:2] * 3 + lanes),
        ))
    sold = [
        event(rnd.choice(["hot", "s1"]), rnd.randrange(span), rnd.choice(["purchase", "view"]), product=f"p{i}")
        for i in range(60)
    ]
    asked.sort(key=lambda r: r[3])
    sold.sort(key=lambda r: r[0])
    return asked, sold


def replayed(spark, rows):
    return silver(spark, rows).withColumn("replay_time", F.col("source_event_time") + F.expr("INTERVAL 2 SECONDS"))


def put(frame, path, n):
    frame.coalesce(n).write.mode("append").parquet(path)


@pytest.mark.parametrize("salts", [1, 4])
def test_closed_windows_equal_the_batch_form(spark, tmp_path, salts):
    asked, sold = case()
    log, events = spark.createDataFrame(asked, LOG), replayed(spark, sold)
    base = str(tmp_path)
    reached = []
    for number in range(4):  # each run adds a quarter and goes on from the checkpoint
        quarter = lambda rows: rows[number * len(rows) // 4 : (number + 1) * len(rows) // 4]  # noqa: B023, E731
        put(spark.createDataFrame(quarter(asked), LOG), f"{base}/asked", 2)
        put(replayed(spark, quarter(sold)), f"{base}/sold", 2)
        left = streams.file_events(spark, f"{base}/asked", log.schema, files_per_trigger=2)
        right = streams.file_events(spark, f"{base}/sold", events.schema, files_per_trigger=2)
        hits = outcomes.purchase_hits(left, right, 300, 400, salts)
        outcomes.follow(hits, f"{base}/out", f"{base}/checkpoint")
        reached.append(outcomes.closed_until(spark, f"{base}/out"))
    assert reached == sorted(reached) and reached[0] < reached[-1]
    found = outcomes.settled(log, f"{base}/out", 300)
    want = monitoring.label_outcomes(log, events, 300)
    assert found.columns == want.columns
    expected = {r["prediction_id"]: r for r in want.collect()}
    open_windows = hits_seen = 0
    for r in found.collect():
        whole = expected[r["prediction_id"]]
        if whole["ground_truth_time"] is not None and whole["ground_truth_time"] <= reached[-1]:
            assert r == whole
            hits_seen += r["actual_purchase"]
        else:
            assert r["actual_purchase"] is None and r["ground_truth_time"] is None
            assert r["is_correct_prediction"] is None
            open_windows += 1
    assert open_windows and hits_seen > 10 and found.count() == len(asked)


def test_a_prediction_leaves_once(spark, tmp_path):
    """Many purchases in the window do not multiply the prediction."""
    asked = [(f"p{i}", "hot", at(i), at(i), 0.9, "model", "demo_replay") for i in range(30)]
    sold = [event("hot", 40 + i, "purchase", product=f"p{i}") for i in range(30)]
    base = str(tmp_path)
    put(spark.createDataFrame(asked, LOG), f"{base}/asked", 1)
    put(replayed(spark, sold), f"{base}/sold", 1)
    left = streams.file_events(spark, f"{base}/asked", spark.createDataFrame(asked, LOG).schema)
    right = streams.file_events(spark, f"{base}/sold", replayed(spark, sold).schema)
    outcomes.follow(outcomes.purchase_hits(left, right, 300), f"{base}/out", f"{base}/checkpoint")
    assert spark.read.parquet(f"{base}/out/hits").count() == 30


def test_a_purchase_is_held_for_two_slices_of_a_lane(spark, tmp_path):
    """Not once per salt: the state grows with the rows of both streams."""
    asked = [(f"p{i}", f"s{i % 5}", at(i), at(i), 0.9, "model", "demo_replay") for i in range(40)]
    sold = [event(f"s{i % 5}", 40 + i, "purchase", product=f"p{i}") for i in range(40)]
    log, base = spark.createDataFrame(asked, LOG), str(tmp_path)
    put(log, f"{base}/asked", 1)
    put(replayed(spark, sold), f"{base}/sold", 1)
    left = streams.file_events(spark, f"{base}/asked", log.schema)
    right = streams.file_events(spark, f"{base}/sold", replayed(spark, sold).schema)
    hits = outcomes.purchase_hits(left, right, 300)
    query = drain(hits, lambda batch, number: batch.count(), f"{base}/checkpoint")
    held = sum(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"])
    assert 40 + 2 * 40 <= held <= 40 + 2 * 2 * 40


@pytest.mark.parametrize("seconds", [299, 300, 301, 600])
def test_windows_reach_over_the_bound_of_a_slice(spark, tmp_path, seconds):
    """One prediction on a bound of the slices and one inside, a purchase after each."""
    on = START - (START - dt.datetime(1970, 1, 1)) % dt.timedelta(seconds=300)
    times = {"on": on, "in": on + dt.timedelta(seconds=150)}
    asked = [(n, n, t, t, 0.9, "model", "offline_backfill") for n, t in times.items()]
    later = dt.timedelta(seconds=seconds)
    sold = [event(n, (t + later - START).total_seconds(), "purchase") for n, t in times.items()]
    log, base = spark.createDataFrame(asked, LOG), str(tmp_path)
    put(log, f"{base}/asked", 1)
    put(replayed(spark, sold), f"{base}/sold", 1)
    left = streams.file_events(spark, f"{base}/asked", log.schema)
    right = streams.file_events(spark, f"{base}/sold", replayed(spark, sold).schema)
    outcomes.follow(outcomes.purchase_hits(left, right, 300), f"{base}/out", f"{base}/checkpoint")
    hits = {r[0] for r in spark.read.parquet(f"{base}/out/hits").select("prediction_id").collect()}
    assert hits == ({"on", "in"} if seconds <= 300 else set())


def test_a_trigger_has_as_many_files_as_its_rows_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 10, raising=False)
    rows = spark.range(160).select(F.col("id").alias("arrival"))
    queries._arriving(spark, rows, str(tmp_path))
    read = spark.read.parquet(f"{tmp_path}/in")
    assert len(read.inputFiles()) == queries.TRIGGERS * 4 and read.count() == 160


def test_ground_truth_time_waits_for_the_window(spark):
    log = spark.createDataFrame(
        [("a", "s", at(0), at(0), 0.9, "model", "demo_replay"), ("b", None, at(0), at(0), 0.9, "model", "demo_replay")], LOG
    )
    events = replayed(spark, [event("s", 10, "purchase")])
    early = {r["prediction_id"]: r for r in monitoring.label_outcomes(log, events, 100, as_of=at(50).isoformat()).collect()}
    assert early["a"]["actual_purchase"] == 1 and early["a"]["ground_truth_time"] is None
    late = {r["prediction_id"]: r for r in monitoring.label_outcomes(log, events, 100, as_of=at(100).isoformat()).collect()}
    assert late["a"]["ground_truth_time"] == at(100) and late["b"]["ground_truth_time"] is None
