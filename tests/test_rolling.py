from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import monitoring, rolling

HOUR = dt.timedelta(hours=1)
START = dt.datetime(2024, 3, 1, 22)
SCHEMA = (
    "prediction_time timestamp_ntz, purchase_probability double, prediction_mode string, "
    "evaluation_mode string, actual_purchase int"
)


def log(seed=4, rows=600, hours=90):
    rnd = random.Random(seed)
    out = []
    for _ in range(rows):
        at = START + dt.timedelta(seconds=rnd.randrange(hours * 3600))
        score = rnd.choice([0.5, None, round(rnd.random(), 2), rnd.random()])
        mode = rnd.choice(["model"] * 5 + ["fallback"])
        out.append((at, score, mode, rnd.choice("ab"), rnd.choice([0, 0, 1, None])))
    # a lane without purchases, and one far away hour
    out += [(START + k * HOUR, 0.3 + k / 100, "model", "never", 0) for k in range(5)]
    out.append((START + 400 * HOUR, 0.7, "model", "a", 1))
    return out


def curve(rows):
    """Areas by walking down the distinct scores."""
    total = sum(y for _, y in rows)
    hits = taken = 0
    area = average = 0.0
    before, found = 1.0, 0.0
    for score in sorted({s for s, _ in rows}, reverse=True):
        here = [y for s, y in rows if s == score]
        hits, taken = hits + sum(here), taken + len(here)
        precision, recall = hits / taken, hits / total if total else 1.0
        area += (recall - found) * (precision + before) / 2
        average += (recall - found) * precision
        before, found = precision, recall
    return area, average


def plain(rows, first, last=None):
    kept = [
        (float("-inf") if s is None else s, y)
        for at, s, mode, lane, y in rows
        if mode == "model" and y is not None and first <= at < first + 24 * HOUR
    ]
    return kept


def windows(rows):
    found = defaultdict(list)
    for row in rows:
        hour = row[0].replace(minute=0, second=0)
        for back in range(24):
            found[row[3], hour - back * HOUR].append(row)
    return found


@pytest.mark.parametrize("limit", [10**6, 60, 7])
def test_every_window_equals_its_own_curve(spark, limit):
    rows = log()
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = {
        (r["evaluation_mode"], r["window_start"]): r
        for r in monitoring.online_metrics(frame, limit).collect()
    }
    expected = {}
    for (lane, first), inside in windows(rows).items():
        kept = plain(inside, first)
        if kept:
            expected[lane, first] = kept
    assert set(found) == set(expected)
    for key, kept in expected.items():
        r = found[key]
        area, average = curve(kept)
        assert r["pr_auc"] == pytest.approx(area) and r["average_precision"] == pytest.approx(average)
        above = [y for s, y in kept if s >= 0.5]
        assert (r["tp"], r["fp"]) == (sum(above), len(above) - sum(above))
        assert r["tp"] + r["fn"] == sum(y for _, y in kept)
        assert r["tp"] + r["fp"] + r["fn"] + r["tn"] == len(kept)


def test_as_of_is_one_of_the_windows(spark):
    frame = spark.createDataFrame(log(), SCHEMA)
    every = monitoring.online_metrics(frame)
    for hours in (24, 50, 113, 400, 900):
        as_of = (START + hours * HOUR + dt.timedelta(minutes=12)).isoformat()
        one = monitoring.online_metrics(frame, as_of=as_of)
        start = F.lit(START + (hours - 24) * HOUR).cast("timestamp_ntz")
        assert sorted(one.collect()) == sorted(every.filter(F.col("window_start") == start).collect())


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert monitoring.online_metrics(frame).collect() == []
    assert rolling.score_drift(rolling.score_histograms(frame)).collect() == []


def test_rows_are_not_copied_to_their_windows(spark):
    """A row goes to at most two blocks, and the scores are shuffled once."""
    hourly = rolling.hourly_scores(spark.createDataFrame(log(), SCHEMA)).cache()
    hourly.count()
    dealt = rolling._dealt(hourly, [])
    assert dealt.count() <= 2 * hourly.count()
    plan = rolling.window_areas(hourly)._jdf.queryExecution().executedPlan().toString()
    scores = [line for line in plan.split("\n") if "Exchange" in line and "block" in line]
    assert len(scores) == 1


def test_merged_states_equal_one_state(spark):
    rows = log()
    frames = [spark.createDataFrame(part, SCHEMA) for part in (rows[::2], rows[1::2], rows)]
    for state in (rolling.hourly_scores, rolling.score_histograms):
        a, b, whole = (state(f) for f in frames)
        merged = rolling.merge_hourly(a, b)
        assert sorted(merged.collect()) == sorted(whole.select(merged.columns).collect())


def test_score_drift_equals_the_formula(spark):
    rows = log(rows=2000, hours=300)
    frame = spark.createDataFrame(rows, SCHEMA)
    found = {
        (r["evaluation_mode"], r["window_start"]): r["kl"]
        for r in rolling.score_drift(rolling.score_histograms(frame)).collect()
    }
    expected = {}
    for lane, first in windows([r for r in rows if r[2] == "model" and r[1] is not None]):
        def shares(low, high):
            scores = [r[1] for r in rows if r[2] == "model" and r[3] == lane and r[1] is not None and low <= r[0] < high]
            if not scores:
                return None
            bins = np.bincount([min(9, int(x * 10)) for x in scores], minlength=10)
            share = np.clip(bins / len(scores), 0.001, None)
            return share / share.sum()
        p, q = shares(first - 168 * HOUR, first), shares(first, first + 24 * HOUR)
        if p is not None and q is not None:
            expected[lane, first] = float(np.sum(p * np.log(p / q)))
    assert set(found) == set(expected) and len(found) > 100
    for key, kl in expected.items():
        assert found[key] == pytest.approx(kl)


def test_a_feature_without_values_is_reported(spark):
    rows = [(float(i % 7), None) for i in range(50)]
    frame = spark.createDataFrame(rows, "x double, y double")
    found = {r["feature"]: r for r in monitoring.drift(frame, frame, ["x", "y"]).collect()}
    assert found["x"]["psi_band"] == "stable" and found["y"]["psi"] is None
    assert found["y"]["psi_band"] is None and found["y"]["kl_band"] is None
    some = [(float(i % 7), None if i % 3 else float(i % 5)) for i in range(50)]
    less = spark.createDataFrame(some, "x double, y double")
    whole = monitoring.drift(less.dropna(), less.dropna(), ["y"]).collect()
    assert monitoring.drift(less, less.dropna(), ["y"]).collect() == whole
    only = monitoring.drift(frame, frame, ["y"]).collect()
    assert [(r["feature"], r["psi"]) for r in only] == [("y", None)]
