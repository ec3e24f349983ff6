from __future__ import annotations

import random

import pytest

from clickloom.operators import evaluation as E

# With ties, and one negative above the lowest positive.
LABELS = [1, 1, 0, 1, 0, 1, 0, 0]
SCORES = [0.95, 0.5, 0.5, 0.5, 0.35, 0.3, 0.15, 0.05]


def scored(spark, pairs, name="m"):
    data = [(name, int(y), float(s)) for y, s in pairs]
    return spark.createDataFrame(data, "model string, label int, score double")


def plain(pairs):
    """Curve, areas and best threshold by definition."""
    total = sum(y for y, _ in pairs)
    points, last, area, average = [], (0.0, 1.0), 0.0, 0.0
    for t in sorted({s for _, s in pairs}, reverse=True):
        hits = [y for y, s in pairs if s >= t]
        p, r = sum(hits) / len(hits), sum(hits) / total
        area += (r - last[0]) * (p + last[1]) / 2
        average += (r - last[0]) * p
        last = (r, p)
        points.append((t, p, r, 2 * (p * r) / (p + r + 1e-10)))
    best = max(points, key=lambda x: (x[3], -x[0]))
    return points, area, average, best[0]


def test_ranking_with_ties_and_a_misplaced_positive(spark):
    pairs = list(zip(LABELS, SCORES))
    row = E.metrics(scored(spark, pairs)).first()
    _, area, average, best = plain(pairs)
    assert row["pr_auc"] == pytest.approx(area) and area < 1
    assert row["average_precision"] == pytest.approx(average)
    assert row["threshold"] == best == 0.3
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (4, 2, 0, 2)


def test_null_model_has_metrics_on_both_paths(spark):
    rows = [(None, y, s) for y, s in zip(LABELS, SCORES)] * 3
    rows += [("m", y, 1 - s) for y, s in zip(LABELS, SCORES)]
    frame = spark.createDataFrame(rows, "model string, label int, score double")
    found = [
        sorted(map(str, E.metrics(frame, ["model"], limit=limit).collect()))
        for limit in (10**6, 3)
    ]
    assert len(found[0]) == 2 and found[0] == found[1]


@pytest.mark.parametrize("limit", [10**6, 5])
def test_random_scores_equal_the_definition(spark, limit):
    rnd = random.Random(4)
    pairs = [(int(rnd.random() < 0.3), rnd.randrange(30) / 30) for _ in range(300)]
    points, area, average, best = plain(pairs)
    frame = scored(spark, pairs)
    row = E.metrics(frame, ["model"], limit=limit).first()
    assert row["pr_auc"] == pytest.approx(area)
    assert row["average_precision"] == pytest.approx(average)
    assert row["threshold"] == best
    assert E.best_threshold(frame, ["model"]).first()["threshold"] == best
    curve = E.pr_curve(frame, ["model"], limit=limit).collect()
    found = {r["threshold"]: (r["precision"], r["recall"]) for r in curve}
    assert found.pop(None) == (1.0, 0.0)
    assert found == {t: (pytest.approx(p), pytest.approx(r)) for t, p, r, _ in points}


def test_given_threshold_and_empty_predictions(spark):
    row = E.metrics(scored(spark, list(zip(LABELS, SCORES))), threshold=0.99).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    assert row["threshold"] == 0.99 and row["fn"] == 4


def test_no_positive_label(spark):
    row = E.metrics(scored(spark, [(0, 0.2), (0, 0.4)])).first()
    assert row["pr_auc"] == pytest.approx(0.5) and row["threshold"] == 0.2


def test_best_model_takes_the_first_on_a_tie(spark):
    table = spark.createDataFrame(
        [("b", 0.5, 1), ("a", 0.5, 0), ("c", 0.4, 2)],
        "candidate string, pr_auc double, candidate_order int",
    )
    assert E.best_model(table).first()["candidate"] == "a"


GATE = "pr_auc double, production_pr_auc double, floor double, override boolean, " \
    "override_by string, override_reason string, override_time string"


@pytest.mark.parametrize(
    "row, passed",
    [
        ((0.6, None, 0.5, False, None, None, None), True),
        ((0.1, None, 0.5, False, None, None, None), True),
        ((0.4, 0.3, 0.5, False, None, None, None), False),
        ((0.6, 0.6, 0.5, False, None, None, None), True),
        ((0.7, 0.6, 0.5, False, None, None, None), True),
        ((0.6, 0.7, 0.5, False, None, None, None), False),
        ((0.1, 0.7, 0.5, True, "me", "why", "now"), True),
    ],
)
def test_gate(spark, row, passed):
    verdict = E.gate_verdict(spark.createDataFrame([row], GATE)).first()
    assert verdict["passed"] is passed


@pytest.mark.parametrize("absent", E.AUDIT_COLUMNS)
def test_override_needs_its_audit(spark, absent):
    audit = {"override_by": "me", "override_reason": "why", "override_time": "now"}
    audit[absent] = None
    row = (0.1, 0.7, 0.5, True, *audit.values())
    with pytest.raises(Exception, match=f"needs {absent}"):
        E.gate_verdict(spark.createDataFrame([row], GATE)).collect()


def test_seeded_sample_is_stable(spark):
    frame = spark.range(1000)
    first = {r[0] for r in E.seeded_sample(frame, 50).collect()}
    again = {r[0] for r in E.seeded_sample(frame.repartition(7), 50).collect()}
    assert first == again and len(first) == 50
