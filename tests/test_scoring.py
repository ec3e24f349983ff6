from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.operators import encoding, gold
from clickloom.plans import scoring, training
from clickloom.sinks import tables as sinks
from data import event, random_events, silver

STATE = {
    "user_session": "s1",
    "serving_total_views": 3,
    "serving_total_carts": 1,
    "serving_net_cart_count": 1,
    "serving_cart_to_view_ratio": 1 / 3,
    "serving_unique_categories": 2,
    "serving_unique_products": 2,
    "serving_session_duration_sec": 60.0,
    "serving_price": 10.0,
    "serving_category_id": "c1",
    "serving_category_code": "",
    "serving_brand": "new-brand",
    "serving_event_type": "view",
}


def states(spark, *changes):
    return spark.createDataFrame([{**STATE, **change} for change in changes])


def requests(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "user_session string")


@pytest.fixture(scope="module")
def fitted(spark):
    gold_rows = gold.snapshots(silver(spark, random_events(7)), 60).cache()
    words = encoding.fit_vocabulary(gold_rows)
    frame = encoding.encode(encoding.model_frame(gold_rows), words)
    return {"train": frame, "val": frame, "test": frame}, words


@pytest.fixture(scope="module")
def trained(fitted):
    return training.run(fitted[0], trials=1)


def test_report_and_gate(trained):
    _, threshold, report = trained
    row = report.first()
    assert row["winner_name"] in {name for name, _ in training.candidates()}
    assert row["validation_gate_passed"] is True  # no production model
    assert row["winner_validation_threshold"] == threshold
    assert 0.3 < row["test_pr_auc"] <= 1.0


def test_search_keeps_the_best_trial_of_each_candidate(spark, fitted):
    """PR-AUC of every trial again from its stored model; settings are seeded."""
    pool = training.candidates()[-2:]
    table = training.search(fitted[0]["train"], fitted[0]["val"], pool, trials=2)
    trials = {(r["candidate"], r["trial"]): r for r in table.collect()}
    assert len(trials) == 4
    for (name, trial), r in trials.items():
        wanted = dict(pool)[name].settings(name, 2, training.SEED)[trial]
        assert json.loads(r["settings"]) == wanted
        model = training.PipelineModel.load(r["path"])
        rows = training.scores(model, fitted[0]["val"]).collect()
        assert r["pr_auc"] == pytest.approx(plain_area([(x["score"], x["label"]) for x in rows]))
    best = {r["candidate"]: r["trial"] for r in training.best_trials(table).collect()}
    for name in best:
        assert best[name] == max((0, 1), key=lambda t: (trials[name, t]["pr_auc"], -t))


def plain_area(rows):
    total, hits, taken = sum(y for _, y in rows), 0, 0
    before, found, area = 1.0, 0.0, 0.0
    for score in sorted({s for s, _ in rows}, reverse=True):
        here = [y for s, y in rows if s == score]
        hits, taken = hits + sum(here), taken + len(here)
        precision, recall = hits / taken, hits / total
        area += (recall - found) * (precision + before) / 2
        before, found = precision, recall
    return area


def test_category_order_does_not_matter_to_the_models(spark, fitted):
    """Buckets are nominal for trees; a linear model has a weight per value."""
    frame = training.weighted(training.bucketed(fitted[0]["train"]))
    kinds = dict(training.candidates())
    tree = kinds["forest"].pipeline({"maxDepth": 4, "numTrees": 3}).fit(frame)
    attrs = tree.transform(frame).schema["features"].metadata["ml_attr"]["attrs"]
    names = [a["name"] for a in attrs["nominal"]]
    assert names == [f"{c}_bucket" for c in C.CATEGORICAL_FEATURES]
    hashed = kinds["logistic"].pipeline({"regParam": 0.01}).fit(frame)
    first = hashed.transform(frame).select("features").first()[0]
    assert first.size == training.HASHED_FEATURES


def test_class_weights_balance(fitted):
    sums = training.weighted(fitted[0]["train"]).groupBy("label").agg(F.sum("_weight"))
    a, b = [r[1] for r in sums.collect()]
    assert a == pytest.approx(b)


def test_fallbacks_without_a_model(spark):
    answers = scoring.score(requests(spark, "s1", "s1", "gone"), states(spark, {})).collect()
    found = {r["user_session"]: r for r in answers}
    assert len(answers) == 2
    assert found["gone"]["fallback_reason"] == "redis_miss"
    assert found["s1"]["fallback_reason"] == "model_unavailable"
    assert {r["purchase_probability"] for r in answers} == {0.5}
    assert found["s1"].cached is False and found["s1"]["model_uri"] is None


def test_scores_and_invalid_states(spark, fitted, trained, tmp_path):
    path = str(tmp_path / "bundle")
    training.save_bundle(trained[0], fitted[1], trained[1], path)
    model, words, facts = training.load_bundle(spark, path)
    rows = states(
        spark,
        {},
        {"user_session": "s2", "serving_category_id": ""},
        {"user_session": "s3", "serving_price": None},
    )
    answers = scoring.score(
        requests(spark, "s1", "s2", "s3"), rows, words, training.BucketingModel(model), facts
    )
    assert tuple(answers.columns) == scoring.RESPONSE
    found = {r["user_session"]: r for r in answers.collect()}
    good = found["s1"]
    assert good["prediction_mode"] == "model" and good["fallback_reason"] is None
    assert 0.0 < good["purchase_probability"] < 1.0
    assert good["prediction_horizon_minutes"] == 10
    for name in ("s2", "s3"):
        assert found[name]["fallback_reason"] == "redis_miss"
        assert found[name]["model_version"] is None


def test_feature_row(spark, fitted):
    row = scoring.feature_rows(states(spark, {})).drop(*[])
    coded = encoding.encode(row, fitted[1]).first()
    assert coded["category_code"] == C.MISSING_TOKEN and coded["brand"] == C.UNKNOWN_TOKEN
    assert coded["total_views"] == 3.0 and coded["event_type"] == "view"


def test_bad_session_ids_are_singled_out(spark):
    bad = scoring.reject_bad_ids(requests(spark, "ok-1", "../etc", "")).collect()
    assert {r[0] for r in bad} == {"../etc", ""}


def test_only_the_known_contract_is_loaded(spark, tmp_path):
    text = spark.createDataFrame([(json.dumps({"contract_version": "v2"}),)], "value string")
    text.write.text(f"{tmp_path}/metadata")
    with pytest.raises(ValueError, match="v2"):
        training.load_bundle(spark, str(tmp_path))


def test_report_sink_orders_its_fields(spark, tmp_path):
    frame = spark.createDataFrame([(2, 1)], "b int, a int")
    sinks.write_report(frame, str(tmp_path / "report"))
    text = spark.read.text(str(tmp_path / "report")).first()["value"]
    assert text == '{"a":1,"b":2}'
    sinks.write_slices(
        silver(spark, [event("s", 0)]).withColumn("slice", F.lit("w1")), "slice",
        str(tmp_path / "slices"),
    )
    assert (tmp_path / "slices" / "slice=w1").is_dir()
