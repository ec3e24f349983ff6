from __future__ import annotations

from pyspark.ml.feature import VectorAssembler

from clickloom import constants as C
from clickloom.plans import training
from clickloom.workload import queries

SF_DIR = "/root/testdata/sf0.001"


def test_the_queries_fit_every_candidate(spark, monkeypatch):
    seen = []
    fit = training.train_candidates

    def noted(train, validation, pool=None, trials=1):
        models, table = fit(train, validation, pool, trials)
        seen.append((set(models), {r["candidate"] for r in table.collect()}))
        return models, table

    monkeypatch.setattr(training, "train_candidates", noted)
    report = queries._trained(spark, SF_DIR)[3].collect()
    names = {name for name, _ in training.candidates()}
    assert seen == [(names, names)]
    assert {r["candidate"] for r in report} == names
    assert {r["trials"] for r in report} == {queries.TRIALS}
    best = max(report, key=lambda r: (r["validation_pr_auc"], -r["candidate_order"]))
    assert {r["winner_name"] for r in report} == {best["candidate"]}


def test_vectors_are_made_once_for_all_trials(spark, monkeypatch):
    names = [*C.NUMERIC_FEATURES, *[f"{c}_code" for c in C.CATEGORICAL_FEATURES]]
    rows = [(*[float(i * k % 7) for k in range(len(names))], i % 2) for i in range(90)]
    frame = spark.createDataFrame(rows, [*names, C.LABEL])
    fitted, plain = [], VectorAssembler.transform

    def noted(self, data, *rest):
        fitted.append("_weight" in data.columns)
        return plain(self, data, *rest)

    monkeypatch.setattr(VectorAssembler, "transform", noted)
    pool = [p for p in training.candidates() if p[0] == "forest"]
    found = training.search(frame, frame, pool, trials=2)
    assert found.count() == 2 and fitted.count(True) == 1
