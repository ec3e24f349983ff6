from __future__ import annotations

import random
import zlib

import numpy as np
from llm_data import SCHEMA, with_odd_rows

from clickloom.llm import toxicity

BAD = ["grobian", "grobheit", "grobes", "scum", "loser", "vilest", "vilestone"]


def labelled(spark, n=700, seed=2):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        words = [f"w{rng.randrange(900)}x" for _ in range(rng.choice([10, 60]))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", ".", "!"]))
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    marks = labels[: int(n * 0.8)] + [(None, 1, 1), (3, 1, None), (10**7, 0, 1)]
    return docs, spark.createDataFrame(marks, "doc_id long, quality int, toxic int"), labels


def test_held_out_accuracy_and_folds(spark):
    docs, marks, labels = labelled(spark)
    found = {r["doc_id"]: r for r in toxicity.score_documents(docs, toxicity.fit(docs, marks)).collect()}
    assert len(found) == len(labels)
    wrong = 0
    for i, _, toxic in labels:
        held = zlib.crc32(str(i).encode()) % 5 == 0
        assert found[i]["held_out"] == held
        assert found[i]["predicted"] == int(found[i]["score"] >= 0.5)
        wrong += held and found[i]["predicted"] != toxic
    assert wrong <= 2


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs, marks, _ = labelled(spark, 300)
    flipped = marks.selectExpr(
        "doc_id", "quality",
        "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - toxic ELSE toxic END AS toxic",
    )
    assert toxicity.fit(docs, marks) == toxicity.fit(docs, flipped)


def test_odd_input(spark, odd, empty, rows):
    docs, marks, _ = labelled(spark, 300)
    model = toxicity.fit(docs, marks)
    found = toxicity.score_documents(odd, model, ("lang",)).collect()
    assert len(found) == len(with_odd_rows(rows))
    assert all(0 <= r["score"] <= 1 for r in found)
    assert toxicity.score_documents(empty, model).count() == 0
    assert toxicity.fit(empty, marks) == toxicity.Model()
    assert toxicity.fit(docs, marks.limit(0)) == toxicity.Model()


def patterns_of(spark, table, gold, weight=1.0):
    rows = [(int(g), weight, [i for i, v in enumerate(row) if v]) for row, g in zip(table.tolist(), gold)]
    return spark.createDataFrame(rows, "gold int, weight double, found array<int>").repartition(4)


def test_label_model_finds_accuracies_without_labels_everywhere(spark):
    rng = np.random.default_rng(1)
    truth = rng.random(4000) < 0.2
    rates = [(0.6, 0.02), (0.4, 0.01), (0.7, 0.05), (0.3, 0.001), (0.5, 0.5)]
    votes = np.stack([np.where(truth, rng.random(4000) < a, rng.random(4000) < b) for a, b in rates], 1)
    votes = np.concatenate([votes, votes[:, :1]], 1)  # one voter repeats another
    gold = np.where(rng.random(4000) < 0.05, truth, -1)
    model = toxicity.fit_labels(patterns_of(spark, votes, gold), 6, list(range(6)), 0.2)
    posterior = model.posterior(votes.astype(float), None)  # the known labels are withheld
    assert ((posterior > 0.5) == truth).mean() > 0.93


def test_linear_classifier_on_soft_labels(spark):
    rng = np.random.default_rng(3)
    x = (rng.random((3000, 30)) < 0.2).astype(float)
    labels = toxicity.LabelModel([0, 1], np.array([7.0, 7.0]), -4.0)
    y = labels.posterior(x, None)
    weights, bias = toxicity.fit_linear(patterns_of(spark, x, [-1] * 3000), 30, labels)
    got = 1 / (1 + np.exp(-(x @ weights + bias)))
    assert ((got > 0.5) == (y > 0.5)).mean() > 0.99


def test_every_unlabelled_row_counts(spark, monkeypatch):
    """All rows outside the held-out fold are in the counts, whatever their number."""
    docs, marks, labels = labelled(spark, 400)
    monkeypatch.setattr(toxicity, "LABELLED_ROWS", 50)
    gold = [r["gold"] for r in toxicity.training_rows(docs, marks).collect()]
    assert len(gold) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _, _ in labels)
    assert 20 < sum(g >= 0 for g in gold) < 80
