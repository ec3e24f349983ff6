from __future__ import annotations

import random
import re

import numpy as np
import pytest
from llm_data import SCHEMA, with_odd_rows

from clickloom.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    triples = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    seen, twice = set(), set()
    for t in triples:
        (twice if t in seen else seen).add(t)
    covered = set()
    for i, t in enumerate(triples):
        if t in twice:
            covered |= {i, i + 1, i + 2}
    n, r = len(words), len(covered)
    failed = n < 50 or 100 * r > 50 * n
    return n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, r, failed


ODD = ["é\u0301 日本 \x1c\u00a0x", "a b c a b c a", "x\n\n x\nx\n \nx", "#*$%&|<>!", "# a # b # a # b", "\x85y \u2028z"]


def test_statistics_of_odd_texts():
    for text in ODD:
        assert quality.statistics(text)[:5] == plain(text)[:5], text


def test_judge(docs, odd, empty, rows):
    rules = [(quality.Condition("distinct_share", False, 0.5), quality.Condition("n_words", True, 60.0))]
    for frame, given in ((docs, rows), (odd, with_odd_rows(rows))):
        found = sorted(map(tuple, quality.judge(frame, rules).collect()), key=str)
        want = []
        for i, text, *_ in given:
            numbers = plain(text)
            words = (text or "").encode().split()
            hit = len(set(words)) / max(len(words), 1) < 0.5 and len(words) >= 60
            want.append((i, *numbers, not numbers[5] and not hit))
        assert found == sorted(want, key=str)
    assert quality.judge(empty, rules).count() == 0


def test_learn_finds_planted_conjunctions():
    rng = np.random.default_rng(1)
    table = {c: rng.random(6000) for c in ("a", "b", "c")}
    bad = ((table["a"] > 0.7) & (table["b"] < 0.3)) | (table["c"] > 0.95)
    rules = quality.learn(table, bad)
    hit = np.zeros(6000, bool)
    for rule in rules:
        hit |= quality._holds(rule, table, 6000)
    assert (hit & bad).sum() / bad.sum() > 0.95 and (hit & ~bad).sum() / hit.sum() < 0.05
    assert all(1 <= len(r) <= 4 for r in rules) and len(rules) <= 12


def test_learn_without_signal_or_rows():
    rng = np.random.default_rng(2)
    table = {"a": rng.random(3000), "b": np.ones(3000)}
    rules = quality.learn(table, rng.random(3000) < 0.1)
    assert rules == []
    assert quality.learn({"a": np.ones(9)}, np.ones(9, bool)) == []
    assert quality.learn({"a": np.empty(0)}, np.empty(0, bool)) == []


def test_fit_on_labels(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(900):
        words = [f"w{rng.randrange(5000)}" for _ in range(80)]
        if i % 3 == 0:
            words = [w + "#$" for w in words]
        rows.append((i, " ".join(words), "en", "s", 0))
        labels.append((i, int(i % 3 != 0), 0))
    labels += [(None, 0, 0), (5, 0, 0), (10**6, 0, 1), (7, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rules = quality.fit(docs, marks)
    found = {r["doc_id"]: r["kept"] for r in quality.judge(docs, rules).collect()}
    assert all(found[i] == (i % 3 != 0) for i in range(900))
    assert quality.fit(docs, marks.limit(0)) == []
    assert quality.fit(docs.limit(0), marks) == []
    carried = quality.judge(docs, rules, ("lang", "text")).first()
    assert carried["lang"] == "en" and carried["text"].startswith("w")


@pytest.mark.parametrize("above", [True, False])
def test_conditions_mean_the_same_in_spark(spark, above):
    frame = spark.createDataFrame([(float(x),) for x in range(5)], "x double")
    condition = quality.Condition("x", above, 2.0)
    got = [r[0] for r in frame.select(condition.spark()).collect()]
    assert got == condition.holds({"x": np.arange(5.0)}).tolist()
