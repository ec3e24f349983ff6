from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickloom.operators import lookup, ordered, profile
from data import event, silver


def table(spark, seed=3, rows=400):
    rnd = random.Random(seed)
    data = [
        ("hot" if rnd.random() < 0.6 else f"k{rnd.randrange(4)}", i, rnd.randrange(9))
        for i in range(rows)
    ]
    return data, spark.createDataFrame(data, "k string, i long, v long").repartition(5)


@pytest.mark.parametrize("limit", [10**6, 20])
def test_running_sums(spark, limit):
    data, frame = table(spark)
    found = ordered.running_sums(frame, ["k"], ["i"], {"upto": "v"}, limit)
    expected, sums = {}, {}
    for key, i, v in data:
        sums[key] = sums.get(key, 0) + v
        expected[i] = sums[key]
    rows = found.collect()
    assert {r["i"]: r["upto"] for r in rows} == expected
    assert all(r["upto_total"] == sums[r["k"]] for r in rows)


@pytest.mark.parametrize("limit", [10**6, 20])
def test_dense_index_without_keys(spark, limit):
    _, frame = table(spark)
    rows = ordered.dense_index(frame, ["i"], "n", limit=limit).collect()
    assert all(r["n"] == r["i"] for r in rows) and len(rows) == 400


def test_a_long_index_is_numbered_where_its_rows_lie_sorted(spark):
    """No second shuffle of the rows; the only window is over the partitions."""
    rows = spark.range(500).withColumn("t", F.concat(F.lit("x"), F.pmod("id", F.lit(7))))
    order = [F.col("t").desc(), "id"]
    found = ordered.dense_index(rows.repartition(3), order, "n", limit=20)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "Repartition" not in plan
    expected = sorted(range(500), key=lambda i: (-(i % 7), i))
    at = {r["n"]: (r["id"], r["n_total"]) for r in found.collect()}
    assert at == {n: (i, 500) for n, i in enumerate(expected)}


@pytest.mark.parametrize("limit", [10**6, 4])
def test_exact_quantiles_interpolate(spark, limit):
    data, frame = table(spark)
    marks = {"a": 0.25, "b": 0.5, "c": 0.99}
    for row in ordered.exact_quantiles(frame, "v", marks, ["k"], limit).collect():
        values = [v for k, _, v in data if k == row["k"]]
        for name, p in marks.items():
            assert row[name] == pytest.approx(np.quantile(values, p))


def test_salted_lookup_equals_the_broadcast_one(spark):
    _, frame = table(spark)
    words = spark.createDataFrame([("hot", 1), ("k1", 2)], "k string, code int")
    key = lambda f: sorted(map(str, f.collect()))
    small = lookup.left_lookup(frame, words, ["k"], small=True)
    salted = lookup.left_lookup(frame, words, ["k"], small=False, rows_per_salt=3)
    assert key(small.select("k", "i", "v", "code")) == key(
        salted.select("k", "i", "v", "code")
    )
    assert lookup.at_most(words, 2) and not lookup.at_most(words, 1)


def test_missing_values_and_top_values(spark):
    frame = silver(
        spark, [event("s", 0, brand="b"), event("s", 1, brand="a"), event("s", 2)]
    )
    missing = {r["field"]: r for r in profile.missing_values(frame).collect()}
    assert missing["brand"]["missing_count"] == 1
    assert missing["category_code"]["missing_pct"] == 100.0
    top = profile.top_values(frame, "brand", "brand", 1).collect()
    assert [(r["brand"], r["rows"]) for r in top] == [("a", 1)]


def test_histogram_of_one_value(spark):
    frame = silver(spark, [event("s", i, price=2.0) for i in range(3)])
    rows = profile.histogram(frame, bins=10).collect()
    assert [(r["bin"], r["rows"]) for r in rows if r["rows"]] == [(5, 3)]
    assert len(rows) == 10  # empty bins too, with edges
    assert (rows[0]["low"], rows[9]["high"]) == (1.5, 2.5)
    assert profile.histogram(frame.limit(0), bins=10).count() == 0


def test_head_per_file(spark):
    frame = spark.createDataFrame(
        [(f, i) for f in "ab" for i in range(9)], "file string, i int"
    )
    rows = profile.head_per_file(frame, "file", ["i"], 2).collect()
    assert {(r["file"], r["i"]) for r in rows} == {
        ("a", 0), ("a", 1), ("b", 0), ("b", 1),
    }


def test_null_keys_on_both_paths(spark):
    rnd = random.Random(6)
    data = [
        (rnd.choice([None, "hot", "hot", "k"]), i, rnd.randrange(5)) for i in range(200)
    ]
    frame = spark.createDataFrame(data, "k string, i long, v long").repartition(4)
    found = [
        sorted(map(str, ordered.exact_quantiles(frame, "v", {"m": 0.5}, ["k"], n).collect()))
        for n in (10**6, 2)
    ]
    assert len(found[0]) == 3 and found[0] == found[1]
    sums = [
        sorted(map(str, ordered.running_sums(frame, ["k"], ["i"], {"u": "v"}, n)
                   .select("k", "i", "u", "u_total").collect()))
        for n in (10**6, 9)
    ]
    assert len(sums[0]) == 200 and sums[0] == sums[1]
    renamed = frame.select(F.col("k").alias("event_type"), F.col("v").alias("price"))
    boxes = profile.box_stats(renamed).collect()
    assert {r["event_type"] for r in boxes} == {None, "hot", "k"}
    assert all(r["whisker_low"] is not None for r in boxes)
