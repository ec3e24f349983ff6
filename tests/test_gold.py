from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.operators import gold, sessions, splits
from clickloom.plans import lake
from clickloom.sinks import tables as sinks
from clickloom.sources import tables as sources
from data import START, event, plain_gold, random_events, silver

FEATURES = [
    "total_views", "total_carts", "net_cart_count", "cart_to_view_ratio",
    "unique_categories", "unique_products", "session_duration_sec", "label",
]


def as_map(frame):
    return {
        (r["user_session"], r["source_event_time"], r["event_type"], r["product_id"]):
        tuple(r[f] for f in FEATURES)
        for r in frame.collect()
    }


def test_features_by_hand(spark):
    rows = [
        event("s", 0, "view", "a", category_code="x"),
        event("s", 60, "cart", "a", category_code="x"),
        event("s", 60, "view", "b", category_id="c9"),
        event("s", 120, "remove_from_cart", "a", category_code="x"),
        event("s", 120, "purchase", "b", category_id="c9"),
        event("s", 121, "view", "b", category_id="c9"),
    ]
    found = as_map(gold.snapshots(silver(spark, rows), 60))
    at = lambda s: START + dt.timedelta(seconds=s)
    assert found == {
        ("s", at(0), "view", "a"): (0, 0, 0, 0.0, 0, 0, 0.0, 0),
        ("s", at(60), "cart", "a"): (1, 0, 0, 0.0, 1, 1, 60.0, 1),
        ("s", at(60), "view", "b"): (1, 1, 1, 1.0, 1, 1, 60.0, 1),
        ("s", at(120), "purchase", "b"): (2, 1, 1, 0.5, 2, 2, 120.0, 0),
        ("s", at(120), "remove_from_cart", "a"): (2, 1, 1, 0.5, 2, 2, 120.0, 0),
        ("s", at(121), "view", "b"): (2, 1, 0, 0.5, 2, 2, 121.0, 0),
    }


def test_gold_schema(spark):
    frame = gold.snapshots(silver(spark, [event("s", 0)]))
    assert [(f.name, f.dataType) for f in frame.schema] == [
        (f.name, f.dataType) for f in schemas.GOLD
    ]


@pytest.mark.parametrize("seed", [1, 2, 3])
@pytest.mark.parametrize("limit", [10**6, 50])
def test_random_sessions_equal_plain_rules(spark, seed, limit):
    """A limit of 50 cuts the hot session into chunks with ties across them."""
    rows = random_events(seed)
    frame = silver(spark, rows).repartition(7)
    assert as_map(gold.snapshots(frame, 30, limit=limit)) == plain_gold(rows, 30)


def test_one_instant_may_span_chunks(spark):
    rows = [event("s", 5, "view", f"p{i:03d}") for i in range(200)]
    rows += [event("s", 5, "purchase", f"p{i:03d}") for i in range(200)]
    rows += [event("s", 9, "purchase", "z"), event("s", 10, "view", "z")]
    found = as_map(gold.snapshots(silver(spark, rows), 4, limit=10))
    assert found == plain_gold(rows, 4)


def test_extended_features_in_chunks(spark):
    frame = silver(spark, random_events(5))
    whole = gold.extended_snapshots(frame)
    chunked = gold.extended_snapshots(frame, limit=50)
    key = lambda r: tuple(map(str, r))
    assert sorted(map(key, whole.collect())) == sorted(map(key, chunked.collect()))


def test_ordinary_sessions_cost_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "silver")
    silver(spark, random_events(1)).write.parquet(path)
    frame = gold.snapshots(spark.read.parquet(path))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 4


def test_a_large_split_map_does_not_move_the_rows_again(spark, tmp_path):
    frame = silver(spark, random_events(1))
    frame.write.parquet(f"{tmp_path}/silver")
    splits.split_sessions(frame, None).write.parquet(f"{tmp_path}/map")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = gold.snapshots(
            spark.read.parquet(f"{tmp_path}/silver"),
            split_map=spark.read.parquet(f"{tmp_path}/map"),
        )
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 2


def test_hot_sessions_are_broadcast_only_if_few(spark, monkeypatch):
    monkeypatch.setattr(sessions, "BROADCAST_SESSIONS", 1)
    frame = silver(spark, [event(f"s{i % 20}", i) for i in range(200)])
    assert sessions.hot_sessions(sessions.session_sizes(frame), 10) is None
    many = sessions.hot_sessions(sessions.session_sizes(frame), 5)
    assert many.count() == 20  # the limit does not rise; too many to broadcast
    assert "Broadcast" not in str(many._jdf.queryExecution().analyzed())
    rows = [event("big" if i % 2 else f"s{i % 20}", i) for i in range(200)]
    hot = sessions.hot_sessions(sessions.session_sizes(silver(spark, rows)), 10)
    assert [r[0] for r in hot.collect()] == ["big"]


def ten_sessions(spark):
    return silver(spark, [event(f"s{i}", i * 100, product=f"p{i}") for i in range(10)])


@pytest.mark.parametrize("limit", [10**6, 3])
def test_split_by_time_is_8_1_1(spark, limit):
    found = splits.split_sessions(ten_sessions(spark), None, limit).collect()
    names = {r["user_session"]: r["split"] for r in found}
    assert [names[f"s{i}"] for i in range(10)] == ["train"] * 8 + ["val", "test"]


def test_split_scope(spark):
    with pytest.raises(ValueError):
        splits.split_sessions(ten_sessions(spark), "2019-09-01T00:00:00")
    early = splits.split_sessions(ten_sessions(spark), "2019-10-01T00:05:00")
    assert early.count() == 3


@pytest.mark.parametrize("limit", [10**6, 50])
def test_scope_keeps_whole_sessions(spark, limit):
    rows = random_events(4)
    bound = START + dt.timedelta(seconds=40)
    first = {}
    for row in rows:
        first[row[5]] = min(first.get(row[5], row[0]), row[0])
    kept = sessions.in_scope(silver(spark, rows), bound.isoformat(), limit).count()
    assert kept == sum(first[row[5]] < bound for row in rows)


@pytest.mark.parametrize("limit", [10**6, 50])
def test_gold_joins_splits_and_drops_later_sessions(spark, limit):
    rows = random_events(6)
    cutoff = (START + dt.timedelta(seconds=300)).isoformat()
    frame = silver(spark, rows)
    split_map = splits.split_sessions(frame, cutoff)
    found = gold.gold(frame, split_map, 30, cutoff, limit)
    names = {r["user_session"]: r["split"] for r in split_map.collect()}
    assert {(r[0], r[1]) for r in found.select("user_session", "split").collect()} == set(
        names.items()
    )
    expected = {k: v for k, v in plain_gold(rows, 30).items() if k[0] in names}
    assert as_map(found) == expected


def test_coverage_is_checked_both_ways(spark):
    frame = ten_sessions(spark)
    split_map = splits.split_sessions(frame, None)
    with pytest.raises(ValueError, match="s3 has no split"):
        gold.gold(frame, split_map.filter("user_session <> 's3'"), cutoff=None)
    with pytest.raises(ValueError, match="absent from silver"):
        gold.gold(frame.filter("user_session <> 's4'"), split_map, cutoff=None)
    with pytest.raises(ValueError, match="unknown split"):
        gold.gold(frame, split_map.withColumn("split", F.lit("holdout")), cutoff=None)
    with pytest.raises(ValueError, match="empty"):
        gold.gold(frame, split_map.limit(0), cutoff=None)


def test_layer_tables_and_an_empty_split(spark, tmp_path):
    rows = [event(f"s{i}", i) for i in range(3)]
    paths = {n: str(tmp_path / n) for n in ("silver", "map", "gold")}
    sinks.write_silver(silver(spark, rows), paths["silver"])
    assert lake.assign_splits(spark, paths["silver"], paths["map"], None) == 3
    stored = sources.read_table(spark, paths["map"]).collect()
    assert [r["user_session"] for r in stored] == ["s0", "s1", "s2"]
    counts = lake.build_gold(
        spark, paths["silver"], paths["map"], paths["gold"], cutoff=None
    )
    assert counts == {"train": 2, "val": 0, "test": 1}
    assert sources.read_gold(spark, paths["gold"], "val").count() == 0
    with pytest.raises(ValueError, match="val is empty"):
        sources.read_gold_splits(spark, paths["gold"])


def test_results_do_not_depend_on_partitions(spark):
    rows = random_events(8)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        found = []
        for parts in ("3", "17"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append(as_map(gold.snapshots(silver(spark, rows), 30, limit=50)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1]


def test_null_products_and_categories_on_both_paths(spark):
    rows = []
    for i in range(60):
        rows.append(event("hot", i // 2, product=[None, "a", "b"][i % 3],
                          category_id=[None, "c"][i % 2], category_code=None))
    frame = silver(spark, rows).dropDuplicates()
    key = ["source_event_time", "event_type", "product_id"]
    found = [
        sorted(map(str, gold.snapshots(frame, 600, limit=n)
                   .select(*key, "unique_products", "unique_categories").collect()))
        for n in (10**6, 7)
    ]
    assert found[0] == found[1]


@pytest.mark.parametrize("limit", [10**6, 4])
def test_prices_of_any_size(spark, limit):
    prices = [0.00004, 0.00006, None, 1e15, 1e15 + 2, 3.0]
    rows = [event("s", i, product=f"p{i}", price=p) for i, p in enumerate(prices)]
    found = gold.extended_snapshots(silver(spark, rows), limit).orderBy("source_event_time")
    means = [r["avg_price_viewed"] for r in found.collect()]
    assert means[:4] == [None, pytest.approx(0.00004), *[pytest.approx(0.00005)] * 2]
    assert means[4] == pytest.approx(1e15 / 3)
