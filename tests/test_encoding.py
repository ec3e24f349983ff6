from __future__ import annotations

import pytest

from clickloom.operators import encoding, gold
from data import event, random_events, silver


def frames(spark):
    train = gold.snapshots(
        silver(
            spark,
            [
                event("s2", 0, brand="late"),
                event("s1", 9, brand="zeta"),
                event("s1", 5, brand=None),
                event("s1", 7, "cart", brand="alpha"),
            ],
        )
    )
    other = gold.snapshots(
        silver(spark, [event("t", 0, brand="brand-new"), event("t", 1), event("t", 2, brand="zeta")])
    )
    return train, other


@pytest.mark.parametrize("limit", [10**6, 1])
def test_codes_follow_first_appearance(spark, limit):
    words = encoding.fit_vocabulary(frames(spark)[0], limit)
    codes = {(r["column"], r["value"]): r["code"] for r in words.collect()}
    assert codes[("brand", "__MISSING__")] == 0 and codes[("brand", "__UNK__")] == 1
    assert [codes[("brand", b)] for b in ("alpha", "zeta", "late")] == [2, 3, 4]
    assert [codes[("event_type", t)] for t in ("view", "cart")] == [2, 3]


@pytest.mark.parametrize("limit", [10**6, 1])
def test_missing_and_unseen(spark, limit):
    train, other = frames(spark)
    words = encoding.fit_vocabulary(train)
    coded = encoding.encode(encoding.model_frame(other), words, limit=limit, rows_per_salt=2)
    found = {r["brand"]: r["brand_code"] for r in coded.collect()}
    assert found == {"__UNK__": 1, "__MISSING__": 0, "zeta": 3}


def test_vocabulary_of_random_rows(spark):
    rows = random_events(9)
    words = encoding.fit_vocabulary(gold.snapshots(silver(spark, rows))).collect()
    ordered = []
    for row in sorted(rows, key=lambda r: (r[5], r[0], r[1], r[2], r[4])):
        if row[6] is not None and row[6] not in ordered:
            ordered.append(row[6])
    codes = {r["value"]: r["code"] for r in words if r["column"] == "category_code"}
    assert [codes[v] for v in ordered] == list(range(2, len(ordered) + 2))


def test_numbers_are_filled_and_columns_required(spark):
    train, _ = frames(spark)
    bad = train.withColumn("price", train["price"].cast("string")).replace("1.0", "x")
    assert {r["price"] for r in encoding.model_frame(bad).collect()} == {0.0}
    with pytest.raises(ValueError, match="brand, price"):
        encoding.model_frame(train.drop("price", "brand"))
