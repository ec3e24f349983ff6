from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from clickloom import schemas
from clickloom.functions import scalars as S
from clickloom.operators import cleaning, dedup, replay
from data import event, silver


def raw_row(**other):
    row = {
        "event_time": "2019-10-01 10:00:00 UTC",
        "event_type": "view",
        "product_id": "kettle",
        "category_id": "c1",
        "user_id": "u9",
        "user_session": "visit-3",
        "category_code": None,
        "brand": None,
        "price": 1.0,
    }
    row.update(other)
    return tuple(row[name] for name in schemas.RAW.names)


def raw(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.RAW)


def test_time_text_and_malformed_text(spark):
    rows = cleaning.to_bronze(raw(spark, raw_row(), raw_row(event_time="soon"))).collect()
    assert {r["source_event_time"] for r in rows} == {
        dt.datetime(2019, 10, 1, 10), None,
    }


def test_mixed_invalid_rows_shrink_step_by_step(spark):
    frame = raw(
        spark,
        raw_row(product_id="7"),
        raw_row(event_type="wishlist"),
        raw_row(event_type="wishlist", price=-2.5),
        raw_row(price=-0.01),
        raw_row(price=None),
        raw_row(user_session=None),
        raw_row(event_time="yesterday"),
    )
    bronze = cleaning.to_bronze(frame)
    required = cleaning.keep_required(bronze)
    counts = (bronze.count(), required.count(), cleaning.keep_valid_price(required).count())
    assert counts == (5, 3, 2)
    assert cleaning.clean_counts(bronze).first().asDict() == {
        "input_rows": 5,
        "rejected_required": 2,
        "rejected_price": 1,
        "valid_rows": 2,
    }
    assert cleaning.raw_counts(frame).first()["rejected_rows"] == 2


def test_null_type_is_rejected(spark):
    frame = raw(spark, raw_row(event_type=None))
    assert cleaning.to_bronze(frame).count() == 0
    assert cleaning.raw_counts(frame).first()["rejected_rows"] == 1


def test_price_rule_keeps_null_and_nan(spark):
    frame = raw(spark, *[raw_row(price=p) for p in (0.0, -5.0, 1.0, None, float("nan"))])
    kept = [r["price"] for r in cleaning.clean(cleaning.to_bronze(frame)).collect()]
    assert len(kept) == 3 and 1.0 in kept and None in kept


def test_category_policies(spark):
    frame = silver(spark, [event("a", 0), event("a", 1, category_code="cat-1")])
    filled = cleaning.category_policy(frame, "fill").orderBy("source_event_time")
    assert [r["category_code"] for r in filled.collect()] == ["unknown", "cat-1"]
    assert cleaning.category_policy(frame) is frame
    with pytest.raises(ValueError):
        cleaning.category_policy(frame, "drop")


def test_first_survivor_wins_whatever_the_row_order(spark):
    rows = [
        event("t", 40, brand="third copy", price=3.25, category_code="z"),
        event("t", 40, brand="second copy", price=None, category_code="m"),
        event("t", 40, brand="kept", price=7.5, category_code="c"),
        event("t", 41, brand="alone", price=1.5, category_code="q"),
    ]
    frame = silver(spark, rows).repartition(5)
    kept = dedup.keep_first(frame, [F.col("category_code")]).collect()
    assert {(r["brand"], r["price"]) for r in kept} == {("kept", 7.5), ("alone", 1.5)}


def test_copies_are_limited_before_the_shuffle(spark):
    frame = spark.range(1000).select(
        (F.col("id") % 2).cast("string").alias("user_session"), "id"
    )
    kept = dedup.keep_first(frame, [F.col("id")], keys=["user_session"])
    plan = kept._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below and "Partial" in below
    assert kept.count() == 2


def test_sort_breaks_ties_and_names_a_missing_column(spark):
    rows = [event("s", 0, product=p) for p in ("2", "3", "1")]
    ordered = dedup.sort_canonical(silver(spark, rows)).collect()
    assert [r["product_id"] for r in ordered] == ["1", "2", "3"]
    with pytest.raises(ValueError, match="missing: product_id"):
        dedup.sort_canonical(silver(spark, rows).drop("product_id"))


def test_duplicate_counts(spark):
    rows = [event("s", 0), event("s", 0), event("s", 1)]
    counts = dedup.duplicate_counts(silver(spark, rows)).first()
    assert (counts["input_rows"], counts["unique_rows"], counts["duplicate_rows"]) == (
        3, 2, 1,
    )
    assert dedup.full_row_duplicates(silver(spark, rows)).first()[0] == 1


def test_event_id_is_the_hash_of_the_joined_identity(spark):
    own = {"user_session": "visit|7", "product_id": "lamp", "user_id": "ana", "event_type": "cart"}
    good = replay.normalise(
        raw(spark, raw_row(event_time="2020-02-29 23:59:07 UTC", brand="", price=None, **own)),
        F.lit("2031-05-06T07:08:09"),
    ).first()
    text = "visit|7|2020-02-29T23:59:07|cart|lamp|ana"
    assert good["event_id"] == hashlib.sha256(text.encode()).hexdigest()
    assert good["source_event_time"] == "2020-02-29T23:59:07"
    assert good["brand"] is None and good["source"] == "replay"
    assert good["replay_time"] == "2031-05-06T07:08:09"


def test_replay_accepts_offsets_and_fractions(spark):
    frame = raw(
        spark,
        raw_row(event_time="2019-11-01T02:00:00+02:00"),
        raw_row(event_time="2019-11-01T00:00:00.250000Z"),
    )
    times = {r["source_event_time"] for r in replay.normalise(frame).collect()}
    assert times == {"2019-11-01T00:00:00", "2019-11-01T00:00:00.250000"}


def test_bad_replay_rows_are_set_aside_or_fail(spark):
    frame = raw(
        spark,
        raw_row(),
        raw_row(event_type="click"),
        raw_row(user_session=""),
        raw_row(event_time="soon"),
    )
    assert replay.normalise(frame).count() == 1
    reasons = {r["reason"] for r in replay.rejects(frame).collect()}
    assert reasons == {
        "event_type not allowed", "user_session is missing", "unreadable event_time",
    }
    with pytest.raises(Exception, match="bad raw row"):
        replay.normalise(frame, fail=True).collect()


@pytest.mark.parametrize(
    "text, valid",
    [("abc-1.x_Y", True), ("-abc", False), ("a b", False), ("", False), ("a\n", False)],
)
def test_session_ids(spark, text, valid):
    frame = spark.createDataFrame([(text,)], "s string")
    assert frame.select(S.is_session_id(F.col("s"))).first()[0] is valid


def test_utc_text(spark):
    frame = spark.createDataFrame(
        [("2019-11-01T00:00:00Z",), ("2019-11-01T02:00:00+02:00",), ("2019-11-01T00:00:00",)],
        "t string",
    )
    texts = {r[0] for r in frame.select(S.iso_text_utc(F.col("t"))).collect()}
    assert texts == {"2019-11-01T00:00:00+00:00"}


def test_half_open_slices(spark):
    slices = [("one", "2019-10-01", "2019-10-02"), ("two", "2019-10-02", "2019-10-03")]
    frame = silver(spark, [event("s", t) for t in (0, 86399, 86400, 172800)])
    label = S.slice_label(F.col("source_event_time"), slices).alias("l")
    found = [r["l"] for r in frame.orderBy("source_event_time").select(label).collect()]
    assert found == ["one", "one", "two", None]
