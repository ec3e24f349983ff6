from __future__ import annotations

import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from clickloom.functions import scalars as S
from clickloom.operators import gold
from clickloom.sinks import tables as batch_sinks
from clickloom.plans import scoring
from clickloom.sources import streams
from clickloom.streaming import session_state, sinks
from clickloom.workload import queries
from data import START, TYPES, event, silver



def message(event_id, session="s", seconds=0, kind="view", arrival=0, clock=None, **other):
    row = {
        "event_id": event_id,
        "user_session": session,
        "source_event_time": START + dt.timedelta(seconds=seconds),
        "replay_time": START + dt.timedelta(seconds=seconds if clock is None else clock),
        "event_type": kind,
        "product_id": "100",
        "category_id": "cat-id",
        "category_code": None,
        "brand": None,
        "price": None,
        "arrival": arrival,
        "user_id": None,
        "source": None,
    }
    row.update(other)
    return row


LAYOUT = (
    "event_id string, user_session string, source_event_time timestamp_ntz, "
    "replay_time timestamp_ntz, event_type string, product_id string, "
    "category_id string, category_code string, brand string, price double, "
    "arrival long, user_id string, source string"
)


def run(spark, folder, batches, **rules):
    """Feed each batch as a file of its own; returns the sink paths."""
    paths = {n: f"{folder}/{n}" for n in ("in", "log", "late", "serving", "dead", "checkpoint")}
    for batch in batches:
        frame = spark.createDataFrame([tuple(m.values()) for m in batch], LAYOUT)
        frame.coalesce(1).write.mode("append").parquet(paths["in"])
        source = streams.file_events(
            spark, paths["in"], frame.schema, files_per_trigger=1
        )
        tracked = session_state.track_sessions(source, **rules)
        write = sinks.route(*(paths[n] for n in ("log", "late", "serving", "dead")))
        sinks.drain(tracked, write, paths["checkpoint"])
    return paths


def served(spark, paths):
    rows = sinks.serving_rows(spark, paths["serving"]).collect()
    return {(r["event_id"], r["arrival"]): r for r in rows}


def test_states_by_hand(spark, tmp_path):
    """Two sessions, a repeat, a late event and one at the edge, over 3 triggers."""
    paths = run(
        spark,
        tmp_path,
        [
            [
                message("k1", "left", kind="cart", product_id="p9", price=3.5,
                        user_id="u1", source="replay"),
                message("m1", "right", seconds=7, arrival=1),
            ],
            [
                message("k2", "left", seconds=95, product_id="p9", arrival=2,
                        brand="acme", category_code="tools.saw"),
                message("m1", "right", seconds=7, arrival=3, clock=96),
                message("k3", "left", seconds=34, arrival=4, clock=97),
            ],
            [
                message("k4", "left", seconds=35, kind="remove_from_cart", arrival=5,
                        clock=98, product_id="p5"),
                message("m2", "right", seconds=107, kind="purchase", arrival=6,
                        category_id="other"),
            ],
        ],
    )
    rows = served(spark, paths)
    statuses = {key[0]: [] for key in rows}
    for (event_id, _), row in sorted(rows.items(), key=lambda item: item[0][1]):
        statuses[event_id].append(row["status"])
    assert statuses == {
        "k1": ["accepted"], "k2": ["accepted"], "k3": ["late"], "k4": ["accepted"],
        "m1": ["accepted", "duplicate"], "m2": ["accepted"],
    }
    opening = rows[("k1", 0)]
    assert (opening["serving_total_carts"], opening["count_cart"]) == (0, 1)
    assert opening["serving_price"] == 3.5 and opening["serving_brand"] == ""
    # k3 is 61 s older than k2 and late; k4 is 60 s older, accepted, and moves time back
    last = rows[("k4", 5)].asDict()
    expected = {
        "first_event_time": START,
        "last_event_time": START + dt.timedelta(seconds=35),
        "count_view": 1, "count_cart": 1, "count_remove_from_cart": 1,
        "serving_total_views": 1, "serving_total_carts": 1,
        "serving_total_removes": 0, "serving_net_cart_count": 1,
        "serving_cart_to_view_ratio": 1.0, "serving_unique_products": 1,
        "serving_unique_categories": 2, "serving_session_duration_sec": 35.0,
        "serving_event_type": "remove_from_cart",
    }
    assert {k: last[k] for k in expected} == expected
    late = rows[("k3", 4)]
    assert late["late_reason"] == "older_than_last_event_time_by_more_than_60s"
    assert late["serving_total_views"] is None
    log = spark.read.parquet(paths["log"]).collect()
    assert {r["event_id"] for r in log} == {"k1", "k2", "k4", "m1", "m2"}
    assert {(r["user_id"], r["source"]) for r in log if r["event_id"] == "k1"} == {
        ("u1", "replay")
    }
    sent = spark.read.parquet(paths["late"]).collect()
    assert [r["key"] for r in sent] == ["left"] and "late_reason" in sent[0]["value"]
    assert "user_id" in sent[0]["value"] and "status" not in sent[0]["value"]
    states = sinks.serving_rows(spark, paths["serving"]).filter("status = 'accepted'")
    newest = {r["user_session"]: r["event_id"] for r in scoring.latest_states(states).collect()}
    assert newest == {"left": "k4", "right": "m2"}


def test_bad_messages_go_to_the_dead_letters(spark, tmp_path):
    """No time, an unknown type, no session and broken JSON: the stream goes on."""
    good = message("g1"), message("g2", seconds=5, arrival=9)
    bad = [
        message("n1", source_event_time=None, arrival=1),
        message("n2", kind="wishlist", arrival=2),
        message("n3", session=None, arrival=3),
        message("n4", replay_time=None, arrival=4),
        message(None, arrival=5),
    ]
    paths = run(spark, tmp_path, [[good[0], *bad], [good[1]]])
    assert {key[0] for key in served(spark, paths)} == {"g1", "g2"}
    dead = spark.read.parquet(paths["dead"]).collect()
    assert sorted(r["reason"] for r in dead) == [
        "event_id is missing", "event_type not allowed",
        "unreadable replay_time", "unreadable source_event_time",
        "user_session is missing",
    ]
    text = spark.createDataFrame([("{broken",), ("[]",)], "value string")
    letters = streams.decode(text.withColumn("arrival", F.lit(1).cast("long")))
    checked = letters.withColumns(
        {"source_us": F.lit(None).cast("long"), "replay_us": F.lit(None).cast("long")}
    ).select(session_state.reject_reason().alias("reason"))
    assert [r["reason"] for r in checked.collect()] == ["unreadable_event"] * 2


@pytest.mark.parametrize("text", ["T10:00:00", "10:00:00", "2019", "2019-10-01", "soon"])
def test_text_without_a_whole_time_is_no_time(spark, text):
    frame = spark.createDataFrame([(text,), ("2019-10-01T10:00:00Z",)], "t string")
    found = [r[0] for r in frame.select(S.parse_iso(F.col("t"))).collect()]
    assert found == [None, dt.datetime(2019, 10, 1, 10)]


def test_state_and_ids_expire_after_their_time(spark, tmp_path):
    paths = run(
        spark,
        tmp_path,
        [
            [message("a"), message("b", seconds=100, arrival=1)],
            [message("c", seconds=1900, arrival=2)],
            [message("d", seconds=3701, arrival=3), message("a", arrival=4, clock=3702)],
            [message("d", seconds=3701, arrival=5, clock=5501)],
        ],
    )
    rows = served(spark, paths)
    assert rows[("c", 2)]["serving_total_views"] == 2  # 1800 s is still alive
    assert rows[("d", 3)]["serving_total_views"] == 0
    # Its id is forgotten, its session is not: the event is now late.
    assert rows[("a", 4)]["status"] == "late"
    assert rows[("d", 5)]["status"] == "duplicate"


def plain_rules(messages, ttl, late):
    """The stream rules as one loop over arrivals."""
    seen, states, out = {}, {}, {}
    for m in sorted(messages, key=lambda m: m["arrival"]):
        now, at = m["replay_time"], m["source_event_time"]
        name = m["user_session"]
        known = seen.get(m["event_id"])
        if known is not None and (now - known).total_seconds() <= ttl:
            out[m["arrival"]] = ("duplicate", None)
            continue
        seen[m["event_id"]] = now
        state = states.get(name)
        if state and (now - state["touched"]).total_seconds() > ttl:
            state = None
        if state and (state["last"] - at).total_seconds() > late:
            out[m["arrival"]] = ("late", None)
            continue
        if state is None:
            state = {"first": at, "count": dict.fromkeys(TYPES, 0), "p": set(), "c": set()}
        count = state["count"]
        out[m["arrival"]] = (
            "accepted",
            (
                count["view"], count["cart"], count["remove_from_cart"],
                len(state["p"]), len(state["c"]), (at - state["first"]).total_seconds(),
            ),
        )
        count[m["event_type"]] += 1
        state["p"].add(m["product_id"])
        state["c"].add(m["category_code"] or m["category_id"])
        state["last"], state["touched"] = at, now
        states[name] = state
    return out


@pytest.mark.parametrize("inline", [500, 3])
def test_random_arrivals_equal_the_plain_rules(spark, tmp_path, monkeypatch, inline):
    """Out of order, repeated and over several triggers; small sets spill too."""
    rnd = random.Random(11)
    messages = []
    for i in range(400):
        if messages and rnd.random() < 0.15:
            copy = dict(rnd.choice(messages))
        else:
            copy = message(
                f"e{i}",
                rnd.choice(["hot", "hot", "s1", "s2"]),
                i * 10 - rnd.choice([0, 0, 30, 90, 400]),
                rnd.choice(TYPES),
                product_id=f"p{rnd.randrange(20)}",
                category_code=rnd.choice([None, "", "x", "y"]),
            )
        copy["replay_time"] = START + dt.timedelta(seconds=i * 10)
        copy["arrival"] = i
        messages.append(copy)
    batches = [messages[:150], messages[150:160], messages[160:]]
    for batch in batches:
        rnd.shuffle(batch)
    if inline != 500:
        processor = session_state.SessionProcessor
        monkeypatch.setattr(
            session_state, "SessionProcessor", lambda *a: processor(*a, inline=inline)
        )
    paths = run(spark, tmp_path, batches, ttl_seconds=600, late_seconds=60)
    expected = plain_rules(messages, 600, 60)
    found = {}
    for (_, arrival), r in served(spark, paths).items():
        values = None
        if r["status"] == "accepted":
            values = (
                r["serving_total_views"], r["serving_total_carts"],
                r["serving_total_removes"], r["serving_unique_products"],
                r["serving_unique_categories"], r["serving_session_duration_sec"],
            )
        found[arrival] = (r["status"], values)
    assert found == expected


def test_ordered_stream_equals_gold(spark, tmp_path):
    rows = [event("s", i * 7, TYPES[i % 3], f"p{i % 5}") for i in range(40)]
    messages = [
        message(f"e{i}", seconds=i * 7, kind=TYPES[i % 3], product_id=f"p{i % 5}",
                category_id="c1", arrival=i)
        for i in range(40)
    ]
    paths = run(spark, tmp_path, [messages[:20], messages[20:]])
    names = ["total_views", "total_carts", "net_cart_count", "cart_to_view_ratio",
             "unique_products", "unique_categories", "session_duration_sec"]
    batch = gold.snapshots(silver(spark, rows)).orderBy("source_event_time")
    stream = sinks.serving_rows(spark, paths["serving"]).orderBy("arrival")
    assert [tuple(r) for r in batch.select(*names).collect()] == [
        tuple(r) for r in stream.select(*[f"serving_{n}" for n in names]).collect()
    ]


def test_log_append_can_be_repeated(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.createDataFrame(
        [tuple(message(f"e{i}", seconds=i * 50000).values()) for i in range(4)], LAYOUT
    ).select(*sinks.LOG_COLUMNS)
    sinks.append_new(rows.unionByName(rows), path)
    sinks.append_new(rows, path)
    sinks.append_new(rows.limit(0), path)
    assert spark.read.parquet(path).count() == 4


def test_a_log_without_repeats_is_appended_without_comparing_rows(
    spark, tmp_path, monkeypatch
):
    path = str(tmp_path / "log")
    rows = _log(spark, 20).persist()
    ids = F.col("event_id")
    known = [r[0] for r in rows.select(ids).orderBy(ids).limit(9).collect()]
    called = []
    plain = type(rows).dropDuplicates
    monkeypatch.setattr(
        type(rows), "dropDuplicates", lambda *a: called.append(1) or plain(*a)
    )
    sinks.append_new(rows.filter(ids.isin(known)), path, stored=True)
    sinks.append_new(rows.filter(~ids.isin(known)), path, stored=True)
    assert called == []
    sinks.append_new(rows, path, stored=True)
    assert called == [1] and spark.read.parquet(path).count() == 20


def test_a_trigger_takes_its_own_rows_only(spark, tmp_path):
    """Six arrivals in four triggers: no file is empty, so none is taken early."""
    arrivals = spark.range(6).select(F.col("id").alias("arrival"))
    source = queries._arriving(spark, arrivals, str(tmp_path))
    taken = []
    sinks.drain(
        source,
        lambda batch, _: taken.append(sorted(r[0] for r in batch.collect())),
        f"{tmp_path}/checkpoint",
    )
    assert taken == [[0, 1], [2], [3, 4], [5]]


def test_times_are_read_alike_from_texts_and_times(spark):
    texts = ["2024-01-02T03:04:05.000006", "0000-05-06T00:00:00", None]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").withColumns(
        {"ntz": F.col("t").cast("timestamp_ntz"), "zoned": F.col("t").cast("timestamp")}
    )
    far = F.lit("+10000-01-01T00:00:00").cast("timestamp_ntz")
    frame = frame.unionByName(
        spark.range(1).select(
            F.lit(None).cast("string").alias("t"), far.alias("ntz"), far.cast("timestamp").alias("zoned")
        )
    )
    columns = [session_state._micros(frame, name) for name in frame.columns]
    read = frame.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
    assert all(len(set(row)) == 1 for row in read.collect())
    assert "RLIKE" not in frame.select(columns[1])._jdf.queryExecution().toString()


def test_unreadable_messages_go_to_dead_letters(spark):
    good = '{"event_id": "e1", "user_session": "s", "price": 2.5}'
    frame = spark.createDataFrame([(good, 1), ("not json", 2)], "value string, arrival long")
    decoded = streams.decode(frame)
    assert [r["event_id"] for r in streams.readable(decoded).collect()] == ["e1"]
    assert [r["value"] for r in streams.dead_letters(decoded).collect()] == ["not json"]


def test_keyed_messages(spark, tmp_path):
    frame = silver(spark, [event("s1", 0), event("s2", 1)])
    path = str(tmp_path / "topic")
    assert batch_sinks.publish(frame, "json", path=path) == 2
    rows = spark.read.json(path).collect()
    assert {r["key"] for r in rows} == {"s1", "s2"} and '"brand":null' in rows[0]["value"]
    assert any('"source_event_time":"2019-10-01T00:00:01"' in r["value"] for r in rows)


def test_repeats_within_the_watermark(spark, tmp_path):
    layout = "event_id string, arrived_at timestamp"
    data = [(f"e{i % 3}", START + dt.timedelta(seconds=i)) for i in range(9)]
    spark.createDataFrame(data, layout).write.parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(layout).parquet(f"{tmp_path}/in")
    out = f"{tmp_path}/out"
    sinks.drain(
        session_state.drop_repeats(source),
        lambda batch, _: batch.write.mode("append").parquet(out),
        f"{tmp_path}/checkpoint",
    )
    kept = spark.read.parquet(out).select("event_id").orderBy(F.col("event_id"))
    assert [r[0] for r in kept.collect()] == ["e0", "e1", "e2"]


def test_missing_products_count_once_over_triggers(spark, tmp_path):
    """No product, or no category, is one value of the session, also later on."""
    rnd = random.Random(6)
    events, number = [], 0
    for _ in range(3):
        batch = []
        for _ in range(12):
            batch.append(message(
                f"e{number}", seconds=number, arrival=number,
                product_id=rnd.choice([None, "null", "", "p1"]),
                category_id=rnd.choice([None, "null", "c1"]),
            ))
            number += 1
        events.append(batch)
    rows = served(spark, run(spark, tmp_path, events))
    products, categories = set(), set()
    for m in sum(events, []):
        found = rows[(m["event_id"], m["arrival"])]
        counts = found["serving_unique_products"], found["serving_unique_categories"]
        assert counts == (len(products), len(categories))
        products.add(m["product_id"])
        categories.add(m["category_id"])
    assert None in products and "null" in products


class _Store:
    """Map state in memory that notes what is asked of it."""

    def __init__(self):
        self.held, self.cleared = {}, 0

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held[key]

    def updateValue(self, key, value):
        self.held[key] = value

    def clear(self):
        self.held, self.cleared = {}, self.cleared + 1

    def iterator(self):
        raise AssertionError("the ids must not be listed")


def test_spilled_ids_leave_by_buckets():
    """Against a plain dict, over many limits; no list of ids is read."""
    rnd = random.Random(9)
    ttl, now, first = 100, 0, {}
    stores, text, spilled, bucket = [_Store(), _Store()], "{}", False, 0
    for _ in range(400):  # triggers
        ids = session_state._Ids(stores, text, spilled, 3, ttl, bucket)
        now += rnd.choice([0, 1, 5, 30, 30, 120, 260])
        ids.roll(now)
        for _ in range(rnd.randrange(8)):
            now += rnd.randrange(4)
            name = f"i{rnd.randrange(12)}"
            known = name in first and now - first[name] <= ttl
            assert ids.seen(name, now) == known
            if not known:
                first[name] = now
        text, spilled, bucket = ids.text(), ids.spilled, ids.bucket
        assert all(len(s.held) <= 12 for s in stores)
    assert all(s.cleared > 10 for s in stores)


def _log(spark, n, day=0, tag=""):
    rows = [
        (f"{tag}e{i}", START + dt.timedelta(days=day, seconds=i), None, "view", "p", "c", "u", f"s{i % 9}",
         None, None, 1.0, "replay") for i in range(n)
    ]
    types = "string timestamp_ntz timestamp_ntz string string string string string string string double string"
    schema = ", ".join(f"{c} {t}" for c, t in zip(sinks.LOG_COLUMNS, types.split()))
    return spark.createDataFrame(rows, schema)


def _files(path, day):
    name = (START + dt.timedelta(days=day)).date().isoformat()
    return len(list((path / f"event_date={name}").glob("*.parquet")))


def test_a_day_is_written_by_many_tasks_and_compacted(spark, tmp_path):
    path = tmp_path / "log"
    sinks.append_new(_log(spark, 400), str(path), rows_per_file=50)
    assert 5 <= _files(path, 0) <= 8
    sinks.append_new(_log(spark, 10, 1, "x"), str(path), rows_per_file=50)
    sinks.append_new(_log(spark, 450), str(path), rows_per_file=50)  # 50 are new
    assert _files(path, 1) == 1
    before = sorted(map(tuple, spark.read.parquet(str(path)).drop("created_at").collect()), key=str)
    assert len(before) == 460
    sinks.compact_log(spark, str(path), [START.date()])
    assert _files(path, 0) == 1 and _files(path, 1) == 1
    after = sorted(map(tuple, spark.read.parquet(str(path)).drop("created_at").collect()), key=str)
    assert after == before
    sinks.append_new(_log(spark, 450), str(path))
    assert spark.read.parquet(str(path)).count() == 460


@pytest.mark.parametrize("broken", ["late", "serving", "dead", "commits"])
def test_a_batch_that_fails_between_sinks_is_repeated(spark, tmp_path, monkeypatch, broken):
    """The query stops at the second batch, starts again, and all sinks equal those
    of a run without a failure."""
    rnd = random.Random(3)
    batches, number = [], 0
    for _ in range(3):
        batch = []
        for _ in range(15):
            kind = rnd.choice([*TYPES, "wishlist"])
            batch.append(message(
                f"e{rnd.randrange(30)}", rnd.choice("ab"), rnd.randrange(300), kind, number, clock=number,
            ))
            number += 1
        batches.append(batch)

    def feed(folder, fail):
        paths = {n: f"{folder}/{n}" for n in ("log", "late", "serving", "dead", "commits")}
        for batch in batches:
            frame = spark.createDataFrame([tuple(m.values()) for m in batch], LAYOUT)
            frame.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        source = streams.file_events(spark, f"{folder}/in", frame.schema, files_per_trigger=1)
        write, put, failed = sinks.route(*paths.values()), sinks.batch_table, []

        def once(df, path, batch_id):
            if fail and batch_id == 1 and path == paths[broken] and not failed:
                failed.append(path)
                raise OSError("disk full")
            put(df, path, batch_id)

        monkeypatch.setattr(sinks, "batch_table", once)
        for _ in range(2):
            tracked = session_state.track_sessions(source)
            try:
                sinks.drain(tracked, write, f"{folder}/checkpoint")
                break
            except Exception as error:
                assert failed and "disk full" in str(error)
        monkeypatch.setattr(sinks, "batch_table", put)
        assert bool(failed) == fail
        return {
            n: sorted(map(tuple, spark.read.parquet(p).drop("created_at").collect()), key=str)
            for n, p in paths.items()
        }

    clean, repeated = feed(tmp_path / "a", False), feed(tmp_path / "b", True)
    assert repeated == clean and all(clean.values())


def test_a_committed_batch_is_not_written_again(spark, tmp_path):
    paths = [str(tmp_path / n) for n in ("log", "late", "serving", "dead", "commits")]
    sinks.batch_table(spark.range(1), paths[-1], 7)
    sinks.route(*paths)(spark.range(3), 7)
    assert not (tmp_path / "serving").exists()


def test_a_key_costs_one_row_and_one_read_of_its_state():
    """Rows and state calls of the processor do not grow with a key's events."""
    calls = []

    class Store:
        def get(self):
            calls.append("get")

        def update(self, value):
            calls.append("update")

    class Handle:
        def getValueState(self, *_):
            return Store()

        def getMapState(self, *_):
            return Store()

    processor = session_state.SessionProcessor(3600, 60, False)
    processor.init(Handle())
    event = {"event_type": "view", "source_us": 1, "replay_us": 1}
    rows = [
        ("s", json.dumps({**event, "event_id": f"e{i}", "arrival": i})) for i in range(400)
    ]
    out = list(processor.handleInputRows(("s",), iter(rows), None))
    assert len(out) == 1 and calls == ["get", "update"]
    results = json.loads(out[0]["results"])
    assert [r["serving_total_views"] for r in results] == list(range(400))


class _Lane:
    """State of one lane in memory, with the calls that reach the server."""

    def __init__(self):
        self.value, self.maps, self.calls = None, {}, []

    def getValueState(self, *_):
        return self

    def get(self):
        self.calls.append("get")
        return self.value

    def update(self, value):
        self.calls.append("update")
        self.value = value

    def getMapState(self, name, *_):
        return self.maps.setdefault(name, _LaneMap(self.calls))


class _LaneMap:
    def __init__(self, calls):
        self.held, self.calls = {}, calls

    def getValue(self, key):
        self.calls.append("map")
        return self.held.get(key)

    def updateValue(self, key, value):
        self.calls.append("map")
        self.held[key] = value

    def removeKey(self, key):
        self.held.pop(key, None)

    def iterator(self):
        self.calls.append("list")
        return iter(list(self.held.items()))


def _in_lane(lane, messages, **rules):
    """One trigger of a lane: the status and product count of each event."""
    processor = session_state.SessionProcessor(100, 60, False, **rules)
    processor.init(lane)
    rows = []
    for m in messages:
        start = START.replace(tzinfo=dt.timezone.utc)
        event = {k: m[k] for k in ("event_id", "user_session", "event_type", "product_id", "arrival")}
        for name, column in (("source_us", "source_event_time"), ("replay_us", "replay_time")):
            at = m[column].replace(tzinfo=dt.timezone.utc) - start
            event[name] = int(at.total_seconds()) * 1_000_000 + 10**12
        rows.append((7, json.dumps(event)))
    out = list(processor.handleInputRows((7,), iter(rows), None))
    results = [r for pack in out for r in json.loads(pack["results"])]
    return {
        r["event"]["arrival"]: (r["status"], r.get("serving_unique_products")) for r in results
    }


def test_the_sessions_of_a_lane_cost_one_read_and_one_write():
    """Calls to the state server do not grow with the number of sessions."""
    lane = _Lane()
    for trigger in range(3):
        some = [
            message(f"e{trigger}-{i}", f"s{i % 50}", trigger, arrival=1000 * trigger + i)
            for i in range(200)
        ]
        assert len(_in_lane(lane, some)) == 200
    assert lane.calls == ["get", "update"] * 3


@pytest.mark.parametrize("inline", [500, 2])
def test_sessions_laid_aside_come_back_if_the_clock_does(inline):
    """The clocks of a lane's sessions may differ: each keeps to its own."""
    rnd = random.Random(5)
    lane, messages, clocks = _Lane(), [], dict.fromkeys("abcd", 0)
    found = {}
    for trigger in range(80):
        batch = []
        for _ in range(rnd.randrange(1, 8)):
            name = rnd.choice("abcd")
            clocks[name] += rnd.choice([0, 3, 9, 40, 40, 130, 400 if name == "a" else 20])
            number = len(messages)
            batch.append(message(
                f"{name}{rnd.randrange(40)}", name, clocks[name] - rnd.choice([0, 0, 30, 90]),
                rnd.choice(TYPES), number, clock=clocks[name], product_id=f"p{rnd.randrange(9)}",
            ))
            messages.append(batch[-1])
        found.update(_in_lane(lane, batch, inline=inline))
    expected = {
        arrival: (status, values and values[3])
        for arrival, (status, values) in plain_rules(messages, 100, 60).items()
    }
    assert found == expected
    assert "list" in lane.calls and lane.maps["aside"].held


def test_pages_of_a_large_set_are_found_and_cleared(monkeypatch):
    monkeypatch.setattr(session_state, "PAGE_NAMES", 5)
    monkeypatch.setattr(session_state, "PAGES_HELD", 3)
    shared = _LaneMap([])
    other = session_state._Paged(shared, "other")
    other.updateValue(("n1",), (7,))
    other.flush()
    for begin in (0, 150):  # taken up anew by a later trigger
        names = session_state._Paged(shared, "s")
        for i in range(begin, begin + 150):
            assert not names.containsKey((f"n{i}",))
            names.updateValue((f"n{i}",), (i,))
        names.flush()
    names = session_state._Paged(shared, "s")
    assert [names.getValue((f"n{i}",)) for i in range(300)] == [(i,) for i in range(300)]
    assert max(len(json.loads(t[0])) for t in shared.held.values()) < 25
    names.clear()
    assert not names.containsKey(("n1",))
    assert session_state._Paged(shared, "other").getValue(("n1",)) == (7,)
    assert len(shared.held) == 2  # the other session's head and page
