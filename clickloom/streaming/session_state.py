"""Keyed session state on Structured Streaming.

Every event leaves with a status and, if accepted, with the state of its
session *before* it (what a model would see) and the counters after it. The
late rule depends on the last accepted event of the same session, which is a
recurrence, so this is the one operator that needs a stateful processor.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from operator import itemgetter
from zlib import crc32

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from clickloom import constants as C
from clickloom.functions import scalars as S

ACCEPTED, DUPLICATE, LATE, REJECTED = "accepted", "duplicate", "late", "rejected"
COUNTED = {"view": 3, "cart": 4, "remove_from_cart": 5}
KEY = "_key"
LANES, REJECT_LANES = 4096, 256

_TEXT, _LONG = T.StringType(), T.LongType()


def _fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in pairs])


_EVENT = _fields(
    ("user_session", _TEXT),
    ("event_id", _TEXT),
    ("arrival", _LONG),
    ("source_us", _LONG),
    ("replay_us", _LONG),
    ("event_type", _TEXT),
    ("product_id", _TEXT),
    ("category_id", _TEXT),
    ("category_code", _TEXT),
    ("brand", _TEXT),
    ("price", _TEXT),
    ("user_id", _TEXT),
    ("source", _TEXT),
    ("message", _TEXT),
    ("reason", _TEXT),
)
_INPUT = tuple(_EVENT.names)

_RESULT = T.StructType(
    [
        T.StructField("event", _EVENT, True),
        *_fields(
            ("status", _TEXT),
            ("late_reason", _TEXT),
            ("first_us", _LONG),
            ("last_us", _LONG),
            ("count_view", _LONG),
            ("count_cart", _LONG),
            ("count_remove_from_cart", _LONG),
            ("serving_total_views", _LONG),
            ("serving_total_carts", _LONG),
            ("serving_total_removes", _LONG),
            ("serving_unique_products", _LONG),
            ("serving_unique_categories", _LONG),
        ).fields,
    ]
)

# Events travel as one text each and results as one text for many events: a
# processor's own rows cost a table per key and an object per cell.
_PACKED = _fields(("results", _TEXT))
_ROW = Row("results")
_COUNTS = tuple(_RESULT.names[3:])
PACK_ROWS, PACK_CHARS = 1_000, 1 << 20

# A key of the state is a lane of many sessions, as a call to the state server costs
# more than the events of a session. ``sessions`` holds a text per session: the fields
# below as JSON. Sessions past both limits lie aside, in pages of their own; ``aside``
# is the newest clock at which one of those could still matter.
_STATE = _fields(("sessions", _TEXT), ("aside", _LONG), ("pages", _LONG))
_EMPTY = ("{}", None, 0)

# alive, first, last, clock of the last accepted event, views, carts, removes, products,
# categories; then the small sets as JSON, whether the ids have spilled, the newest time
# bucket of the ids, the number that tells this life of the session from earlier ones,
# the newest clock of its events, and the wall clock of the last trigger.
_NEW = (False, 0, 0, 0, 0, 0, 0, 0, 0, "{}", "{}", "{}", False, 0)
_LIFE, _HEARD, _WALL = 14, 15, 16
_INLINE = 500
PAGE_NAMES, PAGES_HELD = 100, 1_000


def late_reason(seconds: int) -> str:
    # Fixed value: the text consumers of the late topic match on.
    return f"older_than_last_event_time_by_more_than_{seconds}s"


def _missing(value) -> bool:
    return value is None or value == "" or value != value


def _coded(value: str | None) -> str:
    """A set member as text; no value is a member of its own."""
    return "" if value is None else f"={value}"


class _Names:
    """A set of texts with a number each: small ones inline, the rest in a map.

    An ordinary session costs one state read and one write per trigger; a huge
    one is never loaded as a whole.
    """

    def __init__(self, store, text: str, spilled: bool, room: int):
        self.store, self.inline, self.spilled = store, json.loads(text), spilled
        self.room = room

    def get(self, name: str):
        found = self.inline.get(name)
        if found is None and self.spilled and self.store.containsKey((name,)):
            return self.store.getValue((name,))[0]
        return found

    def put(self, name: str, number: int) -> None:
        if name in self.inline or len(self.inline) < self.room:
            self.inline[name] = number
        else:
            self.store.updateValue((name,), (number,))
            self.spilled = True

    def clear(self) -> None:
        self.inline = {}
        if self.spilled:
            self.store.clear()
            self.spilled = False

    def text(self) -> str:
        return json.dumps(self.inline)


class _Ids:
    """Ids with the clock they were first seen at, for one time limit.

    Small sets sit inline. The rest is dealt by time over two maps: buckets are
    as long as the limit, so an id of the bucket before the last one is past it,
    and its whole map is cleared at once. No list of ids is ever read.
    """

    def __init__(self, stores, text: str, spilled: bool, room: int, ttl: int, bucket: int):
        self.stores, self.inline, self.spilled = stores, json.loads(text), spilled
        self.room, self.ttl, self.bucket = room, ttl, bucket

    def roll(self, now: int) -> None:
        """Drop what is past the limit."""
        self.inline = {k: v for k, v in self.inline.items() if now - v <= self.ttl}
        self._advance(now // self.ttl)

    def _advance(self, bucket: int) -> None:
        passed = bucket - self.bucket
        if self.spilled and passed > 0:
            self.stores[bucket % 2].clear()
            if passed > 1:
                self.stores[1 - bucket % 2].clear()
                self.spilled = False
        self.bucket = max(self.bucket, bucket)

    def seen(self, name: str, now: int) -> bool:
        """Whether the id was seen within the limit; if not, it is from now on."""
        at = self.inline.get(name)
        found = [] if at is None else [at]
        if at is None and self.spilled:
            held = (s for s in self.stores if s.containsKey((name,)))
            found = [store.getValue((name,))[0] for store in held]
        if any(now - at <= self.ttl for at in found):
            return True
        if name in self.inline or len(self.inline) < self.room:
            self.inline[name] = now
        else:
            self._advance(now // self.ttl)
            self.stores[now // self.ttl % 2].updateValue((name,), (now,))
            self.spilled = True
        return False

    def text(self) -> str:
        return json.dumps(self.inline)


class _Paged:
    """The map of one session in a map state that all sessions of a lane share.

    Names lie by their hash in pages of about ``PAGE_NAMES``, so the session's part
    is cleared without listing names. Pages double in number as names are added;
    some are held until ``flush``.
    """

    def __init__(self, store, prefix: str):
        self.store, self.prefix = store, prefix
        self.head, self.pages, self.changed = None, {}, set()

    def _read(self, part):
        found = self.store.getValue((f"{part}/{self.prefix}",))
        return json.loads(found[0]) if found else None

    def _write(self, part, value) -> None:
        self.store.updateValue((f"{part}/{self.prefix}",), (json.dumps(value),))

    def _size(self) -> list[int]:
        """The numbers of pages and of names put."""
        if self.head is None:
            self.head = self._read("head") or [1, 0]
        return self.head

    def _page(self, name: str) -> tuple[int, dict]:
        number = crc32(name.encode()) % self._size()[0]
        if number not in self.pages:
            if len(self.pages) >= PAGES_HELD:
                self.flush()
                self.pages = {}
            self.pages[number] = self._read(number) or {}
        return number, self.pages[number]

    def containsKey(self, key) -> bool:
        return key[0] in self._page(key[0])[1]

    def getValue(self, key):
        return (self._page(key[0])[1][key[0]],)

    def updateValue(self, key, value) -> None:
        number, page = self._page(key[0])
        self.head[1] += key[0] not in page
        page[key[0]] = value[0]
        self.changed.add(number)
        if self.head[1] > self.head[0] * PAGE_NAMES:
            self._double()

    def _double(self) -> None:
        """Every page leaves a part of its names to a new one."""
        self.flush()
        self.pages, count = {}, self.head[0]
        self.head[0] = 2 * count
        for number in range(count):
            page = self._read(number) or {}
            new = {k: v for k, v in page.items() if crc32(k.encode()) % self.head[0] != number}
            self._write(number, {k: v for k, v in page.items() if k not in new})
            self._write(number + count, new)
        self._write("head", self.head)

    def flush(self) -> None:
        if self.changed:  # the head last, so that it does not expire first
            for number in self.changed:
                self._write(number, self.pages[number])
            self._write("head", self.head)
            self.changed = set()

    def clear(self) -> None:
        for part in [*range(self._size()[0]), "head"]:
            self.store.removeKey((f"{part}/{self.prefix}",))
        self.head, self.pages, self.changed = [1, 0], {}, set()


_COUNTED_TEXT = "".join(f',"{name}":%d' for name in _COUNTS)


def _result(event: str, status: str, late: str | None = None, counts: tuple = ()) -> str:
    """An event's text with what became of it; absent names are NULL."""
    text = f'{{"event":{event},"status":"{status}"'
    if late is not None:
        text += f',"late_reason":{json.dumps(late)}'
    if counts:
        text += _COUNTED_TEXT % counts
    return text + "}"


def _packs(results: Iterator[str]) -> Iterator[Row]:
    """Rows of many results each, bounded in number and size."""
    held, size = [], 0
    for result in results:
        held.append(result)
        size += len(result)
        if len(held) >= PACK_ROWS or size >= PACK_CHARS:
            yield _ROW(f"[{','.join(held)}]")
            held, size = [], 0
    if held:
        yield _ROW(f"[{','.join(held)}]")


class SessionProcessor(StatefulProcessor):
    """Duplicate, late and session rules, in arrival order of each session.

    A key is a lane of sessions: its state is read and written once a trigger for
    all of them. The clock is the arrival time of the events, so a replay gives the
    same answer every time. A session whose state and ids are past the limit at the
    newest clock of its lane lies aside in a page that is read only if the clock of
    an event goes back to where it could matter; so a trigger costs what its sessions
    and those of the last time limit cost.

    ``live`` adds a wall-clock limit so that idle sessions go away. The lane, its
    pages and the seen ids then have a TTL; the value and category sets have none,
    as they live as long as their session: they go with it, or by a timer that every
    trigger of the lane sets anew.

    Rows with a reason are given back as rejected and touch no state.
    """

    def __init__(self, ttl_seconds, late_seconds, live, inline: int = _INLINE):
        self.ttl = ttl_seconds * C.MICROS
        self.late = late_seconds * C.MICROS
        self.reason = late_reason(late_seconds)
        self.expiry = ttl_seconds * 1000 if live else None
        self.inline = inline

    def init(self, handle: StatefulProcessorHandle) -> None:
        name, text = _fields(("name", _TEXT)), _fields(("text", _TEXT))
        number = _fields(("number", _LONG))
        self.handle = handle
        self.stored = handle.getValueState("state", _STATE, self.expiry)
        self.aside = handle.getMapState("aside", number, text, self.expiry)
        self.maps = [
            handle.getMapState("products", name, text),
            handle.getMapState("categories", name, text),
        ]
        self.id_maps = [
            handle.getMapState(f"seen_{n}", name, text, self.expiry) for n in (0, 1)
        ]

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        yield from _packs(self._results(rows, timerValues))

    def _results(self, rows, timerValues) -> Iterator[str]:
        # One trigger brings a bounded number of rows (see sources.streams).
        sessions, newest = {}, None
        for row in rows:
            text = row[1]
            event = json.loads(text)
            if "reason" in event:
                yield _result(text, REJECTED)
            else:
                some = sessions.setdefault(event.get("user_session", ""), [])
                some.append((event["arrival"], text, event))
        if not sessions:
            return
        wall = timerValues.getCurrentProcessingTimeInMs() if self.expiry else 0
        held, aside, pages = self._open(sessions, wall)
        for name, events in sessions.items():
            events.sort(key=itemgetter(0))
            self._load(name, held.get(name), events[0][2])
            for _, text, event in events:
                yield _result(text, *self._apply(event))
            held[name] = self._saved(events, wall)
            heard = held[name][_HEARD]
            newest = heard if newest is None else max(newest, heard)
        self._close(held, aside, pages, newest)
        if self.expiry and any(map(self._names_spilled, held.values())):
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(wall + self.expiry)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """No event for the whole limit: the spilled sets of the lane go."""
        self.maps[0].clear()
        self.maps[1].clear()
        yield from ()

    def _open(self, sessions: dict, wall: int) -> tuple[dict, int | None, int]:
        """The states of the lane, also those that lie aside and may matter now."""
        state = self.stored.get()
        if self.expiry and state is None:  # what an expired lane may have left
            self.maps[0].clear()
            self.maps[1].clear()
        text, aside, pages = _EMPTY if state is None else tuple(state)
        held = json.loads(text)
        if aside is not None:
            back = {
                name
                for name, events in sessions.items()
                if name not in held and min(e[2]["replay_us"] for e in events) <= aside
            }
            found = {}
            for (number,), (page,) in self.aside.iterator() if back else ():
                for name, entry in json.loads(page).items():
                    if name in back and found.get(name, (-1,))[0] < number:
                        found[name] = number, entry
            held.update((name, entry) for name, (_, entry) in found.items())
        if self.expiry:
            for name in [n for n, e in held.items() if wall - e[_WALL] > self.expiry]:
                self._load(name, held.pop(name), None)
                self.products.clear()
                self.categories.clear()
        return held, aside, pages

    def _close(self, held: dict, aside: int | None, pages: int, newest: int) -> None:
        """Store the lane; what is past the limits is laid aside as a page."""
        past = {
            name: entry
            for name, entry in held.items()
            if entry[_HEARD] + self.ttl < newest
            and not (self.expiry and self._names_spilled(entry))
        }
        if past:
            self.aside.updateValue((pages,), (json.dumps(past),))
            pages += 1
            ends = [entry[_HEARD] + self.ttl for entry in past.values()]
            aside = max(ends) if aside is None else max(aside, *ends)
            for name in past:
                del held[name]
        self.stored.update((json.dumps(held), aside, pages))

    def _names_spilled(self, entry) -> bool:
        return entry[7] > self.inline or entry[8] > self.inline

    def _load(self, name: str, entry: list | None, first: dict | None) -> None:
        """Take up a session, or begin it with its first event."""
        state = (*_NEW, first["arrival"], first["replay_us"]) if entry is None else entry
        self.alive, self.session, sets = state[0], list(state[1:9]), state[9:12]
        self.life, self.heard = state[_LIFE], state[_HEARD]
        spilled = (self.session[6] > self.inline, self.session[7] > self.inline)
        prefix = f"{self.life}/{name}"
        self.stores = [_Paged(m, prefix) for m in (*self.maps, *self.id_maps)]
        self.products, self.categories = (
            _Names(*parts, self.inline) for parts in zip(self.stores, sets, spilled)
        )
        self.seen = _Ids(
            self.stores[2:], sets[2], state[12], self.inline, self.ttl, state[13]
        )
        if first is not None:
            self.seen.roll(first["replay_us"])

    def _saved(self, events: list, wall: int) -> list:
        for store in self.stores:
            store.flush()
        heard = max(self.heard, max(event["replay_us"] for _, _, event in events))
        texts = (self.products.text(), self.categories.text(), self.seen.text())
        ids = (self.seen.spilled, self.seen.bucket)
        return [self.alive, *self.session, *texts, *ids, self.life, heard, wall]

    def _first(self, names: _Names, value: str | None) -> int:
        value = _coded(value)
        if names.get(value) is not None:
            return 0
        names.put(value, 1)
        return 1

    def _apply(self, event: dict) -> tuple:
        at, now = event["source_us"], event["replay_us"]
        category, code = event.get("category_id"), event.get("category_code")
        if self.seen.seen(event["event_id"], now):
            return (DUPLICATE,)
        if self.alive and now - self.session[2] > self.ttl:
            self.products.clear()
            self.categories.clear()
            self.alive = False
        if self.alive and at < self.session[1] - self.late:
            return LATE, self.reason
        if not self.alive:
            self.session = [at, at, now, 0, 0, 0, 0, 0]
            self.alive = True
        state = self.session
        before = state[3:8]
        kind = event["event_type"]
        if kind in COUNTED:
            state[COUNTED[kind]] += 1
        state[1], state[2] = at, now
        state[6] += self._first(self.products, event.get("product_id"))
        state[7] += self._first(self.categories, category if _missing(code) else code)
        after = state[3:6]
        return ACCEPTED, None, (state[0], state[1], *after, *before)

    def close(self) -> None:
        pass


def reject_reason() -> Column:
    """Why an event cannot be tracked, or NULL."""
    kind = F.col("event_type")
    return (
        F.when(F.col("event_id").isNull() & kind.isNull(), "unreadable_event")
        .when(F.coalesce("event_id", F.lit("")) == "", "event_id is missing")
        .when(F.coalesce("user_session", F.lit("")) == "", "user_session is missing")
        .when(F.col("arrival").isNull(), "arrival is missing")
        .when(F.col("source_us").isNull(), "unreadable source_event_time")
        .when(F.col("replay_us").isNull(), "unreadable replay_time")
        .when(kind.isNull() | ~kind.isin(*C.EVENT_TYPES), "event_type not allowed")
    )


def _micros(events: DataFrame, name: str) -> Column:
    """The time of a column in microseconds; only texts are read as texts."""
    time = F.col(name)
    if isinstance(events.schema[name].dataType, (T.TimestampNTZType, T.TimestampType)):
        zoneless = time.cast("timestamp_ntz")
        return S.epoch_micros(F.when(F.year(zoneless).between(0, 9999), zoneless))
    return S.epoch_micros(S.parse_iso(time.cast("string")))


def track_sessions(
    events: DataFrame,
    ttl_seconds: int = C.STATE_TTL_SECONDS,
    late_seconds: int = C.LATE_THRESHOLD_SECONDS,
    live: bool = False,
    lanes: int = LANES,
) -> DataFrame:
    """Status and serving columns for a stream of replay events.

    Needs ``arrival``, a number that grows with the order of arrival inside a
    session (an offset); ``replay_time`` is the clock of both time limits.
    ``user_id``, ``source`` and ``_text`` (the message) are carried if there.
    Rows that cannot be tracked come back as rejected, with a reason; they are
    dealt over many keys before the shuffle. Sessions share ``lanes`` keys, a number
    that a checkpoint fixes, like the number of its partitions.
    """
    times = {
        "source_us": _micros(events, "source_event_time"),
        "replay_us": _micros(events, "replay_time"),
    }
    optional = {"user_id": "user_id", "source": "source", "message": "_text"}
    for name, column in optional.items():
        held = F.col(column) if column in events.columns else F.lit(None)
        times[name] = held.cast("string")
    checked = events.withColumns(times).withColumn("reason", reject_reason())
    rejects = F.pmod(F.xxhash64("arrival", "message"), F.lit(REJECT_LANES))
    key = F.when(
        F.col("reason").isNull(), F.pmod(F.xxhash64("user_session"), F.lit(lanes))
    ).otherwise(-1 - rejects)
    # a price as text comes back as the same number, also if it is none
    price = F.col("price").cast("string").alias("price")
    packed = F.to_json(F.struct(*(price if n == "price" else n for n in _INPUT)))
    keyed = checked.select(key.alias(KEY), packed.alias("event")).groupBy(KEY)
    tracked = keyed.transformWithState(
        statefulProcessor=SessionProcessor(ttl_seconds, late_seconds, live),
        outputStructType=_PACKED,
        outputMode="Append",
        timeMode="ProcessingTime" if live else "None",
    )
    found = F.from_json("results", T.ArrayType(_RESULT), {"mode": "FAILFAST"})
    results = tracked.select(F.inline(found))
    price = F.col("price").cast("double")
    return _serving(results.select("event.*", *_RESULT.names[1:]).withColumn("price", price))


def _serving(tracked: DataFrame) -> DataFrame:
    def time(name):
        return F.timestamp_micros(name).cast("timestamp_ntz")

    accepted = F.col("status") == ACCEPTED

    def when_accepted(column):
        return F.when(accepted, column)

    views, carts = F.col("serving_total_views"), F.col("serving_total_carts")
    price = F.coalesce(F.nanvl("price", F.lit(0.0)), F.lit(0.0))
    current = {
        "price": price,
        "category_id": F.col("category_id"),
        "category_code": F.coalesce("category_code", F.lit("")),
        "brand": F.coalesce("brand", F.lit("")),
        "event_type": F.col("event_type"),
    }
    columns = {
        "source_event_time": time("source_us"),
        "replay_time": time("replay_us"),
        "first_event_time": time("first_us"),
        "last_event_time": time("last_us"),
        "serving_net_cart_count": carts - F.col("serving_total_removes"),
        "serving_cart_to_view_ratio": S.cart_view_ratio(views, carts),
        "serving_session_duration_sec": (F.col("last_us") - F.col("first_us"))
        / F.lit(float(C.MICROS)),
    }
    for name, value in current.items():
        columns[f"latest_{name}"] = when_accepted(value)
        columns[f"serving_{name}"] = when_accepted(value)
    return tracked.withColumns(columns).drop(
        "source_us", "replay_us", "first_us", "last_us"
    )


def drop_repeats(events: DataFrame, ttl: str = "30 minutes") -> DataFrame:
    """First event per id within the watermark, without session state."""
    return events.withWatermark("arrived_at", ttl).dropDuplicatesWithinWatermark(
        ["event_id"]
    )
