"""Small event tables, and the feature rules written as plain loops."""

from __future__ import annotations

import datetime as dt
import random

from clickloom import schemas

TYPES = ["view", "cart", "remove_from_cart", "purchase"]
START = dt.datetime(2019, 10, 1)


def event(session, seconds, kind="view", product="p1", **other):
    row = {
        "source_event_time": START + dt.timedelta(seconds=seconds),
        "event_type": kind,
        "product_id": product,
        "category_id": "c1",
        "user_id": "u1",
        "user_session": session,
        "category_code": None,
        "brand": None,
        "price": 1.0,
    }
    row.update(other)
    return tuple(row[name] for name in schemas.SILVER.names)


def silver(spark, rows):
    return spark.createDataFrame(rows, schemas.SILVER)


def random_events(seed, rows=1500, hot_share=0.4, span=4000):
    """Unique event keys; one session holds ``hot_share`` of them."""
    rnd = random.Random(seed)
    found = {}
    for _ in range(rows):
        hot = rnd.random() < hot_share
        row = event(
            "hot" if hot else f"s{rnd.randrange(60)}",
            rnd.randrange(span // 10 if hot else span),
            rnd.choice(TYPES),
            f"p{rnd.randrange(40)}",
            category_id=f"c{rnd.randrange(5)}",
            category_code=rnd.choice([None, "a", "b"]),
            brand=rnd.choice([None, "x"]),
            price=rnd.choice([None, 5.5, 7.25]),
        )
        found[(row[5], row[0], row[1], row[2], row[4])] = row
    return [found[key] for key in sorted(found)]


def plain_gold(rows, horizon):
    """(key) -> counters and label, straight from the rules."""
    sessions = {}
    for row in rows:
        sessions.setdefault(row[5], []).append(row)
    out = {}
    for name, members in sessions.items():
        members.sort(key=lambda r: (r[0], r[1], r[2], r[4]))
        for i, row in enumerate(members):
            past = members[:i]
            count = {t: sum(r[1] == t for r in past) for t in TYPES}
            label = any(
                r[1] == "purchase"
                and row[0] < r[0] <= row[0] + dt.timedelta(seconds=horizon)
                for r in members
            )
            out[(name, row[0], row[1], row[2])] = (
                count["view"],
                count["cart"],
                count["cart"] - count["remove_from_cart"],
                count["cart"] / count["view"] if count["view"] else 0.0,
                len({r[6] if r[6] is not None else r[3] for r in past}),
                len({r[2] for r in past}),
                (row[0] - members[0][0]).total_seconds(),
                int(label),
            )
    return out
