from __future__ import annotations

import hashlib
import random

import numpy as np
from llm_data import SCHEMA, with_odd_rows

from clickloom.llm import substring


def plain(rows):
    split = [(i, (t or "").encode().split()) for i, t, *_ in rows]
    least = {}
    for i, words in split:
        if i is None:
            continue
        for k in range(len(words) - 12):
            key = tuple(words[k : k + 13])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, words in split:
        gone = [False] * len(words)
        for k in range(len(words) - 12):
            if i is not None and least[tuple(words[k : k + 13])] < i:
                gone[k : k + 13] = [True] * 13
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((str(i), len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def got(frame):
    found = substring.digests(frame).collect()
    return sorted((str(r[0]), r[1], r[2], r[3]) for r in found)


def test_against_plain_rules(docs, odd, empty, rows):
    want = plain(rows)
    assert sum(w[2] for w in want) > 2000
    assert got(docs) == want
    assert got(odd) == plain(with_odd_rows(rows))
    assert got(empty) == []


def test_repeats_inside_and_across(spark):
    rng = random.Random(4)
    passage = " ".join(f"w{rng.randrange(30)}" for _ in range(80))
    loop = "again " * 60
    rows = [
        (i, f"{rng.random()} {rng.choice([passage, loop, passage[:90]])} {rng.random()}",
         None, None, 0)
        for i in rng.sample(range(10_000), 150)
    ]
    rows += [(i, passage, None, None, 0) for i in range(20_000, 20_040)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert got(frame) == plain(rows)


def test_kept_text_and_carried_columns(spark):
    text = " ".join(str(i) for i in range(30))
    rows = [(1, text, "en", "a", 1), (2, f"x\n{text}  y", "de", "b", 1), (3, "p\n q", "fr", "c", 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    found = substring.remove_repeats(frame, ("lang", "source")).collect()
    assert {(r["doc_id"], r["text"], r["lang"], r["source"]) for r in found} == {
        (1, text, "en", "a"), (2, "x y", "de", "b"), (3, "p\n q", "fr", "c")
    }


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 50, 100).astype(np.uint64)
    for width in range(1, 14):
        want = [min(values[i : i + width]) for i in range(100 - width + 1)]
        assert substring.sliding_min(values, width).tolist() == want


def test_a_frequent_minimiser_is_dealt_out(spark, monkeypatch):
    """Every window of one minimiser lay in one bucket, whatever their number."""
    rng = random.Random(6)
    # windows around the same three words, the rest of each differing
    low = min(
        (f"a{i} b{i} c{i}" for i in range(3000)),
        key=lambda t: int(substring.group_hashes(t.encode().split())[0]),
    )
    rows = []
    for i in range(300):
        around = [f"w{rng.randrange(400)}" for _ in range(20)]
        text = " ".join(around[:10]) + f" {low} " + " ".join(around[10:])
        rows += [(2 * i, text, None, None, 0), (2 * i + 1, f"{text} z{i}", None, None, 0)]
    monkeypatch.setattr(substring, "HEAVY_WINDOWS", 500)
    monkeypatch.setattr(substring, "COUNT_SHARE", 1)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    texts = frame.selectExpr("doc_id", "0 AS hash", "cast(text AS binary) AS text")
    heavy = substring.heavy_minimisers(texts)
    assert heavy.tolist() == substring.group_hashes(low.encode().split()).tolist()

    def largest(heavy):
        held = {}
        for r in substring.packed_windows(texts, 64, heavy).filter("NOT marks").collect():
            head, _, body = substring._open(bytes(r["blob"]))
            held.setdefault(r["bucket"], set()).update(substring._windows(head, body)[0])
        return max(map(len, held.values()))

    assert largest(None) > 3000
    assert largest(heavy) < 300
    assert got(frame) == plain(rows)


def test_all_minimisers_heavy(docs, rows, monkeypatch):
    monkeypatch.setattr(substring, "HEAVY_WINDOWS", 1)
    monkeypatch.setattr(substring, "COUNT_SHARE", 2)
    monkeypatch.setattr(substring, "COUNTED", 50)
    assert got(docs) == plain(rows)
