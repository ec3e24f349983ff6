from __future__ import annotations

import hashlib
import random

import pytest
from llm_data import with_odd_rows
from pyspark.sql import functions as F

from clickloom.llm import components, fingerprint, simhash


def _sketches(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    return [r[0] for r in frame.select(fingerprint.sketch(F.col("text"), 0.25)).collect()]


def test_scaled_sketch_against_plain_rules(spark, docs, rows):
    found = {r["doc_id"]: r for r in fingerprint.fingerprint_documents(docs).collect()}
    assert len(found) == len(rows)
    ordered = sorted((i, t or "") for i, t, *_ in rows)
    for (doc_id, text), (_, after) in zip(ordered, ordered[1:] + ordered[:1]):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        row = found[doc_id]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= row["near_edited"] <= 1 and 0 <= row["near_next"] <= 1
    by_text = {}
    for i, text, *_ in rows:
        by_text.setdefault(text or "", set()).add(found[i]["fingerprint"])
    assert all(len(f) == 1 for f in by_text.values())


def test_scaled_sketch_keeps_a_fraction_and_merges(spark):
    rng = random.Random(3)
    a = " ".join(str(rng.random()) for _ in range(4000))
    b = " ".join(str(rng.random()) for _ in range(4000))
    one, two, both = _sketches(spark, [a, b, a + " " + b])
    assert abs(len(one) - 999) < 150 and one == sorted(set(one))
    seams = set(both) - set(one) - set(two)
    assert len(seams) <= 4 and set(one) | set(two) <= set(both)
    assert _sketches(spark, ["", "  ", "a b", "b a"])[:2] == [[], []]


def test_scaled_sketch_odd_input(odd, empty, rows):
    assert fingerprint.fingerprint_documents(empty).count() == 0
    found = fingerprint.fingerprint_documents(odd).collect()
    assert len(found) == len(rows) + 2
    assert sum(r["doc_id"] is None for r in found) == 1


def test_scaled_sketch_stays_in_the_jvm(docs):
    plan = fingerprint.fingerprint_documents(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("SinglePartition") == 0


@pytest.mark.parametrize("count", [1, 2, 7, 300])
def test_range_number(spark, count):
    firsts = sorted(random.Random(count).sample(range(10_000), count))
    frame = spark.range(0, 10_000, 37)
    number = fingerprint.range_number(F.col("id"), firsts)
    for row in frame.select("id", number.alias("n")).collect():
        assert row["n"] == max(sum(f <= row["id"] for f in firsts) - 1, 0)


def _groups(items, linked):
    root = {x: x for x in items}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(items):
        for b in items[:i]:
            if linked(a, b):
                root[find(a)] = find(b)
    return {x: find(x) for x in items}


def _expected(rows):
    fps = []
    for i, text, *_ in rows:
        fps.append((i, simhash.fingerprint(simhash.shingles((text or "").encode()))))
    groups = _groups(sorted({f for _, f in fps}), lambda a, b: (a ^ b).bit_count() <= 3)
    least = {}
    for i, f in fps:
        if i is not None:
            least[groups[f]] = min(least.get(groups[f], i), i)
    return sorted((str(i), f"{f:016x}", least.get(groups[f])) for i, f in fps)


def test_near_duplicates_against_all_pairs(docs, odd, empty, rows):
    for frame, given in ((docs, rows), (odd, with_odd_rows(rows))):
        found = simhash.near_duplicates(frame).collect()
        tidy = sorted((str(r[0]), r["fingerprint"], r["component_id"]) for r in found)
        assert tidy == _expected(given)
    assert simhash.near_duplicates(empty).count() == 0


def _flip(rng, value, n):
    for bit in rng.sample(range(64), n):
        value ^= 1 << bit
    return value


@pytest.mark.parametrize("small", [16, simhash.SMALL])
def test_links_join_what_chains_join(spark, monkeypatch, small):
    """Clusters of 2 to 80 fingerprints; the larger ones go by whole balls, or all
    are compared where they meet."""
    monkeypatch.setattr(simhash, "SMALL", small)
    rng = random.Random(5)
    fps = set()
    for size in (1, 1, 1, 2, 3, 5, 17, 40, 60):
        centre = rng.getrandbits(64)
        chain = [centre]
        for _ in range(size):
            chain.append(_flip(rng, rng.choice(chain), rng.choice([1, 2, 3, 4])))
        fps |= set(chain)
    hub = rng.getrandbits(64)
    fps |= {_flip(rng, hub, rng.choice([1, 2, 3])) for _ in range(80)}
    # a dense group whose members differ in the first block only, by many bits
    fps |= {(hub >> 21 << 21) ^ rng.getrandbits(21) for _ in range(40)}
    signed = [(f - (1 << 64) if f >> 63 else f,) for f in fps]
    frame = spark.createDataFrame(signed, "fp long").repartition(3)
    edges = simhash.links(frame)
    got = {r["node"]: r["root"] for r in components.components(edges).collect()}
    for r in edges.collect():
        assert 0 < ((r["a"] ^ r["b"]) & (2**64 - 1)).bit_count() <= 3
    want = _groups(sorted(f for (f,) in signed),
                   lambda a, b: ((a ^ b) & (2**64 - 1)).bit_count() <= 3)
    by_root = {}
    for f, r in want.items():
        by_root.setdefault(r, set()).add(f)
    have = {}
    for (f,) in signed:
        have.setdefault(got.get(f, f), set()).add(f)
    assert sorted(map(sorted, have.values())) == sorted(map(sorted, by_root.values()))


def test_components(spark):
    rng = random.Random(9)
    nodes = list(range(200))
    pairs = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    pairs += [(rng.choice(nodes[140:]), rng.choice(nodes[140:])) for _ in range(30)]
    pairs += pairs[:5] + [(7, 7)]
    rng.shuffle(pairs)
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(frame).collect()}
    linked = {frozenset(p) for p in pairs}
    want = _groups(nodes, lambda a, b: frozenset((a, b)) in linked)
    least = {}
    for n in nodes:
        least[want[n]] = min(least.get(want[n], n), n)
    assert all(got.get(n, n) == least[want[n]] for n in nodes)
    none = spark.createDataFrame([], "a long, b long")
    assert components.components(none).count() == 0
