from __future__ import annotations

import random
from itertools import combinations

import numpy as np
from llm_data import SCHEMA, with_odd_rows

import corpus_pipeline
from clickloom.llm import minhash


def plain(rows):
    """The least id of each row's component, from all pairs."""
    rows = [r for r in rows if r[0] is not None]
    sets = []
    for _, text, *_ in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
        sets.append(grams or {tuple(words)})
    root = list(range(len(rows)))

    def up(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            root[up(j)] = up(i)
    least = {}
    for i, row in enumerate(rows):
        least[up(i)] = min(least.get(up(i), row[0]), row[0])
    return sorted((row[0], least[up(i)]) for i, row in enumerate(rows))


def got(frame):
    return sorted(tuple(r) for r in minhash.near_duplicates(frame).collect())


def edited(rng, words, changes):
    words = list(words)
    for k in range(changes):
        at = (k + 1) * len(words) // (changes + 1)
        words[at] = f"new{rng.random()}"
    return " ".join(words)


def test_similar_texts_are_found_by_the_stage(spark):
    """Copies with 4 of 200 words changed: similarity 0.81, far beyond 3 bits."""
    rng = random.Random(3)
    rows = []
    for i in range(40):
        words = [f"w{rng.randrange(5000)}" for _ in range(200)]
        rows += [(2 * i, " ".join(words)), (2 * i + 1, edited(rng, words, 4))]
        rows.append((1000 + i, edited(rng, words, 6)))  # similarity 0.73 at most
    rows = [(i, t, "en", "s", len(t)) for i, t in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, "").collect()
    want = sorted({least for _, least in plain(rows)})
    assert sorted(r["doc_id"] for r in kept) == want
    assert len(want) == 80


def test_against_all_pairs(spark, docs, odd, empty, rows):
    assert got(docs) == plain(rows)
    assert got(odd) == plain(with_odd_rows(rows))
    assert got(empty) == []


def test_a_large_group(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(150)]
    rows = [(i, edited(rng, words, 1 + i % 2), "en", "s", 0) for i in range(300)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(frame) == plain(rows) == [(i, 0) for i in range(300)]


def test_templates_in_large_keys(spark):
    """Pages of one template (200 words, 160 shared, similarity 0.65) and an edited
    copy of each: keys of hundreds of sets in which only few pairs are links."""
    rng = random.Random(8)
    shared = [f"t{i}" for i in range(160)]
    rows = []
    for i in range(200):
        words = shared + [f"own{i}-{k}" for k in range(40)]
        copy = list(words)
        copy[170 + i % 30] = "edit"
        rows += [(i, " ".join(words)), (1000 + i, " ".join(copy))]
    # a chain of weak links: neighbours alike, ends far apart
    chain = [f"c{k}" for k in range(120)]
    for i in range(30):
        chain[4 * i] = f"link{i}"
        rows.append((5000 - i, " ".join(chain)))
    rows = [(i, t, "en", "s", 0) for i, t in rows]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    nodes = minhash.nodes_of(
        frame.selectExpr("doc_id", "cast(text as binary) AS text", "0L AS mark"), 5
    )
    assert minhash.large_key_nodes(nodes).count() > 300
    want = plain(rows)
    assert got(frame) == want
    assert len({c for _, c in want}) == 201


def test_rows_that_share_an_id(spark):
    """One row per component stays, whatever ids its rows share."""
    words = [f"w{i}" for i in range(60)]
    near = words[:59] + ["x"]
    other, third = ([f"{c}{i}" for i in range(60)] for c in "ab")
    rows = [(5, words), (5, near), (5, other), (3, third), (5, third), (5, words), (7, other)]
    rows = [(i, " ".join(t), "en", f"s{k}", k) for k, (i, t) in enumerate(rows)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, "").collect()
    found = sorted((r["doc_id"], r["text"][:2]) for r in kept)
    assert found == [(3, "b0"), (5, "a0"), (5, "w0")]


def test_parities_never_differ_more_than_the_sets():
    rng = random.Random(4)
    for size in (1, 30, 400, 3000):
        for change in (0, 1, 20, size // 2):
            one = {rng.randrange(1 << 64) for _ in range(size)}
            two = set(list(one)[change:]) | {rng.randrange(1 << 64) for _ in range(change)}
            bits = [minhash.parities(np.array(sorted(s), np.uint64)) for s in (one, two)]
            apart = (int.from_bytes(bits[0]) ^ int.from_bytes(bits[1])).bit_count()
            assert apart <= len(one ^ two)
            assert change > 20 or apart >= 0.8 * len(one ^ two) - 3
