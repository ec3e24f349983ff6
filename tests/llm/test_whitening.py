from __future__ import annotations

import math
import random

import numpy as np
import pytest

from clickloom.llm import whitening

SCHEMA = "vec_id long, embedding array<float>, n string, component string, whitened string"


def vectors(count=400, size=40, seed=3):
    rng = np.random.default_rng(seed)
    mixed = rng.normal(size=(count, size)) @ rng.normal(size=(size, size)) * 0.3
    return mixed.astype(np.float32).tolist()


def frame_of(spark, rows):
    return spark.createDataFrame([(i, v, "x", "x", "x") for i, v in rows], SCHEMA)


def odd_rows(good):
    size = len(good[0])
    return [
        (900, None), (901, [None] * size), (902, [math.nan] * size), (903, [math.inf] + [0.0] * (size - 1)),
        (904, [1.0] * (size - 1)), (905, []), (906, [2.0**57] + [0.0] * (size - 1)),
    ]


def plain(good, wanted=32):
    xs = [[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for v in good]
    n, size = len(xs), len(xs[0])
    sums = [sum(x[d] for x in xs) for d in range(size)]
    centred = np.array([[x[d] - sums[d] / n for d in range(size)] for x in xs])
    covariance = centred.T @ centred / n
    values, vectors_ = np.linalg.eigh(covariance)
    values, vectors_ = values[::-1][:wanted], vectors_[:, ::-1][:, :wanted]
    deviation = [sum((n * a - s) ** 2 for a, s in zip(x, sums)) for x in xs]
    return n, deviation, centred @ vectors_ / np.sqrt(values), values / np.trace(covariance)


def test_against_plain_rules(spark):
    good = vectors()
    rows = [*enumerate(good), *odd_rows(good), (None, good[0]), (5, good[5])]
    random.Random(1).shuffle(rows)
    frame = frame_of(spark, rows).repartition(5)
    found = whitening.project(frame, whitening.fit(frame)).collect()
    n, deviation, whitened, explained = plain([*good, good[0], good[5]])
    assert len(found) == n * 32 and n == len(good) + 2
    table, seen = np.zeros((len(good), 32)), {}
    for r in found:
        i = 0 if r["vec_id"] is None else r["vec_id"]
        table[i, r["component"] - 1] = r["whitened"]
        assert r["n"] == n and r["deviation"] == deviation[i]
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-9)
        seen[r["vec_id"]] = seen.get(r["vec_id"], 0) + 1
    assert seen[5] == 64 and seen[None] == seen[7] == 32
    signs = np.sign((table * whitened[: len(good)]).sum(axis=0))
    assert np.abs(table * signs - whitened[: len(good)]).max() < 1e-9
    every = np.vstack([table, table[[0, 5]]])
    real = np.abs(np.cov(every.T, bias=True) - np.eye(32)).max()
    assert abs(real - found[0]["identity_error"]) < 1e-12 and real < 1e-10


def test_few_equal_and_no_vectors(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, []), (2, None)]):
        frame = frame_of(spark, rows)
        assert whitening.project(frame, whitening.fit(frame)).collect() == []
    flat = [(i, [float(i % 7), 2.0 * (i % 7), 3.0, float(i % 3)]) for i in range(50)]
    frame = frame_of(spark, flat)
    found = whitening.project(frame, whitening.fit(frame)).collect()
    assert {r["component"] for r in found} == {1, 2}  # rank two
    assert found[0]["identity_error"] < 1e-10


def test_deviation_beyond_a_long(spark):
    rows = [(i, [2.0**50 * (i == 0), float(i)]) for i in range(5)]
    frame = frame_of(spark, rows)
    found = whitening.project(frame, whitening.fit(frame, 1)).collect()
    assert [r["deviation"] for r in found] == [None] * 5
    rows = [(i, [float(2**20 * i), float(i)]) for i in range(5)]
    frame = frame_of(spark, rows)
    found = whitening.project(frame, whitening.fit(frame, 1)).collect()
    want = plain([v for _, v in rows], 1)[1]
    assert {r["vec_id"]: r["deviation"] for r in found} == dict(enumerate(want))


@pytest.mark.parametrize("kind", ["spread", "ties", "cluster", "low_rank", "one_far", "tiny"])
def test_components_against_a_dense_solver(kind):
    rng = np.random.default_rng(7)
    size = 50
    spectrum = {
        "spread": 10.0 ** -np.linspace(0, 8, size),
        "ties": np.repeat([5.0, 3.0, 2.0, 1.0, 0.5], 10),
        "cluster": 1 + 1e-12 * np.arange(size),
        "low_rank": np.r_[np.arange(1.0, 6.0), np.zeros(size - 5)],
        "one_far": np.r_[1e6, 1 + rng.random(size - 1)],
        "tiny": 1e-12 * (1 + rng.random(size)),
    }[kind]
    basis, _ = np.linalg.qr(rng.normal(size=(size, size)))
    matrix = basis * spectrum @ basis.T
    values, vectors_ = whitening.leading_components(matrix, 32)
    want = np.sort(spectrum[spectrum > 0])[::-1][:32]
    top = spectrum.max()
    assert len(values) == len(want)
    assert np.abs(values - want).max() < 1e-13 * top
    assert np.abs(vectors_.T @ vectors_ - np.eye(len(want))).max() < 1e-13
    assert np.abs(matrix @ vectors_ - vectors_ * values).max() < 1e-13 * top


def test_inertia_counts():
    matrix = np.array([[2.0, 1, 0, 0], [1, 2, 0, 0], [0, 0, 5, 2], [0, 0, 2, 5]])
    diagonal, off = whitening.tridiagonal(matrix)
    shifts = np.array([0.0, 2, 4, 6, 8])
    assert whitening.count_below(diagonal, off, shifts).tolist() == [0, 1, 3, 3, 4]
    assert np.allclose(whitening.locate(diagonal, off), [7, 3, 3, 1])
