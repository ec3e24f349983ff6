from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_data import SCHEMA, with_odd_rows

from clickloom.llm import lm


def plain(rows):
    split = []
    for i, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        held = zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False
        split.append((i, held, [*re.findall(r"[^\x20\x09-\x0D]+", low), None]))
    counts = Counter(w for _, held, words in split if not held for w in words)
    n, v = sum(counts.values()), len(counts)
    out = []
    for i, held, words in split:
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words)
        out.append((str(i), held, len(words), sum(counts[w] > 0 for w in words), n, base))
    return sorted(out)


@pytest.mark.parametrize("known", [5, 200_000])
def test_base_against_plain_rules(docs, odd, empty, rows, known, monkeypatch):
    monkeypatch.setattr(lm, "KNOWN_WORDS", known)
    for frame, given in ((docs, rows), (odd, with_odd_rows(rows))):
        found = sorted((str(r[0]), *r[1:6], r[6]) for r in lm.score_documents(frame).collect())
        want = plain(given)
        assert [f[:5] for f in found] == [w[:5] for w in want]
        assert np.allclose([f[5] for f in found], [w[5] for w in want], rtol=1e-9)
        assert all(np.isfinite(f[6]) and f[6] < 0 for f in found)
    if known == 5:
        assert lm.score_documents(empty).count() == 0


def test_probabilities_add_up_and_beat_the_base_on_held_out_rows(spark):
    rng = random.Random(6)
    follow = {a: rng.sample(range(40), 3) for a in range(40)}
    rows = []
    for i in range(1200):
        at, words = rng.randrange(40), []
        for _ in range(60):
            at = rng.choice(follow[at])
            words.append(f"t{at}")
        rows.append((i, " ".join(words), "", "", 0))
    docs = lm.prepared(spark.createDataFrame(rows, SCHEMA).repartition(4))
    texts = lm.training(docs)
    counts = lm.word_counts(texts).cache()
    of = lm.vocabulary(counts)
    model = lm.train(texts, of)
    a, b, z = model.log_tables()
    for u, v in ((0, 1), (5, 5), (700, 900)):
        assert abs(np.exp(a[u] + b[v] - z[u, v]).sum() - 1) < 1e-4
    # within a bucket: the words' shares and the unseen one's add up to one
    inside = np.zeros(lm.BUCKETS)
    for word, n in of.known.items():
        if word not in of.classes:
            inside[lm.tail_bucket(word)] += n + 1
    assert np.allclose(inside + 1, of.bucket_tokens + of.bucket_words + 1)
    found = lm.score_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    held = [r for r in found if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in held) / sum(r["n_tokens"] for r in held)
    assert gain > 0.2


def test_contexts():
    ids = np.array([9, 1, 2, 9, 9, 3, 9])  # 9 is the end; two texts of 3 and 2 tokens
    u, v, w = lm.contexts(ids, [3, 2], 9)
    assert w.tolist() == [1, 2, 9, 3, 9]
    assert u.tolist() == [9, 1, 2, 9, 3]
    assert v.tolist() == [9, 9, 1, 9, 9]


def test_tokens_are_those_of_plain_rules():
    texts = ["", "  A b\tB\u00a0\u00c4 ", "\n", "a\x0b\x0ca\x1fa", "b a \u2003"]
    codes, distinct, sizes = lm.tokens(pa.array([t.encode() for t in texts], pa.binary()))
    want = [[*t.encode().lower().split(), lm.END] for t in texts]
    assert [distinct[c] for c in codes] == [w for words in want for w in words]
    assert sizes.tolist() == [len(words) for words in want]
    codes, distinct, sizes = lm.tokens(pa.array([], pa.binary()))
    assert len(codes) == len(sizes) == 0


def test_a_step_is_that_of_plain_loops():
    """Slopes of the noise-contrastive loss, added up token by token."""
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 1000, lm.WORDS + lm.BUCKETS)
    model = lm.Model(counts)
    model.flat += rng.normal(0, 0.1, model.flat.shape).astype(np.float32)
    u, v, w = rng.integers(0, 40, (3, 50))
    u1, u2, r, b = (p.astype(float) for p in (model.u1, model.u2, model.r, model.b))
    trainer = lm.Trainer(model, 5)
    drawn = np.searchsorted(np.cumsum(model.noise), np.random.default_rng(5).random(lm.NOISE))
    slopes = [np.zeros(p.shape) for p in (u1, u2, r, b)]
    for x, y, true in zip(u, v, w):
        q = u1[x] + u2[y]
        for z, label in [(true, 1), *((n, 0) for n in drawn)]:
            score = q @ r[z] + b[z] - math.log(lm.NOISE * model.noise[z])
            g = (1 / (1 + math.exp(-score)) - label) / len(u) ** 0.5
            slopes[0][x] += g * r[z]
            slopes[1][y] += g * r[z]
            slopes[2][z] += g * q
            slopes[3][z] += g
    trainer.step(u, v, w)
    for p, old, g in zip((model.u1, model.u2, model.r, model.b), (u1, u2, r, b), slopes):
        assert np.allclose(p, old - lm.RATE * g / np.sqrt(0.1 + g * g), atol=1e-4)


def test_words_are_looked_up_once_a_batch():
    """Not once a token: texts repeat their words."""
    text = b" ".join([b"one", b"two"] * 5000)
    codes, distinct, sizes = lm.tokens(pa.array([text] * 3, pa.binary()))
    assert sorted(distinct) == sorted([b"one", b"two", lm.END])
    assert len(codes) == sizes.sum() == 3 * 10_001
