from __future__ import annotations

import hashlib
import random
from itertools import product

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import with_odd_rows

from clickloom.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN


def library(ranks):
    return tiktoken.Encoding("t", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def reference():
    return library(bpe.load_ranks(PATH))


ENCODER = bpe.TextEncoder(PATH, PATTERN, 50)
TOKENS = {i: t for t, i in bpe.load_ranks(PATH).items()}
LIBRARY = library(bpe.load_ranks(PATH))


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"]), max_size=60))
def test_any_text(text):
    ids = ENCODER.encode([text, "aaaa" + text])
    assert ids[0].tolist() == LIBRARY.encode_ordinary(text)
    assert ids[1].tolist() == LIBRARY.encode_ordinary("aaaa" + text)
    assert bpe.decode(ids[0], TOKENS) == text.encode()


def test_ranks_out_of_order():
    """Vocabularies in which a merge makes a pair of lower rank possible."""
    rng = random.Random(1)
    for _ in range(60):
        tokens = {"".join(t) for n in (2, 3, 4) for t in product("ab", repeat=n)}
        tokens = rng.sample(sorted(tokens), rng.randint(3, 14))
        singles = [bytes([b]) for b in range(256)]
        ranks = {t: i for i, t in enumerate(singles)}
        ranks |= {t.encode(): 256 + i for i, t in enumerate(tokens)}
        library_, replay = library(ranks), bpe.MergeReplay(ranks)
        words = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 30))) for _ in range(40)]
        for word, ids in zip(words, replay.encode([w.encode() for w in words])):
            assert ids == library_.encode_ordinary(word), (word, tokens)


def test_long_word(reference):
    word = "abcab" * 4000
    assert ENCODER.encode([word])[0].tolist() == reference.encode_ordinary(word)


def test_documents(reference, docs, odd, empty, rows):
    for frame, given_ in ((docs, rows), (odd, with_odd_rows(rows))):
        found = sorted((str(r[0]), r[1], r[2], r[3]) for r in bpe.digests(frame, PATH, PATTERN).collect())
        want = []
        for i, text, *_ in given_:
            ids = np.array(reference.encode_ordinary(text or ""), "<u4")
            decoded = hashlib.sha256((text or "").encode()).hexdigest()
            want.append((str(i), len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), decoded))
        assert found == sorted(want)
    assert bpe.digests(empty, PATH, PATTERN).count() == 0
