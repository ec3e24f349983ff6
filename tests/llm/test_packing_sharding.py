from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_data import SCHEMA, with_odd_rows
from tokenizers import Tokenizer

from clickloom.llm import packing, sharding

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["don't we'll GO", "İstanbul ΣΑΣ ﬁne", "a\x1cb\u00a0c\u2003d", "e\u0301 é É", "x.,!?y z.. 12,5",
       "<|endoftext|> and <|startoftext|>", "\u0345a ...", "日本語 テキスト", "ſ ß ǅ ŉ", "a'sb 's", "ÄÖ,Ü.", "I\u0307x"]


def direct(text):
    tokenizer = Tokenizer.from_file(PATH)
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_of_odd_texts():
    words = packing.WordTokenizer(PATH, 20)
    for text, ids in zip(ODD, words.encode(ODD)):
        assert ids.tolist() == direct(text), text


TOKENIZER = Tokenizer.from_file(PATH)
WORDS = packing.WordTokenizer(PATH, 50)


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" .,'sStTéÉß1\n\t|#%İ\u0301"), st.characters(exclude_categories=["Cs"])), max_size=40))
def test_ids_of_any_text(text):
    want = TOKENIZER.encode(text, add_special_tokens=False).ids
    assert WORDS.encode([text])[0].tolist() == want


def test_closest_fill_against_all_subsets():
    rng = random.Random(2)
    for _ in range(200):
        lengths = [rng.randint(1, 40) for _ in range(rng.randint(1, 9))]
        room = rng.randint(1, 90)
        counts = {x: lengths.count(x) for x in lengths}
        chosen = packing.closest_fill(counts, sorted(counts), room)
        sums = {0}
        for x in lengths:
            sums |= {s + x for s in sums}
        assert sum(x * n for x, n in chosen.items()) == max(s for s in sums if s <= room)
        assert all(n <= counts[x] for x, n in chosen.items())


def check_packing(found, given):
    want = sorted((str(i), tuple(direct(t or "")) + (1,)) for i, t, *_ in given)
    pieces, rows = {}, [r.asDict() for r in found]
    for r in rows:
        assert r["length"] > 0
        pieces.setdefault((r["sequence_id"]), []).append(r)
    for parts in pieces.values():
        at = 0
        for r in sorted(parts, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= 2048 and at & (at - 1) == 0
    by_doc = {}
    for r in rows:
        by_doc.setdefault(str(r["doc_id"]), []).append(r)
    for doc, ids in want:
        of_doc, ids = by_doc[doc], np.array(ids, "<u4")
        for r in of_doc:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["doc_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(part)
        copies = sum(d == doc for d, _ in want)
        assert sum(r["length"] for r in of_doc) == copies * len(ids)
        assert len({r["start"] for r in of_doc}) * copies >= len(of_doc) / copies
    assert sum(r["length"] for r in rows) == sum(len(ids) for _, ids in want)


def test_packing(docs, odd, empty, rows):
    check_packing(packing.pack(docs, PATH).collect(), rows)
    check_packing(packing.pack(odd, PATH).collect(), with_odd_rows(rows))
    assert packing.pack(empty, PATH).count() == 0


def test_packing_in_small_groups(docs, rows, monkeypatch):
    packer = packing.Packer(64, 7)
    rng = random.Random(1)
    total = 0
    for i in range(400):
        ids = np.arange(rng.choice([1, 2, 30, 63, 64, 65, 300]), dtype="<u4")
        total += len(ids)
        packer.add(i, ids)
        if packer.held > 1000:
            packer.flush()
    packer.flush()
    fill = {}
    for r in packer.rows:
        fill[r[5]] = fill.get(r[5], 0) + r[2]
    assert sum(fill.values()) == total and packer.held == 0
    assert all(n <= 64 and n & (n - 1) == 0 for n in fill.values())


def test_sharding(docs, odd, empty, rows, tmp_path):
    for frame, given in ((docs, rows), (odd, with_odd_rows(rows))):
        found = sharding.shard_documents(frame).collect()
        want = sorted((str(i), len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in given)
        assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in found) == want
        for shard in range(8):
            slots = sorted(r["slot"] for r in found if r["shard"] == shard)
            assert slots == list(range(len(slots)))
    assert sharding.shard_documents(empty).count() == 0


def test_rebalance_moves_few_slots_to_near_equal_shards():
    rng = random.Random(3)
    weights = [rng.randint(0, 1000) for _ in range(4096)]
    first = sharding.first_map()
    edited = sharding.rebalance(first, weights, 8)
    totals = [sum(w for w, s in zip(weights, edited) if s == k) for k in range(8)]
    assert max(totals) - min(totals) <= 20
    assert sum(a != b for a, b in zip(first, edited)) < 200
    grown = sharding.rebalance(edited, weights, 9)
    totals = [sum(w for w, s in zip(weights, grown) if s == k) for k in range(9)]
    assert max(totals) - min(totals) <= 40
    shrunk = sharding.rebalance(grown, weights, 4)
    totals = [sum(w for w, s in zip(weights, shrunk) if s == k) for k in range(4)]
    assert set(shrunk) == {0, 1, 2, 3} and max(totals) - min(totals) <= 20


def test_map_versions(spark, tmp_path):
    folder = str(tmp_path)
    sharding.write_map(spark, folder, 0, [0, 1])
    sharding.write_map(spark, folder, 1, [1, 1])
    assert sorted(map(tuple, sharding.read_map(spark, folder, 0).collect())) == [(0, 0), (1, 1)]
    with pytest.raises(Exception):
        sharding.write_map(spark, folder, 1, [0, 0])


def test_shards_are_near_equal(spark):
    rng = random.Random(8)
    texts = [(i, "x" * rng.choice([10, 100, 1000, 20_000]), "", "", 0) for i in range(3000)]
    found = sharding.shard_documents(spark.createDataFrame(texts, SCHEMA)).collect()
    totals = [sum(r["size"] for r in found if r["shard"] == k) for k in range(8)]
    assert max(totals) - min(totals) < 0.01 * sum(totals) / 8
