from __future__ import annotations

import hashlib
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from llm_data import SCHEMA, with_odd_rows
from tokenizers import Tokenizer

from clickloom.llm import alignment

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
FILES = (BYTES, public_tokenizers.PATTERN, PIECES)
NUMBERS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
ODD = [
    "<|endoftext|> and </s> <s> <unk> <0x41>", "▁ under", "tab\tand\n\nline", " lead", "trail ", "a  b   c",
    "ﬁ ½ ² Ⅷ", "日本語 ภาษา", "𝄞 emoji 👩‍👩‍👧", "\x00nul\x7f", "é é", "  　 x", "​", "�",
    "don't we'LL", "x" * 5000, "\x85  \x1c\x1d",
]


@pytest.fixture(scope="module")
def tools():
    own = Tokenizer.from_file(BYTES)
    own.encode_special_tokens = True
    letters = alignment.byte_letters()
    vocab = {i: bytes(letters[c] for c in t) for t, i in own.get_vocab().items() if t != "<|endoftext|>"}
    return own, vocab, sentencepiece.SentencePieceProcessor(model_file=PIECES)


def tokens(tools, text):
    own, vocab, pieces = tools
    want = " " + (text or "")
    if not text:
        return [], []
    a = [(i, vocab[i]) for i in own.encode(want, add_special_tokens=False).ids]
    b = []
    for i in pieces.encode(text):
        piece = pieces.id_to_piece(i)
        whole = bytes.fromhex(piece[3:5]) if pieces.is_byte(i) else piece.replace("▁", " ").encode()
        b.append((i, whole))
    whole = want.encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []
    return a, b


def ends(side):
    at, out = 0, {}
    for i, raw in side:
        at += len(raw)
        out[at] = i
    return out


def plain(tools, rows):
    """Groups by sets of offsets, links counted over every document."""
    parts, links = [], Counter()
    for i, text, *_ in rows:
        a, b = tokens(tools, text)
        by_a, by_b = ends(a), ends(b)
        pairs = [(by_a[e], by_b[e]) for e in by_a if e in by_b]
        groups, at = [], 0
        for end in sorted(e for e in by_a if e in by_b):
            ids = [",".join(str(s[e]) for e in sorted(s) if at < e <= end) for s in (by_a, by_b)]
            groups.append("|".join(ids))
            at = end
        parts.append((i, len(a), len(b), groups, pairs))
        links.update(pairs)
    best = {}
    for (_, b), n in links.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for i, n_a, n_b, groups, pairs in parts:
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        n_best = sum(links[p] == best[p[1]] for p in pairs)
        out.append((i, n_a, n_b, len(groups), len(pairs), n_best, sum(links[p] for p in pairs), sha))
    return sorted(out, key=str)


def got(frame):
    return sorted(
        ((r["doc_id"], *(r[n] for n in NUMBERS), r["groups_sha256"]) for r in frame.collect()), key=str
    )


def test_against_plain_rules(spark, odd, rows, tools):
    assert got(alignment.align_documents(odd, *FILES)) == plain(tools, with_odd_rows(rows))


@pytest.mark.parametrize("salt", [2, 2_000])
def test_odd_texts_and_hot_copies(spark, tools, salt, monkeypatch):
    monkeypatch.setattr(alignment, "ROWS_PER_SALT", salt)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(ODD)]
    rows += [(100 + i, "one text of a third of the rows", "en", "s", 0) for i in range(12)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = got(alignment.align_documents(frame, *FILES))
    assert found == plain(tools, rows)
    zeros = {r[0] for r in found if r[1] == 0}
    assert 1 in zeros and 0 not in zeros


def test_empty_table(spark, empty):
    assert alignment.align_documents(empty, *FILES).collect() == []


def test_both_encoders_agree_on_every_letter():
    """The rank library cuts texts as the vocabulary's own library does."""
    vocabulary = alignment.ByteVocabulary(BYTES, public_tokenizers.PATTERN)
    assert vocabulary.fast is not None
    letters = [chr(c) for c in range(0x30000) if not 0xD800 <= c < 0xE000]
    letters += [chr(c) for c in (0xE0001, 0xE0100, 0xF0000, 0x10FFFF)]
    for at in range(0, len(letters), 4096):
        text = "".join(f" a{c}1{c} {c}{c}.{c}" for c in letters[at : at + 4096])
        own = vocabulary.own.encode(text, add_special_tokens=False).ids
        assert vocabulary.fast.encode_ordinary(text) == own


def test_pairs_stay_below_their_bound(spark, docs):
    tool = alignment.aligner(*FILES)
    texts = alignment.align_texts(alignment.distinct_texts(docs), *FILES)
    counts = alignment.pair_counts(texts).collect()
    assert 0 < len(counts) < tool.pair_bound() < 2_000_000
    for r in counts:
        a, b = divmod(r["code"], alignment.SECOND)
        a, b = tool.a.bytes[a], tool.b.bytes[b]
        assert a.endswith(b) or b.endswith(a)
