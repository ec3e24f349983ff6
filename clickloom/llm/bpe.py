"""Byte-level BPE by corpus-level merge replay.

The distinct words of a batch are laid out in one array of tokens. An inverted
index says for each merge where its pair stands; merges are applied in rank
order to every place at once, and only the two neighbours of a merged pair are
looked up again. Texts are then read off word by word.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import Memo, keyed_texts, map_batches

MEMO_WORDS = 150_000
REPLAY_BYTES = 1 << 19
SLICE_ROWS = 250


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


class MergeReplay:
    """Encoder for many words at once; ``ranks`` maps tokens to ids.

    A merge's rank is the id of the merged token. ``pairs`` holds, for two
    neighbouring ids, what they merge to.
    """

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.bytes = [ranks[bytes([b])] for b in range(256)]
        self.pairs: dict[tuple[int, int], int] = {}
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = get(token[:cut]), get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a, b] = rank

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of every word, none of which is merged across its ends.

        A word that is a token is that token, whatever merges would make it.
        """
        whole = [self.ranks.get(word) for word in words]
        rest = [word for word, found in zip(words, whole) if found is None]
        parts = iter(self._replayed(rest))
        return [next(parts) if found is None else [found] for found in whole]

    def _replayed(self, words: list[bytes]) -> list[list[int]]:
        ids: list[int] = []
        after: list[int] = []  # next token's place; -1 at a word's end
        starts, single = [], self.bytes
        for word in words:
            starts.append(len(ids))
            if word:
                after += range(len(ids) + 1, len(ids) + len(word))
                after.append(-1)
                ids += [single[b] for b in word]
        before = list(range(-1, len(ids) - 1))
        for start, word in zip(starts, words):
            if word:
                before[start] = -1
        pairs = self.pairs
        index: dict[int, list[int]] = {}
        rank_at: list[int | None] = [None] * len(ids)
        for at, pair in enumerate(zip(ids, ids[1:])):
            rank = pairs.get(pair)
            if rank is not None and after[at] >= 0:
                rank_at[at] = rank
                index.setdefault(rank, []).append(at)
        ranks = sorted(index)
        while ranks:
            rank = heappop(ranks)
            places = index.pop(rank)
            places.sort()
            for done, at in enumerate(places):
                if rank_at[at] != rank:
                    continue  # one of its tokens went into an earlier merge
                right = after[at]
                beyond = after[right]
                ids[at], after[at] = rank, beyond
                rank_at[right] = rank_at[at] = None
                lower = False
                if beyond >= 0:
                    before[beyond] = at
                    new = pairs.get((rank, ids[beyond]))
                    if new is not None:
                        rank_at[at] = new
                        if new not in index:
                            index[new] = []
                            heappush(ranks, new)
                        index[new].append(at)
                        lower = new < rank
                left = before[at]
                if left >= 0:
                    new = pairs.get((ids[left], rank))
                    rank_at[left] = new
                    if new is not None:
                        if new not in index:
                            index[new] = []
                            heappush(ranks, new)
                        index[new].append(left)
                        lower = lower or new < rank
                if lower and done + 1 < len(places):
                    # a better merge came up: it goes first, then the rest
                    index[rank] = places[done + 1 :]
                    heappush(ranks, rank)
                    break
        out = []
        for start, word in zip(starts, words):
            found, at = [], start if word else -1
            while at >= 0:
                found.append(ids[at])
                at = after[at]
            out.append(found)
        return out


class TextEncoder:
    """Ids of texts: pattern, then the memo of words, then replay of the rest."""

    def __init__(self, path: str, pattern: str, memo: int = MEMO_WORDS):
        self.replay = MergeReplay(load_ranks(path))
        self.pattern = regex.compile(pattern)
        self.memo = Memo(memo)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.pattern.findall(text) for text in texts]
        known, unknown = self.memo.find(set().union(*split))
        at = 0
        while at < len(unknown):
            part, size = [], 0
            while at < len(unknown) and (not part or size < REPLAY_BYTES):
                part.append(unknown[at])
                size += len(unknown[at])
                at += 1
            replayed = self.replay.encode([w.encode() for w in part])
            for word, ids in zip(part, replayed):
                known[word] = packed = np.array(ids, "<u4").tobytes()
                self.memo.put(word, packed)
        get = known.__getitem__
        return [np.frombuffer(b"".join(map(get, s)), "<u4") for s in split]


def decode(ids: np.ndarray, tokens: dict[int, bytes]) -> bytes:
    return b"".join(map(tokens.__getitem__, ids.tolist()))


_ENCODERS: dict[tuple[str, str], TextEncoder] = {}


def encoder(path: str, pattern: str) -> TextEncoder:
    """One per Python worker."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = TextEncoder(path, pattern)
    return _ENCODERS[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the tokens of every whole text, as little-endian uint32.

    A task keeps a bounded memo of words; nothing is shuffled. Null and empty
    texts have no tokens; null ids and repeated rows come back as they are; an
    empty table gives no rows; other columns are ignored.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = encoder(path, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                found = words.encode(part.column(1).to_pylist())
                packed = pa.array([ids.tobytes() for ids in found], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), packed], ["doc_id", "ids"]
                )

    return map_batches(keyed_texts(docs), task, "doc_id long, ids binary")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, decoded): the bytes of every row of ids; null stays null."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = {i: token for token, i in load_ranks(path).items()}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(at, SLICE_ROWS)
                found = [
                    None if ids is None else decode(np.frombuffer(ids, "<u4"), tokens)
                    for ids in part.column(1).to_pylist()
                ]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(found, pa.binary())],
                    ["doc_id", "ids", "decoded"],
                )

    schema = "doc_id long, ids binary, decoded binary"
    return map_batches(encoded.select("doc_id", "ids"), task, schema)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token count, and digests of the ids and of the bytes they decode to."""
    decoded = decode_documents(encode_documents(docs, path, pattern), path)
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length("ids") / 4).alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
