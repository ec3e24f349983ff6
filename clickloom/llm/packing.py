"""Token sequences of a fixed length by minimum bin slack.

Each task tokenises its documents, cuts full windows from long ones and packs
the rests. A window starts with the longest rest; a subset-sum bitset over the
multiset of remaining lengths finds the fill closest to capacity, and walking
the bitsets back gives how many pieces of each length to take.
"""

from __future__ import annotations

import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from clickloom.llm.common import Memo, keyed_texts, map_batches

CAPACITY = 2048
END_ID = 1
GROUP_TOKENS = 4 << 20
MEMO_WORDS = 300_000
SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long"
)
_TAIL = ".,:;!?%$&*#|"
_LATIN = "\u024f"


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokenizer:
    """Ids of a vocabulary file whose pattern never crosses white space.

    The special tokens' strings in a text are special, as in the library's own
    call. Words between ASCII blanks are encoded once and remembered. Of a word of
    Latin letters with punctuation behind, both parts are looked up apart: the
    vocabulary's pattern parts them, and such letters are their own normal form
    but for case.
    """

    def __init__(self, path: str, memo: int = MEMO_WORDS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model, self.letters = self.tokenizer.model, byte_letters()
        self.memo, self.parts = Memo(memo), Memo(memo)

    def _slow(self, word: str) -> bytes:
        found = self.tokenizer.encode(word, add_special_tokens=False)
        return array("I", found.ids).tobytes()

    def _latin(self, core: str) -> bytes:
        letters = core.encode().decode("latin1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _part(self, part: str, make) -> bytes:
        found = self.parts.young.get(part) or self.parts.old.get(part)
        if found is None:
            found = make(part)
            self.parts.put(part, found)
        return found

    def _word(self, word: str) -> bytes:
        core = word.rstrip(_TAIL)
        lower = core.lower()
        if not core or max(core) > _LATIN or not (core.isalpha() and lower.isalpha()):
            return self._slow(word)
        packed = self._part(lower, self._latin)
        if len(core) < len(word):
            packed += self._part(word[len(core) :], self._slow)
        return packed

    def forget(self) -> None:
        """Drop the words looked up so far."""
        for memo in (self.memo, self.parts):
            memo.young, memo.old = {}, {}

    def encode(self, texts: pa.Array | list[str]) -> list[np.ndarray]:
        """Ids of each text: its words are numbered, each different word is
        looked up once, and the ids are gathered by place."""
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.string())
        split = pc.ascii_split_whitespace(texts)
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if not words:
            return [np.zeros(0, "<u4")] * len(texts)
        known, unknown = self.memo.find(words)
        for word in unknown:
            known[word] = packed = self._word(word) if word else b""
            self.memo.put(word, packed)
        packed = [known[word] for word in words]
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        starts = np.cumsum(sizes) - sizes
        ids = np.frombuffer(b"".join(packed), "<u4")
        number = coded.indices.to_numpy()
        taken = sizes[number]
        ends = np.cumsum(taken)
        shift = starts[number] - (ends - taken)
        whole = ids[np.repeat(shift, taken) + np.arange(ends[-1])]
        offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
        bounds = np.r_[0, ends][offsets]
        return [whole[i:j] for i, j in zip(bounds[:-1], bounds[1:])]


_TOKENIZERS: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    """One per Python worker."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def closest_fill(counts: dict[int, int], order: list[int], room: int) -> dict[int, int]:
    """How many pieces of each length fill ``room`` best; order is ascending.

    Bit s of a bitset is set when some of the pieces seen so far sum to s. The
    search ends as soon as ``room`` itself is reached. Multiplicities enter in
    powers of two.
    """
    reached, mask, steps = 1, (1 << (room + 1)) - 1, []
    for length in reversed(order[: bisect_left(order, room + 1)]):
        left, power = min(counts[length], room // length), 1
        while left:
            take = min(power, left)
            steps.append((length, take, reached))
            reached |= (reached << (take * length)) & mask
            left, power = left - take, power * 2
        if reached >> room:
            break
    fill, chosen = reached.bit_length() - 1, {}
    for length, take, before in reversed(steps):
        if not before >> fill & 1:
            chosen[length] = chosen.get(length, 0) + take
            fill -= take * length
    return chosen


class Packer:
    """Sequences of one task; ``rows`` holds what is ready to be returned."""

    def __init__(self, capacity: int, first_id: int):
        self.capacity, self.next_id = capacity, first_id
        self.rows: list[tuple] = []
        self.rests: dict[int, list[tuple]] = {}
        self.held = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.capacity:
            piece = (doc_id, start, ids[start : start + self.capacity], total)
            self._sequence([piece])
            start += self.capacity
        if start < total:
            piece = (doc_id, start, ids[start:], total)
            self.rests.setdefault(total - start, []).append(piece)
            self.held += total - start

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc_id, start, ids, total in pieces:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
            row = (doc_id, start, len(ids), crc, total, self.next_id, offset)
            self.rows.append(row)
            offset += len(ids)
        self.next_id += 1

    def flush(self) -> None:
        """Pack all rests; the last tokens go out in powers of two, unpadded."""
        rests, order = self.rests, sorted(self.rests)
        counts = {length: len(found) for length, found in rests.items()}

        def take(length: int) -> tuple:
            counts[length] -= 1
            if not counts[length]:
                del counts[length]
                order.pop(bisect_left(order, length))
            return rests[length].pop()

        while order and self.held >= self.capacity:
            window = [take(order[-1])]
            room = self.capacity - len(window[0][2])
            for length, n in closest_fill(counts, order, room).items():
                window += [take(length) for _ in range(n)]
                room -= n * length
            if room:  # what is left of the tokens is longer than the room
                doc_id, start, ids, total = take(order[-1])
                window.append((doc_id, start, ids[:room], total))
                rest = (doc_id, start + room, ids[room:], total)
                length = len(rest[2])
                rests.setdefault(length, []).append(rest)
                if length not in counts:
                    insort(order, length)
                counts[length] = counts.get(length, 0) + 1
            self._sequence(window)
            self.held -= self.capacity
        tail = [take(order[-1]) for _ in range(sum(counts.values()))]
        while self.held:
            size, window = 1 << (self.held.bit_length() - 1), []
            self.held -= size
            while size:
                doc_id, start, ids, total = tail.pop()
                window.append((doc_id, start, ids[:size], total))
                if len(ids) > size:
                    tail.append((doc_id, start + size, ids[size:], total))
                size -= len(window[-1][2])
            self._sequence(window)
        self.rests = {}


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: whose ids it holds, and where it lies.

    Nothing is shuffled: a task packs its own split of the table, at most
    ``GROUP_TOKENS`` tokens of rests at a time, and numbers its sequences from
    its partition id. A task that runs again packs the same split alike.

    A null or empty text is the end id alone. Null ids and repeated rows are
    packed like any other row, an empty table gives no rows, and other columns
    are ignored.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tokenizer(vocabulary)
        packer = Packer(capacity, TaskContext.get().partitionId() << 40)
        end = np.array([END_ID], "<u4")

        def ready() -> pa.RecordBatch:
            rows, packer.rows = packer.rows, []
            columns = zip(*rows) if rows else [()] * 7
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), pa.int64()) for c in columns],
                [x.split()[0] for x in SCHEMA.split(", ")],
            )

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for doc_id, found in zip(ids, words.encode(batch.column(1))):
                packer.add(doc_id, np.concatenate([found, end]))
                if packer.held >= GROUP_TOKENS:
                    packer.flush()
            if packer.rows:
                yield ready()
        packer.flush()
        words.forget()  # the worker's next task may be another operator's
        yield ready()

    return map_batches(keyed_texts(docs), task, SCHEMA)
