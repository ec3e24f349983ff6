"""Two tokenizers' ids of the same texts, aligned by byte offsets.

Texts are shuffled whole, so each distinct one is encoded and aligned once,
however many documents carry it; its counts weigh as often as it occurs. The
measures go back to the documents by the digest of the text.

A linked pair of ids ends at the same byte, so of its two tokens one is a suffix
of the other. The number of different pairs is therefore bounded by the two
vocabularies (the sum of all token lengths), whatever the corpus: that is what
makes the table of pair counts small enough to send to every task.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickloom.llm.common import keyed_texts, map_batches
from clickloom.operators.lookup import left_lookup
from clickloom.session import cut_lineage

#: Ids of the second vocabulary fit below this in a pair's code.
SECOND = 1 << 24
ROWS_PER_SALT = 2_000
#: Longer runs of blanks go to the vocabulary's own library.
LONG_TEXT = 200_000

ALIGNED = (
    "text_key string, copies bigint, n_a bigint, n_b bigint, n_groups bigint, "
    "groups_sha256 string, codes array<bigint>, times array<int>"
)
MEASURES = (
    "text_key string, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
    "n_best bigint, count_sum bigint, groups_sha256 string"
)


def byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes
    stand for themselves, the others follow from code point 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class ByteVocabulary:
    """First tokenizer: a byte-level BPE file; ids and the bytes of each id.

    Where the file's merges make ids in rank order, the encoder is the rank
    library's, five times as fast; else, and for very long texts, the file's own.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, encoding="utf-8") as file:
            text = file.read()
        model = json.loads(text)["model"]
        letters = byte_letters()
        spelled = {
            token: bytes(letters[c] for c in token)
            for token in model["vocab"]
            if all(c in letters for c in token)
        }
        self.bytes = [b""] * (max(model["vocab"].values()) + 1)
        for token, number in model["vocab"].items():
            self.bytes[number] = spelled.get(token, token.encode())
        self.own = Tokenizer.from_str(text)
        self.own.encode_special_tokens = True
        added = {t["content"] for t in json.loads(text).get("added_tokens", [])}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        made = [model["vocab"][a + b] for a, b in merges]
        singles = sum(len(b) == 1 for b in spelled.values())
        self.fast = None
        if made == list(range(singles, singles + len(made))):
            ranks = {b: model["vocab"][t] for t, b in spelled.items() if t not in added}
            self.fast = tiktoken.Encoding(
                "pairs", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}
            )

    def encode(self, text: str) -> list[int]:
        if self.fast is None or len(text) > LONG_TEXT:
            return self.own.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


class PieceVocabulary:
    """Second tokenizer: a piece model; ids and the bytes of each id."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes = []
        for number in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(number)
            byte = self.model.is_byte(number)
            self.bytes.append(
                bytes([int(piece[3:5], 16)]) if byte
                else piece.replace("▁", " ").encode()
            )

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


class Aligner:
    """Both vocabularies with the tables that alignment looks up."""

    def __init__(self, byte_path: str, pattern: str, piece_path: str):
        self.a = ByteVocabulary(byte_path, pattern)
        self.b = PieceVocabulary(piece_path)
        self.len_a = np.array([len(x) for x in self.a.bytes])
        self.len_b = np.array([len(x) for x in self.b.bytes])
        numbers_a = [str(i) for i in range(len(self.a.bytes))]
        numbers_b = [str(i) for i in range(len(self.b.bytes))]
        #: A inside a group, A at its end, B inside, B at its end.
        self.words = [
            *(n + "," for n in numbers_a), *(n + "|" for n in numbers_a),
            *(n + "," for n in numbers_b), *(n + ";" for n in numbers_b),
        ]

    def pair_bound(self) -> int:
        """No corpus has more different pairs than this."""
        return int(self.len_a.sum() + self.len_b.sum()) * 2

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both sides; none if either does not spell space + text."""
        whole = " " + text
        a, b = self.a.encode(whole), self.b.encode(text)
        want, none = whole.encode(), np.zeros(0, dtype=np.int64)
        if (
            not text
            or b"".join(map(self.a.bytes.__getitem__, a)) != want
            or b"".join(map(self.b.bytes.__getitem__, b)) != want
        ):
            return none, none
        return np.array(a, dtype=np.int64), np.array(b, dtype=np.int64)

    def align(
        self, a: np.ndarray, b: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, str]:
        """Places in ``a`` and in ``b`` of the last token of each group, and the
        groups as text."""
        if not len(a):
            return a, b, ""
        end_a, end_b = np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b])
        at_a = np.searchsorted(end_a, end_b)
        both = end_a[np.minimum(at_a, len(a) - 1)] == end_b
        last_a, last_b = at_a[both], np.flatnonzero(both)
        closes_a = np.zeros(len(a), dtype=np.int64)
        closes_b = np.zeros(len(b), dtype=np.int64)
        closes_a[last_a], closes_b[last_b] = 1, 1
        # A token stands after all A tokens before it and the B tokens of the
        # groups before its own; a B token after its own group's A tokens too.
        ends_b, ends_a = np.append(0, last_b + 1), last_a + 1
        group_a = np.cumsum(closes_a) - closes_a
        group_b = np.cumsum(closes_b) - closes_b
        word = np.empty(len(a) + len(b), dtype=np.int64)
        size_a, size_b = len(self.len_a), len(self.len_b)
        word[np.arange(len(a)) + ends_b[group_a]] = a + size_a * closes_a
        word[np.arange(len(b)) + ends_a[group_b]] = 2 * size_a + b + size_b * closes_b
        text = "".join(map(self.words.__getitem__, word.tolist()))
        return last_a, last_b, text[:-1]


@lru_cache(maxsize=2)
def aligner(byte_path: str, pattern: str, piece_path: str) -> Aligner:
    return Aligner(byte_path, pattern, piece_path)


def distinct_texts(docs: DataFrame) -> DataFrame:
    """(text, copies) of the texts that are not empty, shuffled by the text."""
    texts = keyed_texts(docs).filter("text <> ''").select("text")
    return texts.groupBy("text").agg(F.count(F.lit(1)).alias("copies"))


def align_texts(
    texts: DataFrame, byte_path: str, pattern: str, piece_path: str
) -> DataFrame:
    """Counts, groups and linked pairs (codes with their times) of each text."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = aligner(byte_path, pattern, piece_path)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                a, b = tool.tokens(text)
                last_a, last_b, groups = tool.align(a, b)
                codes, times = np.unique(
                    a[last_a] * SECOND + b[last_b], return_counts=True
                )
                digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
                rows.append((len(a), len(b), len(last_a), digest, codes, times))
            if not rows:
                continue
            n_a, n_b, n_groups, digests, codes, times = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(2),
                    pa.array(n_a, pa.int64()), pa.array(n_b, pa.int64()),
                    pa.array(n_groups, pa.int64()), pa.array(digests, pa.string()),
                    pa.array(codes, pa.list_(pa.int64())),
                    pa.array(times, pa.list_(pa.int32())),
                ],
                names=[c.split()[0] for c in ALIGNED.split(", ")],
            )

    keyed = texts.select(F.sha2("text", 256).alias("text_key"), "text", "copies")
    return map_batches(keyed, task, ALIGNED)


def _flat(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row number, code and times of every pair of a batch."""
    names = batch.schema.get_field_index
    codes, times = batch.column(names("codes")), batch.column(names("times"))
    sizes = codes.value_lengths().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(batch.num_rows), sizes)
    return row, codes.flatten().to_numpy(), times.flatten().to_numpy()


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(code, links) over all documents: each text's pairs times its copies."""
    schema = "code bigint, links bigint"

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            row, codes, times = _flat(batch)
            copies = batch.column(0).to_numpy()
            known, place = np.unique(np.append(known, codes), return_inverse=True)
            weights = np.append(total, times * copies[row])
            total = np.zeros(len(known), np.int64)
            np.add.at(total, place, weights)
        yield pa.RecordBatch.from_arrays(
            [pa.array(known), pa.array(total)], names=["code", "links"]
        )

    pairs = map_batches(aligned.select("copies", "codes", "times"), task, schema)
    return pairs.groupBy("code").agg(F.sum("links").alias("links"))


def measure(aligned: DataFrame, counts: DataFrame) -> DataFrame:
    """Measures of each text, its pairs looked up in the corpus-wide counts."""
    table = counts.toArrow()
    codes, links = table["code"].to_numpy(), table["links"].to_numpy()
    order = np.argsort(codes)
    codes, links = codes[order], links[order]
    second = codes % SECOND
    best = np.zeros(int(second.max(initial=-1)) + 1, dtype=np.int64)
    np.maximum.at(best, second, links)
    sent = aligned.sparkSession.sparkContext.broadcast(
        (codes, links, links == best[second])
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, links, is_best = sent.value
        for batch in batches:
            row, found, times = _flat(batch)
            place = np.searchsorted(codes, found)
            sums = np.zeros((3, batch.num_rows), dtype=np.int64)
            for line, weight in enumerate(
                (times, times * is_best[place], times * links[place])
            ):
                np.add.at(sums[line], row, weight)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns |= dict(
                zip(("n_links", "n_best", "count_sum"), map(pa.array, sums), strict=True)
            )
            names = [c.split()[0] for c in MEASURES.split(", ")]
            yield pa.RecordBatch.from_arrays([columns[c] for c in names], names=names)

    return map_batches(aligned, task, MEASURES)


def align_documents(
    docs: DataFrame, byte_path: str, pattern: str, piece_path: str
) -> DataFrame:
    """One row per document: sizes, groups and how common its linked pairs are.

    Null and empty texts, and texts that one of the tokenizers does not spell
    exactly, have zeros and an empty digest. Repeated and null ids keep their
    rows; other columns are not looked at. Only the table of pair counts, which
    the vocabularies bound, passes the driver.
    """
    texts = distinct_texts(docs)
    aligned = cut_lineage(align_texts(texts, byte_path, pattern, piece_path))
    measures = measure(aligned, pair_counts(aligned))
    keys = keyed_texts(docs).select("doc_id", F.sha2("text", 256).alias("text_key"))
    joined = left_lookup(
        keys, measures, ["text_key"], small=False, rows_per_salt=ROWS_PER_SALT
    )
    numbers = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
    return joined.select(
        "doc_id",
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
