"""A log-bilinear language model over word classes.

Output classes are the most frequent words and, for all other words, buckets by
their last bytes; a word's probability is its class's, given the two classes
before, times its smoothed share of the class. With contexts added up,
score(w | u, v) = b[w] + (U1[u] + U2[v]) . R[w], every normaliser is one entry
of a matrix product, so scores are exact log probabilities read from tables.

Training is noise-contrastive estimation over all training documents: each task
walks its split once from common parameters, and the tasks' parameters are
averaged by tokens.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import fold, keyed_texts, map_batches
from clickloom.session import cut_lineage

FOLDS, HELD_OUT = 7, 2
WORDS, BUCKETS, TAIL_BYTES = 768, 256, 3
KNOWN_WORDS = 200_000  # documented bound of the counts sent to every worker
WIDTH = 16
NOISE = 32
BATCH = 2048
ROUNDS = 2
RATE = 0.15
FLUSH_WORDS = 200_000
END = b" "  # no word contains a blank


def tail_bucket(word: bytes) -> int:
    return zlib.crc32(word[-TAIL_BYTES:]) % BUCKETS


def tokens(texts: pa.Array) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    """All tokens of all texts as codes, what the codes stand for, tokens a text."""
    low = pc.ascii_lower(texts.cast(pa.large_binary()).view(pa.large_string()))
    lists = pc.ascii_split_whitespace(low)
    words = lists.flatten()
    full = pc.greater(pc.binary_length(words), 0)  # blanks at either end split off nothing
    owner = np.repeat(np.arange(len(texts)), np.asarray(lists.value_lengths()))
    sizes = np.bincount(owner[np.asarray(full)], minlength=len(texts))
    met = words.filter(full).dictionary_encode()
    spelled = met.dictionary.view(pa.large_binary()).to_numpy(zero_copy_only=False)
    distinct = [*spelled, END]
    codes = np.insert(np.asarray(met.indices), np.cumsum(sizes), len(distinct) - 1)
    return codes, distinct, sizes + 1


def training(docs: DataFrame) -> DataFrame:
    return docs.filter(~F.col("held_out")).select("text")


def prepared(docs: DataFrame) -> DataFrame:
    """(doc_id, text in bytes, held_out)."""
    texts = keyed_texts(docs)
    held = fold(F.col("doc_id"), FOLDS) == HELD_OUT
    return texts.select("doc_id", F.col("text").cast("binary").alias("text"), held.alias("held_out"))


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, bucket, n) over all rows; tasks add up before the shuffle."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            words = list(counts)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(words, pa.binary()),
                    pa.array([tail_bucket(w) for w in words], pa.int32()),
                    pa.array(list(counts.values()), pa.int64()),
                ],
                ["word", "bucket", "n"],
            )

        for batch in batches:
            codes, distinct, _ = tokens(batch.column(0))
            times = np.bincount(codes, minlength=len(distinct)).tolist()
            for word, n in zip(distinct, times):
                counts[word] += n
            if not counts[END]:
                del counts[END]
            if len(counts) >= FLUSH_WORDS:
                yield out()
                counts.clear()
        if counts:
            yield out()

    part = map_batches(texts, task, "word binary, bucket int, n long")
    return part.groupBy("word", "bucket").agg(F.sum("n").alias("n"))


@dataclass
class Vocabulary:
    """Counts of the most frequent words, and what the others add up to."""

    known: dict[bytes, int]
    classes: dict[bytes, int]
    class_counts: np.ndarray
    bucket_tokens: np.ndarray
    bucket_words: np.ndarray
    total: int
    distinct: int

    def class_of(self, word: bytes) -> int:
        found = self.classes.get(word)
        return WORDS + tail_bucket(word) if found is None else found

    @cached_property
    def words(self) -> Numbers:
        """Numbers of the known words and those with a class of their own."""
        return Numbers([*self.known, *(w for w in self.classes if w not in self.known)])

    @cached_property
    def class_by_number(self) -> np.ndarray:
        own = [self.class_of(word) for word in self.words]
        return np.r_[own, WORDS + np.arange(BUCKETS)].astype(np.int16)

    def __getstate__(self) -> dict:
        made = ("words", "class_by_number")  # a worker makes its own, once
        return {k: v for k, v in self.__dict__.items() if k not in made}


class Numbers(dict):
    """A number for every word; words that are not listed share their bucket's."""

    def __init__(self, words: list[bytes]):
        super().__init__(zip(words, range(len(words))))
        self.listed, self.tails = len(words), {}

    def __missing__(self, word: bytes) -> int:
        tail = word[-TAIL_BYTES:]
        found = self.tails.get(tail)
        if found is None:
            if len(self.tails) > 1_000_000:
                self.tails.clear()
            found = self.tails[tail] = self.listed + tail_bucket(word)
        return found


def vocabulary(counts: DataFrame) -> Vocabulary:
    """At most ``KNOWN_WORDS`` words and ``BUCKETS`` sums reach the driver.

    The words are those above a count, found from a histogram of the counts'
    logarithms, so no task sends more than it has to.
    """
    step = F.floor(F.log2("n") * 32).cast("int")
    histogram = counts.groupBy(step.alias("step")).count().collect()
    least, held = None, 0
    for row in sorted(histogram, reverse=True):
        held += row["count"]
        if held > KNOWN_WORDS:
            break
        least = row["step"]
    top = counts.filter(step >= (1 << 20 if least is None else least))
    rows = [(bytes(r["word"]), r["n"]) for r in top.select("word", "n").collect()]
    rows.sort(key=lambda row: (-row[1], row[0]))
    known = dict(rows)
    frequent = [word for word, _ in rows[:WORDS]]
    if END not in frequent:
        frequent = [*frequent[: WORDS - 1], END]
    classes = {word: i for i, word in enumerate(frequent)}
    sums = counts.groupBy("bucket").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("words")
    )
    bucket_tokens, bucket_words = np.zeros((2, BUCKETS), np.int64)
    total = distinct = 0
    for row in sums.collect():
        bucket_tokens[row["bucket"]], bucket_words[row["bucket"]] = row["n"], row["words"]
        total, distinct = total + row["n"], distinct + row["words"]
    class_counts = np.zeros(WORDS + BUCKETS, np.int64)
    for word, i in classes.items():
        n = known.get(word, 0)
        class_counts[i] = n
        if n:
            bucket_tokens[tail_bucket(word)] -= n
            bucket_words[tail_bucket(word)] -= 1
    class_counts[WORDS:] = bucket_tokens
    return Vocabulary(
        known, classes, class_counts, bucket_tokens, bucket_words, total, distinct
    )


class Model:
    """Parameters: context tables U1, U2, targets R and constants b, in one array."""

    def __init__(self, class_counts: np.ndarray, seed: int = 1):
        rng, size = np.random.default_rng(seed), len(class_counts)
        share = (class_counts + 1.0) / (class_counts + 1.0).sum()
        self.noise = share
        self.flat = np.zeros(size * (3 * WIDTH + 1), np.float32)
        tables = self.flat[: 3 * size * WIDTH].reshape(3, size, WIDTH)
        self.u1, self.u2, self.r = tables
        self.b = self.flat[3 * size * WIDTH :]
        self.r[...] = rng.normal(0, 0.3, (size, WIDTH))
        self.b[...] = np.log(share)

    def pack(self) -> np.ndarray:
        return self.flat.copy()

    def unpack(self, flat: np.ndarray) -> None:
        self.flat[...] = flat

    def log_tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A[u, w], B[v, w] and the log normaliser Z[u, v] of exp(A + B)."""
        a = self.u1 @ self.r.T + self.b
        b = self.u2 @ self.r.T
        top_a, top_b = a.max(1, keepdims=True), b.max(1, keepdims=True)
        z = np.exp(a - top_a) @ np.exp(b - top_b).T
        return a, b, np.log(z) + top_a + top_b.T


def _shares(scores: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(score)) in place; a huge score gives 0."""
    with np.errstate(over="ignore"):
        np.exp(scores, out=scores)
    scores += 1
    return np.reciprocal(scores, out=scores)


class Trainer:
    """Noise-contrastive steps with AdaGrad; every batch shares its noise."""

    def __init__(self, model: Model, seed: int):
        self.model, self.rng = model, np.random.default_rng(seed)
        self.below = np.cumsum(model.noise)
        self.log_noise = np.log(NOISE * model.noise).astype(np.float32)
        self.squares = np.full(model.flat.shape, 0.1, np.float32)
        self.cells = np.arange(len(model.b) * WIDTH).reshape(-1, WIDTH)
        self.slope, self.root = np.empty_like(model.flat), np.empty_like(model.flat)

    def step(self, u: np.ndarray, v: np.ndarray, w: np.ndarray) -> None:
        m, size = self.model, len(self.model.b)
        drawn = np.searchsorted(self.below, self.rng.random(NOISE))
        noise = np.minimum(drawn, len(m.noise) - 1)
        offset = m.b - self.log_noise
        q, r_w, r_noise = m.u1.take(u, 0), m.r.take(w, 0), m.r.take(noise, 0)
        q += m.u2.take(v, 0)
        true = np.einsum("ij,ij->i", q, r_w)
        true += offset.take(w)
        false = q @ -r_noise.T
        false -= offset.take(noise)
        # slopes of the loss by score, per token, times the root of the batch
        scale = np.float32(len(u) ** -0.5)
        g_true = _shares(true) * -scale
        g_false = _shares(false)
        g_false *= scale
        g_q = g_false @ r_noise
        r_w *= g_true[:, None]
        g_q += r_w
        r_rows = g_true[:, None] * q
        noise_rows = g_false.T @ q
        tables = self.slope[: 3 * size * WIDTH].reshape(3, size, WIDTH)
        g_q = g_q.astype(np.float64).ravel()
        self._add_rows(tables[0], u, g_q)
        self._add_rows(tables[1], v, g_q)
        self._add_rows(tables[2], np.r_[w, noise], np.r_[r_rows, noise_rows].ravel())
        self.slope[3 * size * WIDTH :] = np.bincount(w, g_true, size) + np.bincount(
            noise, np.ones(len(u), np.float32) @ g_false, size
        )
        g, root = self.slope, self.root
        np.multiply(g, g, out=root)
        self.squares += root
        np.sqrt(self.squares, out=root)
        g *= np.float32(RATE)
        g /= root
        m.flat -= g

    def _add_rows(self, out: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Set ``out`` to the sums of the rows by id."""
        cells = self.cells.take(ids, 0).ravel()
        out[...] = np.bincount(cells, rows, out.size).reshape(out.shape)


def word_numbers(distinct: list[bytes], of: Vocabulary) -> np.ndarray:
    return np.fromiter(map(of.words.__getitem__, distinct), np.int64, len(distinct))


def class_ids(numbers: np.ndarray, sizes: np.ndarray, of: Vocabulary) -> np.ndarray:
    """Classes of all tokens, with the end class before each text."""
    classes = of.class_by_number.take(numbers).astype(np.int64)
    return np.insert(classes, np.cumsum(sizes) - sizes, of.classes[END])


def contexts(ids: np.ndarray, sizes: list[int], end: int) -> tuple:
    """(u, v, w) for every token: the class before, the one before that, its own."""
    starts = np.cumsum([0, *(n + 1 for n in sizes)])[:-1]
    keep = np.ones(len(ids), bool)
    keep[starts] = False
    u = np.r_[end, ids[:-1]]
    v = np.r_[end, end, ids[:-2]]
    v[starts[starts + 1 < len(ids)] + 1] = end
    return u[keep], v[keep], ids[keep]


def train(texts: DataFrame, of: Vocabulary, rounds: int = ROUNDS) -> Model:
    """A model that has seen every row of ``texts`` ``rounds`` times.

    Tasks return parameters (about 200 kB) with the tokens they have seen; they
    are added up in a second small stage, and at most 32 sums reach the driver.
    """
    spark = texts.sparkSession
    model = Model(of.class_counts)
    shared_vocabulary = spark.sparkContext.broadcast(of)
    for number in range(rounds):
        start = model.pack().tobytes()

        def task(batches, start=start, number=number):
            of = shared_vocabulary.value
            own = Model(of.class_counts)
            own.unpack(np.frombuffer(start, np.float32))
            trainer = Trainer(own, 1000 * number + TaskContext.get().partitionId())
            end, seen = of.classes[END], 0
            for batch in batches:
                codes, distinct, sizes = tokens(batch.column(0))
                numbers = word_numbers(distinct, of).take(codes)
                u, v, w = contexts(class_ids(numbers, sizes, of), sizes, end)
                order = trainer.rng.permutation(len(w))
                for at in range(0, len(order), BATCH):
                    some = order[at : at + BATCH]
                    trainer.step(u[some], v[some], w[some])
                seen += len(w)
            if seen:
                flat = own.pack().astype(np.float64) * seen
                yield _sums(flat, seen)

        def add(batches):
            total, seen = None, 0
            for batch in batches:
                for blob, n in zip(*(c.to_pylist() for c in batch.columns)):
                    flat = np.frombuffer(blob, np.float64)
                    total = flat.copy() if total is None else total + flat
                    seen += n
            if seen:
                yield _sums(total, seen)

        parts = map_batches(texts, task, "flat binary, seen long")
        sums = map_batches(parts.repartition(32), add, "flat binary, seen long").collect()
        seen = sum(r["seen"] for r in sums)
        if seen:
            total = sum(np.frombuffer(r["flat"], np.float64) for r in sums)
            model.unpack((total / seen).astype(np.float32))
    return model


def _sums(flat: np.ndarray, seen: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([flat.tobytes()], pa.binary()), pa.array([seen], pa.int64())],
        ["flat", "seen"],
    )


SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
    "base_part double, model_part double, rare array<struct<word: binary, times: int>>"
)


def partial_scores(docs: DataFrame, of: Vocabulary, model: Model) -> DataFrame:
    """``SCORED``: all of a text's scores but for words outside ``of.known``.

    ``rare`` lists those, with how often each occurs; their log10(c + 1) is
    still to be added to both parts.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((of, model.pack()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, flat = shared.value
        model = Model(of.class_counts)
        model.unpack(flat)
        a, b, z = model.log_tables()
        spread = np.log10(np.r_[np.ones(WORDS), of.bucket_tokens + of.bucket_words + 1.0])
        base = np.log10(of.total + of.distinct + 1)
        listed = of.words.listed
        own = np.array([of.known.get(w, 0) for w in of.words], np.float64)
        logs = np.r_[np.log10(own + 1), np.zeros(BUCKETS)]
        # top words have their own class: their count is not in the share
        shares = np.where(of.class_by_number < WORDS, 0.0, logs)
        unknown = np.ones(len(logs), bool)
        unknown[:listed] = own == 0
        end = of.classes[END]
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            codes, distinct, sizes = tokens(batch.column(1))
            if not len(sizes):
                continue
            numbers = word_numbers(distinct, of).take(codes)
            u, v, w = contexts(class_ids(numbers, sizes, of), sizes, end)
            log10 = (a[u, w] + b[v, w] - z[u, v]).astype(np.float64) / np.log(10) - spread[w]
            starts = np.cumsum(sizes) - sizes
            by_text = np.add.reduceat(log10 + shares.take(numbers), starts)
            found = np.add.reduceat(logs.take(numbers), starts) - sizes * base
            places = np.flatnonzero(unknown.take(numbers))
            texts = np.searchsorted(starts, places, "right") - 1
            rare = [Counter() for _ in sizes]
            for text, code in zip(texts.tolist(), codes[places].tolist()):
                rare[text][distinct[code]] += 1
            n_known = sizes - np.bincount(texts, minlength=len(sizes))
            lists = [[{"word": x, "times": n} for x, n in r.items()] for r in rare]
            columns = [
                np.arange(row, row + len(sizes)), batch.column(0), batch.column(2), sizes,
                n_known, found, by_text, lists,
            ]
            row += len(sizes)
            yield pa.RecordBatch.from_arrays(
                [
                    c if isinstance(c, pa.Array) else pa.array(c, f.type)
                    for c, f in zip(columns, _SCORED)
                ],
                schema=_SCORED,
            )

    return map_batches(docs, task, SCORED)


_SCORED = pa.schema(
    [
        ("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
        ("n_tokens", pa.int64()), ("n_known", pa.int64()),
        ("base_part", pa.float64()), ("model_part", pa.float64()),
        ("rare", pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int32())]))),
    ]
)


def score_documents(docs: DataFrame) -> DataFrame:
    """Counts, unigram base and model score of every whole text.

    Counts and the model come from all documents of the other folds. Words
    beyond the ``KNOWN_WORDS`` most frequent ones are joined with their counts.
    A null text is the end token alone; a null id is in fold 0, a training one;
    repeated rows are scored (and counted) each; without training documents
    every count is 0; an empty table gives no rows; other columns are ignored.
    """
    rows = prepared(docs)
    texts = training(rows)
    counts = cut_lineage(word_counts(texts))
    of = vocabulary(counts)
    model = train(texts, of)
    parts = cut_lineage(partial_scores(rows, of, model))
    rare = parts.select("row", F.explode("rare").alias("item")).select(
        "row", F.col("item.word").alias("word"), F.col("item.times").alias("times")
    )
    met = rare.join(counts.select("word", "n"), "word")
    more = met.groupBy("row").agg(
        F.sum("times").alias("times"),
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("logs"),
    )
    logs = F.coalesce("logs", F.lit(0.0))
    return parts.drop("rare").join(more, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("times", F.lit(0))).alias("n_known"),
        F.lit(of.total).cast("long").alias("train_tokens"),
        (F.col("base_part") + logs).alias("base_score"),
        (F.col("model_part") + logs).alias("score"),
    )
