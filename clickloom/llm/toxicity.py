"""Toxicity by weak supervision.

Many voters (words of a lexicon, words and word beginnings found in labelled
training rows, patterns) fire or stay silent on a document. A generative model
of the votes estimates how often each fires on toxic and on clean documents,
and how far voters say the same thing; its posterior labels train a linear
classifier on words, which scores every document.

Labels come from a bounded sample of labelled rows. All other training rows take
part without one: rows with the same features are counted together, and Spark
sums over those counts in every step of both models.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import Memo, bounded, fold, keyed_texts, map_batches
from clickloom.llm.common import sum_matrices
from clickloom.session import cut_lineage

FOLDS = 5
LABELLED_ROWS = 10_000  # documented bound of the labelled rows of a model
#: The unlabelled rows, all of them, weigh this share of the labelled ones.
OTHER_WEIGHT = 0.02
ROUNDS = 30
SETTLED = 1e-4
FEATURES = 500
FEATURE_ODDS = 0.5
VOTERS = 300
VOTER_ODDS = 1.0
LEAST_DOCUMENTS = 4
PREFIXES = (4, 5, 6)
MEMO_WORDS = 100_000
SLICE_ROWS = 200
#: General insults, fixed values.
LEXICON = """
asshole bastard bitch clown crap cretin disgusting dumb fool garbage idiot idiots
imbecile jerk loser losers moron morons pathetic scum shit stupid trash ugly
useless vermin vile worthless
arschloch dumm dummkopf dreck idiotisch schwein verlierer widerlich wertlos
abruti con connard crétin imbécile merde pourri salaud stupide
asqueroso basura cabrón estúpido gilipollas idiota imbécil inútil mierda tonto
""".split()
#: Texts without any of the words in front cannot match.
PATTERNS = (
    (("you",), re.compile(r"\byou(?:'re| are)? (?:a |an |such )?(?:\w+ )?(?:idiot|loser|moron|fool)")),
    (("**",), re.compile(r"\b\w\*{2,}\w?")),
    (("shut", "hell", "hate", "kill"), re.compile(r"\b(?:shut up|go to hell|hate you|kill yourself)\b")),
    (("!!", "?!"), re.compile(r"(?:!{2,}|\?!)")),
)
_STRIP = ".,;:!?\"'()[]{}*#$%&|<>«»¡¿-"


def word_features(word: str) -> tuple[str, ...]:
    """The word without punctuation, and its beginnings."""
    bare = word.strip(_STRIP)
    if not bare:
        return ()
    return (f"={bare}", *(bare[:n] for n in PREFIXES if len(bare) > n))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Few rows at a time: the word sets of a whole batch take much memory."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)


def document_words(text: str) -> set[str]:
    return set(text.lower().split())


@dataclass
class Model:
    """Weights of the features that occur in a text, and a constant."""

    features: list[str] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    bias: float = -20.0


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def _table(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """0 or 1 for each feature of the rows of ``found``."""
    found = batch.column(2)
    table = np.zeros((batch.num_rows, width), np.float32)
    row = np.repeat(np.arange(batch.num_rows), found.value_lengths().to_numpy())
    table[row, found.flatten().to_numpy()] = 1
    return table


@dataclass
class LabelModel:
    """Voters' columns, their weighed evidence, and the log prior odds.

    The known label acts as one more voter that is right 49 times in 50. A
    voter's evidence is divided by one plus the correlations it has with others
    beyond what the class explains: voters that repeat each other count once.
    """

    voters: list[int]
    moves: np.ndarray
    bias: float

    def posterior(self, table: np.ndarray, gold: np.ndarray | None) -> np.ndarray:
        score = self.bias + table[:, self.voters] @ self.moves
        if gold is not None:
            score = score + np.log(49.0) * np.where(gold < 0, 0, 2 * gold - 1)
        return _sigmoid(score)


def fit_labels(
    patterns: DataFrame, width: int, voters: list[int], prior: float
) -> LabelModel:
    """Label model of rows (gold, weight, found); gold is 1, 0 or -1 (unlabelled).

    The labelled rows alone give the first guess, then all rows are weighed by
    their posterior until the rates settle; every step is one sum over Spark.
    """
    many = len(voters)
    model, rates, weigh = None, None, np.ones(many)

    def of(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
        gold, weight = (batch.column(i).to_numpy() for i in (0, 1))
        table = _table(batch, width)
        if model is None:
            known = np.where(gold == 1, 0.98, 0.02)
            return table[:, voters], known, weight * (gold >= 0)
        return table[:, voters], model.posterior(table, gold), weight

    def counts(total: np.ndarray, batch: pa.RecordBatch) -> None:
        votes, toxic, weight = of(batch)
        for line, share in enumerate((toxic * weight, (1 - toxic) * weight)):
            total[line, :many] += share @ votes
            total[line, many] += share.sum()

    def alike(total: np.ndarray, batch: pa.RecordBatch) -> None:
        votes, toxic, weight = of(batch)
        rest = votes - toxic[:, None] * rates[0] - (1 - toxic)[:, None] * rates[1]
        total += (rest * weight[:, None]).T @ rest

    for step in range(ROUNDS):
        on, off = sum_matrices(patterns, (2, many + 1), counts)
        before = rates
        rates = np.stack(
            [
                (on[:many] + 0.5) / (on[many] + 1.5),
                (off[:many] + 0.05) / (off[many] + 1.0),
            ]
        )
        if step % 10 == 0:
            shared = sum_matrices(patterns, (many, many), alike)
            spread = np.sqrt(np.maximum(shared.diagonal(), 1e-9))
            close = np.abs(shared) / np.outer(spread, spread)
            np.fill_diagonal(close, 0)
            weigh = 1 / (1 + np.where(close > 0.3, close, 0).sum(1))
        if step:
            prior = np.clip(on[many] / (on[many] + off[many]), 0.001, 0.999)
        fire = weigh * (np.log(rates[0]) - np.log(rates[1]))
        silent = weigh * (np.log1p(-rates[0]) - np.log1p(-rates[1]))
        bias = float(np.log(prior / (1 - prior)) + silent.sum())
        model = LabelModel(voters, fire - silent, bias)
        if step > 1 and np.abs(rates - before).max() < SETTLED:
            break
    return model


def fit_linear(
    patterns: DataFrame, width: int, labels: LabelModel, ridge: float = 0.25
) -> tuple[np.ndarray, float]:
    """Logistic regression of the first ``width`` features on posterior labels,
    by Newton steps; gradient and curvature are one sum over Spark."""
    columns = max(width, max(labels.voters, default=-1) + 1)
    weights = np.zeros(width + 1)
    pull = np.r_[np.full(width, ridge), 1e-3]

    def slopes(total: np.ndarray, batch: pa.RecordBatch) -> None:
        gold, weight = (batch.column(i).to_numpy() for i in (0, 1))
        table = _table(batch, columns)
        x = np.c_[table[:, :width], np.ones(len(table), np.float32)]
        p = _sigmoid(x @ weights)
        total[:, -1] += x.T @ (weight * (p - labels.posterior(table, gold)))
        total[:, :-1] += (x * (weight * p * (1 - p))[:, None].astype(np.float32)).T @ x

    for _ in range(25):
        sums = sum_matrices(patterns, (width + 1, width + 2), slopes)
        slope = sums[:, -1] + pull * weights
        step = np.linalg.solve(sums[:, :-1] + np.diag(pull), slope)
        weights = weights - step / max(1.0, np.abs(step).max() / 2)
        if np.abs(step).max() < 1e-3:
            break
    return weights[:-1], float(weights[-1])


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, gold) of every row outside fold 0 that has an id. At most
    ``LABELLED_ROWS`` labels, chosen by hash of the id, are looked at; gold is
    -1 for all other rows."""
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic")
        .filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(fold(F.col("doc_id"), FOLDS) != 0)
        .groupBy("doc_id")
        .agg(F.min("toxic").alias("gold"), F.max("toxic").alias("most"))
        .filter("gold = most")
        .select("doc_id", F.col("gold").cast("int").alias("gold"))
    )
    gold = bounded(marked, LABELLED_ROWS, labels.count(), F.col("doc_id"))
    texts = keyed_texts(docs).filter(
        (fold(F.col("doc_id"), FOLDS) != 0) & F.col("doc_id").isNotNull()
    )
    joined = texts.join(F.broadcast(gold), "doc_id", "left")
    return joined.select("text", F.coalesce("gold", F.lit(-1)).alias("gold"))


def feature_counts(rows: DataFrame) -> DataFrame:
    """(feature, toxic, clean): labelled documents in which a feature occurs."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = {0: Counter(), 1: Counter()}
            for text, gold in zip(*(c.to_pylist() for c in batch.columns)):
                if gold >= 0:
                    names = {f for w in document_words(text) for f in word_features(w)}
                    found[int(gold == 1)].update(names)
            names = list(found[0].keys() | found[1].keys())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(names, pa.string()),
                    pa.array([found[1][f] for f in names], pa.int64()),
                    pa.array([found[0][f] for f in names], pa.int64()),
                ],
                ["feature", "toxic", "clean"],
            )

    part = map_batches(rows, task, "feature string, toxic long, clean long")
    return part.groupBy("feature").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )


def choose_features(counts: DataFrame, toxic: int, clean: int) -> list[tuple]:
    """(feature, surely): at most ``FEATURES``, by the lower end of the 95%
    interval of the log odds of toxic against clean documents."""
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log(
        (F.col("clean") + 0.5) / (clean + 1)
    )
    width = F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
    ranked = (
        counts.filter(F.col("toxic") + F.col("clean") >= LEAST_DOCUMENTS)
        .select("feature", (odds - 1.96 * width).alias("surely"))
        .filter(F.col("surely") > FEATURE_ODDS)
        .orderBy(F.col("surely").desc(), "feature")
        .limit(FEATURES)
    )
    return [(r["feature"], r["surely"]) for r in ranked.collect()]


def occurrences(rows: DataFrame, features: list[str]) -> DataFrame:
    """(gold, found): indices of the features and patterns in each training row."""
    place = {f: i for i, f in enumerate(features)}

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(MEMO_WORDS)
        for batch in _slices(batches):
            texts = batch.column(0).to_pylist()
            every = [document_words(text) for text in texts]
            hits = _known_hits(memo, every, place)
            out = []
            for text, words in zip(texts, every, strict=True):
                low = text.lower()
                found = {i for word in words for i in hits[word]}
                for i, (parts, pattern) in enumerate(PATTERNS):
                    if any(part in low for part in parts) and pattern.search(low):
                        found.add(len(place) + i)
                out.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(out, pa.list_(pa.int32()))], ["gold", "found"]
            )

    return map_batches(rows, task, "gold int, found array<int>")


def _known_hits(memo: Memo, texts: list[set[str]], place: dict[str, int]) -> dict:
    """Places of the features of every word of the texts."""
    known, unknown = memo.find(set().union(*texts))
    for word in unknown:
        known[word] = hits = tuple(place[f] for f in word_features(word) if f in place)
        memo.put(word, hits)
    return known


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier; without labels of both kinds it scores near zero."""
    rows = training_rows(docs, labels)
    totals = dict(rows.groupBy("gold").count().collect())
    toxic, clean = totals.get(1, 0), totals.get(0, 0)
    if not toxic or not clean:
        return Model()
    chosen = choose_features(feature_counts(rows.filter("gold >= 0")), toxic, clean)
    names = [f for f, _ in chosen]
    names += sorted({f"={w}" for w in LEXICON} - set(names))
    weight = min(1.0, OTHER_WEIGHT * (toxic + clean) / max(totals.get(-1, 0), 1))
    one = F.when(F.col("gold") < 0, F.lit(weight)).otherwise(F.lit(1.0))
    counted = occurrences(rows, names).groupBy("gold", "found").count()
    patterns = counted.select("gold", (one * F.col("count")).alias("weight"), "found")
    patterns = cut_lineage(patterns.sortWithinPartitions("gold", "found"))
    width = len(names) + len(PATTERNS)
    speak = [i for i, (_, surely) in enumerate(chosen) if surely > VOTER_ODDS]
    voters = [*speak[:VOTERS], *range(len(chosen), width)]
    labels_ = fit_labels(patterns, width, voters, toxic / (toxic + clean))
    weights, bias = fit_linear(patterns, len(names), labels_)
    return Model(names, np.round(weights, 9).tolist(), round(bias, 9))


def score_documents(
    docs: DataFrame, model: Model, carry: tuple[str, ...] = ()
) -> DataFrame:
    """Score and prediction of every whole text, and the carried columns.

    Null and empty texts get the model's constant; null ids count as held out;
    repeated rows come back as they are; an empty table gives no rows; other
    columns are ignored.
    """
    place = {f: i for i, f in enumerate(model.features)}
    weights = np.array(model.weights)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = Memo(MEMO_WORDS)
        for batch in _slices(batches):
            texts = [document_words(t) for t in batch.column(1).to_pylist()]
            known = _known_hits(memo, texts, place)
            scores = []
            for words in texts:
                hits = {i for word in words for i in known[word]}
                total = model.bias + (weights[sorted(hits)].sum() if hits else 0.0)
                scores.append(float(_sigmoid(total)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), *batch.columns[2:]],
                ["doc_id", "score", *batch.schema.names[2:]],
            )

    texts = keyed_texts(docs, *(F.col(c).alias(f"carry_{c}") for c in carry))
    types = dict(texts.dtypes)
    schema = "doc_id long, score double"
    schema += "".join(f", carry_{c} {types[f'carry_{c}']}" for c in carry)
    return map_batches(texts, task, schema).select(
        "doc_id",
        (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *(F.col(f"carry_{c}").alias(c) for c in carry),
    )
