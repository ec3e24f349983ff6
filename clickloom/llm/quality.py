"""Quality rules learned as a decision list.

Sequential covering: a rule for bad documents is a conjunction of thresholds on
document statistics, grown on two thirds of the labelled rows by information
gain, pruned on the other third, and its documents leave before the next rule
is grown. The list becomes one ordered Spark ``CASE WHEN``.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom.llm.common import bounded, keyed_texts, map_batches

LABELLED_ROWS = 20_000  # documented bound of the rows a list is fitted on
LEAST_WORDS = 50
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
RATIOS = (
    "word_length", "symbol_share", "dup_line_share", "repeat_share", "upper_share",
    "digit_share", "bang_share", "bar_share", "distinct_share", "stop_share",
    "line_words", "top_word_share",
)
SCHEMA = "doc_id long, " + ", ".join(
    [f"{c} long" for c in BASE] + [f"{c} double" for c in RATIOS]
)
_DROP_SYMBOLS = bytes.maketrans(b"", b""), b"#*$%&|<>"
_UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")


def statistics(text: str) -> tuple:
    """The numbers of ``SCHEMA`` but the id, for one text."""
    raw = text.encode()
    words = raw.split()
    n = len(words)
    body = b"".join(words)
    continuing = sum(map(body.count, _TAILS)) if not body.isascii() else 0
    chars = len(body) - continuing
    symbols = len(raw) - len(raw.translate(*_DROP_SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.split()]
    dup = len(lines) - len(set(lines))
    triples = list(zip(words, words[1:], words[2:]))
    repeat = 0
    if len(set(triples)) < len(triples):
        counts = Counter(triples)
        covered = bytearray(n)
        for i, triple in enumerate(triples):
            if counts[triple] > 1:
                covered[i : i + 3] = b"\1\1\1"
        repeat = sum(covered)
    of_words, of_chars = max(n, 1), max(chars, 1)
    kinds = Counter(words)
    return (
        n, chars, symbols, dup, repeat,
        chars / of_words,
        symbols / of_words,
        dup / max(len(lines), 1),
        repeat / of_words,
        len(_UPPER.findall(text)) / of_chars,
        sum(body.count(b"%d" % d) for d in range(10)) / of_chars,
        (body.count(b"!") + body.count(b"?")) / of_words,
        body.count(b"|") / of_words,
        len(kinds) / of_words,
        sum(len(w) <= 3 for w in words) / of_words,
        n / max(len(lines), 1),
        max(kinds.values(), default=0) / of_words,
    )


#: Bytes that continue a UTF-8 character.
_TAILS = [bytes([b]) for b in range(0x80, 0xC0)]


def document_statistics(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``SCHEMA`` of every whole text, then the carried columns as they are."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        for batch in batches:
            found = [statistics(t) for t in batch.column(1).to_pylist()]
            columns = list(zip(*found)) or [()] * (len(names) - 1)
            whole = len(BASE)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(c, pa.int64()) for c in columns[:whole]),
                    *(pa.array(c, pa.float64()) for c in columns[whole:]),
                    *batch.columns[2:],
                ],
                [*names, *batch.schema.names[2:]],
            )

    texts = keyed_texts(docs, *(F.col(c).alias(f"carry_{c}") for c in carry))
    types = dict(texts.dtypes)
    schema = SCHEMA + "".join(f", carry_{c} {types[f'carry_{c}']}" for c in carry)
    return map_batches(texts, task, schema)


def base_failed() -> Column:
    few = F.col("n_words") < LEAST_WORDS
    return few | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


@dataclass(frozen=True)
class Condition:
    """``column >= value`` or ``column < value``."""

    column: str
    above: bool
    value: float

    def holds(self, table: dict[str, np.ndarray]) -> np.ndarray:
        x = table[self.column]
        return x >= self.value if self.above else x < self.value

    def spark(self) -> Column:
        x = F.col(self.column)
        return x >= self.value if self.above else x < self.value

    def __str__(self) -> str:
        return f"{self.column} {'>=' if self.above else '<'} {self.value:.6g}"


Rule = tuple[Condition, ...]


def _holds(rule: Rule, table: dict[str, np.ndarray], n: int) -> np.ndarray:
    out = np.ones(n, bool)
    for condition in rule:
        out &= condition.holds(table)
    return out


def _best_condition(table, bad, inside) -> tuple[float, Condition | None]:
    """By FOIL's gain: bad rows kept, times the bits that purity gains."""
    p0, n0 = (bad & inside).sum(), (~bad & inside).sum()
    best, gain_of = None, 1e-9
    before = math.log2(p0 / (p0 + n0))
    for column, values in table.items():
        order = np.argsort(values[inside], kind="stable")
        x, y = values[inside][order], bad[inside][order]
        cut = np.flatnonzero(x[1:] > x[:-1]) + 1
        if not len(cut):
            continue
        below_p, below = np.cumsum(y)[cut - 1], cut
        for above in (False, True):
            p = p0 - below_p if above else below_p
            size = p0 + n0 - below if above else below
            gain = p * (np.log2(np.maximum(p, 1e-9) / size) - before)
            at = int(np.argmax(gain))
            if gain[at] > gain_of:
                value = float((x[cut[at] - 1] + x[cut[at]]) / 2)
                if not x[cut[at] - 1] < value <= x[cut[at]]:
                    value = float(x[cut[at]])
                gain_of, best = gain[at], Condition(column, above, value)
    return gain_of, best


def learn(
    table: dict[str, np.ndarray],
    bad: np.ndarray,
    most_rules: int = 12,
    most_conditions: int = 4,
    least_precision: float = 0.9,
) -> list[Rule]:
    """Ordered rules for bad rows; stops when a pruned rule is not precise."""
    part = np.random.default_rng(0).random(len(bad)) < 1 / 3
    left, rules = np.ones(len(bad), bool), []
    for _ in range(most_rules):
        grow, prune = left & ~part, left & part
        if (bad & grow).sum() < 5 or not (bad & prune).any():
            break
        rule, inside = [], grow.copy()
        while len(rule) < most_conditions and (~bad & inside).any():
            _, condition = _best_condition(table, bad, inside)
            if condition is None:
                break
            rule.append(condition)
            inside &= condition.holds(table)

        def worth(n: int) -> float:
            hit = _holds(tuple(rule[:n]), table, len(bad)) & prune
            p, q = (hit & bad).sum(), (hit & ~bad).sum()
            return (p - q) / max(p + q, 1)

        if not rule:
            break
        kept = tuple(rule[: max(range(1, len(rule) + 1), key=lambda n: (worth(n), -n))])
        hit = _holds(kept, table, len(bad)) & left
        right = (hit & bad & prune).sum() / max((hit & prune).sum(), 1)
        if not hit.any() or right < least_precision:
            break
        rules.append(kept)
        left &= ~hit
    return rules


def verdict(rules: list[Rule]) -> Column:
    """True for documents to keep: the first rule that holds rejects."""
    out = None
    for rule in rules:
        condition = rule[0].spark()
        for more in rule[1:]:
            condition = condition & more.spark()
        out = (F if out is None else out).when(condition, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> list[Rule]:
    """Rules from about ``rows`` labelled documents, chosen by hash of the id.

    Labels that are null, or repeated with another value, are left out; without
    labels of both kinds there are no rules.
    """
    marked = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .filter("doc_id IS NOT NULL AND quality IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"), F.max("quality").alias("most"))
        .filter("quality = most")
        .select("doc_id", "quality")
    )
    marked = bounded(marked, rows, labels.count(), F.col("doc_id"))
    chosen = docs.select("doc_id", "text").join(F.broadcast(marked), "doc_id")
    numbers = document_statistics(chosen).dropDuplicates(["doc_id"])
    found = numbers.join(F.broadcast(marked), "doc_id").filter(~base_failed())
    found = found.toPandas().sort_values("doc_id")
    table = {c: found[c].to_numpy(float) for c in RATIOS}
    bad = found["quality"].to_numpy() == 0
    return learn(table, bad) if len(bad) else []


def judge(
    docs: DataFrame, rules: list[Rule], carry: tuple[str, ...] = ()
) -> DataFrame:
    """Statistics and verdict of every whole text, and the carried columns.

    Null and empty texts have no words and fail the base; null ids and repeated
    rows are judged like any other; an empty table gives no rows; other columns
    are ignored.
    """
    numbers = document_statistics(docs, carry).withColumn("base_failed", base_failed())
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(rules))
    carried = (F.col(f"carry_{c}").alias(c) for c in carry)
    return numbers.select("doc_id", *BASE, "base_failed", kept.alias("kept"), *carried)
