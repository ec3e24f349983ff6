"""Threshold-scaled sketches of documents, in DataFrame functions only.

A text's sketch keeps every shingle hash below a fixed fraction of the hash
range. Sketches of equal fraction can be merged by union, and the overlap of two
estimates both resemblance and containment however unequal the texts are. A
text with words whose hashes all lie above keeps its smallest one.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm.common import keyed_texts

SHINGLE_WORDS = 5
FRACTION = 1 / 8
BLANKS = r"[\x20\x09-\x0D]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is evaluated once."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.filter(F.split(text, BLANKS), lambda word: word != "")


def shingle_hashes(text: Column, n: int = SHINGLE_WORDS) -> Column:
    """One hash per ``n`` consecutive words; one for all words of a shorter text."""

    def of(hashes: Column) -> Column:
        size = F.size(hashes)
        window = F.transform(
            F.sequence(F.lit(0), size - n),
            lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(n)]),
        )
        short = F.transform(F.array(hashes), lambda whole: F.xxhash64(whole))
        none = F.array().cast("array<bigint>")
        return F.when(size >= n, window).when(size > 0, short).otherwise(none)

    return let(F.transform(words(text), lambda word: F.xxhash64(word)), of)


def sketch(
    text: Column, fraction: float = FRACTION, n: int = SHINGLE_WORDS
) -> Column:
    """Ascending distinct hashes in the lowest ``fraction`` of the range."""
    limit = F.lit(int(-(2**63) + fraction * 2**64))

    def kept(hashes: Column) -> Column:
        low = F.filter(hashes, lambda h: h < limit)
        least = F.when(
            F.size(hashes) > 0, F.array(F.array_min(hashes))
        ).otherwise(hashes)
        return F.when(F.size(low) > 0, F.sort_array(F.array_distinct(low))).otherwise(
            least
        )

    return let(shingle_hashes(text, n), kept)


def sketch_text(found: Column) -> Column:
    """Sixteen hexadecimal digits per hash."""
    digits = F.transform(found, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0"))
    return F.array_join(digits, "")


def resemblance(a: Column, b: Column) -> Column:
    """Share of common hashes; two empty sketches are alike."""
    both, either = F.size(F.array_intersect(a, b)), F.size(F.array_union(a, b))
    return F.when(either == 0, F.lit(1.0)).otherwise(both / either)


def containment(a: Column, b: Column) -> Column:
    """Share of ``a`` that is in ``b``; an empty sketch is in every other."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(both / F.size(a))


def id_bounds(docs: DataFrame) -> tuple[list[int], bool]:
    """First ids of as many ranges as there are shuffle partitions, and whether
    some id is null. Only ids are sorted; a row per range reaches the driver."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = (
        docs.select("doc_id")
        .repartitionByRange(parts, "doc_id")
        .groupBy(F.spark_partition_id().alias("part"))
        .agg(F.min("doc_id").alias("first"), F.count_if(F.isnull("doc_id")).alias("n"))
        .collect()
    )
    firsts = sorted(r["first"] for r in ranges if r["first"] is not None)
    return firsts, any(r["n"] for r in ranges)


def range_number(value: Column, firsts: list[int]) -> Column:
    """Index of the last bound not above the value (0 for null), found in two
    steps so that thousands of bounds cost few comparisons."""
    if len(firsts) < 2:
        return F.lit(0)
    step = math.isqrt(len(firsts))
    pieces = [firsts[i : i + step] for i in range(0, len(firsts), step)]
    heads = F.array(*[F.lit(piece[0]) for piece in pieces])
    table = F.array(*[F.array(*[F.lit(x) for x in piece]) for piece in pieces])

    def upto(bounds: Column) -> Column:
        return F.greatest(
            F.size(F.filter(bounds, lambda b: b <= value)) - 1, F.lit(0)
        )

    return let(upto(heads), lambda i: i * step + upto(F.get(table, i)))


def with_next(docs: DataFrame) -> DataFrame:
    """Rows plus ``next``, a struct of the following row's ``text`` and ``sketch``
    by ascending id; the first row follows the last. Texts move once, to their
    id range; the first row of a range also goes to the range before it."""
    firsts, nulls = id_bounds(docs)
    count = max(len(firsts), 1)
    number = range_number(F.col("doc_id"), firsts)
    start = F.lit(None) if nulls or not firsts else F.lit(firsts[0])
    head = F.lit(False)
    if len(firsts) > 1:
        head = F.coalesce(F.col("doc_id").isin(firsts[1:]), F.lit(False))

    def place(number: Column, copy: int) -> Column:
        return F.struct(number.alias("range"), F.lit(copy).alias("copy"))

    places = F.array_compact(
        F.array(
            place(F.col("range"), 0),
            F.when(head, place(F.col("range") - 1, 1)),
            F.when(F.col("doc_id").eqNullSafe(start), place(F.lit(count - 1), 2)),
        )
    )
    placed = docs.withColumn("range", number).withColumn("place", F.explode(places))
    order = Window.partitionBy("place.range").orderBy("place.copy", "doc_id", "text")
    return placed.withColumn(
        "next", F.lead(F.struct("text", "sketch")).over(order)
    ).filter("place.copy = 0")


def fingerprint_documents(
    docs: DataFrame, fraction: float = FRACTION, n: int = SHINGLE_WORDS
) -> DataFrame:
    """Sketch of every whole text and of its edited form, and their likeness.

    Null texts are empty and have an empty sketch; null ids come first; rows of
    equal id follow each other by text, repeated rows included; a table of one
    row follows itself; an empty table gives no rows; other columns are ignored.
    """
    made = keyed_texts(docs).withColumn("sketch", sketch(F.col("text"), fraction, n))
    half = F.floor(F.length("text") / 2).cast("int")
    head = F.substring(F.col("text"), F.lit(1), F.length("text") - half)
    edited = with_next(made).select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        "sketch",
        F.col("next.sketch").alias("next_sketch"),
        F.concat(head, F.substring(F.col("next.text"), F.lit(1), half)).alias("edited"),
    )
    both = edited.withColumn("edited_sketch", sketch(F.col("edited"), fraction, n))
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        sketch_text(F.col("sketch")).alias("fingerprint"),
        sketch_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("within_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("within_next"),
    )
