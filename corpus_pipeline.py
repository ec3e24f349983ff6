"""A corpus from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir), reads all that its predecessor kept and
returns documents again, the last one sequences. Between stages the rows are
written to the shared folder and read again.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from clickloom.llm import minhash, packing, quality, simhash, substring, toxicity
from clickloom.llm.common import DOCUMENT, documents, labels
from clickloom.llm.components import components
from clickloom.session import cut_lineage


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on these, does not call toxic.

    Every row is judged by its own text, null as empty; repeated rows and null
    ids are kept or dropped like any other. An empty table gives no rows.
    """
    model = toxicity.fit(docs, labels(spark, sf_dir))
    scored = toxicity.score_documents(docs, model, DOCUMENT[1:])
    return scored.filter("predicted = 0").select(*DOCUMENT)


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list.

    Null and empty texts fail the base rules (fewer than 50 words) and go;
    repeated rows and null ids are judged like any other.
    """
    rules = quality.fit(docs, labels(spark, sf_dir))
    judged = quality.judge(docs, rules, DOCUMENT[1:])
    return judged.filter("kept").select(*DOCUMENT)


def linked_texts(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, root) of every row that has an id.

    Texts are linked by ball hashing, the method of ``op5``: fingerprints within
    three bits. Similar texts that are further apart are linked by their shingle
    sets as well (``minhash``); root names what chains of either link join.
    """
    named = docs.filter("doc_id IS NOT NULL")
    mark = minhash.text_mark(F.col("text")).alias("mark")
    rows = cut_lineage(simhash.fingerprint_documents(named, mark))
    balls = rows.join(simhash.fingerprint_roots(rows), "fp").select(
        "doc_id", "mark", F.xxhash64(F.lit("ball"), "root").alias("ball")
    )
    sets = minhash.group_texts(named).select(
        "doc_id", "mark", F.xxhash64(F.lit("set"), "root").alias("set")
    )
    sets = sets.distinct()
    both = cut_lineage(balls.distinct().join(sets, ["doc_id", "mark"]))
    joined = components(both.select(F.col("ball").alias("a"), F.col("set").alias("b")))
    roots = joined.withColumnRenamed("node", "ball")
    return both.join(roots, "ball").select("doc_id", "mark", "root")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of linked texts: one with its smallest id.

    Rows without an id are kept. Rows that share an id but not the text are told
    apart by it; of rows equal in both one is kept, the first by the other
    columns. Null texts count as empty, and all texts without words are alike.
    """
    groups = linked_texts(docs)
    first = groups.groupBy("root").agg(F.min(F.struct("doc_id", "mark")).alias("k"))
    first = first.select("k.doc_id", "k.mark")
    marked = docs.filter("doc_id IS NOT NULL").select(
        *DOCUMENT, minhash.text_mark(F.col("text")).alias("mark")
    )
    same = Window.partitionBy("doc_id", "mark").orderBy("lang", "source", "n_chars")
    named = marked.join(first, ["doc_id", "mark"], "left_semi")
    named = named.withColumn("place", F.row_number().over(same)).filter("place = 1")
    return named.select(*DOCUMENT).unionByName(
        docs.filter("doc_id IS NULL").select(*DOCUMENT)
    )


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller id has; n_chars follows.

    No row is dropped: null texts, empty ones and texts that lose all their words
    stay as rows. Rows of one id do not take passages from each other.
    """
    kept = substring.remove_repeats(docs, ("lang", "source", "n_chars"))
    length = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
    n_chars = F.coalesce(length, F.col("n_chars"))
    return kept.withColumn("n_chars", n_chars).select(*DOCUMENT)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 2048 tokens; an empty or null text is
    its end token alone."""
    words = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack(docs, words)


STAGES = [
    ("toxicity", drop_toxic),
    ("quality_rules", drop_low_quality),
    ("near_duplicates", drop_near_duplicates),
    ("substring_dedup", drop_repeats),
    ("packing", pack_sequences),
]

#: The classifier, the rule list, the tokenizer and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
