"""Model-ready numeric columns and train-fitted category vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas
from clickloom.operators.lookup import (
    BROADCAST_ROWS,
    ROWS_PER_SALT,
    at_most,
    left_lookup,
)
from clickloom.operators.ordered import TASK_ROWS, dense_index

_TOKENS = (C.MISSING_TOKEN, C.UNKNOWN_TOKEN)


def model_frame(gold: DataFrame, *carry: str) -> DataFrame:
    """The model inputs; a number that is missing or unreadable becomes 0."""
    wanted = {*C.NUMERIC_FEATURES, *C.CATEGORICAL_FEATURES, C.LABEL}
    absent = sorted(wanted.difference(gold.columns))
    if absent:
        raise ValueError(f"columns the model needs are absent: {', '.join(absent)}")

    def number(name):
        value = F.col(name).try_cast("double")
        return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0)).alias(name)

    return gold.select(
        *carry,
        *[number(name) for name in C.NUMERIC_FEATURES],
        *C.CATEGORICAL_FEATURES,
        F.col(C.LABEL).cast("int").alias(C.LABEL),
    )


def fit_vocabulary(train: DataFrame, limit: int = TASK_ROWS) -> DataFrame:
    """``(column, value, code)``; codes follow first appearance in gold order.

    Rows collapse to distinct category tuples before anything is ordered.
    """
    first = F.min(F.struct(*C.EVENT_KEY)).alias("_first")
    tuples = train.groupBy(*C.CATEGORICAL_FEATURES).agg(first)
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("column"), F.col(name).alias("value"))
                for name in C.CATEGORICAL_FEATURES
            ]
        )
    )
    listed = tuples.select(pairs.alias("_pair"), "_first").select("_pair.*", "_first")
    listed = listed.filter(F.col("value").isNotNull() & ~F.col("value").isin(*_TOKENS))
    firsts = listed.groupBy("column", "value").agg(F.min("_first").alias("_first"))
    ranked = dense_index(firsts, ["_first"], "rank", keys=["column"], limit=limit)
    coded = ranked.select(
        "column", "value", (F.col("rank") + C.FIRST_VALUE_CODE).alias("code")
    )
    reserved = train.sparkSession.createDataFrame(
        [
            (name, token, code)
            for name in C.CATEGORICAL_FEATURES
            for token, code in zip(_TOKENS, (C.MISSING_CODE, C.UNKNOWN_CODE))
        ],
        schemas.VOCABULARY,
    )
    return coded.unionByName(reserved)


def encode(
    df: DataFrame,
    vocabulary: DataFrame,
    columns=C.CATEGORICAL_FEATURES,
    limit: int = BROADCAST_ROWS,
    rows_per_salt: int = ROWS_PER_SALT,
) -> DataFrame:
    """NULL to the missing token, unseen to the unknown one; adds codes."""
    small = at_most(vocabulary, limit)
    for name in columns:
        known = vocabulary.filter(F.col("column") == name).select(
            F.col("value").alias(name), F.col("code").alias(f"{name}_code")
        )
        filled = df.withColumn(name, F.coalesce(name, F.lit(C.MISSING_TOKEN)))
        df = left_lookup(filled, known, [name], small, rows_per_salt=rows_per_salt)
        unseen = F.col(f"{name}_code").isNull()
        df = df.withColumn(
            name, F.when(unseen, C.UNKNOWN_TOKEN).otherwise(F.col(name))
        ).withColumn(
            f"{name}_code", F.coalesce(f"{name}_code", F.lit(C.UNKNOWN_CODE))
        )
    return df
