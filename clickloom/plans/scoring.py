"""Score session states with a fallback, in batch or per micro-batch."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom.functions import scalars as S
from clickloom.operators.dedup import keep_first
from clickloom.operators.encoding import encode

RESPONSE = (
    "user_session",
    "purchase_probability",
    "prediction_horizon_minutes",
    "model_uri",
    "model_version",
    "prediction_mode",
    "fallback_reason",
    "cached",
)


def reject_bad_ids(requests: DataFrame) -> DataFrame:
    return requests.filter(~S.is_session_id(F.col("user_session")))


def feature_rows(states: DataFrame) -> DataFrame:
    """Model inputs from serving columns, and ``_valid``.

    A missing or unreadable number, category id or event type makes the row
    invalid; an empty category code or brand is the missing token.
    """
    numbers = {
        name: F.col(f"serving_{name}").try_cast("double") for name in C.NUMERIC_FEATURES
    }
    texts = {
        name: S.blank_to_null(F.col(f"serving_{name}")) for name in C.CATEGORICAL_FEATURES
    }
    valid = F.lit(True)
    for column in [*numbers.values(), texts["category_id"], texts["event_type"]]:
        valid = valid & column.isNotNull()
    return states.withColumns({**numbers, **texts, "_valid": valid})


def latest_states(serving: DataFrame, order: str = "arrival") -> DataFrame:
    """The newest serving row of each session.

    The rank limit also runs below the shuffle, so a busy session sends one
    row per task.
    """
    return keep_first(serving, [F.col(order).desc()], keys=["user_session"])


def join_states(requests: DataFrame, states: DataFrame) -> DataFrame:
    """Requests with their state; ``_found`` tells whether there is one.

    Requests collapse to sessions before the join: all requests of a session
    get the same answer, so a session asked for often costs one lookup.
    """
    asked = requests.select("user_session").distinct()
    known = states.withColumn("_found", F.lit(True))
    joined = asked.join(known, "user_session", "left")
    return joined.withColumn("_found", F.coalesce("_found", F.lit(False)))


def score(
    requests: DataFrame,
    states: DataFrame,
    vocabulary: DataFrame | None = None,
    model=None,
    meta: dict | None = None,
) -> DataFrame:
    """One response per requested session, in one pass over the joined rows.

    No state or an invalid one: 0.5, ``redis_miss``. No model: 0.5,
    ``model_unavailable``. ``model`` is any fitted Spark ML model with a
    ``probability`` column. Rows that get a fallback go through the model with
    neutral inputs and their score is not used.
    """
    rows = feature_rows(join_states(requests, states))
    usable = F.col("_found") & F.col("_valid")
    if model is None or vocabulary is None:
        reason = F.when(F.col("_found"), "model_unavailable").otherwise("redis_miss")
        return _respond(rows, F.lit(False), F.lit(None), reason, {})
    neutral = rows.fillna(0.0, list(C.NUMERIC_FEATURES))
    scored = model.transform(encode(neutral, vocabulary))
    chance = vector_to_array(F.col("probability"))[1]
    return _respond(scored, usable, chance, F.lit("redis_miss"), meta or {})


def _respond(rows, scored: Column, chance: Column, reason: Column, meta: dict):
    """Response columns; model metadata only where the model answered."""

    def fact(name: str, kind: str) -> Column:
        return F.when(scored, F.lit(meta.get(name)).cast(kind))

    answers = {
        "purchase_probability": F.when(scored, chance.cast("double")).otherwise(
            F.lit(C.FALLBACK_PROBABILITY)
        ),
        "prediction_horizon_minutes": fact("horizon_minutes", "int"),
        "model_uri": fact("model_uri", "string"),
        "model_version": fact("model_version", "string"),
        "prediction_mode": F.when(scored, "model").otherwise("fallback"),
        "fallback_reason": F.when(~scored, reason),
        "cached": F.lit(False),
    }
    return rows.select(
        "user_session", *[column.alias(name) for name, column in answers.items()]
    )
