"""Train candidates with Spark ML, pick a winner, store the serving bundle."""

from __future__ import annotations

import json
import random
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import FeatureHasher, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clickloom import constants as C
from clickloom import schemas
from clickloom.operators import evaluation as E
from clickloom.session import cut_lineage, scratch_path
from clickloom.sources.tables import read_table

HASH_BUCKETS = 64
HASHED_FEATURES = 1 << 14
TRIALS = 3
SEED = 42


def bucketed(frame: DataFrame, buckets: int = HASH_BUCKETS) -> DataFrame:
    """Hash category codes into few classes that trees split as sets.

    Tokens keep their own class; only the model sees the buckets. The columns
    are marked nominal, so no order of the hashes is taken for one of the values.
    """
    nominal = {"ml_attr": {"type": "nominal", "num_vals": buckets}}
    for name in C.CATEGORICAL_FEATURES:
        code = F.col(f"{name}_code")
        spread = F.pmod(F.xxhash64(code), F.lit(buckets - C.FIRST_VALUE_CODE))
        number = F.when(code < C.FIRST_VALUE_CODE, code).otherwise(
            spread + C.FIRST_VALUE_CODE
        )
        marked = number.cast("double").alias(f"{name}_bucket", metadata=nominal)
        frame = frame.select("*", marked)
    return frame


def weighted(train: DataFrame) -> DataFrame:
    """Balance the classes: each one weighs half of all rows."""
    row = train.agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(C.LABEL)).alias("pos")
    ).first()
    positives = max(row["pos"] or 0, 1)
    negatives = max(row["n"] - (row["pos"] or 0), 1)
    weight = F.when(F.col(C.LABEL) == 1, row["n"] / (2.0 * positives)).otherwise(
        row["n"] / (2.0 * negatives)
    )
    return train.withColumn("_weight", weight)


@dataclass(frozen=True)
class Candidate:
    """A learner with the ranges its settings are drawn from.

    A pair of whole numbers is a range of whole numbers, ``positive_weight``
    multiplies the weight of positive rows. ``hashed`` learners see a category
    value as a column of its own, the others as a class.
    """

    make: Callable[..., object]
    ranges: dict[str, tuple]
    hashed: bool = False

    def settings(self, name: str, trials: int, seed: int) -> list[dict]:
        """Seeded draws; equal names and seeds give equal settings."""
        rng = random.Random(f"{seed}/{name}")
        return [
            {
                key: rng.randint(low, high)
                if isinstance(low, int)
                else round(rng.uniform(low, high), 6)
                for key, (low, high) in self.ranges.items()
            }
            for _ in range(trials)
        ]

    def learner(self, settings: dict):
        kept = {k: v for k, v in settings.items() if k != "positive_weight"}
        return self.make(
            labelCol=C.LABEL, featuresCol="features", weightCol="_weight", **kept
        )

    def inputs(self):
        """The stage that makes the feature vector; it has nothing to fit."""
        if self.hashed:
            return FeatureHasher(
                inputCols=[*C.NUMERIC_FEATURES, *C.CATEGORICAL_FEATURES],
                categoricalCols=list(C.CATEGORICAL_FEATURES),
                numFeatures=HASHED_FEATURES,
                outputCol="features",
            )
        buckets = [f"{c}_bucket" for c in C.CATEGORICAL_FEATURES]
        return VectorAssembler(
            inputCols=[*C.NUMERIC_FEATURES, *buckets], outputCol="features"
        )

    def pipeline(self, settings: dict) -> Pipeline:
        return Pipeline(stages=[self.inputs(), self.learner(settings)])


def candidates(seed: int = SEED) -> list[tuple[str, Candidate]]:
    """The learners in evaluation order."""
    balance = {"positive_weight": (0.5, 2.0)}
    trees = dict(maxBins=HASH_BUCKETS, seed=seed)
    boost = {"maxDepth": (2, 5), "maxIter": (8, 16), "stepSize": (0.05, 0.3), **balance}
    sampled = {**boost, "subsamplingRate": (0.5, 0.9)}
    forest = {"maxDepth": (4, 8), "numTrees": (10, 30), **balance}
    linear = {"regParam": (0.001, 0.1), "elasticNetParam": (0.0, 0.5), **balance}
    return [
        ("gbt", Candidate(partial(GBTClassifier, **trees), boost)),
        ("gbt_sampled", Candidate(partial(GBTClassifier, **trees), sampled)),
        ("forest", Candidate(partial(RandomForestClassifier, **trees), forest)),
        ("logistic", Candidate(partial(LogisticRegression, maxIter=30), linear, True)),
    ]


def scores(model, frame: DataFrame) -> DataFrame:
    chance = vector_to_array(F.col("probability"))[1]
    return model.transform(bucketed(frame)).select(
        chance.alias("score"), F.col(C.LABEL)
    )


def search(
    train: DataFrame,
    validation: DataFrame,
    pool=None,
    trials: int = TRIALS,
    seed: int = SEED,
) -> DataFrame:
    """A row per trial: candidate, settings, where its model is stored, metrics.

    Both frames are stored encoded, once, and the feature vectors once for all
    learners that see the same ones. Every trial's model and validation
    scores are stored too; the metrics of all trials are one job over the
    scores.
    """
    pool = candidates() if pool is None else pool
    spark = train.sparkSession
    ready, held = cut_lineage(weighted(bucketed(train))), cut_lineage(validation)
    base, facts, vectors = scratch_path(spark, "search"), [], {}
    for order, (name, candidate) in enumerate(pool):
        inputs = candidate.inputs()
        if candidate.hashed not in vectors:
            made = inputs.transform(ready).select(C.LABEL, "_weight", "features")
            vectors[candidate.hashed] = cut_lineage(made)
        for trial, settings in enumerate(candidate.settings(name, trials, seed)):
            more = F.when(F.col(C.LABEL) == 1, settings["positive_weight"]).otherwise(1.0)
            rows = vectors[candidate.hashed].withColumn("_weight", F.col("_weight") * more)
            path = f"{base}/model-{order}-{trial}"
            model = PipelineModel([inputs, candidate.learner(settings).fit(rows)])
            model.write().save(path)
            facts.append((name, order, trial, json.dumps(settings, sort_keys=True), path))
            # read back: a fresh model drags its training summary along
            scored = scores(PipelineModel.load(path), held).withColumns(
                {"candidate_order": F.lit(order), "trial": F.lit(trial)}
            )
            scored.write.mode("append").parquet(f"{base}/scores")
    keys = ["candidate_order", "trial"]
    found = E.metrics(spark.read.parquet(f"{base}/scores"), keys)
    table = spark.createDataFrame(
        facts, "candidate string, candidate_order int, trial int, settings string, path string"
    )
    return cut_lineage(table.join(F.broadcast(found), keys))


def best_trials(table: DataFrame) -> DataFrame:
    """The best trial of each candidate, the earliest one on a tie."""
    order = Window.partitionBy("candidate").orderBy(F.col("pr_auc").desc(), "trial")
    every = Window.partitionBy("candidate")
    ranked = table.withColumns(
        {"_place": F.row_number().over(order), "trials": F.count(F.lit(1)).over(every)}
    )
    return ranked.filter("_place = 1").drop("_place")


def train_candidates(
    train: DataFrame, validation: DataFrame, pool=None, trials: int = TRIALS
) -> tuple[dict[str, PipelineModel], DataFrame]:
    """Every candidate's best model, and the row of its trial."""
    best = best_trials(search(train, validation, pool, trials))
    models = {r["candidate"]: PipelineModel.load(r["path"]) for r in best.collect()}
    return models, best


def run(
    frames: dict[str, DataFrame],
    pool=None,
    floor: float = C.MIN_PR_AUC,
    trials: int = TRIALS,
):
    """Winner by validation PR-AUC, gate verdict, test metrics and report.

    The report has a row per candidate; the winner's facts are in every one.
    """
    models, table = train_candidates(frames["train"], frames["val"], pool, trials)
    winner = E.best_model(table).first()
    model = models[winner["candidate"]]
    threshold = winner["threshold"]
    tested = E.metrics(scores(model, frames["test"]), threshold=threshold)
    spark = frames["train"].sparkSession
    asked = spark.createDataFrame(
        [(winner["pr_auc"], None, floor, False, None, None, None)],
        "pr_auc double, production_pr_auc double, floor double, override boolean, "
        "override_by string, override_reason string, override_time string",
    )
    passed = E.gate_verdict(asked).first()["passed"]
    facts = tested.select(
        F.lit(winner["candidate"]).alias("winner_name"),
        F.lit(winner["pr_auc"]).alias("winner_validation_pr_auc"),
        F.lit(winner["average_precision"]).alias("winner_validation_average_precision"),
        F.lit(threshold).alias("winner_validation_threshold"),
        F.col("pr_auc").alias("test_pr_auc"),
        F.col("average_precision").alias("test_average_precision"),
        F.lit(passed).alias("validation_gate_passed"),
    )
    tried = table.select(
        "candidate",
        "candidate_order",
        "trials",
        "settings",
        F.col("pr_auc").alias("validation_pr_auc"),
        F.col("average_precision").alias("validation_average_precision"),
    )
    fact = facts.first().asDict()
    report = tried.select(
        "*", *[F.lit(fact[f.name]).cast(f.dataType).alias(f.name) for f in facts.schema]
    )
    return model, threshold, report.orderBy("candidate_order")


def save_bundle(
    model: PipelineModel,
    vocabulary: DataFrame,
    threshold: float,
    path: str,
    horizon_minutes: int = C.HORIZON_SECONDS // 60,
    model_version: str = "1",
) -> None:
    """Model, vocabulary and metadata below one path."""
    model.write().overwrite().save(f"{path}/model")
    vocabulary.write.mode("overwrite").parquet(f"{path}/vocabulary")
    facts = {
        "contract_version": C.CONTRACT_VERSION,
        "columns": [*C.NUMERIC_FEATURES, *C.CATEGORICAL_FEATURES],
        "missing_token": C.MISSING_TOKEN,
        "unknown_token": C.UNKNOWN_TOKEN,
        "threshold": float(threshold),
        "horizon_minutes": horizon_minutes,
        "model_version": model_version,
        "model_uri": f"{path}/model",
    }
    spark = vocabulary.sparkSession
    text = spark.createDataFrame([(json.dumps(facts, sort_keys=True),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load_bundle(spark: SparkSession, path: str):
    """``(model, vocabulary, metadata)``; an unknown contract is an error."""
    facts = json.loads(spark.read.text(f"{path}/metadata").first()["value"])
    if facts["contract_version"] != C.CONTRACT_VERSION:
        raise ValueError(f"contract {facts['contract_version']!r} is not supported")
    vocabulary = read_table(spark, f"{path}/vocabulary", schemas.VOCABULARY)
    return PipelineModel.load(f"{path}/model"), vocabulary, facts


class BucketingModel:
    """A stored model that also derives the bucket columns it was fitted on."""

    def __init__(self, model: PipelineModel):
        self.model = model

    def transform(self, frame: DataFrame) -> DataFrame:
        return self.model.transform(bucketed(frame))
