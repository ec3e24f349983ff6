from __future__ import annotations

import pytest
from llm_data import SCHEMA, corpus, with_odd_rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="session")
def odd(spark, rows):
    """The same with odd rows, and columns named like those of the results."""
    frame = spark.createDataFrame(with_odd_rows(rows), SCHEMA).repartition(3)
    clash = (
        "fingerprint component_id slot shard size length start offset kept score key "
        "sketch next range fp node root a b bucket n_words predicted count rank"
    )
    return frame.selectExpr("*", *[f"'x' AS {c}" for c in clash.split()]).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
