from __future__ import annotations

import os
import random
import shutil
import subprocess
import sys

import numpy as np
from llm_data import SCHEMA, with_odd_rows
from test_packing_sharding import check_packing
from test_minhash import plain as similar
from test_substring import plain

import corpus_pipeline
from clickloom.llm import quality, simhash, substring, toxicity
from clickloom.llm.common import DOCUMENT, labels

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF_DIR = "/root/testdata/sf0.001"


def rows_of(frame):
    return sorted((tuple(r[c] for c in DOCUMENT) for r in frame.collect()), key=str)


def test_stages_against_plain_rules(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "quality_rules", "near_duplicates", "substring_dedup", "packing"]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        given = rows_of(docs)
        out = stage(spark, docs, SF_DIR)
        path = str(tmp_path / str(number))
        out.write.parquet(path)
        out = spark.read.parquet(path)
        if name == "packing":
            check_packing(out.collect(), given)
            return
        assert out.columns == list(DOCUMENT)
        found = rows_of(out)
        if name == "toxicity":
            model = toxicity.fit(docs, labels(spark, SF_DIR))
            scores = toxicity.score_documents(docs, model).collect()
            clean = {r["doc_id"] for r in scores if r["score"] < 0.5}
            assert found == [r for r in given if r[0] in clean]
        elif name == "quality_rules":
            rules = quality.fit(docs, labels(spark, SF_DIR))
            kept = {r["doc_id"] for r in quality.judge(docs, rules).collect() if r["kept"]}
            assert found == [r for r in given if r[0] in kept]
        elif name == "near_duplicates":
            first = {least for _, least in similar(given)}
            assert found == [r for r in given if r[0] in first]
        else:
            removed = {i: n for i, _, n, _ in plain(given)}
            assert {r[0] for r in found} == {r[0] for r in given}
            text = {r[0]: r[1] for r in given}
            for i, new, _, _, n_chars in found:
                assert len(new.split()) == len(text[i].split()) - removed[str(i)]
                assert n_chars == len(new) and (removed[str(i)] or new == text[i])
        docs = out


def test_stages_on_odd_rows_and_empty_tables(spark, odd, empty, rows):
    given = with_odd_rows(rows)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
        assert stage(spark, odd, SF_DIR).count() <= 2 * len(given)
    kept = corpus_pipeline.drop_near_duplicates(spark, odd, SF_DIR).collect()
    assert sum(r["doc_id"] is None for r in kept) == 1
    frame = spark.createDataFrame(rows, SCHEMA)
    assert substring.remove_repeats(frame).count() == len(rows)


def test_near_duplicates_take_fingerprint_links(spark):
    """Four pairs within three bits, of which shingle sets link none."""
    base = [f"w{i}" for i in range(400)]
    given, number = [], 0
    for at in range(4):
        words = [f"p{at}{w}" for w in base]
        own = simhash.fingerprints([" ".join(words).encode()])
        for seed in range(4000):
            random.seed(seed)
            other = list(words)
            for place in random.sample(range(len(words)), 12):
                other[place] = f"x{place}"
            new = simhash.fingerprints([" ".join(other).encode()])
            if int(np.bitwise_count((own ^ new).view(np.uint64))[0]) <= simhash.RADIUS:
                break
        else:
            raise AssertionError("no pair within three bits")
        for text in (words, other):
            given.append((number, " ".join(text), "en", "s", 1))
            number += 1
    frame = spark.createDataFrame(given, SCHEMA)
    assert {least for _, least in similar(given)} == set(range(8))
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, SF_DIR).collect()
    assert sorted(r["doc_id"] for r in kept) == [0, 2, 4, 6]


def test_the_rest_imports_without_this_subpackage(tmp_path):
    copy = tmp_path / "repo"
    skip = shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__")
    shutil.copytree(ROOT, copy, ignore=skip)
    code = (
        "import __spark_entry__ as e; q = e.queries(); "
        "assert q and 'pipeline' not in q and not any(n.startswith('op') for n in q); "
        "assert e.oracle_sql()"
    )
    env = {**os.environ, "PYTHONPATH": ""}
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env=env)
