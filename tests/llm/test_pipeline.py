"""The pipeline, stage by stage, each stage against its contract on its own input."""

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import TABLES
from tests.llm import brute
from tideline.llm import secret_scan, tokens
from tideline.llm.queries import vocabulary


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of every stage."""
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, TABLES).write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out[name] = (docs.collect(), after.collect(), after.columns)
        docs = after
    return out


def test_order_and_columns(stages):
    assert list(stages) == ["language_id", "near_duplicates", "decontaminate", "secrets", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name][2] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_language_stage_keeps_clean_documents(stages):
    before, after, _ = stages["language_id"]
    kept = {r.doc_id for r in after}
    assert kept <= {r.doc_id for r in before} and len(kept) >= 0.98 * len(before)
    assert all(any(c.isalpha() for c in r.text) for r in after)


def test_near_duplicate_stage_keeps_one_of_each_group(stages):
    before, after, _ = stages["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before]
    expected = brute.near_groups(rows, corpus_pipeline.SHINGLE, corpus_pipeline.MIN_PERCENT)
    assert sorted(r.doc_id for r in after) == sorted(d for i, (d, _) in enumerate(rows) if expected[i][1] == d)


def test_decontamination_stage(spark, stages):
    before, after, _ = stages["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").select("item_id", "text").collect()]
    judged = brute.contamination([r.text for r in before], items)
    clean = [r for r, (n, hit, _) in zip(before, judged) if not (hit > 0 and 20 * hit >= n)]
    assert sorted(after) == sorted(clean) and len(clean) < len(before)


def test_secret_stage(stages):
    before, after, _ = stages["secrets"]
    then = {r.doc_id: r for r in before}
    assert len(after) == len(before)
    for r in after:
        assert not brute.secrets(r.text)[2]
        if not secret_scan.find_secrets(then[r.doc_id].text):
            assert r == then[r.doc_id]
        else:
            assert secret_scan.MARK in r.text and r.n_chars == len(r.text)


def test_packing_stage(stages):
    before, after, _ = stages["packing"]
    library = tokens.load(vocabulary())
    sizes = {r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1 for r in before}
    found: dict = {}
    for r in after:
        found[r.doc_id] = found.get(r.doc_id, 0) + r.length
    assert found == sizes
    assert len({r.sequence_id for r in after}) <= math.ceil(1.01 * sum(sizes.values()) / 2048) + 1


def test_run_returns_the_last_stage(spark, stages):
    out = corpus_pipeline.run(spark, TABLES)
    assert out.columns == stages["packing"][2] and out.count() == len(stages["packing"][1])
    assert out.filter(F.col("offset") + F.col("length") > 2048).count() == 0
