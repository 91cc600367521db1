"""The pipeline, stage by stage, against what each stage is to do; and the mix against its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

import corpus_pipeline
from leadtide.llm import pii, quality, queries, simhash
from leadtide.llm.common import documents
from tests.llm.cases import clashing, documents as cases
from tests.parity import connect, differences

FOLDER = "/root/testdata/sf0.01"


def test_stages_keep_the_columns(spark):
    docs = clashing(cases(spark))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns, name
        out.collect()
        stage(spark, docs.limit(0), FOLDER).collect()


def test_each_stage_takes_effect(spark):
    docs = documents(spark, FOLDER)
    stages = [f for _, f in corpus_pipeline.STAGES]
    good = stages[0](spark, docs, FOLDER).cache()
    judged = {r.doc_id for r in quality.quality_rules(docs.select("doc_id", "text"), spark.read.parquet(f"{FOLDER}/labels.parquet")).where("kept").collect()}
    assert {r.doc_id for r in good.collect()} == judged and len(judged) < docs.count()
    single = stages[1](spark, good, FOLDER).cache()
    groups = {r.component_id for r in simhash.near_duplicates(good).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(groups)
    clean = stages[2](spark, single, FOLDER).cache()
    assert clean.count() == single.count()
    assert not any(pii.EMAIL.search(r.text) for r in clean.collect())
    mixed = stages[3](spark, clean, FOLDER).cache()
    known = {(r.doc_id, r.text) for r in clean.collect()}
    assert {(r.doc_id, r.text) for r in mixed.collect()} <= known
    pieces = stages[4](spark, mixed, FOLDER)
    tokens = pieces.agg(F.sum("length")).first()[0]
    whole = pieces.where("start = 0").agg(F.sum("doc_tokens")).first()[0]
    assert tokens == whole and pieces.where("start = 0").count() == mixed.count()


def test_oracle_of_the_mix(spark):
    df = queries.QUERIES["op6_mixing"](spark, FOLDER)
    assert differences(df, connect(FOLDER), queries.ORACLE["op6_mixing"]) is None


def test_every_operator_has_a_query():
    assert sorted({n.split("_")[0] for n in queries.QUERIES}) == sorted([f"op{i}" for i in range(1, 14)] + ["pipeline"])
