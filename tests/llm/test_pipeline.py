"""The pipeline against its stages' plain versions, stage by stage."""

import pytest
from helpers import table
from test_pii import base_spans
from test_quality import brute as quality_of
from test_sigtree import brute as components_of

import __spark_entry__ as entry
import corpus_pipeline
from eventlayers.llm import toxicity
from eventlayers.llm.common import materialise

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialise(stage(spark, out[-1], SF), name))
    return out


def rows_of(frame):
    return sorted((r.doc_id, r.text) for r in frame.collect())


def test_order_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality_rules", "near_copies", "pii", "packing"]
    assert all(s.columns == stages[0].columns for s in stages[:-1])


def test_toxicity_goes(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scores = toxicity.score_toxicity(stages[0], labels)
    kept = {r.doc_id for r in scores.where("predicted = 0").collect()}
    assert {i for i, _ in rows_of(stages[1])} == kept


def test_quality_goes(stages):
    before = rows_of(stages[1])
    kept = {r[0] for r in quality_of(before) if r[-1]}
    assert rows_of(stages[2]) == [r for r in before if r[0] in kept]


def test_one_of_each_component_stays(stages):
    before = rows_of(stages[2])
    assert {i for i, _ in rows_of(stages[3])} == {c for _, _, c in components_of(before)}


def test_personal_values_go(stages):
    before, after = rows_of(stages[3]), rows_of(stages[4])
    assert [i for i, _ in before] == [i for i, _ in after]
    assert not any(base_spans(t) for _, t in after)
    assert any(base_spans(t) for _, t in before)


def test_packing_holds_every_document(spark, stages):
    assert {r.doc_id for r in stages[5].collect()} == {i for i, _ in rows_of(stages[4])}
    sizes = stages[5].groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert all(r[1] <= 1024 for r in sizes)
    run = entry.queries()["pipeline"](spark, SF)
    columns = ["doc_id", "piece", "length", "ids_crc32"]
    assert table(run.select(*columns)) == table(stages[5].select(*columns))


def test_empty_table(spark, empty):
    docs = empty.selectExpr("doc_id", "text", "lang", "'s' source", "0 n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
