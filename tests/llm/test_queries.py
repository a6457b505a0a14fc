"""The registered queries and the pipeline."""

import os
from collections import Counter

import pytest

from halyard.llm import decontaminate, jaccard, mixing, quality, queries, secrets

from .conftest import SCHEMA

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables aren't here")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(name, against_oracle):
    assert against_oracle(queries.QUERIES[name], queries.ORACLES[name], SF)


@pytest.mark.parametrize("name", sorted({*queries.QUERIES} - {*queries.ORACLES}))
def test_query_has_a_row_for_each_input(name, spark):
    table = "pages" if "url" in name else "documents"
    assert queries.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{table}.parquet").count()


@pytest.mark.parametrize("name", ["op7_licenses", "op8_urls", "op9_mixing", "op10_secrets"])
def test_native_plans_have_no_python(name, spark):
    plan = queries.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_pipeline_stages_take_effect(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    good = {r.doc_id for r in quality.scored(docs, spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 1").collect()}
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        docs = corpus_pipeline.written(stage(spark, before, SF))
        ids = Counter(r.doc_id for r in docs.collect())
        if k == 0:
            assert {*ids} == good
        elif k == 1:
            found = jaccard.joined(before, k=5, percent=80).collect()
            assert {*ids} == {r.component_id for r in found} and max(ids.values()) == 1
        elif k == 2:
            bad = {r.doc_id for r in decontaminate.report(before, spark.read.parquet(f"{SF}/benchmark.parquet")).where("contaminated").collect()}
            assert {*ids} == {r.doc_id for r in before.collect()} - bad
        elif k == 3:
            assert secrets.digest(docs).where("n_assign + n_access + n_hex > 0").count() == 0 and docs.count() == before.count()
        else:
            assert ids == Counter({r.doc_id: r.copies for r in mixing.copies(before).collect() if r.copies})
        assert docs.columns == (columns if k < 4 else [*columns, "mix_copy"])
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, docs.collect()))


def test_pipeline_stages_on_odd_tables(spark, odd, none):
    import corpus_pipeline

    base = ["doc_id", "text", "lang", "source", "n_chars"]
    for table in (odd, none):
        docs = table
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            docs = corpus_pipeline.written(stage(spark, docs.select(*[f"`{c}`" for c in table.columns]), SF))
            assert docs.columns[: len(table.columns)] == table.columns and {*base} <= {*docs.columns}
    assert SCHEMA
