"""The pipeline: stages, their decisions, odd rows."""

import pytest

import corpus_pipeline
from logweir.llm import decontaminate, quality, records, simhash
from logweir.llm.common import materialize, table
from logweir.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages(spark, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_copies", "decontaminate", "mix", "token_records"]
    docs = table(spark, SF, "documents")
    assert all(s.columns == docs.columns for s in steps[:4])
    scores = quality.quality_scores(docs, table(spark, SF, "labels")).collect()
    assert ids(steps[0]) == {r["doc_id"] for r in scores if r["predicted"]}
    near = simhash.near_copies(steps[0]).collect()
    assert ids(steps[1]) == {r["component_id"] for r in near}
    leaked = decontaminate.leaked_items(steps[1], table(spark, SF, "benchmark")).collect()
    assert leaked and ids(steps[2]) == ids(steps[1]) - {r["doc_id"] for r in leaked}
    assert ids(steps[3]) <= ids(steps[2])
    again = records.token_records(steps[3], tokenizer_path())
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, steps[4].collect()))
    assert steps[4].count() == steps[3].count()


def test_run_gives_the_last_stage(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, steps[4].collect()))


def test_odd_rows_pass_all_stages(spark):
    docs = table(spark, SF, "documents").limit(300)
    text = "Words of a plain text that is like no other one.\nIt has lines, too, and nothing in it is odd at all."
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (None, text, "en", None, 1), (5000, "", "en", "s", 0), (5001, None, "en", "s", 0)]
        + [(5002, text, "en", "s", 1)] * 2
        + [(5003, text + " more" * 60_000, "en", "s", 1)],
        docs.schema,
    )
    rows = docs.union(odd)
    for column in ("score", "size", "target", "copies", "fp", "component_id", "start", "n_tokens"):
        rows = rows.withColumn(column, rows["lang"])
    for name, stage in corpus_pipeline.STAGES:
        before = rows.columns
        rows = materialize(stage(spark, rows, SF), name)
        assert name == "token_records" or rows.columns == before
    assert rows.count() > 100


def test_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), name)
        assert docs.count() == 0
