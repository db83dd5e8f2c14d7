"""The corpus pipeline: five stages over documents, each by one of the corpus operators.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; its rows are
written to the shared folder and read again as the next one's. All but the last return the
columns of documents.

1. quality         documents that the classifier rejects go
2. near_copies     one document of each SimHash component stays
3. decontaminate   documents that hold a benchmark item go
4. mix             documents are repeated or left out to meet the sources' token targets
5. token_records   token ids go to binary files; a row for each record read back

Nulls, empty and very long texts, repeated rows and empty tables have the results that the
operators define; further columns of documents pass through the first four stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweir.llm import decontaminate, mixing, quality, records, simhash
from logweir.llm.common import materialize, prepare, table
from logweir.llm.queries import tokenizer_path

#: A trained network and a tokenizer are part of the result: no SQL can express it.
ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return simhash.drop_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix_documents(docs)


def write_records(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return records.token_records(docs, tokenizer_path())


STAGES = [
    ("quality", keep_good),
    ("near_copies", drop_near_copies),
    ("decontaminate", drop_leaks),
    ("mix", mix),
    ("token_records", write_records),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
