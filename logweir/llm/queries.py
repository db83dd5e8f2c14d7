"""The corpus operators as named queries over the given tables."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from logweir.llm import (
    decontaminate,
    extract,
    infill,
    language,
    lines,
    mixing,
    periodic,
    quality,
    records,
    repeats,
    simhash,
    vectors,
    wordbpe,
)
from logweir.llm.common import table

#: Environment variables with a tokenizers file; else the public package's file is taken.
TOKENIZER = "LOGWEIR_TOKENIZER"
WORD_TOKENIZER = "LOGWEIR_WORD_TOKENIZER"


def tokenizer_path(variable: str = TOKENIZER, name: str = "byte_bpe_50k.json") -> str:
    if variable in os.environ:
        return os.environ[variable]
    import public_tokenizers

    return public_tokenizers.path(name)


def word_tokenizer_path() -> str:
    return tokenizer_path(WORD_TOKENIZER, "word_bpe_49k.json")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.main_texts(table(spark, sf_dir, "pages"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.scores(table(spark, sf_dir, "documents"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(table(spark, sf_dir, "documents"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_digests(table(spark, sf_dir, "documents"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lines.drop_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_dropped")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(table(spark, sf_dir, "documents"), tokenizer_path())


def op11_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordbpe.digests(table(spark, sf_dir, "documents"), word_tokenizer_path())


def op12_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.with_planted_runs(table(spark, sf_dir, "documents")))


def op13_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digests(table(spark, sf_dir, "documents"))


OPERATORS = (
    op1_quality,
    op2_extract,
    op3_language,
    op4_mixing,
    op5_repeats,
    op6_decontaminate,
    op7_lines,
    op8_simhash,
    op9_vectors,
    op10_token_records,
    op11_transducer,
    op12_periodic,
    op13_infill,
)


def catalog() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_catalog() -> dict[str, str]:
    return {"op7_lines": lines.SQL, "op13_infill": infill.SQL}
