"""A training-data pipeline over ``documents``: five stages, each one corpus operator.

Every stage gets what the one before it kept, as Parquet in the shared checkpoint folder,
and all but the last return the columns of ``documents``.

1. ``language``: documents in which no language is found go (null texts, no letters).
2. ``lines``: repeated chunks of lines are cut from texts; no document goes.
3. ``near_duplicates``: of each group of near-duplicates one document stays.
4. ``benchmark``: passages of the benchmark are cut; mostly contaminated documents go.
5. ``tokens``: the ids of every text, and the check that they decode to the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attestor.llm import bpe, dart, decontam, langid, line_dedup
from attestor.session import materialize


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dart.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bpe.token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"),
                             public_tokenizers.PATTERN)


STAGES = [("language", language), ("lines", lines), ("near_duplicates", near_duplicates),
          ("benchmark", benchmark), ("tokens", tokens)]

#: SQL can express neither the classifier nor the signatures; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
