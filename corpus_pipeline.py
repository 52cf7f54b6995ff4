"""Cleaning a corpus step by step: each stage gets the table that the one before it wrote."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmill.llm import decontamination, encoding, language, ngram_join, secrets
from flowmill.llm.batches import bound_batches
from flowmill.session import shared_dir


#: Near duplicates: words of a shingle, and the least similarity, 100 * common >= 80 * union.
SHINGLE, THRESHOLD = 5, (80, 100)


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that was learned from the labelled ones; texts without a letter go."""
    learned_from = docs.filter(~language.held_out(F.col("doc_id")))
    return language.known_language(docs, language.fit(learned_from))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: linked by shingles of five words from a similarity of 0.8 on."""
    return ngram_join.one_per_component(docs, size=SHINGLE, threshold=THRESHOLD)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return decontamination.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of every credential; ``n_chars`` follows the text."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of every text, checked by decoding them again."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    return encoding.round_trip(docs, path, keep=["doc_id", "lang", "source"], with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    """The stage, with its texts handed to Python workers a few megabytes at a time."""

    @functools.wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bound_batches(spark)
        return stage(spark, docs, sf_dir)

    return run


STAGES: list[tuple[str, Stage]] = [
    ("language", in_small_batches(known_language)),
    ("near_duplicates", in_small_batches(one_of_each)),
    ("decontamination", in_small_batches(without_benchmark)),
    ("secrets", in_small_batches(without_secrets)),
    ("encode", in_small_batches(encode)),
]

#: Learned models and byte-pair merges are beyond SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in a row over ``documents``, each result written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
