"""One query per operator, over its whole table, and the DuckDB SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmill.llm import (
    decontamination,
    encoding,
    language,
    license_scan,
    main_text,
    nearest,
    ngram_join,
    prefix_trie,
    secrets,
    spelling,
    token_counts,
    url_filter,
    warc,
)

BYTE_PAIRS = "byte_bpe_50k.json"


#: The test that stands for the SQL of a query that SQL cannot express.
TESTED_BY = {
    "op1_secret_scan": "tests/llm/test_texts.py::test_base_spans_of_odd_texts",
    "op2_token_counts": "tests/llm/test_tokens.py::test_counts_and_round_trip",
    "op4_byte_pairs": "tests/llm/test_tokens.py::test_tokens_are_the_librarys",
    "op5_main_text": "tests/llm/test_texts.py::test_main_text",
    "op6_language": "tests/llm/test_texts.py::test_language_is_learned_and_held_out",
    "pipeline": "tests/llm/test_tokens.py::test_pipeline",
}

TOP_SQL = """
    WITH v AS (
      SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e, row_number() OVER () AS r
      FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    pairs AS (
      SELECT a.r, a.vec_id AS query_id, b.vec_id, b.r AS other,
        list_inner_product(a.e::DOUBLE[], b.e::DOUBLE[])::BIGINT AS score
      FROM v a JOIN v b ON a.r <> b.r AND len(a.e) = len(b.e) WHERE a.vec_id % 20 = 0)
    SELECT query_id, row_number() OVER w AS rank, vec_id, score FROM pairs
    WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id, other)
    QUALIFY row_number() OVER w <= 20"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_PAIRS))


def url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(_table(spark, sf_dir, "pages"), keep=["page_id"])


def byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encoding.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_PAIRS))


def page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.main_text(_table(spark, sf_dir, "pages"))


def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", language.held_out(F.col("doc_id")))
    model = language.fit(docs.filter(~F.col("held_out")))
    return language.predict(docs, model, keep=["doc_id", "held_out"])


def benchmark_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.find(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hits", F.lit(0), lambda total, x: total + x["to"] - x["from"]).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_components(_table(spark, sf_dir, "documents"))


def top_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(_table(spark, sf_dir, "documents"))


def spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(_table(spark, sf_dir, "documents"), slips=True)


def warc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(_table(spark, sf_dir, "conversations"), shared=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_secret_scan": secret_scan,
        "op2_token_counts": token_count,
        "op3_url_filter": url_rules,
        "op4_byte_pairs": byte_pairs,
        "op5_main_text": page_text,
        "op6_language": languages,
        "op7_ngram_join": near_duplicates,
        "op8_benchmark_hits": benchmark_hits,
        "op9_top_neighbours": top_neighbours,
        "op10_license_scan": licenses,
        "op11_spelling_variants": spelling_variants,
        "op12_warc_records": warc_records,
        "op13_conversation_trie": conversation_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_url_filter": url_filter.oracle(),
        "op7_ngram_join": ngram_join.oracle(),
        "op8_benchmark_hits": decontamination.oracle(),
        "op9_top_neighbours": TOP_SQL,
        "op10_license_scan": license_scan.oracle(),
        "op11_spelling_variants": spelling.oracle(),
        "op12_warc_records": warc.oracle(),
        "op13_conversation_trie": prefix_trie.oracle(),
    }
