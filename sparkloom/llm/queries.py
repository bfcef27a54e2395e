"""The queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkloom.llm import exact_dedup, html_extract, langid, line_dedup, media, mixing, packing, sharding, simhash, tokencount

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.count_tokens(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(_table(spark, sf_dir, "pages"))


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(_table(spark, sf_dir, "documents"))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return langid.identify_languages(docs, langid.train(docs))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract_pages(_table(spark, sf_dir, "pages"))


def queries() -> dict[str, Query]:
    from corpus_pipeline import run

    own = (op1_mix_sources, op2_token_counts, op3_shards, op4_exact_dedup, op5_simhash, op6_line_dedup, op7_media, op8_language, op9_packing, op10_html_text)
    return {q.__name__: q for q in own} | {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": mixing.MIX_SQL, "op4_exact_dedup": exact_dedup.DEDUP_SQL, "op6_line_dedup": line_dedup.LINE_SQL}
