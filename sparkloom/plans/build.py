"""Whole jobs: corpus to chunks, chunks to a vector table with its manifest, and evaluation of a table."""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.tokenizer import Counter, QuarterTokenizer
from sparkloom.operators import cache as descriptions
from sparkloom.operators import chunks as chunking
from sparkloom.operators import evaluate, index, validate
from sparkloom.sources import readers, sinks

Embedder = Callable[[list[str]], np.ndarray]


def build_chunks(spark: SparkSession, *, official: str | None = None, manifest: str | None = None, staging: str | None = None, config: str | None = None, snapshot: str | None = None, exact: bool = True, tokenizer: Counter | None = None) -> DataFrame:
    """Chunks of both corpora, of exact budgets or by quarter lengths. From a snapshot, only after it verifies."""
    if snapshot:
        found = sinks.snapshot_inputs(spark, snapshot, official=official, manifest=manifest, staging=staging, config=config)
        official, manifest, staging, config = (found[k] for k in ("official", "manifest", "staging", "config"))
    parts = []
    if official:
        pages = readers.html_files(spark, official)
        parts.append(chunking.span_chunk_pages(pages, tokenizer) if exact else chunking.chunk_pages(pages))
    if manifest and staging:
        files = readers.verified_files(spark, manifest, staging, config)
        parts.append(chunking.span_chunk_markdown(files, tokenizer) if exact else chunking.chunk_markdown(files))
    if not parts:
        raise ValueError("neither pages nor a manifest with its staged files were given")
    return chunking.union_corpora(*parts) if len(parts) == 2 else parts[0].withColumn("corpus_ord", F.lit(0))


def build_index(chunks: DataFrame, path: str, *, candidate: str, embedder: Embedder, model: str, dimensions: int, groups: DataFrame | None = None, cache: DataFrame | None = None, recipe: dict[str, Any] | None = None, tokenizer: Counter | None = None, snapshot_sha: str | None = None, built_at: str = "") -> dict[str, Any]:
    """Check the chunks, then embed and write them; the manifest document. Cheap checks come before any embedding."""
    counter = tokenizer or QuarterTokenizer()
    validate.require_none(validate.duplicate_ids(chunks), "chunk ids repeat")
    validate.require_none(validate.chunk_errors(chunks), "chunks break their contract")
    validate.require_none(validate.lineage_errors(chunks, candidate), "chunks of another lineage")
    if candidate != "c0" and groups is not None:
        validate.require_none(evaluate.fixture_errors(chunks, groups), "fixtures aren't whole in any chunk")
    ids = None
    if candidate == "b567":
        if cache is None or recipe is None:
            raise ValueError("b567 needs cached descriptions and their recipe")
        chunks = descriptions.keyed(chunks, recipe)
        may = descriptions.eligible(chunks, counter)
        validate.require_none(descriptions.release_errors(may, cache), "descriptions aren't fit for release")
        ids = may.select("id")
    plan = index.embedding_plan(chunks, candidate, cache=cache, eligible_ids=ids)
    count = F.udf(counter.count, "int", useArrow=True)
    validate.require_none(validate.over_budget(plan, count=count(F.col("embedding_input"))), "embedding inputs are too long", 5)
    stored = index.metadata(chunks).select("id", "metadata")
    sinks.vectors(index.embed(plan.join(stored, "id"), embedder), path)
    row = index.manifest(chunks).first()
    document = index.manifest_document(row, model=model, dimensions=dimensions, candidate=candidate, snapshot_sha=snapshot_sha, built_at=built_at)
    inputs = index.semantic_inputs(plan)
    document["semantic_inputs_sha256"] = index.semantic_summary(inputs).first()["semantic_inputs_sha256"]
    return document


def evaluate_table(spark: SparkSession, path: str, queries: dict[str, str], groups: DataFrame, embedder: Embedder, k: int = 5) -> DataFrame:
    """Results of a suite (query texts by id, target groups) over a vector table."""
    return evaluate.run_suite(search(spark, path, queries, embedder, k), groups)


def verify_table(spark: SparkSession, path: str, queries: dict[str, str], embedder: Embedder, source_type: str | None = None, limit: float = 0.45) -> DataFrame:
    """Smoke queries without a hit near enough among the first three of the source type."""
    asked = spark.createDataFrame([(q,) for q in queries], "query_id string")
    return index.smoke_failures(search(spark, path, queries, embedder, 3, source_type), asked, limit)


def compare_bundles(a: dict[str, Any], b: dict[str, Any]) -> DataFrame:
    """(item, failure) of two readers.run_bundle: inputs, results, embedding contract, cache and semantic hash."""
    spark = a["results"].sparkSession
    whole = [("run", name) for name, x, y in (
        ("contracts", a["manifest"].get("embedding_contract"), b["manifest"].get("embedding_contract")), ("cache", a["cache_sha256"], b["cache_sha256"]),
        ("semantic_inputs", a["semantic_inputs_sha256"], b["semantic_inputs_sha256"]),
    ) if x != y]
    out = spark.createDataFrame(whole, "item string, failure string")
    out = out.unionByName(evaluate.compare_inputs(a["inputs"], b["inputs"]).withColumnRenamed("id", "item"))
    results = evaluate.compare_results(a["results"], b["results"]).select(F.concat_ws("/", "query_id", "group_index").alias("item"), "failure")
    return out.unionByName(results)


def search(spark: SparkSession, path: str, queries: dict[str, str], embedder: Embedder, k: int = 5, source_type: str | None = None) -> DataFrame:
    """Hits of query texts (by id) in a vector table: what evaluation takes. The filter goes before the search."""
    table = spark.read.parquet(path)
    if source_type:
        table = table.where(F.col("metadata.source_type") == source_type)
    vectors = embedder(list(queries.values()))
    asked = spark.createDataFrame([(q, [float(x) for x in v]) for q, v in zip(queries, vectors)], "query_id string, embedding array<double>")
    found = index.nearest(asked, table.withColumnRenamed("id", "vec_id"), k)
    told = table.select(F.col("id").alias("vec_id"), F.col("document").alias("content"), F.col("metadata.page_key").alias("page_key"), F.col("metadata.source_type").alias("source_type"))
    return found.join(told, "vec_id").select("query_id", F.col("rank").alias("position"), F.col("vec_id").alias("chunk_id"), "page_key", "content", "distance", "source_type")


class Service:
    """A vector table opened for search. ValueError where its manifest tells of another model, size or contract."""

    def __init__(self, spark: SparkSession, path: str, manifest: dict[str, Any], embedder: Embedder, *, model: str, dimensions: int, candidate: str | None = None) -> None:
        told = (manifest.get("embedding_model"), manifest.get("embedding_dim"))
        if told != (model, dimensions):
            raise ValueError(f"the table was built with {told}, not with {(model, dimensions)}")
        if candidate and (version := manifest.get("embedding_contract", {}).get("embedding_text_version")) != candidate:
            raise ValueError(f"the table holds {version}, not {candidate}")
        self.spark, self.path, self.embedder = spark, path, embedder

    def search(self, queries: dict[str, str], k: int = 5, source_type: str | None = None) -> DataFrame:
        return search(self.spark, self.path, queries, self.embedder, k, source_type)
