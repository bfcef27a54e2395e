"""Contract checks on chunks, as rows of errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom.functions import columns as C
from sparkloom.functions.markdown import has_raw_component
from sparkloom.operators.chunks import BLANK_PROVENANCE, COMPANION, OFFICIAL
from sparkloom.operators.rows import contiguity

REAL = tuple(BLANK_PROVENANCE)
COUNTS = ("source_start_byte", "source_end_byte", "embedding_token_count", "content_token_count", "source_token_count")


def _errors(checks: list[tuple[Column, str]]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(text)) for bad, text in checks]))


def raw_component(content: Column) -> Column:
    """Cheap native test first; the parser runs only where a component tag stands at all."""
    parsed = F.udf(has_raw_component, "boolean", useArrow=True)
    return F.when(content.contains("Component"), parsed(content)).otherwise(F.lit(False))


def chunk_errors(chunks: DataFrame, *, spans: bool | None = None, markup: bool = True) -> DataFrame:
    """(id, error) of every broken rule; then pages whose indices have gaps. Empty means fit for release.

    ``spans`` adds the rules of exact-budget chunks (default: if the columns are there).
    """
    spans = "source_record_id" in chunks.columns if spans is None else spans
    companion = F.col("source_type") == COMPANION
    official = F.col("source_type") == OFFICIAL
    empty = lambda c: F.coalesce(C.strip(F.col(c)), F.lit("")) == ""
    checks = [(empty(c), f"{c} is empty") for c in ("id", "page_key", "content")]
    checks.append((F.col("chunk_index").isNull(), "chunk_index is missing"))
    checks += [(companion & empty(c), f"companion chunk without {c}") for c in REAL]
    checks += [(official & ~F.col(c).eqNullSafe(F.lit("")), f"official chunk with {c}") for c in REAL]
    if markup:
        checks.append((companion & raw_component(F.col("content")), "companion chunk with a raw component"))
    if spans:
        has = F.col("source_record_id").isNotNull()
        checks += [(has & (F.col(c).isNull() | (F.col(c) < 0)), f"{c} isn't a count") for c in COUNTS]
        checks.append((has & (F.col("source_end_byte") < F.col("source_start_byte")), "span ends before it starts"))
        checks.append((F.col("source_record_id") == "", "source_record_id is empty"))
        checks += [(has & F.col(c).isNull(), f"{c} is missing") for c in ("synthetic_wrapper_metadata", "s6_header")]
    rows = chunks.select("id", F.explode(_errors(checks)).alias("error"))
    gaps = contiguity(chunks.where(F.col("chunk_index").isNotNull() & (F.col("page_key") != ""))).select(F.col("page_key").alias("id"), F.lit("page with gaps in chunk_index").alias("error"))
    return rows.unionByName(gaps)


def duplicate_ids(chunks: DataFrame) -> DataFrame:
    return chunks.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def lineage_errors(chunks: DataFrame, candidate: str) -> DataFrame:
    """One row if the chunks are of the wrong lineage for ``candidate``: c0 has no spans, all others must."""
    has = F.count_if(F.col("source_record_id").isNotNull()) if "source_record_id" in chunks.columns else F.lit(0).cast("long")
    counted = chunks.agg(has.alias("with_spans"), F.count(F.lit(1)).alias("n"))
    wrong = F.col("with_spans") > 0 if candidate == "c0" else F.col("with_spans") < F.col("n")
    return counted.where(wrong).select(F.lit(candidate).alias("candidate"), "with_spans", "n")


def over_budget(plan: DataFrame, budget: int = 254, count: Column | None = None) -> DataFrame:
    """Embedding inputs that are too long."""
    tokens = C.wordpiece_count(F.col("embedding_input")) if count is None else count
    return plan.select("id", tokens.alias("tokens")).where(F.col("tokens") > budget)


def require_none(errors: DataFrame, what: str, shown: int = 10) -> None:
    """Raise ValueError with a few of the rows if there are any."""
    found = errors.limit(shown).collect()
    if found:
        raise ValueError(f"{what}: " + "; ".join(", ".join(map(str, r)) for r in found))
