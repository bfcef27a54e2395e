"""Generated descriptions: keys, an append-only store, usages, missing keys and release rules."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkloom import schemas
from sparkloom.functions import columns as C
from sparkloom.functions import identifiers as I
from sparkloom.functions.tokenizer import Counter
from sparkloom.operators.rows import Row, flat_map

OK, FALLBACK = "ok", "raw_fallback"
MOST_FALLBACK = 0.10
ATTEMPTS = 3
COMPACT = ",:"[0], ",:"[1]


def canonical_json(value: Any) -> str:
    """Sorted keys, compact, unescaped."""
    return json.dumps(value, separators=COMPACT, ensure_ascii=False, sort_keys=True)


def contract(*, prompt_version: str, system_prompt: str, user_prompt_template: str, model: str, temperature: float = 0, max_output_tokens: int = 300, extractor: str = "1", validator: str = "1") -> dict[str, Any]:
    """The recipe of a description; all of it takes part in the hash, rules included."""
    tokens = I.MOST_DESCRIPTION_TOKENS
    rules = {
        "max_wordpieces": tokens, "sentence_range": [1, 3], "forbid_xml_blocks": True, "forbid_fenced_code": True, "introduced_identifier_policing": "case_sensitive",
        "mandatory_semantics": "topic_in_first_sentence root_element_when_present discriminating_type_when_present material_prefix".split(),
    }
    return {
        "max_output_tokens": max_output_tokens, "temperature": temperature, "requested_model_id": model, "prompt_version": prompt_version, "validator_schema": rules, "validator_version": validator,
        "system_prompt": system_prompt, "user_prompt_template": user_prompt_template, "max_description_wordpieces": tokens, "identifier_extractor_version": extractor,
    }


def contract_sha(recipe: dict[str, Any]) -> str:
    return hashlib.sha256(canonical_json(recipe).encode()).hexdigest()


def with_identifiers(chunks: DataFrame) -> DataFrame:
    """Structural identifiers of each chunk's content."""
    return chunks.withColumn("identifiers", F.udf(I.identifiers, "array<string>", useArrow=True)("content"))


def keyed(chunks: DataFrame, recipe: dict[str, Any] | str) -> DataFrame:
    """Adds generation_input_sha256 and cache_key. Where a chunk is doesn't matter: equal content shares a description."""
    sha = recipe if isinstance(recipe, str) else contract_sha(recipe)
    own = chunks if "identifiers" in chunks.columns else with_identifiers(chunks)
    text = C.generation_input_json(*map(F.col, "content title section_heading breadcrumb source_type identifiers".split()))
    return own.withColumn("generation_input_sha256", C.sha256(text)).withColumn("cache_key", C.cache_key(F.col("generation_input_sha256"), F.lit(sha)))


def eligible(chunks: DataFrame, tokenizer: Counter) -> DataFrame:
    """Chunks that a description may stand for; the parsers run on companion rows only."""
    judge = F.udf(lambda content: I.is_eligible(I.COMPANION, content or "", tokenizer), "boolean", useArrow=True)
    return chunks.where(F.col("source_type") == I.COMPANION).where(judge("content"))


def latest(records: DataFrame, order: Column) -> DataFrame:
    """Last record of each key by ``order``, as a reduction with map-side combining."""
    names = [c for c in records.columns if c != "cache_key"]
    return records.groupBy("cache_key").agg(F.max_by(F.struct(*names), order).alias("r")).select("cache_key", *[F.col("r")[n].alias(n) for n in names])


def missing(keyed_chunks: DataFrame, cache: DataFrame) -> DataFrame:
    """Keys that the cache lacks, each once, with a chunk that stands for it (the smallest id)."""
    wanted = keyed_chunks.join(cache.select("cache_key"), "cache_key", "left_anti")
    return wanted.groupBy("cache_key").agg(F.min_by(F.struct(*[c for c in keyed_chunks.columns if c != "cache_key"]), F.col("id")).alias("chunk"))


def usages(keyed_chunks: DataFrame) -> DataFrame:
    """Where each key is used, in order: a list a key, for reviewers. Rules go by counts (release_errors), not by it."""
    use = F.struct("id", F.coalesce("source_record_id", F.lit("")).alias("record"), F.coalesce("source_start_byte", F.lit(0)).alias("start"), F.coalesce("source_end_byte", F.lit(0)).alias("end"))
    return keyed_chunks.groupBy("cache_key").agg(F.array_sort(F.collect_list(use)).alias("usages"), F.count(F.lit(1)).alias("n"))


def immutability_errors(old: DataFrame, new: DataFrame) -> DataFrame:
    """Records of the old cache that the new one has lost or changed."""
    names = [c for c in old.columns if c != "cache_key"]
    both = old.select("cache_key", F.struct(*names).alias("was")).join(new.select("cache_key", F.struct(*names).alias("now"), F.lit(True).alias("there")), "cache_key", "left")
    return both.select("cache_key", F.when(F.col("there").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("now")), "modified").alias("error")).where("error IS NOT NULL")


def append_errors(cache: DataFrame, records: DataFrame) -> DataFrame:
    """Why records can't be appended: a field is missing, the status is unknown, or the key exists."""
    blank = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(f"{c} is missing")) for c in records.columns]))
    own = F.concat(blank, F.when(~F.col("status").isin(OK, FALLBACK), F.array(F.lit("unknown status"))).otherwise(F.array().cast("array<string>")))
    found = records.select("cache_key", F.explode(own).alias("error"))
    known = records.join(cache.select("cache_key"), "cache_key", "left_semi").select("cache_key", F.lit("key exists").alias("error"))
    twice = records.groupBy("cache_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cache_key", F.lit("key given twice").alias("error"))
    return found.unionByName(known).unionByName(twice)


def generate(missing_keys: DataFrame, recipe: dict[str, Any], call: Callable[[str, str, str], tuple[str, str]], tokenizer: Counter, attempts: int = ATTEMPTS) -> DataFrame:
    """Cache records for missing keys, from an injected ``call(system, user, model) -> (model, text)``.

    A try fails if another model answers or the text breaks a rule; after the last one the record is a fallback. The
    prompt template may name any of raw_document, topic, section_heading and breadcrumb.
    """
    sha = contract_sha(recipe)

    def parse(row: Row) -> Iterator[Row]:
        chunk = row["chunk"]
        document, topic = chunk["content"], chunk["title"] or ""
        prompt = recipe["user_prompt_template"].format(raw_document=document, topic=topic, section_heading=chunk["section_heading"] or "", breadcrumb=chunk["breadcrumb"] or "")
        about, text = I.facts(document), None
        for _ in range(attempts):
            model, said = call(recipe["system_prompt"], prompt, recipe["requested_model_id"])
            if model == recipe["requested_model_id"] and not I.description_errors(said, document=document, known=chunk["identifiers"], topic=topic, about=about, tokenizer=tokenizer):
                text = said
                break
        yield {
            "cache_key": row["cache_key"], "status": OK if text else FALLBACK, "description": text or "", "identifiers": chunk["identifiers"], "prompt_version": recipe["prompt_version"],
            "requested_model_id": recipe["requested_model_id"], "returned_model_id": recipe["requested_model_id"] if text else "", "generator_contract_sha256": sha,
            "raw_content_sha256": hashlib.sha256(document.encode()).hexdigest(), "generation_input_sha256": chunk["generation_input_sha256"],
        }

    return flat_map(missing_keys, parse, schemas.CACHE_RECORD)


def release_errors(keyed_chunks: DataFrame, cache: DataFrame, most: float = MOST_FALLBACK) -> DataFrame:
    """Missing keys, each with a chunk that needs it; and too great a share of usages that fall back."""
    known = cache.select("cache_key", "status")
    used = keyed_chunks.groupBy("cache_key").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).join(known, "cache_key", "left")
    lost = used.where("status IS NULL").select(F.concat(F.lit("missing "), "cache_key", F.lit(" for "), "first", F.when(F.col("n") > 1, F.concat(F.lit(" and "), (F.col("n") - 1).cast("string"), F.lit(" more"))).otherwise("")).alias("error"))
    share = used.agg(F.sum("n").alias("n"), F.sum(F.when(F.col("status") == FALLBACK, F.col("n")).otherwise(0)).alias("fallback"))
    heavy = share.where(F.col("fallback") > F.lit(most) * F.col("n")).select(F.concat(F.lit("fallback "), "fallback", F.lit(" of "), "n").alias("error"))
    return lost.unionByName(heavy)
