"""Mixing sources to target weights by systematic sampling, with DataFrame functions alone.

Method: within a source, documents are ordered by size class and then by a hash; the prefix sum of their expected
copies plus one random offset a source crosses integers, and each crossing emits the document once. Ordering by
size bounds a source's error by about its largest document.

Defined results: a null text has size 0; a null source is a source of its own, last in order; rows without an id are
hashed by their place in the files; repeated rows are sampled each on its own; an empty table gives an empty mix. Columns of
the input besides id, source and text are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.llm.common import WORD, materialize, passing_tables, row_name

SUB_BUCKETS = 4096


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def hash32(value: Column) -> Column:
    """First 32 bits of the MD5 of a string, as a long."""
    return F.conv(F.substring(F.md5(F.coalesce(value.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("long")


def size_class(size: Column) -> Column:
    """Eight classes an octave, from the leading four bits of size + 8."""
    bits = F.bin(size + 8)
    return F.length(bits) * 8 + F.conv(bits.substr(2, 3), 2, 10).cast("int")


def source_key(source: Column) -> Column:
    """Non-null key of a source; null gets one that no name has."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def source_targets(sources: DataFrame, weights: Sequence[int], share: float, max_repeat: float) -> DataFrame:
    """(skey, source, source_size) with target added. One row a source goes through the windows, never a document.

    Weights repeat along the sources in code point order, null last. Targets share ``share`` of all sizes by weight;
    none goes above ``max_repeat`` times its source's size. With sources in ascending order of capacity by weight,
    the common level is the largest (total - capacity before) / (weight from here on).
    """
    everything = Window.partitionBy(F.lit(0))
    by_name = everything.orderBy(F.col("source").asc_nulls_last())
    by_ratio = everything.orderBy("ratio", "skey")
    weighed = sources.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int")))
    capped = weighed.withColumn("capacity", F.col("source_size") * F.lit(float(max_repeat))).withColumn("ratio", F.col("capacity") / F.col("weight"))
    before = F.coalesce(F.sum("capacity").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    rest = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    total = F.sum("source_size").over(everything) * F.lit(float(share))
    leveled = capped.withColumn("level_here", (total - before) / rest)
    level = F.max("level_here").over(everything)
    return leveled.withColumn("target", F.least("capacity", F.col("weight") * level)).select("skey", "source_size", "target")


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    row_col: str | None = None,
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    max_repeat: float = 2.0,
    seed: str = "mix",
) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken, copies; with ``row_col``, that column too.

    Shuffles carry (id, hash, size) rows only; the text is read once. Ranks within a source come from counts of
    (source, size class, hash bucket) cells and a row number within a cell, so a source that holds a third of all
    rows is spread over thousands of cells.
    """
    with passing_tables() as kept:
        sized = materialize(
            docs.select(
                F.col(id_col).alias("doc_id"),
                source_key(F.col(source_col)).alias("skey"),
                word_count(F.col(text_col)).alias("size"),
                hash32(F.coalesce(F.col(id_col).cast("string"), row_name(docs))).alias("h"),
                *([F.col(row_col).alias("row")] if row_col else []),
            )
            .withColumn("cls", size_class(F.col("size")))
            .withColumn("sub", F.floor(F.col("h") / F.lit(2**32 // SUB_BUCKETS)).cast("int")),
            "sized",
            kept,
        )
    cells = sized.groupBy("skey", "cls", "sub").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    sources = cells.groupBy("skey").agg(F.sum("words").alias("source_size"), F.sum("n").alias("source_docs"))
    named = sources.withColumn("source", F.when(F.col("skey") != "", F.expr("substring(skey, 2)")))
    targets = source_targets(named, weights, share, max_repeat)
    along = Window.partitionBy("skey").orderBy("cls", "sub").rowsBetween(Window.unboundedPreceding, -1)
    placed = cells.withColumn("ahead", F.coalesce(F.sum("n").over(along), F.lit(0))).drop("n", "words").join(targets, "skey")
    within = Window.partitionBy("skey", "cls", "sub").orderBy("h", "doc_id", "size", *(["row"] if row_col else []))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = hash32(F.concat(F.lit(seed), F.col("skey"))) / F.lit(float(2**32))
    ranked = sized.join(placed, ["skey", "cls", "sub"]).withColumn("rank", F.col("ahead") + F.row_number().over(within))
    copies = (F.floor(rate * F.col("rank") + offset) - F.floor(rate * (F.col("rank") - 1) + offset)).cast("long")
    return ranked.withColumn("copies", copies).select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "copies", *(["row"] if row_col else []))


#: DuckDB form of :func:`mix_sources` over ``documents``, where every row has an id, with its default parameters.
MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, coalesce('=' || source, '') AS skey, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS h
  FROM documents),
classed AS (
  SELECT *, length(bin(size + 8)) * 8
            + ('0b' || substr(bin(size + 8), 2, 3))::BIGINT AS cls
  FROM sized),
sources AS (SELECT skey, min(source) AS source, sum(size)::BIGINT AS source_size FROM classed GROUP BY skey),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sources),
capped AS (SELECT *, source_size * 2.0::DOUBLE AS capacity, source_size * 2.0::DOUBLE / weight AS ratio FROM weighed),
leveled AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
             - coalesce(sum(capacity) OVER (ORDER BY ratio, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0::DOUBLE))
            / sum(weight) OVER (ORDER BY ratio, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level_here
  FROM capped),
targets AS (SELECT skey, source_size, least(capacity, weight * max(level_here) OVER ()) AS target FROM leveled),
ranked AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, d.skey,
         row_number() OVER (PARTITION BY d.skey ORDER BY d.cls, d.h // 1048576, d.h, d.doc_id, d.size) AS rnk
  FROM classed d JOIN targets t USING (skey)),
rated AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0::DOUBLE END AS rate,
         ('0x' || substr(md5('mix' || skey), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM ranked),
copied AS (SELECT *, (floor(rate * rnk + u) - floor(rate * (rnk - 1) + u))::BIGINT AS copies FROM rated)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM copied
"""
