"""The corpus pipeline: language ID, exact dedup, near-dedup, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all that the one before it kept. All but the last return the
columns that came in; a document that the mix takes twice is two rows from there on. Ids may repeat or be null: rows
are told apart by their place in the stage's files, and only where ids tie.

Defined results: an empty stage gives an empty table of the same columns, and so does every stage after it; null ids and
sources are values like others, null texts are rejected by the first stage; further columns pass through whatever their
names. Tables that a stage needs no longer are dropped; those its result still reads go with ``common.drop_tables``, or
when the driver ends.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm import exact_dedup, langid, mixing, packing, shingles
from sparkloom.llm.common import drop_tables, give_back_heaps, materialize, passing_tables, tables, with_row_id
from sparkloom.llm.queries import tokenizer_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _keyed(docs: DataFrame) -> tuple[DataFrame, DataFrame, str]:
    """The rows with their row id; text and a key that orders rows by id, null ids last, then by place; the row id's name."""
    rows, row = with_row_id(docs)
    return rows, rows.select(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col(row).alias("row")).alias("key"), "text"), row


def _without(rows: DataFrame, dropped: DataFrame, row: str) -> DataFrame:
    """``rows``, numbered once by _keyed, less those whose keys are in ``dropped`` (column doc_id), which is written down."""
    with passing_tables() as kept:
        names = materialize(dropped.select(F.col("doc_id.row").alias(row)), "dropped", kept)
    return rows.join(names, row, "left_anti").drop(row)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents for which no language can be told (no text, no letter in it) are rejected; all others stay.

    Those without a stated ``lang`` get the one that was found.
    """
    model = langid.train(docs)
    return langid.known_language(docs, model) if model.languages else docs.where(F.col("text").cast("string").rlike(r"\p{L}"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id stays."""
    rows, keyed, row = _keyed(docs)
    before = tables()
    stays = _without(rows, exact_dedup.exact_dedup(keyed, id_col="key").where(~F.col("kept")), row)
    drop_tables({t for t in tables() - before if not t.endswith("/dropped")})
    return stays


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts with five-word shingles 0.8 similar or more the row with the smallest id stays."""
    rows, keyed, row = _keyed(docs)
    before = tables()
    found = shingles.similar_documents(keyed, id_col="key")
    stays = _without(rows, found.where(~F.col("doc_id").eqNullSafe(F.col("component_id"))), row)
    drop_tables({t for t in tables() - before if not t.endswith("/dropped")})
    return stays


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, once or twice."""
    rows, row = with_row_id(docs)
    taken = mixing.mix_sources(rows, row_col=row).where("copies > 0").select(F.col("row").alias(row), F.col("copies").alias("_copies" + row))
    times = F.explode(F.sequence(F.lit(1), F.col("_copies" + row).cast("int")))
    return rows.join(taken, row).select(*docs.columns, times.alias("_time" + row)).drop("_time" + row)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed windows. Its workers remember most of all stages', so the executors' heaps make room first."""
    give_back_heaps(spark)
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [("language_id", language), ("exact_dedup", exact), ("simhash_dedup", near), ("mix_sources", mix), ("packing", pack)]

#: No SQL: language models, SimHash components and BM25 packing are beyond it; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of the last stage. A stage's tables and its input go once its result is written."""
    docs, former = spark.read.parquet(f"{sf_dir}/documents.parquet"), set()
    for name, stage in STAGES[:-1]:
        with passing_tables() as kept:
            docs = materialize(stage(spark, docs, sf_dir), name, kept)
        drop_tables(former)
        former = kept
    return STAGES[-1][1](spark, docs, sf_dir)
