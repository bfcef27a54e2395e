"""Exact deduplication against a persistent digest index.

The index is a table bucketed and sorted by digest. New rows are reduced to one candidate a digest, an anti-join
drops the digests that the index already holds, the rest is appended. The index side of that sort-merge join needs no
exchange. Appended batches leave a file each in a bucket; ``compact`` makes them one sorted file again, with as many
buckets as the index has grown to need.

Defined results: a null text counts as empty; white space runs (ASCII) are one space each; of equal texts the row
with the smallest id stays, and of those with equal ids the first in the input, so that repeated rows come down to one;
a null id never wins over another; a digest already in the index keeps its first owner, and no row of the batch stays
for it; an empty table changes nothing. Extra columns are ignored.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.llm.common import SPACE, attach, drop_tables, materialize, new_table, passing_tables, salt_of

#: Digests of a bucket, about: with ids some 150 MB.
BUCKET_ROWS = 4_000_000
LEAST_BUCKETS = 16


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with white space runs made single spaces, lowercase hex."""
    return F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " "), 256)


def buckets_for(rows: int) -> int:
    return max(LEAST_BUCKETS, -(-rows // BUCKET_ROWS))


class DigestIndex:
    """Digests seen so far, with the id that stays for each.

    Appends go by whole batches under one writer; a batch that fails leaves no rows behind, since Spark commits a
    job's files at its end. Below ``path`` are a generation's files and a note of its number and buckets, so that an
    index is opened again as it was made, whatever ``buckets`` says.
    """

    def __init__(self, spark: SparkSession, path: str, *, buckets: int = LEAST_BUCKETS, id_type: str = "bigint") -> None:
        self.spark, self.path, self.id_type = spark, path, id_type
        self._folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._files = self._folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self._note = spark._jvm.org.apache.hadoop.fs.Path(path, "_current")
        if self._files.exists(self._note):
            stream = self._files.open(self._note)
            self.generation, self.buckets = stream.readInt(), stream.readInt()
            stream.close()
        else:
            self._name(0, buckets)
        self._register()

    def _name(self, generation: int, buckets: int) -> None:
        stream = self._files.create(self._note, True)
        stream.writeInt(generation)
        stream.writeInt(buckets)
        stream.close()
        self.generation, self.buckets = generation, buckets

    def _register(self) -> None:
        self.location = f"{self.path}/{self.generation}"
        self.table = "digest_index_" + uuid.uuid5(uuid.NAMESPACE_URL, self.location).hex
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, keep_id {self.id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.location}'"
        )

    def _append(self, rows: DataFrame) -> None:
        (
            rows.select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.mode("append")
            .format("parquet")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.location)
            .saveAsTable(self.table)
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def missing(self, candidates: DataFrame) -> DataFrame:
        """Those candidates (digest, ...) whose digest the index doesn't hold."""
        return candidates.join(self.rows().hint("merge"), "digest", "left_anti")

    def add(self, candidates: DataFrame) -> None:
        """candidates: one row a digest (digest, keep_id). Digests that the index holds are left out, others appended."""
        with passing_tables():
            self._append(materialize(self.missing(candidates), "new"))

    def compact(self) -> None:
        """One sorted file a bucket, and buckets by the index's size; the former files go once the new ones count."""
        rows, former = self.rows(), (self.table, self.generation)
        self.generation, self.buckets = self.generation + 1, buckets_for(rows.count())
        self._register()
        self._append(rows)
        self._name(self.generation, self.buckets)
        self.spark.sql(f"DROP TABLE {former[0]}")
        self._files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{former[1]}"), True)

    def close(self) -> None:
        """Take the table out of the catalog; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.table}")

    def drop(self) -> None:
        self.close()
        self._files.delete(self._folder, True)


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row an input row: doc_id, keep_id, group_size, kept, text_sha256. group_size counts this batch's equal rows.

    The text is read once and leaves its task as a 32-byte digest. Sizes and first rows are gathered a (digest, salt)
    first, so a text that a third of all rows share costs no task more than a few rows. Without ``index`` a new one is
    made for the call and dropped at its end.
    """
    spark = docs.sparkSession
    id_type = docs.select(F.col(id_col)).schema[0].dataType.simpleString()
    with passing_tables() as kept:
        source = docs.select(F.col(id_col).alias("doc_id"), F.unhex(text_digest(F.col(text_col))).alias("digest"), F.monotonically_increasing_id().alias("row"))
        digests = materialize(source, "digests", kept)  # written once: from here on a row's number is a fact
        first = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("keep_id"), F.col("row").alias("keep_row"))
        parts = digests.groupBy("digest", salt_of(F.col("row")).alias("_salt")).agg(F.min(first).alias("first"), F.count(F.lit(1)).alias("n"))
        groups = materialize(parts.groupBy("digest").agg(F.min("first").alias("first"), F.sum("n").alias("group_size")).select("digest", "first.keep_id", "first.keep_row", "group_size"), "groups", kept)
        own = index is None
        size = groups.count()
        index = index or DigestIndex(spark, new_table(spark, "index"), buckets=buckets_for(size), id_type=id_type)
        new = materialize(index.missing(groups), "new", kept)
        owners = new
        if not own and new.count() < size:
            old = groups.join(new.select("digest"), "digest", "left_anti").select("digest", "group_size").join(index.rows().hint("merge"), "digest")
            owners = materialize(new.unionByName(old.select("digest", "keep_id", F.lit(None).cast("long").alias("keep_row"), "group_size")), "owners", kept)
        index._append(new)
        if own:
            index.drop()
    found = attach(digests, owners, ["digest"], "row")
    stays = F.coalesce(F.col("row") == F.col("keep_row"), F.lit(False))
    return found.select("doc_id", "keep_id", "group_size", stays.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


DEDUP_SQL = r"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, (count(*) OVER same)::BIGINT AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW same AS (PARTITION BY text_sha256)
"""
