"""Running Python parsers over DataFrames: one row in, any number out, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

Row = Mapping[str, Any]


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than the cluster has cores, over all cores; anything else as it is.

    Parsing costs far more than moving rows, and what is moved is at most a split a core. Plans that exchange rows
    already are left alone.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(cores) if 0 < splits < cores else df


def flat_map(df: DataFrame, parse: Callable[[Row], Iterable[Row]], schema: str, out_rows: int = 2000) -> DataFrame:
    """Rows that ``parse`` makes of each row. No shuffle; batches in and out are bounded."""
    spark_schema = StructType.fromDDL(schema)
    arrow = to_arrow_schema(spark_schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: list[Row] = []
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                for row in batch.slice(at, 500).to_pylist():
                    made.extend(parse(row))
                    if len(made) >= out_rows:
                        yield pa.RecordBatch.from_pylist(made, schema=arrow)
                        made = []
        yield pa.RecordBatch.from_pylist(made, schema=arrow)

    return df.mapInArrow(run, spark_schema)


def numbered(df: DataFrame, key: str, *order: str, name: str = "chunk_index") -> DataFrame:
    """0-based place within ``key`` in the given order.

    Rows are counted by (key, first order column) before they are numbered, so that a key with a great share of all
    rows is spread over as many tasks as that column has values.
    """
    first = order[0]
    lanes = df.groupBy(key, first).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(key).orderBy(first).rowsBetween(Window.unboundedPreceding, -1)
    lanes = lanes.select(F.col(key).alias("_key"), F.col(first).alias("_first"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_ahead"))
    placed = df.join(lanes, df[key].eqNullSafe(F.col("_key")) & df[first].eqNullSafe(F.col("_first")))
    own = F.row_number().over(Window.partitionBy(key, first).orderBy(*order))
    return placed.withColumn(name, (F.col("_ahead") + own - 1).cast("int")).drop("_key", "_first", "_ahead")


def running_bytes(df: DataFrame, key: str, size: str, *order: str, name: str = "base_offset") -> DataFrame:
    """Sum of ``size`` over the rows of ``key`` that come before each row; summed by (key, first order column) first, as ``numbered`` counts."""
    first = order[0]
    before = Window.partitionBy("_key").orderBy("_first").rowsBetween(Window.unboundedPreceding, -1)
    lanes = df.groupBy(F.col(key).alias("_key"), F.col(first).alias("_first")).agg(F.sum(size).alias("_bytes"))
    lanes = lanes.select("_key", "_first", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_ahead"))
    placed = df.join(lanes, df[key].eqNullSafe(F.col("_key")) & df[first].eqNullSafe(F.col("_first")))
    within = Window.partitionBy(key, first).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn(name, (F.col("_ahead") + F.coalesce(F.sum(size).over(within), F.lit(0))).cast("long")).drop("_key", "_first", "_ahead")


def carry_forward(df: DataFrame, column: str, partition: list[str], order: list[str], name: str | None = None) -> DataFrame:
    """Last value seen, so far, that is neither null nor empty.

    The last value of each (partition, first order column) is carried over those first, so that a partition with a
    great share of all rows is spread over as many tasks as that column has values.
    """
    keys = [*partition, order[0]]
    value = F.when(F.col(column) != "", F.col(column))
    last = lambda of: F.last(of, ignorenulls=True)
    place = F.struct(*order)
    lanes = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(value, F.when(value.isNotNull(), place)).alias("_held"))
    names = [f"_k{i}" for i in range(len(keys))]
    before = Window.partitionBy(*names[:-1]).orderBy(names[-1]).rowsBetween(Window.unboundedPreceding, -1)
    lanes = lanes.select(*names, last(F.col("_held")).over(before).alias("_before"))
    met = df.join(lanes, [df[k].eqNullSafe(F.col(n)) for k, n in zip(keys, names)])
    seen = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return met.withColumn(name or column, F.coalesce(last(value).over(seen), F.col("_before"))).drop(*names, "_before")


def digest_in_order(df: DataFrame, text: str, *order: str, between: str = "", before: str = "", after: str = "", chunk: int = 1 << 20) -> str:
    """SHA-256 of all rows' texts in order, joined: one sequence by definition, so it streams through the driver.

    Rows are range-sorted by all executors, which hand over pieces of about ``chunk`` characters; the driver holds one
    partition's pieces at a time and never a list of all rows.
    """
    import hashlib

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for value in batch.column(0).to_pylist():
                held.append(value)
                size += len(value)
                if size >= chunk:
                    yield pa.RecordBatch.from_pydict({"piece": [between.join(held)]})
                    held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pydict({"piece": [between.join(held)]})

    digest, first = hashlib.sha256(before.encode()), True
    for row in df.orderBy(*order).select(text).mapInArrow(pieces, "piece string").toLocalIterator():
        digest.update(((between if not first else "") + row["piece"]).encode())
        first = False
    digest.update(after.encode())
    return digest.hexdigest()


def contiguity(df: DataFrame, key: str = "page_key", index: str = "chunk_index") -> DataFrame:
    """Keys whose indices aren't exactly 0 to n - 1."""
    found = df.groupBy(key).agg(F.min(index).alias("lowest"), F.max(index).alias("highest"), F.count(index).alias("n"), F.count_distinct(index).alias("distinct_n"))
    return found.where((F.col("lowest") != 0) | (F.col("highest") != F.col("n") - 1) | (F.col("distinct_n") != F.col("n")))
