"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import os
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words in every contract of this subpackage.
SPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Parts of a hot key: a key with a third of all rows is about a 768th of them a task. Keys of few rows cost no more for it.
SALTS = 256

_own_dir: str | None = None
#: Tables written by this driver and not yet dropped; sessions to drop them with.
_tables: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder that every executor can read: ``spark.checkpoint.dir``. Only a local master has one of its own without it."""
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"spark.checkpoint.dir is unset: executors of {master} need a folder that all of them can read")
    if _own_dir is None:
        _own_dir = tempfile.mkdtemp(prefix="sparkloom-shared-")
        atexit.register(shutil.rmtree, _own_dir, ignore_errors=True)
    return _own_dir


def new_table(spark: SparkSession, name: str) -> str:
    """Path of a table below the shared folder, noted so that it can be dropped."""
    path = f"{shared_dir(spark)}/tables/{uuid.uuid4().hex}/{name}"
    _tables[path] = spark
    return path


def materialize(df: DataFrame, name: str, kept: set[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends there and a lost executor costs no recomputation.

    ``kept``, of ``passing_tables``, gets the table's path.
    """
    path = new_table(df.sparkSession, name)
    df.write.parquet(path)
    if kept is not None:
        kept.add(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_tables(paths: Iterable[str]) -> None:
    """Delete tables of ``new_table`` with their folders."""
    for path in paths:
        spark = _tables.pop(path, None)
        if spark is not None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


@atexit.register
def _drop_at_exit() -> None:
    """What is left at the driver's end. A result that is still read later must be written by then."""
    for path in list(_tables):
        if path.startswith(("/", "file:")):
            shutil.rmtree(os.path.dirname(re.sub(r"^file:/*", "/", path)), ignore_errors=True)
        else:
            try:
                drop_tables([path])
            except Exception:  # noqa: BLE001 - the session may be gone; its tables then stay
                return


def tables() -> set[str]:
    """Paths of the tables that this driver has written and not dropped."""
    return set(_tables)


@contextmanager
def passing_tables() -> Iterator[set[str]]:
    """What is materialised inside is dropped at the end, but for the paths that are added to the set given."""
    before, kept = tables(), set()
    try:
        yield kept
    finally:
        drop_tables(tables() - before - kept)


def byte_length(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def salt_of(row_id: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(row_id.cast("string"), F.lit("salt")), F.lit(salts)).cast("int")


def attach(rows: DataFrame, lookup: DataFrame, keys: list[str], row_id: str) -> DataFrame:
    """Left join of ``rows`` with ``lookup`` (one row a key) where a single key may own a third of all rows.

    The (key, salt) pairs that occur are joined with ``lookup`` first, at most SALTS of them a key; rows then meet
    their own pair, so that no task gets more than a SALTS-th of the largest key.
    """
    salted = rows.withColumn("_salt", salt_of(F.col(row_id)))
    pairs = salted.select(*keys, "_salt").distinct().join(lookup, keys, "inner")
    return salted.join(pairs, [*keys, "_salt"], "left").drop("_salt")


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than the cluster has cores, over all cores; anything else as it is.

    Parsing costs far more than moving rows, and what is moved is at most a split a core. Plans that exchange rows
    already are left alone.
    """
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    cores, splits = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    return df.repartition(cores) if 0 < splits < cores else df


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """Batches cut to so many rows, without copying: what is made of them in Python stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def with_row_id(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with a string that names each row (file and place in it), and that column's name.

    Unlike a generated number it doesn't depend on how a scan is split, so two scans agree even if executors were
    lost between them. What isn't a plain file scan is written out first.
    """
    name = "_row"
    while name in docs.columns:
        name += "_"
    row_id = F.concat_ws(":", "_metadata.file_path", F.col("_metadata.row_index").cast("string")).alias(name)
    try:
        return docs.select("*", row_id), name
    except AnalysisException:
        return materialize(docs, "rows").select("*", row_id), name


def row_name(docs: DataFrame) -> Column:
    """A string that names each row: its place in the files of a scan; a number, good for one job, in any other plan."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return F.monotonically_increasing_id().cast("string")
    return F.concat_ws(":", "_metadata.file_path", F.col("_metadata.row_index").cast("string"))


def give_back() -> None:
    """Return freed memory to the system: a worker's allocators else keep it while other stages run."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def give_back_heaps(spark: SparkSession) -> None:
    """Have each executor collect its garbage, by a task a core, and so return what its heap doesn't need to the system.

    A heap that earlier stages made grow else stays as large beside the Python workers. Which executor a task goes to is
    the scheduler's choice: one that gets none keeps its heap, and no result depends on it.
    """
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.expr("reflect('java.lang.System', 'gc')").alias("gc")).write.format("noop").mode("append").save()


_held: dict[str, Callable[[], object]] = {}


def hold(name: str, release: Callable[[], object] = lambda: None) -> None:
    """Called in a worker by the operator whose task begins: what other operators keep there between tasks is released.

    Workers outlive stages, so that an operator's caches would else take memory from all those after it.
    """
    others = [x for x in _held if x != name]
    for other in others:
        _held.pop(other)()
    _held[name] = release
    if others:
        give_back()
