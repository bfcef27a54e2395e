"""Sessions with the settings that the engine relies on."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # one thread a worker in matrix libraries: results don't depend on a machine's cores, and tasks don't compete
    **{f"spark.executorEnv.{name}_NUM_THREADS": "1" for name in ("OMP", "MKL", "OPENBLAS")},
}


def session(name: str = "sparkloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the engine's defaults; ``settings`` (underscores for dots) win over them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in (DEFAULTS | {k.replace("_", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@lru_cache(maxsize=1)
def _own_folder() -> str:
    path = tempfile.mkdtemp(prefix="sparkloom-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


_scratch: set[str] = set()


@atexit.register
def drop_scratch() -> None:
    """Remove the folders of ``scratch``; called at the driver's end if not before."""
    while _scratch:
        shutil.rmtree(_scratch.pop(), ignore_errors=True)


def scratch(spark: SparkSession, name: str) -> str:
    """Path below a new folder that every executor can read and write."""
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    _scratch.add(folder)
    return f"{folder}/{name}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: what several steps read is computed once."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which all executors share; only a local master has a folder of its own without it."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return re.sub("^file:/*", "/", named.rstrip("/"))
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is unset: executors need a folder that all of them can read")
    return _own_folder()
