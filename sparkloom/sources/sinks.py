"""Sinks: ordered JSON lines, HTML files, vectors, manifests, snapshots, assembled archives and reports."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions.header import COMPANION
from sparkloom.operators.rows import digest_in_order
from sparkloom.operators.validate import require_none
from sparkloom.sources import readers

SNAPSHOT_MANIFEST = "snapshot_manifest.json"


def jsonl(df: DataFrame, path: str, *order: str, single: bool = False) -> None:
    """JSON lines in order: range-partitioned files whose names sort as their rows do, or a single file if asked."""
    out = df.coalesce(1).sortWithinPartitions(*order) if single else df.orderBy(*order)
    out.write.mode("overwrite").json(path, ignoreNullFields=False)


def html_documents(documents: DataFrame, folder: str) -> DataFrame:
    """Write (filename, html) rows as files from the executors; (filename, bytes) of what was written.

    A file appears whole under its name: a task that is run again replaces it with the same content.
    """
    from sparkloom.operators.rows import flat_map

    def write(row: Any) -> list[dict[str, Any]]:
        os.makedirs(folder, exist_ok=True)
        data = row["html"].encode()
        part = f"{folder}/.{row['filename']}.{os.getpid()}"
        with open(part, "wb") as f:
            f.write(data)
        os.replace(part, f"{folder}/{row['filename']}")
        return [{"filename": row["filename"], "bytes": len(data)}]

    return flat_map(documents.select("filename", "html"), write, "filename string, bytes long")


def distinct_in_order(df: DataFrame, column: str, order: str) -> DataFrame:
    """Each value once, where it first stood."""
    return df.groupBy(column).agg(F.min(order).alias(order)).orderBy(order)


def url_report(urls: DataFrame, path: str, order: str, always: bool = False) -> int:
    """Failed URLs, each once in order of appearance, one a line; nothing is written for none unless ``always``."""
    found = [r["url"] for r in distinct_in_order(urls, "url", order).toLocalIterator()]
    if found or always:
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        Path(path).write_text("\n".join(found), "utf-8")
    return len(found)


def save_tree(roots: list[dict[str, Any]], path: str) -> None:
    """A URL configuration; what was there is kept beside it."""
    if os.path.exists(path):
        shutil.copyfile(path, path + ".bak")
    save_json({"urls": roots}, path)


def save_json(document: Any, path: str) -> None:
    os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
    Path(path + ".part").write_text(json.dumps(document, indent=2, ensure_ascii=False), "utf-8")
    os.replace(path + ".part", path)


def vectors(embedded: DataFrame, path: str) -> None:
    """The vector table, made anew each time."""
    embedded.write.mode("overwrite").parquet(path)


def matrix_outputs(matrix: DataFrame, path: str) -> None:
    """Append the shard matrix and its size as step outputs."""
    rows = [r.asDict() for r in matrix.orderBy("shard").collect()]
    text = "matrix=" + json.dumps({"include": rows}).replace(": ", ":").replace(", ", ",")
    with Path(path).open("a") as f:
        print(text, f"shard_count={len(rows)}", sep="\n", file=f)


def fetch_manifest(config: dict[str, Any], files: DataFrame, fetched_at: str) -> dict[str, Any]:
    """Manifest document of fetched files (source rows with text): what was curated, and what came."""
    rows = files.withColumns({"sha256": F.sha2("text", 256), "bytes": F.octet_length("text").cast("long")}).drop("text", "upstream_repo", "upstream_commit").orderBy("path").collect()
    order = {f["path"]: i for i, f in enumerate(config["files"])}
    base = dict(license="", repo_url="", verification_status="companion_unverified", source_type=COMPANION) | {k: config[k] for k in readers.TOP_FIELDS if k in config}
    return base | {"fetched_at": fetched_at, "files": sorted((r.asDict() for r in rows), key=lambda r: order[r["path"]])}


def combined_sha(files: DataFrame) -> str:
    """Hash of the sorted ``path<TAB>sha256`` lines: content alone, not order or time."""
    return digest_in_order(files.select("path", F.concat("path", F.lit("\t"), "sha256").alias("line")), "line", "path", between="\n")


def freeze(spark: SparkSession, *, official: str, staging: str, manifest: str, config: str, out: str, created_at: str = "") -> dict[str, Any]:
    """Copy a build's verified inputs and record their hashes. Nothing is written unless all of them are as fetched."""
    verified = readers.verified_files(spark, manifest, staging, config).select("path", "text")
    shutil.rmtree(out, ignore_errors=True)
    for name in sorted(os.listdir(official)):
        if os.path.isfile(f"{official}/{name}"):
            os.makedirs(f"{out}/official", exist_ok=True)
            shutil.copyfile(f"{official}/{name}", f"{out}/official/{name}")
    for row in verified.toLocalIterator():
        target = f"{out}/companion/{row['path']}"
        os.makedirs(os.path.dirname(target), exist_ok=True)
        with open(target, "w", encoding="utf-8", newline="") as f:
            f.write(row["text"])
    shutil.copyfile(manifest, f"{out}/companion_manifest.json")
    shutil.copyfile(config, f"{out}/companion_sources.json")
    files = readers.text_files(spark, out).select("path", "sha256", "bytes")
    pins = json.loads(Path(manifest).read_text("utf-8"))
    document = {"schema": 1, "created_at": created_at, "upstream": {k: pins.get(k, "") for k in ("repo", "commit")}, "source_snapshot_sha256": combined_sha(files), "files": [r.asDict() for r in files.orderBy("path").collect()]}
    save_json(document, f"{out}/{SNAPSHOT_MANIFEST}")
    return document


def snapshot_errors(recorded: DataFrame, present: DataFrame) -> DataFrame:
    """(path, error): files missing, changed, or there without a record."""
    both = recorded.select("path", F.col("sha256").alias("wanted")).join(present.select("path", "sha256"), "path", "full_outer")
    error = F.when(F.col("sha256").isNull(), "missing").when(F.col("wanted").isNull(), "unrecorded").when(F.col("wanted") != F.col("sha256"), "drifted")
    return both.select("path", error.alias("error")).where("error IS NOT NULL")


def verify_snapshot(spark: SparkSession, folder: str) -> str:
    """The snapshot's hash, or ValueError where its files aren't the recorded ones."""
    path = f"{folder}/{SNAPSHOT_MANIFEST}"
    if not Path(path).is_file():
        raise ValueError(f"no snapshot manifest in {folder}")
    document = json.loads(Path(path).read_text("utf-8"))
    recorded = spark.createDataFrame([(r["path"], r["sha256"]) for r in document.get("files", [])], "path string, sha256 string")
    present = readers.text_files(spark, folder).where(F.col("path") != SNAPSHOT_MANIFEST)
    require_none(snapshot_errors(recorded, present), f"snapshot {folder}")
    found = combined_sha(recorded)
    if found != document.get("source_snapshot_sha256"):
        raise ValueError(f"snapshot {folder}: its hash is {found}, {document.get('source_snapshot_sha256')} is recorded")
    return found


def snapshot_inputs(spark: SparkSession, folder: str, **given: Any) -> dict[str, str]:
    """Paths of a verified snapshot's inputs; inputs given beside it are an error."""
    if extra := [k for k, v in given.items() if v is not None]:
        raise ValueError(f"a snapshot holds all inputs, {extra} can't be given with it")
    verify_snapshot(spark, folder)
    return {"official": f"{folder}/official", "staging": f"{folder}/companion", "manifest": f"{folder}/companion_manifest.json", "config": f"{folder}/companion_sources.json"}


def merge_files(files: DataFrame) -> DataFrame:
    """(path, sha256, bytes, text) once a path; ValueError at run time where shards disagree on a path's content."""
    merged = files.groupBy("path").agg(F.count_distinct("sha256").alias("kinds"), F.first(F.struct("sha256", "bytes", "text")).alias("f"))
    same = F.when(F.col("kinds") == 1, F.col("f")).otherwise(F.raise_error(F.concat(F.lit("shards disagree on "), F.col("path"))).cast(merged.schema["f"].dataType))
    return merged.select("path", same.alias("f")).select("path", "f.*")


def assemble(archive_rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merged page files (paths below their shard folder) and failed URLs with their order, of readers.archives rows."""
    pages = archive_rows.where(F.col("path").rlike(r"(^|/)knowledge_base/shard-[^/]+/")).withColumn("path", F.regexp_replace("path", r"^(.*/)?knowledge_base/shard-[^/]+/", ""))
    lists = archive_rows.where(F.col("path").rlike(r"(^|/)failed_urls_shard_\d+\.txt$"))
    lines = lists.select("shard", "path", F.posexplode(F.split("text", "\n")).alias("pos", "line")).select(F.struct("shard", "path", "pos").alias("order"), F.trim("line").alias("url")).where("url <> ''")
    return merge_files(pages), lines


def scrape_report(archive_rows: DataFrame, expected: int) -> str:
    """Markdown report of completed and missing shards, pages and failures by shard."""
    html = F.count_if(F.col("path").endswith(".html")).alias("pages")
    told = {r["shard"]: r["pages"] for r in archive_rows.groupBy("shard").agg(html).collect()}
    _, lines = assemble(archive_rows)
    failed = {r["shard"]: r["n"] for r in lines.groupBy(F.col("order.shard").alias("shard")).agg(F.count(F.lit(1)).alias("n")).collect()}
    lost = sorted(set(range(expected)) - set(told))
    head = ["# Scrape report", "", f"- Shards expected: {expected}", f"- Shards completed: {len(told)}", f"- Shards missing: {', '.join(map(str, lost)) or 'none'}", "", "## By shard", ""]
    body = [f"- {s}: {told[s]} pages, {failed.get(s, 0)} failed URLs" for s in sorted(told)] or ["No archives."]
    tail = ["", "## Failed URLs", "", f"- In all: {lines.select('url').distinct().count()}"] if told else []
    return "\n".join(head + body + tail) + "\n"


def folder_bytes(spark: SparkSession, folder: str) -> int:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]


def size_text(n: int) -> str:
    return f"{n / 2**20:.1f} MB" if n >= 2**20 else f"{n / 2**10:.1f} KB"


def file_sha(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()
