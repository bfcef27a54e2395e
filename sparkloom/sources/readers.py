"""Sources: files as rows, verified where a manifest says what they must be."""

from __future__ import annotations

import io
import json
import os
import re
import tarfile
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom import schemas
from sparkloom.functions import columns as C
from sparkloom.operators.rows import Row, flat_map
from sparkloom.operators.validate import require_none

ARCHIVE = re.compile(r"shard-(?P<number>\d+)[.]tar[.]gz\Z")
CONFIG_KEYS = ("files", "repo", "commit", "blob_url_template", "raw_url_template", "latest_blob_url_template")
TOP_FIELDS = tuple("repo repo_url commit license verification_status source_type latest_blob_url_template blob_url_template raw_url_template".split())


def _json(path: str) -> Any:
    return json.loads(Path(path).read_text("utf-8"))


def html_files(spark: SparkSession, folder: str) -> DataFrame:
    """(file, html) of every ``*.html`` in the folder; whole files, splittable by file."""
    return spark.read.text(folder, wholetext=True, pathGlobFilter="*.html").select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("html"))


def text_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, text, sha256, bytes) of every file below the folder, paths relative to it.

    Text with carriage returns keeps them: hashes are of the file's bytes.
    """
    root = os.path.abspath(folder).rstrip("/") + "/"
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    path = F.expr(f"substring(path, locate('{root}', path) + {len(root)})")
    return raw.select(F.url_decode(path).alias("path"), F.decode("content", "UTF-8").alias("text"), F.sha2("content", 256).alias("sha256"), F.col("length").alias("bytes"))


def jsonl(spark: SparkSession, path: str, schema: str, strict: bool = True) -> DataFrame:
    """Rows of JSON lines; a malformed line fails the read unless ``strict`` is off. Blank lines are skipped."""
    return spark.read.schema(schema).json(path, mode="FAILFAST" if strict else "PERMISSIVE")


def chunks(spark: SparkSession, path: str) -> DataFrame:
    return jsonl(spark, path, f"{schemas.SPAN_CHUNK}, chunk_index int")


def cache_records(spark: SparkSession, path: str) -> DataFrame:
    """Cache records, the last of each key in file order."""
    from sparkloom.operators.cache import latest

    rows = spark.read.schema(schemas.CACHE_RECORD).json(path).select("*", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("_order"))
    return latest(rows, F.col("_order")).drop("_order")


def load_tree(path: str) -> list[dict[str, Any]]:
    """Roots of a URL configuration file."""
    return _json(path)["urls"]


def http_pages(urls: DataFrame, get: Callable[[str], tuple[int, str, str]], tries: int = 3, wait: Callable[[float], None] | None = None, delay: float = 1.0) -> DataFrame:
    """schemas.FETCHED for each url: ``get(url) -> (status, content_type, text)``, retried with doubling waits.

    Status 404 isn't retried; a failure after the last try has the status that was seen, or 0. Each task fetches its
    own urls one after another, with ``delay`` before each, so the number of partitions is the number of clients.
    """
    import time

    pause = wait or time.sleep

    def fetch(row: Row) -> Iterator[Row]:
        pause(delay)
        found = 0, "", ""
        for i in range(tries):
            try:
                found = get(row["url"])
            except OSError:
                found = 0, "", ""
            if found[0] in (200, 404):
                break
            if i + 1 < tries:
                pause(2.0 ** (i + 1))
        status, kind, text = found
        yield {"url": row["url"], "status": status, "content_type": kind, "text": text if status == 200 else ""}

    return flat_map(urls.select("url"), fetch, schemas.FETCHED, out_rows=1)


def failed_urls(fetched: DataFrame) -> DataFrame:
    return fetched.where("status <> 200").select("url")


def reject_non_markdown(fetched: DataFrame) -> DataFrame:
    """(url, error) of responses that can't be Markdown: status, blank body, or HTML."""
    text = F.col("text")
    blank = F.coalesce(C.strip(text), F.lit("")) == ""
    error = F.when(F.col("status") != 200, F.concat(F.lit("status "), F.col("status"))).when(blank, "empty body").when(~C.looks_like_markdown(text, F.col("content_type")), "HTML instead of Markdown")
    return fetched.select("url", error.alias("error")).where("error IS NOT NULL")


def load_config(path: str) -> dict[str, Any]:
    """A curated source list; ValueError unless it pins one commit and names good, distinct paths."""
    config = _json(path)
    check_config(config)
    return config


def check_config(config: Any) -> None:
    if not isinstance(config, dict):
        raise ValueError("a source configuration is a JSON object")
    if lost := [k for k in CONFIG_KEYS if k not in config]:
        raise ValueError(f"the configuration lacks {lost}")
    if not re.fullmatch("[0-9a-f]{40}", str(config["commit"])):
        raise ValueError(f"commit {config['commit']!r} isn't a full hash; names that move can't be pinned")
    for key in CONFIG_KEYS[3:]:
        wanted = ["{path}"] if key.startswith("latest") else ["/{commit}/", "{path}"]
        if lost := [w for w in wanted if w not in config[key]]:
            raise ValueError(f"{key} lacks {lost}")
    if not (config["files"] and isinstance(config["files"], list)):
        raise ValueError("the configuration names no files")
    seen: set[str] = set()
    for entry in config["files"]:
        path = str(entry.get("path") or "") if hasattr(entry, "get") else ""
        if denied(path):
            raise ValueError(f"not an allowed file: {entry!r}")
        if path in seen:
            raise ValueError(f"file named twice: {path}")
        seen.add(path)


def denied(path: str, names: tuple[str, ...] = C.DENIED_NAMES) -> bool:
    """Driver-side form of columns.is_denied_path."""
    base = path.rpartition("/")[2].lower()
    return path == "" or "\\" in path or bool({"", ".", ".."} & set(path.split("/"))) or base.endswith(".sh") or base in names


def source_files(spark: SparkSession, config: dict[str, Any]) -> DataFrame:
    """schemas.SOURCE_FILE with the three addresses of each file."""
    rows = [(f["path"], f.get("title", ""), f.get("area", ""), f.get("priority"), f.get("sections"), f.get("drop_sections"), bool(f.get("strip_xml_blocks"))) for f in config["files"]]
    found = spark.createDataFrame(rows, schemas.SOURCE_FILE)
    url = lambda key: C.fill_template(F.lit(config[key]), F.lit(config["commit"]), F.col("path"))
    return found.withColumns({"raw_url": url("raw_url_template"), "blob_url": url("blob_url_template"), "latest_url": url("latest_blob_url_template"), "upstream_repo": F.lit(config["repo"]), "upstream_commit": F.lit(config["commit"])})


def curation_drift(spark: SparkSession, config: dict[str, Any], manifest: dict[str, Any]) -> DataFrame:
    """(path, field, manifest, config) wherever a curator's choice in the configuration isn't the manifest's; path null for the top."""
    top = [(None, k, json.dumps(manifest.get(k)), json.dumps(config[k])) for k in TOP_FIELDS if k in config and config[k] != manifest.get(k)]
    out = spark.createDataFrame(top, "path string, field string, manifest string, config string")
    return out.unionByName(policy_drift(_policies(spark, manifest), _policies(spark, config)))


def _policies(spark: SparkSession, document: dict[str, Any]) -> DataFrame:
    rows = [(f["path"], f.get("title", ""), f.get("area", ""), f.get("priority"), f.get("sections") or [], f.get("drop_sections") or [], bool(f.get("strip_xml_blocks"))) for f in document.get("files", [])]
    return spark.createDataFrame(rows, schemas.SOURCE_FILE)


def policy_drift(manifest: DataFrame, config: DataFrame) -> DataFrame:
    """Full outer join on path; the two pattern lists compare as sets."""
    fields = [c for c in config.columns if c != "path"]
    as_text = lambda c: F.to_json(F.array(F.array_sort(F.array_distinct(c)) if c in ("sections", "drop_sections") else F.col(c)))
    side = lambda df, name: df.select("path", F.lit(True).alias(f"in_{name}"), *[as_text(c).alias(f"{name}_{c}") for c in fields])
    both = side(manifest, "m").join(side(config, "c"), "path", "full_outer")
    both_in = F.col("in_m").isNotNull() & F.col("in_c").isNotNull()
    change = lambda when, field, m, c: F.when(when, F.struct(F.lit(field).alias("field"), m.alias("manifest"), c.alias("config")))
    changes = [change(~both_in, "file", F.coalesce(F.col("in_m"), F.lit(False)).cast("string"), F.coalesce(F.col("in_c"), F.lit(False)).cast("string"))]
    changes += [change(both_in & ~F.col(f"m_{c}").eqNullSafe(F.col(f"c_{c}")), c, F.col(f"m_{c}"), F.col(f"c_{c}")) for c in fields]
    return both.select("path", F.explode(F.array_compact(F.array(*changes))).alias("d")).select("path", "d.field", "d.manifest", "d.config")


def staging_errors(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """(path, error) of manifest rows (path, sha256) whose staged file isn't exactly what was fetched."""
    both = manifest.select("path", F.col("sha256").alias("wanted")).join(files.select("path", "sha256"), "path", "left")
    error = F.when(C.is_denied_path(F.col("path")), "path isn't allowed").when(F.coalesce("wanted", F.lit("")) == "", "no hash in the manifest").when(F.col("sha256").isNull(), "file is missing").when(F.col("wanted") != F.col("sha256"), "content differs")
    return both.select("path", error.alias("error")).where("error IS NOT NULL")


def verified_files(spark: SparkSession, manifest_path: str, folder: str, config_path: str | None = None) -> DataFrame:
    """Staged Markdown files with their manifest rows, or ValueError: every file there, hashed as fetched, policy current."""
    manifest = _json(manifest_path)
    if config_path:
        require_none(curation_drift(spark, _json(config_path), manifest), "the manifest is older than the configuration")
    hashes = spark.createDataFrame([(e["path"], e.get("sha256")) for e in manifest["files"]], "path string, sha256 string")
    files = text_files(spark, folder)
    require_none(staging_errors(hashes, files), "staged files don't match the manifest")
    rows = [tuple(e.get(k) or "" for k in ("path", "raw_url", "blob_url", "latest_url")) for e in manifest["files"]]
    urls = spark.createDataFrame(rows, "path string, raw_url string, blob_url string, latest_url string")
    return _policies(spark, manifest).join(urls, "path").join(files.select("path", "text"), "path").withColumns({"upstream_repo": F.lit(manifest["repo"]), "upstream_commit": F.lit(manifest["commit"])})


def archives(spark: SparkSession, folder: str) -> DataFrame:
    """(shard, path, sha256, bytes, text) of every file in the folder's numbered shard archives."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "knowledge-base-shard-*.tar.gz").load(folder)

    def unpack(row: Row) -> Iterator[Row]:
        import hashlib

        if not (m := ARCHIVE.search(row["path"])):
            return
        with tarfile.open(fileobj=io.BytesIO(row["content"]), mode="r:gz") as tar:
            for member in tar:
                if member.isfile() and not denied(member.name.removeprefix("./"), ()):
                    data = tar.extractfile(member).read()
                    yield {"shard": int(m["number"]), "path": member.name.removeprefix("./"), "sha256": hashlib.sha256(data).hexdigest(), "bytes": len(data), "text": data.decode("utf-8", "replace")}

    return flat_map(raw.select("path", "content"), unpack, "shard int, path string, sha256 string, bytes long, text string", out_rows=50)


def holdout(spark: SparkSession, payload: str) -> DataFrame:
    """schemas.HOLDOUT_TARGET of a base64 payload of JSON lines, strictly checked."""
    rows = [t for i, r in enumerate(_holdout_rows(payload)) for t in _holdout_targets(r, i)]
    return spark.createDataFrame(rows, schemas.HOLDOUT_TARGET)


def holdout_commitment(payload: str) -> dict[str, Any]:
    """What may be told of a sealed set: the payload's hash and its number of rows."""
    import hashlib

    return {"sha256": hashlib.sha256(payload.encode()).hexdigest(), "count": len(_holdout_rows(payload))}


def _holdout_rows(payload: str) -> list[Any]:
    import base64
    import binascii

    try:
        text = base64.b64decode(payload, validate=True).decode("utf-8")
    except (binascii.Error, UnicodeDecodeError) as e:
        raise ValueError(f"not base64 of UTF-8 text: {e}") from e
    out = []
    for n, line in enumerate(text.splitlines(), 1):
        if line.strip():
            try:
                out.append(json.loads(line))
            except json.JSONDecodeError as e:
                raise ValueError(f"line {n} isn't JSON: {e}") from e
    return out


def _holdout_targets(row: Any, n: int) -> Iterator[tuple]:
    if not isinstance(row, dict) or any(k not in row for k in ("family", "query", "query_id", "targets")):
        raise ValueError(f"row {n} isn't an object with query_id, query, family and targets")
    if not isinstance(row["targets"], list) or not row["targets"]:
        raise ValueError(f"row {n} has no targets")
    for i, t in enumerate(row["targets"]):
        anchor = t.get("anchor") if isinstance(t, dict) else None
        if not isinstance(anchor, dict) or not t.get("source_record_id"):
            raise ValueError(f"row {n}, target {i} needs a source_record_id and an anchor")
        heading, start, end = anchor.get("section_heading"), anchor.get("start_byte"), anchor.get("end_byte")
        if "section_heading" in anchor:
            good, start, end = bool(str(heading).strip()), None, None
        else:
            good = type(start) is int and type(end) is int and start <= end
        if not good:
            raise ValueError(f"row {n}, target {i}: an anchor is a heading, or a byte range in order")
        yield row["query_id"], row["query"], row["family"], i, t["source_record_id"], start, end, heading


def eval_groups(spark: SparkSession, path: str) -> DataFrame:
    """Target groups of a fixture file: [{query_id, query, groups: [{page_match, markers}]}]."""
    raw = spark.read.schema("query_id string, query string, groups array<struct<page_match: string, markers: array<string>>>").json(path, multiLine=True)
    return raw.select("query_id", F.posexplode("groups").alias("group_index", "g")).select("query_id", F.col("group_index"), "g.page_match", F.coalesce("g.markers", F.array().cast("array<string>")).alias("markers"))


def run_bundle(spark: SparkSession, folder: str) -> dict[str, Any]:
    """A run's results (long table), semantic inputs, their summary, manifest, and the hash of its cache if it has one."""
    import hashlib

    results = _json(f"{folder}/results.json")["queries"]
    rows = [(q, r["status"], r.get("rank1_source_type"), g["index"], json.dumps(g.get("identity")), g["rank"], g["distance"], g["hit"]) for q, r in results.items() for g in r["groups"]]
    lines = spark.read.text(f"{folder}/semantic_inputs.jsonl")
    parsed = lines.select(F.from_json("value", "id string, raw_document string, embedding_input_sha256 string, semantic_inputs_sha256 string").alias("r"), F.get_json_object("value", "$.canonical_metadata").alias("canonical_metadata")).select("r.*", "canonical_metadata")
    manifest = _json(f"{folder}/manifest.json")
    cache = None
    if os.path.isfile(f"{folder}/s7_cache.jsonl"):
        with open(f"{folder}/s7_cache.jsonl", "rb") as f:
            cache = hashlib.file_digest(f, "sha256").hexdigest()
    summary = parsed.where("semantic_inputs_sha256 IS NOT NULL").first()
    return {
        "results": spark.createDataFrame(rows, schemas.RESULT), "inputs": parsed.where("id IS NOT NULL").drop("semantic_inputs_sha256"),
        "semantic_inputs_sha256": summary and summary["semantic_inputs_sha256"], "manifest": manifest, "cache_sha256": cache,
    }
