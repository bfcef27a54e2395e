"""Command line: ``python -m sparkloom COMMAND``. Each command is one stage; files are what stages share."""

from __future__ import annotations

import argparse
import json
import shlex
import subprocess
import sys
import time
import urllib.error
import urllib.request
from datetime import datetime, timezone
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from sparkloom import schemas
from sparkloom.functions.tokenizer import LibraryTokenizer, QuarterTokenizer
from sparkloom.operators import cache, gates, index, tree, validate
from sparkloom.operators import evaluate as evaluation
from sparkloom.operators.validate import require_none
from sparkloom.plans import build
from sparkloom.session import session, written
from sparkloom.sources import readers, sinks


def http_get(url: str) -> tuple[int, str, str]:
    """(status, content type, text); OSError if there is no answer."""
    request = urllib.request.Request(url, headers={"User-Agent": "sparkloom"})
    try:
        with urllib.request.urlopen(request, timeout=30) as answer:
            return answer.status, answer.headers.get("content-type", ""), answer.read().decode("utf-8", "replace")
    except urllib.error.HTTPError as e:
        return e.code, "", ""


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def fetch(spark: SparkSession, a: argparse.Namespace) -> None:
    """Curated Markdown files of a pinned commit, into a staging folder with their manifest."""
    config = readers.load_config(a.config)
    files = readers.source_files(spark, config)
    fetched = readers.http_pages(files.select(F.col("raw_url").alias("url")), http_get).cache()
    validate.require_none(readers.reject_non_markdown(fetched), "files can't be fetched")
    whole = files.join(fetched.select(F.col("url").alias("raw_url"), "text"), "raw_url")
    for row in whole.select("path", "text").toLocalIterator():
        target = Path(a.staging, row["path"])
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_text(row["text"], "utf-8")
    sinks.save_json(sinks.fetch_manifest(config, whole, _now()), a.manifest)


def crawl(spark: SparkSession, a: argparse.Namespace) -> None:
    """URL tree of a section by its menus; says what changed against the tree that is there."""

    def page(url: str) -> str | None:
        time.sleep(a.delay)
        status, _, text = http_get(url)
        return text if status == 200 else None

    roots = tree.crawl(a.name, a.url, page, set(), frozenset(a.hosts.split(",")))
    if Path(a.tree).exists():
        tree.delta(tree.nodes(spark, readers.load_tree(a.tree)), tree.nodes(spark, roots)).groupBy("change").count().show()
    sinks.save_tree(roots, a.tree)
    tree.tree_stats(tree.nodes(spark, roots)).show()
    if a.check:
        tree.unreachable(tree.nodes(spark, roots), http_get, a.check, a.delay).show(a.check, truncate=False)


def scrape(spark: SparkSession, a: argparse.Namespace) -> None:
    """Pages of a tree (or of some roots) as one HTML document a root."""
    roots = readers.load_tree(a.tree)
    nodes = tree.select_roots(tree.nodes(spark, roots), tree.parse_root_indices(a.roots, len(roots)))
    fetched = readers.http_pages(nodes.select("url").distinct().repartition(a.clients), http_get).cache()
    written = sinks.html_documents(tree.render_roots(nodes, fetched.select("url", F.col("text").alias("html"))), a.out)
    print(written.count(), "documents")
    sinks.url_report(readers.failed_urls(fetched).withColumn("place", F.col("url")), a.failed, "place")


def shards(spark: SparkSession, a: argparse.Namespace) -> None:
    """Balanced shards of a tree's roots."""
    matrix = tree.shard_matrix(tree.nodes(spark, readers.load_tree(a.tree)), a.shards)
    matrix.show(truncate=False)
    if a.outputs:
        sinks.matrix_outputs(matrix, a.outputs)


def assemble(spark: SparkSession, a: argparse.Namespace) -> None:
    """Shard archives into one folder, their failed URLs into one list; a report of what came."""
    rows = readers.archives(spark, a.archives)
    Path(a.report).write_text(sinks.scrape_report(rows, a.expected), "utf-8")
    files, failed = sinks.assemble(rows)
    sinks.html_documents(files.select(F.col("path").alias("filename"), F.col("text").alias("html")), a.out).count()
    sinks.url_report(failed, a.failed, "order", always=True)


def snapshot(spark: SparkSession, a: argparse.Namespace) -> None:
    """Freeze a build's inputs, or verify a frozen folder."""
    if a.official:
        sinks.freeze(spark, official=a.official, staging=a.staging, manifest=a.manifest, config=a.config, out=a.folder, created_at=_now())
    print(sinks.verify_snapshot(spark, a.folder))


def chunk(spark: SparkSession, a: argparse.Namespace) -> None:
    """Chunks of both corpora as JSON lines."""
    counter = LibraryTokenizer(a.tokenizer) if a.tokenizer else QuarterTokenizer()
    made = build.build_chunks(spark, official=a.official, manifest=a.manifest, staging=a.staging, config=a.config, snapshot=a.snapshot, exact=not a.quarter, tokenizer=counter)
    sinks.jsonl(made, a.out, "corpus_ord", "file", "ord")
    readers.chunks(spark, a.out).groupBy("category").agg(F.count(F.lit(1)).alias("chunks"), F.min("token_estimate").alias("least"), F.max("token_estimate").alias("most")).orderBy(F.desc("chunks")).show()


def _recipe(path: str) -> dict:
    """A description's recipe from a JSON file with the arguments of cache.contract."""
    return cache.contract(**json.loads(Path(path).read_text("utf-8")))


def describe(spark: SparkSession, a: argparse.Namespace) -> None:
    """Descriptions for eligible chunks that the cache lacks, from a command that reads {system, prompt, model} and prints {model, text}."""
    recipe = _recipe(a.recipe)
    words = shlex.split(a.command)

    def call(system: str, prompt: str, model: str) -> tuple[str, str]:
        said = subprocess.run(words, input=json.dumps({"system": system, "prompt": prompt, "model": model}), capture_output=True, text=True, check=True, timeout=600)
        answer = json.loads(said.stdout)
        return answer["model"], answer["text"]

    counter = LibraryTokenizer(a.tokenizer) if a.tokenizer else QuarterTokenizer()
    wanted = cache.keyed(cache.eligible(readers.chunks(spark, a.chunks), counter), recipe)
    held = readers.cache_records(spark, a.cache) if Path(a.cache).exists() else spark.createDataFrame([], schemas.CACHE_RECORD)
    made = written(cache.generate(cache.missing(wanted, held), recipe, call, counter), "descriptions")
    require_none(cache.append_errors(held, made.select("cache_key", "status")), "records can't be appended")
    made.write.mode("append").json(a.cache, ignoreNullFields=False)
    made.groupBy("status").count().show()


def embed(spark: SparkSession, a: argparse.Namespace) -> None:
    """Vector table and manifest of chunks, with the hashing embedder; b567 takes a cache of descriptions and its recipe."""
    began = time.time()
    made = readers.chunks(spark, a.chunks)
    said = {"cache": readers.cache_records(spark, a.cache), "recipe": _recipe(a.recipe)} if a.cache else {}
    document = build.build_index(made, a.out, candidate=a.candidate, embedder=index.hash_embedder(a.dimensions), model="hash", dimensions=a.dimensions, snapshot_sha=a.snapshot_sha, built_at=_now(), **said)
    sinks.save_json(document, a.manifest)
    print(document["chunk_count"], "chunks,", sinks.size_text(sinks.folder_bytes(spark, a.out)), f"{time.time() - began:.1f} s")


def evaluate(spark: SparkSession, a: argparse.Namespace) -> None:
    """Results of a fixture file over a vector table, as JSON lines."""
    texts = {q["query_id"]: q.get("query", "") for q in json.loads(Path(a.fixtures).read_text("utf-8"))}
    found = build.evaluate_table(spark, a.table, texts, readers.eval_groups(spark, a.fixtures), index.hash_embedder(a.dimensions))
    sinks.jsonl(found, a.out, "query_id", "group_index", single=True)


def compare(spark: SparkSession, a: argparse.Namespace) -> None:
    """Differences of two run bundles; exit status 1 if there are any."""
    found = build.compare_bundles(readers.run_bundle(spark, a.first), readers.run_bundle(spark, a.second)).cache()
    found.show(50, truncate=False)
    sys.exit(int(not found.isEmpty()))


def holdout(spark: SparkSession, a: argparse.Namespace) -> None:
    """Results of a sealed holdout over a vector table, and its commitment; texts of queries aren't written."""
    payload = Path(a.payload).read_text("utf-8").strip()
    targets = readers.holdout(spark, payload)
    texts = {r["query_id"]: r["query"] for r in targets.select("query_id", "query").distinct().collect()}
    hits = build.search(spark, a.table, texts, index.hash_embedder(a.dimensions))
    sinks.jsonl(evaluation.run_holdout(hits, targets, readers.chunks(spark, a.chunks)), a.out, "query_id", "group_index", single=True)
    print(json.dumps(readers.holdout_commitment(payload)))


def gate(spark: SparkSession, a: argparse.Namespace) -> None:
    """Gates of a release over results: full, fallback, holdout or holdout-fallback; exit status 1 if it may not go out."""
    read = lambda path: readers.jsonl(spark, path, f"{schemas.RESULT}, family string")
    own = read(a.results)
    needed = {"full": ["before"], "fallback": ["base", "before"], "holdout": [], "holdout-fallback": ["base"]}
    if a.kind not in needed:
        raise ValueError(f"no such kind of release: {a.kind}; there are {sorted(needed)}")
    if lost := [name for name in needed[a.kind] if not getattr(a, name)]:
        raise ValueError(f"gates of kind {a.kind} need the results {lost}")
    others = [read(getattr(a, name)) for name in needed[a.kind]]
    run = {"full": gates.full_release, "fallback": gates.fallback_release, "holdout": gates.holdout_full, "holdout-fallback": gates.holdout_fallback}[a.kind]
    report = written(run(own, *others), "gates")
    report.orderBy("severity", "gate", "message").show(200, truncate=False)
    sys.exit(int(not gates.verdict(report).first()["passed"]))


OPTIONS = {
    fetch: ["config", "staging", "manifest"],
    crawl: ["name", "url", "tree", "--hosts=", "--delay=1.0", "--check=20"],
    scrape: ["tree", "out", "--roots=", "--clients=2", "--failed=failed_urls.txt"],
    shards: ["tree", "--shards=4", "--outputs="],
    assemble: ["archives", "out", "--expected=4", "--failed=failed_urls.txt", "--report=report.md"],
    snapshot: ["folder", "--official=", "--staging=", "--manifest=", "--config="],
    chunk: ["out", "--official=", "--staging=", "--manifest=", "--config=", "--snapshot=", "--tokenizer=", "--quarter=?"],
    embed: ["chunks", "out", "manifest", "--candidate=b56", "--dimensions=64", "--snapshot-sha=", "--cache=", "--recipe="],
    describe: ["chunks", "cache", "recipe", "command", "--tokenizer="],
    evaluate: ["fixtures", "table", "out", "--dimensions=64"],
    holdout: ["payload", "table", "chunks", "out", "--dimensions=64"],
    gate: ["results", "--kind=full", "--base=", "--before="],
    compare: ["first", "second"],
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="sparkloom", description=__doc__)
    commands = top.add_subparsers(required=True)
    for run, options in OPTIONS.items():
        sub = commands.add_parser(run.__name__, help=run.__doc__)
        sub.set_defaults(run=run)
        for option in options:
            name, _, default = option.partition("=")
            if default == "?":
                sub.add_argument(name, action="store_true")
            elif name.startswith("--"):
                kind = next((k for k in (int, float) if _is(k, default)), str)
                sub.add_argument(name, default=kind(default) if default else None, type=kind)
            else:
                sub.add_argument(name)
    return top


def _is(kind: type, text: str) -> bool:
    try:
        kind(text)
    except ValueError:
        return False
    return True


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(session(f"sparkloom {args.run.__name__}"), args)


if __name__ == "__main__":
    main()
