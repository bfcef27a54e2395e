"""Embedding plans, the vector table, exact search, and manifests."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from sparkloom.functions import columns as C
from sparkloom.operators.chunks import COMPANION, OFFICIAL
from sparkloom.operators.rows import digest_in_order

SCALARS = "title section_heading breadcrumb source_url page_key chunk_index category token_estimate source_type verification_status upstream_repo upstream_commit source_path raw_url latest_url".split()
SPAN_SCALARS = "source_record_id source_start_byte source_end_byte source_token_count content_token_count embedding_token_count s6_header".split()
CANDIDATES = frozenset("c0 b5 b56 b567".split())
#: Queries and vectors of a task at once.
QUERY_BLOCK, VECTOR_BLOCK = 4096, 16_384
#: Products of queries and vectors at once, and what rounding may take from one.
PRODUCTS, ROUNDING = 1 << 19, 1e-9


def metadata(chunks: DataFrame) -> DataFrame:
    """Chunks with a ``metadata`` struct of scalars; nested wrapper data are canonical JSON."""
    fields = [F.coalesce(F.col(c), F.lit("")).alias(c) if c not in ("chunk_index", "token_estimate") else F.col(c) for c in SCALARS]
    if "source_record_id" in chunks.columns:
        wrapper = F.struct(*[F.col(f"synthetic_wrapper_metadata.{c}").alias(c) for c in ("fence_close", "fence_open", "heading_line", "spans", "stripped_xml")])
        fields += [F.col(c) for c in SPAN_SCALARS] + [F.to_json(wrapper, {"ignoreNullFields": "false"}).alias("synthetic_wrapper_metadata")]
    return chunks.withColumn("metadata", F.struct(*fields))


def embedding_plan(chunks: DataFrame, candidate: str, *, cache: DataFrame | None = None, eligible_ids: DataFrame | None = None, contract_sha: str | None = None) -> DataFrame:
    """id, document, embedding_input, embedding_source and description of each chunk.

    c0 and b5 embed the content, b56 puts the header before it, b567 lets a cached description stand for eligible
    companion chunks. ``cache`` joins by cache_key and is left to the optimiser: it grows with the corpus.
    """
    if candidate not in CANDIDATES:
        raise ValueError(f"no such candidate: {candidate!r}")
    content = F.col("content")
    if candidate in ("c0", "b5"):
        return chunks.select("id", content.alias("document"), content.alias("embedding_input"), F.lit("raw").alias("embedding_source"), F.lit(None).cast("string").alias("description"))
    headed = F.when(F.coalesce(F.col("s6_header"), F.lit("")) != "", F.concat("s6_header", F.lit("\n"), content)).otherwise(content)
    if candidate == "b56":
        return chunks.select("id", content.alias("document"), headed.alias("embedding_input"), F.lit("raw").alias("embedding_source"), F.lit(None).cast("string").alias("description"))
    if cache is None or eligible_ids is None:
        raise ValueError("b567 needs a cache and the ids of eligible chunks")
    found = chunks.join(eligible_ids.select("id", F.lit(True).alias("_may")), "id", "left").join(cache.select("cache_key", "status", F.col("description").alias("_said")), "cache_key", "left")
    may = F.coalesce("_may", F.lit(False)) & (F.col("source_type") == COMPANION)
    source = F.when(~may, "raw").when(F.col("status") == "ok", "description").when(F.col("status").isNotNull(), "raw_fallback")
    source = F.coalesce(source, F.raise_error(F.concat(F.lit("no cached description for "), F.col("id"))).cast("string"))
    out = found.withColumn("embedding_source", source)
    said = F.when(F.col("embedding_source") == "description", F.col("_said"))
    return out.select("id", content.alias("document"), F.coalesce(said, headed).alias("embedding_input"), "embedding_source", said.alias("description"))


def hash_embedder(dimensions: int = 64) -> Callable[[list[str]], np.ndarray]:
    """Deterministic stand-in for a model: signed counts of word hashes, unit length."""
    import zlib

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dimensions), np.float32)
        for i, text in enumerate(texts):
            for word in text.lower().split():
                h = zlib.crc32(word.encode())
                out[i, h % dimensions] += 1 if h >> 31 else -1
        norm = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(norm == 0, 1, norm)

    return embed


def embed(plan: DataFrame, embedder: Callable[[list[str]], np.ndarray], batch: int = 64) -> DataFrame:
    """The plan with an ``embedding`` column, in bounded batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, batch):
                part = whole.slice(at, batch)
                vectors = embedder(part.column("embedding_input").to_pylist())
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(list(vectors), pa.list_(pa.float32()))], [*part.schema.names, "embedding"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plan.schema)
    return plan.mapInArrow(run, f"{fields}, embedding array<float>")


def nearest(
    queries: DataFrame, vectors: DataFrame, k: int, *, query_id: str = "query_id", vector_id: str = "vec_id", embedding: str = "embedding", others_only: bool = False, same: str | None = None,
    block: int = QUERY_BLOCK, vector_block: int = VECTOR_BLOCK,
) -> DataFrame:
    """The ``k`` nearest vectors of each query by cosine distance, exactly: query_id, vector_id, distance, rank.

    Queries and vectors are dealt into blocks, and each pair of blocks is a task's work, of bounded size whatever the
    tables' sizes are: k rows a query and vector block come out of it, which then are ranked by query. Distances are
    computed in double precision; ties go to the smaller id. With ``same``, a query is searched for among vectors of
    equal value there. A zero vector is at distance 1 of all; a null one is found by no query, and as a query finds none.
    """
    value = (F.col(same) if same else F.lit("")).cast("string")
    short = lambda df: "array<float>" if df.schema[embedding].dataType.simpleString() == "array<float>" else "array<double>"
    asked = queries.select(F.col(query_id).alias("id"), F.col(embedding).cast(short(queries)).alias("e"), value.alias("s")).where("e IS NOT NULL")
    held = vectors.select(F.col(vector_id).alias("id"), F.col(embedding).cast(short(vectors)).alias("e"), value.alias("s")).where("e IS NOT NULL")
    rows, columns = (max(1, -(-df.count() // n)) for df, n in ((asked, block), (held, vector_block)))
    deal = lambda n: F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(n)).cast("int")
    left = asked.withColumn("row", deal(rows)).withColumn("column", F.explode(F.sequence(F.lit(0), F.lit(columns - 1))))
    right = held.withColumn("column", deal(columns)).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(rows - 1))))
    q_type, v_type = (df.schema["id"].dataType for df in (asked, held))
    out = pa.schema([("query_id", to_arrow_type(q_type)), (vector_id, to_arrow_type(v_type)), ("distance", pa.float64())])

    def search(own: pa.Table, other: pa.Table) -> pa.Table:
        return _block(own, other, k, others_only, out)

    found = left.groupBy("row", "column").cogroup(right.groupBy("row", "column")).applyInArrow(search, f"query_id {q_type.simpleString()}, `{vector_id}` {v_type.simpleString()}, distance double")
    best = Window.partitionBy("query_id").orderBy("distance", vector_id)
    return found.withColumn("rank", F.row_number().over(best).cast("int")).where(F.col("rank") <= k)


def _units(table: pa.Table) -> np.ndarray:
    """Vectors of unit length in double precision, zero ones as they are; not-a-number throughout where a length is not finite."""
    flat = table.column("e").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    out = flat.astype(np.float64).reshape(table.num_rows, -1)
    with np.errstate(all="ignore"):
        size = np.linalg.norm(out, axis=1, keepdims=True)
        out /= np.where(size == 0, 1, size)
        out[~np.isfinite(size[:, 0])] = np.nan
    return out


def _codes(own: pa.Table, other: pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers that are equal where two tables' values are; nulls are equal."""
    pair = [t.column(name).combine_chunks() for t in (own, other)]
    if pair[0].type != pair[1].type:
        pair = [x.cast(pa.string()) for x in pair]
    both = pa.concat_arrays(pair).dictionary_encode().indices.fill_null(-1).to_numpy()
    return both[: own.num_rows], both[own.num_rows :]


def _meetings(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all equal values, by place in ``left``."""
    order = np.argsort(right, kind="stable")
    low, high = (np.searchsorted(right[order], left, side) for side in ("left", "right"))
    n = high - low
    return np.repeat(np.arange(len(left)), n), order[np.arange(n.sum()) + np.repeat(low - np.cumsum(n) + n, n)]


def _block(queries: pa.Table, vectors: pa.Table, k: int, others_only: bool, out: pa.Schema) -> pa.Table:
    """The k nearest of a block's vectors for each of a block's queries, all that tie with the last of them, and a few more.

    Some queries at a time, so that their products with all vectors are of ``PRODUCTS`` numbers. A query's k-th best
    maximum over groups of vectors is a bound that k vectors reach; distances are computed for those within it, by the
    same sum wherever a vector stands, so that equal vectors are at equal distances.
    """
    if not queries.num_rows or not vectors.num_rows:
        return out.empty_table()
    a, b = _units(queries), _units(vectors)
    n, group = len(b), max(1, min(64, len(b) // (4 * k)))
    wide = np.zeros((-(-n // group) * group, b.shape[1]))
    wide[:n] = b
    hidden = np.append(np.isnan(b[:, 0]), np.ones(len(wide) - n, bool)) if b.shape[1] else np.arange(len(wide)) >= n
    q_same, v_same = _codes(queries, vectors, "s")
    alike = (q_same == q_same[0]).all() and (v_same == q_same[0]).all()
    own_q, own_v = _meetings(*_codes(queries, vectors, "id")) if others_only else (np.zeros(0, int),) * 2
    at, found_q, found_v, found_d = max(1, PRODUCTS // len(wide)), [], [], []
    for i in range(0, len(a), at):
        near = a[i : i + at] @ wide.T
        near[:, hidden] = -np.inf
        if not alike:
            near[:, :n][q_same[i : i + at, None] != v_same] = -np.inf
        low, high = np.searchsorted(own_q, (i, i + at))
        near[own_q[low:high] - i, own_v[low:high]] = -np.inf
        best = near.reshape(len(near), -1, group).max(axis=2)
        limit = np.partition(best, -k, axis=1)[:, -k, None] - ROUNDING if best.shape[1] > k else np.full((len(near), 1), -np.inf)
        q, v = np.nonzero((near >= limit) & (near > -np.inf))
        for j in range(0, len(q), PRODUCTS // 64):
            some_q, some_v = i + q[j : j + PRODUCTS // 64], v[j : j + PRODUCTS // 64]
            found_q.append(some_q), found_v.append(some_v), found_d.append(1 - np.einsum("ij,ij->i", a[some_q], b[some_v]))
    if not found_q:
        return out.empty_table()
    q, v = np.concatenate(found_q), np.concatenate(found_v)
    return pa.Table.from_arrays([queries.column("id").take(pa.array(q)), vectors.column("id").take(pa.array(v)), pa.array(np.concatenate(found_d))], out.names).cast(out)


def smoke_failures(hits: DataFrame, queries: DataFrame, limit: float = 0.45) -> DataFrame:
    """Queries without a hit, or whose best one is too far: query_id, best."""
    best = hits.groupBy("query_id").agg(F.min("distance").alias("best"))
    return queries.select("query_id").join(best, "query_id", "left").where(F.col("best").isNull() | (F.col("best") > limit))


def manifest(chunks: DataFrame, default_root: str = "") -> DataFrame:
    """One row: counts by category and source type, pages, source roots, and the companion corpus's summary."""
    root = F.concat(F.parse_url("source_url", F.lit("PROTOCOL")), F.lit("://"), F.parse_url("source_url", F.lit("HOST")))
    kind = F.coalesce("source_type", F.lit(OFFICIAL))
    rows = chunks.select("category", "page_key", root.alias("root"), kind.alias("kind"), F.when(kind == COMPANION, True).alias("own"), "upstream_repo", "upstream_commit", "source_path", C.area(F.col("breadcrumb")).alias("area"))

    def counts(column: str) -> DataFrame:
        return rows.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct(column, "n")))).alias(f"{column}_counts"))

    def listed(column: str) -> Any:
        return F.array_sort(F.collect_set(F.when(F.col("own") & (F.col(column) != ""), F.col(column))))

    base = rows.agg(
        F.count(F.lit(1)).alias("chunk_count"), F.count_distinct("page_key").alias("page_count"), F.array_sort(F.collect_set("root")).alias("roots"),
        F.count("own").alias("companion_chunks"), F.array_join(listed("upstream_repo"), ", ").alias("companion_repo"), F.array_join(listed("upstream_commit"), ", ").alias("companion_commit"),
        F.count_distinct(F.when(F.col("own") & (F.col("source_path") != ""), F.col("source_path"))).alias("companion_files"),
    )
    base = base.withColumn("source_roots", F.when(F.size("roots") > 0, F.col("roots")).otherwise(F.array(F.lit(default_root)))).drop("roots")
    own_area = rows.where(F.col("own") & F.col("area").isNotNull()).groupBy("area").agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("area", "n")))).alias("area_counts"))
    for one in (counts("category"), counts("kind"), own_area):  # single rows, all of them
        base = base.join(F.broadcast(one))
    return base


def manifest_document(row: Any, *, model: str, dimensions: int, candidate: str, snapshot_sha: str | None = None, built_at: str = "", extra: dict[str, Any] | None = None) -> dict[str, Any]:
    """JSON form of a manifest row. Version 2, with the embedding contract, for b56 and b567, which need a snapshot's hash."""
    found: dict[str, Any] = {
        "schema_version": "1", "embedding_model": model, "embedding_dim": dimensions, "build_timestamp": built_at, "chunk_count": row["chunk_count"], "page_count": row["page_count"],
        "category_counts": row["category_counts"], "source_type_counts": row["kind_counts"], "source_roots": row["source_roots"],
    }
    if row["companion_chunks"]:
        found["companion"] = {"repo": row["companion_repo"], "commit": row["companion_commit"], "chunk_count": row["companion_chunks"], "file_count": row["companion_files"], "area_counts": row["area_counts"]}
    if candidate in ("b56", "b567"):
        if not snapshot_sha:
            raise ValueError(f"{candidate} is built from a verified snapshot only, whose hash goes into the manifest")
        found["schema_version"] = "2"
        found["source_snapshot_sha256"] = snapshot_sha
        found["embedding_contract"] = dict(version=1, model_id=model, embedding_text_version=candidate, s7_enabled=candidate == "b567", max_seq_length=256, normalize_embeddings=False, distance_metric="cosine")
    return found | (extra or {})


def semantic_inputs(plan: DataFrame) -> DataFrame:
    """id, raw_document and the hash of the embedding input: what two builds are compared by."""
    return plan.select("id", F.col("document").alias("raw_document"), C.sha256(F.col("embedding_input")).alias("embedding_input_sha256"))


def semantic_summary(inputs: DataFrame) -> DataFrame:
    """One row: number of inputs and the hash of their sorted (id, hash) pairs as canonical JSON."""
    pairs = inputs.select("id", "embedding_input_sha256", F.to_json(F.array("id", "embedding_input_sha256")).alias("pair"))
    sha = digest_in_order(pairs, "pair", "id", "embedding_input_sha256", between=",", before="[", after="]")
    return inputs.agg(F.count(F.lit(1)).alias("row_count")).withColumn("semantic_inputs_sha256", F.lit(sha))
