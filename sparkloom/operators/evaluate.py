"""Retrieval evaluation: fixtures against chunks, search hits against target groups, and comparison of runs.

Hits are rows (query_id, position from 1, page_key, content, distance, source_type, chunk_id); target groups are rows
of schemas.EVAL_GROUP. Group tables are a suite's, a few dozen rows; hits grow with queries and depth, not the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparkloom.functions import columns as C
from sparkloom.operators.rows import running_bytes, spread
from sparkloom.session import written

TOLERANCE = 1e-4


def _groups(groups: DataFrame) -> DataFrame:
    return groups.withColumn("identity", C.group_identity(F.col("page_match"), F.col("markers")))


def run_suite(hits: DataFrame, groups: DataFrame, limit: float = 0.45) -> DataFrame:
    """schemas.RESULT: for each target group its first satisfying hit; for each query its status and first hit's type."""
    per_query = hits.groupBy("query_id").agg(F.min_by("source_type", "position").alias("rank1_source_type"), F.min("distance").alias("best"))
    joined = _groups(groups).alias("g").join(hits.alias("h"), "query_id", "left")
    good = C.group_hit(F.col("page_match"), F.col("markers"), F.col("page_key"), F.col("content"))
    first = F.min(F.when(good, F.struct(F.col("position").alias("rank"), F.col("distance").alias("distance"))))
    scored = joined.groupBy("query_id", "group_index", "identity").agg(first.alias("found"))
    return scored.join(per_query, "query_id", "left").select(
        "query_id", C.search_status(F.col("best"), limit).alias("status"), "rank1_source_type", "group_index", "identity",
        F.col("found.rank").cast("int").alias("rank"), F.col("found.distance").alias("distance"), F.col("found").isNotNull().alias("hit"),
    )


def _shingles(text: Column, edge: int) -> Column:
    """Hashes of three words in a row, ``edge`` words at either end aside: a marker's outer words may be parts of longer ones."""
    words = F.split(text, r"\s+")
    n = F.greatest(F.lit(0), F.size(words) - 2 - 2 * edge)
    triples = F.arrays_zip(*[F.slice(words, 1 + edge + k, n).alias(f"w{k}") for k in range(3)])
    return F.transform(triples, lambda x: F.xxhash64(x["w0"], x["w1"], x["w2"]))


def containing(texts: DataFrame, markers: DataFrame, *, text_id: str = "id", text: str = "text", marker_id: str = "marker_id", marker: str = "marker") -> DataFrame:
    """(text_id, marker_id) of every text that contains a marker, as it stands.

    A text that contains a marker has all of its inner words in a row, so rows meet by one shingle of each marker, and
    those that met are verified. Markers of fewer than five words have no such shingle: they are few and short, a
    fixture's, and are looked for in every text.
    """
    own = markers.select(F.col(marker_id).alias("_m"), F.col(marker).alias("_marker")).distinct()
    keyed = own.withColumn("_key", F.get(_shingles(F.col("_marker"), 1), 0))
    named = texts.select(F.col(text_id).alias("_t"), F.col(text).alias("_text"))
    long = keyed.where("_key IS NOT NULL")
    met = spread(named).select("_t", F.explode(F.array_distinct(_shingles(F.col("_text"), 0))).alias("_key")).join(long, "_key").select("_t", "_m", "_marker").distinct()
    found = named.join(met, "_t").where(F.col("_text").contains(F.col("_marker"))).select("_t", "_m")
    short = keyed.where("_key IS NULL").select("_m", "_marker")
    if not short.isEmpty():
        found = found.unionByName(spread(named).join(short, F.col("_text").contains(F.col("_marker"))).select("_t", "_m"))
    return found.distinct().select(F.col("_t").alias(text_id), F.col("_m").alias(marker_id))


#: Characters of a page that are looked through at once.
STRETCH = 1 << 16


def fixture_errors(chunks: DataFrame, groups: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """(query_id, identity, error) of each distinct group whose marker stands whole in no chunk: missing, or split.

    Page names are compared with the groups' once a page; from there on rows meet by page. The pages of groups that
    failed are looked through in stretches that overlap by the longest marker, each put together on its own.
    """
    wanted = _groups(groups).groupBy("identity").agg(F.first("page_match").alias("page_match"), F.first("markers").alias("markers"), F.min("query_id").alias("query_id"))
    wanted = wanted.withColumn("_wanted", C.page_norm(F.col("page_match")))
    names = wanted.select("_wanted").distinct()
    counted = chunks.groupBy("page_key").agg(F.count("content").alias("n")).withColumn("_page", C.page_norm(F.col("page_key")))
    pages = written(counted.join(names, F.col("_page").contains(F.col("_wanted"))).select("_wanted", "page_key", "n"), "pages")
    own = chunks.select(F.struct("page_key", "chunk_index").alias("id"), F.col("content").alias("text"))
    markers = wanted.select(F.col("identity").alias("marker_id"), F.explode("markers").alias("marker"))
    held = containing(own, markers).select(F.col("id.page_key").alias("page_key"), F.col("marker_id").alias("identity"))
    whole = held.join(wanted.select("identity", "_wanted"), "identity").join(pages.select("_wanted", "page_key"), ["_wanted", "page_key"]).select("identity").distinct().withColumn("whole", F.lit(True))
    there = pages.groupBy("_wanted").agg(F.sum("n").alias("n"))
    told = wanted.join(there, "_wanted", "left").join(whole, "identity", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    failed = written(told.where((F.col("n") == 0) | ((F.size("markers") > 0) & F.col("whole").isNull())).select("identity", "page_match", "markers", "query_id", "_wanted"), "failed")

    longest = failed.select("_wanted", F.explode("markers").alias("m")).groupBy("_wanted").agg(F.max(F.length(C.squeeze(F.col("m")))).alias("reach"))
    lines = chunks.join(pages.join(longest, "_wanted").select("_wanted", "page_key", "reach"), "page_key").select("_wanted", "reach", "page_key", "chunk_index", F.concat(C.squeeze(F.col("content")), F.lit(" ")).alias("t"))
    placed = running_bytes(lines.withColumn("_size", F.length("t")), "_wanted", "_size", "page_key", "chunk_index", name="at")
    first = F.greatest(F.lit(0), F.floor((F.col("at") - F.col("reach")) / stretch)).cast("long")
    each = placed.select("_wanted", "at", "t", "reach", F.explode(F.sequence(first, F.floor((F.col("at") + F.col("_size") - 1) / stretch).cast("long"))).alias("part"))
    begin = F.greatest(F.lit(0), F.col("part") * stretch - F.col("at")).cast("int")
    length = (F.least(F.col("at") + F.length("t"), (F.col("part") + 1) * stretch + F.col("reach")) - F.col("at")).cast("int") - begin
    clipped = each.select("_wanted", "part", "at", F.col("t").substr(begin + 1, length).alias("t")).where("t <> ''")
    joined = clipped.groupBy("_wanted", "part").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("at", "t"))), lambda p: p["t"]), "").alias("text"))
    parted = failed.join(joined, "_wanted").where(F.exists("markers", lambda m: F.col("text").contains(C.squeeze(m)))).select("identity").distinct().withColumn("split", F.lit(True))
    return failed.join(parted, "identity", "left").select("query_id", "identity", F.when(F.col("split"), "split").otherwise("missing").alias("error"))


def match_holdout(targets: DataFrame, chunks: DataFrame) -> DataFrame:
    """(query_id, target_index, chunk id): same record, and an overlapping byte range or the same heading."""
    own = chunks.select("id", "source_record_id", "source_start_byte", "source_end_byte", F.col("section_heading").alias("chunk_heading"))
    section = F.col("section_heading").isNotNull()
    near = C.spans_overlap(F.col("start_byte"), F.col("end_byte"), F.col("source_start_byte"), F.col("source_end_byte"))
    same = C.heading_norm(F.col("section_heading")) == C.heading_norm(F.col("chunk_heading"))
    return targets.join(own, "source_record_id").where((section & same) | (~section & near)).select("query_id", "target_index", "id")


def run_holdout(hits: DataFrame, targets: DataFrame, chunks: DataFrame, limit: float = 0.45) -> DataFrame:
    """Like run_suite, for targets of schemas.HOLDOUT_TARGET; query texts aren't returned."""
    good = match_holdout(targets, chunks).withColumnRenamed("id", "chunk_id")
    first = hits.join(good, ["query_id", "chunk_id"]).groupBy("query_id", "target_index").agg(F.min(F.struct("position", "distance")).alias("found"))
    per_query = hits.groupBy("query_id").agg(F.min_by("source_type", "position").alias("rank1_source_type"), F.min("distance").alias("best"))
    return targets.select("query_id", "family", "target_index").join(first, ["query_id", "target_index"], "left").join(per_query, "query_id", "left").select(
        "query_id", "family", C.search_status(F.col("best"), limit).alias("status"), "rank1_source_type", F.col("target_index").alias("group_index"),
        F.col("found.position").cast("int").alias("rank"), F.col("found.distance").alias("distance"), F.col("found").isNotNull().alias("hit"),
    )


def best_groups(results: DataFrame, by: str = "query_id") -> DataFrame:
    """Each query's best group: hits first, then the lower rank, then the smaller distance, then the earlier group."""
    key = F.struct(F.col("rank").isNull(), F.coalesce("rank", F.lit(0)), F.coalesce("distance", F.lit(float("inf"))), "group_index")
    return results.groupBy(by).agg(F.min_by(F.struct("group_index", "rank", "distance", "status", "rank1_source_type", "hit"), key).alias("b")).select(by, "b.*")


def unique_groups(results: DataFrame) -> DataFrame:
    """Best rank and distance of each distinct target, whichever query found it."""
    key = F.struct(F.coalesce("rank", F.lit(C.MISS_RANK)), F.coalesce("distance", F.lit(float("inf"))))
    return results.groupBy("identity").agg(F.min_by(F.struct("rank", "distance"), key).alias("b")).select("identity", "b.rank", "b.distance")


def mean_reciprocal_rank(rank: Column) -> Column:
    return F.avg(F.coalesce(F.lit(1.0) / rank, F.lit(0.0)))


def compare_results(a: DataFrame, b: DataFrame, tolerance: float = TOLERANCE) -> DataFrame:
    """(query_id, group_index, failure) of two runs' results: ids, status, rank, hit exactly, distance within tolerance."""
    left = a.select("query_id", "group_index", *[F.col(c).alias(f"a_{c}") for c in ("status", "rank", "hit", "distance")], F.lit(True).alias("in_a"))
    right = b.select("query_id", "group_index", *[F.col(c).alias(f"b_{c}") for c in ("status", "rank", "hit", "distance")], F.lit(True).alias("in_b"))
    both = left.join(right, ["query_id", "group_index"], "full_outer")
    paired = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    differ = lambda c: paired & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}"))
    presence = paired & (F.col("a_distance").isNull() != F.col("b_distance").isNull())
    far = paired & (F.abs(F.col("a_distance") - F.col("b_distance")) > tolerance)
    checks = [(~paired, "groups"), (differ("status"), "status"), (differ("rank"), "ranks"), (differ("hit"), "recall"), (presence, "presence"), (far, "distances")]
    failures = F.array_compact(F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for bad, name in checks]))
    return both.select("query_id", "group_index", F.explode(failures).alias("failure"))


def compare_inputs(a: DataFrame, b: DataFrame) -> DataFrame:
    """(id, failure) of two builds' semantic inputs: ids, documents, embedding inputs and, where given, metadata."""
    fields = [c for c in ("raw_document", "embedding_input_sha256", "canonical_metadata") if c in a.columns and c in b.columns]
    left = a.select("id", *[F.col(c).alias(f"a_{c}") for c in fields], F.lit(True).alias("in_a"))
    right = b.select("id", *[F.col(c).alias(f"b_{c}") for c in fields], F.lit(True).alias("in_b"))
    both = left.join(right, "id", "full_outer")
    paired = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    checks = [(~paired, "ids"), *[(paired & ~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), c) for c in fields]]
    return both.select("id", F.explode(F.array_compact(F.array(*[F.when(bad, F.lit(name)) for bad, name in checks]))).alias("failure"))


def contiguous_spans(spans: DataFrame, record: str = "record", start: str = "start_byte", end: str = "end_byte") -> DataFrame:
    """Rows whose span doesn't begin where the one before it in the record ends, or is empty."""
    before = F.lag(end).over(Window.partitionBy(record).orderBy(start, end))
    return spans.withColumn("_before", before).where((F.col(end) <= F.col(start)) | (F.col("_before").isNotNull() & (F.col("_before") != F.col(start)))).drop("_before")
