"""Registered queries over the test tables, each with its DuckDB counterpart where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.functions import columns as C
from sparkloom.functions import identifiers as I
from sparkloom.functions.header import COMPANION, OFFICIAL, build
from sparkloom.functions.tokenizer import QuarterTokenizer
from sparkloom.operators import cache, chunks, evaluate, gates, index, rows, tree, validate
from sparkloom.plans.registry import REGISTRY, Query, Tables, query
from sparkloom.sources import sinks
from sparkloom.streaming import ingest

# *** scalars

PAGE_KEY = "coalesce(nullif(regexp_replace(split_part(split_part(trim(url), '#', 1), '?', 1), '/+$', ''), ''), 'file:page_' || page_id)"


def _page_key() -> F.Column:
    return C.page_key(F.col("url"), F.concat(F.lit("page_"), F.col("page_id")))


@query(f"SELECT page_id, {PAGE_KEY} AS page_key FROM pages")
def page_keys(t: Tables) -> DataFrame:
    return t.pages.select("page_id", _page_key().alias("page_key"))


@query(f"SELECT {PAGE_KEY} AS page_key, count(*) AS n, min(page_id) AS first_page FROM pages GROUP BY 1 HAVING count(*) > 1")
def page_key_duplicates(t: Tables) -> DataFrame:
    return t.pages.select(_page_key().alias("page_key"), "page_id").groupBy("page_key").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first_page")).where("n > 1")


@query(r"SELECT regexp_extract(url, '^([a-z]+://[^/?#]+)', 1) AS root, count(*) AS pages FROM pages GROUP BY 1")
def source_roots(t: Tables) -> DataFrame:
    root = F.concat(F.parse_url("url", F.lit("PROTOCOL")), F.lit("://"), F.parse_url("url", F.lit("HOST")))
    return t.pages.groupBy(root.alias("root")).agg(F.count(F.lit(1)).alias("pages"))


@query(r"SELECT page_id, substr(sha1(url), 1, 10) || '_' || coalesce(nullif(trim(regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '[^a-zA-Z0-9_\-]', '_', 'g'), '_'), ''), 'document') || '.html' AS filename FROM pages")
def output_filenames(t: Tables) -> DataFrame:
    return t.pages.select("page_id", C.output_filename(F.regexp_extract("html", "<h1>(.*?)</h1>", 1), F.col("url")).alias("filename"))


@query(r"SELECT page_id, regexp_extract(html, '<h1>(.*?)</h1>', 1) AS title FROM pages")
def page_titles(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_extract("html", "<h1>(.*?)</h1>", 1).alias("title"))


@query("""SELECT page_id, unnest(generate_series(0, len(hrefs) - 1)) AS pos, unnest(hrefs) AS href FROM (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM pages) WHERE len(hrefs) > 0""")
def page_links(t: Tables) -> DataFrame:
    hrefs = F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))
    return t.pages.select("page_id", F.posexplode(hrefs).alias("pos", "href")).withColumn("pos", F.col("pos").cast("long"))


WORDPIECES = r"coalesce(list_sum(list_transform(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''), lambda w: (length(w) + 3) // 4)), 0)::INT"


@query(f"SELECT doc_id, (length(text) // 4)::INT AS estimate, {WORDPIECES} AS pieces FROM documents")
def token_counts(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", C.token_estimate(F.col("text")).alias("estimate"), C.wordpiece_count(F.col("text")).alias("pieces"))


@query("SELECT lang, floor(sum(length(text) // 4) / count(*))::BIGINT AS mean_tokens, min(length(text) // 4)::INT AS least, max(length(text) // 4)::INT AS most FROM documents GROUP BY 1")
def token_stats(t: Tables) -> DataFrame:
    sized = t.documents.select("lang", C.token_estimate(F.col("text")).alias("n"))
    return sized.groupBy("lang").agg(F.floor(F.sum("n") / F.count(F.lit(1))).alias("mean_tokens"), F.min("n").alias("least"), F.max("n").alias("most"))


@query("SELECT doc_id, sha256(text) AS sha, 'doc_' || doc_id || '_' || lpad(((doc_id % 1000)::INT)::VARCHAR, 3, '0') AS chunk_id, 'companion_readme_' || substr(sha1('d' || doc_id || '/Readme.md'), 1, 12) || '_000' AS companion_id FROM documents")
def identities(t: Tables) -> DataFrame:
    path = F.concat(F.lit("d"), "doc_id", F.lit("/Readme.md"))
    return t.documents.select(
        "doc_id", C.sha256(F.col("text")).alias("sha"), C.chunk_id(F.concat(F.lit("Doc "), "doc_id"), (F.col("doc_id") % 1000).cast("int")).alias("chunk_id"),
        C.companion_chunk_id(path, F.lit(0)).alias("companion_id"),
    )


@query(r"""
SELECT page_id, path, path = '' OR starts_with(path, '/') OR contains(path, '\') OR len(list_filter(string_split(path, '/'), lambda p: p IN ('', '.', '..'))) > 0
       OR ends_with(lower(path), '.sh') OR lower(string_split(path, '/')[-1]) IN ('readme.md', 'claude.md') AS denied,
       regexp_matches(sha1(path), '^[0-9a-f]{40}$') AS pinned
FROM (SELECT page_id, regexp_replace(url, '^[a-z]+://[^/]*/', '') AS path FROM pages)""")
def path_rules(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.regexp_replace("url", "^[a-z]+://[^/]*/", "").alias("path")).select("page_id", "path", C.is_denied_path(F.col("path")).alias("denied"), C.is_pinned_commit(F.sha1("path")).alias("pinned"))


@query(r"SELECT doc_id, unnest(generate_series(0, len(s) - 1)) AS pos, sha256(unnest(s)) AS sentence_sha FROM (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([.!?])\s+', '\1' || chr(1), 'g'), chr(1)), lambda x: trim(x, E' \n\t') <> '') AS s FROM documents) WHERE len(s) > 0")
def sentence_units(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.posexplode(C.sentences(F.col("text"))).alias("pos", "s")).select("doc_id", F.col("pos").cast("long").alias("pos"), C.sha256(F.col("s")).alias("sentence_sha"))


@query(r"""
SELECT doc_id, array_to_string(list_sort(list_distinct(list_concat(
  regexp_extract_all(text, '\b(?:[A-Za-z_]\w*\.)+[A-Za-z_]\w*\b'), regexp_extract_all(text, '\b[a-zA-Z]+(?:_[0-9a-zA-Z]+)+\b'),
  regexp_extract_all(text, '\b[a-z]+[A-Z][0-9a-zA-Z]*\b'), regexp_extract_all(text, '\b[A-Z][0-9a-z]+[A-Z][0-9a-zA-Z]*\b')))), ' ') AS names FROM (SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', ' ', 'g') AS text FROM documents)""")
def word_identifiers(t: Tables) -> DataFrame:
    ascii_text = F.regexp_replace("text", r"[^\x00-\x7F]", " ")
    return t.documents.select("doc_id", F.array_join(C.word_identifiers(ascii_text), " ").alias("names"))


@query("SELECT doc_id, sha256(to_json({breadcrumb: lang || ' > ' || source, identifiers: [lang, source], raw_document: text, section_heading: source, source_type: 'official', title: lang})) AS input_sha FROM documents")
def generation_inputs(t: Tables) -> DataFrame:
    made = C.generation_input_json(F.col("text"), F.col("lang"), F.col("source"), F.concat("lang", F.lit(" > "), "source"), F.lit("official"), F.array("source", "lang"))
    return t.documents.select("doc_id", C.sha256(made).alias("input_sha"))


@query("SELECT doc_id, sha256(sha256(text) || chr(0) || sha256('recipe')) AS cache_key FROM documents")
def cache_keys(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", C.cache_key(C.sha256(F.col("text")), C.sha256(F.lit("recipe"))).alias("cache_key"))


# *** aggregates


@query("SELECT coalesce(lang, 'Unknown') AS category, count(*) AS n FROM documents GROUP BY 1")
def category_counts(t: Tables) -> DataFrame:
    """The manifest's own counts, unfolded."""
    own = {c: F.lit(None).cast("string") for c in ("source_url", "upstream_repo", "upstream_commit", "source_path", "breadcrumb")}
    made = index.manifest(t.documents.select(F.coalesce("lang", F.lit("Unknown")).alias("category"), F.col("source").alias("source_type"), F.col("doc_id").cast("string").alias("page_key"), *[v.alias(k) for k, v in own.items()]))
    return made.select(F.explode("category_counts").alias("category", "n"))


@query("SELECT coalesce(source, 'official') AS source_type, count(*) AS n, count(DISTINCT lang) AS langs FROM documents GROUP BY 1")
def source_type_counts(t: Tables) -> DataFrame:
    return t.documents.groupBy(F.coalesce("source", F.lit("official")).alias("source_type")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("lang").alias("langs"))


@query("SELECT sha256(text) AS cache_key, count(*) AS n, string_agg(doc_id::VARCHAR, ',' ORDER BY doc_id) AS ids FROM documents GROUP BY 1")
def usage_map(t: Tables) -> DataFrame:
    used = cache.usages(t.documents.select(C.sha256(F.col("text")).alias("cache_key"), F.col("doc_id").alias("id"), *[F.lit(None).cast(k).alias(c) for c, k in (("source_record_id", "string"), ("source_start_byte", "long"), ("source_end_byte", "long"))]))
    return used.select("cache_key", "n", F.array_join(F.transform("usages", lambda u: u["id"].cast("string")), ",").alias("ids"))


@query("SELECT sha256(text) AS id, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def duplicate_ids(t: Tables) -> DataFrame:
    return validate.duplicate_ids(t.documents.select(C.sha256(F.col("text")).alias("id")))


@query("SELECT sha256(string_agg(doc_id::VARCHAR || chr(9) || sha256(text), chr(10) ORDER BY doc_id::VARCHAR)) AS combined FROM documents")
def combined_hash(t: Tables) -> DataFrame:
    files = t.documents.select(F.col("doc_id").cast("string").alias("path"), C.sha256(F.col("text")).alias("sha256"))
    return t.spark.createDataFrame([(sinks.combined_sha(files),)], "combined string")


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1")
def latest_records(t: Tables) -> DataFrame:
    kept = cache.latest(t.events.select(F.col("user_id").alias("cache_key"), "event_id", "event_type", "ts"), F.struct("ts", "event_id"))
    return kept.select(F.col("cache_key").alias("user_id"), "event_id", "event_type")


@query("SELECT count(*) AS chunk_count, count(DISTINCT source) AS page_count, count(DISTINCT lang) AS categories, count(*) FILTER (lang = 'en') AS companion_chunks FROM documents")
def index_manifest(t: Tables) -> DataFrame:
    made = index.manifest(_chunks(t))
    return made.select("chunk_count", "page_count", F.size("category_counts").cast("long").alias("categories"), "companion_chunks")


# *** windows


@query("SELECT conv_id, turn, role, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INT AS chunk_index FROM conversations")
def chunk_index(t: Tables) -> DataFrame:
    return rows.numbered(t.conversations.select("conv_id", "turn", "role"), "conv_id", "turn")


@query("""SELECT conv_id, min(turn) AS lowest, max(turn) AS highest, count(*) AS n, count(DISTINCT turn) AS distinct_n FROM conversations WHERE role = 'user' GROUP BY 1
HAVING min(turn) <> 0 OR max(turn) <> count(*) - 1 OR count(DISTINCT turn) <> count(*)""")
def contiguity(t: Tables) -> DataFrame:
    return rows.contiguity(t.conversations.where("role = 'user'"), "conv_id", "turn")


@query("SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN sha256(text) END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS carried FROM conversations")
def carry_forward(t: Tables) -> DataFrame:
    asked = t.conversations.withColumn("asked", F.when(F.col("role") == "user", C.sha256(F.col("text"))))
    return rows.carry_forward(asked, "asked", ["conv_id"], ["turn"], "carried").select("conv_id", "turn", "carried")


SPANS = "SELECT conv_id, turn, (sum(strlen(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - strlen(text))::BIGINT AS start_byte, strlen(text)::BIGINT AS size FROM conversations"


def _spans(t: Tables) -> DataFrame:
    sized = t.conversations.select("conv_id", "turn", F.octet_length("text").cast("long").alias("size"))
    return rows.running_bytes(sized, "conv_id", "size", "turn", name="start_byte")


@query(SPANS)
def running_offsets(t: Tables) -> DataFrame:
    return _spans(t).select("conv_id", "turn", "start_byte", "size")


@query(f"SELECT count(*) AS broken FROM (SELECT start_byte, size, lag(start_byte + size) OVER (PARTITION BY conv_id ORDER BY turn) AS before FROM ({SPANS})) WHERE size = 0 OR before <> start_byte")
def span_tiling(t: Tables) -> DataFrame:
    spans = _spans(t).select(F.col("conv_id").alias("record"), "start_byte", (F.col("start_byte") + F.col("size")).alias("end_byte"))
    return evaluate.contiguous_spans(spans).agg(F.count(F.lit(1)).alias("broken"))


# *** joins


@query(f"SELECT a.conv_id, a.k, s.turn FROM (SELECT conv_id, unnest(generate_series(0, (max(start_byte + size) // 500)::BIGINT)) AS k FROM ({SPANS}) GROUP BY 1) a JOIN ({SPANS}) s ON a.conv_id = s.conv_id AND a.k * 500 < s.start_byte + s.size AND s.start_byte < a.k * 500 + 500")
def interval_overlap(t: Tables) -> DataFrame:
    spans = _spans(t).select("conv_id", "turn", "start_byte", (F.col("start_byte") + F.col("size")).alias("end_byte"))
    anchors = spans.groupBy("conv_id").agg(F.max("end_byte").alias("e")).select("conv_id", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("e div 500"))).alias("k"))
    near = C.spans_overlap(F.col("k") * 500, F.col("k") * 500 + 500, F.col("start_byte"), F.col("end_byte"))
    return anchors.join(spans, "conv_id").where(near).select("conv_id", "k", "turn")


@query("SELECT b.item_id, d.doc_id FROM benchmark b JOIN documents d ON contains(d.text, b.text)")
def marker_join(t: Tables) -> DataFrame:
    """Benchmark passages that stand in documents as they are."""
    return evaluate.containing(t.documents, t.benchmark, text_id="doc_id", text="text", marker_id="item_id", marker="text")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_keys(t: Tables) -> DataFrame:
    """Documents as keyed chunks, labels as the cache: the keys that it lacks, each with a chunk that stands for it."""
    keyed = t.documents.select(F.col("doc_id").alias("cache_key"), F.col("doc_id").alias("id"))
    return cache.missing(keyed, t.labels.select(F.col("doc_id").alias("cache_key"))).select(F.col("chunk.id").alias("doc_id"))


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def eligible_ids(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang").join(t.labels.where("quality = 1"), "doc_id", "left_semi")


@query("""SELECT coalesce(c.path, m.path) AS path, CASE WHEN c.sha256 IS NULL THEN 'missing' WHEN m.sha256 IS NULL THEN 'unrecorded' ELSE 'drifted' END AS error
FROM (SELECT doc_id::VARCHAR AS path, '1' AS sha256 FROM documents) m FULL JOIN (SELECT doc_id::VARCHAR AS path, quality::VARCHAR AS sha256 FROM labels) c ON m.path = c.path WHERE m.sha256 IS DISTINCT FROM c.sha256""")
def snapshot_drift(t: Tables) -> DataFrame:
    recorded = t.documents.select(F.col("doc_id").cast("string").alias("path"), F.lit("1").alias("sha256"))
    present = t.labels.select(F.col("doc_id").cast("string").alias("path"), F.col("quality").cast("string").alias("sha256"))
    return sinks.snapshot_errors(recorded, present)


@query("""SELECT CASE WHEN doc_id % 5 = 4 THEN '../' ELSE 'd/' END || doc_id || '.md' AS path,
CASE doc_id % 5 WHEN 0 THEN 'no hash in the manifest' WHEN 1 THEN 'content differs' WHEN 2 THEN 'file is missing' ELSE 'path isn''t allowed' END AS error FROM documents WHERE doc_id % 5 <> 3""")
def staging_errors(t: Tables) -> DataFrame:
    """Documents as staged files: as fetched, changed, lost, without a hash, or at a path that isn't allowed."""
    from sparkloom.sources import readers

    path = F.concat(F.when(F.col("doc_id") % 5 == 4, "../").otherwise("d/"), "doc_id", F.lit(".md"))
    wanted = F.when(F.col("doc_id") % 5 == 0, "").when(F.col("doc_id") % 5 == 1, "0").otherwise(C.sha256(F.col("text")))
    staged = t.documents.where("doc_id % 5 <> 2").select(path.alias("path"), C.sha256(F.col("text")).alias("sha256"))
    return readers.staging_errors(t.documents.select(path.alias("path"), wanted.alias("sha256")), staged)


CHUNKS = """(SELECT doc_id::VARCHAR AS id, text AS content, CASE WHEN lang = 'en' THEN 'companion_reference' ELSE 'official' END AS source_type, CASE WHEN lang = 'fr' THEN '' ELSE 'About ' || source END AS s6_header, sha256(text) AS cache_key, source AS page_key,
quality FROM documents LEFT JOIN labels USING (doc_id))"""


def _chunks(t: Tables) -> DataFrame:
    """Documents in the shape of chunks."""
    companion = F.col("lang") == "en"
    real = lambda v: F.when(companion, v).otherwise("")
    return t.documents.select(
        F.col("doc_id").cast("string").alias("id"), F.col("text").alias("content"), F.col("lang").alias("title"), F.col("source").alias("section_heading"), F.concat("lang", F.lit(" > "), "source", F.lit(" > x")).alias("breadcrumb"),
        F.lit("").alias("source_url"), F.col("source").alias("page_key"), F.col("doc_id").cast("int").alias("chunk_index"), F.col("lang").alias("category"), C.token_estimate(F.col("text")).alias("token_estimate"),
        F.when(companion, COMPANION).otherwise(OFFICIAL).alias("source_type"), F.lit("x").alias("verification_status"), real(F.lit("r")).alias("upstream_repo"), real(F.lit("c")).alias("upstream_commit"), real(F.col("source")).alias("source_path"),
        F.when(F.col("lang").isin("en", "de"), F.when(F.col("source") == "src3", "").otherwise("u")).otherwise("").alias("raw_url"), real(F.lit("l")).alias("latest_url"),
        F.when(F.col("lang") == "fr", "").otherwise(F.concat(F.lit("About "), "source")).alias("s6_header"), C.sha256(F.col("text")).alias("cache_key"),
    )


@query(f"""SELECT c.id, CASE WHEN source_type <> 'companion_reference' OR quality IS NULL THEN 'raw' WHEN k.status = 'ok' THEN 'description' ELSE 'raw_fallback' END AS embedding_source,
sha256(CASE WHEN source_type = 'companion_reference' AND quality IS NOT NULL AND k.status = 'ok' THEN 'said ' || k.cache_key WHEN s6_header <> '' THEN s6_header || chr(10) || content ELSE content END) AS input_sha
FROM {CHUNKS} c LEFT JOIN (SELECT cache_key, CASE WHEN count(*) > 1 THEN 'raw_fallback' ELSE 'ok' END AS status FROM {CHUNKS} GROUP BY 1) k USING (cache_key)""")
def embedding_plan(t: Tables) -> DataFrame:
    made = _chunks(t)
    said = made.groupBy("cache_key").agg(F.when(F.count(F.lit(1)) > 1, "raw_fallback").otherwise("ok").alias("status")).withColumn("description", F.concat(F.lit("said "), "cache_key"))
    plan = index.embedding_plan(made, "b567", cache=said, eligible_ids=t.labels.select(F.col("doc_id").cast("string").alias("id")))
    return plan.select("id", "embedding_source", C.sha256(F.col("embedding_input")).alias("input_sha"))


@query(f"SELECT count(*) AS row_count, sha256('[' || string_agg('[\"' || id || '\",\"' || sha256(content) || '\"]', ',' ORDER BY id) || ']') AS semantic_inputs_sha256 FROM {CHUNKS}")
def semantic_summary(t: Tables) -> DataFrame:
    return index.semantic_summary(index.semantic_inputs(index.embedding_plan(_chunks(t), "c0")))


@query("""SELECT * FROM (SELECT doc_id::VARCHAR AS id, unnest(list_filter([CASE WHEN trim(text, E' \n\t') = '' THEN 'content is empty' END, CASE WHEN lang = 'en' AND source = 'src3' THEN 'companion chunk without raw_url' END,
CASE WHEN lang = 'de' AND source <> 'src3' THEN 'official chunk with raw_url' END], lambda x: x IS NOT NULL)) AS error FROM documents)
UNION ALL SELECT source, 'page with gaps in chunk_index' FROM documents GROUP BY 1 HAVING min(doc_id) <> 0 OR max(doc_id) <> count(*) - 1 OR count(DISTINCT doc_id) <> count(*)""")
def chunk_errors(t: Tables) -> DataFrame:
    return validate.chunk_errors(_chunks(t))


@query(f"""SELECT 'fallback ' || sum(n) FILTER (n > 1)::VARCHAR || ' of ' || sum(n)::VARCHAR AS error FROM (SELECT cache_key, count(*) AS n FROM {CHUNKS} GROUP BY 1) HAVING sum(n) FILTER (n > 1) > 0.05 * sum(n)""")
def release_errors(t: Tables) -> DataFrame:
    made = _chunks(t)
    known = made.groupBy("cache_key").agg(F.when(F.count(F.lit(1)) > 1, "raw_fallback").otherwise("ok").alias("status"))
    return cache.release_errors(made, known, 0.05)


# *** sets and trees


@query("SELECT coalesce(a.url, b.url) AS url, CASE WHEN a.url IS NULL THEN 'added' WHEN b.url IS NULL THEN 'removed' ELSE 'unchanged' END AS change FROM (SELECT DISTINCT doc_id::VARCHAR AS url FROM labels) a FULL JOIN (SELECT DISTINCT doc_id::VARCHAR AS url FROM documents) b ON a.url = b.url")
def url_delta(t: Tables) -> DataFrame:
    return tree.delta(t.labels.select(F.col("doc_id").cast("string").alias("url")), t.documents.select(F.col("doc_id").cast("string").alias("url")))


@query("SELECT url, min(page_id) AS page_id FROM pages GROUP BY 1")
def first_seen(t: Tables) -> DataFrame:
    return sinks.distinct_in_order(t.pages, "url", "page_id")


@query("SELECT sha256(text) AS path, any_value(strlen(text))::BIGINT AS bytes FROM documents GROUP BY 1")
def merged_files(t: Tables) -> DataFrame:
    files = t.documents.select(C.sha256(F.col("text")).alias("path"), C.sha256(F.col("text")).alias("sha256"), F.octet_length("text").cast("long").alias("bytes"), "text")
    return sinks.merge_files(files).select("path", "bytes")


NODES = """(SELECT r_regionkey AS root_index, 'r' || r_regionkey AS url, NULL AS parent, 1 AS depth FROM region UNION ALL SELECT n_regionkey, 'n' || n_nationkey, 'r' || n_regionkey, 2 FROM nation
UNION ALL SELECT n_regionkey, 'c' || c_custkey, 'n' || c_nationkey, 3 FROM customer JOIN nation ON c_nationkey = n_nationkey)"""


def _nodes(t: Tables) -> DataFrame:
    pad = lambda c: F.lpad(F.col(c).cast("string"), 9, "0")
    regions = t.region.select(F.col("r_regionkey").alias("root_index"), F.concat(F.lit("r"), "r_regionkey").alias("url"), F.lit(None).cast("string").alias("parent"), F.lit(1).alias("depth"), pad("r_regionkey").alias("path"))
    nations = t.nation.select(F.col("n_regionkey"), F.concat(F.lit("n"), "n_nationkey"), F.concat(F.lit("r"), "n_regionkey"), F.lit(2), F.concat_ws("/", pad("n_regionkey"), pad("n_nationkey")))
    people = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select("n_regionkey", F.concat(F.lit("c"), "c_custkey"), F.concat(F.lit("n"), "c_nationkey"), F.lit(3), F.concat_ws("/", pad("n_regionkey"), pad("n_nationkey"), pad("c_custkey")))
    return regions.union(nations).union(people).withColumn("node_id", F.xxhash64("url"))


@query(f"WITH RECURSIVE up AS (SELECT url AS node, url AS ancestor, parent FROM {NODES} UNION ALL SELECT up.node, p.url, p.parent FROM up JOIN {NODES} p ON up.parent = p.url), s AS (SELECT ancestor AS url, count(*) AS size FROM up GROUP BY 1) SELECT n.url, n.root_index, n.depth, s.size FROM {NODES} n JOIN s USING (url)")
def tree_sizes(t: Tables) -> DataFrame:
    return tree.depths_and_sizes(_nodes(t)).select("url", "root_index", "depth", "size")


@query(f"WITH RECURSIVE up AS (SELECT url AS node, url AS ancestor, parent, 0 AS distance FROM {NODES} UNION ALL SELECT up.node, p.url, p.parent, up.distance + 1 FROM up JOIN {NODES} p ON up.parent = p.url) SELECT node, ancestor, distance FROM up")
def tree_closure(t: Tables) -> DataFrame:
    return tree.closure(_nodes(t), "url", "parent")


@query(f"SELECT count(*) AS urls, count(*) FILTER (depth = 1) AS roots, max(depth) AS deepest, avg(depth) AS mean_depth FROM {NODES}")
def tree_stats(t: Tables) -> DataFrame:
    return tree.tree_stats(_nodes(t))


@query(f"""WITH RECURSIVE s AS (SELECT root_index, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, root_index) AS k FROM {NODES} GROUP BY 1),
g AS (SELECT 0::BIGINT AS k, 0::BIGINT AS a, 0::BIGINT AS b, 0::BIGINT AS c, ''::VARCHAR AS ia, ''::VARCHAR AS ib, ''::VARCHAR AS ic
UNION ALL SELECT s.k, CASE WHEN a <= b AND a <= c THEN a + n ELSE a END, CASE WHEN b < a AND b <= c THEN b + n ELSE b END, CASE WHEN c < a AND c < b THEN c + n ELSE c END,
CASE WHEN a <= b AND a <= c THEN ia || ',' || root_index ELSE ia END, CASE WHEN b < a AND b <= c THEN ib || ',' || root_index ELSE ib END, CASE WHEN c < a AND c < b THEN ic || ',' || root_index ELSE ic END FROM g JOIN s ON s.k = g.k + 1),
f AS (SELECT * FROM g ORDER BY k DESC LIMIT 1), o AS (SELECT 0 AS shard, ia AS i, a AS n FROM f UNION ALL SELECT 1, ib, b FROM f UNION ALL SELECT 2, ic, c FROM f)
SELECT shard, array_to_string(list_sort(string_split(i[2:], ',')), ',') AS root_indices, len(string_split(i[2:], ','))::INT AS root_count, n AS url_count FROM o""")
def shard_matrix(t: Tables) -> DataFrame:
    return tree.shard_matrix(_nodes(t), 3)


# *** search and evaluation

# queries are every vector whose id is divisible by 20, searched against all vectors
NEAREST = """(SELECT query_id, vec_id, distance, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id) AS rank, label, query_label FROM
(SELECT q.vec_id AS query_id, v.vec_id, list_cosine_distance(q.embedding::DOUBLE[], v.embedding::DOUBLE[]) AS distance, v.label, q.label AS query_label FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 20 = 0) QUALIFY rank <= 5)"""
SAME = NEAREST.replace("ON q.vec_id <> v.vec_id", "ON q.vec_id <> v.vec_id AND q.label = v.label")


def _asked(t: Tables) -> DataFrame:
    return t.embeddings.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding", F.col("label").alias("query_label"))


def _hits(t: Tables) -> DataFrame:
    return index.nearest(_asked(t), t.embeddings, 5, others_only=True)


@query(f"SELECT query_id, vec_id, round(distance, 6) AS distance, rank::INT AS rank FROM {NEAREST}")
def knn_top5(t: Tables) -> DataFrame:
    return _hits(t).withColumn("distance", F.round("distance", 6))


@query(f"SELECT query_id, vec_id, round(distance, 6) AS distance, rank::INT AS rank FROM {SAME}")
def knn_filtered(t: Tables) -> DataFrame:
    """Search with an equality filter."""
    asked = _asked(t).withColumnRenamed("query_label", "label")
    return index.nearest(asked, t.embeddings, 5, others_only=True, same="label").withColumn("distance", F.round("distance", 6))


@query(f"SELECT query_id, round(min(distance), 6) AS best FROM {NEAREST} GROUP BY 1 HAVING min(distance) > 0.45")
def smoke_failures(t: Tables) -> DataFrame:
    return index.smoke_failures(_hits(t), _asked(t)).withColumn("best", F.round("best", 6))


RESULTS = f"""(SELECT query_id::VARCHAR AS query_id, CASE WHEN min(distance) <= 0.45 THEN 'ok' ELSE 'low_confidence' END AS status, arg_min('label' || label, rank) AS rank1_source_type, '{{"page":"label' || any_value(query_label) || '","markers":[]}}' AS identity,
min(rank) FILTER (label = query_label)::INT AS rank, arg_min(distance, rank) FILTER (label = query_label) AS distance, count(*) FILTER (label = query_label) > 0 AS hit FROM {NEAREST} GROUP BY query_id)"""


def _shown() -> dict[str, F.Column]:
    """Misses as numbers: an outer rank and distance."""
    return {"rank": F.coalesce("rank", F.lit(C.MISS_RANK)), "distance": F.round(F.coalesce("distance", F.lit(9.0)), 6)}


def _results(t: Tables, hits: DataFrame | None = None) -> DataFrame:
    """Target of a query: any vector of its own label."""
    found = (_hits(t) if hits is None else hits).join(t.embeddings.select("vec_id", "label"), "vec_id")
    page = F.concat(F.lit("label"), "label")
    hits = found.select(F.col("query_id").cast("string").alias("query_id"), F.col("rank").alias("position"), page.alias("page_key"), F.lit("").alias("content"), "distance", page.alias("source_type"))
    groups = _asked(t).select(F.col("query_id").cast("string").alias("query_id"), F.lit(0).alias("group_index"), F.concat(F.lit("label"), "query_label").alias("page_match"), F.array().cast("array<string>").alias("markers"))
    return evaluate.run_suite(hits, groups)


@query(f"SELECT query_id, status, rank1_source_type, 0 AS group_index, identity, coalesce(rank, 99) AS rank, round(coalesce(distance, 9), 6) AS distance, hit FROM {RESULTS}")
def suite_results(t: Tables) -> DataFrame:
    return _results(t).withColumns(_shown())


@query(f"SELECT query_id, coalesce(rank, 99) AS rank, round(coalesce(distance, 9), 6) AS distance, hit FROM {RESULTS}")
def best_groups(t: Tables) -> DataFrame:
    return evaluate.best_groups(_results(t)).select("query_id", "rank", "distance", "hit").withColumns(_shown())


@query(f"SELECT identity, arg_min(coalesce(rank, 99), (coalesce(rank, 99), coalesce(distance, 9))) AS rank, round(coalesce(min(distance) FILTER (rank IS NOT DISTINCT FROM least_rank), 9), 6) AS distance FROM (SELECT *, min(rank) OVER (PARTITION BY identity) AS least_rank FROM {RESULTS}) GROUP BY 1")
def unique_groups(t: Tables) -> DataFrame:
    return evaluate.unique_groups(_results(t)).withColumns(_shown())


@query(f"SELECT count(*) AS queries, count(*) FILTER (hit) AS recalled, round(avg(coalesce(1.0::DOUBLE / rank, 0)), 9) AS mrr FROM {RESULTS}")
def mrr_recall(t: Tables) -> DataFrame:
    return _results(t).agg(F.count(F.lit(1)).alias("queries"), F.count_if("hit").alias("recalled"), F.round(evaluate.mean_reciprocal_rank(F.col("rank")), 9).alias("mrr"))


OTHER = RESULTS.replace(NEAREST, SAME)


@query(f"""WITH a AS MATERIALIZED (SELECT * FROM {RESULTS}), b AS MATERIALIZED (SELECT * FROM {OTHER})
SELECT query_id, 0 AS group_index, unnest(list_filter([CASE WHEN a.status <> b.status THEN 'status' END, CASE WHEN a.rank IS DISTINCT FROM b.rank THEN 'ranks' END, CASE WHEN a.hit <> b.hit THEN 'recall' END,
CASE WHEN (a.distance IS NULL) <> (b.distance IS NULL) THEN 'presence' END, CASE WHEN abs(a.distance - b.distance) > 1e-4 THEN 'distances' END], lambda x: x IS NOT NULL)) AS failure FROM a JOIN b USING (query_id)""")
def run_comparison(t: Tables) -> DataFrame:
    return evaluate.compare_results(_results(t), _results(t, knn_filtered(t)))


SUITE = (*gates.PRIMARY, *gates.OFFICIAL, *gates.EXPOSED[:5])


def _listed(ids: tuple[str, ...]) -> str:
    return ",".join(f"'{i}'" for i in ids)


def _named(results: DataFrame) -> DataFrame:
    """The suite's names dealt to all searched queries; those that share a name are its target groups."""
    number = F.col("query_id").cast("long")
    names = F.array(*[F.lit(i) for i in SUITE])
    return results.withColumns({"query_id": F.get(names, (number % len(SUITE)).cast("int")), "group_index": F.floor(number / len(SUITE)).cast("int")})


@query(f"""WITH a AS MATERIALIZED (SELECT ([{_listed(SUITE)}])[query_id::BIGINT % {len(SUITE)} + 1] AS q, query_id::BIGINT // {len(SUITE)} AS g, * FROM {RESULTS}),
w AS MATERIALIZED (SELECT ([{_listed(SUITE)}])[query_id::BIGINT % {len(SUITE)} + 1] AS q, query_id::BIGINT // {len(SUITE)} AS g, hit FROM {OTHER}),
n AS (SELECT unnest([{_listed(SUITE)}]) AS q), p AS (SELECT q, coalesce(bool_or(hit), false) AS p FROM n LEFT JOIN a USING (q) GROUP BY q),
best AS (SELECT n.q, rank, distance, status, rank1_source_type FROM n LEFT JOIN (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY q ORDER BY rank IS NULL, coalesce(rank, 0), coalesce(distance, 'inf'::DOUBLE), g) = 1) b USING (q)),
u AS (SELECT identity, min(rank) AS rank FROM a WHERE q IN ({_listed(gates.PRIMARY)}) GROUP BY 1), ud AS (SELECT u.identity, u.rank, min(a.distance) AS distance FROM u LEFT JOIN a ON a.identity = u.identity AND a.rank = u.rank AND q IN ({_listed(gates.PRIMARY)}) GROUP BY 1, 2),
r AS (SELECT w.hit AS was, a.hit AS now FROM w JOIN a USING (q, g) WHERE q IN ({_listed(gates.IDENTIFIER)})),
f AS (
SELECT 'generic' AS gate, 'failure' AS severity, (count(*) FILTER (p) < 4)::INT AS n FROM p WHERE q IN ({_listed(gates.GENERIC)}) UNION ALL SELECT 'identifier', 'failure', count(*) FROM p WHERE NOT p AND q IN ({_listed(gates.IDENTIFIER)})
UNION ALL SELECT 'task', 'failure', (count(*) FILTER (p) < 4)::INT FROM p WHERE q IN ({_listed(gates.TASK)}) UNION ALL SELECT 'companion', 'failure', (count(*) FILTER (p) < 14)::INT FROM p WHERE q IN ({_listed(gates.PRIMARY)})
UNION ALL SELECT 'companion', 'failure', (count(rank) < 15)::INT + (count(*) FILTER (distance <= 0.45) < 14)::INT + coalesce(avg(coalesce(1.0::DOUBLE / rank, 0)) < 0.65 - 1e-9, true)::INT FROM ud
UNION ALL SELECT 'mandatory', 'failure', (NOT p)::INT FROM p WHERE q = 'G01' UNION ALL SELECT 'mandatory', 'failure', (NOT coalesce(hit, false))::INT FROM (SELECT unnest(['T02', 'T03', 'T03']) AS q, unnest([0, 0, 1]) AS g) LEFT JOIN a USING (q, g)
UNION ALL SELECT 'rescue', 'failure', coalesce(rank > 2, true)::INT + coalesce(distance > 0.45, true)::INT + coalesce(status <> 'ok', true)::INT FROM best WHERE q = 'G01'
UNION ALL SELECT 'official', 'failure', coalesce(rank > 3, true)::INT + coalesce(distance > 0.45, true)::INT + coalesce(rank1_source_type <> 'official', true)::INT FROM best WHERE q IN ({_listed(gates.OFFICIAL)})
UNION ALL SELECT 'exposed', 'failure', coalesce(rank > 2, true)::INT + coalesce(distance > 0.45, true)::INT + coalesce(status <> 'ok', true)::INT FROM best WHERE q = 'E01' UNION ALL SELECT 'exposed', 'failure', (NOT hit)::INT FROM a WHERE q IN ({_listed(gates.EXPOSED[1:5])})
UNION ALL SELECT 'identifier-regression', 'failure', (was AND NOT now)::INT FROM r UNION ALL SELECT 'identifier-regression', 'advisory', (NOT was AND NOT now)::INT FROM r)
SELECT gate, severity, sum(n)::BIGINT AS n FROM f GROUP BY 1, 2 HAVING sum(n) > 0""")
def release_gates(t: Tables) -> DataFrame:
    """All searched queries as one suite, held against the filtered search as the run before: failures and notes by gate."""
    report = gates.full_release(_named(_results(t)), _named(_results(t, knn_filtered(t))))
    return report.groupBy("gate", "severity").agg(F.count(F.lit(1)).alias("n"))


# *** parsers


def _pages(t: Tables) -> DataFrame:
    return t.pages.select(F.concat(F.lit("page_"), F.col("page_id"), F.lit(".html")).alias("file"), "html")


# a page's article is its heading, then one paragraph that nothing closes: its strings, trimmed, with spaces between
def _unescaped(text: str) -> str:
    for name, char in (("&quot;", '"'), ("&#x27;", "''"), ("&lt;", "<"), ("&gt;", ">"), ("&quot", '"'), ("&amp;", "&"), ("&amp", "&")):
        text = f"replace({text}, '{name}', '{char}')"
    return f"trim({text}, E' \\n\\t')"


SECTIONS = f"""(SELECT 'page_' || page_id || '.html' AS file, {_unescaped("regexp_extract(html, '<h1>(.*?)</h1>', 1)")} AS heading,
array_to_string(list_filter(list_transform(string_split(regexp_replace(regexp_extract(html, '(?s)</h1>(.*?)</article>', 1), '<[^>]*>', chr(1), 'g'), chr(1)), lambda x: {_unescaped("x")}), lambda x: x <> ''), ' ') AS body FROM pages)"""


@query(f"SELECT file, 0 AS pos, 'h1' AS heading_tag, heading AS heading_text, '' AS breadcrumb, sha256(body) AS text_sha FROM {SECTIONS}")
def html_sections(t: Tables) -> DataFrame:
    found = chunks.html_sections(_pages(t), element="article")
    return found.select("file", "pos", "heading_tag", "heading_text", "breadcrumb", C.sha256(F.col("content_text")).alias("text_sha"))


PAGE_CHUNKS = f"(SELECT *, CASE WHEN length(body) // 4 > 1200 THEN heading || chr(10) || body ELSE body END AS content FROM {SECTIONS})"


@query(f"SELECT file, replace(file, '.html', '') || '_000' AS id, heading AS title, 'file:' || replace(file, '.html', '') AS page_key, 'Unknown' AS category, sha256(content) AS content_sha, (length(content) // 4)::INT AS token_estimate, 0 AS chunk_index FROM {PAGE_CHUNKS} WHERE content <> ''")
def page_chunks(t: Tables) -> DataFrame:
    made = chunks.chunk_pages(_pages(t), element="article")
    return made.select("file", "id", "title", "page_key", "category", C.sha256(F.col("content")).alias("content_sha"), "token_estimate", "chunk_index")


@query(f"SELECT 'official:file:' || replace(file, '.html', '') AS record, (strlen(heading) + 1)::BIGINT AS first_byte, (strlen(heading) + 1 + strlen(body))::BIGINT AS last_byte, strlen(body)::BIGINT AS covered, true AS fits FROM {SECTIONS} WHERE body <> ''")
def span_coverage(t: Tables) -> DataFrame:
    """Spans of the exact-budget chunks tile each page's text, and no chunk is over its budget."""
    made = chunks.span_chunk_pages(_pages(t), element="article")
    size = F.col("source_end_byte") - F.col("source_start_byte")
    return made.groupBy(F.col("source_record_id").alias("record")).agg(F.min("source_start_byte").alias("first_byte"), F.max("source_end_byte").alias("last_byte"), F.sum(size).alias("covered"), F.bool_and(F.col("embedding_token_count") <= 254).alias("fits"))


def _files(t: Tables) -> DataFrame:
    none = lambda k: F.lit(None).cast(k)
    return t.documents.select(
        F.concat("source", F.lit("/d"), "doc_id", F.lit(".md")).alias("path"), F.lit("Some title").alias("title"), F.col("lang").alias("area"), none("array<string>").alias("sections"), none("array<string>").alias("drop_sections"),
        F.lit(True).alias("strip_xml_blocks"), *[F.lit(v).alias(k) for k, v in (("upstream_repo", "r"), ("upstream_commit", "c"), ("raw_url", "u"), ("blob_url", "b"), ("latest_url", "l"))], "text",
    )


BODY = r"trim(text, E' \n\t\r\v\f')"


@query(f"SELECT source || '/d' || doc_id || '.md' AS path, 0 AS level, '' AS heading, sha256({BODY}) AS body_sha, (strlen(text) - strlen(ltrim(text, E' \\n\\t\\r\\v\\f')))::BIGINT AS start_byte, (strlen(text) - strlen(ltrim(text, E' \\n\\t\\r\\v\\f')) + strlen({BODY}))::BIGINT AS end_byte FROM documents WHERE {BODY} <> ''")
def markdown_sections(t: Tables) -> DataFrame:
    """The documents have no headings: each is a preamble."""
    found = chunks.markdown_sections(_files(t), curated=True)
    return found.select("path", "level", "heading", C.sha256(F.col("body")).alias("body_sha"), F.col("body_start_byte").alias("start_byte"), F.col("body_end_byte").alias("end_byte"))


@query(f"SELECT 'companion://r/' || source || '/d' || doc_id || '.md' AS record, strlen({BODY})::BIGINT AS covered, true AS fits FROM documents WHERE {BODY} <> ''")
def markdown_span_coverage(t: Tables) -> DataFrame:
    made = chunks.span_chunk_markdown(_files(t))
    size = F.col("source_end_byte") - F.col("source_start_byte")
    return made.groupBy(F.col("source_record_id").alias("record")).agg(F.sum(size).alias("covered"), F.bool_and(F.col("embedding_token_count") <= 254).alias("fits"))


@query(r"""SELECT doc_id, concat_ws(chr(10), CASE WHEN NOT starts_with(first, lang) THEN lang END, CASE WHEN NOT starts_with(first, source) THEN source END) AS header,
(CASE WHEN NOT starts_with(first, lang) THEN (length(lang) + 3) // 4 ELSE 0 END + CASE WHEN NOT starts_with(first, source) THEN (length(source) + 3) // 4 ELSE 0 END)::INT AS tokens
FROM (SELECT doc_id, lang, source, trim(regexp_replace(lower(split_part(text, chr(10), 1)), '\s+', ' ', 'g')) AS first FROM documents)""")
def context_headers(t: Tables) -> DataFrame:
    """Title: the source; breadcrumb: language, then the source again, which is left out."""
    counter = QuarterTokenizer()

    def one(row: rows.Row) -> list[rows.Row]:
        head = build(COMPANION, row["source"], f"{row['lang']} > {row['source']}", row["text"].split("\n", 1)[0], counter)
        return [{"doc_id": row["doc_id"], "header": head.text, "tokens": head.tokens}]

    return rows.flat_map(t.documents.select("doc_id", "lang", "source", "text"), one, "doc_id long, header string, tokens int")


@query()
def structural_identifiers(t: Tables) -> DataFrame:
    """Of markup as well as words: no SQL, tests have the expectations."""
    found = F.udf(I.identifiers, "array<string>", useArrow=True)
    ratio = F.udf(lambda text: I.code_ratio(text, QuarterTokenizer()), "double", useArrow=True)
    return t.pages.select("page_id", F.array_join(found("html"), " ").alias("names"), ratio("html").alias("code_ratio"))


@query(r"""SELECT item_id::VARCHAR AS query_id, '{"page":"src","markers":' || to_json([text]) || '}' AS identity, CASE WHEN contains((SELECT string_agg(trim(regexp_replace(text, '\s+', ' ', 'g')), ' ' ORDER BY source, doc_id) FROM documents), trim(regexp_replace(b.text, '\s+', ' ', 'g'))) THEN 'split' ELSE 'missing' END AS error
FROM benchmark b WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE contains(d.text, b.text))""")
def fixture_errors(t: Tables) -> DataFrame:
    """Benchmark passages as markers of any page."""
    own = t.documents.select(F.col("source").alias("page_key"), F.col("doc_id").alias("chunk_index"), F.col("text").alias("content"))
    wanted = t.benchmark.select(F.col("item_id").cast("string").alias("query_id"), F.lit(0).alias("group_index"), F.lit("src").alias("page_match"), F.array("text").alias("markers"))
    return evaluate.fixture_errors(own, wanted)


@query(f"""SELECT s.conv_id::VARCHAR AS query_id, 0 AS target_index, s.conv_id || '-' || s.turn AS id FROM ({SPANS}) s WHERE s.size > 0 AND s.start_byte < 300
UNION ALL SELECT c.conv_id::VARCHAR, 1, c.conv_id || '-' || c.turn FROM conversations c WHERE c.role = 'assistant'""")
def holdout_matches(t: Tables) -> DataFrame:
    """Of each conversation, a target at its first 300 bytes and one at its assistant's turns."""
    spans = _spans(t).join(t.conversations.select("conv_id", "turn", "role"), ["conv_id", "turn"])
    own = spans.select(F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("conv_id").cast("string").alias("source_record_id"), F.col("start_byte").alias("source_start_byte"), (F.col("start_byte") + F.col("size")).alias("source_end_byte"), F.col("role").alias("section_heading"))
    record = F.col("conv_id").cast("string")
    base = t.conversations.select("conv_id").distinct()
    byte = base.select(record.alias("query_id"), F.lit(0).alias("target_index"), record.alias("source_record_id"), F.lit(0).cast("long").alias("start_byte"), F.lit(300).cast("long").alias("end_byte"), F.lit(None).cast("string").alias("section_heading"))
    heading = base.select(record, F.lit(1), record, F.lit(None).cast("long"), F.lit(None).cast("long"), F.lit(" Assistant"))
    return evaluate.match_holdout(byte.union(heading), own)


@query("SELECT d.doc_id::VARCHAR AS cache_key, CASE WHEN l.doc_id IS NULL THEN 'removed' ELSE 'modified' END AS error FROM documents d LEFT JOIN labels l USING (doc_id) WHERE l.quality IS DISTINCT FROM 1")
def cache_changes(t: Tables) -> DataFrame:
    old = t.documents.select(F.col("doc_id").cast("string").alias("cache_key"), F.lit(1).alias("value"))
    return cache.immutability_errors(old, t.labels.select(F.col("doc_id").cast("string").alias("cache_key"), F.col("quality").alias("value")))


@query("""SELECT coalesce(d.id, l.id) AS id, unnest(list_filter([CASE WHEN d.id IS NULL OR l.id IS NULL THEN 'ids' END, CASE WHEN d.raw_document <> l.raw_document THEN 'raw_document' END], lambda x: x IS NOT NULL)) AS failure
FROM (SELECT doc_id::VARCHAR AS id, '1' AS raw_document FROM documents) d FULL JOIN (SELECT doc_id::VARCHAR AS id, quality::VARCHAR AS raw_document FROM labels) l ON d.id = l.id""")
def input_comparison(t: Tables) -> DataFrame:
    side = lambda df, value: df.select(F.col("doc_id").cast("string").alias("id"), value.cast("string").alias("raw_document"))
    return evaluate.compare_inputs(side(t.documents, F.lit(1)), side(t.labels, F.col("quality")))


@query("SELECT cache_key, unnest(list_filter([CASE WHEN lang IS NULL THEN 'x' END, CASE WHEN lang NOT IN ('ok', 'raw_fallback') THEN 'unknown status' END], lambda x: x IS NOT NULL)) AS error FROM (SELECT doc_id::VARCHAR AS cache_key, CASE lang WHEN 'en' THEN 'ok' WHEN 'fr' THEN 'raw_fallback' ELSE lang END AS lang FROM documents) UNION ALL SELECT doc_id::VARCHAR, 'key exists' FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def append_errors(t: Tables) -> DataFrame:
    status = F.when(F.col("lang") == "en", "ok").when(F.col("lang") == "fr", "raw_fallback").otherwise(F.col("lang"))
    return cache.append_errors(t.labels.select(F.col("doc_id").cast("string").alias("cache_key")), t.documents.select(F.col("doc_id").cast("string").alias("cache_key"), status.alias("status")))


DRIFTS = ("file", "file", "title", "area", "priority", "sections", "drop_sections", "strip_xml_blocks")


@query(f"""SELECT 'd/' || doc_id || '.md' AS path, ([{",".join(f"'{d}'" for d in DRIFTS)}])[doc_id % 9 + 1] AS field FROM documents WHERE doc_id % 9 < 8""")
def policy_drift(t: Tables) -> DataFrame:
    """Documents as source files, each with one difference: on one side only, or in a field. Order of sections doesn't count."""
    from sparkloom.sources import readers

    k = F.col("doc_id") % 9

    def policy(other: bool) -> DataFrame:
        own = lambda n, a, b: F.when(k == n, b).otherwise(a) if other else a
        names = [F.lit("y"), F.lit("x")] if other else [F.lit("x"), F.lit("y")]
        return t.documents.where(k != (0 if other else 1)).select(
            F.concat(F.lit("d/"), "doc_id", F.lit(".md")).alias("path"), own(2, F.col("lang"), F.lit("other")).alias("title"), own(3, F.lit("a"), F.lit("b")).alias("area"), own(4, F.lit(1), F.lit(2)).alias("priority"),
            own(5, F.array(*names), F.array(F.lit("x"))).alias("sections"), own(6, F.array(F.lit("z")), F.array(F.lit("z"), F.lit("w"))).alias("drop_sections"), own(7, F.lit(True), F.lit(False)).alias("strip_xml_blocks"),
        )

    return readers.policy_drift(policy(False), policy(True)).select("path", "field")


@query(f"SELECT url, depth FROM {NODES} ORDER BY md5('7' || url) LIMIT 20")
def sampled_urls(t: Tables) -> DataFrame:
    return tree.sample_urls(_nodes(t)).select("url", "depth")


# *** streams

WINDOWS = "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, sum(value::DECIMAL(18, 6))::DOUBLE AS total FROM events GROUP BY 1, 2"


def _windowed(events: DataFrame) -> DataFrame:
    exact = events.withColumn("value", F.col("value").cast("decimal(18,6)"))
    return ingest.windowed_counts(exact, "ts", "event_type", "value").select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.col("total").cast("double").alias("total"))


@query(WINDOWS)
def event_windows(t: Tables) -> DataFrame:
    return _windowed(t.events)


@query(WINDOWS)
def stream_windows(t: Tables) -> DataFrame:
    """The same counts from the table read as a stream of files."""
    schema = t.events.schema
    stream = t.spark.readStream.schema(schema).format("parquet").option("pathGlobFilter", "events.parquet").load(t.sf_dir)
    return ingest.run_to_table(_windowed(stream), t.scratch("windows"), t.scratch("checkpoint"))


@query("SELECT count(*) AS n, count(DISTINCT event_id) AS ids FROM events")
def stream_first_arrivals(t: Tables) -> DataFrame:
    stream = t.spark.readStream.schema(t.events.schema).format("parquet").option("pathGlobFilter", "events.parquet").load(t.sf_dir)
    found = ingest.run_to_table(ingest.first_arrivals(stream, ["event_id"], "ts"), t.scratch("arrivals"), t.scratch("checkpoint"), "append")
    return found.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


def queries() -> dict[str, Query]:
    from sparkloom.plans import parsing, release  # noqa: F401 - they register theirs

    return {name: r.run for name, r in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    queries()
    return {name: r.sql for name, r in REGISTRY.items() if r.sql}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages to chunks to counts by category and page."""
    made = chunks.chunk_pages(_pages(Tables(spark, sf_dir)), element="article")
    return made.groupBy("page_key", "category").agg(F.count(F.lit(1)).alias("chunks"), F.sum("token_estimate").alias("tokens"), F.max("chunk_index").alias("last_index"))
