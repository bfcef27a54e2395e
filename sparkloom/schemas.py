"""Row types of the engine's tables, as DDL."""

PROVENANCE = "source_type string, verification_status string, upstream_repo string, upstream_commit string, source_path string, raw_url string, latest_url string"
URL_NODE = "node_id long, url string, parent_id long, root_index int, depth int, path string"
SIDEBAR_ITEM = "pos int, level int, href string, text string, is_category boolean, is_current boolean"
HTML_SECTION = "file string, pos int, heading_tag string, heading_text string, breadcrumb string, source_url string, content_text string, content_html string, page_title string"
MARKDOWN_SECTION = "path string, pos int, level int, heading string, body string, body_start_byte long, body_end_byte long"
CHUNK_CORE = "id string, title string, section_heading string, breadcrumb string, source_url string, page_key string, category string, content string, content_html string, token_estimate int"
CHUNK = f"file string, ord int, {CHUNK_CORE}, {PROVENANCE}"
WRAPPER = "struct<heading_line: boolean, fence_open: string, fence_close: string, stripped_xml: boolean, spans: array<array<long>>>"
SPAN_FIELDS = (
    "source_record_id string, source_start_byte long, source_end_byte long, source_token_count int, content_token_count int, "
    f"embedding_token_count int, s6_header string, synthetic_wrapper_metadata {WRAPPER}"
)
SPAN_CHUNK = f"{CHUNK}, {SPAN_FIELDS}"
FRAGMENT = "pos int, text string, start_byte long, end_byte long, fence_open string, fence_close string"
CACHE_RECORD = (
    "cache_key string, status string, description string, identifiers array<string>, prompt_version string, requested_model_id string, "
    "returned_model_id string, raw_content_sha256 string, generation_input_sha256 string, generator_contract_sha256 string"
)
EVAL_GROUP = "query_id string, group_index int, page_match string, markers array<string>"
RESULT = "query_id string, status string, rank1_source_type string, group_index int, identity string, rank int, distance double, hit boolean"
HOLDOUT_TARGET = "query_id string, query string, family string, target_index int, source_record_id string, start_byte long, end_byte long, section_heading string"
SOURCE_FILE = "path string, title string, area string, priority int, sections array<string>, drop_sections array<string>, strip_xml_blocks boolean"
SNAPSHOT_FILE = "path string, sha256 string, bytes long"
FETCHED = "url string, status int, content_type string, text string"
