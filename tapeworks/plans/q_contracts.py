"""Contract documents and rule queries (§2.1 A1/A2/A4/A5, §2.2 S1–S7,
§2.3 V1–V10, V25, V26)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.uri import content_type, content_type_sql, path_segment, split_s3_uri
from tapeworks.operators import rules as R
from tapeworks.operators.payload import message_payload
from tapeworks.plans import bindings as B
from tapeworks.plans.catalog import register
from tapeworks.sources.contracts import CONTRACTS, lax_int, parse_contract, to_contract_json
from tapeworks.sources.tables import table

_S3_RE = r"(?i)^s3://[^/?#]+/[^?#]*[^/?#][^?#]*[?]?#?$"
_SHA_RE = "^[0-9a-f]{64}$"
_ART_KNOWN = "'schema_version', 'uri', 'content_type', 'size', 'etag', 'version_id', 'sha256'"


def _artifacts(spark: SparkSession, sf: str) -> DataFrame:
    return parse_contract(B.artifact_docs(spark, sf), "raw", CONTRACTS["artifact"], checked=False)


_ART_SQL = f"""art AS (
  SELECT doc_id, raw,
    coalesce(json_extract_string(raw, '$.schema_version'), '1.0') AS schema_version,
    coalesce(json_extract_string(raw, '$.schema_version'), '1.0') = '1.0' AS version_ok,
    trim(json_extract_string(raw, '$.uri')) AS uri,
    trim(json_extract_string(raw, '$.content_type')) AS content_type,
    CAST(json_extract(raw, '$.size') AS BIGINT) AS size,
    trim(json_extract_string(raw, '$.etag')) AS etag,
    trim(json_extract_string(raw, '$.sha256')) AS sha256,
    array_to_string(list_sort(list_filter(json_keys(raw), lambda k: k NOT IN ({_ART_KNOWN}))), ',') AS unknown_fields
  FROM artifact_docs)"""


def _art_sql(body: str) -> str:
    return B.with_sql(["artifact_docs"], f"WITH {_ART_SQL}\n{body}")


_TYPED_SQL = f"""typed AS (
  SELECT doc_id, raw, json_valid(raw) AS readable, CASE WHEN json_valid(raw) THEN raw ELSE '{{}}' END AS j FROM typed_docs),
parts AS (
  SELECT *, json_type(j, '$.schema_version') AS version_type, json_extract_string(j, '$.schema_version') AS version_text,
    json_type(j, '$.size') AS size_type, json_extract_string(j, '$.size') AS size_text, json_type(j, '$.etag') AS etag_type,
    trim(json_extract_string(j, '$.uri')) AS uri, trim(json_extract_string(j, '$.content_type')) AS content_type,
    trim(json_extract_string(j, '$.sha256')) AS sha256,
    list_sort(list_filter(json_keys(j), lambda k: k NOT IN ({_ART_KNOWN}))) AS others FROM typed),
vals AS (
  SELECT *, CASE WHEN NOT readable THEN NULL WHEN version_type IS NULL THEN '1.0' WHEN version_type = 'VARCHAR' THEN version_text END AS schema_version,
    CASE WHEN size_type IN ('BIGINT', 'UBIGINT') THEN CAST(size_text AS BIGINT)
         WHEN size_type = 'DOUBLE' AND floor(CAST(size_text AS DOUBLE)) = CAST(size_text AS DOUBLE) THEN CAST(CAST(size_text AS DOUBLE) AS BIGINT)
         WHEN size_type = 'BOOLEAN' THEN CASE WHEN size_text = 'true' THEN 1 ELSE 0 END
         WHEN size_type = 'VARCHAR' AND regexp_matches(size_text, '^[+-]?\\d+$') THEN TRY_CAST(size_text AS BIGINT) END AS size,
    CASE WHEN etag_type = 'VARCHAR' THEN trim(json_extract_string(j, '$.etag')) END AS etag FROM parts),
coded AS (
  SELECT *, CASE WHEN NOT readable THEN ['json'] ELSE list_filter([
    CASE WHEN version_type = 'NULL' THEN 'schema_version:null' WHEN version_type <> 'VARCHAR' THEN 'schema_version:string_type'
         WHEN version_text <> '1.0' THEN 'schema_version:enum' END,
    CASE WHEN NOT regexp_matches(uri, '{_S3_RE}') THEN 'uri:s3_uri' END,
    CASE WHEN length(content_type) < 1 THEN 'content_type:too_short' END,
    CASE WHEN size IS NULL THEN 'size:int_type' WHEN size < 0 THEN 'size:too_small' END,
    CASE WHEN etag_type <> 'VARCHAR' THEN 'etag:string_type' WHEN length(etag) < 1 THEN 'etag:too_short' END,
    CASE WHEN NOT regexp_matches(sha256, '{_SHA_RE}') THEN 'sha256:pattern' END,
    CASE WHEN len(others) > 0 THEN array_to_string(list_transform(others, lambda k: k || ':unknown'), ',') END], lambda c: c IS NOT NULL) END AS codes
  FROM vals)"""


def _typed_sql(body: str) -> str:
    return B.with_sql(["typed_docs"], f"WITH {_TYPED_SQL}\n{body}")


def _typed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_contract(B.typed_docs(spark, sf), "raw", CONTRACTS["artifact"])


@register("contract_read", _typed_sql("""
SELECT doc_id, schema_version, coalesce(schema_version = '1.0', false) AS version_ok, uri, content_type, size, etag, sha256,
       coalesce(array_to_string(others, ','), '') AS unknown_fields, array_to_string(codes, ',') AS codes FROM coded"""))
def contract_read(spark: SparkSession, sf: str) -> DataFrame:
    """A1: strict read of artifact JSON documents: typed values, and the codes of
    all that is wrong with each."""
    a = _typed(spark, sf)
    return a.select("doc_id", "schema_version", "version_ok", "uri", "content_type", "size", "etag", "sha256",
                    F.array_join("unknown_fields", ",").alias("unknown_fields"), F.array_join("codes", ",").alias("codes"))


@register("schema_unknown_fields", _art_sql("""
SELECT doc_id, unknown_fields FROM art WHERE unknown_fields <> ''"""))
def schema_unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Documents carrying undeclared fields, with the field names."""
    a = parse_contract(B.artifact_docs(spark, sf), "raw", CONTRACTS["artifact"]).filter(F.size("unknown_fields") > 0)
    return a.select("doc_id", F.array_join("unknown_fields", ",").alias("unknown_fields"))


@register("schema_version_gate", _art_sql("SELECT doc_id, schema_version, version_ok FROM art"))
def schema_version_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Only version 1.0 passes; a missing version means 1.0."""
    return _artifacts(spark, sf).select("doc_id", "schema_version", "version_ok")


@register("schema_strip", _art_sql("""
SELECT doc_id, json_extract_string(raw, '$.uri') AS raw_uri, uri,
       length(json_extract_string(raw, '$.uri')) - length(uri) AS stripped_chars FROM art"""))
def schema_strip(spark: SparkSession, sf: str) -> DataFrame:
    """S3: string values are stripped before any rule sees them."""
    a = _artifacts(spark, sf).withColumn("raw_uri", F.get_json_object("raw", "$.uri"))
    return a.select("doc_id", "raw_uri", "uri", (F.length("raw_uri") - F.length("uri")).alias("stripped_chars"))


@register("rule_s3_uri", _art_sql(f"""
SELECT doc_id, uri, coalesce(regexp_matches(uri, '{_S3_RE}'), false) AS ok FROM art"""))
def rule_s3_uri(spark: SparkSession, sf: str) -> DataFrame:
    """V1: object URIs need scheme s3, a bucket and a key; no query/fragment."""
    a = _artifacts(spark, sf)
    return a.select("doc_id", "uri", F.coalesce(R.s3_uri("uri").ok, F.lit(False)).alias("ok"))


@register("artifact_uri_split", _art_sql(f"""
SELECT doc_id, regexp_extract(uri, '^[^:]+://([^/?#]+)', 1) AS bucket,
       regexp_extract(uri, '^[^:]+://[^/?#]+/([^?#]*)', 1) AS key
FROM art WHERE regexp_matches(uri, '{_S3_RE}')"""))
def artifact_uri_split(spark: SparkSession, sf: str) -> DataFrame:
    """A5: valid object URIs split into bucket and key."""
    a = _artifacts(spark, sf).withColumn("_s", split_s3_uri("uri")).filter(F.col("_s").isNotNull())
    return a.select("doc_id", F.col("_s.bucket").alias("bucket"), F.col("_s.key").alias("key"))


@register("rule_sha256", _art_sql(f"""
SELECT doc_id, sha256, sha256 IS NULL OR regexp_matches(sha256, '{_SHA_RE}') AS ok FROM art"""))
def rule_sha256(spark: SparkSession, sf: str) -> DataFrame:
    """V4: sha256 is 64 lowercase hex characters."""
    a = _artifacts(spark, sf)
    return a.select("doc_id", "sha256", R.sha256("sha256").ok.alias("ok"))


@register("rule_min_length", _art_sql("""
SELECT doc_id, content_type IS NULL OR length(content_type) >= 1 AS content_type_ok,
       etag IS NULL OR length(etag) >= 1 AS etag_ok FROM art"""))
def rule_min_length(spark: SparkSession, sf: str) -> DataFrame:
    """V7: text fields are non-empty after stripping."""
    a = _artifacts(spark, sf)
    return a.select("doc_id", R.min_length("content_type", 1, "ct", optional=True).ok.alias("content_type_ok"),
                    R.min_length("etag", 1, "etag", optional=True).ok.alias("etag_ok"))


@register("rule_bounds", """
SELECT event_id, value, CAST(value AS VARCHAR) AS token,
       value >= 0 AS non_negative, value > 0 AS positive,
       value BETWEEN 0 AND 51 AS crf_range, value BETWEEN 0 AND 1 AS probability_range
FROM events""")
def rule_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """V3: the contracts' numeric bounds (>=0, >0, crf 0..51, probability 0..1)."""
    e = table(spark, sf, "events")
    v = F.col("value")
    return e.select("event_id", "value", v.cast("string").alias("token"),
                    R.bounds(v, "nn", lo=0).ok.alias("non_negative"),
                    R.bounds(v, "pos", lo=0, strict_lo=True).ok.alias("positive"),
                    R.bounds(v, "crf", lo=0, hi=51).ok.alias("crf_range"),
                    R.bounds(v, "p", lo=0, hi=1).ok.alias("probability_range"))


@register("schema_lax_int", """
SELECT event_id, CAST(value AS VARCHAR) AS token,
  CASE WHEN regexp_matches(CAST(value AS VARCHAR), '^[+-]?\\d+$') THEN CAST(CAST(value AS VARCHAR) AS BIGINT)
       WHEN regexp_matches(CAST(value AS VARCHAR), '^[+-]?\\d+\\.0*$') THEN CAST(value AS BIGINT) END AS as_int
FROM events""")
def schema_lax_int(spark: SparkSession, sf: str) -> DataFrame:
    """Integer fields accept ``12`` and ``12.0``, refuse ``6.55`` (null)."""
    e = table(spark, sf, "events")
    tok = F.col("value").cast("string")
    return e.select("event_id", tok.alias("token"), lax_int(tok).alias("as_int"))


_ART_RULES_SQL = f"""
SELECT doc_id,
  CASE WHEN NOT version_ok THEN 'schema_version'
       WHEN uri IS NULL THEN 'uri_required'
       WHEN NOT regexp_matches(uri, '{_S3_RE}') THEN 'uri'
       WHEN content_type IS NULL THEN 'content_type_required'
       WHEN length(content_type) < 1 THEN 'content_type'
       WHEN size < 0 THEN 'size'
       WHEN etag IS NOT NULL AND length(etag) < 1 THEN 'etag'
       WHEN sha256 IS NOT NULL AND NOT regexp_matches(sha256, '{_SHA_RE}') THEN 'sha256'
       WHEN unknown_fields <> '' THEN 'extra_forbidden' END AS error_code
FROM art"""


@register("validate_split", _typed_sql("""
SELECT doc_id, len(codes) = 0 AS valid, codes[1] AS error_code FROM coded"""))
def validate_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every document is either valid or quarantined with its first error."""
    valid, bad = R.split_by_codes(_typed(spark, sf))
    return (valid.select("doc_id", F.lit(True).alias("valid"), F.lit(None).cast("string").alias("error_code"))
            .unionByName(bad.select("doc_id", F.lit(False).alias("valid"), "error_code")))


@register("contract_roundtrip", _art_sql(f"""
SELECT doc_id, json_object('schema_version', schema_version, 'uri', uri, 'content_type', content_type,
    'size', size, 'etag', etag, 'version_id', NULL, 'sha256', sha256)::VARCHAR AS json
FROM ({_ART_RULES_SQL}) JOIN art USING (doc_id) WHERE error_code IS NULL"""))
def contract_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A2: valid documents written back as canonical JSON (nulls kept)."""
    valid, _ = R.split_by_codes(parse_contract(B.artifact_docs(spark, sf), "raw", CONTRACTS["artifact"]))
    cols = ["schema_version", "uri", "content_type", "size", "etag", "version_id", "sha256"]
    return valid.select("doc_id", to_contract_json(valid, cols).alias("json"))


# ------------------------------------------------------------------ job payloads

_JOB_SQL = """job AS (
  SELECT event_id, user_id, raw,
    coalesce(json_extract_string(raw, '$.job_id'), json_extract_string(raw, '$.id')) AS job_id,
    coalesce(json_extract_string(raw, '$.job_type'), json_extract_string(raw, '$.type')) AS job_type,
    json_extract_string(raw, '$.status') AS status,
    json_extract_string(raw, '$.error.code') AS error_code,
    json_extract(raw, '$.error') IS NOT NULL AND json_extract_string(raw, '$.error') <> 'null' AS has_error,
    json_extract_string(raw, '$.updated_at') AS updated_text,
    (json_exists(raw, '$.job_id') AND json_exists(raw, '$.id')) AS doubled
  FROM job_log)"""


def _job_sql(body: str) -> str:
    return B.with_sql(["job_log"], f"WITH {_JOB_SQL}\n{body}")


def _jobs(spark: SparkSession, sf: str, checked: bool = False) -> DataFrame:
    return parse_contract(B.job_log(spark, sf), "raw", CONTRACTS["localization_job"], checked)


@register("job_alias_normalize", _job_sql("""
SELECT event_id, job_id, job_type, CASE WHEN doubled THEN 'id' ELSE '' END AS unknown_fields FROM job"""))
def job_alias_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """``id``/``type`` fold into ``job_id``/``job_type``; both names at
    once leaves the alias as an unknown field."""
    j = _jobs(spark, sf, checked=True)
    return j.select("event_id", "job_id", "job_type", F.array_join("unknown_fields", ",").alias("unknown_fields"))


@register("schema_required", _job_sql("""
SELECT event_id, job_id IS NOT NULL AS job_id_present, job_type IS NOT NULL AS job_type_present,
       status IS NOT NULL AS status_present FROM job"""))
def schema_required(spark: SparkSession, sf: str) -> DataFrame:
    """Required fields are present (after alias folding)."""
    j = _jobs(spark, sf)
    req = CONTRACTS["localization_job"].required
    return j.select("event_id", *[R.required(c, c).ok.alias(f"{c}_present") for c in req])


@register("schema_defaults", _job_sql("""
SELECT event_id, error_code, CAST(json_extract(raw, '$.error.retryable') AS BOOLEAN) AS retryable,
       coalesce(json_extract(raw, '$.error.details')::VARCHAR, '{}') AS details
FROM job WHERE has_error"""))
def schema_defaults(spark: SparkSession, sf: str) -> DataFrame:
    """Nested error defaults (retryable false, details {}) filled."""
    j = _jobs(spark, sf).filter(F.col("error").isNotNull())
    err = j.select("event_id", "error.*")
    return err.select("event_id", F.col("code").alias("error_code"), "retryable", "details")


_TS_CONTRACT_RE = r"^\d{4}-\d{2}-\d{2}(?:[Tt ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?(?:[Zz]|[+-]\d{2}:?\d{2})$"


@register("rule_aware_ts", _job_sql(f"""
SELECT event_id, updated_text,
  updated_text IS NULL OR regexp_matches(trim(updated_text), '{_TS_CONTRACT_RE}')
  OR regexp_matches(trim(updated_text), '^-?\\d+(?:\\.\\d+)?$') AS ok FROM job"""))
def rule_aware_ts(spark: SparkSession, sf: str) -> DataFrame:
    """V2: contract instants must name their offset."""
    j = _jobs(spark, sf)
    return j.select("event_id", F.get_json_object("raw", "$.updated_at").alias("updated_text"),
                    R.aware_ts("updated_at").ok.alias("ok"))


_JT = "'download', 'transcribe', 'translate_subtitles', 'separate_audio', 'synthesize_speech', 'render_video', 'media_quality_check'"
_JS = "'queued', 'running', 'succeeded', 'failed', 'cancelled'"


@register("rule_enum", _job_sql(f"""
SELECT event_id, status, coalesce(status IN ({_JS}), false) AS status_ok,
       coalesce(job_type IN ({_JT}), false) AS job_type_ok FROM job"""))
def rule_enum(spark: SparkSession, sf: str) -> DataFrame:
    """V6: status and job type are members of their enumerations."""
    j = _jobs(spark, sf)
    return j.select("event_id", "status",
                    F.coalesce(R.enum("status", R.JOB_STATUSES, "s").ok, F.lit(False)).alias("status_ok"),
                    F.coalesce(R.enum("job_type", R.JOB_TYPES, "t").ok, F.lit(False)).alias("job_type_ok"))


@register("rule_job_state", _job_sql("""
SELECT event_id, status, NOT ((status = 'failed' AND NOT has_error) OR (status = 'succeeded' AND has_error)) AS ok
FROM job"""))
def rule_job_state(spark: SparkSession, sf: str) -> DataFrame:
    """A failed job carries an error, a succeeded one does not."""
    j = _jobs(spark, sf)
    return j.select("event_id", "status", F.coalesce(R.job_state().ok, F.lit(False)).alias("ok"))


# ------------------------------------------------------------------ URLs, IDs, handles

_HTTP_RE = r"(?i)^https?://[^/?#\s@]*[^/?#\s:@][^/?#\s]*(?:[/?#]\S*)?$"


@register("rule_http_url", f"""
SELECT page_id, url, coalesce(regexp_matches(trim(url), '{_HTTP_RE}'), false) AS ok FROM pages""")
def rule_http_url(spark: SparkSession, sf: str) -> DataFrame:
    """V8: absolute http(s) URLs with a host."""
    p = table(spark, sf, "pages")
    return p.select("page_id", "url", F.coalesce(R.http_url("url", optional=False).ok, F.lit(False)).alias("ok"))


_PATH_ENDINGS = ("", "/cut.mp4", "/Take.FLAC", "/all.tgz", "/all.tar.gz", "/icon.SVGZ", "/notes.txt.bz2", "/.hidden",
                 "/dir.d/name", "/a.b.json?x=1.png", "/odd.xyz")
_PATHS_SQL = ("(SELECT page_id, url || unnest([" + ", ".join(f"'{x}'" for x in _PATH_ENDINGS) + "]) AS url FROM pages)")


@register("artifact_content_type", content_type_sql("page_id", "url", _PATHS_SQL))
def artifact_content_type(spark: SparkSession, sf: str) -> DataFrame:
    """A4: MIME type of each page URL, and of paths under it, by extension."""
    p = table(spark, sf, "pages")
    endings = F.explode(F.array(*map(F.lit, _PATH_ENDINGS)))
    p = p.select("page_id", "url", endings.alias("_ending")).select("page_id", F.concat("url", "_ending").alias("url"))
    return p.select("page_id", "url", content_type("url").alias("content_type"))


@register("rule_resource_id", B.with_sql(["channel_refs"], """
SELECT pos, ref, coalesce(regexp_matches(trim(ref), '^[A-Za-z0-9_-]+$'), false) AS ok FROM channel_refs"""))
def rule_resource_id(spark: SparkSession, sf: str) -> DataFrame:
    """V9: IDs safe to put in a URI (after stripping)."""
    r = B.channel_refs(spark, sf)
    return r.select("pos", "ref", F.coalesce(R.resource_id("ref").ok, F.lit(False)).alias("ok"))


@register("rule_handle", B.with_sql(["channel_refs"], """
SELECT pos, ref, coalesce(length(n) > 0 AND NOT starts_with(n, '@') AND NOT contains(n, '/')
                          AND NOT regexp_matches(n, '\\s'), false) AS ok
FROM (SELECT pos, ref, CASE WHEN starts_with(trim(ref), '@') THEN substr(trim(ref), 2) ELSE trim(ref) END AS n
      FROM channel_refs)"""))
def rule_handle(spark: SparkSession, sf: str) -> DataFrame:
    """A handle is a bare name (one optional leading @, no URL parts)."""
    r = B.channel_refs(spark, sf)
    return r.select("pos", "ref", R.handle("ref").ok.alias("ok"))


@register("rule_artifact_key", """
SELECT p_partkey, key, regexp_matches(key, '^[a-z0-9][a-z0-9._/-]*$') AS ok FROM (
  SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN p_brand || '/' || p_partkey
                         ELSE lower(p_type) || '/' || replace(p_name, ' ', '-') || '.bin' END AS key FROM part)""")
def rule_artifact_key(spark: SparkSession, sf: str) -> DataFrame:
    """V5: artifact keys are lowercase path-like names."""
    p = table(spark, sf, "part")
    key = F.when(F.col("p_type") == "PROMO", F.concat("p_brand", F.lit("/"), F.col("p_partkey").cast("string"))) \
        .otherwise(F.concat(F.lower("p_type"), F.lit("/"), F.regexp_replace("p_name", " ", "-"), F.lit(".bin")))
    k = p.select("p_partkey", key.alias("key"))
    return k.select("p_partkey", "key", R.artifact_key("key").ok.alias("ok"))


# ------------------------------------------------------------------ messages

_LEVELS = "'critical', 'active', 'timeSensitive', 'passive'"
_MSG_SQL = """msgs AS (
  SELECT c_custkey, c_name AS title, c_mktsegment AS body,
    CASE c_nationkey WHEN 0 THEN 'critical' WHEN 1 THEN 'timeSensitive' WHEN 2 THEN 'passive'
                     WHEN 3 THEN 'urgent' ELSE NULL END AS level,
    CASE WHEN c_nationkey = 5 THEN 'shop.example.com/c/' || c_custkey
         ELSE 'https://shop.example.com/c/' || c_custkey END AS url,
    CAST(floor(c_acctbal / 1000) AS BIGINT) AS badge,
    c_acctbal > 9000 AS call,
    CASE WHEN c_mktsegment = 'BUILDING' THEN c_name END AS copy,
    c_mktsegment = 'BUILDING' AS autoCopy
  FROM customer)"""


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    nk = F.col("c_nationkey")
    level = (F.when(nk == 0, F.lit("critical")).when(nk == 1, F.lit("timeSensitive"))
             .when(nk == 2, F.lit("passive")).when(nk == 3, F.lit("urgent")))
    url = F.when(nk == 5, F.concat(F.lit("shop.example.com/c/"), F.col("c_custkey").cast("string"))) \
        .otherwise(F.concat(F.lit("https://shop.example.com/c/"), F.col("c_custkey").cast("string")))
    return c.select("c_custkey", F.col("c_name").alias("title"), F.col("c_mktsegment").alias("body"),
                    level.alias("level"), url.alias("url"),
                    F.floor(F.col("c_acctbal") / 1000).cast("long").alias("badge"),
                    (F.col("c_acctbal") > 9000).alias("call"),
                    F.when(F.col("c_mktsegment") == "BUILDING", F.col("c_name")).alias("copy"),
                    (F.col("c_mktsegment") == "BUILDING").alias("autoCopy"),
                    *[F.lit(None).cast("string").alias(n) for n in ("subtitle", "markdown", "group", "icon", "sound")],
                    F.lit(False).alias("isArchive"))


@register("rule_message", B.with_sql([], f"""WITH {_MSG_SQL}
SELECT c_custkey, array_to_string(list_filter([
  CASE WHEN level IS NOT NULL AND level NOT IN ({_LEVELS}) THEN 'level' END,
  CASE WHEN url IS NOT NULL AND NOT regexp_matches(trim(url), '{_HTTP_RE}') THEN 'url' END,
  CASE WHEN badge < 0 THEN 'badge' END], lambda x: x IS NOT NULL), ',') AS violations
FROM msgs"""))
def rule_message(spark: SparkSession, sf: str) -> DataFrame:
    """Push messages: non-empty title/body, known level, http URLs, badge >= 0."""
    v = R.validate(_messages(spark, sf), R.message_rules())
    return v.select("c_custkey", R.codes().alias("violations"))


@register("message_fields_payload", B.with_sql([], f"""WITH {_MSG_SQL}
SELECT c_custkey, '{{' || '"title":' || to_json(title) || ',"body":' || to_json(body) ||
  ',"level":"' || coalesce(level, 'active') || '","url":' || to_json(url) || ',"badge":' || badge ||
  CASE WHEN copy IS NOT NULL THEN ',"copy":' || to_json(copy) ELSE '' END ||
  CASE WHEN call THEN ',"call":1' ELSE '' END || CASE WHEN autoCopy THEN ',"autoCopy":1' ELSE '' END || '}}' AS payload
FROM msgs WHERE (level IS NULL OR level IN ({_LEVELS})) AND badge >= 0
  AND regexp_matches(trim(url), '{_HTTP_RE}')"""))
def message_fields_payload(spark: SparkSession, sf: str) -> DataFrame:
    """V25 + P12: valid messages only, then their payloads (badge 0 kept,
    false flags absent, copy under its alias)."""
    valid, _ = R.split(R.validate(_messages(spark, sf), R.message_rules()))
    return message_payload(valid).select("c_custkey", "payload")


@register("path_segment", """
SELECT page_id, url, url_encode(url) AS segment FROM pages""")
def path_segment_q(spark: SparkSession, sf: str) -> DataFrame:
    """A whole value percent-encoded as one URL path segment (nothing safe)."""
    p = table(spark, sf, "pages")
    return p.select("page_id", "url", path_segment("url").alias("segment"))
