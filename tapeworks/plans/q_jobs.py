"""Job, attempt and request queries (§2.3 V12/V28/V29, §2.4 P13–P20,
§2.6 G2/G7, §2.10 T6, §2.11 R3/R4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.time import ts_text
from tapeworks.functions.uri import watch_url
from tapeworks.operators import jobs as J
from tapeworks.operators import rules as R
from tapeworks.operators.manifest import LAYOUT_ROOT
from tapeworks.operators.payload import error_detail
from tapeworks.plans import bindings as B
from tapeworks.plans.catalog import register
from tapeworks.plans.q_contracts import _JOB_SQL, _JS, _JT, _TS_CONTRACT_RE, _jobs
from tapeworks.sources.tables import table

NOW = "2024-01-31 00:00:00"   # ours: the instant the timeout report is made


def _ts_sql(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


# ------------------------------------------------------------------ attempts

_CLS = "CASE WHEN status = 429 OR status >= 500 THEN 'retry' WHEN status >= 400 THEN 'fail' ELSE 'ok' END"


def _outcome_sql(retries: int, delay: float) -> str:
    m = retries + 1
    return B.with_sql(["attempt_log"], f"""
WITH a AS (SELECT request_id, attempt, {_CLS} AS cls FROM attempt_log),
g AS (SELECT request_id, min(attempt) FILTER (WHERE cls <> 'retry') AS d, count(*) AS logged FROM a GROUP BY request_id),
g2 AS (SELECT g.*, a.cls AS dcls FROM g LEFT JOIN a ON a.request_id = g.request_id AND a.attempt = g.d)
SELECT request_id,
  CASE WHEN d < {m} THEN dcls WHEN coalesce(d, logged) >= {m} THEN 'exhausted' ELSE 'pending' END AS outcome,
  CAST(CASE WHEN d < {m} THEN d + 1 ELSE least(logged, {m}) END AS BIGINT) AS attempts_used,
  {delay} * (pow(2.0, least(coalesce(d, logged), {m - 1})) - 1) AS backoff_s
FROM g2""")


@register("http_outcome", _outcome_sql(J.DEFAULT_RETRIES, J.DEFAULT_RETRY_DELAY_S))
def http_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """Final outcome of each API request under the retry bound."""
    return J.http_outcome(B.attempt_log(spark, sf))


@register("backoff_wait", _outcome_sql(5, 0.5))
def backoff_wait(spark: SparkSession, sf: str) -> DataFrame:
    """Total back-off per request with 5 retries and a 0.5 s first delay."""
    return J.http_outcome(B.attempt_log(spark, sf), retries=5, delay_s=0.5)


@register("error_detail", B.with_sql(["attempt_log"], """
SELECT event_id, status,
  'HTTP ' || status || CASE WHEN sfx <> '' THEN ' (' || left(sfx, 300) || ')' ELSE '' END AS detail
FROM (SELECT *, concat_ws(': ', nullif(json_extract_string(body, '$.error.errors[0].reason'), ''),
                                nullif(json_extract_string(body, '$.error.message'), '')) AS sfx
      FROM attempt_log WHERE status >= 400)"""))
def error_detail_q(spark: SparkSession, sf: str) -> DataFrame:
    """Safe error text (status, reason, message; nothing else from the body)."""
    a = B.attempt_log(spark, sf).filter(F.col("status") >= 400)
    return a.select("event_id", "status", error_detail(F.col("status"), F.col("body")).alias("detail"))


@register("retry_policy", B.with_sql(["attempt_log"], """
SELECT event_id, status, cls AS error_class,
  CASE cls WHEN 'transient' THEN 'retry_with_backoff' WHEN 'authentication' THEN 'stop_and_notify'
           WHEN 'input' THEN 'not_retryable' WHEN 'quality' THEN 'manual_review'
           WHEN 'policy' THEN 'block_downstream' END AS policy
FROM (SELECT *, CASE WHEN status = 429 OR status >= 500 THEN 'transient' WHEN status IN (401, 403) THEN 'authentication'
                     WHEN status IN (404, 410) THEN 'input' WHEN status = 422 THEN 'quality'
                     WHEN status = 451 THEN 'policy' END AS cls
      FROM attempt_log WHERE status >= 400)"""))
def retry_policy(spark: SparkSession, sf: str) -> DataFrame:
    """Error class of each failed attempt and the policy for it."""
    a = B.attempt_log(spark, sf).filter(F.col("status") >= 400)
    a = a.select("event_id", "status", J.http_error_class("status").alias("error_class"))
    return J.retry_policy(a, spark).select("event_id", "status", "error_class", "policy")


# ------------------------------------------------------------------ job status log

_VALID_JOBS = f"""jv AS (
  SELECT *, timezone('UTC', try_cast(trim(updated_text) AS TIMESTAMPTZ)) AS updated_ts FROM job
  WHERE status IN ({_JS}) AND job_type IN ({_JT}) AND length(trim(job_id)) >= 1
    AND regexp_matches(trim(updated_text), '{_TS_CONTRACT_RE}') AND NOT doubled
    AND NOT ((status = 'failed' AND NOT has_error) OR (status = 'succeeded' AND has_error))),
lj AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY updated_ts DESC, event_id DESC) AS rn
                      FROM jv) WHERE rn = 1)"""


def _jsql(body: str, extra: tuple[str, ...] = ()) -> str:
    return B.with_sql(["job_log", *extra], f"WITH {_JOB_SQL},\n{_VALID_JOBS}\n{body}")


def _latest(spark: SparkSession, sf: str) -> DataFrame:
    return J.latest_job(J.job_from_log(_jobs(spark, sf, checked=True)))


@register("latest_job", _jsql(f"""
SELECT job_id, job_type, status, {_ts_sql('updated_ts')} AS updated_at, error_code FROM lj"""))
def latest_job(spark: SparkSession, sf: str) -> DataFrame:
    """What a poll sees: latest valid status per job."""
    lj = _latest(spark, sf)
    return lj.select("job_id", "job_type", "status", ts_text("updated_ts").alias("updated_at"),
                     F.col("error.code").alias("error_code"))


@register("job_terminal", _jsql(f"""
SELECT job_id, status, status IN ('succeeded', 'failed', 'cancelled') AS terminal FROM lj"""))
def job_terminal(spark: SparkSession, sf: str) -> DataFrame:
    """Is the latest state terminal (polling may stop)?"""
    return _latest(spark, sf).select("job_id", "status", J.terminal("status").alias("terminal"))


@register("job_success_gate", _jsql("""
SELECT job_id, status, status IN ('succeeded', 'failed', 'cancelled') AS poll_done,
  CASE WHEN status NOT IN ('succeeded', 'failed', 'cancelled') THEN 'waiting'
       WHEN status = 'succeeded' THEN 'ok' ELSE 'error' END AS outcome, error_code
FROM lj"""))
def job_success_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Polling ended vs job succeeded, kept apart; failures routed as errors."""
    g = J.success_gate(_latest(spark, sf))
    return g.select("job_id", "status", "poll_done", "outcome", F.col("error.code").alias("error_code"))


@register("job_timeouts", _jsql(f"""
SELECT job_id, status, age_s FROM (
  SELECT job_id, arg_max(status, (updated_ts, event_id)) AS status,
         epoch_us(TIMESTAMP '{NOW}') // 1000000 - epoch_us(min(updated_ts)) // 1000000 AS age_s
  FROM jv GROUP BY job_id)
WHERE status NOT IN ('succeeded', 'failed', 'cancelled') AND age_s > 7200"""))
def job_timeouts(spark: SparkSession, sf: str) -> DataFrame:
    """Jobs not terminal 7200 s after they were first seen."""
    t = J.job_timeouts(J.job_from_log(_jobs(spark, sf, checked=True)), NOW)
    return t.select("job_id", "status", "age_s")


@register("poll_outcome", _jsql("""
SELECT j.event_id, a.status AS http_status,
  CASE WHEN a.status >= 400 AND a.status < 500 THEN 'fail' WHEN a.status >= 500 THEN 'retry'
       WHEN j.status IN ('succeeded', 'failed', 'cancelled') THEN 'done' ELSE 'wait' END AS outcome
FROM jv j JOIN attempt_log a ON j.event_id = a.event_id""", ("attempt_log",)))
def poll_outcome(spark: SparkSession, sf: str) -> DataFrame:
    """Each poll: 4xx fails, >=500 retries, else the job state decides."""
    polls = J.job_from_log(_jobs(spark, sf, checked=True)).join(B.attempt_log(spark, sf).select("event_id", F.col("status").alias("http_status")),
                                                  "event_id")
    cls = J.poll_class("http_status")
    out = F.when(cls != "parse", cls).when(J.terminal("status"), F.lit("done")).otherwise(F.lit("wait"))
    return polls.select("event_id", "http_status", out.alias("outcome"))


# ------------------------------------------------------------------ requests

_STAGES = ", ".join(f"('{s}')" for s in J.REQUEST_STAGES)
_S3_RE = r"(?i)^s3://[^/?#]+/[^?#]*[^/?#][^?#]*[?]?#?$"


def _order_requests(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    base = F.concat(F.lit("s3://orders/"), F.col("o_custkey").cast("string"), F.lit("/"), F.col("o_orderkey").cast("string"))
    return o.select("o_orderkey", "o_custkey", "o_orderpriority",
                    F.concat(base, F.lit("/input")).alias("input_uri"), base.alias("_base"),
                    as_date_key("o_orderdate").alias("order_day"))


def as_date_key(c):
    return F.date_format(F.col(c), "yyyy-MM-dd")


@register("job_requests", f"""
WITH st(job_type) AS (VALUES {_STAGES}),
r AS (SELECT o_orderkey, st.job_type, 's3://orders/' || o_custkey || '/' || o_orderkey || '/input' AS input_uri,
        's3://orders/' || o_custkey || '/' || o_orderkey || '/' || st.job_type || '/' ||
        CASE WHEN o_orderpriority = '1-URGENT' THEN '?X-Amz-Signature=abc' ELSE '' END AS output_prefix
      FROM orders CROSS JOIN st)
SELECT o_orderkey, job_type, output_prefix,
  CASE WHEN NOT regexp_matches(output_prefix, '{_S3_RE}') THEN 'output_prefix' END AS error_code
FROM r""")
def job_requests(spark: SparkSession, sf: str) -> DataFrame:
    """P20: one validated request per order and stage operator, each with its
    fixed job type; presigned output prefixes are refused (V1)."""
    o = _order_requests(spark, sf)
    out = J.stage_requests(o, J.REQUEST_STAGES).withColumn("output_prefix", F.concat(
        "_base", F.lit("/"), F.col("job_type"), F.lit("/"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("?X-Amz-Signature=abc")).otherwise(F.lit(""))))
    v = R.validate(out, [R.enum("job_type", R.JOB_TYPES, "job_type"), R.min_length("input_uri", 1, "input_uri"),
                         R.s3_uri("output_prefix", "output_prefix")])
    return v.select("o_orderkey", "job_type", "output_prefix",
                    F.try_element_at("violations", F.lit(1))["code"].alias("error_code"))


@register("idempotent_requests", """
SELECT o_custkey || ':' || strftime(o_orderdate, '%Y-%m-%d') AS idempotency_key, min(o_orderkey) AS o_orderkey
FROM orders GROUP BY 1""")
def idempotent_requests(spark: SparkSession, sf: str) -> DataFrame:
    """The first submitted request per idempotency key wins."""
    o = _order_requests(spark, sf).select(
        F.concat_ws(":", F.col("o_custkey").cast("string"), "order_day").alias("idempotency_key"), "o_orderkey")
    return J.idempotent_requests(o, order=["o_orderkey"]).select("idempotency_key", "o_orderkey")


@register("idempotency_key", """
SELECT l_orderkey, l_linenumber, 'localize:run-' || l_orderkey || ':download:' || (l_linenumber - 1) AS idempotency_key
FROM lineitem""")
def idempotency_key(spark: SparkSession, sf: str) -> DataFrame:
    """The default ``dag:run:task:map_index`` key of mapped tasks."""
    li = table(spark, sf, "lineitem")
    key = J.default_idempotency_key(F.lit("localize"), F.concat(F.lit("run-"), F.col("l_orderkey").cast("string")),
                                    F.lit("download"), F.col("l_linenumber") - 1)
    return li.select("l_orderkey", "l_linenumber", key.alias("idempotency_key"))


# Stand-in parts of the stage keys: hashes of the video's artifacts by kind, and
# versions; a quality check stands for the upload.
_KEY_HASHES = ("audio_sha256", "transcript_sha256", "translated_segment_sha256", "source_sha256", "timeline_sha256",
               "render_sha256")
_KEY_VERSIONS = {"format_profile_version": "f1", "provider": "asr", "model": "base", "config_version": "c1",
                 "target_language": "de", "prompt_version": "p1", "voice_profile_version": "w1", "profile_version": "r1",
                 "account_id": "a1"}


@register("stage_idempotency_key", B.with_sql(["stage_records"], """
SELECT job_id, CASE job_type
  WHEN 'download' THEN 'youtube:' || video_id || ':f1'
  WHEN 'transcribe' THEN sha256(video_id || '/audio_sha256') || ':asr:base:c1'
  WHEN 'translate_subtitles' THEN sha256(video_id || '/transcript_sha256') || ':de:p1'
  WHEN 'synthesize_speech' THEN sha256(video_id || '/translated_segment_sha256') || ':w1'
  WHEN 'render_video' THEN sha256(video_id || '/source_sha256') || ':' || sha256(video_id || '/timeline_sha256') || ':' ||
                           sha256(video_id || '/audio_sha256') || ':r1'
  WHEN 'media_quality_check' THEN 'bilibili:' || video_id || ':' || sha256(video_id || '/render_sha256') || ':a1'
END AS stage_key FROM stage_records"""))
def stage_idempotency_key(spark: SparkSession, sf: str) -> DataFrame:
    """Each stage's idempotency key, in that stage's own shape."""
    s = B.stage_records(spark, sf)
    parts = {name: F.sha2(F.concat("video_id", F.lit(f"/{name}")), 256) for name in _KEY_HASHES}
    parts |= {name: F.lit(v) for name, v in _KEY_VERSIONS.items()} | {"video_id": "video_id", "source_video_id": "video_id"}
    stage = F.when(F.col("job_type") == "media_quality_check", F.lit("publish")).otherwise(F.col("job_type"))
    return s.select("job_id", J.stage_idempotency_key(stage, parts).alias("stage_key"))


@register("download_requests", B.with_sql(["publications"], """
SELECT video_id, 'download' AS job_type, 'https://www.youtube.com/watch?v=' || video_id AS input_uri,
  's3://media/videos/' || video_id || '/source/' AS output_prefix,
  'youtube:' || video_id || ':v1' AS idempotency_key
FROM publications"""))
def download_requests(spark: SparkSession, sf: str) -> DataFrame:
    """One download request per video (input, prefix, idempotency key)."""
    p = B.publications(spark, sf)
    return p.select("video_id", F.lit("download").alias("job_type"), watch_url("video_id").alias("input_uri"),
                    F.concat(F.lit(f"{LAYOUT_ROOT}/"), "video_id", F.lit("/source/")).alias("output_prefix"),
                    F.concat(F.lit("youtube:"), "video_id", F.lit(":v1")).alias("idempotency_key"))


# ------------------------------------------------------------------ stages

@register("rule_stage_record", B.with_sql(["stage_records"], """
SELECT job_id, CASE
  WHEN status IN ('succeeded', 'failed', 'cancelled') AND completed_at IS NULL THEN 'stage_terminal_completed'
  WHEN status = 'failed' AND error_code IS NULL THEN 'stage_failed_error'
  WHEN status = 'succeeded' AND error_code IS NOT NULL THEN 'stage_succeeded_error'
  WHEN started_at IS NOT NULL AND completed_at IS NOT NULL AND completed_at < started_at THEN 'stage_time_order'
END AS violation FROM stage_records"""))
def rule_stage_record(spark: SparkSession, sf: str) -> DataFrame:
    """Stage record consistency, first failure in the contract's order."""
    s = B.stage_records(spark, sf)
    field_rules = [R.enum("job_type", R.JOB_TYPES, "job_type"), R.enum("status", R.JOB_STATUSES, "status"),
                   R.min_length("job_id", 1, "job_id"), R.min_length("idempotency_key", 1, "idempotency_key"),
                   R.sha256("parameters_sha256", optional=False)]
    v = R.validate(s, field_rules, R.stage_record_rules(started="started_at", completed="completed_at"))
    return v.select("job_id", F.try_element_at("violations", F.lit(1))["code"].alias("violation"))


@register("latest_stage", B.with_sql(["stage_records"], f"""
SELECT video_id, job_type, job_id, status, {_ts_sql('updated_at')} AS updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id, job_type ORDER BY updated_at DESC, job_id DESC) AS rn
  FROM stage_records) WHERE rn = 1"""))
def latest_stage(spark: SparkSession, sf: str) -> DataFrame:
    """Latest durable state per (video, stage)."""
    ls = J.latest_stage(B.stage_records(spark, sf))
    return ls.select("video_id", "job_type", "job_id", "status", ts_text("updated_at").alias("updated_at"))
