"""Job requests, status logs and attempts (§2.3 V11/V28/V29, §2.4 P13–P20,
§2.6 G2/G7, §2.10 T6, §2.11 R3/R4).

Status logs are folded with ``max_by`` per key (partial aggregation, so a
job polled millions of times still reduces map-side).  Attempt logs are
folded per request the same way; the outcome and the total back-off come
from per-request aggregates, not from a loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import col_of
from tapeworks.functions.time import aware_timestamp
from tapeworks.operators.discovery import dedupe_keep_first, dedupe_keep_last
from tapeworks.operators.rules import TERMINAL_STATUSES

DEFAULT_RETRIES = 2          # fixed: reference default (0..5)
DEFAULT_RETRY_DELAY_S = 1.0  # fixed: reference default
JOB_TIMEOUT_S = 7200         # fixed: reference default job timeout

# Stages with their own request operator (quality check has none).
REQUEST_STAGES = ("download", "transcribe", "translate_subtitles", "separate_audio",
                  "synthesize_speech", "render_video")

# Error classes and their retry policy.
RETRY_POLICIES = (
    ("transient", "retry_with_backoff"),
    ("authentication", "stop_and_notify"),
    ("input", "not_retryable"),
    ("quality", "manual_review"),
    ("policy", "block_downstream"),
)


def attempt_class(status) -> Column:
    """P14 per attempt: 429 and >=500 retry, other >=400 fail, else ok."""
    s = col_of(status)
    return F.when((s == 429) | (s >= 500), F.lit("retry")).when(s >= 400, F.lit("fail")).otherwise(F.lit("ok"))


def poll_class(status) -> Column:
    """P15 per poll: 4xx fail, >=500 retry (no bound), else the body is read."""
    s = col_of(status)
    return F.when((s >= 400) & (s < 500), F.lit("fail")).when(s >= 500, F.lit("retry")).otherwise(F.lit("parse"))


def http_outcome(attempts: DataFrame, retries: int = DEFAULT_RETRIES,
                 delay_s: float = DEFAULT_RETRY_DELAY_S) -> DataFrame:
    """P14 + P16 over an attempt log (request_id, attempt, status).

    Outcome per request: the class of the first non-retry attempt if it comes
    within ``retries + 1`` attempts; ``exhausted`` when that many attempts all
    asked for a retry; ``pending`` when the log ends before either.  The
    waiting time is ``delay * 2**i`` before each retry i: ``delay*(2**m - 1)``
    for m sleeps.
    """
    if not 0 <= retries <= 5:
        raise ValueError("retries must be between 0 and 5")
    max_attempts = retries + 1
    cls = attempt_class("status")
    agg = attempts.groupBy("request_id").agg(
        F.min(F.when(cls != "retry", F.struct(F.col("attempt").alias("at"), cls.alias("cls")))).alias("_d"),
        F.count("*").alias("logged"))
    decided = F.col("_d.at")
    outcome = (F.when(decided < max_attempts, F.col("_d.cls"))
               .when(F.coalesce(decided, F.col("logged")) >= max_attempts, F.lit("exhausted"))
               .otherwise(F.lit("pending")))
    sleeps = F.least(F.coalesce(decided, F.col("logged")), F.lit(max_attempts - 1))
    used = F.when(decided < max_attempts, decided + 1).otherwise(F.least(F.col("logged"), F.lit(max_attempts)))
    return agg.select("request_id", outcome.alias("outcome"), used.cast("long").alias("attempts_used"),
                      (F.lit(delay_s) * (F.pow(F.lit(2.0), sleeps) - 1)).alias("backoff_s"))


def job_from_log(parsed: DataFrame) -> DataFrame:
    """Status rows that are valid job documents (no ``codes`` from the reader),
    with their update time; rows without one can't be ordered and are refused too."""
    valid = parsed.filter(F.size("codes") == 0)
    return valid.withColumn("updated_ts", aware_timestamp("updated_at")).filter("updated_ts is not null")


def latest_job(jobs: DataFrame) -> DataFrame:
    """The latest status per job (by update time, then arrival)."""
    return dedupe_keep_last(jobs, ["job_id"], ["updated_ts", "event_id"])


def terminal(status) -> Column:
    """V29."""
    return col_of(status).isin(*TERMINAL_STATUSES)


def success_gate(latest: DataFrame) -> DataFrame:
    """Polling ended (terminal) is one column, the job's success another;
    failed and cancelled jobs are routed as errors."""
    t = terminal("status")
    return latest.withColumn("poll_done", t).withColumn(
        "outcome", F.when(~t, F.lit("waiting")).when(F.col("status") == "succeeded", F.lit("ok")).otherwise(F.lit("error")))


def job_timeouts(jobs: DataFrame, now, timeout_s: int = JOB_TIMEOUT_S) -> DataFrame:
    """Jobs still not terminal ``timeout_s`` after they were first seen."""
    agg = jobs.groupBy("job_id").agg(F.min("updated_ts").alias("first_seen"),
                                     F.max_by("status", F.struct("updated_ts", "event_id")).alias("status"))
    age = F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("first_seen")
    return agg.withColumn("age_s", age).filter(~terminal("status") & (F.col("age_s") > timeout_s))


def idempotent_requests(requests: DataFrame, key: str = "idempotency_key", order: list[str] = None) -> DataFrame:
    """The first request per idempotency key wins."""
    return dedupe_keep_first(requests, [key], order or ["submitted_at"])


def default_idempotency_key(dag_id, run_id, task_id, map_index) -> Column:
    """``dag:run:task:map_index``."""
    return F.concat_ws(":", col_of(dag_id), col_of(run_id), col_of(task_id), col_of(map_index).cast("string"))


# What each stage's idempotency key is made of, in order; a part
# in quotes stands for itself.
STAGE_KEYS = {
    "download": ("'youtube'", "video_id", "format_profile_version"),
    "transcribe": ("audio_sha256", "provider", "model", "config_version"),
    "translate_subtitles": ("transcript_sha256", "target_language", "prompt_version"),
    "synthesize_speech": ("translated_segment_sha256", "voice_profile_version"),
    "render_video": ("source_sha256", "timeline_sha256", "audio_sha256", "profile_version"),
    "publish": ("'bilibili'", "source_video_id", "render_sha256", "account_id"),
}


def stage_idempotency_key(stage, parts: dict) -> Column:
    """The idempotency key of a stage's work, in that stage's own shape;
    null for a stage without one, and when a part is missing.  ``parts``: the
    column of each named part."""
    out = F.lit(None).cast("string")
    for name, shape in STAGE_KEYS.items():
        if all(p[0] == "'" or p in parts for p in shape):
            cols = [F.lit(p.strip("'")) if p[0] == "'" else col_of(parts[p]).cast("string") for p in shape]
            joined = cols[0]
            for c in cols[1:]:
                joined = F.concat(joined, F.lit(":"), c)   # null when a part is null
            out = F.when(col_of(stage) == name, joined).otherwise(out)
    return out


def stage_requests(requests: DataFrame, stages=REQUEST_STAGES) -> DataFrame:
    """P20 for several stage operators in one pass: each request once per
    stage, each copy carrying that stage's fixed job type (one scan, no union
    of per-stage reads)."""
    unknown = [s for s in stages if s not in REQUEST_STAGES]
    if unknown:
        raise ValueError(f"no request operator for {unknown!r}")
    return requests.withColumn("job_type", F.explode(F.array(*[F.lit(s) for s in stages])))


def retry_policy(errors: DataFrame, spark) -> DataFrame:
    """Error class → retry policy (a 5-row table; broadcast is bounded)."""
    policy = spark.createDataFrame(list(RETRY_POLICIES), "error_class string, policy string")
    return errors.join(F.broadcast(policy), "error_class", "left")


def http_error_class(status) -> Column:
    """T6 classes for HTTP statuses (ours: the document gives examples only)."""
    s = col_of(status)
    return (F.when((s == 429) | (s >= 500), F.lit("transient")).when(s.isin(401, 403), F.lit("authentication"))
            .when(s.isin(404, 410), F.lit("input")).when(s == 422, F.lit("quality"))
            .when(s == 451, F.lit("policy")))


def latest_stage(stages: DataFrame) -> DataFrame:
    """Latest durable state per (video, stage)."""
    return dedupe_keep_last(stages, ["video_id", "job_type"], ["updated_at", "job_id"])
