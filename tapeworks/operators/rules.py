"""Validation rules (§2.3) as Column predicates, and the valid/quarantine split.

A ``Rule`` is ``(code, ok, message)`` where ``ok`` is a boolean Column (null
counts as a failure).  ``validate`` adds ``violations ARRAY<STRUCT<code,
message>>``: every failing field rule, then — only when no field rule failed —
the first failing model rule, which is how the contracts report cross-field
errors.  Everything is a projection: no shuffle, no Python.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import col_of
from tapeworks.functions.text import (ARTIFACT_KEY_PATTERN, RESOURCE_ID_PATTERN, SHA256_PATTERN,
                                      handle_name, strip_ws)
from tapeworks.functions.time import has_offset
from tapeworks.functions.uri import is_http_url, is_s3_uri

# Enumerations of the contracts.
JOB_TYPES = ("download", "transcribe", "translate_subtitles", "separate_audio",
             "synthesize_speech", "render_video", "media_quality_check")
JOB_STATUSES = ("queued", "running", "succeeded", "failed", "cancelled")
TERMINAL_STATUSES = ("succeeded", "failed", "cancelled")
AUDIO_STRATEGIES = ("subtitle_only", "voice_overlay", "voice_replace", "silent_bed")
DUBBED_STRATEGIES = ("voice_overlay", "voice_replace", "silent_bed")
VIDEO_CODECS = ("copy", "libx264")
MESSAGE_LEVELS = ("critical", "active", "timeSensitive", "passive")


@dataclass(frozen=True)
class Rule:
    code: str
    ok: Column
    message: str


def _fails(rule: Rule) -> Column:
    return ~F.coalesce(rule.ok, F.lit(False))


def _entry(rule: Rule) -> Column:
    return F.struct(F.lit(rule.code).alias("code"), F.lit(rule.message).alias("message"))


def violations(field_rules: list[Rule], model_rules: list[Rule] = ()) -> Column:
    """All failing field rules; then the first failing model rule if none."""
    empty = F.array().cast("array<struct<code:string,message:string>>")
    fields = F.filter(F.array(*[F.when(_fails(r), _entry(r)) for r in field_rules]), lambda x: x.isNotNull()) \
        if field_rules else empty
    if not model_rules:
        return fields
    first = None
    for r in reversed(list(model_rules)):
        first = F.when(_fails(r), _entry(r)) if first is None else F.when(_fails(r), _entry(r)).otherwise(first)
    model = F.when(first.isNotNull(), F.array(first)).otherwise(empty)
    return F.when(F.size(fields) > 0, fields).otherwise(model)


def validate(df: DataFrame, field_rules: list[Rule], model_rules: list[Rule] = ()) -> DataFrame:
    return df.withColumn("violations", violations(field_rules, model_rules))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with first code and message)."""
    valid = validated.filter(F.size("violations") == 0).drop("violations")
    bad = validated.filter(F.size("violations") > 0).withColumn(
        "error_code", F.try_element_at("violations", F.lit(1))["code"]).withColumn(
        "error_message", F.try_element_at("violations", F.lit(1))["message"])
    return valid, bad


def split_by_codes(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """V26 on documents as the strict reader gives them: (valid rows, quarantined
    rows with ``error_code``, the first of their ``codes``)."""
    bad = df.filter(F.size("codes") > 0).withColumn("error_code", F.get("codes", 0))
    return df.filter(F.size("codes") == 0), bad


def codes(c: str = "violations") -> Column:
    """Violation codes joined by ``,`` (empty when valid)."""
    return F.array_join(F.transform(F.col(c), lambda v: v["code"]), ",")


# ------------------------------------------------------------------ field rules


def s3_uri(c, code: str = "s3_uri", optional: bool = False) -> Rule:
    """V1."""
    x = col_of(c)
    ok = is_s3_uri(strip_ws(x))
    return Rule(code, (x.isNull() | ok) if optional else ok,
                "not an object URI (s3://bucket/key)")


def aware_ts(text, code: str = "aware_ts", optional: bool = True, grammar: str = "contract") -> Rule:
    """V2: timestamp text must carry an offset."""
    x = col_of(text)
    ok = has_offset(x, grammar)
    return Rule(code, (x.isNull() | ok) if optional else ok, "no UTC offset")


def bounds(c, code: str, lo=None, hi=None, strict_lo: bool = False, optional: bool = True) -> Rule:
    """V3: numeric bounds (``>= lo`` or ``> lo``, ``<= hi``)."""
    x = col_of(c)
    ok = F.lit(True)
    if lo is not None:
        ok = ok & ((x > lo) if strict_lo else (x >= lo))
    if hi is not None:
        ok = ok & (x <= hi)
    return Rule(code, (x.isNull() | ok) if optional else ok, "value out of range")


def sha256(c, code: str = "sha256", optional: bool = True) -> Rule:
    """V4."""
    x = col_of(c)
    ok = strip_ws(x).rlike(SHA256_PATTERN)
    return Rule(code, (x.isNull() | ok) if optional else ok, "must be 64 lowercase hex characters")


def artifact_key(c, code: str = "artifact_key") -> Rule:
    """V5 on one key."""
    return Rule(code, strip_ws(col_of(c)).rlike(ARTIFACT_KEY_PATTERN), "invalid artifact key")


def enum(c, values, code: str, optional: bool = False) -> Rule:
    """V6: membership, no stripping (``" download"`` is refused)."""
    x = col_of(c)
    ok = x.isin(*values)
    return Rule(code, (x.isNull() | ok) if optional else ok, f"must be one of {', '.join(values)}")


def min_length(c, n: int, code: str, optional: bool = False) -> Rule:
    """V7: length after stripping."""
    x = col_of(c)
    ok = F.length(strip_ws(x)) >= n
    return Rule(code, (x.isNull() | ok) if optional else ok, f"must have at least {n} characters")


def http_url(c, code: str = "http_url", optional: bool = True) -> Rule:
    """V8."""
    x = col_of(c)
    return Rule(code, (x.isNull() | is_http_url(x)) if optional else is_http_url(x), "must be an http(s) URL")


def resource_id(c, code: str = "resource_id") -> Rule:
    """V9."""
    return Rule(code, strip_ws(col_of(c)).rlike(RESOURCE_ID_PATTERN),
                "not an ID")


def handle(c, code: str = "handle") -> Rule:
    """V10."""
    return Rule(code, handle_name(col_of(c)).isNotNull(), "not a handle")


def required(c, code: str) -> Rule:
    """S6."""
    return Rule(code, col_of(c).isNotNull(), "field required")


def interval(start, end, code: str = "interval") -> Rule:
    """``end > start``."""
    return Rule(code, col_of(end) > col_of(start), "end must be greater than start")


# ------------------------------------------------------------------ contract rule sets


def artifact_rules(prefix: str = "", code_prefix: str = "") -> list[Rule]:
    p = (lambda n: F.col(f"{prefix}{n}")) if not prefix else (lambda n: F.col(prefix).getField(n))
    return [
        required(p("uri"), f"{code_prefix}uri_required"),
        s3_uri(p("uri"), f"{code_prefix}uri", optional=True),
        required(p("content_type"), f"{code_prefix}content_type_required"),
        min_length(p("content_type"), 1, f"{code_prefix}content_type", optional=True),
        bounds(p("size"), f"{code_prefix}size", lo=0),
        min_length(p("etag"), 1, f"{code_prefix}etag", optional=True),
        min_length(p("version_id"), 1, f"{code_prefix}version_id", optional=True),
        sha256(p("sha256"), f"{code_prefix}sha256"),
    ]


def job_state(status="status", error="error") -> Rule:
    """Failed ⇒ error; succeeded ⇒ no error."""
    s, e = col_of(status), col_of(error)
    return Rule("job_state", ~(((s == "failed") & e.isNull()) | ((s == "succeeded") & e.isNotNull())),
                "error doesn't fit the status")


def stage_record_rules(status="status", error="error", started="started_ts", completed="completed_ts") -> list[Rule]:
    """V12, in the contract's order."""
    s, e, a, b = col_of(status), col_of(error), col_of(started), col_of(completed)
    return [
        Rule("stage_terminal_completed", ~(s.isin(*TERMINAL_STATUSES) & b.isNull()),
             "ended without an end time"),
        Rule("stage_failed_error", ~((s == "failed") & e.isNull()), "failed without an error"),
        Rule("stage_succeeded_error", ~((s == "succeeded") & e.isNotNull()), "succeeded with an error"),
        Rule("stage_time_order", a.isNull() | b.isNull() | (b >= a), "ends before it starts"),
    ]


def render_settings_rule(settings="settings") -> Rule:
    """Burned subtitles need re-encoding."""
    st = col_of(settings)
    return Rule("render_settings", ~(F.coalesce(st.burn_subtitles, F.lit(False)) &
                                      (F.coalesce(st.video_codec, F.lit("copy")) == "copy")),
                "burning subtitles needs an encoder")


def render_request_rules(settings="settings") -> list[Rule]:
    """V18, in the contract's order."""
    st = col_of(settings)
    strategy = F.coalesce(st.audio_strategy, F.lit("subtitle_only"))
    return [
        Rule("render_needs_ass", ~(F.coalesce(st.burn_subtitles, F.lit(False)) & F.col("subtitle_ass").isNull()),
             "nothing to burn in"),
        Rule("render_needs_dub", ~(strategy.isin(*DUBBED_STRATEGIES) & F.col("dubbed_audio").isNull()),
             "the audio strategy needs a dub"),
        Rule("render_needs_accompaniment", ~((strategy == "voice_replace") & F.col("accompaniment_audio").isNull()),
             "replacing the voice needs an accompaniment"),
    ]


def message_rules() -> list[Rule]:
    """Push message fields."""
    return [
        required("title", "title_required"), min_length("title", 1, "title", optional=True),
        required("body", "body_required"), min_length("body", 1, "body", optional=True),
        enum("level", MESSAGE_LEVELS, "level", optional=True),
        http_url("url", "url"), http_url("icon", "icon"),
        bounds("badge", "badge", lo=0),
    ]
