"""Strict validation of whole contract documents.

The codes of all that is wrong with a document as a contract are ``path:code``;
none means valid.  The text is parsed once, to VARIANT, so a value keeps its JSON
type: a number given for a text is seen, and ``5``, ``"5"`` and ``5.0`` all read as
the integer 5.  ``parsed_documents`` splits the parsed document into its fields,
from which ``field_codes`` and the reader's typed values are both taken;
``document_codes`` is the same check as one expression.

Paths are known when the check is built, so a code is a literal.  Of a repeated
JSON key the parser refuses the text (code ``json``): two values leave open which
one a writer meant.

A model is checked from the inside out: every field (missing, null, wrong type,
bounds, patterns, nested models, lists and maps), then undeclared fields, and
only when all of these hold its own rule across fields, which reports its first
failure.  Strings are stripped before their length or pattern is checked;
enumerations and the version are compared as they stand.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import bind, col_of, evaluate_once
from tapeworks.functions.text import ARTIFACT_KEY_PATTERN, SHA256_PATTERN, strip_ws
from tapeworks.functions.time import aware_timestamp, has_offset
from tapeworks.functions.uri import is_http_url, is_s3_uri
from tapeworks.operators.rules import DUBBED_STRATEGIES, JOB_STATUSES, JOB_TYPES, MESSAGE_LEVELS, TERMINAL_STATUSES
from tapeworks.sources.contracts import SCHEMA_VERSION, is_object, lax_int, parts_of

Check = Callable[[Column, str], Column]


def no_codes() -> Column:
    return F.array().cast("array<string>")


def get(v: Column, name: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{name}", kind)


def text_of(x: Column) -> Column:
    return F.try_variant_get(x, "$", "string")


def kind_of(x: Column) -> Column:
    return F.schema_of_variant(x)



def is_null(x: Column) -> Column:
    return F.coalesce(F.is_variant_null(x), F.lit(False))


def inside(at: str, name: str) -> str:
    return f"{at}.{name}" if at else name


def code(at: str, what: str) -> Column:
    return F.array(F.lit(f"{at}:{what}" if at else what))


def one_of(at: str, *cases: tuple[Column, str]) -> Column:
    """The code of the first case that holds, as an array of at most one."""
    out = None
    for bad, what in cases:
        found = code(at, what)
        bad = F.coalesce(bad, F.lit(True))
        out = F.when(bad, found) if out is None else out.when(bad, found)
    return out.otherwise(no_codes())


# ------------------------------------------------------------------ leaves


def text(least: int = 0, pattern: str | None = None) -> Check:
    def check(x, at):
        s = strip_ws(text_of(x))
        cases = [(kind_of(x) != "STRING", "string_type"), (F.length(s) < least, "too_short")]
        return one_of(at, *cases, *([(~s.rlike(pattern), "pattern")] if pattern else []))
    return check


def member(values) -> Check:
    return lambda x, at: one_of(at, (kind_of(x) != "STRING", "string_type"), (~text_of(x).isin(*values), "enum"))


def integer(lo: int | None = None, hi: int | None = None, above: int | None = None) -> Check:
    def check(x, at):
        def judged(n):
            cases = [(kind_of(x).rlike("^(OBJECT|ARRAY)") | n.isNull(), "int_type")]
            if lo is not None:
                cases.append((n < lo, "too_small"))
            if above is not None:
                cases.append((n <= above, "too_small"))
            if hi is not None:
                cases.append((n > hi, "too_large"))
            return one_of(at, *cases)
        return bind(lax_int(text_of(x)), judged)
    return check


def number(lo: float | None = None, hi: float | None = None) -> Check:
    def check(x, at):
        n = text_of(x).try_cast("double")
        cases = [(kind_of(x).rlike("^(OBJECT|ARRAY)") | n.isNull(), "float_type")]
        cases += [(n < lo, "too_small")] if lo is not None else []
        return one_of(at, *cases, *([(n > hi, "too_large")] if hi is not None else []))
    return check


def flag(x: Column, at: str) -> Column:
    said = F.lower(text_of(x)).isin("true", "false", "1", "0", "yes", "no", "on", "off", "y", "n", "t", "f")
    return one_of(at, ((kind_of(x) != "BOOLEAN") & ~(kind_of(x).isin("STRING", "BIGINT") & said), "bool_type"))


def instant(x: Column, at: str) -> Column:
    s = strip_ws(text_of(x))
    number_kind = kind_of(x).rlike("^(BIGINT|DOUBLE|DECIMAL)")  # seconds since the epoch are aware
    return one_of(at, (~(number_kind | ((kind_of(x) == "STRING") & has_offset(s, "contract"))), "aware_timestamp"))


def http(x: Column, at: str) -> Column:
    return one_of(at, (kind_of(x) != "STRING", "string_type"), (~is_http_url(text_of(x)), "http_url"))


def s3(x: Column, at: str) -> Column:
    return one_of(at, (kind_of(x) != "STRING", "string_type"), (~is_s3_uri(strip_ws(text_of(x))), "s3_uri"))


def json_object(x: Column, at: str) -> Column:
    return one_of(at, (~is_object(x), "object_type"))


# ------------------------------------------------------------------ composition


@dataclass(frozen=True)
class Item:
    """A field: its check, whether it must be there, whether null is allowed
    (only an optional field without a default takes null)."""

    name: str
    check: Check
    required: bool = False
    nullable: bool = False
    alias: str | None = None


def must(name: str, check: Check, alias: str | None = None) -> Item:
    return Item(name, check, required=True, alias=alias)


def may(name: str, check: Check) -> Item:
    return Item(name, check, nullable=True)


def defaulted(name: str, check: Check) -> Item:
    return Item(name, check)


def _field(x: Column, f: Item, at: str) -> Column:
    """Codes of one field's value ``x``."""
    path = inside(at, f.name)
    missing = code(path, "missing") if f.required else no_codes()
    null = no_codes() if f.nullable else code(path, "null")
    return F.when(x.isNull(), missing).when(is_null(x), null).otherwise(f.check(x, path))


def _value(own: Callable[[str], Column], f: Item) -> Column:
    return F.coalesce(own(f.name), own(f.alias)) if f.alias else own(f.name)


def _unknown(v: Column, own: Callable[[str], Column], fields: tuple[Item, ...], at: str) -> Column:
    # An alias is known only where the name itself isn't used.
    known = F.array(*[F.lit(f.name) for f in fields],
                    *[F.when(own(f.name).isNull(), F.lit(f.alias)) for f in fields if f.alias])
    keys = F.array_except(F.map_keys(F.try_variant_get(v, "$", "map<string,struct<>>")), known)
    named = F.transform(F.array_sort(keys), lambda k: F.concat(F.lit(inside(at, "")), k, F.lit(":unknown")))
    return F.when(F.size(keys) > 0, named).otherwise(no_codes())


class Model:
    """A check of an object with these fields and no others, then of the rule across them."""

    def __init__(self, *fields: Item, rule: Callable[[Column, str], Column] | None = None, versioned: bool = True):
        own = (defaulted("schema_version", member([SCHEMA_VERSION])),) if versioned else ()
        self.fields, self.rule = (*own, *fields), rule

    def found(self, v: Column, own: Callable[[str], Column], values: dict[str, Column], at: str) -> Column:
        """Codes of the fields, whose values are given, and of undeclared ones;
        ``own``: the value under a name or alias."""
        return F.concat(*[_field(values[f.name], f, at) for f in self.fields], _unknown(v, own, self.fields, at))

    def ruled(self, v: Column, found: Column, at: str) -> Column:
        """``found``, or the rule's codes where nothing was found."""
        return found if self.rule is None else F.when(F.size(found) > 0, found).otherwise(self.rule(v, at))

    def settled(self, v: Column, found: Column, at: str) -> Column:
        """All codes of a value, given those of its fields."""
        return F.when(~is_object(v), code(at, "object_type")).otherwise(self.ruled(v, found, at))

    def __call__(self, v: Column, at: str) -> Column:
        # All fields are taken out in one pass over the object.
        names = [n for f in self.fields for n in (f.name, f.alias) if n]

        def judged(row):
            own = lambda name: row[name]
            found = self.found(v, own, {f.name: _value(own, f) for f in self.fields}, at)
            return F.when(row.isNull(), code(at, "object_type")).otherwise(bind(found, lambda x: self.ruled(v, x, at)))
        return bind(parts_of(v, names), judged)


model = Model


def listing(part: Check) -> Check:
    def check(x, at):
        own = inside(at, "[]")
        found = lambda parts: F.flatten(F.transform(parts, lambda e: F.when(e.isNull() | is_null(e), code(own, "null")).otherwise(part(e, own))))
        return bind(F.try_variant_get(x, "$", "array<variant>"),
                    lambda parts: F.when(parts.isNotNull(), found(parts)).otherwise(code(at, "list_type")))
    return check


def mapping(key: Callable[[Column], Column], part: Check) -> Check:
    """A check of an object used as a map: its keys, then its values."""
    def check(x, at):
        def found(entries):
            keys = F.flatten(F.transform(entries, lambda e: F.when(key(e["key"]), no_codes()).otherwise(code(at, "key"))))
            values = F.flatten(F.transform(entries, lambda e: part(e["value"], inside(at, "{}"))))
            return F.when(entries.isNotNull(), F.concat(F.array_distinct(keys), values)).otherwise(code(at, "object_type"))
        return bind(F.map_entries(F.try_variant_get(x, "$", "map<string,variant>")), found)
    return check


# ------------------------------------------------------------------ rules across fields


def _absent(v: Column, name: str) -> Column:
    x = get(v, name)
    return x.isNull() | is_null(x)


def _string(v: Column, name: str) -> Column:
    return strip_ws(get(v, name, "string"))


def _long(v: Column, name: str) -> Column:
    return lax_int(text_of(get(v, name)))


def _time(v: Column, name: str) -> Column:
    return aware_timestamp(_string(v, name))


def _truth(v: Column, name: str) -> Column:
    return F.coalesce(F.lower(get(v, name, "string")).isin("true", "1", "yes", "on", "y", "t"), F.lit(False))


def _positive_interval(start: str, end: str) -> Callable[[Column, str], Column]:
    return lambda v, at: one_of(at, (_long(v, end) <= _long(v, start), "interval"))


def _job_rule(v: Column, at: str) -> Column:
    status = _string(v, "status")
    return one_of(at, ((status == "failed") & _absent(v, "error"), "failed_without_error"),
                  ((status == "succeeded") & ~_absent(v, "error"), "succeeded_with_error"))


def _stage_rule(v: Column, at: str) -> Column:
    status = _string(v, "status")
    order = F.coalesce(_time(v, "completed_at") < _time(v, "started_at"), F.lit(False))
    return one_of(at, (status.isin(*TERMINAL_STATUSES) & _absent(v, "completed_at"), "terminal_without_completion"),
                  ((status == "failed") & _absent(v, "error"), "failed_without_error"),
                  ((status == "succeeded") & ~_absent(v, "error"), "succeeded_with_error"),
                  (order, "completed_before_started"))


def _settings_rule(v: Column, at: str) -> Column:
    return one_of(at, (_truth(v, "burn_subtitles") & (F.coalesce(_string(v, "video_codec"), F.lit("copy")) == "copy"), "burn_needs_encoding"))


def _render_rule(v: Column, at: str) -> Column:
    s = get(v, "settings")
    strategy = F.coalesce(_string(s, "audio_strategy"), F.lit("subtitle_only"))
    return one_of(at, (_truth(s, "burn_subtitles") & _absent(v, "subtitle_ass"), "burn_needs_subtitles"),
                  (strategy.isin(*DUBBED_STRATEGIES) & _absent(v, "dubbed_audio"), "strategy_needs_dub"),
                  ((strategy == "voice_replace") & _absent(v, "accompaniment_audio"), "replace_needs_accompaniment"))


def _list(v: Column, name: str) -> Column:
    return F.coalesce(get(v, name, "array<variant>"), F.array().cast("array<variant>"))


def _in_order(starts: Column, first: Column) -> Column:
    """Whether starts never go back; the first is compared with ``first``."""
    def forward(s):
        before = F.slice(F.concat(F.array(first), s), 1, F.size(s))
        return F.forall(F.zip_with(s, before, lambda a, b: a >= b), lambda ok: ok)
    return bind(starts, forward)


def _segment_rule(v: Column, at: str) -> Column:
    times = lambda x: F.struct(_long(x, "start_ms").alias("start"), _long(x, "end_ms").alias("end"))

    def judged(own, words):
        inside = F.forall(words, lambda w: (w["start"] >= own["start"]) & (w["end"] <= own["end"]))
        return one_of(at, (own["end"] <= own["start"], "interval"), (~inside, "word_outside"),
                      (~_in_order(F.transform(words, lambda w: w["start"]), own["start"]), "word_order"))
    return bind(times(v), lambda own: bind(F.transform(_list(v, "words"), times), lambda words: judged(own, words)))


def _timeline_rule(start: str | None, duration: str | None = None) -> Callable[[Column, str], Column]:
    def rule(v, at):
        def judged(segments):
            repeated = bind(F.transform(segments, lambda s: _string(s, "segment_id")),
                            lambda ids: F.size(F.array_distinct(ids)) != F.size(ids))
            cases = [(repeated, "segment_id_repeated")]
            if start:
                cases.append((~_in_order(F.transform(segments, lambda s: _long(s, start)), F.lit(0).cast("long")), "segment_order"))
            if duration:
                within = bind(_long(v, duration), lambda most: F.forall(segments, lambda s: _long(s, "end_ms") <= most))
                cases.append((~within, "segment_beyond_duration"))
            return one_of(at, *cases)
        return bind(_list(v, "segments"), judged)
    return rule


def _manifest_rule(v: Column, at: str) -> Column:
    empty = F.array().cast("array<string>")
    of = lambda s, name: F.coalesce(get(s, name, "array<string>"), empty)
    stages = F.map_entries(F.coalesce(get(v, "stages", "map<string,variant>"), F.create_map().cast("map<string,variant>")))
    known = F.coalesce(F.map_keys(get(v, "artifacts", "map<string,variant>")), empty)
    keyed = F.forall(stages, lambda e: e["key"] == get(e["value"], "job_type", "string"))
    whole = bind(known, lambda k: F.forall(stages, lambda e: F.size(F.array_except(
        F.array_union(of(e["value"], "input_artifacts"), of(e["value"], "output_artifacts")), k)) == 0))
    return one_of(at, (_string(v, "video_id") != _string(get(v, "source"), "video_id"), "identity"),
                  (_time(v, "updated_at") < _time(v, "created_at"), "updated_before_created"),
                  (~keyed, "stage_key"), (~whole, "missing_artifacts"))


# ------------------------------------------------------------------ the contracts

name1, name2 = text(1), text(2)
SHA = text(0, SHA256_PATTERN)
ARTIFACT = model(must("uri", s3), must("content_type", name1), may("size", integer(0)), may("etag", name1),
                 may("version_id", name1), may("sha256", SHA))
JOB_ERROR = model(must("code", name1), must("message", name1), defaulted("retryable", flag), defaulted("details", json_object))
VIDEO = model(must("video_id", name1), must("channel_id", name1), may("channel_title", text()), must("title", name1),
              may("description", text()), must("published_at", instant), must("source_url", http),
              may("thumbnail_url", http), may("duration_ms", integer(0)), may("default_language", text()))
KEYS = listing(text(1, ARTIFACT_KEY_PATTERN))
STAGE = model(must("job_type", member(JOB_TYPES)), must("status", member(JOB_STATUSES)), must("job_id", name1),
              must("idempotency_key", name1), defaulted("input_artifacts", KEYS), defaulted("output_artifacts", KEYS),
              must("parameters_sha256", SHA), may("error", JOB_ERROR), may("started_at", instant),
              may("completed_at", instant), rule=_stage_rule)
PUBLICATION = model(must("aid", integer(above=0)), must("bvid", name1), must("url", http), must("published_at", instant),
                    must("title", name1))
SETTINGS = model(defaulted("audio_strategy", member(("subtitle_only", *DUBBED_STRATEGIES))), defaulted("burn_subtitles", flag),
                 defaulted("video_codec", member(("copy", "libx264"))), defaulted("preset", text()),
                 defaulted("crf", integer(0, 51)), defaulted("audio_codec", text()), defaulted("audio_bitrate", text()),
                 defaulted("pixel_format", text()), defaulted("faststart", flag), rule=_settings_rule, versioned=False)
WORD = model(must("start_ms", integer(0)), must("end_ms", integer(above=0)), must("text", name1),
             may("probability", number(0, 1)), rule=_positive_interval("start_ms", "end_ms"), versioned=False)
SEGMENT = model(must("segment_id", name1), must("start_ms", integer(0)), must("end_ms", integer(above=0)),
                must("text", name1), defaulted("words", listing(WORD)), may("speaker", text()), rule=_segment_rule, versioned=False)
TRANSLATED = model(must("segment_id", name1), must("source_start_ms", integer(0)), must("source_end_ms", integer(above=0)),
                   must("source_text", name1), must("translated_text", name1), may("speaker", text()),
                   defaulted("translation_version", integer(1)),
                   rule=_positive_interval("source_start_ms", "source_end_ms"), versioned=False)
SPOKEN = model(must("segment_id", name1), must("target_start_ms", integer(0)), must("target_end_ms", integer(above=0)),
               must("text", name1), must("voice", name1), must("audio", ARTIFACT), must("actual_duration_ms", integer(above=0)),
               rule=_positive_interval("target_start_ms", "target_end_ms"), versioned=False)
QUALITY = model(must("name", name1), must("passed", flag), may("detail", text()), versioned=False)

DOCUMENTS: dict[str, Model] = {
    "artifact": ARTIFACT,
    "youtube_video": VIDEO,
    "youtube_channel": model(must("channel_id", name1), must("title", name1), may("description", text()),
                             may("published_at", instant), must("uploads_playlist_id", name1)),
    "localization_job": model(must("job_id", name1, "id"), must("job_type", member(JOB_TYPES), "type"),
                              must("status", member(JOB_STATUSES)), may("output", json_object), may("error", JOB_ERROR),
                              may("created_at", instant), may("updated_at", instant), rule=_job_rule),
    "job_request": model(must("job_type", member(JOB_TYPES)), must("input_uri", name1), must("output_prefix", s3),
                         defaulted("parameters", json_object)),
    "stage_record": STAGE,
    "render_request": model(must("source_video", ARTIFACT), must("output_uri", s3), defaulted("settings", SETTINGS),
                            may("dubbed_audio", ARTIFACT), may("accompaniment_audio", ARTIFACT),
                            may("subtitle_ass", ARTIFACT), rule=_render_rule),
    "render_result": model(must("video", ARTIFACT), *[must(n, integer(above=0)) for n in ("duration_ms", "width", "height")],
                           must("video_codec", name1), must("audio_codec", name1), must("subtitle_burned", flag),
                           defaulted("backend", text())),
    "quality_report": model(must("video", ARTIFACT), must("passed", flag), must("checks", listing(QUALITY)),
                            may("duration_delta_ms", integer(0)), may("integrated_loudness_lufs", number())),
    "source_separation": model(must("source_audio", ARTIFACT), must("provider", name1), must("model", name1),
                               must("vocals", ARTIFACT), must("accompaniment", ARTIFACT)),
    "publish_result": PUBLICATION,
    "video_manifest": model(must("video_id", name1), defaulted("revision", integer(1)), must("source", VIDEO),
                            defaulted("artifacts", mapping(lambda k: k.rlike(ARTIFACT_KEY_PATTERN), ARTIFACT)),
                            defaulted("stages", mapping(lambda k: k.isin(*JOB_TYPES), STAGE)), may("publication", PUBLICATION),
                            must("created_at", instant), must("updated_at", instant), rule=_manifest_rule),
    "transcript": model(must("source_audio", ARTIFACT), must("language", name2), must("duration_ms", integer(above=0)),
                        must("provider", name1), must("model", name1), must("segments", listing(SEGMENT)),
                        defaulted("raw_response_artifacts", listing(ARTIFACT)), rule=_timeline_rule("start_ms", "duration_ms")),
    "translated_timeline": model(must("source_transcript", ARTIFACT), must("source_language", name2),
                                 must("target_language", name2), must("provider", name1), must("model", name1),
                                 must("segments", listing(TRANSLATED)), may("subtitle_srt", ARTIFACT),
                                 may("subtitle_ass", ARTIFACT), rule=_timeline_rule("source_start_ms")),
    "synthesis_result": model(must("source_timeline", ARTIFACT), must("language", name2), must("provider", name1),
                              must("model", name1), must("voice", name1), must("segments", listing(SPOKEN)),
                              must("dubbed_audio", ARTIFACT), rule=_timeline_rule(None)),
}


# Contracts that only occur inside others or in messages.
PARTS: dict[str, Model] = {
    "job_error": JOB_ERROR,
    "message": model(must("title", name1), must("body", name1), may("subtitle", text()), may("markdown", text()),
                     defaulted("level", member(MESSAGE_LEVELS)), may("url", http),
                     may("group", text()), may("icon", http), may("sound", text()), may("badge", integer(0)),
                     defaulted("call", flag), may("copy", text()), defaulted("autoCopy", flag), defaulted("isArchive", flag),
                     versioned=False),
    "market_status": model(must("is_open", flag), must("is_trading_day", flag), must("current_time", text()),
                           may("open_time", text()), may("close_time", text()), may("next_trading_day", text()), versioned=False),
}


def contract_model(name: str) -> Model:
    return DOCUMENTS[name] if name in DOCUMENTS else PARTS[name]


def _parsed(raw) -> Column:
    return F.try_parse_json(F.coalesce(col_of(raw), F.lit("")))


def document_codes(raw, name: str) -> Column:
    """Codes of all that is wrong with the JSON text ``raw`` as this contract."""
    return bind(_parsed(raw), lambda d: F.when(d.isNull(), code("", "json")).otherwise(contract_model(name)(d, "")))


def parsed_documents(df: DataFrame, raw: str, name: str) -> DataFrame:
    """``df`` with the parsed document ``_v`` and the value ``_x_<field>`` of each
    of its fields, aliases folded: one parse, each value taken out once."""
    parsed = evaluate_once(df, df.columns, [_parsed(raw).alias("_v")])
    fields = contract_model(name).fields
    return evaluate_once(parsed, parsed.columns, [_value(lambda n: get(F.col("_v"), n), f).alias(f"_x_{f.name}") for f in fields])


def field_codes(name: str) -> Column:
    """Codes of a document in ``parsed_documents``' columns, before the rule across fields."""
    m = contract_model(name)
    return m.found(F.col("_v"), lambda n: get(F.col("_v"), n), {f.name: F.col(f"_x_{f.name}") for f in m.fields}, "")


def settled_codes(name: str, found: str) -> Column:
    """All codes of a document, given those of its fields."""
    v = F.col("_v")
    return F.when(v.isNull(), code("", "json")).otherwise(contract_model(name).settled(v, F.col(found), ""))


def with_codes(df: DataFrame, raw: str, name: str) -> DataFrame:
    """``df`` with ``codes`` of the JSON text ``raw`` as this contract."""
    p = parsed_documents(df, raw, name)
    p = p.select(*df.columns, "_v", field_codes(name).alias("_found"))
    return p.select(*df.columns, settled_codes(name, "_found").alias("codes"))
