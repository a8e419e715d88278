"""Contract schemas (§1.3) and strict JSON reading/writing.

A contract is a ``StructType`` plus the names of its required fields and
its defaults.  Reading parses the text once, to VARIANT, and takes two things
from it: the typed values, directed by the ``StructType`` (strings stripped, S3;
aliases folded, S4; defaults filled at every level, S5; lax integers, S7), and
the codes of all that is wrong (``operators.contract_check``: unknown fields, S1;
the version literal, S2; required fields, S6; every rule).  A value that its
field refuses is null, and a code says why.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tapeworks.functions import bind, col_of, evaluate_once
from tapeworks.functions.text import strip_ws
from tapeworks.functions.time import iso_text

SCHEMA_VERSION = "1.0"  # fixed: the only accepted contract version

ARTIFACT = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("uri", T.StringType()),
    T.StructField("content_type", T.StringType()),
    T.StructField("size", T.LongType()),
    T.StructField("etag", T.StringType()),
    T.StructField("version_id", T.StringType()),
    T.StructField("sha256", T.StringType()),
])

YOUTUBE_VIDEO = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("video_id", T.StringType()),
    T.StructField("channel_id", T.StringType()),
    T.StructField("channel_title", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("source_url", T.StringType()),
    T.StructField("thumbnail_url", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("default_language", T.StringType()),
])

JOB_ERROR = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("code", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("retryable", T.BooleanType()),
    T.StructField("details", T.StringType()),
])

LOCALIZATION_JOB = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("job_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("output", T.StringType()),
    T.StructField("error", JOB_ERROR),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])

JOB_REQUEST = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("job_type", T.StringType()),
    T.StructField("input_uri", T.StringType()),
    T.StructField("output_prefix", T.StringType()),
    T.StructField("parameters", T.StringType()),
])

STAGE_RECORD = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("job_type", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("job_id", T.StringType()),
    T.StructField("idempotency_key", T.StringType()),
    T.StructField("input_artifacts", T.ArrayType(T.StringType())),
    T.StructField("output_artifacts", T.ArrayType(T.StringType())),
    T.StructField("parameters_sha256", T.StringType()),
    T.StructField("error", JOB_ERROR),
    T.StructField("started_at", T.StringType()),
    T.StructField("completed_at", T.StringType()),
])

RENDER_SETTINGS = T.StructType([
    T.StructField("audio_strategy", T.StringType()),
    T.StructField("burn_subtitles", T.BooleanType()),
    T.StructField("video_codec", T.StringType()),
    T.StructField("preset", T.StringType()),
    T.StructField("crf", T.LongType()),
    T.StructField("audio_codec", T.StringType()),
    T.StructField("audio_bitrate", T.StringType()),
    T.StructField("pixel_format", T.StringType()),
    T.StructField("faststart", T.BooleanType()),
])

RENDER_REQUEST = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("source_video", ARTIFACT),
    T.StructField("output_uri", T.StringType()),
    T.StructField("settings", RENDER_SETTINGS),
    T.StructField("dubbed_audio", ARTIFACT),
    T.StructField("accompaniment_audio", ARTIFACT),
    T.StructField("subtitle_ass", ARTIFACT),
])

PUBLISH_RESULT = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("aid", T.LongType()),
    T.StructField("bvid", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("published_at", T.StringType()),
    T.StructField("title", T.StringType()),
])

VIDEO_MANIFEST = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("video_id", T.StringType()),
    T.StructField("revision", T.LongType()),
    T.StructField("source", YOUTUBE_VIDEO),
    T.StructField("artifacts", T.MapType(T.StringType(), ARTIFACT)),
    T.StructField("stages", T.MapType(T.StringType(), STAGE_RECORD)),
    T.StructField("publication", PUBLISH_RESULT),
    T.StructField("created_at", T.StringType()),
    T.StructField("updated_at", T.StringType()),
])

TRANSCRIPT_WORD = T.StructType([
    T.StructField("start_ms", T.LongType()),
    T.StructField("end_ms", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("probability", T.DoubleType()),
])

TRANSCRIPT_SEGMENT = T.StructType([
    T.StructField("segment_id", T.StringType()),
    T.StructField("start_ms", T.LongType()),
    T.StructField("end_ms", T.LongType()),
    T.StructField("text", T.StringType()),
    T.StructField("words", T.ArrayType(TRANSCRIPT_WORD)),
    T.StructField("speaker", T.StringType()),
])

TRANSCRIPT = T.StructType([
    T.StructField("schema_version", T.StringType()),
    T.StructField("source_audio", ARTIFACT),
    T.StructField("language", T.StringType()),
    T.StructField("duration_ms", T.LongType()),
    T.StructField("provider", T.StringType()),
    T.StructField("model", T.StringType()),
    T.StructField("segments", T.ArrayType(TRANSCRIPT_SEGMENT)),
    T.StructField("raw_response_artifacts", T.ArrayType(ARTIFACT)),
])

def _struct(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


_S, _L, _B, _D = T.StringType(), T.LongType(), T.BooleanType(), T.DoubleType()

YOUTUBE_CHANNEL = _struct(("schema_version", _S), ("channel_id", _S), ("title", _S), ("description", _S),
                          ("published_at", _S), ("uploads_playlist_id", _S))

TRANSLATED_SEGMENT = _struct(("segment_id", _S), ("source_start_ms", _L), ("source_end_ms", _L), ("source_text", _S),
                             ("translated_text", _S), ("speaker", _S), ("translation_version", _L))
TRANSLATED_TIMELINE = _struct(("schema_version", _S), ("source_transcript", ARTIFACT), ("source_language", _S),
                              ("target_language", _S), ("provider", _S), ("model", _S),
                              ("segments", T.ArrayType(TRANSLATED_SEGMENT)), ("subtitle_srt", ARTIFACT),
                              ("subtitle_ass", ARTIFACT))

SYNTHESIZED_SEGMENT = _struct(("segment_id", _S), ("target_start_ms", _L), ("target_end_ms", _L), ("text", _S),
                              ("voice", _S), ("audio", ARTIFACT), ("actual_duration_ms", _L))
SYNTHESIS_RESULT = _struct(("schema_version", _S), ("source_timeline", ARTIFACT), ("language", _S), ("provider", _S),
                           ("model", _S), ("voice", _S), ("segments", T.ArrayType(SYNTHESIZED_SEGMENT)),
                           ("dubbed_audio", ARTIFACT))
SOURCE_SEPARATION = _struct(("schema_version", _S), ("source_audio", ARTIFACT), ("provider", _S), ("model", _S),
                            ("vocals", ARTIFACT), ("accompaniment", ARTIFACT))
RENDER_RESULT = _struct(("schema_version", _S), ("video", ARTIFACT), ("duration_ms", _L), ("width", _L),
                        ("height", _L), ("video_codec", _S), ("audio_codec", _S), ("subtitle_burned", _B),
                        ("backend", _S))
QUALITY_CHECK = _struct(("name", _S), ("passed", _B), ("detail", _S))
QUALITY_REPORT = _struct(("schema_version", _S), ("video", ARTIFACT), ("passed", _B),
                         ("checks", T.ArrayType(QUALITY_CHECK)), ("duration_delta_ms", _L),
                         ("integrated_loudness_lufs", _D))
MARKET_STATUS = _struct(("is_open", _B), ("is_trading_day", _B), ("current_time", _S), ("open_time", _S),
                        ("close_time", _S), ("next_trading_day", _S))

MESSAGE = T.StructType([T.StructField(n, t) for n, t in [
    ("title", T.StringType()), ("body", T.StringType()), ("subtitle", T.StringType()),
    ("markdown", T.StringType()), ("level", T.StringType()), ("url", T.StringType()),
    ("group", T.StringType()), ("icon", T.StringType()), ("sound", T.StringType()),
    ("badge", T.LongType()), ("call", T.BooleanType()), ("copy", T.StringType()),
    ("autoCopy", T.BooleanType()), ("isArchive", T.BooleanType())]])


@dataclass(frozen=True)
class Contract:
    name: str
    schema: T.StructType
    required: tuple[str, ...]
    defaults: dict = field(default_factory=dict)
    versioned: bool = True
    aliases: dict = field(default_factory=dict)   # field -> alternative JSON key
    json_fields: tuple[str, ...] = ()              # opaque JSON objects kept as text


CONTRACTS = {
    "artifact": Contract("artifact", ARTIFACT, ("uri", "content_type")),
    "youtube_video": Contract("youtube_video", YOUTUBE_VIDEO,
                              ("video_id", "channel_id", "title", "published_at", "source_url")),
    "job_error": Contract("job_error", JOB_ERROR, ("code", "message"),
                          {"retryable": False, "details": "{}"}, json_fields=("details",)),
    "localization_job": Contract("localization_job", LOCALIZATION_JOB, ("job_id", "job_type", "status"),
                                 aliases={"job_id": "id", "job_type": "type"}, json_fields=("output",)),
    "job_request": Contract("job_request", JOB_REQUEST, ("job_type", "input_uri", "output_prefix"),
                            {"parameters": "{}"}, json_fields=("parameters",)),
    "stage_record": Contract("stage_record", STAGE_RECORD,
                             ("job_type", "status", "job_id", "idempotency_key", "parameters_sha256"),
                             {"input_artifacts": [], "output_artifacts": []}),
    "render_request": Contract("render_request", RENDER_REQUEST, ("source_video", "output_uri")),
    "video_manifest": Contract("video_manifest", VIDEO_MANIFEST, ("video_id", "source", "created_at", "updated_at"),
                               {"revision": 1}),
    "transcript": Contract("transcript", TRANSCRIPT,
                           ("source_audio", "language", "duration_ms", "provider", "model", "segments"),
                           {"raw_response_artifacts": []}),
    "youtube_channel": Contract("youtube_channel", YOUTUBE_CHANNEL, ("channel_id", "title", "uploads_playlist_id")),
    "translated_timeline": Contract("translated_timeline", TRANSLATED_TIMELINE,
                                    ("source_transcript", "source_language", "target_language", "provider",
                                     "model", "segments")),
    "synthesis_result": Contract("synthesis_result", SYNTHESIS_RESULT,
                                 ("source_timeline", "language", "provider", "model", "voice", "segments",
                                  "dubbed_audio")),
    "source_separation": Contract("source_separation", SOURCE_SEPARATION,
                                  ("source_audio", "provider", "model", "vocals", "accompaniment")),
    "render_result": Contract("render_result", RENDER_RESULT,
                              ("video", "duration_ms", "width", "height", "video_codec", "audio_codec",
                               "subtitle_burned"), {"backend": "local_ffmpeg"}),
    "quality_report": Contract("quality_report", QUALITY_REPORT, ("video", "passed", "checks")),
    "publish_result": Contract("publish_result", PUBLISH_RESULT, ("aid", "bvid", "url", "published_at", "title")),
    "market_status": Contract("market_status", MARKET_STATUS, ("is_open", "is_trading_day", "current_time"),
                              versioned=False),
    "message": Contract("message", MESSAGE, ("title", "body"),
                        {"level": "active", "call": False, "autoCopy": False, "isArchive": False},
                        versioned=False),
}

# Defaults of the render settings.
RENDER_DEFAULTS = {"audio_strategy": "subtitle_only", "burn_subtitles": False, "video_codec": "copy",
                   "preset": "fast", "crf": 22, "audio_codec": "aac", "audio_bitrate": "192k",
                   "pixel_format": "yuv420p", "faststart": True}


# Defaults of the parts of documents.
PART_DEFAULTS = [
    (JOB_ERROR, {"retryable": False, "details": "{}"}),
    (RENDER_SETTINGS, RENDER_DEFAULTS),
    (STAGE_RECORD, {"input_artifacts": [], "output_artifacts": []}),
    (TRANSCRIPT_SEGMENT, {"words": []}),
    (TRANSLATED_SEGMENT, {"translation_version": 1}),
]
# Fields that are compared as they stand, JSON objects kept as text, and instants
# (text, or a number of seconds).
EXACT_FIELDS = ("schema_version", "job_type", "status", "audio_strategy", "video_codec", "level")
OBJECT_FIELDS = ("details", "output", "parameters")
INSTANT_SUFFIX = "_at"
TRUE_TEXTS = ("true", "1", "yes", "on", "y", "t")    # fixed: texts read as flags
FALSE_TEXTS = ("false", "0", "no", "off", "n", "f")


# ------------------------------------------------------------------ S1


def unknown_fields(raw, schema: T.StructType, path: str = "$", label: str = "",
                   aliases: dict | None = None, opaque: tuple[str, ...] = ()) -> Column:
    """Sorted array of undeclared keys at every nesting level.

    Walks the ``StructType`` statically: object keys of the document (or of
    each array element) are compared with the declared names.  Opaque JSON
    fields are not descended into.
    """
    node = col_of(raw) if path == "$" else F.get_json_object(col_of(raw), path)
    return F.array_sort(F.array_distinct(_unknown(node, schema, label, aliases or {}, opaque)))


_NO_KEYS = "array<string>"


def _element_check(schema: T.StructType, label: str):
    """One-argument lambda for ``transform`` (closes over schema and label)."""
    return lambda e: _unknown(e, schema, label, {}, ())


def _unknown(node: Column, schema: T.StructType, label: str, aliases: dict, opaque: tuple[str, ...]) -> Column:
    """Undeclared keys of the JSON object text ``node`` and, recursively, of
    its struct fields, of struct elements of arrays and of struct values of
    maps (labelled ``a.b``, ``a[].b``, ``a{}.b``), at any depth."""
    empty = F.array().cast(_NO_KEYS)
    keys = F.coalesce(F.json_object_keys(node), empty)
    known = [f.name for f in schema.fields] + list(aliases.values())
    parts = [F.transform(F.array_except(keys, F.array(*[F.lit(k) for k in known])),
                         lambda k: F.concat(F.lit(label), k))]
    for name, alt in aliases.items():
        # both the name and its alias present: the alias counts as unknown
        both = F.array_contains(keys, name) & F.array_contains(keys, alt)
        parts.append(F.when(both, F.array(F.lit(label + alt))).otherwise(empty))
    for f in schema.fields:
        if f.name in opaque:
            continue
        child = F.get_json_object(node, f"$.{f.name}")
        t = f.dataType
        if isinstance(t, T.StructType):
            parts.append(_unknown(child, t, f"{label}{f.name}.", {}, ()))
        elif isinstance(t, (T.ArrayType, T.MapType)):
            inner = t.elementType if isinstance(t, T.ArrayType) else t.valueType
            if not isinstance(inner, T.StructType):
                continue
            elems = (F.from_json(child, "array<string>") if isinstance(t, T.ArrayType)
                     else F.map_values(F.from_json(child, "map<string,string>")))
            mark = "[]." if isinstance(t, T.ArrayType) else "{}."
            per = F.transform(elems, _element_check(inner, f"{label}{f.name}{mark}"))
            parts.append(F.flatten(F.coalesce(per, F.array().cast("array<array<string>>"))))
    out = parts[0]
    for p in parts[1:]:
        out = F.concat(out, p)
    return out


# ------------------------------------------------------------------ S3, S5, S7


def strip_strings(c: Column, dtype: T.DataType) -> Column:
    """S3: strip every string leaf of a (nested) value."""
    if isinstance(dtype, T.StringType):
        return strip_ws(c)
    if isinstance(dtype, T.StructType):
        rebuilt = F.struct(*[strip_strings(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields])
        return F.when(c.isNull(), F.lit(None)).otherwise(rebuilt)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda e: strip_strings(e, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda k, v: strip_strings(v, dtype.valueType))
    return c


def fill_struct_defaults(df: DataFrame, col: str, defaults: dict) -> DataFrame:
    """S5 inside a nested value (e.g. render settings): an absent struct
    becomes its defaults, absent fields of a present struct get theirs;
    declared defaults missing from the struct are added."""
    dtype = df.schema[col].dataType
    c = F.col(col)
    names = [f.name for f in dtype.fields]
    parts = []
    for f in dtype.fields:
        v = c.getField(f.name)
        if f.name in defaults:
            v = F.coalesce(v, F.lit(defaults[f.name]).cast(f.dataType))
        parts.append(v.alias(f.name))
    parts += [F.lit(v).alias(k) for k, v in defaults.items() if k not in names]
    return df.withColumn(col, F.struct(*parts))


def apply_defaults(df: DataFrame, defaults: dict, prefix: str = "") -> DataFrame:
    """Fill declared defaults where the value is absent."""
    out = df
    for name, value in defaults.items():
        col = f"{prefix}{name}"
        if isinstance(value, list):
            lit = F.array().cast(df.schema[col].dataType) if col in df.columns else F.array()
        else:
            lit = F.lit(value)
        out = out.withColumn(col, F.coalesce(F.col(col), lit)) if col in out.columns else out.withColumn(col, lit)
    return out


def lax_int(token) -> Column:
    """A JSON number token → long; ``5``, ``"5"``, ``5.0`` and ``true``
    pass, ``5.5`` and other text give null."""
    t = strip_ws(col_of(token))
    return (F.when(t.rlike(r"^[+-]?\d+\z"), t.try_cast("long"))
            .when(t.rlike(r"^[+-]?\d+\.0*\z"), t.try_cast("double").cast("long"))
            .when(t == "true", F.lit(1).cast("long"))
            .when(t == "false", F.lit(0).cast("long")))


# ------------------------------------------------------------------ A1


def _default(value, dtype: T.DataType) -> Column:
    if isinstance(value, list):
        return F.array().cast(dtype)
    return F.lit(value).cast(dtype)


def is_object(x: Column) -> Column:
    """Whether the VARIANT ``x`` is a JSON object; looks at its own fields'
    names alone, where ``schema_of_variant`` reads all that is inside."""
    return F.when(x.isNotNull(), F.try_variant_get(x, "$", "struct<>").isNotNull())


def parts_of(x: Column, names: list[str]) -> Column:
    """The values of the JSON object ``x`` under these names, as a struct of
    VARIANTs taken out in one pass; null where ``x`` is no object."""
    return F.try_variant_get(x, "$", f"struct<{','.join(f'`{n}`:variant' for n in names)}>")


def decode(x: Column, dtype: T.DataType, name: str = "") -> Column:
    """The value of the VARIANT ``x`` as the type of a contract's field ``name``;
    null where the field would refuse it."""
    kind = F.schema_of_variant(x)
    said = F.try_variant_get(x, "$", "string")
    if isinstance(dtype, T.StringType):
        if name in OBJECT_FIELDS:
            return F.when(is_object(x), F.to_json(x))
        if name in EXACT_FIELDS:
            return F.when(kind == "STRING", said)
        if name.endswith(INSTANT_SUFFIX):
            return F.when(kind.rlike("^(STRING|BIGINT|DOUBLE|DECIMAL)"), strip_ws(said))
        return F.when(kind == "STRING", strip_ws(said))
    if isinstance(dtype, T.LongType):
        return F.when(~kind.rlike("^(OBJECT|ARRAY)"), lax_int(said))
    if isinstance(dtype, T.DoubleType):
        return F.when(~kind.rlike("^(OBJECT|ARRAY|BOOLEAN)"), said.try_cast("double"))
    if isinstance(dtype, T.BooleanType):
        low = F.lower(said)
        return F.when(kind.rlike("^(BOOLEAN|STRING|BIGINT)"), F.when(low.isin(*TRUE_TEXTS), True).when(low.isin(*FALSE_TEXTS), False))
    if isinstance(dtype, T.ArrayType):
        parts = F.try_variant_get(x, "$", "array<variant>")
        return F.transform(parts, lambda e: decode(e, dtype.elementType))
    if isinstance(dtype, T.MapType):
        parts = F.try_variant_get(x, "$", "map<string,variant>")
        return F.transform_values(parts, lambda k, e: decode(e, dtype.valueType))
    defaults = next((d for part, d in PART_DEFAULTS if part == dtype), {})
    fields = lambda own: F.struct(*[with_default(decode(own[f.name], f.dataType, f.name), own[f.name], f, defaults).alias(f.name)
                                    for f in dtype.fields])
    return bind(parts_of(x, [f.name for f in dtype.fields]), lambda own: F.when(own.isNotNull(), fields(own)))


def with_default(value: Column, x: Column, f: T.StructField, defaults: dict) -> Column:
    """A field's value, or its default where the document doesn't have the field."""
    if f.name == "schema_version":
        return F.when(x.isNull(), SCHEMA_VERSION).otherwise(value)
    if f.name in defaults:
        return F.when(x.isNull(), _default(defaults[f.name], f.dataType)).otherwise(value)
    return value


def parse_contract(df: DataFrame, raw: str, contract: Contract, checked: bool = True) -> DataFrame:
    """A1 on a column of JSON text: typed contract columns, the raw text,
    ``version_ok`` (S2) and ``malformed`` (not one JSON value); ``checked``: also
    ``codes`` of all that is wrong (none: valid) and ``unknown_fields`` (S1).
    """
    from tapeworks.operators import contract_check as check  # it reads this module's constants

    parsed = check.parsed_documents(df, raw, contract.name)
    x = lambda name: F.col(f"_x_{name}")
    read = F.col("_v").isNotNull()
    values = [F.when(read, with_default(decode(x(f.name), f.dataType, f.name), x(f.name), f, contract.defaults)).alias(f.name)
              for f in contract.schema.fields]
    held = evaluate_once(parsed, parsed.columns, values)
    out = [*df.columns, *[f.name for f in contract.schema.fields], F.col("_v").isNull().alias("malformed")]
    if contract.versioned:
        out.append((read & F.coalesce(F.col("schema_version") == SCHEMA_VERSION, F.lit(False))).alias("version_ok"))
    if not checked:
        return held.select(*out)
    # A filter on the codes must not be pushed below, where it would repeat them.
    held = evaluate_once(held.withColumn("_found", check.field_codes(contract.name)), held.columns,
                         [check.settled_codes(contract.name, "_found").alias("codes")])
    paths = F.transform(F.filter("codes", lambda c: c.endswith(":unknown")),
                        lambda c: F.replace(F.replace(F.regexp_replace(c, ":unknown$", ""), F.lit(".[]"), F.lit("[]")), F.lit(".{}"), F.lit("{}")))
    return held.select(*out, F.array_sort(F.array_distinct(paths)).alias("unknown_fields"), "codes")


def read_contract(spark: SparkSession, path: str, contract: Contract, whole_files: bool = False) -> DataFrame:
    """A1 on files: one JSON document per line (or, with ``whole_files``,
    one document per file, e.g. ``manifest.json`` objects), read as text and
    parsed with the contract's fixed schema (no inference); the raw text is
    kept in ``raw`` and, for whole files, the file path in ``path``."""
    text = spark.read.text(path, wholetext=whole_files)
    if whole_files:
        text = text.select(F.col("value").alias("raw"), F.col("_metadata.file_path").alias("path"))
    else:
        text = text.withColumnRenamed("value", "raw")
    return parse_contract(text, "raw", contract)


# ------------------------------------------------------------------ A2


def to_contract_json(df: DataFrame, cols: list[str], ts_cols: tuple[str, ...] = ()) -> Column:
    """A2: canonical JSON text: nulls kept, instants as ISO text with ``Z``."""
    parts = [iso_text(F.col(c)).alias(c) if c in ts_cols else F.col(c) for c in cols]
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})
