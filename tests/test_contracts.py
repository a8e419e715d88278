"""Contract reading and rules on small cases."""

import json

from pyspark.sql import functions as F

from conftest import rows
from tapeworks.operators import rules as R
from tapeworks.operators.payload import message_payload
from tapeworks.sources.contracts import CONTRACTS, lax_int, parse_contract, to_contract_json

GOOD_URI = "s3://shelf-7/films/q9/cut.mkv"
ARTIFACT = {"uri": GOOD_URI, "content_type": "video/x-matroska", "size": 77, "sha256": "0f" * 32,
            "schema_version": "1.0"}


def _artifacts(spark, docs):
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, raw string")
    return parse_contract(df, "raw", CONTRACTS["artifact"])


def _codes(spark, docs):
    a = _artifacts(spark, docs)
    rules = ([R.Rule("schema_version", F.col("version_ok"), "v")] + R.artifact_rules()
             + [R.Rule("extra_forbidden", F.size("unknown_fields") == 0, "x")])
    return [r["c"] for r in R.validate(a, rules).orderBy("id").select(R.codes().alias("c")).collect()]


def test_object_uris(spark):
    good = [GOOD_URI, "S3://Shelf/k", "s3://b/a b/c", "s3://b/k?", "s3://b/k#", "s3://b//k"]
    bad = ["", "shelf/k", "gs://b/k", "https://b.example/k", "s3:/b/k", "s3://", "s3://b", "s3://b/", "s3://b//", "s3:///k",
           "s3://b/k?version=2", "s3://b/k#part", "s3://b/k?a=1#b"]
    df = spark.createDataFrame([(u, u in good) for u in good + bad], "uri string, expected boolean")
    assert [r["uri"] for r in df.select("uri", "expected", R.s3_uri("uri").ok.alias("ok")).collect() if r["ok"] != r["expected"]] == []


def test_artifact_field_rules(spark):
    without = {k: v for k, v in ARTIFACT.items() if k != "schema_version"}
    cases = [(ARTIFACT, ""), (without, ""), ({**without, "schema_version": "1.1"}, "schema_version"),
             ({**ARTIFACT, "owner": 3}, "extra_forbidden"), ({**ARTIFACT, "sha256": "0F" * 32}, "sha256"),
             ({**ARTIFACT, "sha256": "0f" * 31}, "sha256"), ({**ARTIFACT, "etag": ""}, "etag"),
             ({**ARTIFACT, "size": -7, "version_id": " "}, "size,version_id")]
    assert _codes(spark, [d for d, _ in cases]) == [c for _, c in cases]


def test_strip_before_rules(spark):
    a = _artifacts(spark, [{**ARTIFACT, "uri": "  " + GOOD_URI + "\n", "content_type": " \t "}])
    r = a.collect()[0]
    assert r["uri"] == GOOD_URI and r["content_type"] == ""
    assert _codes(spark, [{**ARTIFACT, "content_type": "   "}]) == ["content_type"]


def test_round_trip_keeps_nulls_and_values(spark):
    a = _artifacts(spark, [ARTIFACT])
    out = json.loads(a.select(to_contract_json(a, ["schema_version", "uri", "content_type", "size", "etag",
                                                   "version_id", "sha256"])).collect()[0][0])
    assert out == {**ARTIFACT, "etag": None, "version_id": None}


def test_job_aliases_state_and_naive_time(spark):
    docs = [
        {"id": "job-1", "type": "transcribe", "status": "running", "updated_at": "2026-08-19T00:00:00Z"},
        {"job_id": "job-2", "job_type": "download", "status": "failed", "updated_at": "2026-08-19T00:00:00Z"},
        {"job_id": "job-3", "job_type": "download", "status": "running", "updated_at": "2026-08-19T00:00:00"},
        {"job_id": "job-4", "job_type": "download", "status": "done"},
        {"job_id": "job-5", "id": "job-5", "job_type": "download", "status": "queued"},
        {"job_id": "job-6", "job_type": "download", "status": "succeeded",
         "error": {"code": "E", "message": "m"}},
    ]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, raw string")
    j = parse_contract(df, "raw", CONTRACTS["localization_job"])
    fields = [R.enum("status", R.JOB_STATUSES, "status"), R.aware_ts("updated_at"),
              R.Rule("extra_forbidden", F.size("unknown_fields") == 0, "x")]
    v = R.validate(j, fields, [R.job_state()]).orderBy("id")
    got = [(r["job_id"], r["job_type"], r["c"]) for r in v.select("job_id", "job_type", R.codes().alias("c")).collect()]
    assert got == [("job-1", "transcribe", ""), ("job-2", "download", "job_state"),
                   ("job-3", "download", "aware_ts"), ("job-4", "download", "status"),
                   ("job-5", "download", "extra_forbidden"), ("job-6", "download", "job_state")]


def test_request_presigned_prefix_refused(spark):
    df = spark.createDataFrame([("s3://b/out/",), ("s3://b/out/?X-Amz-Signature=abc",)], "p string")
    assert [r[0] for r in df.select(R.s3_uri("p").ok).collect()] == [True, False]


def test_stage_record_rules(spark):
    df = spark.createDataFrame(
        [("succeeded", None, "2026-08-19 00:00:00", None), ("succeeded", None, "2026-08-19 00:00:00", "2026-08-18 00:00:00"),
         ("failed", None, "2026-08-19 00:00:00", "2026-08-19 01:00:00"), ("running", None, None, None)],
        "status string, error string, started string, completed string").select(
        "status", "error", F.to_timestamp("started").alias("s"), F.to_timestamp("completed").alias("c"))
    v = R.validate(df, [], R.stage_record_rules("status", "error", "s", "c"))
    assert [r[0] for r in v.select(R.codes()).collect()] == [
        "stage_terminal_completed", "stage_time_order", "stage_failed_error", ""]


def test_render_matrix(spark):
    cases = [("subtitle_only", True, "copy", True, False, False),    # burn + copy
             ("subtitle_only", True, "libx264", False, False, False),  # burn without ASS
             ("voice_replace", False, "copy", False, True, False),   # replace without accompaniment
             ("voice_overlay", False, "copy", False, False, False),  # overlay without dub
             ("voice_overlay", False, "copy", False, True, False)]   # ok
    df = spark.createDataFrame(cases, "a string, burn boolean, codec string, ass boolean, dub boolean, acc boolean")
    df = df.select(F.struct(F.col("a").alias("audio_strategy"), F.col("burn").alias("burn_subtitles"),
                            F.col("codec").alias("video_codec")).alias("settings"),
                   F.when(F.col("ass"), F.lit("x")).alias("subtitle_ass"),
                   F.when(F.col("dub"), F.lit("x")).alias("dubbed_audio"),
                   F.when(F.col("acc"), F.lit("x")).alias("accompaniment_audio"))
    v = R.validate(df, [R.render_settings_rule()], R.render_request_rules())
    assert [r[0] for r in v.select(R.codes()).collect()] == [
        "render_settings", "render_needs_ass", "render_needs_accompaniment", "render_needs_dub", ""]


def test_message_payload_and_level(spark):
    df = spark.createDataFrame(
        [("t", "b", None, None, 0, False, True, False), ("t", "b", "urgent", None, None, True, False, True)],
        "title string, body string, level string, url string, badge long, call boolean, autoCopy boolean, "
        "isArchive boolean")
    p = [json.loads(r[0]) for r in message_payload(df).select("payload").collect()]
    assert p[0] == {"title": "t", "body": "b", "level": "active", "badge": 0, "autoCopy": 1}
    assert p[1]["call"] == 1 and p[1]["isArchive"] == 1 and "autoCopy" not in p[1]
    v = R.validate(df.withColumn("icon", F.lit(None).cast("string")), R.message_rules())
    assert [r[0] for r in v.select(R.codes()).collect()] == ["", "level"]


def test_lax_int(spark):
    df = spark.createDataFrame([("5",), ("5.0",), ("5.5",), ("true",), ("x",)], "t string")
    assert [r[0] for r in df.select(lax_int("t")).collect()] == [5, 5, None, 1, None]


def test_ids_and_handles(spark):
    df = spark.createDataFrame([("UC_abc-123",), ("abc/../../key",), (" @EarnMoar ",), ("@a/b",), ("@@x",)], "v string")
    got = rows(df.select("v", R.resource_id("v").ok.alias("id"), R.handle("v").ok.alias("h")))
    assert (" @EarnMoar ", False, True) in got and ("UC_abc-123", True, True) in got
    assert ("abc/../../key", False, False) in got and ("@a/b", False, False) in got and ("@@x", False, False) in got


def test_read_contract_files_with_nested_unknown_fields(spark, tmp_path):
    from tapeworks.sources.contracts import read_contract
    docs = [{"job_id": "j1", "job_type": "download", "status": "failed",
             "error": {"code": "E1", "message": "m", "token": "x"}},
            {"job_id": "j2", "job_type": "download", "status": "queued", "extra": 1}]
    path = tmp_path / "jobs.jsonl"
    path.write_text("\n".join(json.dumps(d) for d in docs) + "\n{not json\n")
    j = read_contract(spark, str(path), CONTRACTS["localization_job"]).orderBy("job_id")
    got = [(r["job_id"], r["unknown_fields"], r["malformed"]) for r in j.collect()]
    assert got == [(None, [], True), ("j1", ["error.token"], False), ("j2", ["extra"], False)]
    err = j.filter("job_id = 'j1'").select("error.retryable", "error.details").collect()[0]
    assert err["retryable"] is False and err["details"] == "{}"  # defaults of nested parts too


def test_manifest_unknown_fields_inside_maps_and_identity(spark):
    from tapeworks.operators.manifest import parsed_manifest_rules
    stage = {"job_type": "download", "status": "succeeded", "job_id": "j", "idempotency_key": "k",
             "parameters_sha256": "a" * 64, "input_artifacts": ["source/video.mp4"], "completed_at": "2026-08-19T00:00:00Z"}
    doc = {"video_id": "abc", "source": {"video_id": "abc", "channel_id": "c", "title": "t",
                                         "published_at": "2026-08-19T00:00:00Z", "source_url": "https://x.test/v"},
           "artifacts": {"source/video.mp4": {"uri": GOOD_URI, "content_type": "video/mp4", "color": "red"}},
           "stages": {"download": {**stage, "note": 1}},
           "created_at": "2026-08-19T00:00:00Z", "updated_at": "2026-08-19T01:00:00Z"}
    bad_id = {**doc, "source": {**doc["source"], "video_id": "other"}, "stages": {"download": stage},
              "artifacts": {"source/video.mp4": {"uri": GOOD_URI, "content_type": "video/mp4"}}}
    missing = {**bad_id, "source": doc["source"], "artifacts": {}}
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate([doc, bad_id, missing])], "id int, raw string")
    p = parse_contract(df, "raw", CONTRACTS["video_manifest"])
    out = parsed_manifest_rules(p).orderBy("id").select(
        "unknown_fields", R.codes().alias("c"), "first_missing", "revision").collect()
    assert out[0]["unknown_fields"] == ["artifacts{}.color", "stages{}.note"] and out[0]["revision"] == 1
    assert out[1]["c"] == "manifest_identity"
    assert out[2]["c"] == "artifact_refs" and out[2]["first_missing"] == "source/video.mp4"


def test_unknown_fields_at_any_depth(spark):
    from pyspark.sql import types as T
    from tapeworks.sources.contracts import unknown_fields
    word = T.StructType([T.StructField("start_ms", T.LongType()), T.StructField("text", T.StringType())])
    seg = T.StructType([T.StructField("segment_id", T.StringType()), T.StructField("words", T.ArrayType(word))])
    doc = T.StructType([T.StructField("segments", T.ArrayType(seg)),
                        T.StructField("by_key", T.MapType(T.StringType(), seg))])
    raw = json.dumps({"segments": [{"segment_id": "s1", "words": [{"start_ms": 1, "text": "a", "conf": 0.9}]},
                                   {"segment_id": "s2", "x": 1}],
                      "by_key": {"k": {"segment_id": "s3", "words": [{"text": "b", "y": 2}]}}, "z": True})
    df = spark.createDataFrame([(raw,)], "raw string")
    got = df.select(unknown_fields("raw", doc)).collect()[0][0]
    assert got == ["by_key{}.words[].y", "segments[].words[].conf", "segments[].x", "z"]


def test_two_timestamp_grammars(spark):
    from tapeworks.functions.time import aware_timestamp, has_offset
    texts = ["2026-08-19T08:00:00+08:00", "2026-08-19T08:00:00+08", "2026-08-19T00:00:00z",
             "1787097600", "2026-08-19T00:00:00", "2026-08-19T00:00:00.5Z"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select(has_offset("t", "contract").alias("c"), has_offset("t", "window").alias("w"),
                    F.date_format(aware_timestamp("t", "contract"), "yyyy-MM-dd HH:mm:ss.SSS").alias("ct"),
                    F.date_format(aware_timestamp("t", "window"), "yyyy-MM-dd HH:mm:ss.SSS").alias("wt")).collect()
    assert [(r["c"], r["w"]) for r in out] == [(True, True), (False, True), (True, False), (True, False),
                                                (False, False), (True, True)]
    assert out[0]["ct"] == out[0]["wt"] == "2026-08-19 00:00:00.000"
    assert out[1]["ct"] is None and out[1]["wt"] == "2026-08-19 00:00:00.000"
    assert out[2]["ct"] == "2026-08-19 00:00:00.000" and out[3]["ct"] == "2026-08-19 00:00:00.000"
    assert out[4]["ct"] is None and out[5]["wt"] == "2026-08-19 00:00:00.500"


def test_nested_render_defaults(spark):
    from tapeworks.sources.contracts import RENDER_DEFAULTS, fill_struct_defaults
    df = spark.createDataFrame([(None,), ((None, True, "libx264"),)],
                               "settings struct<audio_strategy:string, burn_subtitles:boolean, video_codec:string>")
    out = [r["settings"].asDict() for r in fill_struct_defaults(df, "settings", RENDER_DEFAULTS).collect()]
    assert out[0] == RENDER_DEFAULTS
    assert out[1]["audio_strategy"] == "subtitle_only" and out[1]["burn_subtitles"] is True and out[1]["crf"] == 22


def test_read_contract_whole_files(spark, tmp_path):
    from tapeworks.sources.contracts import read_contract
    for i, doc in enumerate([ARTIFACT, {**ARTIFACT, "extra": 1}]):
        (tmp_path / f"a{i}.json").write_text(json.dumps(doc, indent=2))   # pretty-printed: one document per file
    a = read_contract(spark, str(tmp_path), CONTRACTS["artifact"], whole_files=True).orderBy("path").collect()
    assert [r["uri"] for r in a] == [GOOD_URI, GOOD_URI]
    assert [r["unknown_fields"] for r in a] == [[], ["extra"]]
    assert a[0]["path"].endswith("a0.json")


def test_every_contract_reads_a_minimal_document(spark):
    """Each contract of the data model: a document with its required fields
    parses with no unknown field, and an extra key is caught."""
    from pyspark.sql import types as T
    art = {"uri": GOOD_URI, "content_type": "video/mp4"}

    def sample(dtype):
        if isinstance(dtype, T.StructType):
            if [f.name for f in dtype.fields][:3] == ["schema_version", "uri", "content_type"]:
                return dict(art)
            return {f.name: sample(f.dataType) for f in dtype.fields}
        if isinstance(dtype, T.ArrayType):
            return [sample(dtype.elementType)]
        if isinstance(dtype, T.MapType):
            return {"k": sample(dtype.valueType)}
        return {"StringType": "x", "LongType": 1, "BooleanType": True, "DoubleType": 0.5}[type(dtype).__name__]

    for name, contract in CONTRACTS.items():
        doc = {k: v for k, v in sample(contract.schema).items() if k not in contract.json_fields}
        df = spark.createDataFrame([(json.dumps(doc),), (json.dumps({**doc, "zz_extra": 1}),)], "raw string")
        got = [r["unknown_fields"] for r in parse_contract(df, "raw", contract).collect()]
        assert got == [[], ["zz_extra"]], name


def test_http_url_normal_form(spark):
    from tapeworks.functions.uri import normalize_http_url
    urls = ["https://Example.COM", "HTTP://a.test:80/x?y", "https://a.test:443?q=1", "https://a.test:8443/p",
            " https://a.test/p ", "not a url"]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(normalize_http_url("u")).collect()] == [
        "https://example.com/", "http://a.test/x?y", "https://a.test/?q=1", "https://a.test:8443/p",
        "https://a.test/p", "not a url"]


def test_content_types_and_uri_split(spark):
    from tapeworks.functions.uri import content_type, split_s3_uri
    cases = [("image.jpg", "image/jpeg"), ("photo.png", "image/png"), ("document.pdf", "application/pdf"),
             ("spreadsheet.xlsx", "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet"),
             ("data.csv", "text/csv"), ("config.json", "application/json"),
             ("file.unknown", "application/octet-stream"), ("VIDEO.MP4", "video/mp4"),
             ("a.tar.gz", "application/x-tar"), ("a.tgz", "application/x-tar"), ("a.gz", "application/octet-stream"),
             (".bashrc", "application/octet-stream"), ("https://x.test/p/final.mp4?sig=1#t", "video/mp4"),
             ("https://x.test/en/825/", "application/octet-stream")]
    df = spark.createDataFrame(cases, "path string, expected string")
    assert [(r[0], r[1]) for r in df.select("expected", content_type("path")).collect()] == \
        [(e, e) for _, e in cases]
    u = spark.createDataFrame([(GOOD_URI,), ("s3://bucket",)], "u string").select(split_s3_uri("u").alias("s")).collect()
    assert (u[0]["s"]["bucket"], u[0]["s"]["key"]) == ("shelf-7", "films/q9/cut.mkv")
    assert u[1]["s"] is None


def test_reader_gives_values_and_codes_from_one_parse(spark):
    ok = {"uri": GOOD_URI, "content_type": "v/x"}
    cases = [({**ok, "size": "5"}, 5, ""), ({**ok, "size": 5.0}, 5, ""), ({**ok, "size": True}, 1, ""), ({**ok, "size": 5.5}, None, "size:int_type"),
             ({**ok, "size": "abc"}, None, "size:int_type"), ({**ok, "size": 1e30}, None, "size:int_type"),
             ({**ok, "schema_version": " 1.0 "}, None, "schema_version:enum"), ({**ok, "schema_version": 1.0}, None, "schema_version:string_type"),
             ({**ok, "schema_version": None}, None, "schema_version:null"), ({**ok, "etag": 5, "size": -1}, -1, "size:too_small,etag:string_type"),
             ("not json", None, "json"), ({"content_type": "v/x", "b": 1, "a": 2}, None, "uri:missing,a:unknown,b:unknown")]
    df = spark.createDataFrame([(i, d if isinstance(d, str) else json.dumps(d)) for i, (d, *_) in enumerate(cases)], "id int, raw string")
    a = parse_contract(df, "raw", CONTRACTS["artifact"])
    got = a.orderBy("id").select("size", F.array_join("codes", ",").alias("c"), "version_ok", "malformed").collect()
    assert [(r["size"], r["c"]) for r in got] == [(v, c) for _, v, c in cases]
    assert [r["version_ok"] for r in got] == [i not in (6, 7, 8, 10) for i in range(len(cases))] and got[10]["malformed"]
    valid, bad = R.split_by_codes(a)
    assert sorted(r["id"] for r in valid.collect()) == [0, 1, 2] and bad.count() == len(cases) - 3
    assert a._jdf.queryExecution().executedPlan().toString().count("try_parse_json") <= 1


def test_reader_fills_nested_defaults_and_refuses_nested_types(spark):
    art = {"uri": GOOD_URI, "content_type": "v/x"}
    docs = [{"source_video": art, "output_uri": GOOD_URI, "settings": {"crf": "18", "burn_subtitles": "no", "preset": " slow "}},
            {"source_video": {**art, "size": 2.5}, "output_uri": GOOD_URI, "settings": {"crf": [1]}}]
    df = spark.createDataFrame([(i, json.dumps(d)) for i, d in enumerate(docs)], "id int, raw string")
    one, two = parse_contract(df, "raw", CONTRACTS["render_request"]).orderBy("id").collect()
    assert one["settings"].asDict() == {"audio_strategy": "subtitle_only", "burn_subtitles": False, "video_codec": "copy", "preset": "slow", "crf": 18,
                                        "audio_codec": "aac", "audio_bitrate": "192k", "pixel_format": "yuv420p", "faststart": True}
    assert one["codes"] == [] and one["source_video"]["schema_version"] == "1.0"
    assert two["codes"] == ["source_video.size:int_type", "settings.crf:int_type"] and two["settings"]["crf"] is None


def test_parts_and_messages_are_read_too(spark):
    df = spark.createDataFrame([('{"title": " t ", "body": "b", "badge": "2"}',), ('{"title": "t", "body": "b", "level": "urgent"}',)], "raw string")
    a, b = parse_contract(df, "raw", CONTRACTS["message"]).collect()
    assert (a["title"], a["badge"], a["level"], a["call"], a["codes"]) == ("t", 2, "active", False, [])
    assert b["codes"] == ["level:enum"]
