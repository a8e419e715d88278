"""Whole-document validation on literal documents."""

import json

import pytest

from tapeworks.operators.contract_check import DOCUMENTS, document_codes
from tapeworks.operators import jobs as J
from tapeworks.plans.q_documents import DOCUMENTS as TEMPLATES
from tapeworks.sources.contracts import CONTRACTS, parse_contract

ART = {"uri": "s3://shelf/k", "content_type": "audio/flac"}


def codes(spark, name, docs):
    raw = [(k, d if d is None or isinstance(d, str) else json.dumps(d)) for k, d in enumerate(docs)]
    df = spark.createDataFrame(raw, "k int, raw string").select("k", document_codes("raw", name).alias("c"))
    return [r["c"] for r in df.orderBy("k").collect()]


def test_integers_read_lax_and_refused(spark):
    sizes = [5, "5", 5.0, " 7 ", True, None, 5.5, "abc", "5.5", [5], {"n": 5}, -1]
    got = codes(spark, "artifact", [{**ART, "size": s} for s in sizes])
    assert got == [[]] * 6 + [["size:int_type"]] * 5 + [["size:too_small"]]


def test_versions_texts_and_unknown_fields(spark):
    docs = [{**ART, "schema_version": v} for v in ("1.0", " 1.0 ", "2.0", None, 1.0)]
    got = codes(spark, "artifact", docs + [{**ART, "uri": 5, "owner": 1}, {**ART, "etag": None}, "[]", "{", "null", None])
    assert got[:5] == [[], ["schema_version:enum"], ["schema_version:enum"], ["schema_version:null"], ["schema_version:string_type"]]
    assert got[5:] == [["uri:string_type", "owner:unknown"], [], ["object_type"], ["json"], ["object_type"], ["json"]]


def test_status_rows_that_must_be_refused(spark):
    base = {"job_id": "j", "job_type": "download", "status": "running", "updated_at": "2025-03-03T00:00:00Z"}
    changes = [{}, {"status": " running"}, {"job_type": " download"}, {"schema_version": "2.0"}, {"error": {"message": "m"}},
               {"error": {"code": "c", "message": "m", "schema_version": "9"}}, {"created_at": "2025-03-03T00:00:00"},
               {"output": [1]}, {"output": {"n": 1}}, {"id": "j"}, {"status": "failed"}, {"updated_at": None}]
    docs = [{**base, **c, "job_id": f"j{k}"} for k, c in enumerate(changes)]
    df = spark.createDataFrame([(json.dumps(d),) for d in docs], "raw string")
    valid = J.job_from_log(parse_contract(df, "raw", CONTRACTS["localization_job"]))
    assert sorted(r["job_id"] for r in valid.collect()) == ["j0", "j8"]


def test_nested_documents(spark):
    words = [{"start_ms": 0, "end_ms": 5, "text": "a"}, {"start_ms": 4, "end_ms": 9, "text": "b"}]
    seg = {"segment_id": "s", "start_ms": 0, "end_ms": 10, "text": "a b", "words": words}
    doc = {"source_audio": ART, "language": "en", "duration_ms": 100, "provider": "p", "model": "m", "segments": [seg]}
    swapped = {**seg, "words": words[::-1]}
    other = {**seg, "segment_id": "t", "start_ms": 3, "words": []}
    got = codes(spark, "transcript", [doc, {**doc, "segments": []}, {**doc, "segments": [swapped]}, {**doc, "segments": [seg, seg]},
                                      {**doc, "segments": [other, {**seg, "words": []}]}, {**doc, "duration_ms": 9},
                                      {**doc, "segments": None}, {**doc, "segments": [None]}, {**doc, "source_audio": {"uri": "x"}}])
    assert got == [[], [], ["segments.[]:word_order"], ["segment_id_repeated"], ["segment_order"], ["segment_beyond_duration"],
                   ["segments:null"], ["segments.[]:null"], ["source_audio.uri:s3_uri", "source_audio.content_type:missing"]]


def test_manifest_probes(spark):
    video = {"video_id": "v", "channel_id": "c", "title": "t", "published_at": "2025-03-03T00:00:00Z", "source_url": "https://e.example/"}
    doc = {"video_id": "v", "source": video, "created_at": "2025-03-03T00:00:00Z", "updated_at": "2025-03-03T00:00:00+00:00"}
    stage = {"job_type": "download", "status": "failed", "job_id": "j", "idempotency_key": "k", "parameters_sha256": "0f" * 32,
             "completed_at": "2025-03-03T00:00:00Z"}
    got = codes(spark, "video_manifest", [
        doc, {**doc, "revision": 0, "artifacts": {"BAD KEY": {"uri": "https://nope", "content_type": ""}}},
        {**doc, "stages": {"download": stage}}, {**doc, "schema_version": "2.0"}, {**doc, "created_at": "2025-03-03T00:00:00"}])
    assert got == [[], ["revision:too_small", "artifacts:key", "artifacts.{}.uri:s3_uri", "artifacts.{}.content_type:too_short"],
                   ["stages.{}:failed_without_error"], ["schema_version:enum"], ["created_at:aware_timestamp"]]


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_every_contract_has_a_query_and_its_faults_apply(name):
    template, faults = TEMPLATES[name]
    assert name in DOCUMENTS and all(old in template for old, *_ in faults)
