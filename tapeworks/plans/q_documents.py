"""Whole contract documents, validated strictly (``contract_<name>`` keys).

Every row of ``part`` becomes one JSON document of each contract: valid, or
with one fault, chosen by the row's key.  A fault is a replacement in the text
(a number for a text, a missing field, a broken rule across fields).  The
oracle says which codes each fault must give.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.operators.contract_check import with_codes
from tapeworks.plans.catalog import register
from tapeworks.sources.tables import spread, table

SHA = "ab" * 32
ART = '{"uri": "s3://media/<id>/a.bin", "content_type": "video/mp4", "size": <size>}'
VIDEO = ('{"video_id": "v<id>", "channel_id": "c1", "title": "Title <id>", "published_at": "2024-01-05T10:00:00Z", '
         '"source_url": "https://example.com/v/<id>", "duration_ms": <size>}')
STAGE = ('{"job_type": "download", "status": "succeeded", "job_id": "j<id>", "idempotency_key": "k<id>", '
         f'"parameters_sha256": "{SHA}", "output_artifacts": ["video/raw"], '
         '"started_at": "2024-01-05T10:00:00Z", "completed_at": "2024-01-05T11:00:00+00:00"}')
WORDS = '[{"start_ms": 0, "end_ms": 400, "text": "one"}, {"start_ms": 400, "end_ms": 900, "text": "two", "probability": 0.5}]'

# Contract -> (document, faults): a fault is (text, replacement, codes it gives).
DOCUMENTS: dict[str, tuple[str, list[tuple[str, str, str]]]] = {
    "artifact": (ART, [
        ('"size": <size>', '"size": "<size>"', ""), ('"size": <size>', '"size": <size>.0', ""),
        ('"size": <size>', '"size": <size>.5', "size:int_type"), ('"size": <size>', '"size": "many"', "size:int_type"),
        ('"size": <size>', '"size": -1', "size:too_small"), ('"video/mp4"', '"  "', "content_type:too_short"),
        ('s3://', 'https://', "uri:s3_uri"), ('"content_type"', '"type"', "content_type:missing,type:unknown"),
        ('{"uri"', '{"schema_version": "2.0", "uri"', "schema_version:enum"),
        ('{"uri"', f'{{"sha256": "{SHA.upper()}", "uri"', "sha256:pattern"), ("}", "", "json")]),
    "youtube_video": (VIDEO, [
        ('"Title <id>"', "<id>", "title:string_type"), ("10:00:00Z", "10:00:00", "published_at:aware_timestamp"),
        ("https://", "ftp://", "source_url:http_url"), ('"duration_ms": <size>', '"duration_ms": null', ""),
        ('"channel_id": "c1", ', "", "channel_id:missing"), ('"channel_id": "c1"', '"channel_id": null', "channel_id:null")]),
    "youtube_channel": ('{"channel_id": "c<id>", "title": "Channel <id>", "uploads_playlist_id": "u<id>"}', [
        ('"Channel <id>"', '" "', "title:too_short"), ('"u<id>"', "[]", "uploads_playlist_id:string_type"),
        ('{"channel_id"', '{"published_at": "soon", "channel_id"', "published_at:aware_timestamp")]),
    "localization_job": ('{"id": "j<id>", "type": "download", "status": "running", "output": {"n": <id>}, "error": null}', [
        ('"running"', '" running"', "status:enum"), ('"download"', '" download"', "job_type:enum"),
        ('{"n": <id>}', "[<id>]", "output:object_type"), ('"running"', '"failed"', "failed_without_error"),
        ('"error": null', '"error": {"message": "m"}', "error.code:missing"),
        ('"error": null', '"error": {"code": "c", "message": "m", "schema_version": "9"}', "error.schema_version:enum"),
        ('"error": null', '"created_at": "2024-01-01T00:00:00"', "created_at:aware_timestamp"),
        ('"id"', '"job_id"', ""), ('"error": null', '"note": 1', "note:unknown")]),
    "job_request": ('{"job_type": "transcribe", "input_uri": "s3://a/<id>", "output_prefix": "s3://out/<id>"}', [
        ('"transcribe"', '"sing"', "job_type:enum"), ("s3://out/<id>", "s3://out", "output_prefix:s3_uri"),
        ('{"job_type"', '{"parameters": "x", "job_type"', "parameters:object_type")]),
    "stage_record": (STAGE, [
        ("T11:", "T09:", "completed_before_started"), ('"succeeded"', '"failed"', "failed_without_error"),
        (', "completed_at": "2024-01-05T11:00:00+00:00"', "", "terminal_without_completion"),
        ('"video/raw"', '"Bad Key"', "output_artifacts.[]:pattern"),
        (', "output_artifacts"', ', "error": {"code": "c", "message": "m"}, "output_artifacts"', "succeeded_with_error")]),
    "render_request": (f'{{"source_video": {ART}, "output_uri": "s3://out/<id>.mp4", "settings": {{"crf": 20}}}}', [
        ('"crf": 20', '"crf": 52', "settings.crf:too_large"),
        ('"crf": 20', '"burn_subtitles": true', "settings:burn_needs_encoding"),
        ('"crf": 20', '"burn_subtitles": true, "video_codec": "libx264"', "burn_needs_subtitles"),
        ('"crf": 20', '"audio_strategy": "silent_bed"', "strategy_needs_dub"),
        ('"crf": 20}', f'"audio_strategy": "voice_replace"}}, "dubbed_audio": {ART}', "replace_needs_accompaniment"),
        ('"video/mp4"', '""', "source_video.content_type:too_short")]),
    "render_result": (f'{{"video": {ART}, "duration_ms": 1000, "width": 640, "height": 480, "video_codec": "h264", '
                      '"audio_codec": "aac", "subtitle_burned": false}', [
        ('"width": 640', '"width": 0', "width:too_small"), ('"aac"', "null", "audio_codec:null"),
        ("false", '"maybe"', "subtitle_burned:bool_type")]),
    "quality_report": (f'{{"video": {ART}, "passed": true, "checks": [{{"name": "probe", "passed": true}}], "duration_delta_ms": 3}}', [
        ('"name": "probe"', '"name": ""', "checks.[].name:too_short"), ('"duration_delta_ms": 3', '"duration_delta_ms": -3', "duration_delta_ms:too_small"),
        ('[{"name": "probe", "passed": true}]', "{}", "checks:list_type")]),
    "source_separation": (f'{{"source_audio": {ART}, "provider": "p", "model": "m", "vocals": {ART}, "accompaniment": {ART}}}', [
        ('"provider": "p"', '"provider": 5', "provider:string_type"), (', "accompaniment"', ', "rest"', "accompaniment:missing,rest:unknown")]),
    "publish_result": ('{"aid": <size>, "bvid": "BV<id>", "url": "https://example.com/<id>", "published_at": "2024-02-01T00:00:00+08:00", "title": "T"}', [
        ('"aid": <size>', '"aid": 0', "aid:too_small"), ("+08:00", "", "published_at:aware_timestamp"), ('"BV<id>"', '""', "bvid:too_short")]),
    "video_manifest": (f'{{"video_id": "v<id>", "source": {VIDEO}, "artifacts": {{"video/raw": {ART}}}, "stages": {{"download": {STAGE}}}, '
                       '"created_at": "2024-01-05T10:00:00Z", "updated_at": "2024-01-06T10:00:00Z"}', [
        ('{"video_id": "v<id>", "source"', '{"video_id": "w<id>", "source"', "identity"), ("2024-01-06T", "2024-01-04T", "updated_before_created"),
        ('"stages": {"download"', '"stages": {"transcribe"', "stage_key"), ('{"video/raw"', '{"video/cut"', "missing_artifacts"),
        ('{"video/raw"', '{"BAD KEY"', "artifacts:key"), ('"source"', '"revision": 0, "source"', "revision:too_small"),
        ("s3://", "https://", "artifacts.{}.uri:s3_uri"), ('"job_id": "j<id>", ', "", "stages.{}.job_id:missing")]),
    "transcript": (f'{{"source_audio": {ART}, "language": "en", "duration_ms": 5000, "provider": "p", "model": "m", "segments": ['
                   f'{{"segment_id": "s1", "start_ms": 0, "end_ms": 1000, "text": "one two", "words": {WORDS}}}, '
                   '{"segment_id": "s2", "start_ms": 1000, "end_ms": 2000, "text": "three"}]}', [
        ('"s2"', '"s1"', "segment_id_repeated"), ('"duration_ms": 5000', '"duration_ms": 1500', "segment_beyond_duration"),
        ('"start_ms": 0, "end_ms": 1000, "text"', '"start_ms": 3000, "end_ms": 4000, "text"', "segments.[]:word_outside"),
        ('"probability": 0.5', '"probability": 1.5', "segments.[].words.[].probability:too_large"),
        ('"start_ms": 400, "end_ms": 900', '"start_ms": 900, "end_ms": 900', "segments.[].words.[]:interval"),
        ('"words": [{"start_ms": 0', '"words": [{"start_ms": 500, "end_ms": 600, "text": "zero"}, {"start_ms": 0', "segments.[]:word_order"),
        ('"language": "en"', '"language": "e"', "language:too_short")]),
    "translated_timeline": (f'{{"source_transcript": {ART}, "source_language": "en", "target_language": "de", "provider": "p", "model": "m", "segments": ['
                            '{"segment_id": "a", "source_start_ms": 0, "source_end_ms": 10, "source_text": "x", "translated_text": "y"}, '
                            '{"segment_id": "b", "source_start_ms": 10, "source_end_ms": 20, "source_text": "x", "translated_text": "y"}]}', [
        ('"source_start_ms": 0, "source_end_ms": 10', '"source_start_ms": 15, "source_end_ms": 16', "segment_order"), ('"b"', '"a"', "segment_id_repeated"),
        ('"source_end_ms": 20', '"source_end_ms": 5', "segments.[]:interval"),
        ('"segment_id": "b"', '"segment_id": "b", "translation_version": 0', "segments.[].translation_version:too_small")]),
    "synthesis_result": (f'{{"source_timeline": {ART}, "language": "de", "provider": "p", "model": "m", "voice": "v", "segments": ['
                         f'{{"segment_id": "a", "target_start_ms": 0, "target_end_ms": 10, "text": "y", "voice": "v", "audio": {ART}, "actual_duration_ms": 9}}], '
                         f'"dubbed_audio": {ART}}}', [
        ('"actual_duration_ms": 9', '"actual_duration_ms": 0', "segments.[].actual_duration_ms:too_small"),
        ('"target_end_ms": 10', '"target_end_ms": 0', "segments.[].target_end_ms:too_small"), ('"language": "de"', '"language": ["de"]', "language:string_type")]),
}


def documents(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """(p_partkey, raw): one JSON document of the contract per part."""
    template, faults = DOCUMENTS[name]
    p = spread(table(spark, sf, "part").select("p_partkey", "p_size"))  # a row of the table is small, its check is not
    which = F.col("p_partkey") % (len(faults) + 2)  # two residues stay valid
    text = F.lit(template)
    for k, (old, new, _) in enumerate(faults, 1):
        text = F.when(which == k, F.lit(template.replace(old, new, 1))).otherwise(text)
    text = F.replace(text, F.lit("<id>"), F.col("p_partkey").cast("string"))
    return p.select("p_partkey", F.replace(text, F.lit("<size>"), F.col("p_size").cast("string")).alias("raw"))


def _sql(name: str) -> str:
    faults = DOCUMENTS[name][1]
    cases = " ".join(f"WHEN {k} THEN '{codes}'" for k, (*_, codes) in enumerate(faults, 1))
    return f"SELECT p_partkey, CASE p_partkey % {len(faults) + 2} {cases} ELSE '' END AS codes FROM part"


def _query(name: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return with_codes(documents(spark, sf, name), "raw", name).select("p_partkey", F.array_join("codes", ",").alias("codes"))
    run.__name__ = f"contract_{name}"
    run.__doc__ = f"A1/S1–S7: {name} documents validated whole; the codes of all that is wrong with each."
    return run


for _name in DOCUMENTS:
    register(f"contract_{_name}", _sql(_name))(_query(_name))
