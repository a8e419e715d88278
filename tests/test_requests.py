"""Job request operators."""

import pytest
from pyspark.sql import functions as F

from tapeworks.operators import jobs as J


def test_stage_requests_carry_their_type(spark):
    df = spark.createDataFrame([("s3://b/in", "s3://b/out/")], "input_uri string, output_prefix string")
    assert [r["job_type"] for r in J.stage_requests(df, ("transcribe", "download")).collect()] == ["transcribe", "download"]
    with pytest.raises(ValueError):
        J.stage_requests(df, ("media_quality_check",))   # the quality check has no request operator


def test_idempotency_keys(spark):
    df = spark.createDataFrame([("localize", "run-1", "download", 3)], "d string, r string, t string, m int")
    assert df.select(J.default_idempotency_key("d", "r", "t", "m")).collect()[0][0] == "localize:run-1:download:3"


def test_stage_keys_have_six_shapes(spark):
    names = sorted({p for shape in J.STAGE_KEYS.values() for p in shape if p[0] != "'"})
    df = spark.createDataFrame([(s,) for s in [*J.STAGE_KEYS, "separate_audio"]], "stage string")
    parts = {n: F.lit(f"<{n}>") for n in names}
    got = {r[0]: r[1] for r in df.select("stage", J.stage_idempotency_key("stage", parts)).collect()}
    assert got["download"] == "youtube:<video_id>:<format_profile_version>"
    assert got["publish"] == "bilibili:<source_video_id>:<render_sha256>:<account_id>"
    assert got["render_video"] == "<source_sha256>:<timeline_sha256>:<audio_sha256>:<profile_version>"
    assert got["separate_audio"] is None and len({v for v in got.values() if v}) == 6
    missing = {**parts, "video_id": F.lit(None).cast("string")}
    assert df.filter("stage = 'download'").select(J.stage_idempotency_key("stage", missing)).collect()[0][0] is None


def test_poll_and_error_classes(spark):
    df = spark.createDataFrame([(200,), (404,), (429,), (500,), (451,), (401,)], "s int")
    got = [(r[0], r[1], r[2]) for r in df.select("s", J.poll_class("s"), J.http_error_class("s")).collect()]
    assert got == [(200, "parse", None), (404, "fail", "input"), (429, "fail", "transient"),
                   (500, "retry", "transient"), (451, "fail", "policy"), (401, "fail", "authentication")]
    pol = {r["error_class"]: r["policy"] for r in J.retry_policy(
        df.select(J.http_error_class("s").alias("error_class")).dropna(), spark).collect()}
    assert pol == {"input": "not_retryable", "transient": "retry_with_backoff", "policy": "block_downstream",
                   "authentication": "stop_and_notify"}


def test_job_timeouts(spark):
    jobs = spark.createDataFrame([("j1", "queued", "2024-01-30 20:00:00", 1), ("j1", "running", "2024-01-30 23:00:00", 2),
                                  ("j2", "queued", "2024-01-30 23:30:00", 3), ("j3", "queued", "2024-01-30 10:00:00", 4),
                                  ("j3", "succeeded", "2024-01-30 11:00:00", 5)],
                                 "job_id string, status string, t string, event_id int").withColumn(
        "updated_ts", F.to_timestamp("t"))
    out = [(r["job_id"], r["status"], r["age_s"]) for r in J.job_timeouts(jobs, "2024-01-31 00:00:00").collect()]
    assert out == [("j1", "running", 14400)]


def test_stage_requests_one_pass(spark):
    df = spark.createDataFrame([("s3://b/in",)], "input_uri string")
    assert sorted(r["job_type"] for r in J.stage_requests(df, ("download", "transcribe")).collect()) == [
        "download", "transcribe"]
    with pytest.raises(ValueError):
        J.stage_requests(df, ("download", "media_quality_check"))
