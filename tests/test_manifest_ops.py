"""Manifest-side operators on small literal cases."""

from pyspark.sql import functions as F

from conftest import rows
from tapeworks.operators import manifest as M


def test_layout_paths(spark):
    df = spark.createDataFrame([("q9", "synthesize_speech"), ("q9", "media_quality_check"), ("w1", "manifest")],
                               "video_id string, stage string")
    got = rows(M.layout_paths(df, "video_id", "stage", "fr", root="s3://shelf"), "stage", "artifact", "path")
    assert got == [("manifest", "manifest", "s3://shelf/w1/manifest.json"),
                   ("synthesize_speech", "dubbed", "s3://shelf/q9/tts/dubbed.fr.wav"),
                   ("synthesize_speech", "segments", "s3://shelf/q9/tts/segments/")]
    every = M.layout_paths(spark.createDataFrame([("v", s) for s in {x[0] for x in M.LAYOUT}], "v string, s string"), "v", "s", "fr")
    assert every.count() == len(M.LAYOUT) and every.filter("path like '%{%'").count() == 0


def test_quality_report_folds_checks(spark):
    checks = spark.createDataFrame([(1, "loudness", True), (1, "duration", False), (2, "loudness", True)],
                                   "doc_id int, name string, passed boolean")
    assert rows(M.quality_report(checks)) == [(1, False, 1, "duration=false,loudness=true"),
                                              (2, True, 0, "loudness=true")]


def test_cleanup_and_missing_references(spark):
    art = spark.createDataFrame([("k1",), ("k2",), ("k3",)], "key string")
    refs = spark.createDataFrame([("k1", "2020-01-01 00:00:00", "j1"), ("k2", "2024-06-01 00:00:00", "j2"),
                                  ("k9", "2024-06-01 00:00:00", "j2")], "key string, t string, job_id string") \
        .withColumn("ref_at", F.to_timestamp("t"))
    published = refs.filter("job_id = 'j9'")
    assert rows(M.cleanup_candidates(art, refs, published, "2024-01-01 00:00:00"), "key") == [("k1",), ("k3",)]
    assert rows(M.missing_artifacts(refs, art), "key") == [("k9",)]


def test_revisions_number_and_flag_latest(spark):
    hist = spark.createDataFrame([("v1", "j2", "2024-01-02 00:00:00"), ("v1", "j1", "2024-01-01 00:00:00"),
                                  ("v2", "j3", "2024-01-01 00:00:00")], "video_id string, job_id string, t string") \
        .withColumn("updated_at", F.to_timestamp("t"))
    assert rows(M.revisions(hist), "job_id", "revision", "is_latest") == [("j1", 1, False), ("j2", 2, True),
                                                                          ("j3", 1, True)]
