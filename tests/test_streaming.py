"""Streaming state survives a restart: it lives in storage, not in the driver."""

import json

from pyspark.sql import functions as F

from tapeworks.session import scratch_path
from tapeworks.streaming import streams as S


def test_latest_state_resumes_from_storage(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    schema = "job_id string, status string, seq long"

    def drop(name, rows):
        (src / name).write_text("\n".join(json.dumps(dict(zip(["job_id", "status", "seq"], r))) for r in rows))

    def stream():
        return spark.readStream.schema(schema).json(str(src))

    base = scratch_path(spark, "resume")
    drop("a.json", [("j1", "queued", 1), ("j2", "queued", 2)])
    first = S.latest_state(spark, stream(), "job_id", ["seq"], base=base)
    assert sorted(map(tuple, first.select("job_id", "status").collect())) == [("j1", "queued"), ("j2", "queued")]
    # a restart on the same folder (a new driver): earlier state comes from storage
    drop("b.json", [("j1", "succeeded", 3)])
    second = S.latest_state(spark, stream(), "job_id", ["seq"], base=base)
    assert sorted(map(tuple, second.select("job_id", "status").collect())) == [("j1", "succeeded"), ("j2", "queued")]
    # and with nothing new, the same answer again
    third = S.latest_state(spark, stream(), "job_id", ["seq"], base=base)
    assert sorted(map(tuple, third.select("job_id", "status").collect())) == [("j1", "succeeded"), ("j2", "queued")]
    assert third.filter(F.col("seq") == 3).count() == 1


def test_late_and_repeated_rows_all_count(spark, tmp_path):
    """Four files newest first, one per trigger, then a repeat of the first."""
    rows = [(f"k{i % 7}", f"2024-01-{1 + i % 20:02d} 10:00:00", i) for i in range(200)]
    newest = sorted(rows, key=lambda r: r[1], reverse=True)
    schema = "key string, t string, n long"
    for k in range(4):
        spark.createDataFrame(newest[50 * k:50 * k + 50], schema).coalesce(1).write.parquet(f"{tmp_path}/f{k}")
    spark.createDataFrame(newest[:50], schema).coalesce(1).write.parquet(f"{tmp_path}/f9")

    def stream():
        s = S.files_stream(spark, str(tmp_path), spark.createDataFrame([], schema).schema, max_files=1)
        return s.withColumn("ts", F.to_timestamp("t"))

    first = {r["key"]: r["n"] for r in S.first_per_key(spark, stream(), "key", ["ts", "n"], compact_every=2).collect()}
    assert first == {k: min((t, n) for q, t, n in rows if q == k)[1] for k in {r[0] for r in rows}}
    counts = S.daily_counts(spark, stream(), "key", "ts", compact_every=2)
    assert sum(r["uploads"] for r in counts.collect()) == 250
    assert counts.count() == len({(k, t) for k, t, _ in rows})
    assert S.latest_state(spark, stream().filter("n < 0"), "key", ["n"]).count() == 0
