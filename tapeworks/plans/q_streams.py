"""Streaming and sink queries (§2.11 R1/R2/R5, §2.1 A6/A7).

Each key runs a real stream (file source over the driver folder,
``availableNow``) or a real write, then reads the result back; the oracle is
the batch SQL the stream must agree with.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.time import ts_text
from tapeworks.operators import jobs as J
from tapeworks.plans import bindings as B
from tapeworks.plans.catalog import register
from tapeworks.plans.q_contracts import _JOB_SQL
from tapeworks.plans.q_discovery import AFTER, AFTER_SQL, BEFORE, BEFORE_SQL
from tapeworks.plans.q_jobs import _VALID_JOBS
from tapeworks.session import scratch_path
from tapeworks.sources import sinks
from tapeworks.sources.contracts import CONTRACTS, parse_contract
from tapeworks.sources.tables import table
from tapeworks.streaming import streams as S


def _ts_sql(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


FILE_ROWS = 250_000  # ours: rows a delivered file holds at most, about


def _delivered(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table as a stream of out-of-order deliveries: four that each hold rows of
    all times, then a third of the rows once more.  A delivery is a micro-batch of
    as many files as there are cores, more for many rows, so all cores share it."""
    rows = table(spark, sf, name)
    files = max(spark.sparkContext.defaultParallelism, math.ceil(rows.count() / (4 * FILE_ROWS)))
    path = scratch_path(spark, f"in-{name}")
    rows.repartition(4 * files).write.parquet(f"{path}/first")
    rows.filter(F.col(rows.columns[0]) % 3 == 0).repartition(files).write.parquet(f"{path}/again")
    return S.files_stream(spark, path, rows.schema, max_files=files)


@register("stream_uploads", f"""
SELECT 'v' || event_id AS video_id, 'UC' || user_id AS channel_id, {_ts_sql('ts')} AS published_at
FROM events WHERE ts >= TIMESTAMP '{AFTER_SQL}' AND ts < TIMESTAMP '{BEFORE_SQL}'""")
def stream_uploads(spark: SparkSession, sf: str) -> DataFrame:
    """Uploads in the window from out-of-order deliveries with repeats in
    other batches; each video comes out once."""
    pubs = B.publications_of(_delivered(spark, sf, "events")).select("video_id", "channel_id", "published_at")
    out = S.uploads(spark, pubs, AFTER, BEFORE)
    return out.select("video_id", "channel_id", ts_text("published_at").alias("published_at"))


@register("stream_job_state", B.with_sql(["job_log"], f"""WITH {_JOB_SQL},
{_VALID_JOBS}
SELECT job_id, status, {_ts_sql('updated_ts')} AS updated_at FROM lj"""))
def stream_job_state(spark: SparkSession, sf: str) -> DataFrame:
    """R2: latest job state folded across micro-batches of the status log."""
    raw = B.job_log_of(_delivered(spark, sf, "events"))
    valid = J.job_from_log(parse_contract(raw, "raw", CONTRACTS["localization_job"]))
    rows = valid.select("job_id", "status", "updated_ts", "event_id")
    latest = S.latest_state(spark, rows, "job_id", ["updated_ts", "event_id"], compact_every=2)
    return latest.select("job_id", "status", ts_text("updated_ts").alias("updated_at"))


@register("daily_uploads", """
SELECT 'UC' || user_id AS channel_id, strftime(date_trunc('day', ts), '%Y-%m-%d') AS day,
       count(*) + count(*) FILTER (WHERE event_id % 3 = 0) AS uploads
FROM events GROUP BY 1, 2""")
def daily_uploads(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries per channel per UTC day in tumbling windows, late and
    repeated deliveries counted."""
    counts = S.daily_counts(spark, B.publications_of(_delivered(spark, sf, "events")))
    return counts.select("channel_id", F.date_format("day", "yyyy-MM-dd").alias("day"), "uploads")


@register("write_replace", B.with_sql(["stage_records"], f"""
SELECT video_id, job_type, job_id, CASE WHEN job_type = 'download' AND right(job_id, 1) = '7' THEN 'rechecked' ELSE status END AS status,
       {_ts_sql('updated_at')} AS updated_at FROM (
  SELECT *, row_number() OVER (PARTITION BY video_id, job_type ORDER BY updated_at DESC, job_id DESC) AS rn
  FROM stage_records) WHERE rn = 1"""))
def write_replace(spark: SparkSession, sf: str) -> DataFrame:
    """The latest-stage table written by job type, then a tenth of one job
    type's rows replaced by key: that partition's other rows stay, other
    partitions aren't touched; read back whole."""
    ls = J.latest_stage(B.stage_records(spark, sf)).select("video_id", "job_type", "job_id", "status", "updated_at")
    path = scratch_path(spark, "latest_stage")
    sinks.write_replace(ls, path, ["job_type"])
    changed = ls.filter((F.col("job_type") == "download") & F.col("job_id").endswith("7")).withColumn("status", F.lit("rechecked"))
    sinks.write_replace(changed, path, ["job_type"], ["video_id"])
    back = spark.read.parquet(path)
    return back.select("video_id", "job_type", "job_id", "status", ts_text("updated_at").alias("updated_at"))


@register("append_revision", B.with_sql(["stage_records"], """
SELECT job_id, status, CAST(2 AS INTEGER) AS revision FROM stage_records"""))
def append_revision(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs append the stage records; nothing is overwritten and the
    latest view shows revision 2 of every record."""
    s = B.stage_records(spark, sf).select("job_id", "status", "updated_at")
    path = scratch_path(spark, "stage_history")
    sinks.append_revision(spark, s, path, "job_id", ["updated_at"])
    sinks.append_revision(spark, s, path, "job_id", ["updated_at"])
    return sinks.latest_revision(spark, path, "job_id").select("job_id", "status", "revision")


@register("stream_idempotent_requests", """
SELECT o_custkey || ':' || strftime(o_orderdate, '%Y-%m-%d') AS idempotency_key, min(o_orderkey) AS request
FROM orders GROUP BY 1""")
def stream_idempotent_requests(spark: SparkSession, sf: str) -> DataFrame:
    """R4 as a stream: job requests (orders, some delivered twice) pass once per
    idempotency key, as the first request."""
    o = _delivered(spark, sf, "orders")
    req = o.select(F.concat_ws(":", F.col("o_custkey").cast("string"),
                               F.date_format("o_orderdate", "yyyy-MM-dd")).alias("idempotency_key"),
                   F.col("o_orderdate").cast("timestamp").alias("submitted_at"), "o_orderkey")
    out = S.first_per_key(spark, req, "idempotency_key", ["submitted_at", "o_orderkey"])
    return out.select("idempotency_key", F.col("o_orderkey").alias("request"))
