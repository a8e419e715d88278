"""Structured Streaming forms of the re-polled queries (§2.11 R1, R2, R4, R5).

The reference waits by re-running a bounded query on a schedule.  Here the
same logic runs as a stream over a file source with a fixed schema.
``trigger(availableNow=True)`` is the reference's "reschedule" mode: process
what has arrived, then stop.

All of these answers must be complete: a row that arrives late counts like any
other.  So there is no watermark and no state store.  Every micro-batch is
reduced to one row per key (partially aggregated) and written under its batch
ID; the answer is the same reduction over all of them.  The reduction is a
minimum, maximum or sum, so batches may come in any order, and a batch that is
retried after a lost executor overwrites its own folder.  Every
``compact_every`` batches the folders so far are reduced to one snapshot, so
what a read has to look at stays bounded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.operators.discovery import dedupe_keep_first, dedupe_keep_last, window_half_open
from tapeworks.session import scratch_path
from tapeworks.sources.sinks import folder_exists

COMPACT_EVERY = 20


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int | None = None) -> DataFrame:
    """A driver table as a file stream: the folder, filtered to one file
    name, with the schema fixed from the table (no inference per batch)."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    return files_stream(spark, sf_dir, schema, max_files, f"{name}.parquet")


def files_stream(spark: SparkSession, path: str, schema, max_files: int | None = None, pattern: str = "*.parquet") -> DataFrame:
    """The Parquet files of a folder as a stream, ``max_files`` per batch."""
    r = spark.readStream.schema(schema).option("pathGlobFilter", pattern).option("recursiveFileLookup", "true")
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def _parts(spark: SparkSession, base: str, kind: str) -> list[int]:
    """Batch IDs of the complete folders ``base/<kind><id>``."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [s.getPath().getName() for s in fs.listStatus(root)] if fs.exists(root) else []
    return sorted(int(n[1:]) for n in found if n[0] == kind and n[1:].isdigit()
                  and folder_exists(spark, f"{base}/{n}/_SUCCESS"))


def folded(spark: SparkSession, base: str, schema, reduce: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What the batches under ``base`` add up to: the newest snapshot and the
    batches after it, reduced."""
    snapshots = _parts(spark, base, "s")
    last = snapshots[-1] if snapshots else -1
    paths = [f"{base}/s{last:08d}"] * bool(snapshots) + [f"{base}/b{k:08d}" for k in _parts(spark, base, "b") if k > last]
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return reduce(rows)


def run_folded(spark: SparkSession, rows: DataFrame, first: Callable[[DataFrame], DataFrame],
               again: Callable[[DataFrame], DataFrame] | None = None, name: str = "fold", base: str | None = None,
               compact_every: int = COMPACT_EVERY) -> DataFrame:
    """Run the stream ``rows`` to the end of what has arrived and return the
    fold: ``first`` reduces a batch, ``again`` (default: the same) reduces
    reduced rows.  ``base``: the folder of a previous run to resume; the state
    lives only there, so a restarted driver loses nothing."""
    base, again = base or scratch_path(spark, name), again or first
    schema = first(spark.createDataFrame([], rows.schema)).schema

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        first(batch).write.mode("overwrite").parquet(f"{base}/b{batch_id:08d}")
        if batch_id % compact_every == compact_every - 1:
            folded(session, base, schema, again).write.mode("overwrite").parquet(f"{base}/s{batch_id:08d}")

    q = (rows.writeStream.foreachBatch(write).option("checkpointLocation", f"{base}/checkpoint")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(f"stream {name} failed: {q.exception()}")
    return folded(spark, base, schema, again)


def uploads(spark: SparkSession, pubs: DataFrame, after=None, before=None, **run) -> DataFrame:
    """Uploads inside the window, each video once (its first publication)."""
    rows = window_half_open(pubs, "published_at", after, before)
    return run_folded(spark, rows, lambda x: dedupe_keep_first(x, ["video_id"], ["published_at"]), name="uploads", **run)


def latest_state(spark: SparkSession, rows: DataFrame, key: str, order: list[str], **run) -> DataFrame:
    """R2: the latest row per key."""
    return run_folded(spark, rows, lambda x: dedupe_keep_last(x, [key], order), name="latest", **run)


def first_per_key(spark: SparkSession, rows: DataFrame, key: str, order: list[str], **run) -> DataFrame:
    """R4 (stream): each idempotency key goes out once, as its first request."""
    return run_folded(spark, rows, lambda x: dedupe_keep_first(x, [key], order), name="requests", **run)


def daily_counts(spark: SparkSession, pubs: DataFrame, key: str = "channel_id", ts: str = "published_at", **run) -> DataFrame:
    """Uploads per key per UTC day (tumbling window), late rows included."""
    day = F.window(ts, "1 day").start.alias("day")
    return run_folded(spark, pubs, lambda x: x.groupBy(key, day).agg(F.count("*").alias("uploads")),
                      lambda x: x.groupBy(key, "day").agg(F.sum("uploads").alias("uploads")), name="daily", **run)
