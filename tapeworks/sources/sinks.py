"""Sinks (A6 replace-by-key, A7 history-keeping append).

Both write Parquet under a path the caller gives (on a cluster: a folder in
the shared storage).  A6 replaces rows by key and rewrites only the partitions
that the new data touch.  A7 never rewrites: each append gets the next revision
per key.  The latest revision of every key, its head, is kept beside the
history, so an append reads heads and new rows only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.operators.discovery import dedupe_keep_last
from tapeworks.operators.ordering import dense_positions, order_bucket
from tapeworks.session import scratch_path


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in whatever store it names; other errors are raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_replace(df: DataFrame, path: str, partition_cols: list[str], key: list[str] | None = None) -> None:
    """Write ``df`` into its partitions.  With ``key``, rows of the table with
    a new row's key (in the partitions touched) are replaced and all others stay;
    without, the partitions are replaced whole.

    The rows that stay are an anti join on the key, read from the touched
    partitions only (a semi join on the partition columns prunes the scan).  They
    are written to the shared folder first: nobody reads what is overwritten."""
    spark = df.sparkSession
    if key and folder_exists(spark, path):
        own = [*partition_cols, *[k for k in key if k not in partition_cols]]
        old = spark.read.parquet(path)
        touched = old.join(df.select(*partition_cols).distinct(), partition_cols, "left_semi")
        merged = touched.join(df.select(*own).distinct(), own, "left_anti").unionByName(df, allowMissingColumns=True)
        staged = scratch_path(spark, "replace")
        merged.write.parquet(staged)
        df = spark.read.schema(merged.schema).parquet(staged)
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_cols).parquet(path))


HEAD_BUCKETS = 64  # partitions of the heads; an append rewrites those of its keys


def heads_path(path: str) -> str:
    return f"{path.rstrip('/')}-heads"


def append_revision(spark: SparkSession, df: DataFrame, path: str, key: str, order: list[str]) -> None:
    """Append ``df`` with ``revision`` = head of its key + rank, then replace
    the heads of its keys (A6)."""
    out = next_revisions(spark, df, path, key, order)
    staged = scratch_path(spark, "revisions")
    out.write.parquet(staged)
    new = spark.read.schema(out.schema).parquet(staged)
    new.write.mode("append").parquet(path)
    heads = dedupe_keep_last(new, [key], ["revision"])
    bucket = F.pmod(F.xxhash64(key), F.lit(HEAD_BUCKETS)).cast("int").alias("bucket")
    write_replace(heads.select("*", bucket), heads_path(path), ["bucket"], [key])


def next_revisions(spark: SparkSession, df: DataFrame, path: str, key: str, order: list[str]) -> DataFrame:
    """``df`` with the revisions an append would give it: the history is not read."""
    new = dense_positions(df, [key], order_bucket(df, order[0]), order, name="_rank", start=1)
    if folder_exists(spark, heads_path(path)):
        prev = spark.read.parquet(heads_path(path)).select(key, F.col("revision").alias("_prev"))
        new = new.join(prev, key, "left")
    else:
        new = new.withColumn("_prev", F.lit(0))
    return new.withColumn("revision", F.coalesce("_prev", F.lit(0)) + F.col("_rank")).drop("_rank", "_prev")


def latest_revision(spark: SparkSession, path: str, key: str) -> DataFrame:
    """A7 read side: the latest revision per key, from the heads."""
    return spark.read.parquet(heads_path(path)).drop("bucket")
