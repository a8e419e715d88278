"""Driver-table scans.

Every scan goes through ``table`` so that Catalyst sees a plain Parquet
relation: column pruning and filter pushdown reach the file reader.  Parquet
timestamps arrive as ``timestamp_ntz``; contract instants are UTC, so
``as_utc`` reinterprets them (wall clock = UTC, session time zone is UTC).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def as_utc(col: Column | str) -> Column:
    """``timestamp_ntz`` wall clock read as a UTC instant (session tz is UTC)."""
    c = F.col(col) if isinstance(col, str) else col
    return c.cast("timestamp")


def spread(df: DataFrame) -> DataFrame:
    """The rows dealt evenly over as many tasks as a shuffle has (or the cores
    are, if more): for costly work on few bytes, which a scan cuts by size alone
    and a Parquet file by row group, whatever the rows cost."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
