"""Session builder and shared-folder helpers.

The library never creates its own session inside an operator; callers pass a
``SparkSession``.  ``build_session`` is what tests, ``bench.py`` and the CLI
use: UTC session time zone (every contract instant is UTC), ANSI on, AQE on
with skew-join splitting, UI off.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession


# Settings for a large cluster (~1000 executors, ~100 TB of input).  The
# session builder below is for local runs; on a cluster pass these with
# ``spark-submit --conf`` (or ``builder.config``):
#  * 512 MB input splits: ~200k scan tasks for 100 TB, each well inside an
#    executor core's memory;
#  * shuffles start wide (AQE coalesces small partitions at runtime to the
#    advisory size), so no reducer receives more than a few hundred MB;
#  * skew join splitting kicks in for partitions 5x the median and > 1 GB;
#  * runtime broadcast only for sides measured under 64 MB.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": str(512 * 1024 * 1024),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "40000",
    "spark.sql.shuffle.partitions": "40000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1024 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "tapeworks") -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Generated methods over 8000 bytes are never JIT-compiled by the JVM;
        # such stages run faster without whole-stage codegen.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("TAPEWORKS_DRIVER_MEMORY", "8g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="tapeworks-shared-")


def checkpoint_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediate tables:
    ``spark.checkpoint.dir`` as the cluster names it.

    A cluster that names none is refused.  Only a local session (tests, bench),
    whose tasks run on this machine, gets a folder of its own, one per process.
    What a run writes there stays until the folder's owner clears it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        configured = _local_folder()
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"
