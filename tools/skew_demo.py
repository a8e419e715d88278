"""Hot-key demo: positions within a group where one key holds a third of the rows.

Usage: python tools/skew_demo.py [rows]

Times ``row_number()`` over ``partitionBy(key)`` (the hot key's rows all sort
in one task) against ``ordering.dense_positions`` (bucketed offsets; the hot
key spreads over tasks), checks both give the same positions, and prints
the largest input one task of the numbering stage had to take.
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tapeworks.operators.ordering import dense_positions  # noqa: E402
from tapeworks.session import build_session  # noqa: E402


def main(argv) -> int:
    n = int(argv[1]) if len(argv) > 1 else 6_000_000
    spark = build_session()
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("key"),   # key 0: 1/3 of rows
        ((F.col("id") * 2654435761) % 1000003).alias("t"), F.col("id"))
    df = df.repartition(64).cache()
    df.count()

    def timed(name, out):
        t0 = time.perf_counter()
        out.write.format("noop").mode("overwrite").save()
        dt = time.perf_counter() - t0
        print(f"{name:18s} {dt:6.2f} s")
        return dt

    plain = df.withColumn("pos", F.row_number().over(Window.partitionBy("key").orderBy("t", "id")) - 1)
    bucketed = dense_positions(df, ["key"], F.floor(F.col("t") / 10000), ["t", "id"], name="pos")
    timed("row_number", plain)
    timed("dense_positions", bucketed)
    # the largest group a single numbering task sorts
    biggest_plain = df.groupBy("key").count().agg(F.max("count")).first()[0]
    biggest_bucket = df.groupBy("key", F.floor(F.col("t") / 10000)).count().agg(F.max("count")).first()[0]
    print(f"largest sort unit: row_number {biggest_plain:,} rows, dense_positions {biggest_bucket:,} rows")
    same = plain.select("id", "pos").exceptAll(bucketed.select("id", "pos")).limit(1).count() == 0
    print(f"same positions: {same}")
    spark.stop()
    return 0 if same else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
