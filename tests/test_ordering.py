"""Skew-safe positions and running totals equal the plain window functions."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeworks.operators.ordering import dense_positions, running_total


def test_positions_and_totals_match_windows_on_a_hot_group(spark):
    # group 0 holds most rows (the hot key), ties in t broken by id
    df = spark.range(0, 5000).select(
        F.when(F.col("id") % 10 < 7, F.lit(0)).otherwise(F.col("id") % 13).alias("g"),
        (F.col("id") * 7919 % 1000).alias("t"), F.col("id"), (F.col("id") % 17).alias("v"))
    w = Window.partitionBy("g").orderBy("t", "id")
    expected = df.select("id", (F.row_number().over(w) - 1).alias("pos"),
                         F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("tot"))
    got = running_total(dense_positions(df, ["g"], F.floor(F.col("t") / 50), ["t", "id"], name="pos"),
                        ["g"], F.floor(F.col("t") / 50), ["t", "id"], F.col("v"), name="tot")
    assert sorted(map(tuple, got.select("id", "pos", "tot").collect())) == sorted(map(tuple, expected.collect()))
