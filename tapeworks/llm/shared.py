"""Shared storage, stable hashing and connected components for the operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage
    is cut, several readers share one computation, and a lost executor costs
    a re-read only."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(rows: int, per_group: int) -> int:
    """Number of groups so that hashing puts about ``per_group`` rows in each."""
    return max(1, -(-rows // per_group))


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric boolean matrix."""
    new, edges = np.ones(len(linked), bool), []
    for root in range(len(linked)):
        if not new[root]:
            continue
        new[root] = False
        todo = [root]
        while todo:
            u = todo.pop()
            found = np.flatnonzero(linked[u] & new)
            new[found] = False
            edges += [(u, v) for v in found.tolist()]
            todo += found.tolist()
    return edges


def block_pairs(count: str, block: str, per_block: int) -> Column:
    """The (i, j) block pairs a row belongs to, when its group of ``count`` rows
    is dealt out by ``block``, a hash of the row."""
    blocks = F.ceil(F.col(count) / per_block).cast("int")
    own = F.pmod(F.col(block), blocks).cast("int")
    return F.transform(F.sequence(F.lit(0), blocks - 1),
                       lambda j: F.struct(F.least(own, j).alias("i"), F.greatest(own, j).alias("j"), own.alias("own")))


def runs(*columns: np.ndarray) -> np.ndarray:
    """Bounds of the runs of equal rows in sorted columns."""
    turn = np.zeros(len(columns[0]) + 1, bool)
    turn[[0, -1]] = True
    for c in columns:
        turn[1:-1] |= c[1:] != c[:-1]
    return np.flatnonzero(turn)


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Smallest node reachable from each node: (node, component).

    ``edges``: columns ``a``, ``b`` of one orderable type, not null.  Alternating large-star
    and small-star steps: every step points nodes at the smallest neighbour
    they know.  A step is a partially aggregated ``min`` and a join; no list of
    neighbours is ever gathered.  The first minima are written before their
    join, so that both of its sides are shuffled for it and AQE can split the
    side of a hub with a third of all edges.  Every round's edges are written to
    the shared folder.  Raises if ``max_rounds`` don't converge
    (rounds grow with the logarithm of the longest path).
    """
    e = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
               .distinct(), "edges")
    previous = None
    for _ in range(max_rounds):
        both = e.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionAll(
            e.select(F.col("lo").alias("u"), F.col("hi").alias("v")))
        low = stored(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "minima")
        large = (both.join(low, "u").where("v > u").where("v <> m")
                 .select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct())
        down = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = (large.join(down, "hi")
                 .select(F.explode(F.when(F.col("lo") == F.col("m"), F.array(F.struct(F.col("hi"), F.col("m").alias("lo"))))
                                   .otherwise(F.array(F.struct(F.col("hi"), F.col("m").alias("lo")),
                                                      F.struct(F.col("lo").alias("hi"), F.col("m").alias("lo"))))).alias("x"))
                 .select("x.hi", "x.lo").where("hi <> lo").distinct())
        e = stored(small, "edges")
        state = e.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
        if tuple(state) == previous:
            break
        previous = tuple(state)
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return e.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionAll(roots)
