"""Embedding near-dedup by collision-counting projections.

Vectors with the same label (and number of components) are linked when their
cosine, in double precision, is 0.98 or more.

1. *Classes.*  Equal vectors of a label are one class; work is per class.
2. *Projections.*  Unit vectors are projected on random Gaussian directions.
   Two vectors at the threshold are sqrt(2 - 2 cos) apart, so their projections
   differ by a normal variable of that deviation, independently in each
   direction.  One direction deals the classes out: cells are windows of
   ``DEALING`` deviations along it, overlapping by half, so that a pair closer
   than a window meets in exactly one cell.
3. *Counting.*  In a cell, each of ``PROJECTIONS`` directions is sorted; around
   each query the members of its window of ``WIDTH`` deviations to either side
   collide with it.  A pair is a candidate from ``calibrated()`` collisions, the
   largest count that a pair at the threshold reaches with probability
   ``RECALL``.
4. *Verification.*  Candidates are compared exactly.

A cell is dealt out by hash to pairs of blocks of ``BLOCK`` classes, so a label
with a third of all rows is many bounded tasks.  Blocks return counts of links
and a spanning forest, never pairs.  One-dimensional windows hold a constant
share of a label, so counting grows with the square of a label's distinct
vectors; copies cost nothing.

Nulls and edge cases: a vector that is null, empty, zero or holds a null or
non-finite component, or has a null label, links with nothing and is its own
component.  A null vec_id counts as larger than all others.  Repeated rows are
copies of each other.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.shared import block_pairs, connected_components, forest, runs, spread, stored

COSINE = 0.98
PROJECTIONS = 32
WIDTH = 2.5
DEALING = 6.0
RECALL = 1 - 1e-6
BLOCK = 2048
LAST = 9223372036854775807


def calibrated(projections: int = PROJECTIONS, width: float = WIDTH, recall: float = RECALL) -> int:
    """Largest number of collisions that a pair at the threshold reaches with
    probability ``recall``."""
    p = math.erf(width / math.sqrt(2))
    tail = 0.0
    for count in range(projections, -1, -1):
        tail += math.comb(projections, count) * p ** count * (1 - p) ** (projections - count)
        if tail >= recall:
            return count
    return 0


@cache
def directions(size: int) -> np.ndarray:
    """The dealing direction and the counted ones for vectors of ``size``."""
    return np.random.default_rng([5, size]).standard_normal((1 + PROJECTIONS, size))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Vectors (rows) times the power of two that brings their largest component
    to between 0.5 and 1: norms and products neither overflow nor vanish, and no
    digit of a component changes."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=-1, keepdims=True))[1])


def valid(label: str, vector: str) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.col(label).isNotNull() & (F.size(vector) > 0) & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _cells(spread_of_pair: float):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = []
            for v in batch.column("vector").to_pylist():
                v = scaled(np.array(v, np.float64))
                at = directions(len(v))[0] @ v / np.linalg.norm(v)
                cell.append(math.floor(at / (DEALING * spread_of_pair)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell, pa.int32())], [*batch.schema.names, "own"])
    return deal


def linked_pairs(vectors: np.ndarray, cosine: float) -> np.ndarray:
    """Boolean matrix of the pairs found with this cosine or more."""
    n, size = vectors.shape
    vectors = scaled(vectors)
    width, least = WIDTH * math.sqrt(2 - 2 * cosine), calibrated()
    norms = np.linalg.norm(vectors, axis=1)
    at = (vectors / norms[:, None]) @ directions(size)[1:].T
    order = np.argsort(at, axis=0, kind="stable")
    rank = np.empty_like(order)
    low, high = np.empty_like(order), np.empty_like(order)
    for k in range(PROJECTIONS):
        along = at[order[:, k], k]
        rank[order[:, k], k] = np.arange(n)
        low[:, k] = np.searchsorted(along, at[:, k] - width, "left")
        high[:, k] = np.searchsorted(along, at[:, k] + width, "right")
    rank, low, high = (x.astype(np.int16 if n < 2**15 else np.int32).T.copy() for x in (rank, low, high))
    linked = np.zeros((n, n), bool)
    for a in range(0, n, 256):
        count = np.zeros((min(256, n - a), n), np.int8)
        for k in range(PROJECTIONS):
            count += (rank[k] >= low[k, a:a + 256, None]) & (rank[k] < high[k, a:a + 256, None])
        u, v = np.nonzero(count >= least)
        u += a
        for part in range(0, len(u), 100_000):
            i, j = u[part:part + 100_000], v[part:part + 100_000]
            dot = np.einsum("ij,ij->i", vectors[i], vectors[j])
            good = dot >= cosine * (norms[i] * norms[j])
            linked[i[good], j[good]] = True
    linked |= linked.T
    np.fill_diagonal(linked, False)
    return linked


def _verified(cosine: float):
    """Task function: links in each block pair of a table: per class the number
    of linked vectors (b null), and edges of a forest (n null)."""
    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([(c, "ascending") for c in ("group", "cell", "i", "j", "cls")])
        group, cell, i, j, block, own, cls, copies = (
            table.column(c).to_numpy() for c in ("group", "cell", "i", "j", "block", "own", "cls", "copies"))
        vectors = table.column("vector").to_pylist()
        bounds = runs(group, cell, i, j)
        a, b, n = [], [], []
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if high - low < 2:
                continue
            linked = linked_pairs(np.array(vectors[low:high], np.float64), cosine)
            part = slice(low, high)
            # Each pair once: in the lower cell of the two, in the pair of its blocks.
            beyond = own[part] > cell[part]
            linked &= ~(beyond[:, None] & beyond[None])
            if i[low] != j[low]:
                linked &= block[part][:, None] != block[part][None]
            for k, links in enumerate((linked @ copies[part]).tolist(), low):
                if links:
                    a.append(cls[k]), b.append(None), n.append(links)
            for u, v in forest(linked):
                a.append(cls[low + u]), b.append(cls[low + v]), n.append(None)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "n": pa.array(n, pa.int64())})

    return verify


def near_vectors(table: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per vector of ``table``
    (vec_id, embedding, label)."""
    vector = F.transform("embedding", lambda x: x.cast("double"))
    rows = table.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(LAST)).alias("id"), vector.alias("vector"),
                        F.col("label").cast("string").alias("label"))
    rows = stored(rows.withColumn("good", valid("label", "vector")), "vectors")
    good = rows.where("good").withColumn("group", F.xxhash64("label", F.size("vector")))
    good = good.withColumn("cls", F.xxhash64("label", "vector"))
    classes = good.groupBy("group", "cls").agg(F.count("*").alias("copies"), F.min("id").alias("first"),
                                               F.first("vector").alias("vector"))
    far = math.sqrt(2 - 2 * cosine)
    classes = stored(classes.select("group", "cls", "copies", "first", "vector").mapInArrow(
        _cells(far), "group long, cls long, copies long, first long, vector array<double>, own int"), "vector-classes")
    celled = classes.withColumn("cell", F.explode(F.array("own", F.col("own") - 1)))
    sized = celled.groupBy("group", "cell").agg(F.count("*").alias("members"))
    dealt = (celled.join(sized, ["group", "cell"]).withColumn("x", F.xxhash64("cls"))
             .select("group", "cell", "cls", "copies", "vector", F.col("own").alias("bucket"),
                     F.explode(block_pairs("members", "x", BLOCK)).alias("p"))
             .select("group", "cell", "cls", "copies", "vector", "p.i", "p.j", F.col("p.own").alias("block"),
                     F.col("bucket").alias("own")))
    total = sized.agg(F.sum(F.col("members") * F.ceil(F.col("members") / BLOCK))).first()[0] or 0
    task = F.pmod(F.xxhash64("group", "cell", "i", "j"), F.lit(spread(int(total), BLOCK)))
    links = stored(dealt.withColumn("task", task).groupBy("task").applyInArrow(
        _verified(cosine), "a long, b long, n long"), "vector-links")
    counts = links.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
    groups = connected_components(links.where("b is not null").select("a", "b")).withColumnRenamed("node", "cls")
    own = (classes.select("cls", "copies", "first").join(groups, "cls", "left")
           .withColumn("component", F.coalesce("component", "cls")))
    # Stored, so that the join shuffles both sides and a hot component's can be split.
    least = stored(own.groupBy("component").agg(F.min("first").alias("component_id")), "vector-components")
    judged = (own.join(least, "component").join(counts, "cls", "left")
              .select("cls", "component_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    named = good.select("id", "cls").join(judged, "cls").select("id", "n_links", "component_id")
    rest = rows.where("not good").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    real = lambda c: F.when(F.col(c) != LAST, F.col(c))
    return named.unionAll(rest).select(
        real("id").alias("vec_id"), "n_links", real("component_id").alias("component_id"),
        (F.col("id") == F.col("component_id")).alias("kept"))
