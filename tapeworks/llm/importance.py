"""Quality by importance resampling: hashed n-gram models of target and raw
text, Gumbel top-k.

1. *Features.*  Words and pairs of neighbouring words (lower-cased, A to Z),
   hashed to ``BUCKETS`` cells.
2. *Models.*  The raw model is the cells' shares over all documents, the target
   model over the documents labelled good (quality 1, not toxic); both with one
   added to every cell.  At most ``TARGET_DOCS`` labelled rows are used, those
   with the smallest hashes; that bounds the list of ids that tasks get.
3. *Weight.*  A document's log importance weight is the sum of log(target /
   raw) over its features.
4. *Sampling.*  ``log_ratio`` plus Gumbel noise, seeded by the document, is its
   key; the ``KEEP_SHARE`` of the documents with words that have the largest
   keys are kept, which samples them without replacement in proportion to their
   weights.

The k-th largest key is found exactly by counting keys in ever narrower
intervals (a bounded histogram each time); nothing is sorted as a whole.

Nulls and edge cases: a null text or one without words has no weight and no key
and is not kept.  Rows with equal doc_id and text have equal keys and stay or go
together, so ties at the k-th key may keep a few more.  Labels without a
document, repeated or null labels do no harm.  Without any labelled document
all weights are 0 and sampling is uniform.  Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.shared import stored
from tapeworks.llm.text import WordHasher, gram_hashes, utf8_column

BUCKETS = 1 << 14
TARGET_DOCS = 20_000
KEEP_SHARE = 0.85
SEED = "resample-1"
CELLS = 4096
SETTLED = 10_000


def features(text: bytes | None, hasher: WordHasher) -> tuple[np.ndarray, int]:
    """Cells of a text's words and word pairs, and its number of words."""
    words = hasher((text or b"").lower())
    cells = np.concatenate([words, gram_hashes(words, 2)]) & np.uint64(BUCKETS - 1)
    return cells.astype(np.int64), len(words)


def target_ids(labels: DataFrame, most: int = TARGET_DOCS) -> np.ndarray:
    """Ids of at most ``most`` documents labelled good, ascending."""
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null")
    ids = (good.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).toArrow())
    return np.sort(ids.column("doc_id").to_numpy())


def cell_counts(docs: DataFrame, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Occurrences per cell in all documents and in the target documents."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        total = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            wanted = np.isin(np.array([i if i is not None else -1 for i in ids], np.int64), target)
            wanted &= np.array([i is not None for i in ids], bool)
            for text, is_target in zip(utf8_column(batch, "text"), wanted.tolist()):
                cells, _ = features(text, hasher)
                n = np.bincount(cells, minlength=BUCKETS)
                total[0] += n
                if is_target:
                    total[1] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(BUCKETS, dtype=np.int32)), pa.array(total[0]), pa.array(total[1])], ["cell", "raw", "target"])

    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(count, "cell int, raw long, target long")
            .groupBy("cell").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow())
    out = np.zeros((2, BUCKETS), np.int64)
    for k, name in enumerate(("raw", "target")):
        out[k, rows.column("cell").to_numpy()] = rows.column(name).to_numpy()
    return out[0], out[1]


def log_ratios(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """log(target / raw) per cell."""
    if not target.any():
        return np.zeros(len(raw))
    return np.log((target + 1) / (target.sum() + len(target))) - np.log((raw + 1) / (raw.sum() + len(raw)))


def kth_largest(keys: DataFrame, k: int) -> float | None:
    """The k-th largest value of ``key`` (null if there are fewer), exactly."""
    edge = keys.agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("key").alias("n")).first()
    if k < 1 or edge.n < k:
        return None
    low, high, left, held = edge.low, edge.high, k, edge.n
    while held > SETTLED and high > low:
        width = (high - low) / CELLS
        inside = keys.where(F.col("key").between(low, high))
        cell = F.least(F.floor((F.col("key") - low) / width), F.lit(CELLS - 1)).alias("cell")
        counts = inside.groupBy(cell).agg(F.count("*").alias("n"), F.min("key").alias("low"), F.max("key").alias("high")).collect()
        for r in sorted(counts, key=lambda r: -r.cell):
            if left <= r.n:
                break
            left -= r.n
        if (r.low, r.high) == (low, high):
            break
        low, high, held = r.low, r.high, r.n
    for r in keys.where(F.col("key").between(low, high)).groupBy("key").agg(F.count("*").alias("n")).orderBy(F.desc("key")).toLocalIterator():
        if left <= r.n:
            return r.key
        left -= r.n
    return None


def resample(docs: DataFrame, labels: DataFrame, keep_share: float = KEEP_SHARE, seed: str = SEED) -> DataFrame:
    """doc_id, n_words, log_ratio, key, kept: one row per document."""
    ratio = log_ratios(*cell_counts(docs, target_ids(labels)))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            weight, n = [], []
            for text in utf8_column(batch, "text"):
                cells, words = features(text, hasher)
                weight.append(float(ratio[cells].sum()) if words else None)
                n.append(words)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("noise"), pa.array(n, pa.int64()), pa.array(weight, pa.float64())],
                ["doc_id", "noise", "n_words", "log_ratio"])

    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text"), 11)
    uniform = (bits + 0.5) / float(2**53)
    kind = dict(docs.dtypes)["doc_id"]
    rows = (docs.select("doc_id", "text", (-F.log(-F.log(uniform))).alias("noise"))
            .mapInArrow(weigh, f"doc_id {kind}, noise double, n_words long, log_ratio double"))
    keys = stored(rows.select("doc_id", "n_words", "log_ratio", (F.col("log_ratio") + F.col("noise")).alias("key")), "keys")
    share = math.ceil(keep_share * keys.where("key is not null").count())
    least = kth_largest(keys, share)
    kept = F.lit(False) if least is None else F.coalesce(F.col("key") >= least, F.lit(False))
    return keys.select("doc_id", "n_words", "log_ratio", "key", kept.alias("kept"))
