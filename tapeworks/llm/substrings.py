"""Substring dedup: repeated word sequences by prefix-partitioned suffix trees.

A window is ``WINDOW`` (20) consecutive words of one document.  Every word that
lies in a window whose words also start earlier (a smaller doc_id, or the same
document further left) is removed; windows are judged on the input.

1. *Sync points.*  In every window the 8-word gram with the smallest hash is
   marked.  Equal windows mark the same gram, so a window that occurs twice
   shows a marked gram that occurs twice.  Marked grams that occur in one place
   only are dropped (counted over the whole corpus, partially aggregated);
   the suffixes that start a window over the remaining ones are all that can
   reach a node of depth 20.  No repeat is lost.
2. *Suffixes* are read as symbols of five words (64-bit names), so a window is
   the path of four symbols.
3. *Prefix partition.*  Histograms of all suffixes by their first 1, 2, 3 and 4
   symbols choose, for each suffix, the shortest prefix whose bucket holds at
   most ``GROUP`` suffixes.  Buckets of light prefixes share a task.  Suffixes
   of a window that is itself more frequent are dealt out by hash, and only the
   earliest of each part meets the others.
4. *Subtrees.*  A task sorts its suffixes and takes the longest common prefixes
   of neighbours: an internal node of depth 20 words or more is a run of
   neighbours that share four symbols.  Its earliest leaf stays, the windows at
   its other leaves are removed; overlapping windows join to maximal repeats.

A document whose words equal an earlier document's is a copy: all its windows
start earlier, so it is removed whole (if it has a window) without entering the
trees; thousands of copies are one document to them.

Nulls and edge cases: a null text has no words.  Null doc_ids count as larger
than all others.  Rows with equal doc_id and different texts are different
documents, ordered by a hash of the text; rows equal in both are one document
and get the same result.  Texts under 20 words keep all.  Extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.shared import spread, stored
from tapeworks.llm.text import WordHasher, covered, gram_hashes, mix, utf8_column

WINDOW = 20
SYMBOL = 5
SYNC = 8
GROUP = 250_000
FILTER_BITS = 23
LAST = 9223372036854775807


def row_keys(docs: DataFrame) -> list:
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("d"),
            F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("t")]


def sync_points(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the marked grams, given the words' hashes."""
    if len(words) < WINDOW:
        return np.empty(0, np.int32), np.empty(0, np.uint64)
    g = gram_hashes(words, SYNC)
    span = WINDOW - SYNC + 1
    low, width = g, 1  # smallest hash of each window, by doubling
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[:len(low) - step], low[step:])
        width += step
    # A gram is marked if it is the smallest of some window over it.
    marked = np.zeros(len(g), bool)
    for k in range(span):
        marked[k:k + len(low)] |= g[k:k + len(low)] == low
    at = np.flatnonzero(marked)
    return at.astype(np.int32), g[at]


def symbols(words: np.ndarray) -> np.ndarray:
    """Rows of the symbols of every window: its path in the tree."""
    s = gram_hashes(words, SYMBOL)
    count = len(words) - WINDOW + 1
    return np.stack([s[k:k + count] for k in range(0, WINDOW, SYMBOL)], axis=1)


def prefix_names(path: np.ndarray) -> np.ndarray:
    """64-bit names of each path's prefixes of 1, 2, 3, ... symbols."""
    names = [mix(path[:, 0])]
    for k in range(1, path.shape[1]):
        names.append(mix(names[-1] * np.uint64(0x9E3779B97F4A7C15) + path[:, k]))
    return np.stack(names, axis=1)


def window_starts(at: np.ndarray, count: int) -> np.ndarray:
    """Starts of the windows over the marked grams at these places."""
    start = np.zeros(count + 1, np.int64)
    np.add.at(start, np.maximum(at - (WINDOW - SYNC), 0), 1)
    np.add.at(start, np.minimum(at + 1, count), -1)
    return np.flatnonzero(np.cumsum(start[:count]) > 0)


def _survey(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per document its words, their SHA-256 and its sync points."""
    hasher = WordHasher()
    for batch in batches:
        n, sha, at, g = [], [], [], []
        for text in utf8_column(batch, "text"):
            words = (text or b"").split()
            n.append(len(words))
            sha.append(hashlib.sha256(b" ".join(words)).digest())
            places, hashes = sync_points(hasher(text)) if len(words) >= WINDOW else sync_points(np.empty(0, np.uint64))
            at.append(places)
            g.append(hashes.view(np.int64))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("d"), batch.column("t"), pa.array(n, pa.int64()), pa.array(sha, pa.binary()),
             pa.array(at, pa.list_(pa.int32())), pa.array(g, pa.list_(pa.int64()))],
            ["doc_id", "d", "t", "n_words", "sha", "at", "g"])


def _suffixes(batch: pa.RecordBatch, hasher: WordHasher) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(row, starts, paths) of the suffixes that can reach depth ``WINDOW``."""
    for row, (text, at) in enumerate(zip(utf8_column(batch, "text"), batch.column("at").to_pylist())):
        words = hasher(text)
        path = symbols(words)
        starts = window_starts(np.array(at, np.int64), len(path))
        yield row, starts, path[starts]


def prefix_histograms(affected: DataFrame, bits: int) -> np.ndarray:
    """Number of suffixes per bucket of prefix names, for each prefix length."""
    levels = WINDOW // SYMBOL

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, total = WordHasher(), np.zeros((levels, 1 << bits), np.int64)
        for batch in batches:
            for _, _, path in _suffixes(batch, hasher):
                bucket = (prefix_names(path) >> np.uint64(64 - bits)).astype(np.int64)
                for k in range(levels):
                    np.add.at(total[k], bucket[:, k], 1)
        level, at = np.nonzero(total)
        for k in range(0, len(at), 100_000):
            part = slice(k, k + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(level[part].astype(np.int32)), pa.array(at[part]), pa.array(total[level[part], at[part]])],
                ["level", "bucket", "n"])

    out = np.zeros((levels, 1 << bits), np.int64)
    found = (affected.select("text", "at").mapInArrow(count, "level int, bucket long, n long")
             .groupBy("level", "bucket").agg(F.sum("n").alias("n")).toArrow())
    out[found.column("level").to_numpy(), found.column("bucket").to_numpy()] = found.column("n").to_numpy()
    return out


def _dealt(histogram: np.ndarray, tasks: int, group: int):
    """Task function: suffix rows with the task of their prefix; ``part`` is 0,
    or the number of a part when the window itself is more frequent."""
    levels, bits = len(histogram), int(math.log2(histogram.shape[1]))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            d, t = batch.column("d").to_numpy(), batch.column("t").to_numpy()
            for row, start, path in _suffixes(batch, hasher):
                if not len(start):
                    continue
                names = prefix_names(path)
                bucket = (names >> np.uint64(64 - bits)).astype(np.int64)
                held = np.stack([histogram[k][bucket[:, k]] for k in range(levels)], axis=1)
                light = held <= group
                light[:, -1] = True
                level = light.argmax(axis=1)
                every = np.arange(len(start))
                key = mix(bucket[every, level].astype(np.uint64) * np.uint64(levels) + level.astype(np.uint64))
                parts = -(-held[every, level] // group)
                own = mix(start.astype(np.uint64) ^ np.uint64(int(t[row]) & (2**64 - 1)))
                part = np.where(parts > 1, 1 + (own % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64), 0)
                task = mix(key + part.astype(np.uint64)) % np.uint64(tasks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(task.astype(np.int64)), pa.array(part), pa.array(np.full(len(start), d[row])),
                     pa.array(np.full(len(start), t[row])), pa.array(start.astype(np.int32)),
                     *(pa.array(path[:, k].view(np.int64)) for k in range(levels))],
                    ["task", "part", "d", "t", "start", *(f"s{k}" for k in range(levels))])

    return deal


def _subtrees(table: pa.Table) -> pa.Table:
    """Deep internal nodes of a task's suffixes.  Rows: the windows of a
    document to remove (``starts``), or the earliest leaf of a part of a node
    that is dealt out (``starts`` of one, with the node's path)."""
    levels = WINDOW // SYMBOL
    c = {name: table.column(name).to_numpy() for name in table.column_names}
    order = np.lexsort((c["start"], c["t"], c["d"], c["part"], *(c[f"s{k}"] for k in reversed(range(levels)))))
    c = {name: v[order] for name, v in c.items()}
    same = np.ones(max(len(order) - 1, 0), bool)
    for k in range(levels):  # longest common prefix of neighbours, in symbols
        same &= c[f"s{k}"][1:] == c[f"s{k}"][:-1]
    same &= c["part"][1:] == c["part"][:-1]
    later = np.concatenate([[False], same])
    first_of_part = ~later & (c["part"] > 0)
    gone = np.flatnonzero(later)
    by_doc = gone[np.lexsort((c["start"][gone], c["t"][gone], c["d"][gone]))]
    d, t, start = c["d"][by_doc], c["t"][by_doc], c["start"][by_doc]
    turn = np.flatnonzero(np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1])])) if len(d) else np.empty(0, np.int64)
    starts = pa.ListArray.from_arrays(pa.array(np.append(turn, len(d)), pa.int32()), pa.array(start, pa.int32()))
    removed = pa.table({"d": d[turn], "t": t[turn], "starts": starts,
                        "path": pa.array([None] * len(turn), pa.binary())})
    leaf = np.flatnonzero(first_of_part)
    path = np.stack([c[f"s{k}"][leaf] for k in range(levels)], axis=1)
    open_ = pa.table({"d": c["d"][leaf], "t": c["t"][leaf],
                      "starts": pa.array([[s] for s in c["start"][leaf].tolist()], pa.list_(pa.int32())),
                      "path": pa.array([p.tobytes() for p in path], pa.binary())})
    return pa.concat_tables([removed, open_])


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Remove the windows of each text: words removed and SHA-256 of the rest."""
    for batch in batches:
        n, sha = [], []
        for text, lists in zip(utf8_column(batch, "text"), batch.column("windows").to_pylist()):
            words = (text or b"").split()
            out = covered(np.concatenate([np.array(x, np.int64) for x in lists]), WINDOW, len(words))
            n.append(int(out.sum()))
            sha.append(hashlib.sha256(b" ".join(w for w, o in zip(words, out.tolist()) if not o)).digest())
        yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("t"), pa.array(n, pa.int64()), pa.array(sha, pa.binary())],
                                         ["d", "t", "removed", "left"])


def fixed_filter(keys: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """Bitmap of ``keys`` (column t) of a fixed size, whatever their number: it
    only saves rows that can't join from being shuffled."""
    slot = F.pmod("t", F.lit(1 << bits))
    rows = (keys.select(F.shiftright(slot, 5).alias("w"), F.pmod(slot, F.lit(32)).cast("int").alias("b")).distinct()
            .groupBy("w").agg(F.sum(F.expr("shiftleft(1L, b)")).alias("v")).toArrow())
    out = np.zeros(1 << (bits - 5), np.uint32)
    out[rows.column("w").to_numpy()] = rows.column("v").to_numpy().astype(np.uint32)
    return out


def _in_filter(bitmap: np.ndarray):
    slots = len(bitmap) * 32

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slot = np.mod(batch.column("t").to_numpy(), slots)
            yield batch.filter(pa.array((bitmap[slot >> 5] >> (slot & 31).astype(np.uint32)) & 1 == 1))

    return keep


def remove_repeats(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256: one row per document."""
    kind = dict(docs.dtypes)["doc_id"]
    survey = stored(docs.select("doc_id", *row_keys(docs), "text").mapInArrow(
        _survey, f"doc_id {kind}, d long, t long, n_words long, sha binary, at array<int>, g array<long>"), "survey")
    whole = survey.select("doc_id", "d", "t", "n_words", "sha")
    # Stored, so that the join shuffles both sides and a hot text's can be split.
    first = stored(whole.groupBy("sha").agg(F.min(F.struct("d", "t")).alias("rep")), "first-texts")

    points = survey.select("t", F.explode(F.arrays_zip("at", "g")).alias("p")).select("t", "p.at", "p.g")
    place = F.xxhash64("t", "at")
    # Stored, so that the join shuffles both sides and a hot gram's can be split.
    shared = stored(points.groupBy("g").agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select("g"), "shared")
    marked = points.join(shared, "g").groupBy("t").agg(F.collect_set("at").alias("at"))
    needed = stored(first.select("rep.d", "rep.t").join(marked, "t").select("d", "t", "at"), "marked")
    sizes = needed.agg(F.count("*").alias("n"), F.sum(F.size("at")).alias("points")).first()
    most = (sizes.points or 0) * (WINDOW - SYNC + 1)  # suffixes, at most

    near = docs.select(*row_keys(docs), "text").mapInArrow(_in_filter(fixed_filter(needed)), "d long, t long, text string")
    affected = near.join(needed.hint("shuffle_hash"), ["d", "t"])
    affected = stored(affected.dropDuplicates(["d", "t"]) if _repeats(whole) else affected, "affected")
    tasks = spread(most, group)
    bits = min(22, max(8, math.ceil(math.log2(tasks)) + 3))  # buckets of about an eighth of a group
    names = [f"s{k}" for k in range(WINDOW // SYMBOL)]
    suffixes = affected.mapInArrow(
        _dealt(prefix_histograms(affected, bits), tasks, group),
        "task long, part long, d long, t long, start int, " + ", ".join(f"{s} long" for s in names))
    found = stored(suffixes.groupBy("task").applyInArrow(_subtrees, "d long, t long, starts array<int>, path binary"), "repeats")
    leaves = found.where("path is not null").select("d", "t", F.col("starts")[0].alias("start"), "path")
    earliest = leaves.groupBy("path").agg(F.min(F.struct("d", "t", "start")).alias("first"))
    later = (leaves.join(earliest, "path").where(F.struct("d", "t", "start") > F.col("first"))
             .select("d", "t", F.array("start").alias("starts")))
    windows = (found.where("path is null").select("d", "t", "starts").unionAll(later)
               .groupBy("d", "t").agg(F.collect_list("starts").alias("windows")))
    cut = affected.select("d", "t", "text").join(windows, ["d", "t"]).mapInArrow(_kept, "d long, t long, removed long, left binary")

    nothing = F.unhex(F.lit(hashlib.sha256(b"").hexdigest()))
    copy = (F.struct("d", "t") != F.col("rep")) & (F.col("n_words") >= WINDOW)
    return (whole.join(first, "sha").join(cut, ["d", "t"], "left")
            .select("doc_id", "n_words",
                    F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
                    F.lower(F.hex(F.when(copy, nothing).otherwise(F.coalesce("left", "sha")))).alias("kept_sha256")))


def _repeats(whole: DataFrame) -> bool:
    """Whether some rows are equal in doc_id and text."""
    return not whole.groupBy("d", "t").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
