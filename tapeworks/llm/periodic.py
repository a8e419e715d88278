"""Periodic runs of words by descending-LCP Kruskal.

A run is a stretch of consecutive words with smallest period q, at least
max(``MIN_LENGTH``, ``MIN_EXPONENT`` q) words long, that no neighbouring word
extends keeping period q.  Each document is worked on by itself, many at once:

1. *Repeats.*  With s the start of a run of length L, the suffixes at s and
   s + q agree on L - q >= ``LEAST`` words, so only suffixes whose first
   ``LEAST`` words recur in their document matter.  A suffix is cut after the
   first group of ``LEAST`` words that does not recur: no common prefix is longer.
2. *Suffix order.*  The cut suffixes are sorted by doubling ranks, and the common
   prefix of neighbours is read off the ranks of all lengths.
3. *Kruskal.*  Neighbours are united from the longest common prefix (LCP) down, by
   union-find over classes that keep their positions in order; the smaller class
   is inserted into the larger.  When two positions at distance q first become
   neighbours in a class, their LCP l is the current one.  If q is within it, as
   far as the least exponent asks (q + l >= max(6, 4 q)), they seed a run of q + l
   words, q being its smallest period: a smaller one would have put a position
   between them earlier.  A run's first words give exactly one such pair; pairs
   whose words before are equal too lie inside a run and are left out.

Words are compared by 64-bit hashes.  Nothing is shuffled; memory is that of a
chunk of texts, or of one long text: 4 bytes per repeated word and doubling.

Nulls and edge cases: a null or empty text has no words and no runs.  A null
doc_id is kept.  Rows are judged one by one, repeated ones too.  Very long texts
are read whole.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.text import WORD_PATTERN, WordHasher, gram_hashes, mix, utf8_column

MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Words that the suffixes at a run's start and one period later share at least (period 1: 6 - 1).
LEAST = MIN_LENGTH - 1
CHUNK = 4_000_000
SIEVE_BITS = 22


def recurring(grams: np.ndarray) -> np.ndarray:
    """Positions of the values that occur more than once, ascending."""
    cell = (grams >> np.uint64(64 - SIEVE_BITS)).astype(np.int64)
    maybe = np.flatnonzero(np.bincount(cell, minlength=1 << SIEVE_BITS)[cell] > 1)
    own = grams[maybe]
    order = np.argsort(own, kind="stable")
    own = own[order]
    same = np.zeros(len(own) + 1, bool)
    same[1:-1] = own[1:] == own[:-1]
    return np.sort(maybe[order[same[1:] | same[:-1]]])


def suffix_ranks(symbols: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols, until all differ.
    Equal rank: equal symbols.  The last symbol must occur once."""
    size = len(symbols)
    order = np.argsort(symbols, kind="stable")
    start = np.flatnonzero(np.diff(symbols[order], prepend=symbols[order[0]] - 1))
    rank = np.empty(size, np.int32)
    rank[order] = np.repeat(start, np.diff(start, append=size))
    levels, length = [rank], 1
    count = np.bincount(rank, minlength=size)
    active = np.flatnonzero(count[rank] > 1)
    while len(active):
        old = rank[active].astype(np.int64)
        key = old * size + rank[active + length]
        order = np.argsort(key, kind="stable")
        key, old, place = key[order], old[order], np.arange(len(active))
        bucket = np.maximum.accumulate(np.where(np.diff(old, prepend=-1) != 0, place, 0))
        fresh = np.maximum.accumulate(np.where(np.diff(key, prepend=-1) != 0, place, 0))
        rank = rank.copy()
        rank[active[order]] = old + (fresh - bucket)
        levels.append(rank)
        length *= 2
        count = np.bincount(rank[active], minlength=size)
        active = active[count[rank[active]] > 1]
    return levels


def common_prefixes(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Symbols that the suffixes at ``a`` and ``b`` share at their beginnings."""
    shared, last = np.zeros(len(a), np.int64), len(levels[0]) - 1
    for k in range(len(levels) - 1, -1, -1):
        left, right = a + shared, b + shared
        inside = (left <= last) & (right <= last)
        shared += (inside & (levels[k][np.minimum(left, last)] == levels[k][np.minimum(right, last)])).astype(np.int64) << k
    return shared


def kruskal(a: list[int], b: list[int], lcp: list[int]) -> list[tuple[int, int, int]]:
    """(position, period, LCP) of newly neighbouring positions whose distance is
    within their LCP as far as a run's length asks.  ``a``, ``b``: neighbours in
    suffix order, by descending LCP."""
    owner: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    seeds = []

    def find(x: int) -> int:
        root = x
        while (up := owner.get(root, root)) != root:
            root = up
        while x != root:
            owner[x], x = root, owner.get(x, x)
        return root

    for x, y, shared in zip(a, b, lcp):
        x, y = find(x), find(y)
        large, small = members.pop(x, None) or [x], members.pop(y, None) or [y]
        if len(large) < len(small):
            x, y, large, small = y, x, small, large
        owner[y] = x
        members[x] = large
        widest = min(shared // (MIN_EXPONENT - 1), shared)  # q + l >= 4 q
        if shared < MIN_LENGTH - 1:
            widest = 0
        at = 0
        for k, p in enumerate(small):
            at = bisect_left(large, p, at)
            # A neighbour out of the same class became one before, at a longer prefix.
            if at and large[at - 1] != (small[k - 1] if k else -1) and p - large[at - 1] <= widest:
                seeds.append((large[at - 1], p - large[at - 1], shared))
            if at < len(large) and (k + 1 == len(small) or large[at] < small[k + 1]) and large[at] - p <= widest:
                seeds.append((p, large[at] - p, shared))
            large.insert(at, p)
            at += 1
    return [s for s in seeds if s[1] + s[2] >= MIN_LENGTH]


def runs_of(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and period of all runs in the words of several documents
    (``doc``: ascending number of each word's), by start, then period."""
    none = (np.empty(0, np.int64),) * 3
    if len(words) <= LEAST:
        return none
    own = words ^ mix(doc.astype(np.uint64) + np.uint64(1))
    within = doc[:1 - LEAST] == doc[LEAST - 1:]
    starts = np.flatnonzero(within)
    at = starts[recurring(gram_hashes(own, LEAST)[within])]
    if not len(at):
        return none
    # Stretches of recurring positions, with the words up to the first group that doesn't recur.
    first = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    low, high = at[first], at[np.append(first[1:], len(at)) - 1] + LEAST + 1
    doc_end = np.searchsorted(doc, doc[low], "right")
    size = np.minimum(high, doc_end) - low + 1  # and a mark
    bound = np.cumsum(size)
    word = np.repeat(low - (bound - size), size) + np.arange(bound[-1])
    symbol = np.empty(bound[-1], np.int64)
    mark = np.zeros(bound[-1], bool)
    mark[bound - 1] = True
    known = np.unique(own[word[~mark]], return_inverse=True)[1]
    symbol[~mark] = known
    symbol[mark] = known.max() + 1 + np.arange(len(low))
    levels = suffix_ranks(symbol)
    core = np.repeat(bound - size, np.diff(first, append=len(at))) + at - np.repeat(low, np.diff(first, append=len(at)))
    core = core[np.argsort(levels[-1][core], kind="stable")]
    left, right = core[:-1], core[1:]
    shared = common_prefixes(levels, left, right)
    edge = np.flatnonzero(shared >= LEAST)
    edge = edge[np.argsort(-shared[edge], kind="stable")]
    seeds = kruskal(word[left[edge]].tolist(), word[right[edge]].tolist(), shared[edge].tolist())
    if not seeds:
        return none
    start, period, lcp = np.array(seeds, np.int64).T
    before = np.maximum(start - 1, 0)
    inside = (start > 0) & (doc[before] == doc[start]) & (own[before] == own[before + period])
    start, period, lcp = start[~inside], period[~inside], lcp[~inside]
    order = np.lexsort((period, start))
    return start[order], (period + lcp)[order], period[order]


def kept_words(start: np.ndarray, length: np.ndarray, period: np.ndarray, size: int) -> np.ndarray:
    """Mark the words that no run contains after its first period."""
    edge = np.bincount(start + period, minlength=size + 1) - np.bincount(start + length, minlength=size + 1)
    return np.cumsum(edge[:size]) == 0


def find_runs(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, runs array<struct<start, length, period>> by start, then
    period, collapsed: the words no run contains after its first period, joined
    by a space."""
    kind = dict(docs.dtypes)["doc_id"]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            texts = [x or b"" for x in utf8_column(batch, "text")]
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size < CHUNK):
                    size += len(texts[high]) + 1
                    high += 1
                some = texts[low:high]
                whole = b" ".join(some)
                begin, end = hasher.bounds(whole) if whole else (np.empty(0, np.int64),) * 2
                words = hasher.pieces(whole, begin, end) if len(begin) else np.empty(0, np.uint64)
                text_end = np.cumsum([len(x) + 1 for x in some])
                first = np.searchsorted(begin, np.concatenate([[0], text_end]))
                count = np.diff(first)
                start, length, period = runs_of(words, np.repeat(np.arange(len(some)), count))
                kept = kept_words(start, length, period, len(words))
                of = np.searchsorted(start, first)
                collapsed = []
                for k, text in enumerate(some):
                    own = text.split()
                    if of[k] < of[k + 1]:
                        own = [w for w, keep in zip(own, kept[first[k]:first[k + 1]].tolist()) if keep]
                    collapsed.append(b" ".join(own))
                start = start - np.repeat(first[:-1], np.diff(of))
                found = pa.ListArray.from_arrays(pa.array(of, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(x, pa.int64()) for x in (start, length, period)], fields=list(run)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(count, pa.int64()), found,
                     pa.array(collapsed, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "runs", "collapsed"])
                low = high

    return docs.select("doc_id", "text").mapInArrow(
        search, f"doc_id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def with_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with seeded repetitions: with h the crc32 of doc_id and g = h / 10,
    of a document of n words with h % 10 = 0 each word i >= a = g % n becomes word
    a + (i - a) % p, p = 1 + (n - a) / (3 + g % 8).  A null doc_id is left alone."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.flatten(F.array_repeat(F.slice(w, a.cast("int") + 1, p.cast("int")), F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.concat(F.slice(w, 1, a.cast("int")), F.slice(tail, 1, (n - a).cast("int"))), " ")

    # Bound by a lambda, so that a text is split once; texts of other documents are not split.
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    once = F.get(F.transform(F.array(words), repeated), 0)
    text = F.when((h % 10 == 0) & F.col("text").rlike(WORD_PATTERN), once).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def runs_digest(runs: DataFrame) -> DataFrame:
    """``find_runs``' rows as counts, the run of greatest exact exponent, and hashes."""
    better = lambda x, best: best.isNull() | (x.length * best.period > best.length * x.period)
    top = F.reduce("runs", F.lit(None).cast("struct<start:long,length:long,period:long>"),
                   lambda best, x: F.when(better(x, best), x).otherwise(best))  # in order of start, then period
    lines = F.transform("runs", lambda x: F.concat_ws(",", *[x[c].cast("string") for c in ("start", "length", "period")]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return (runs.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"),
                        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
            .select("doc_id", "n_runs", "top.start", "top.length", "top.period",
                    F.floor(F.lit(1000) * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
                    "runs_sha256", "collapsed_sha256"))
