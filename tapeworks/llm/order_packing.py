"""Order-preserving packing: window cuts by dynamic programming.

Documents keep their order.  Their tokens, an end id behind each document, form
one stream per task, which is cut into sequences of at most ``SEQUENCE`` tokens.
A sequence is padded to ``SEQUENCE``, except where its length is a power of two.

*Cuts.*  A cut may stand behind a document (free), behind a sentence (a penalty
of ``SENTENCE_CUT`` tokens) or, in a stretch without sentence ends, behind every
``STRIDE`` tokens (``TRUNCATION``).  With p(j) the place of cut j, the least cost
up to it is

    f(j) = penalty(j) + PER_SEQUENCE + min of
           f(i) + SEQUENCE - (p(j) - p(i))   for p(j) - SEQUENCE <= p(i) < p(j)
           f(i)                              where p(j) - p(i) is a power of two

The first minimum is that of f(i) + p(i) over a sliding window: a monotone queue
gives it in constant time.  ``PER_SEQUENCE`` prefers the longer of equal sequences.

*Stream.*  Blocks of ``BLOCK`` tokens are planned one after another.  All of a
block but its last, unfinished sequence is written; that one's tokens begin the
next block, so a task pads at most its last sequence more than it must.  A task
works on its own part of the table: nothing is shuffled, no key can be hot, and
memory is that of a block of tokens and of one text.

Nulls and edge cases: a null or empty text is its end id alone.  A null doc_id
is kept.  Repeated rows are packed each by itself.  A very long text is cut like
any other.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.packing import WordEncoder, kept_encoder
from tapeworks.llm.text import utf8_column

SEQUENCE = 4096
END_ID = 2
SENTENCE_CUT = 4
TRUNCATION = 64
PER_SEQUENCE = 1
STRIDE = 32
BLOCK = 1_000_000
CHUNK = 2_000_000


def sentence_ends(encoder: WordEncoder) -> np.ndarray:
    """For every id, whether it ends a sentence: a token of punctuation with a stop."""
    tokens = encoder.tokenizer.get_vocab()
    ends = np.zeros(max(tokens.values()) + 1, bool)
    for token, number in tokens.items():
        text = token.removesuffix("</w>")
        ends[number] = any(c in ".!?" for c in text) and not any(c.isalnum() or c in "<|" for c in text)
    return ends


def candidate_cuts(ids: np.ndarray, bounds: np.ndarray, ends: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Places of possible cuts, from 0 to the end, and their penalties.  ``bounds``:
    where documents end."""
    penalty = np.full(len(ids) + 1, np.inf)
    penalty[1:][ends[ids]] = SENTENCE_CUT
    penalty[bounds] = 0
    penalty[0] = 0
    place = np.flatnonzero(penalty < np.inf)
    gap = np.diff(place)
    wide = np.flatnonzero(gap > stride)
    count = (gap[wide] - 1) // stride
    inner = np.repeat(place[wide], count) + stride * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + 1)
    penalty[inner] = TRUNCATION
    place = np.flatnonzero(penalty < np.inf)
    return place, penalty[place]


def plan(place: np.ndarray, penalty: np.ndarray, capacity: int) -> tuple[list[float], list[int]]:
    """Least cost up to each cut, and the cut before it."""
    near, far = [], []  # pairs of cuts a power of two apart
    length = 1
    while length <= capacity:
        at = np.searchsorted(place, place - length)
        hit = np.flatnonzero((place >= length) & (place[at] == place - length))
        near.append(hit)
        far.append(at[hit])
        length *= 2
    near, far = np.concatenate(near), np.concatenate(far)
    order = np.argsort(near, kind="stable")
    first = np.searchsorted(near[order], np.arange(len(place) + 1)).tolist()
    far, where, extra = far[order].tolist(), place.tolist(), (penalty + PER_SEQUENCE).tolist()
    cost, before = [0.0] * len(where), [0] * len(where)
    queue, keys, head = [0], [0.0], 0  # cuts with ascending f(i) + p(i)
    for j in range(1, len(where)):
        p = where[j]
        low = p - capacity
        while where[queue[head]] < low:
            head += 1
        source, best = queue[head], keys[head] + capacity - p
        for i in far[first[j]:first[j + 1]]:
            if cost[i] < best:
                source, best = i, cost[i]
        cost[j], before[j] = best + extra[j], source
        key = cost[j] + p
        while len(keys) > head and keys[-1] >= key:
            keys.pop()
            queue.pop()
        keys.append(key)
        queue.append(j)
    return cost, before


def chosen_cuts(place: np.ndarray, penalty: np.ndarray, capacity: int, last: bool) -> np.ndarray:
    """The cheapest cuts, from 0 to the end or, unless this is the ``last`` block,
    to the best place to stop within a sequence of it."""
    cost, before = plan(place, penalty, capacity)
    at = len(place) - 1
    if not last:
        open_ = int(np.searchsorted(place, place[-1] - capacity, "right"))
        at = open_ + int(np.argmin(cost[open_:]))
    cuts = [at]
    while cuts[-1]:
        cuts.append(before[cuts[-1]])
    return place[cuts[::-1]]


class Stream:
    """Documents on their way into sequences: (id, tokens, tokens already written)."""

    def __init__(self, ends: np.ndarray, capacity: int):
        self.ends, self.capacity = ends, capacity
        self.docs: list[tuple[object, np.ndarray, int]] = []
        self.waiting = self.sequences = 0

    def add(self, doc_id: object, ids: np.ndarray) -> None:
        self.docs.append((doc_id, ids, 0))
        self.waiting += len(ids)

    def take(self, last: bool) -> Iterator[tuple]:
        """Rows of the sequences that are ready."""
        if not self.docs:
            return
        left = [ids[done:] for _, ids, done in self.docs]
        bounds = np.cumsum([len(x) for x in left])
        ids = np.concatenate(left)
        place, penalty = candidate_cuts(ids, bounds, self.ends)
        cuts = chosen_cuts(place, penalty, self.capacity, last)
        edges = np.union1d(cuts, bounds[bounds <= cuts[-1]])
        of = np.searchsorted(bounds, edges[:-1], "right").tolist()
        window = np.searchsorted(cuts, edges[:-1], "right") - 1
        begin = (bounds - [len(x) for x in left]).tolist()
        for low, high, doc, k, offset in zip(edges[:-1].tolist(), edges[1:].tolist(), of, window.tolist(), (edges[:-1] - cuts[window]).tolist()):
            doc_id, own, done = self.docs[doc]
            yield (doc_id, done + low - begin[doc], high - low, zlib.crc32(ids[low:high].tobytes()), len(own), self.sequences + k, offset)
        self.sequences += len(cuts) - 1
        first = int(np.searchsorted(bounds, cuts[-1], "right"))
        kept = [(d, own, done + max(0, int(cuts[-1]) - begin[k])) for k, (d, own, done) in enumerate(self.docs[first:], first)]
        self.docs, self.waiting = kept, int(bounds[-1] - cuts[-1])


def pack_in_order(docs: DataFrame, vocabulary: str, capacity: int = SEQUENCE, end_id: int = END_ID, block: int = BLOCK) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row
    per piece of a document in a sequence."""
    kind = dict(docs.dtypes)["doc_id"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(vocabulary)
        stream = Stream(sentence_ends(encoder), capacity)
        schema = base = None

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            own = list(zip(*rows)) if rows else [()] * len(schema)
            own[5] = [base + k for k in own[5]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(own, schema)], schema=schema)

        for batch in batches:
            if schema is None and batch.num_rows:
                base = batch.column("task")[0].as_py() << 40
                schema = pa.schema([batch.schema.field("doc_id"), *((c, pa.int64()) for c in (
                    "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"))])
            texts, doc_ids = utf8_column(batch, "text"), batch.column("doc_id").to_pylist()
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size < CHUNK):
                    size += len(texts[high] or b"")
                    high += 1
                for doc_id, ids in zip(doc_ids[low:high], encoder.encode(texts[low:high])):
                    stream.add(doc_id, np.append(ids, np.uint32(end_id)).astype("<u4"))
                if stream.waiting >= block:
                    yield batch_of(list(stream.take(last=False)))
                low = high
        if schema is not None:
            yield batch_of(list(stream.take(last=True)))

    return docs.select("doc_id", "text", F.spark_partition_id().cast("long").alias("task")).mapInArrow(
        pack, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
