"""Best-fit packing of tokenised documents by the sum-of-squares rule.

1. *Pieces.*  A document is its token ids and one end id.  Only a document
   longer than a sequence is cut, into pieces of a whole sequence; the last
   piece may be shorter.
2. *Groups.*  Pieces are spread by hash over groups of about
   ``PIECES_PER_GROUP``, as many as the corpus needs.
3. *Packing.*  In a group, from the longest piece to the shortest, each piece
   goes where the sum of the squared counts of open sequences per residual gap
   becomes smallest: into an open sequence of some gap, or into a new one.
   Among equal choices the smaller gap wins.  With g the gap chosen and s the
   piece, only the counts N(g) and N(g - s) change, so the best gap is the one
   with the smallest N(g - s) - N(g) (a full sequence has no count).

The first pass reads each text once; after that only rows of a few numbers
move.  Words are encoded once per task and remembered (``WordEncoder``; a test
compares it with the tokenizer's ids of whole texts).

Nulls and edge cases: a null or empty text is one piece with the end id only.
A null doc_id is kept.  Repeated rows are packed each by itself.  An empty
table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import sys
import types
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.shared import spread, stored
from tapeworks.llm.text import WordHasher, utf8_column

SEQUENCE = 4096
END_ID = 1
PIECES_PER_GROUP = 20_000
REMEMBERED_PARTS = 1_500_000
SLOT_BITS = 22
CHUNK = 2_000_000


class WordEncoder:
    """Token ids of texts by way of their parts, each encoded once.

    The vocabulary ignores case, drops white space and keeps letters and
    punctuation apart, so a text is cut at white space and between an ASCII
    letter and a stop, and its parts are encoded independently.  Parts are found
    and numbered by 64-bit hashes, many texts at once.  A new part of ASCII
    letters goes to the tokenizer's model as it is; all others go through the
    whole tokenizer, many at a time with a separator between them that is a word
    of one token.
    """

    SEPARATOR = "0"
    SPACES = b" \t\n\x0b\x0c\r"
    STOPS = b".,;:!?"
    SPECIAL = b"<|"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.hasher = WordHasher()
        kind = np.zeros(256, np.int8)
        kind[list(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")] = 3
        kind[list(self.STOPS)], kind[list(self.SPACES)] = 1, 2
        self.kind = kind
        (self.mark,) = self.ids([self.SEPARATOR])[0]
        self.forget()

    def forget(self) -> None:
        self.known = np.zeros(1, np.uint64)  # hashes of the parts; number 0 stands for none
        self.first, self.size = np.zeros(1, np.int32), np.zeros(1, np.int32)  # their places in tokens
        self.tokens = np.empty(0, np.uint32)
        self.deal(SLOT_BITS)

    def deal(self, bits: int) -> None:
        """A table of part numbers by hash, 2**bits slots, open addressing."""
        self.bits, self.slots = bits, np.zeros(1 << bits, np.int32)
        self.enter(np.arange(1, len(self.known)))

    def enter(self, numbers: np.ndarray) -> None:
        """Give each of these parts a free slot."""
        slot = (self.known[numbers] >> np.uint64(64 - self.bits)).astype(np.int64)
        while len(numbers):
            free = self.slots[slot] == 0
            self.slots[slot[free]] = numbers[free]
            rest = self.slots[slot] != numbers
            numbers, slot = numbers[rest], (slot[rest] + 1) & (len(self.slots) - 1)

    def numbers(self, part: np.ndarray) -> np.ndarray:
        """The number of each part hash, 0 where it is not known."""
        slot = (part >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.slots[slot]
        other = np.flatnonzero((found > 0) & (self.known[found] != part))
        while len(other):
            slot[other] = (slot[other] + 1) & (len(self.slots) - 1)
            found[other] = self.slots[slot[other]]
            other = other[(found[other] > 0) & (self.known[found[other]] != part[other])]
        return found

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def parts_ids(self, parts: list[bytes]) -> list[list[int]]:
        """Ids of each part."""
        own, model, out = self.SEPARATOR.encode(), self.tokenizer.model, [None] * len(parts)
        joined = []
        for k, x in enumerate(parts):
            if x.isalpha() and x.islower():  # of bytes: ASCII letters only
                out[k] = [t.id for t in model.tokenize(x.decode())]
            elif own in x:
                out[k] = self.ids([x.decode("utf-8", "replace")])[0]
            else:
                joined.append(k)
        between = f" {self.SEPARATOR} "
        for low in range(0, len(joined), 1000):
            some = joined[low:low + 1000]
            ids = self.ids([between.join(parts[k].decode("utf-8", "replace") for k in some)])[0]
            ends = [*np.flatnonzero(np.array(ids) == self.mark).tolist(), len(ids)]
            if len(ends) != len(some):
                raise ValueError("a part's ids contain the separator's")
            start = 0
            for k, end in zip(some, ends):
                out[k] = ids[start:end]
                start = end + 1
        return out

    def encode(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Ids of each text."""
        texts = [x if self.SPECIAL in x else x.lower() for x in (x or b"" for x in texts)]
        whole = b" ".join(texts)
        if not whole:
            return [np.empty(0, np.uint32)] * len(texts)
        kind = self.kind[np.frombuffer(whole, np.uint8)]
        before = np.concatenate([[2], kind[:-1]])
        inside = kind != 2
        starts = np.flatnonzero(inside & ((before == 2) | (before == 3) & (kind == 1)))
        # A part ends where the next starts or a space follows.
        space = np.flatnonzero(np.concatenate([~inside & (before != 2), [kind[-1] != 2]]))
        ends = np.empty(len(starts), np.int64)
        if len(starts):
            ends[:-1] = starts[1:]
            ends[-1] = len(whole)
            ends = np.minimum(ends, space[np.searchsorted(space, starts, "right")])
        part = self.hasher.pieces(whole, starts, ends)
        if len(self.known) > REMEMBERED_PARTS:
            self.forget()
        at = self.numbers(part)
        missing = np.flatnonzero(at == 0)
        if len(missing):
            fresh, index = np.unique(part[missing], return_index=True)
            index = missing[index]
            found = self.parts_ids([whole[a:b] for a, b in zip(starts[index].tolist(), ends[index].tolist())])
            size = np.fromiter(map(len, found), np.int32, len(found))
            first = (len(self.tokens) + np.cumsum(size) - size).astype(np.int32)
            self.tokens = np.concatenate([self.tokens, np.fromiter(chain.from_iterable(found), np.uint32, int(size.sum()))])
            low = len(self.known)
            self.known, self.first, self.size = (np.concatenate(x) for x in (
                (self.known, fresh), (self.first, first), (self.size, size)))
            if 2 * len(self.known) > len(self.slots):
                self.deal(int(2 * len(self.known)).bit_length())
            else:
                self.enter(np.arange(low, len(self.known)))
            at[missing] = self.numbers(part[missing])
        first, size = self.first[at], self.size[at]
        total = np.cumsum(size, dtype=np.int64)
        ids = self.tokens[np.repeat(first - (total - size), size) + np.arange(total[-1] if len(total) else 0)]
        text_ends = np.cumsum([len(x) + 1 for x in texts])
        cuts = np.concatenate([[0], total])[np.searchsorted(starts, text_ends)]
        return np.split(ids, cuts[:-1])


def kept_encoder(vocabulary: str) -> WordEncoder:
    """The encoder of this Python worker.  It lives as long as the worker, so that
    parts are encoded once per worker and not once per task."""
    kept = sys.modules.setdefault("_tapeworks_encoders", types.ModuleType("_tapeworks_encoders")).__dict__
    if vocabulary not in kept:
        kept[vocabulary] = WordEncoder(vocabulary)
    return kept[vocabulary]


def pieces(docs: DataFrame, vocabulary: str, length: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: one row per piece."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_encoder(vocabulary)
        for batch in batches:
            source, found = [], []
            texts = utf8_column(batch, "text")
            low = 0
            while low < len(texts):
                high, size = low, 0
                while high < len(texts) and (high == low or size < CHUNK):
                    size += len(texts[high] or b"")
                    high += 1
                for row, ids in enumerate(encoder.encode(texts[low:high]), low):
                    ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), length)):
                        own = ids[start:start + length]
                        source.append(row)
                        found.append((k, start, len(own), zlib.crc32(own.tobytes())))
                low = high
            k, start, size, crc = zip(*found) if found else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(source, pa.int64())), pa.array(k, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(crc, pa.int64())],
                ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(
        encode, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack_lengths(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of each piece, in the order given.

    With N(g) open sequences of gap g, a piece of s put into gap g changes the
    sum of squares by 2 (N(g - s) - N(g) + 1), into a gap of its own size by
    1 - 2 N(s), into a new sequence by 2 N(capacity - s) + 1.
    """
    count = np.zeros(capacity + 1, np.int64)  # gap 0 (full) is never counted
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    made, never = 0, np.iinfo(np.int64).max
    for k, s in enumerate(sizes.tolist()):
        here, left = count[s:], count[: capacity + 1 - s]
        change = np.where(here > 0, 2 * (left - here + 1), never)
        if here[0] > 0:
            change[0] = 1 - 2 * here[0]
        best = int(change.argmin())
        new = 2 * int(left[-1]) + 1 if s < capacity else 0
        if change[best] <= new:
            gap = s + best
            at = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, at = capacity, made
            made += 1
        sequence[k], offset[k] = at, capacity - gap
        if gap > s:
            open_at[gap - s].append(at)
            count[gap - s] += 1
    return sequence, offset


def pack(docs: DataFrame, vocabulary: str, capacity: int = SEQUENCE, end_id: int = END_ID,
         per_group: int = PIECES_PER_GROUP) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    rows = stored(pieces(docs, vocabulary, capacity, end_id), "pieces")
    groups = spread(rows.count(), per_group)

    def place(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("piece", "ascending"),
                               ("ids_crc32", "ascending")])
        sequence, offset = pack_lengths(table.column("length").to_numpy(), capacity)
        return (table.drop_columns(["group"])
                .append_column("sequence_id", pa.array(sequence + (key[0].as_py() << 32)))
                .append_column("offset", pa.array(offset)))

    group = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)).alias("group")
    kind = dict(docs.dtypes)["doc_id"]
    return rows.select("*", group).groupBy("group").applyInArrow(
        place, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
