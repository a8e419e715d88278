"""Language-model scoring with a probabilistic suffix tree (PST) over words.

Documents whose crc32(doc_id as text) mod 10 is not 0 train, all are scored.  A
text is lower-cased (A to Z); its tokens are its words and one end token.  A
start stands before the first token, as a context only.

*Root.*  With c training occurrences of a token, N of all, V distinct ones:
(c + 0.1) / (N + 0.1 (V + 1)), all tokens never seen being one event.  The base
score uses the root alone.

*Contexts* are the 1 to ``DEPTH`` tokens before a token, any words.  A symbol is
listed after a context if it follows it at least ``MIN_COUNT`` times in training,
a fixed number, so the tree grows with the corpus.  A context is retained if
its listed symbols, and all others as one event, diverge from what its suffix
gives them: count times Kullback-Leibler divergence of at least ``MIN_GAIN`` nats
plus one for every listed symbol; with it all its suffixes are retained.

*Smoothing* (absolute discounting).  After a context with n occurrences a listed
symbol seen m times has the probability (m - d + r P) / n, any other r P / n: d
is ``DISCOUNT``, P the probability after the context's suffix, r what the listed
m - d leave of n.  Probabilities sum to 1 in every state.  A token is scored in
the state of the longest retained suffix of the tokens before it.

*How it is counted.*  All counts are over all training documents and exact.
1. Words are counted by 64-bit hash.
2. No gram occurs more often than a shorter one inside it.  Words with
   ``MIN_COUNT`` mark their cells of 2^``CELL_BITS``; pairs of marked words are
   counted by their 64-bit keys, and those with ``MIN_COUNT`` mark theirs; then
   triples of marked pairs, then grams of four of marked triples.
   The bits (16 MB whatever the corpus) save shuffle alone; what a cell lets
   through is counted exactly.
   Most of these grams are rare still.  A task sends them by ranges of keys, a
   range's sorted keys, tags and counts in one value, byte by byte: the equal bytes
   at the front of keys and counts are compressed.  Tasks add up range after range;
   rows of single grams are made of the frequent ones alone.
   With a key goes a tag, 32 bits of its suffix's key, rather than the keys of
   context and suffix: the hash can be undone, so key and suffix give the
   context.  Of the shorter grams with the tag the suffix is the one whose
   context is a frequent gram too (by 64 bits, as all keys are compared).
3. Retention and probabilities are joins of the gram table with itself.  The
   score telescopes: every listed gram has one number, what it adds to the
   state without it, and every retained context what an unlisted symbol loses,
   so a text's gain is the sum of the numbers of the grams in it.
4. Grams of the texts meet that table in a shuffled join, added up per text.

Nothing that grows with the corpus is broadcast: the most frequent words and
grams, 1 / ``COMMON_SHARE`` of each order and all with a share of ``COMMON_SHARE``
of the tokens (again at most as many), are looked up in the task, so no hot gram
is shuffled; all others go through the join of step 4.  The bits of step 4 mark
the cells of either kind.

Nulls and edge cases: a null text is empty: one token, the end.  A null doc_id
counts as the empty id (crc32 0, held out).  Without training documents all
counts are 0 and the root is all there is; an empty table gives no rows.
Repeated rows are counted and scored each by itself; rows of one text (told by
64-bit hash) share its sums.  Ties can't matter: nothing is ranked.  Very long
texts are one row each, hashed whole with a few arrays of 8 bytes a word.  Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.shared import runs, stored
from tapeworks.llm.text import MIX_FACTORS, WordHasher, mix, utf8_column

DEPTH = 3
GRAMS = tuple(range(2, DEPTH + 2))
MIN_COUNT = 16
DISCOUNT = 0.75
MIN_GAIN = 10.0
COMMON_SHARE = 2e-6
CELL_BITS = 27
BLOCK_BITS = 16
RANGE_BITS = 11  # ranges of keys, more for many tokens
RANGE_TOKENS = 1 << 22
CHUNK = 4_000_000
HELD = 600_000  # grams that a task adds up before it sends them
START, END = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)
TAG = np.uint64(0xFFFFFFFF)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def with_fold(docs: DataFrame) -> DataFrame:
    """doc_id, text, held_out."""
    fold = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 10
    return docs.select("doc_id", "text", (fold == 0).alias("held_out"))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches of about ``CHUNK`` bytes, with their texts in lower
    case."""
    for batch in batches:
        texts = utf8_column(batch, "text")
        low = 0
        while low < len(texts):
            high, size = low, 0
            while high < len(texts) and (high == low or size < CHUNK):
                size += len(texts[high] or b"")
                high += 1
            yield batch.slice(low, high - low), [(x or b"").lower() for x in texts[low:high]]
            low = high


def _send(**columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    size = len(next(iter(columns.values())))
    for k in range(0, size, 100_000):
        part = {c: pa.array(v[k:k + 100_000]) for c, v in columns.items()}
        yield pa.RecordBatch.from_arrays(list(part.values()), list(part))


def word_counts(training: DataFrame) -> DataFrame:
    """(word, n): occurrences by 64-bit hash, added up per chunk first."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for _, texts in chunks(batches):
            word, n = np.unique(np.concatenate([hasher(x) for x in texts]), return_counts=True)
            yield from _send(word=word.view(np.int64), n=n.astype(np.int64))

    return (training.select("text").mapInArrow(count, "word long, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def token_stream(words: list[np.ndarray]) -> np.ndarray:
    """Texts (word hashes) one after another, each after a start and before an end."""
    size = np.array([len(w) for w in words])
    out = np.empty(size.sum() + 2 * len(words), np.uint64)
    end = np.cumsum(size + 2) - 1
    inner = np.ones(len(out), bool)
    inner[end] = inner[end - size - 1] = False
    out[inner] = np.concatenate(words)
    out[end], out[end - size - 1] = END, START
    return out


def gram_keys(context: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """A gram's key, from those of the gram without its last and its first token."""
    return mix(context * _STEP + suffix)


def contexts_of(key: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """The context for which ``gram_keys(context, suffix)`` is the key."""
    h = key ^ (key >> np.uint64(33))
    for factor in MIX_FACTORS[::-1]:
        h = h * np.uint64(pow(factor, -1, 2**64))
        h ^= h >> np.uint64(33)
    return (h - suffix) * np.uint64(pow(int(_STEP), -1, 2**64))


def grams(stream: np.ndarray, bits: np.ndarray | None = None, orders: tuple[int, ...] = (), longest: int = DEPTH + 1,
          chained: bool = True) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(k, places, key, context, suffix) of the k-grams of 2 to ``longest`` tokens
    that lie within a text: the place of the last token; the keys of the gram,
    of the gram without its last token and without its first one.

    Of the ``orders`` only grams (1: tokens) in cells set in ``bits``; if
    ``chained``, only grams whose context and suffix are let through as well."""
    inside, key = stream != START, stream
    lies = np.ones(len(stream), bool)
    let = marked(bits, stream) if 1 in orders else lies
    for k in range(2, longest + 1):
        shorter, before = key, let
        key = np.zeros(len(stream), np.uint64)
        key[1:] = gram_keys(shorter[:-1], shorter[1:])
        lies = inside & np.concatenate([[False], lies[:-1]])
        at = np.flatnonzero(lies & before & np.concatenate([[False], before[:-1]]) if chained else lies)
        if k in orders:
            at = at[marked(bits, key[at])]
        let = np.zeros(len(stream), bool)
        let[at] = True
        yield k, at, key[at], shorter[at - 1], shorter[at]


def marked(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    cell = keys >> np.uint64(64 - CELL_BITS)
    return (bits[cell >> np.uint64(3)] >> (cell & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _cells(keys: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The cells of keys by block, as places within the block."""
    cell = np.unique((keys >> np.uint64(64 - CELL_BITS)).astype(np.int64))
    if not len(cell):
        return
    cut, low = runs(cell >> BLOCK_BITS), cell.astype(np.uint16)
    yield pa.RecordBatch.from_arrays(
        [pa.array(cell[cut[:-1]] >> BLOCK_BITS, pa.int32()),
         pa.array([low[a:b].tobytes() for a, b in zip(cut, cut[1:])], pa.binary())], ["block", "low"])


def cell_bits(table: DataFrame) -> np.ndarray:
    """A bit per cell, packed: whether a ``key`` of the table lies in it.  Blocks
    of cells are put together in tasks; 16 MB of bits come back, whatever the
    number of keys."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, low in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                packed = found.setdefault(block, np.zeros(1 << (BLOCK_BITS - 3), np.uint8))
                low = np.frombuffer(low, np.uint16)
                np.bitwise_or.at(packed, low >> 3, np.left_shift(np.uint8(1), (low & 7).astype(np.uint8)))
        for block, packed in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([packed.tobytes()], pa.binary())], ["block", "bits"])

    out = np.zeros((1 << (CELL_BITS - BLOCK_BITS), 1 << (BLOCK_BITS - 3)), np.uint8)
    blocks = key_cells(table).repartition("block").mapInArrow(add, "block int, bits binary").toArrow()
    for block, packed in zip(blocks.column(0).to_pylist(), blocks.column(1).to_pylist()):
        out[block] = np.frombuffer(packed, np.uint8)
    return out.reshape(-1)


def range_bits(tokens: int) -> int:
    """Key ranges are 2^this many, about ``RANGE_TOKENS`` tokens each, if not fewer."""
    return max(RANGE_BITS, (tokens // RANGE_TOKENS).bit_length())


def packed_counts(key: np.ndarray, tag: np.ndarray, m: np.ndarray, bits: int) -> Iterator[pa.RecordBatch]:
    """(range, grams): sorted distinct keys with tags and counts by the first ``bits``
    bits of the key, as 15 rows of bytes: the last 7 of the key, 4 of tag and count."""
    if not len(key):
        return
    own = (key >> np.uint64(64 - bits)).astype(np.int32)
    table = np.hstack([key.view(np.uint8).reshape(-1, 8)[:, :7],
                       *(x.astype(np.uint32).view(np.uint8).reshape(-1, 4) for x in (tag, m))])
    cut = runs(own)
    for k in range(0, len(cut) - 1, 1000):
        part = cut[k:k + 1001]
        yield pa.RecordBatch.from_arrays(
            [pa.array(own[part[:-1]]), pa.array([table[a:b].T.tobytes() for a, b in zip(part, part[1:])], pa.binary())], ["range", "grams"])


def unpacked_counts(own: int, values: list[bytes], bits: int) -> list[np.ndarray]:
    """Keys, tags and counts of values of ``packed_counts`` of one range."""
    table = np.concatenate([np.frombuffer(x, np.uint8).reshape(15, -1).T for x in values])
    key = np.full((len(table), 8), own >> (bits - 8), np.uint8)
    key[:, :7] = table[:, :7]
    tag, m = (np.ascontiguousarray(table[:, a:a + 4]).view(np.uint32).ravel().astype(np.uint64) for a in (7, 11))
    return [key.view(np.uint64).ravel(), tag, m.astype(np.int64)]


def frequent_counts(packed: DataFrame, bits: int) -> DataFrame:
    """(key, tag, m) of ``MIN_COUNT`` occurrences or more.  A task adds up one range
    after another, batch by batch."""
    def send(key: np.ndarray, tag: np.ndarray, m: np.ndarray) -> Iterator[pa.RecordBatch]:
        many = m >= MIN_COUNT
        yield from _send(key=key[many].view(np.int64), tag=tag[many].view(np.int64), m=m[many])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held = None, None
        for batch in batches:
            each = batch.column(0).to_numpy()
            cut = runs(each)
            for a, b in zip(cut, cut[1:]):
                if held and own != each[a]:
                    yield from send(*held)
                    held = None
                own = int(each[a])
                more = unpacked_counts(own, batch.column(1)[a:b].to_pylist(), bits)
                held = _added([list(c) for c in zip(held, more)] if held else [[c] for c in more])
        if held:
            yield from send(*held)

    return packed.repartition("range").sortWithinPartitions("range").mapInArrow(add, "key long, tag long, m long")


def gram_counts(training: DataFrame, order: int, bits: np.ndarray, ranges: int) -> DataFrame:
    """(range, grams): counts of the grams of ``order`` tokens whose shorter ones the
    bits let through, added up per task first, ``HELD`` grams at a time."""
    shared = training.sparkSession.sparkContext.broadcast(bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = WordHasher(), None
        for _, texts in chunks(batches):
            *_, (_, _, key, _, suffix) = grams(token_stream([hasher(x) for x in texts]), shared.value, (order - 1,), order)
            more = key, suffix & TAG, np.ones(len(key), np.int64)
            held = _added([list(c) for c in zip(held, more)] if held else [[c] for c in more])
            if len(held[0]) > HELD:
                yield from packed_counts(*held, ranges)
                held = None
        if held:
            yield from packed_counts(*held, ranges)

    return training.select("text").mapInArrow(count, "range int, grams binary")


def frequent_grams(training: DataFrame, order: int, bits: np.ndarray, shorter: DataFrame, ranges: int) -> DataFrame:
    """(key, k, context, suffix, m): grams of ``order`` tokens with ``MIN_COUNT``
    training occurrences.  ``shorter``: the keys of the next shorter grams with as
    many; ``bits`` marks their cells; grams are added up in 2^``ranges`` ranges."""
    def with_context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, suffix = (batch.column(c).to_numpy().view(np.uint64) for c in ("key", "suffix"))
            context = pa.array(contexts_of(key, suffix).view(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, context], [*batch.schema.names, "context"])

    counts = frequent_counts(gram_counts(training, order, bits, ranges), ranges)
    tagged = shorter.select(F.col("key").alias("suffix"), F.col("key").bitwiseAND(F.lit(int(TAG))).alias("tag"))
    return (counts.join(tagged, "tag").select("key", F.lit(order).cast("long").alias("k"), "suffix", "m")
            .mapInArrow(with_context, "key long, k long, suffix long, m long, context long")
            .join(shorter.select(F.col("key").alias("context")), "context", "left_semi")
            .select("key", "k", "context", "suffix", "m"))


def key_cells(table: DataFrame) -> DataFrame:
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _cells(batch.column(0).to_numpy().view(np.uint64))

    return table.select("key").mapInArrow(mark, "block int, low binary")


def _added(held: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Columns with equal keys (first column) added up (last column)."""
    columns = [np.concatenate(c) for c in held]
    order = np.argsort(columns[0])
    key = columns[0][order]
    first = runs(key)[:-1] if len(key) else np.empty(0, np.int64)
    m = columns[-1][order]
    return [key[first], *(c[order[first]] for c in columns[1:-1]), np.add.reduceat(m, first) if len(key) else m]


class SuffixTree:
    """The retained contexts and what they give, as stored tables.

    ``contexts``: (context, length, n, r); ``symbols``: (key, k, context, m, p),
    the listed grams with the probability of their last token; ``gains``: (key, gain,
    m), what every occurrence of a gram adds to a text's log10 probability, and the
    number of its training occurrences.
    """

    def __init__(self, found: DataFrame, words: DataFrame, tokens: int, size: float, min_gain: float):
        # Counts of all grams of one token or more: those of contexts and suffixes.
        single = words.select(F.col("word").alias("key"), F.col("n").alias("m"))
        every = single.unionAll(found.select("key", "m"))
        listed = stored(found.join(every.select(F.col("key").alias("context"), F.col("m").alias("n")), "context"), "listed")
        share = (single.select(F.col("key").alias("suffix"), (F.col("m") / max(tokens, 1)).alias("q"))
                 .unionAll(listed.select(F.col("key").alias("suffix"), (F.col("m") / F.col("n")).alias("q"))))
        lost = F.col("n") - F.col("s")
        rest = F.when(lost > 0, lost * F.log(lost / F.col("n") / F.greatest(1 - F.col("sq"), F.lit(1e-12)))).otherwise(0.0)
        tested = stored(
            listed.join(share, "suffix").groupBy("context")
            .agg((F.first("k") - 1).alias("length"), F.first("n").alias("n"), F.count("*").alias("t"),
                 F.sum("m").alias("s"), F.sum("q").alias("sq"),
                 F.sum(F.col("m") * F.log(F.col("m") / F.col("n") / F.col("q"))).alias("gain"))
            .select("context", "length", "n", (lost + DISCOUNT * F.col("t")).alias("r"),
                    (F.col("gain") + rest >= min_gain + F.col("t")).alias("chosen")), "tested")
        kept, longer = [], None
        for length in range(DEPTH, 0, -1):
            own = tested.where(F.col("chosen") & (F.col("length") == length)).select("context")
            if longer is not None:  # with a context all its suffixes
                own = own.unionAll(longer.join(found, longer["context"] == found["key"])
                                   .select(F.col("suffix").alias("context"))).distinct()
            longer = stored(own, "retained")
            kept.append(longer)
        self.contexts = stored(tested.drop("chosen").join(kept[0].unionAll(kept[1]).unionAll(kept[2]), "context"), "contexts")
        lower = single.select(F.col("key").alias("suffix"), ((F.col("m") + 0.1) / size).alias("low"))
        steps = []
        for k in range(2, DEPTH + 2):
            step = (listed.where(F.col("k") == k).select("key", "k", "context", "suffix", "m")
                    .join(self.contexts.select("context", "n", "r"), "context").join(lower, "suffix")
                    .withColumn("p", (F.col("m") - DISCOUNT + F.col("r") * F.col("low")) / F.col("n")))
            steps.append(stored(step.select("key", "k", "context", "m", "p", (F.log10(F.col("p") / F.col("low"))
                                            - F.log10(F.col("r") / F.col("n"))).alias("gain")), "symbols"))
            lower = steps[-1].select(F.col("key").alias("suffix"), F.col("p").alias("low"))
        self.symbols = steps[0].unionAll(steps[1]).unionAll(steps[2])
        left = self.contexts.select(F.col("context").alias("key"), F.log10(F.col("r") / F.col("n")).alias("gain"),
                                    F.col("n").alias("m"))
        self.gains = stored(self.symbols.select("key", "gain", "m").unionAll(left)
                            .groupBy("key").agg(F.sum("gain").alias("gain"), F.max("m").alias("m")), "gains")


def _sorted(table: DataFrame) -> tuple[np.ndarray, ...]:
    """The columns of a bounded table by the first one, a hash; the last one is a gain (null: 0)."""
    key, *others, gain = (c.to_numpy() for c in table.toArrow().columns)
    key = key.view(np.uint64)
    order = np.argsort(key)
    return key[order], *(c[order] for c in others), np.nan_to_num(gain.astype(float)[order])


def least_count(table: DataFrame, count: str, most: float, enough: float) -> float:
    """The count from which on rows are looked up in tasks: ``enough``, or less if
    ``most`` rows at most have it.  Counts are told apart by 16ths of their octave."""
    levels = table.groupBy(F.floor(F.log2(count) * 16)).agg(F.min(count).alias("least"), F.count("*").alias("rows")).collect()
    rows, least = 0, enough
    for level in sorted(levels, key=lambda x: -x.least):
        rows += level.rows
        if rows > most:
            break
        least = min(least, level.least)
    return least


def score_documents(docs: DataFrame, min_gain: float = MIN_GAIN) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    spark = docs.sparkSession
    folded = with_fold(docs)
    training = folded.where("not held_out")
    words = stored(word_counts(training), "word-counts")
    ends = training.count()
    sums = words.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    n, v = (sums.n or 0) + ends, sums.v + (ends > 0)
    size = n + 0.1 * (v + 1)
    edges = spark.createDataFrame([(int(x.view(np.int64)), ends) for x in (START, END)], "word long, n long")
    tokens = words.unionAll(edges)
    # Only frequent tokens are in listed grams.
    tokens = tokens.where(F.col("n") >= MIN_COUNT)
    shorter, found = tokens.select(F.col("word").alias("key")), []
    for k in GRAMS:
        found.append(stored(frequent_grams(training, k, cell_bits(shorter), shorter, range_bits(n)), f"grams-{k}"))
        shorter = found[-1].select("key")
    tree = SuffixTree(found[0].unionAll(found[1]).unionAll(found[2]), tokens, n, size, min_gain)
    known_words = words.join(tree.gains.select(F.col("key").alias("word"), "gain"), "word", "left")
    gram_gains = stored(tree.gains.join(words.select(F.col("word").alias("key")), "key", "left_anti"), "gram-gains")
    enough = max(1.0, COMMON_SHARE * n)
    least = least_count(words, "n", 1 / COMMON_SHARE, enough)
    hot = F.col("m") >= least_count(gram_gains, "m", len(GRAMS) / COMMON_SHARE, enough)
    # (key, n, gain): words and grams not looked up in the task.
    rare = stored(known_words.where(F.col("n") < least).select(F.col("word").alias("key"), "n", "gain")
                  .unionAll(gram_gains.where(~hot).select("key", F.lit(None).cast("long"), "gain")), "gains-by-key")
    common, times, word_gain = _sorted(known_words.where(F.col("n") >= least).select("word", "n", "gain"))
    common_grams, hot_gain = _sorted(gram_gains.where(hot).select("key", "gain"))
    first = tree.gains.where(F.col("key") == int(START.view(np.int64))).first()
    at_start = first.gain if first else 0.0
    shared = spark.sparkContext.broadcast((common, times, word_gain, common_grams, hot_gain))
    hot_bits = spark.sparkContext.broadcast(cell_bits(gram_gains.where(hot)))
    rare_bits = spark.sparkContext.broadcast(cell_bits(gram_gains.where(~hot)))

    def look_up(every: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(known):
            return np.zeros(len(every), np.int64), np.zeros(len(every), bool)
        at = np.minimum(np.searchsorted(known, every), len(known) - 1)
        return at, known[at] == every

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, times, word_gain, common_grams, hot_gain = shared.value
        hasher, logs = WordHasher(), np.log10(times + 0.1)
        for part, texts in chunks(batches):
            words = [hasher(x) for x in texts]
            count, rows = np.array([len(w) for w in words]), len(words)
            at, hit = look_up(np.concatenate(words), known)
            of, at = np.repeat(np.arange(rows), count)[hit], at[hit]
            hits = np.bincount(of, minlength=rows)
            base = np.bincount(of, logs[at], rows) + (count - hits) * np.log10(0.1) + np.log10(ends + 0.1)
            gain = np.bincount(of, word_gain[at], rows) + at_start
            text = np.repeat(np.arange(rows), count + 2)
            for _, place, key, _, _ in grams(token_stream(words), hot_bits.value, GRAMS, chained=False):
                at, hit = look_up(key, common_grams)
                gain += np.bincount(text[place[hit]], hot_gain[at[hit]], rows)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("held_out"), part.column("row"), pa.array(count + 1, pa.int64()),
                 pa.array(hits, pa.int64()), pa.array(base), pa.array(gain)],
                ["doc_id", "held_out", "row", "n_tokens", "known", "base", "gain"])

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, bits = shared.value[0], rare_bits.value
        hasher = WordHasher()
        for part, texts in chunks(batches):
            words = [hasher(x) for x in texts]
            row = part.column("row").to_numpy()
            stream = token_stream(words)
            of = np.repeat(row, [len(w) + 2 for w in words])
            for _, at, key, _, _ in grams(stream, bits, GRAMS, chained=False):
                yield from _send(row=of[at], key=key.view(np.int64))
            inner = np.flatnonzero((stream != START) & (stream != END))
            inner = inner[~look_up(stream[inner], known)[1]]
            yield from _send(row=of[inner], key=stream[inner].view(np.int64))

    kind = dict(docs.dtypes)["doc_id"]
    rows = folded.withColumn("row", F.xxhash64("text"))
    scored = stored(rows.mapInArrow(score, f"doc_id {kind}, held_out boolean, row long, n_tokens long, known long, "
                                           "base double, gain double"), "scored")
    more = (rows.select("row", "text").mapInArrow(places, "row long, key long").join(rare, "key").groupBy("row")
            .agg(F.count("n").alias("more_known"), F.sum(F.log10(F.col("n") + 0.1) - F.log10(F.lit(0.1))).alias("more"),
                 F.sum("gain").alias("more_gain")))
    # Rows of one text have added to one sum.
    copies = scored.groupBy("row").agg(F.count("*").alias("copies"))
    each = stored(more.join(copies, "row"), "text-sums")
    part = lambda c: F.coalesce(F.col(c) / F.col("copies"), F.lit(0.0))
    base = F.col("base") + part("more") - F.col("n_tokens") * float(np.log10(size))
    return scored.join(each, "row", "left").select(
        "doc_id", "held_out", "n_tokens",
        (F.col("known") + part("more_known").cast("long") + int(ends > 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"),
        (base + F.col("gain") + part("more_gain")).alias("score"))
