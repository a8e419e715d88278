"""N-gram Jaccard join: all pairs of documents whose sets of five-word grams
have a Jaccard similarity of 0.8 or more, by MinHash banding.

1. *Classes.*  Documents with the same set of grams are one class (128-bit hash
   of the set).  From here on work is per class, so thousands of copies are one
   row.
2. *Banding.*  ``choose_bands`` picks bands and rows so that a pair at the
   threshold shares a band with the target recall.  Classes are shuffled on
   band hashes; buckets of one class go.
3. *Linking buckets.*  In a bucket, classes whose 96-byte MinHash sketches agree
   well enough (an estimate of ``SKETCH_FLOOR``, five standard deviations below
   the threshold) are linked, and only a spanning forest of these links leaves
   the bucket.  Connected components of the forests hold all candidate pairs.
4. *Verification.*  The full gram sets of a component's classes are compared
   exactly, in blocks of ``BLOCK`` classes: a large component is dealt out by
   hash to pairs of blocks, so no task holds more than two blocks and no pair is
   ever a row.  Blocks return counts of links and a spanning forest of the true
   links.

Result: one row per document with its class, its number of links (other
documents with similarity >= 0.8, copies counted) and its group (connected by
links); the document of a group with the smallest doc_id is kept.

Nulls and edge cases: a text of one to four words has one gram, all its words,
so that short copies link; a null text or one without words links with nothing
and is kept, a group of its own (``class_id`` and ``group_id`` its own doc_id).
A null doc_id counts as larger than all others.  Rows equal in doc_id and text
are judged alike.  Extra columns are ignored.  Grams are compared as 64-bit
hashes of the words as they stand.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.shared import block_pairs, connected_components, forest, runs, spread, stored
from tapeworks.llm.text import WordHasher, gram_hashes, mix, utf8_column

GRAM = 5
THRESHOLD = 0.8
RECALL = 0.9999
MAX_HASHES = 192
SKETCH = 96
SKETCH_FLOOR = 0.6
BLOCK = 256
BUCKET_ROWS = 2048
LAST = 9223372036854775807


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band, and so the fewest false
    candidates, with which a pair at the threshold shares one of the bands with
    this probability, using at most ``most`` hash functions."""
    best = None
    for rows in range(1, most + 1):
        bands = math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))
        if bands * rows > most:
            break
        best = bands, rows
    if best is None:
        raise ValueError("no banding reaches this recall with so few hash functions")
    return best


def grams(text: bytes | None, hasher: WordHasher, n: int = GRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the grams of a text."""
    words = hasher(text)
    return np.unique(gram_hashes(words, min(n, len(words)))) if len(words) else words


def min_hashes(grams: np.ndarray, factors: np.ndarray) -> np.ndarray:
    low = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(grams), 512):
        np.minimum(low, np.multiply.outer(factors, grams[k:k + 512]).min(axis=1), out=low)
    return low


def signatures(docs: DataFrame, bands: int, rows: int, n: int = GRAM) -> DataFrame:
    """(d, t, cls, size, bands, sketch) per document: d and t place the row, the
    others are null for a text without words."""
    factors = np.random.default_rng(4).integers(0, 2**63, max(bands * rows, SKETCH), dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        number = np.arange(bands, dtype=np.uint64)
        for batch in batches:
            out = []
            for text in utf8_column(batch, "text"):
                g = grams(text, hasher, n)
                if not len(g):
                    out.append((None, 0, None, None))
                    continue
                low = min_hashes(g, factors)
                keys = number
                for k in range(rows):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + low[k:bands * rows:rows])
                out.append((xxhash.xxh3_128_digest(g.tobytes()), len(g), keys.view(np.int64).tolist(),
                            (mix(low[:SKETCH]) & np.uint64(255)).astype(np.uint8).tobytes()))
            cls, size, keys, sketch = zip(*out) if out else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column("d"), batch.column("t"), pa.array(cls, pa.binary()), pa.array(size, pa.int64()),
                 pa.array(keys, pa.list_(pa.int64())), pa.array(sketch, pa.binary())],
                ["d", "t", "cls", "size", "bands", "sketch"])

    return docs.select(*row_keys(docs), "text").mapInArrow(
        sign, "d long, t long, cls binary, size long, bands array<long>, sketch binary")


def row_keys(docs: DataFrame) -> list:
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("d"),
            F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("t")]


def _bucket_edges(floor: float):
    """Task function: forests of the sketch links in each bucket of a table."""
    least = math.ceil(SKETCH * (floor + (1 - floor) / 256))

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by([("h", "ascending"), ("i", "ascending"), ("j", "ascending")])
        h, i, j = (table.column(c).to_numpy() for c in "hij")
        cls = table.column("cls").to_pylist()
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, SKETCH)
        bounds, edges = runs(h, i, j), set()
        twos = bounds[:-1][np.diff(bounds) == 2]
        alike = (sketch[twos] == sketch[twos + 1]).sum(axis=1) >= least
        edges.update((cls[a], cls[a + 1]) for a in twos[alike].tolist())
        for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            if b - a > 2:
                own = sketch[a:b]
                linked = np.empty((b - a, b - a), bool)
                for k in range(0, b - a, 64):
                    linked[k:k + 64] = (own[k:k + 64, None, :] == own[None]).sum(axis=2) >= least
                edges.update((cls[a + u], cls[a + v]) for u, v in forest(linked))
        a, b = zip(*edges) if edges else ([], [])
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return link


def candidate_groups(classes: DataFrame, floor: float = SKETCH_FLOOR) -> DataFrame:
    """(node, component) of all classes that may be similar to another."""
    keyed = classes.select("cls", F.explode("bands").alias("h"))
    # Stored, so that the join shuffles both sides and a hot bucket's can be split.
    shared = stored(keyed.groupBy("h").agg(F.count("*").alias("n")).where("n > 1"), "shared-bands")
    members = stored(keyed.join(shared, "h").join(classes.select("cls", "sketch"), "cls")
                     .withColumn("x", F.xxhash64("cls"))
                     .select("h", "cls", "sketch", F.explode(block_pairs("n", "x", BUCKET_ROWS)).alias("p"))
                     .select("h", "cls", "sketch", "p.i", "p.j"), "buckets")
    tasks = spread(members.count(), 50_000)
    edges = (members.withColumn("task", F.pmod(F.xxhash64("h", "i", "j"), F.lit(tasks)))
             .groupBy("task").applyInArrow(_bucket_edges(floor), "a binary, b binary"))
    return connected_components(edges)


def similar(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Boolean matrix of the pairs with Jaccard similarity >= threshold (a set
    isn't paired with itself).  Exact, on sorted distinct hashes."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    common = np.zeros((n, n), np.int64)
    if n <= 8:
        for u in range(n):
            for v in range(u + 1, n):
                if min(sizes[u], sizes[v]) >= threshold * max(sizes[u], sizes[v]):
                    common[u, v] = common[v, u] = len(np.intersect1d(sets[u], sets[v], assume_unique=True))
    else:
        every, column = np.unique(np.concatenate(sets), return_inverse=True)
        often = np.bincount(column) > 1  # a gram of one set only adds to no intersection
        number = np.cumsum(often) - 1
        row = np.repeat(np.arange(n), sizes)[often[column]]
        column = number[column[often[column]]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for low in range(0, int(often.sum()), 4096):
            a, b = np.searchsorted(column, [low, low + 4096])
            part = np.zeros((n, 4096), np.float32)
            part[row[a:b], column[a:b] - low] = 1
            common += np.rint(part @ part.T).astype(np.int64)
    union = sizes[:, None] + sizes[None] - common
    linked = common >= threshold * union - 1e-9
    np.fill_diagonal(linked, False)
    return linked


def _verified(threshold: float):
    """Task function: exact links in each block pair of a table: per class the
    number of linked documents (b null), and edges of a forest (n null)."""
    def verify(table: pa.Table) -> pa.Table:
        table = table.sort_by([("component", "ascending"), ("i", "ascending"), ("j", "ascending"), ("cls", "ascending")])
        component = np.array(table.column("component").to_pylist(), object)
        i, j, own = (table.column(c).to_numpy() for c in ("i", "j", "own"))
        cls, copies = table.column("cls").to_pylist(), table.column("copies").to_numpy()
        blobs = table.column("grams").to_pylist()
        bounds = runs(component, i, j)
        a, b, n = [], [], []
        for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
            rows = [k for k in range(low, high) if k == low or cls[k] != cls[k - 1]]
            if len(rows) < 2:
                continue
            linked = similar([np.frombuffer(blobs[k], np.uint64) for k in rows], threshold)
            if i[low] != j[low]:  # pairs inside a block belong to the pair (i, i)
                side = own[rows]
                linked &= side[:, None] != side[None]
            for k, links in zip(rows, (linked @ copies[rows]).tolist()):
                if links:
                    a.append(cls[k]), b.append(None), n.append(links)
            for u, v in forest(linked):
                a.append(cls[rows[u]]), b.append(cls[rows[v]]), n.append(None)
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary()), "n": pa.array(n, pa.int64())})

    return verify


def _with_grams(n: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            blobs = [grams(text, hasher, n).tobytes() for text in utf8_column(batch, "text")]
            names = ["component", "cls", "copies", "members"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(blobs, pa.binary())],
                                             [*names, "grams"])
    return add


def verified_links(docs: DataFrame, classes: DataFrame, groups: DataFrame, threshold: float, n: int) -> DataFrame:
    """(a, b, n) as ``_verified`` says, over all candidate groups."""
    # Stored, as the groups' first places below, so that the joins shuffle both
    # sides and a hot component's can be split.
    sized = stored(groups.groupBy("component").agg(F.count("*").alias("members")), "sized")
    needed = (groups.join(sized, "component").withColumnRenamed("node", "cls")
              .join(classes.select("cls", "copies", "size", "rep"), "cls")
              .select("component", "cls", "copies", "members", F.col("rep.d").alias("d"), F.col("rep.t").alias("t"), "size"))
    needed = stored(needed, "candidates")
    grams_in_all = needed.agg(F.sum(F.col("size") * F.ceil(F.col("members") / BLOCK))).first()[0] or 0
    tasks = spread(int(grams_in_all), 1_500_000)
    texts = (docs.select(*row_keys(docs), "text").join(needed.drop("size").hint("shuffle_hash"), ["d", "t"])
             .select("component", "cls", "copies", "members", "text")
             .mapInArrow(_with_grams(n), "component binary, cls binary, copies long, members long, grams binary"))
    dealt = (texts.withColumn("x", F.xxhash64("cls"))
             .select("component", "cls", "copies", "grams", F.explode(block_pairs("members", "x", BLOCK)).alias("p"))
             .select("component", "cls", "copies", "grams", "p.*")
             .withColumn("task", F.pmod(F.xxhash64("component", "i", "j"), F.lit(tasks))))
    return stored(dealt.groupBy("task").applyInArrow(_verified(threshold), "a binary, b binary, n long"), "links")


def jaccard_groups(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL,
                   n: int = GRAM) -> DataFrame:
    """One row per document: d and t (its place), class_id, n_links, group_id,
    kept; ids are ``d`` values."""
    bands, rows = choose_bands(threshold, recall)
    signed = stored(signatures(docs, bands, rows, n), "signatures")
    place = F.struct("d", "t")
    classes = stored(signed.where("cls is not null").groupBy("cls").agg(
        F.min(place).alias("rep"), F.count("*").alias("copies"), F.first("size").alias("size"),
        F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "classes")
    links = verified_links(docs, classes, candidate_groups(classes), threshold, n)
    counts = links.where("b is null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("links"))
    groups = connected_components(links.where("b is not null").select("a", "b"))
    own = (classes.select("cls", "rep", "copies").join(groups.withColumnRenamed("node", "cls"), "cls", "left")
           .withColumn("component", F.coalesce("component", "cls")))
    first = stored(own.groupBy("component").agg(F.min("rep").alias("group_rep")), "group-places")
    judged = (own.join(first, "component").join(counts, "cls", "left")
              .select("cls", "rep", "group_rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    with_words = (signed.where("cls is not null").select("d", "t", "cls").join(judged, "cls")
                  .select("d", "t", F.col("rep.d").alias("class_id"), "n_links", F.col("group_rep.d").alias("group_id"),
                          (place == F.col("group_rep")).alias("kept")))
    without = signed.where("cls is null").select("d", "t", F.col("d").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
                                                 F.col("d").alias("group_id"), F.lit(True).alias("kept"))
    return with_words.unionAll(without)


def jaccard_join(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links, group_id, kept: one row per document."""
    given = lambda c: F.when(F.col(c) != LAST, F.col(c)).alias(c)
    return (jaccard_groups(docs, **options).withColumnRenamed("d", "doc_id")
            .select(given("doc_id"), given("class_id"), "n_links", given("group_id"), "kept"))


def keep_one(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group, all columns.  Rows equal in
    doc_id and text are one document, so one of them stays (that whose other
    columns are least as JSON); rows without words are no copies of anything and
    all stay."""
    judged = stored(jaccard_groups(docs, **options), "judged")
    gone = judged.where("not kept").select(F.col("d").alias("_d"), F.col("t").alias("_t")).distinct()
    row = docs.select(*[k.alias(f"_{n}") for k, n in zip(row_keys(docs), "dt")], F.struct(*docs.columns).alias("row"))
    left = row.join(gone.hint("shuffle_hash"), ["_d", "_t"], "left_anti")
    twice = judged.where("kept").groupBy("d", "t").agg(F.count("*").alias("n")).where("n > 1")
    if twice.isEmpty():
        return left.select("row.*")
    words = F.length(F.trim(F.coalesce("row.text", F.lit("")), F.lit(" \t\n\x0b\x0c\r"))) > 0
    others = [F.col(f"row.{c}").alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    order = F.to_json(F.struct(*others)) if others else F.lit("")
    single = left.where(words).groupBy("_d", "_t").agg(F.min_by("row", order).alias("row"))
    return single.select("row.*").unionAll(left.where(~words).select("row.*"))
