"""Quality rules: base rules, then distribution divergence from a language.

A text is compared with the reference of its language on two histograms:

* character classes (the eight of ``CLASSES``), and
* common words (the language's most frequent words, plus one cell for all
  other words).

The distance is the Jensen-Shannon distance (square root of the divergence,
logarithms to base 2, 0 to 1).  References are learned from the corpus: class
and word counts of all documents with ten words or more, per language.

Nulls and edge cases: a null or empty text has no words, fails the base rules
(fewer than 10 words) and is not kept.  A null language is a language of its
own.  A language with fewer than ``MIN_TOKENS`` words in such documents gets no
reference, whatever its share; for its documents the base rules alone decide.
References are joined to the documents by language, so their number may grow
with the corpus.  Repeated rows are judged alike, one result row each.  Extra
columns are ignored.
"""

from __future__ import annotations

import json
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tapeworks.llm.shared import stored
from tapeworks.llm.text import covered, utf8_column, windows_repeated

CLASSES = ("lower", "upper", "other letter", "mark", "digit", "punctuation", "symbol", "space or control")
SYMBOLS = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">")
SPACES = (b" ", b"\t", b"\n", b"\x0b", b"\x0c", b"\r")
# The sampling error of that many words adds about COMMON_WORDS / (8 n ln 2) = 0.006 to a divergence.
MIN_TOKENS = 2_000
COMMON_WORDS = 64
UNPACKED = 1_000  # references that a task keeps ready
# Distances above these reject; below the minimum lengths a test says nothing.
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.48
MIN_CHARS = 300
MIN_WORDS = 50

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, class_distance double, word_distance double, kept boolean")

def class_table() -> np.ndarray:
    """Character class of every code point, from its Unicode category."""
    by_category = {"Ll": 0, "Lu": 1, "Lt": 1, "Lo": 2, "Lm": 2}
    by_major = {"M": 3, "N": 4, "P": 5, "S": 6, "Z": 7, "C": 7}
    table = np.empty(0x110000, np.uint8)
    for point in range(0x110000):
        category = unicodedata.category(chr(point))
        table[point] = by_category.get(category, by_major.get(category[0], 2))
    return table


def class_counts(text: bytes, table: np.ndarray) -> np.ndarray:
    points = np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    return np.bincount(table[points], minlength=len(CLASSES))


def base_measures(text: bytes, words: list[bytes]) -> tuple[int, int, int, int, int, bool]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)."""
    word_chars = len(text.decode("utf-8", "replace")) - sum(map(text.count, SPACES))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x.strip(b"".join(SPACES))]
    n_words, n_repeat = len(words), 0
    if len(set(zip(words, words[1:], words[2:], words[3:], words[4:]))) < n_words - 4:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n_words)
        n_repeat = int(covered(np.flatnonzero(windows_repeated(ids, 5)), 5, n_words).sum())
    failed = n_words < 10 or 100 * n_repeat > 20 * n_words
    return n_words, word_chars, n_symbols, len(lines) - len(set(lines)), n_repeat, failed


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance of two count vectors, 0 (alike) to 1 (disjoint)."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(d / 2, 0.0)))


Reference = tuple[np.ndarray, dict[bytes, int], np.ndarray]


def unpack(ref: str) -> Reference:
    """(class counts, cell of each common word, word counts with the cell of
    all other words last) of a packed reference."""
    given = json.loads(ref)
    listed = [(bytes.fromhex(x["word"]), x["n"]) for x in given["common"]]
    counts = np.array([n for _, n in listed] + [given["tokens"] - sum(n for _, n in listed)])
    return np.array(given["classes"]), {w: k for k, (w, _) in enumerate(listed)}, counts


def pack(ref: Reference) -> str:
    classes, cells, counts = ref
    return json.dumps({"classes": classes.tolist(), "tokens": int(counts.sum()),
                       "common": [{"word": w.hex(), "n": int(counts[k])} for w, k in cells.items()]})


def reference_table(docs: DataFrame) -> DataFrame:
    """(lang, ref): the packed reference of every language with ``MIN_TOKENS``
    words, stored.

    Counts cover all documents with ten words or more.  Tasks add up their
    own words first, so a frequent word is one row per task before the shuffle.
    Nothing comes to the driver.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        words_of: dict[str | None, Counter] = {}
        sums: dict[str | None, np.ndarray] = {}

        def flush():
            rows = [(lang, w, None, n) for lang, c in words_of.items() for w, n in c.items()]
            rows += [(lang, None, k, int(n)) for lang, v in sums.items() for k, n in enumerate(v)]
            words_of.clear()
            sums.clear()
            for k in range(0, len(rows), 50_000):
                part = list(zip(*rows[k:k + 50_000]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part[0], pa.string()), pa.array(part[1], pa.binary()),
                     pa.array(part[2], pa.int32()), pa.array(part[3], pa.int64())], ["lang", "word", "cell", "n"])

        for batch in batches:
            for text, lang in zip(utf8_column(batch, "text"), batch.column("lang").to_pylist()):
                words = (text or b"").split()
                if len(words) < 10:
                    continue
                words_of.setdefault(lang, Counter()).update(words)
                v = sums.setdefault(lang, np.zeros(len(CLASSES) + 2, np.int64))
                v[: len(CLASSES)] += class_counts(text, table)
                v[-2] += len(words)
                v[-1] += 1
            if sum(map(len, words_of.values())) > 400_000:
                yield from flush()
        yield from flush()

    rows = (docs.select("text", "lang").mapInArrow(count, "lang string, word binary, cell int, n long")
            .groupBy("lang", "word", "cell").agg(F.sum("n").alias("n")))
    rows = stored(rows, "language-counts")
    cell = lambda k: F.coalesce(F.sum(F.when(F.col("cell") == k, F.col("n"))), F.lit(0))
    sums = (rows.where("cell is not null").groupBy("lang")
            .agg(F.array(*map(cell, range(len(CLASSES)))).alias("classes"), cell(len(CLASSES)).alias("tokens"))
            .where(F.col("tokens") >= MIN_TOKENS))
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "word")
    common = (rows.where("word is not null").withColumn("k", F.row_number().over(top)).where(F.col("k") <= COMMON_WORDS)
              .groupBy(F.col("lang").alias("_lang"))
              .agg(F.array_sort(F.collect_list(F.struct("k", F.lower(F.hex("word")).alias("word"), "n"))).alias("common")))
    ref = F.to_json(F.struct("classes", "tokens", "common")).alias("ref")
    return stored(sums.join(common, F.col("lang").eqNullSafe(F.col("_lang"))).select("lang", ref), "references")


def references(docs: DataFrame) -> dict[str | None, Reference]:
    """The references as a dictionary on the driver, for tests and small corpora."""
    return {r.lang: unpack(r.ref) for r in reference_table(docs).collect()}


def judge(docs: DataFrame, refs: DataFrame | dict, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``row`` (a struct of the ``carry`` columns), the
    base measures, both distances (null below the minimum lengths or without a
    reference of the language) and the verdict ``kept``.  ``refs``: the rows of
    ``reference_table``, broadcast only while the table is small, or a
    dictionary."""
    if isinstance(refs, dict):
        refs = docs.sparkSession.createDataFrame([(k, pack(v)) for k, v in refs.items()], "lang string, ref string")
    names = [c.split()[0] for c in RESULT.split(", ")]
    kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.float64(), pa.bool_()]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = class_table()
        unpacked = lru_cache(UNPACKED)(unpack)

        def distances(text: bytes, words: list[bytes], ref: str | None) -> tuple[float | None, float | None]:
            by_class = by_word = None
            if ref is None:
                return by_class, by_word
            classes, cell, counts = unpacked(ref)
            if len(text) >= MIN_CHARS:
                own = class_counts(text, table)
                if own.sum() >= MIN_CHARS:
                    by_class = js_distance(own, classes)
            if len(words) >= MIN_WORDS:
                seen = Counter(words)
                own = np.zeros(len(counts))
                for w, k in cell.items():
                    own[k] = seen.get(w, 0)
                own[-1] = len(words) - own.sum()
                by_word = js_distance(own, counts)
            return by_class, by_word

        for batch in batches:
            found = []
            for text, ref in zip(utf8_column(batch, "text"), batch.column("ref").to_pylist()):
                text = text or b""
                words = text.split()
                base = base_measures(text, words)
                by_class, by_word = distances(text, words, ref)
                kept = not base[-1] and (by_class or 0) <= MAX_CLASS_DISTANCE and (by_word or 0) <= MAX_WORD_DISTANCE
                found.append((*base, by_class, by_word, kept))
            cols = list(zip(*found)) if found else [[]] * len(names)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), *(pa.array(v, k) for v, k in zip(cols, kinds))], ["row", *names])

    given = docs.select(F.struct(*carry).alias("row"), "text", F.col("lang").cast("string").alias("lang"))
    refs = refs.select(F.col("lang").alias("_lang"), "ref")
    given = given.join(refs, F.col("lang").eqNullSafe(F.col("_lang")), "left").select("row", "text", "ref")
    out = T.StructType([given.schema["row"], *T._parse_datatype_string(RESULT).fields])
    return given.mapInArrow(apply, out)


def quality_rules(docs: DataFrame) -> DataFrame:
    """Learn the references from ``docs`` and judge every document of it:
    doc_id, the base measures, the distances and the verdict."""
    return judge(docs, reference_table(docs)).select("row.doc_id", *[c.split()[0] for c in RESULT.split(", ")])


def keep_good(docs: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose document passes, with all their columns, in one
    pass over the texts (the verdict is made beside the row, not joined)."""
    return judge(docs, reference_table(docs), tuple(docs.columns)).where("kept").select("row.*")
