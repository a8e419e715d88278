"""Line dedup: delete runs of lines that repeat an earlier run, by winnowing.

Lines are what ``\\n`` separates; a line without a word is blank, is never
deleted and does not interrupt a run.  A run counts from ``MIN_RUN`` lines; with
``min_words`` (the pipeline) also from one line, if its lines have that many
words in total.
Line i of a document is deleted when it lies in a run whose lines also stand,
in the same order, at an earlier place: in a document with a smaller doc_id, or
further up in the same document.  Runs are judged on the input, not on what is
left, so the result does not depend on any order of work.

1. *Fingerprints.*  In every window of ``MIN_RUN`` line hashes the smallest one
   is selected.  Equal runs select equal fingerprints, so a run of ``MIN_RUN``
   lines that occurs twice is guaranteed to share one.  With ``min_words`` the
   windows of fewer lines that have enough words select theirs as well; longer
   runs are made of windows of ``MIN_RUN``.
2. *Join.*  Fingerprints that were selected once in the whole corpus are
   dropped; the windows around all others are candidates.
3. *Extension.*  Around a shared fingerprint the match is followed both ways:
   every window that has the fingerprint first, last or between is compared
   with the earliest place of the same lines.  Matching windows overlap into
   runs of any length.
4. Lines in a matching window are deleted.

All steps are DataFrame expressions.  A line, fingerprint or run that a third
of all documents share is one partially aggregated row; candidates are joined
to that row, never to each other.  Windows are compared by two 64-bit hashes
with different seeds (128 bits).

Nulls and edge cases: a null text has no lines and stays null; an empty text
stays empty.  Null doc_ids count as larger than all others.  Rows with equal
doc_id but different texts are different documents, ordered by a hash of the
text; rows equal in both are one document (neither is earlier, both get the
same result).  Extra columns pass through unread.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.shared import stored
from tapeworks.llm.text import WORD_PATTERN

MIN_RUN = 3
MIN_WORDS = 20
BLANKS = " \t\n\x0b\x0c\r"
LAST = 9223372036854775807


def _keys(docs: DataFrame) -> list[Column]:
    """Place of a row in the order of documents."""
    return [F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST)).alias("_d"),
            F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("_t")]


def line_sequences(docs: DataFrame) -> DataFrame:
    """(_d, _t, pos, h, g, n): per document the places, the two hashes and the
    words of its lines with a word."""
    lines = F.transform(F.split("text", "\n"), lambda x, i: F.struct(i.alias("pos"), x.alias("x")))
    words = F.filter(lines, lambda s: F.length(F.trim(s["x"], F.lit(BLANKS))) > 0)
    return (docs.where("text is not null").select(*_keys(docs), words.alias("w"))
            .select("_d", "_t", F.col("w.pos").alias("pos"),
                    F.transform("w.x", lambda x: F.xxhash64(x)).alias("h"),
                    F.transform("w.x", lambda x: F.xxhash64(F.lit("line"), x)).alias("g"),
                    F.transform("w.x", lambda x: F.regexp_count(x, F.lit(WORD_PATTERN))).alias("n")))


def deleted_lines(docs: DataFrame, min_run: int = MIN_RUN, min_words: int | None = None) -> DataFrame:
    """(_d, _t, deleted): the places of the lines to delete, for documents that
    have any."""
    seq = line_sequences(docs)
    seq = (seq.where(F.size("h") >= min_run).drop("n") if min_words is None else seq.where(F.size("h") > 0)).distinct()
    seq = stored(seq, "lines")

    def windows(size: int) -> Column:
        starts = F.when(F.size("h") >= size, F.sequence(F.lit(0), F.size("h") - size)).otherwise(F.array().cast("array<int>"))
        if size < min_run:
            words = lambda i: F.aggregate(F.slice("n", i + 1, size), F.lit(0), lambda x, y: x + y)
            starts = F.filter(starts, lambda i: words(i) >= min_words)
        lowest = lambda i: F.array_min(F.slice("h", i + 1, size))
        return F.transform(starts, lambda i: F.struct(
            i.alias("i"), lowest(i).alias("f"), (i + F.array_position(F.slice("h", i + 1, size), lowest(i))).alias("p"),
            F.slice("pos", i + 1, size).alias("at"),
            F.xxhash64(F.slice("h", i + 1, size)).alias("a"),
            F.xxhash64(F.slice("g", i + 1, size)).alias("b")))

    window = F.concat(*[windows(k) for k in range(min_run if min_words is None else 1, min_run + 1)])
    selected = F.array_distinct(F.transform(window, lambda s: F.struct(s["p"].alias("at"), s["f"].alias("f"))))
    # Stored, as the earliest places below, so that the joins shuffle both sides
    # and what a third of all documents share can be split.
    shared = stored(seq.select(F.explode(selected).alias("s")).groupBy(F.col("s.f").alias("f"))
                    .agg(F.count("*").alias("n")).where("n > 1").select("f"), "shared-lines")
    candidates = stored(seq.select("_d", "_t", F.explode(window).alias("s")).select("_d", "_t", "s.*").drop("p")
                        .join(shared, "f").drop("f"), "line-windows")
    first = stored(candidates.groupBy("a", "b").agg(F.min(F.struct("_d", "_t", "i")).alias("first"),
                                                    F.count("*").alias("n")).where("n > 1"), "first-lines")
    later = candidates.join(first, ["a", "b"]).where(F.struct("_d", "_t", "i") > F.col("first"))
    return later.groupBy("_d", "_t").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("deleted"))


def dedup_lines(docs: DataFrame, min_run: int = MIN_RUN, min_words: int | None = None) -> DataFrame:
    """``docs`` (all columns, ``text`` without the deleted lines) as struct
    ``row``, plus ``n_lines`` (with a word) and ``n_deleted``.  The texts move
    once, to meet their own deletions."""
    deleted = deleted_lines(docs, min_run, min_words).hint("shuffle_hash")
    row = F.struct(*[docs[c] for c in docs.columns]).alias("row")
    both = docs.select(*_keys(docs), row).join(deleted, ["_d", "_t"], "left")
    lines = F.split("row.text", "\n")
    none = F.array().cast("array<int>")
    left = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce("deleted", none)),
                       lambda j: F.get(lines, j))
    text = F.when(F.col("deleted").isNull(), F.col("row.text")).otherwise(F.array_join(left, "\n"))
    n_lines = F.size(F.filter(lines, lambda x: F.length(F.trim(x, F.lit(BLANKS))) > 0))
    return both.select(
        F.col("row").withField("text", text).alias("row"),
        F.when(F.col("row.text").isNull(), 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.size(F.coalesce("deleted", none)).cast("long").alias("n_deleted"))


def line_dedup(docs: DataFrame, min_run: int = MIN_RUN, min_words: int | None = None) -> DataFrame:
    """doc_id, n_lines, n_deleted and the text that is left.  With ``min_words``
    repeated runs of fewer lines go too if they have that many words."""
    return dedup_lines(docs, min_run, min_words).select("row.doc_id", "n_lines", "n_deleted", "row.text")


def drop_repeated_lines(docs: DataFrame, min_run: int = MIN_RUN, min_words: int | None = MIN_WORDS) -> DataFrame:
    """``docs`` with the deletions made, of repeated runs of fewer than
    ``min_run`` lines too if they have ``min_words`` words; ``n_chars`` follows
    the text.  Documents of which no line with a word is left go; all others stay."""
    out = dedup_lines(docs, min_run, min_words).where("n_deleted = 0 or n_deleted < n_lines")
    row = F.col("row")
    if "n_chars" in docs.columns:
        row = row.withField("n_chars", F.when(F.col("n_deleted") > 0, F.length("row.text").cast("long"))
                            .otherwise(F.col("row.n_chars").cast("long")))
    return out.select(row.alias("row")).select("row.*").select(
        *[F.col(c).cast(t).alias(c) for c, t in docs.dtypes])


ORACLE_SQL = f"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
seq AS (
  SELECT doc_id, pos, line, row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k,
         len(regexp_extract_all(line, '[^\\x20\\x09-\\x0D]+')) AS n
  FROM lines WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
win AS (
  SELECT doc_id, k, 1 AS size, line AS run FROM seq WHERE n >= {MIN_WORDS}
  UNION ALL
  SELECT doc_id, k, 2, line || chr(10) || lead(line, 1) OVER w FROM seq
  WINDOW w AS (PARTITION BY doc_id ORDER BY k) QUALIFY n + lead(n, 1) OVER w >= {MIN_WORDS}
  UNION ALL
  SELECT doc_id, k, {MIN_RUN}, line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w
  FROM seq WINDOW w AS (PARTITION BY doc_id ORDER BY k)),
later AS (
  SELECT doc_id, k, size FROM win WHERE run IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY size, run ORDER BY doc_id, k) > 1),
gone AS (
  SELECT DISTINCT s.doc_id, s.pos FROM seq s JOIN (SELECT doc_id, unnest(range(k, k + size)) AS k FROM later) l
  ON s.doc_id = l.doc_id AND s.k = l.k),
kept AS (
  SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) AS text FROM lines
  ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_lines, coalesce(g.n, 0)::BIGINT AS n_deleted,
       CASE WHEN d.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text
FROM documents d LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM seq GROUP BY doc_id) n USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) g USING (doc_id)
"""
