"""Timelines on the millisecond media axis (§2.10 T1–T5, V19–V24, D6, G4, G6).

Rules run on the flat form (one row per segment or word).  Order checks
compare each row with its predecessor through an equi-join on
``(doc, position - 1)`` rather than a ``lag`` window over the whole
document: the join keys include the position, so one very long document is
spread over all tasks instead of being sorted in one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import evaluate_once
from tapeworks.operators.discovery import dedupe_keep_last
from tapeworks.operators.ordering import dense_positions

MS_PER_HOUR = 3600000


# ------------------------------------------------------------------ T1


def flatten_segments(docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Nested documents (``segments`` array) → one row per segment with
    its position ``seg_pos``."""
    x = docs.select(doc, F.posexplode("segments").alias("seg_pos", "s"))
    return x.select(doc, F.col("seg_pos").cast("long").alias("seg_pos"), "s.*")


def flatten_words(segments: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Nested ``words`` of flat segments → one row per word."""
    x = segments.select(doc, "segment_id", F.posexplode("words").alias("word_pos", "w"))
    return x.select(doc, "segment_id", "word_pos", "w.*")


def nest_segments(segments: DataFrame, doc: str = "doc_id", fields: list[str] | None = None) -> DataFrame:
    """T1 inverse: flat segments → one row per document with its ``segments``
    array in position order.  A nested document is one value by contract; the
    rules never nest, they read the flat form."""
    fields = fields or [c for c in segments.columns if c not in (doc, "seg_pos")]
    arr = F.array_sort(F.collect_list(F.struct("seg_pos", *fields)))
    return segments.groupBy(doc).agg(arr.alias("_s")).select(
        doc, F.transform("_s", lambda s: s.dropFields("seg_pos")).alias("segments"))


# ------------------------------------------------------------------ V19–V24


def interval_violations(rows: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose interval is not positive."""
    return rows.filter(~(F.col(end) > F.col(start)))


def containment_violations(words: DataFrame, segments: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Words that leave their segment."""
    seg = segments.select(doc, "segment_id", F.col("start_ms").alias("seg_start"), F.col("end_ms").alias("seg_end"))
    j = words.join(seg, [doc, "segment_id"])
    return j.filter((F.col("start_ms") < F.col("seg_start")) | (F.col("end_ms") > F.col("seg_end")))


def with_previous(rows: DataFrame, keys: list[str], pos: str, cols: list[str]) -> DataFrame:
    """Attach the previous row's ``cols`` (as ``prev_<c>``) by equi-join on
    ``keys + pos - 1``; positions are dense from 0."""
    prev = rows.select(*keys, (F.col(pos) + 1).alias(pos), *[F.col(c).alias(f"prev_{c}") for c in cols])
    return rows.join(prev, keys + [pos], "left")


def word_order_violations(words: DataFrame, segments: DataFrame, doc: str = "doc_id") -> DataFrame:
    """A word starting before the previous word (the first word is
    compared with its segment's start).  Equal starts and overlaps pass."""
    seg = segments.select(doc, "segment_id", F.col("start_ms").alias("seg_start"))
    w = with_previous(words, [doc, "segment_id"], "word_pos", ["start_ms"]).join(seg, [doc, "segment_id"])
    prev = F.coalesce(F.col("prev_start_ms"), F.col("seg_start"))
    return w.filter(F.col("start_ms") < prev).drop("seg_start")


def duplicate_keys(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter(F.col("n") > 1)


def segment_order_violations(segments: DataFrame, start: str = "start_ms", doc: str = "doc_id") -> DataFrame:
    """A segment starting before the previous one (first compared with 0)."""
    s = with_previous(segments, [doc], "seg_pos", [start])
    return s.filter(F.col(start) < F.coalesce(F.col(f"prev_{start}"), F.lit(0)))


def duration_violations(segments: DataFrame, docs: DataFrame, doc: str = "doc_id") -> DataFrame:
    """A segment ending after its transcript's duration (one per document,
    however many rows ``docs`` has for it)."""
    durations = docs.groupBy(doc).agg(F.max("duration_ms").alias("duration_ms"))
    return segments.join(durations, doc).filter(F.col("end_ms") > F.col("duration_ms"))


# ------------------------------------------------------------------ G6, D6, T2, T3


def latest_translation(translated: DataFrame, doc: str = "doc_id") -> DataFrame:
    """The highest ``translation_version`` per segment."""
    return dedupe_keep_last(translated, [doc, "segment_id"], ["translation_version"])


def align_segments(transcript: DataFrame, translation: DataFrame, synthesis: DataFrame,
                   doc: str = "doc_id") -> DataFrame:
    """Full outer alignment on the stable segment ID, with gap flags."""
    t = transcript.select(doc, "segment_id", F.lit(True).alias("in_transcript"))
    r = translation.select(doc, "segment_id", F.lit(True).alias("in_translation"))
    s = synthesis.select(doc, "segment_id", F.lit(True).alias("in_synthesis"))
    j = t.join(r, [doc, "segment_id"], "full_outer").join(s, [doc, "segment_id"], "full_outer")
    return j.select(doc, "segment_id", *[F.coalesce(F.col(c), F.lit(False)).alias(c)
                                         for c in ("in_transcript", "in_translation", "in_synthesis")])


def dub_fit(synth: DataFrame, max_tempo: float = 1.25) -> DataFrame:
    """How a synthesized clip fits its target window.

    ``tempo`` = actual / window; ``fits`` when <= 1, ``speedup`` when the
    clip fits after speeding up by at most ``max_tempo``, else ``overflow``.
    ``max_tempo`` is ours: the reference names the check, not the threshold.
    """
    window = F.col("target_end_ms") - F.col("target_start_ms")
    tempo = F.col("actual_duration_ms") / window
    cls = F.when(tempo <= 1.0, F.lit("fits")).when(tempo <= max_tempo, F.lit("speedup")).otherwise(F.lit("overflow"))
    return synth.withColumn("window_ms", window).withColumn("tempo", F.round(tempo, 4)).withColumn("fit", cls)


def stale_segments(latest: DataFrame, synthesis: DataFrame, doc: str = "doc_id") -> DataFrame:
    """Synthesized segments whose text differs from the latest translation."""
    lt = latest.select(doc, "segment_id", "translation_version", "translated_text")
    j = synthesis.join(lt, [doc, "segment_id"])
    return j.filter(F.col("text") != F.col("translated_text"))


# ------------------------------------------------------------------ T4, T5


def chunk_merge(chunks: DataFrame, chunk_ms: int, overlap_ms: int, doc: str = "doc_id") -> DataFrame:
    """T4: merge recognition chunks that overlap by ``overlap_ms``.

    Input rows: (doc, chunk, offset_ms, start_ms, end_ms, text) with times
    relative to the chunk.  Times get the chunk offset; a segment is kept by
    the chunk owning its midpoint (the overlap is split in half, the first
    chunk owns from 0); then segments are renumbered per document.
    """
    a = chunks.withColumn("start_ms", F.col("start_ms") + F.col("offset_ms")).withColumn(
        "end_ms", F.col("end_ms") + F.col("offset_ms"))
    mid2 = F.col("start_ms") + F.col("end_ms")      # twice the midpoint, stays integral
    lo2 = F.when(F.col("chunk") == 0, F.lit(0)).otherwise(2 * F.col("offset_ms") + overlap_ms)
    hi2 = 2 * F.col("offset_ms") + 2 * chunk_ms - overlap_ms
    kept = a.filter((mid2 >= lo2) & (mid2 < hi2)).drop("chunk", "offset_ms")
    # renumber per document; buckets are minutes of media time (monotone in start)
    return dense_positions(kept, [doc], F.floor(F.col("start_ms") / 60000), ["start_ms", "end_ms", "text"],
                           name="seg_pos")


def normal_word(text) -> Column:
    """A word as two recognitions of it are compared: lower case, no punctuation at its ends."""
    return F.lower(F.regexp_replace(text, r"^\p{Punct}+|\p{Punct}+\z", ""))


def longest_common_run(a: Column, b: Column) -> Column:
    """(size, i, j) of the longest run of elements that stands in both arrays, from
    ``i`` and ``j``; the smallest i, then j, among equals; size 0 if there is none.
    One pass over ``a`` with the run lengths that end at each element of ``b``."""
    def step(acc: Column, x: Column) -> Column:
        ending = F.transform(b, lambda y, j: F.when(x == y, F.coalesce(F.get(acc["ending"], j - 1), F.lit(0)) + 1).otherwise(F.lit(0)))
        found = F.transform(ending, lambda size, j: F.struct(size.alias("size"), (size - acc["at"] - 1).alias("i"), (size - j - 1).alias("j")))
        return F.struct((acc["at"] + 1).alias("at"), ending.alias("ending"),
                        F.greatest(acc["best"], F.array_max(found)).alias("best"))

    none = F.struct(F.lit(0).alias("size"), F.lit(0).alias("i"), F.lit(0).alias("j"))
    start = F.struct(F.lit(0).alias("at"), F.transform(b, lambda _: F.lit(0)).alias("ending"), none.alias("best"))
    best = F.reduce(a, start, step)["best"]  # i and j negated, so that the greatest is the earliest
    return F.struct(best["size"].alias("size"), (-best["i"]).alias("i"), (-best["j"]).alias("j"))


def aligned_chunk_merge(words: DataFrame, step_ms: int, overlap_ms: int, doc: str = "doc_id") -> DataFrame:
    """T4 where chunks disagree: merge recognised words of chunks that begin every
    ``step_ms`` and overlap by ``overlap_ms``.

    Input rows: (doc, chunk, pos, start_ms, end_ms, text) with times relative to
    the chunk and ``pos`` the order in it.  Times jitter and words at a chunk's
    edge may be misheard, so the seam is found by the words: of the two word lists
    in an overlap (by midpoint) the longest common run is taken, and the chunks
    meet in its middle.  Without a common word the overlap is split in half by
    time.  Words are renumbered per document.

    An overlap's words are few (its length bounds them), so their lists are one
    row per seam; seams and words meet by (doc, chunk), which spreads a long
    document over all tasks."""
    if 2 * overlap_ms > step_ms:
        raise ValueError(f"an overlap of {overlap_ms} ms leaves nothing between two seams of chunks every {step_ms} ms")
    offset = F.col("chunk") * step_ms
    w = words.withColumn("start_ms", F.col("start_ms") + offset).withColumn("end_ms", F.col("end_ms") + offset)
    mid2 = F.col("start_ms") + F.col("end_ms")
    tail, head = mid2 >= 2 * (offset + step_ms), (F.col("chunk") > 0) & (mid2 < 2 * (offset + overlap_ms))
    sides = F.filter(F.array(F.when(tail, F.struct(F.col("chunk").alias("seam"), F.lit(True).alias("left"))),
                             F.when(head, F.struct((F.col("chunk") - 1).alias("seam"), F.lit(False).alias("left")))), lambda x: x.isNotNull())
    item = F.struct("pos", normal_word(F.col("text")).alias("x"))
    lists = (w.select(doc, "pos", "text", F.inline(sides)).groupBy(doc, "seam").agg(
        F.sort_array(F.collect_list(F.when(F.col("left"), item))).alias("a"), F.sort_array(F.collect_list(F.when(~F.col("left"), item))).alias("b")))
    run = longest_common_run(F.col("a.x"), F.col("b.x"))
    half = F.floor((F.col("run.size") + 1) / 2).cast("int")
    seams = evaluate_once(lists, [doc, "seam", "a", "b"], [run.alias("run")]).where("run.size > 0").select(
        doc, "seam", F.get("a.pos", F.col("run.i") + half - 1).alias("last"), F.get("b.pos", F.col("run.j") + half - 1).alias("before"))
    after = seams.select(doc, F.col("seam").alias("chunk"), "last")
    ahead = seams.select(doc, (F.col("seam") + 1).alias("chunk"), "before")
    middle = 2 * offset + overlap_ms
    kept = (w.join(after, [doc, "chunk"], "left").join(ahead, [doc, "chunk"], "left")
            .where(F.coalesce(F.col("pos") <= F.col("last"), mid2 < middle + 2 * step_ms)
                   & ((F.col("chunk") == 0) | F.coalesce(F.col("pos") > F.col("before"), mid2 >= middle))).drop("last", "before"))
    return dense_positions(kept, [doc], F.col("chunk"), ["chunk", "pos"], name="word_no")


def _srt_time(ms) -> F.Column:
    return F.format_string("%02d:%02d:%02d,%03d", (ms / MS_PER_HOUR).cast("long"),
                           ((ms % MS_PER_HOUR) / 60000).cast("long"), ((ms % 60000) / 1000).cast("long"),
                           (ms % 1000).cast("long"))


def srt_cues(segments: DataFrame, text: str = "text", doc: str = "doc_id") -> DataFrame:
    """T5: the SRT file of a timeline as ordered cue rows: ``cue`` (numbered
    from 1 in position order) and its text, a blank line included.  The cues in
    order are the file, so nothing is collected however long a timeline is."""
    cue = F.concat(F.concat_ws("\n", (F.col("seg_pos") + 1).cast("string"),
                               F.concat(_srt_time(F.col("start_ms")), F.lit(" --> "), _srt_time(F.col("end_ms"))),
                               F.col(text)), F.lit("\n\n"))
    return segments.select(doc, (F.col("seg_pos") + 1).alias("cue"), cue.alias("srt"))


# ------------------------------------------------------------------ nested forms (one document per row)


def nested_words_inside(segment) -> Column:
    """V20 on a nested segment: every word inside ``[start_ms, end_ms]``."""
    s = segment
    return F.forall(F.coalesce(s["words"], F.array()),
                    lambda w: (w["start_ms"] >= s["start_ms"]) & (w["end_ms"] <= s["end_ms"]))


def nested_words_ordered(segment) -> Column:
    """V21 on a nested segment: word starts never go back (first vs segment start)."""
    s = segment
    starts = F.transform(F.coalesce(s["words"], F.array()), lambda w: w["start_ms"])
    prev = F.slice(F.concat(F.array(s["start_ms"]), starts), 1, F.size(starts))
    return F.forall(F.arrays_zip(starts.alias("a"), prev.alias("b")), lambda p: p["a"] >= p["b"])


def nested_ids_unique(segments) -> Column:
    """V22 on a nested timeline: no segment ID twice."""
    ids = F.transform(segments, lambda s: s["segment_id"])
    return F.size(F.array_distinct(ids)) == F.size(ids)


def nested_segments_ordered(segments) -> Column:
    """V23 on a nested timeline: segment starts never go back (first vs 0)."""
    starts = F.transform(segments, lambda s: s["start_ms"])
    prev = F.slice(F.concat(F.array(F.lit(0).cast("long")), starts), 1, F.size(starts))
    return F.forall(F.arrays_zip(starts.alias("a"), prev.alias("b")), lambda p: p["a"] >= p["b"])


# ------------------------------------------------------------------ transcript documents (A1 + V19–V24)


def _word_codes(s) -> Column:
    """Per word of a segment, in order: ``word_outside`` or ``word_order``
    (containment first, then order).  Words are zipped with the starts before
    them, so the loop is linear."""
    words = F.coalesce(s["words"], F.array())
    starts = F.transform(words, lambda w: w["start_ms"])
    before = F.slice(F.concat(F.array(s["start_ms"]), starts), 1, F.size(starts))
    pairs = F.arrays_zip(words.alias("w"), before.alias("prev"))
    return F.transform(pairs, lambda p: F.when(
        (p["w"]["start_ms"] < s["start_ms"]) | (p["w"]["end_ms"] > s["end_ms"]), F.lit("word_outside"))
        .when(p["w"]["start_ms"] < p["prev"], F.lit("word_order")))


def segment_error(s) -> Column:
    """First violation of one nested segment: word intervals (its fields),
    then its own interval, then the word loop."""
    words = F.coalesce(s["words"], F.array())
    loop = F.try_element_at(F.filter(_word_codes(s), lambda c: c.isNotNull()), F.lit(1))
    return (F.when(~F.forall(words, lambda w: w["end_ms"] > w["start_ms"]), F.lit("word_interval"))
            .when(~(s["end_ms"] > s["start_ms"]), F.lit("segment_interval"))
            .otherwise(loop))


def _first_repeat(ids: Column) -> Column:
    """Position of the first element equal to an earlier one: sorted with their
    positions, equal elements are neighbours."""
    order = F.sort_array(F.transform(ids, lambda x, i: F.struct(x.alias("id"), i.alias("at"))))
    size = F.greatest(F.size(order) - 1, F.lit(0))
    pairs = F.arrays_zip(F.slice(order, 1, size).alias("a"), F.slice(order, 2, size).alias("b"))
    return F.array_min(F.transform(pairs, lambda p: F.when(p["a"]["id"] == p["b"]["id"], p["b"]["at"])))


def _first_step_back(starts: Column) -> Column:
    """Position of the first start before its predecessor (the first one's is 0)."""
    before = F.slice(F.concat(F.array(F.lit(0).cast("long")), starts), 1, F.size(starts))
    return F.array_min(F.transform(F.arrays_zip(starts.alias("a"), before.alias("b")), lambda p, i: F.when(p["a"] < p["b"], i)))


def loop_error(segments: Column, start: str | None, duration: Column | None = None) -> Column:
    """The document loop over a document's segments in order: the code of the
    first segment that repeats an earlier ID, starts before the previous one or
    ends after the duration.  One pass over the row that the document is: the
    previous start and the IDs seen come from the array itself, nothing is
    joined, and the cost grows with the segments (their IDs are sorted)."""
    found = [(_first_repeat(F.transform(segments, lambda s: s["segment_id"])), "segment_id_unique")]
    if start:
        found.append((_first_step_back(F.transform(segments, lambda s: s[start])), "segment_order"))
    if duration is not None:
        found.append((F.array_min(F.transform(segments, lambda s, i: F.when(s["end_ms"] > duration, i))), "segment_duration"))
    first = F.array_min(F.array(*[F.when(at.isNotNull(), F.struct(at.alias("at"), F.lit(k).alias("k"), F.lit(code).alias("code")))
                                  for k, (at, code) in enumerate(found)]))
    return first["code"]


def transcript_checks(parsed: DataFrame, key: str) -> DataFrame:
    """Checks of parsed transcript documents (one row per document, unique by
    ``key``):

    * ``field_error``: language (2+ characters), duration (> 0), provider and
      model (non-empty), in field order;
    * ``segment_errors`` / ``first_segment_error``: segments failing their own
      validation, and the first one's code;
    * ``model_error``: the document loop (``loop_error``), only when fields
      and segments are valid: an outer model isn't built from invalid parts.
    """
    segs = F.coalesce(F.col("segments"), F.array())
    failing = F.filter(F.transform(segs, segment_error), lambda c: c.isNotNull())
    trim_len = lambda c: F.length(F.btrim(F.col(c)))
    field = (F.when(F.coalesce(trim_len("language"), F.lit(0)) < 2, F.lit("language"))
             .when(~F.coalesce(F.col("duration_ms") > 0, F.lit(False)), F.lit("duration_ms"))
             .when(F.coalesce(trim_len("provider"), F.lit(0)) < 1, F.lit("provider"))
             .when(F.coalesce(trim_len("model"), F.lit(0)) < 1, F.lit("model")))
    checked = parsed.select("*", field.alias("field_error"), F.size(failing).cast("long").alias("segment_errors"),
                            F.try_element_at(failing, F.lit(1)).alias("first_segment_error"))
    inner_ok = F.col("field_error").isNull() & F.col("first_segment_error").isNull()
    return checked.withColumn("model_error", F.when(inner_ok, loop_error(segs, "start_ms", F.col("duration_ms"))))


def _first(codes) -> Column:
    return F.try_element_at(F.filter(codes, lambda c: c.isNotNull()), F.lit(1))


def translated_timeline_checks(parsed: DataFrame, key: str) -> DataFrame:
    """Translated timeline documents: each segment's own checks (positive
    source interval, version >= 1, non-empty texts), then the document loop —
    a repeated segment ID or a source start before the previous one (first
    compared with 0); no duration rule for translations."""
    segs = F.coalesce(F.col("segments"), F.array())
    seg = lambda s: (F.when(~(s["source_end_ms"] > s["source_start_ms"]), F.lit("translated_interval"))
                     .when(F.coalesce(s["translation_version"], F.lit(1)) < 1, F.lit("translation_version"))
                     .when(F.length(F.btrim(s["translated_text"])) < 1, F.lit("translated_text")))
    checked = parsed.select("*", _first(F.transform(segs, seg)).alias("first_segment_error"))
    return checked.withColumn("model_error", F.when(F.col("first_segment_error").isNull(), loop_error(segs, "source_start_ms")))


def synthesis_checks(parsed: DataFrame, key: str) -> DataFrame:
    """Synthesis results: each segment's own checks (positive target window,
    positive measured length), then one synthesized segment per ID (no order
    rule for synthesis)."""
    segs = F.coalesce(F.col("segments"), F.array())
    seg = lambda s: (F.when(~(s["target_end_ms"] > s["target_start_ms"]), F.lit("target_interval"))
                     .when(~(s["actual_duration_ms"] > 0), F.lit("actual_duration")))
    checked = parsed.select("*", _first(F.transform(segs, seg)).alias("first_segment_error"))
    return checked.withColumn("model_error", F.when(F.col("first_segment_error").isNull(), loop_error(segs, None)))
