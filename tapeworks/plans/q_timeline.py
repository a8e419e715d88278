"""Timeline queries over ``conversations`` (§2.10, V19–V24, D6, G4, G6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.operators import timeline as TL
from tapeworks.plans import bindings as B
from tapeworks.plans.catalog import register
from tapeworks.sources.contracts import CONTRACTS, parse_contract

MAX_TEMPO = 1.25  # ours: dub speed-up allowed before a clip counts as overflow


@register("timeline_flatten", B.with_sql(["transcript_segments"], """
SELECT doc_id, seg_pos, segment_id, start_ms, end_ms, speaker, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words
FROM transcript_segments"""))
def timeline_flatten(spark: SparkSession, sf: str) -> DataFrame:
    """Nested transcript documents → flat segment rows."""
    s = TL.flatten_segments(B.transcript_docs(spark, sf))
    return s.select("doc_id", "seg_pos", "segment_id", "start_ms", "end_ms", "speaker",
                    F.size("words").alias("n_words"))


@register("timeline_nest", B.with_sql(["transcript_segments"], """
SELECT doc_id, count(*) AS n_segments, string_agg(segment_id, ',' ORDER BY seg_pos) AS segment_ids,
       min(start_ms) AS first_start_ms, max(end_ms) AS last_end_ms
FROM transcript_segments GROUP BY doc_id"""))
def timeline_nest(spark: SparkSession, sf: str) -> DataFrame:
    """T1 inverse: flat segment rows → one ordered segments array per document."""
    nested = TL.nest_segments(B.transcript_segments(spark, sf), fields=["segment_id", "start_ms", "end_ms"])
    return nested.select("doc_id", F.size("segments").cast("long").alias("n_segments"),
                         F.array_join(F.transform("segments", lambda s: s["segment_id"]), ",").alias("segment_ids"),
                         F.try_element_at("segments", F.lit(1))["start_ms"].alias("first_start_ms"),
                         F.element_at("segments", -1)["end_ms"].alias("last_end_ms"))


@register("rule_interval", B.with_sql(["faulty_words"], """
SELECT doc_id, segment_id, CAST(word_pos AS INTEGER) AS word_pos, start_ms, end_ms
FROM faulty_words WHERE NOT (end_ms > start_ms)"""))
def rule_interval(spark: SparkSession, sf: str) -> DataFrame:
    """Words (and by the same rule segments) need end > start."""
    w = TL.interval_violations(B.faulty_words(spark, sf), "start_ms", "end_ms")
    return w.select("doc_id", "segment_id", "word_pos", "start_ms", "end_ms")


@register("rule_word_containment", B.with_sql(["transcript_words"], """
SELECT w.doc_id, w.segment_id, CAST(w.word_pos AS INTEGER) AS word_pos, w.start_ms, w.end_ms
FROM transcript_words w JOIN transcript_segments s ON w.doc_id = s.doc_id AND w.segment_id = s.segment_id
WHERE w.start_ms < s.start_ms OR w.end_ms > s.end_ms"""))
def rule_word_containment(spark: SparkSession, sf: str) -> DataFrame:
    """Words must stay inside their segment."""
    v = TL.containment_violations(B.transcript_words(spark, sf), B.transcript_segments(spark, sf))
    return v.select("doc_id", "segment_id", "word_pos", "start_ms", "end_ms")


@register("rule_word_order", B.with_sql(["faulty_words"], """
SELECT doc_id, segment_id, CAST(word_pos AS INTEGER) AS word_pos, start_ms FROM (
  SELECT w.*, coalesce(lag(w.start_ms) OVER (PARTITION BY w.doc_id, w.segment_id ORDER BY w.word_pos), s.start_ms) AS prev
  FROM faulty_words w JOIN transcript_segments s ON w.doc_id = s.doc_id AND w.segment_id = s.segment_id)
WHERE start_ms < prev"""))
def rule_word_order(spark: SparkSession, sf: str) -> DataFrame:
    """Words ordered by start (ties and overlaps allowed)."""
    v = TL.word_order_violations(B.faulty_words(spark, sf), B.transcript_segments(spark, sf))
    return v.select("doc_id", "segment_id", "word_pos", "start_ms")


@register("rule_segment_unique", B.with_sql(["faulty_segments"], """
SELECT doc_id, segment_id, count(*) AS n FROM faulty_segments GROUP BY doc_id, segment_id HAVING count(*) > 1"""))
def rule_segment_unique(spark: SparkSession, sf: str) -> DataFrame:
    """Segment IDs unique within a transcript."""
    return TL.duplicate_keys(B.faulty_segments(spark, sf), ["doc_id", "segment_id"])


@register("duplicate_segments", B.with_sql(["translations"], """
SELECT doc_id, segment_id, count(*) AS n FROM translations GROUP BY doc_id, segment_id HAVING count(*) > 1"""))
def duplicate_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segment IDs that occur more than once when all translation
    versions are put in one timeline."""
    return TL.duplicate_keys(B.translations(spark, sf), ["doc_id", "segment_id"])


@register("rule_segment_order", B.with_sql(["faulty_segments"], """
SELECT doc_id, seg_pos, start_ms FROM (
  SELECT *, coalesce(lag(start_ms) OVER (PARTITION BY doc_id ORDER BY seg_pos), 0) AS prev FROM faulty_segments)
WHERE start_ms < prev"""))
def rule_segment_order(spark: SparkSession, sf: str) -> DataFrame:
    """Segments ordered by start (first compared with 0)."""
    return TL.segment_order_violations(B.faulty_segments(spark, sf)).select("doc_id", "seg_pos", "start_ms")


@register("rule_segment_duration", B.with_sql(["transcript_durations"], """
SELECT s.doc_id, s.segment_id, s.end_ms, d.duration_ms
FROM transcript_segments s JOIN transcript_durations d ON s.doc_id = d.doc_id WHERE s.end_ms > d.duration_ms"""))
def rule_segment_duration(spark: SparkSession, sf: str) -> DataFrame:
    """Transcript segments end within the media duration."""
    v = TL.duration_violations(B.transcript_segments(spark, sf), B.transcript_durations(spark, sf))
    return v.select("doc_id", "segment_id", "end_ms", "duration_ms")


@register("latest_translation", B.with_sql(["translations"], """
SELECT doc_id, segment_id, translation_version, translated_text FROM (
  SELECT *, row_number() OVER (PARTITION BY doc_id, segment_id ORDER BY translation_version DESC) AS rn
  FROM translations) WHERE rn = 1"""))
def latest_translation(spark: SparkSession, sf: str) -> DataFrame:
    """Latest translation version per segment."""
    lt = TL.latest_translation(B.translations(spark, sf))
    return lt.select("doc_id", "segment_id", "translation_version", "translated_text")


@register("segment_alignment", B.with_sql(["translations", "synthesis"], """
WITH t AS (SELECT DISTINCT doc_id, segment_id FROM transcript_segments),
r AS (SELECT DISTINCT doc_id, segment_id FROM translations),
s AS (SELECT DISTINCT doc_id, segment_id FROM synthesis),
k AS (SELECT doc_id, segment_id FROM t UNION SELECT doc_id, segment_id FROM r UNION SELECT doc_id, segment_id FROM s)
SELECT k.doc_id, k.segment_id, t.segment_id IS NOT NULL AS in_transcript, r.segment_id IS NOT NULL AS in_translation,
       s.segment_id IS NOT NULL AS in_synthesis
FROM k LEFT JOIN t USING (doc_id, segment_id) LEFT JOIN r USING (doc_id, segment_id) LEFT JOIN s USING (doc_id, segment_id)"""))
def segment_alignment(spark: SparkSession, sf: str) -> DataFrame:
    """Transcript, latest translation and synthesis aligned on segment ID."""
    lt = TL.latest_translation(B.translations(spark, sf))
    return TL.align_segments(B.transcript_segments(spark, sf), lt, B.synthesis(spark, sf))


@register("dub_fit", B.with_sql(["synthesis"], f"""
SELECT doc_id, segment_id, target_end_ms - target_start_ms AS window_ms, actual_duration_ms,
  round(actual_duration_ms / (target_end_ms - target_start_ms), 4) AS tempo,
  CASE WHEN actual_duration_ms / (target_end_ms - target_start_ms) <= 1.0 THEN 'fits'
       WHEN actual_duration_ms / (target_end_ms - target_start_ms) <= {MAX_TEMPO} THEN 'speedup'
       ELSE 'overflow' END AS fit
FROM synthesis"""))
def dub_fit(spark: SparkSession, sf: str) -> DataFrame:
    """Synthesized clip length against its target window."""
    d = TL.dub_fit(B.synthesis(spark, sf), MAX_TEMPO)
    return d.select("doc_id", "segment_id", "window_ms", "actual_duration_ms", "tempo", "fit")


@register("stale_segments", B.with_sql(["translations", "synthesis"], """
WITH lt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, segment_id
                                    ORDER BY translation_version DESC) AS rn FROM translations) WHERE rn = 1)
SELECT s.doc_id, s.segment_id, lt.translation_version
FROM synthesis s JOIN lt ON s.doc_id = lt.doc_id AND s.segment_id = lt.segment_id
WHERE s.text <> lt.translated_text"""))
def stale_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Synthesized audio made from an older translation than the latest."""
    lt = TL.latest_translation(B.translations(spark, sf))
    return TL.stale_segments(lt, B.synthesis(spark, sf)).select("doc_id", "segment_id", "translation_version")


@register("chunk_merge", B.with_sql(["transcript_segments"], """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start_ms, end_ms, text) - 1 AS INTEGER) AS seg_pos,
       start_ms, end_ms, text FROM transcript_segments"""))
def chunk_merge(spark: SparkSession, sf: str) -> DataFrame:
    """T4: overlapping recognition chunks merged back into one timeline."""
    m = TL.chunk_merge(B.recognition_chunks(spark, sf), B.CHUNK_MS, B.OVERLAP_MS)
    return m.select("doc_id", "seg_pos", "start_ms", "end_ms", "text")


_STEP = B.CHUNK_MS - B.OVERLAP_MS


@register("chunk_merge_aligned", B.with_sql(["recognised_words"], f"""
WITH n AS (SELECT *, start_ms + end_ms AS mid2, lower(regexp_replace(text, '^[!-/:-@\\[-`{{-~]+|[!-/:-@\\[-`{{-~]+$', '', 'g')) AS x FROM recognised_words),
a AS (SELECT doc_id, chunk AS seam, pos, x, row_number() OVER (PARTITION BY doc_id, chunk ORDER BY pos) AS i
      FROM n WHERE mid2 >= 2 * (chunk + 1) * {_STEP}),
b AS (SELECT doc_id, chunk - 1 AS seam, pos, x, row_number() OVER (PARTITION BY doc_id, chunk ORDER BY pos) AS j
      FROM n WHERE chunk > 0 AND mid2 < 2 * (chunk * {_STEP} + {B.OVERLAP_MS})),
m AS (SELECT a.doc_id, a.seam, a.i, b.j, a.i - row_number() OVER (PARTITION BY a.doc_id, a.seam, a.i - b.j ORDER BY a.i) AS island
      FROM a JOIN b ON a.doc_id = b.doc_id AND a.seam = b.seam AND a.x = b.x),
best AS (SELECT doc_id, seam, min(i) AS i, min(j) AS j, count(*) AS size FROM m GROUP BY doc_id, seam, i - j, island
         QUALIFY row_number() OVER (PARTITION BY doc_id, seam ORDER BY count(*) DESC, min(i), min(j)) = 1),
seams AS (SELECT best.doc_id, best.seam, a.pos AS last, b.pos AS before FROM best
          JOIN a ON a.doc_id = best.doc_id AND a.seam = best.seam AND a.i = best.i + (best.size + 1) // 2 - 1
          JOIN b ON b.doc_id = best.doc_id AND b.seam = best.seam AND b.j = best.j + (best.size + 1) // 2 - 1)
SELECT n.doc_id, row_number() OVER (PARTITION BY n.doc_id ORDER BY n.chunk, n.pos) - 1 AS word_no, n.chunk, n.start_ms, n.end_ms, n.text
FROM n LEFT JOIN seams s ON n.doc_id = s.doc_id AND n.chunk = s.seam LEFT JOIN seams p ON n.doc_id = p.doc_id AND n.chunk = p.seam + 1
WHERE coalesce(n.pos <= s.last, n.mid2 < 2 * (n.chunk + 1) * {_STEP} + {B.OVERLAP_MS})
  AND (n.chunk = 0 OR coalesce(n.pos > p.before, n.mid2 >= 2 * n.chunk * {_STEP} + {B.OVERLAP_MS}))"""))
def chunk_merge_aligned(spark: SparkSession, sf: str) -> DataFrame:
    """T4 where chunks disagree: words recognised twice in the overlaps, with
    jittered times and misheard words, merged at their longest common run."""
    m = TL.aligned_chunk_merge(B.recognised_words(spark, sf), _STEP, B.OVERLAP_MS)
    return m.select("doc_id", "word_no", "chunk", "start_ms", "end_ms", "text")


def _srt_sql_time(x: str) -> str:
    return (f"printf('%02d:%02d:%02d,%03d', CAST({x} // 3600000 AS BIGINT), CAST(({x} % 3600000) // 60000 AS BIGINT), "
            f"CAST(({x} % 60000) // 1000 AS BIGINT), CAST({x} % 1000 AS BIGINT))")


@register("srt_text", B.with_sql(["transcript_segments"], f"""
SELECT doc_id, seg_pos + 1 AS cue, (seg_pos + 1) || chr(10) || {_srt_sql_time('start_ms')} || ' --> ' ||
       {_srt_sql_time('end_ms')} || chr(10) || text || chr(10) || chr(10) AS srt FROM transcript_segments"""))
def srt_text(spark: SparkSession, sf: str) -> DataFrame:
    """T5: the SRT document of each transcript, as its ordered cues."""
    return TL.srt_cues(B.transcript_segments(spark, sf))


@register("timeline_nested_rules", B.with_sql(["transcript_words"], """
WITH outside AS (SELECT DISTINCT w.doc_id, w.segment_id FROM transcript_words w JOIN transcript_segments s
                   ON w.doc_id = s.doc_id AND w.segment_id = s.segment_id
                 WHERE w.start_ms < s.start_ms OR w.end_ms > s.end_ms),
unordered AS (SELECT DISTINCT doc_id, segment_id FROM (
    SELECT w.*, coalesce(lag(w.start_ms) OVER (PARTITION BY w.doc_id, w.segment_id ORDER BY w.word_pos), s.start_ms) AS prev
    FROM transcript_words w JOIN transcript_segments s ON w.doc_id = s.doc_id AND w.segment_id = s.segment_id)
  WHERE start_ms < prev),
seg AS (SELECT *, coalesce(lag(start_ms) OVER (PARTITION BY doc_id ORDER BY seg_pos), 0) AS prev FROM transcript_segments)
SELECT s.doc_id, count(*) AS n_segments,
  count(o.segment_id) AS segments_with_words_outside, count(u.segment_id) AS segments_with_unordered_words,
  count(DISTINCT s.segment_id) = count(*) AS ids_unique, bool_and(s.start_ms >= s.prev) AS segments_ordered
FROM seg s LEFT JOIN outside o ON s.doc_id = o.doc_id AND s.segment_id = o.segment_id
LEFT JOIN unordered u ON s.doc_id = u.doc_id AND s.segment_id = u.segment_id
GROUP BY s.doc_id"""))
def timeline_nested_rules(spark: SparkSession, sf: str) -> DataFrame:
    """V20–V23 in nested form, evaluated on each nested document (``forall``
    over the words and segments arrays, no flattening)."""
    docs = B.transcript_docs(spark, sf)
    segs = F.col("segments")
    return docs.select(
        "doc_id", F.size(segs).cast("long").alias("n_segments"),
        F.size(F.filter(segs, lambda s: ~TL.nested_words_inside(s))).cast("long").alias("segments_with_words_outside"),
        F.size(F.filter(segs, lambda s: ~TL.nested_words_ordered(s))).cast("long").alias("segments_with_unordered_words"),
        TL.nested_ids_unique(segs).alias("ids_unique"),
        TL.nested_segments_ordered(segs).alias("segments_ordered"))


@register("transcript_contract", B.with_sql(["transcript_words", "transcript_durations"], """
WITH w AS (
  SELECT w.doc_id, w.segment_id, w.word_pos, w.start_ms, w.end_ms, s.start_ms AS s_start, s.end_ms AS s_end,
         coalesce(lag(w.start_ms) OVER (PARTITION BY w.doc_id, w.segment_id ORDER BY w.word_pos), s.start_ms) AS prev
  FROM transcript_words w JOIN transcript_segments s ON w.doc_id = s.doc_id AND w.segment_id = s.segment_id),
wc AS (
  SELECT doc_id, segment_id, bool_or(NOT (end_ms > start_ms)) AS bad_word_interval,
         arg_min(CASE WHEN start_ms < s_start OR end_ms > s_end THEN 'word_outside'
                      WHEN start_ms < prev THEN 'word_order' END, word_pos)
           FILTER (WHERE start_ms < s_start OR end_ms > s_end OR start_ms < prev) AS loop_code
  FROM w GROUP BY doc_id, segment_id),
sc AS (
  SELECT s.doc_id, s.seg_pos,
    CASE WHEN coalesce(wc.bad_word_interval, false) THEN 'word_interval'
         WHEN NOT (s.end_ms > s.start_ms) THEN 'segment_interval' ELSE wc.loop_code END AS seg_code,
    CASE WHEN count(*) OVER (PARTITION BY s.doc_id, s.segment_id ORDER BY s.seg_pos
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > 0 THEN 'segment_id_unique'
         WHEN s.start_ms < coalesce(lag(s.start_ms) OVER (PARTITION BY s.doc_id ORDER BY s.seg_pos), 0) THEN 'segment_order'
         WHEN s.end_ms > d.duration_ms THEN 'segment_duration' END AS model_code
  FROM transcript_segments s LEFT JOIN wc ON s.doc_id = wc.doc_id AND s.segment_id = wc.segment_id
  JOIN transcript_durations d ON s.doc_id = d.doc_id)
SELECT sc.doc_id,
  CASE WHEN min(d.duration_ms) > 0 THEN NULL ELSE 'duration_ms' END AS field_error,
  count(sc.seg_code) AS segment_errors,
  arg_min(sc.seg_code, sc.seg_pos) FILTER (WHERE sc.seg_code IS NOT NULL) AS first_segment_error,
  CASE WHEN min(d.duration_ms) > 0 AND count(sc.seg_code) = 0
       THEN arg_min(sc.model_code, sc.seg_pos) FILTER (WHERE sc.model_code IS NOT NULL) END AS model_error,
  '' AS unknown_fields
FROM sc JOIN transcript_durations d ON sc.doc_id = d.doc_id
GROUP BY sc.doc_id"""))
def transcript_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Transcript documents written as canonical JSON (A2), read back with
    the transcript contract's fixed schema (A1, unknown fields at every
    level), then checked in nested form: document fields, each segment's own
    validation (V19–V21) and the document loop (V22–V24)."""
    docs = B.transcript_docs(spark, sf)
    doc = F.struct(F.lit("1.0").alias("schema_version"),
                   F.struct(F.concat(F.lit("s3://audio/"), F.col("doc_id").cast("string"), F.lit(".flac")).alias("uri"),
                            F.lit("audio/flac").alias("content_type")).alias("source_audio"),
                   "language", "duration_ms", F.lit("asr").alias("provider"), F.lit("base").alias("model"),
                   "segments")
    raw = docs.select("doc_id", F.to_json(doc).alias("raw"))
    parsed = parse_contract(raw, "raw", CONTRACTS["transcript"])
    checked = TL.transcript_checks(parsed, "doc_id")
    return checked.select("doc_id", "field_error", "segment_errors", "first_segment_error", "model_error",
                          F.array_join("unknown_fields", ",").alias("unknown_fields"))


@register("timeline_contracts", B.with_sql(["translations", "synthesis"], """
WITH lt AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, segment_id ORDER BY translation_version DESC) AS rn
                           FROM translations) WHERE rn = 1),
tr AS (SELECT doc_id, count(*) AS n,
         arg_min(CASE WHEN NOT (source_end_ms > source_start_ms) THEN 'translated_interval' END, segment_id)
           FILTER (WHERE NOT (source_end_ms > source_start_ms)) AS seg_err
       FROM lt GROUP BY doc_id),
sy AS (SELECT doc_id, count(*) AS n, count(DISTINCT segment_id) AS n_ids,
         arg_min(CASE WHEN NOT (target_end_ms > target_start_ms) THEN 'target_interval'
                      WHEN NOT (actual_duration_ms > 0) THEN 'actual_duration' END, segment_id)
           FILTER (WHERE NOT (target_end_ms > target_start_ms) OR NOT (actual_duration_ms > 0)) AS seg_err
       FROM synthesis GROUP BY doc_id)
SELECT coalesce(tr.doc_id, sy.doc_id) AS doc_id, tr.n AS translated_segments, tr.seg_err AS translation_segment_error,
       CAST(NULL AS VARCHAR) AS translation_model_error, sy.n AS synthesized_segments,
       sy.seg_err AS synthesis_segment_error,
       CASE WHEN sy.n_ids <> sy.n THEN 'segment_id_unique' END AS synthesis_model_error, '' AS unknown_fields
FROM tr FULL OUTER JOIN sy ON tr.doc_id = sy.doc_id"""))
def timeline_contracts(spark: SparkSession, sf: str) -> DataFrame:
    """Translated timelines (latest version per segment, G6) and synthesis
    results per conversation, written as contract documents (A2), read back
    strictly (A1) and checked with their segment and document rules."""
    art = lambda prefix: F.struct(F.concat(F.lit(prefix), F.col("doc_id").cast("string")).alias("uri"),
                                  F.lit("application/json").alias("content_type"))
    # Flat rows are built once: a segment's versions and its speech side by side.
    rows = B.translated_segments(spark, sf)
    tseg = F.struct("segment_id", "source_start_ms", "source_end_ms", "source_text", "translated_text", "speaker",
                    "translation_version")
    sseg = F.struct("segment_id", F.col("source_start_ms").alias("target_start_ms"), F.col("source_end_ms").alias("target_end_ms"),
                    F.col("spoken_text").alias("text"), "voice",
                    F.struct(F.col("audio_uri").alias("uri"), F.lit("audio/wav").alias("content_type")).alias("audio"),
                    "actual_duration_ms")
    docs = TL.latest_translation(rows).groupBy("doc_id").agg(
        F.sort_array(F.collect_list(F.struct("seg_pos", tseg.alias("t"), sseg.alias("s")))).alias("_r"))
    docs = docs.select("doc_id", F.to_json(F.struct(
        F.lit("1.0").alias("schema_version"), art("s3://asr/").alias("source_transcript"),
        F.lit("en").alias("source_language"), F.lit("zh-CN").alias("target_language"), F.lit("mt").alias("provider"),
        F.lit("base").alias("model"), F.transform("_r", lambda x: x["t"]).alias("segments"))).alias("traw"),
        F.to_json(F.struct(
            F.lit("1.0").alias("schema_version"), art("s3://translation/").alias("source_timeline"),
            F.lit("zh-CN").alias("language"), F.lit("tts").alias("provider"), F.lit("base").alias("model"),
            F.lit("voice").alias("voice"), F.transform("_r", lambda x: x["s"]).alias("segments"),
            art("s3://tts/").alias("dubbed_audio"))).alias("sraw"))
    t = TL.translated_timeline_checks(parse_contract(docs, "traw", CONTRACTS["translated_timeline"]), "doc_id")
    t = t.select("doc_id", "sraw", F.size("segments").cast("long").alias("translated_segments"),
                 F.col("first_segment_error").alias("translation_segment_error"),
                 F.col("model_error").alias("translation_model_error"), F.col("unknown_fields").alias("_u1"))
    s = TL.synthesis_checks(parse_contract(t, "sraw", CONTRACTS["synthesis_result"]), "doc_id")
    return s.select("doc_id", "translated_segments", "translation_segment_error", "translation_model_error",
                    F.size("segments").cast("long").alias("synthesized_segments"),
                    F.col("first_segment_error").alias("synthesis_segment_error"),
                    F.col("model_error").alias("synthesis_model_error"),
                    F.array_join(F.array_union("_u1", "unknown_fields"), ",").alias("unknown_fields"))
