"""Manifests, stage references and artifacts (§2.3 V13–V18, §2.5 D4/D5/D10–D12,
§2.6 G3/G5, §2.7 F7, §2.9 U1/U2, P26).

References are checked across tables with anti/semi joins on the key, so a
video with many stages shuffles like any other key; per-video arrays (the
manifest maps) only hold what one manifest document holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.functions import col_of
from tapeworks.functions.time import aware_timestamp, iso_text
from tapeworks.operators import rules as R
from tapeworks.operators.discovery import dedupe_keep_first
from tapeworks.operators.jobs import latest_stage
from tapeworks.operators.ordering import dense_positions, order_bucket

LAYOUT_ROOT = "s3://media/videos"   # ours; a parameter of ``layout_path``

# The object layout of one video: stage, artifact, path below the
# video's prefix ({lang}: target language, {source}: source language).
LAYOUT = (
    ("manifest", "manifest", "manifest.json"),
    ("download", "video", "source/video.mp4"),
    ("download", "metadata", "source/metadata.json"),
    ("download", "original_subtitle", "source/original.{source}.vtt"),
    ("separate_audio", "speech", "audio/speech.flac"),
    ("separate_audio", "vocals", "audio/vocals.wav"),
    ("separate_audio", "accompaniment", "audio/accompaniment.wav"),
    ("transcribe", "chunks", "asr/chunks/"),
    ("transcribe", "raw", "asr/raw/"),
    ("transcribe", "transcript", "asr/transcript.json"),
    ("translate_subtitles", "timeline", "translation/timeline.{lang}.json"),
    ("translate_subtitles", "subtitle_srt", "translation/subtitle.{lang}.srt"),
    ("translate_subtitles", "subtitle_ass", "translation/subtitle.{lang}.ass"),
    ("synthesize_speech", "segments", "tts/segments/"),
    ("synthesize_speech", "dubbed", "tts/dubbed.{lang}.wav"),
    ("render_video", "final", "render/final.{lang}.mp4"),
    ("publish", "publication", "publish/bilibili.json"),
)


def missing_artifacts(refs: DataFrame, catalog: DataFrame) -> DataFrame:
    """References whose key is not in the catalogue."""
    return refs.join(catalog.select("key"), "key", "left_anti")


def stage_artifacts(refs: DataFrame, catalog: DataFrame) -> DataFrame:
    """References resolved to artifact URIs."""
    return refs.join(catalog, "key", "inner")


def refs_union(refs: DataFrame, stage_key: str = "job_id") -> DataFrame:
    """The set of keys a stage reads or writes (inputs ∪ outputs)."""
    return refs.select(stage_key, "key").distinct()


def refs_except(refs: DataFrame, catalog: DataFrame, stage_key: str = "job_id") -> DataFrame:
    """Stage keys minus known keys (set difference by key)."""
    return refs_union(refs, stage_key).join(catalog.select("key").distinct(), "key", "left_anti")


def build_manifests(stages: DataFrame, refs: DataFrame, catalog: DataFrame) -> DataFrame:
    """One manifest row per video: ``stages`` map (job type → latest
    record), ``artifacts`` map (key → artifact) of the referenced keys that
    exist, plus created/updated bounds.  Keys are deduplicated before
    ``map_from_entries`` (which refuses duplicate keys)."""
    latest = latest_stage(stages)
    inout = refs.groupBy("video_id", "job_id").agg(
        F.array_sort(F.collect_set(F.when(F.col("direction") == "input", F.col("key")))).alias("input_artifacts"),
        F.array_sort(F.collect_set(F.when(F.col("direction") == "output", F.col("key")))).alias("output_artifacts"))
    rec = latest.join(inout, ["video_id", "job_id"], "left")
    extra = [c for c in ("parameters_sha256", "error") if c in stages.columns]
    stage_struct = F.struct("job_type", "status", "job_id", "idempotency_key",
                            F.coalesce("input_artifacts", F.array().cast("array<string>")).alias("input_artifacts"),
                            F.coalesce("output_artifacts", F.array().cast("array<string>")).alias("output_artifacts"),
                            *extra, "started_at", "completed_at", "updated_at")
    st = rec.groupBy("video_id").agg(
        F.map_from_entries(F.collect_list(F.struct("job_type", stage_struct))).alias("stages"),
        F.min("started_at").alias("created_at"), F.max("updated_at").alias("updated_at"))
    known = dedupe_keep_first(catalog.select("key", "uri", "size"), ["key"], ["uri"])
    used = refs.select("video_id", "key").distinct().join(known, "key")
    art = used.groupBy("video_id").agg(
        F.map_from_entries(F.collect_list(F.struct("key", F.struct("uri", "size")))).alias("artifacts"))
    m = st.join(art, "video_id", "left").withColumn(
        "artifacts", F.coalesce("artifacts", F.create_map().cast("map<string,struct<uri:string,size:bigint>>")))
    return m.withColumn("source_video_id", F.col("video_id"))


def artifact_ref_violations(manifests: DataFrame) -> DataFrame:
    """V16 in-row: per stage, references missing from the manifest's
    artifacts, sorted and joined by ``, ``."""
    st = manifests.select("video_id", "artifacts", F.explode("stages").alias("job_type", "stage"))
    empty = F.array().cast("array<string>")
    refs = F.array_union(F.coalesce(F.col("stage.input_artifacts"), empty),
                         F.coalesce(F.col("stage.output_artifacts"), empty))
    missing = F.array_sort(F.array_except(refs, F.coalesce(F.map_keys("artifacts"), empty)))
    return st.select("video_id", "job_type", F.array_join(missing, ", ").alias("missing")).filter(
        F.col("missing") != "")


def manifest_rules(manifests: DataFrame) -> DataFrame:
    """V13–V15 and V16 (first failure, in the contract's order)."""
    empty = F.array().cast("array<string>")
    refs = lambda e: F.array_union(F.coalesce(e["value"]["input_artifacts"], empty),   # absent lists default to ()
                                   F.coalesce(e["value"]["output_artifacts"], empty))
    missing = F.filter(F.transform(F.map_entries("stages"), lambda e: F.array_join(F.array_sort(F.array_except(
        refs(e), F.coalesce(F.map_keys("artifacts"), empty))), ", ")), lambda x: x != "")
    model = [
        R.Rule("manifest_identity", F.col("video_id") == F.col("source_video_id"),
               "the source is another video"),
        R.Rule("manifest_time", F.col("updated_at") >= F.col("created_at"), "updated before it was created"),
        R.Rule("stage_key", F.forall(F.map_entries("stages"), lambda e: e["key"] == e["value"]["job_type"]),
               "a stage stands under another name"),
        R.Rule("artifact_refs", F.size(missing) == 0, "references to unknown artifacts"),
    ]
    return R.validate(manifests, [], model).withColumn("first_missing", F.try_element_at(missing, F.lit(1)))


def revisions(history: DataFrame, key: str = "video_id", order: list[str] = None) -> DataFrame:
    """revision numbers per video in update order; latest flagged."""
    order = order or ["updated_at", "job_id"]
    h = dense_positions(history, [key], order_bucket(history, order[0]), order, name="revision", start=1).withColumn(
        "revision", F.col("revision").cast("int"))
    last = h.groupBy(key).agg(F.max("revision").alias("_last"))
    return h.join(last, key).withColumn("is_latest", F.col("revision") == F.col("_last")).drop("_last")


def pending(videos: DataFrame, processed: DataFrame, key: str = "video_id") -> DataFrame:
    """Videos not processed yet."""
    return videos.join(processed.select(key).distinct(), key, "left_anti")


def cleanup_candidates(artifacts: DataFrame, refs: DataFrame, published: DataFrame, cutoff) -> DataFrame:
    """Artifacts whose last use is before ``cutoff`` and that no
    successful publication refers to."""
    last_use = refs.groupBy("key").agg(F.max("ref_at").alias("last_used"))
    old = artifacts.join(last_use, "key", "left").filter(
        F.col("last_used").isNull() | (F.col("last_used") < F.lit(cutoff).cast("timestamp")))
    return old.join(published.select("key").distinct(), "key", "left_anti")


def approval_flags(items: DataFrame, approvals: DataFrame, key: str) -> DataFrame:
    """D12 in one pass: every item with ``approved`` (a granted approval exists)."""
    granted = approvals.select(key).distinct().withColumn("approved", F.lit(True))
    return items.join(granted, key, "left").withColumn("approved", F.coalesce("approved", F.lit(False)))


def layout_paths(rows: DataFrame, video_id: str, stage: str, lang: str, source: str = "en",
                 root: str = LAYOUT_ROOT) -> DataFrame:
    """Every object of a row's stage: the columns of ``rows`` with
    ``artifact`` and ``path``; a stage that stores nothing gives no row."""
    fill = lambda path: path.replace("{lang}", lang).replace("{source}", source)
    table = F.array(*[F.struct(F.lit(s).alias("s"), F.lit(a).alias("a"), F.lit(fill(p)).alias("p")) for s, a, p in LAYOUT])
    own = rows.select("*", F.explode(F.filter(table, lambda x: x["s"] == F.col(stage))).alias("_o"))
    path = F.concat_ws("/", F.lit(root), F.col(video_id), F.col("_o.p"))
    return own.select("*", F.col("_o.a").alias("artifact"), path.alias("path")).drop("_o")


def quality_report(checks: DataFrame, key: str = "doc_id") -> DataFrame:
    """Checks folded per video: all passed?, failures, check list."""
    return checks.groupBy(key).agg(
        F.bool_and("passed").alias("passed"),
        F.count_if(~F.col("passed")).alias("n_failed"),
        F.array_join(F.array_sort(F.collect_list(F.concat_ws("=", "name", F.col("passed").cast("string")))), ",").alias("checks"))


def manifest_documents(manifests: DataFrame, sources: DataFrame, content_type: str = "application/octet-stream"
                       ) -> DataFrame:
    """A2 for manifests: one canonical JSON document per video in the
    contract's shape (artifacts and stage records as contract objects,
    instants as ISO text with ``Z``, absent optionals left out).

    ``sources``: (video_id, source) with ``source`` a video struct.
    """
    iso = lambda c: F.when(c.isNotNull(), iso_text(c))
    v = F.lit("1.0").alias("schema_version")
    art = F.transform_values("artifacts", lambda k, a: F.struct(
        v, a["uri"].alias("uri"), F.lit(content_type).alias("content_type"), a["size"].alias("size")))
    stage = F.transform_values("stages", lambda k, s: F.struct(
        v, s["job_type"].alias("job_type"), s["status"].alias("status"), s["job_id"].alias("job_id"),
        s["idempotency_key"].alias("idempotency_key"), s["input_artifacts"].alias("input_artifacts"),
        s["output_artifacts"].alias("output_artifacts"), s["parameters_sha256"].alias("parameters_sha256"),
        s["error"].alias("error"), iso(s["started_at"]).alias("started_at"),
        iso(s["completed_at"]).alias("completed_at")))
    doc = F.struct(v, F.col("video_id"), F.lit(1).cast("long").alias("revision"), F.col("source"),
                   art.alias("artifacts"), stage.alias("stages"),
                   iso(F.col("created_at")).alias("created_at"), iso(F.col("updated_at")).alias("updated_at"))
    return manifests.join(sources, "video_id", "left").select("video_id", F.to_json(doc).alias("raw"))


def parsed_manifest_rules(parsed: DataFrame) -> DataFrame:
    """V13–V16 on manifests read back from JSON (A1): instants parsed from
    their text, the source identity taken from the nested source video."""
    m = (parsed.withColumn("source_video_id", F.col("source.video_id"))
         .withColumn("created_at", aware_timestamp("created_at"))
         .withColumn("updated_at", aware_timestamp("updated_at")))
    return manifest_rules(m)
