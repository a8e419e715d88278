"""Manifest, artifact and render queries (§2.3 V13–V18, §2.5 D4/D5/D10–D12,
§2.6 G3/G5, §2.7 F7, §2.9 U1/U2, P26)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.time import ts_text
from tapeworks.operators import manifest as M
from tapeworks.operators.jobs import latest_stage
from tapeworks.operators import rules as R
from tapeworks.plans import bindings as B
from tapeworks.plans.catalog import register
from tapeworks.sources.contracts import CONTRACTS, RENDER_DEFAULTS, fill_struct_defaults, parse_contract
from tapeworks.sources.tables import table

CLEANUP_CUTOFF = "2001-01-01 00:00:00"  # ours: artifacts unused since before this may go
TARGET_LANG = "zh-CN"                   # ours: target language of the layout


def _ts_sql(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def _manifests(spark: SparkSession, sf: str) -> DataFrame:
    return M.build_manifests(B.stage_records(spark, sf), B.stage_refs(spark, sf), B.artifact_catalog(spark, sf))


_LATEST_STAGE_SQL = """ls AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY video_id, job_type
                                           ORDER BY updated_at DESC, job_id DESC) AS rn FROM stage_records) WHERE rn = 1)"""
_MISSING_SQL = """miss AS (
  SELECT ls.video_id, ls.job_type, string_agg(DISTINCT r.key, ', ' ORDER BY r.key) AS missing
  FROM ls JOIN stage_refs r ON ls.job_id = r.job_id
  WHERE r.key NOT IN (SELECT key FROM artifact_catalog)
  GROUP BY ls.video_id, ls.job_type)"""
_MBASE = ["stage_records", "stage_refs", "artifact_catalog"]


@register("missing_artifacts", B.with_sql(["stage_refs", "artifact_catalog"], """
SELECT video_id, job_id, direction, key FROM stage_refs WHERE key NOT IN (SELECT key FROM artifact_catalog)"""))
def missing_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """Stage references to artifacts that do not exist."""
    m = M.missing_artifacts(B.stage_refs(spark, sf), B.artifact_catalog(spark, sf))
    return m.select("video_id", "job_id", "direction", "key")


@register("stage_artifacts", B.with_sql(["stage_refs", "artifact_catalog"], """
SELECT r.video_id, r.job_id, r.direction, r.key, c.uri FROM stage_refs r JOIN artifact_catalog c ON r.key = c.key"""))
def stage_artifacts(spark: SparkSession, sf: str) -> DataFrame:
    """Stage inputs and outputs resolved to artifact URIs."""
    s = M.stage_artifacts(B.stage_refs(spark, sf), B.artifact_catalog(spark, sf))
    return s.select("video_id", "job_id", "direction", "key", "uri")


@register("stage_refs_union", B.with_sql(["stage_refs"], """
SELECT job_id, key FROM stage_refs WHERE direction = 'input'
UNION SELECT job_id, key FROM stage_refs WHERE direction = 'output'"""))
def stage_refs_union(spark: SparkSession, sf: str) -> DataFrame:
    """Per stage, inputs ∪ outputs as a set of keys."""
    return M.refs_union(B.stage_refs(spark, sf))


@register("stage_refs_except", B.with_sql(["stage_refs", "artifact_catalog"], """
SELECT job_id, key FROM stage_refs EXCEPT SELECT r.job_id, r.key FROM stage_refs r JOIN artifact_catalog c ON r.key = c.key"""))
def stage_refs_except(spark: SparkSession, sf: str) -> DataFrame:
    """Per stage, referenced keys minus known keys."""
    return M.refs_except(B.stage_refs(spark, sf), B.artifact_catalog(spark, sf)).select("job_id", "key")


@register("manifest_build", B.with_sql(_MBASE, f"""WITH {_LATEST_STAGE_SQL},
used AS (SELECT DISTINCT r.video_id, r.key FROM stage_refs r JOIN artifact_catalog c ON r.key = c.key),
art AS (SELECT u.video_id, count(*) AS n_artifacts, md5(string_agg(u.key || '=' || c.uri, ',' ORDER BY u.key)) AS artifacts
        FROM used u JOIN artifact_catalog c ON u.key = c.key GROUP BY u.video_id)
SELECT ls.video_id, max(art.artifacts) AS artifacts, string_agg(ls.job_type || '=' || ls.job_id || '/' || ls.status, ',' ORDER BY ls.job_type) AS stages, count(*) AS n_stages, string_agg(ls.job_type, ',' ORDER BY ls.job_type) AS stage_types,
       coalesce(max(art.n_artifacts), 0) AS n_artifacts,
       {_ts_sql('min(ls.started_at)')} AS created_at, {_ts_sql('max(ls.updated_at)')} AS updated_at
FROM ls LEFT JOIN art ON ls.video_id = art.video_id GROUP BY ls.video_id"""))
def manifest_build(spark: SparkSession, sf: str) -> DataFrame:
    """One manifest per video: latest stage per job type and the index of
    the artifacts its stages use."""
    m = _manifests(spark, sf)
    listed = lambda c, text: F.array_join(F.transform(F.array_sort(F.map_entries(c)), text), ",")
    stages = listed("stages", lambda e: F.concat(e["key"], F.lit("="), e["value"]["job_id"], F.lit("/"), e["value"]["status"]))
    artifacts = listed("artifacts", lambda e: F.concat(e["key"], F.lit("="), e["value"]["uri"]))
    return m.select("video_id", stages.alias("stages"), F.when(F.size("artifacts") > 0, F.md5(artifacts)).alias("artifacts"),
                    F.size("stages").cast("long").alias("n_stages"),
                    F.array_join(F.array_sort(F.map_keys("stages")), ",").alias("stage_types"),
                    F.size("artifacts").cast("long").alias("n_artifacts"),
                    ts_text("created_at").alias("created_at"), ts_text("updated_at").alias("updated_at"))


@register("rule_artifact_refs", B.with_sql(_MBASE, f"""WITH {_LATEST_STAGE_SQL}, {_MISSING_SQL}
SELECT video_id, job_type, missing FROM miss"""))
def rule_artifact_refs(spark: SparkSession, sf: str) -> DataFrame:
    """Per stage of each manifest, missing references sorted and joined."""
    return M.artifact_ref_violations(_manifests(spark, sf))


# Manifests with faults, by the last digit of the video: 3 names another source,
# 5 was updated before it was created, 8 has its stages under other names.


def _faulty_manifests(spark: SparkSession, sf: str) -> DataFrame:
    digit = F.substring("video_id", -1, 1)
    m = _manifests(spark, sf)
    other = F.map_from_entries(F.transform(F.map_entries("stages"), lambda e: F.struct(F.concat(F.lit("x_"), e["key"]), e["value"])))
    return (m.withColumn("source_video_id", F.when(digit == "3", F.lit("other")).otherwise(F.col("source_video_id")))
            .withColumn("updated_at", F.when(digit == "5", F.col("created_at") - F.expr("INTERVAL 1 DAY")).otherwise(F.col("updated_at")))
            .withColumn("stages", F.when(digit == "8", other).otherwise(F.col("stages"))))


def _mrules_sql(cond: str) -> str:
    return B.with_sql(_MBASE, f"""WITH {_LATEST_STAGE_SQL}, {_MISSING_SQL},
mb AS (SELECT video_id, right(video_id, 1) AS digit, min(started_at) AS created_at, max(updated_at) AS updated_at
       FROM ls GROUP BY video_id),
v AS (SELECT video_id, digit, digit = '5' OR updated_at < created_at AS early,
        CASE WHEN digit = '3' THEN 'manifest_identity' WHEN digit = '5' OR updated_at < created_at THEN 'manifest_time'
             WHEN digit = '8' THEN 'stage_key'
             WHEN EXISTS (SELECT 1 FROM miss WHERE miss.video_id = mb.video_id) THEN 'artifact_refs' END AS violation FROM mb)
SELECT video_id, {cond} AS ok, violation FROM v""")


@register("rule_manifest_identity", _mrules_sql("digit <> '3'"))
def rule_manifest_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest video_id equals its source's video_id (first violation shown)."""
    v = M.manifest_rules(_faulty_manifests(spark, sf))
    return v.select("video_id", (F.col("video_id") == F.col("source_video_id")).alias("ok"),
                    F.try_element_at("violations", F.lit(1))["code"].alias("violation"))


@register("rule_manifest_time", _mrules_sql("NOT early"))
def rule_manifest_time(spark: SparkSession, sf: str) -> DataFrame:
    """updated_at not before created_at."""
    v = M.manifest_rules(_faulty_manifests(spark, sf))
    return v.select("video_id", (F.col("updated_at") >= F.col("created_at")).alias("ok"),
                    F.try_element_at("violations", F.lit(1))["code"].alias("violation"))


@register("rule_stage_key", _mrules_sql("digit <> '8'"))
def rule_stage_key(spark: SparkSession, sf: str) -> DataFrame:
    """Every stage map key equals its record's job type."""
    v = M.manifest_rules(_faulty_manifests(spark, sf))
    ok = F.forall(F.map_entries("stages"), lambda e: e["key"] == e["value"]["job_type"])
    return v.select("video_id", ok.alias("ok"), F.try_element_at("violations", F.lit(1))["code"].alias("violation"))


@register("manifest_revisions", B.with_sql(["stage_records"], """
SELECT video_id, job_id, revision, revision = max(revision) OVER (PARTITION BY video_id) AS is_latest FROM (
  SELECT video_id, job_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY updated_at, job_id) AS INTEGER) AS revision
  FROM stage_records)"""))
def manifest_revisions(spark: SparkSession, sf: str) -> DataFrame:
    """every stage update is a manifest revision; the latest is flagged."""
    r = M.revisions(B.stage_records(spark, sf))
    return r.select("video_id", "job_id", "revision", "is_latest")


@register("pending_videos", B.with_sql(["stage_records"], """
SELECT 'vid' || c_custkey AS video_id FROM customer
WHERE 'vid' || c_custkey NOT IN (SELECT video_id FROM stage_records WHERE job_type = 'download' AND status = 'succeeded')"""))
def pending_videos(spark: SparkSession, sf: str) -> DataFrame:
    """Videos without a successful download yet."""
    videos = table(spark, sf, "customer").select(F.concat(F.lit("vid"), F.col("c_custkey").cast("string")).alias("video_id"))
    done = B.stage_records(spark, sf).filter((F.col("job_type") == "download") & (F.col("status") == "succeeded"))
    return M.pending(videos, done)


@register("cleanup_candidates", B.with_sql(["stage_records", "stage_refs", "artifact_catalog"], f"""
WITH lu AS (SELECT key, max(ref_at) AS last_used FROM stage_refs GROUP BY key),
pub AS (SELECT DISTINCT r.key FROM stage_refs r JOIN stage_records s ON r.job_id = s.job_id
        WHERE s.job_type = 'render_video' AND s.status = 'succeeded')
SELECT c.key FROM artifact_catalog c LEFT JOIN lu ON c.key = lu.key
WHERE (lu.last_used IS NULL OR lu.last_used < TIMESTAMP '{CLEANUP_CUTOFF}') AND c.key NOT IN (SELECT key FROM pub)"""))
def cleanup_candidates(spark: SparkSession, sf: str) -> DataFrame:
    """Expired artifacts no successful publication refers to."""
    refs = B.stage_refs(spark, sf)
    published = refs.join(B.stage_records(spark, sf).filter(
        (F.col("job_type") == "render_video") & (F.col("status") == "succeeded")).select("job_id"), "job_id")
    return M.cleanup_candidates(B.artifact_catalog(spark, sf), refs, published, CLEANUP_CUTOFF).select("key")


@register("approval_gate", """
SELECT doc_id, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 AND toxic = 0) AS approved FROM documents""")
def approval_gate(spark: SparkSession, sf: str) -> DataFrame:
    """Documents go on only with a granted approval; the rest are blocked."""
    docs = table(spark, sf, "documents").select("doc_id")
    approvals = table(spark, sf, "labels").filter((F.col("quality") == 1) & (F.col("toxic") == 0))
    return M.approval_flags(docs, approvals, "doc_id")


_LAYOUT_SQL = ", ".join(f"('{s}', '{a}', '{p.replace('{lang}', TARGET_LANG).replace('{source}', 'en')}')" for s, a, p in M.LAYOUT)


@register("artifact_layout", B.with_sql(["stage_records"], f"""WITH {_LATEST_STAGE_SQL}
SELECT video_id, job_type, artifact, '{M.LAYOUT_ROOT}/' || video_id || '/' || path AS path
FROM ls JOIN (VALUES {_LAYOUT_SQL}) l(stage, artifact, path) ON job_type = stage"""))
def artifact_layout(spark: SparkSession, sf: str) -> DataFrame:
    """Where every artifact of each stage of a video is stored."""
    ls = latest_stage(B.stage_records(spark, sf)).select("video_id", "job_type")
    return M.layout_paths(ls, "video_id", "job_type", TARGET_LANG)


@register("quality_report", """
SELECT doc_id, quality = 1 AND toxic = 0 AS passed,
  CAST(CASE WHEN quality = 1 THEN 0 ELSE 1 END + CASE WHEN toxic = 0 THEN 0 ELSE 1 END AS BIGINT) AS n_failed,
  'quality=' || CASE WHEN quality = 1 THEN 'true' ELSE 'false' END || ',toxicity=' ||
  CASE WHEN toxic = 0 THEN 'true' ELSE 'false' END AS checks
FROM labels""")
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Media quality checks folded into one report per item."""
    lab = table(spark, sf, "labels")
    checks = lab.select("doc_id", F.lit("quality").alias("name"), (F.col("quality") == 1).alias("passed")).unionByName(
        lab.select("doc_id", F.lit("toxicity").alias("name"), (F.col("toxic") == 0).alias("passed")))
    return M.quality_report(checks)


# ------------------------------------------------------------------ render requests
# orders → render requests: priority → audio strategy (5 → default),
# status P burns subtitles, expensive orders re-encode; which optional audio
# and subtitle inputs exist depends on status, price and date.

_STRATEGY = (("1-URGENT", "subtitle_only"), ("2-HIGH", "voice_overlay"), ("3-MEDIUM", "voice_replace"),
             ("4-NOT SPECIFIED", "silent_bed"))


def _render_requests(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    strat = None
    for p, s in _STRATEGY:
        strat = F.when(F.col("o_orderpriority") == p, F.lit(s)) if strat is None else strat.when(F.col("o_orderpriority") == p, F.lit(s))
    art = lambda name: F.struct(F.concat(F.lit(f"s3://render/{name}/"), F.col("o_orderkey").cast("string")).alias("uri"))
    settings = F.struct(strat.alias("audio_strategy"), (F.col("o_orderstatus") == "P").alias("burn_subtitles"),
                        F.when(F.col("o_totalprice") > 200000, F.lit("libx264")).otherwise(F.lit("copy")).alias("video_codec"))
    return o.select("o_orderkey", settings.alias("settings"),
                    F.when(F.col("o_orderstatus") != "O", art("dub")).alias("dubbed_audio"),
                    F.when(F.col("o_totalprice") > 150000, art("acc")).alias("accompaniment_audio"),
                    F.when(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"), art("ass")).alias("subtitle_ass"))


_RENDER_SQL = """rr AS (
  SELECT o_orderkey,
    coalesce(CASE o_orderpriority WHEN '1-URGENT' THEN 'subtitle_only' WHEN '2-HIGH' THEN 'voice_overlay'
      WHEN '3-MEDIUM' THEN 'voice_replace' WHEN '4-NOT SPECIFIED' THEN 'silent_bed' END, 'subtitle_only') AS strategy,
    o_orderstatus = 'P' AS burn, CASE WHEN o_totalprice > 200000 THEN 'libx264' ELSE 'copy' END AS codec,
    o_orderstatus <> 'O' AS has_dub, o_totalprice > 150000 AS has_acc, o_orderdate < TIMESTAMP '1998-01-01' AS has_ass
  FROM orders)"""


@register("rule_render_settings", f"""WITH {_RENDER_SQL}
SELECT o_orderkey, NOT (burn AND codec = 'copy') AS ok FROM rr""")
def rule_render_settings(spark: SparkSession, sf: str) -> DataFrame:
    """Burned subtitles need a re-encoding codec."""
    r = fill_struct_defaults(_render_requests(spark, sf), "settings", RENDER_DEFAULTS)   # S5 nested
    return r.select("o_orderkey", R.render_settings_rule().ok.alias("ok"))


@register("rule_render_request", f"""WITH {_RENDER_SQL}
SELECT o_orderkey, CASE
  WHEN burn AND codec = 'copy' THEN 'render_settings'
  WHEN burn AND NOT has_ass THEN 'render_needs_ass'
  WHEN strategy IN ('voice_overlay', 'voice_replace', 'silent_bed') AND NOT has_dub THEN 'render_needs_dub'
  WHEN strategy = 'voice_replace' AND NOT has_acc THEN 'render_needs_accompaniment' END AS violation
FROM rr""")
def rule_render_request(spark: SparkSession, sf: str) -> DataFrame:
    """V18 (after V17 on the nested settings): inputs the strategy needs."""
    r = fill_struct_defaults(_render_requests(spark, sf), "settings", RENDER_DEFAULTS)   # S5 nested
    v = R.validate(r, [R.render_settings_rule()], R.render_request_rules())
    return v.select("o_orderkey", F.try_element_at("violations", F.lit(1))["code"].alias("violation"))


@register("manifest_contract", B.with_sql(_MBASE, f"""WITH {_LATEST_STAGE_SQL}, {_MISSING_SQL},
used AS (SELECT DISTINCT r.video_id, r.key FROM stage_refs r JOIN artifact_catalog c ON r.key = c.key),
art AS (SELECT video_id, count(*) AS n_artifacts FROM used GROUP BY video_id),
mb AS (SELECT video_id, count(*) AS n_stages, min(started_at) AS created_at, max(updated_at) AS updated_at
       FROM ls GROUP BY video_id)
SELECT mb.video_id, mb.n_stages, coalesce(art.n_artifacts, 0) AS n_artifacts, '' AS unknown_fields,
  CASE WHEN mb.updated_at < mb.created_at THEN 'manifest_time'
       WHEN EXISTS (SELECT 1 FROM miss WHERE miss.video_id = mb.video_id) THEN 'artifact_refs' END AS violation
FROM mb LEFT JOIN art ON mb.video_id = art.video_id"""))
def manifest_contract(spark: SparkSession, sf: str) -> DataFrame:
    """Manifest document life cycle: built manifests written as canonical
    JSON (A2), read back strictly (A1: fixed schema, unknown fields at every
    level including map values), then the cross-field rules (V13–V16)."""
    docs = M.manifest_documents(_manifests(spark, sf), B.manifest_sources(spark, sf))
    parsed = parse_contract(docs.select("raw"), "raw", CONTRACTS["video_manifest"])
    v = M.parsed_manifest_rules(parsed)
    return v.select("video_id", F.size("stages").cast("long").alias("n_stages"),
                    F.size("artifacts").cast("long").alias("n_artifacts"),
                    F.array_join("unknown_fields", ",").alias("unknown_fields"),
                    F.try_element_at("violations", F.lit(1))["code"].alias("violation"))
