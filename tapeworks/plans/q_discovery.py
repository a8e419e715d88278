"""Discovery queries over the driver tables (§2.1 A3, §2.4 P1–P12, §2.5 D1–D3,
§2.6 G1/G8/G9, §2.7 F1–F5/F8, §2.8 L4, §2.9 U3/U4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.text import resource_id
from tapeworks.functions.time import aware_timestamp, duration_ms, duration_ok, has_offset, ts_text
from tapeworks.functions.uri import channel_uploads_uri, video_uri
from tapeworks.operators import discovery as D
from tapeworks.operators.payload import message_payload
from tapeworks.plans import bindings as B
from tapeworks.plans.catalog import register
from tapeworks.sources.pages import read_pages

# Query parameters (ours; the reference takes them per call).
AFTER = "2024-01-03T00:00:00Z"
AFTER_SQL = "2024-01-03 00:00:00"
BEFORE = "2024-01-29T00:00:00Z"
BEFORE_SQL = "2024-01-29 00:00:00"
K = 100
EARLY, EARLY_SQL = "2024-01-10T00:00:00Z", "2024-01-10 00:00:00"   # lower bound of the early-stop query

_ID_RE = "^[A-Za-z0-9_-]+$"
_DUR_RE = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?$"
_TS_WINDOW_RE = r"^\d{4}-\d{2}-\d{2}(?:[Tt ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?(?:Z|[+-]\d{2}(?::?\d{2})?)$"
_HTTP_RE = r"(?i)^https?://[^/?#\s@]*[^/?#\s:@][^/?#\s]*(?:[/?#]\S*)?$"
_TS_CONTRACT_RE = r"^\d{4}-\d{2}-\d{2}(?:[Tt ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?(?:[Zz]|[+-]\d{2}:?\d{2})$"
_EPOCH_RE = r"^-?\d+(?:\.\d+)?$"


def _dur_sql(x: str) -> str:
    part = lambda i: f"coalesce(try_cast(nullif(regexp_extract({x}, '{_DUR_RE}', {i}), '') AS DOUBLE), 0)"
    secs = f"({part(1)} * 86400 + {part(2)} * 3600 + {part(3)} * 60 + {part(4)})"
    return f"(CASE WHEN regexp_matches({x}, '{_DUR_RE}') THEN CAST(round_even({secs} * 1000, 0) AS BIGINT) END)"


def _ts_sql(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S.%f')"


def _iso_sql(x: str, suffix: str) -> str:
    return (f"(CASE WHEN epoch_us({x}) % 1000000 = 0 THEN strftime({x}, '%Y-%m-%dT%H:%M:%S') "
            f"ELSE strftime({x}, '%Y-%m-%dT%H:%M:%S.%f') END || '{suffix}')")


PARSED_SQL = f"""pv0 AS (
  SELECT *, trim(id) AS vid, trim(channelId) AS cid,
    CASE WHEN regexp_matches(trim(publishedAt), '{_TS_WINDOW_RE}')
         THEN timezone('UTC', try_cast(trim(publishedAt) AS TIMESTAMPTZ)) END AS pub_ts,
    coalesce(nullif(t_maxres, ''), nullif(t_standard, ''), nullif(t_high, ''), nullif(t_medium, ''),
             nullif(t_default, '')) AS thumb
  FROM video_items),
pv1 AS (
  SELECT *, CASE
    WHEN NOT coalesce(regexp_matches(vid, '{_ID_RE}'), false) THEN 'bad_video_id'
    WHEN NOT coalesce(regexp_matches(cid, '{_ID_RE}'), false) THEN 'bad_channel_id'
    WHEN coalesce(title, '') = '' THEN 'incomplete_metadata'
    WHEN coalesce(publishedAt, '') = '' THEN 'incomplete_metadata'
    WHEN pub_ts IS NULL THEN 'bad_timestamp'
    WHEN NOT (duration IS NULL OR regexp_matches(duration, '{_DUR_RE}')) THEN 'bad_duration'
    WHEN length(trim(title)) = 0 THEN 'incomplete_metadata'
  END AS error FROM pv0),
parsed_videos AS (
  SELECT CASE WHEN error IS NULL THEN vid ELSE id END AS video_id,
    CASE WHEN error IS NULL THEN cid END AS channel_id,
    CASE WHEN error IS NULL THEN trim(nullif(channelTitle, '')) END AS channel_title,
    CASE WHEN error IS NULL THEN trim(title) END AS title,
    CASE WHEN error IS NULL THEN trim(nullif(description, '')) END AS description,
    CASE WHEN error IS NULL THEN pub_ts END AS published_at,
    CASE WHEN error IS NULL THEN 'https://www.youtube.com/watch?v=' || vid END AS source_url,
    CASE WHEN error IS NULL AND regexp_matches(trim(thumb), '{_HTTP_RE}') THEN trim(thumb) END AS thumbnail_url,
    CASE WHEN error IS NULL THEN {_dur_sql('duration')} END AS duration_ms,
    CASE WHEN error IS NULL THEN trim(coalesce(nullif(defaultLanguage, ''), nullif(defaultAudioLanguage, ''))) END
      AS default_language,
    error, fetch_seq
  FROM pv1),
good_videos AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY video_id ORDER BY fetch_seq DESC) AS rn
    FROM parsed_videos WHERE error IS NULL) WHERE rn = 1)"""


def _found_sql(items: str, after: str | None, before: str | None, k: int, tokens: bool = True) -> str:
    stop = (f"""stopcut AS (SELECT playlist_id, min(CASE WHEN published_at < TIMESTAMP '{after}' THEN page END) AS cut
             FROM rows GROUP BY playlist_id),""" if after else
            "stopcut AS (SELECT playlist_id, CAST(NULL AS BIGINT) AS cut FROM rows GROUP BY playlist_id),")
    win = []
    if after:
        win.append(f"r.published_at >= TIMESTAMP '{after}'")
    if before:
        win.append(f"r.published_at < TIMESTAMP '{before}'")
    wsql = " AND ".join(win) if win else "TRUE"
    return f"""{PARSED_SQL},
cand AS (
  SELECT playlist_id, video_id, page, pos FROM (
    SELECT *, row_number() OVER (PARTITION BY playlist_id, video_id ORDER BY page, pos) AS rn
    FROM {items} WHERE video_id IS NOT NULL AND video_id <> '') WHERE rn = 1),
rows AS (SELECT c.playlist_id, c.page, c.pos, v.* FROM cand c JOIN good_videos v USING (video_id)),
pgs AS (SELECT DISTINCT playlist_id, page, next_token FROM {items}),
firstuse AS (SELECT playlist_id, next_token, min(page) AS first_page FROM pgs
             WHERE next_token IS NOT NULL GROUP BY playlist_id, next_token),
tokcut AS (
  SELECT p.playlist_id, min(CASE WHEN p.next_token IS NULL OR p.page > f.first_page THEN p.page END) AS cut
  FROM pgs p LEFT JOIN firstuse f ON p.playlist_id = f.playlist_id AND p.next_token = f.next_token
  GROUP BY p.playlist_id),
{stop}
kept AS (
  SELECT r.* FROM rows r LEFT JOIN tokcut t ON r.playlist_id = t.playlist_id
  LEFT JOIN stopcut s ON r.playlist_id = s.playlist_id
  WHERE ({'t.cut IS NULL' if tokens else 'true'} OR r.page <= t.cut) AND (s.cut IS NULL OR r.page <= s.cut) AND {wsql}),
found AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY playlist_id ORDER BY page, pos) AS rank FROM kept)
  WHERE rank <= {k})"""


def _videos(spark: SparkSession, sf: str) -> DataFrame:
    parsed = D.parse_video(B.video_items(spark, sf)).filter(F.col("error").isNull()).drop("error")
    return D.latest_payload(parsed)


def _found(spark: SparkSession, sf: str, order: str = "newest", after=AFTER, before=BEFORE, k=K) -> DataFrame:
    return D.discover(B.stored_items(spark, sf, order), _videos(spark, sf), after, before, k)


_ITEMS = "playlist_items"
_SHUF = "playlist_shuffled"
_B_VID = ["video_items"]


# ------------------------------------------------------------------ G1 (flagship)

@register("channel_events", B.with_sql([_ITEMS] + _B_VID, f"""WITH {_found_sql(_ITEMS, AFTER_SQL, BEFORE_SQL, K)}
SELECT 'youtube://channel/' || channel_id || '/uploads' AS uri, channel_id,
       count(*) AS video_count,
       array_to_string(list(video_id ORDER BY page, pos)[1:50], ',') AS video_ids,
       '2024-01-03T00:00:00+00:00' AS published_after, '2024-01-29T00:00:00+00:00' AS published_before
FROM found GROUP BY channel_id"""))
def channel_events(spark: SparkSession, sf: str) -> DataFrame:
    """G1 over the whole discovery chain: pages → dedupe → lookup → cuts →
    half-open window → per-channel limit → one event per non-empty channel."""
    ev = D.channel_events(_found(spark, sf), AFTER, BEFORE)
    return ev.withColumn("video_ids", F.array_join("video_ids", ","))


# ------------------------------------------------------------------ D2 / L1 / U4

@register("channel_videos", B.with_sql([_ITEMS] + _B_VID, f"""WITH {_found_sql(_ITEMS, AFTER_SQL, BEFORE_SQL, K)},
channels AS (SELECT DISTINCT channel_id, playlist_id FROM publications)
SELECT c.channel_id, f.playlist_id, f.page, f.pos, f.rank, f.video_id, f.title,
       {_ts_sql('f.published_at')} AS published_at, f.duration_ms, f.thumbnail_url, f.default_language
FROM channels c JOIN found f ON c.playlist_id = f.playlist_id"""))
def channel_videos(spark: SparkSession, sf: str) -> DataFrame:
    """Every channel → its uploads playlist → its discovered videos, all
    channels in one plan (U4), rank = playlist order (L1)."""
    channels = B.publications(spark, sf).select("channel_id", "playlist_id").distinct()
    found = _found(spark, sf).drop("channel_id")
    return channels.join(found, "playlist_id").select(
        "channel_id", "playlist_id", "page", "pos", "rank", "video_id", "title",
        ts_text("published_at").alias("published_at"), "duration_ms", "thumbnail_url", "default_language")


# ------------------------------------------------------------------ P1, P3, P4

@register("parse_video", B.with_sql(_B_VID, f"""WITH {PARSED_SQL}
SELECT video_id, channel_id, channel_title, title, description, {_ts_sql('published_at')} AS published_at,
       source_url, thumbnail_url, duration_ms, default_language, error
FROM parsed_videos"""))
def parse_video(spark: SparkSession, sf: str) -> DataFrame:
    """P1 with P3–P8: nested API items → contract video rows or error rows."""
    v = D.parse_video(B.video_items(spark, sf))
    return v.select("video_id", "channel_id", "channel_title", "title", "description",
                    ts_text("published_at").alias("published_at"), "source_url", "thumbnail_url",
                    "duration_ms", "default_language", "error")


@register("duration_ms", B.with_sql(_B_VID, f"""
SELECT id AS video_id, duration, {_dur_sql('duration')} AS duration_ms,
       (duration IS NULL OR regexp_matches(duration, '{_DUR_RE}')) AS duration_ok
FROM video_items"""))
def duration_ms_q(spark: SparkSession, sf: str) -> DataFrame:
    """ISO-8601 duration text → milliseconds (half-even), with validity."""
    v = B.video_items(spark, sf)
    d = F.col("contentDetails.duration")
    return v.select(F.col("id").alias("video_id"), d.alias("duration"),
                    duration_ms(d).alias("duration_ms"), duration_ok(d).alias("duration_ok"))


@register("utc_timestamp", B.with_sql(_B_VID, f"""
SELECT id AS video_id, publishedAt AS text,
       regexp_matches(trim(publishedAt), '{_TS_WINDOW_RE}') AS has_offset,
       {_ts_sql("CASE WHEN regexp_matches(trim(publishedAt), '" + _TS_WINDOW_RE + "') THEN timezone('UTC', try_cast(trim(publishedAt) AS TIMESTAMPTZ)) END")} AS utc,
       regexp_matches(trim(publishedAt), '{_TS_CONTRACT_RE}') OR regexp_matches(trim(publishedAt), '{_EPOCH_RE}')
         AS has_offset_contract,
       {_ts_sql("CASE WHEN regexp_matches(trim(publishedAt), '" + _EPOCH_RE + "') THEN timezone('UTC', to_timestamp(CAST(trim(publishedAt) AS DOUBLE))) WHEN regexp_matches(trim(publishedAt), '" + _TS_CONTRACT_RE + "') THEN timezone('UTC', try_cast(trim(publishedAt) AS TIMESTAMPTZ)) END")} AS utc_contract
FROM video_items"""))
def utc_timestamp(spark: SparkSession, sf: str) -> DataFrame:
    """P4 + V2: timestamp text → UTC instant under both grammars (API text
    and window arguments; contract fields, which also take epoch seconds);
    naive text gives null."""
    v = B.video_items(spark, sf)
    t = F.col("snippet.publishedAt")
    return v.select(F.col("id").alias("video_id"), t.alias("text"),
                    has_offset(t, "window").alias("has_offset"),
                    ts_text(aware_timestamp(t, "window")).alias("utc"),
                    has_offset(t, "contract").alias("has_offset_contract"),
                    ts_text(aware_timestamp(t, "contract")).alias("utc_contract"))


# ------------------------------------------------------------------ A3, F2, F3, F8

@register("pages_explode", B.with_sql([_ITEMS], """
WITH p AS (SELECT *, page % 7 AS way, '{"playlistId":"' || playlist_id || '","page":' || page AS head FROM playlist_items)
SELECT playlist_id, page, pos, video_id, next_token, 'ok' AS state, CAST(NULL AS VARCHAR) AS raw FROM p WHERE way NOT IN (3, 4, 5)
UNION ALL
SELECT DISTINCT CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), 'broken', head || ',"items":[{' FROM p WHERE way = 3
UNION ALL
SELECT DISTINCT playlist_id, page, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), next_token, CASE way WHEN 4 THEN 'no_items' ELSE 'empty_items' END, CAST(NULL AS VARCHAR)
FROM p WHERE way IN (4, 5)"""))
def pages_explode(spark: SparkSession, sf: str) -> DataFrame:
    """A3: page documents written as JSON files and read back with a fixed
    schema → one row per item with its position; pages without items keep a
    row, broken pages are quarantined with their text."""
    pages = read_pages(spark, B.page_files(spark, sf))
    items = D.explode_pages(pages.where("state <> 'broken'")).select(
        "playlist_id", "page", F.col("pos").cast("long").alias("pos"), "video_id", "next_token", "state", F.lit(None).cast("string").alias("raw"))
    none = lambda kind: F.lit(None).cast(kind)
    broken = pages.where("state = 'broken'").select(none("string"), none("long"), none("long"), none("string"), none("string"), "state", "raw")
    return items.unionAll(broken)


@register("page_dedupe", B.with_sql([_SHUF], """
SELECT playlist_id, video_id, page, pos FROM (
  SELECT playlist_id, page, pos, 'v' || (CAST(substr(video_id, 2) AS BIGINT) % 40) AS video_id,
         row_number() OVER (PARTITION BY playlist_id, CAST(substr(video_id, 2) AS BIGINT) % 40 ORDER BY page, pos) AS rn
  FROM playlist_shuffled) WHERE rn = 1"""))
def page_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """candidate IDs across all pages of a playlist, first sighting kept
    (pages here name forty IDs again and again)."""
    again = F.concat(F.lit("v"), (F.substring("video_id", 2, 20).cast("long") % 40).cast("string"))
    items = B.playlist_items(spark, sf, "shuffled").withColumn("video_id", again)
    return D.page_dedupe(items).select("playlist_id", "video_id", "page", "pos")


@register("early_stop", B.with_sql([_SHUF] + _B_VID, f"""WITH {_found_sql(_SHUF, EARLY_SQL, BEFORE_SQL, 200, tokens=False)}
SELECT playlist_id, page, pos, video_id FROM kept"""))
def early_stop(spark: SparkSession, sf: str) -> DataFrame:
    """F3 on a playlist whose order crosses the lower bound early: rows on
    pages after the first page with an older video are never read."""
    cand = D.page_dedupe(B.stored_items(spark, sf, "shuffled")).drop("next_token")
    rows = cand.join(_videos(spark, sf), "video_id")
    kept = D.apply_cuts(rows, D.early_stop_cut(rows, EARLY))
    return D.window_half_open(kept, "published_at", EARLY, BEFORE).select("playlist_id", "page", "pos", "video_id")


@register("token_cycle_cut", B.with_sql([_SHUF], """
WITH pgs AS (SELECT DISTINCT playlist_id, page, next_token FROM playlist_shuffled),
firstuse AS (SELECT playlist_id, next_token, min(page) AS first_page FROM pgs
             WHERE next_token IS NOT NULL GROUP BY playlist_id, next_token)
SELECT p.playlist_id, min(CASE WHEN p.next_token IS NULL OR p.page > f.first_page THEN p.page END) AS token_cut
FROM pgs p LEFT JOIN firstuse f ON p.playlist_id = f.playlist_id AND p.next_token = f.next_token
GROUP BY p.playlist_id"""))
def token_cycle_cut(spark: SparkSession, sf: str) -> DataFrame:
    """F8: the page after which a playlist's token chain stops (a repeated
    next-page token ends the chain; the page carrying it is still read)."""
    pages = B.playlist_items(spark, sf, "shuffled").select("playlist_id", "page", "next_token").distinct()
    return D.token_cycle_cut(pages)


# ------------------------------------------------------------------ V27, F5, F1, F4

@register("window_half_open", f"""
SELECT 'v' || event_id AS video_id, 'UC' || user_id AS channel_id, {_ts_sql('ts')} AS published_at
FROM events WHERE ts >= TIMESTAMP '{AFTER_SQL}' AND ts < TIMESTAMP '{BEFORE_SQL}'""")
def window_half_open(spark: SparkSession, sf: str) -> DataFrame:
    """Publications with after <= published_at < before (pushed to the scan)."""
    p = D.window_half_open(B.publications(spark, sf), "published_at", AFTER, BEFORE)
    return p.select("video_id", "channel_id", ts_text("published_at").alias("published_at"))


@register("top_k_per_channel", B.with_sql(["publications"], f"""
SELECT channel_id, video_id, {_ts_sql('published_at')} AS published_at, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id ORDER BY published_at DESC, event_id DESC) AS rank
  FROM publications) WHERE rank <= {K}"""))
def top_k_per_channel(spark: SparkSession, sf: str) -> DataFrame:
    """newest ``K`` publications per channel (WindowGroupLimit)."""
    p = B.publications(spark, sf)
    top = D.top_k_per_group(p, ["channel_id"], [F.col("published_at").desc(), F.col("event_id").desc()], K)
    return top.select("channel_id", "video_id", ts_text("published_at").alias("published_at"), "rank")


@register("dedupe_keep_first", B.with_sql(["publications"], f"""
SELECT channel_id, title, video_id, {_ts_sql('published_at')} AS published_at FROM (
  SELECT *, row_number() OVER (PARTITION BY channel_id, title ORDER BY published_at, event_id) AS rn
  FROM publications) WHERE rn = 1"""))
def dedupe_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """first publication per (channel, title) in input order."""
    p = B.publications(spark, sf).select("channel_id", "title", "video_id", "published_at", "event_id")
    first = D.dedupe_keep_first(p, ["channel_id", "title"], ["published_at", "event_id"])
    return first.select("channel_id", "title", "video_id", ts_text("published_at").alias("published_at"))


@register("batch_ids", B.with_sql(["video_requests"], """
SELECT request_id, pos, video_id, CAST(floor((row_number() OVER (PARTITION BY request_id ORDER BY pos, video_id) - 1) / 50) AS BIGINT) AS batch
FROM (SELECT request_id, video_id, min(pos) AS pos FROM (SELECT request_id, pos, trim(video_id) AS video_id FROM video_requests)
      WHERE regexp_matches(video_id, '^[A-Za-z0-9_-]+$') GROUP BY request_id, video_id)
WHERE request_id IN (SELECT request_id FROM video_requests WHERE regexp_matches(trim(video_id), '^[A-Za-z0-9_-]+$')
                     GROUP BY request_id HAVING count(DISTINCT trim(video_id)) <= 200)"""))
def batch_ids(spark: SparkSession, sf: str) -> DataFrame:
    """unique requested IDs numbered into lookup batches of 50 per request."""
    req = D.normalize_requests(B.video_requests(spark, sf)).filter(F.col("error").isNull()).drop("error")
    return D.batch_ids(req, "request_id", "pos").select("request_id", "pos", "video_id", "batch")


# ------------------------------------------------------------------ D3, L4

@register("ordered_lookup", B.with_sql(["video_requests"] + _B_VID, f"""WITH {PARSED_SQL},
norm AS (SELECT request_id, pos, trim(video_id) AS video_id FROM video_requests),
good AS (SELECT request_id, video_id, min(pos) AS pos FROM norm
         WHERE regexp_matches(video_id, '^[A-Za-z0-9_-]+$') GROUP BY request_id, video_id),
refused AS (SELECT DISTINCT request_id FROM norm WHERE NOT coalesce(regexp_matches(video_id, '^[A-Za-z0-9_-]+$'), false)
            UNION SELECT request_id FROM good GROUP BY request_id HAVING count(*) > 200)
SELECT g.request_id, g.pos, g.video_id, v.title, {_ts_sql('v.published_at')} AS published_at
FROM good g JOIN good_videos v ON g.video_id = v.video_id
WHERE g.request_id NOT IN (SELECT request_id FROM refused)"""))
def ordered_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """D3 + L2: metadata for requested IDs in requested order; unknown IDs vanish."""
    out = D.ordered_lookup(B.video_requests(spark, sf), _videos(spark, sf))
    return out.select("request_id", "pos", "video_id", "title", ts_text("published_at").alias("published_at"))


@register("request_size_rule", B.with_sql(["video_requests"], """
SELECT request_id, count(DISTINCT trim(video_id)) AS unique_ids, count(DISTINCT trim(video_id)) > 200 AS too_many
FROM video_requests WHERE regexp_matches(trim(video_id), '^[A-Za-z0-9_-]+$') GROUP BY request_id"""))
def request_size_rule(spark: SparkSession, sf: str) -> DataFrame:
    """L4: a lookup may name at most 200 unique IDs."""
    req = D.normalize_requests(B.video_requests(spark, sf)).filter(
        F.col("error").isNull() | (F.col("error") != "bad_video_id"))
    return req.groupBy("request_id").agg(F.count("*").alias("unique_ids"),
                                         F.max(F.col("error").isNotNull()).alias("too_many"))


# ------------------------------------------------------------------ D1, G8, P2

@register("normalize_references", B.with_sql(["channel_refs"], """
SELECT ref, pos, NULL::VARCHAR AS error FROM (SELECT trim(ref) AS ref, min(pos) AS pos FROM channel_refs
  WHERE trim(ref) <> '' GROUP BY trim(ref))
UNION ALL SELECT trim(ref) AS ref, pos, 'blank_reference' AS error FROM channel_refs WHERE coalesce(trim(ref), '') = ''"""))
def normalize_references(spark: SparkSession, sf: str) -> DataFrame:
    """Strip, refuse blanks, keep first of duplicates (order kept in pos)."""
    return D.normalize_references(B.channel_refs(spark, sf)).select("ref", "pos", "error")


_RESOLVE_SQL = """WITH norm AS (
  SELECT trim(ref) AS ref, min(pos) AS pos FROM channel_refs WHERE trim(ref) <> '' GROUP BY trim(ref)),
h AS (SELECT ref, pos, CASE WHEN starts_with(ref, '@') THEN substr(ref, 2) END AS name FROM norm),
hv AS (SELECT *, CASE WHEN name IS NOT NULL AND length(name) > 0 AND NOT starts_with(name, '@')
                       AND NOT contains(name, '/') AND NOT regexp_matches(name, '\\s') THEN name END AS okname FROM h),
j AS (SELECT hv.*, c.id AS cid FROM hv LEFT JOIN channel_items c ON lower(hv.okname) = lower(c.handle)),
e AS (SELECT pos, ref,
        CASE WHEN starts_with(ref, '@') AND okname IS NULL THEN 'bad_handle'
             WHEN starts_with(ref, '@') AND cid IS NULL THEN 'handle_not_found' END AS error,
        CASE WHEN starts_with(ref, '@') THEN cid ELSE ref END AS chan FROM j),
ok AS (SELECT channel_id, arg_min(pos, pos) AS pos, arg_min(ref, pos) AS ref FROM
        (SELECT chan AS channel_id, pos, ref FROM e WHERE error IS NULL) GROUP BY channel_id)
SELECT pos, ref, channel_id, NULL::VARCHAR AS error FROM ok
UNION ALL SELECT pos, ref, NULL AS channel_id, error FROM e WHERE error IS NOT NULL
UNION ALL SELECT pos, trim(ref) AS ref, NULL AS channel_id, 'blank_reference' FROM channel_refs
  WHERE coalesce(trim(ref), '') = ''"""


@register("resolve_channels", B.with_sql(["channel_refs", "channel_items"], _RESOLVE_SQL))
def resolve_channels(spark: SparkSession, sf: str) -> DataFrame:
    """Channel references (handles or IDs) → permanent channel IDs."""
    dim = B.channel_items(spark, sf).select(F.col("id").alias("channel_id"), "handle")
    return D.resolve_channels(B.channel_refs(spark, sf), dim).select("pos", "ref", "channel_id", "error")


@register("parse_channel", B.with_sql(["channel_items"], f"""
SELECT trim(id) AS channel_id,
  CASE WHEN coalesce(uploads, '') = '' OR coalesce(title, '') = '' THEN NULL ELSE trim(title) END AS title,
  CASE WHEN coalesce(uploads, '') = '' OR coalesce(title, '') = '' THEN NULL ELSE trim(nullif(description, '')) END AS description,
  CASE WHEN coalesce(uploads, '') = '' OR coalesce(title, '') = '' THEN NULL
       ELSE {_ts_sql("timezone('UTC', try_cast(publishedAt AS TIMESTAMPTZ))")} END AS published_at,
  CASE WHEN coalesce(uploads, '') = '' OR coalesce(title, '') = '' THEN NULL ELSE trim(uploads) END AS uploads_playlist_id,
  CASE WHEN coalesce(uploads, '') = '' OR coalesce(title, '') = '' THEN 'incomplete_metadata' END AS error
FROM channel_items"""))
def parse_channel(spark: SparkSession, sf: str) -> DataFrame:
    """Nested channel items → channel rows; missing uploads/title → error."""
    c = D.parse_channel(B.channel_items(spark, sf))
    return c.select("channel_id", "title", "description", ts_text("published_at").alias("published_at"),
                    "uploads_playlist_id", "error")


# ------------------------------------------------------------------ P9, P10, P11, P12, G9, U3

@register("dataset_uri", B.with_sql(["channel_refs"], """
SELECT pos, ref,
  CASE WHEN regexp_matches(trim(ref), '^[A-Za-z0-9_-]+$') THEN 'youtube://channel/' || trim(ref) || '/uploads' END AS channel_uri,
  CASE WHEN regexp_matches(trim(ref), '^[A-Za-z0-9_-]+$') THEN 'youtube://video/' || trim(ref) END AS video_uri
FROM channel_refs"""))
def dataset_uri(spark: SparkSession, sf: str) -> DataFrame:
    """Stable dataset URIs; IDs with other characters give null."""
    r = B.channel_refs(spark, sf)
    return r.select("pos", "ref", channel_uploads_uri("ref").alias("channel_uri"), video_uri("ref").alias("video_uri"))


@register("video_event", B.with_sql([_ITEMS] + _B_VID, f"""WITH {_found_sql(_ITEMS, AFTER_SQL, BEFORE_SQL, K)}
SELECT 'youtube://video/' || video_id AS uri, video_id,
  '{{"video_id":"' || video_id || '","channel_id":"' || channel_id || '","published_at":"' ||
  {_iso_sql('published_at', '+00:00')} || '","title":"' || title || '","url":"' || source_url || '"}}' AS extra
FROM found"""))
def video_event(spark: SparkSession, sf: str) -> DataFrame:
    """P10: compact JSON metadata per discovered video (``+00:00`` instants)."""
    return D.video_event(_found(spark, sf)).select("uri", "video_id", "extra")


_NOTIFY_SQL = f"""WITH {_found_sql(_ITEMS, AFTER_SQL, BEFORE_SQL, K)}
SELECT video_id, coalesce(nullif(channel_title, ''), 'YouTube') || ' 发布了新视频' AS title, title AS body,
       source_url AS url, 'youtube-updates' AS "group", true AS isArchive
FROM found"""


@register("notifications", B.with_sql([_ITEMS] + _B_VID, _NOTIFY_SQL))
def notifications(spark: SparkSession, sf: str) -> DataFrame:
    """One push message per discovered video across all channels."""
    return D.notifications(_found(spark, sf))


@register("message_payload", B.with_sql([_ITEMS] + _B_VID, f"""WITH {_found_sql(_ITEMS, AFTER_SQL, BEFORE_SQL, K)}
SELECT video_id, '{{"title":"' || coalesce(nullif(channel_title, ''), 'YouTube') || ' 发布了新视频","body":"' || title ||
  '","level":"active","url":"' || source_url || '","group":"youtube-updates","isArchive":1}}' AS payload
FROM found"""))
def message_payload_q(spark: SparkSession, sf: str) -> DataFrame:
    """Push payload JSON (nulls dropped, flags → 1 or absent)."""
    return message_payload(D.notifications(_found(spark, sf))).select("video_id", "payload")


@register("event_dedupe", B.with_sql([_ITEMS] + _B_VID, f"""WITH {_found_sql(_ITEMS, AFTER_SQL, BEFORE_SQL, K)},
ev AS (SELECT channel_id, 'youtube://channel/' || channel_id || '/uploads' AS uri, count(*) AS n,
              '{{"page":' || min(page) || ',"videos":' || count(*) || '}}' AS first FROM found GROUP BY channel_id)
SELECT uri, '{{"a":"' || channel_id || '","published_after":"{AFTER}","stats":' || first || ',"video_count":' || n || '}}' AS extra FROM ev
UNION ALL
SELECT uri, '{{"a":"' || channel_id || '","published_after":"{AFTER}","stats":' || first || ',"video_count":' || n + 1 || '}}' FROM ev WHERE n % 2 = 0"""))
def event_dedupe(spark: SparkSession, sf: str) -> DataFrame:
    """The same channel event emitted three times, its fields (nested ones
    too) in other orders, collapses to one; another count stays another event."""
    per = _found(spark, sf).groupBy("channel_id").agg(F.count("*").alias("n"), F.min("page").alias("p"))
    c, n, p = F.col("channel_id"), F.col("n"), F.col("p")
    after = F.lit(AFTER)
    one = F.to_json(F.struct(n.alias("video_count"), after.alias("published_after"), F.struct(n.alias("videos"), p.alias("page")).alias("stats"), c.alias("a")))
    two = F.to_json(F.struct(F.struct(p.alias("page"), n.alias("videos")).alias("stats"), c.alias("a"), n.alias("video_count"), after.alias("published_after")))
    three = F.replace(two, F.lit(","), F.lit(" ,\t"))
    other = F.when(n % 2 == 0, F.to_json(F.struct((n + 1).alias("video_count"), after.alias("published_after"),
                                                  F.struct(p.alias("page"), n.alias("videos")).alias("stats"), c.alias("a"))))
    ev = per.select(channel_uploads_uri("channel_id").alias("uri"), F.explode(F.array(one, two, three, other)).alias("extra")).where("extra is not null")
    return D.event_dedupe(ev)


@register("outlet_merge", B.with_sql(["channel_refs"], """
SELECT pos, CASE WHEN 'youtube://channel/UCN0/uploads' = 'youtube://channel/' || trim(ref) || '/uploads'
                 THEN 'youtube://channel/UCN0/uploads'
                 ELSE 'youtube://channel/UCN0/uploads,youtube://channel/' || trim(ref) || '/uploads' END AS outlets
FROM channel_refs WHERE regexp_matches(trim(ref), '^[A-Za-z0-9_-]+$')"""))
def outlet_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Append a channel's outlet to the declared list unless present."""
    r = B.channel_refs(spark, sf).filter(resource_id("ref").isNotNull())
    declared = F.array(F.lit("youtube://channel/UCN0/uploads"))
    merged = D.outlet_merge(declared, channel_uploads_uri("ref"))
    return r.select("pos", F.array_join(merged, ",").alias("outlets"))

