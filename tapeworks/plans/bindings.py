"""Stand-in inputs built from the driver tables.

Each binding only reshapes driver rows into the schema an operator expects
(names, nesting, page layout); none of them does an operator's work.  Every
Spark binding has a DuckDB twin (``SQL[name]``) used by the oracle queries,
so both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeworks.functions.time import iso_text
from tapeworks.operators.ordering import dense_positions, running_total, running_totals
from tapeworks.operators.rules import JOB_TYPES
from tapeworks.operators.timeline import nest_segments
from tapeworks.session import scratch_path
from tapeworks.sources.tables import as_utc, spread, table

# ---------------------------------------------------------------- publications
# events → one published video per event; channel = user.


def publications(spark: SparkSession, sf: str) -> DataFrame:
    return publications_of(table(spark, sf, "events"))


def publications_of(e: DataFrame) -> DataFrame:
    """The same mapping on any events frame (batch or stream)."""
    return e.select(
        F.concat(F.lit("v"), e.event_id.cast("string")).alias("video_id"),
        F.concat(F.lit("UC"), e.user_id.cast("string")).alias("channel_id"),
        F.concat(F.lit("UU"), e.user_id.cast("string")).alias("playlist_id"),
        as_utc("ts").alias("published_at"),
        F.col("event_type").alias("title"),
        F.col("event_id"),
        F.col("value"),
    )


_PUBLICATIONS_SQL = """publications AS (
  SELECT 'v' || event_id AS video_id, 'UC' || user_id AS channel_id,
         'UU' || user_id AS playlist_id, ts AS published_at,
         event_type AS title, event_id, value
  FROM events)"""

# ---------------------------------------------------------------- playlist items
# Uploads playlist pages.  "newest": newest first, 50 a page (the API's order).
# "shuffled": value desc then event_id, 10 a page (an order where the lower
# time bound is crossed early, so early stop differs from a plain filter).
# The next-page token names the next page; "shuffled" hands out the first
# publication day of the next page instead, so tokens repeat.

_ORDERS = {
    "newest": ([("published_at", "desc"), ("event_id", "desc")], 50, "published_at DESC, event_id DESC"),
    "shuffled": ([("value", "desc"), ("event_id", "asc")], 10, "value DESC, event_id ASC"),
}
_TOKENS_SQL = {"newest": "'T' || page", "shuffled": "'T' || strftime(arg_min(published_at, pos), '%Y%m%d')"}
# order buckets (monotone in the order) for skew-safe numbering
_BUCKETS = {
    "newest": lambda: -F.floor(F.unix_seconds(F.col("published_at")) / 3600),
    "shuffled": lambda: -F.floor(F.col("value")),
}


def playlist_items(spark: SparkSession, sf: str, order: str = "newest") -> DataFrame:
    spec, size, _ = _ORDERS[order]
    order_by = [getattr(F.col(c), d)() for c, d in spec]
    p = dense_positions(publications(spark, sf), ["playlist_id"], _BUCKETS[order](), order_by, name="rn")
    p = p.select("playlist_id", "video_id", "published_at",
                 F.floor(F.col("rn") / size).alias("page"),
                 (F.col("rn") % size).alias("pos"))
    token = F.concat(F.lit("T"), F.date_format("first_at", "yyyyMMdd") if order == "shuffled" else F.col("page").cast("string"))
    firsts = (p.groupBy("playlist_id", "page").agg(F.min_by("published_at", "pos").alias("first_at"))
              .select("playlist_id", (F.col("page") - 1).alias("page"), token.alias("next_token")))
    return p.join(firsts, ["playlist_id", "page"], "left").select(
        "playlist_id", "page", "pos", "video_id", "next_token")


def stored_items(spark: SparkSession, sf: str, order: str = "newest") -> DataFrame:
    """The playlist items as a table of this run: the API hands pages out, it
    doesn't number them, so the numbering is no part of a query's plan."""
    path = scratch_path(spark, f"items-{order}")
    playlist_items(spark, sf, order).write.parquet(path)
    return spark.read.parquet(path)


def page_files(spark: SparkSession, sf: str) -> str:
    """A folder of JSON files, a page of ``playlist_items`` per line; by page % 7
    some bodies are cut off (3), have no items (4) or empty items (5)."""
    pages = playlist_items(spark, sf).groupBy("playlist_id", "page", "next_token").agg(
        F.sort_array(F.collect_list(F.struct("pos", "video_id"))).alias("_i"))
    items = F.transform("_i", lambda x: F.struct(F.struct(x["video_id"].alias("videoId")).alias("contentDetails")))
    way = F.col("page") % 7
    head = (F.col("playlist_id").alias("playlistId"), "page", F.col("next_token").alias("nextPageToken"))
    broken = F.concat(F.lit('{"playlistId":"'), "playlist_id", F.lit('","page":'), F.col("page").cast("string"), F.lit(',"items":[{'))
    body = (F.when(way == 3, broken).when(way == 4, F.to_json(F.struct(*head)))
            .otherwise(F.to_json(F.struct(*head, F.when(way == 5, F.slice(items, 1, 0)).otherwise(items).alias("items")))))
    path = scratch_path(spark, "pages")
    pages.select(body.alias("value")).write.text(path)
    return path


def _playlist_sql(name: str, order: str) -> str:
    _, size, order_sql = _ORDERS[order]
    return f"""{name}_rn AS (
  SELECT playlist_id, video_id, channel_id, published_at,
         row_number() OVER (PARTITION BY playlist_id ORDER BY {order_sql}) - 1 AS rn
  FROM publications),
{name}_p AS (
  SELECT playlist_id, video_id, channel_id, published_at,
         CAST(floor(rn / {size}) AS BIGINT) AS page, rn % {size} AS pos FROM {name}_rn),
{name}_first AS (
  SELECT playlist_id, page - 1 AS page, {_TOKENS_SQL[order]} AS next_token
  FROM {name}_p GROUP BY playlist_id, page),
{name} AS (
  SELECT p.playlist_id, p.page, p.pos, p.video_id, f.next_token
  FROM {name}_p p LEFT JOIN {name}_first f ON p.playlist_id = f.playlist_id AND p.page = f.page)"""


# ---------------------------------------------------------------- API video items
# Nested ``videos`` API items, one per event.  ``props.k`` (0..99) and the
# event type pick which optional parts are present, empty or malformed.

def video_items(spark: SparkSession, sf: str) -> DataFrame:
    e = spread(table(spark, sf, "events"))  # an item takes far longer to parse than its row to read
    vid = F.concat(F.lit("v"), e.event_id.cast("string"))
    k = F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    ts = as_utc("ts")
    thumb = lambda name, cond, url: F.when(cond, F.struct(url.alias("url")))
    base = F.concat(F.lit("https://i.ytimg.com/vi/"), vid)
    dec = F.col("value").cast("decimal(10,2)")
    minutes = F.floor(dec / 60).cast("long")
    duration = F.when(k >= 97, F.lit("P1W")).otherwise(
        F.concat(F.lit("PT"), minutes.cast("string"), F.lit("M"),
                 (dec - minutes * 60).cast("string"), F.lit("S")))
    published = F.when(k.between(3, 5), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(iso_text(ts))
    snippet = F.struct(
        F.concat(F.lit("UC"), e.user_id.cast("string")).alias("channelId"),
        F.when(et == "signup", F.lit("")).otherwise(F.concat(F.lit("Channel "), e.user_id.cast("string"))).alias("channelTitle"),
        F.when(k < 3, F.lit("")).otherwise(et).alias("title"),
        F.when(k < 50, F.lit("")).otherwise(F.concat(F.lit("k="), k.cast("string"))).alias("description"),
        published.alias("publishedAt"),
        F.struct(
            thumb("default", F.lit(True), F.concat(base, F.lit("/default.jpg"))).alias("default"),
            F.lit(None).cast("struct<url:string>").alias("medium"),
            thumb("high", et.isin("view", "click"), F.concat(base, F.lit("/hqdefault.jpg"))).alias("high"),
            thumb("standard", et == "click", F.lit("")).alias("standard"),
            thumb("maxres", et == "purchase", F.concat(base, F.lit("/maxresdefault.jpg"))).alias("maxres"),
        ).alias("thumbnails"),
        F.when(et == "view", F.lit("en")).when(et == "click", F.lit("")).alias("defaultLanguage"),
        F.when(et.isin("click", "signup"), F.lit("fr")).alias("defaultAudioLanguage"),
    )
    return e.select(vid.alias("id"), snippet.alias("snippet"),
                    F.struct(duration.alias("duration")).alias("contentDetails"),
                    F.col("event_id").alias("fetch_seq"))


_VIDEO_ITEMS_SQL = """video_items AS (
  SELECT 'v' || event_id AS id,
    'UC' || user_id AS channelId,
    CASE WHEN event_type = 'signup' THEN '' ELSE 'Channel ' || user_id END AS channelTitle,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 3 THEN '' ELSE event_type END AS title,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) < 50 THEN ''
         ELSE 'k=' || CAST(json_extract_string(props, '$.k') AS INTEGER) END AS description,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) BETWEEN 3 AND 5
         THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END AS publishedAt,
    'https://i.ytimg.com/vi/v' || event_id || '/default.jpg' AS t_default,
    CAST(NULL AS VARCHAR) AS t_medium,
    CASE WHEN event_type IN ('view', 'click') THEN 'https://i.ytimg.com/vi/v' || event_id || '/hqdefault.jpg' END AS t_high,
    CASE WHEN event_type = 'click' THEN '' END AS t_standard,
    CASE WHEN event_type = 'purchase' THEN 'https://i.ytimg.com/vi/v' || event_id || '/maxresdefault.jpg' END AS t_maxres,
    CASE WHEN event_type = 'view' THEN 'en' WHEN event_type = 'click' THEN '' END AS defaultLanguage,
    CASE WHEN event_type IN ('click', 'signup') THEN 'fr' END AS defaultAudioLanguage,
    CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) >= 97 THEN 'P1W'
         ELSE 'PT' || CAST(floor(CAST(value AS DECIMAL(10,2)) / 60) AS BIGINT) || 'M' ||
              CAST(CAST(value AS DECIMAL(10,2)) - CAST(floor(CAST(value AS DECIMAL(10,2)) / 60) AS BIGINT) * 60 AS VARCHAR) || 'S'
    END AS duration,
    event_id AS fetch_seq
  FROM events)"""

# ---------------------------------------------------------------- channels
# Channel dimension from ``nation`` (handle = name); channel references from
# ``customer``: a handle, a raw ID (padded), an unknown handle or a blank,
# by market segment.


def channel_items(spark: SparkSession, sf: str) -> DataFrame:
    n = table(spark, sf, "nation")
    key = n.n_nationkey.cast("string")
    snippet = F.struct(
        F.col("n_name").alias("title"),
        F.when(n.n_regionkey == 0, F.lit("")).otherwise(F.concat(F.lit("Region "), n.n_regionkey.cast("string"))).alias("description"),
        F.lit("2010-01-01T00:00:00Z").alias("publishedAt"),
        F.concat(F.lit("@"), F.lower("n_name")).alias("customUrl"),
    )
    uploads = F.when(n.n_regionkey == 4, F.lit(None).cast("string")).otherwise(F.concat(F.lit("UUN"), key))
    details = F.struct(F.struct(uploads.alias("uploads")).alias("relatedPlaylists"))
    return n.select(F.concat(F.lit("UCN"), key).alias("id"), snippet.alias("snippet"),
                    details.alias("contentDetails"), F.col("n_name").alias("handle"))


_CHANNEL_ITEMS_SQL = """channel_items AS (
  SELECT 'UCN' || n_nationkey AS id, n_name AS title,
    CASE WHEN n_regionkey = 0 THEN '' ELSE 'Region ' || n_regionkey END AS description,
    '2010-01-01T00:00:00Z' AS publishedAt,
    CASE WHEN n_regionkey = 4 THEN NULL ELSE 'UUN' || n_nationkey END AS uploads,
    n_name AS handle
  FROM nation)"""


def channel_refs(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    n = table(spark, sf, "nation")
    seg = F.col("c_mktsegment")
    ref = (F.when(seg == "HOUSEHOLD", F.concat(F.lit(" @"), F.col("n_name"), F.lit(" ")))
           .when(seg == "MACHINERY", F.concat(F.lit("UCN"), F.col("c_nationkey").cast("string"), F.lit(" ")))
           .when(seg == "FURNITURE", F.concat(F.lit("@"), F.col("n_name")))
           .when(seg == "BUILDING", F.concat(F.lit("@ghost_"), F.col("c_nationkey").cast("string")))
           .otherwise(F.lit("   ")))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").alias("pos"), ref.alias("ref")))


_CHANNEL_REFS_SQL = """channel_refs AS (
  SELECT c_custkey AS pos,
    CASE c_mktsegment WHEN 'HOUSEHOLD' THEN ' @' || n_name || ' '
                      WHEN 'MACHINERY' THEN 'UCN' || c_nationkey || ' '
                      WHEN 'FURNITURE' THEN '@' || n_name
                      WHEN 'BUILDING' THEN '@ghost_' || c_nationkey
                      ELSE '   ' END AS ref
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""


# ---------------------------------------------------------------- lookup requests
# lineitem → lookup requests: IDs are ``v`` + 7 × part key (some name no video),
# the first line padded with blanks.  The lines of two suppliers in ten are one
# request each (hundreds of IDs), those of a third make one request per line
# number (dozens); all others are one request per order, in which a returned
# line 7 is malformed (the whole request is then refused).


def video_requests(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    kind, line = F.col("l_suppkey") % 10, F.col("l_linenumber")
    vid = F.concat(F.lit("v"), (F.col("l_partkey") * 7).cast("string"))
    vid = (F.when(line == 1, F.concat(F.lit(" "), vid, F.lit(" ")))
           .when((kind > 2) & (F.col("l_returnflag") == "R") & (line == 7), F.concat(vid, F.lit("/x")))
           .otherwise(vid))
    request = (F.when(kind < 2, -F.col("l_suppkey")).when(kind == 2, -(F.col("l_suppkey") * 10 + line + 10**9))
               .otherwise(F.col("l_orderkey")))
    return li.select(request.cast("long").alias("request_id"), (F.col("l_orderkey") * 10 + line).cast("long").alias("pos"),
                     vid.alias("video_id"))


_VIDEO_REQUESTS_SQL = """video_requests AS (
  SELECT CAST(CASE WHEN l_suppkey % 10 < 2 THEN -l_suppkey WHEN l_suppkey % 10 = 2 THEN -(l_suppkey * 10 + l_linenumber + 1000000000)
              ELSE l_orderkey END AS BIGINT) AS request_id, CAST(l_orderkey * 10 + l_linenumber AS BIGINT) AS pos,
    CASE WHEN l_linenumber = 1 THEN ' v' || (l_partkey * 7) || ' '
         WHEN l_suppkey % 10 > 2 AND l_returnflag = 'R' AND l_linenumber = 7 THEN 'v' || (l_partkey * 7) || '/x'
         ELSE 'v' || (l_partkey * 7) END AS video_id
  FROM lineitem)"""


# ---------------------------------------------------------------- artifact documents
# documents → one artifact JSON document each.  Language and size pick the
# URI form (valid, with a query, padded upper-case scheme, key-less), the
# content type (blank for es), an upper-case hash (short texts), a missing or
# foreign schema version, and an undeclared field (very long texts).


def artifact_docs(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    lang, src, did = F.col("lang"), F.col("source"), F.col("doc_id").cast("string")
    uri = (F.when(lang == "en", F.concat(F.lit("s3://"), src, F.lit("/en/"), did, F.lit(".txt")))
           .when(lang == "fr", F.concat(F.lit("s3://"), src, F.lit("/fr/"), did, F.lit(".txt?versionId=1")))
           .when(lang == "de", F.concat(F.lit(" S3://"), src, F.lit("/de/"), did, F.lit(" ")))
           .otherwise(F.concat(F.lit("s3://"), src, F.lit("/"))))
    sha = F.sha2("text", 256)
    raw = F.to_json(F.struct(
        F.when(lang != "de", F.when(F.col("n_chars").between(200, 209), F.lit("2.0")).otherwise(F.lit("1.0"))).alias("schema_version"),
        uri.alias("uri"),
        F.when(lang == "es", F.lit("  ")).otherwise(F.lit("text/plain")).alias("content_type"),
        F.col("n_chars").alias("size"),
        F.md5("text").alias("etag"),
        F.when(F.col("n_chars") < 200, F.upper(sha)).otherwise(sha).alias("sha256"),
        F.when(F.col("n_chars") > 15000, F.lit("x")).alias("secret"),
    ))
    return d.select("doc_id", raw.alias("raw"))


_ARTIFACT_DOCS_SQL = """artifact_docs AS (
  SELECT doc_id, '{' ||
    CASE WHEN lang <> 'de' THEN '"schema_version":"' || CASE WHEN n_chars BETWEEN 200 AND 209 THEN '2.0' ELSE '1.0' END || '",'
         ELSE '' END ||
    '"uri":' || to_json(CASE WHEN lang = 'en' THEN 's3://' || source || '/en/' || doc_id || '.txt'
                             WHEN lang = 'fr' THEN 's3://' || source || '/fr/' || doc_id || '.txt?versionId=1'
                             WHEN lang = 'de' THEN ' S3://' || source || '/de/' || doc_id || ' '
                             ELSE 's3://' || source || '/' END) ||
    ',"content_type":"' || CASE WHEN lang = 'es' THEN '  ' ELSE 'text/plain' END || '"' ||
    ',"size":' || n_chars || ',"etag":"' || md5(text) || '"' ||
    ',"sha256":"' || CASE WHEN n_chars < 200 THEN upper(sha256(text)) ELSE sha256(text) END || '"' ||
    CASE WHEN n_chars > 15000 THEN ',"secret":"x"' ELSE '' END || '}' AS raw
  FROM documents)"""

# artifact documents whose values have other JSON types than their fields, by doc_id % 16.
_TYPED = {1: ("size", '"{n}"'), 2: ("size", "{n}.0"), 3: ("size", "true"), 4: ("size", "{n}.5"), 5: ("size", '"abc"'),
          6: ("schema_version", '" 1.0 "'), 7: ("schema_version", "1.0"), 8: ("schema_version", "null"), 9: ("etag", "5")}


def typed_docs(spark: SparkSession, sf: str) -> DataFrame:
    docs = artifact_docs(spark, sf).join(table(spark, sf, "documents").select("doc_id", F.col("n_chars").cast("string").alias("n")), "doc_id")
    raw, way = F.col("raw"), F.col("doc_id") % 16
    out = F.when(way == 10, F.lit("not json"))
    for k, (name, value) in _TYPED.items():
        out = out.when(way == k, F.regexp_replace(raw, F.lit(f'"{name}":("[^"]*"|[0-9]+)'),
                                                  F.concat(F.lit(f'"{name}":'), F.replace(F.lit(value), F.lit("{n}"), F.col("n")))))
    return docs.select("doc_id", out.otherwise(raw).alias("raw"))


_TYPED_DOCS_SQL = "typed_docs AS (\n  SELECT doc_id, CASE doc_id % 16 WHEN 10 THEN 'not json'\n" + "".join(
    f"""    WHEN {k} THEN regexp_replace(raw, '"{name}":("[^"]*"|[0-9]+)', '"{name}":' || replace('{value}', '{{n}}', n_chars::VARCHAR))\n"""
    for k, (name, value) in _TYPED.items()) + "    ELSE raw END AS raw FROM artifact_docs JOIN documents USING (doc_id))"

# ---------------------------------------------------------------- job status log
# events → job status payloads as a gateway returns them.  user = job;
# event type → status; props.k picks alias keys, a doubled key, a missing or
# unexpected error, an unknown status and naive timestamps.


def job_log(spark: SparkSession, sf: str) -> DataFrame:
    return job_log_of(spread(table(spark, sf, "events")))  # a document takes far longer to check than its row to read


def job_log_of(e: DataFrame) -> DataFrame:
    """The same mapping on any events frame (batch or stream)."""
    k =F.get_json_object("props", "$.k").cast("int")
    et = F.col("event_type")
    status = (F.when((et == "view") & (k >= 95), F.lit("cancelled"))
              .when((et == "click") & (k >= 97), F.lit("done"))
              .when(et == "signup", F.lit("queued")).when(et.isin("view", "click"), F.lit("running"))
              .when(et == "purchase", F.lit("succeeded")).otherwise(F.lit("failed")))
    jtype = F.element_at(F.array(*[F.lit(x) for x in JOB_TYPES]), (F.col("user_id") % len(JOB_TYPES) + 1).cast("int"))
    jid = F.concat(F.lit("job-"), F.col("user_id").cast("string"))
    ts = as_utc("ts")
    upd = F.when(k.between(3, 5), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")).otherwise(iso_text(ts))
    has_err = ((status == "failed") & (k >= 10)) | ((status == "succeeded") & (k < 5))
    err = F.when(has_err, F.struct(F.concat(F.lit("E"), k.cast("string")).alias("code"),
                                   F.concat(F.lit("failure "), k.cast("string")).alias("message"),
                                   (k >= 50).alias("retryable")))
    raw = F.to_json(F.struct(
        F.when(k < 50, jid).alias("id"), F.when(k < 50, jtype).alias("type"),
        F.when((k >= 50) | (k == 49), jid).alias("job_id"), F.when(k >= 50, jtype).alias("job_type"),
        status.alias("status"), err.alias("error"), upd.alias("updated_at")))
    return e.select("event_id", raw.alias("raw"), F.col("user_id"), ts.alias("polled_at"))


_JOB_LOG_SQL = """job_log AS (
  SELECT event_id, user_id, ts AS polled_at, '{' ||
    CASE WHEN k < 50 THEN '"id":"job-' || user_id || '","type":"' || jtype || '",' ELSE '' END ||
    CASE WHEN k >= 50 OR k = 49 THEN '"job_id":"job-' || user_id || '",' ELSE '' END ||
    CASE WHEN k >= 50 THEN '"job_type":"' || jtype || '",' ELSE '' END ||
    '"status":"' || status || '"' ||
    CASE WHEN (status = 'failed' AND k >= 10) OR (status = 'succeeded' AND k < 5)
         THEN ',"error":{"code":"E' || k || '","message":"failure ' || k || '","retryable":' ||
              CASE WHEN k >= 50 THEN 'true' ELSE 'false' END || '}' ELSE '' END ||
    ',"updated_at":"' ||
    CASE WHEN k BETWEEN 3 AND 5 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
         WHEN epoch_us(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') || 'Z'
         ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' END || '"}' AS raw
  FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
          CASE WHEN event_type = 'view' AND CAST(json_extract_string(props, '$.k') AS INTEGER) >= 95 THEN 'cancelled'
               WHEN event_type = 'click' AND CAST(json_extract_string(props, '$.k') AS INTEGER) >= 97 THEN 'done'
               WHEN event_type = 'signup' THEN 'queued' WHEN event_type IN ('view', 'click') THEN 'running'
               WHEN event_type = 'purchase' THEN 'succeeded' ELSE 'failed' END AS status,
          ['download', 'transcribe', 'translate_subtitles', 'separate_audio', 'synthesize_speech',
           'render_video', 'media_quality_check'][user_id % 7 + 1] AS jtype
        FROM events))"""


# ---------------------------------------------------------------- timelines
# conversations → transcripts: one document per conversation, one segment
# per turn (10 ms per character, back to back), words split on spaces
# (10 ms per character offset, 12 ms per character length, so long words can
# run past their segment), media duration rounded down to whole seconds.
# Translations: version 1 for every turn, version 2 for assistant turns.
# Synthesis: every turn, made from version 1, 9 ms per character + 150.

def transcript_segments(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "conversations").withColumn("_dur", F.length("text").cast("long") * 10)
    block = F.floor(F.col("turn") / 1000)   # buckets of 1000 turns: skew-safe numbering and offsets
    c = running_totals(c, ["conv_id"], block, ["turn"],
                       {"seg_pos": F.lit(1).cast("long"), "start_ms": F.col("_dur")})
    return c.select(F.col("conv_id").alias("doc_id"), "seg_pos",
                    F.concat(F.lit("seg-"), F.lpad(F.col("turn").cast("string"), 4, "0")).alias("segment_id"),
                    "start_ms", (F.col("start_ms") + F.col("_dur")).alias("end_ms"), "text",
                    F.col("role").alias("speaker"))


_SEGMENTS_SQL = """transcript_segments AS (
  SELECT conv_id AS doc_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS BIGINT) AS seg_pos,
    'seg-' || lpad(CAST(turn AS VARCHAR), 4, '0') AS segment_id,
    CAST(coalesce(sum(10 * length(text)) OVER (PARTITION BY conv_id ORDER BY turn
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start_ms,
    CAST(coalesce(sum(10 * length(text)) OVER (PARTITION BY conv_id ORDER BY turn
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 10 * length(text) AS BIGINT) AS end_ms,
    text, role AS speaker
  FROM conversations)"""


def transcript_words(spark: SparkSession, sf: str) -> DataFrame:
    """Flat words of the segments: doc_id, segment_id, word_pos, start_ms, end_ms, text."""
    w = transcript_segments(spark, sf).select(
        "doc_id", "segment_id", "start_ms", F.posexplode(F.split("text", " ")).alias("word_pos", "w"))
    w = running_total(w, ["doc_id", "segment_id"], F.floor(F.col("word_pos") / 1000), ["word_pos"],
                      F.length("w") + 1, name="offset")
    start = F.col("start_ms") + 10 * F.col("offset")
    return w.select("doc_id", "segment_id", "word_pos", start.alias("start_ms"),
                    (start + 12 * F.length("w")).alias("end_ms"), F.col("w").alias("text"))


def faulty_segments(spark: SparkSession, sf: str) -> DataFrame:
    """The segments with faults: two segments of every fifth document share an
    ID, and the third of every third document starts at 0 again."""
    dup = (F.col("doc_id") % 5 == 0) & F.col("seg_pos").isin(1, 2)
    back = (F.col("doc_id") % 3 == 1) & (F.col("seg_pos") == 2)
    return transcript_segments(spark, sf).withColumn(
        "segment_id", F.when(dup, F.lit("seg-dup")).otherwise(F.col("segment_id"))).withColumn(
        "start_ms", F.when(back, F.lit(0)).otherwise(F.col("start_ms")).cast("long"))


def faulty_words(spark: SparkSession, sf: str) -> DataFrame:
    """The words with faults: the second word of a segment has no length in
    every fourth document, the third starts with its segment in the next."""
    seg = transcript_segments(spark, sf).select("doc_id", "segment_id", F.col("start_ms").alias("_seg"))
    w = transcript_words(spark, sf).join(seg, ["doc_id", "segment_id"])
    flat = (F.col("doc_id") % 4 == 0) & (F.col("word_pos") == 1)
    back = (F.col("doc_id") % 4 == 1) & (F.col("word_pos") == 2)
    return w.withColumn("end_ms", F.when(flat, F.col("start_ms")).otherwise(F.col("end_ms"))).withColumn(
        "start_ms", F.when(back, F.col("_seg")).otherwise(F.col("start_ms"))).drop("_seg")


def _words_of(start: Column, text: Column) -> Column:
    """The words of one segment as a transcript holds them (``transcript_words``, nested)."""
    step = lambda acc, w: F.struct((acc["at"] + F.length(w) + 1).alias("at"), F.array_append(acc["words"], F.struct(
        (start + 10 * acc["at"]).alias("start_ms"), (start + 10 * acc["at"] + 12 * F.length(w)).alias("end_ms"), w.alias("text"),
        F.lit(None).cast("double").alias("probability"))).alias("words"))
    empty = F.array().cast("array<struct<start_ms:bigint,end_ms:bigint,text:string,probability:double>>")
    return F.reduce(F.split(text, " "), F.struct(F.lit(0).cast("long").alias("at"), empty.alias("words")), step)["words"]


def transcript_docs(spark: SparkSession, sf: str) -> DataFrame:
    """Nested transcript documents: a document is one row, as its contract says."""
    seg = transcript_segments(spark, sf)
    part = F.struct("segment_id", "start_ms", "end_ms", "text", _words_of(F.col("start_ms"), F.col("text")).alias("words"), "speaker")
    docs = seg.select("doc_id", "seg_pos", (F.col("end_ms") - F.col("start_ms")).alias("ms"), part.alias("s")).groupBy("doc_id").agg(
        (F.floor(F.sum("ms") / 1000) * 1000).cast("long").alias("duration_ms"),
        F.sort_array(F.collect_list(F.struct("seg_pos", "s"))).alias("_s"))
    return docs.select("doc_id", "duration_ms", F.lit("en").alias("language"), F.transform("_s", lambda x: x["s"]).alias("segments"))


def transcript_durations(spark: SparkSession, sf: str) -> DataFrame:
    return transcript_segments(spark, sf).groupBy("doc_id").agg(
        (F.floor(F.sum(F.col("end_ms") - F.col("start_ms")) / 1000) * 1000).cast("long").alias("duration_ms"))


_DOCS_SQL = """transcript_durations AS (
  SELECT doc_id, CAST(floor(sum(end_ms - start_ms) / 1000) * 1000 AS BIGINT) AS duration_ms
  FROM transcript_segments GROUP BY doc_id)"""

_WORDS_SQL = """transcript_words AS (
  SELECT doc_id, segment_id, word_pos,
    start_ms + 10 * (length(array_to_string(list_slice(ws, 1, word_pos), ' ')) + CASE WHEN word_pos > 0 THEN 1 ELSE 0 END) AS start_ms,
    start_ms + 10 * (length(array_to_string(list_slice(ws, 1, word_pos), ' ')) + CASE WHEN word_pos > 0 THEN 1 ELSE 0 END)
      + 12 * length(w) AS end_ms, w AS text
  FROM (SELECT doc_id, segment_id, start_ms, string_split(text, ' ') AS ws,
               unnest(string_split(text, ' ')) AS w, unnest(range(len(string_split(text, ' ')))) AS word_pos
        FROM transcript_segments))"""


_FAULTY_SEGMENTS_SQL = """faulty_segments AS (
  SELECT doc_id, seg_pos, CASE WHEN doc_id % 5 = 0 AND seg_pos IN (1, 2) THEN 'seg-dup' ELSE segment_id END AS segment_id,
    CASE WHEN doc_id % 3 = 1 AND seg_pos = 2 THEN 0 ELSE start_ms END AS start_ms, end_ms, text, speaker
  FROM transcript_segments)"""

_FAULTY_WORDS_SQL = """faulty_words AS (
  SELECT w.doc_id, w.segment_id, w.word_pos,
    CASE WHEN w.doc_id % 4 = 1 AND w.word_pos = 2 THEN s.start_ms ELSE w.start_ms END AS start_ms,
    CASE WHEN w.doc_id % 4 = 0 AND w.word_pos = 1 THEN w.start_ms ELSE w.end_ms END AS end_ms, w.text
  FROM transcript_words w JOIN transcript_segments s ON w.doc_id = s.doc_id AND w.segment_id = s.segment_id)"""


def translated_segments(spark: SparkSession, sf: str) -> DataFrame:
    """One row per segment and translation version, with the speech made from
    version 1 beside it."""
    seg = transcript_segments(spark, sf)
    first = F.concat(F.lit("T1:"), F.col("text"))
    version = lambda n: F.struct(F.concat(F.lit(f"T{n}:"), F.col("text")).alias("translated_text"),
                                 F.lit(n).cast("long").alias("translation_version"))
    versions = F.when(F.col("speaker") == "assistant", F.array(version(1), version(2))).otherwise(F.array(version(1)))
    return seg.select("doc_id", "segment_id", "seg_pos", F.col("start_ms").alias("source_start_ms"),
                      F.col("end_ms").alias("source_end_ms"), F.col("text").alias("source_text"), "speaker", first.alias("spoken_text"),
                      F.concat(F.lit("voice-"), "speaker").alias("voice"),
                      F.concat(F.lit("s3://tts/"), F.col("doc_id").cast("string"), F.lit("/"), "segment_id", F.lit(".wav")).alias("audio_uri"),
                      (F.length(first).cast("long") * 9 + 150).alias("actual_duration_ms"), F.inline(versions))


def translations(spark: SparkSession, sf: str) -> DataFrame:
    return translated_segments(spark, sf).select("doc_id", "segment_id", "source_start_ms", "source_end_ms", "source_text", "speaker",
                                                 "translated_text", "translation_version")


_TRANSLATIONS_SQL = """translations AS (
  SELECT doc_id, segment_id, start_ms AS source_start_ms, end_ms AS source_end_ms, text AS source_text, speaker,
         'T1:' || text AS translated_text, CAST(1 AS BIGINT) AS translation_version FROM transcript_segments
  UNION ALL
  SELECT doc_id, segment_id, start_ms, end_ms, text, speaker, 'T2:' || text, CAST(2 AS BIGINT)
  FROM transcript_segments WHERE speaker = 'assistant')"""


def synthesis(spark: SparkSession, sf: str) -> DataFrame:
    t = translations(spark, sf).filter(F.col("translation_version") == 1)
    return t.select("doc_id", "segment_id", F.col("source_start_ms").alias("target_start_ms"),
                    F.col("source_end_ms").alias("target_end_ms"), F.col("translated_text").alias("text"),
                    F.concat(F.lit("voice-"), "speaker").alias("voice"),
                    F.concat(F.lit("s3://tts/"), F.col("doc_id").cast("string"), F.lit("/"), "segment_id",
                             F.lit(".wav")).alias("audio_uri"),
                    (F.length("translated_text").cast("long") * 9 + 150).alias("actual_duration_ms"))


_SYNTHESIS_SQL = """synthesis AS (
  SELECT doc_id, segment_id, source_start_ms AS target_start_ms, source_end_ms AS target_end_ms,
    translated_text AS text, 'voice-' || speaker AS voice,
    's3://tts/' || doc_id || '/' || segment_id || '.wav' AS audio_uri,
    CAST(length(translated_text) * 9 + 150 AS BIGINT) AS actual_duration_ms
  FROM translations WHERE translation_version = 1)"""

CHUNK_MS = 30000
OVERLAP_MS = 2000


def recognition_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Chunked recognition output: a segment appears (chunk-relative) in every
    chunk whose range holds its midpoint, so overlaps repeat it."""
    seg = transcript_segments(spark, sf)
    step = CHUNK_MS - OVERLAP_MS
    mid2 = F.col("start_ms") + F.col("end_ms")
    lo = F.greatest(F.lit(0).cast("long"), (F.floor((mid2 - 2 * CHUNK_MS) / (2 * step)) + 1).cast("long"))
    hi = F.floor(mid2 / (2 * step)).cast("long")
    x = seg.select("doc_id", "start_ms", "end_ms", "text", F.explode(F.sequence(lo, hi)).alias("chunk"))
    return x.select("doc_id", "chunk", (F.col("chunk") * step).alias("offset_ms"),
                    (F.col("start_ms") - F.col("chunk") * step).alias("start_ms"),
                    (F.col("end_ms") - F.col("chunk") * step).alias("end_ms"), "text")


# words as two recognitions of overlapping chunks hear them: a word is in every
# chunk whose range holds its midpoint; times jitter by up to 60 ms with the chunk,
# and every sixth word (another one in each chunk) is misheard.

def recognised_words(spark: SparkSession, sf: str) -> DataFrame:
    w = transcript_words(spark, sf)
    step = CHUNK_MS - OVERLAP_MS
    mid2 = F.col("start_ms") + F.col("end_ms")
    lo = F.greatest(F.lit(0).cast("long"), (F.floor((mid2 - 2 * CHUNK_MS) / (2 * step)) + 1).cast("long"))
    x = w.select("doc_id", (F.col("start_ms") / 10).cast("long").alias("pos"), "start_ms", "end_ms", "text",
                 F.explode(F.sequence(lo, F.floor(mid2 / (2 * step)).cast("long"))).alias("chunk"))
    jitter = (F.col("pos") + 7 * F.col("chunk")) % 13 * 10 - 60 - F.col("chunk") * step
    misheard = (F.col("pos") + F.col("chunk")) % 6 == 0
    return x.select("doc_id", "chunk", "pos", (F.col("start_ms") + jitter).alias("start_ms"), (F.col("end_ms") + jitter).alias("end_ms"),
                    F.when(misheard, F.concat(F.lit("um"), F.col("chunk").cast("string"))).otherwise(F.col("text")).alias("text"))


_RECOGNISED_SQL = f"""recognised_words AS (
  SELECT doc_id, chunk, pos, start_ms + (pos + 7 * chunk) % 13 * 10 - 60 AS start_ms, end_ms + (pos + 7 * chunk) % 13 * 10 - 60 AS end_ms,
         CASE WHEN (pos + chunk) % 6 = 0 THEN 'um' || chunk ELSE text END AS text FROM (
    SELECT doc_id, start_ms // 10 AS pos, start_ms, end_ms, text, unnest(range(
      greatest(0, CAST(floor((start_ms + end_ms - {2 * CHUNK_MS}) / {2 * (CHUNK_MS - OVERLAP_MS)}.0) + 1 AS BIGINT)),
      CAST(floor((start_ms + end_ms) / {2 * (CHUNK_MS - OVERLAP_MS)}.0) AS BIGINT) + 1)) AS chunk
    FROM transcript_words))"""


# ---------------------------------------------------------------- HTTP attempt log
# events → API attempts: request = (user, day), attempts in time order; the
# status comes from props.k (429, 503, 500, 403, 404, 401, 422, 451 or 200);
# error bodies carry a reason, a message and a debug field with a key that
# must never reach error text.

def attempt_log(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    status = (F.when(k < 8, 429).when(k < 12, 503).when(k < 14, 500).when(k == 14, 403).when(k == 15, 404)
              .when(k == 16, 401).when(k == 17, 422).when(k == 18, 451).otherwise(200))
    reason = (F.when(status == 429, F.lit("rateLimitExceeded")).when(status == 403, F.lit("quotaExceeded"))
              .when(status == 404, F.lit("notFound")).when(status == 401, F.lit("")).otherwise(F.lit("backendError")))
    body = F.when(status >= 400, F.to_json(F.struct(F.struct(
        status.alias("code"), F.concat(F.lit("Request failed: "), F.col("event_type")).alias("message"),
        F.array(F.struct(reason.alias("reason"))).alias("errors"),
        F.concat(F.lit("key=AIza-"), F.col("user_id").cast("string")).alias("debug")).alias("error"))))
    req = F.concat(F.col("user_id").cast("string"), F.lit(":"), F.date_format("ts", "yyyy-MM-dd"))
    a = e.select("event_id", "ts", req.alias("request_id"), status.alias("status"), body.alias("body"))
    hour = F.floor(F.unix_seconds(as_utc("ts")) / 3600)
    a = dense_positions(a, ["request_id"], hour, ["ts", "event_id"], name="attempt")
    return a.select("event_id", "request_id", F.col("attempt").cast("int").alias("attempt"), "status", "body")


_ATTEMPT_LOG_SQL = """attempt_log AS (
  SELECT event_id, request_id, CAST(row_number() OVER (PARTITION BY request_id ORDER BY ts, event_id) - 1 AS INTEGER) AS attempt,
    status, CASE WHEN status >= 400 THEN
      '{"error":{"code":' || status || ',"message":"Request failed: ' || event_type || '","errors":[{"reason":"' ||
      CASE status WHEN 429 THEN 'rateLimitExceeded' WHEN 403 THEN 'quotaExceeded' WHEN 404 THEN 'notFound'
                  WHEN 401 THEN '' ELSE 'backendError' END || '"}],"debug":"key=AIza-' || user_id || '"}}' END AS body
  FROM (SELECT *, user_id || ':' || strftime(ts, '%Y-%m-%d') AS request_id,
          CASE WHEN k < 8 THEN 429 WHEN k < 12 THEN 503 WHEN k < 14 THEN 500 WHEN k = 14 THEN 403 WHEN k = 15 THEN 404
               WHEN k = 16 THEN 401 WHEN k = 17 THEN 422 WHEN k = 18 THEN 451 ELSE 200 END AS status
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)))"""

# ---------------------------------------------------------------- stages and artifacts
# orders → stage records of the video 'vid'+customer: order priority → job
# type, order status → status (F succeeded, O running, P failed); price
# bands decide error presence and completion times (some inconsistent).
# lineitem → the artifact keys a stage reads ('N' lines are outputs).
# part (size <= 40) → the artifact catalogue, so some references are missing.

PRIORITY_JOB = (("1-URGENT", "download"), ("2-HIGH", "transcribe"), ("3-MEDIUM", "translate_subtitles"),
                ("4-NOT SPECIFIED", "synthesize_speech"), ("5-LOW", "render_video"))


def _job_type_of(priority):
    out = None
    for p, j in PRIORITY_JOB:
        out = F.when(priority == p, F.lit(j)) if out is None else out.when(priority == p, F.lit(j))
    return out


def stage_records(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders")
    price = F.col("o_totalprice")
    status = F.when(F.col("o_orderstatus") == "F", F.lit("succeeded")).when(
        F.col("o_orderstatus") == "O", F.lit("running")).otherwise(F.lit("failed"))
    started = as_utc("o_orderdate")
    completed = (F.when(status == "running", F.lit(None).cast("timestamp"))
                 .when(price > 450000, started - F.expr("INTERVAL 1 DAY"))
                 .when(price > 50000, started + F.expr("INTERVAL 1 DAY")))
    error = F.when(((status == "failed") & (price > 100000)) | ((status == "succeeded") & (price < 5000)),
                   F.struct(F.lit("E_STAGE").alias("code"), F.concat(F.lit("order "), F.col("o_orderkey").cast("string")).alias("message")))
    return o.select(
        F.concat(F.lit("vid"), F.col("o_custkey").cast("string")).alias("video_id"),
        _job_type_of(F.col("o_orderpriority")).alias("job_type"), status.alias("status"),
        F.concat(F.lit("job-"), F.col("o_orderkey").cast("string")).alias("job_id"),
        F.concat_ws(":", F.col("o_custkey").cast("string"), F.col("o_orderkey").cast("string")).alias("idempotency_key"),
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("parameters_sha256"),
        error.alias("error"), started.alias("started_at"), completed.alias("completed_at"),
        F.coalesce(completed, started).alias("updated_at"))


_STAGES_SQL = """stage_records AS (
  SELECT 'vid' || o_custkey AS video_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'download' WHEN '2-HIGH' THEN 'transcribe'
      WHEN '3-MEDIUM' THEN 'translate_subtitles' WHEN '4-NOT SPECIFIED' THEN 'synthesize_speech'
      WHEN '5-LOW' THEN 'render_video' END AS job_type,
    status, 'job-' || o_orderkey AS job_id, o_custkey || ':' || o_orderkey AS idempotency_key,
    sha256(CAST(o_orderkey AS VARCHAR)) AS parameters_sha256,
    CASE WHEN (status = 'failed' AND o_totalprice > 100000) OR (status = 'succeeded' AND o_totalprice < 5000)
         THEN 'E_STAGE' END AS error_code,
    o_orderdate AS started_at, completed_at, coalesce(completed_at, o_orderdate) AS updated_at
  FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 'succeeded' WHEN 'O' THEN 'running' ELSE 'failed' END AS status,
          CASE WHEN o_orderstatus = 'O' THEN NULL
               WHEN o_totalprice > 450000 THEN o_orderdate - INTERVAL 1 DAY
               WHEN o_totalprice > 50000 THEN o_orderdate + INTERVAL 1 DAY END AS completed_at
        FROM orders))"""


def stage_refs(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    return j.select(F.concat(F.lit("vid"), F.col("o_custkey").cast("string")).alias("video_id"),
                    F.concat(F.lit("job-"), F.col("l_orderkey").cast("string")).alias("job_id"),
                    _job_type_of(F.col("o_orderpriority")).alias("job_type"),
                    F.when(F.col("l_returnflag") == "N", F.lit("output")).otherwise(F.lit("input")).alias("direction"),
                    F.concat(F.when(F.col("l_linenumber") == 7, F.lit("gone/")).otherwise(F.lit("part/")),
                             F.col("l_partkey").cast("string")).alias("key"),
                    as_utc("l_shipdate").alias("ref_at"))


_STAGE_REFS_SQL = """stage_refs AS (
  SELECT 'vid' || o_custkey AS video_id, 'job-' || l_orderkey AS job_id,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'download' WHEN '2-HIGH' THEN 'transcribe'
      WHEN '3-MEDIUM' THEN 'translate_subtitles' WHEN '4-NOT SPECIFIED' THEN 'synthesize_speech'
      WHEN '5-LOW' THEN 'render_video' END AS job_type,
    CASE WHEN l_returnflag = 'N' THEN 'output' ELSE 'input' END AS direction,
    CASE WHEN l_linenumber = 7 THEN 'gone/' ELSE 'part/' END || l_partkey AS key, l_shipdate AS ref_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def artifact_catalog(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part")
    return p.select(F.concat(F.lit("part/"), F.col("p_partkey").cast("string")).alias("key"),
                    F.concat(F.lit("s3://parts/"), F.lower(F.regexp_replace("p_brand", "#", "")), F.lit("/"),
                             F.col("p_partkey").cast("string")).alias("uri"),
                    (F.col("p_size").cast("long") * 1000).alias("size"))


_CATALOG_SQL = """artifact_catalog AS (
  SELECT 'part/' || p_partkey AS key, 's3://parts/' || lower(replace(p_brand, '#', '')) || '/' || p_partkey AS uri,
         CAST(p_size AS BIGINT) * 1000 AS size
  FROM part)"""


# ---------------------------------------------------------------- manifest sources
# customer → the source video of the manifest 'vid'+custkey.


def manifest_sources(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    vid = F.concat(F.lit("vid"), F.col("c_custkey").cast("string"))
    return c.select(vid.alias("video_id"), F.struct(
        F.lit("1.0").alias("schema_version"), vid.alias("video_id"),
        F.concat(F.lit("UCN"), F.col("c_nationkey").cast("string")).alias("channel_id"),
        F.col("c_name").alias("title"), F.lit("2024-01-01T00:00:00Z").alias("published_at"),
        F.concat(F.lit("https://www.youtube.com/watch?v="), vid).alias("source_url")).alias("source"))


SQL = {
    "publications": _PUBLICATIONS_SQL,
    "playlist_items": _playlist_sql("playlist_items", "newest"),
    "playlist_shuffled": _playlist_sql("playlist_shuffled", "shuffled"),
    "video_items": _VIDEO_ITEMS_SQL,
    "channel_items": _CHANNEL_ITEMS_SQL,
    "channel_refs": _CHANNEL_REFS_SQL,
    "video_requests": _VIDEO_REQUESTS_SQL,
    "artifact_docs": _ARTIFACT_DOCS_SQL,
    "typed_docs": _TYPED_DOCS_SQL,
    "recognised_words": _RECOGNISED_SQL,
    "job_log": _JOB_LOG_SQL,
    "transcript_segments": _SEGMENTS_SQL,
    "transcript_durations": _DOCS_SQL,
    "transcript_words": _WORDS_SQL,
    "faulty_segments": _FAULTY_SEGMENTS_SQL,
    "faulty_words": _FAULTY_WORDS_SQL,
    "translations": _TRANSLATIONS_SQL,
    "synthesis": _SYNTHESIS_SQL,
    "attempt_log": _ATTEMPT_LOG_SQL,
    "stage_records": _STAGES_SQL,
    "stage_refs": _STAGE_REFS_SQL,
    "artifact_catalog": _CATALOG_SQL,
}

# Bindings whose SQL reads another binding.
_NEEDS = {"typed_docs": ["artifact_docs"], "recognised_words": ["transcript_words"], "faulty_segments": ["transcript_segments"], "faulty_words": ["transcript_segments", "transcript_words"],
          "playlist_items": ["publications"], "playlist_shuffled": ["publications"],
          "transcript_durations": ["transcript_segments"], "transcript_words": ["transcript_segments"],
          "translations": ["transcript_segments"], "synthesis": ["translations"]}


def with_sql(names: list[str], body: str) -> str:
    """``WITH`` the named bindings (and what they read), then ``body``."""
    ordered: list[str] = []

    def add(n):
        for dep in _NEEDS.get(n, []):
            add(dep)
        if n not in ordered:
            ordered.append(n)

    for n in names:
        add(n)
    if not ordered:
        return body.strip()
    ctes = ",\n".join(SQL[n] for n in ordered)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
