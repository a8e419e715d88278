"""URIs and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeworks.functions import col_of
from tapeworks.functions.text import RESOURCE_ID_PATTERN, strip_ws

# An absolute object URI has scheme s3 (any case), a bucket,
# a key with at least one non-slash character, and no query or fragment
# (an empty ``?`` or ``#`` marker is not a query or fragment).
S3_URI_PATTERN = r"(?i)^s3://[^/?#]+/[^?#]*[^/?#][^?#]*[?]?#?\z"
HTTP_URL_PATTERN = r"(?i)^https?://[^/?#\s@]*[^/?#\s:@][^/?#\s]*(?:[/?#]\S*)?\z"

# Our pinned extension → MIME map (case-insensitive), default
# application/octet-stream.  Compression suffixes are an encoding, not a type.
CONTENT_TYPES = {
    ".aac": "audio/aac", ".ass": "text/x-ssa", ".avi": "video/x-msvideo",
    ".bmp": "image/bmp", ".css": "text/css", ".csv": "text/csv",
    ".flac": "audio/flac", ".gif": "image/gif", ".htm": "text/html",
    ".html": "text/html", ".ico": "image/vnd.microsoft.icon", ".jpeg": "image/jpeg",
    ".jpg": "image/jpeg", ".js": "text/javascript", ".json": "application/json",
    ".m4a": "audio/mp4", ".md": "text/markdown", ".mkv": "video/x-matroska",
    ".mov": "video/quicktime", ".mp3": "audio/mpeg", ".mp4": "video/mp4",
    ".ogg": "audio/ogg", ".opus": "audio/opus", ".pdf": "application/pdf",
    ".png": "image/png", ".srt": "application/x-subrip", ".svg": "image/svg+xml",
    ".tar": "application/x-tar", ".txt": "text/plain", ".vtt": "text/vtt",
    ".wav": "audio/x-wav", ".webm": "video/webm", ".webp": "image/webp",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet",
    ".xml": "text/xml", ".zip": "application/zip", ".php": "application/x-httpd-php",
}
SUFFIX_ALIASES = {".tgz": ".tar.gz", ".taz": ".tar.gz", ".tz": ".tar.gz",
                  ".tbz2": ".tar.bz2", ".txz": ".tar.xz", ".svgz": ".svg.gz"}
ENCODINGS = (".gz", ".bz2", ".xz", ".br", ".z")
DEFAULT_CONTENT_TYPE = "application/octet-stream"


def is_s3_uri(c) -> Column:
    """V1."""
    return col_of(c).rlike(S3_URI_PATTERN)


def split_s3_uri(c) -> Column:
    """A5: ``struct(bucket, key)`` of a valid object URI, else null."""
    u = col_of(c)
    return F.when(is_s3_uri(u), F.struct(
        F.regexp_extract(u, r"^[^:]+://([^/?#]+)", 1).alias("bucket"),
        F.regexp_extract(u, r"^[^:]+://[^/?#]+/([^?#]*)", 1).alias("key"),
    ))


def is_http_url(c) -> Column:
    """V8: absolute http(s) URL with a host."""
    return strip_ws(col_of(c)).rlike(HTTP_URL_PATTERN)


def _extension(name: Column) -> Column:
    base = F.regexp_replace(F.regexp_extract(name, r"([^/]*)\z", 1), r"^\.+", "")
    return F.lower(F.regexp_extract(base, r"(\.[^.]*)\z", 1))


def content_type(c) -> Column:
    """A4: MIME type from a file path or URL path, by extension.

    A short form stands for two extensions (``.tgz`` is ``.tar.gz``): the last
    is an encoding, so the type is that of the first, as for an extension
    before any other encoding.
    """
    s = col_of(c)
    path = F.when(s.rlike(r"^[A-Za-z][A-Za-z0-9+.-]+:"),
                  F.regexp_extract(s, r"^[A-Za-z][A-Za-z0-9+.-]+:(?://[^/?#]*)?([^?#]*)", 1)).otherwise(s)
    ext = _extension(path)
    inner = F.create_map(*[F.lit(x) for alias, full in SUFFIX_ALIASES.items() for x in (alias, _first_suffix(full))])
    ext = (F.when(ext.isin(*ENCODINGS), _extension(F.regexp_replace(path, r"\.[^./]*\z", "")))
           .otherwise(F.coalesce(F.try_element_at(inner, ext), ext)))
    lookup = F.create_map(*[x for kv in CONTENT_TYPES.items() for x in map(F.lit, kv)])
    return F.coalesce(F.try_element_at(lookup, ext), F.lit(DEFAULT_CONTENT_TYPE))


def _first_suffix(full: str) -> str:
    return "." + full.split(".")[1]


def content_type_sql(key: str, expr: str, source: str) -> str:
    """DuckDB twin of ``content_type``: (``key``, ``expr``, content_type) of every
    row of ``source``; each step is a column of its own."""
    def ext(p):
        return f"lower(regexp_extract(regexp_replace(regexp_extract({p}, '([^/]*)$', 1), '^\\.+', ''), '(\\.[^.]*)$', 1))"

    values = lambda rows: ", ".join(f"('{a}', '{b}')" for a, b in rows)
    enc = ", ".join(f"'{x}'" for x in ENCODINGS)
    return f"""
WITH short(a, b) AS (VALUES {values((a, _first_suffix(f)) for a, f in SUFFIX_ALIASES.items())}),
types(ext, type) AS (VALUES {values(CONTENT_TYPES.items())}),
paths AS (SELECT {key}, {expr}, CASE WHEN regexp_matches({expr}, '^[A-Za-z][A-Za-z0-9+.-]+:')
            THEN regexp_extract({expr}, '^[A-Za-z][A-Za-z0-9+.-]+:(?://[^/?#]*)?([^?#]*)', 1) ELSE {expr} END AS path
          FROM {source}),
last AS (SELECT *, {ext('path')} AS e FROM paths),
inner_ AS (SELECT l.*, CASE WHEN e IN ({enc}) THEN {ext("regexp_replace(path, '\\.[^./]*$', '')")} ELSE coalesce(b, e) END AS x
           FROM last l LEFT JOIN short ON e = a)
SELECT {key}, {expr}, coalesce(type, '{DEFAULT_CONTENT_TYPE}') AS content_type FROM inner_ LEFT JOIN types ON x = ext"""


def path_segment(c) -> Column:
    """Percent-encode a whole value as one path segment (nothing is safe)."""
    enc = F.url_encode(col_of(c))
    enc = F.replace(enc, F.lit("+"), F.lit("%20"))
    enc = F.replace(enc, F.lit("*"), F.lit("%2A"))
    return F.replace(enc, F.lit("%7E"), F.lit("~"))


def channel_uploads_uri(c) -> Column:
    """Dataset URI of a channel's uploads; null for an invalid ID."""
    s = strip_ws(col_of(c))
    return F.when(s.rlike(RESOURCE_ID_PATTERN), F.concat(F.lit("youtube://channel/"), s, F.lit("/uploads")))


def video_uri(c) -> Column:
    """Dataset URI of one video; null for an invalid ID."""
    s = strip_ws(col_of(c))
    return F.when(s.rlike(RESOURCE_ID_PATTERN), F.concat(F.lit("youtube://video/"), s))


def watch_url(video_id) -> Column:
    """P8."""
    return F.concat(F.lit("https://www.youtube.com/watch?v="), col_of(video_id))


def normalize_http_url(c) -> Column:
    """An http(s) URL as the contracts serialize it: scheme and host in lower
    case, the scheme's default port dropped, an empty path written as ``/``
    (``https://Example.COM:443?q`` → ``https://example.com/?q``).  Text that
    is not an http(s) URL is returned stripped, unchanged otherwise."""
    s = strip_ws(col_of(c))
    pat = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)(.*)\z"
    scheme = F.lower(F.regexp_extract(s, pat, 1))
    host = F.lower(F.regexp_extract(s, pat, 2))
    host = (F.when((scheme == "http") & host.endswith(":80"), F.regexp_replace(host, r":80\z", ""))
            .when((scheme == "https") & host.endswith(":443"), F.regexp_replace(host, r":443\z", ""))
            .otherwise(host))
    rest = F.regexp_extract(s, pat, 3)
    rest = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(is_http_url(s), F.concat(scheme, F.lit("://"), host, rest)).otherwise(s)
