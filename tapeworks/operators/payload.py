"""Push-message payloads and safe error text (P12, P13, V25 fields)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeworks.functions.text import strip_ws
from tapeworks.functions.uri import normalize_http_url

# Message field order and flag names of the push payload.
MESSAGE_FIELDS = ("title", "body", "subtitle", "markdown", "level", "url", "group",
                  "icon", "sound", "badge", "copy")
MESSAGE_FLAGS = ("call", "autoCopy", "isArchive")
DEFAULT_LEVEL = "active"
ERROR_DETAIL_LIMIT = 300


def message_payload(messages: DataFrame) -> DataFrame:
    """Message rows → payload JSON.

    Null fields are dropped; ``level`` defaults to ``active``; a true flag
    becomes ``1`` and a false flag disappears; ``badge = 0`` stays.
    """
    cols = set(messages.columns)
    parts = []
    for name in MESSAGE_FIELDS:
        if name == "level":
            v = F.coalesce(F.col("level"), F.lit(DEFAULT_LEVEL)) if "level" in cols else F.lit(DEFAULT_LEVEL)
        elif name in cols:
            # the contract strips text fields (the level literal is not
            # stripped) and writes URL fields in normal form
            if name in ("url", "icon"):
                v = normalize_http_url(name)
            else:
                v = strip_ws(name) if dict(messages.dtypes)[name] == "string" else F.col(name)
        else:
            continue
        parts.append(v.alias(name))
    for flag in MESSAGE_FLAGS:
        if flag in cols:
            parts.append(F.when(F.col(flag), F.lit(1)).alias(flag))
    return messages.withColumn("payload", F.to_json(F.struct(*parts)))


def error_detail(status, body) -> F.Column:
    """``HTTP nnn`` plus ``(reason: message)`` cut at 300 characters.

    Reads only ``error.errors[0].reason`` and ``error.message`` from the body,
    so nothing else (keys, URLs with secrets) can reach the text.
    """
    reason = F.get_json_object(body, "$.error.errors[0].reason")
    message = F.get_json_object(body, "$.error.message")
    suffix = F.concat_ws(": ", F.nullif(reason, F.lit("")), F.nullif(message, F.lit("")))
    head = F.concat(F.lit("HTTP "), status.cast("string"))
    return F.when(suffix == "", head).otherwise(
        F.concat(head, F.lit(" ("), F.substring(suffix, 1, ERROR_DETAIL_LIMIT), F.lit(")")))
