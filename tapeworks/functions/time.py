"""Instants and durations (V2, P3, P4, P10 text forms).

Contract instants are UTC; the session time zone is UTC.  Naive text is
refused by looking at the text itself, because Spark's parsers silently read
offset-free text as session time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeworks.functions import col_of
from tapeworks.functions.text import strip_ws

# The ISO-8601 duration grammar the catalogue API uses
# (days, hours, minutes, fractional seconds).
DURATION_PATTERN = r"^P(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?\z"

_DATE_TIME = r"^\d{4}-\d{2}-\d{2}(?:[Tt ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)?"
# Contract fields: ``Z``/``z`` or ``+HH:MM``/``+HHMM``; epoch seconds also pass.
_CONTRACT_OFFSET = r"(?:[Zz]|[+-]\d{2}:?\d{2})\z"
# Window arguments and API text: ``Z``, ``+HH``, ``+HH:MM``, ``+HHMM``.
_WINDOW_OFFSET = r"(?:Z|[+-]\d{2}(?::?\d{2})?)\z"
_EPOCH = r"^-?\d+(?:\.\d+)?\z"


def ts_text(c) -> Column:
    """Canonical text of an instant for comparisons: ``yyyy-MM-dd HH:mm:ss.SSSSSS``."""
    return F.date_format(col_of(c), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def iso_text(c, zulu: bool = True) -> Column:
    """ISO-8601 text of a UTC instant as the contracts print it.

    Fraction only when non-zero (six digits), then ``Z`` (JSON documents) or
    ``+00:00`` (event metadata).
    """
    ts = col_of(c)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    body = F.when(F.date_trunc("second", ts) == ts, whole).otherwise(frac)
    return F.concat(body, F.lit("Z" if zulu else "+00:00"))


def has_offset(text, grammar: str = "contract") -> Column:
    """V2: the text names its offset (or, for contracts, is an epoch number)."""
    t = strip_ws(col_of(text))
    if grammar == "contract":
        return t.rlike(_DATE_TIME + _CONTRACT_OFFSET) | t.rlike(_EPOCH)
    if grammar == "window":
        return t.rlike(_DATE_TIME + _WINDOW_OFFSET)
    raise ValueError(f"unknown grammar {grammar!r}")


def aware_timestamp(text, grammar: str = "contract") -> Column:
    """Text → UTC instant; null when naive or unparsable."""
    t = strip_ws(col_of(text))
    # Spark reads Z, +HH, +HHMM and +HH:MM itself; the rewrite (small z or t,
    # other spellings) only runs when that fails: coalesce is lazy
    iso = F.regexp_replace(F.regexp_replace(t, r"[Zz]\z", "+00:00"), r"([+-]\d{2})\z", "$1:00")
    iso = F.regexp_replace(iso, r"([+-]\d{2})(\d{2})\z", "$1:$2")
    iso = F.regexp_replace(iso, r"^(\d{4}-\d{2}-\d{2})[t ]", "$1T")
    parsed = F.coalesce(F.try_to_timestamp(t), F.try_to_timestamp(iso))
    if grammar == "contract":
        epoch = F.when(t.rlike(_EPOCH), F.timestamp_micros((t.try_cast("decimal(20,6)") * 1000000).cast("long")))
        parsed = F.coalesce(epoch, parsed)
    return F.when(has_offset(t, grammar), parsed)


def duration_ms(text) -> Column:
    """ISO-8601 duration → whole milliseconds, half-even; null stays null.

    Text that does not match the grammar gives null here; ``duration_ok``
    tells that case apart from a null input.
    """
    t = col_of(text)
    part = lambda i: F.coalesce(F.regexp_extract(t, DURATION_PATTERN, i).try_cast("double"), F.lit(0.0))
    seconds = part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    return F.when(t.rlike(DURATION_PATTERN), F.bround(seconds * 1000, 0).cast("long"))


def duration_ok(text) -> Column:
    """True for null (no duration) or a duration the grammar accepts."""
    t = col_of(text)
    return t.isNull() | t.rlike(DURATION_PATTERN)
