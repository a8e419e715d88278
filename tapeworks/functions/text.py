"""String helpers.

All are plain Column expressions so they stay inside whole-stage codegen.
Whole-string matches end in ``\\z``: Java's ``$`` also matches before a final
newline, the contract patterns do not.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapeworks.functions import col_of

# Patterns the contracts define.
RESOURCE_ID_PATTERN = r"^[A-Za-z0-9_-]+\z"
ARTIFACT_KEY_PATTERN = r"^[a-z0-9][a-z0-9._/-]*\z"
SHA256_PATTERN = r"^[0-9a-f]{64}\z"

# The characters Python's ``str.strip()`` removes (``str.isspace``).
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
              "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def strip_ws(c) -> Column:
    """Strip leading and trailing whitespace as Python ``str.strip`` does.

    ``btrim`` with the fixed character set: codegen'd, no regex per row.
    """
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def empty_to_null(c) -> Column:
    """Falsy text becomes null: ``x or None``."""
    return F.nullif(col_of(c), F.lit(""))


def first_truthy(*cols) -> Column:
    """``a or b or ...``: the first value that is neither null nor empty."""
    return F.coalesce(*[empty_to_null(c) for c in cols])


def min_length_ok(c, n: int = 1) -> Column:
    """Length after stripping is at least ``n`` (null passes: optional field)."""
    return F.length(strip_ws(c)) >= F.lit(n)


def resource_id(c) -> Column:
    """Stripped resource ID, or null when it is empty or has other characters."""
    s = strip_ws(col_of(c))
    return F.when(s.rlike(RESOURCE_ID_PATTERN), s)


def handle_name(c) -> Column:
    """Handle without one leading ``@``; null when it is not a bare handle name."""
    s = strip_ws(col_of(c))
    name = F.when(s.startswith("@"), F.substring(s, 2, 1 << 30)).otherwise(s)
    ok = (F.length(name) > 0) & ~name.startswith("@") & ~name.contains("/") & ~name.rlike(r"(?U)\s")
    return F.when(ok, name)
