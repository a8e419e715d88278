"""Column-level helpers: every function takes and returns ``Column``s."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bind(x: Column, then: Callable[[Column], Column]) -> Column:
    """``then(x)`` with ``x`` evaluated once, however often it is used."""
    return F.element_at(F.transform(F.array(x), then), 1)


def evaluate_once(df, keep: list[str], cols: list[Column]):
    """Project ``cols`` so each is computed once per row.

    ``inline(array(struct(..)))`` is a generator: filters above it cannot be
    pushed below it, so later rules and quarantine filters read the computed
    columns instead of re-evaluating (say) ``from_json`` once per reference.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*cols))))
