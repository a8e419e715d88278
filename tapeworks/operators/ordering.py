"""Positions and running totals within a group without sorting the whole
group in one task.

``row_number()`` or ``sum() OVER (PARTITION BY g ORDER BY o)`` sends every
row of a group to one task.  When one channel or document holds a third of
the data, that task sorts a third of the data.  ``running_total`` gives the
same numbers in three skew-proof steps:

1. rows are labelled with an order bucket (a coarse key monotone in the
   order: hour of publication, minute of media time, a block of positions);
2. values per (group, bucket) are summed (partial aggregation) and turned
   into a running offset per group (a window over buckets only: small);
3. the running total runs within (group, bucket) — bounded by what one
   bucket holds — and is added to the bucket's offset.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_totals(df: DataFrame, group: list[str], bucket: Column, order: list, values: dict,
                   inclusive: bool = False) -> DataFrame:
    """Add one column per ``values`` entry (name → Column): the sum of that
    value over the rows before (``inclusive``: up to and including) each row
    within ``group`` in ``order``, all in one pass.  ``bucket`` must be
    monotone in ``order``: rows of a smaller bucket always come first."""
    tmp = {name: f"_v_{i}" for i, name in enumerate(values)}
    d = df.withColumn("_bucket", bucket)
    for name, v in values.items():
        d = d.withColumn(tmp[name], v)
    sums = d.groupBy(*group, "_bucket").agg(*[F.sum(t).alias(f"{t}_s") for t in tmp.values()])
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(*group, "_bucket", *[F.coalesce(F.sum(f"{t}_s").over(before), F.lit(0)).alias(f"{t}_o")
                                               for t in tmp.values()])
    frame = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    out = d.join(offsets, [*group, "_bucket"])
    for name, t in tmp.items():
        out = out.withColumn(name, F.col(f"{t}_o") + F.coalesce(F.sum(t).over(frame), F.lit(0)))
    return out.drop("_bucket", *tmp.values(), *[f"{t}_o" for t in tmp.values()])


def running_total(df: DataFrame, group: list[str], bucket: Column, order: list, value: Column,
                  name: str, inclusive: bool = False) -> DataFrame:
    """``running_totals`` with one value."""
    return running_totals(df, group, bucket, order, {name: value}, inclusive)


def dense_positions(df: DataFrame, group: list[str], bucket: Column, order: list, name: str = "pos",
                    start: int = 0) -> DataFrame:
    """Add ``name`` = position (from ``start``) of each row within ``group``
    in ``order`` — ``row_number() - 1 + start`` without a whole-group sort.
    ``order`` must be a total order (ties broken by a key)."""
    out = running_total(df, group, bucket, order, F.lit(1).cast("long"), name)
    return out.withColumn(name, F.col(name) + start) if start else out


def order_bucket(df: DataFrame, col: str, descending: bool = False) -> Column:
    """A coarse bucket monotone in ``col``: the day of a timestamp or date,
    blocks of 1000 for numbers.  Other types have no such bucket and are
    refused: numbering them would sort a whole group in one task."""
    t = df.schema[col].dataType.typeName()
    c = F.col(col)
    if t in ("timestamp", "timestamp_ntz", "date"):
        b = F.floor(F.unix_seconds(c.cast("timestamp")) / 86400)
    elif t in ("byte", "short", "integer", "long", "float", "double", "decimal"):
        b = F.floor(c / 1000)
    else:
        raise TypeError(f"no order bucket for {col}, a {t}; order by a number, date or timestamp first")
    return -b if descending else b
