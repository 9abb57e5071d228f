"""Bins of an ordered column: how one hot key is spread over many tasks.

A bin is a fixed range of the order column, so its number is a function of the row alone: no job
finds bounds, and every reader, retry and re-plan agrees. Neighbours are found within (key,
bin); what crosses a bin's border is found from one row per (key, bin), again in bins (of bins)
where the type asks for it, and last in one window per key.

* times: ``TIME_BINS``, one level of 2^36 microseconds (19 hours); the last window has one row
  per (key, bin), some 23,000 for a key that changes for 50 years;
* whole numbers: ``NUMBER_BINS``, three levels of 2^16; no window has more than 2^16 rows per
  group when the order column is unique within a key;
* other types: one bin.

Null is an order value of its own, before all others.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_BINS = (1 << 36,)
NUMBER_BINS = (1 << 16, 1 << 16, 1 << 16)
_NULL_BIN = -(1 << 63)


def bin_widths(df: DataFrame, order: str, widths: Sequence[int] | None = None) -> tuple[int, ...]:
    """Widths of the levels for the type of ``order``: in microseconds, or in units of the number."""
    kind = df.schema[order].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return tuple(TIME_BINS if widths is None else widths)
    if isinstance(kind, T.IntegralType):
        return tuple(NUMBER_BINS if widths is None else widths)
    return ()


def bin_of(df: DataFrame, order: str, widths: Sequence[int]) -> Column:
    """The bin of a row at the first level (0 without levels)."""
    if not widths:
        return F.lit(0).cast("long")
    c = F.col(f"`{order}`")
    number = c.cast("long") if isinstance(df.schema[order].dataType, T.IntegralType) else F.unix_micros(c.cast("timestamp"))
    return F.coalesce(F.floor(number / F.lit(widths[0])), F.lit(_NULL_BIN))


def nearest(
    df: DataFrame, key: str, order: str, value: Column, widths: Sequence[int], out: str, after: bool = False,
) -> DataFrame:
    """``df`` with ``out``: the last non-null ``value`` among a key's rows before the row in
    ``order`` (``after``: the first among those after it). ``key`` is never null (a struct)."""
    ahead = F.col(order).desc_nulls_last() if after else F.col(order).asc_nulls_first()

    def met(*by: str) -> Column:
        w = Window.partitionBy(*by).orderBy(ahead).rowsBetween(Window.unboundedPreceding, -1)
        return F.last(value, ignorenulls=True).over(w)

    if not widths:
        return df.withColumn(out, met(key))
    level, edge_col, far_col = (f"__{name}{len(widths)}" for name in ("bin", "edge", "far"))
    binned = df.withColumn(level, bin_of(df, order, widths))
    edge = (F.min if after else F.max)(F.when(value.isNotNull(), F.struct(F.col(order).alias("o"), value.alias("v"))))
    edges = binned.groupBy(key, level).agg(edge["v"].alias(edge_col))
    far = nearest(edges, key, level, F.col(edge_col), widths[1:], far_col, after).select(key, level, far_col)
    near = binned.withColumn(out, met(key, level)).join(far, [key, level])
    return near.withColumn(out, F.coalesce(out, far_col)).drop(level, far_col)
