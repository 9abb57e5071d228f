"""Rows of a key met in order by a small Python state, without holding the key's rows.

``ordered`` sorts rows over the whole table: a key's rows may lie in several partitions, so a
hot key is many tasks, and ``at`` numbers them in order. ``streamed`` hands the rows of each
key, in order, to a state object that keeps no more than it needs (a digest, a vector id).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ship, stored

SLICE = 256  # rows made Python objects at a time
HELD = 2048  # rows collected before they leave as one batch


def ordered(df: DataFrame, order: Sequence[str], label: str, keep: Sequence | None = None) -> DataFrame:
    """``df`` sorted by ``order`` (nulls first) with ``part`` and ``at``, written once.

    ``at`` ascends in the order of the whole table and is gapless within a ``part``. Both are
    columns of a written table, so every reader sees the same numbers. ``keep``: columns left
    beside them (default: all)."""
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    kept = list(keep) if keep is not None else ["*"]
    numbered = sorted_rows.select(
        *kept, F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at"),
    )
    return stored(numbered, label)


def record_batches(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def mapped(df: DataFrame, row: Callable[..., Iterator[tuple]], schema: T.StructType) -> DataFrame:
    """``row(*values)`` for every row of ``df``; what it yields are rows of ``schema``."""
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                columns = [c.to_pylist() for c in batch.slice(first, SLICE).columns]
                yield record_batches([out for values in zip(*columns) for out in row(*values)], arrow)

    return ship(df).mapInArrow(run, schema)


def streamed(
    df: DataFrame, by: Sequence[str], order: Sequence, fold: Callable[[], object], schema: T.StructType,
) -> DataFrame:
    """One state per key of ``by``: ``add(*row)`` for its rows in ``order``, then ``end()``.

    Both yield rows of ``schema``; every row given to ``add`` has all columns of ``df``."""
    dealt = df.repartition(*by).sortWithinPartitions(*by, *order)
    at = [df.columns.index(c) for c in by]
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, key, out = None, None, []
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                columns = [c.to_pylist() for c in batch.slice(first, SLICE).columns]
                for values in zip(*columns):
                    own = tuple(values[i] for i in at)
                    if state is None or own != key:
                        if state is not None:
                            out.extend(state.end())
                        state, key = fold(), own
                    out.extend(state.add(*values))
                if len(out) >= HELD:
                    yield record_batches(out, arrow)
                    out = []
        if state is not None:
            out.extend(state.end())
        yield record_batches(out, arrow)

    return ship(dealt).mapInArrow(run, schema)
