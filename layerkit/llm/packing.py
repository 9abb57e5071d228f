"""Best-fit packing: documents as token pieces, packed into sequences by sums of squares.

Sum-of-squares packing keeps, for every residual gap, the number N(gap) of open sequences
with that gap, and places a piece so that the sum of N(gap)^2 after it is smallest. A piece
of length s moved into a sequence with gap g changes the sum by 2 * (N(g - s) - N(g)) + 2
(a gap of zero is closed and counts no more). Among the open sequences the smallest change
wins, then the smallest gap; a new sequence is opened only where none has room, and longer
pieces go first: of the orders tried on the documents table, this one leaves the fewest
sequences (one more than the volume bound per bucket of 8,192 pieces).

Scale: pieces are dealt by hash into buckets of about ``PER_BUCKET`` pieces, as many as the
count asks for, so a task holds one bounded bucket whatever the input size, and a sample of
all lengths meets in each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, ship
from .tokens import encoded_slices

PER_BUCKET = 8192


def token_pieces(
    docs: DataFrame,
    tokenizer: str,
    seq_len: int = 2048,
    end_id: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Documents as pieces of at most ``seq_len`` ids: id_col, piece, start, length, ids.

    A document is the ids of its whole text (null or empty: none), then ``end_id``. Only
    longer ones are cut; the first piece takes what does not fill a whole one. ``ids`` are
    little-endian unsigned 32-bit integers. A null id stays null, repeated rows are
    documents of their own, other columns are left out.
    """
    end = np.asarray([end_id], "<u4").tobytes()
    id_type = docs.schema[id_col].dataType
    schema = T.StructType([
        T.StructField(id_col, id_type),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, encoded in encoded_slices(tokenizer, batch.column(1)):
                row, piece, start, length, ids = [], [], [], [], []
                for i, raw in enumerate(encoded, first):
                    raw += end
                    n = len(raw) // 4
                    at, k = 0, 0
                    while at < n:
                        size = (n % seq_len or seq_len) if at == 0 else seq_len
                        row.append(i)
                        piece.append(k)
                        start.append(at)
                        length.append(size)
                        ids.append(raw[4 * at:4 * (at + size)])
                        at, k = at + size, k + 1
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).take(pa.array(row, pa.int32())),
                        pa.array(piece, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(length, pa.int64()),
                        pa.array(ids, pa.binary()),
                    ],
                    names=schema.names,
                )

    return ship(docs.select(id_col, text_col)).mapInArrow(cut, schema)


def place(lengths: np.ndarray, seq_len: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence number, offset) of each piece; longest first, by sums of squares."""
    n_open = np.zeros(seq_len + 1, np.int64)
    waiting: list[list[int]] = [[] for _ in range(seq_len + 1)]
    seq, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    made, never = 0, np.iinfo(np.int64).max
    for i in np.argsort(-lengths, kind="stable").tolist():
        s = int(lengths[i])
        gaps = n_open[s:seq_len]
        change = 2 * (n_open[:seq_len - s] - gaps) + 2
        if len(change):
            change[0] = 1 - 2 * gaps[0]  # an exact fit closes the sequence
            change[gaps == 0] = never
            g = int(change.argmin())
        if len(change) and change[g] != never:
            g += s
            n_open[g] -= 1
            q = waiting[g].pop()
        else:
            g, q, made = seq_len, made, made + 1
        seq[i], offset[i] = q, seq_len - g
        if g > s:
            n_open[g - s] += 1
            waiting[g - s].append(q)
    return seq, offset


def pack(pieces: DataFrame, seq_len: int = 2048, per_bucket: int = PER_BUCKET) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: every piece placed whole and once.

    Needs a column ``length`` (1 to ``seq_len``); all other columns are carried along, those
    named ``sequence_id`` or ``offset`` are replaced. Offsets in a sequence are gapless from
    0. Sequence ids are distinct numbers, not gapless. Pieces of equal content hash to one
    bucket and are packed like any other; an empty input gives an empty result.

    ``pieces`` is read twice (its count sets the number of buckets), so pass a stored table.
    """
    carried = pieces.drop("sequence_id", "offset")
    buckets = max(1, -(-carried.count() // per_bucket))
    bucket = free_name(carried, "bucket")
    schema = T.StructType(carried.schema.fields + [
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])

    def place_bucket(key: tuple, group: pa.Table) -> pa.Table:
        group = group.drop_columns([bucket])
        seq, offset = place(group.column("length").to_numpy(), seq_len)
        ids = seq + (int(key[0].as_py()) << 32)
        return group.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    by = F.pmod(F.xxhash64(*[c for c in carried.columns]), F.lit(buckets)).cast("long")
    return ship(carried.withColumn(bucket, by)).groupBy(bucket).applyInArrow(place_bucket, schema)
