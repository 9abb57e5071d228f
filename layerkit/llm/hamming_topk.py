"""Exact top-k search over binary codes by incremental multi-index hashing.

A vector's code has one bit per component (set where it is above zero). Codes are cut into m
segments, and every code is listed under each segment's value. If two codes differ in at most
m * (r + 1) - 1 bits, some segment differs in at most r. So round r looks up, for every query
still open, all segment values within radius r, keeps the codes whose verified Hamming distance
is within that bound, and closes the queries that have k of them: their k nearest are then
among the codes found, whatever was not looked at. Open queries go on with r + 1, at the latest
until r is a whole segment and the bound covers all codes.

Scale: segments have about log2(codes) bits, so a listed value has a few codes whatever their
number. Only distinct codes are listed, with their count and k + 1 smallest ids, so a vector
that a third of all rows share is one entry. A pair that meets under several segments is kept
by the first of them, inside the join condition: no duplicates, and candidates that fail the
check never leave the join. Each round's results are written below ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import itertools
import logging
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, stored

log = logging.getLogger(__name__)


def _word_names(bits: int, side: str) -> list[str]:
    return [f"{side}{i}" for i in range(-(-bits // 64))]


def binary_codes(vectors: DataFrame, bits: int, id_col: str, vector_col: str) -> DataFrame:
    """(id, c0, c1, ...): signs of the vectors as 64-bit words, lowest component first.

    Rows whose vector is null, has a null or NaN, or another length than ``bits`` have no code
    and are left out."""
    schema = T.StructType([T.StructField("id", vectors.schema[id_col].dataType)] + [T.StructField(c, T.LongType()) for c in _word_names(bits, "c")])
    words = -(-bits // 64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, bits)
            padded = np.zeros((len(flat), 64 * words), bool)
            padded[:, :bits] = flat > 0
            packed = np.packbits(padded, axis=1, bitorder="little").view("<i8")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(np.ascontiguousarray(packed[:, i])) for i in range(words))], names=schema.names,
            )

    v = F.col(f"`{vector_col}`")
    whole = vectors.select(F.col(f"`{id_col}`").alias("id"), v.alias("v")).filter(
        (F.size("v") == bits) & ~F.exists("v", lambda x: x.isNull() | F.isnan(x)),
    )
    return ship(whole).mapInArrow(encode, schema)


def _segments(bits: int, n_codes: int) -> list[tuple[int, int, int]]:
    """(word, offset, width) of segments of about log2(n_codes) bits, 6 to 20, none across words."""
    want = min(20, max(6, round(math.log2(max(n_codes, 2)))))
    out = []
    for w in range(-(-bits // 64)):
        size = min(64, bits - 64 * w)
        m = max(1, round(size / want))
        edges = [size * i // m for i in range(m + 1)]
        out += [(w, a, b - a) for a, b in zip(edges, edges[1:])]
    return out


def _segment(side: str, seg: tuple[int, int, int]) -> Column:
    w, offset, width = seg
    value = F.shiftrightunsigned(F.col(f"{side}{w}"), offset)
    return value if width == 64 else value.bitwiseAND(F.lit((1 << width) - 1))


def _ball(width: int, radius: int) -> np.ndarray:
    """All masks of at most ``radius`` of ``width`` bits."""
    masks = [0]
    for r in range(1, min(radius, width) + 1):
        masks += [sum(1 << b for b in c) for c in itertools.combinations(range(width), r)]
    return np.array(masks, np.int64)


def _probes(queries: DataFrame, segments: list[tuple[int, int, int]], radius: int, names: list[str]) -> DataFrame:
    """(seg, value, query words): every segment value within ``radius`` of a query's."""
    schema = T.StructType([T.StructField("seg", T.IntegerType()), T.StructField("value", T.LongType())] + [T.StructField(c, T.LongType()) for c in names])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        balls = [_ball(width, radius) for _, _, width in segments]
        for batch in batches:
            words = [c.to_numpy() for c in batch.columns]
            for row in range(batch.num_rows):
                for j, (w, offset, width) in enumerate(segments):
                    own = np.int64((int(words[w][row]) >> offset) & ((1 << width) - 1))
                    n = len(balls[j])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, j, np.int32)), pa.array(balls[j] ^ own), *(pa.array(np.full(n, x[row])) for x in words)],
                        names=schema.names,
                    )

    return ship(queries.select(*names)).mapInArrow(spread, schema)


def _usual_length(vectors: DataFrame, vector_col: str) -> int:
    """The most frequent length above 0; logs how many rows have another one, or none."""
    v = F.col(f"`{vector_col}`")
    broken = F.exists(v, lambda x: x.isNull() | F.isnan(x))
    length = F.when(v.isNotNull() & ~broken, F.size(v)).otherwise(0)
    by_length = vectors.groupBy(length.alias("length")).count()
    totals = by_length.agg(F.max(F.when(F.col("length") > 0, F.struct("count", "length"))).alias("most"), F.sum("count").alias("n")).first()
    if totals["most"] is None:
        return 1
    left_out = totals["n"] - totals["most"]["count"]
    if left_out:
        log.warning("%d of %d rows have no vector of %d components and are left out", left_out, totals["n"], totals["most"]["length"])
    return totals["most"]["length"]


def top_k(
    vectors: DataFrame, queries: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    bits: int | None = None,
) -> DataFrame:
    """(query_id, rank, id_col, distance): the ``k`` nearest other rows of every query row.

    ``queries`` is a condition over the table's columns that marks the query rows; all rows
    are searched. Rank 1 to k by (Hamming distance, id); a row is not its own neighbour. Exact.
    Vectors have ``bits`` components, or the table's most frequent length (the greater of equally
    frequent ones); rows with a null or broken vector, or one of another length, are neither
    searched nor found (their number is logged where the length is taken from the table), nor are
    rows with a null id. Repeated ids are one row per
    code. With fewer than k others all are returned; an empty table gives an empty result.
    """
    id_type = vectors.schema[id_col].dataType
    if bits is None:
        bits = _usual_length(vectors, vector_col)
    names, q_names = _word_names(bits, "c"), _word_names(bits, "q")
    usable = vectors.filter(F.col(f"`{id_col}`").isNotNull())
    codes = stored(binary_codes(usable, bits, id_col, vector_col).distinct(), "codes")
    asked_ids = usable.filter(queries).select(F.col(f"`{id_col}`").alias("id")).distinct()
    asked = stored(codes.join(asked_ids, "id", "left_semi"), "query-codes")

    by_id = Window.partitionBy(*names).orderBy("id")
    first_ids = codes.withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    index = stored(first_ids.groupBy(*names).agg(F.sort_array(F.collect_list("id")).alias("ids")), "code-index")
    segments = _segments(bits, index.count())
    m = len(segments)
    listed = index.select(
        F.posexplode(F.array(*[_segment("c", s) for s in segments])).alias("seg", "value"), *names, F.element_at("ids", 1).alias("first_id"),
        F.size("ids").alias("n"),
    )
    listed = stored(listed, "code-segments")
    open_ = stored(asked.select(*[F.col(a).alias(b) for a, b in zip(names, q_names)]).distinct(), "open-queries")
    results = None
    for radius in range(max(w for _, _, w in segments) + 1):
        bound = m * (radius + 1) - 1
        per_segment = [F.bit_count(_segment("q", s).bitwiseXOR(_segment("c", s))) for s in segments]
        earlier = F.lit(False)
        meets: Column = F.lit(False)
        for j, d in enumerate(per_segment):
            meets = meets | ((F.col("p.seg") == j) & ~earlier)
            earlier = earlier | (d <= radius)
        distance = sum((F.bit_count(F.col(q).bitwiseXOR(F.col(c))) for q, c in zip(q_names, names)), F.lit(0))
        # probes repeat their query's words, so they compress to little and would pass for broadcastable
        found = _probes(open_, segments, radius, q_names).alias("p").hint("merge").join(
            listed.alias("l"), (F.col("p.seg") == F.col("l.seg")) & (F.col("p.value") == F.col("l.value")) & (distance <= bound) & meets,
        ).select(*q_names, *names, distance.cast("int").alias("distance"), "first_id", "n")
        nearest = Window.partitionBy(*q_names).orderBy("distance", "first_id")
        # k + 1 codes hold at least k ids besides the query's own
        found = stored(found.withColumn("r", F.row_number().over(nearest)).filter(F.col("r") <= k + 1), "found-codes")
        covered = found.groupBy(*q_names).agg(F.sum("n").alias("have")).filter(F.col("have") > k).select(*q_names)
        last = radius == max(w for _, _, w in segments)
        closed = found if last else found.join(covered, q_names, "left_semi")
        results = closed if results is None else results.unionByName(closed)
        if last:
            break
        open_ = stored(open_.join(covered, q_names, "left_anti"), "open-queries")
        if open_.isEmpty():
            break
    ranked = Window.partitionBy("query_id").orderBy("distance", "id")
    near = results.join(index, names).select(*q_names, "distance", F.explode("ids").alias("id"))
    pairs = asked.select(F.col("id").alias("query_id"), *[F.col(a).alias(b) for a, b in zip(names, q_names)]).join(near, q_names)
    out = pairs.filter("query_id != id").groupBy("query_id", "id").agg(F.min("distance").alias("distance"))
    out = out.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k)
    return out.select("query_id", "rank", F.col("id").cast(id_type).alias(id_col), "distance")


def oracle_sql(vectors: str = "embeddings", k: int = 10, every: int = 50) -> str:
    """Brute force in DuckDB SQL."""
    return f"""
    WITH d AS (
      SELECT q.vec_id AS query_id, v.vec_id AS vec_id,
             list_sum(list_transform(list_zip(q.embedding, v.embedding), lambda x: CASE WHEN (x[1] > 0) <> (x[2] > 0) THEN 1 ELSE 0 END))::INT AS distance
      FROM {vectors} q JOIN {vectors} v ON q.vec_id % {every} = 0 AND q.vec_id <> v.vec_id
    ), r AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, vec_id)::INT AS rank FROM d
    )
    SELECT query_id, rank, vec_id, distance FROM r WHERE rank <= {k}"""
