"""SimHash near-duplicates with pigeonring filtering.

A fingerprint has 64 bits in a ring of ``SEGMENTS`` segments. If two differ in at most
``distance`` bits, then on some start the differences summed over the first 1, 2, ...
consecutive segments stay within distance / SEGMENTS, 2 * distance / SEGMENTS, ... (the
pigeonring principle: such a chain must exist, or the sum round the ring would be larger).
With 4 bits and 5 segments: some segment is equal, and the one after it differs in at most
one bit. So a pair meets under a key of a start and two segments' bits (26 of 64), if each
fingerprint is listed under its own bits and under those with one set bit of the second
segment cleared: of two that differ in one bit, one has the bit set. The chain is then
followed to the end before the full Hamming check.

Scale: rows per fingerprint are fixed (5 keys, about 32 with one bit cleared) and pairs that
meet by chance are n^2 * 1e-6, against n^2 / 1600 for one equal segment. Only distinct
fingerprints are listed, so copies cost nothing. A key that many near copies share gives
their spanning forest, not their pairs, and one with more than ``BLOCK`` rows is dealt out in
pairs of blocks, so no task holds an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, ship, stored
from .components import components

SEGMENTS = (13, 13, 13, 13, 12)  # bits, from the lowest
BLOCK = 8192
SMALL = 64  # groups up to this size give their links, larger ones a spanning forest
SEED = 42


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """Signed 64-bit fingerprint of a whole text; 0 without a word."""
    import xxhash

    # bytes.lower and bytes.split are about ASCII only: A-Z, and white space 0x20 and 0x09-0x0D
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    flat = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
    stops = ends[min(shingle, len(words)) - 1:].tolist()
    digest = xxhash.xxh64_intdigest
    set_bits = np.zeros(64, np.int64)
    for a in range(0, n, 1 << 14):
        h = np.array([digest(flat[i:j], SEED) for i, j in zip(starts[a:a + (1 << 14)], stops[a:a + (1 << 14)])], "<u8")
        set_bits += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > n, bitorder="little").view("<i8")[0])


def with_fingerprints(docs: DataFrame, text_col: str = "text", out: str = "fingerprint", shingle: int = 4) -> DataFrame:
    """``docs`` with a long column ``out`` (renamed where taken): null and empty texts give 0."""
    schema = T.StructType(docs.schema.fields + [T.StructField(free_name(docs, out), T.LongType())])
    at = docs.columns.index(text_col)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.int64())], names=schema.names)

    return ship(docs).mapInArrow(add, schema)


def _keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of every listing: per start, two segments' bits, also with one bit cleared."""
    p = prints.view(np.uint64)
    at = np.concatenate(([0], np.cumsum(SEGMENTS)))
    rows, keys = [], []
    every = np.arange(len(p))
    for i in range(len(SEGMENTS)):
        j = (i + 1) % len(SEGMENTS)
        first = (p >> np.uint64(at[i])) & np.uint64((1 << SEGMENTS[i]) - 1)
        second = (p >> np.uint64(at[j])) & np.uint64((1 << SEGMENTS[j]) - 1)
        head = (np.uint64(i) << np.uint64(40)) | (first << np.uint64(20))
        rows.append(every)
        keys.append(head | second)
        for b in range(SEGMENTS[j]):
            bit = np.uint64(1 << b)
            has = np.flatnonzero(second & bit)
            rows.append(has)
            keys.append(head[has] | (second[has] ^ bit))
    return np.concatenate(rows), np.concatenate(keys)


def _listed(prints: DataFrame) -> DataFrame:
    """(key, p) rows of distinct fingerprints ``p``."""

    def lay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = batch.column(0).to_numpy()
            for a in range(0, len(p), 4096):
                rows, keys = _keys(p[a:a + 4096])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), pa.array(p[a:a + 4096][rows])], names=["key", "p"],
                )

    return ship(prints).mapInArrow(lay, "key long, p long")


def _chain(x: np.ndarray, distance: int) -> np.ndarray:
    """Whether differences ``x`` allow a whole chain from some start (prefixes within budget)."""
    at = np.concatenate(([0], np.cumsum(SEGMENTS)))
    per = [np.bitwise_count((x >> np.uint64(at[i])) & np.uint64((1 << SEGMENTS[i]) - 1)).astype(np.int64) for i in range(len(SEGMENTS))]
    m = len(SEGMENTS)
    found = np.zeros(x.shape, bool)
    for i in range(m):
        total, fits = np.zeros(x.shape, np.int64), np.ones(x.shape, bool)
        for step in range(m):
            total = total + per[(i + step) % m]
            fits &= total * m <= distance * (step + 1)
        found |= fits
    return found


def _links(p: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among the fingerprints of one key, as edges of a spanning forest."""
    u, v = [], []
    left, queue = np.unique(p), []
    while len(left) or queue:
        if not queue:
            queue.append(left[0])
            left = left[1:]
        x = queue.pop()
        near = np.bitwise_count(left ^ x) <= distance
        if near.any():
            found = left[near]
            left = left[~near]
            queue.extend(found)
            u.append(np.full(len(found), x))
            v.append(found)
    if not u:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    return np.concatenate(u), np.concatenate(v)


def _pairs_in_groups(key: np.ndarray, p: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within runs of equal ``key`` (sorted)."""
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    sizes = np.diff(np.append(starts, len(key)))
    u, v = [], []
    small = np.repeat(sizes <= SMALL, sizes) & np.repeat(sizes > 1, sizes)
    k, q = key[small], p[small]
    o = 1
    while o < len(k):
        same = k[o:] == k[:-o]
        if not same.any():
            break
        a, b = q[:-o][same], q[o:][same]
        x = a ^ b
        chained = _chain(x, distance)
        a, b, x = a[chained], b[chained], x[chained]
        near = np.bitwise_count(x) <= distance
        u.append(a[near])
        v.append(b[near])
        o += 1
    for s, n in zip(starts[sizes > SMALL].tolist(), sizes[sizes > SMALL].tolist()):
        a, b = _links(p[s:s + n], distance)
        u.append(a)
        v.append(b)
    if not u:
        return np.empty(0, np.uint64), np.empty(0, np.uint64)
    u, v = np.concatenate(u), np.concatenate(v)
    apart = u != v
    return u[apart], v[apart]


def links(prints: DataFrame, distance: int = 4) -> DataFrame:
    """(u, v) edges whose components are those of all pairs within ``distance`` bits.

    ``prints``: one long column of distinct fingerprints. ``distance`` must leave one segment
    equal and the next within one bit, so at most 4 with these segments.
    """
    if not 0 <= distance < len(SEGMENTS):
        raise ValueError(f"distance must be from 0 to {len(SEGMENTS) - 1}")
    rows = _listed(prints)
    # keys with too many rows for one task: their rows are dealt out as pairs of blocks
    heavy = stored(
        rows.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > BLOCK)
        .select("key", F.ceil(F.col("n") / BLOCK).alias("blocks")), "heavy-keys",
    )
    block = F.pmod(F.xxhash64("p"), F.col("blocks"))
    mates = F.expr("transform(sequence(0, blocks - 1), j -> named_struct('a', least(b, j), 'b', greatest(b, j)))")
    dealt = rows.join(heavy, "key", "left").withColumn("b", block).select(
        "key", "p", F.explode_outer(F.when(F.col("blocks").isNotNull(), mates)).alias("mate"),
    )
    dealt = dealt.select(F.when(F.col("mate").isNull(), F.col("key")).otherwise(F.xxhash64("key", "mate")).alias("key"), "p")
    together = dealt.repartition("key").sortWithinPartitions("key")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_p = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            k = np.concatenate([held_k, batch.column(0).to_numpy()])
            p = np.concatenate([held_p, batch.column(1).to_numpy().view(np.uint64)])
            if not len(k):
                continue
            cut = int(np.searchsorted(k, k[-1]))  # the last key may go on in the next batch
            yield _edges(k[:cut], p[:cut])
            held_k, held_p = k[cut:], p[cut:]
        yield _edges(held_k, held_p)

    def _edges(k: np.ndarray, p: np.ndarray) -> pa.RecordBatch:
        u, v = _pairs_in_groups(k, p, distance) if len(k) else (p, p)
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return ship(together).mapInArrow(link, "u long, v long")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, shingle: int = 4,
    keep: list[str] | None = None,
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with ``fingerprint`` (long) and ``component_id``.

    Documents are linked where their fingerprints differ in at most ``distance`` bits;
    ``component_id`` is the smallest id reachable over links. Texts without a word (null
    too) have fingerprint 0 and are linked like any other. Null ids are linked and never the
    smallest; a component of null ids only has a null component_id. Repeated rows are kept.
    Both names get an underscore where they are taken.
    """
    columns = list(docs.columns if keep is None else keep)
    used = [c for c in docs.columns if c in {*columns, id_col, text_col}]
    printed = with_fingerprints(docs.select(*[F.col(f"`{c}`") for c in used]), text_col, shingle=shingle)
    fp = printed.columns[-1]
    printed = stored(printed.select(*[F.col(f"`{c}`") for c in dict.fromkeys([*columns, id_col, fp])]), "fingerprints")
    p, out = free_name(printed, "class_print"), free_name(printed, "component_id")
    of_class = _classes(printed, fp, id_col, distance).select(F.col("p").alias(p), F.col("smallest").alias(out))
    return printed.join(of_class, F.col(f"`{fp}`") == F.col(p)).select(*[F.col(f"`{c}`") for c in columns], F.col(f"`{fp}`"), out)


def _classes(printed: DataFrame, fp: str, id_col: str, distance: int) -> DataFrame:
    """(p, component, smallest) of every distinct fingerprint: smallest id of its component."""
    classes = printed.groupBy(F.col(f"`{fp}`").alias("p")).agg(F.min(F.col(f"`{id_col}`")).alias("least"))
    classes = stored(classes, "classes")
    found = components(links(classes.select("p"), distance))
    labelled = classes.join(found.withColumnRenamed("node", "p"), "p", "left")
    labelled = labelled.withColumn("component", F.coalesce("component", "p"))
    smallest = labelled.groupBy("component").agg(F.min("least").alias("smallest"))
    return stored(labelled.join(smallest, "component").select("p", "component", "smallest"), "class-components")


def one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", distance: int = 4, shingle: int = 4,
) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest id.

    Rows with null ids only stay where their component has no other. Of several rows with the
    smallest id the one with the lowest hash of all columns stays, once if repeated.
    """
    printed = with_fingerprints(docs, text_col, shingle=shingle)
    fp = printed.columns[-1]
    k = free_name(printed, "row_hash")
    printed = stored(printed.withColumn(k, F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])), "fingerprints")
    thin = printed.select(F.col(f"`{fp}`").alias("p"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{k}`").alias("k"))
    order = F.struct(F.col("id").isNull().alias("no_id"), "id", "k")
    first = thin.join(_classes(printed, fp, id_col, distance), "p").groupBy("component").agg(F.min(F.struct(order.alias("o"), "p")).alias("m"))
    p, h = free_name(printed, "chosen_print"), free_name(printed, "chosen_hash")
    chosen = first.select(F.col("m.p").alias(p), F.col("m.o.k").alias(h))
    kept = printed.join(chosen, (F.col(f"`{fp}`") == F.col(p)) & (F.col(f"`{k}`") == F.col(h)), "left_semi")
    row = F.first(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))
    return kept.groupBy(fp, k).agg(row.alias("row")).select("row.*")
