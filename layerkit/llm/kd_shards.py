"""K-d tree shards: documents split at weighted medians along the widest metadata dimension.

A cell that is to hold n shards is split into cells of n // 2 and n - n // 2 shards, at the
value of its widest dimension below which lies that share of its bytes, until every cell is
one shard of about ``target_bytes``. Dimensions are the metadata of a group of equal texts:
bytes, language, source and smallest id, each over its range in the whole table.

Equal texts are one group and stay in one shard. A group that alone is more than a 64th of a
shard is cut into parts by id, or no split could be even; its parts lie next to each other in
every dimension, so it is only torn where a median falls inside it.

Scale: a median is not found by sorting a cell (the first one is the whole table). Keys are
whole numbers of 60 bits; bytes are summed into 4,096 ranges of the key, then into 4,096
ranges of the range that holds the median, and so on, for all cells of a level at once. The
driver gets at most 4,096 sums per cell and pass. All passes run over a narrow table, written
once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_size, free_name, stored

BITS = 12  # of the key, per pass
PASSES = 5
CLOSE = 0.0005  # share of a cell's bytes a range may hold for its edge to be the cut
PARTS = 64  # a group above 1/PARTS of a shard is divided
PER_CHUNK = 8192  # rows numbered by one task
DIMENSIONS = ("d_bytes", "d_lang", "d_source", "d_id")


@dataclass
class Cell:
    """A node of the tree: ``shards`` leaves, numbered from ``first``."""

    first: int
    shards: int
    bytes: int = 0
    dimension: str | None = None
    cut: int | None = None  # keys below it go left
    low: "Cell | None" = None
    high: "Cell | None" = None
    # search state: the key range known to hold the median, and the bytes before it
    lo: int = 0
    bits: int = BITS * PASSES
    before: int = 0
    done: bool = field(default=False)


def _key(dimension: str) -> Column:
    """60-bit key: 24 bits of the dimension, then 36 of the group and the part (see ``_part_bits``)."""
    scaled = F.floor(F.col(dimension) * F.lit(float((1 << 24) - 1))).cast("long")
    return F.shiftleft(scaled, 36) + F.col("tie")


def _part_bits(n_shards: int) -> int:
    """Bits of the tie that number a group's parts; the others tell groups apart.

    A group of all bytes has ``n_shards * PARTS`` parts. 8 bits up to 16 shards, where a third of
    the bytes needs no more; at most 24, so that 12 are left for groups."""
    return min(24, max(8, math.ceil(math.log2(n_shards * PARTS)) if n_shards > 16 else 8))


def _place(cell: Cell, leaf) -> Column:
    """An expression over the tree: ``leaf(cell)`` for the cell a row is in."""
    if cell.low is None:
        return leaf(cell)
    return F.when(_key(cell.dimension) < F.lit(cell.cut), _place(cell.low, leaf)).otherwise(_place(cell.high, leaf))


def _leaves(cell: Cell) -> list[Cell]:
    return [cell] if cell.low is None else _leaves(cell.low) + _leaves(cell.high)


def _grow(root: Cell, rows: DataFrame) -> None:
    """Split every cell of more than one shard, level by level."""
    while open_cells := [c for c in _leaves(root) if c.shards > 1]:
        cell_of = _place(root, lambda c: F.lit(c.first))
        spans = [(F.max(d) - F.min(d)).alias(d) for d in DIMENSIONS]
        seen = {
            r["cell"]: r for r in rows.groupBy(cell_of.alias("cell")).agg(F.sum("size").alias("bytes"), *spans).collect()
        }  # one row per cell
        for c in open_cells:
            r = seen.get(c.first)
            c.bytes = r["bytes"] if r else 0
            c.dimension = max(DIMENSIONS, key=lambda d: (r[d] if r else 0, -DIMENSIONS.index(d)))
            c.done = not c.bytes
        for _ in range(PASSES):
            searching = {c.first: c for c in open_cells if not c.done}
            if not searching:
                break

            def bin_of(c: Cell) -> Column:
                if c.first not in searching:
                    return F.lit(None).cast("long")
                off = _key(c.dimension) - F.lit(c.lo)
                inside = (off >= 0) & (off < F.lit(1 << c.bits))
                return F.when(inside, F.shiftright(off, c.bits - BITS))

            found = rows.select(cell_of.alias("cell"), _place(root, bin_of).alias("bin"), "size").filter("bin is not null")
            sums = found.groupBy("cell", "bin").agg(F.sum("size").alias("s")).collect()  # cells * 4,096 rows at most
            by_cell: dict[int, list] = {}
            for r in sums:
                by_cell.setdefault(r["cell"], []).append((r["bin"], r["s"]))
            for first, bins in by_cell.items():
                _narrow(searching[first], sorted(bins))
        for c in open_cells:
            left = c.shards // 2
            c.low, c.high = Cell(c.first, left), Cell(c.first + left, c.shards - left)
            c.cut = c.lo if c.cut is None else c.cut


def _narrow(c: Cell, bins: list[tuple[int, int]]) -> None:
    """Go into the range that holds the weighted median, or set the cut at its nearer edge."""
    goal, width = c.bytes * (c.shards // 2) / c.shards, c.bits - BITS
    for b, s in bins:
        if c.before + s >= goal or (b, s) == bins[-1]:
            start = c.lo + (b << width)
            if s <= CLOSE * c.bytes or not width:
                c.cut = start + (1 << width) if c.before + s - goal <= goal - c.before else start
                c.done = True
            c.lo, c.bits = start, width
            return
        c.before += s


def shards(
    docs: DataFrame, n_shards: int | None = 16, target_bytes: int | None = None, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
) -> DataFrame:
    """(id_col, size, text_crc32, shard, slot) of every row.

    ``size``: UTF-8 bytes of the text (null: none) plus 1. ``n_shards``, or as many shards as
    reach ``target_bytes`` each. Shards are near equal in bytes; ``slot`` numbers the rows of
    a shard gaplessly from 0. Nulls in the metadata come first in their dimension, null and
    empty texts are one group, repeated rows get slots of their own, other columns are left
    out. An empty table gives an empty result.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    read = docs.select(
        F.col(f"`{id_col}`").alias("id"), (byte_size(text) + 1).alias("size"), F.crc32(text.cast("binary")).alias("crc"),
        F.xxhash64(text).alias("g"), F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
        F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"),
    )
    read = stored(read, "shard-docs")
    n, total = read.agg(F.count("*"), F.coalesce(F.sum("size"), F.lit(0))).first()
    if target_bytes is not None:
        n_shards = max(1, round(total / target_bytes))
    groups = read.groupBy("g").agg(
        F.sum("size").alias("group_bytes"), F.min("size").alias("bytes"), F.min("lang").alias("lang"),
        F.min("source").alias("source"), F.min(F.xxhash64("id")).alias("any_id"), F.min("id").alias("min_id"),
    )
    groups = groups.select("g", "group_bytes", *_scaled(groups))
    part_bytes = max(1.0, total / n_shards / PARTS)
    bits = _part_bits(n_shards)
    parts = F.least(F.ceil(F.col("group_bytes") / F.lit(part_bytes)), F.lit(1 << bits)).cast("long")
    part = F.pmod(F.xxhash64("id", "g", F.lit(7)), parts)
    tie = F.shiftleft(F.shiftrightunsigned("g", 28 + bits), bits) + part
    rows = read.select("id", "size", "crc", "g").join(groups, "g").select("id", "size", "crc", tie.alias("tie"), *DIMENSIONS)
    rows = stored(rows, "shard-rows")
    root = Cell(0, n_shards)
    _grow(root, rows)
    placed = rows.select("id", "size", "crc", _place(root, lambda c: F.lit(c.first)).alias("shard"))

    # gapless numbers: rows of a chunk are numbered in a task, after all rows of earlier chunks
    chunks = max(1, -(-n // (n_shards * PER_CHUNK)))
    placed = placed.withColumn("chunk", F.pmod(F.xxhash64("id", "crc", F.lit(11)), F.lit(chunks)))
    counts = placed.groupBy("shard", "chunk").count()
    earlier = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("shard").alias("s"), F.col("chunk").alias("c"), F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("off"))
    within = F.row_number().over(Window.partitionBy("shard", "chunk").orderBy("id", "crc")) - 1
    numbered = placed.withColumn("n", within).join(offsets, F.expr("shard = s and chunk = c"))
    return numbered.select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("n") + F.col("off")).cast("long").alias("slot"),
    )


def _scaled(groups: DataFrame) -> list[Column]:
    """The dimensions of a group as numbers in [0, 1], so that widths compare.

    Bytes by their logarithm and ids by value (by hash where they are no numbers), over their
    range in the table; languages and sources by a hash of the name, as names have no distance.
    """
    numeric = dict(groups.dtypes)["min_id"] in ("tinyint", "smallint", "int", "bigint", "float", "double")
    id_value = F.col("min_id" if numeric else "any_id").cast("double")
    lo, hi, most = groups.agg(F.min(id_value), F.max(id_value), F.max("bytes")).first()
    lo, hi = lo or 0.0, hi or 0.0

    def name(c: str) -> Column:
        return F.coalesce(F.conv(F.substring(F.md5(c), 1, 6), 16, 10).cast("double") / F.lit(float(16**6)), F.lit(0.0))

    unit = lambda x: F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(x, F.lit(0.0))))
    return [
        unit(F.ln(F.col("bytes")) / F.ln(F.lit(float(max(most or 2, 2))))).alias("d_bytes"),
        unit(name("lang")).alias("d_lang"),
        unit(name("source")).alias("d_source"),
        unit((id_value - F.lit(lo)) / F.lit(max(hi - lo, 1.0))).alias("d_id"),
    ]
