"""Mixing sources to target weights, by Efraimidis-Spirakis sampling without replacement.

Every document gets the key -ln(u) / quality, u uniform from a hash of its id and text: the
smaller the key, the earlier it is drawn, and a document is drawn first with a chance in
proportion to its quality. Sources share the budget by weight. A source whose target is a
few times its size goes in whole so many times (complete epochs); of what is left of the
target, documents are taken in key order up to the prefix of sizes nearest to it.

Scale: the prefix is not summed over a sorted source (a hot one would be a single task).
Sizes are summed into cells of the key, with two passes of 4,096 cells per source; only the
few documents in the last cell are sorted. Per source one row of cut values remains, against
which every document is compared where it stands, so texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, stored

WEIGHTS = (5, 2, 1)  # of sources by code point, repeating, null last
MOST = 3  # times a source, and so a document, may be taken
CELLS = 4096
SEED = "mix-1"


def _group(source: Column) -> Column:
    """A source as a key that is never null."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def draw_key(id_col: Column, text: Column, quality: Column) -> tuple[Column, Column]:
    """(key, tie-break) of a document: the same on every run."""
    tie = F.md5(F.concat_ws("|", F.lit(SEED), F.coalesce(id_col.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))
    u = (F.conv(F.substring(tie, 1, 13), 16, 10).cast("double") + 0.5) / F.lit(float(1 << 52))
    return -F.ln(u) / quality, tie


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``target`` to rows (source_key, source, source_size), one per source.

    All sizes together are shared by weight; a target above ``most`` times its source stops
    there and the excess is shared among the others by weight, until none is above. In the
    order of size / weight the stopped sources come first, so running sums of whole numbers
    find them in one pass. One row per source: small beside the documents.
    """
    # one partition on purpose: a row per source
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    d = sizes.withColumn("w", weight.cast("long"))
    rest = Window.orderBy(F.col("source_size") / F.col("w"), F.col("source").isNull(), "source")
    to_end = rest.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    d = (
        d.withColumn("total", F.sum("source_size").over(everything))
        .withColumn("w_left", F.sum("w").over(everything) - F.coalesce(F.sum("w").over(to_end), F.lit(0)))
        .withColumn("size_left", F.col("total") - most * F.coalesce(F.sum("source_size").over(to_end), F.lit(0)))
        .withColumn("stopped", most * F.col("source_size") * F.col("w_left") <= F.col("w") * F.col("size_left"))
    )
    shared_size = F.col("total") - most * F.coalesce(F.sum(F.when(F.col("stopped"), F.col("source_size"))).over(everything), F.lit(0))
    shared_w = F.sum(F.when(~F.col("stopped"), F.col("w"))).over(everything)
    share = F.col("w") * (shared_size.cast("double") / shared_w.cast("double"))
    target = F.when(F.col("stopped"), (most * F.col("source_size")).cast("double")).otherwise(share)
    return d.select("source_key", "source", "source_size", target.alias("target"))


def _cut_cell(cells: DataFrame, cell: str) -> DataFrame:
    """Per source the cell in which the running size passes what is left of the target."""
    upto = Window.partitionBy("source_key").orderBy(cell).rowsBetween(Window.unboundedPreceding, -1)
    d = cells.withColumn("before", F.col("base") + F.coalesce(F.sum("s").over(upto), F.lit(0)))
    return d.filter((F.col("before") <= F.col("left")) & (F.col("left") < F.col("before") + F.col("s")))


def mix(
    docs: DataFrame, size: Column, quality: Column, id_col: str = "doc_id", text_col: str = "text",
    source_col: str = "source", weights: Sequence[int] = WEIGHTS, most: int = MOST,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``docs`` (columns ``keep``, default all) with a struct column ``mix``.

    Its fields: size, source_size and target of the document's source, ``copies`` (how often
    the mix takes the document, 0 to ``most``) and ``taken`` (size times copies). ``size``
    (long) and ``quality`` (positive double) are columns over ``docs``; a null or
    non-positive quality counts as 1. A null source is a source of its own, ordered last;
    documents of size 0 take no part of a target. Rows with equal id and text have one key
    and are taken together or not at all. ``mix`` gets an underscore where it is taken; an
    empty table gives an empty result.
    """
    columns = list(docs.columns if keep is None else keep)
    quality = F.when(quality > 0, quality).otherwise(F.lit(1.0))
    key, tie = draw_key(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), quality)
    # cells in the order of the key: 1 - exp(-key) is even over [0, 1) for quality 1
    cell = F.floor((1 - F.exp(-key)) * F.lit(float(CELLS * CELLS))).cast("long")
    row = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row")
    keyed = docs.select(
        row, _group(F.col(f"`{source_col}`")).alias("source_key"), F.col(f"`{source_col}`").alias("source"),
        size.cast("long").alias("size"), key.alias("key"), tie.alias("tie"), cell.alias("cell"),
    )
    thin = stored(keyed.drop("row"), "mix-keys")

    sizes = thin.groupBy("source_key").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    plan = source_targets(sizes, weights, most).withColumn(
        "epochs", F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(most))).otherwise(0).cast("long"),
    )
    plan = stored(plan.withColumn("left", F.col("target") - F.col("epochs") * F.col("source_size")), "mix-targets")

    def summed(rows: DataFrame, cell: Column) -> DataFrame:
        return rows.groupBy("source_key", "left", "base", cell.alias("c")).agg(F.sum("size").alias("s"))

    first = thin.join(plan.select("source_key", "left"), "source_key").withColumn("base", F.lit(0).cast("long"))
    coarse = stored(_cut_cell(summed(first, F.floor(F.col("cell") / CELLS)), "c").select("source_key", "left", F.col("before").alias("base"), F.col("c").alias("coarse")), "mix-cells")
    second = thin.join(coarse, "source_key").filter(F.floor(F.col("cell") / CELLS) == F.col("coarse"))
    fine = stored(_cut_cell(summed(second, F.col("cell")), "c").select("source_key", "left", F.col("before").alias("base"), F.col("c").alias("fine")), "mix-cells")
    # the rest of one cell of CELLS * CELLS: a few documents, in key order
    third = thin.join(fine, "source_key").filter(F.col("cell") == F.col("fine"))
    drawn = third.groupBy("source_key", "left", "base", "fine", "key", "tie").agg(F.sum("size").alias("s"))
    upto = Window.partitionBy("source_key").orderBy("key", "tie").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("base") + F.coalesce(F.sum("s").over(upto), F.lit(0))
    drawn = drawn.withColumn("in", before + F.col("s") / 2 <= F.col("left"))
    last = drawn.groupBy("source_key", "fine").agg(F.max(F.when(F.col("in"), F.struct("key", "tie"))).alias("last"))
    cuts = stored(plan.join(last, "source_key", "left").drop("source"), "mix-cuts")

    # no cut cell: nothing is left of the target (the whole of a source is never left)
    drawn_too = F.coalesce(
        (F.col("cell") < F.col("fine")) | ((F.col("cell") == F.col("fine")) & (F.struct("key", "tie") <= F.col("last"))),
        F.col("cell") < F.col("fine"), F.lit(False),
    )
    copies = F.col("epochs") + F.when((F.col("size") > 0) & drawn_too, 1).otherwise(0)
    info = F.struct(
        "size", "source_size", "target", copies.cast("int").alias("copies"), (F.col("size") * copies).alias("taken"),
    )
    name = free_name(docs.select(*[F.col(f"`{c}`") for c in columns]), "mix")
    return keyed.join(cuts, "source_key").select("row.*", info.alias(name))


def label_quality(labels: DataFrame) -> DataFrame:
    """(doc_id, quality weight) from labels: good 2, bad 0.5; repeated labels count once, the best."""
    best = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("label_id")).agg(F.max("quality").alias("q"))
    return best.select("label_id", F.when(F.col("q") == 1, 2.0).when(F.col("q") == 0, 0.5).otherwise(1.0).alias("label_weight"))


def oracle_sql(documents: str = "documents", labels: str = "labels") -> str:
    """The same in DuckDB SQL, with running sums over whole sources (texts given by their md5)."""
    return f"""
    WITH w AS (
      SELECT doc_id AS label_id, CASE max(quality) WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight
      FROM {labels} WHERE doc_id IS NOT NULL GROUP BY 1
    ), d AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
             md5('{SEED}|' || coalesce(doc_id::VARCHAR, '') || '|' || md5(md5(coalesce(text, '')))) AS tie,
             coalesce(weight, 1.0::DOUBLE) AS quality
      FROM {documents} LEFT JOIN w ON doc_id = label_id
    ), keyed AS (
      SELECT *, -ln((('0x' || substr(tie, 1, 13))::BIGINT::DOUBLE + 0.5) / {1 << 52}::DOUBLE) / quality AS k FROM d
    ), s AS (
      SELECT source, sum(size)::BIGINT AS source_size,
             ([{', '.join(map(str, WEIGHTS))}])[((row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)} + 1)::INT]::BIGINT AS w
      FROM d GROUP BY source
    ), o AS (
      SELECT *, sum(source_size) OVER () AS total,
             sum(w) OVER () - coalesce(sum(w) OVER before, 0) AS w_left,
             sum(source_size) OVER () - {MOST} * coalesce(sum(source_size) OVER before, 0) AS size_left
      FROM s WINDOW before AS (ORDER BY source_size / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), c AS (
      SELECT *, {MOST} * source_size * w_left <= w * size_left AS stopped FROM o
    ), t AS (
      SELECT source, source_size, CASE WHEN stopped THEN ({MOST} * source_size)::DOUBLE ELSE
               w * ((total - {MOST} * coalesce(sum(source_size) FILTER (WHERE stopped) OVER (), 0))::DOUBLE
                    / (sum(w) FILTER (WHERE NOT stopped) OVER ())::DOUBLE) END AS target
      FROM c
    ), e AS (
      SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), {MOST}) ELSE 0 END::BIGINT AS epochs FROM t
    ), r AS (
      SELECT keyed.*, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
             coalesce(sum(size) OVER (PARTITION BY keyed.source ORDER BY k, tie ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM keyed JOIN e ON keyed.source IS NOT DISTINCT FROM e.source
    )
    SELECT doc_id, size, source_size, target,
           (size * (epochs + CASE WHEN size > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken,
           (epochs + CASE WHEN size > 0 AND before + size / 2 <= rest THEN 1 ELSE 0 END)::INT AS copies
    FROM r"""
