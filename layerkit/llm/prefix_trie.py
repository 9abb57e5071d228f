"""Prefix trie of conversations with subtree totals, by depth-band rollup.

A node of depth d is a distinct sequence of the first d turns (role, text); its key is d and two
64-bit fingerprints, the exclusive or of position-dependent turn hashes up to d. So a prefix's
key follows from the keys of blocks of turns, and a long conversation is keyed by many tasks.

Subtree totals by bands of ``BAND`` depths:

* up: every node explodes its value to its ancestors within its band only (at most ``BAND``);
  the top of a band then has the total of its band part and stands for it one level up, where
  a band is ``BAND`` times as high;
* down: a completed band-root total is added to the at most ``BAND`` ancestors of the root in
  the band above.

Rounds grow with the logarithm of the depth (levels), and no node explodes to more than ``BAND``
rows a level. The ancestors come from the path of the node's smallest member: groups of
(conversation, band) with at most ``BAND`` rows. Sums are combined on the map side, so a node
with many descendants or members is no hot key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .streams import ordered, streamed

BAND = 8
BLOCK = 4096  # turns whose hashes are joined by one window; span of ids joined in one string (2^12)
KEY = ["depth", "x", "y"]


def numbered(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> DataFrame:
    """Narrow turns: conv, pos (1, 2, ... by turn), two content hashes a and b, bytes of the text.

    Null turns come first, equal turns go by role and text, repeated rows are turns of their
    own; a null role or text is empty; rows without an id belong to no conversation and are
    left out; other columns are left out.
    """
    role, text = F.coalesce(role_col, F.lit("")), F.coalesce(text_col, F.lit(""))
    own = turns.filter(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
    )
    rows = ordered(own, ["conv", "turn", "role", "text"], "trie-turns", [
        "conv", F.xxhash64(F.lit(1), "role", "text").alias("a"), F.xxhash64(F.lit(2), "role", "text").alias("b"),
        F.octet_length("text").cast("long").alias("bytes"),
    ])
    # a conversation may lie in several parts: rows of its earlier parts count before
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = rows.groupBy("conv", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    spans = spans.select("conv", "part", (F.col("first") - F.coalesce(F.sum("n").over(earlier), F.lit(0))).alias("zero"))
    return rows.join(spans, ["conv", "part"]).select("conv", (F.col("at") - F.col("zero") + 1).alias("pos"), "a", "b", "bytes")


def regrafted(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) rebuilt on shared beginnings.

    Conversation c takes the first h turns of conversation c - c % 5 (all if fewer, none if it
    is absent), then its own turns after its first h, where h is crc32 of c's digits, mod 9.
    ``conversations`` has conv and length (also 0).
    """
    turns = stored(turns, "trie-numbered")
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % 9
    convs = turns.groupBy("conv").agg(F.count("*").alias("m"))
    base = convs.select(F.col("conv").alias("base"), F.col("m").alias("base_m"))
    convs = convs.withColumns({"h": h, "base": F.col("conv") - F.col("conv") % 5}).join(base, "base", "left")
    lent = F.least(F.coalesce("base_m", F.lit(0)), "h")
    convs = convs.select("conv", "base", "h", lent.alias("lent"), (lent + F.greatest(F.col("m") - F.col("h"), F.lit(0))).alias("length"))
    convs = stored(convs, "trie-convs")
    kept = turns.join(convs.select("conv", "h", "lent"), "conv").filter(F.col("pos") > F.col("h"))
    kept = kept.withColumn("pos", F.col("pos") - F.col("h") + F.col("lent")).select(*turns.columns)
    heads = turns.filter(F.col("pos") <= 8).withColumnRenamed("conv", "base")  # h is 8 at most
    heads = heads.join(convs.select("conv", "base", "h"), "base").filter(F.col("pos") <= F.col("h")).select(*turns.columns)
    return kept.unionByName(heads), convs.select("conv", "length")


def _paths(turns: DataFrame) -> DataFrame:
    """conv, pos and bytes of each turn with its node's key (x, y) and its parent's (px, py)."""
    own = {"a": F.xxhash64(F.lit(1), "pos", "a", "b"), "b": F.xxhash64(F.lit(2), "pos", "a", "b")}
    t = turns.withColumns({**own, "block": F.floor((F.col("pos") - 1) / BLOCK)})
    within = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = t.groupBy("conv", "block").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    blocks = blocks.select("conv", "block", F.bit_xor("a").over(earlier).alias("ba"), F.bit_xor("b").over(earlier).alias("bb"))
    t = t.withColumns({"x": F.bit_xor("a").over(within), "y": F.bit_xor("b").over(within)})
    t = t.join(blocks.filter(F.col("block") > 0), ["conv", "block"], "left")
    zero = F.lit(0).cast("long")
    x, y = F.col("x").bitwiseXOR(F.coalesce("ba", zero)), F.col("y").bitwiseXOR(F.coalesce("bb", zero))
    return t.select(
        "conv", "pos", "bytes", x.alias("x"), y.alias("y"), x.bitwiseXOR(F.col("a")).alias("px"), y.bitwiseXOR(F.col("b")).alias("py"),
    )


def _band(i: Column) -> Column:
    """The band of a node's strict ancestors: nodes 1..BAND have those of depth 0..BAND-1."""
    return F.floor((i - 1) / BAND)


def _level_up(paths: DataFrame) -> DataFrame:
    """The path rows at band boundaries, as path rows of the next level."""
    i = F.col("pos")
    top, bottom = (i - 1) % BAND == 0, i % BAND == 0
    ends = {c: F.max(F.when(cond, F.col(c))).alias(c) for cond, cs in ((bottom, "xy"), (top, ("px", "py"))) for c in cs}
    found = paths.groupBy("conv", _band(i).alias("band")).agg(*ends.values())
    return found.filter(F.col("x").isNotNull()).select("conv", (F.col("band") + 1).alias("pos"), "x", "y", "px", "py")


def _added(values: DataFrame, paths: DataFrame, unit: int, sums: list[str], whole: DataFrame | None = None) -> DataFrame:
    """``values`` plus what nodes give to their ancestors in the band above them.

    Without ``whole``, nodes inside a band give their value; with it, its rows (band roots) do."""
    giving = values.filter(F.col("depth") % (unit * BAND) != 0) if whole is None else whole.filter(F.col("depth") > 0)
    i = F.expr(f"depth div {unit}")
    giving = giving.select(F.col("conv").alias("from_conv"), i.alias("i"), _band(i).alias("band"), *sums)
    steps = paths.select("conv", F.col("pos").alias("step"), "px", "py", _band(F.col("pos")).alias("step_band"))
    given = giving.join(
        steps, (F.col("from_conv") == F.col("conv")) & (F.col("band") == F.col("step_band")) & (F.col("step") <= F.col("i")),
    )
    given = given.select(
        F.lit(None).cast("long").alias("conv"), ((F.col("step") - 1) * unit).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"), *sums,
    )
    return values.select("conv", *KEY, *sums).unionByName(given).groupBy(*KEY).agg(
        F.max("conv").alias("conv"), *[F.sum(c).alias(c) for c in sums],
    )


def subtree_sums(values: DataFrame, paths: DataFrame, sums: list[str]) -> DataFrame:
    """Nodes (conv: smallest member, depth, x, y) with ``sums`` over their subtrees.

    ``paths``: conv, pos, x, y, px, py of every turn. Levels: as many as the depth asks for."""
    deepest = values.agg(F.max("depth")).first()[0] or 0  # one number
    parts, steps, unit = [], [paths], 1
    while True:
        part = stored(_added(values, steps[-1], unit, sums), "trie-band")
        parts.append(part)
        if unit * BAND > deepest:
            break
        unit *= BAND
        values = part.filter(F.col("depth") % unit == 0)
        steps.append(stored(_level_up(steps[-1]), "trie-level"))
    total = parts.pop()  # the top level is one band
    while parts:
        unit //= BAND
        total = stored(_added(parts.pop(), steps[len(parts)], unit, sums, whole=total), "trie-total")
    return total


class _Joined:
    """SHA-256 of strings joined by commas."""

    def __init__(self):
        self.key, self.digest, self.first = (), hashlib.sha256(), True

    def add(self, depth, x, y, block, ids) -> Iterator[tuple]:
        self.key = (depth, x, y)
        self.digest.update((ids if self.first else "," + ids).encode())
        self.first = False
        return ()

    def end(self) -> Iterator[tuple]:
        yield (*self.key, self.digest.hexdigest())


def trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """One row per node of the trie of all conversations.

    ``turns``: conv, pos, a, b, bytes (as from ``numbered``); ``convs``: conv, length (also
    conversations without turns). Returns conv_id (smallest member), depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens (over the subtree, (n_convs - 1) times the bytes
    of the last text), ends_sha256 (of the ids of conversations that end here, in numerical
    order). Without conversations there is no node.
    """
    paths = stored(_paths(turns), "trie-paths")
    zero, none = F.lit(0).cast("long"), F.lit(None).cast("long")
    root = convs.agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv")).filter(F.col("n_convs") > 0).select(
        zero.alias("depth"), zero.alias("x"), zero.alias("y"), "n_convs", "conv", zero.alias("bytes"), none.alias("px"), none.alias("py"),
    )
    nodes = paths.groupBy(F.col("pos").alias("depth"), "x", "y").agg(
        F.count("*").alias("n_convs"), F.min("conv").alias("conv"), *[F.max(c).alias(c) for c in ("bytes", "px", "py")],
    )
    nodes = stored(nodes.unionByName(root), "trie-nodes")
    links = nodes.filter(F.col("depth") > 0).select((F.col("depth") - 1).alias("depth"), F.col("px").alias("x"), F.col("py").alias("y"))
    children = links.groupBy(*KEY).agg(F.count("*").alias("n_children"))
    nodes = stored(nodes.join(children, KEY, "left").fillna(0, ["n_children"]), "trie-nodes")
    saved = (F.col("n_convs") - 1) * F.col("bytes")
    values = nodes.select(
        "conv", *KEY, F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("n_leaves"), saved.alias("saved_tokens"),
    )
    sums = subtree_sums(values, paths, ["n_leaves", "saved_tokens"]).drop("conv")

    ends = paths.join(convs, "conv").filter(F.col("pos") == F.col("length")).select("conv", F.col("pos").alias("depth"), "x", "y")
    bare = convs.filter(F.col("length") == 0).select("conv", *[zero.alias(c) for c in KEY])
    ids = F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")))
    ends = ends.unionByName(bare).groupBy(*KEY, F.shiftright("conv", 12).alias("block")).agg(ids.alias("ids"))
    schema = T.StructType([T.StructField(c, T.LongType()) for c in KEY] + [T.StructField("ends_sha256", T.StringType())])
    ended = streamed(ends, KEY, ["block"], _Joined, schema)

    parent = nodes.select("depth", F.col("x").alias("px"), F.col("y").alias("py"), F.col("conv").alias("parent_conv_id"))
    parent = parent.withColumn("depth", F.col("depth") + 1)
    return (
        nodes.join(parent, ["depth", "px", "py"], "left").join(sums, KEY).join(ended, KEY, "left")
        .select(
            F.col("conv").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
        )
    )


def oracle_sql() -> str:
    """The same nodes by exploding every node to all its ancestors; crc32 bit by bit."""
    crc = """xor(list_reduce(flatten([[ascii(ch)::BIGINT, 0, 0, 0, 0, 0, 0, 0] FOR ch IN string_split(conv::VARCHAR, '')]),
        lambda r, s: xor(xor(r, s) >> 1, CASE WHEN xor(r, s) % 2 = 1 THEN 3988292384 ELSE 0 END), 4294967295::BIGINT), 4294967295)"""
    return f"""
    WITH own AS (
        SELECT conv_id AS conv, coalesce(role, '') AS role, coalesce(text, '') AS text,
            row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
        FROM conversations WHERE conv_id IS NOT NULL
    ), convs AS (
        SELECT conv, count(*) AS m, conv - conv % 5 AS base, {crc} % 9 AS h FROM own GROUP BY conv
    ), lent AS (
        SELECT c.*, least(coalesce(b.m, 0), c.h) AS k FROM convs c LEFT JOIN convs b ON b.conv = c.base
    ), rebuilt AS (
        SELECT l.conv, o.pos - l.h + l.k AS pos, o.role, o.text FROM own o JOIN lent l USING (conv) WHERE o.pos > l.h
        UNION ALL
        SELECT l.conv, o.pos, o.role, o.text FROM own o JOIN lent l ON o.conv = l.base WHERE o.pos <= l.h
    ), path AS (
        SELECT conv, pos AS depth, octet_length(encode(text)) AS bytes,
            list([role, text]) OVER (PARTITION BY conv ORDER BY pos) AS seq
        FROM rebuilt
        UNION ALL SELECT conv, 0, 0, [] FROM convs
    ), node AS (
        SELECT depth, seq, min(conv) AS conv_id, count(*) AS n_convs, min(bytes) AS bytes FROM path GROUP BY depth, seq
    ), kid AS (
        SELECT n.depth, n.conv_id, p.conv_id AS parent_conv_id
        FROM node n JOIN path q ON q.conv = n.conv_id AND q.depth = n.depth - 1 JOIN node p ON p.depth = q.depth AND p.seq = q.seq
    ), kids AS (
        SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM kid GROUP BY ALL
    ), total AS (
        SELECT a.depth, a.seq, count(*) FILTER (k.conv_id IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.bytes) AS saved_tokens
        FROM node n LEFT JOIN kids k USING (conv_id, depth)
        JOIN path q ON q.conv = n.conv_id AND q.depth <= n.depth JOIN node a ON a.depth = q.depth AND a.seq = q.seq
        GROUP BY a.depth, a.seq
    ), ended AS (
        SELECT p.depth, p.seq, string_agg(p.conv::VARCHAR, ',' ORDER BY p.conv) AS ids
        FROM path p JOIN (SELECT conv, max(depth) AS depth FROM path GROUP BY conv) USING (conv, depth) GROUP BY p.depth, p.seq
    )
    SELECT n.conv_id, n.depth, k.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, t.n_leaves,
        t.saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
    FROM node n JOIN total t USING (depth, seq) LEFT JOIN kid k USING (conv_id, depth)
    LEFT JOIN kids c USING (conv_id, depth) LEFT JOIN ended e USING (depth, seq)
    """
