"""Content-defined line chunks, and removal of those that repeat across documents.

A text is a row of units: its lines, long lines cut behind the ends of their sentences. A
rolling hash over the hashes of two units in a row gives every place between units a value;
a chunk is cut wherever that value is no strict maximum between its neighbours. Its two
units and the neighbours alone decide, so a passage gets the same chunks wherever it stands:
text put in before it shifts its chunks but does not change them. Of three units in a row
that two documents share, one chunk at least is cut in both. A chunk that occurs more than
once in the corpus also takes the unit before and the unit after it, where no repeated chunk
holds them: as a chunk of three, compared like any other. So a repeated run of three or more
units goes from its first unit to its last. All repeated chunks but their first occurrence in
the order of (document id, content hash, place) are removed.

Stages: chunk hashes and places are written down once and counted (combined on the map side);
the places of repeated ones go to their documents, which are written down too; there the chunks' bytes are compared: per hash, the
least and the greatest bytes must be the same (combined on the map side too), so a hash
collision removes nothing. Texts are shuffled twice, once for the bytes and once for the
removal; all other rows are hashes and places. No group is gathered: a chunk found in a third
of all documents is one row after partial aggregation, and what is joined with many places is
a written table of one row a hash, so both sides of the join come from plain shuffles and
adaptive execution can split a hot one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, once, stored, words_of

BASE = 1_000_003
MODULUS = 2_147_483_647
LONG_LINE = 160  # characters; longer lines are cut into sentences
SPACES = " \t\u000b\f\r"


def _units(text: Column) -> Column:
    """Units of a text, each behind an ``L`` (it begins a line) or a ``U`` (it goes on in one).

    The marks keep every unit from being empty; see ``_together`` for the way back."""
    def cut(line: Column) -> Column:
        parts = line
        for end in ".!?":
            parts = F.replace(parts, F.lit(f"{end} "), F.lit(f"{end} \nU"))
        return F.when(F.length(line) > LONG_LINE, parts).otherwise(line)

    lines = F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), cut)
    return F.split(F.concat(F.lit("L"), F.array_join(lines, "\nL")), "\n")


def _together(units: Column) -> Column:
    """The text of units; an ``X`` stands for a removed unit that began a line."""
    joined = F.concat(F.lit("\n"), F.array_join(units, "\n"))
    for mark, meant in (("\nX\nU", "\nL"), ("\nX", ""), ("\nU", ""), ("\nL", "\n")):
        joined = F.replace(joined, F.lit(mark), F.lit(meant))
    return F.substring(joined, 2, 2**31 - 1)


def _worded(units: Column) -> Column:
    """Units with a word: number ``i`` among all, and ``c``, their text without white space at its ends."""
    def bare(x: Column) -> Column:  # trimming a set of characters is slow; few units need it
        odd = F.lit(False)
        for space in SPACES[1:]:
            odd = odd | x.startswith(space) | x.endswith(space)
        return F.when(odd, F.trim(x, F.lit(SPACES))).otherwise(x)

    trimmed = F.transform(units, lambda u: F.trim(F.substring(u, 2, 2**31 - 1)))
    numbered = F.transform(trimmed, lambda x, i: F.struct(i.alias("i"), bare(x).alias("c")))
    return F.filter(numbered, lambda x: x["c"] != "")


def _cut_chunks(docs: DataFrame) -> DataFrame:
    """(k, n, h) of every chunk of ``docs`` (k, t): worded units n and n + 1."""
    d = once(docs, "w", _worded(_units(F.col("t"))))  # the filter would compute it again
    d = d.filter(F.size("w") > 1).select("k", F.transform("w", lambda x: F.md5(x["c"])).alias("m"))
    # 32 bits of md5, so that plain SQL can state the same chunks
    d = d.withColumn("a", F.transform("m", lambda m: F.conv(F.substring(m, 1, 8), 16, 10).cast("long")))
    n = F.size("a") - 1
    d = d.withColumn("r", F.zip_with(F.slice("a", 1, n), F.slice("a", 2, n), lambda x, y: (x * BASE + y) % MODULUS))
    around = F.lit(MODULUS).cast("long")
    low = F.transform("r", lambda r, i: F.when(
        (r <= F.coalesce(F.get("r", i + 1), around)) | (r < F.coalesce(F.get("r", i - 1), around)),
        F.struct(i.alias("n"), F.xxhash64(F.get("m", i), F.get("m", i + 1)).alias("h"))))
    return d.select("k", F.explode(F.filter(low, lambda x: x.isNotNull())).alias("x")).select("k", "x.*")


def _pieces(docs: DataFrame) -> DataFrame:
    """Repeated chunks with their text, and the chunks of three at the ends of repeated runs.

    ``docs`` has id, k, t and ``cand``, the sorted places of its repeated chunks."""
    d = docs.select("id", "k", "cand", _worded(_units(F.col("t"))).alias("w"))

    def piece(n: Column, size: int) -> Column:
        own = F.slice("w", n + 1, F.lit(size))
        return F.struct(
            n.alias("n"), F.get("w", n)["i"].alias("first"), F.get("w", n + F.lit(size - 1))["i"].alias("last"),
            F.array_join(F.transform(own, lambda x: x["c"]), "\n").alias("c"))

    found = F.transform("cand", lambda n, i: F.array(
        piece(n, 2),
        F.when((n > 0) & (F.coalesce(F.get("cand", i - 1), F.lit(-9)) < n - 2), piece(n - 1, 3)),
        F.when((n + 2 < F.size("w")) & (F.coalesce(F.get("cand", i + 1), F.lit(2**31 - 1)) > n + 2), piece(n, 3)),
    ))
    d = d.select("id", "k", F.explode(F.filter(F.flatten(found), lambda x: x.isNotNull())).alias("p"))
    # k stands for a document; places that another one with the same k has may lie outside this text
    return d.select("id", "k", "p.*").filter("last is not null").withColumn("h", F.xxhash64("c"))


def remove_repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``text_col`` stripped of repeated chunks, plus a struct column ``dedup``.

    ``dedup`` has removed_lines (units, that is lines or sentences of long lines) and
    removed_words (its name gets an underscore where it is taken). Blank units between two
    worded ones of a removed chunk go with them. Every unit taken away stays at an earlier place. Rows with equal id and equal
    text are one document: they lose the same chunks, and chunks repeated only among them stay. A
    repetition within one document goes as well. Ids may be null (ordered first). A null text
    stays null; an empty one is a single line without a word. A single unit is never a chunk.
    All rows are kept, also where no text is left, and an empty table gives an empty one. Other
    columns pass through, whatever their names.
    """
    others = [c for c in docs.columns if c != text_col]
    base = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in others]).alias("row"), F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").alias("t"),
    ).withColumn("k", F.xxhash64("id", "t"))
    texts = base.select("id", "k", "t")

    cut = stored(_cut_chunks(texts), "chunks")
    repeated = stored(cut.groupBy("h").count().filter("count > 1").select("h"), "repeated-chunks")
    places = cut.join(repeated, "h").groupBy("k").agg(F.array_sort(F.collect_set("n")).alias("cand"))
    pieces = _pieces(stored(texts.join(places, "k"), "texts-with-repeated-chunks"))
    place = F.struct("id", "k", "n")
    first = pieces.groupBy("h").agg(
        F.min(place).alias("origin"), F.max(place).alias("end"), F.min("c").alias("least"), F.max("c").alias("greatest"))
    first = stored(first.filter("least = greatest and origin != end").select("h", "origin"), "first-chunks")
    removed = (
        pieces.select("h", "id", "k", "n", "first", "last").join(first, "h").filter(place != F.col("origin"))
        .groupBy("id", "k").agg(F.collect_set(F.struct("first", "last")).alias("gone"))
    )
    d = base.alias("d").join(
        removed.alias("r"), F.expr("d.k = r.k and d.id <=> r.id"), "left",
    ).select("d.row", "d.t", "r.gone")

    # unit numbers, in sets that are merged by hash: kept ones, and removed ones that began a line
    d = d.withColumn("u", F.when(F.col("gone").isNotNull(), _units(F.col("t"))))
    d = d.withColumn("gone", F.array_distinct(F.flatten(F.transform("gone", lambda g: F.sequence(g["first"], g["last"])))))
    numbers = F.sequence(F.lit(0), F.size("u") - 1)
    heads = F.filter("gone", lambda i: F.get("u", i).startswith("L"))
    d = d.withColumn("order", F.array_sort(F.concat(
        F.transform(F.array_except(numbers, F.col("gone")), lambda i: i * 2), F.transform(heads, lambda i: i * 2 + 1))))
    left = F.transform("order", lambda j: F.when(j % 2 == 1, F.lit("X")).otherwise(F.get("u", F.floor(j / 2).cast("int"))))
    lost = F.aggregate("gone", F.lit(0).cast("long"), lambda total, i: total + F.size(words_of(F.substring(F.get("u", i), 2, 2**31 - 1))))
    info = F.struct(
        F.when(F.col("u").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("removed_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("removed_words"))
    text = F.when(F.col("u").isNull(), F.col("t")).otherwise(_together(left))
    d = d.select("row", text.alias("left"), info.alias("info"))  # names of ``docs`` come back only now
    columns = [F.col("left").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns]
    return d.select(*columns, F.col("info").alias(free_name(docs, "dedup")))


def oracle_sql(documents: str = "documents") -> str:
    """The same in DuckDB SQL: id, text left and the counts of each document (distinct ids)."""
    parts = "line"
    for end in ".!?":
        parts = f"replace({parts}, '{end} ', '{end} ' || chr(10) || 'U')"
    together = "chr(10) || string_agg(u, chr(10) ORDER BY i)"
    for mark, meant in (("X' || chr(10) || 'U", "chr(10) || 'L'"), ("X", "''"), ("U", "''"), ("L", "chr(10)")):
        together = f"replace({together}, chr(10) || '{mark}', {meant})"
    return f"""
    WITH lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no
      FROM {documents}
    ), cut AS (
      SELECT doc_id, line_no, 'L' || CASE WHEN length(line) > {LONG_LINE} THEN {parts} ELSE line END AS line FROM lines
    ), split AS (
      SELECT doc_id, line_no, unnest(string_split(line, chr(10))) AS u,
             generate_subscripts(string_split(line, chr(10)), 1) AS part
      FROM cut
    ), units AS (
      SELECT doc_id, u, row_number() OVER (PARTITION BY doc_id ORDER BY line_no, part) AS i,
             trim(substr(u, 2), ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS c
      FROM split
    ), worded AS (
      SELECT doc_id, i, c, ('0x' || substr(md5(c), 1, 8))::BIGINT AS a,
             row_number() OVER (PARTITION BY doc_id ORDER BY i) AS n
      FROM units WHERE c <> ''
    ), places AS (
      SELECT doc_id, n, i, lag(i) OVER w AS i0, lead(i) OVER w AS i2, lead(i, 2) OVER w AS i3,
             c, lag(c) OVER w AS c0, lead(c) OVER w AS c2, lead(c, 2) OVER w AS c3,
             (a * {BASE} + lead(a) OVER w) % {MODULUS} AS r
      FROM worded WINDOW w AS (PARTITION BY doc_id ORDER BY n)
    ), lows AS (
      SELECT *, r <= coalesce(lead(r) OVER w, {MODULUS}) OR r < coalesce(lag(r) OVER w, {MODULUS}) AS low
      FROM places WHERE r IS NOT NULL WINDOW w AS (PARTITION BY doc_id ORDER BY n)
    ), chunks AS (
      SELECT * FROM lows WHERE low QUALIFY count(*) OVER (PARTITION BY c, c2) > 1
    ), runs AS (
      SELECT *, lag(n) OVER w AS n0, lead(n) OVER w AS n2 FROM chunks WINDOW w AS (PARTITION BY doc_id ORDER BY n)
    ), pieces AS (
      SELECT doc_id, n, i AS first, i2 AS last, c || chr(10) || c2 AS chunk FROM runs
      UNION ALL
      SELECT doc_id, n - 1, i0, i2, c0 || chr(10) || c || chr(10) || c2
      FROM runs WHERE c0 IS NOT NULL AND coalesce(n0, -9) < n - 2
      UNION ALL
      SELECT doc_id, n, i, i3, c || chr(10) || c2 || chr(10) || c3
      FROM runs WHERE c3 IS NOT NULL AND coalesce(n2, n + 9) > n + 2
    ), judged AS (
      SELECT *, rank() OVER (PARTITION BY chunk ORDER BY doc_id, n) > 1 AS later FROM pieces
    ), gone AS (
      SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM judged WHERE later
    ), marked AS (
      SELECT doc_id, units.i, CASE WHEN gone.i IS NULL THEN u WHEN u[1] = 'L' THEN 'X' END AS u,
             gone.i IS NOT NULL AS lost, len(regexp_extract_all(c, '[^\\x20\\x09-\\x0D]+')) AS n_words
      FROM units LEFT JOIN gone USING (doc_id, i)
    )
    SELECT doc_id, CASE WHEN any_value(text) IS NOT NULL THEN substr(any_value(left_over), 2) END AS text,
           any_value(removed_lines) AS removed_lines, any_value(removed_words) AS removed_words
    FROM {documents} JOIN (
      SELECT doc_id, {together} AS left_over, (count(*) FILTER (WHERE lost))::BIGINT AS removed_lines,
             coalesce(sum(n_words) FILTER (WHERE lost), 0)::BIGINT AS removed_words
      FROM marked GROUP BY doc_id) USING (doc_id)
    GROUP BY doc_id"""
