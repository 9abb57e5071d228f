"""Change data capture: keyed tables with SCD type 1 / type 2 semantics.

Pure ``DataFrame -> DataFrame`` cores; the streaming layer calls them per refresh.

Ordering contract (the same for both types):

* versions of a key are ordered by ``seq`` (the ``SEQUENCE BY`` column);
* rows with the same ``(key, seq)`` are ordered by the caller's ``tie_break`` columns, then by
  the payload itself, so the winner never depends on arrival order or replays;
* ordering is done on whole structs, so NULL payload values do overwrite (no IGNORE NULL)
  and columns of different events are never mixed.

Scale notes:

* SCD1 is one ``groupBy(keys).agg(max(struct))``: partial aggregation collapses a hot key
  on the map side, so no task ever holds a whole key.
* SCD2 needs ordered neighbours per key. Rows are ordered within (key, bin), bins being fixed
  ranges of the sequence (``bins.py``), and a key's bins are stitched from one row per (key,
  bin). All keys take this plan; nothing is looked up before it runs.
* SCD2 state is kept as segments: a run of equal payload within one bin, with the sorted
  sequence values that confirmed it. A late row lands in the segments of its own (key, bin):
  those are split and run again, all others are carried over, and only segments are stitched.
  The feed that made the state is not read again. Stored segments and new rows are dealt by
  (key, bin) once; splitting, ties, runs and neighbours all work on that one shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bins import bin_of, bin_widths, nearest

START_AT = "__START_AT"
END_AT = "__END_AT"
HIDDEN_SEQ = "__seq"
#: Columns of stored SCD2 segments: whether it opens a version, and what confirmed it.
OPENS = "__opens"
CONFIRMED = "__confirmed"
RESERVED = (START_AT, END_AT, HIDDEN_SEQ, OPENS, CONFIRMED)


def _as_list(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def payload_columns(
    df: DataFrame, keys: Sequence[str], seq: str, tie_break: Sequence[str] = (), except_: Sequence[str] = ()
) -> list[str]:
    """Tracked columns: everything but keys, sequence, tie-break and excluded columns.

    Tie-break columns are delivery metadata (file, arrival), which a redelivery changes. A
    business column that should break ties and be tracked goes in under a second name."""
    skip = set(keys) | {seq} | set(tie_break) | set(except_)
    return [c for c in df.columns if c not in skip and c not in RESERVED]


def _hidden_tb(i: int) -> str:
    return f"__tb{i}"


# ----------------------------------------------------------------------------------------
# Tie-break: one row per (key, seq)
# ----------------------------------------------------------------------------------------
def dedup_ties(
    feed: DataFrame,
    keys: str | Sequence[str],
    seq: str,
    tie_break: Sequence[str] = (),
    except_: Sequence[str] = (),
) -> DataFrame:
    """One row per ``(keys, seq)``: the greatest by ``(tie_break..., payload...)``.

    Output columns: keys, seq, tie-break columns, payload (in feed order).
    A ``max(struct)`` aggregate, so it is combined map-side before the shuffle.
    """
    keys = _as_list(keys)
    payload = payload_columns(feed, keys, seq, tie_break, except_)
    order = [F.col(t).alias(_hidden_tb(i)) for i, t in enumerate(tie_break)] + [F.col(p) for p in payload]
    won = feed.groupBy(*keys, seq).agg(F.max(F.struct(*order)).alias("__w"))
    return won.select(
        *keys,
        seq,
        *[F.col(f"__w.{_hidden_tb(i)}").alias(t) for i, t in enumerate(tie_break)],
        *[F.col(f"__w.{p}").alias(p) for p in payload],
    )


# ----------------------------------------------------------------------------------------
# SCD type 1
# ----------------------------------------------------------------------------------------
def to_scd1_state(
    feed: DataFrame, keys: Sequence[str], seq: str, tie_break: Sequence[str] = (), except_: Sequence[str] = ()
) -> DataFrame:
    """Feed rows in the stored SCD1 shape: visible columns + hidden ``__seq``/``__tbN``."""
    keys = _as_list(keys)
    payload = payload_columns(feed, keys, seq, tie_break, except_)
    visible = [c for c in feed.columns if c in set(keys) | set(payload)]
    return feed.select(
        *visible,
        F.col(seq).alias(HIDDEN_SEQ),
        *[F.col(t).alias(_hidden_tb(i)) for i, t in enumerate(tie_break)],
    )


def is_hidden(column: str) -> bool:
    """Whether a stored column is kept beside the visible ones: sequence, tie-breaks, segments."""
    return column in (HIDDEN_SEQ, OPENS, CONFIRMED) or re.fullmatch(r"__tb\d+", column) is not None


def _hidden_cols(df: DataFrame) -> list[str]:
    return [HIDDEN_SEQ] + sorted(c for c in df.columns if c.startswith("__tb") and is_hidden(c))


def scd1_reduce(state: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    """Collapse rows in the stored SCD1 shape to one per key (highest sequence wins)."""
    keys = _as_list(keys)
    hidden = _hidden_cols(state)
    payload = [c for c in state.columns if c not in keys and c not in hidden]
    won = state.groupBy(*keys).agg(F.max(F.struct(*hidden, *payload)).alias("__w"))
    return won.select(*keys, *[F.col(f"__w.{c}").alias(c) for c in payload + hidden]).select(*state.columns)


def scd1(
    feed: DataFrame,
    keys: str | Sequence[str],
    seq: str,
    tie_break: Sequence[str] = (),
    except_: Sequence[str] = (),
    keep_hidden: bool = False,
) -> DataFrame:
    """``APPLY CHANGES ... STORED AS SCD TYPE 1``: latest value per key, no history."""
    keys = _as_list(keys)
    state = scd1_reduce(to_scd1_state(feed, keys, seq, tie_break, except_), keys)
    return state if keep_hidden else visible_scd1(state)


def scd1_merge(
    state: DataFrame,
    new_rows: DataFrame,
    keys: str | Sequence[str],
    seq: str,
    tie_break: Sequence[str] = (),
    except_: Sequence[str] = (),
) -> DataFrame:
    """Merge new change rows into a stored SCD1 state (hidden columns kept).

    The greatest sequence wins, so merging the same rows again changes nothing."""
    keys = _as_list(keys)
    return scd1_reduce(state.unionByName(to_scd1_state(new_rows, keys, seq, tie_break, except_)), keys)


def visible_scd1(state: DataFrame) -> DataFrame:
    return state.select(*[c for c in state.columns if not is_hidden(c)])


# ----------------------------------------------------------------------------------------
# SCD type 2
# ----------------------------------------------------------------------------------------
def _events(
    feed: DataFrame, keys: Sequence[str], seq: str, tie_break: Sequence[str], payload: Sequence[str],
) -> DataFrame:
    """One row per (key, sequence): __key, __seq, __c (sequence and tie-breaks), __p (payload)."""
    d = dedup_ties(feed.select(*keys, seq, *tie_break, *payload), keys, seq, tie_break)
    ties = [F.col(t).alias(_hidden_tb(i)) for i, t in enumerate(tie_break)]
    return d.select(
        F.struct(*keys).alias("__key"), F.col(seq).alias("__seq"),
        F.struct(F.col(seq).alias("seq"), *ties).alias("__c"), F.struct(*payload).alias("__p"),
    )


def _binned(events: DataFrame, widths: Sequence[int]) -> DataFrame:
    """Events with __bin, and __c as a list of what confirms them."""
    return events.withColumns({"__bin": bin_of(events, "__seq", widths), "__c": F.array("__c")})


def _runs(events: DataFrame, confirmed: bool) -> DataFrame:
    """Runs of equal payload within (key, bin): __key, __bin, __seq (first), __p[, __confirmed]."""
    w = Window.partitionBy("__key", "__bin").orderBy("__seq")
    opens = ~F.lag("__p").over(w).eqNullSafe(F.col("__p"))
    marked = events.withColumn("__opens", opens)
    if not confirmed:
        return marked.filter("__opens").select("__key", "__bin", "__seq", "__p")
    # a struct, so that a null sequence is a value
    first = F.last(F.when(F.col("__opens"), F.struct("__seq")), ignorenulls=True)
    numbered = marked.withColumn("__run", first.over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("__key", "__bin", "__run").agg(
        F.first("__p").alias("__p"), F.sort_array(F.flatten(F.collect_list("__c"))).alias(CONFIRMED),
    ).select("__key", "__bin", F.col("__run.__seq").alias("__seq"), "__p", CONFIRMED)


def _numbered(segments: DataFrame) -> DataFrame:
    """Segments with __n (number in the bin) and __next (where the next one in the bin starts)."""
    w = Window.partitionBy("__key", "__bin").orderBy("__seq")
    return segments.withColumns({"__n": F.row_number().over(w), "__next": F.lead(F.struct("__seq")).over(w)})


def _stitched(s: DataFrame, widths: Sequence[int]) -> DataFrame:
    """Numbered segments with __opens (a version starts here) and __end (where the next one starts).

    Neighbours in a bin differ in payload, so only the first segment of a bin may continue a
    version of an earlier bin. That is decided from one row per (key, bin)."""
    edges = s.groupBy("__key", "__bin").agg(
        F.max(F.when(F.col("__n") == 1, F.struct("__seq", "__p"))).alias("__first"),
        F.max(F.when(F.col("__n") == 2, F.struct("__seq"))).alias("__second"),
        F.max(F.struct("__seq", "__p")).alias("__last"),
    )
    edges = nearest(edges, "__key", "__bin", F.col("__last.__p"), widths[1:], "__before")
    edges = edges.withColumn("__starts", ~F.col("__before").eqNullSafe(F.col("__first.__p")))
    opening = F.when(F.col("__starts"), F.struct(F.col("__first.__seq").alias("__seq"))).otherwise(F.col("__second"))
    edges = nearest(edges.withColumn("__open", opening), "__key", "__bin", F.col("__open"), widths[1:], "__after", after=True)
    met = s.join(edges.select("__key", "__bin", "__starts", "__after"), ["__key", "__bin"])
    return met.withColumns({
        OPENS: (F.col("__n") > 1) | F.col("__starts"), "__end": F.coalesce("__next", "__after")["__seq"],
    })


def _visible(stitched: DataFrame, keys: Sequence[str], columns: Sequence[str], *more: str) -> DataFrame:
    own = [F.col(f"__key.{c}") if c in keys else F.col(f"__p.{c}") for c in columns]
    return stitched.select(
        *[x.alias(c) for x, c in zip(own, columns)], F.col("__seq").alias(START_AT), F.col("__end").alias(END_AT), *more,
    )


def scd2(
    feed: DataFrame,
    keys: str | Sequence[str],
    seq: str,
    tie_break: Sequence[str] = (),
    except_: Sequence[str] = (),
    widths: Sequence[int] | None = None,
) -> DataFrame:
    """``APPLY CHANGES ... STORED AS SCD TYPE 2``: full history with validity ranges.

    A row opens a version when its payload differs (null-safe) from the previous row of the
    key in sequence order (a null sequence comes first); ``__START_AT`` is its sequence value and
    ``__END_AT`` the sequence value of the next version (NULL while current).

    ``widths``: widths of the sequence's bins, level by level (default by its type); the rows do
    not depend on them.
    """
    keys = _as_list(keys)
    payload = payload_columns(feed, keys, seq, tie_break, except_)
    widths = bin_widths(feed, seq, widths)
    stitched = _stitched(_numbered(_runs(_binned(_events(feed, keys, seq, tie_break, payload), widths), False)), widths)
    return _visible(stitched.filter(OPENS), keys, [c for c in feed.columns if c in {*keys, *payload}])


def current_rows(history: DataFrame) -> DataFrame:
    """Current version of each key: ``WHERE __END_AT IS NULL``."""
    return history.filter(F.col(END_AT).isNull())


def scd2_state(
    feed: DataFrame,
    keys: str | Sequence[str],
    seq: str,
    tie_break: Sequence[str] = (),
    except_: Sequence[str] = (),
    widths: Sequence[int] | None = None,
) -> DataFrame:
    """The history as stored: segments with what confirmed them (see the module's notes)."""
    keys = _as_list(keys)
    payload = payload_columns(feed, keys, seq, tie_break, except_)
    widths = bin_widths(feed, seq, widths)
    stitched = _stitched(_numbered(_runs(_binned(_events(feed, keys, seq, tie_break, payload), widths), True)), widths)
    return _visible(stitched, keys, [c for c in feed.columns if c in {*keys, *payload}], OPENS, CONFIRMED)


def visible_scd2(state: DataFrame) -> DataFrame:
    """The versions of a stored history."""
    return state.filter(OPENS).drop(OPENS, CONFIRMED)


def scd2_merge(
    state: DataFrame,
    new_rows: DataFrame,
    keys: str | Sequence[str],
    seq: str,
    tie_break: Sequence[str] = (),
    except_: Sequence[str] = (),
    widths: Sequence[int] | None = None,
    keep: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Merge new change rows, late ones too, into a stored history (same ``widths`` as made it).

    The segments of the (key, bin) that a new row falls into are split back into the sequence
    values that confirmed them, run again with the new rows, and stitched to the others. Keys
    without new rows stay as they are stored. One row per (key, sequence) stays, as in a single
    pass; merging the same rows again changes nothing.

    ``keep``: stores the merged segments (``persist``, or written and read back), which stitching
    reads twice; without it they are made twice.
    """
    keys = _as_list(keys)
    payload = payload_columns(new_rows, keys, seq, tie_break, except_)
    widths = bin_widths(new_rows, seq, widths)
    visible = [c for c in new_rows.columns if c in {*keys, *payload}]
    new = _binned(_events(new_rows, keys, seq, tie_break, payload), widths)
    met, keyed = new_rows.select(F.struct(*keys).alias("__key")).distinct(), state.withColumn("__key", F.struct(*keys))
    # a history depends on the rows of its own key alone
    as_stored = keyed.join(met, "__key", "left_anti").select(*visible, START_AT, END_AT, OPENS, CONFIRMED)
    stored = keyed.join(met, "__key", "left_semi").select(
        "__key", bin_of(state, START_AT, widths).alias("__bin"),
        F.col(CONFIRMED).alias("__c"), F.struct(*payload).alias("__p"), F.lit(False).alias("__new"),
    )
    both = stored.unionByName(new.select("__key", "__bin", "__c", "__p", F.lit(True).alias("__new")))
    # the one shuffle: a bin's rows stay together through all that follows
    both = both.repartition("__key", "__bin").withColumn("__hit", F.max("__new").over(Window.partitionBy("__key", "__bin")))
    lists = F.when(F.col("__hit"), F.transform("__c", lambda c: F.array(c))).otherwise(F.array("__c"))
    split = both.select("__key", "__bin", "__p", F.explode(lists).alias("__c"))
    # the same rule as for ties in a feed: tie-breaks, then payload
    won = split.groupBy("__key", "__bin", F.col("__c")[0]["seq"].alias("__seq")).agg(F.max(F.struct("__c", "__p")).alias("__w"))
    segments = _numbered(_runs(won.select("__key", "__bin", "__seq", "__w.__c", "__w.__p"), True))
    merged = _visible(_stitched(keep(segments) if keep else segments, widths), keys, visible, OPENS, CONFIRMED)
    return merged.unionByName(as_stored)
