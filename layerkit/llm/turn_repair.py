"""Cheapest repair of a conversation's turns, by Four-Russians block tables.

A repaired conversation's role initials read ``(s?(ua)+)?``. Its automaton has four states: at
the start, after s, after u, after a. Edits: K(eep) 0, R(erole) to user or assistant 2, D(elete) 3
(the only one for blank and duplicate rows), I(nsert) an empty user or assistant row 2; a
truncated row that stays adds 1. Equal costs: the ASCII-least string of edit letters.

For every place between rows, the costs still to come from the four states form a vector. Less
its minimum, it is one of a few dozen (states can follow one another with few edits), so a row, or
a block of ``BLOCK`` rows, is a step from one vector number to another and an amount added.
``tables()`` has these steps for every block of symbols. Costs are then found from the end of a
conversation by one lookup a block; each block is afterwards expanded backward, row by row, from
the vector at its end, and every row's letters are read forward from the state reached: a letter is
allowed if it keeps the least cost, and the ASCII-least one is taken. So ties need no second pass.

Scale: rows are sorted by range and numbered once (``streams.ordered``); at most ``CHUNK`` rows of a
conversation make a chunk. A chunk is a step on vector numbers (one for each of them), so the
chunks of a long conversation are looked up in parallel, linked by one small row each, and
expanded in parallel again, from each of the four states the chunk may start in.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored
from .streams import mapped, ordered, streamed

BLOCK = 3  # rows of a block: 9 ** 3 blocks
CHUNK_BITS = 12  # at most 4,096 rows in a chunk

# states: 0 start, 1 after s, 2 after u, 3 after a
ROLES = "sua"  # initials that may be kept; any other is "x"
KEPT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})  # state -> initial -> state
NEXT = (("u", 2), ("u", 2), ("a", 3), ("u", 2))  # the only role that an inserted or reroled row can have
END = (0, 4, 2, 0)  # inserts that complete the string: none, ua, a, none
DELETE, INSERT, REROLE, CUT_OFF = 3, 2, 2, 1
# symbols: must go; then initials s, u, a, x, whole or truncated
SYMBOLS = ("-", *(r + f for r in "suax" for f in ("", "t")))


def symbol(initial: str, fault: str) -> int:
    if fault in "bd":
        return 0
    return 1 + 2 * "suax".index(initial) + (fault == "t")


def _edits(s: int, q: int) -> list[tuple[str, int, int, str]]:
    """(letter, cost, next state, role shown) of the edits that take row symbol ``s`` in state ``q``."""
    found = [("D", DELETE, q, "-")]
    if s:
        initial, cut = SYMBOLS[s][0], CUT_OFF * (len(SYMBOLS[s]) > 1)
        if initial in KEPT[q]:
            found.append(("K", cut, KEPT[q][initial], "="))
        found.append(("R", REROLE + cut, NEXT[q][1], NEXT[q][0]))
    return found


def _before(s: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to come before a row from those after it; inserts may come first."""
    cost = [min(c + after[to] for _, c, to, _ in _edits(s, q)) for q in range(4)]
    for _ in range(3):  # a chain of inserts visits each state once at most
        cost = [min(cost[q], INSERT + cost[NEXT[q][1]]) for q in range(4)]
    return tuple(cost)


class Tables:
    """Normalised vectors, their steps by row and by block, and the letters of each step."""

    def __init__(self, block: int = BLOCK):
        self.block = block
        self.vectors: list[tuple[int, ...]] = [END]
        number, steps, i = {END: 0}, [], 0
        while i < len(self.vectors):
            row = []
            for s in range(len(SYMBOLS)):
                v = _before(s, self.vectors[i])
                least = min(v)
                v = tuple(c - least for c in v)
                if v not in number:
                    number[v] = len(self.vectors)
                    self.vectors.append(v)
                row.append((number[v], least))
            steps.append(row)
            i += 1
        one = np.array(steps)
        self.row_to, self.row_add = one[:, :, 0], one[:, :, 1]
        n = len(SYMBOLS)
        ids = np.arange(len(self.vectors))
        to, add = np.empty((len(ids), n ** block), np.int64), np.zeros((len(ids), n ** block), np.int64)
        for code, symbols in enumerate(itertools.product(range(n), repeat=block)):
            v = ids
            for s in reversed(symbols):  # costs to come run from the end
                add[:, code] += self.row_add[v, s]
                v = self.row_to[v, s]
            to[:, code] = v
        self.block_to, self.block_add = to, add
        self.letters = {
            (v, s, q): self._letters(v, s, q) for v in range(len(ids)) for s in range(n) for q in range(4)
        }

    def _letters(self, v: int, s: int, q: int) -> tuple[str, str, int, int]:
        """(letters, roles, state after, cost) of a row in state ``q`` before vector ``v``: inserts, then its edit."""
        after, before = self.vectors[v], _before(s, self.vectors[v])
        letters, roles, spent = "", "", 0
        while True:
            fits = [("I", INSERT, NEXT[q][1], NEXT[q][0])] if before[q] == INSERT + before[NEXT[q][1]] else []
            fits += [e for e in _edits(s, q) if before[q] == e[1] + after[e[2]]]
            letter, cost, q, role = min(fits)
            letters, roles, spent = letters + letter, roles + role, spent + cost
            if letter != "I":
                return letters, roles, q, spent

    def blocks(self, symbols: list[int]) -> tuple[list[int], list[int]]:
        """(numbers of the whole blocks, symbols left over at the end)."""
        n, b = len(SYMBOLS), self.block
        whole = len(symbols) // b * b
        codes = []
        for a in range(0, whole, b):
            code = 0
            for s in symbols[a:a + b]:
                code = code * n + s
            codes.append(code)
        return codes, symbols[whole:]

    def chunk_step(self, symbols: list[int]) -> list[int]:
        """For every vector after the symbols, the number of the one before them."""
        codes, rest = self.blocks(symbols)
        v = np.arange(len(self.vectors))
        for s in reversed(rest):
            v = self.row_to[v, s]
        for code in reversed(codes):
            v = self.block_to[v, code]
        return v.tolist()

    def trace(self, symbols: list[int], after: int, state: int) -> tuple[list[str], list[str], int, int]:
        """(letters, roles shown, state after, cost) row by row from the vector after the symbols."""
        codes, rest = self.blocks(symbols)
        v = after
        for s in reversed(rest):
            v = int(self.row_to[v, s])
        ends = []  # the vector after each block, by lookup
        for code in reversed(codes):
            ends.append(v)
            v = int(self.block_to[v, code])
        ends.reverse()
        letters, roles, cost = [], [], 0
        for k in range(len(codes) + 1):
            own, v = (symbols[k * self.block:(k + 1) * self.block], ends[k]) if k < len(codes) else (rest, after)
            inner = [v] * len(own)  # the block expanded backward: the vector after each of its rows
            for j in range(len(own) - 1, 0, -1):
                inner[j - 1] = int(self.row_to[inner[j], own[j]])
            for s, v in zip(own, inner):
                found, shown, state, spent = self.letters[v, s, state]
                letters.append(found)
                roles.append(shown)
                cost += spent
        return letters, roles, state, cost


@functools.cache
def tables() -> Tables:
    return Tables()


def closing(state: int) -> tuple[str, str, int]:
    """(letters, roles, cost) of the inserts after the last row."""
    roles = {1: "ua", 2: "a"}.get(state, "")
    return "I" * len(roles), roles, INSERT * len(roles)


# ----------------------------------------------------------------------------------------
# chunks of conversations
# ----------------------------------------------------------------------------------------
def _strings(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType()) for n in names]


def _longs(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.LongType()) for n in names]


_HEAD = [*_strings("k"), *_longs("chunk", "first_at"), *_strings("initials", "faults")]
_NUMBERS = T.ArrayType(T.LongType())


def _symbols(initials: str, faults: str) -> list[int]:
    return [symbol(i, f) for i, f in zip(initials, faults)]


def _step(k, chunk, first_at, initials, faults) -> Iterator[tuple]:
    yield k, chunk, first_at, initials, faults, tables().chunk_step(_symbols(initials, faults))


class _FromTheEnd:
    """The vector after each chunk, chunks of a conversation from the last to the first."""

    def __init__(self):
        self.v, self.last = 0, True  # vector 0 is END

    def add(self, k, chunk, first_at, initials, faults, step) -> Iterator[tuple]:
        yield k, chunk, first_at, initials, faults, self.v, self.last
        self.v, self.last = step[self.v], False

    def end(self) -> Iterator[tuple]:
        return ()


def _traces(k, chunk, first_at, initials, faults, after, last) -> Iterator[tuple]:
    """A chunk's edits for each state it may start in."""
    symbols = _symbols(initials, faults)
    found = [tables().trace(symbols, after, state) for state in range(4)]
    if last:
        for i, (letters, roles, state, cost) in enumerate(found):
            more, shown, extra = closing(state)
            found[i] = letters + [more], roles + [shown], state, cost + extra
    letters, roles, states, costs = (list(x) for x in zip(*found))
    yield k, chunk, first_at, initials, letters, roles, states, costs


class _FromTheStart:
    """The edits of each chunk from the state it does start in; neighbours out of turn counted."""

    def __init__(self):
        self.state, self.before = 0, ""

    def add(self, k, chunk, first_at, initials, letters, roles, states, costs) -> Iterator[tuple]:
        q, row = self.state, self.before + initials
        illegal = sum(row[i:i + 2] not in ("su", "ua", "au") for i in range(len(row) - 1))
        yield k, chunk, first_at, letters[q], roles[q], costs[q], illegal
        self.state, self.before = states[q], initials[-1:]

    def end(self) -> Iterator[tuple]:
        return ()


def _key(id_col: str) -> Column:
    """The id as text that is never null: a null id is a conversation of its own."""
    return F.when(F.col(id_col).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(id_col).cast("string")))


def repair(
    turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
) -> tuple[DataFrame, DataFrame]:
    """(repaired rows, one row per conversation).

    Rows go by turn (nulls first), equal turns by role and text; repeated rows are rows of their
    own; null roles and texts are one space; rows with a null id are one conversation; other
    columns are left out. Repaired rows: id_col, at and nth (their order), edit (K, R or I), role,
    text. Conversations: id_col, gaps, blank, duplicate, truncated, illegal, cost, audit (letters).
    A row's first fault counts: blank, duplicate (role and text met earlier), truncated (its last
    character other than white space is not ``.``, ``!`` or ``?``). No rows, no rows.
    """
    role, text = F.coalesce(F.col(role_col), F.lit(" ")), F.coalesce(F.col(text_col), F.lit(" "))
    own = turns.select(
        F.col(id_col).alias("id"), _key(id_col).alias("k"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"),
    )
    rows = ordered(own, ["k", "turn", "role", "text"], "repair-rows")

    bare = F.rtrim(F.translate("text", "\t\n\u000b\f\r", "     "))
    initial = F.substring("role", 1, 1)
    narrow = rows.select(
        "id", "k", "turn", "at", F.when(initial.isin(*ROLES), initial).otherwise("x").alias("initial"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256).alias("print"),
        (bare == "").alias("empty"), F.substring(bare, -1, 1).isin(".", "!", "?").alias("ended"),
    )
    # the first of equal rows, joined by its number: no key is hot
    first = narrow.groupBy("k", "print").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = (
        F.when(F.col("empty"), "b").when(F.col("first").isNull(), "d").when(~F.col("ended"), "t").otherwise("-")
    )
    marked = narrow.join(first, "at", "left").withColumn("fault", fault)

    chunk = F.shiftright("at", CHUNK_BITS).alias("chunk")
    inside = F.sort_array(F.collect_list(F.struct("at", "initial", "fault")))  # at most 2^CHUNK_BITS rows
    chunks = marked.groupBy("k", chunk).agg(F.min("at").alias("first_at"), inside.alias("r")).select(
        "k", "chunk", "first_at", F.concat_ws("", F.col("r.initial")).alias("initials"), F.concat_ws("", F.col("r.fault")).alias("faults"),
    )
    stepped = mapped(chunks, _step, T.StructType([*_HEAD, T.StructField("step", _NUMBERS)]))
    known = streamed(
        stepped, ["k"], [F.desc("chunk")], _FromTheEnd,
        T.StructType([*_HEAD, *_longs("after"), T.StructField("last", T.BooleanType())]),
    )
    lists = T.ArrayType(T.ArrayType(T.StringType()))
    traced = mapped(known.repartition("k", "chunk"), _traces, T.StructType([
        *_HEAD[:4], T.StructField("letters", lists), T.StructField("roles", lists),
        T.StructField("states", _NUMBERS), T.StructField("costs", _NUMBERS),
    ]))
    words = T.ArrayType(T.StringType())
    chosen = streamed(traced, ["k"], ["chunk"], _FromTheStart, T.StructType([
        *_HEAD[:3], T.StructField("letters", words), T.StructField("roles", words), *_longs("cost", "illegal"),
    ]))
    chosen = stored(chosen, "repair-edits")

    counts = _counts(marked)
    audits = chosen.groupBy("k").agg(
        F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"),
        F.sort_array(F.collect_list(F.struct("chunk", F.concat_ws("", "letters").alias("letters")))).alias("r"),
    ).select("k", "cost", "illegal", F.concat_ws("", F.col("r.letters")).alias("audit"))
    summary = counts.join(audits, "k").drop("k").withColumnRenamed("id", id_col)
    repaired = _repaired(rows, chosen)
    own_id = F.when(F.col("k") != "", F.substring("k", 2, 2**31 - 1)).cast(turns.schema[id_col].dataType)
    return repaired.withColumn(id_col, own_id), summary


def _counts(marked: DataFrame) -> DataFrame:
    """Faults and gaps of each conversation; turns are made distinct by (k, turn) first."""
    kinds = {"blank": "b", "duplicate": "d", "truncated": "t"}
    by_turn = marked.groupBy("k", "turn").agg(
        F.min("id").alias("id"), *[F.count(F.when(F.col("fault") == f, 1)).alias(c) for c, f in kinds.items()],
    )
    wide = F.col("turn").cast("decimal(20,0)")
    gaps = (F.max(wide) - F.min(wide) + 1 - F.count("turn")).try_cast("long")
    return by_turn.groupBy("k").agg(
        F.min("id").alias("id"), F.coalesce(gaps, F.lit(0)).alias("gaps"), *[F.sum(c).alias(c) for c in kinds],
    )


def _repaired(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """Rows with their edits applied; each row's edits meet it by its number."""
    each = chosen.select("k", "first_at", F.posexplode(F.arrays_zip("letters", "roles")).alias("i", "e"))
    each = each.select((F.col("first_at") + F.col("i")).alias("own_at"), "k", F.col("e.letters").alias("letters"), F.col("e.roles").alias("roles"))
    # the inserts after a conversation's last row stand one number past it: that of no row of its own
    met = each.join(
        rows.select(F.col("at").alias("row_at"), F.col("k").alias("row_k"), "role", "text"),
        (F.col("own_at") == F.col("row_at")) & (F.col("k") == F.col("row_k")), "left",
    )
    full = {"u": "user", "a": "assistant"}
    shown = F.col("shown")
    new_role = F.when(shown == "=", F.col("role"))
    for initial, name in full.items():
        new_role = new_role.when(shown == initial, F.lit(name))
    out = met.select(
        "k", F.col("own_at").alias("at"), "role", "text", F.posexplode(F.split("letters", "")).alias("nth", "edit"), "roles",
    ).withColumn("shown", F.substring(F.col("roles"), F.col("nth") + 1, F.lit(1))).filter((F.col("edit") != "D") & (F.col("edit") != ""))
    new_text = F.when(F.col("edit") == "I", F.lit("")).otherwise(F.col("text"))
    return out.select("k", "at", "nth", "edit", new_role.alias("role"), new_text.alias("text"))


class _Digest:
    """SHA-256 of ``role:text`` lines."""

    def __init__(self):
        self.k, self.digest, self.first = "", hashlib.sha256(), True

    def add(self, k, at, nth, role, text) -> Iterator[tuple]:
        self.k = k
        self.digest.update(f"{'' if self.first else chr(10)}{role}:{text}".encode())
        self.first = False
        return ()

    def end(self) -> Iterator[tuple]:
        yield self.k, self.digest.hexdigest()


def digests(repaired: DataFrame) -> DataFrame:
    """k, repaired_sha256 of each conversation's repaired rows, streamed in order."""
    return streamed(repaired.select("k", "at", "nth", "role", "text"), ["k"], ["at", "nth"], _Digest, T.StructType(_strings("k", "repaired_sha256")))


# ----------------------------------------------------------------------------------------
# damage (the query's input)
# ----------------------------------------------------------------------------------------
def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with known faults: by crc32(conv_id:turn) % 20, 0 drops a row, 1 empties its text, 2
    removes its ``.!?``, 3 repeats it, 4 makes it a user's; a null is one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, text = F.crc32(key.cast("binary")) % 20, F.coalesce("text", space)
    rows = conversations.select("conv_id", "turn", "role", text.alias("text"), kind.alias("kind")).filter(F.col("kind") != 0)
    new_text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    new_role = F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", space))
    times = F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1)))
    return rows.select("conv_id", "turn", new_role.alias("role"), new_text.alias("text"), times.alias("n")).drop("n")


def repaired_summary(conversations: DataFrame) -> DataFrame:
    """Every conversation of the table after damage and repair, with the digest of its rows."""
    rows, summary = repair(damaged(conversations))
    summary = summary.withColumn("k", _key("conv_id")).drop("conv_id").join(digests(rows), "k", "left")
    every = conversations.select("conv_id").distinct().withColumn("k", _key("conv_id"))
    zeros = {c: 0 for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    found = every.join(summary, "k", "left").drop("k").fillna(zeros | {"audit": ""})
    return found.withColumn("repaired_sha256", F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)))
