import functools
import hashlib
import random
import re
import zlib

import pytest

from layerkit.llm import turn_repair as R

NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def fits(state, initial):
    return initial == NEXT[state] or (state == "" and initial == "s")


def least(rows):
    """(cost, audit, repaired rows) by trying every edit; rows: (role, text, fault)."""

    @functools.cache
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            role = NEXT[state]
            c, a, r = best(i, role, inserted + 1)
            found.append((c + 2, "I" + a, (("user" if role == "u" else "assistant") + ":",) + r))
        if i < len(rows):
            role, text, fault = rows[i]
            c, a, r = best(i + 1, state, 0)
            found.append((c + 3, "D" + a, r))
            if fault not in ("b", "d"):
                cut = fault == "t"
                if fits(state, role[:1]):
                    c, a, r = best(i + 1, role[:1], 0)
                    found.append((c + cut, "K" + a, (f"{role}:{text}",) + r))
                c, a, r = best(i + 1, NEXT[state], 0)
                found.append((c + cut + 2, "R" + a, (("user:" if NEXT[state] == "u" else "assistant:") + text,) + r))
        return min(found, key=lambda f: f[:2]) if found else (10**9, "", ())

    return best(0, "", 0)


def brute(rows, damage=True):
    out = {}
    for key in {r[0] for r in rows}:
        own = []
        for _, turn, role, text in (r for r in rows if r[0] == key):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if key is None else key}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            row = (turn is not None, turn or 0, "user" if kind == 4 else role, text)
            own += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
        own.sort()
        seen, faults = set(), ""
        for row in own:
            bare = re.sub(r"[\x20\x09-\x0D]", "", row[3])
            faults += "b" if not bare else "d" if row[2:] in seen else "t" if bare[-1] not in ".!?" else "-"
            seen.add(row[2:])
        turns = [r[1] for r in own if r[0]]
        roles = "".join(r[2][:1] or "?" for r in own)
        cost, audit, repaired = least(tuple((r[2], r[3], f) for r, f in zip(own, faults)))
        out[key] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            sum(roles[i:i + 2] not in ("su", "ua", "au") for i in range(len(roles) - 1)), cost, audit,
            hashlib.sha256("\n".join(repaired).encode()).hexdigest(),
        )
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def check(spark, rows, clashing=False):
    fields = "conv_id long, turn long, role string, text string"
    given = rows
    if clashing:
        fields += ", k string, at string, id string, chunk string, part string"
        given = [(*r, *"vwxyz") for r in rows]
    got = R.repaired_summary(spark.createDataFrame(given, fields)).collect()
    assert {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got} == brute(rows)
    assert len(got) == len({r[0] for r in rows})


def dealt(n, seed):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.randrange(1, 8)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No", "Why?", "a. b ", " \t", None, "Yes.", "ünd.\n", "ok!"])
            rows.append((c, rng.choice([t, t, t, None, 2 * t]), role, text))
    return rows


def test_random_conversations_equal_brute_force(spark):
    odd = [(None, None, None, None), (None, 3, "user", "Hi."), (900, 0, "assistant", "x" * 200_000 + "."), (901, 0, "system", "Be.")]
    check(spark, dealt(300, 1) + odd, clashing=True)


@pytest.mark.parametrize("bits", [1, 2])
def test_chunks_of_a_long_conversation_change_nothing(spark, monkeypatch, bits):
    monkeypatch.setattr(R, "CHUNK_BITS", bits)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rng = random.Random(bits)
        long = [(1000, t, rng.choice(["user", "assistant", "system", "tool"]), rng.choice([f"t{t}.", f"t{t}", "same.", ""])) for t in range(90)]
        check(spark, dealt(40, 2) + long)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_everything_dropped_or_no_row(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    check(spark, [(dropped, 0, "user", "Hi.")])
    assert R.repaired_summary(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_repaired_rows_are_rows(spark):
    df = spark.createDataFrame([(7, 0, "user", "One."), (7, 1, "user", "Two."), (None, 0, "assistant", "Three.")], "conv_id long, turn long, role string, text string")
    rows, _ = R.repair(df)
    got = [(r.conv_id, r.edit, r.role, r.text) for r in rows.orderBy("k", "at", "nth").collect()]
    assert got == [(None, "I", "user", ""), (None, "K", "assistant", "Three."), (7, "K", "user", "One."), (7, "R", "assistant", "Two.")]


def test_blocks_equal_single_rows():
    t, rng = R.tables(), random.Random(3)
    for _ in range(300):
        symbols = [rng.randrange(len(R.SYMBOLS)) for _ in range(rng.randrange(0, 12))]
        vector = R.END
        for s in reversed(symbols):
            vector = R._before(s, vector)
        letters, roles, state, cost = t.trace(symbols, 0, 0)
        assert t.vectors[t.chunk_step(symbols)[0]] == tuple(c - min(vector) for c in vector)
        assert cost + R.closing(state)[2] == vector[0]
