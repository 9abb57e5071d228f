import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from layerkit.llm import prefix_trie as P


def rebuilt(rows):
    own = {}
    for r in rows:
        if r[0] is not None:
            own.setdefault(r[0], []).append((r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + ts[h:]
    return out


def brute(rows):
    convs, members = rebuilt(rows), {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    kids = {n: [m for m in members if len(m) == len(n) + 1 and m[:-1] == n] for n in members}
    out = []
    for n, cs in members.items():
        under = [m for m in members if m[:len(n)] == n]
        ends = ",".join(str(c) for c in sorted(cs) if len(convs[c]) == len(n))
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in under if m)
        out.append((min(cs), len(n), min(members[n[:-1]]) if n else None, len(cs), len(kids[n]), sum(not kids[m] for m in under), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, clashing=False):
    fields = "conv_id long, turn long, role string, text string"
    if clashing:
        fields += ", pos string, x string, a string, conv string, depth string, part string, at string"
        rows = [(*r, *"pqrstuv") for r in rows]
    df = spark.createDataFrame(rows, fields)
    got = P.trie(*P.regrafted(P.numbered(df))).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)
    return got


SHARED = [("system", "be kind"), ("user", "héllo"), ("assistant", "日本"), ("user", "")]


def small():
    rows = [(c, t, *SHARED[t]) for c in range(30) for t in range(c % 5)]
    rows += [(c, t, "user", f"own {c % 3} {t}") for c in range(0, 30, 2) for t in range(4, 12)]
    rows += [(None, 0, "user", "no id"), (40, None, None, None), (40, None, None, None), (40, 1, "user", "a"), (40, 1, "assistant", "a"), (41, 0, "user", "w " * 50_000)]
    return rows


def test_nodes_equal_brute_force(spark):
    check(spark, small(), clashing=True)


def test_low_bands_and_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(P, "BAND", 2)
    monkeypatch.setattr(P, "BLOCK", 3)
    deep = [(c, t, "user", f"turn {t if t < 60 + c else (t, c)}") for c in (50, 55, 60, 61) for t in range(90)]
    got = check(spark, small() + deep)
    assert max(r.depth for r in got) >= 85


def test_one_conversation_over_many_parts(spark):
    """Ordered parts of one conversation are numbered on; nothing depends on where they are cut."""
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = [(5, t, "user", f"t{t}") for t in range(300)] + [(c, 0, "user", "same") for c in range(100, 400)]
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
        found = P.numbered(df)
        assert sorted(r.pos for r in found.filter("conv = 5").collect()) == list(range(1, 301))
        assert found.filter("conv = 5").select(F.count_distinct("a")).first()[0] == 300
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


@pytest.mark.parametrize("rows", [[], [(None, 0, "user", "x")]])
def test_no_conversation_no_node(spark, rows):
    assert check(spark, rows) == []
