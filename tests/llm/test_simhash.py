import random

import numpy as np
import xxhash
from pyspark.sql import functions as F

from layerkit.llm import simhash as S
from layerkit.llm.components import components


def brute_print(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lower) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_pairs(prints, distance):
    p = sorted(prints)
    return [(a, b) for i, a in enumerate(p) for b in p[i + 1:] if bin((a ^ b) & (2**64 - 1)).count("1") <= distance]


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def test_fingerprints(odd):
    for _, text, *_ in [*odd[:4], *odd[5:], (0, "İstanbul A B ÀÉ c\x0bd\x1ce f"), (0, "a b c"), (0, "A b  C d")]:
        assert S.fingerprint(text) == signed(brute_print(text))


def clusters(n, spread, seed):
    r = random.Random(seed)
    out = set()
    for _ in range(n):
        x = r.getrandbits(64)
        out.add(x)
        for _ in range(r.randint(0, 6)):
            for _ in range(r.randint(1, spread)):
                x ^= 1 << r.randrange(64)
            out.add(x)
    return sorted(map(signed, out))


def check_links(spark, prints, distance):
    got = S.links(spark.createDataFrame([(p,) for p in prints], "p long").repartition(5), distance)
    edges = [(r.u, r.v) for r in got.collect()]
    assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= distance for a, b in edges)
    assert brute_components(prints, edges) == brute_components(prints, near_pairs(prints, distance))


def test_links_lose_no_component(spark):
    prints = clusters(150, 6, 1)
    for distance in (4, 2, 0):
        check_links(spark, prints, distance)


def test_dense_cluster_gives_a_forest(spark):
    """Near copies of one text: thousands of pairs, and few edges."""
    r = random.Random(4)
    base = r.getrandbits(64)
    prints = sorted({signed(base ^ (1 << a) ^ (1 << b)) for a in range(30) for b in range(30)})
    check_links(spark, prints, 4)


def test_heavy_keys_are_dealt_out_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(S, "BLOCK", 16)
    check_links(spark, clusters(60, 5, 9) + [signed(x) for x in range(1 << 7)], 4)


def test_chain_lets_every_near_pair_through():
    rng = np.random.default_rng(0)
    x = np.zeros(4000, np.uint64)
    for _ in range(4):
        x ^= np.uint64(1) << rng.integers(0, 64, len(x), dtype=np.uint64)
    assert S._chain(x, 4).all()


def test_components(spark):
    r = random.Random(8)
    edges = [(r.randint(-50, 400), r.randint(-50, 400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)] + [(5, 5)]
    df = spark.createDataFrame(edges, "u long, v long")
    got = {x.node: x.component for x in components(df).collect()}
    want = brute_components({n for e in edges for n in e}, edges)
    assert {n: c for n, c in want.items() if n in got} == got
    assert all(want[n] == n for n in want.keys() - got.keys())
    assert components(df.limit(0)).count() == 0


def small_corpus(odd):
    r = random.Random(11)
    rows = list(odd)
    for g in range(40):
        words = [f"w{r.randint(0, 400)}" for _ in range(120)]
        for c in range(r.randint(1, 5)):
            near = list(words)
            if c % 2:
                near[r.randrange(120)] = "changed"
            rows.append((1000 - 7 * len(rows), " ".join(near), "s"))
    return rows


def expected(rows):
    prints = {r[1] or "": signed(brute_print(r[1])) for r in rows if r[1] is None or len(r[1]) < 10_000}
    prints |= {r[1]: S.fingerprint(r[1]) for r in rows if r[1] and len(r[1]) >= 10_000}
    nodes = sorted(set(prints.values()))
    root = brute_components(nodes, near_pairs(nodes, 4))
    least = {}
    for r in rows:
        c = root[prints[r[1] or ""]]
        least[c] = min([x for x in (least.get(c), r[0]) if x is not None], default=None)
    return {(r[0], r[1]): (prints[r[1] or ""], least[root[prints[r[1] or ""]]]) for r in rows}


def test_near_duplicates(make_docs, odd):
    rows = small_corpus(odd)
    docs = make_docs(rows, clashing=True)
    got = S.near_duplicates(docs)
    assert got.count() == len(rows)
    want = expected(rows)
    for x in got.collect():
        assert (x["fingerprint_"], x["component_id_"]) == want[(x.doc_id, x.text)]
    one = S.one_of_each(docs)
    assert one.columns == docs.columns
    ids = [x.doc_id for x in one.collect()]
    components_ = {c for _, c in want.values()}
    assert sorted(ids, key=str) == sorted(components_, key=str)


def test_empty_table(make_docs):
    assert S.near_duplicates(make_docs([])).count() == 0
    assert S.one_of_each(make_docs([])).count() == 0


def test_nulls_only(make_docs):
    got = S.one_of_each(make_docs([(None, None), (None, "")])).collect()
    assert len(got) == 1
    rows = S.near_duplicates(make_docs([(None, None), (None, "")])).select(F.col("component_id")).collect()
    assert [r[0] for r in rows] == [None, None]
