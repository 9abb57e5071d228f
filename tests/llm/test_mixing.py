import hashlib
import math
import random

from pyspark.sql import functions as F

from layerkit.llm import mixing as M
from layerkit.llm.common import words_of


def brute_targets(sizes, weights=M.WEIGHTS, most=M.MOST):
    """Share, stop, share the excess again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, target, open_ = sum(sizes.values()), {}, set(sizes)
    left = float(total)
    while open_:
        share = left / sum(w[s] for s in open_)
        over = {s for s in open_ if w[s] * share >= most * sizes[s]}
        if not over:
            target |= {s: w[s] * share for s in open_}
            break
        for s in over:
            target[s] = float(most * sizes[s])
            left -= target[s]
        open_ -= over
    return target


def brute_mix(rows):
    """rows: (id, text, source, quality) -> {(id, text): copies}."""
    size = lambda t: len((t or "").split())
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    target = brute_targets(sizes)
    md5 = lambda x: hashlib.md5(x.encode()).hexdigest()
    out = {}
    for s in sizes:
        epochs = min(M.MOST, int(target[s] // sizes[s])) if sizes[s] else 0
        left = target[s] - epochs * sizes[s]
        keyed = {}
        for i, t, src, q in rows:
            if src == s:
                tie = md5(f"{M.SEED}|{'' if i is None else i}|{md5(t or '')}")
                k = -math.log((int(tie[:13], 16) + 0.5) / 2**52) / (q if q and q > 0 else 1.0)
                keyed.setdefault((k, tie), []).append((i, t))
        before = 0
        for key in sorted(keyed):
            n = sum(size(t) for _, t in keyed[key])
            drawn = before + n / 2 <= left
            before += n
            for i, t in keyed[key]:
                out[(i, t)] = epochs + (drawn and size(t) > 0)
    return out, target


def rows_of(seed, n, sources):
    r = random.Random(seed)
    return [(i, " ".join("w" * r.randint(1, 5) for _ in range(int(r.paretovariate(1)) % 400)), r.choice(sources), r.choice([0.5, 1.0, 2.0, None]))
            for i in range(n)]


def run(make_docs, rows, clashing=False):
    q = make_docs([], False).sparkSession.createDataFrame([(i, x) for i, x in {r[0]: r[3] for r in rows}.items()], "qid long, weight double")
    docs = make_docs([r[:3] for r in rows], clashing).join(F.broadcast(q), F.col("doc_id").eqNullSafe(F.col("qid")), "left").drop("qid")
    return M.mix(docs, F.size(words_of(F.col("text"))), F.col("weight"))


def test_against_brute_force(make_docs):
    rows = rows_of(1, 900, ["a", "a", "a", "b", "c", "Z", "é", None])
    got = run(make_docs, rows, clashing=True).collect()
    want, target = brute_mix(rows)
    assert {(x.doc_id, x.text): x["mix_"].copies for x in got} == want
    for x in got:
        assert math.isclose(x["mix_"].target, target[x.source])
    words, largest = {}, {}
    for x in got:
        words[x.source] = words.get(x.source, 0) + x["mix_"].taken
        largest[x.source] = max(largest.get(x.source, 0), x["mix_"].size)
        assert x["mix_"].taken <= 3 * x["mix_"].size
    assert all(abs(words[s] - target[s]) <= largest[s] / 2 + 1e-6 for s in words)


def test_targets(spark):
    r = random.Random(2)
    for n in (1, 2, 3, 7, 40):
        sizes = {(None if i == 3 else f"s{i}"): r.choice([0, 1, 10, 1000, 10**6]) for i in range(n)}
        df = spark.createDataFrame([(str(s), s, z) for s, z in sizes.items()], "source_key string, source string, source_size long")
        got = {x.source: x.target for x in M.source_targets(df).collect()}
        want = brute_targets(sizes)
        assert all(math.isclose(got[s] or 0.0, want[s], abs_tol=1e-9) for s in sizes)


def test_better_documents_are_drawn_first(make_docs):
    rows = [(i, " ".join("w" for _ in range(20)), "a" if i < 2000 else "b", 2.0 if i % 2 else 0.5) for i in range(4000)]
    got = run(make_docs, rows).collect()
    taken = [sum(x.mix.copies for x in got if x.source == "b" and x.doc_id % 2 == odd) for odd in (0, 1)]
    assert taken[1] > 1.5 * taken[0] > 0
    again = {x.doc_id: x.mix.copies for x in run(make_docs, rows).collect()}
    assert again == {x.doc_id: x.mix.copies for x in got}


def test_odd_rows_and_empty_table(make_docs, odd):
    rows = [(*(r + (None,))[:3], None) for r in odd]
    got = run(make_docs, rows, clashing=True).collect()
    want, _ = brute_mix(rows)
    assert len(got) == len(rows) and all(x["mix_"].copies == want[(x.doc_id, x.text)] for x in got)
    assert run(make_docs, []).count() == 0
