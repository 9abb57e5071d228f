import numpy as np
from pyspark.sql import functions as F

from layerkit.llm import hamming_topk as H


def brute(rows, k, every):
    usable = {(i, tuple(x > 0 for x in v)) for i, v in rows if i is not None and v is not None and None not in v and len(v) == max(len(u) for _, u in rows if u)}
    out = []
    for q, a in usable:
        if q % every:
            continue
        near = {}
        for i, b in usable:
            if i != q:
                near[i] = min(near.get(i, 999), sum(x != y for x, y in zip(a, b)))
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(sorted((d, i) for i, d in near.items())[:k])]
    return sorted(out)


def run(spark, rows, k=10, every=50):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, n int, rank string").repartition(4)
    return sorted((r.query_id, r["rank"], r.vec_id, r.distance) for r in H.top_k(df, F.col("vec_id") % every == 0, k).collect())


def test_against_brute_force(spark):
    rng = np.random.default_rng(0)
    for bits, n in ((64, 600), (48, 300), (100, 300)):
        centres = rng.normal(size=(12, bits))
        v = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, bits)) * rng.choice([0.1, 1.0], (n, 1))
        rows = [(i, [float(x) for x in v[i]], 1, None, "x") for i in range(n)]
        assert run(spark, rows) == brute([r[:2] for r in rows], 10, 50)


def test_hot_code_ties_and_odd_rows(spark):
    rng = np.random.default_rng(1)
    same = [1.0, -1.0] * 16
    rows = [(i, same if i % 3 == 0 else [float(x) for x in rng.normal(size=32)], None, 1, None) for i in range(300)]
    rows += [(400, None, 1, 1, ""), (450, [1.0] * 31, 1, 1, ""), (500, [None] + [1.0] * 31, 1, 1, ""), (None, same, 1, 1, ""), (0, same, 7, 7, "again")]
    assert run(spark, rows) == brute([r[:2] for r in rows], 10, 50)


def test_few_rows_and_empty(spark):
    rows = [(50 * i, [1.0, -1.0, float(i - 1), 2.0], 1, 1, "") for i in range(4)]
    assert run(spark, rows) == brute([r[:2] for r in rows], 10, 50)
    assert run(spark, []) == []


def test_one_row_too_long_hides_no_other(spark, caplog):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=32)], 1, 1, "") for i in range(120)]
    odd = [(200, [1.0] * 33, 1, 1, ""), (250, None, 1, 1, "")]
    with caplog.at_level("WARNING"):
        got = run(spark, rows + odd)
    assert got == brute([r[:2] for r in rows], 10, 50) and len(got) == 30
    assert "2 of 122 rows" in caplog.text


def test_length_given_by_the_caller(spark):
    rows = [(i, [1.0, float(i - 2)] if i < 2 else [1.0], 1, 1, "") for i in range(9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, id int, n int, rank string")
    assert [(r.query_id, r.vec_id) for r in H.top_k(df, F.col("vec_id") == 0, bits=2).collect()] == [(0, 1)]
