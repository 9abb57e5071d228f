"""Each stage on what the one before kept, against the brute force of its operator's tests."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

import corpus_pipeline as P  # noqa: E402
import test_line_dedup as lines  # noqa: E402
import test_mixing as mixing  # noqa: E402
import test_quality_votes as quality  # noqa: E402
import test_simhash as simhash  # noqa: E402
from layerkit.llm.common import stored  # noqa: E402


@pytest.fixture(scope="module")
def sf_dir(spark, make_docs):
    rows = [(i, t, f"s{i % 3}", "en") for i, t, _ in quality.corpus()]
    rows += [(5000 + i, rows[i][1], "s1", "en") for i in range(30)]  # exact copies
    passage = "\n".join(" ".join(f"passage{13 * j + w}" for w in range(9)) + "." for j in range(12))
    rows += [(6000 + i, rows[40 + i][1] + "\n" + passage + "\n" + rows[80 + i][1], None, None) for i in range(10)]
    rows += [(7000, None, "s0", "en"), (7001, "", "s0", "en"), (None, rows[7][1], "s2", "en"), (5, rows[5][1], "s2", "en")]
    from layerkit.session import run_dir

    path = run_dir(spark, "sf")
    make_docs(rows).write.parquet(f"{path}/documents.parquet")
    return path


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in P.STAGES[:-1]:
        before = docs.collect()
        docs = stored(stage(spark, docs, sf_dir), name)
        assert docs.columns == columns
        kept.append((before, docs.collect()))
    (raw, good), (_, deduped), (_, single), (_, mixed) = kept
    junk = {r.doc_id for r in raw if r.doc_id is not None and (1000 <= r.doc_id < 4000 or r.doc_id >= 7000)}
    assert sorted(str(r.doc_id) for r in good) == sorted(str(r.doc_id) for r in raw if r.doc_id not in junk)
    distinct = {(-1 if r.doc_id is None else r.doc_id, r.text) for r in good}
    left = lines.brute([r for r in distinct])
    assert {-1 if r.doc_id is None else r.doc_id: r.text for r in deduped} == {i: t for i, t in left.items() if t.strip()}
    want = simhash.expected([(r.doc_id, r.text) for r in deduped])
    assert sorted(str(r.doc_id) for r in single) == sorted({str(c) for _, c in want.values()})
    rows = []
    for r in single:
        w = r.text.split()
        rows.append((r.doc_id, r.text, r.source, 0.5 + len(set(w)) / len(w)))
    copies, _ = mixing.brute_mix(rows)
    taken = {}
    for r in mixed:
        taken[(r.doc_id, r.text)] = taken.get((r.doc_id, r.text), 0) + 1
    assert taken == {k: n for k, n in copies.items() if n}
    packed = P.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sum(r.piece == 0 for r in packed) == len(mixed)
    assert sorted((r.doc_id, r.piece, r.start, r.length) for r in packed) == sorted(
        (r.doc_id, r.piece, r.start, r.length) for r in P.run(spark, sf_dir).collect()
    )


def test_texts_are_put_together_once_for_filter_and_length(spark):
    text = "\n".join(f"line number {i} of a text." for i in range(9))
    rows = [(1, text, "en", "s", 1), (2, text, "en", "s", 1), (3, None, "en", "s", 0), (4, f"other\n{text}\nend", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    left = P.line_chunk_dedup(spark, docs, "")
    assert left._jdf.queryExecution().optimizedPlan().toString().count("array_except(") == 1
    assert all(r["n_chars"] == len(r["text"]) for r in left.collect())
