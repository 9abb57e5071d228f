"""SCD type 1 / type 2: the change-feed cases of the blueprint, brute-force properties,
bins of the sequence and incremental application."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from layerkit.operators import cdc

T0 = datetime(2024, 1, 1)
HOUR = 3_600_000_000
SCHEMA = "k string, seq timestamp_ntz, src string, v string, w int"


def ts(i):
    return T0 + timedelta(hours=i)


def feed(spark, rows):
    return spark.createDataFrame([(k, ts(s), src, v, w) for k, s, src, v, w in rows], SCHEMA)


def scd1_rows(spark, rows, **kw):
    out = cdc.scd1(feed(spark, rows), "k", "seq", ("src",), **kw)
    return sorted(((r.k, r.v, r.w) for r in out.collect()), key=repr)


def scd2_rows(spark, rows, **kw):
    out = cdc.scd2(feed(spark, rows), "k", "seq", ("src",), **kw)
    conv = lambda t: None if t is None else int((t - T0).total_seconds() // 3600)
    return sorted(((r.k, r.v, r.w, conv(r["__START_AT"]), conv(r["__END_AT"])) for r in out.collect()), key=repr)


# ---- the change-feed table of the blueprint (k, seq, payload) in arrival order ----------
CASES = [
    ([("k", 1, "f", "A", 0)], [("k", "A", 0)], [("k", "A", 0, 1, None)]),
    ([("k", 1, "f", "A", 0), ("k", 2, "f", "B", 0)], [("k", "B", 0)], [("k", "A", 0, 1, 2), ("k", "B", 0, 2, None)]),
    ([("k", 1, "f", "A", 0), ("k", 2, "f", "A", 0)], [("k", "A", 0)], [("k", "A", 0, 1, None)]),
    ([("k", 2, "f", "B", 0), ("k", 1, "f", "A", 0)], [("k", "B", 0)], [("k", "A", 0, 1, 2), ("k", "B", 0, 2, None)]),
    (
        [("k", 1, "f", "A", 0), ("k", 3, "f", "A", 0), ("k", 2, "f", "B", 0)],
        [("k", "A", 0)],
        [("k", "A", 0, 1, 2), ("k", "B", 0, 2, 3), ("k", "A", 0, 3, None)],
    ),
    ([("k", 1, "f", "A", 0), ("k", 2, "f", None, 0)], [("k", None, 0)], [("k", "A", 0, 1, 2), ("k", None, 0, 2, None)]),
    # tie on the sequence: the greater tie-break column wins, one version only
    ([("k", 1, "f2", "B", 0), ("k", 1, "f1", "A", 0)], [("k", "B", 0)], [("k", "B", 0, 1, None)]),
    # tie on sequence and tie-break: the greater payload wins (whole struct, NULL smallest)
    ([("k", 1, "f", None, 9), ("k", 1, "f", "A", 0)], [("k", "A", 0)], [("k", "A", 0, 1, None)]),
]


def test_blueprint_cases(spark):
    for rows, want1, want2 in CASES:
        assert scd1_rows(spark, rows) == sorted(want1, key=repr), rows
        assert sorted(map(repr, scd2_rows(spark, rows))) == sorted(map(repr, want2)), rows
        # sent twice: same result
        assert scd1_rows(spark, rows + rows) == sorted(want1, key=repr)
        assert sorted(map(repr, scd2_rows(spark, rows + rows))) == sorted(map(repr, want2))


# ---- brute force ---------------------------------------------------------------------------
def _key(t):
    return tuple((0,) if x is None else (1, x) for x in t)


def brute_scd1(rows):
    best = {}
    for k, s, src, v, w in rows:
        cand = (s, src, v, w)
        if k not in best or _key(cand) > _key(best[k]):
            best[k] = cand
    return sorted(((k, c[2], c[3]) for k, c in best.items()), key=repr)


def brute_scd2(rows):
    per = {}
    for k, s, src, v, w in rows:
        cand = (src, v, w)
        cur = per.setdefault(k, {}).get(s)
        if cur is None or _key(cand) > _key(cur):
            per[k][s] = cand
    out = []
    for k, bys in per.items():
        kept = []
        prev = object()
        for s in sorted(bys):
            p = bys[s][1:]
            if p != prev:
                kept.append((s, p))
            prev = p
        for i, (s, p) in enumerate(kept):
            end = kept[i + 1][0] if i + 1 < len(kept) else None
            out.append((k, p[0], p[1], s, end))
    return sorted(map(repr, out))


row = st.tuples(
    st.sampled_from(["a", "b", "c"]),
    st.integers(0, 6),
    st.sampled_from(["f1", "f2"]),
    st.sampled_from(["X", "Y", None]),
    st.sampled_from([0, 1]),
)
SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(row, min_size=1, max_size=25))
def test_scd_matches_brute_force_and_hot_path(spark, rows):
    assert scd1_rows(spark, rows) == brute_scd1(rows)
    want = brute_scd2(rows)
    assert sorted(map(repr, scd2_rows(spark, rows))) == want
    # the rows do not depend on the bins of the sequence
    assert sorted(map(repr, scd2_rows(spark, rows, widths=(HOUR, 2, 2)))) == want


@SETTINGS
@given(st.lists(row, min_size=2, max_size=25), st.integers(1, 24), st.booleans())
def test_any_split_and_order_gives_same_table(spark, rows, cut, reverse):
    cut = min(cut, len(rows) - 1)
    a, b = rows[:cut], rows[cut:]
    if reverse:
        a, b = b, a
    fa, fb = feed(spark, a), feed(spark, b)
    # SCD1: stored state with hidden sequence, merged batch by batch, replayed once more
    state = cdc.scd1(fa, "k", "seq", ("src",), keep_hidden=True)
    state = cdc.scd1_merge(state, fb, "k", "seq", ("src",))
    state = cdc.scd1_merge(state, fb, "k", "seq", ("src",))
    got1 = sorted(((r.k, r.v, r.w) for r in cdc.visible_scd1(state).collect()), key=repr)
    assert got1 == brute_scd1(rows)
    # SCD2: the stored segments alone, merged and replayed once more
    bins = {"widths": (3 * HOUR, 1)}
    from layerkit.session import run_dir

    hist = cdc.scd2_state(fa, "k", "seq", ("src",), **bins)
    for _ in range(2):
        path = run_dir(spark, "segments")
        hist.coalesce(1).write.parquet(path)
        hist = cdc.scd2_merge(spark.read.parquet(path), fb, "k", "seq", ("src",), **bins)
    hist = cdc.visible_scd2(hist)
    conv = lambda t: None if t is None else int((t - T0).total_seconds() // 3600)
    got2 = sorted(repr((r.k, r.v, r.w, conv(r["__START_AT"]), conv(r["__END_AT"]))) for r in hist.collect())
    assert got2 == brute_scd2(rows)


def test_history_invariants_on_test_tables(spark):
    from pyspark.sql import functions as F

    from layerkit.plans.queries import dim_customers, fact_orders, silver  # noqa: F401
    from tests.conftest import SF0001

    hist = dim_customers(spark, SF0001, widths=(1 << 34, 4, 4))
    plain = dim_customers(spark, SF0001, widths=())
    assert sorted(map(tuple, hist.collect())) == sorted(map(tuple, plain.collect()))
    # one open row per key, no overlapping or empty ranges
    assert hist.filter(F.col("__END_AT").isNull()).groupBy("customer_id").count().filter("count <> 1").count() == 0
    assert hist.filter(F.col("__END_AT") <= F.col("__START_AT")).count() == 0
    # current version equals the SCD1 of the same feed on every payload column
    s1 = cdc.scd1(silver(spark, SF0001, "customers"), "customer_id", "_ingested_at", ("_source_file",))
    cur = cdc.current_rows(hist).drop("__START_AT", "__END_AT")
    assert cur.exceptAll(s1.select(*cur.columns)).count() == 0 and s1.count() == cur.count()


def test_rank_within_key_hot_path_equals_window(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from layerkit.operators.ranking import rank_within_key

    rows = [("a", i % 7, f"p{i % 3}") for i in range(60)] + [("b", 1, "x"), ("b", 0, "y"), (None, 2, "z")]
    df = spark.createDataFrame(rows, "k string, s int, p string").repartition(4)
    want = df.withColumn("__rank", F.row_number().over(Window.partitionBy("k").orderBy("s", "p")))
    got = rank_within_key(df, ["k"], ["s", "p"], widths=(2,))
    # ties (same k, s, p) may swap rank, so compare the multiset of (k, s, p, rank)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.columns == ["k", "s", "p", "__rank"]


def test_hot_keys_in_many_bins_with_small_coalesced_partitions(spark):
    """400,000 rows, two keys with a quarter each, and partitions that AQE merges differently
    for every reader: the bins must not depend on partitions."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    settings_ = {
        "spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "20k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64m", "spark.sql.adaptive.coalescePartitions.parallelismFirst": "true",
    }
    before = {k: spark.conf.get(k, None) for k in settings_}
    try:
        for k, v in settings_.items():
            spark.conf.set(k, v)
        i = F.col("id")
        df = spark.range(400_000).select(
            F.when(i % 4 < 2, F.concat(F.lit("hot"), (i % 4).cast("string"))).otherwise((i % 5000).cast("string")).alias("k"),
            F.timestamp_seconds(F.lit(1_700_000_000) + F.pmod(F.xxhash64("id"), F.lit(5_000_000))).alias("seq"),
            F.lit("f").alias("src"), F.pmod(F.xxhash64(i + 7), F.lit(3)).alias("v"),
        )
        got = cdc.scd2(df, "k", "seq", ("src",), widths=(1 << 38,)).cache()
        d = cdc.dedup_ties(df, "k", "seq", ("src",))
        w = Window.partitionBy("k").orderBy("seq")
        kept = d.withColumn("p", F.lag("v").over(w)).filter("p is null or p != v")
        want = kept.select("k", "v", F.col("seq").alias("__START_AT"), F.lead("seq").over(w).alias("__END_AT"))
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        assert got.filter("__END_AT <= __START_AT").count() == 0
        assert got.filter("__END_AT is null").groupBy("k").count().filter("count != 1").count() == 0

        from layerkit.operators.ranking import rank_within_key

        ranks = rank_within_key(df, ["k"], ["seq", "v"], widths=(1 << 38,))
        assert ranks.select("k", "__rank").distinct().count() == 400_000
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_late_row_splits_a_version_that_was_confirmed_later(spark, scratch):
    """A at 1, 2.5 and 3; then B at 2 arrives: A [1, 2), B [2, 2.5), A [2.5, -)."""
    rows = [("k", s, "f", "A", 0) for s in (1, 2.5, 3)]
    cdc.scd2_state(feed(spark, rows), "k", "seq", ("src",)).coalesce(1).write.parquet(f"{scratch}/state")
    state = spark.read.parquet(f"{scratch}/state")
    assert [(r["__opens"], len(r["__confirmed"])) for r in state.collect()] == [(True, 3)]
    got = cdc.visible_scd2(cdc.scd2_merge(state, feed(spark, [("k", 2, "f", "B", 0)]), "k", "seq", ("src",)))
    found = sorted((r["__START_AT"], r["__END_AT"], r.v) for r in got.collect())
    assert found == [(ts(1), ts(2), "A"), (ts(2), ts(2.5), "B"), (ts(2.5), None, "A")]


def test_null_sequences_come_first_whatever_the_bins(spark):
    df = spark.createDataFrame(
        [("k", None, "A"), ("k", 30, "A"), ("k", 70_000, "B"), ("n", None, "x"), ("n", None, "y"), ("n", -5, "x"), (None, 1, "z"), (None, 2, "z")],
        "k string, seq long, v string",
    )
    want = [("k", "A", None, 70_000), ("k", "B", 70_000, None), ("n", "y", None, -5), ("n", "x", -5, None), (None, "z", 1, None)]
    for widths in (None, (), (5,)):
        got = [tuple(r) for r in cdc.scd2(df, "k", "seq", widths=widths).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr), widths
        state = cdc.scd2_state(df.filter("seq is not null"), "k", "seq", widths=widths)
        merged = cdc.visible_scd2(cdc.scd2_merge(state, df.filter("seq is null"), "k", "seq", widths=widths))
        assert sorted(map(tuple, merged.collect()), key=repr) == sorted(want, key=repr), widths


def test_no_job_before_an_action(spark):
    """Building a plan runs nothing: bins are known from the row alone."""
    from layerkit.operators.ranking import rank_within_key

    tracker = spark.sparkContext.statusTracker()
    df = feed(spark, [("k", 1, "f", "A", 0)])
    spark.sparkContext.setJobGroup("plans-only", "no job is expected here")
    try:
        state = cdc.scd2_state(df, "k", "seq", ("src",))
        cdc.scd2(df, "k", "seq", ("src",))
        cdc.scd2_merge(state, df, "k", "seq", ("src",))
        rank_within_key(df, ["k"], ["seq"])
        assert len(tracker.getJobIdsForGroup("plans-only")) == 0
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# ---- stored targets ------------------------------------------------------------------------
def target(spark, scratch, kind, **kw):
    import uuid

    from layerkit.sinks.tables import ensure_schema
    from layerkit.streaming.cdc_apply import Target

    name = f"cdc_{uuid.uuid4().hex[:10]}"
    ensure_schema(spark, name, f"{scratch}/{name}")
    return Target(f"{name}.{kind}", f"{scratch}/{name}/state", ("k",), kind, "seq", ("src",), **kw)


def shown(spark, t):
    rows = spark.table(t.view).collect()
    if t.kind == "scd1":
        return sorted(((r.k, r.v, r.w) for r in rows), key=repr)
    conv = lambda x: None if x is None else int((x - T0).total_seconds() // 3600)
    return sorted(repr((r.k, r.v, r.w, conv(r["__START_AT"]), conv(r["__END_AT"]))) for r in rows)


def deliver(spark, t, scratch, rows):
    from layerkit.streaming.cdc_apply import refresh_target

    if rows:
        feed(spark, rows).coalesce(1).write.mode("append").parquet(f"{scratch}/log")
    return refresh_target(spark, t, spark.readStream.schema(SCHEMA).parquet(f"{scratch}/log"), f"{scratch}/{t.kind}-changes")


def test_late_rows_and_new_keys_survive_the_apply(spark, scratch):
    first = [("k", 1, "f", "A", 0), ("k", 3, "f", "A", 0)]
    later = [("k", 2, "f", "B", 0), ("n", 2, "f", "N", 0)]
    last = [("n", 0, "f", "M", 0)]
    for kind, want in (("scd1", brute_scd1(first + later + last)), ("scd2", brute_scd2(first + later + last))):
        base, t = f"{scratch}/{kind}", target(spark, scratch, kind)
        for n, more in enumerate((first, later, last), 1):
            assert deliver(spark, t, base, more) == {"applied": True, "refresh": n}
        assert deliver(spark, t, base, []) == {"applied": False, "refresh": 3}
        assert shown(spark, t) == want
        # a refresh takes the new rows of the log only
        assert spark.read.parquet(f"{base}/{kind}-changes/inbox").filter("__refresh = 3").count() == len(last)


def test_a_table_keeps_its_bucket_count(spark, scratch):
    import dataclasses

    rows = [(f"k{i}", 1, "f", "v1", i) for i in range(300)]
    t, log = target(spark, scratch, "scd1", buckets=4), []
    for step, buckets in enumerate((4, 9, 2)):
        more = rows if not step else [(f"k{i}", step + 2, "f", f"v{step}", i) for i in range(step, 300, 7)]
        log += more
        deliver(spark, dataclasses.replace(t, buckets=buckets), scratch, more)
        assert shown(spark, t) == brute_scd1(log)
    assert spark.table(t.state).select("__bucket").distinct().count() == 4


def test_only_touched_buckets_are_read_and_written(spark, scratch):
    """One key of 100 buckets: one partition is read (by dynamic pruning) and replaced."""
    import glob
    import os

    from pyspark.sql import functions as F

    from layerkit.sinks.tables import BUCKET, bucket_of, touched_rows

    rows = [(f"key{i}", 1, "f", "x" * 50, i) for i in range(20_000)]
    for kind in ("scd1", "scd2"):
        base, t = f"{scratch}/{kind}", target(spark, scratch, kind, buckets=100)
        deliver(spark, t, base, rows)
        seen = lambda: {f: os.path.getsize(f) for f in glob.glob(f"{t.path}/*/part-*".replace("file:", ""))}
        before = seen()
        assert len({os.path.dirname(f) for f in before}) == 100
        deliver(spark, t, base, [("key7", 5, "f", "new", 7)])
        written = {f: n for f, n in seen().items() if f not in before}
        assert len({os.path.dirname(f) for f in written}) == 1
        assert sum(written.values()) < sum(before.values()) / 50
        assert spark.table(t.view).count() == 20_000 + (kind == "scd2")
        new = spark.read.parquet(f"{base}/{kind}-changes/inbox").filter("__refresh = 2").withColumn(BUCKET, bucket_of(["k"], 100))
        read = touched_rows(spark, t.state, new)
        assert "dynamicpruning" in read._jdf.queryExecution().executedPlan().toString()
        files = read.select(F.col("_metadata.file_path").alias("f")).distinct() if "_metadata" in read.columns else None
        assert read.count() < 400 and files is None


def test_a_refresh_that_failed_is_run_again(spark, scratch, monkeypatch):
    """Failures after the drain, after the merge, and a merge done twice: nothing lost or doubled."""
    from layerkit.streaming import cdc_apply

    first = [("k", 1, "f", "A", 0), ("m", 1, "f", "A", 0)]
    later = [("k", 2, "f", "B", 0), ("n", 2, "f", "N", 0)]
    for kind, brute in (("scd1", brute_scd1), ("scd2", brute_scd2)):
        base, t = f"{scratch}/{kind}", target(spark, scratch, kind, buckets=3)
        deliver(spark, t, base, first)

        def broken(*a, **k):
            raise RuntimeError("lost")

        for step in ("replace_touched", "set_properties"):
            with monkeypatch.context() as m:
                m.setattr(cdc_apply, step, broken)
                try:
                    deliver(spark, t, base, later if step == "replace_touched" else [])
                    raise AssertionError("not reached")
                except RuntimeError as e:
                    assert str(e) == "lost"
        assert deliver(spark, t, base, []) == {"applied": True, "refresh": 2}
        assert shown(spark, t) == brute(first + later)


def test_a_failing_read_is_not_an_empty_inbox(spark, scratch, monkeypatch):
    import pytest

    from layerkit.streaming import cdc_apply

    monkeypatch.setattr(cdc_apply, "run_append_stream", lambda *a, **k: {"rows": 0})
    stream = feed(spark, [])
    assert cdc_apply.drain(spark, stream, f"{scratch}/none", 1) is None
    spark.range(3).selectExpr("'no parquet' AS value").write.text(f"{scratch}/broken/inbox/__refresh=1")
    with pytest.raises(Exception, match="(?i)parquet"):
        cdc_apply.drain(spark, stream, f"{scratch}/broken", 1)


def test_files_are_found_again_without_their_catalog_entry(spark, scratch):
    first, later = [("k", 1, "f", "A", 0), ("m", 1, "f", "A", 0)], [("k", 2, "f", "B", 0)]
    for kind, brute in (("scd1", brute_scd1), ("scd2", brute_scd2)):
        base, t = f"{scratch}/{kind}", target(spark, scratch, kind, buckets=3)
        deliver(spark, t, base, first)
        spark.sql(f"DROP VIEW {t.view}")
        spark.sql(f"DROP TABLE {t.state}")
        deliver(spark, t, base, later)
        assert shown(spark, t) == brute(first + later)
