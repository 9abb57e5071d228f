"""What must hold of the plans and jobs of the file flows for them to grow no faster than their input."""

import json

import pytest

from layerkit.config import SCHEMA_HINTS
from layerkit.functions.clean import natural
from layerkit.operators import cdc
from layerkit.operators.ranking import rank_within_key
from layerkit.plans import queries
from layerkit.sources.json_ingest import parse_with_rescue

SF = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def rendered(monkeypatch):
    """Entities whose JSON lines were made, once per call."""
    calls, plain = [], queries.tt.json_lines
    monkeypatch.setattr(queries.tt, "json_lines", lambda s, d, entity: calls.append(entity) or plain(s, d, entity))
    return calls


def test_deliveries_are_rendered_once_and_stamps_are_broadcast(spark, rendered):
    df = queries._ingest(spark, SF, "orders")
    assert rendered == ["orders"]
    # a stamp is that of a whole delivery: a shuffle by it would make each delivery one task
    assert "rightHint=(strategy=broadcast)" in optimized(df)
    assert df.count() > 0


def test_staged_deliveries_land_one_after_the_other(spark, scratch):
    queries.stage_raw(spark, SF, f"{scratch}/raw", "customers", ((1, 1), (2, 2), (3, None), (900, None)))
    plain = spark.read.option("recursiveFileLookup", "true")
    seen = []
    for number in (1, 2, 3, 4):  # the last has no row
        queries.deliver(spark, f"{scratch}/raw", "customers", number)
        seen.append(plain.text(f"{scratch}/raw/customers").count())
    assert 0 < seen[0] < seen[1] < seen[2] == seen[3]
    queries.write_raw(spark, SF, f"{scratch}/whole", "customers")
    whole, parts = plain.text(f"{scratch}/whole/customers"), plain.text(f"{scratch}/raw/customers")
    assert whole.exceptAll(parts).isEmpty() and parts.exceptAll(whole).isEmpty()


def test_only_records_that_may_have_something_to_rescue_are_parsed_into_a_map(spark):
    rest = '"order_id":"1","quantity":1,"unit_price":2'
    lines = {
        f'{{"line_item_id":"a","product_name":"p",{rest}}}': None,
        f'{{"line_item_id":"a","product_name":"p",{rest},"unit_price":3}}': "whole",
        f'{{"line_item_id":"a","product_name":{{"a":1,"a":2}},{rest}}}': "whole",  # keys of a value too
        f'{{"line_item_id":"a","product_name":{{"a":1}},{rest}}}': None,
        f'{{"line_item_id":"a","product_name":"[p",{rest}}}': None,
        f'{{"line_item_id":"a","product_name":"p",{rest},"Quantity":1}}': '{"Quantity":1}',
        f'{{"line_item_id":"a","product_name":"p",{rest}}}}}': "whole",
    }
    df = parse_with_rescue(spark.createDataFrame([(x,) for x in lines], "value string"), SCHEMA_HINTS["line_items"])
    for row, (line, want) in zip(df.collect(), lines.items(), strict=True):
        got = row["_rescued_data"]
        assert got == (line if want == "whole" else want) or json.loads(got) == json.loads(want)
    assert "json_object_keys" in optimized(df) or "jsonObjectKeys" in optimized(df)


def test_names_are_padded_once_per_distinct_name(spark):
    names = {"a9": f"a{'9'.zfill(20)}", "00012z": f"{'12'.zfill(20)}z", "x" + "1" * 20: "x" + "1" * 20,
             "0" * 20 + "123": "0" * 20 + "123", "": "", "é9٣8": f"é{'9'.zfill(20)}٣{'8'.zfill(20)}", None: None}
    df = spark.createDataFrame([(x,) for x in names], "n string").select(natural("n").alias("n"))
    assert [r["n"] for r in df.collect()] == list(names.values())
    assert "ArrowEvalPython" in optimized(df)


def test_first_bins_are_not_joined(spark):
    df = spark.createDataFrame([("a", 5, 0), ("a", 70000, 1), ("a", None, 2), ("b", 1, 3), (None, 2, 4), (None, 200000, 5)], "k string, o int, x int")
    ranked = rank_within_key(df, ["k"], ["o"])
    assert sorted((r["x"], r["__rank"]) for r in ranked.collect()) == [(0, 2), (1, 3), (2, 1), (3, 1), (4, 1), (5, 2)]
    assert "Join LeftOuter" in optimized(ranked)


def test_late_deliveries_are_made_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    plain, made = queries.silver, spark.sparkContext.accumulator(0)
    rows = plain(spark, SF, "customers").count()

    def seen(_):
        made.add(1)
        return True

    every = F.udf(seen, "boolean").asNondeterministic()  # not moved behind a filter
    monkeypatch.setattr(queries, "silver", lambda *a: plain(*a).filter(every("customer_id")))
    queries.cdc_apply_late_arrival(spark, SF)
    assert made.value == rows > 0


def test_a_merge_deals_stored_segments_once(spark, scratch):
    """One scan of the state and one shuffle by (key, bin) for all steps on segments; what stitching
    reads twice is kept, and keys without new rows are not in it."""
    schema, kept = "k string, seq int, src string, v string", []
    old = spark.createDataFrame([("a", 1, "f", "A"), ("a", 5, "f", "A"), ("a", 70000, "f", "A"), (None, 2, "f", "B"), ("z", 4, "f", "Z")], schema)
    new = spark.createDataFrame([("a", 3, "f", "B"), ("a", 5, "g", "A"), ("n", 1, "f", "N"), (None, None, "f", "B")], schema)
    cdc.scd2_state(old, "k", "seq", ("src",)).write.parquet(f"{scratch}/state")
    merged = cdc.scd2_merge(
        spark.read.parquet(f"{scratch}/state"), new, "k", "seq", ("src",), keep=lambda s: kept.append(s.persist()) or s,
    )
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and plan.count("REPARTITION_BY_COL") == 1
    assert len(kept) == 1 and "InMemoryRelation" in optimized(merged)
    got, want = cdc.visible_scd2(merged), cdc.scd2(old.unionByName(new), "k", "seq", ("src",))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert {r["k"] for r in kept[0].select("__key.k").collect()} == {"a", "n", None}
    kept[0].unpersist()


def test_an_apply_keeps_nothing_in_the_store(spark, scratch):
    from layerkit.sinks.tables import ensure_schema
    from layerkit.streaming.cdc_apply import Target, apply_changes

    name = f"kept_{scratch.rsplit('-', 1)[-1]}"
    ensure_schema(spark, name, f"{scratch}/{name}")
    held = lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before, t = held(), Target(f"{name}.scd2", f"{scratch}/{name}/state", ("k",), "scd2", "seq")
    for i in (2, 1):
        spark.createDataFrame([("a", i, "A")], "k string, seq int, v string").write.parquet(f"{scratch}/new{i}")
        apply_changes(spark, t, spark.read.parquet(f"{scratch}/new{i}"))
    assert held() == before
    assert [tuple(r) for r in spark.table(t.view).collect()] == [("a", "A", 1, None)]
