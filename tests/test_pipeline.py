"""The 11-dataset pipeline over JSON files: end state, re-runs, selective refresh, catalog."""

import pytest

from layerkit.config import PipelineConfig
from layerkit.operators import marts
from layerkit.plans import pipeline, queries
from layerkit.streaming.cdc_apply import refresh_number
from tests.conftest import SF0001


def _rows(df):
    return sorted(map(repr, map(tuple, df.select(*sorted(df.columns)).collect())))


@pytest.fixture(scope="module")
def ran(spark):
    from layerkit.session import run_dir

    root = run_dir(spark, "pipe")
    cfg = PipelineConfig.for_target(root).with_(bronze_schema="tb", silver_schema="ts", gold_schema="tg")
    for e in ("customers", "orders", "line_items"):
        queries.write_raw(spark, SF0001, cfg.raw, e)
    stats = pipeline.refresh(spark, cfg)
    return cfg, stats


def test_marts_equal_batch_flow(spark, ran):
    cfg, _ = ran
    m1 = pipeline.read_dataset(spark, cfg, "gold_sales_by_region_monthly")
    m2 = pipeline.read_dataset(spark, cfg, "gold_product_sales_metrics")
    assert _rows(m1) == _rows(queries.mv_sales_by_region_monthly(spark, SF0001))
    assert _rows(m2) == _rows(queries.mv_product_sales_metrics(spark, SF0001))


def _numbers(spark, cfg, names):
    return {n: refresh_number(spark, pipeline.target_of(cfg, pipeline.BY_NAME[n])) for n in names}


def test_rerun_without_new_files_changes_nothing(spark, ran):
    cfg, _ = ran
    names = ("fact_orders", "dim_customers")
    before = _numbers(spark, cfg, names)
    counts = {n: pipeline.read_dataset(spark, cfg, n).count() for n in ("bronze_orders", "silver_orders")}
    stats = pipeline.refresh(spark, cfg, only=["bronze_orders", "silver_orders", "fact_orders", "dim_customers"])
    assert stats["fact_orders"]["applied"] is False and stats["dim_customers"]["applied"] is False
    assert stats["bronze_orders"]["rows"] == 0
    assert before == _numbers(spark, cfg, names) == {n: 1 for n in names}
    assert counts == {n: pipeline.read_dataset(spark, cfg, n).count() for n in counts}


def test_views_skip_refresh_when_inputs_unchanged(spark, ran):
    cfg, _ = ran
    stats = pipeline.refresh(spark, cfg, only=list(pipeline.VIEW_INPUTS))
    assert all(stats[n] == {"applied": False, "refresh": 1} for n in pipeline.VIEW_INPUTS)


def test_catalog_metadata(spark, ran):
    cfg, _ = ran
    rows = {r.dataset: r for r in pipeline.catalog_frame(spark, cfg).collect()}
    assert set(rows) == {d.name for d in pipeline.DATASETS}
    assert rows["dim_customers"].kind == "scd2" and rows["dim_customers"].layer == "gold"
    assert rows["bronze_orders"].cluster_key == "order_id"
    assert rows["silver_line_items"].comment.startswith("Order lines")
    assert all(r.row_count > 0 for r in rows.values())


def test_clustered_files_have_disjoint_key_ranges(spark, ran):
    cfg, _ = ran
    before = {n: pipeline.read_dataset(spark, cfg, n).count() for n in ("bronze_orders", "silver_line_items")}
    assert all(x == {"applied": True, "refresh": 1} for x in pipeline.recluster(spark, cfg).values())
    assert all(x == {"applied": False, "refresh": 1} for x in pipeline.recluster(spark, cfg).values())
    rows = {r.dataset: r for r in pipeline.cluster_report(spark, cfg).collect()}
    assert set(rows) == {d.name for d in pipeline.DATASETS if d.cluster_by} and len(rows) == 9
    assert all(r.four_files and r.disjoint for r in rows.values())
    for name, n in before.items():
        table = spark.table(pipeline.clustered_table(cfg, name)).drop("__run")
        assert rows[name].row_count == n
        assert table.exceptAll(pipeline.read_dataset(spark, cfg, name)).count() == 0
    # a lookup by key reads the one file of the run whose range has it
    from pyspark.sql import functions as F

    plan = spark.table(pipeline.clustered_table(cfg, "silver_line_items")).filter(F.col("line_item_id") == "7-1")
    assert "EqualTo(line_item_id,7-1)" in plan._jdf.queryExecution().executedPlan().toString()


def test_selective_refresh_rejects_unknown(spark, ran):
    cfg, _ = ran
    with pytest.raises(KeyError):
        pipeline.refresh(spark, cfg, only=["no_such_table"])


def test_incremental_line_items_then_selective_refresh(spark):
    df = queries.pipeline_selective_refresh(spark, SF0001)
    assert _rows(df) == _rows(queries.mv_product_sales_metrics(spark, SF0001))


def test_targets_are_known(spark):
    assert PipelineConfig.for_target("r", "prod").gold_schema == "gold"
    assert PipelineConfig.for_target("r").gold_schema == "gold_dev"
    for name in ("staging", "Dev", ""):
        with pytest.raises(ValueError):
            PipelineConfig.for_target("r", name)


def test_refresh_keeps_the_catalog_entry(spark, scratch):
    """The entry is altered, never dropped: its table id in the catalog stays."""
    from layerkit.sinks.tables import ensure_schema, register_table, table_metadata

    ensure_schema(spark, "keep_entry", f"{scratch}/db")
    d = spark.range(5)
    for i in (1, 2):
        d.withColumn("id", d.id + i).write.parquet(f"{scratch}/v{i}")
    register_table(spark, "spark_catalog.keep_entry.t", f"{scratch}/v1", d.schema, "it's one", {"a": "1"})
    made = spark.sql("DESCRIBE TABLE EXTENDED keep_entry.t").filter("col_name = 'Created Time'").first()
    register_table(spark, "spark_catalog.keep_entry.t", f"{scratch}/v2", d.schema, "two", {"a": "2"})
    assert spark.sql("DESCRIBE TABLE EXTENDED keep_entry.t").filter("col_name = 'Created Time'").first() == made
    assert spark.table("keep_entry.t").agg({"id": "max"}).first()[0] == 6
    meta = table_metadata(spark, "spark_catalog.keep_entry.t")
    assert meta["comment"] == "two" and meta["properties"]["a"] == "2"


def test_catalog_is_chosen_by_target():
    named = {"prod": "lake"}
    assert PipelineConfig.for_target("r", "prod", named).qualified("gold", "fact_orders") == "lake.gold.fact_orders"
    assert PipelineConfig.for_target("r", "dev", named).qualified("gold", "fact_orders") == "spark_catalog.gold_dev.fact_orders"


def _write_lines(path, rows):
    import json
    import os

    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def _local(path):
    return path.replace("file://", "").replace("file:", "")


def test_ties_go_by_file_time_then_natural_file_order(spark, scratch):
    """Three files of one batch give one key: the tenth is later than the ninth, unless the
    file time says otherwise."""
    import os

    cfg = PipelineConfig.for_target(scratch).with_(bronze_schema="tie_b", silver_schema="tie_s", gold_schema="tie_g")
    raw = _local(cfg.raw_dir("orders"))
    order = {"order_id": "1", "customer_id": "c", "order_date": "2024-01-05", "total_amount": 1.0}
    for n, when in ((9, 1_700_000_000), (10, 1_700_000_000), (11, 1_600_000_000)):
        _write_lines(f"{raw}/orders_{n}.json", [order | {"status": f"s{n}"}])
        os.utime(f"{raw}/orders_{n}.json", (when, when))
    pipeline.refresh(spark, cfg, only=["bronze_orders", "silver_orders", "fact_orders"])
    assert [r.status for r in spark.table(cfg.qualified("gold", "fact_orders")).collect()] == ["S10"]
    # a later delivery of an older file has a later sequence
    _write_lines(f"{raw}/orders_2.json", [order | {"status": "s2"}])
    pipeline.refresh(spark, cfg, only=["bronze_orders", "silver_orders", "fact_orders"])
    assert [r.status for r in spark.table(cfg.qualified("gold", "fact_orders")).collect()] == ["S2"]


def test_names_sort_with_their_numbers(spark):
    from layerkit.functions.clean import natural

    names = ["orders_9.json", "orders_10.json", "orders_100.json", "x", "x0.json", "x00.json"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r.n for r in df.orderBy(natural("n"), "n").collect()] == names


def test_bounded_batches_archive_and_a_batch_that_fails(spark, scratch):
    """Eight files in batches of about two; a batch lost between its data and its commit, and one
    lost between the table's commit and the checkpoint's, are run again: nothing lost or doubled."""
    import os

    from layerkit.config import SCHEMA_HINTS
    from layerkit.sinks.tables import run_append_stream
    from layerkit.sources.json_ingest import read_json_stream

    raw, out, ckpt = _local(f"{scratch}/raw"), _local(f"{scratch}/bronze"), _local(f"{scratch}/ckpt")

    def put(n):
        _write_lines(f"{raw}/{n}.json", [{"order_id": f"{n}-{i}"} for i in range(10)])

    def run():
        stream = read_json_stream(spark, raw, SCHEMA_HINTS["orders"], max_bytes_per_trigger=2 * size + 1, archive_dir=f"{scratch}/old")
        return run_append_stream(stream, out, ckpt)

    def forget(folder, batch):
        for name in (f"{folder}/{batch}", f"{folder}/.{batch}.crc"):
            os.remove(name)

    for n in range(10, 18):
        put(n)
    size = os.path.getsize(f"{raw}/10.json")
    assert run() == {"batches": 4, "rows": 80}
    ids = lambda: sorted(r.order_id for r in spark.read.parquet(out).select("order_id").collect())
    want = sorted(f"{n}-{i}" for n in range(10, 18) for i in range(10))
    assert ids() == want
    put(18)
    assert run()["rows"] == 10
    forget(f"{ckpt}/commits", 4)  # the table has the batch, the checkpoint does not
    want = sorted(want + [f"18-{i}" for i in range(10)])
    run()
    assert ids() == want
    put(19)
    assert run()["rows"] == 10
    # the files are there, neither log has the batch
    forget(f"{ckpt}/commits", 5)
    forget(f"{out}/_spark_metadata", 5)
    run()
    assert ids() == sorted(want + [f"19-{i}" for i in range(10)])
    assert any(files for _, _, files in os.walk(_local(f"{scratch}/old")))
    with pytest.raises(ValueError):
        read_json_stream(spark, raw, SCHEMA_HINTS["orders"], max_files_per_trigger=1, max_bytes_per_trigger=1)
