"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Batch keys run the layers directly on the typed feeds derived from the shared tables;
``ingest_*``, ``stream_*``, ``clustered_write``, ``dataset_catalog`` and ``pipeline_*`` first
render those tables as JSON files in a fresh run folder under ``spark.checkpoint.dir`` and
then run the real streaming/snapshot machinery over them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

from py4j.java_gateway import JavaObject
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..config import SCHEMA_HINTS, PipelineConfig
from ..functions.clean import ORDER, arrival_order, clean
from ..operators import cdc, marts
from ..session import freed_shuffles, remove, run_dir, stored
from ..sinks.tables import ensure_schema, run_append_stream, write_clustered
from ..sources import testtables as tt
from ..sources.json_ingest import RESCUED, read_json_batch, read_json_stream
from ..streaming.cdc_apply import Target, refresh_target
from . import pipeline

SEQ = "_ingested_at"
TIE = ("_source_file",)


# ----------------------------------------------------------------------------------------
# batch flow on the typed feeds
# ----------------------------------------------------------------------------------------
def silver(spark: SparkSession, sf: str, entity: str) -> DataFrame:
    return clean(tt.FEEDS[entity](spark, sf), entity)


def fact_orders(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.scd1(silver(spark, sf, "orders"), "order_id", SEQ, TIE)


def fact_line_items(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.scd1(silver(spark, sf, "line_items"), "line_item_id", SEQ, TIE)


def dim_customers(spark: SparkSession, sf: str, widths: tuple[int, ...] | None = None) -> DataFrame:
    return cdc.scd2(silver(spark, sf, "customers"), "customer_id", SEQ, TIE, widths=widths)


def mv_sales_by_region_monthly(spark: SparkSession, sf: str) -> DataFrame:
    return marts.sales_by_region_monthly(fact_orders(spark, sf), dim_customers(spark, sf))


def mv_product_sales_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return marts.product_sales_metrics(fact_line_items(spark, sf), fact_orders(spark, sf))


def scd2_noop_suppressed(spark: SparkSession, sf: str) -> DataFrame:
    """Every base customer row delivered a second time later, with new metadata only:
    the history must not change."""
    feed = silver(spark, sf, "customers")
    again = feed.filter(F.col("_source_file") == "customer").withColumns(
        {SEQ: F.lit("2023-12-31 12:00:00").cast("timestamp_ntz"), "_source_file": F.lit("customer-redelivery")}
    )
    return cdc.scd2(feed.unionByName(again), "customer_id", SEQ, TIE)


LATE_SPLIT = "2024-01-16 00:00:00"


def scd2_late_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """Later events arrive first; the earlier ones (and the base rows) arrive late and are
    merged into the stored segments. The result must equal the history built in one pass."""
    feed = silver(spark, sf, "customers")
    late_cut = F.lit(LATE_SPLIT).cast("timestamp_ntz")
    first = feed.filter(F.col(SEQ) >= late_cut)
    late = feed.filter(F.col(SEQ) < late_cut)
    path = run_dir(spark, "segments")
    cdc.scd2_state(first, "customer_id", SEQ, TIE).write.parquet(path)
    return cdc.visible_scd2(cdc.scd2_merge(spark.read.parquet(path), late, "customer_id", SEQ, TIE))


SKEW_BINS = (1 << 30, 1 << 10)  # 18 minutes, 12.7 days


def skewed_customers(spark: SparkSession, sf: str) -> DataFrame:
    """The customer feed with nine in ten change events on customer 1."""
    feed = silver(spark, sf, "customers")
    moved = (F.col("_source_file") == "events") & (F.unix_timestamp(F.col(SEQ).cast("timestamp")) % 10 != 0)
    return feed.withColumn("customer_id", F.when(moved, F.lit("1")).otherwise(F.col("customer_id")))


def scd2_skewed_key(spark: SparkSession, sf: str) -> DataFrame:
    """History of a feed with one hot key, built in many bins of the sequence on two levels."""
    return cdc.scd2(skewed_customers(spark, sf), "customer_id", SEQ, TIE, widths=SKEW_BINS)


def cdc_apply_late_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """Three deliveries into both kinds of target: later events first, then earlier events and
    base rows of the same customers, then customers never seen, all of whose rows are older
    than rows applied before. A fourth run has nothing to apply. Each apply reads the new files of
    the log and the stored targets, nothing else."""
    root = run_dir(spark, "late")
    schema = f"late_{root.rsplit('-', 1)[-1]}"
    ensure_schema(spark, schema, f"{root}/db")
    feed = silver(spark, sf, "customers")
    new_key = F.col("customer_id").cast("long") % 3 == 0
    early = F.col(SEQ) < F.lit(LATE_SPLIT).cast("timestamp_ntz")
    feed = feed.withColumn("delivery", F.when(new_key, 3).when(early, 2).otherwise(1))
    targets = [
        Target(f"{schema}.{kind}", f"{root}/{kind}", ("customer_id",), kind, SEQ, (*TIE, "delivery"), buckets=8)
        for kind in ("scd1", "scd2")
    ]
    # the feed is made once; its deliveries are moved in one after the other
    feed.write.partitionBy("delivery").parquet(f"{root}/raw-staged/log")
    for d in (1, 2, 3, 4):
        deliver(spark, f"{root}/raw", "log", d)
        for t in targets:
            log = spark.readStream.schema(feed.schema).parquet(f"{root}/raw/log")
            done = refresh_target(spark, t, log, f"{root}/{t.kind}-changes")
            if done["applied"] != (d < 4):
                raise RuntimeError(f"delivery {d}: {done}")
    none = F.lit(None).cast("timestamp_ntz")
    latest = spark.table(targets[0].view).withColumns({"kind": F.lit("scd1"), cdc.START_AT: none, cdc.END_AT: none})
    return latest.unionByName(spark.table(targets[1].view).withColumn("kind", F.lit("scd2")))


def pipeline_scd2_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Customer files in four deliveries (first, second, third and all later versions of each
    customer), one refresh each: the versions of ``dim_customers`` with the deliveries that
    opened and closed them. Of several versions in one delivery the last one counts."""
    cfg = _pipeline_cfg(spark, "scd2inc")
    chain = ["bronze_customers", "silver_customers", "dim_customers"]
    ranks = ((1, 1), (2, 2), (3, 3), (4, None))
    stage_raw(spark, sf, cfg.raw, "customers", ranks)
    for number in range(1, len(ranks) + 1):
        deliver(spark, cfg.raw, "customers", number)
        pipeline.refresh(spark, cfg, only=chain)
    history = pipeline.read_dataset(spark, cfg, "dim_customers")
    stamps = pipeline.read_dataset(spark, cfg, "silver_customers").select("_ingested_at").distinct()  # four rows
    number = stamps.select(F.col("_ingested_at").alias("stamp"), F.row_number().over(Window.orderBy("_ingested_at")).alias("no"))
    opened, closed = number.select(F.col("stamp").alias("o"), F.col("no").alias("opened")), number.select(F.col("stamp").alias("c"), F.col("no").alias("closed"))
    out = history.join(opened, F.col(cdc.START_AT) == F.col("o")).join(closed, F.col(cdc.END_AT) == F.col("c"), "left")
    return out.drop(cdc.START_AT, cdc.END_AT, "o", "c")


def scd_tie_break(spark: SparkSession, sf: str) -> DataFrame:
    """Line items of two files of one batch, told apart by their names: of two rows with one key
    and sequence that of the tenth file wins over that of the ninth, then the payload decides."""
    odd = F.coalesce("quantity", F.lit(0)) % 2 != 0
    name = F.when(odd, "line_items_10.json").otherwise("line_items_9.json")
    feed = silver(spark, sf, "line_items").withColumn("_source_file", name)
    ordered = feed.withColumn(ORDER, arrival_order(feed))
    return cdc.dedup_ties(ordered, "line_item_id", SEQ, (ORDER,)).drop(ORDER)


# ----------------------------------------------------------------------------------------
# file-based flows
# ----------------------------------------------------------------------------------------
def write_raw(
    spark: SparkSession, sf: str, raw_root: str, entity: str, first_batch_only: bool | None = None,
    ranks: tuple[int, int | None] | None = None,
) -> None:
    """Render an entity as JSON files ``raw_root/entity/batch=NNN/``, one folder per rank.

    ``first_batch_only`` True writes only rank 1, False only ranks above 1, None all;
    ``ranks`` (from, to or None) writes those ranks.
    """
    if first_batch_only is not None:
        ranks = (1, 1) if first_batch_only else (2, None)
    lo, hi = ranks or (1, None)
    lines = tt.json_lines(spark, sf, entity).filter(F.col("batch") >= tt.batch_name(lo))
    if hi is not None:
        lines = lines.filter(F.col("batch") <= tt.batch_name(hi))
    _write_lines(lines, f"{raw_root}/{entity}", "batch")


FILE_LINES = 200_000  # a compressed file is not split, so it is read by one task


def _write_lines(lines: DataFrame, path: str, *by: str) -> None:
    """Compressed text files under ``path``, partitioned by ``by``, all with one time: that of their landing.

    The ranked lines are stored before they are dealt again, so the shuffles of the two are not on
    disk together. Files are written by many tasks, small ones earlier: by their own times, a later
    version would seem to have arrived before an earlier one."""
    spark = lines.sparkSession
    known = {name for name, _ in _files(spark, path)}
    kept = run_dir(spark, "lines")
    # deliveries together, large ones split by size: tasks and files grow with the input
    dealt = stored(lines, kept).hint("rebalance", "batch")
    with freed_shuffles(spark):
        dealt.write.mode("append").partitionBy(*by).option("compression", "gzip").option("maxRecordsPerFile", FILE_LINES).text(path)
    remove(spark, kept)
    landed = int(time.time() * 1000)
    for name, fs in _files(spark, path):
        if name not in known:
            fs.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), landed, -1)


def _files(spark: SparkSession, path: str) -> Iterator[tuple[str, JavaObject]]:
    """Names of the files below ``path``, with their file system."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.listFiles(folder, True) if fs.exists(folder) else None
    while found is not None and found.hasNext():
        yield found.next().getPath().toString(), fs


def stage_raw(spark: SparkSession, sf: str, raw_root: str, entity: str, ranks: tuple[tuple[int, int | None], ...] = ((1, 1), (2, None))) -> None:
    """Render an entity once for several deliveries beside ``raw_root``: the files of ranks (from,
    to or None) number i in ``delivery=i``, which :func:`deliver` moves in."""
    lines = tt.json_lines(spark, sf, entity)
    delivery = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(ranks, 1):
        met = F.col("batch") >= tt.batch_name(lo)
        met = met if hi is None else met & (F.col("batch") <= tt.batch_name(hi))
        delivery = F.coalesce(delivery, F.when(met, F.lit(i)))
    lines = lines.withColumn("delivery", delivery).filter("delivery is not null")
    _write_lines(lines, f"{raw_root}-staged/{entity}", "delivery", "batch")


def deliver(spark: SparkSession, raw_root: str, entity: str, number: int) -> None:
    """Files of a staged delivery land in ``raw_root/entity`` as a whole, by one rename."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    staged, landing = path(f"{raw_root}-staged/{entity}/delivery={number}"), path(f"{raw_root}/{entity}")
    fs = landing.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(landing)
    if fs.exists(staged) and not fs.rename(staged, path(landing, staged.getName())):
        raise RuntimeError(f"{staged} was not delivered")


def _ingest(spark: SparkSession, sf: str, entity: str) -> DataFrame:
    root = run_dir(spark, f"ingest-{entity}")
    raw = f"{root}/raw"
    out, ckpt = f"{root}/bronze", f"{root}/_checkpoint"
    stage_raw(spark, sf, raw, entity)
    # first arrival, then a second delivery of files, then a run with nothing new
    for part in (1, 2, None):
        if part is not None:
            deliver(spark, raw, entity, part)
        run_append_stream(read_json_stream(spark, f"{raw}/{entity}", SCHEMA_HINTS[entity]), out, ckpt)
    bronze = spark.read.schema(pipeline.bronze_schema(entity)).parquet(out)
    # lineage in a form that does not depend on the clock or the folder: which delivery stamped
    # the row, whether its file is one of the first delivery, and whether the file has a time
    stamps = bronze.select("_ingested_at").distinct()  # one row per delivery
    stamps = stamps.select(
        F.col("_ingested_at").alias("stamp"), F.row_number().over(Window.orderBy("_ingested_at")).alias("delivery"),
    )
    folder = F.regexp_extract("_source_file", "batch=([0-9]+)/", 1)
    # each stamp is that of a large part of the rows: joined by shuffle, a delivery would be one task
    return bronze.join(F.broadcast(stamps), F.col("_ingested_at") == F.col("stamp")).select(
        *tt.TYPED[entity], RESCUED, "delivery", (folder == tt.batch_name(1)).alias("first_file"),
        F.col("_source_file_modified_at").isNotNull().alias("has_file_time"),
    )


def ingest_bounded_batches(spark: SparkSession, sf: str) -> DataFrame:
    """A backlog of line-item files taken in batches of at most a quarter of its bytes; files of
    finished batches are archived. Every row arrives once."""
    root = run_dir(spark, "bounded")
    write_raw(spark, sf, f"{root}/raw", "line_items")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{root}/raw/line_items")
    size = files.agg(F.sum("length")).first()[0]
    stream = read_json_stream(
        spark, f"{root}/raw/line_items", SCHEMA_HINTS["line_items"], max_bytes_per_trigger=-(-(size or 1) // 4), archive_dir=f"{root}/archive",
    )
    taken = run_append_stream(stream, f"{root}/bronze", f"{root}/_checkpoint")
    bronze = spark.read.schema(pipeline.bronze_schema("line_items")).parquet(f"{root}/bronze")
    return bronze.select(*tt.TYPED["line_items"], RESCUED, F.lit(taken["batches"] > 1).alias("in_several_batches"))


def ingest_rescued_data(spark: SparkSession, sf: str) -> DataFrame:
    root = run_dir(spark, "rescue")
    write_raw_all(spark, sf, f"{root}/raw")
    parts = []
    for entity in ("customers", "orders", "line_items"):
        df = read_json_batch(spark, f"{root}/raw/{entity}", SCHEMA_HINTS[entity])
        parts.append(
            df.select(F.lit(entity).alias("entity"), F.col(tt.KEYS[entity]).alias("record_key"), RESCUED)
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def stream_incremental_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze and silver append streams over two deliveries of line-item files."""
    cfg = PipelineConfig(root=run_dir(spark, "stream"), bronze_schema="b", silver_schema="s", gold_schema="g")
    only = ["bronze_line_items", "silver_line_items"]
    stage_raw(spark, sf, cfg.raw, "line_items")
    deliver(spark, cfg.raw, "line_items", 1)
    pipeline.refresh(spark, cfg, only=only)
    deliver(spark, cfg.raw, "line_items", 2)
    pipeline.refresh(spark, cfg, only=only)
    pipeline.refresh(spark, cfg, only=only)  # nothing new: no change
    return pipeline.read_dataset(spark, cfg, "silver_line_items").drop("_ingested_at", "_source_file")


def clustered_write(spark: SparkSession, sf: str) -> DataFrame:
    path = f"{run_dir(spark, 'clustered')}/silver_line_items"
    write_clustered(silver(spark, sf, "line_items"), path, ["line_item_id"])
    return spark.read.parquet(path)


def clustered_tables(spark: SparkSession, sf: str) -> DataFrame:
    """The nine clustered datasets after two deliveries of line items: rows, lowest and highest
    key, whether there are 4 files at least, and whether the files that were written together (a
    run of an append table, a bucket of a target) have disjoint key ranges."""
    cfg = _pipeline_cfg(spark, "clustered")
    write_raw_all(spark, sf, cfg.raw, ("customers", "orders"))
    stage_raw(spark, sf, cfg.raw, "line_items")
    for part in (1, 2):
        deliver(spark, cfg.raw, "line_items", part)
        pipeline.refresh(spark, cfg, only=[d.name for d in pipeline.DATASETS if d.cluster_by])
        pipeline.recluster(spark, cfg)
    return pipeline.cluster_report(spark, cfg)


def _pipeline_cfg(spark: SparkSession, label: str) -> PipelineConfig:
    root = run_dir(spark, label)
    tag = root.rsplit("-", 1)[-1]
    return PipelineConfig.for_target(root).with_(
        bronze_schema=f"bronze_{tag}", silver_schema=f"silver_{tag}", gold_schema=f"gold_{tag}"
    )


def write_raw_all(spark: SparkSession, sf: str, raw_root: str, entities=("customers", "orders", "line_items")) -> None:
    """Render several entities, one after the other: their shuffles are not on disk together."""
    for e in entities:
        write_raw(spark, sf, raw_root, e)


def _full_pipeline(spark: SparkSession, sf: str, label: str) -> PipelineConfig:
    cfg = _pipeline_cfg(spark, label)
    write_raw_all(spark, sf, cfg.raw)
    pipeline.refresh(spark, cfg)
    return cfg


def pipeline_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _full_pipeline(spark, sf, "e2e")
    return pipeline.read_dataset(spark, cfg, "gold_sales_by_region_monthly")


def dataset_catalog(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _full_pipeline(spark, sf, "catalog")
    return pipeline.catalog_frame(spark, cfg)


SELECTIVE = ["bronze_line_items", "silver_line_items", "fact_line_items", "gold_product_sales_metrics"]


def pipeline_selective_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """Full refresh with the first line-item delivery, then the rest of the line items
    arrive and only the line-item chain and the product mart are refreshed."""
    cfg = _pipeline_cfg(spark, "selective")
    write_raw_all(spark, sf, cfg.raw, ("customers", "orders"))
    stage_raw(spark, sf, cfg.raw, "line_items")
    deliver(spark, cfg.raw, "line_items", 1)
    pipeline.refresh(spark, cfg)
    deliver(spark, cfg.raw, "line_items", 2)
    pipeline.refresh(spark, cfg, only=SELECTIVE)
    return pipeline.read_dataset(spark, cfg, "gold_product_sales_metrics")


# ----------------------------------------------------------------------------------------
# registry
# ----------------------------------------------------------------------------------------
def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "ingest_json_customers": lambda s, d: _ingest(s, d, "customers"),
        "ingest_json_orders": lambda s, d: _ingest(s, d, "orders"),
        "ingest_json_line_items": lambda s, d: _ingest(s, d, "line_items"),
        "ingest_rescued_data": ingest_rescued_data,
        "ingest_bounded_batches": ingest_bounded_batches,
        "stream_incremental_silver": stream_incremental_silver,
        "dataset_catalog": dataset_catalog,
        "clustered_write": clustered_write,
        "clustered_tables": clustered_tables,
        "silver_customers": lambda s, d: silver(s, d, "customers"),
        "silver_orders": lambda s, d: silver(s, d, "orders"),
        "silver_line_items": lambda s, d: silver(s, d, "line_items"),
        "scd1_orders": fact_orders,
        "scd1_line_items": fact_line_items,
        "scd2_history": dim_customers,
        "scd2_current_rows": lambda s, d: cdc.current_rows(dim_customers(s, d)),
        "scd2_noop_suppressed": scd2_noop_suppressed,
        "scd2_late_arrival": scd2_late_arrival,
        "scd2_skewed_key": scd2_skewed_key,
        "cdc_apply_late_arrival": cdc_apply_late_arrival,
        "pipeline_scd2_incremental": pipeline_scd2_incremental,
        "scd_tie_break": scd_tie_break,
        "join_orders_current_customers": lambda s, d: marts.join_orders_current_customers(
            fact_orders(s, d), dim_customers(s, d)
        ),
        "join_line_items_orders": lambda s, d: marts.join_line_items_orders(fact_line_items(s, d), fact_orders(s, d)),
        "agg_count_distinct": lambda s, d: marts.distinct_orders_per_product(fact_line_items(s, d)),
        "agg_conditional": lambda s, d: marts.revenue_by_status_monthly(fact_orders(s, d)),
        "agg_conditional_distinct": lambda s, d: marts.status_distinct_orders_per_product(
            fact_line_items(s, d), fact_orders(s, d)
        ),
        "mv_sales_by_region_monthly": mv_sales_by_region_monthly,
        "mv_product_sales_metrics": mv_product_sales_metrics,
        "pipeline_end_to_end": pipeline_end_to_end,
        "pipeline_selective_refresh": pipeline_selective_refresh,
    }
