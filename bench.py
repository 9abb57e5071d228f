"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints ONE JSON line.

Every query is executed in full with the ``noop`` sink (no driver collect). Ingest is timed
separately from rendering its JSON input so rows/s reflects the streaming read only.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from layerkit.config import SCHEMA_HINTS  # noqa: E402
from layerkit.plans import queries as Q  # noqa: E402
from layerkit.session import build_session, run_dir  # noqa: E402
from layerkit.sinks.tables import ensure_schema, run_append_stream  # noqa: E402
from layerkit.sources.json_ingest import read_json_stream  # noqa: E402
from layerkit.streaming.cdc_apply import Target, apply_changes  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

HEADLINE = [
    "mv_sales_by_region_monthly",
    "mv_product_sales_metrics",
    "scd1_line_items",
    "scd2_history",
    "silver_line_items",
    "scd2_late_arrival",
]


def run_noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus), app="layerkit-bench")
    qs = Q.queries()

    # warm-up: JVM, parquet footers, codegen caches
    run_noop(qs["silver_orders"](spark, sf_dir))

    # each headline query twice: the first run pays JIT / codegen compilation, the second
    # is the steady state a long-running cluster job sees; both are reported
    cold: dict[str, float] = {}
    times: dict[str, float] = {}
    for name in HEADLINE:
        for bucket in (cold, times):
            t0 = time.perf_counter()
            run_noop(qs[name](spark, sf_dir))
            bucket[name] = round(time.perf_counter() - t0, 3)

    # streaming JSON ingest of line items (render files first, untimed)
    root = run_dir(spark, "bench-ingest")
    Q.write_raw(spark, sf_dir, f"{root}/raw", "line_items")
    t0 = time.perf_counter()
    stats = run_append_stream(
        read_json_stream(spark, f"{root}/raw/line_items", SCHEMA_HINTS["line_items"]), f"{root}/bronze", f"{root}/ckpt"
    )
    times["ingest_json_line_items"] = round(time.perf_counter() - t0, 3)
    rows = stats["rows"]

    # whole pipeline from JSON to both marts (files rendered inside, so timed end to end)
    t0 = time.perf_counter()
    run_noop(qs["pipeline_end_to_end"](spark, sf_dir))
    times["pipeline_end_to_end"] = round(time.perf_counter() - t0, 3)

    # a second delivery merged into stored targets (the first is untimed)
    extra: dict[str, float] = {}
    early = F.col("_ingested_at") < F.lit("1996-01-01").cast("timestamp_ntz")
    late = F.col("_ingested_at") >= F.lit(Q.LATE_SPLIT).cast("timestamp_ntz")
    for kind, entity, first in (("scd1", "line_items", early), ("scd2", "customers", late)):
        target_dir = run_dir(spark, f"bench-{kind}")
        schema = f"bench_{kind}_{target_dir.rsplit('-', 1)[-1]}"
        ensure_schema(spark, schema, f"{target_dir}/db")
        feed = Q.silver(spark, sf_dir, entity)
        for name, part in (("first", feed.filter(first)), ("second", feed.filter(~first))):
            part.write.parquet(f"{target_dir}/{name}")
        target = Target(f"{schema}.t", f"{target_dir}/t", (entity[:-1] + "_id",), kind, "_ingested_at", ("_source_file",))
        apply_changes(spark, target, spark.read.parquet(f"{target_dir}/first"))
        t0 = time.perf_counter()
        apply_changes(spark, target, spark.read.parquet(f"{target_dir}/second"))
        extra[f"{kind}_incremental_merge"] = round(time.perf_counter() - t0, 3)

    sf = os.path.basename(sf_dir).replace("sf", "")
    out = {
        "metric": "total_sec_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "method": "second run of each headline query (noop sink); ingest and pipeline are single runs",
        "queries": times,
        "queries_cold": cold,
        "extra_not_in_total": extra,
        "ingest_rows_per_sec": round(rows / times["ingest_json_line_items"], 1) if rows else 0.0,
        "ingest_rows": rows,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "shuffle_partitions": int(spark.conf.get("spark.sql.shuffle.partitions")),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
