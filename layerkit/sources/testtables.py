"""The shared test tables mapped to the retail shape of the pipeline.

``customer``/``nation``/``region`` -> customers, ``events`` -> customer tier changes,
``orders`` -> orders, ``lineitem``/``part`` -> line items. ``(l_orderkey, l_linenumber)`` is not
unique in ``lineitem``, which makes it a natural re-delivery feed.

Rows are made dirty by fixed key rules so every cleaning and validity branch is
exercised. The SQL oracle spells the same rules (see ``plans/oracle.py``); change both
together.

Two shapes are produced:

* *typed feeds*: what bronze holds after ingest (hinted columns) plus ``_ingested_at`` and
  ``_source_file`` taken from the source tables, so the batch flow has a real sequence;
* *raw JSON lines*: the same rows rendered as JSON with extra dirt that only ingest can see
  (a wrong-case key, a field outside the hints, text where a number is pinned, an invalid
  date), written as files for the streaming flow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import SILVER_COLUMNS
from ..operators.ranking import rank_within_key
from ..session import run_dir, stored

# --- fixed values of the fixture rules -----------------------------------------------------
CUSTOMER_BASE_SEQ = "2023-12-31 00:00:00"  # base version of every customer, before all events
EMAIL_DOMAIN = "@SHOP.TEST"
ORDER_STATUS_TEXT = {"O": " delivered", "F": "Shipped ", "P": "pending"}
BAD_AMOUNT_TEXT = "n/a"
BAD_DATE_TEXT = "2024-02-30"
BAD_QUANTITY_JSON = "2.5"
RANK_BINS = (1 << 44,)  # 200 days: most keys have one or a few bins
TEXT_AFTER = ' {"note":"resent"}'
SENT_TWICE = '{"region":"UNKNOWN",'


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _m(c: Column | str, mod: int, rem: int) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return (c % F.lit(mod)) == F.lit(rem)


# ------------------------------------------------------------------------------------------
# customers
# ------------------------------------------------------------------------------------------
def _customer_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    base_email = F.concat(F.upper(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit(EMAIL_DOMAIN))
    name = (
        F.when(_m(k, 97, 13), F.lit(None).cast("string"))
        .when(_m(k, 89, 17), F.lit("   "))
        .when(_m(k, 5, 0), F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")))
        .otherwise(F.col("c_name"))
    )
    email = (
        F.when(_m(k, 31, 3), F.lit(None).cast("string"))  # sent under the key "Email"
        .when(_m(k, 83, 19), F.lit(None).cast("string"))
        .when(_m(k, 79, 23), F.lit(""))
        .when(_m(k, 3, 1), F.concat(F.lit(" "), base_email, F.lit(" ")))
        .otherwise(base_email)
    )
    tier = F.when(_m(k, 7, 2), F.concat(F.col("c_mktsegment"), F.lit(" "))).otherwise(F.col("c_mktsegment"))
    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            k.alias("__k"),
            k.cast("string").alias("customer_id"),
            name.alias("name"),
            email.alias("email"),
            tier.alias("membership_level"),
            F.col("r_name").alias("region"),
            base_email.alias("__email_raw"),
        )
    )


def customers_feed(spark: SparkSession, sf_dir: str, keep_helpers: bool = False) -> DataFrame:
    """Typed customer change rows: one base version per customer plus one row per event,
    whose ``event_type`` becomes the membership tier (SCD2 feed)."""
    base = _customer_base(spark, sf_dir)
    ev = table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    cols = ["customer_id", "name", "email", "membership_level", "region"]
    first = base.select(
        "__k",
        *cols,
        F.lit(CUSTOMER_BASE_SEQ).cast("timestamp_ntz").alias("_ingested_at"),
        F.lit("customer").alias("_source_file"),
        "__email_raw",
    )
    changes = ev.join(base, ev.user_id == base.__k).select(
        "__k",
        "customer_id",
        "name",
        "email",
        F.col("event_type").alias("membership_level"),
        "region",
        F.col("ts").alias("_ingested_at"),
        F.lit("events").alias("_source_file"),
        "__email_raw",
    )
    out = first.unionByName(changes)
    return out if keep_helpers else out.drop("__k", "__email_raw")


# ------------------------------------------------------------------------------------------
# orders
# ------------------------------------------------------------------------------------------
def orders_feed(spark: SparkSession, sf_dir: str, keep_helpers: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    k = F.col("o_orderkey")
    st = F.col("o_orderstatus")
    out = o.select(
        k.alias("__k"),
        F.when(_m(k, 211, 47), F.lit(None).cast("string")).otherwise(k.cast("string")).alias("order_id"),
        F.when(_m(k, 103, 29), F.lit(None).cast("string")).otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(_m(k, 107, 31), F.lit(None).cast("date")).otherwise(F.col("o_orderdate").cast("date")).alias("order_date"),
        F.when(_m(k, 37, 6), F.lit(None).cast("double"))  # sent as text
        .when(_m(k, 89, 37), -F.col("o_totalprice"))
        .when(_m(k, 113, 41), F.lit(0.0))
        .otherwise(F.col("o_totalprice"))
        .alias("total_amount"),
        F.when(_m(k, 53, 43), F.lit(None).cast("string"))
        .when(st == "O", F.lit(ORDER_STATUS_TEXT["O"]))
        .when(st == "F", F.lit(ORDER_STATUS_TEXT["F"]))
        .otherwise(F.lit(ORDER_STATUS_TEXT["P"]))
        .alias("status"),
        F.col("o_orderdate").alias("_ingested_at"),
        F.lit("orders").alias("_source_file"),
    )
    return out if keep_helpers else out.drop("__k")


# ------------------------------------------------------------------------------------------
# line items
# ------------------------------------------------------------------------------------------
def line_items_feed(spark: SparkSession, sf_dir: str, keep_helpers: bool = False) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate"
    )
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    k = F.col("l_orderkey") + F.col("l_linenumber")
    pk = F.col("l_partkey")
    qty = F.col("l_quantity").cast("int")
    price = F.col("l_extendedprice") / F.col("l_quantity")
    out = li.join(p, li.l_partkey == p.p_partkey).select(
        k.alias("__k"),
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string")).alias("line_item_id"),
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.when(_m(pk, 59, 7), F.lit(" "))
        .when(_m(pk, 61, 11), F.lit(None).cast("string"))
        .when(_m(pk, 4, 1), F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")))
        .otherwise(F.col("p_name"))
        .alias("product_name"),
        F.when(_m(k, 41, 3), F.lit(None).cast("int"))  # sent as a fraction
        .when(_m(k, 67, 5), F.lit(0))
        .when(_m(k, 71, 9), -qty)
        .otherwise(qty)
        .alias("quantity"),
        F.when(_m(k, 73, 15), -price).when(_m(k, 79, 21), F.lit(0.0)).otherwise(price).alias("unit_price"),
        F.col("l_shipdate").alias("_ingested_at"),
        F.lit("lineitem").alias("_source_file"),
    )
    return out if keep_helpers else out.drop("__k")


FEEDS = {"customers": customers_feed, "orders": orders_feed, "line_items": line_items_feed}
TYPED = {
    "customers": ["customer_id", "name", "email", "membership_level", "region"],
    "orders": ["order_id", "customer_id", "order_date", "total_amount", "status"],
    "line_items": ["line_item_id", "order_id", "product_name", "quantity", "unit_price"],
}
KEYS = {"customers": "customer_id", "orders": "order_id", "line_items": "line_item_id"}


# ------------------------------------------------------------------------------------------
# raw JSON rendering
# ------------------------------------------------------------------------------------------
def _append_field(j: Column, name: str, value: Column) -> Column:
    return F.concat(F.expr("substring(__j, 1, length(__j) - 1)"), F.lit(f',"{name}":"'), value, F.lit('"}'))


BATCH_FORMAT = "%012d"


def batch_name(rank: int) -> str:
    """Folder name of an arrival rank: names order as ranks do."""
    return BATCH_FORMAT % rank


def _ranked(feed: DataFrame, entity: str) -> DataFrame:
    """``feed`` with its arrival rank in ``__rank``: sequence, then the cleaned payload (same order as
    the CDC tie-break).

    Rows without a key are kept (ingest must see them) and all arrive in the first
    delivery: silver drops them, so they need no order, and ranking them would put every
    one of them into a single window group (one task, one folder per row)."""
    key = KEYS[entity]
    cleaned = SILVER_COLUMNS[entity]()
    names = feed.select(*cleaned).columns
    payload = [c for c, name in zip(cleaned, names, strict=True) if name != key]
    spark = feed.sparkSession
    keyed = rank_within_key(
        feed.filter(F.col(key).isNotNull()), [key], ["_ingested_at", *payload], widths=RANK_BINS,
        keep=lambda offsets: stored(offsets, run_dir(spark, f"ranks-{entity}")),
    )
    keyless = feed.filter(F.col(key).isNull()).withColumn("__rank", F.lit(1).cast("long"))
    return keyed.unionByName(keyless)


def json_lines(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """``(batch, value)``: one JSON object per line; ``batch`` is a zero-padded arrival rank.

    Versions of one key get increasing ranks in sequence order (payload order on ties), so
    files in later batch folders carry later versions. The rank is a window per key; it
    only lays out test input. Rows are shuffled as the feed has them; the cleaned payload and the
    text are made behind the shuffle.
    """
    df = _ranked(FEEDS[entity](spark, sf_dir, keep_helpers=True).drop("_source_file"), entity)
    typed = TYPED[entity]
    j = F.to_json(F.struct(*typed), {"ignoreNullFields": "false"})
    df = df.withColumn("__j", j)
    k = F.col("__k")
    jc = F.col("__j")
    if entity == "customers":
        jc = F.when(
            _m(k, 31, 3),
            F.replace(jc, F.lit('"email":null'), F.concat(F.lit('"Email":"'), F.col("__email_raw"), F.lit('"'))),
        ).otherwise(jc)
        df = df.withColumn("__j", jc)
        df = df.withColumn(
            "__j", F.when(_m(k, 31, 5), _append_field(jc, "loyalty_code", F.concat(F.lit("L"), k.cast("string")))).otherwise(F.col("__j"))
        )
        # text after the object, and a key sent twice (the last one counts)
        jc = F.col("__j")
        df = df.withColumn(
            "__j",
            F.when(_m(k, 31, 9), F.concat(jc, F.lit(TEXT_AFTER)))
            .when(_m(k, 31, 11), F.concat(F.lit(SENT_TWICE), F.expr("substring(__j, 2)")))
            .otherwise(jc),
        )
    elif entity == "orders":
        jc = F.when(_m(k, 107, 31), F.replace(jc, F.lit('"order_date":null'), F.lit(f'"order_date":"{BAD_DATE_TEXT}"'))).otherwise(jc)
        jc = F.when(_m(k, 37, 6), F.replace(jc, F.lit('"total_amount":null'), F.lit(f'"total_amount":"{BAD_AMOUNT_TEXT}"'))).otherwise(jc)
        df = df.withColumn("__j", jc)
        df = df.withColumn(
            "__j", F.when(_m(k, 37, 9), _append_field(F.col("__j"), "coupon", F.concat(F.lit("C"), k.cast("string")))).otherwise(F.col("__j"))
        )
    else:
        jc = F.when(_m(k, 41, 3), F.replace(jc, F.lit('"quantity":null'), F.lit(f'"quantity":{BAD_QUANTITY_JSON}'))).otherwise(jc)
        df = df.withColumn("__j", jc)
        df = df.withColumn(
            "__j", F.when(_m(k, 43, 7), _append_field(F.col("__j"), "gift_wrap", F.lit("yes"))).otherwise(F.col("__j"))
        )

    return df.select(F.format_string(BATCH_FORMAT, F.col("__rank").cast("long")).alias("batch"), F.col("__j").alias("value"))
