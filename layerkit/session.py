"""Session helpers: building a local session for tests/bench and locating shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "layerkit") -> SparkSession:
    """Session for tests and the bench. A cluster job would get its session from the launcher."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("LAYERKIT_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.schemaInference", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session (one machine, as in tests) gets one of its own where none is set: on a
    cluster, a folder of the driver is not one that executors see.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="layerkit-ckpt-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint root for one run."""
    return f"{checkpoint_root(spark)}/layerkit-runs/{label}-{uuid.uuid4().hex[:12]}"


FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Jobs in here remove their shuffle files when they end. Else the files stay until the driver
    happens to collect its garbage, and steps that run one after the other add up on disk.

    For jobs whose result is written; a DataFrame that is run again makes its shuffles again."""
    before = spark.conf.get(FREED, "false")
    spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(FREED, before)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back: what made it is a job of its own, whose shuffles are gone."""
    spark = df.sparkSession
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate rows that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
