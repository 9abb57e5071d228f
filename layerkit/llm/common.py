"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import run_dir

# the word rule of every operator here: runs of anything but ASCII white space
WORD = r"[^\x20\x09-\x0D]+"
SPACES = "\t\n\u000b\f\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below ``spark.checkpoint.dir`` and read back.

    Cuts the lineage: what follows never recomputes ``df``, also after a lost executor,
    and every reader sees the same rows.
    """
    spark = df.sparkSession
    path = run_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """``df`` with a column ``name`` that is computed once per row.

    A filter on a projected column moves below the projection with a copy of its expression; it
    does not move below a generator."""
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def words_of(text: Column) -> Column:
    """Words of a text as an array (null text: no word)."""
    flat = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.array_remove(F.split(flat, " "), "")


def byte_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first variant of it that is no column of ``df`` (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"{name}_"
    return name


def ship(df: DataFrame) -> DataFrame:
    """``df``, after making sure that Python workers can import this package.

    The package's sources go to the workers once per application, as any job's own modules
    do (``addPyFile``)."""
    context = df.sparkSession.sparkContext
    if not getattr(context, "_layerkit_shipped", False):
        root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        target = os.path.join(tempfile.mkdtemp(), "layerkit-sources.zip")
        with zipfile.ZipFile(target, "w") as z:
            for folder, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, os.path.dirname(root)))
        context.addPyFile(target)
        context._layerkit_shipped = True
    return df
