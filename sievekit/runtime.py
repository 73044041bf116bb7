"""Shared folders, stored tables and code shipping."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir; where that is unset, a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="sievekit"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/sievekit-{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write df as Parquet in a shared folder and read it back: lineage ends here."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, out: str, order: list[Column], by: list[str] | None = None) -> DataFrame:
    """df with out, the row's number from 1 in ``order``, within each group of ``by`` if given.

    Rows are dealt in ranges of (by, order) and written; each range counts its rows by group,
    and a row's number is its place in its range plus the counts of the ranges before. No task
    sees a whole group or table, however large.
    """
    groups = by or []
    ranged = df.repartitionByRange(*groups, *order).withColumn("__range", F.spark_partition_id())
    ranged = stored(ranged, f"{shared_dir(df.sparkSession)}/ranged")
    counts = ranged.groupBy(*groups, "__range").agg(F.count("*").alias("__count"))
    # a row for each range, and for each further group in it
    before = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*[F.col(g).alias(f"__by_{g}") for g in groups], F.col("__range").alias("__of"), F.coalesce(F.sum("__count").over(before), F.lit(0)).alias("__before"))
    same = F.col("__range") == F.col("__of")
    for g in groups:
        same = same & F.col(g).eqNullSafe(F.col(f"__by_{g}"))
    place = F.row_number().over(Window.partitionBy(*groups, "__range").orderBy(*order))
    rows = ranged.withColumn("__place", place).join(offsets, same)
    return rows.withColumn(out, F.col("__place") + F.col("__before")).select(*[c for c in df.columns if c != out], out)


def ship(spark: SparkSession) -> None:
    """Send the library's modules to the Python workers, once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_sievekit_core_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as z:
        for folder, _, names in os.walk(here):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(full := os.path.join(folder, name), os.path.relpath(full, os.path.dirname(here)))
    from pyarrow import fs

    folder = shared_dir(spark)
    uri = folder if "://" in folder else "file://" + folder.removeprefix("file:")
    system, path = fs.FileSystem.from_uri(uri)
    system.create_dir(path, recursive=True)
    with system.open_output_stream(f"{path}/sievekit_core.zip") as out:
        out.write(packed.getvalue())
    sc.addPyFile(f"{folder}/sievekit_core.zip")
    sc._sievekit_core_shipped = True
