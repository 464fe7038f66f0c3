"""Parquet tables in versions: readers follow a pointer, so compaction and vacuum leave no gap.

A table is a folder with one folder for each version and a small file that names the current one.  A new
version is written beside the old one and then named by replacing that file, which the file system does
in one step; a run that fails before leaves the old version current.  Old versions stay, for readers that
have begun on them, until ``vacuum`` finds them unused for long enough.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quantsilo.plans.joins import broadcast_if_small

POINTER = "CURRENT"
TARGET_BYTES = 128 << 20


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def current(spark: SparkSession, base: str) -> str | None:
    """The folder of the current version, or None if the table has none yet."""
    p, fs = _fs(spark, f"{base}/{POINTER}")
    if not fs.exists(p):
        return None
    return f"{base}/{spark.read.text(str(p)).first()[0]}"


def read(spark: SparkSession, base: str) -> DataFrame:
    folder = current(spark, base)
    if folder is None:
        raise FileNotFoundError(f"{base} has no version")
    return spark.read.parquet(folder)


def publish(spark: SparkSession, base: str, name: str) -> None:
    """Make a version current: the pointer is written aside and moved over the old one."""
    jvm = spark._jvm
    aside, fs = _fs(spark, f"{base}/{POINTER}.{uuid.uuid4().hex}")
    out = fs.create(aside, True)
    out.write(bytearray(name.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
        aside, jvm.org.apache.hadoop.fs.Path(f"{base}/{POINTER}"), options)


def write(df: DataFrame, base: str, partition_by: tuple = ()) -> str:
    """Write ``df`` as the table's next version and make it current; returns the version's folder."""
    name = f"v-{time.time_ns()}"
    w = df.write.mode("errorifexists")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{base}/{name}")
    publish(df.sparkSession, base, name)
    return f"{base}/{name}"


def files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, dir, bytes) of the data files of a version that hold rows, from the file metadata."""
    meta = spark.read.parquet(folder).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes"))
    return meta.distinct().withColumn("dir", F.regexp_replace("path", "/[^/]*$", ""))


def bins(found: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Files with a bin: in each partition folder, by name, cut where the bytes before pass another ``target_bytes``."""
    w = Window.partitionBy("dir").orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("bytes").over(w), F.lit(0))
    return found.withColumn("bin", F.floor(before / target_bytes).cast("long"))


def compact(spark: SparkSession, base: str, partition_by: tuple = (), target_bytes: int = TARGET_BYTES,
            sort_by: tuple = ()) -> str:
    """Rewrite the current version in files of about ``target_bytes``, and make that current.

    Rows of a bin's files go to one file; a partition folder of many bins is written by as many tasks.
    Returns the new version's folder.
    """
    folder = current(spark, base)
    if folder is None:
        raise FileNotFoundError(f"{base} has no version")
    # bins are numbered over the list of files, a row each, so that every bin is one task and one file
    placed = (bins(files(spark, folder), target_bytes)
              .select("path", (F.dense_rank().over(Window.orderBy("dir", "bin")) - 1).alias("_task")))
    tasks = (placed.agg(F.max("_task")).first()[0] or 0) + 1
    rows = spark.read.parquet(folder)
    columns = rows.columns
    rows = rows.withColumn("_path", F.col("_metadata.file_path"))
    out = rows.join(broadcast_if_small(placed), rows["_path"] == placed["path"]).repartitionById(tasks, "_task")
    return write(out.sortWithinPartitions(*partition_by, *sort_by).select(*columns) if partition_by or sort_by
                 else out.select(*columns), base, tuple(partition_by))


def vacuum(spark: SparkSession, base: str, older_than_seconds: float = 7 * 86400) -> list[str]:
    """Delete versions that are not current and were last written longer ago than that; returns their names."""
    p, fs = _fs(spark, base)
    now, keep, gone = time.time(), current(spark, base), []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith("v-") and not (keep or "").endswith(f"/{name}") \
                and now - s.getModificationTime() / 1000 > older_than_seconds:
            fs.delete(s.getPath(), True)
            gone.append(name)
    return sorted(gone)
