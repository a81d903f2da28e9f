"""Ingest that reads only files it has not read yet and rewrites only the months they touch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from agoralens.sources.scratch import stored

MANIFEST = "path string, size long, modified timestamp, run int"
SOURCE = "_source"


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def files_in(spark: SparkSession, source: str, pattern: str = "*.parquet") -> DataFrame:
    """`path`, `size` and `modified` of the files under a folder. Contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(source)
    return listed.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def read_so_far(spark: SparkSession, manifest: str) -> DataFrame:
    """The last entry of every file that an earlier run has read."""
    if not _exists(spark, manifest):
        return spark.createDataFrame([], MANIFEST)
    rows = spark.read.schema(MANIFEST).parquet(manifest)
    return rows.groupBy("path").agg(F.max_by(F.struct("size", "modified", "run"), "run").alias("last")).select("path", "last.*")


def fresh_files(spark: SparkSession, source: str, manifest: str, pattern: str = "*.parquet") -> DataFrame:
    """Files that are new, or whose size or time is not the one in the manifest."""
    known = read_so_far(spark, manifest).select("path", "size", "modified")
    return files_in(spark, source, pattern).join(known, ["path", "size", "modified"], "left_anti")


def ingest_new(
    spark: SparkSession,
    source: str,
    target: str,
    manifest: str,
    created: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda df: df,
    *,
    pattern: str = "*.parquet",
) -> list[str]:
    """Bring a `yyyy=/mm=` partitioned Parquet table up to date with a folder of Parquet files; returns
    the paths of the files that were read.

    New and changed files are read and `prepare`d; `created` (of the prepared rows) gives the month, and
    rows without a time go to the partition without a month. Every row keeps the file it came from, so
    that rows of a changed file, and of a run that failed before its manifest entry was written, are
    replaced instead of doubled. Only months that the files' old and new rows are in are read and
    written again (dynamic partition overwrite); all others stay as they are. Files that vanish keep
    their rows. The manifest entry is written last.
    """
    fresh = stored(fresh_files(spark, source, manifest, pattern), "fresh")
    # The reader needs the paths of what it reads on the driver, as it does for any list of files.
    paths = sorted(row["path"] for row in fresh.select("path").collect())
    if not paths:
        return []
    rows = spark.read.parquet(*paths).withColumn(SOURCE, F.col("_metadata.file_path"))
    month = {"yyyy": F.year(created), "mm": F.month(created)}
    rows = stored(prepare(rows).withColumns(month), "rows")
    touched = rows.select("yyyy", "mm").distinct()
    names = rows.select(SOURCE).distinct()
    if _exists(spark, target):
        there = spark.read.schema(rows.schema).parquet(target)
        replaced = there.join(F.broadcast(names), SOURCE).select("yyyy", "mm").distinct()
        touched = stored(touched.union(replaced).distinct(), "months")
        same = there["yyyy"].eqNullSafe(F.col("_y")) & there["mm"].eqNullSafe(F.col("_m"))
        months = F.broadcast(touched.select(F.col("yyyy").alias("_y"), F.col("mm").alias("_m")))
        kept = there.join(months, same, "left_semi").join(F.broadcast(names), SOURCE, "left_anti")
        # Stored, since a table cannot be read while it is overwritten.
        rows = stored(kept.select(rows.columns).unionByName(rows), "months")
        emptied = touched.join(rows.select("yyyy", "mm").distinct(), ["yyyy", "mm"], "left_anti").dropna()
        _drop_months(spark, target, emptied)
    writer = rows.repartition("yyyy", "mm", F.pmod(F.xxhash64(SOURCE), F.lit(16))).write.mode("overwrite")
    writer.option("partitionOverwriteMode", "dynamic").partitionBy("yyyy", "mm").parquet(target)
    runs = read_so_far(spark, manifest).agg(F.max("run")).first()[0]
    entry = fresh.withColumn("run", F.lit(0 if runs is None else runs + 1))
    entry.coalesce(1).write.mode("append").parquet(manifest)
    return paths


def _drop_months(spark: SparkSession, target: str, months: DataFrame) -> None:
    """Delete months that no row is left in; dynamic overwriting leaves them alone."""
    for row in months.collect():
        folder = f"{target.rstrip('/')}/yyyy={row['yyyy']}/mm={row['mm']}"
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
