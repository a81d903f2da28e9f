"""Readers and writers for tables, lexicons and reports."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from agoralens.sources.schemas import LEXICON, require_columns


def read_table(
    spark: SparkSession,
    paths: str | Sequence[str],
    contract: T.StructType | None = None,
    *,
    fmt: str = "parquet",
    schema: T.StructType | None = None,
    merge_schema: bool = False,
    **options: str,
) -> DataFrame:
    """Scan one directory, a glob or a list of paths.

    `merge_schema` unions the footers of files written with different column sets. `options` go to
    the reader as they are (`recursiveFileLookup`, `pathGlobFilter`, `modifiedAfter`, `header` ...).
    """
    reader = spark.read.format(fmt).options(**options)
    if merge_schema:
        reader = reader.option("mergeSchema", "true")
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load([paths] if isinstance(paths, str) else list(paths))
    return df if contract is None else require_columns(df, contract)


def spread_few_files(df: DataFrame, key: str) -> DataFrame:
    """Hash a table that is scanned in fewer pieces than there are cores over the cores.

    For tables about to get heavy per-row work. A table large enough to occupy the cores comes
    back as it is, without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df


def read_table_stream(
    spark: SparkSession, path: str, schema: T.StructType, *, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Stream the files under `path`, which may be a directory, a glob or a single file."""
    # A bare file is refused as a stream source; a one-character class turns it into a glob.
    if not any(c in path for c in "*?[{"):
        path = f"{path[:-1]}[{path[-1]}]"
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def monthly_paths(template: str, months: Iterable[tuple[int, int]]) -> list[str]:
    """Fill `{year}` and `{month}` (format it as `{month:02d}`) for each (year, month)."""
    return [template.format(year=year, month=month) for year, month in months]


def read_months(
    spark: SparkSession, root: str, first: tuple[int, int], last: tuple[int, int]
) -> DataFrame:
    """Read a `yyyy=/mm=` partitioned table between two months, both included.

    The table is read at its root so the range prunes partitions instead of listing leaf paths.
    """
    def position(year: int, month: int) -> int:
        return year * 12 + month

    df = spark.read.parquet(root)
    at = F.col("yyyy").cast("int") * 12 + F.col("mm").cast("int")
    return df.where(at.between(position(*first), position(*last)))


def read_lexicon(
    spark: SparkSession, path: str, *, flagged_only: bool = True, sep: str = "\t"
) -> DataFrame:
    """Headerless delimited word list; columns are named by position. Keeps rows flagged "1"."""
    words = spark.read.schema(LEXICON).csv(path, sep=sep, header=False)
    if flagged_only:
        words = words.where(F.col("value") == "1").select("word", "emotion")
    return words


def write_table(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    **options: str,
) -> None:
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def write_bucketed(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    buckets: int,
    *,
    path: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Save a catalog table hashed and sorted by `keys`, so later joins on them need no shuffle.

    With a `path` the files lie there, and stay when the table is dropped. Repartition `df` by the
    same keys and number first to get one file per bucket.
    """
    writer = df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def write_report_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header. Only for report-sized tables: one task writes everything."""
    df.repartition(1).write.mode("overwrite").option("header", True).csv(path)


def write_report_parquet(df: DataFrame, path: str) -> None:
    """One Parquet file. Only for report-sized tables such as daily series."""
    df.repartition(1).write.mode("overwrite").parquet(path)
