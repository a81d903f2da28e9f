"""Where jobs may keep intermediate tables: the cluster's shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`, which every executor can reach.

    If the setting is missing, a session whose executors are threads of this process gets a
    temporary folder; a cluster session is refused, since a machine-local folder would be lost with
    its machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="agoralens-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    folder = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(folder)
    return folder


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write to the shared folder as Parquet and read back.

    Later steps read only the columns they need, start from the table's true size, and survive the
    loss of any executor without repeating what made it.
    """
    folder = new_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """A reliable checkpoint for the small state of a loop, so a lost executor replays one step.

    Rows are kept whole and keep the size estimate of what made them; store tables that are read
    several times, or whose loop runs long, with `stored`.
    """
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def drop(spark: SparkSession, folders: list[str]) -> None:
    """Delete stored tables that nothing will read again."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)
        if folder in _made:
            _made.remove(folder)


class Scratch:
    """Tables of one operator that are deleted together, but for those it still needs."""

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.tables: list[tuple[str, DataFrame]] = []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        folder = new_folder(self.spark, name)
        df.write.parquet(folder)
        self.tables.append((folder, self.spark.read.schema(df.schema).parquet(folder)))
        return self.tables[-1][1]

    def drop(self, *but: DataFrame) -> None:
        """Delete all tables so far but those given, as `stored` returned them."""
        gone = [folder for folder, df in self.tables if not any(df is kept for kept in but)]
        drop(self.spark, gone)
        self.tables = [(folder, df) for folder, df in self.tables if folder not in gone]


def made_since(start: int) -> list[str]:
    """Folders that this process has made after the first `start` ones (see `made_so_far`)."""
    return _made[start:]


def made_so_far() -> int:
    return len(_made)


def clear(spark: SparkSession) -> None:
    """Delete what this process has stored. Call it when the results that read it are written."""
    drop(spark, list(_made))
