"""Helpers shared by the corpus operators: table readers and shared-folder tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: The six characters that separate words everywhere in this package.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see.

    It is what ``spark.checkpoint.dir`` names. Only where that is unset in a
    local run, as in tests, a temporary folder is made and set as checkpoint
    folder; on a cluster no machine's own folder would do.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyspark-"))
    return context.getCheckpointDir().rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, removed when the application ends."""
    where = f"{shared_dir(spark)}/tallyspark/{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    return where


def remove_path(spark: SparkSession, where: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Saved:
    """A DataFrame written as Parquet in the shared folder: short lineage, survives lost executors."""

    def __init__(self, df: DataFrame, name: str):
        self.spark = df.sparkSession
        self.path = shared_path(self.spark, name)
        df.write.parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def remove(self) -> None:
        remove_path(self.spark, self.path)


def saved(df: DataFrame, name: str) -> DataFrame:
    return Saved(df, name).df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
