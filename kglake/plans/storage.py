"""Tables kept on the cluster's shared storage between the steps of a job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Rows per stored file. A reader packs files into tasks by their bytes and 4 MB for each, so small ones bound the rows of a task however
# well they compress, and with them what its aggregates hold.
ROWS_PER_FILE = 100_000

_local_base: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """A new folder under `spark.checkpoint.dir`, or the context's own checkpoint directory.

    A local session without either gets one temporary directory of this process; on a cluster the
    setting is required, because a machine-local folder would be lost with its machine. The session's own settings
    stay as they are.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not base:
        if not sc.master.startswith("local") or "cluster" in sc.master:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not _local_base:
            _local_base.append(tempfile.mkdtemp(prefix="kglake-"))
        base = _local_base[0]
    return f"{base.rstrip('/')}/kglake-{uuid.uuid4().hex}"


def materialize(df: DataFrame, folder: str | None = None, name: str = "table") -> DataFrame:
    """Write `df` as Parquet on shared storage and read it back.

    This cuts the lineage of iterative jobs and survives the loss of executors. The
    new scan also has exact size statistics, so later joins are broadcast only
    when the table really is below the session's broadcast threshold.
    """
    folder = folder or shared_folder(df.sparkSession)
    path = f"{folder}/{name}"
    df.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_tables(like: DataFrame, paths: list[str]) -> DataFrame:
    """One scan over several tables written with the schema of `like`."""
    return like.sparkSession.read.schema(like.schema).parquet(*paths)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly under `path`, empty where it does not exist."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        return []
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def replace_path(spark: SparkSession, new: str, target: str) -> None:
    """Put the file or folder `new` at `target`. What was there is moved aside first, comes back if that fails,
    and is deleted only when the new one is in place."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    source, goal, aside = (hadoop.Path(p) for p in (new, target, f"{target.rstrip('/')}.{uuid.uuid4().hex}.old"))
    fs = goal.getFileSystem(spark._jsc.hadoopConfiguration())
    replaces = fs.exists(goal)
    if replaces and not fs.rename(goal, aside):
        raise OSError(f"cannot move {target} aside")
    if not fs.rename(source, goal):
        if replaces:
            fs.rename(aside, goal)
        raise OSError(f"cannot write {target}; it is in {new}")
    if replaces:
        fs.delete(aside, True)


def delete_path(spark: SparkSession, path: str) -> None:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
