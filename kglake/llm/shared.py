"""What the operators of this subpackage share: words, shared storage and file systems."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE_BYTES = " \t\n\v\f\r"


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder, as a URI, below `spark.checkpoint.dir`, the storage that driver and executors share.

    Only a local session (one machine, as in tests) may lack the setting; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="kglake-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    if "://" not in base and not base.startswith("file:"):
        base = "file://" + base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet to shared storage and read back: cuts lineage, survives lost executors."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder on shared storage, for tasks that write or read raw bytes."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder made by `new_folder` whose content no result reads any more."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def unused(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, longer by underscores where `columns` has them already."""
    taken, out = {c.lower() for c in columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def word_count(text: Column) -> Column:
    """Number of words of a text; null counts as no words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as `--py-files` would."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    _shipped.add(application)
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="kglake-package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))
