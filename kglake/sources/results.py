"""Run-stamped result files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.plans import storage


def read_results(spark: SparkSession, directory: str, basis: str) -> tuple[DataFrame, DataFrame]:
    """`(runs, results)` of the files whose name is `basis` and a number; other lines and files are dropped.

    `runs` has a `run_id` for every such file, also for one without a result line.
    """
    names = [(name,) for name in storage.child_names(spark, directory) if basis in name]
    files = spark.createDataFrame(names, "file_name string")
    results = t.empty_results(spark)
    if names:
        lines = spark.read.text([f"{directory.rstrip('/')}/{name}" for name, in names]).select(
            "value", F.col("_metadata.file_path").alias("file_name"))
        results = parse_results(lines, basis)
    return runs_of(files, basis), results


def runs_of(files: DataFrame, basis: str) -> DataFrame:
    """The distinct `run_id` of files `(file_name)`, whatever they hold."""
    run_id = t.try_long(t.suffix_after(F.regexp_extract("file_name", "[^/]*$", 0), basis))
    return files.select(run_id.alias("run_id")).where("run_id is not null").distinct()


def parse_results(lines: DataFrame, basis: str) -> DataFrame:
    """Lines `(file_name, value)` as distinct result rows."""
    name = F.regexp_extract("file_name", "[^/]*$", 0)
    run_id = t.try_long(t.suffix_after(name, basis))
    rows = lines.select(run_id.alias("run_id"), t.parse_result_line(F.col("value")).alias("r"))
    return rows.where("run_id is not null and r is not null").select("run_id", "r.*").distinct()
