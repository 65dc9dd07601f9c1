"""What changed between successive result sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kglake.functions import vocab as V

RESULT = ["s", "p", "o"]


def latest_two(runs: DataFrame) -> DataFrame:
    """`(run_id, age)` of the newest run, age 1, and the one before, age 2; `runs` has every run, empty ones too."""
    newest = runs.select("run_id").distinct().orderBy(F.desc("run_id")).limit(2)
    return newest.withColumn("age", F.row_number().over(Window.orderBy(F.desc("run_id"))))


def new_results(results: DataFrame, runs: DataFrame) -> DataFrame:
    """Results of the newest run that the run before lacks; all of them when it is the first.

    One aggregate over both runs: a result is new when its oldest occurrence is in the newest.
    """
    aged = results.join(F.broadcast(latest_two(runs)), "run_id")
    return aged.groupBy(*RESULT).agg(F.max("age").alias("oldest")).where("oldest = 1").select(*RESULT)


def has_news(results: DataFrame, runs: DataFrame) -> bool:
    return not new_results(results, runs).isEmpty()


def newest_run(results: DataFrame, runs: DataFrame) -> DataFrame:
    """The complete results of the newest run, as they stand beside a report of what is new."""
    return results.join(F.broadcast(latest_two(runs).where("age = 1")), "run_id").select(*RESULT).distinct()


def result_lines(results: DataFrame) -> DataFrame:
    """Result rows as lines of a report's second section."""
    return results.select(
        F.lit(2).alias("section"),
        F.concat(F.lit("<"), "s", F.lit("> <"), "p", F.lit("> <"), "o", F.lit(">")).alias("line"),
    )


def diff_report(results: DataFrame, runs: DataFrame, report_uri: str, run_prefix: str) -> DataFrame:
    """Report lines `(section, line)`: where the news came from and each new triple, or that there is none."""
    news = new_results(results, runs)
    lines = result_lines(news)
    run = runs.agg(F.max("run_id").alias("run_id"), F.lit(0).cast("bigint").alias("n"))
    counted = news.agg(F.lit(None).cast("bigint").alias("run_id"), F.count("*").alias("n"))
    both = run.unionByName(counted).agg(F.max("run_id").alias("run_id"), F.sum("n").alias("n"))
    source = F.concat(F.lit(f"<{report_uri}> <{V.PROV_DERIVED}> <{run_prefix}"), F.col("run_id"), F.lit(">"))
    head = F.when(F.col("n") == 0, F.lit("# NO newer results")).otherwise(source)
    return both.select(F.lit(1).alias("section"), head.alias("line")).unionByName(lines)
