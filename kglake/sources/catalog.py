"""The lake's catalog, from the JSON metadata files written at ingestion."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METADATA_SCHEMA = (
    "dir_name string, version string, download_url string, compression string, format string,"
    " ontology_namespace string, file_list array<string>, actual_file_list array<string>,"
    " date_importation_msd string"
)

# What a missing metadata field reads as.
DEFAULTS = {
    "dir_name": "NoDirNameSpecified",
    "version": "NoVersionSpecified",
    "format": "NoFormatSpecified",
    "ontology_namespace": "",
}
DEFAULT_FILE = "NoFileListSpecified"


def read_catalog(spark: SparkSession, data_dir: str) -> DataFrame:
    """One row per metadata file, fields defaulted; a broken file fails and is named in the error.

    `is_latest` is set for the copy named `<dir_name>_metadata_latest`.
    """
    root = data_dir.rstrip("/")
    try:
        raw = spark.read.schema(METADATA_SCHEMA).json(
            f"{root}/*_metadata_*", multiLine=True, mode="FAILFAST"
        ).withColumn("file_path", F.col("_metadata.file_path"))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raw = spark.createDataFrame([], METADATA_SCHEMA + ", file_path string")
    return with_defaults(raw, root)


def with_defaults(raw: DataFrame, data_dir: str) -> DataFrame:
    """Metadata rows as catalog rows."""
    filled = {name: F.coalesce(name, F.lit(value)) for name, value in DEFAULTS.items()}
    graph_dir = F.concat(F.lit(data_dir.rstrip("/") + "/"), filled["dir_name"], F.lit("_v"), filled["version"])
    return raw.select(
        filled["dir_name"].alias("dir_name"),
        filled["version"].alias("version"),
        "download_url",
        "compression",
        filled["format"].alias("format"),
        filled["ontology_namespace"].alias("ontology_namespace"),
        "file_list",
        F.coalesce("actual_file_list", F.array(F.lit(DEFAULT_FILE))).alias("actual_file_list"),
        F.try_to_timestamp("date_importation_msd").alias("date_importation"),
        F.col("file_path").endswith("_metadata_latest").alias("is_latest"),
        graph_dir.alias("graph_dir"),
    )
