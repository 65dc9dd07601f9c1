"""VoID summaries, from the Turtle shape the statistics job writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kglake.functions import vocab as V

_IRI = r"<[^<>\"{}|^`\\\x00-\x20]*>"
PARTITION = r"\[\s*void:(class|property)\s+(" + _IRI + r")\s*;\s*void:triples\s+(-?\d+)\s*;?\s*\]"
_STATEMENT = (
    r"(?:void:(?:classes|entities|distinctSubjects|distinctObjects|properties|triples)\s+-?\d+"
    r"|void:(?:classPartition|propertyPartition)\s+#(?:\s*,\s*#)*+"
    r"|void:vocabulary\s+" + _IRI + r"(?:\s*,\s*" + _IRI + r")*+"
    r"|a\s+void:Dataset)"
)
# The document after each well-formed partition was replaced by `#`.
DOCUMENT = (
    r"^\s*(?:@prefix\s+[\w-]*:\s*" + _IRI + r"\s*\.\s*)*+" + _IRI + r"\s+" + _STATEMENT
    + r"(?:\s*;\s*" + _STATEMENT + r")*+\s*;?\s*\.\s*$"
)
# The counters of a summary.
COUNTERS = {
    "classes": "classes",
    "entities": "entities",
    "distinct_subjects": "distinctSubjects",
    "distinct_objects": "distinctObjects",
    "properties": "properties",
    "triples": "triples",
}


def read_void(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """The text of each summary file with the graph directory it describes."""
    texts = spark.read.text(paths, wholetext=True).withColumn("file_path", F.col("_metadata.file_path"))
    return with_source(texts)


def with_source(texts: DataFrame) -> DataFrame:
    """Adds `graph_dir`, `graph` and `version`, taken from the summary's source IRI."""
    source = F.regexp_extract("value", r"void/\?source=([^>\s]*)>", 1)
    base = F.regexp_extract(F.col("graph_dir"), r"([^/]*)/?$", 1)
    return (
        texts.withColumn("graph_dir", source)
        .withColumn("graph", F.regexp_extract(base, r"^(.*?)(?:_v(?!.*_v).*)?$", 1))
        .withColumn("version", F.regexp_extract(base, r"^.*_v([^/]*)$", 1))
    )


def void_dataset(texts: DataFrame) -> DataFrame:
    """Counters of each summary; null where missing, `is_valid` false where the text is malformed."""
    outside = F.regexp_replace("value", PARTITION, "#")
    listed = F.regexp_extract(outside, r"void:vocabulary\s+([^;]*)", 1)
    counters = [
        F.regexp_extract(outside, rf"void:{turtle}\s+(-?\d+)", 1).try_cast("bigint").alias(name)
        for name, turtle in COUNTERS.items()
    ]
    return texts.select(
        "graph", "version", "graph_dir", *counters,
        F.regexp_extract_all(listed, F.lit(r"<([^>]*)>"), F.lit(1)).alias("vocabularies"),
        outside.rlike(DOCUMENT).alias("is_valid"),
    )


def void_partition(texts: DataFrame) -> DataFrame:
    """Class and property counts of the well-formed summaries."""
    valid = texts.where(F.regexp_replace("value", PARTITION, "#").rlike(DOCUMENT))
    found = F.explode(F.regexp_extract_all("value", F.lit(PARTITION), F.lit(0)))
    return valid.select("graph", "version", found.alias("entry")).select(
        "graph", "version",
        F.regexp_extract("entry", PARTITION, 1).alias("kind"),
        F.regexp_extract("entry", r"<([^>]*)>", 1).alias("item"),
        F.regexp_extract("entry", PARTITION, 3).cast("bigint").alias("triples"),
    )


def enhanced_void_partition(triples: DataFrame) -> DataFrame:
    """Partitions with ranges and domains from an enhanced summary kept as triples."""
    v = V.VOID
    wanted = {
        v + "property": "property", v + "class": "class", v + "triples": "triples",
        V.VOID_EXT_RANGE: "range", V.VOID_EXT_DOMAIN: "domain",
    }

    def value(name):
        return F.max(F.when(F.col("field") == name, F.col("o")))

    def values(name):
        return F.array_sort(F.collect_set(F.when(F.col("field") == name, F.col("o"))))

    field = F.coalesce(*(F.when(F.col("p") == iri, F.lit(name)) for iri, name in wanted.items()))
    rows = triples.where(F.col("p").isin(list(wanted))).withColumn("field", field)
    entries = rows.groupBy("s").agg(
        value("property").alias("property"), value("class").alias("class"),
        value("triples").try_cast("bigint").alias("triples"),
        values("domain").alias("domains"), values("range").alias("ranges"),
    )
    return entries.where("property is not null or class is not null").select(
        F.when(F.col("property").isNotNull(), "property").otherwise("class").alias("kind"),
        F.coalesce("property", "class").alias("item"), "triples", "domains", "ranges",
    )
