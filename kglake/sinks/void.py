"""VoID summaries as Turtle."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kglake.functions import vocab as V
from kglake.plans import storage

# The prefix block of a summary.
PREFIXES = {
    "rdf": "http://www.w3.org/1999/02/22-rdf-syntax-ns#",
    "void": "http://rdfs.org/ns/void#",
    "void-ext": "http://stats.lod2.eu/rdf/void-ext/",
    "qb": "http://purl.org/linked-data/cube#",
    "dcterms": "http://purl.org/dc/terms/",
    "ls-void": "http://stats.lod2.eu/rdf/void/",
    "ls-qb": "http://stats.lod2.eu/rdf/qb/",
    "ls-cr": "http://stats.lod2.eu/rdf/qb/criteria/",
    "xsd": "http://www.w3.org/2001/XMLSchema#",
    "xstats": "http://example.org/XStats#",
    "foaf": "http://xmlns.com/foaf/0.1/",
    "rdfs": "http://www.w3.org/2000/01/rdf-schema#",
}


GRAPH_KEY = ["graph", "version"]


def ranked_partitions(partition: DataFrame, size: int | None = None) -> DataFrame:
    """The entries of each graph and kind, ranked by count, ties by item; only the `size` largest where one is given.

    Such a limit is applied by each task before the shuffle.
    """
    order = Window.partitionBy(*GRAPH_KEY, "kind").orderBy(F.desc("triples"), "item")
    ranked = partition.withColumn("rank", F.row_number().over(order))
    return ranked if size is None else ranked.where(F.col("rank") <= size)


def _blocks(partition: DataFrame, size: int | None) -> DataFrame:
    """The class and property text of each graph: one row per graph, as long as its summary."""
    entry = F.concat(
        F.lit("[ \nvoid:"), F.col("kind"), F.lit(" <"), F.col("item"), F.lit(">; \nvoid:triples "),
        F.col("triples"), F.lit(";\n]"),
    )

    def block(kind: str) -> Column:
        entries = F.collect_list(F.when(F.col("kind") == kind, F.struct("rank", entry.alias("entry"))))
        text = F.array_join(F.transform(F.array_sort(entries), lambda e: e["entry"]), ",")
        return F.when(text != "", F.concat(F.lit(f"\nvoid:{kind}Partition "), text, F.lit(";"))).otherwise(F.lit(""))

    return ranked_partitions(partition, size).groupBy(*GRAPH_KEY).agg(
        block("class").alias("class_block"), block("property").alias("property_block")
    )


def void_to_turtle(dataset: DataFrame, partition: DataFrame, source: Column, report_size: int | None = None,
                   vocabulary_size: int | None = None) -> DataFrame:
    """`(graph, version, value)`: the summary text of each graph; `source` is its directory.

    Everything is listed; a short text lists only so many partitions of a kind and vocabularies (100 and 15 where
    the text must equal that of the established reports).
    """
    prefixes = "\n".join(f"@prefix {name}: <{iri}> ." for name, iri in PREFIXES.items())

    def counter(turtle: str, name: str) -> Column:
        return F.concat(F.lit(f"\nvoid:{turtle} "), F.coalesce(F.col(name), F.lit(0)), F.lit(";"))

    listed = F.array_sort("vocabularies")
    if vocabulary_size is not None:
        listed = F.slice(listed, 1, vocabulary_size)
    vocabulary = F.when(
        F.size(listed) > 0,
        F.concat(F.lit("\nvoid:vocabulary  <"), F.array_join(listed, ">, <"), F.lit(">;")),
    ).otherwise(F.lit(""))
    class_block, property_block = (F.coalesce(f"{kind}_block", F.lit("")) for kind in ("class", "property"))
    return dataset.join(_blocks(partition, report_size), GRAPH_KEY, "left").select(
        *GRAPH_KEY,
        F.concat(
            F.lit(f"{prefixes}\n<{V.VOID_SOURCE}"), source, F.lit(">\n"),
            counter("classes", "classes"), class_block,
            counter("entities", "entities"),
            counter("distinctSubjects", "distinct_subjects"),
            counter("distinctObjects", "distinct_objects"),
            counter("properties", "properties"), property_block,
            counter("triples", "triples"), vocabulary, F.lit("\na void:Dataset ."),
        ).alias("value")
    )


def write_void(turtle: DataFrame, path: str) -> None:
    """The summary text under `path`, one file; an older summary there is replaced once the new one is written whole."""
    temporary = f"{path.rstrip('/')}.{uuid.uuid4().hex}.temp"
    turtle.select("value").coalesce(1).write.text(temporary)
    if turtle.sparkSession.read.text(temporary, wholetext=True).where(
            F.col("value").rlike(r"a void:Dataset \.\s*$")).isEmpty():
        raise ValueError(f"the summary in {temporary} is not complete")
    storage.replace_path(turtle.sparkSession, temporary, path)
