"""The summary of one graph, or of every graph of a lake, as one job."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.operators import stats
from kglake.plans import storage
from kglake.sinks import void as void_sink

BY = ["graph", "version"]


@dataclass(frozen=True)
class VoidStats:
    """`dataset` has one row per graph, `partition` one per class or property, `vocabularies` one per namespace."""

    dataset: DataFrame
    partition: DataFrame
    vocabularies: DataFrame


def void_stats(triples: DataFrame, graph: str | None = None, version: str = "") -> VoidStats:
    """All summary statistics from one pass over the triples.

    It groups terms and digests of triples; the result is stored once, because counters, partitions and
    vocabularies all read it. A distinct triple is stored as a row without a term, which compresses to nothing. Triples with `graph` and
    `version` columns are summarised per graph; otherwise pass the graph's name, and an
    empty graph still gets its row of zeros.
    """
    if graph is not None:
        triples = triples.withColumn("graph", F.lit(graph)).withColumn("version", F.lit(version))
    stored = storage.materialize(stats.term_usage(triples, BY, with_triples=True), name="term_usage")
    usage = stored.where("term is not null")
    vocabularies = usage.select(*BY, t.namespace(F.col("term")).alias("ns")).distinct()
    listed = vocabularies.groupBy(*BY).agg(F.array_sort(F.collect_list("ns")).alias("vocabularies"))
    counted = stored.where("term is null").groupBy(*BY).agg(F.count("*").alias("triples"))
    dataset = stats.usage_totals(usage, BY).join(counted, BY).join(listed, BY, "left").withColumn(
        "is_valid", F.lit(True)
    )
    if graph is not None:
        named = triples.sparkSession.range(1).select(F.lit(graph).alias("graph"), F.lit(version).alias("version"))
        dataset = named.join(dataset, BY, "left").fillna(0).fillna(True, ["is_valid"])
    return VoidStats(dataset, stats.usage_partition(usage, BY), vocabularies)


def write_graph_void(catalog: DataFrame, name: str, version: str = "", output_dir: str = "") -> str | None:
    """Summarise a graph of the catalog and write the Turtle text; graphs that are not RDF are skipped.

    May be run again: the new text is checked, then takes the old one's place.
    """
    from kglake.functions import vocab as V
    from kglake.operators.catalog import find_graph
    from kglake.sources.triples import read_graph

    row = find_graph(catalog, name, version)
    if row["format"] not in V.RDF_FORMATS:
        return None
    summary = void_stats(read_graph(catalog, name, version), row["dir_name"], row["version"])
    path = output_dir or f"{row['graph_dir']}_analysis/void"
    turtle = void_sink.void_to_turtle(summary.dataset, summary.partition, F.lit(row["graph_dir"]))
    void_sink.write_void(turtle, path)
    return path
