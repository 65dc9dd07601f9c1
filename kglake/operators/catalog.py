"""Queries over the catalog and the VoID tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kglake.functions import terms as t

KEY = ["dir_name", "version"]


def all_graphs(catalog: DataFrame) -> DataFrame:
    """One row per version: the copy flagged latest when the metadata is there twice."""
    rest = [c for c in catalog.columns if c not in KEY + ["is_latest"]]
    best = F.max_by(F.struct(*rest), F.col("is_latest").cast("int"))
    picked = catalog.groupBy(*KEY).agg(best.alias("best"), F.max("is_latest").alias("is_latest"))
    return picked.select(*KEY, "best.*", "is_latest").select(*catalog.columns)


def latest_graphs(catalog: DataFrame) -> DataFrame:
    return catalog.where("is_latest")


def instance_graphs(catalog: DataFrame, latest: bool = True) -> DataFrame:
    return (latest_graphs if latest else all_graphs)(catalog).where("ontology_namespace = ''")


def ontologies(catalog: DataFrame, latest: bool = True) -> DataFrame:
    return (latest_graphs if latest else all_graphs)(catalog).where("ontology_namespace <> ''")


def select_graph(catalog: DataFrame, name: str, version: str = "") -> DataFrame:
    """The catalog row of a graph; no version means the latest, by import date, then version."""
    if version == "":
        newest = Window.orderBy(F.desc("date_importation"), F.desc("version"))
        found = latest_graphs(catalog).where(F.col("dir_name") == name)
        return found.withColumn("rank", F.row_number().over(newest)).where("rank = 1").drop("rank")
    return all_graphs(catalog.where((F.col("dir_name") == name) & (F.col("version") == version)))


def find_graph(catalog: DataFrame, name: str, version: str = ""):
    """The same as one Row, or a LookupError."""
    row = select_graph(catalog, name, version).first()
    if row is None:
        raise LookupError(f"graph {name} {version or 'latest'} is not in the catalog")
    return row


def graph_files(catalog: DataFrame, uri_root: str = "") -> DataFrame:
    """Each file of each version by name, path and URI."""
    files = all_graphs(catalog).select(*KEY, "graph_dir", F.explode("actual_file_list").alias("file_name"))
    path = F.concat("graph_dir", F.lit("/"), "file_name")
    return files.select(*KEY, "file_name", path.alias("file_path"), F.concat(F.lit(uri_root), path).alias("file_uri"))


def graph_metadata(catalog: DataFrame) -> DataFrame:
    """Each version's metadata as JSON."""
    rest = [c for c in catalog.columns if c not in ("is_latest", "graph_dir")]
    return all_graphs(catalog).select(*KEY, F.to_json(F.struct(*rest)).alias("metadata"))


def _with_sizes(graphs: DataFrame, void_dataset: DataFrame) -> DataFrame:
    sizes = void_dataset.where("is_valid").select(
        F.col("graph").alias("dir_name"), "version", F.col("triples").alias("size")
    )
    return graphs.join(sizes, KEY, "left")


def graph_listing(catalog: DataFrame, void_dataset: DataFrame | None = None, latest: bool = True) -> DataFrame:
    """One line of text per graph, with size and kind when summaries are given."""
    graphs = (latest_graphs if latest else all_graphs)(catalog)
    line = F.concat("dir_name", F.lit(" "), "version", F.lit(", "), "format")
    if void_dataset is None:
        return graphs.select(*KEY, line.alias("line"))
    size = t.format_size(F.col("size"))
    size = F.when(size != "", F.concat(F.lit(", "), size)).otherwise("")
    kind = F.when(F.col("ontology_namespace") != "", ", ontology").otherwise(", instance graph")
    return _with_sizes(graphs, void_dataset).select(*KEY, F.concat(line, size, kind).alias("line"))


def graph_counts(catalog: DataFrame) -> DataFrame:
    """Number of versions of each graph."""
    return all_graphs(catalog).groupBy("dir_name").agg(F.count("*").alias("versions"))


def lake_totals(catalog: DataFrame, void_dataset: DataFrame) -> DataFrame:
    """Triples of the latest ontologies, of the latest instance graphs, and of both."""
    sized = _with_sizes(latest_graphs(catalog), void_dataset)
    part = F.when(F.col("ontology_namespace") != "", "ontologies").otherwise("instance graphs")
    totals = sized.select(part.alias("part"), "size").rollup("part").agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("triples")
    )
    return totals.select(F.coalesce("part", F.lit("global")).alias("part"), "triples")


def void_counts(void_dataset: DataFrame) -> DataFrame:
    """Counters of each summary, zero where one is missing."""
    names = ["entities", "distinct_subjects", "distinct_objects", "triples"]
    return void_dataset.select("graph", "version", *(F.coalesce(n, F.lit(0)).alias(n) for n in names))


def class_partition(void_partition: DataFrame) -> DataFrame:
    return void_partition.where("kind = 'class'").select("graph", "version", F.col("item").alias("class"), "triples")


def property_partition(void_partition: DataFrame) -> DataFrame:
    return void_partition.where("kind = 'property'").select(
        "graph", "version", F.col("item").alias("property"), "triples"
    )


def expired_versions(catalog: DataFrame, n_kept: int = 2) -> DataFrame:
    """Versions beyond the newest `n_kept` of each graph, by import date, then version.

    The kept versions are ranked first: their filter runs in every task before the
    shuffle, so a graph with very many versions is never gathered in one task.
    """
    graphs = catalog.groupBy(*KEY, "graph_dir").agg(F.max("date_importation").alias("date_importation"))
    newest = Window.partitionBy("dir_name").orderBy(F.desc("date_importation"), F.desc("version"))
    kept = graphs.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= n_kept)
    return graphs.join(kept.select(*KEY), KEY, "left_anti")


def pending_updates(offered: DataFrame, catalog: DataFrame, force: bool = False) -> DataFrame:
    """Offered `(dir_name, version)` rows that differ from the lake's latest, or all when forced."""
    if force:
        return offered
    return offered.join(latest_graphs(catalog).select(*KEY), KEY, "left_anti")


def available_together(catalog: DataFrame, names: Sequence[str]) -> DataFrame:
    """The versions at which every named graph is present."""
    present = all_graphs(catalog).where(F.col("dir_name").isin(list(names)))
    counted = present.groupBy("version").agg(F.countDistinct("dir_name").alias("found"))
    return counted.where(F.col("found") == len(set(names))).select("version")


def register_version(catalog: DataFrame, added: DataFrame, imported_at=None) -> DataFrame:
    """The catalog with new versions, stamped with the import time and flagged latest."""
    stamp = F.current_timestamp() if imported_at is None else F.lit(imported_at).cast("timestamp")
    # Of several new versions of a graph the last one is the latest.
    last = Window.partitionBy("dir_name").orderBy(F.desc("version"))
    new = added.withColumn("date_importation", stamp).withColumn("is_latest", F.row_number().over(last) == 1)
    older = catalog.join(new.select(*KEY), KEY, "left_anti")
    renewed = new.select("dir_name").distinct().withColumn("renewed", F.lit(True))
    older = older.join(renewed, "dir_name", "left").withColumn(
        "is_latest", F.col("is_latest") & F.col("renewed").isNull()
    )
    return older.select(*catalog.columns).unionByName(new.select(*catalog.columns))


def raw_void(texts: DataFrame, name: str, version: str) -> DataFrame:
    """The text of a graph's summary, an empty text where there is none."""
    found = texts.where((F.col("graph") == name) & (F.col("version") == version))
    return found.agg(F.coalesce(F.max("value"), F.lit("")).alias("value"))
