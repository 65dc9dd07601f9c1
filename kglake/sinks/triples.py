"""Writers of graphs."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.plans import storage

# Fixed value: rows per Parquet file of the ingestion job.
MAX_TRIPLES_PER_FILE = 3_000_000


def write_triples_parquet(triples: DataFrame, path: str, max_triples_per_file: int = MAX_TRIPLES_PER_FILE) -> None:
    """Typed Parquet, no file above the given rows.

    Each task sorts its own rows by predicate and subject, without a shuffle, so that
    row-group statistics let a reader of one predicate skip the rest.
    """
    (
        triples.select(*t.TRIPLE_COLUMNS)
        .sortWithinPartitions("p", "s")
        .write.option("maxRecordsPerFile", max_triples_per_file)
        .parquet(path)
    )


def serialize_graph(catalog: DataFrame, name: str, version: str = "",
                    max_triples_per_file: int = MAX_TRIPLES_PER_FILE) -> str:
    """A Parquet copy of a graph's current content in a new run folder; earlier copies stay.

    Returns the folder written. Readers take the newest complete run.
    """
    from kglake.operators.catalog import find_graph
    from kglake.sources.triples import read_graph

    row = find_graph(catalog, name, version)
    path = f"{row['graph_dir'].rstrip('/')}.parquet/run-{time.time_ns() // 1_000_000}"
    write_triples_parquet(read_graph(catalog, name, version), path, max_triples_per_file)
    return path


def write_ntriples(triples: DataFrame, path: str, compression: str = "gzip") -> None:
    """N-Triples text, compressed, since lines repeat long IRIs; "none" leaves it plain.

    A compressed file is read by one task, so no file has more than `storage.ROWS_PER_FILE` lines. The fastest level
    takes no longer than writing plain text and leaves about a tenth of it.
    """
    lines = triples.select(t.format_line().alias("value")).write.option("maxRecordsPerFile", storage.ROWS_PER_FILE)
    lines.option("compression", compression).option("zlib.compress.level", "BEST_SPEED").text(path)


def walk_as_triples(nodes: DataFrame, start: str) -> DataFrame:
    """Walk results as `node  propertySubGraphElementOf  start`."""
    return t.resource_triples(nodes, "node", F.lit(V.WALK_MEMBER), F.lit(start))
