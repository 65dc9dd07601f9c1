"""Literature exploration: from a taxon to the compounds its relatives' articles discuss."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.operators import paths, patterns
from kglake.plans import storage
from kglake.sinks.triples import walk_as_triples

# Vocabularies the exploration reads.
FABIO = "http://purl.org/spar/fabio/"
CITO = "http://purl.org/spar/cito/"
SIO = "http://semanticscience.org/resource/"
MESHV = "http://id.nlm.nih.gov/mesh/vocab#"
DCT_TITLE = "http://purl.org/dc/terms/title"
SUBJECT_TERMS = [FABIO + "hasSubjectTerm", FABIO + "hasPrimarySubjectTerm"]


def article_patterns(subject_term: str) -> list[patterns.Pattern]:
    """Articles about a taxon found by the walk, and the compounds they discuss."""
    return [
        ("?cousinId", V.WALK_MEMBER, "?parent"),
        ("?cousinId", V.RDFS_LABEL, "?cousinLabel"),
        ("?d", V.RDFS_LABEL, "?cousinLabel"),
        ("?d", V.RDF_TYPE, MESHV + "TopicalDescriptor"),
        ("?pmid", subject_term, "?d"),
        ("?pmid", DCT_TITLE, "?pmidTitle"),
        ("?substance", CITO + "isDiscussedBy", "?pmid"),
        ("?substance", SIO + "CHEMINF_000477", "?compound"),
    ]


def explore(taxonomy: DataFrame, others: DataFrame, super_taxon: str, minimum: int = 0) -> DataFrame:
    """`(pmid, pmidTitle, compound, cousinId)` for the taxa below `super_taxon`.

    `minimum` fails the run when the walk finds too few taxa, which means a broken taxonomy.
    """
    taxa = paths.property_path(taxonomy, V.RDFS_SUBCLASS, super_taxon, paths.BACKWARD)
    if minimum:
        paths.require_at_least(taxa, minimum)
    graph = taxonomy.unionByName(others).unionByName(walk_as_triples(taxa, super_taxon))
    columns = ["pmid", "pmidTitle", "compound", "cousinId"]
    # Both queries share all patterns but one: the graph is scanned once for all of them.
    queries = [article_patterns(term) for term in SUBJECT_TERMS]
    matches = patterns.match_all(graph, [p for query in queries for p in query])
    found = [patterns.bgp(matches, query, columns) for query in queries]
    return storage.materialize(found[0].unionByName(found[1]), name="articles")


def compounds(articles: DataFrame, taxon: str) -> DataFrame:
    """The distinct compounds as `compound skos:related taxon`."""
    found = articles.select("compound").distinct()
    return t.resource_triples(found, "compound", F.lit(V.SKOS_RELATED), F.lit(taxon))


def explore_run(catalog: DataFrame, taxonomy: str, others: list[str], super_taxon: str, taxon: str, directory: str,
                basis: str, minimum: int = 0, run_id: int | None = None) -> str:
    """Explore the latest graphs of a catalog and write the compounds as a run that `read_results` reads.

    The run is the file `basis` and its number, the time in milliseconds unless given. A run that finds nothing is an empty file,
    so that the next comparison knows of it. Returns the path.
    """
    from kglake.sinks.single_file import write_single_file
    from kglake.sources.triples import read_graph, read_graphs

    articles = explore(read_graph(catalog, taxonomy), read_graphs(catalog, [(name, "") for name in others]), super_taxon, minimum)
    number = run_id if run_id is not None else time.time_ns() // 1_000_000
    path = f"{directory.rstrip('/')}/{basis}{number}"
    write_single_file(compounds(articles, taxon).select(t.format_line().alias("value")), path)
    return path


def article_listing(articles: DataFrame) -> DataFrame:
    """The detailed rows, sorted by compound."""
    return articles.orderBy("compound", "pmid", "cousinId")
