"""Ranges and domains for the properties of a VoID summary."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kglake.functions import vocab as V
from kglake.operators import catalog as cat
from kglake.operators import horst as owl
from kglake.operators import inference


def select_ontologies(catalog: DataFrame, void_dataset: DataFrame, max_size: int | None = None) -> DataFrame:
    """Latest ontologies, all or those of at most `max_size` triples, each with its size as `triples`.

    One without a valid summary has a null size and is kept: the caller sees that its size is not known.
    """
    sizes = void_dataset.where("is_valid").select(F.col("graph").alias("dir_name"), "version", "triples")
    graphs = cat.ontologies(catalog).join(sizes, cat.KEY, "left")
    chosen = graphs.select(*catalog.columns, "triples")
    return chosen if max_size is None else chosen.where(F.coalesce("triples", F.lit(0)) <= max_size)


def schema_triples(triples: DataFrame) -> DataFrame:
    """The rows that can give a property a range or domain by the RDFS rules, directly or by inference.

    Classes and properties are few next to instances, so the closure runs on a fraction of the graph. Rows of a predicate
    below one of the schema's are rows of the schema too.
    """
    wanted = inference.SCHEMA_PREDICATES + [V.DCAM_RANGE_INCLUDES, V.DCAM_DOMAIN_INCLUDES]
    below = inference.subproperty_closure(triples).where(F.col("dst").isin(wanted) & ~F.col("src").isin(wanted))
    widened = triples.join(below.select(F.col("src").alias("p")).distinct(), "p", "left_semi")
    return triples.where(F.col("p").isin(wanted)).unionByName(widened.select(*triples.columns))


def _per_property(pairs: DataFrame, value: str, used: DataFrame, column: str, equal: DataFrame | None = None) -> DataFrame:
    """The sorted values of each used property; those of `property` are also those of the ones that it has `replaced`."""
    if equal is not None:
        pairs = pairs.unionByName(pairs.join(equal, "property").select(F.col("replaced").alias("property"), value))
    rows = pairs.join(used, pairs.property == used.item, "left_semi")
    return rows.groupBy(F.col("property").alias("item")).agg(F.array_sort(F.collect_set(value)).alias(column))


def enhance_void(void_partition: DataFrame, triples: DataFrame, horst: bool = False) -> DataFrame:
    """The partition with `domains` and `ranges` arrays for its properties.

    `triples` are those of the chosen ontologies and of the graph itself. OWL rules can derive a range from any triple, so with
    `horst` the closure runs on all of them.
    """
    closure = owl.owl_horst_closure(triples) if horst else inference.rdfs_closure(schema_triples(triples))
    # A property that equals another one has its ranges: the closure states them of the least of the equal ones.
    equal = inference.pairs(closure, V.OWL_SAME_AS, "replaced", "property") if horst else None
    used = void_partition.where("kind = 'property'").select("item").distinct()
    ranges = _per_property(inference.property_ranges(closure), "range", used, "ranges", equal)
    domains = _per_property(inference.property_domains(closure), "domain", used, "domains", equal)
    none = F.array().cast("array<string>")
    enhanced = void_partition.join(domains, "item", "left").join(ranges, "item", "left")
    is_property = F.col("kind") == "property"
    return enhanced.select(
        *void_partition.columns,
        F.when(is_property, F.coalesce("domains", none)).otherwise(none).alias("domains"),
        F.when(is_property, F.coalesce("ranges", none)).otherwise(none).alias("ranges"),
    )


def ranges_of(enhanced: DataFrame) -> DataFrame:
    """Property to its own set of ranges, for those that have any."""
    return enhanced.where("kind = 'property' and size(ranges) > 0").select(
        "graph", "version", F.col("item").alias("property"), "ranges"
    )


def domains_of(enhanced: DataFrame) -> DataFrame:
    return enhanced.where("kind = 'property' and size(domains) > 0").select(
        "graph", "version", F.col("item").alias("property"), "domains"
    )


def enhanced_as_triples(enhanced: DataFrame) -> DataFrame:
    """Property partitions with their ranges and domains as triples about one blank node each."""
    from kglake.functions import terms as t

    node = F.concat(F.lit("_:p"), F.md5(F.concat_ws("|", "graph", "version", "kind", "item")))
    null = F.lit(None).cast("string")

    def triple(p, o, literal=False):
        return F.struct(
            F.lit(p).alias("p"), o.cast("string").alias("o"),
            F.lit(t.LITERAL).alias("o_kind") if literal else t.kind_of(o).alias("o_kind"),
            (F.lit(V.XSD + "integer") if literal else null).alias("o_datatype"), null.alias("o_lang"),
        )

    subject = F.when(F.col("kind") == "property", F.lit(V.VOID + "property")).otherwise(F.lit(V.VOID + "class"))
    own = F.array(
        triple(V.VOID + "triples", F.col("triples"), literal=True),
        F.struct(subject.alias("p"), F.col("item").alias("o"), F.lit(t.IRI).alias("o_kind"),
                 null.alias("o_datatype"), null.alias("o_lang")),
    )
    values = F.concat(
        own,
        F.transform("ranges", lambda r: triple(V.VOID_EXT_RANGE, r)),
        F.transform("domains", lambda d: triple(V.VOID_EXT_DOMAIN, d)),
    )
    rows = enhanced.select(node.alias("s"), F.explode(values).alias("v"))
    return rows.select("s", F.lit(t.BNODE).alias("s_kind"), "v.*").select(*t.TRIPLE_COLUMNS)


def summary_as_triples(dataset: DataFrame, source) -> DataFrame:
    """The counters and vocabularies of summaries as triples about `source`, the IRI column of each."""
    from kglake.functions import terms as t

    null = F.lit(None).cast("string")
    counters = {"classes": "classes", "entities": "entities", "distinctSubjects": "distinct_subjects",
                "distinctObjects": "distinct_objects", "properties": "properties", "triples": "triples"}

    def value(p, o, literal):
        return F.struct(
            F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit(t.LITERAL if literal else t.IRI).alias("o_kind"),
            (F.lit(V.XSD + "integer") if literal else null).alias("o_datatype"), null.alias("o_lang"))

    values = F.concat(
        F.array(value(V.RDF_TYPE, F.lit(V.VOID + "Dataset"), False),
                *[value(V.VOID + name, F.coalesce(F.col(column), F.lit(0)), True) for name, column in counters.items()]),
        F.transform(F.coalesce("vocabularies", F.array().cast("array<string>")),
                    lambda v: value(V.VOID + "vocabulary", v, False)))
    rows = dataset.select(source.alias("s"), F.explode(values).alias("v"))
    return rows.select("s", F.lit(t.IRI).alias("s_kind"), "v.*").select(*t.TRIPLE_COLUMNS)


def write_enhanced_void(catalog: DataFrame, name: str, version: str = "", void_dataset: DataFrame | None = None,
                        max_size: int | None = None, horst: bool = False, output_dir: str = "") -> str:
    """Summarise a graph, add the ranges and domains that the lake's ontologies give its properties, and write all of it as N-Triples.

    The ontologies are the latest ones, or those of at most `max_size` triples by `void_dataset`. May be run again:
    the new text is read back, then takes the old one's place. Returns the path.
    """
    from kglake.operators.catalog import find_graph
    from kglake.plans import storage
    from kglake.plans.void_job import void_stats
    from kglake.sinks.triples import write_ntriples
    from kglake.sources.triples import ntriples_rejects, read_graph, read_graphs

    spark = catalog.sparkSession
    row = find_graph(catalog, name, version)
    graph = read_graph(catalog, name, version)
    if void_dataset is None:
        void_dataset = spark.createDataFrame([], "graph string, version string, triples bigint, is_valid boolean")
    chosen = select_ontologies(catalog, void_dataset, max_size).select(*cat.KEY).collect()  # rows of the catalog
    ontologies = read_graphs(catalog, [(r["dir_name"], r["version"]) for r in chosen])
    summary = void_stats(graph, row["dir_name"], row["version"])
    enhanced = enhance_void(summary.partition, graph.unionByName(ontologies), horst)
    source = F.lit(V.VOID_SOURCE + row["graph_dir"])
    path = output_dir or f"{row['graph_dir']}_analysis/enhanced_void"
    temporary = f"{path}.{uuid.uuid4().hex}.temp"
    write_ntriples(enhanced_as_triples(enhanced).unionByName(summary_as_triples(summary.dataset, source)), temporary, compression="none")
    if not ntriples_rejects(spark, temporary).isEmpty():
        raise ValueError(f"the summary in {temporary} has lines that are no statements")
    storage.replace_path(spark, temporary, path)
    return path
