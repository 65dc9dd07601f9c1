"""Every operator over the supplied tables, each with SQL text for an outside check where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.operators import catalog as cat
from kglake.operators import horst, inference, paths, patterns, reachability, search, stats
from kglake.operators import results as res
from kglake.plans import enhance, explore, storage
from kglake.plans.void_job import void_stats
from kglake.sinks import single_file
from kglake.sinks import triples as triples_sink
from kglake.sinks import void as void_sink
from kglake.sources import catalog as catalog_src
from kglake.sources import results as results_src
from kglake.sources import tables as tables_src
from kglake.sources import triples as triples_src
from kglake.sources import void as void_src
from kglake.sources import web
from kglake.testbed import closure_sql
from kglake.testbed import graph as g

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

GRAPH = "with recursive " + g.triples_sql() + " "
LAKE = "with " + g.CATALOG_SQL + ", " + g.VOID_DATASET_SQL + ", " + g.VOID_PARTITION_SQL + " "
RESULTS = "with " + g.RESULTS_SQL + " "
COLUMNS = "s, s_kind, p, o, o_kind, o_datatype, o_lang"
NAMESPACE = r"regexp_replace({0}, '[\p{{L}}_][\p{{L}}\p{{N}}_.\-·]*$', '')"
OBJECT_TERM = (
    "case when o_kind <> 'literal' then o else concat('\"', replace(replace(o, '\\', '\\\\'), '\"', '\\\"'), '\"',"
    f" case when o_lang is not null then concat('@', o_lang) when o_datatype = '{V.XSD_STRING}' then ''"
    " else concat('^^<', o_datatype, '>') end) end"
)
TERMS = (
    "terms as (select s as term, 1 as as_s, 0 as as_p, 0 as as_o, 0 as as_class from triples where s_kind = 'iri'"
    " union all select p, 0, 1, 0, 0 from triples"
    f" union all select o, 0, 0, 1, case when p = '{V.RDF_TYPE}' then 1 else 0 end from triples where o_kind = 'iri'),"
    " usage as (select term, sum(as_s) as as_s, sum(as_p) as as_p, sum(as_o) as as_o, sum(as_class) as as_class"
    " from terms group by term)"
)


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def on_graph(name: str, operator: Callable[[DataFrame], DataFrame], sql: str | None) -> None:
    """A query that applies one operator to the whole graph; what it filters on is the operator's own business."""
    query(name, None if sql is None else GRAPH + sql)(lambda spark, d: operator(g.triples(spark, d)))




# --- terms ------------------------------------------------------------------------------------

on_graph(
    "term_kinds", lambda T: T.groupBy(
        t.is_iri("s").alias("s_iri"), t.is_blank("s").alias("s_blank"), t.is_iri("o").alias("o_iri"),
        t.is_blank("o").alias("o_blank"), t.is_literal("o").alias("o_literal"),
    ).agg(F.count("*").alias("n")),
    "select s_kind = 'iri' as s_iri, s_kind = 'bnode' as s_blank, o_kind = 'iri' as o_iri, o_kind = 'bnode' as o_blank,"
    " o_kind = 'literal' as o_literal, count(*) as n from triples group by all",
)
on_graph(
    "predicate_and_object_match", lambda T: T.where(t.predicate_matches(V.RDF_TYPE) & t.object_matches(g.CLASS + "Debtor")).select("s"),
    f"select s from triples where p = '{V.RDF_TYPE}' and o = '{g.CLASS}Debtor' and o_kind = 'iri'",
)
on_graph(
    "namespace_of_subjects", lambda T: T.where(t.is_iri("s")).select(
        "s", t.namespace(F.col("s")).alias("ns")).distinct(),
    f"select distinct s, {NAMESPACE.format('s')} as ns from triples where s_kind = 'iri'",
)
on_graph(
    "lexical_length", lambda T: T.select("s", "o", t.lexical_length().alias("len")),
    "select s, o, length(o) as len from triples",
)
on_graph(
    "datatype_and_language", lambda T: T.groupBy(t.has_datatype().alias("typed"), t.has_language().alias("tagged"), "o_datatype", "o_lang").agg(
        F.count("*").alias("n")),
    "select o_kind = 'literal' and coalesce(o_datatype, '') <> '' as typed,"
    " o_kind = 'literal' and coalesce(o_lang, '') <> '' as tagged,"
    " o_datatype, o_lang, count(*) as n from triples group by all",
)
on_graph(
    "format_line", lambda T: T.select(t.format_line().alias("line")),
    "select concat(case when s_kind = 'bnode' then s else concat('<', s, '>') end, ' <', p, '> ',"
    f" case when o_kind = 'iri' then concat('<', o, '>') else {OBJECT_TERM} end, ' .') as line from triples",
)
on_graph(
    "term_to_string", lambda T: T.select("p", t.term_to_string().alias("term")).distinct(),
    f"select distinct p, {OBJECT_TERM} as term from triples",
)


@query("escape_and_unescape", "select doc_id, md5(text) as digest, true as same from documents")
def _(spark, d):
    docs = g.read_table(spark, d, "documents")
    back = t.unescape_literal(t.escape_literal(F.col("text")))
    return docs.select("doc_id", F.md5(back).alias("digest"), (back == F.col("text")).alias("same"))


@query("item_endings", LAKE + "select item, ends_with(item, 'F') as ends, contains(item, 'URG') as has"
       " from void_partition group by all")
def _(spark, d):
    items = g.void_partition(spark, d).select("item").distinct()
    return items.select(
        "item", t.ends_with_item(F.col("item"), F.lit("F")).alias("ends"),
        t.contains_item(F.col("item"), F.lit("URG")).alias("has"),
    )


@query(
    "run_id_of_file_name",
    "select file_name, replace(file_name, 'found-', '') as suffix,"
    " try_cast(replace(file_name, 'found-', '') as bigint) as run_id, count(*) as n"
    " from (select concat('found-', replace(substr(cast(ts as varchar), 1, 10), '-', ''),"
    " case when event_id % 11 = 0 then '.log' else '' end) as file_name from events) group by all",
)
def _(spark, d):
    suffix = t.suffix_after(F.col("file_name"), "found-")
    return g.result_lines(spark, d).groupBy("file_name").agg(F.count("*").alias("n")).select(
        "file_name", suffix.alias("suffix"), t.try_long(suffix).alias("run_id"), "n"
    )


@query(
    "supported_formats",
    LAKE + "select format, format in ('NTRIPLES', 'TURTLE', 'RDFXML') as supported, count(*) as n from lake group by all",
)
def _(spark, d):
    graphs = cat.all_graphs(g.catalog(spark, d))
    return graphs.groupBy("format").agg(F.count("*").alias("n")).withColumn(
        "supported", t.is_supported_format(F.col("format"))
    )


@query(
    "formatted_sizes",
    LAKE + "select graph, version, case when triples > 10000 then"
    " concat(printf('%.2e', cast(cast(triples as float) as double)), ' triples') when coalesce(triples, 0) <> 0"
    " then concat(triples, ' triples') else '' end as size from void_dataset",
)
def _(spark, d):
    return g.void_dataset(spark, d).select("graph", "version", t.format_size(F.col("triples")).alias("size"))


# --- statistics ---------------------------------------------------------------------------------

on_graph(
    "used_classes", stats.used_classes,
    f"select o as class, count(*) as n from triples where p = '{V.RDF_TYPE}' and o_kind = 'iri' group by o",
)
on_graph(
    "classes_defined", stats.classes_defined,
    f"select count(distinct s) as n from triples where p = '{V.RDF_TYPE}' and s_kind = 'iri'"
    f" and o in ('{V.RDFS_CLASS}', '{V.OWL_CLASS}')",
)
on_graph(
    "properties_defined", stats.properties_defined,
    f"select count(distinct s) as n from triples where p = '{V.RDF_TYPE}' and s_kind = 'iri'"
    f" and o in ('{V.OWL_OBJECT_PROPERTY}', '{V.RDF_PROPERTY}')",
)


def _depth_sql(predicate: str) -> str:
    return (
        f", edges as (select distinct s, o from triples where p = '{predicate}' and s_kind = 'iri' and o_kind = 'iri'),"
        " down(node, depth) as (select o, 0 from edges where o not in (select s from edges)"
        " union select e.s, depth + 1 from down join edges e on e.o = down.node)"
        " select node, max(depth) as depth from down group by node"
    )


on_graph("class_hierarchy_depth", stats.class_hierarchy_depth, _depth_sql(V.RDFS_SUBCLASS))
on_graph(
    "property_hierarchy_depth", stats.property_hierarchy_depth, _depth_sql(V.RDFS_SUBPROPERTY)
)
# Each part follows the one that squares give, so chains run into cycles.
_NEXT_PART = "(p_partkey * p_partkey + 7) % 97"


@query(
    "cyclic_hierarchy_depth",
    f"with recursive e as (select distinct p_partkey as a, {_NEXT_PART} as b from part),"
    " nodes as (select a as n from e union select b from e),"
    " r(x, y) as (select a, b from e union select r.x, e.b from r join e on e.a = r.y),"
    " looped as (select x from r where x = y),"
    # A part has one next one, so a chain ends at a part without one or at a cycle.
    " d(n, depth) as (select n, 0 from nodes where n not in (select a from e)"
    " union all select e.a, case when e.b in (select x from looped) then 1 else d.depth + 1 end from d join e on e.b = d.n"
    " where e.a not in (select x from looped)),"
    " c(n, depth) as (select a, 1 from e where b in (select x from looped) and a not in (select x from looped)"
    " union all select e.a, c.depth + 1 from c join e on e.b = c.n)"
    f" select concat('{g.BASE}part/P', n) as node, coalesce(max(depth), -1) as depth from"
    " (select * from d union all select * from c union all select x, null from looped) group by node",
)
def _(spark, d):
    parts = g.read_table(spark, d, "part")
    rows = parts.select(F.expr(g.PART).alias("s"), F.expr(f"concat('{g.BASE}part/P', {_NEXT_PART})").alias("o"))
    depth = paths.hierarchy_depth(t.resource_triples(rows, "s", F.lit(g.VOCAB + "followedBy"), "o"), g.VOCAB + "followedBy")
    return depth.select("node", F.coalesce("depth", F.lit(-1)).alias("depth"))


on_graph(
    "property_usage", stats.property_usage,
    "select p as property, count(*) as n from triples group by p",
)
on_graph(
    "properties_per_subject", stats.properties_per_subject,
    "select s, count(distinct p) as n from triples group by s",
)
on_graph(
    "properties_per_object", stats.properties_per_object,
    "select o, o_kind, o_datatype, o_lang, count(distinct p) as n from triples group by o, o_kind, o_datatype, o_lang",
)
on_graph(
    "subclass_usage", stats.subclass_usage,
    f"select count(*) as n from triples where p = '{V.RDFS_SUBCLASS}'",
)
on_graph("triple_count", stats.triple_count, "select count(*) as n from triples")
on_graph(
    "distinct_triple_count", stats.distinct_triple_count,
    f"select count(*) as n from (select distinct {COLUMNS} from triples)",
)
on_graph(
    "entities", stats.entities,
    "select count(distinct term) as n from (select s as term from triples where s_kind = 'iri'"
    " union select p from triples union select o from triples where o_kind = 'iri')",
)
on_graph(
    "distinct_subjects", stats.distinct_subjects,
    "select count(distinct s) as n from triples where s_kind = 'iri'",
)
on_graph(
    "distinct_objects", stats.distinct_objects,
    "select count(distinct o) as n from triples where o_kind = 'iri'",
)
on_graph("literals", stats.literals, f"select {COLUMNS} from triples where o_kind = 'literal'")
on_graph("blanks_as_subject", stats.blanks_as_subject, f"select {COLUMNS} from triples where s_kind = 'bnode'")
on_graph("blanks_as_object", stats.blanks_as_object, f"select {COLUMNS} from triples where o_kind = 'bnode'")
on_graph(
    "datatypes", stats.datatypes,
    "select o_datatype as datatype, count(*) as n from triples where o_datatype <> '' group by o_datatype",
)
on_graph(
    "languages", stats.languages,
    "select o_lang as lang, count(*) as n from triples where o_lang <> '' group by o_lang",
)


def _rounded(averages: DataFrame) -> DataFrame:
    return averages.select(F.round("avg_length", 6).alias("avg_length"))


on_graph(
    "avg_typed_string_length", lambda T: _rounded(stats.avg_typed_string_length(T)),
    f"select round(avg(length(o)), 6) as avg_length from triples where o_datatype = '{V.XSD_STRING}'",
)
on_graph(
    "avg_untyped_string_length", lambda T: _rounded(stats.avg_untyped_string_length(T)),
    "select round(avg(length(o)), 6) as avg_length from triples where o_lang <> ''",
)
on_graph("typed_subjects", stats.typed_subjects, f"select s from triples where p = '{V.RDF_TYPE}'")
on_graph("labelled_subjects", stats.labelled_subjects, f"select s from triples where p = '{V.RDFS_LABEL}'")
on_graph("same_as", stats.same_as, f"select {COLUMNS} from triples where p = '{V.OWL_SAME_AS}'")
on_graph(
    "links", stats.links,
    f"select ns_s, ns_o, count(*) as n from (select {NAMESPACE.format('s')} as ns_s, {NAMESPACE.format('o')} as ns_o"
    " from triples where s_kind = 'iri' and o_kind = 'iri') where ns_s <> ns_o group by all",
)
_NUMERIC = ", ".join(f"'{d}'" for d in V.ALL_NUMERIC_DATATYPES)
_TEMPORAL = ", ".join(f"'{d}'" for d in V.TEMPORAL_DATATYPES)
on_graph(
    "max_per_property", stats.max_per_property,
    f", valued as (select *, case when o_datatype in ({_NUMERIC}) then try_cast(o as double) end as number,"
    f" case when o_datatype in ({_TEMPORAL}) then try_cast(o as timestamp) end as moment"
    " from triples where o_kind = 'literal'), ranked as (select *, row_number() over (partition by p order by"
    " case when number is not null then 3 when moment is not null then 2 when o_lang <> '' then 1 else 0 end desc,"
    " number desc nulls last, moment desc nulls last, o desc, o_datatype desc, o_lang desc nulls last) as r from valued)"
    " select p as property, o, o_datatype, o_lang from ranked where r = 1",
)
on_graph(
    "avg_per_property", lambda T: stats.avg_per_property(T).select("property", F.round("avg_value", 6).alias("avg_value")),
    "select p as property, round(avg(try_cast(o as double)), 6) as avg_value from triples where o_datatype in ("
    + ", ".join(f"'{d}'" for d in V.NUMERIC_DATATYPES) + ") group by p",
)
for _position, _name in (("s", "subject"), ("p", "predicate"), ("o", "object")):
    on_graph(
        f"{_name}_vocabularies", lambda T, position=_position: stats.vocabularies(T, position),
        f"select {NAMESPACE.format(_position)} as ns, count(*) as n from triples"
        + ("" if _position == "p" else f" where {_position}_kind = 'iri'") + " group by all",
    )
on_graph(
    "all_vocabularies", stats.all_vocabularies,
    f", {TERMS} select distinct {NAMESPACE.format('term')} as ns from usage",
)


@query(
    "void_dataset",
    GRAPH + f", {TERMS}, listed as (select {NAMESPACE.format('term')} as ns from usage group by ns)"
    " select 'testbed' as graph, '1' as version, count_if(as_class > 0) as classes, count(*) as entities,"
    " count_if(as_s > 0) as distinct_subjects, count_if(as_o > 0) as distinct_objects, count_if(as_p > 0) as properties,"
    f" (select count(*) from (select distinct {COLUMNS} from triples)) as triples,"
    " (select string_agg(ns, ' ' order by ns) from listed) as vocabularies, true as is_valid from usage",
)
def _(spark, d):
    dataset = void_stats(g.triples(spark, d), "testbed", "1").dataset
    return dataset.withColumn("vocabularies", F.array_join("vocabularies", " "))


@query(
    "void_partition",
    GRAPH + f", {TERMS} select 'class' as kind, term as item, cast(as_class as bigint) as triples from usage"
    " where as_class > 0 union all select 'property', term, cast(as_p as bigint) from usage where as_p > 0",
)
def _(spark, d):
    return void_stats(g.triples(spark, d), "testbed", "1").partition.select("kind", "item", "triples")


@query(
    "lake_totals",
    LAKE + ", sized as (select case when ontology_namespace <> '' then 'ontologies' else 'instance graphs' end as part,"
    " triples from catalog left join (select * from void_dataset where is_valid) v"
    " on v.graph = dir_name and v.version = catalog.version where is_latest)"
    " select part, cast(coalesce(sum(triples), 0) as bigint) as triples from sized group by part"
    " union all select 'global', cast(coalesce(sum(triples), 0) as bigint) from sized",
)
def _(spark, d):
    return cat.lake_totals(g.catalog(spark, d), g.void_dataset(spark, d))


@query("graph_counts", LAKE + "select dir_name, count(*) as versions from catalog group by dir_name")
def _(spark, d):
    return cat.graph_counts(g.catalog(spark, d))


# --- graph patterns --------------------------------------------------------------------------------

@query(
    "graph_pattern",
    GRAPH + "select distinct o.s as ord, o.o as customer, n.o as nation, l.o as region_name from triples o"
    " join triples n on n.s = o.o join triples r on r.s = n.o join triples l on l.s = r.o join triples k on k.s = o.s"
    f" where o.p = '{g.WITHIN}' and n.p = '{g.IN_NATION}' and r.p = '{g.WITHIN}' and l.p = '{V.RDFS_LABEL}'"
    f" and k.p = '{g.STATUS}' and k.o = 'http://ex.org/status/F'",
)
def _(spark, d):
    graph = g.triples(spark, d, [g.WITHIN, g.IN_NATION, V.RDFS_LABEL, g.STATUS])
    return patterns.bgp(graph, [
        ("?ord", g.WITHIN, "?customer"), ("?customer", g.IN_NATION, "?nation"), ("?nation", g.WITHIN, "?region"),
        ("?region", V.RDFS_LABEL, "?region_name"), ("?ord", g.STATUS, g.BASE + "status/F"),
    ], ["ord", "customer", "nation", "region_name"], repeats=False)


@query(
    "literal_join",
    GRAPH + "select distinct a.s as part, b.s as concept from triples a join triples b on a.o = b.o"
    " join triples ta on ta.s = a.s join triples tb on tb.s = b.s"
    f" where a.p = '{V.RDFS_LABEL}' and b.p = '{V.RDFS_LABEL}' and ta.p = '{V.RDF_TYPE}'"
    f" and ta.o = '{g.CLASS}Part' and tb.p = '{V.RDF_TYPE}' and tb.o = '{g.CLASS}Concept'",
)
def _(spark, d):
    graph = g.triples(spark, d, [V.RDFS_LABEL, V.RDF_TYPE])
    return patterns.bgp(graph, [
        ("?concept", V.RDF_TYPE, g.CLASS + "Concept"), ("?concept", V.RDFS_LABEL, "?label"),
        ("?part", V.RDFS_LABEL, "?label"), ("?part", V.RDF_TYPE, g.CLASS + "Part"),
    ], ["part", "concept"])


on_graph(
    "repeated_variable", lambda T: patterns.bgp(T, [("?n", g.PARTNER, "?n")]),
    f"select distinct s as n from triples where p = '{g.PARTNER}' and s = o",
)
on_graph(
    "literal_constant", lambda T: patterns.bgp(T, [("?region", V.RDFS_LABEL, t.Literal("ASIA"))]),
    f"select distinct s as region from triples where p = '{V.RDFS_LABEL}' and o = 'ASIA'",
)
on_graph(
    "two_hop_siblings", lambda T: patterns.siblings(T, g.WITHIN, g.BASE + "nation/N0"),
    f"select distinct b.s as sibling from triples a join triples b on b.o = a.o where a.p = '{g.WITHIN}'"
    f" and b.p = '{g.WITHIN}' and a.s = 'http://ex.org/nation/N0'",
)


# --- walks -------------------------------------------------------------------------------------------

def _walk_sql(start: str, backward: bool, where: str, cap: int) -> str:
    near, far = ("o_term", "s") if backward else ("s", "o_term")
    return (
        f", edges as (select distinct s, {OBJECT_TERM} as o_term from triples where {where}),"
        f" walk(node, hops) as (select '{start}', 0 union select e.{far}, hops + 1 from walk"
        f" join edges e on e.{near} = walk.node where hops < {cap}),"
        f" found as (select node, min(hops) as hops from walk where node <> '{start}' group by node) "
    )


_IS_WITHIN = f"p = '{g.WITHIN}'"
_CUSTOMER_0 = g.BASE + "customer/C0"

on_graph(
    "descendants", lambda T: paths.property_path(T, g.WITHIN, g.REGION_0, paths.BACKWARD),
    _walk_sql(g.REGION_0, True, _IS_WITHIN, 10) + "select * from found",
)
on_graph(
    "descendants_two_hops", lambda T: paths.property_path(T, g.WITHIN, g.REGION_0, paths.BACKWARD, 2),
    _walk_sql(g.REGION_0, True, _IS_WITHIN, 2) + "select * from found",
)
on_graph(
    "ancestors", lambda T: paths.property_path(T, g.WITHIN, _CUSTOMER_0),
    _walk_sql(_CUSTOMER_0, False, _IS_WITHIN, 10) + "select * from found",
)
on_graph(
    "walk_as_triples", lambda T: paths.property_path_as_triples(T, g.WITHIN, g.REGION_0, paths.BACKWARD),
    _walk_sql(g.REGION_0, True, _IS_WITHIN, 10)
    + f"select node as s, 'iri' as s_kind, '{V.WALK_MEMBER}' as p, '{g.REGION_0}' as o, 'iri' as o_kind,"
    " cast(null as varchar) as o_datatype, cast(null as varchar) as o_lang from found",
)
on_graph(
    "reachable_forward", lambda T: paths.reachable_any(T, _CUSTOMER_0, paths.FORWARD, 4),
    _walk_sql(_CUSTOMER_0, False, "true", 4) + "select * from found",
)
on_graph(
    "reachable_backward", lambda T: paths.reachable_any(T, g.REGION_0, paths.BACKWARD, 10),
    _walk_sql(g.REGION_0, True, "true", 10) + "select * from found",
)
on_graph(
    "find_node", lambda T: paths.find_node(T, g.BASE + "nation/N3"),
    "select 'http://ex.org/nation/N3' as node where exists (select 1 from triples"
    " where (s = 'http://ex.org/nation/N3' and s_kind = 'iri') or (o = 'http://ex.org/nation/N3' and o_kind = 'iri'))",
)
on_graph(
    "minimum_size_guard", lambda T: paths.require_at_least(paths.property_path(T, g.WITHIN, g.REGION_0, paths.BACKWARD, 1), 5),
    _walk_sql(g.REGION_0, True, _IS_WITHIN, 1) + "select * from found",
)


# --- inference -------------------------------------------------------------------------------------------

_SC = (
    f", sc(src, dst) as (select distinct s, o from triples where p = '{V.RDFS_SUBCLASS}'"
    f" union select sc.src, t.o from sc join triples t on t.s = sc.dst and t.p = '{V.RDFS_SUBCLASS}')"
)
_SP = (
    f", sp(src, dst) as (select distinct s, o from triples where p = '{V.RDFS_SUBPROPERTY}'"
    f" union select sp.src, t.o from sp join triples t on t.s = sp.dst and t.p = '{V.RDFS_SUBPROPERTY}')"
)
_KIND = "case when starts_with({0}, '_:') then 'bnode' else 'iri' end"


def _resource(s: str, p: str, o: str) -> str:
    return (
        f"{s} as s, {_KIND.format(s)} as s_kind, {p} as p, {o} as o, {_KIND.format(o)} as o_kind,"
        " cast(null as varchar) as o_datatype, cast(null as varchar) as o_lang"
    )


_A = f"'{V.RDF_TYPE}'"

on_graph("subclass_closure", inference.subclass_closure, _SC + "select * from sc")
on_graph("subproperty_closure", inference.subproperty_closure, _SP + "select * from sp")
on_graph(
    "superproperty_triples", lambda T: inference.superproperty_triples(T, inference.subproperty_closure(T)),
    _SP + "select s, s_kind, sp.dst as p, o, o_kind, o_datatype, o_lang from triples join sp on p = sp.src",
)
on_graph(
    "domain_types", lambda T: inference.as_set(inference.domain_types(T, inference.pairs(T, V.RDFS_DOMAIN))),
    f"select distinct {_resource('t.s', _A, 'd.o')} from triples t join triples d on d.s = t.p"
    f" and d.p = '{V.RDFS_DOMAIN}'",
)
on_graph(
    "range_types", lambda T: inference.as_set(inference.range_types(T, inference.pairs(T, V.RDFS_RANGE))),
    f"select distinct {_resource('t.o', _A, 'd.o')} from triples t join triples d on d.s = t.p"
    f" and d.p = '{V.RDFS_RANGE}' where t.o_kind <> 'literal'",
)
_SUPERCLASS_SQL = (
    _SC + f"select distinct {_resource('t.s', _A, 'sc.dst')} from triples t join sc on sc.src = t.o"
    f" where t.p = '{V.RDF_TYPE}'"
)
on_graph(
    "superclass_types", lambda T: inference.as_set(inference.superclass_types(T, inference.subclass_closure(T))), _SUPERCLASS_SQL,
)
on_graph(
    "superclass_types_by_labels", lambda T: inference.as_set(inference.superclass_types_by_labels(
        T, reachability.build(inference.pairs(T, V.RDFS_SUBCLASS)))), _SUPERCLASS_SQL,
)


on_graph(
    "rdfs_closure", inference.rdfs_closure,
    _SC + _SP + f", wide as (select {COLUMNS} from triples union"
    " select s, s_kind, sp.dst, o, o_kind, o_datatype, o_lang from triples join sp on p = sp.src),"
    f" typed as (select * from wide union select {_resource('t.s', _A, 'd.o')} from wide t join triples d"
    f" on d.s = t.p and d.p = '{V.RDFS_DOMAIN}' union select {_resource('t.o', _A, 'd.o')} from wide t join triples d"
    f" on d.s = t.p and d.p = '{V.RDFS_RANGE}' where t.o_kind <> 'literal'),"
    f" closed as (select * from typed union select {_resource('t.s', _A, 'sc.dst')} from typed t join sc"
    f" on sc.src = t.o where t.p = '{V.RDF_TYPE}'"
    f" union select {_resource('src', repr(V.RDFS_SUBCLASS), 'dst')} from sc"
    f" union select {_resource('src', repr(V.RDFS_SUBPROPERTY), 'dst')} from sp)"
    + f" select {COLUMNS} from closed",
)
on_graph(
    "inverse_triples", lambda T: inference.as_set(inference.inverse_triples(T)),
    f", inv as (select s as a, o as b from triples where p = '{V.OWL_INVERSE_OF}'"
    f" union select o, s from triples where p = '{V.OWL_INVERSE_OF}')"
    f"select distinct {_resource('t.o', 'inv.b', 't.s')} from triples t join inv on inv.a = t.p"
    " where t.o_kind <> 'literal'",
)
on_graph(
    "symmetric_triples", lambda T: inference.as_set(inference.symmetric_triples(T)),
    f"select distinct {_resource('t.o', 't.p', 't.s')} from triples t join triples k on k.s = t.p and k.p = {_A}"
    f" and k.o = '{V.OWL_SYMMETRIC}' where t.o_kind <> 'literal'",
)
on_graph(
    "transitive_triples", inference.transitive_triples,
    f", te as (select distinct t.p, t.s, t.o from triples t join triples k on k.s = t.p and k.p = {_A}"
    f" and k.o = '{V.OWL_TRANSITIVE}' where t.o_kind <> 'literal'),"
    " tc(p, s, o) as (select p, s, o from te union select tc.p, tc.s, te.o from tc"
    f" join te on te.p = tc.p and te.s = tc.o) select {_resource('s', 'p', 'o')} from tc",
)
on_graph(
    "functional_same_as", inference.functional_same_as,
    f", f as (select distinct t.p, t.s as k, t.o as v from triples t join triples x on x.s = t.p and x.p = {_A}"
    f" and x.o = '{V.OWL_FUNCTIONAL}' union all select distinct t.p, t.o, t.s from triples t join triples x"
    f" on x.s = t.p and x.p = {_A} and x.o = '{V.OWL_INVERSE_FUNCTIONAL}'),"
    " m as (select p, k, min(v) as least from f group by p, k)"
    f" select distinct {_resource('v', repr(V.OWL_SAME_AS), 'least')} from f join m using (p, k) where v <> least",
)
_REPS = (
    f", se as (select s as a, o as b from triples where p = '{V.OWL_SAME_AS}' union"
    f" select o, s from triples where p = '{V.OWL_SAME_AS}'),"
    " cc(node, other) as (select a, b from se union select cc.node, se.b from cc join se on se.a = cc.other),"
    " reps as (select node, min(other) as representative from cc group by node having min(other) < node)"
)
on_graph("same_as_components", inference.same_as_components, _REPS + "select * from reps")
on_graph(
    "same_as_substitution", lambda T: inference.substitute_same_as(T, inference.same_as_components(T)),
    _REPS + " select distinct coalesce(a.representative, s) as s, s_kind, p, coalesce(b.representative, o) as o,"
    " o_kind, o_datatype, o_lang from triples left join reps a on a.node = s"
    " left join reps b on b.node = o and o_kind <> 'literal'"
    f" where p <> '{V.OWL_SAME_AS}' union select {_resource('node', repr(V.OWL_SAME_AS), 'representative')} from reps",
)


def _both_ways_sql(equivalence: str, sub: str) -> str:
    return (
        f"select {_resource('s', repr(sub), 'o')} from triples where p = '{equivalence}'"
        f" union select {_resource('o', repr(sub), 's')} from triples where p = '{equivalence}'"
        f" union select {_resource('a.s', repr(equivalence), 'a.o')} from triples a join triples b"
        f" on a.s = b.o and a.o = b.s where a.p = '{sub}' and b.p = '{sub}' and a.s <> a.o"
    )


on_graph(
    "equivalence_triples",
    lambda T: inference.as_set(inference.equivalence_triples(T)),
    _both_ways_sql(V.OWL_EQUIVALENT_CLASS, V.RDFS_SUBCLASS) + " union "
    + _both_ways_sql(V.OWL_EQUIVALENT_PROPERTY, V.RDFS_SUBPROPERTY),
)
on_graph(
    "restriction_triples", lambda T: inference.as_set(inference.restriction_triples(storage.materialize(T))),
    f", r as (select a.s as r, a.o as prop, b.p as kind, b.o as v from triples a join triples b on b.s = a.s"
    f" where a.p = '{V.OWL_ON_PROPERTY}' and b.p in ('{V.OWL_HAS_VALUE}', '{V.OWL_SOME_VALUES}',"
    f" '{V.OWL_ALL_VALUES}')), ty as (select s, o from triples where p = {_A}), added as ("
    f" select t.s, {_A} as p, r.r as o from triples t join r on t.p = r.prop and t.o = r.v"
    f" where r.kind = '{V.OWL_HAS_VALUE}'"
    f" union select ty.s, r.prop, r.v from ty join r on ty.o = r.r where r.kind = '{V.OWL_HAS_VALUE}'"
    f" union select t.s, {_A}, r.r from triples t join r on t.p = r.prop join ty on ty.s = t.o and ty.o = r.v"
    f" where r.kind = '{V.OWL_SOME_VALUES}'"
    f" union select t.o, {_A}, r.v from triples t join r on t.p = r.prop join ty on ty.s = t.s and ty.o = r.r"
    f" where r.kind = '{V.OWL_ALL_VALUES}') select {_resource('s', 'p', 'o')} from added",
)
# Three rounds are enough for these tables; the SQL runs two more, which add nothing.
on_graph("owl_horst_closure", lambda T: horst.owl_horst_closure(T), closure_sql.closure(5) + f" select {COLUMNS} from closed")
on_graph(
    "property_ranges", inference.property_ranges,
    f'select distinct s as property, o as "range" from triples where p in (\'{V.RDFS_RANGE}\', \'{V.DCAM_RANGE_INCLUDES}\')',
)
on_graph(
    "property_domains", inference.property_domains,
    f"select distinct s as property, o as domain from triples where p in ('{V.RDFS_DOMAIN}', '{V.DCAM_DOMAIN_INCLUDES}')",
)


def _enhanced(spark, d):
    graph = storage.materialize(g.triples(spark, d))
    partition = void_stats(graph, "testbed", "1").partition
    return enhance.enhance_void(partition, graph)


_ENHANCED_SQL = (
    f", {TERMS}, rng as (select s, string_agg(distinct o, ' ' order by o) as ranges from triples"
    f" where p in ('{V.RDFS_RANGE}', '{V.DCAM_RANGE_INCLUDES}') group by s),"
    " dom as (select s, string_agg(distinct o, ' ' order by o) as domains from triples"
    f" where p in ('{V.RDFS_DOMAIN}', '{V.DCAM_DOMAIN_INCLUDES}') group by s)"
)


@query(
    "enhanced_void",
    GRAPH + _ENHANCED_SQL + " select 'property' as kind, term as item, cast(as_p as bigint) as triples,"
    " coalesce(domains, '') as domains, coalesce(ranges, '') as ranges from usage left join rng on rng.s = term"
    " left join dom on dom.s = term where as_p > 0"
    " union all select 'class', term, cast(as_class as bigint), '', '' from usage where as_class > 0",
)
def _(spark, d):
    joined = [F.array_join(c, " ").alias(c) for c in ("domains", "ranges")]
    return _enhanced(spark, d).select("kind", "item", "triples", *joined)


@query(
    "ranges_of",
    GRAPH + _ENHANCED_SQL + " select term as property, ranges from usage join rng on rng.s = term where as_p > 0",
)
def _(spark, d):
    return enhance.ranges_of(_enhanced(spark, d)).select("property", F.array_join("ranges", " ").alias("ranges"))


@query(
    "domains_of",
    GRAPH + _ENHANCED_SQL + " select term as property, domains from usage join dom on dom.s = term where as_p > 0",
)
def _(spark, d):
    return enhance.domains_of(_enhanced(spark, d)).select("property", F.array_join("domains", " ").alias("domains"))


@query(
    "enhanced_void_round_trip",
    GRAPH + _ENHANCED_SQL + " select 'property' as kind, term as item, cast(as_p as bigint) as triples,"
    " coalesce(domains, '') as domains, coalesce(ranges, '') as ranges from usage left join rng on rng.s = term"
    " left join dom on dom.s = term where as_p > 0"
    " union all select 'class', term, cast(as_class as bigint), '', '' from usage where as_class > 0",
)
def _(spark, d):
    path = storage.shared_folder(spark)
    triples_sink.write_ntriples(enhance.enhanced_as_triples(_enhanced(spark, d)), path)
    back = void_src.enhanced_void_partition(triples_src.read_ntriples(spark, path, "shared"))
    joined = [F.array_join(c, " ").alias(c) for c in ("domains", "ranges")]
    return back.select("kind", "item", "triples", *joined)


# --- catalog and search -------------------------------------------------------------------------------------

_GRAPH_ROW = "dir_name, version, format, ontology_namespace, is_latest, graph_dir"


def _rows(graphs: DataFrame) -> DataFrame:
    return graphs.select(*_GRAPH_ROW.split(", "))


@query("all_graphs", LAKE + f"select {_GRAPH_ROW} from catalog")
def _(spark, d):
    return _rows(cat.all_graphs(g.catalog(spark, d)))


@query("latest_graphs", LAKE + f"select {_GRAPH_ROW} from catalog where is_latest")
def _(spark, d):
    return _rows(cat.latest_graphs(g.catalog(spark, d)))


for _latest in (True, False):
    for _name, _operator, _test in (
        ("instance_graphs", cat.instance_graphs, "= ''"), ("ontologies", cat.ontologies, "<> ''"),
    ):
        query(
            f"{'latest' if _latest else 'all'}_{_name}",
            LAKE + f"select {_GRAPH_ROW} from catalog where ontology_namespace {_test}"
            + (" and is_latest" if _latest else ""),
        )(lambda spark, d, operator=_operator, latest=_latest: _rows(operator(g.catalog(spark, d), latest)))


@query("graph_lookup", LAKE + f"select {_GRAPH_ROW} from catalog where dir_name = 'building_5' and is_latest")
def _(spark, d):
    return _rows(cat.select_graph(g.catalog(spark, d), "building_5"))


@query(
    "graph_lookup_version",
    LAKE + f"select {_GRAPH_ROW} from catalog where dir_name = 'building_5' and version = '1998-04'",
)
def _(spark, d):
    return _rows(cat.select_graph(g.catalog(spark, d), "building_5", "1998-04"))


@query(
    "graph_files",
    LAKE + ", f as (select dir_name, version, graph_dir, unnest(actual_file_list) as file_name from catalog)"
    " select dir_name, version, file_name, concat(graph_dir, '/', file_name) as file_path,"
    " concat('hdfs://lake', graph_dir, '/', file_name) as file_uri from f",
)
def _(spark, d):
    return cat.graph_files(g.catalog(spark, d), "hdfs://lake")


@query(
    "graph_metadata",
    LAKE + "select dir_name, version, concat('{\"download_url\":\"http://ex.org/download/\",\"compression\":\"\","
    "\"format\":\"', format, '\",\"ontology_namespace\":\"', ontology_namespace,"
    " '\",\"file_list\":[\"all.nt\"],\"actual_file_list\":[\"a.nt\",\"b', orders, '.nt\"]}') as metadata from catalog",
)
def _(spark, d):
    shown = ["dir_name", "version", "download_url", "compression", "format", "ontology_namespace", "file_list",
             "actual_file_list", "is_latest", "graph_dir"]
    described = cat.graph_metadata(g.catalog(spark, d).select(*shown))
    keyless = F.regexp_replace("metadata", r'"dir_name":"[^"]*","version":"[^"]*",', "")
    return described.select("dir_name", "version", keyless.alias("metadata"))


@query("graph_listing", LAKE + "select dir_name, version, concat(dir_name, ' ', version, ', ', format) as line from catalog")
def _(spark, d):
    return cat.graph_listing(g.catalog(spark, d), latest=False)


@query(
    "graph_listing_with_sizes",
    LAKE + "select dir_name, c.version, concat(dir_name, ' ', c.version, ', ', format, case when triples > 10000 then"
    " concat(', ', printf('%.2e', cast(cast(triples as float) as double)), ' triples') when coalesce(triples, 0) <> 0"
    " then concat(', ', triples, ' triples') else '' end,"
    " case when ontology_namespace <> '' then ', ontology' else ', instance graph' end) as line"
    " from catalog c left join (select * from void_dataset where is_valid) v"
    " on v.graph = dir_name and v.version = c.version where c.is_latest",
)
def _(spark, d):
    return cat.graph_listing(g.catalog(spark, d), g.void_dataset(spark, d))


@query(
    "void_counts",
    LAKE + "select graph, version, coalesce(entities, 0) as entities, coalesce(distinct_subjects, 0) as distinct_subjects,"
    " coalesce(distinct_objects, 0) as distinct_objects, coalesce(triples, 0) as triples from void_dataset",
)
def _(spark, d):
    return cat.void_counts(g.void_dataset(spark, d))


@query(
    "class_partition",
    LAKE + "select graph, version, item as class, triples from void_partition where kind = 'class'",
)
def _(spark, d):
    return cat.class_partition(g.void_partition(spark, d))


@query(
    "property_partition",
    LAKE + "select graph, version, item as property, triples from void_partition where kind = 'property'",
)
def _(spark, d):
    return cat.property_partition(g.void_partition(spark, d))


_ITEMS = [("class", "#P"), ("property", "URGENT"), ("any", "LOW")]


def _having_all(items, test: str) -> str:
    """Graphs that satisfy every item: one EXISTS per item."""
    return " and ".join(
        "exists (select 1 from void_partition v where v.graph = k.graph and v.version = k.version"
        + ("" if kind == "any" else f" and v.kind = '{kind}'") + f" and {test.format(pattern)})"
        for kind, pattern in items
    )


_GRAPHS = "(select distinct graph, version from void_partition) k"


@query("graphs_with_all_suffixes", LAKE + f"select graph, version from {_GRAPHS} where "
       + _having_all(_ITEMS, "ends_with(v.item, '{0}')"))
def _(spark, d):
    return search.graphs_with_all_suffixes(g.void_partition(spark, d), search.items_frame(spark, _ITEMS))


_EXACT = [("class", "http://ex.org/status#F"), ("property", "http://ex.org/priority#HIGH")]


@query("graphs_with_all_items", LAKE + f"select graph, version from {_GRAPHS} where "
       + _having_all(_EXACT, "v.item = '{0}'"))
def _(spark, d):
    return search.graphs_with_all_items(g.void_partition(spark, d), search.items_frame(spark, _EXACT))


@query(
    "find_graphs",
    LAKE + f", hits as (select graph, version from {_GRAPHS} where " + _having_all(_ITEMS, "ends_with(v.item, '{0}')")
    + ") select p.graph, p.version, c.graph_dir, p.kind, p.item, p.triples from void_partition p join hits h"
    " on h.graph = p.graph and h.version = p.version join catalog c on c.dir_name = p.graph and c.version = p.version"
    " where c.is_latest and ((p.kind = 'class' and contains(p.item, '#P')) or"
    " (p.kind = 'property' and contains(p.item, 'URGENT')) or contains(p.item, 'LOW'))",
)
def _(spark, d):
    return search.find_graphs(g.void_partition(spark, d), g.catalog(spark, d), search.items_frame(spark, _ITEMS))


@query(
    "expired_versions",
    LAKE + "select dir_name, version from (select *, row_number() over (partition by dir_name"
    " order by date_importation desc, version desc) as r from catalog) where r > 2",
)
def _(spark, d):
    return cat.expired_versions(g.catalog(spark, d)).select("dir_name", "version")


def _offered(spark, d):
    """The offered version of each graph: its second newest for some nations, else its newest, plus new graphs."""
    newest = cat.latest_graphs(g.catalog(spark, d)).select("dir_name", "version")
    changed = F.when(F.col("dir_name").endswith("3"), "2099-01").otherwise(F.col("version"))
    return newest.select("dir_name", changed.alias("version"))


_OFFERED_SQL = (
    ", offered as (select dir_name, case when ends_with(dir_name, '3') then '2099-01' else version end as version"
    " from catalog where is_latest)"
)


@query("pending_updates", LAKE + _OFFERED_SQL + " select * from offered where version = '2099-01'")
def _(spark, d):
    return cat.pending_updates(_offered(spark, d), g.catalog(spark, d))


@query("forced_updates", LAKE + _OFFERED_SQL + " select * from offered")
def _(spark, d):
    return cat.pending_updates(_offered(spark, d), g.catalog(spark, d), force=True)


@query(
    "available_together",
    LAKE + "select version from catalog where dir_name in ('building_5', 'machinery_7') group by version"
    " having count(distinct dir_name) = 2",
)
def _(spark, d):
    return cat.available_together(g.catalog(spark, d), ["building_5", "machinery_7"])


@query(
    "register_version",
    LAKE + "select dir_name, version, is_latest and not ends_with(dir_name, '3') as is_latest,"
    " cast(date_importation as varchar) as imported from catalog union all"
    " select dir_name, '2099-01', true, '2099-01-02 00:00:00' from catalog where is_latest and ends_with(dir_name, '3')",
)
def _(spark, d):
    catalog = cat.all_graphs(g.catalog(spark, d))
    added = catalog.where("is_latest and endswith(dir_name, '3')").withColumn("version", F.lit("2099-01"))
    result = cat.register_version(catalog, added, "2099-01-02 00:00:00")
    return result.select("dir_name", "version", "is_latest", F.col("date_importation").cast("string").alias("imported"))


@query(
    "select_ontologies",
    LAKE + "select dir_name, c.version from catalog c left join (select * from void_dataset where is_valid) v"
    " on v.graph = dir_name and v.version = c.version where c.is_latest and ontology_namespace <> ''"
    " and coalesce(triples, 0) <= 3000",
)
def _(spark, d):
    chosen = enhance.select_ontologies(cat.all_graphs(g.catalog(spark, d)), g.void_dataset(spark, d), 3000)
    return chosen.select("dir_name", "version")


@query(
    "catalog_defaults",
    "select distinct case when c_nationkey % 3 <> 0 then c_mktsegment else 'NoDirNameSpecified' end as dir_name,"
    " case when c_nationkey % 4 <> 0 then cast(c_nationkey as varchar) else 'NoVersionSpecified' end as version,"
    " 'NoFormatSpecified' as format, '' as ontology_namespace, 'NoFileListSpecified' as files,"
    " concat('/data/', case when c_nationkey % 3 <> 0 then c_mktsegment else 'NoDirNameSpecified' end, '_v',"
    " case when c_nationkey % 4 <> 0 then cast(c_nationkey as varchar) else 'NoVersionSpecified' end) as graph_dir"
    " from customer",
)
def _(spark, d):
    nation, null = F.col("c_nationkey"), F.lit(None).cast("string")
    raw = g.read_table(spark, d, "customer").select(
        F.when(nation % 3 != 0, F.col("c_mktsegment")).alias("dir_name"),
        F.when(nation % 4 != 0, nation.cast("string")).alias("version"),
        *(null.alias(c) for c in ("download_url", "compression", "format", "ontology_namespace",
                                  "date_importation_msd", "file_path")),
        *(F.lit(None).cast("array<string>").alias(c) for c in ("file_list", "actual_file_list")),
    ).distinct()
    rows = catalog_src.with_defaults(raw, "/data")
    return rows.select(
        "dir_name", "version", "format", "ontology_namespace", F.array_join("actual_file_list", " ").alias("files"),
        "graph_dir",
    )


# --- result tracking ------------------------------------------------------------------------------------------

def _results(spark, d):
    return results_src.parse_results(g.result_lines(spark, d), "found-")


def _runs(spark, d):
    return results_src.runs_of(g.result_lines(spark, d).select("file_name"), "found-")


_NEWS = (
    f", runs as (select distinct run_id from ({g.RUNS_SQL}) order by run_id desc limit 2),"
    " news as (select s, p, o from results where run_id = (select max(run_id) from runs)"
    " except select s, p, o from results where run_id = (select min(run_id) from runs))"
)


@query("parse_results", RESULTS + "select run_id, s, p, o from results")
def _(spark, d):
    return _results(spark, d)


@query(
    "latest_two",
    RESULTS + "select run_id, row_number() over (order by run_id desc) as age from"
    f" (select distinct run_id from ({g.RUNS_SQL}) order by run_id desc limit 2)",
)
def _(spark, d):
    return res.latest_two(_runs(spark, d)).select("run_id", F.col("age").cast("bigint").alias("age"))


@query("new_results", RESULTS + _NEWS + " select * from news")
def _(spark, d):
    return res.new_results(_results(spark, d), _runs(spark, d))


@query("has_news", RESULTS + _NEWS + " select count(*) > 0 as has_news from news")
def _(spark, d):
    return res.new_results(_results(spark, d), _runs(spark, d)).limit(1).agg((F.count("*") > 0).alias("has_news"))


_REPORT = (
    " select 1 as section, case when (select count(*) from news) = 0 then '# NO newer results' else"
    f" concat('<http://ex.org/report> <{V.PROV_DERIVED}> <http://ex.org/found-', (select max(run_id) from runs), '>')"
    " end as line union all select 2, concat('<', s, '> <', p, '> <', o, '>') from news"
)


@query("diff_report", RESULTS + _NEWS + _REPORT)
def _(spark, d):
    return res.diff_report(_results(spark, d), _runs(spark, d), "http://ex.org/report", "http://ex.org/found-")


@query("diff_report_file", RESULTS + _NEWS + f" select line from ({_REPORT})")
def _(spark, d):
    path = storage.shared_folder(spark) + "-report"
    report = res.diff_report(_results(spark, d), _runs(spark, d), "http://ex.org/report", "http://ex.org/found-")
    single_file.write_single_file(report.orderBy("section", "line").select("line"), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


# --- exploration ------------------------------------------------------------------------------------------------

_Rule = tables_src.Rule
_MESH = g.iri("mesh", "", "replace(p_brand, '#', '')")
_SUBSTANCE = g.iri("substance", "E", "event_id")
_TOP = g.CLASS + "Product"
LITERATURE = {
    "taxonomy": ("part", [
        _Rule(V.RDFS_SUBCLASS, g.BRAND, g.KIND),
        _Rule(V.RDFS_SUBCLASS, g.KIND, g._class("Product")),
        _Rule(V.RDFS_LABEL, g.BRAND, "p_brand", V.XSD_STRING),
    ]),
    "headings": ("part", [
        _Rule(V.RDFS_LABEL, _MESH, "p_brand", V.XSD_STRING),
        _Rule(V.RDF_TYPE, _MESH, f"'{explore.MESHV}TopicalDescriptor'"),
    ]),
    "references": ("documents", [
        _Rule(explore.SUBJECT_TERMS[0], g.DOCUMENT, g.iri("mesh", "Brand", "doc_id % 30")),
        _Rule(explore.SUBJECT_TERMS[1], g.DOCUMENT, g.iri("mesh", "Brand", "doc_id % 7")),
        _Rule(explore.DCT_TITLE, g.DOCUMENT, "source", V.XSD_STRING),
    ]),
    "substances": ("events", [
        _Rule(explore.CITO + "isDiscussedBy", _SUBSTANCE, g.iri("document", "D", "event_id")),
        _Rule(explore.SIO + "CHEMINF_000477", _SUBSTANCE, g.iri("compound", "CID", "user_id")),
    ]),
}
_ARTICLES_SQL = (
    "with b as (select distinct p_brand, replace(p_brand, '#', '') as k from part),"
    " terms as (select doc_id, source, concat('Brand', doc_id % 30) as k, 1 as q from documents union all"
    " select doc_id, source, concat('Brand', doc_id % 7), 2 from documents),"
    " articles as (select distinct q, concat('http://ex.org/document/D', doc_id) as pmid, source as \"pmidTitle\","
    " concat('http://ex.org/compound/CID', user_id) as compound, concat('http://ex.org/brand/', b.k) as \"cousinId\""
    " from terms join b on b.k = terms.k join events on event_id = doc_id)"
)


def _articles(spark, d):
    parts = {
        name: tables_src.tables_to_triples(g.read_table(spark, d, source), rules)
        for name, (source, rules) in LITERATURE.items()
    }
    others = parts["headings"].unionByName(parts["references"]).unionByName(parts["substances"])
    return explore.explore(parts["taxonomy"], others, _TOP, minimum=5)


@query(
    "explore_run",
    _ARTICLES_SQL + f" select distinct 7 as run_id, compound as s, '{V.SKOS_RELATED}' as p, '{_TOP}' as o from articles",
)
def _(spark, d):
    """The graphs stored in a lake, explored from the catalog's names, and the run read back."""
    lake = storage.shared_folder(spark)
    rows = []
    for name, (source, rules) in LITERATURE.items():
        triples_sink.write_triples_parquet(
            tables_src.tables_to_triples(g.read_table(spark, d, source), rules), f"{lake}/{name}_v1.parquet/run-1")
        rows.append((name, "1", "NT", f"{lake}/{name}_v1"))
    given = spark.createDataFrame(rows, "dir_name string, version string, format string, graph_dir string").selectExpr(
        "dir_name", "version", "format", "graph_dir", "array('none.nt') as actual_file_list", "'' as ontology_namespace",
        "timestamp '2024-01-01' as date_importation", "true as is_latest")
    explore.explore_run(given, "taxonomy", ["headings", "references", "substances"], _TOP, _TOP, lake, "found-", 5, 7)
    runs, results = results_src.read_results(spark, lake, "found-")
    return results.join(runs, "run_id")


@query("explore_articles", _ARTICLES_SQL + ' select pmid, "pmidTitle", compound, "cousinId" from articles')
def _(spark, d):
    return explore.article_listing(_articles(spark, d))


@query(
    "explore_compounds",
    _ARTICLES_SQL + f" select distinct compound as s, '{V.SKOS_RELATED}' as p, '{_TOP}' as o from articles",
)
def _(spark, d):
    return explore.compounds(_articles(spark, d), _TOP).select("s", "p", "o")


# --- sources and sinks ----------------------------------------------------------------------------------------------

@query("ntriples_round_trip", GRAPH + f"select {COLUMNS} from triples")
def _(spark, d):
    path = storage.shared_folder(spark)
    triples_sink.write_ntriples(g.triples(spark, d), path)
    return triples_src.read_ntriples(spark, path, blank_nodes="shared")


@query("document_text_round_trip", "select concat('http://ex.org/document/D', doc_id) as s, md5(text) as digest,"
       " length(text) as len from documents")
def _(spark, d):
    rules = [_Rule(V.RDFS_LABEL, g.DOCUMENT, "text", V.XSD_STRING)]
    path = storage.shared_folder(spark)
    triples_sink.write_ntriples(tables_src.tables_to_triples(g.read_table(spark, d, "documents"), rules), path)
    back = triples_src.read_ntriples(spark, path)
    return back.select("s", F.md5("o").alias("digest"), F.length("o").alias("len"))


@query("parquet_round_trip", GRAPH + f"select {COLUMNS} from triples")
def _(spark, d):
    path = storage.shared_folder(spark)
    triples_sink.write_triples_parquet(g.triples(spark, d), path)
    return triples_src.read_triples_parquet(spark, path)


# One line per document: a literal with valid escapes, an escape that does not exist, a short numeric one, a space in
# an IRI, an escaped character in an IRI, half a surrogate pair, a slash escape.
_LINE_ENDS = [r'"say \"\u00e9\U0001F600\""', r'"C:\qdir"', r'"bad \u12G4"', "<http://ex.org/not an iri>",
              r"<http://ex.org/c\u003Ed>", r'"\uD800"', r'"a\/b"']


@query(
    "ntriples_strictness",
    "select doc_id % 7 as kind, doc_id % 7 in (0, 4) as is_statement, count(*) as n, case doc_id % 7"
    " when 0 then 'say \"é😀\"' when 4 then 'http://ex.org/c>d' end as o from documents group by all",
)
def _(spark, d):
    path = storage.shared_folder(spark) + "-strict"
    docs = g.read_table(spark, d, "documents").select("doc_id")
    ends = F.element_at(F.array(*[F.lit(end) for end in _LINE_ENDS]), (F.col("doc_id") % 7 + 1).cast("int"))
    line = F.concat(F.lit("<http://ex.org/document/D"), "doc_id", F.lit("> <http://ex.org/p> "), ends, F.lit(" ."))
    docs.select(line.alias("value")).write.text(path)
    number = r"document/D(\d+)"
    read = triples_src.read_ntriples(spark, path)
    again = path + "-again"
    triples_sink.write_ntriples(read, again)  # what was read is written and read again
    good = triples_src.read_ntriples(spark, again).select("s", "o", F.lit(True).alias("is_statement"))
    bad = triples_src.ntriples_rejects(spark, path).select(
        F.col("value").alias("s"), F.lit(None).cast("string").alias("o"), F.lit(False).alias("is_statement"))
    rows = good.unionByName(bad).withColumn("kind", F.regexp_extract("s", number, 1).cast("bigint") % 7)
    return rows.groupBy("kind", "is_statement", "o").agg(F.count("*").alias("n"))


@query("ntriples_rejects", "select concat('page ', url) as value from pages")
def _(spark, d):
    path = storage.shared_folder(spark)
    pages = g.read_table(spark, d, "pages").select(F.concat(F.lit("page "), "url").alias("value"))
    pages.write.text(path)
    return triples_src.ntriples_rejects(spark, path).select("value")


def _stored_lake(spark, d):
    """Three graphs, one per table, stored as Parquet, with their catalog."""
    root = storage.shared_folder(spark)
    names = ["orders", "customer", "documents"]
    for name in names:
        triples_sink.write_triples_parquet(g.triples(spark, d, tables=[name]), f"{root}/{name}_v1.parquet")
    rows = [(n, "1", "NT", ["a.nt"], "2024-01-31", f"{root}/{n}_metadata_latest") for n in names]
    metadata = spark.createDataFrame(
        rows, "dir_name string, version string, format string, actual_file_list array<string>,"
        " date_importation_msd string, file_path string",
    ).withColumns({name: F.lit(None).cast("string") for name in ("download_url", "compression", "ontology_namespace")})
    return catalog_src.with_defaults(metadata.withColumn("file_list", F.col("actual_file_list")), root)


@query("read_graph", "with " + g.triples_sql(["orders"]) + f" select {COLUMNS} from triples")
def _(spark, d):
    return triples_src.read_graph(_stored_lake(spark, d), "orders", force_parquet=True)


@query(
    "read_graphs",
    "with " + g.triples_sql(["orders", "customer", "documents"]) + " select p, count(*) as n from triples group by p",
)
def _(spark, d):
    graphs = [("orders", "1"), ("customer", ""), ("documents", "1")]
    return triples_src.read_graphs(_stored_lake(spark, d), graphs).groupBy("p").agg(F.count("*").alias("n"))


@query("tables_to_triples", "with " + g.triples_sql(["part"]) + f" select {COLUMNS} from triples")
def _(spark, d):
    return tables_src.tables_to_triples(g.read_table(spark, d, "part"), g.RULES["part"])


def _table_dump(spark, d):
    """The part table as the nested JSON of a scraped HTML table, header row included; some cells missing."""
    part = g.read_table(spark, d, "part")

    def cell(text):
        return F.struct(text.cast("string").alias("text"), F.lit(None).cast("array<struct<text:string,href:string>>")
                        .alias("children"))

    link = F.struct(
        F.lit(None).cast("string").alias("text"),
        F.array(F.struct(F.concat(F.lit("P"), "p_partkey").alias("text"),
                         F.concat(F.lit("info?id=P"), "p_partkey").alias("href"))).alias("children"),
    )
    cells = F.array(link, cell(F.col("p_size")), cell(F.col("p_name")), cell(F.col("p_brand")),
                    cell(F.col("p_retailprice").cast("decimal(18,2)")))
    full = F.when(F.col("p_partkey") % 5 == 0, cells).otherwise(F.array_append(cells, cell(F.col("p_type"))))
    rows = part.select(full.alias("children"))
    header = spark.range(1).select(F.array(*(cell(F.lit(h)) for h in ("ID", "CAS", "Name"))).alias("children"))
    path = storage.shared_folder(spark)
    header.unionByName(rows).write.json(path)
    columns = ["id", "cas_id", "name", "formula", "mass", "taxon"]
    return tables_src.read_json_rows(spark, path, columns, "http://ex.org/core/")


_DUMP_SQL = (
    "dump as (select concat('http://ex.org/core/info?id=P', p_partkey) as uri, concat('P', p_partkey) as id,"
    " cast(p_size as varchar) as cas_id, p_name as name, p_brand as formula,"
    " cast(cast(p_retailprice as decimal(18,2)) as varchar) as mass,"
    " case when p_partkey % 5 = 0 then '' else p_type end as taxon from part)"
)


@query("json_table_rows", f"with {_DUMP_SQL} select * from dump")
def _(spark, d):
    return _table_dump(spark, d)


_OBO = "http://www.geneontology.org/formats/oboInOwl#"
_CHEBI = "http://purl.obolibrary.org/obo/chebi#"


@query(
    "compound_triples",
    f"with {_DUMP_SQL} select uri as s, '{V.RDF_TYPE}' as p, '{g.VOCAB}Compound' as o from dump"
    f" union all select uri, '{V.RDF_TYPE}', '{g.VOCAB}KnapsackCompound' from dump"
    f" union all select uri, '{V.RDFS_LABEL}', name from dump union all select uri, '{V.RDFS_LABEL}', id from dump"
    f" union all select uri, '{_OBO}hasExactSynonym', name from dump"
    f" union all select uri, '{_CHEBI}formula', formula from dump"
    f" union all select uri, '{_CHEBI}mass', mass from dump"
    f" union all select uri, '{g.VOCAB}taxon', taxon from dump"
    f" union all select uri, '{_OBO}hasDbXref', concat('CAS:', cas_id) from dump",
)
def _(spark, d):
    return tables_src.tables_to_triples(_table_dump(spark, d), tables_src.compound_rules(g.VOCAB)).select("s", "p", "o")


for _tag in ("li", "p", "title"):
    query(
        f"html_{_tag}_elements",
        "with e as (select page_id, regexp_extract_all(html,"
        rf" '(?is)<{_tag}\b[^>]*>(.*?)</{_tag}\s*>', 1) as found from pages),"
        " x as (select page_id, unnest(found) as inner_html, generate_subscripts(found, 1) - 1 as position from e)"
        " select page_id, position, inner_html, trim(regexp_replace(inner_html, '<[^>]*>', '', 'g')) as text from x",
    )(lambda spark, d, tag=_tag: web.html_elements(g.read_table(spark, d, "pages"), tag))


@query(
    "extract_links",
    "with e as (select page_id, unnest(regexp_extract_all(html, 'a href=\"(\\S+)\"', 1)) as link from pages)"
    " select page_id, link from e where contains(link, 'en')",
)
def _(spark, d):
    return web.extract_links(g.read_table(spark, d, "pages"), "en")


@query(
    "extract_versions",
    "select page_id, regexp_extract_all(url, '[0-9]+', 0)[1] as first_number,"
    " regexp_extract_all(html, '[0-9]+', 0)[3] as third_number,"
    " regexp_replace(url, '^https?://([^/]+)/.*$', '\\1') as host, concat('SHA_', substr(md5(html), 1, 8)) as hash_version"
    " from pages",
)
def _(spark, d):
    return g.read_table(spark, d, "pages").select(
        "page_id", web.nth_match(F.col("url"), "[0-9]+").alias("first_number"),
        web.nth_match(F.col("html"), "[0-9]+", 3).alias("third_number"),
        web.version_by_substitution(F.col("url"), "^https?://([^/]+)/.*$").alias("host"),
        web.hash_version(F.md5("html")).alias("hash_version"),
    )


@query("date_versions", "select substr(cast(ts as varchar), 1, 10) as version, count(*) as n from events group by all")
def _(spark, d):
    events = g.read_table(spark, d, "events")
    return events.groupBy(web.date_version(F.col("ts").cast("string")).alias("version")).agg(F.count("*").alias("n"))


_PREFIX_TEXT = "\n".join(f"@prefix {name}: <{iri}> ." for name, iri in void_sink.PREFIXES.items())


def _block_sql(kind: str, column: str) -> str:
    return (
        f"(select concat(chr(10), 'void:{kind}Partition ', string_agg(concat('[ ', chr(10), 'void:{kind} <', term,"
        f" '>; ', chr(10), 'void:triples ', {column}, ';', chr(10), ']'), ',' order by {column} desc, term), ';')"
        f" from (select term, {column} from usage where {column} > 0 order by {column} desc, term))"
    )


@query(
    "void_turtle",
    GRAPH + f", {TERMS}, listed as (select {NAMESPACE.format('term')} as ns from usage group by ns)"
    f" select concat('{_PREFIX_TEXT}', chr(10), '<{V.VOID_SOURCE}/data/testbed_v1>', chr(10),"
    " chr(10), 'void:classes ', count_if(as_class > 0), ';', " + _block_sql("class", "as_class") + ","
    " chr(10), 'void:entities ', count(*), ';', chr(10), 'void:distinctSubjects ', count_if(as_s > 0), ';',"
    " chr(10), 'void:distinctObjects ', count_if(as_o > 0), ';', chr(10), 'void:properties ', count_if(as_p > 0), ';', "
    + _block_sql("property", "as_p") + ", chr(10), 'void:triples ',"
    f" (select count(*) from (select distinct {COLUMNS} from triples)), ';', chr(10), 'void:vocabulary  <',"
    " (select string_agg(ns, '>, <' order by ns) from listed), '>;', chr(10), 'a void:Dataset .') as value from usage",
)
def _(spark, d):
    summary = void_stats(g.triples(spark, d), "testbed", "1")
    return void_sink.void_to_turtle(summary.dataset, summary.partition, F.lit("/data/testbed_v1")).select("value")


def _void_texts(spark, d):
    """The summaries of the derived lake, written as Turtle and read back; one file per summary."""
    dataset = g.void_dataset(spark, d).withColumn("vocabularies", F.array(F.lit("http://ex.org/vocab#")))
    turtle = void_sink.void_to_turtle(
        dataset, g.void_partition(spark, d), F.concat(F.lit("/data/"), "graph", F.lit("_v"), "version")
    )
    broken = F.when(F.substring("version", 7, 1) == "5", F.replace("value", F.lit("a void:Dataset ."), F.lit("a <")))
    return void_src.with_source(turtle.select(F.coalesce(broken, "value").alias("value")))


@query(
    "read_void_dataset",
    LAKE + "select graph, version, classes, coalesce(entities, 0) as entities, distinct_subjects,"
    " coalesce(distinct_objects, 0) as distinct_objects, properties, coalesce(triples, 0) as triples,"
    " 'http://ex.org/vocab#' as vocabularies, is_valid from void_dataset",
)
def _(spark, d):
    rows = void_src.void_dataset(_void_texts(spark, d)).drop("graph_dir")
    return rows.withColumn("vocabularies", F.array_join("vocabularies", " "))


@query(
    "read_void_partition",
    LAKE + "select p.graph, p.version, kind, item, p.triples from void_partition p"
    " where substr(p.version, 7, 1) <> '5'",
)
def _(spark, d):
    return void_src.void_partition(_void_texts(spark, d))


@query(
    "raw_void",
    LAKE + "select 'building_5' as graph,"
    " exists (select 1 from void_dataset where graph = 'building_5' and version = '1998-04') as found,"
    " exists (select 1 from void_dataset where graph = 'building_5' and version = '1900-01') as found_absent",
)
def _(spark, d):
    texts = _void_texts(spark, d)
    here = cat.raw_void(texts, "building_5", "1998-04").withColumn("which", F.lit("found"))
    absent = cat.raw_void(texts, "building_5", "1900-01").withColumn("which", F.lit("absent"))
    return here.unionByName(absent).agg(
        F.lit("building_5").alias("graph"),
        F.max((F.col("which") == "found") & (F.col("value") != "")).alias("found"),
        F.max((F.col("which") == "absent") & (F.col("value") != "")).alias("found_absent"),
    )


# --- flagship -----------------------------------------------------------------------------------------------------------

@query(
    "regional_part_ranking",
    GRAPH + _walk_sql(g.REGION_0, True, _IS_WITHIN, 10).rstrip() + " select l.o as label, count(distinct c.s) as orders"
    f" from found join triples c on c.s = found.node and c.p = '{g.CONTAINS}'"
    f" join triples l on l.s = c.o and l.p = '{V.RDFS_LABEL}' group by l.o",
)
def regional_part_ranking(spark, d):
    """Everything within one region, the parts its orders contain, and those parts' names by number of orders."""
    walked = paths.property_path_as_triples(
        g.triples(spark, d, [g.WITHIN]), g.WITHIN, g.REGION_0, paths.BACKWARD)
    graph = g.triples(spark, d, [g.CONTAINS, V.RDFS_LABEL]).unionByName(walked)
    rows = patterns.bgp(graph, [
        ("?ord", V.WALK_MEMBER, g.REGION_0), ("?ord", g.CONTAINS, "?part"), ("?part", V.RDFS_LABEL, "?label"),
    ], ["ord", "part", "label"], repeats=False)
    return rows.groupBy("label").agg(F.countDistinct("ord").alias("orders")).orderBy(F.desc("orders"), "label")
