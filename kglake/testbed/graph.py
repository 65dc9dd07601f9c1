"""The supplied star-schema tables as a knowledge graph, in Spark and as SQL text.

The mapping is stated once, as rules per table. Spark runs it through `tables_to_triples`;
the SQL text is one select per rule, which an outside engine can run on the same tables.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.sources.tables import Rule, tables_to_triples

BASE = "http://ex.org/"
VOCAB = BASE + "vocab#"
CLASS = BASE + "class/"

WITHIN, IN_NATION, CONTAINS, CONTAINED_IN = (VOCAB + n for n in ("within", "inNation", "contains", "containedIn"))
RELATED, PARTNER, PICK, DIGEST = (VOCAB + n for n in ("related", "partner", "pick", "digest"))
STATUS, BALANCE, PRICE, SIZE = (VOCAB + n for n in ("status", "balance", "price", "size"))
ORIGIN, MADE_BY, USER, AT, VALUE = (VOCAB + n for n in ("origin", "madeBy", "user", "at", "value"))

REGION_0 = BASE + "region/R0"


def iri(kind: str, letter: str, key: str) -> str:
    return f"concat('{BASE}{kind}/{letter}', {key})"


def _class(name: str) -> str:
    return f"'{CLASS}{name}'"


def _money(column: str) -> str:
    return f"cast({column} as decimal(18, 2))"


ORDER, CUSTOMER = iri("order", "O", "o_orderkey"), iri("customer", "C", "c_custkey")
SUPPLIER, PART = iri("supplier", "S", "s_suppkey"), iri("part", "P", "p_partkey")
SUPPLIES = iri("supplies", "S", "s_suppkey")
BRAND = iri("brand", "", "replace(p_brand, '#', '')")
KIND = iri("kind", "", "p_type")
CONCEPT = iri("concept", "", "replace(p_name, ' ', '-')")
DOCUMENT = iri("document", "D", "doc_id")
EVENT = "concat('_:e', event_id)"

RULES: dict[str, list[Rule]] = {
    "region": [
        Rule(V.RDF_TYPE, iri("region", "R", "r_regionkey"), _class("Region")),
        Rule(V.RDFS_LABEL, iri("region", "R", "r_regionkey"), "r_name", V.XSD_STRING),
    ],
    "nation": [
        Rule(V.RDF_TYPE, iri("nation", "N", "n_nationkey"), _class("Nation")),
        Rule(WITHIN, iri("nation", "N", "n_nationkey"), iri("region", "R", "n_regionkey")),
        Rule(PARTNER, iri("nation", "N", "n_nationkey"), iri("nation", "N", "(n_nationkey * 7 + 3) % 25")),
        Rule(V.RDFS_LABEL, iri("nation", "N", "n_nationkey"), "n_name", V.XSD_STRING),
        Rule(V.RDFS_SUBPROPERTY, iri("supplies", "N", "n_nationkey"), iri("supplies", "R", "n_regionkey")),
    ],
    "customer": [
        Rule(V.RDF_TYPE, CUSTOMER, _class("Customer")),
        Rule(V.RDF_TYPE, CUSTOMER, f"case when c_acctbal < 0 then {_class('Debtor')} end"),
        Rule(WITHIN, CUSTOMER, iri("nation", "N", "c_nationkey")),
        Rule(IN_NATION, CUSTOMER, iri("nation", "N", "c_nationkey")),
        Rule(V.RDFS_LABEL, CUSTOMER, "c_name", V.XSD_STRING),
        Rule(BALANCE, CUSTOMER, _money("c_acctbal"), V.XSD + "double"),
    ],
    "supplier": [
        Rule(V.RDF_TYPE, SUPPLIER, _class("Supplier")),
        Rule(WITHIN, SUPPLIER, iri("nation", "N", "s_nationkey")),
        Rule(V.RDFS_LABEL, SUPPLIER, "s_name", V.XSD_STRING),
        Rule(BALANCE, SUPPLIER, _money("s_acctbal"), V.XSD + "double"),
        # A property per supplier, below one per nation and region: schema rows that grow with the tables.
        Rule(V.RDF_TYPE, SUPPLIES, f"'{V.RDF_PROPERTY}'"),
        Rule(V.RDFS_SUBPROPERTY, SUPPLIES, iri("supplies", "N", "s_nationkey")),
        Rule(V.RDFS_DOMAIN, SUPPLIES, _class("Supplier")),
        Rule(V.RDFS_RANGE, SUPPLIES, f"case when s_acctbal < 0 then {_class('Order')} else {_class('Part')} end"),
        Rule(V.OWL_EQUIVALENT_PROPERTY, SUPPLIES, iri("delivers", "S", "s_suppkey")),
    ],
    "part": [
        Rule(V.RDF_TYPE, PART, _class("Part")),
        Rule(V.RDFS_LABEL, PART, "p_name", V.XSD_STRING),
        Rule(MADE_BY, PART, BRAND),
        Rule(SIZE, PART, "p_size", V.XSD + "integer"),
        Rule(PRICE, PART, _money("p_retailprice"), V.XSD + "double"),
        Rule(PICK, BRAND, iri("size", "Z", "p_size")),
        Rule(V.RDFS_SUBCLASS, BRAND, KIND),
        Rule(V.RDF_TYPE, BRAND, f"'{V.RDFS_CLASS}'"),
        Rule(V.RDFS_SUBCLASS, KIND, _class("Product")),
        Rule(V.RDF_TYPE, CONCEPT, _class("Concept")),
        Rule(V.RDFS_LABEL, CONCEPT, "p_name", V.XSD_STRING),
    ],
    "orders": [
        Rule(V.RDF_TYPE, ORDER, _class("Order")),
        Rule(WITHIN, ORDER, iri("customer", "C", "o_custkey")),
        Rule(STATUS, ORDER, iri("status", "", "o_orderstatus")),
        Rule(PRICE, ORDER, _money("o_totalprice"), V.XSD + "double"),
    ],
    "lineitem": [
        Rule(CONTAINS, iri("order", "O", "l_orderkey"), iri("part", "P", "l_partkey")),
    ],
    "documents": [
        Rule(V.RDF_TYPE, DOCUMENT, _class("Document")),
        Rule(ORIGIN, DOCUMENT, "source", lang="lang"),
        Rule(DIGEST, DOCUMENT, iri("digest", "X", "md5(text)")),
    ],
    "same_documents": [
        Rule(V.OWL_SAME_AS, DOCUMENT, iri("document", "D", "first_id")),
    ],
    "events": [
        Rule(V.RDF_TYPE, EVENT, iri("event", "", "event_type"), subject_kind=t.BNODE),
        Rule(USER, EVENT, "concat('_:u', user_id)", subject_kind=t.BNODE, object_kind=t.BNODE),
        Rule(VALUE, EVENT, _money("value"), V.XSD + "decimal", subject_kind=t.BNODE),
        Rule(AT, EVENT, "concat(substr(cast(ts as string), 1, 10), 'T', substr(cast(ts as string), 12, 8))",
             V.XSD + "dateTime", subject_kind=t.BNODE),
    ],
}

SCHEMA = [
    (CLASS + "Customer", V.RDFS_SUBCLASS, CLASS + "Party"),
    (CLASS + "Supplier", V.RDFS_SUBCLASS, CLASS + "Party"),
    (CLASS + "Party", V.RDFS_SUBCLASS, CLASS + "Agent"),
    (CLASS + "Part", V.RDFS_SUBCLASS, CLASS + "Product"),
    (CLASS + "Nation", V.RDFS_SUBCLASS, CLASS + "Place"),
    (CLASS + "Region", V.RDFS_SUBCLASS, CLASS + "Place"),
    (CLASS + "Client", V.OWL_EQUIVALENT_CLASS, CLASS + "Customer"),
    (VOCAB + "holds", V.OWL_EQUIVALENT_PROPERTY, CONTAINS),
    (IN_NATION, V.RDFS_SUBPROPERTY, WITHIN),
    (WITHIN, V.RDFS_SUBPROPERTY, RELATED),
    (IN_NATION, V.RDFS_DOMAIN, CLASS + "Party"),
    (IN_NATION, V.RDFS_RANGE, CLASS + "Nation"),
    (CONTAINS, V.RDFS_DOMAIN, CLASS + "Order"),
    (CONTAINS, V.RDFS_RANGE, CLASS + "Part"),
    (USER, V.RDFS_RANGE, CLASS + "User"),
    (PRICE, V.RDFS_RANGE, V.XSD + "double"),
    (WITHIN, V.DCAM_RANGE_INCLUDES, CLASS + "Place"),
    (WITHIN, V.DCAM_RANGE_INCLUDES, CLASS + "Party"),
    (WITHIN, V.DCAM_DOMAIN_INCLUDES, CLASS + "Order"),
    (CLASS + "Customer", V.RDF_TYPE, V.OWL_CLASS),
    (CLASS + "Supplier", V.RDF_TYPE, V.OWL_CLASS),
    (CLASS + "Party", V.RDF_TYPE, V.RDFS_CLASS),
    (CLASS + "Party", V.RDF_TYPE, V.OWL_CLASS),
    (CLASS + "Order", V.RDF_TYPE, V.RDFS_CLASS),
    (WITHIN, V.RDF_TYPE, V.OWL_OBJECT_PROPERTY),
    (WITHIN, V.RDF_TYPE, V.OWL_TRANSITIVE),
    (CONTAINS, V.RDF_TYPE, V.OWL_OBJECT_PROPERTY),
    (BALANCE, V.RDF_TYPE, V.RDF_PROPERTY),
    (PARTNER, V.RDF_TYPE, V.OWL_SYMMETRIC),
    (PICK, V.RDF_TYPE, V.OWL_FUNCTIONAL),
    (DIGEST, V.RDF_TYPE, V.OWL_INVERSE_FUNCTIONAL),
    (CONTAINS, V.OWL_INVERSE_OF, CONTAINED_IN),
    (CLASS + "Finished", V.OWL_ON_PROPERTY, STATUS),
    (CLASS + "Finished", V.OWL_HAS_VALUE, BASE + "status/F"),
    (CLASS + "Filled", V.OWL_ON_PROPERTY, CONTAINS),
    (CLASS + "Filled", V.OWL_SOME_VALUES, CLASS + "Part"),
    (CLASS + "Debtor", V.OWL_ON_PROPERTY, IN_NATION),
    (CLASS + "Debtor", V.OWL_ALL_VALUES, CLASS + "LenderNation"),
]

SAME_DOCUMENTS_SQL = (
    "select d.doc_id, f.first_id from documents d join"
    " (select text, min(doc_id) as first_id from documents group by text) f on d.text = f.text"
    " where d.doc_id <> f.first_id"
)


# The supplied tables' columns, stated so that no job has to look them up.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
              " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double,"
                " l_extendedprice double, l_discount double, l_tax double, l_returnflag string,"
                " l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _same_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text an earlier one has. Texts meet by digest, so none is shuffled."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    first = docs.groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    return docs.join(first, "digest").where("doc_id <> first_id").select("doc_id", "first_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _same_documents(spark, sf_dir) if name == "same_documents" else read_table(spark, sf_dir, name)


def _schema_triples(spark: SparkSession, wanted: set[str] | None) -> DataFrame:
    rows = [row for row in SCHEMA if wanted is None or row[1] in wanted]
    frame = spark.createDataFrame(rows, "s string, p string, o string")
    return t.resource_triples(frame, "s", "p", "o")


def triples(spark: SparkSession, sf_dir: str, predicates: Iterable[str] | None = None,
            tables: Iterable[str] | None = None) -> DataFrame:
    """The graph, or the part of it with some predicates or from some tables; other tables are not read."""
    wanted = None if predicates is None else set(predicates)
    frames = [
        tables_to_triples(table(spark, sf_dir, name), rules, wanted)
        for name, rules in RULES.items()
        if (tables is None or name in tables)
        and (wanted is None or any(rule.predicate in wanted for rule in rules))
    ]
    if tables is None and (wanted is None or any(row[1] in wanted for row in SCHEMA)):
        frames.append(_schema_triples(spark, wanted))
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def ontology(spark: SparkSession) -> DataFrame:
    return _schema_triples(spark, None)


# --- the same graph as SQL ----------------------------------------------------------------

def _sql_kind(expression: str) -> str:
    return f"case when starts_with({expression}, '_:') then 'bnode' else 'iri' end"


def _rule_sql(name: str, rule: Rule) -> str:
    obj = f"cast({rule.obj} as varchar)"
    if not rule.is_literal:
        rest = f"{_sql_kind(obj)}, null, null"
    elif rule.lang is not None:
        rest = f"'literal', '{V.RDF_LANG_STRING}', {rule.lang}"
    else:
        rest = f"'literal', '{rule.datatype}', null"
    source = f"({SAME_DOCUMENTS_SQL})" if name == "same_documents" else name
    return (
        f"select {rule.subject}, {_sql_kind(rule.subject)}, '{rule.predicate}', {obj}, {rest}"
        f" from {source} where {rule.subject} is not null and {rule.obj} is not null"
    )


def triples_sql(tables: Iterable[str] | None = None) -> str:
    """`triples(...) as (...)`, ready to follow WITH."""
    parts = [
        _rule_sql(name, rule) for name, rules in RULES.items() if tables is None or name in tables for rule in rules
    ]
    if tables is None:
        values = ", ".join(f"('{s}', '{p}', '{o}')" for s, p, o in SCHEMA)
        parts.append(f"select a, 'iri', b, c, 'iri', null, null from (values {values}) v(a, b, c)")
    return "triples(s, s_kind, p, o, o_kind, o_datatype, o_lang) as (" + " union all ".join(parts) + ")"


# --- catalog, summaries and results derived from the tables ---------------------------------

_CATALOG_SELECT = """
select concat(lower(c_mktsegment), '_', c_nationkey) as dir_name,
       substr(cast(o_orderdate as {text}), 1, 7) as version,
       case c_nationkey % 4 when 0 then 'NTRIPLES' when 1 then 'TURTLE' when 2 then 'RDFXML' else 'OBO' end as format,
       case when c_nationkey % 5 = 0 then concat('http://ex.org/onto/', c_nationkey, '#') else '' end
         as ontology_namespace,
       max(o_orderdate) as date_importation, count(*) as orders, count(distinct c_custkey) as customers
from orders join customer on o_custkey = c_custkey
group by c_mktsegment, c_nationkey, substr(cast(o_orderdate as {text}), 1, 7)
"""


def _lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    nation = F.col("c_nationkey")
    grouped = rows.groupBy(
        F.concat(F.lower("c_mktsegment"), F.lit("_"), nation).alias("dir_name"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("version"), nation,
    ).agg(
        F.max("o_orderdate").alias("date_importation"), F.count("*").alias("orders"),
        F.countDistinct("c_custkey").alias("customers"),
    )
    fmt = (
        F.when(nation % 4 == 0, "NTRIPLES").when(nation % 4 == 1, "TURTLE").when(nation % 4 == 2, "RDFXML")
        .otherwise("OBO")
    )
    onto = F.when(nation % 5 == 0, F.concat(F.lit("http://ex.org/onto/"), nation, F.lit("#"))).otherwise("")
    return grouped.withColumn("format", fmt).withColumn("ontology_namespace", onto).drop("c_nationkey")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One graph per market segment and nation, one version per month with orders.

    The newest version of each graph is listed twice, as the ingestion's two metadata files do.
    """
    lake = _lake(spark, sf_dir)
    newest = lake.groupBy("dir_name").agg(F.max("version").alias("version"))
    rows = lake.select(
        "dir_name", "version", F.lit("http://ex.org/download/").alias("download_url"), F.lit("").alias("compression"),
        "format", "ontology_namespace", F.array(F.lit("all.nt")).alias("file_list"),
        F.array(F.lit("a.nt"), F.concat(F.lit("b"), F.col("orders").cast("string"), F.lit(".nt"))).alias(
            "actual_file_list"),
        F.col("date_importation").cast("timestamp").alias("date_importation"), F.lit(False).alias("is_latest"),
        F.concat(F.lit("/data/"), "dir_name", F.lit("_v"), "version").alias("graph_dir"),
    )
    latest = rows.join(newest, ["dir_name", "version"], "left_semi").withColumn("is_latest", F.lit(True))
    return rows.unionByName(latest.select(*rows.columns))


CATALOG_SQL = (
    f"lake as ({_CATALOG_SELECT.format(text='varchar')}), catalog as (select *,"
    " version = max(version) over (partition by dir_name) as is_latest,"
    " concat('/data/', dir_name, '_v', version) as graph_dir,"
    " ['a.nt', concat('b', orders, '.nt')] as actual_file_list from lake)"
)


def void_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Summary counters of each version; months ending in 3 have no total, in 5 a malformed summary."""
    month = F.substring("version", 7, 1)
    return _lake(spark, sf_dir).select(
        F.col("dir_name").alias("graph"), "version", F.lit(3).cast("bigint").alias("classes"),
        (F.col("orders") + F.col("customers")).alias("entities"), F.col("orders").alias("distinct_subjects"),
        F.when(month != "9", F.col("customers")).alias("distinct_objects"), F.lit(4).cast("bigint").alias("properties"),
        F.when(month != "3", F.col("orders") * 1500).alias("triples"), (month != "5").alias("is_valid"),
    )


VOID_DATASET_SQL = (
    "void_dataset as (select dir_name as graph, version, 3 as classes, orders + customers as entities,"
    " orders as distinct_subjects, case when substr(version, 7, 1) <> '9' then customers end as distinct_objects,"
    " 4 as properties, case when substr(version, 7, 1) <> '3' then orders * 1500 end as triples,"
    " substr(version, 7, 1) <> '5' as is_valid from lake)"
)


def void_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per version: order priorities as properties and order statuses as classes, with their counts."""
    orders = read_table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderstatus", "o_orderpriority")
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    rows = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    items = F.explode(F.array(
        F.struct(F.lit("class").alias("kind"),
                 F.concat(F.lit("http://ex.org/status#"), "o_orderstatus").alias("item")),
        F.struct(F.lit("property").alias("kind"),
                 F.concat(F.lit("http://ex.org/priority#"),
                          F.replace(F.substring("o_orderpriority", 3, 20), F.lit(" "), F.lit("-"))).alias("item")),
    ))
    return rows.select(
        F.concat(F.lower("c_mktsegment"), F.lit("_"), "c_nationkey").alias("graph"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 7).alias("version"), items.alias("i"),
    ).groupBy("graph", "version", "i.kind", "i.item").agg(F.count("*").alias("triples"))


VOID_PARTITION_SQL = (
    "void_rows as (select concat(lower(c_mktsegment), '_', c_nationkey) as graph,"
    " substr(cast(o_orderdate as varchar), 1, 7) as version, o_orderstatus, o_orderpriority"
    " from orders join customer on o_custkey = c_custkey),"
    " void_partition as (select graph, version, 'class' as kind, concat('http://ex.org/status#', o_orderstatus)"
    " as item, count(*) as triples from void_rows group by all union all select graph, version, 'property',"
    " concat('http://ex.org/priority#', replace(substr(o_orderpriority, 3, 20), ' ', '-')), count(*) from void_rows group by all)"
)


def result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result files `(file_name, value)`: one per event day, with comments and a log file's lines mixed in."""
    events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    day = F.replace(F.substring(F.col("ts").cast("string"), 1, 10), F.lit("-"), F.lit(""))
    suffix = F.when(F.col("event_id") % 11 == 0, ".log").otherwise("")
    line = F.concat(
        F.lit("<http://ex.org/user/U"), "user_id", F.lit(f"> <{V.SKOS_RELATED}> <http://ex.org/event/"),
        "event_type", F.lit(">"), F.when(F.col("event_id") % 3 == 0, " .").otherwise(""),
    )
    text = F.when(F.col("event_id") % 7 == 0, F.concat(F.lit("#"), line)).otherwise(line)
    return events.select(F.concat(F.lit("found-"), day, suffix).alias("file_name"), text.alias("value"))


RESULTS_SQL = (
    "results as (select distinct cast(replace(substr(cast(ts as varchar), 1, 10), '-', '') as bigint) as run_id,"
    f" concat('http://ex.org/user/U', user_id) as s, '{V.SKOS_RELATED}' as p,"
    " concat('http://ex.org/event/', event_type) as o from events where event_id % 11 <> 0 and event_id % 7 <> 0)"
)
# Every file is a run, also one whose lines are all comments.
RUNS_SQL = (
    "select distinct cast(replace(substr(cast(ts as varchar), 1, 10), '-', '') as bigint) as run_id from events"
    " where event_id % 11 <> 0"
)
