"""Dataset statistics over a triples DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V

def top(counts: DataFrame, item: str, size: int) -> DataFrame:
    """The `size` largest counts, ties by item, for reports that ask for that many."""
    return counts.orderBy(F.desc("n"), item).limit(size)


def used_classes(triples: DataFrame) -> DataFrame:
    typed = triples.where(t.predicate_matches(V.RDF_TYPE) & t.is_iri("o"))
    return typed.groupBy(F.col("o").alias("class")).agg(F.count("*").alias("n"))


def _distinct_subjects_typed(triples: DataFrame, classes: list[str]) -> DataFrame:
    typed = t.predicate_matches(V.RDF_TYPE) & t.is_iri("s") & t.is_iri("o") & F.col("o").isin(classes)
    return triples.where(typed).agg(F.countDistinct("s").alias("n"))


def classes_defined(triples: DataFrame) -> DataFrame:
    return _distinct_subjects_typed(triples, [V.RDFS_CLASS, V.OWL_CLASS])


def properties_defined(triples: DataFrame) -> DataFrame:
    return _distinct_subjects_typed(triples, [V.OWL_OBJECT_PROPERTY, V.RDF_PROPERTY])


def property_usage(triples: DataFrame) -> DataFrame:
    return triples.groupBy(F.col("p").alias("property")).agg(F.count("*").alias("n"))


def properties_per_subject(triples: DataFrame) -> DataFrame:
    return triples.groupBy("s").agg(F.countDistinct("p").alias("n"))


def properties_per_object(triples: DataFrame) -> DataFrame:
    return triples.groupBy(*t.OBJECT_COLUMNS).agg(F.countDistinct("p").alias("n"))


def subclass_usage(triples: DataFrame) -> DataFrame:
    return triples.where(t.predicate_matches(V.RDFS_SUBCLASS)).agg(F.count("*").alias("n"))


def triple_count(triples: DataFrame) -> DataFrame:
    return triples.agg(F.count("*").alias("n"))


def distinct_triple_count(triples: DataFrame) -> DataFrame:
    return triples.select(*t.TRIPLE_COLUMNS).distinct().agg(F.count("*").alias("n"))


def entities(triples: DataFrame) -> DataFrame:
    """Number of distinct IRIs in any position."""
    terms = F.explode(F.array(F.when(t.is_iri("s"), F.col("s")), F.col("p"), F.when(t.is_iri("o"), F.col("o"))))
    return triples.select(terms.alias("term")).agg(F.countDistinct("term").alias("n"))


def distinct_subjects(triples: DataFrame) -> DataFrame:
    return triples.where(t.is_iri("s")).agg(F.countDistinct("s").alias("n"))


def distinct_objects(triples: DataFrame) -> DataFrame:
    return triples.where(t.is_iri("o")).agg(F.countDistinct("o").alias("n"))


def literals(triples: DataFrame) -> DataFrame:
    return triples.where(t.is_literal("o"))


def blanks_as_subject(triples: DataFrame) -> DataFrame:
    return triples.where(t.is_blank("s"))


def blanks_as_object(triples: DataFrame) -> DataFrame:
    return triples.where(t.is_blank("o"))


def datatypes(triples: DataFrame) -> DataFrame:
    rows = triples.where(t.has_datatype())
    return rows.groupBy(F.col("o_datatype").alias("datatype")).agg(F.count("*").alias("n"))


def languages(triples: DataFrame) -> DataFrame:
    return triples.where(t.has_language()).groupBy(F.col("o_lang").alias("lang")).agg(F.count("*").alias("n"))


def avg_typed_string_length(triples: DataFrame) -> DataFrame:
    strings = triples.where(t.is_literal("o") & (F.col("o_datatype") == V.XSD_STRING))
    return strings.agg(F.avg(t.lexical_length()).alias("avg_length"))


def avg_untyped_string_length(triples: DataFrame) -> DataFrame:
    return triples.where(t.has_language()).agg(F.avg(t.lexical_length()).alias("avg_length"))


def typed_subjects(triples: DataFrame) -> DataFrame:
    return triples.where(t.predicate_matches(V.RDF_TYPE)).select("s")


def labelled_subjects(triples: DataFrame) -> DataFrame:
    return triples.where(t.predicate_matches(V.RDFS_LABEL)).select("s")


def same_as(triples: DataFrame) -> DataFrame:
    return triples.where(t.predicate_matches(V.OWL_SAME_AS))


def links(triples: DataFrame) -> DataFrame:
    """Directed counts of links between different namespaces."""
    ends = triples.where(t.is_iri("s") & t.is_iri("o")).select(
        t.namespace(F.col("s")).alias("ns_s"), t.namespace(F.col("o")).alias("ns_o")
    )
    return ends.where("ns_s <> ns_o").groupBy("ns_s", "ns_o").agg(F.count("*").alias("n"))


# Fixed value order between literals that are not comparable by value.
_SPACE_TEXT, _SPACE_LANG, _SPACE_TIME, _SPACE_NUMBER = 0, 1, 2, 3


def _digits() -> Column:
    """The exact order of plain decimal numerals: places before the point, then digits; null for others.

    A negative number has fewer places and the complement of its digits, closed by a sign above nine.
    """
    plain = r"^([+-]?)0*(\d*)(?:\.(\d*?)0*)?$"
    places = F.length(F.regexp_extract("o", plain, 2))
    digits = F.concat(F.regexp_extract("o", plain, 2), F.regexp_extract("o", plain, 3))
    negative = F.col("o").startswith("-")
    return F.when(F.col("o").rlike(plain) & F.col("o").rlike(r"\d"), F.struct(
        F.when(negative, -places).otherwise(places).alias("places"),
        F.when(negative, F.concat(F.translate(digits, "0123456789", "9876543210"), F.lit(":"))).otherwise(digits).alias("digits")))


def value_order() -> Column:
    """A sortable key for literals: value space, then value, then lexical form and type.

    Numbers compare as numbers of any length: first as doubles, which never swap two of them, then those that share
    a double by their digits. NaN sorts above every number. Dates compare as instants, in UTC where
    they name no zone. A malformed one falls back to text.
    """
    datatype = F.col("o_datatype")
    number = F.when(datatype.isin(V.ALL_NUMERIC_DATATYPES), F.col("o").try_cast("double"))
    zoned = F.when(F.col("o").rlike(r"(?:[zZ]|[+-]\d\d:\d\d)$"), F.col("o")).when(
        F.col("o").contains("T"), F.concat("o", F.lit("Z"))).otherwise(F.concat("o", F.lit("T00:00:00Z")))
    moment = F.when(datatype.isin(V.TEMPORAL_DATATYPES), zoned.try_cast("timestamp"))
    space = (
        F.when(number.isNotNull(), _SPACE_NUMBER)
        .when(moment.isNotNull(), _SPACE_TIME)
        .when(t.has_language(), _SPACE_LANG)
        .otherwise(_SPACE_TEXT)
    )
    return F.struct(
        space.alias("space"), number.alias("number"), _digits().alias("digits"), moment.alias("moment"),
        F.col("o").alias("o"), datatype.alias("o_datatype"), F.col("o_lang").alias("o_lang"),
    )


def max_per_property(triples: DataFrame) -> DataFrame:
    """The greatest literal of each property."""
    greatest = literals(triples).groupBy(F.col("p").alias("property")).agg(F.max(value_order()).alias("m"))
    return greatest.select("property", "m.o", "m.o_datatype", "m.o_lang")


def avg_per_property(triples: DataFrame) -> DataFrame:
    numbers = literals(triples).where(F.col("o_datatype").isin(V.NUMERIC_DATATYPES))
    return numbers.groupBy(F.col("p").alias("property")).agg(F.avg(F.col("o").try_cast("double")).alias("avg_value"))


def vocabularies(triples: DataFrame, position: str) -> DataFrame:
    """Namespace histogram of one position, `s`, `p` or `o`."""
    rows = triples.where(t.is_iri(position)).select(t.namespace(F.col(position)).alias("ns"))
    return rows.groupBy("ns").agg(F.count("*").alias("n"))


def all_vocabularies(triples: DataFrame) -> DataFrame:
    terms = F.explode(F.array(F.when(t.is_iri("s"), F.col("s")), F.col("p"), F.when(t.is_iri("o"), F.col("o"))))
    used = triples.select(terms.alias("term")).where("term is not null")
    return used.select(t.namespace(F.col("term")).alias("ns")).distinct()


def triple_digest() -> Column:
    """128 bits that name a triple, as two hashes from different seeds; a null and an empty string differ.

    Among a billion triples the chance that two share them is below 10^-20.
    """
    nulls = [F.col(c).isNull() for c in t.TRIPLE_COLUMNS]
    first, second = (F.xxhash64(F.lit(seed), *nulls, *t.TRIPLE_COLUMNS) for seed in (0, 1))
    return F.struct(first.alias("first"), second.alias("second"))


def term_usage(triples: DataFrame, by: list[str] | None = None, with_triples: bool = False) -> DataFrame:
    """How often each IRI is a subject, predicate, object and class, in one pass over the triples.

    The summary counters, both partitions and the vocabularies all follow from this table.
    Its partial aggregates run before the shuffle, so a hub term costs one row per task. `with_triples` adds a row
    without a term for each distinct triple, told apart by `triple_digest`.
    """
    by = by or []

    def use(term, position, is_class=None):
        is_class = F.lit(0) if is_class is None else is_class
        flags = [F.lit(1 if position == other else 0).cast("bigint").alias(f"as_{other}") for other in "spo"]
        return F.struct(term.alias("term"), *flags, is_class.cast("bigint").alias("as_class"))

    uses = [
        use(F.when(t.is_iri("s"), F.col("s")), "s"),
        use(F.col("p"), "p"),
        use(F.when(t.is_iri("o"), F.col("o")), "o", (F.col("p") == V.RDF_TYPE).cast("int")),
    ]
    counts = [F.sum(c).alias(c) for c in ("as_s", "as_p", "as_o", "as_class")]
    if not with_triples:
        rows = triples.select(*by, F.explode(F.array(*uses)).alias("u")).select(*by, "u.*").where("term is not null")
        return rows.groupBy(*by, "term").agg(*counts)
    uses.append(use(F.lit(None).cast("string"), "triple"))
    hashed = triples.select(*by, "s", "s_kind", "p", "o", "o_kind", triple_digest().alias("d"))
    rows = hashed.select(*by, "d", F.posexplode(F.array(*uses)).alias("position", "u"))
    is_triple = F.col("position") == len(uses) - 1
    rows = rows.where(F.col("u.term").isNotNull() | is_triple).select(
        *by, "u.*", *(F.when(is_triple, F.col(f"d.{half}")).alias(half) for half in ("first", "second")))
    return rows.groupBy(*by, "term", "first", "second").agg(*counts).drop("first", "second")


def usage_partition(usage: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Class and property counts `(kind, item, triples)` from `term_usage`."""
    kinds = F.array(
        F.when(F.col("as_class") > 0, F.struct(F.lit("class").alias("kind"), F.col("as_class").alias("triples"))),
        F.when(F.col("as_p") > 0, F.struct(F.lit("property").alias("kind"), F.col("as_p").alias("triples"))),
    )
    rows = usage.where("as_class > 0 or as_p > 0").select(*(by or []), "term", F.explode(kinds).alias("k"))
    return rows.where("k is not null").select(*(by or []), "k.kind", F.col("term").alias("item"), "k.triples")


def usage_totals(usage: DataFrame, by: list[str] | None = None) -> DataFrame:
    """The distinct-term counters from `term_usage`."""
    counters = {"classes": "as_class", "entities": None, "distinct_subjects": "as_s",
                "distinct_objects": "as_o", "properties": "as_p"}
    return usage.groupBy(*(by or [])).agg(*(
        (F.count("*") if flag is None else F.count_if(F.col(flag) > 0)).alias(name) for name, flag in counters.items()
    ))


def typed_hierarchy(triples: DataFrame, predicate: str) -> DataFrame:
    """Deepest-first `(node, depth)` of the hierarchy one predicate spans between IRIs."""
    from kglake.operators.paths import hierarchy_depth

    return hierarchy_depth(triples.where(t.is_iri("s") & t.is_iri("o")), predicate).orderBy(F.desc("depth"), "node")


def class_hierarchy_depth(triples: DataFrame) -> DataFrame:
    return typed_hierarchy(triples, V.RDFS_SUBCLASS)


def property_hierarchy_depth(triples: DataFrame) -> DataFrame:
    return typed_hierarchy(triples, V.RDFS_SUBPROPERTY)
