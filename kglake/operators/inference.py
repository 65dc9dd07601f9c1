"""Entailment rules of RDFS and of the OWL Horst fragment, as joins.

Rules follow the W3C RDF Semantics and ter Horst (2005). Schema tables (class and property
hierarchies, domains, ranges, property kinds) are stored before use, so the
optimizer knows their exact size and broadcasts them only below its threshold. A rule
gives a bag: the closures, and `as_set`, remove repeats once, after a map-side pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.operators import reachability
from kglake.plans import storage

SCHEMA_PREDICATES = [V.RDFS_SUBCLASS, V.RDFS_SUBPROPERTY, V.RDFS_DOMAIN, V.RDFS_RANGE]
RANGE_PREDICATES = [V.RDFS_RANGE, V.DCAM_RANGE_INCLUDES]
DOMAIN_PREDICATES = [V.RDFS_DOMAIN, V.DCAM_DOMAIN_INCLUDES]


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def as_set(triples: DataFrame) -> DataFrame:
    return triples.select(*t.TRIPLE_COLUMNS).distinct()


def pairs(triples: DataFrame, predicates: str | list[str], src: str = "src", dst: str = "dst") -> DataFrame:
    """Distinct resource pairs of some predicates."""
    predicates = [predicates] if isinstance(predicates, str) else predicates
    rows = triples.where(F.col("p").isin(predicates) & ~t.is_literal("o"))
    return rows.select(F.col("s").alias(src), F.col("o").alias(dst)).distinct()


def transitive_closure(edges: DataFrame, by: list[str] | None = None) -> DataFrame:
    """All `(src, dst)` joined by a path, per group of the `by` columns.

    Each round extends the newest pairs by everything known, on both sides, so a chain
    of n edges takes about log2 n rounds; only pairs not seen before go on.
    """
    by = by or []
    columns = by + ["src", "dst"]
    folder = storage.shared_folder(edges.sparkSession)
    delta = storage.materialize(edges.select(*columns).distinct(), folder, "round-0")
    paths = [f"{folder}/round-0"]
    while not delta.isEmpty():
        known = storage.read_tables(delta, paths)
        ahead = delta.select(*by, "src", F.col("dst").alias("via")).join(
            known.select(*by, F.col("src").alias("via"), "dst"), by + ["via"]
        )
        behind = known.select(*by, "src", F.col("dst").alias("via")).join(
            delta.select(*by, F.col("src").alias("via"), "dst"), by + ["via"]
        )
        found = ahead.select(*columns).unionByName(behind.select(*columns)).distinct()
        name = f"round-{len(paths)}"
        delta = storage.materialize(found.join(known, columns, "left_anti"), folder, name)
        paths.append(f"{folder}/{name}")
    return storage.read_tables(delta, paths)


def subclass_closure(triples: DataFrame) -> DataFrame:
    return transitive_closure(pairs(triples, V.RDFS_SUBCLASS))


def subproperty_closure(triples: DataFrame) -> DataFrame:
    return transitive_closure(pairs(triples, V.RDFS_SUBPROPERTY))


def closure_as_triples(closure: DataFrame, predicate: str) -> DataFrame:
    return t.resource_triples(closure, "src", F.lit(predicate), "dst")


def superproperty_triples(triples: DataFrame, subproperties: DataFrame) -> DataFrame:
    """rdfs7: the triple again under each superproperty that can be a predicate."""
    wider = subproperties.where(~F.col("dst").startswith("_:"))
    rows = triples.join(wider, triples.p == wider.src).withColumn("p", F.col("dst"))
    return rows.select(*t.TRIPLE_COLUMNS)


def domain_types(triples: DataFrame, domains: DataFrame) -> DataFrame:
    """rdfs2: subjects typed by the domain of their predicate."""
    domains = storage.materialize(domains, name="domains")
    typed = triples.join(domains, triples.p == domains.src).select("s", "dst")
    return t.resource_triples(typed, "s", F.lit(V.RDF_TYPE), "dst")


def range_types(triples: DataFrame, ranges: DataFrame) -> DataFrame:
    """rdfs3: resource objects typed by the range of their predicate."""
    ranges = storage.materialize(ranges, name="ranges")
    resources = triples.where(~t.is_literal("o"))
    typed = resources.join(ranges, resources.p == ranges.src).select("o", "dst")
    return t.resource_triples(typed, "o", F.lit(V.RDF_TYPE), "dst")


def superclass_types(triples: DataFrame, subclasses: DataFrame) -> DataFrame:
    """rdfs9: instances typed by the superclasses of their class."""
    types = triples.where(t.predicate_matches(V.RDF_TYPE) & ~t.is_literal("o")).select("s", "o")
    wider = types.join(subclasses, types.o == subclasses.src).select("s", "dst")
    return t.resource_triples(wider, "s", F.lit(V.RDF_TYPE), "dst")


def superclass_types_by_labels(triples: DataFrame, hierarchy: reachability.Index) -> DataFrame:
    """rdfs9 from the labels of the class hierarchy: only classes that have instances are looked up, and no pairs are stored."""
    types = triples.where(t.predicate_matches(V.RDF_TYPE) & ~t.is_literal("o")).select("s", F.col("o").alias("src"))
    wider = types.join(hierarchy.targets(types.select(F.col("src").alias("node"))), "src").select("s", "dst")
    return t.resource_triples(wider, "s", F.lit(V.RDF_TYPE), "dst")


def property_ranges(triples: DataFrame) -> DataFrame:
    return pairs(triples, RANGE_PREDICATES, "property", "range")


def property_domains(triples: DataFrame) -> DataFrame:
    return pairs(triples, DOMAIN_PREDICATES, "property", "domain")


def _widened(pairs_of: DataFrame, subclasses: DataFrame, subproperties: DataFrame) -> DataFrame:
    """Domains or ranges with those of superproperties, and the superclasses of each."""
    inherited = subproperties.join(
        pairs_of.select(F.col("src").alias("via"), F.col("dst").alias("class")), F.col("dst") == F.col("via")
    ).select("src", F.col("class").alias("dst"))
    own = pairs_of.unionByName(inherited)
    wider = own.join(
        subclasses.select(F.col("src").alias("class"), F.col("dst").alias("super")), F.col("dst") == F.col("class")
    ).select("src", F.col("super").alias("dst"))
    return own.unionByName(wider)


def _effects(schema: DataFrame, subclasses: DataFrame, subproperties: DataFrame) -> DataFrame:
    """`(predicate, role, target)`: all that a triple entails through its predicate.

    The rules are composed on the schema, which is small, so the facts need one join.
    """
    wider = subproperties.where(~F.col("dst").startswith("_:"))
    domains = _widened(pairs(schema, V.RDFS_DOMAIN), subclasses, subproperties)
    ranges = _widened(pairs(schema, V.RDFS_RANGE), subclasses, subproperties)
    parts = [("super", wider), ("domain", domains), ("range", ranges)]
    return _union([
        frame.select(F.col("src").alias("predicate"), F.lit(role).alias("role"), F.col("dst").alias("target"))
        for role, frame in parts
    ]).distinct()


def _apply_effects(triples: DataFrame, effects: DataFrame) -> DataFrame:
    """rdfs7, rdfs2 and rdfs3 in one scan of the triples."""
    rows = triples.join(effects, triples.p == effects.predicate)
    rows = rows.where((F.col("role") != "range") | ~t.is_literal("o"))
    is_super = F.col("role") == "super"
    subject = F.when(F.col("role") == "range", F.col("o")).otherwise(F.col("s"))
    subject_kind = F.when(F.col("role") == "range", F.col("o_kind")).otherwise(F.col("s_kind"))
    return rows.select(
        subject.alias("s"), subject_kind.alias("s_kind"),
        F.when(is_super, F.col("target")).otherwise(F.lit(V.RDF_TYPE)).alias("p"),
        F.when(is_super, F.col("o")).otherwise(F.col("target")).alias("o"),
        F.when(is_super, F.col("o_kind")).otherwise(t.kind_of(F.col("target"))).alias("o_kind"),
        F.when(is_super, F.col("o_datatype")).alias("o_datatype"), F.when(is_super, F.col("o_lang")).alias("o_lang"),
    )


def _rdfs_round(triples: DataFrame, schema: DataFrame, folder: str) -> DataFrame:
    """One application of rdfs5 and 11, then 7, 2, 3 and 9 with those closures."""
    subproperties = subproperty_closure(schema)
    extends_schema = subproperties.where(F.col("dst").isin(SCHEMA_PREDICATES) & ~F.col("src").isin(SCHEMA_PREDICATES))
    if not extends_schema.isEmpty():
        schema = storage.materialize(
            schema.unionByName(superproperty_triples(triples, extends_schema)), folder, "extended-schema"
        )
        subproperties = subproperty_closure(schema)
    subclasses = subclass_closure(schema)
    # Only effects of predicates that triples have are stored, however many properties a schema declares: so many fit a broadcast.
    used = triples.select(F.col("p").alias("predicate")).distinct()
    effects = storage.materialize(_effects(schema, subclasses, subproperties).join(used, "predicate", "left_semi"), folder, "effects")
    return as_set(_union([
        triples,
        _apply_effects(triples, effects),
        superclass_types(triples, subclasses),
        closure_as_triples(subproperties, V.RDFS_SUBPROPERTY),
        closure_as_triples(subclasses, V.RDFS_SUBCLASS),
    ]))


def _needs_another_round(schema: DataFrame) -> bool:
    """Whether rdf:type or the schema predicates are themselves given a superproperty, domain or range."""
    watched = SCHEMA_PREDICATES + [V.RDF_TYPE]
    about_schema = F.col("s").isin(watched)
    widened_into = F.col("o").isin(watched) & t.predicate_matches(V.RDFS_SUBPROPERTY)
    return not schema.where((about_schema | widened_into) & (F.col("s") != F.col("o"))).isEmpty()


def rdfs_closure(triples: DataFrame) -> DataFrame:
    """The triples with everything the RDFS rules add, as a set.

    The schema rows are stored apart once, so that the hierarchies never scan the facts.
    One round is complete unless the schema vocabulary itself is extended; then
    rounds repeat until one adds nothing.
    """
    folder = storage.shared_folder(triples.sparkSession)
    return _rdfs_rounds(storage.materialize(triples.select(*t.TRIPLE_COLUMNS), folder, "given"), folder)


def _rdfs_rounds(stored: DataFrame, folder: str) -> DataFrame:
    """RDFS rounds over stored triples."""
    current, size, step = stored, None, 0
    while True:
        step += 1
        at = f"{folder}/{step}"
        schema = storage.materialize(current.where(F.col("p").isin(SCHEMA_PREDICATES)), at, "schema")
        current = storage.materialize(_rdfs_round(current, schema, at), folder, f"rdfs-{step}")
        if not _needs_another_round(schema):
            return current
        grown = current.count()
        if grown == size:
            return current
        size = grown


def _typed_properties(triples: DataFrame, kind: str) -> DataFrame:
    """The declared properties, stored: a schema table is broadcast by its real size instead of shuffling facts by predicate."""
    rows = triples.where(t.predicate_matches(V.RDF_TYPE) & t.object_matches(kind))
    return storage.materialize(rows.select(F.col("s").alias("property")).distinct(), name="properties")


def inverse_triples(triples: DataFrame) -> DataFrame:
    """rdfp8: (s p o) and p inverse of q give (o q s), in both directions."""
    declared = pairs(triples, V.OWL_INVERSE_OF, "property", "inverse")
    both = declared.unionByName(declared.select(F.col("inverse").alias("property"), F.col("property").alias("inverse")))
    both = storage.materialize(both.distinct(), name="inverses")
    resources = triples.where(~t.is_literal("o"))
    rows = resources.join(both, resources.p == F.col("property")).select("o", "inverse", "s")
    return t.resource_triples(rows, "o", "inverse", "s")


def symmetric_triples(triples: DataFrame) -> DataFrame:
    """rdfp3."""
    resources = triples.where(~t.is_literal("o"))
    symmetric = _typed_properties(triples, V.OWL_SYMMETRIC)
    rows = resources.join(symmetric, resources.p == symmetric.property, "left_semi").select("s", "p", "o")
    return t.resource_triples(rows, "o", "p", "s")


def transitive_triples(triples: DataFrame) -> DataFrame:
    """rdfp4: paths of transitive properties."""
    resources = triples.where(~t.is_literal("o"))
    transitive = _typed_properties(triples, V.OWL_TRANSITIVE)
    edges = resources.join(transitive, resources.p == transitive.property, "left_semi").select(
        "p", F.col("s").alias("src"), F.col("o").alias("dst"))
    return t.resource_triples(reachability.closure(edges), "src", "p", "dst")


def functional_same_as(triples: DataFrame) -> DataFrame:
    """rdfp1 and rdfp2 as links of each value to the least one it must equal.

    The links span the same equality as all pairs would, with one row per value. Groups
    are only aggregated for their least value, so a hub costs no task more than its share.
    """
    resources = triples.where(~t.is_literal("o"))

    def links(kind: str, key: str, value: str) -> DataFrame:
        properties = _typed_properties(triples, kind)
        rows = resources.join(properties, resources.p == properties.property, "left_semi").select("p", "s", "o")
        rows = storage.materialize(rows.distinct(), name=f"{key}-values")
        least = rows.groupBy("p", key).agg(F.min(value).alias("least"))
        linked = rows.join(least, ["p", key]).where(F.col(value) != F.col("least"))
        return linked.select(F.col(value).alias("node"), "least").distinct()

    found = links(V.OWL_FUNCTIONAL, "s", "o").unionByName(links(V.OWL_INVERSE_FUNCTIONAL, "o", "s")).distinct()
    return t.resource_triples(found, "node", F.lit(V.OWL_SAME_AS), "least")


def connected_components(edges: DataFrame) -> DataFrame:
    """`(node, representative)`: each non-least node of a component with its least node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every round moves
    neighbours to their least neighbour with one aggregate and one join, until nothing moves.
    """
    folder = storage.shared_folder(edges.sparkSession)
    oriented = edges.where("src <> dst").select(
        F.greatest("src", "dst").alias("node"), F.least("src", "dst").alias("near")
    )
    current = storage.materialize(oriented.distinct(), folder, "round-0")
    step = 0
    while True:
        step += 1
        both = current.unionByName(current.select(F.col("near").alias("node"), F.col("node").alias("near")))
        least = both.groupBy("node").agg(F.min("near").alias("m")).select("node", F.least("node", "m").alias("m"))
        larger = both.where("near > node").join(least, "node")
        large = larger.select(F.col("near").alias("node"), F.col("m").alias("near")).where("node <> near").distinct()
        large = storage.materialize(large, folder, f"large-{step}")
        lowest = large.groupBy("node").agg(F.min("near").alias("m"))
        moved = large.join(lowest, "node").select(F.col("near").alias("node"), F.col("m").alias("near"))
        small = moved.unionByName(lowest.select("node", F.col("m").alias("near"))).where("node <> near").distinct()
        previous, current = current, storage.materialize(small, folder, f"round-{step}")
        if current.count() == previous.count() and current.join(previous, ["node", "near"], "left_anti").isEmpty():
            return current.select("node", F.col("near").alias("representative"))


def same_as_components(triples: DataFrame) -> DataFrame:
    """rdfp6 and rdfp7: each node with the least node it equals, instead of all equal pairs."""
    return connected_components(pairs(triples, V.OWL_SAME_AS))


def substitute_same_as(triples: DataFrame, components: DataFrame) -> DataFrame:
    """rdfp11: triples over representatives, plus one sameAs link per replaced node.

    All triples over equal nodes follow from these, without writing every combination.
    """
    reps = components.select(F.col("node").alias("_node"), F.col("representative").alias("_rep"))
    rest = triples.where(F.col("p") != V.OWL_SAME_AS)
    by_s = rest.join(reps, rest.s == F.col("_node"), "left").withColumn("s", F.coalesce("_rep", "s"))
    by_s = by_s.withColumn("s_kind", t.kind_of(F.col("s"))).select(*t.TRIPLE_COLUMNS)
    key = F.when(~t.is_literal("o"), F.col("o"))
    by_o = by_s.join(reps, key == F.col("_node"), "left").withColumn("o", F.coalesce("_rep", "o"))
    by_o = by_o.withColumn("o_kind", F.when(t.is_literal("o"), t.LITERAL).otherwise(t.kind_of(F.col("o"))))
    links = t.resource_triples(components, "node", F.lit(V.OWL_SAME_AS), "representative")
    return as_set(by_o.select(*t.TRIPLE_COLUMNS).unionByName(links))


def _both_ways(triples: DataFrame, equivalence: str, sub: str) -> list[DataFrame]:
    """Equivalence as two sub relations, and two opposite sub relations as an equivalence."""
    equal = pairs(triples, equivalence)
    below = pairs(triples, sub)
    opposite = below.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    mutual = below.where("src <> dst").join(opposite, ["src", "dst"], "left_semi")
    return [
        t.resource_triples(equal, "src", F.lit(sub), "dst"),
        t.resource_triples(equal, "dst", F.lit(sub), "src"),
        t.resource_triples(mutual, "src", F.lit(equivalence), "dst"),
    ]


def equivalence_triples(triples: DataFrame) -> DataFrame:
    """rdfp12 and rdfp13, with rdfp9 and rdfp10 for equal classes and properties."""
    equal = pairs(triples, V.OWL_SAME_AS)

    def declared(kinds: list[str]) -> DataFrame:
        rows = triples.where(t.predicate_matches(V.RDF_TYPE) & t.is_iri("o") & F.col("o").isin(kinds))
        return rows.select(F.col("s").alias("src")).distinct()

    classes = equal.join(declared([V.OWL_CLASS, V.RDFS_CLASS]), "src", "left_semi")
    properties = equal.join(declared([V.OWL_OBJECT_PROPERTY, V.RDF_PROPERTY]), "src", "left_semi")
    return _union(
        _both_ways(triples, V.OWL_EQUIVALENT_CLASS, V.RDFS_SUBCLASS)
        + _both_ways(triples, V.OWL_EQUIVALENT_PROPERTY, V.RDFS_SUBPROPERTY)
        + [t.resource_triples(classes, "src", F.lit(V.RDFS_SUBCLASS), "dst"),
           t.resource_triples(properties, "src", F.lit(V.RDFS_SUBPROPERTY), "dst")]
    )


_TERM = ["value", "value_kind", "value_datatype", "value_lang"]


def _restrictions(triples: DataFrame, filler: str) -> DataFrame:
    """`(restriction, property, value...)` of one kind of restriction."""
    on = pairs(triples, V.OWL_ON_PROPERTY, "restriction", "property")
    fillers = triples.where(t.predicate_matches(filler)).select(
        F.col("s").alias("restriction"), *(F.col(o).alias(v) for o, v in zip(t.OBJECT_COLUMNS, _TERM))
    )
    return storage.materialize(on.join(fillers, "restriction").distinct(), name="restrictions")


def _instances(triples: DataFrame) -> DataFrame:
    rows = triples.where(t.predicate_matches(V.RDF_TYPE) & ~t.is_literal("o"))
    return rows.select(F.col("s").alias("instance"), F.col("o").alias("class"))


def _instances_of(triples: DataFrame, classes: DataFrame, name: str) -> DataFrame:
    """Instances of the classes in a column of a stored table; the others are dropped before anything is shuffled."""
    return _instances(triples).join(classes.select(F.col(name).alias("class")), "class", "left_semi")


def restriction_triples(triples: DataFrame) -> DataFrame:
    """rdfp14a/b, rdfp15 and rdfp16: hasValue, someValuesFrom and allValuesFrom."""
    types = _instances(triples)
    has_value = _restrictions(triples, V.OWL_HAS_VALUE)
    same_term = reduce(
        lambda a, b: a & b,
        (F.col(o).eqNullSafe(F.col(v)) for o, v in zip(t.OBJECT_COLUMNS, _TERM)),
    )
    by_value = triples.join(has_value, (F.col("p") == F.col("property")) & same_term).select("s", "restriction")
    given = types.join(has_value, F.col("class") == F.col("restriction")).select(
        F.col("instance").alias("s"), t.kind_of(F.col("instance")).alias("s_kind"), F.col("property").alias("p"),
        *(F.col(v).alias(o) for o, v in zip(t.OBJECT_COLUMNS, _TERM)),
    )
    resources = triples.where(~t.is_literal("o")).select("s", "p", "o")
    some = _restrictions(triples, V.OWL_SOME_VALUES).select("restriction", "property", F.col("value").alias("filler"))
    some_rows = resources.join(some, F.col("p") == F.col("property"))
    by_some = some_rows.join(
        _instances_of(triples, some, "filler"), (F.col("o") == F.col("instance")) & (F.col("filler") == F.col("class")), "left_semi"
    ).select("s", "restriction")
    every = _restrictions(triples, V.OWL_ALL_VALUES).select("restriction", "property", F.col("value").alias("filler"))
    every_rows = resources.join(every, F.col("p") == F.col("property"))
    by_every = every_rows.join(
        _instances_of(triples, every, "restriction"), (F.col("s") == F.col("instance")) & (F.col("restriction") == F.col("class")), "left_semi"
    ).select("o", "filler")
    return _union([
        t.resource_triples(by_value, "s", F.lit(V.RDF_TYPE), "restriction"),
        given,
        t.resource_triples(by_some, "s", F.lit(V.RDF_TYPE), "restriction"),
        t.resource_triples(by_every, "o", F.lit(V.RDF_TYPE), "filler"),
    ])
