"""The OWL Horst closure by deltas: a round looks only for what the last round's new triples entail.

All rules are rows of one table, keyed by the predicate or the class that sets them off, with the hierarchies already
composed into them. A round scans the facts once, joined with that table:

* rules on one triple (rdfs2, 3, 7, 9, rdfp3, 8, 14) fire for new triples, and for known ones only under rules that
  are new themselves; rules on predicates are composed over inverses too, so what one of them derives sets off none again;
* rules on two triples (rdfp4, 15, 16) leave one stored row per triple with the node at which it meets another, and new rows are
  joined with all of the other side, known ones with new ones only; functional properties (rdfp1, 2) are grouped by the same rows.

What the schema alone entails (rdfs5, 11, rdfp9, 10, 12, 13) is derived when a round brings schema triples. Equality (rdfp6, 7, 11) is
kept as representatives: what given triples make equal is replaced before the first round, and when a round brings new links, known triples that
mention a replaced node are rewritten and count as new, and all others stay known. Each triple carries the round in which it came.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.operators import inference as inf
from kglake.plans import storage

CLASS_KINDS = [V.OWL_CLASS, V.RDFS_CLASS]
PROPERTY_KINDS = [V.OWL_OBJECT_PROPERTY, V.RDF_PROPERTY]
MARKS = [V.OWL_SYMMETRIC, V.OWL_TRANSITIVE, V.OWL_FUNCTIONAL, V.OWL_INVERSE_FUNCTIONAL]
SCHEMA_PREDICATES = inf.SCHEMA_PREDICATES + [
    V.OWL_INVERSE_OF, V.OWL_EQUIVALENT_CLASS, V.OWL_EQUIVALENT_PROPERTY, V.OWL_ON_PROPERTY, V.OWL_HAS_VALUE, V.OWL_SOME_VALUES,
    V.OWL_ALL_VALUES,
]
VALUE = ["value", "value_kind", "value_datatype", "value_lang"]
# Rules whose triple waits for another one; the rest derive from one triple.
MEETING = ["path", "some", "some_class", "all", "all_class", "functional", "inverse_functional"]
# Rules keyed by the predicate that derive from one triple, those of them that give it another predicate, and those that give types.
SINGLE = ["super", "same", "inverse", "domain", "subject", "range"]
TURNS = ["super", "same", "inverse"]
TYPES = ["domain", "subject", "range", "superclass"]
WAIT = ["family", "tag", "filler", "node", "side", "payload", "out"]
# Predicates of what the schema alone entails.
SCHEMA_HEADS = [V.RDFS_SUBCLASS, V.OWL_EQUIVALENT_CLASS, V.RDFS_SUBPROPERTY, V.OWL_EQUIVALENT_PROPERTY]
RULE_COLUMNS = ["keyed_by", "key", "rule", "target", *VALUE]


def is_schema() -> Column:
    marks = CLASS_KINDS + PROPERTY_KINDS + MARKS
    return F.col("p").isin(SCHEMA_PREDICATES) | (t.predicate_matches(V.RDF_TYPE) & t.is_iri("o") & F.col("o").isin(marks))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _hierarchy(schema: DataFrame, sub: str, equivalence: str) -> DataFrame:
    """All `(src, dst)` pairs below each other, equivalence as both directions."""
    equal = inf.pairs(schema, equivalence)
    edges = inf.pairs(schema, sub).unionByName(equal).unionByName(equal.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return inf.transitive_closure(edges.distinct())


def _entailed_by_schema(schema: DataFrame, classes: DataFrame, properties: DataFrame, links: DataFrame | None) -> DataFrame:
    """Hierarchies and equivalences as triples; a class or property with equals is below itself."""
    def kinds(wanted: list[str]) -> DataFrame:
        return schema.where(t.predicate_matches(V.RDF_TYPE) & F.col("o").isin(wanted)).select(F.col("s").alias("src"))

    parts = []
    for pairs, sub, equivalence, wanted in (
            (classes, V.RDFS_SUBCLASS, V.OWL_EQUIVALENT_CLASS, CLASS_KINDS),
            (properties, V.RDFS_SUBPROPERTY, V.OWL_EQUIVALENT_PROPERTY, PROPERTY_KINDS)):
        opposite = pairs.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        mutual = pairs.where("src <> dst").join(opposite, ["src", "dst"], "left_semi")
        parts += [inf.closure_as_triples(pairs, sub), inf.closure_as_triples(mutual, equivalence)]
        # Equivalences are symmetric even where a node is equivalent to itself.
        own = inf.pairs(schema, equivalence).select(F.col("dst").alias("src"), F.col("src").alias("dst"))
        parts.append(inf.closure_as_triples(own, equivalence))
        if links is not None:
            reps = links.select(F.col("representative").alias("src")).distinct().join(kinds(wanted), "src", "left_semi")
            parts.append(t.resource_triples(reps, "src", F.lit(sub), "src"))
    return _union(parts)


def _over_inverses(supers: DataFrame, inverses: DataFrame) -> DataFrame | None:
    """`src, dst, turned`: predicates that a triple of `src` with a resource as object also has, by a path with an inverse; none without inverses.

    `turned` tells that subject and object change places. Paths within `supers` alone, which is closed, are left out.
    """
    inverses = storage.materialize(inverses.distinct(), name="inverses")
    if inverses.isEmpty():
        return None
    ends = inverses.select(F.col("src").alias("dst")).distinct()
    steps = inverses.withColumn("turn", F.lit(1)).unionByName(supers.join(ends, "dst", "left_semi").withColumn("turn", F.lit(0)))
    sided = steps.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        F.concat_ws(" ", "side", "src").alias("src"), F.concat_ws(" ", (F.col("side") + F.col("turn")) % 2, "dst").alias("dst"))
    reached = inf.transitive_closure(sided.distinct()).where(F.col("src").startswith("0 ")).select(
        F.expr("substr(src, 3)").alias("src"), F.expr("substr(dst, 3)").alias("dst"), F.col("dst").startswith("1 ").alias("turned"))
    above = reached.join(supers.select(F.col("src").alias("dst"), F.col("dst").alias("super")), "dst").select(
        "src", F.col("super").alias("dst"), "turned")
    known = supers.withColumn("turned", F.lit(False))
    every = reached.unionByName(above).distinct().where("turned or src <> dst")
    return storage.materialize(every.join(known, ["src", "dst", "turned"], "left_anti"), name="over-inverses")


def rules_of(schema: DataFrame, classes: DataFrame, properties: DataFrame) -> DataFrame:
    """`RULE_COLUMNS` of every rule instance of a schema: what sets it off, its target, and the value it gives or waits for."""
    null = F.lit(None).cast("string")

    def rows(frame: DataFrame, keyed_by: str, key, rule: str, target, value: list[Column] | None = None) -> DataFrame:
        key, target = (F.col(c) if isinstance(c, str) else c for c in (key, target))
        value = value or [null] * 4
        return frame.select(F.lit(keyed_by).alias("keyed_by"), key.alias("key"), F.lit(rule).alias("rule"), target.alias("target"),
                            *(c.alias(name) for c, name in zip(value, VALUE)))

    def marked(kind: str) -> DataFrame:
        return schema.where(t.predicate_matches(V.RDF_TYPE) & t.object_matches(kind)).select(F.col("s").alias("src"))

    def restrictions(filler: str) -> DataFrame:
        on = inf.pairs(schema, V.OWL_ON_PROPERTY, "target", "property")
        return on.join(schema.where(t.predicate_matches(filler)).select(
            F.col("s").alias("target"), *(F.col(o).alias(v) for o, v in zip(t.OBJECT_COLUMNS, VALUE))), "target").where(
            ~F.col("property").startswith("_:"))

    def can_be_predicate(column: str) -> Column:
        return ~F.col(column).startswith("_:")

    value = [F.col(c) for c in VALUE]
    inverse = inf.pairs(schema, V.OWL_INVERSE_OF)
    opposite = inverse.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    mirrored = marked(V.OWL_SYMMETRIC).select("src", F.col("src").alias("dst"))
    supers = properties.where(can_be_predicate("dst") & (F.col("src") != F.col("dst")))
    domains, ranges = (inf._widened(inf.pairs(schema, p), classes, properties) for p in (V.RDFS_DOMAIN, V.RDFS_RANGE))
    over = _over_inverses(supers, _union([inverse, opposite, mirrored]).where(can_be_predicate("src") & can_be_predicate("dst")))
    has, some, every = (restrictions(filler) for filler in (V.OWL_HAS_VALUE, V.OWL_SOME_VALUES, V.OWL_ALL_VALUES))
    some, every = (frame.where(F.col("value_kind") != t.LITERAL) for frame in (some, every))
    parts = [
        rows(supers, "p", "src", "super", "dst"),
        rows(domains, "p", "src", "domain", "dst"), rows(ranges, "p", "src", "range", "dst"),
        rows(marked(V.OWL_TRANSITIVE), "p", "src", "path", "src"),
        rows(marked(V.OWL_FUNCTIONAL), "p", "src", "functional", "src"),
        rows(marked(V.OWL_INVERSE_FUNCTIONAL), "p", "src", "inverse_functional", "src"),
        rows(classes.where("src <> dst"), "c", "src", "superclass", "dst"),
        rows(has, "p", "property", "has", "target", value), rows(has, "c", "target", "given", "property", value),
        rows(some, "p", "property", "some", "target", value), rows(some, "c", "value", "some_class", "target", value),
        rows(every, "p", "property", "all", "target", value), rows(every, "c", "target", "all_class", "target", value),
    ]
    if over is not None:
        def types(turned: bool, of: DataFrame) -> DataFrame:
            through = over.where(F.col("turned") == turned).select("src", F.col("dst").alias("via"))
            return through.join(of.select(F.col("src").alias("via"), "dst"), "via").select("src", "dst")

        parts += [
            rows(over.where("not turned"), "p", "src", "same", "dst"), rows(over.where("turned"), "p", "src", "inverse", "dst"),
            rows(types(False, domains).unionByName(types(True, ranges)), "p", "src", "subject", "dst"),
            rows(types(False, ranges).unionByName(types(True, domains)), "p", "src", "range", "dst"),
        ]
    return _union(parts).distinct()


def keys_of(facts: DataFrame) -> DataFrame:
    """`keyed_by, key`: the predicates and classes in `facts`."""
    types = facts.where(t.predicate_matches(V.RDF_TYPE) & ~t.is_literal("o")).select(F.lit("c").alias("keyed_by"), F.col("o").alias("key"))
    return facts.select(F.lit("p").alias("keyed_by"), F.col("p").alias("key")).distinct().unionByName(types.distinct())


def set_off(rules: DataFrame, keys: DataFrame) -> DataFrame:
    """Those of `rules` whose key is one of `keys`: few, however many properties a schema declares."""
    return rules.join(keys, ["keyed_by", "key"], "left_semi")


def _head() -> Column:
    """The predicate of what a rule derives."""
    rule = F.col("rule")
    return F.when(rule.isin(*TURNS, "given", "path"), F.col("target")).when(
        rule.isin("functional", "inverse_functional"), F.lit(V.OWL_SAME_AS)).otherwise(F.lit(V.RDF_TYPE))


def with_heads(rules: DataFrame, keys: DataFrame) -> DataFrame:
    """`rules` that facts with `keys` set off, with `head`, the predicate of what they derive, and `sole`.

    A rule of `TURNS` is `sole` if it alone leads to a predicate that no fact has. It keeps different triples different, so what it
    derives from a set is a set, without looking for repeats.
    """
    headed = rules.withColumn("head", _head())
    alone = headed.groupBy("head").agg(F.count("*").alias("n")).where("n = 1").select("head")
    used = keys.where("keyed_by = 'p'").select(F.col("key").alias("head"))
    sole = headed.where(F.col("rule").isin(TURNS) & ~F.col("head").isin(SCHEMA_HEADS)).join(alone, "head", "left_semi").join(
        used, "head", "left_anti").select("head", F.lit(True).alias("is_sole"))
    return headed.join(sole, "head", "left").withColumn("sole", F.coalesce("is_sole", F.lit(False))).drop("is_sole")


def hits(facts: DataFrame, rules: DataFrame) -> DataFrame:
    """Facts joined with the rules that they set off and that fire. One scan of the facts.

    `rules` has `rule_is_new`, `facts` has `fact_is_new`. Where facts have `turned, typed`, whether a rule of `TURNS` or `TYPES` gave the
    triple, rules that are not new do not fire on what they lead to from the triple before.
    """
    type_of = t.predicate_matches(V.RDF_TYPE) & ~t.is_literal("o")
    by_predicate, by_class = (F.struct(F.lit(by).alias("keyed_by"), F.col(c).alias("key")) for by, c in (("p", "p"), ("c", "o")))
    keys = F.when(type_of, F.array(by_predicate, by_class)).otherwise(F.array(by_predicate))
    rows = facts.select("*", F.explode(keys).alias("k")).select("*", "k.*").drop("k").join(rules, ["keyed_by", "key"])
    rule, resource = F.col("rule"), F.col("o_kind") != t.LITERAL
    if "turned" in facts.columns:
        done = (F.col("turned") & rule.isin(SINGLE)) | (F.col("typed") & (rule == "superclass"))
        rows = rows.where(F.col("rule_is_new") | ~done)
    same_value = reduce(Column.__and__, (F.col(o).eqNullSafe(F.col(v)) for o, v in zip(t.OBJECT_COLUMNS, VALUE)))
    return rows.where(F.when(
        rule.isin("range", "inverse", "same", "subject", "path", "some", "all", "functional", "inverse_functional"), resource).when(
        rule == "has", same_value).otherwise(F.lit(True)))


def derived(fired: DataFrame) -> DataFrame:
    """The triples of rules on one triple, given their `hits`, where fact or rule is new, with `turned, typed`."""
    rule, null = F.col("rule"), F.lit(None).cast("string")
    swapped = rule.isin("range", "inverse")
    target = [F.col("target"), t.kind_of(F.col("target")), null, null]
    objects = [
        F.when(rule.isin("super", "same"), F.col(o)).when(rule == "inverse", s).when(rule == "given", F.col(v)).otherwise(x)
        for o, v, s, x in zip(t.OBJECT_COLUMNS, VALUE, (F.col("s"), F.col("s_kind"), null, null), target)]
    return fired.where(F.col("fact_is_new") | F.col("rule_is_new")).select(
        F.when(swapped, F.col("o")).otherwise(F.col("s")).alias("s"),
        F.when(swapped, F.col("o_kind")).otherwise(F.col("s_kind")).alias("s_kind"),
        F.when(rule.isin(*TURNS, "given"), F.col("target")).otherwise(F.lit(V.RDF_TYPE)).alias("p"),
        *(c.alias(name) for c, name in zip(objects, t.OBJECT_COLUMNS)), rule.isin(TURNS).alias("turned"), rule.isin(TYPES).alias("typed"))


def waiting(fired: DataFrame) -> DataFrame:
    """The rows of `WAIT` of rules on two triples, given their `hits`."""
    rule, null = F.col("rule"), F.lit(None).cast("string")

    def meet(family: str, node: str, side: int, payload=null, filler=None, out=null) -> Column:
        payload = F.col(payload) if isinstance(payload, str) else payload
        return F.struct(
            F.lit(family).alias("family"), F.col("target").alias("tag"), (F.lit("") if filler is None else filler).alias("filler"),
            F.col(node).alias("node"), F.lit(side).alias("side"), payload.alias("payload"), out.alias("out"))

    waits = (F.when(rule == "path", F.array(meet("path", "o", 0, "s"), meet("path", "s", 1, "o")))
             .when(rule == "some", F.array(meet("some", "o", 0, "s", F.col("value"))))
             .when(rule == "some_class", F.array(meet("some", "s", 1, null, F.col("key"))))
             .when(rule == "all", F.array(meet("all", "s", 0, "o", None, F.col("value"))))
             .when(rule == "all_class", F.array(meet("all", "s", 1)))
             .when(rule == "functional", F.array(meet("functional", "s", 0, "o")))
             .when(rule == "inverse_functional", F.array(meet("inverse functional", "o", 0, "s"))))
    return fired.select(F.explode(waits).alias("wait")).select("wait.*")


def entailed(new: DataFrame, known: DataFrame | None) -> DataFrame:
    """Triples that stored rows of `WAIT` derive where they meet: `new` ones with all, `known` ones with new ones only."""
    keys = ["family", "tag", "filler", "node"]

    def side(frame: DataFrame, k: int) -> DataFrame:
        pairs = frame.where((F.col("side") == k) & ~F.col("family").endswith("functional"))
        return pairs.select(*keys, *(F.col(c).alias(f"{c}_{k}") for c in ("payload", "out")))

    def functional(frame: DataFrame) -> DataFrame:
        return frame.where(F.col("family").endswith("functional")).select(*keys, "payload")

    met, values = side(new, 0).join(side(new, 1), keys), functional(new)
    if known is not None:
        rule = ["family", "tag", "filler"]
        asked = storage.materialize(new.select(*rule, "side").distinct(), name="asked")

        def met_by(k: int) -> DataFrame:
            """Known rows of side `k` that have new ones of their rule on the other side: the rest is not shuffled."""
            return side(known, k).join(asked.where(F.col("side") != k).select(*rule), rule, "left_semi")

        met = _union([met, side(new, 0).join(met_by(1), keys), met_by(0).join(side(new, 1), keys)])
        known_values = functional(known).join(asked.select(*rule).distinct(), rule, "left_semi")
        values = values.unionByName(known_values.join(values.select(*keys).distinct(), keys, "left_semi"))
    is_path = F.col("family") == "path"
    by_two = t.resource_triples(
        met, "payload_0", F.when(is_path, F.col("tag")).otherwise(F.lit(V.RDF_TYPE)),
        F.when(is_path, F.col("payload_1")).when(F.col("family") == "some", F.col("tag")).otherwise(F.col("out_0")))
    least = values.groupBy(*keys).agg(F.min("payload").alias("least"))
    equal = values.join(least, keys).where("payload <> least")
    return by_two.unionByName(t.resource_triples(equal, "payload", F.lit(V.OWL_SAME_AS), "least"))


def _same_triple(a: DataFrame, b: DataFrame) -> Column:
    """The same triple by its digest `k`, which is cheap to sort by, and then by all columns."""
    return reduce(Column.__and__, (a[c].eqNullSafe(b[c]) for c in t.TRIPLE_COLUMNS), a["k"] == b["k"])


def unseen(candidates: DataFrame, facts: list[DataFrame]) -> DataFrame:
    """Those of `candidates` that no frame of `facts` has. Facts with other predicates are left out before they meet, and where the candidates
    are few, nothing of the facts moves."""
    def keyed(frame: DataFrame) -> DataFrame:
        return frame.withColumn("k", F.xxhash64(*t.TRIPLE_COLUMNS))

    heads = storage.materialize(candidates.select("p").distinct(), name="heads")
    candidates = keyed(candidates)
    of_heads = _union([f.select(*t.TRIPLE_COLUMNS) for f in facts]).join(heads, "p", "left_semi").select(*t.TRIPLE_COLUMNS)
    met = keyed(of_heads)
    seen = met.join(candidates, _same_triple(met, candidates), "left_semi")
    return candidates.join(seen, _same_triple(candidates, seen), "left_anti").drop("k")


def normal(facts: DataFrame, links: DataFrame) -> DataFrame:
    """`facts` over representatives (`links`: `node, representative`), with `changed` where one replaced a node.

    Of the equality links only those to representatives are left. Predicates of the fixed vocabularies are not replaced, nor any by a
    blank node.
    """
    def joined(frame: DataFrame, key: Column, name: str) -> DataFrame:
        reps = links.select(F.col("node").alias(f"{name}_node"), F.col("representative").alias(name))
        return frame.join(reps, key == F.col(f"{name}_node"), "left").drop(f"{name}_node")

    fixed = reduce(Column.__or__, (F.col("p").startswith(space) for space in (V.RDF, V.RDFS, V.OWL)))
    rows = joined(facts, F.col("s"), "new_s")
    rows = joined(rows, F.when(~fixed, F.col("p")), "new_p").withColumn("new_p", F.when(~F.col("new_p").startswith("_:"), F.col("new_p")))
    rows = joined(rows, F.when(~t.is_literal("o"), F.col("o")), "new_o")
    link = t.predicate_matches(V.OWL_SAME_AS) & ~t.is_literal("o")
    rows = rows.where(~link | F.col("new_s").eqNullSafe(F.col("o")))
    changed = F.when(link, F.lit(False)).otherwise(
        F.col("new_s").isNotNull() | F.col("new_p").isNotNull() | F.col("new_o").isNotNull())
    rows = rows.withColumn("changed", changed)

    def taken(column: str) -> Column:
        return F.when(F.col("changed"), F.coalesce(f"new_{column}", column)).otherwise(F.col(column))

    rest = [c for c in facts.columns if c not in t.TRIPLE_COLUMNS]
    rows = rows.select(taken("s").alias("s"), taken("p").alias("p"), taken("o").alias("o"), "o_kind", "o_datatype", "o_lang", "changed", *rest)
    return rows.select(
        "s", t.kind_of(F.col("s")).alias("s_kind"), "p", "o",
        F.when(t.is_literal("o"), F.lit(t.LITERAL)).otherwise(t.kind_of(F.col("o"))).alias("o_kind"), "o_datatype", "o_lang", "changed", *rest)


def given_equality(triples: DataFrame, keep) -> DataFrame | None:
    """`node, representative` of what given sameAs triples and the given values of functional properties make equal; none without any.

    Only those triples are looked at, until they make no more equal, so the graph is rewritten once, as it is first stored. What
    only derived triples make equal is left to the rounds.
    """
    same, mark = t.predicate_matches(V.OWL_SAME_AS) & ~t.is_literal("o"), t.predicate_matches(V.RDF_TYPE) & t.is_iri("o")
    marks = mark & F.col("o").isin(V.OWL_FUNCTIONAL, V.OWL_INVERSE_FUNCTIONAL)
    stated = keep(triples.where(same | marks).select(*t.TRIPLE_COLUMNS), "stated")
    marked = keep(stated.where(marks).select(F.col("s").alias("property")).distinct(), "marked")
    found, links, values, number = inf.pairs(stated, V.OWL_SAME_AS), None, None, 0
    if not marked.isEmpty():
        rows = triples.where(~t.is_literal("o") & (F.col("p") != V.OWL_SAME_AS)).select(*t.TRIPLE_COLUMNS)
        rows = rows.join(marked, rows.p == marked.property, "left_semi").unionByName(stated.where(marks))
        values = keep(rows.distinct(), "values-0")
    while True:
        if values is not None:
            found = found.unionByName(inf.pairs(inf.functional_same_as(values), V.OWL_SAME_AS))
        found = keep(found, f"found-{number}")
        if found.isEmpty():
            return links
        equal = found if links is None else found.unionByName(links.select(F.col("node").alias("src"), F.col("representative").alias("dst")))
        links = keep(inf.connected_components(equal), f"given-links-{number}")
        if values is None:
            return links
        number += 1
        values = keep(normal(values, links).select(*t.TRIPLE_COLUMNS).distinct(), f"values-{number}")
        found = found.limit(0)


def closure_in_rounds(triples: DataFrame) -> DataFrame:
    """The triples and all that the rules entail, as a set over representatives, each with the `round` it came in (given ones: 0).

    A node that equals a smaller one is replaced by it everywhere, with one sameAs link; a rewritten triple has the round
    of its rewriting. No rule invents a node, so a round that brings nothing ends the loop.
    """
    folder = storage.shared_folder(triples.sparkSession)

    def keep(frame: DataFrame, name: str) -> DataFrame:
        return storage.materialize(frame, folder, name)

    def numbered(frame: DataFrame, number: int) -> DataFrame:
        return frame.select(*t.TRIPLE_COLUMNS, F.lit(number).alias("round"), "turned", "typed")

    def given(frame: DataFrame) -> DataFrame:
        return frame.select(*t.TRIPLE_COLUMNS, F.lit(False).alias("turned"), F.lit(False).alias("typed"))

    links, first = given_equality(triples, keep), triples
    if links is not None:
        first = normal(triples, links).select(*t.TRIPLE_COLUMNS).unionByName(
            t.resource_triples(links, "node", F.lit(V.OWL_SAME_AS), "representative"))
    delta = keep(numbered(given(inf.as_set(first)), 0), "round-0")
    known: list[DataFrame] = []
    schema: list[DataFrame] = []
    waits: list[DataFrame] = []  # rows of `WAIT` of known facts
    rules = None
    schema_moved, number = False, 0
    while not delta.isEmpty():
        number += 1
        fresh_schema = keep(delta.where(is_schema()).select(*t.TRIPLE_COLUMNS), f"schema-{number}")
        by_schema, fresh = [], None
        if schema_moved or rules is None or not fresh_schema.isEmpty():
            schema.append(fresh_schema)
            rows = _union(schema)
            classes = _hierarchy(rows, V.RDFS_SUBCLASS, V.OWL_EQUIVALENT_CLASS)
            properties = _hierarchy(rows, V.RDFS_SUBPROPERTY, V.OWL_EQUIVALENT_PROPERTY)
            by_schema = [given(_entailed_by_schema(rows, classes, properties, links))]
            before, rules = rules, keep(rules_of(rows, classes, properties), f"rules-{number}")
            fresh = keep(rules.subtract(before), f"fresh-rules-{number}") if known else None
        old = rules if fresh is None else rules.subtract(fresh)
        tagged = old.withColumn("rule_is_new", F.lit(False))
        if fresh is not None:
            tagged = tagged.unionByName(fresh.withColumn("rule_is_new", F.lit(True)))
        meeting = F.col("rule").isin(MEETING)
        keys = keep(keys_of(delta), f"keys-{number}")
        found = [(delta.withColumn("fact_is_new", F.lit(True)), keep(with_heads(set_off(tagged, keys), keys), f"set-off-{number}"))]
        if known:
            everything = _union(known).select(*t.TRIPLE_COLUMNS, F.lit(False).alias("fact_is_new"))
            if not waits:  # a rewriting has changed them
                again = set_off(old.where(meeting).withColumn("rule_is_new", F.lit(False)), keys_of(everything))
                waits = [keep(waiting(hits(everything, keep(again, f"waiting-{number}"))), f"known-waits-{number}")]
            if fresh is not None and not fresh.isEmpty():
                late = set_off(fresh.withColumn("rule_is_new", F.lit(True)), keys_of(everything))
                found.append((everything, keep(late, f"late-{number}")))
        new_waits = keep(_union([waiting(hits(facts, by.where(meeting))) for facts, by in found]), f"waits-{number}")
        by_two = given(entailed(new_waits, _union(waits) if waits else None))
        waits.append(new_waits)
        flags = [F.max("turned").alias("turned"), F.max("typed").alias("typed")]
        if not known:
            # The first candidates are about as many as the facts: both meet in one grouping, but for facts with predicates that no candidate
            # has, and candidates that need not look for repeats.
            (facts, by), = found
            single = derived(hits(facts, by.where(~meeting & ~F.col("sole"))))
            heads = by.where("not sole").select(F.col("head").alias("p")).unionByName(
                delta.sparkSession.createDataFrame([(p,) for p in SCHEMA_HEADS], "p string"))
            rivals = delta.join(keep(heads.distinct(), f"heads-{number}"), "p", "left_semi")
            met = _union([single, by_two, *by_schema]).withColumn("seen", F.lit(False)).unionByName(rivals.select(
                *t.TRIPLE_COLUMNS, "turned", "typed", F.lit(True).alias("seen")))
            fresh_facts = met.groupBy(*t.TRIPLE_COLUMNS).agg(*flags, F.max("seen").alias("seen")).where("not seen").drop("seen")
            fresh_facts = fresh_facts.unionByName(derived(hits(facts, by.where("sole"))))
        else:
            single = [derived(hits(facts, by.where(~meeting))) for facts, by in found]
            candidates = _union([*single, by_two, *by_schema])
            candidates = keep(candidates.groupBy(*t.TRIPLE_COLUMNS).agg(*flags), f"candidates-{number}")
            fresh_facts = unseen(candidates, [*known, delta])
        known.append(delta)
        new = keep(numbered(fresh_facts, number), f"round-{number}")
        schema_moved = False
        if new.where(t.predicate_matches(V.OWL_SAME_AS) & ~t.is_literal("o") & (F.col("s") != F.col("o"))).isEmpty():
            delta = new
        else:
            known, links, delta = _rewritten(known, new, keep, number)
            schema = [keep(_union(known).where(is_schema()).select(*t.TRIPLE_COLUMNS), f"known-schema-{number}")]
            schema_moved, waits = True, []
    return _union(known).drop("turned", "typed") if known else delta.drop("turned", "typed")


def _rewritten(known: list[DataFrame], new: DataFrame, keep, number: int):
    """`known, links, delta` after new equalities: what they change counts as new, the rest of the known stays known.

    Only what changed is looked for among the rest; new triples that did not change are a set apart from the known as they are.
    """
    links = keep(inf.same_as_components(_union([*known, new])), f"links-{number}")
    old = keep(normal(_union(known), links), f"normal-{number}")
    fresh = keep(normal(new, links), f"fresh-{number}")
    kept, same = (frame.where("not changed").drop("changed") for frame in (old, fresh))
    linked = t.resource_triples(links, "node", F.lit(V.OWL_SAME_AS), "representative")
    moved = keep(_union([linked, *(frame.where("changed").select(*t.TRIPLE_COLUMNS) for frame in (old, fresh))]).distinct(), f"moved-{number}")
    moved = unseen(moved, [kept, same]).select("*", F.lit(number).alias("round"), F.lit(False).alias("turned"), F.lit(False).alias("typed"))
    return [kept], links, same.unionByName(keep(moved, f"delta-{number}"))


def owl_horst_closure(triples: DataFrame) -> DataFrame:
    """RDFS and OWL Horst rules until a round adds nothing; see `closure_in_rounds`."""
    return closure_in_rounds(triples).select(*t.TRIPLE_COLUMNS)
