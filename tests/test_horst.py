"""The closure by deltas against every rule applied to everything until nothing is new."""

import random

import pytest
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.operators import horst

A, SAME, SUB, SUBP = V.RDF_TYPE, V.OWL_SAME_AS, V.RDFS_SUBCLASS, V.RDFS_SUBPROPERTY


def step(facts):
    """One application of each rule to all facts; literals begin with a quote."""
    by = {}
    for s, p, o in facts:
        by.setdefault(p, set()).add((s, o))
    resources = {(s, p, o) for s, p, o in facts if not o.startswith('"')}

    def of(p):
        return by.get(p, set())

    def marked(kind):
        return {s for s, o in of(A) if o == kind}

    out = set()
    for sub, equal, kinds in ((SUB, V.OWL_EQUIVALENT_CLASS, horst.CLASS_KINDS), (SUBP, V.OWL_EQUIVALENT_PROPERTY, horst.PROPERTY_KINDS)):
        out |= {(a, sub, d) for a, b in of(sub) for c, d in of(sub) if b == c}
        out |= {x for a, b in of(equal) for x in ((a, sub, b), (b, sub, a))}
        out |= {(a, equal, b) for a, b in of(sub) if a != b and (b, a) in of(sub)}
        out |= {(b, equal, a) for a, b in of(equal)}
        out |= {(b, sub, b) for a, b in of(SAME) if any((b, k) in of(A) for k in kinds)}
    out |= {(s, q, o) for s, p, o in facts for a, q in of(SUBP) if a == p and not q.startswith("_:")}
    out |= {(s, A, c) for s, p, _ in facts for a, c in of(V.RDFS_DOMAIN) if a == p}
    out |= {(o, A, c) for _, p, o in resources for a, c in of(V.RDFS_RANGE) if a == p}
    out |= {(x, A, d) for x, c in of(A) for a, d in of(SUB) if a == c}
    inverse = of(V.OWL_INVERSE_OF) | {(b, a) for a, b in of(V.OWL_INVERSE_OF)} | {(p, p) for p in marked(V.OWL_SYMMETRIC)}
    out |= {(o, q, s) for s, p, o in resources for a, q in inverse if a == p}
    for p in marked(V.OWL_TRANSITIVE):
        out |= {(a, p, d) for a, b in of(p) for c, d in of(p) if b == c}
    for kind, key, value in ((V.OWL_FUNCTIONAL, 0, 1), (V.OWL_INVERSE_FUNCTIONAL, 1, 0)):
        for p in marked(kind):
            groups = {}
            for pair in of(p):
                if not pair[1].startswith('"'):
                    groups.setdefault(pair[key], set()).add(pair[value])
            out |= {(v, SAME, min(group)) for group in groups.values() for v in group if v != min(group)}
    for r, p in of(V.OWL_ON_PROPERTY):
        for x, v in of(V.OWL_HAS_VALUE):
            if x == r:
                out |= {(s, A, r) for s, o in of(p) if o == v} | {(s, p, v) for s, c in of(A) if c == r}
        for x, c in of(V.OWL_SOME_VALUES):
            if x == r:
                out |= {(s, A, r) for s, o in of(p) if (o, c) in of(A)}
        for x, c in of(V.OWL_ALL_VALUES):
            if x == r:
                out |= {(o, A, c) for s, o in of(p) if (s, r) in of(A) and not o.startswith('"')}
    return out


def normal(facts):
    root = {}

    def find(x):
        while root.get(x, x) != x:
            x = root[x]
        return x

    for s, p, o in facts:
        if p == SAME:
            a, b = sorted((find(s), find(o)))
            root[b] = a
    replaced = {x for s, p, o in facts if p == SAME for x in (s, o) if find(x) != x}
    out = {(find(s), p if p.startswith("http://www.w3") else find(p), find(o)) for s, p, o in facts if p != SAME}
    return out | {(x, SAME, find(x)) for x in replaced}


def closed(facts):
    facts = normal(facts)
    while True:
        more = normal(facts | step(facts))
        if more == facts:
            return facts
        facts = more


def frame(spark, facts):
    def row(s, p, o):
        literal = o.startswith('"')
        return (s, t.BNODE if s.startswith("_:") else t.IRI, p, o[1:] if literal else o,
                t.LITERAL if literal else t.BNODE if o.startswith("_:") else t.IRI, V.XSD_STRING if literal else None, None)

    return spark.createDataFrame([row(*f) for f in facts], t.TRIPLE_SCHEMA)


def rows(df):
    return {(r.s, r.p, ('"' if r.o_kind == t.LITERAL else "") + r.o) for r in df.collect()}


CHAIN = [
    # Each step needs what the one before derives: types, a path, equality, a value, a new mark, a new hierarchy row.
    ("http://e/p", A, V.OWL_TRANSITIVE), ("http://e/a", "http://e/p", "http://e/b"), ("http://e/b", "http://e/p", "http://e/c"),
    ("http://e/c", "http://e/p", "http://e/d"), ("http://e/R", V.OWL_ON_PROPERTY, "http://e/p"), ("http://e/R", V.OWL_SOME_VALUES, "http://e/C"),
    ("http://e/d", A, "http://e/C"), ("http://e/R", SUB, "http://e/Marked"), ("http://e/f", V.RDFS_DOMAIN, "http://e/Marked"),
    ("http://e/Q", V.OWL_ON_PROPERTY, "http://e/g"), ("http://e/Q", V.OWL_HAS_VALUE, "http://e/z"), ("http://e/Marked", SUB, "http://e/Q"),
    ("http://e/g", A, V.OWL_INVERSE_FUNCTIONAL), ("http://e/a", "http://e/name", '"one'), ("http://e/b", "http://e/name", '"two'),
    ("http://e/turn", SUBP, SUB), ("http://e/Q", "http://e/turn", "http://e/Late"), ("http://e/Late", SUB, "http://e/Later"),
    ("http://e/h", SAME, "http://e/p"), ("http://e/d", "http://e/h", "http://e/e"), ("_:x", "http://e/p", "http://e/a"),
]


def test_a_chain_of_rules(spark):
    got = horst.closure_in_rounds(frame(spark, CHAIN * 2))
    assert rows(got) == closed(set(CHAIN))
    assert got.count() == len(closed(set(CHAIN)))
    assert ("_:x", A, "http://e/Later") in rows(got)  # the least of all that g makes equal
    assert rows(got.where("round = 0")) <= normal(set(CHAIN))


@pytest.mark.parametrize("seed", range(2))
def test_random_graphs(spark, seed):
    r = random.Random(seed)
    nodes = [f"http://e/n{k}" for k in range(7)] + ["_:b0"]
    classes, props = [f"http://e/C{k}" for k in range(4)], [f"http://e/p{k}" for k in range(4)]
    facts = set()
    for _ in range(14):
        facts.add((r.choice(nodes), r.choice(props), r.choice([*nodes, '"text'])))
    for _ in range(5):
        facts.add((r.choice(nodes), A, r.choice([*classes, "http://e/R0", "http://e/R1"])))
    rules = [
        lambda: (r.choice(classes), SUB, r.choice([*classes, "http://e/R0"])), lambda: (r.choice(props), SUBP, r.choice([*props, "_:q"])),
        lambda: (r.choice(props), V.RDFS_DOMAIN, r.choice(classes)), lambda: (r.choice(props), V.RDFS_RANGE, r.choice(classes)),
        lambda: (r.choice(props), A, r.choice(horst.MARKS)), lambda: (r.choice(props), V.OWL_INVERSE_OF, r.choice(props)),
        lambda: (r.choice(classes), V.OWL_EQUIVALENT_CLASS, r.choice(classes)), lambda: (r.choice(props), A, V.OWL_OBJECT_PROPERTY),
        lambda: ("http://e/R0", V.OWL_ON_PROPERTY, r.choice(props)), lambda: ("http://e/R1", V.OWL_ON_PROPERTY, r.choice(props)),
        lambda: ("http://e/R0", r.choice([V.OWL_SOME_VALUES, V.OWL_ALL_VALUES]), r.choice(classes)),
        lambda: ("http://e/R1", V.OWL_HAS_VALUE, r.choice([*nodes[:3], '"text'])), lambda: (r.choice(nodes), SAME, r.choice(nodes)),
    ]
    for _ in range(11):
        facts.add(r.choice(rules)())
    assert rows(horst.owl_horst_closure(frame(spark, facts))) == closed(facts)


def test_nothing_given(spark):
    assert horst.owl_horst_closure(t.empty_triples(spark)).count() == 0


def test_a_round_scans_the_facts_once(spark):
    """The join with the rules reads each table of facts one time, however many rules there are."""
    facts = frame(spark, CHAIN).withColumn("fact_is_new", F.lit(True))
    schema = frame(spark, CHAIN).where(horst.is_schema())
    classes = horst._hierarchy(schema, SUB, V.OWL_EQUIVALENT_CLASS)
    properties = horst._hierarchy(schema, SUBP, V.OWL_EQUIVALENT_PROPERTY)
    rules = horst.storage.materialize(horst.rules_of(schema, classes, properties)).withColumn("rule_is_new", F.lit(False))
    stored = horst.storage.materialize(facts)
    plan = horst.hits(stored, rules)._jdf.queryExecution().optimizedPlan().toString()
    assert rules.select("rule").distinct().count() > 5
    assert plan.count("Relation") == 2  # the facts and the rules


def test_ranges_by_equality_and_by_widened_schema(spark):
    """A range that only OWL rules give, and one stated by a predicate below rdfs:range."""
    from kglake.plans import enhance

    facts = [("http://e/p", V.RDFS_RANGE, "http://e/C"), ("http://e/q", SAME, "http://e/p"), ("http://e/q", A, V.OWL_OBJECT_PROPERTY),
             ("http://e/rangeOf", SUBP, V.RDFS_RANGE), ("http://e/r", "http://e/rangeOf", "http://e/D"),
             ("http://e/inverse", SAME, V.OWL_INVERSE_OF), ("http://e/x", "http://e/q", "http://e/y"), ("http://e/x", "http://e/r", "http://e/y")]
    graph = frame(spark, facts)
    used = spark.createDataFrame([("g", "1", "property", f"http://e/{p}", 1) for p in "pqr"],
                                 "graph string, version string, kind string, item string, triples long")
    ranges = {r.item: r.ranges for r in enhance.enhance_void(used, graph).collect()}
    assert ranges == {"http://e/p": ["http://e/C"], "http://e/q": [], "http://e/r": ["http://e/D"]}
    by_owl = {r.item: r.ranges for r in enhance.enhance_void(used, graph, horst=True).collect()}
    assert by_owl == {"http://e/p": ["http://e/C"], "http://e/q": ["http://e/C"], "http://e/r": ["http://e/D"]}


def test_known_rows_meet_new_ones_only(spark):
    """Rows that have met before are not joined again, and nothing is derived twice through a rule that another one holds."""
    def waits(rows):
        return spark.createDataFrame(rows, "family string, tag string, filler string, node string, side int, payload string, out string")

    known = waits([("path", "http://e/p", "", "http://e/b", 0, "http://e/a", None), ("path", "http://e/p", "", "http://e/b", 1, "http://e/c", None)])
    assert horst.entailed(known.limit(0), known).isEmpty()
    new = waits([("path", "http://e/p", "", "http://e/b", 1, "http://e/d", None)])
    assert rows(horst.entailed(new, known)) == {("http://e/a", "http://e/p", "http://e/d")}
    facts = [("http://e/p", SUBP, "http://e/q"), ("http://e/q", V.OWL_INVERSE_OF, "http://e/i"), ("http://e/i", V.RDFS_DOMAIN, "http://e/C"),
             ("http://e/i", SUBP, "http://e/j"), ("http://e/x", "http://e/p", "http://e/y"), ("http://e/x", "http://e/p", '"text')]
    got = horst.closure_in_rounds(frame(spark, facts))
    assert rows(got) == closed(set(facts))
    assert rows(got.where("round = 1")) >= {("http://e/y", "http://e/j", "http://e/x"), ("http://e/y", A, "http://e/C")}
    assert not rows(got.where("round > 1")) & {x for x in rows(got) if x[0] in ("http://e/x", "http://e/y")}


def test_given_values_are_made_equal_before_the_first_round(spark):
    """The graph is stored over representatives at once, also where one equality leads to the next."""
    facts = [("http://e/f", A, V.OWL_FUNCTIONAL), ("http://e/g", A, V.OWL_INVERSE_FUNCTIONAL), ("http://e/x", "http://e/f", "http://e/a"),
             ("http://e/x", "http://e/f", "http://e/b"), ("http://e/y", "http://e/g", "http://e/b"), ("http://e/z", "http://e/g", "http://e/a"),
             ("http://e/z", "http://e/h", "http://e/b"), ("http://e/b", SAME, "http://e/c"), ("http://e/x", "http://e/f", '"text')]
    got = horst.closure_in_rounds(frame(spark, facts))
    assert rows(got) == closed(set(facts))
    assert got.count() == len(closed(set(facts)))
    assert {("http://e/z", SAME, "http://e/y"), ("http://e/y", "http://e/h", "http://e/a")} <= rows(got.where("round = 0"))
    assert got.where("round > 0").isEmpty()


def test_only_a_predicate_with_one_rule_and_no_facts_is_left_out_of_the_grouping(spark):
    """One rule leads to `one`, two lead to `both`, and a fact has `used`: each triple comes once."""
    facts = [("http://e/p", SUBP, "http://e/one"), ("http://e/p", SUBP, "http://e/both"), ("http://e/q", V.OWL_INVERSE_OF, "http://e/both"),
             ("http://e/q", SUBP, "http://e/used"), ("http://e/r", SUBP, SUB), ("http://e/x", "http://e/p", "http://e/y"),
             ("http://e/y", "http://e/q", "http://e/x"), ("http://e/y", "http://e/used", "http://e/x"), ("http://e/C", "http://e/r", "http://e/D"),
             ("http://e/x", A, "http://e/C")]
    given = frame(spark, facts * 2)
    schema = given.where(horst.is_schema())
    rules = horst.rules_of(schema, horst._hierarchy(schema, SUB, V.OWL_EQUIVALENT_CLASS), horst._hierarchy(schema, SUBP, V.OWL_EQUIVALENT_PROPERTY))
    keys = horst.keys_of(given)
    sole = horst.with_heads(horst.set_off(rules, keys), keys).where("sole")
    assert {r.head for r in sole.collect()} == {"http://e/one"}
    got = horst.closure_in_rounds(given)
    assert rows(got) == closed(set(facts))
    assert got.count() == len(closed(set(facts)))
