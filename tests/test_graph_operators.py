import pytest

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.operators import horst, inference, paths, patterns, stats
from kglake.plans import explore as ex
from kglake.plans.void_job import void_stats
from kglake.sinks import void as void_sink
from kglake.sources import triples as src
from kglake.sources import void as void_src
from pyspark.sql import functions as F
from tests.graphs import EX, taxonomy, write


def graph(spark, tmp_path, lines, name="g.nt"):
    return src.read_ntriples(spark, write(tmp_path / name, lines))


def nodes(df):
    return {r.node.removeprefix(EX) for r in df.collect()}


def test_walks_on_a_cycle(spark, tmp_path):
    g = graph(spark, tmp_path, taxonomy(True))
    n10 = EX + "n10"
    assert nodes(paths.property_path(g, V.RDFS_SUBCLASS, n10)) == {"n1", "n200"}
    below = {"n100", "n1000", "n10000", "n200", "n2000"}
    assert nodes(paths.property_path(g, V.RDFS_SUBCLASS, n10, paths.BACKWARD)) == below
    assert nodes(paths.property_path(g, V.RDFS_SUBPROPERTY, EX + "n30", paths.BACKWARD)) == {"n300", "n400"}
    assert len(nodes(paths.reachable_any(g, n10, paths.BACKWARD))) == 8
    assert len(nodes(paths.reachable_any(g, EX + "n10000"))) == 5
    assert nodes(paths.property_path(g, V.RDFS_SUBCLASS, n10, paths.BACKWARD, 1)) == {"n100", "n200"}
    with pytest.raises(LookupError):
        paths.property_path(g, V.RDFS_SUBPROPERTY, EX + "absent")
    assert paths.find_node(g, EX + "absent").isEmpty() and paths.find_node(g, n10).count() == 1


def test_walk_as_triples(spark, tmp_path):
    g = graph(spark, tmp_path, taxonomy(False))
    out = paths.property_path_as_triples(g, V.RDFS_SUBCLASS, EX + "n10", paths.BACKWARD).collect()
    assert len(out) == 5 and {(r.p, r.o) for r in out} == {(V.WALK_MEMBER, EX + "n10")}


def test_depth(spark, tmp_path):
    g = graph(spark, tmp_path, taxonomy(False))
    depth = {r.node.removeprefix(EX): r.depth for r in stats.class_hierarchy_depth(g).collect()}
    assert depth == {"n1": 0, "n10": 1, "n100": 2, "n200": 2, "n1000": 3, "n2000": 3, "n10000": 4}
    cyclic = graph(spark, tmp_path, taxonomy(True), "c.nt")
    depth = {r.node.removeprefix(EX): r.depth for r in stats.class_hierarchy_depth(cyclic).collect()}
    assert depth == {"n1": 0, "n10": None, "n200": None, "n100": 2, "n2000": 2, "n1000": 3, "n10000": 4}


def test_void_text(spark, tmp_path):
    lines = [f'<http://e.org/s{i}> <http://e.org/predicate> "Object {i}" .' for i in (1, 2, 3)]
    summary = void_stats(graph(spark, tmp_path, lines), "g", "1")
    turtle = void_sink.void_to_turtle(summary.dataset, summary.partition, F.lit("/data/g_v1"))
    text = turtle.first().value
    body = text.split("source=", 1)[1].replace("\n", "").replace(" ", "")
    assert body == (
        "/data/g_v1>void:classes0;void:entities4;void:distinctSubjects3;void:distinctObjects0;"
        "void:properties1;void:propertyPartition[void:property<http://e.org/predicate>;void:triples3;];"
        "void:triples3;void:vocabulary<http://e.org/>;avoid:Dataset."
    )
    path = str(tmp_path / "void")
    void_sink.write_void(turtle, path)
    texts = void_src.read_void(spark, path)
    row = void_src.void_dataset(texts).first()
    assert (row.graph, row.version, row.is_valid, row.triples, row.entities) == ("g", "1", True, 3, 4)
    part = void_src.void_partition(texts).collect()
    assert [(r.kind, r.item, r.triples) for r in part] == [("property", "http://e.org/predicate", 3)]


def test_void_of_an_empty_graph(spark):
    summary = void_stats(t.empty_triples(spark), "g", "1")
    row = summary.dataset.first()
    assert (row.graph, row.triples, row.entities, row.is_valid) == ("g", 0, 0, True)
    text = void_sink.void_to_turtle(summary.dataset, summary.partition, F.lit("/data/g_v1")).first().value
    assert "Partition" not in text and "vocabulary" not in text and "void:triples 0;" in text


def test_malformed_void_is_flagged(spark, tmp_path):
    good = "@prefix void: <http://x#> .\n<http://s/void/?source=/d/a_v1>\n\nvoid:classes 0;\na void:Dataset ."
    (tmp_path / "a").write_text(good)
    (tmp_path / "b").write_text(good.replace("a_v1", "b_v1").replace("classes 0", "classes <"))
    texts = void_src.read_void(spark, [str(tmp_path / "a"), str(tmp_path / "b")])
    assert {r.graph: r.is_valid for r in void_src.void_dataset(texts).collect()} == {"a": True, "b": False}


def test_patterns(spark, tmp_path):
    g = graph(spark, tmp_path, taxonomy(False) + [
        f'<{EX}x> <{V.RDFS_LABEL}> "Same" .', f'<{EX}y> <{V.RDFS_LABEL}> "Same" .',
        f'<{EX}z> <{V.RDFS_LABEL}> "Same"@en .', f"<{EX}x> <{EX}self> <{EX}x> .",
    ])
    by_label = [("?a", V.RDFS_LABEL, "?l"), ("?b", V.RDFS_LABEL, "?l")]
    pairs = {(r.a[-1], r.b[-1]) for r in patterns.bgp(g, by_label, ["a", "b"]).collect()}
    assert pairs == {("x", "x"), ("x", "y"), ("y", "x"), ("y", "y"), ("z", "z"), ("9", "9")}
    constant = patterns.bgp(g, [("?a", V.RDFS_LABEL, t.Literal("Same"))]).collect()
    assert {r.a[-1] for r in constant} == {"x", "y"}
    assert patterns.bgp(g, [("?a", "?p", "?a")]).collect() == [(EX + "x", EX + "self")]
    assert {r.sibling for r in patterns.siblings(g, V.RDFS_SUBCLASS, EX + "n100").collect()} == {
        EX + "n100", EX + "n200"}
    with pytest.raises(ValueError):
        patterns.bgp(g, [("?a", V.RDFS_LABEL, "?l"), ("?c", V.RDFS_SUBCLASS, "?d")])


def test_exploration(spark, tmp_path):
    taxon, mesh, chem = "http://t/", "http://m/", "http://c/"
    taxonomy_graph = graph(spark, tmp_path, [
        f"<{taxon}child> <{V.RDFS_SUBCLASS}> <{taxon}top> .", f"<{taxon}leaf> <{V.RDFS_SUBCLASS}> <{taxon}child> .",
        f'<{taxon}child> <{V.RDFS_LABEL}> "Child" .', f'<{taxon}leaf> <{V.RDFS_LABEL}> "Leaf" .',
    ], "tax.nt")
    others = graph(spark, tmp_path, [
        f'<{mesh}D1> <{V.RDFS_LABEL}> "Child" .', f'<{mesh}D2> <{V.RDFS_LABEL}> "Leaf" .',
        f"<{mesh}D1> <{V.RDF_TYPE}> <{ex.MESHV}TopicalDescriptor> .",
        f"<{mesh}D2> <{V.RDF_TYPE}> <{ex.MESHV}TopicalDescriptor> .",
        f"<{chem}r1> <{ex.SUBJECT_TERMS[0]}> <{mesh}D2> .", f"<{chem}r1> <{ex.SUBJECT_TERMS[1]}> <{mesh}D1> .",
        f'<{chem}r1> <{ex.DCT_TITLE}> "An article" .',
        f"<{chem}s1> <{ex.CITO}isDiscussedBy> <{chem}r1> .", f"<{chem}s1> <{ex.SIO}CHEMINF_000477> <{chem}CID1> .",
    ], "oth.nt")
    articles = ex.explore(taxonomy_graph, others, taxon + "top")
    assert {tuple(r) for r in articles.collect()} == {
        (chem + "r1", "An article", chem + "CID1", taxon + "leaf"),
        (chem + "r1", "An article", chem + "CID1", taxon + "child"),
    }
    assert [r.s for r in ex.compounds(articles, taxon + "child").collect()] == [chem + "CID1"]
    with pytest.raises(ValueError):
        ex.explore(taxonomy_graph, others, taxon + "top", minimum=3)


def test_components(spark):
    edges = [("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("y", "x"), ("q", "q")]
    edges += [(f"h{i:03d}", "h000") for i in range(1, 50)]
    df = spark.createDataFrame(edges, "src string, dst string")
    reps = {r.node: r.representative for r in inference.connected_components(df).collect()}
    assert {k: v for k, v in reps.items() if k[0] != "h"} == {"b": "a", "c": "a", "d": "a", "e": "a", "y": "x"}
    assert len([k for k in reps if k[0] == "h"]) == 49 and {v for k, v in reps.items() if k[0] == "h"} == {"h000"}


def test_closure_of_a_chain(spark):
    df = spark.createDataFrame([(f"{i:02d}", f"{i + 1:02d}") for i in range(12)], "src string, dst string")
    assert inference.transitive_closure(df).count() == 12 * 13 // 2


def iri(x):
    return f"<{EX}{x}>"


def test_horst_rules(spark, tmp_path):
    a = f"<{V.RDF_TYPE}>"
    facts = [
        f"{iri('P')} {a} <{V.OWL_TRANSITIVE}> .", f"{iri('S')} {a} <{V.OWL_SYMMETRIC}> .",
        f"{iri('F')} {a} <{V.OWL_FUNCTIONAL}> .", f"{iri('I')} <{V.OWL_INVERSE_OF}> {iri('J')} .",
        f"{iri('x')} {iri('P')} {iri('y')} .", f"{iri('y')} {iri('P')} {iri('z')} .",
        f"{iri('x')} {iri('S')} {iri('y')} .", f"{iri('x')} {iri('I')} {iri('z')} .",
        f"{iri('x')} {iri('F')} {iri('v1')} .", f"{iri('x')} {iri('F')} {iri('v2')} .",
        f'{iri("v2")} {iri("name")} "two" .',
        f"{iri('C')} <{V.OWL_EQUIVALENT_CLASS}> {iri('D')} .", f"{iri('x')} {a} {iri('C')} .",
        f"{iri('R1')} <{V.OWL_ON_PROPERTY}> {iri('name')} .", f'{iri("R1")} <{V.OWL_HAS_VALUE}> "two" .',
        f"{iri('R2')} <{V.OWL_ON_PROPERTY}> {iri('P')} .", f"{iri('R2')} <{V.OWL_SOME_VALUES}> {iri('E')} .",
        f"{iri('z')} {a} {iri('E')} .",
        f"{iri('R3')} <{V.OWL_ON_PROPERTY}> {iri('S')} .", f"{iri('R3')} <{V.OWL_ALL_VALUES}> {iri('G')} .",
        f"{iri('x')} {a} {iri('R3')} .",
        f"{iri('R1')} <{V.RDFS_SUBCLASS}> {iri('Named')} .",
    ]
    closed = horst.owl_horst_closure(graph(spark, tmp_path, facts))
    got = {(r.s.removeprefix(EX), r.p.removeprefix(EX), r.o.removeprefix(EX)) for r in closed.collect()}
    type_ = V.RDF_TYPE
    expected = {
        ("x", "P", "z"), ("y", "S", "x"), ("z", "J", "x"), ("v2", V.OWL_SAME_AS, "v1"), ("v1", "name", "two"),
        ("x", type_, "D"), ("D", V.RDFS_SUBCLASS, "C"), ("v1", type_, "R1"), ("v1", type_, "Named"),
        ("x", type_, "R2"), ("y", type_, "R2"), ("y", type_, "G"),
    }
    assert expected <= got
    assert ("v2", "name", "two") not in got and ("x", "F", "v2") not in got


def test_rdfs_closure_with_extended_schema(spark, tmp_path):
    facts = [
        f"{iri('kindOf')} <{V.RDFS_SUBPROPERTY}> <{V.RDFS_SUBCLASS}> .",
        f"{iri('Cat')} {iri('kindOf')} {iri('Animal')} .", f"{iri('tom')} <{V.RDF_TYPE}> {iri('Cat')} .",
        f"{iri('owns')} <{V.RDFS_RANGE}> {iri('Thing')} .", f"{iri('owns')} <{V.RDFS_DOMAIN}> {iri('Person')} .",
        f"{iri('ann')} {iri('owns')} {iri('tom')} .", f'{iri("ann")} {iri("owns")} "text" .',
    ]
    closed = inference.rdfs_closure(graph(spark, tmp_path, facts))
    got = {(r.s.removeprefix(EX), r.p, r.o.removeprefix(EX)) for r in closed.collect()}
    for row in [("tom", "Animal"), ("tom", "Thing"), ("ann", "Person")]:
        assert (row[0], V.RDF_TYPE, row[1]) in got
    assert ("text", V.RDF_TYPE, "Thing") not in got and ("Cat", V.RDFS_SUBCLASS, "Animal") in got


def test_patterns_matched_in_one_scan(spark, tmp_path):
    """Stored matches give what separate scans give; the graph is read once for all patterns, small sides cut large ones."""
    facts = [f"{iri(f's{k}')} {iri('p')} {iri(f's{k % 7}')} ." for k in range(40)]
    facts += [f'{iri(f"s{k}")} <{V.RDFS_LABEL}> "label {k % 5}" .' for k in range(40)] + [f"{iri('s3')} {iri('q')} {iri('s4')} ."] * 2
    facts += [f"{iri('s4')} {iri('p')} {iri('s4')} .", f'{iri("s4")} {iri("q")} "text" .']
    g = graph(spark, tmp_path, facts)
    p, q = EX + "p", EX + "q"
    queries = [
        [("?a", p, "?b"), ("?c", q, "?b")], [("?a", p, "?b"), ("?b", V.RDFS_LABEL, "?l"), ("?c", V.RDFS_LABEL, "?l"), ("?c", q, "?d")],
        [("?a", q, "?x"), ("?a", p, "?b"), ("?b", p, "?b")], [("?a", p, EX + "s1"), ("?a", V.RDFS_LABEL, t.Literal("label 1"))],
        [("?a", "?r", "?b"), ("?b", q, "?c")], [(EX + "s3", q, "?b"), ("?b", p, "?c")],
    ]
    matches = patterns.match_all(g, [x for query in queries for x in query])
    for query in queries:
        for distinct in (True, False):
            got = patterns.bgp(matches, query, distinct=distinct).collect()
            assert sorted(map(tuple, got)) == sorted(map(tuple, patterns.bgp(g, query, distinct=distinct).collect()))
    from kglake.plans import storage

    stored = storage.materialize(g)
    wanted = [x for query in queries for x in query]
    assert patterns._tagged(stored, wanted)._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert matches.counts[("?c", q, "?b")] == 3
    assert patterns._join_order([("?a", p, "?b"), ("?c", q, "?b")], matches.counts)[0] == ("?c", q, "?b")
    plan = patterns.bgp(matches, queries[2])._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan


def test_effects_of_unused_properties_are_not_stored(spark, monkeypatch):
    """Properties that no triple has stay out of the table that facts are joined with."""
    from kglake.functions import terms as t
    from kglake.functions import vocab as V
    from kglake.operators import inference

    stored = {}
    keep = inference.storage.materialize
    monkeypatch.setattr(inference.storage, "materialize", lambda df, folder=None, name="table": stored.setdefault(name, keep(df, folder, name)))
    rows = [(f"http://e/p{k}", V.RDFS_DOMAIN, "http://e/C") for k in range(50)] + [("http://e/x", "http://e/p7", "http://e/y")]
    facts = spark.createDataFrame(rows, "s string, p string, o string")
    inference._rdfs_round(t.resource_triples(facts, "s", "p", "o"), t.resource_triples(facts.where(f"p = '{V.RDFS_DOMAIN}'"), "s", "p", "o"),
                          inference.storage.shared_folder(spark)).count()
    assert [r.predicate for r in stored["effects"].collect()] == ["http://e/p7"]


def test_a_walk_scans_its_edges_instead_of_shuffling_them(spark, monkeypatch):
    iris = [("a", "b"), ("a", "b"), ("c", "b"), ("d", "c"), ("b", "d"), ("e", "f")]
    rows = [(EX + s, t.IRI, EX + "p", EX + o, t.IRI, None, None) for s, o in iris]
    rows += [(EX + s, t.IRI, EX + "q", "one", t.LITERAL, V.XSD_STRING, None) for s in ("d", "g")]
    graph = spark.createDataFrame(rows, t.TRIPLE_SCHEMA)
    stored, materialize = {}, paths.storage.materialize

    def watched(frame, folder, name):
        stored[name] = (frame._jdf.queryExecution().executedPlan().toString(), frame.count())
        return materialize(frame, folder, name)

    monkeypatch.setattr(paths.storage, "materialize", watched)
    for first in (1, 1000):  # with and without the filter
        monkeypatch.setattr(paths, "FILTER_FROM", first)
        back = {(r.node[len(EX):], r.hops) for r in paths.reachable_any(graph, EX + "b", paths.BACKWARD).collect()}
        assert back == {("a", 1), ("c", 1), ("d", 2)}
        assert "Exchange" not in stored["edges"][0] and stored["edges"][1] == 6  # as given, without literals
    back = {(r.node[len(EX):], r.hops) for r in paths.reachable_any(graph, '"one"', paths.BACKWARD, 2).collect()}
    assert back == {("d", 1), ("g", 1), ("b", 2)}
    assert paths.reachable_any(graph, EX + "g", paths.BACKWARD).isEmpty()
    ahead = {(r.node, r.hops) for r in paths.reachable_any(graph, EX + "c", paths.FORWARD).collect()}
    assert ahead == {(EX + "b", 1), (EX + "d", 2), ('"one"', 3)}


def test_restrictions_shuffle_instances_of_their_classes_only(spark, tmp_path):
    """Instances of every class went to the joins: rows that compress well and fill one task."""
    from kglake.functions import terms as t
    from kglake.functions import vocab as V
    from kglake.operators import inference

    e = "http://e/"
    facts = [("R1", V.OWL_ON_PROPERTY, "p"), ("R1", V.OWL_SOME_VALUES, "C"), ("R2", V.OWL_ON_PROPERTY, "p"), ("R2", V.OWL_ALL_VALUES, "D"),
             ("c", V.RDF_TYPE, "C"), ("x", V.RDF_TYPE, "X"), ("r", V.RDF_TYPE, "R2"), ("a", e + "p", "c"), ("b", e + "p", "x"), ("r", e + "p", "x")]
    rows = [(e + s, "iri", p, e + o, "iri", None, None) for s, p, o in facts]
    spark.createDataFrame(rows, t.TRIPLE_SCHEMA).write.parquet(str(tmp_path / "g"))
    found = inference.restriction_triples(spark.read.parquet(str(tmp_path / "g")))
    assert {(r.s, r.p, r.o) for r in found.collect()} == {(e + "a", V.RDF_TYPE, e + "R1"), (e + "x", V.RDF_TYPE, e + "D")}
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LeftSemi") == 4
