import random

import pytest
from pyspark.sql import functions as F

from kglake.operators import reachability as rc


def closure(edges):
    """Every pair joined by a path."""
    ahead = {}
    for a, b in edges:
        ahead.setdefault(a, set()).add(b)
    out = set()
    for a in ahead:
        todo, seen = list(ahead[a]), set()
        while todo:
            b = todo.pop()
            if b not in seen:
                seen.add(b)
                todo += ahead.get(b, ())
        out |= {(a, b) for b in seen}
    return out


def frame(spark, edges):
    return spark.createDataFrame(sorted(edges), "src string, dst string").repartition(3)


def random_edges(seed, nodes, count, forward):
    r = random.Random(seed)
    names = [f"n{k:02d}" for k in range(nodes)]
    edges = set()
    while len(edges) < count:
        a, b = r.randrange(nodes), r.randrange(nodes)
        if forward:
            a, b = min(a, b), max(a, b)
        if a != b or not forward:
            edges.add((names[a], names[b]))
    return edges


GRAPHS = {
    "cycles": {("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "d"), ("f", "a"), ("e", "g"), ("h", "h"), ("h", "f"), ("g", "i")},
    "acyclic": random_edges(1, 25, 60, True),
    "cyclic": random_edges(2, 25, 34, False),
}


@pytest.mark.parametrize("name", GRAPHS)
def test_labels_answer_what_pairs_would(spark, name):
    edges = GRAPHS[name]
    index = rc.build(frame(spark, edges))
    nodes = sorted({x for e in edges for x in e})
    want = closure(edges)
    found = [tuple(r) for r in index.targets(spark.createDataFrame([(n,) for n in nodes], "node string")).collect()]
    assert set(found) == want and len(found) == len(want)
    pairs = spark.createDataFrame([(a, b) for a in nodes for b in nodes], "src string, dst string").withColumn("kept", F.lit(1))
    assert {(r.src, r.dst) for r in index.leads_to(pairs).collect()} == want
    # A few rows per node, not one per pair.
    assert index.numbers.count() == len(nodes)


def test_a_chain_needs_no_pairs(spark):
    edges = {(f"n{k:03d}", f"n{k + 1:03d}") for k in range(40)}
    index = rc.build(frame(spark, edges))
    assert index.blocks.count() < 41 * 2 * index.lengths
    assert index.targets(spark.createDataFrame([("n000",), ("n040",), ("no",)], "node string")).count() == 40


def test_components(spark):
    got = {r.node: r.component for r in rc.strong_components(frame(spark, GRAPHS["cycles"])).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "d": "d", "e": "d", "h": "h"}
    for name in ("acyclic", "cyclic"):
        pairs = closure(GRAPHS[name])
        want = {a: min(b for b in (x for e in GRAPHS[name] for x in e) if (a, b) in pairs and (b, a) in pairs)
                for a in {x for e in GRAPHS[name] for x in e} if (a, a) in pairs}
        assert {r.node: r.component for r in rc.strong_components(frame(spark, GRAPHS[name])).collect()} == want


def test_no_edges(spark):
    index = rc.build(frame(spark, {("a", "b")}).where("false"))
    assert index.targets(spark.createDataFrame([("a",)], "node string")).count() == 0


def test_closure_takes_sources_off_before_it_labels(spark, monkeypatch):
    """A star of chains with two properties, repeats, a source of several targets, and a cycle that sources lead to."""
    edges = {("p", f"leaf{k}", f"mid{k % 3}") for k in range(30)} | {("p", f"mid{k}", "top") for k in range(3)}
    edges |= {("p", "leaf0", "mid1"), ("p", "leaf0", "top"), ("q", "top", "leaf0"), ("q", "leaf0", "q0")}
    cycles = edges | {("p", "top", "c"), ("p", "c", "d"), ("p", "d", "c"), ("p", "rim", "c"), ("p", "rim2", "d"), ("p", "d", "e")}
    labelled, build = [], rc.build

    def watched(rows):
        labelled.append(rows.count())
        return build(rows)

    monkeypatch.setattr(rc, "build", watched)
    for rows in (edges, cycles):
        given = spark.createDataFrame(sorted(rows) * 2, "p string, src string, dst string").repartition(3)
        got = [tuple(r) for r in rc.closure(given).collect()]
        want = {(p, a, b) for p in "pq" for a, b in closure({(s, o) for q, s, o in rows if q == p})}
        assert set(got) == want and len(got) == len(want)
    assert labelled[0] == 0 and labelled[1] <= 6
