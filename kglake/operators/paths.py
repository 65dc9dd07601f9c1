"""Reachability and depth, as loops of joins over an edge table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.operators import reachability
from kglake.plans import storage
from kglake.sinks.triples import walk_as_triples

FORWARD, BACKWARD = "forward", "backward"
# A walk's frontier of at least so many nodes filters the edges before they are shuffled, by so many bits.
FILTER_FROM, FILTER_BITS = 50_000, 1 << 26


class NodeNotFound(LookupError):
    """The start node has no edge in the searched graph."""


def _edge_rows(triples: DataFrame, predicate: str | None) -> DataFrame:
    """`(src, dst, to_literal)` of each triple; a literal end is written as an N-Triples term, so it equals no resource."""
    rows = triples if predicate is None else triples.where(t.predicate_matches(predicate))
    return rows.select(F.col("s").alias("src"), t.term_to_string().alias("dst"), t.is_literal("o").alias("to_literal"))


def edges_of(triples: DataFrame, predicate: str | None = None) -> DataFrame:
    """Distinct `(src, dst)`."""
    return _edge_rows(triples, predicate).select("src", "dst").distinct()


def find_node(triples: DataFrame, iri: str) -> DataFrame:
    """One row with the IRI if it is a subject or object, none otherwise."""
    here = (t.is_iri("s") & (F.col("s") == iri)) | t.object_matches(iri)
    return triples.where(here).select(F.lit(iri).alias("node")).limit(1)


def _touched(steps: DataFrame, frontier: DataFrame) -> DataFrame:
    """The steps that may start in the frontier, and some others: those whose bit of `FILTER_BITS` is set by one of its nodes.

    The set bits are broadcast as words of 64, at most `FILTER_BITS` / 64 rows, whatever the frontier. Steps are scanned and not
    shuffled; what passes is joined exactly.
    """
    def bit(node: str) -> Column:
        return F.pmod(F.xxhash64(node), F.lit(FILTER_BITS))

    words = frontier.select(bit("node").alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("bits"))
    numbered = steps.withColumn("bit", bit("near")).withColumn("word", F.expr("bit div 64"))
    return numbered.join(F.broadcast(words), "word").where("getbit(bits, cast(bit % 64 as int)) = 1").select("near", "far")


def _walk(edges: DataFrame, start: str, direction: str, max_iterations: int | None) -> DataFrame:
    """`(node, hops)` of the nodes reached from `start`, which is itself left out.

    Each hop is one job: the last hop's new nodes join the edges, and what earlier hops
    found is taken away. Every hop is a small table on shared storage with exact
    size statistics, so the join broadcasts the frontier only while it is under the
    session's threshold and shuffles, with skew handling, beyond it. A large frontier first leaves out the edges it does
    not touch. Repeated edges do no harm, as a hop's nodes are made a set.
    """
    if direction not in (FORWARD, BACKWARD):
        raise ValueError(f"direction is {FORWARD} or {BACKWARD}, not {direction}")
    spark = edges.sparkSession
    folder = storage.shared_folder(spark)
    near, far = ("src", "dst") if direction == FORWARD else ("dst", "src")
    # No edge leads to a literal's node but that of a walk which starts there.
    walked = edges if direction == FORWARD else edges.where(~F.col("to_literal") | (F.col("dst") == start))
    steps = storage.materialize(
        walked.select(F.col(near).alias("near"), F.col(far).alias("far")), folder, "edges"
    )
    if steps.where((F.col("near") == start) | (F.col("far") == start)).isEmpty() and edges.where(
            (F.col("src") == start) | (F.col("dst") == start)).isEmpty():
        raise NodeNotFound(f"no edge touches {start}")
    first = spark.range(1).select(F.lit(start).alias("node"), F.lit(0).alias("hops"))
    frontier = storage.materialize(first, folder, "hop-0")
    paths, hop, size = [f"{folder}/hop-0"], 0, 1
    while max_iterations is None or hop < max_iterations:
        hop += 1
        touched = _touched(steps, frontier) if FILTER_FROM <= size <= FILTER_BITS else steps
        reached = frontier.join(touched, frontier.node == touched.near).select(F.col("far").alias("node")).distinct()
        seen = storage.read_tables(frontier, paths)
        new = reached.join(seen, "node", "left_anti").select("node", F.lit(hop).alias("hops"))
        frontier = storage.materialize(new, folder, f"hop-{hop}")
        size = frontier.count()
        if not size:
            break
        paths.append(f"{folder}/hop-{hop}")
    return storage.read_tables(frontier, paths).where(F.col("hops") > 0)


def property_path(triples: DataFrame, predicate: str, start: str, direction: str = FORWARD,
                  max_iterations: int | None = None) -> DataFrame:
    """Nodes reached over one predicate: ancestors forward, descendants backward.

    All of them, or, where `max_iterations` is given, those within that many hops.
    """
    return _walk(_edge_rows(triples, predicate), start, direction, max_iterations)


def property_path_as_triples(triples: DataFrame, predicate: str, start: str, direction: str = FORWARD,
                             max_iterations: int | None = None) -> DataFrame:
    return walk_as_triples(property_path(triples, predicate, start, direction, max_iterations), start)


def reachable_any(triples: DataFrame, start: str, direction: str = FORWARD,
                  max_iterations: int | None = None) -> DataFrame:
    """As `property_path`, over the edges of all predicates."""
    return _walk(_edge_rows(triples, None), start, direction, max_iterations)


def require_at_least(nodes: DataFrame, minimum: int) -> DataFrame:
    """`nodes`, or an error when there are fewer than `minimum`."""
    found = nodes.limit(minimum).count()
    if found < minimum:
        raise ValueError(f"found {found} nodes, expected at least {minimum}")
    return nodes


def hierarchy_depth(triples: DataFrame, predicate: str) -> DataFrame:
    """`(node, depth)`: most edges from a root, for child-to-parent triples; null for the nodes on cycles.

    A cycle counts as one node, so what lies below it has a depth. Cycles are only looked for in
    what a walk from the roots down cannot settle.
    """
    folder = storage.shared_folder(triples.sparkSession)
    edges = storage.materialize(edges_of(triples, predicate), folder, "edges")
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    settled = storage.materialize(reachability.layers(edges, f"{folder}/settling"), folder, "settled")
    # Whatever is on a cycle, or below one, waits for a node that waits.
    waiting = storage.materialize(edges.join(settled.withColumnRenamed("node", "dst"), "dst", "left_anti"), folder, "waiting")
    if not waiting.isEmpty():
        components = storage.materialize(reachability.strong_components(waiting, f"{folder}/strong"), folder, "components")
        inner = storage.materialize(reachability.condensed(edges, components), folder, "condensed")
        settled = reachability.layers(inner, f"{folder}/condensed-settling").join(components, "node", "left_anti")
        # A node whose only edge is a loop is in no edge between components.
        nodes = nodes.join(components.select("node", F.lit(True).alias("cyclic")), "node", "left")
        depth = nodes.join(settled, "node", "left")
        return depth.select("node", F.when(F.col("cyclic").isNull(), F.coalesce("layer", F.lit(0))).alias("depth"))
    return nodes.join(settled.withColumnRenamed("layer", "depth"), "node", "left")
