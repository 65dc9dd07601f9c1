"""Reachability in directed graphs without storing pairs: strong components, layers, and interval labels.

The edges' strong components are condensed to a graph without cycles. There each node has the interval of numbers
that a spanning forest's subtree takes, and the intervals that other edges add (tree cover labels; Agrawal, Borgida and
Jagadish, 1989). `x` leads to `y` exactly if the number of `x` lies in an interval of `y`, so the labels answer what the pairs of the
transitive closure would, with a few rows per node. For joins an interval is cut into aligned blocks, at most two of
each length, and a number lies in one block of each length: the range test is a join on equal keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kglake.plans import storage

# Children of one node are numbered by this many tasks, so a node with very many is no bottleneck.
SHARDS = 64


def _spread(edges: DataFrame, values: DataFrame, keep) -> DataFrame:
    """`node, value`: each value handed over its edges (`src` to `dst`), the least per node."""
    return edges.join(values.withColumnRenamed("node", "src"), "src").where(keep).groupBy(F.col("dst").alias("node")).agg(
        F.min("value").alias("value"))


def strong_components(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """`node, component` of the nodes on cycles of `edges` (`src, dst`): the least node of their strong component.

    Nodes without an edge in or out are trimmed, for they are on no cycle. Then colours run forward: each node takes the least node
    that leads to it. Within a colour, what leads back to that least node is its component (Orzan, 2004). Both loops only
    move what changed in the last round; found components leave the graph.
    """
    folder = folder or storage.shared_folder(edges.sparkSession)
    turn, found = 0, []

    def keep(frame: DataFrame, name: str) -> DataFrame:
        return storage.materialize(frame, f"{folder}/{turn}", name)

    loops = keep(edges.where("src = dst").select(F.col("src").alias("node"), F.col("src").alias("component")).distinct(), "loops")
    live = keep(edges.where("src <> dst").select("src", "dst").distinct(), "edges")
    left = live.count()
    while left:
        turn += 1
        for step in range(left):
            both = live.select(F.col("src").alias("node")).intersect(live.select(F.col("dst").alias("node")))
            ends = [both.withColumnRenamed("node", c) for c in ("src", "dst")]
            live = keep(live.join(ends[0], "src", "left_semi").join(ends[1], "dst", "left_semi").select("src", "dst"), f"trimmed-{step}")
            before, left = left, live.count()
            if left == before:
                break
        if not left:
            break
        colours = keep(live.select(F.col("src").alias("node")).distinct().withColumn("value", F.col("node")), "colours-0")
        moved, step = colours, 0
        while not moved.isEmpty():
            step += 1
            handed = _spread(live, moved, F.lit(True)).withColumnRenamed("value", "offer")
            merged = keep(colours.join(handed, "node", "left").select(
                "node", F.least("value", "offer").alias("value"), F.coalesce(F.col("offer") < F.col("value"), F.lit(False)).alias("moved")),
                f"colours-{step}")
            colours, moved = merged.select("node", "value"), merged.where("moved").select("node", "value")
        one = colours.select(F.col("node").alias("src"), F.col("value").alias("src_colour"))
        other = colours.select(F.col("node").alias("dst"), F.col("value").alias("dst_colour"))
        within = keep(live.join(one, "src").join(other, "dst").where("src_colour = dst_colour").select(
            F.col("dst").alias("src"), F.col("src").alias("dst")), "within")
        front = keep(colours.where("node = value"), "back-0")
        back, step = [front], 0
        while True:
            step += 1
            reached = _spread(within, front, F.lit(True))
            for frame in back:
                reached = reached.join(frame.select("node"), "node", "left_anti")
            front = keep(reached, f"back-{step}")
            if front.isEmpty():
                break
            back.append(front)
        component = back[0]
        for frame in back[1:]:
            component = component.unionByName(frame)
        component = keep(component.select("node", F.col("value").alias("component")), "components")
        several = component.groupBy("component").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("component")
        found.append(keep(component.join(several, "component", "left_semi").select("node", "component"), "found"))
        gone = component.select("node")
        live = keep(live.join(gone.withColumnRenamed("node", "src"), "src", "left_anti").join(
            gone.withColumnRenamed("node", "dst"), "dst", "left_anti").select("src", "dst"), "rest")
        left = live.count()
    result = loops
    for frame in found:
        result = result.join(frame.select("node"), "node", "left_anti").unionByName(frame)
    return result


def condensed(edges: DataFrame, components: DataFrame) -> DataFrame:
    """`edges` between components: each node on a cycle replaced by its component, without loops."""
    def of(column: str) -> DataFrame:
        return components.select(F.col("node").alias(column), F.col("component").alias(f"{column}_component"))

    rows = edges.select("src", "dst").join(of("src"), "src", "left").join(of("dst"), "dst", "left")
    return rows.select(F.coalesce("src_component", "src").alias("src"), F.coalesce("dst_component", "dst").alias("dst")).where(
        "src <> dst").distinct()


def layers(edges: DataFrame, folder: str | None = None) -> DataFrame:
    """`node, layer`: most edges (`src` to `dst`) from the node to one without any, for stored edges without cycles.

    Round r settles the nodes whose targets are all settled, the last of them in round r - 1. Each node settles
    once, so an edge is used once over the whole loop.
    """
    folder = folder or storage.shared_folder(edges.sparkSession)
    nodes = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct()
    open_ends = storage.materialize(edges.groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("waits")), folder, "waits")
    first = nodes.join(open_ends, "node", "left_anti").select("node", F.lit(0).alias("layer"))
    settled = storage.materialize(first, folder, "layer-0")
    paths, uses, layer = [f"{folder}/layer-0"], [], 0
    while not settled.isEmpty():
        layer += 1
        touched = settled.join(edges, settled.node == edges.dst).groupBy(F.col("src").alias("node")).agg(F.count(F.lit(1)).alias("uses"))
        touched = storage.materialize(touched, folder, f"uses-{layer}")
        uses.append(f"{folder}/uses-{layer}")
        total = storage.read_tables(touched, uses).join(touched.select("node"), "node", "left_semi").groupBy("node").agg(
            F.sum("uses").alias("uses"))
        ready = total.join(open_ends, "node").where("uses = waits").select("node", F.lit(layer).alias("layer"))
        settled = storage.materialize(ready, folder, f"layer-{layer}")
        paths.append(f"{folder}/layer-{layer}")
    return storage.read_tables(settled, paths)


@dataclass
class Index:
    """Labels of a graph: `numbers` has `node, component, number, cyclic`, `blocks` has `component, length, block`."""

    numbers: DataFrame
    blocks: DataFrame
    lengths: int

    def targets(self, nodes: DataFrame) -> DataFrame:
        """`src, dst`: what each of `nodes` (`node`) leads to over one edge or more. Nothing of it is stored."""
        start = nodes.select("node").distinct().join(self.numbers, "node")
        keyed = start.select(F.col("node").alias("src"), F.col("component").alias("own"), "cyclic", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(self.lengths - 1)), lambda k: F.call_function("shiftright", F.col("number"), k))).alias("length", "block"))
        met = keyed.join(self.blocks, ["length", "block"]).where("component <> own or cyclic").select("src", "component")
        return met.join(self.numbers.select("component", F.col("node").alias("dst")), "component").select("src", "dst")

    def leads_to(self, pairs: DataFrame) -> DataFrame:
        """Those rows of `pairs` (`src, dst`, other columns stay) where the one leads to the other."""
        numbers = self.numbers
        one = numbers.select(F.col("node").alias("src"), F.col("component").alias("_own"), "cyclic", "number")
        other = numbers.select(F.col("node").alias("dst"), "component")
        keyed = pairs.join(one, "src").join(other, "dst").select("*", F.posexplode(F.transform(
            F.sequence(F.lit(0), F.lit(self.lengths - 1)), lambda k: F.call_function("shiftright", F.col("number"), k))).alias("length", "block"))
        inside = keyed.where("component <> _own or cyclic").join(self.blocks, ["component", "length", "block"], "left_semi")
        return inside.select(*pairs.columns)


def _blocks(low: Column, high: Column, lengths: int) -> Column:
    """Aligned blocks `(length, block)` that make up the numbers from `low` to `high`: those of length k hold 2 ** k numbers."""
    def of(k: Column) -> Column:
        one = F.call_function("shiftleft", F.lit(1).cast("long"), k)
        a = F.call_function("shiftright", low + one - 1, k)  # rounded up
        b = F.call_function("shiftright", high + 1, k)
        odd_a, odd_b = a.bitwiseAND(F.lit(1)) == 1, b.bitwiseAND(F.lit(1)) == 1
        cut = [F.when((a < b) & odd_a, F.struct(k.alias("length"), a.alias("block"))),
               F.when((a < b) & odd_b, F.struct(k.alias("length"), (b - 1).alias("block")))]
        return F.filter(F.array(*cut), lambda x: x.isNotNull())

    return F.flatten(F.transform(F.sequence(F.lit(0), F.lit(lengths - 1)), of))


def _numbered(tree: DataFrame, sizes: DataFrame, keep) -> DataFrame:
    """`node, low`: the first number of each subtree; `tree` has `node, parent` (null for roots), `sizes` has `node, size`."""
    # Siblings stand one after the other: within shards, then shard by shard.
    rows = keep(tree.join(sizes, "node").withColumn("shard", F.pmod(F.xxhash64("node"), F.lit(SHARDS))), "siblings")
    earlier = W.unboundedPreceding, -1
    shards = rows.groupBy("parent", "shard").agg(F.sum("size").alias("total")).withColumn(
        "ahead", F.coalesce(F.sum("total").over(W.partitionBy("parent").orderBy("shard").rowsBetween(*earlier)), F.lit(0)))
    inside = F.coalesce(F.sum("size").over(W.partitionBy("parent", "shard").orderBy("node").rowsBetween(*earlier)), F.lit(0))
    placed = rows.withColumn("inside", inside).join(
        shards.select(F.col("parent").alias("p"), F.col("shard").alias("q"), "ahead"),
        F.col("parent").eqNullSafe(F.col("p")) & (F.col("shard") == F.col("q")))
    # A node's first number is the sum of its own and its ancestors' offsets: sums double their reach each round.
    jumps = keep(placed.select("node", F.col("parent").alias("up"), (F.col("ahead") + F.col("inside") + F.when(
        F.col("parent").isNull(), 0).otherwise(1)).alias("low")), "jumps-0")
    step = 0
    while not jumps.where("up is not null").isEmpty():
        step += 1
        above = jumps.select(F.col("node").alias("up"), F.col("up").alias("next"), F.col("low").alias("more"))
        jumps = keep(jumps.join(above, "up", "left").select(
            "node", F.col("next").alias("up"), (F.col("low") + F.coalesce("more", F.lit(0))).alias("low")), f"jumps-{step}")
    return jumps.select("node", "low")


def build(edges: DataFrame) -> Index:
    """The index of `edges` (`src, dst`, strings): one loop round per layer of the condensed graph, twice.

    A node's own interval is that of its subtree in a forest where each node hangs below its least target; intervals that come by other
    edges are kept where none of the node's holds them.
    """
    folder = storage.shared_folder(edges.sparkSession)

    def keep(frame: DataFrame, name: str) -> DataFrame:
        return storage.materialize(frame, folder, name)

    edges = keep(edges.select("src", "dst").distinct(), "edges")
    components = keep(strong_components(edges, f"{folder}/strong"), "components")
    dag = keep(condensed(edges, components), "condensed")
    every = edges.select(F.explode(F.array("src", "dst")).alias("node")).distinct().join(components, "node", "left").select(
        "node", F.coalesce("component", "node").alias("component"), F.col("component").isNotNull().alias("cyclic"))
    every = keep(every, "nodes")
    # From sources up: a node's layer is above those of all that lead to it.
    up = dag.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    layer = keep(layers(keep(up, "reversed"), f"{folder}/settling"), "layers")
    names = every.select(F.col("component").alias("node")).distinct()
    tree = keep(names.join(dag.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("parent")), "node", "left"), "tree")
    last = layer.agg(F.max("layer")).first()[0] or 0
    sizes = keep(names.join(layer.where("layer > 0"), "node", "left_anti").select("node", F.lit(1).cast("long").alias("size")), "sizes-0")
    sized = [f"{folder}/sizes-0"]
    for k in range(1, last + 1):
        here = layer.where(F.col("layer") == k).select("node")
        below = tree.join(here.withColumnRenamed("node", "parent"), "parent", "left_semi").join(
            storage.read_tables(sizes, sized), "node").groupBy(F.col("parent").alias("node")).agg(F.sum("size").alias("size"))
        keep(here.join(below, "node", "left").select("node", (F.coalesce("size", F.lit(0)) + 1).alias("size")), f"sizes-{k}")
        sized.append(f"{folder}/sizes-{k}")
    sizes = storage.read_tables(sizes, sized)
    low = _numbered(tree, sizes, keep)
    own = keep(low.join(sizes, "node").select("node", "low", (F.col("low") + F.col("size") - 1).alias("high")), "own")
    others = keep(dag.join(tree.select(F.col("node").alias("src"), F.col("parent").alias("tree")), "src").select(
        "src", "dst", (F.col("dst") == F.col("tree")).alias("in_tree")), "others")
    extra = keep(own.limit(0), "extra-0")
    extras = [f"{folder}/extra-0"]
    for k in range(1, last + 1):
        here = layer.where(F.col("layer") == k).select(F.col("node").alias("dst"))
        into = others.join(here, "dst", "left_semi")
        handed = into.where("not in_tree").join(own.withColumnRenamed("node", "src"), "src").select("dst", "low", "high").unionByName(
            into.join(storage.read_tables(extra, extras).withColumnRenamed("node", "src"), "src").select("dst", "low", "high"))
        outside = handed.distinct().join(own.select(F.col("node").alias("dst"), F.col("low").alias("a"), F.col("high").alias("b")), "dst").where(
            "low < a or high > b").select(F.col("dst").alias("node"), "low", "high")
        # Of intervals that start no earlier, one that ends no later is held by another.
        before = W.partitionBy("node").orderBy("low", F.desc("high")).rowsBetween(W.unboundedPreceding, -1)
        kept = outside.withColumn("reach", F.max("high").over(before)).where("reach is null or high > reach").drop("reach")
        keep(kept, f"extra-{k}")
        extras.append(f"{folder}/extra-{k}")
    total = own.count()
    lengths = max(1, total.bit_length())
    intervals = own.unionByName(storage.read_tables(extra, extras))
    blocks = intervals.select(F.col("node").alias("component"), F.explode(_blocks(F.col("low"), F.col("high"), lengths)).alias("b"))
    numbers = every.join(own.select(F.col("node").alias("component"), F.col("low").alias("number")), "component").select(
        "node", "component", "number", "cyclic")
    return Index(keep(numbers, "numbers"), keep(blocks.select("component", "b.*").distinct(), "blocks"), lengths)


def closure(edges: DataFrame) -> DataFrame:
    """`p, src, dst`: all pairs joined by a path of edges of one `p`, each once, for `edges` with these columns.

    Sources, the nodes that no edge leads to, are taken off while they have at least half of the edges left: their pairs are their edges
    and the pairs of their targets, one join per layer from the last one taken off to the first. Only what is left is labelled, so
    the many nodes at the rim of a graph get no labels. The first layer's pairs, as a rule most of all, are not stored.
    """
    folder = storage.shared_folder(edges.sparkSession)

    def keep(frame: DataFrame, name: str) -> DataFrame:
        return storage.materialize(frame, folder, name)

    rest = keep(edges.select("p", "src", "dst"), "given")
    taken = []
    while True:
        led_to = rest.select("p", F.col("dst").alias("src")).distinct().withColumn("inner", F.lit(True))
        # One shuffle by source serves the join, the removal of repeats and the window.
        marked = rest.select("p", "src", "dst").join(led_to, ["p", "src"], "left").select(
            "p", "src", "dst", F.coalesce("inner", F.lit(False)).alias("inner")).distinct()
        marked = keep(marked.withColumn("several", F.count(F.lit(1)).over(W.partitionBy("p", "src")) > 1), f"marked-{len(taken)}")
        inner, outer = marked.agg(F.count_if("inner"), F.count_if(~F.col("inner"))).first()
        if outer < inner or not outer:
            rest = marked
            break
        taken.append(marked.where("not inner").drop("inner"))
        rest = marked.where("inner")
        if not inner:
            break
    # No IRI has a space, so nodes of one property are told from those of another by what stands before it.
    labels = build(rest.select(F.concat_ws(" ", "p", "src").alias("src"), F.concat_ws(" ", "p", "dst").alias("dst")))
    found = labels.targets(labels.numbers.select("node"))
    below = keep(found.select(F.substring_index("src", " ", 1).alias("p"), *(
        F.substring_index(c, " ", -1).alias(c) for c in ("src", "dst"))), "pairs-core")
    paths = [f"{folder}/pairs-core"]
    for k in range(len(taken) - 1, -1, -1):
        known = storage.read_tables(below, paths)
        further = known.select("p", F.col("src").alias("via"), F.col("dst").alias("far"))

        def led(layer: DataFrame) -> DataFrame:
            # A target on a cycle leads to itself, which its edge says already.
            more = layer.withColumnRenamed("dst", "via").join(further, ["p", "via"]).where("far <> via")
            return layer.select("p", "src", "dst").unionByName(more.select("p", "src", F.col("far").alias("dst")))

        # Only a source with several targets can have a pair twice.
        own = led(taken[k].where("not several")).unionByName(led(taken[k].where("several")).distinct())
        if k == 0:
            return known.unionByName(own)
        keep(own, f"pairs-{k}")
        paths.append(f"{folder}/pairs-{k}")
    return below
