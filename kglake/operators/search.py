"""Graphs by the classes and properties they use.

Names are found through inverted indexes, so the list of searched names may be as long as the lake: an ending of a name is
a key, in a few fixed lengths, and so are the short pieces a name is made of. A searched text meets the names that share its
longest key, as a join on equal keys, and is then compared exactly.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kglake.functions import terms as t

# Item kinds: 'class', 'property', or 'any'.
Item = tuple[str, str]

# Lengths of keys. A searched text takes the longest that it has; an empty one has the key that all names have.
ENDING_LENGTHS = (16, 8, 4, 2, 1, 0)
PIECE_LENGTHS = (4, 3, 2, 1, 0)


def items_frame(spark, items: Sequence[Item]) -> DataFrame:
    """The searched items, each once."""
    return spark.createDataFrame(sorted(set(items)), "wanted_kind string, pattern string")


def _longest(text: Column, lengths: Sequence[int]) -> Column:
    return F.coalesce(*(F.when(F.length(text) >= length, F.lit(length)) for length in lengths))


def _names(void_partition: DataFrame) -> DataFrame:
    return void_partition.select("kind", "item").distinct()


def ending_index(names: DataFrame, lengths: Sequence[int] = ENDING_LENGTHS) -> DataFrame:
    """`kind, item, key_length, key`: every name by its endings of fixed lengths. May be stored and passed to the searches."""
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length("item"))
    return names.select("kind", "item", F.explode(fitting).alias("key_length")).withColumn("key", F.right("item", F.col("key_length")))


def piece_index(names: DataFrame, lengths: Sequence[int] = PIECE_LENGTHS) -> DataFrame:
    """`kind, item, key_length, key`: every name by all pieces of fixed lengths that it contains."""
    def pieces(length: int) -> Column:
        cut = F.transform(F.sequence(F.lit(1), F.length("item") - length + 1), lambda at: F.substring(F.col("item"), at, F.lit(length)))
        cut = F.array_distinct(cut) if length else F.array(F.lit(""))
        return F.transform(F.when(F.length("item") >= length, cut), lambda piece: F.struct(F.lit(length).alias("key_length"), piece.alias("key")))

    rows = names.select("kind", "item", F.explode(F.array(*map(pieces, lengths))).alias("of_length"))
    return rows.select("kind", "item", F.explode("of_length").alias("k")).select("kind", "item", "k.*")


def _met(names: DataFrame, items: DataFrame, index, lengths: Sequence[int], exactly) -> DataFrame:
    """`kind, item, wanted_kind, pattern` of the names that satisfy an item, over the keys of `index`."""
    keyed = items.withColumn("key_length", _longest(F.col("pattern"), lengths))
    keyed = keyed.withColumn("key", F.right("pattern", F.col("key_length")))
    used = [r[0] for r in keyed.select("key_length").distinct().collect()]  # some of the fixed lengths
    index = index(names, sorted(used)) if callable(index) else index.where(F.col("key_length").isin(used))
    kinds = (F.col("wanted_kind") == "any") | (F.col("wanted_kind") == F.col("kind"))
    return index.join(keyed, ["key_length", "key"]).where(kinds & exactly(F.col("item"), F.col("pattern"))).select(
        "kind", "item", "wanted_kind", "pattern")


def _having_all(void_partition: DataFrame, met: DataFrame, items: DataFrame) -> DataFrame:
    """Graphs with a name for every item."""
    matches = void_partition.select("graph", "version", "kind", "item").join(met, ["kind", "item"])
    found = matches.groupBy("graph", "version").agg(F.countDistinct("wanted_kind", "pattern").alias("found"))
    return found.where(F.col("found") == items.distinct().count()).select("graph", "version")


def graphs_with_all_suffixes(void_partition: DataFrame, items: DataFrame, endings: DataFrame | None = None) -> DataFrame:
    """Graphs where each item is the ending of some class or property name; `endings` is a stored `ending_index`."""
    index = ending_index if endings is None else endings
    return _having_all(void_partition, _met(_names(void_partition), items, index, ENDING_LENGTHS, t.ends_with_item), items)


def graphs_with_all_items(void_partition: DataFrame, items: DataFrame) -> DataFrame:
    """Graphs that have each item by its exact name."""
    met = _names(void_partition).join(items, F.col("item") == F.col("pattern")).where(
        (F.col("wanted_kind") == "any") | (F.col("wanted_kind") == F.col("kind")))
    return _having_all(void_partition, met, items)


def find_graphs(void_partition: DataFrame, catalog: DataFrame, items: DataFrame, endings: DataFrame | None = None,
                pieces: DataFrame | None = None) -> DataFrame:
    """Latest graphs that have every item, with the count of each entry that contains one.

    No items find no graph. `endings` and `pieces` are stored indexes of all names; without them the names of the latest
    graphs are indexed as they are searched.
    """
    latest = catalog.where("is_latest").select(F.col("dir_name").alias("graph"), "version", "graph_dir")
    in_lake = void_partition.join(latest.select("graph", "version"), ["graph", "version"], "left_semi")
    found = graphs_with_all_suffixes(in_lake, items, endings)
    inside = in_lake.join(found, ["graph", "version"], "left_semi")
    index = piece_index if pieces is None else pieces
    containing = _met(_names(inside), items, index, PIECE_LENGTHS, t.contains_item).select("kind", "item").distinct()
    return inside.join(containing, ["kind", "item"], "left_semi").join(latest, ["graph", "version"]).select(
        "graph", "version", "graph_dir", "kind", "item", "triples")
