"""Conjunctive graph patterns as joins of filtered projections."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.plans import storage

Pattern = tuple[str, str, "str | t.Literal"]
_LITERAL_PARTS = ("kind", "datatype", "lang")


def is_variable(term) -> bool:
    return isinstance(term, str) and term.startswith("?")


def variables(pattern: Pattern) -> set[str]:
    return {term[1:] for term in pattern if is_variable(term)}


def _columns(name: str, resources: set[str]) -> list[str]:
    """The columns of a variable: one for a resource, four for what may be a literal."""
    return [name] if name in resources else [name] + [f"{name}__{part}" for part in _LITERAL_PARTS]


# A side is cut by the keys of another one that has fewer rows by this factor.
REDUCE_BY = 4


def _terms(pattern: Pattern, resources: set[str]) -> tuple[Column, dict[str, list[Column]]]:
    """One pattern: constants and repeated variables as a condition, and the columns of each variable."""
    condition, picked = F.lit(True), {}
    for position, term in zip("spo", pattern):
        column = F.col(position)
        if isinstance(term, t.Literal):
            condition &= (F.col("o_kind") == t.LITERAL) & (column == term.value)
            condition &= (F.col("o_datatype") == term.datatype) & F.col("o_lang").eqNullSafe(F.lit(term.lang))
        elif not is_variable(term):
            condition &= column == term
            if position != "p":
                condition &= F.col(f"{position}_kind") == (t.BNODE if term.startswith("_:") else t.IRI)
        else:
            name = term[1:]
            if position == "o" and name in resources:
                condition &= F.col("o_kind") != t.LITERAL
            if name in picked:
                condition &= column == picked[name][0]
            elif name in resources:
                picked[name] = [column]
            else:
                picked[name] = [column, F.col("o_kind"), F.col("o_datatype"), F.col("o_lang")]
    return condition, picked


def _matches(triples: DataFrame, pattern: Pattern, resources: set[str]) -> DataFrame:
    """The variables of the triples that a pattern matches."""
    condition, picked = _terms(pattern, resources)
    out = [
        column.alias(alias)
        for name, columns in picked.items()
        for alias, column in zip(_columns(name, resources), columns)
    ]
    return triples.where(condition).select(*out)


@dataclass(frozen=True)
class Matches:
    """The triples that each of some patterns matches, stored apart, and their numbers."""

    tables: dict[Pattern, DataFrame]
    counts: dict[Pattern, int]


def _tagged(triples: DataFrame, patterns: Sequence[Pattern]) -> DataFrame:
    """The triples that some pattern matches, once for each, with the pattern's place as `tag`."""
    # Without knowing which variables are resources a pattern matches at least what it will.
    conditions = [_terms(pattern, set())[0] for pattern in patterns]
    tags = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in enumerate(conditions))), lambda tag: tag.isNotNull())
    return triples.select(*t.TRIPLE_COLUMNS, F.explode(tags).alias("tag"))


def match_all(triples: DataFrame, patterns: Sequence[Pattern]) -> Matches:
    """All patterns of one or more queries matched in one scan of the triples, and stored by pattern."""
    patterns = list(dict.fromkeys(patterns))
    path = f"{storage.shared_folder(triples.sparkSession)}/matches"
    _tagged(triples, patterns).write.partitionBy("tag").parquet(path)
    spark = triples.sparkSession
    stored = spark.read.schema(", ".join(f"{c} string" for c in t.TRIPLE_COLUMNS) + ", tag int").parquet(path)
    counts = dict(stored.groupBy("tag").count().collect())  # a row per pattern
    tables = {p: stored.where(F.col("tag") == k).select(*t.TRIPLE_COLUMNS) for k, p in enumerate(patterns)}
    return Matches(tables, {p: counts.get(k, 0) for k, p in enumerate(patterns)})


def _join_order(patterns: Sequence[Pattern], counts: dict[Pattern, int] | None = None) -> list[Pattern]:
    """As listed, or those with fewest matches first, except that a pattern waits until it shares a variable with those before it."""
    waiting, ordered, bound = list(patterns), [], set()
    if counts:
        waiting.sort(key=counts.__getitem__)
    while waiting:
        joinable = [p for p in waiting if not ordered or variables(p) & bound or not variables(p)]
        if not joinable:
            raise ValueError(f"pattern {waiting[0]} shares no variable with the others")
        ordered.append(joinable[0])
        waiting.remove(joinable[0])
        bound |= variables(joinable[0])
    return ordered


def _reduced(matches: Matches, ordered: list[Pattern], resources: set[str]) -> dict[Pattern, DataFrame]:
    """The matches of each pattern, without those whose keys no smaller one before it has.

    A semi join by the keys of a much smaller side: it keeps the rest out of the shuffles of the joins, as a runtime filter would.
    """
    out: dict[Pattern, DataFrame] = {}
    for k, pattern in enumerate(ordered):
        rows = _matches(matches.tables[pattern], pattern, resources)
        for other in ordered[:k]:
            keys = sorted(variables(pattern) & variables(other) & resources)
            if keys and matches.counts[other] * REDUCE_BY < matches.counts[pattern]:
                rows = rows.join(out[other].select(*keys).distinct(), keys, "left_semi")
        out[pattern] = rows
    return out


def bgp(triples: DataFrame | Matches, patterns: Sequence[Pattern], select: Sequence[str] | None = None,
        distinct: bool = True, typed: bool = False, repeats: bool = True) -> DataFrame:
    """Solutions of triple patterns, one column per selected variable.

    Variables start with `?`; other strings are IRIs or blank nodes; literals are `Literal`.
    A variable seen only in object position may be a literal and joins on its
    whole term; `typed` keeps its `__kind`, `__datatype` and `__lang` columns.

    With `distinct` a pattern that binds nothing new is a semi join, and a variable nobody
    needs any more is dropped, with its duplicates, before the next join, so a
    label shared by many nodes does not multiply through the rest of the query. A graph is
    a set, so each pattern's matches are made one first: a triple stored a thousand
    times must not multiply either. For triples known to hold few repeats,
    `repeats=False` leaves that out, and with it a shuffle per pattern.

    Given triples are scanned once per pattern, where each scan reads only its predicate. Given `Matches`, from `match_all`, patterns
    read what is stored of them, join in the order of their numbers, and are cut by much smaller ones first.
    """
    resources = {term[1:] for p in patterns for term in p[:2] if is_variable(term)}
    everything = set().union(*(variables(p) for p in patterns))
    selected = list(select) if select else sorted(everything)
    unknown = set(selected) - everything
    if unknown:
        raise ValueError(f"no pattern binds {sorted(unknown)}")
    stored = isinstance(triples, Matches)
    ordered = _join_order(patterns, triples.counts if stored else None)
    reduced = _reduced(triples, ordered, resources) if stored else {}
    result, bound = None, set()
    for step, pattern in enumerate(ordered):
        names = variables(pattern)
        matches = reduced[pattern] if stored else _matches(triples, pattern, resources)
        if distinct and repeats and not names <= bound:
            matches = matches.distinct()
        later = set(selected).union(*(variables(p) for p in ordered[step + 1:]))
        if result is None:
            result = matches
        elif not names:
            result = result.join(matches.limit(1), F.lit(True), "left_semi")
        else:
            result = _join(result, matches, names & bound, resources, distinct and names <= bound)
        bound |= names
        kept = bound & later
        if kept != bound:
            result = result.select(*(c for name in sorted(kept) for c in _columns(name, resources)))
            bound = kept
            if distinct and step + 1 < len(ordered):
                result = result.distinct()
    columns = [c for name in selected for c in _columns(name, resources)]
    result = result.select(*columns)
    if distinct:
        result = result.distinct()
    return result if typed else result.select(*selected)


def _join(left: DataFrame, right: DataFrame, shared: set[str], resources: set[str], semi: bool) -> DataFrame:
    how = "left_semi" if semi else "inner"
    keys = sorted(shared)
    if set(keys) <= resources:
        return left.join(right, keys, how)
    renamed = right
    condition = F.lit(True)
    for column in [c for key in keys for c in _columns(key, resources)]:
        renamed = renamed.withColumnRenamed(column, f"{column}__r")
        condition &= left[column].eqNullSafe(renamed[f"{column}__r"])
    joined = left.join(renamed, condition, how)
    return joined.select(*(c for c in joined.columns if not c.endswith("__r")))


def siblings(triples: DataFrame, predicate: str, node: str) -> DataFrame:
    """The children of a node's parents, the node included."""
    return bgp(triples, [(node, predicate, "?parent"), ("?sibling", predicate, "?parent")], ["sibling"])
