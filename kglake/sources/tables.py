"""Relational rows as triples."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V


@dataclass(frozen=True)
class Rule:
    """One triple made from each row; SQL expressions over the row's columns.

    `obj` is a resource unless a datatype or language is given. A null subject or
    object makes no triple. Blank subjects and objects are declared.
    """

    predicate: str
    subject: str
    obj: str
    datatype: str | None = None
    lang: str | None = None
    subject_kind: str = t.IRI
    object_kind: str = t.IRI

    @property
    def is_literal(self) -> bool:
        return self.datatype is not None or self.lang is not None


def _text(value: str | None) -> str:
    return "null" if value is None else "'" + value.replace("'", "\\'") + "'"


def _columns_of(rule: Rule) -> dict[str, str]:
    """The triple's columns as SQL."""
    datatype = V.RDF_LANG_STRING if rule.lang is not None else rule.datatype
    return {
        "s": rule.subject,
        "s_kind": _text(rule.subject_kind),
        "p": _text(rule.predicate),
        "o": f"cast({rule.obj} as string)",
        "o_kind": _text(t.LITERAL if rule.is_literal else rule.object_kind),
        "o_datatype": _text(datatype),
        "o_lang": rule.lang or "null",
    }


def tables_to_triples(df: DataFrame, rules: Iterable[Rule], predicates: Iterable[str] | None = None) -> DataFrame:
    """Every row of `df` through every rule, in one scan.

    A row is repeated by the numbers of the rules that apply to it, and each triple column is
    a choice by that number. A query that uses few triple columns then computes, and
    reads from the table, only what those need. Rules name their predicate as a constant, so a
    reader who wants only some `predicates` leaves the other rules out of the plan.
    """
    wanted = None if predicates is None else set(predicates)
    rules = [rule for rule in rules if wanted is None or rule.predicate in wanted]
    if not rules:
        return t.empty_triples(df.sparkSession)
    applies = [f"{rule.subject} is not null and {rule.obj} is not null" for rule in rules]
    made = [_columns_of(rule) for rule in rules]
    if len(rules) == 1:
        return df.where(applies[0]).selectExpr(
            *(f"cast({made[0][name]} as string) as {name}" for name in t.TRIPLE_COLUMNS)
        )
    numbers = ", ".join(f"case when {condition} then {i} end" for i, condition in enumerate(applies))
    rows = df.selectExpr("*", f"explode(array({numbers})) as rule").where("rule is not null")
    return rows.selectExpr(*(f"{_choice([m[name] for m in made])} as {name}" for name in t.TRIPLE_COLUMNS))


def _choice(values: list[str]) -> str:
    """The value for the row's rule; one branch per different value."""
    branches: dict[str, list[str]] = {}
    for number, value in enumerate(values):
        branches.setdefault(value, []).append(str(number))
    if len(branches) == 1:
        return f"cast({values[0]} as string)"
    cases = " ".join(f"when rule in ({', '.join(ns)}) then {value}" for value, ns in branches.items())
    return f"cast(case {cases} end as string)"


_CELL = "struct<text:string, href:string, children:array<struct<text:string, href:string>>>"


_LINK = "try_element_at(try_element_at(children, 1).children, 1)"


def json_row_rejects(spark: SparkSession, paths: str | list[str], multiline: bool = False) -> DataFrame:
    """The cells' texts of the rows without a link: the header, and data rows a caller should look at."""
    rows = spark.read.schema(f"children array<{_CELL}>").json(paths, multiLine=multiline)
    return rows.where(F.expr(f"{_LINK}.href is null")).select(F.expr("transform(children, c -> c.text)").alias("cells"))


def read_json_rows(spark: SparkSession, paths: str | list[str], columns: list[str], url_base: str,
                   multiline: bool = False) -> DataFrame:
    """Rows of an HTML table dumped as nested JSON.

    The first cell holds a link: its target, after `url_base`, becomes `uri` and its text the
    first column. Cells are taken by position and a missing one is the empty string. Rows
    without a link, the header among them, are those of `json_row_rejects`.
    """
    rows = spark.read.schema(f"children array<{_CELL}>").json(paths, multiLine=multiline)
    link = F.expr(_LINK)
    rest = [
        F.coalesce(F.expr(f"try_element_at(children, {i}).text"), F.lit("")).alias(name)
        for i, name in enumerate(columns[1:], start=2)
    ]
    return rows.withColumn("link", link).where("link.href is not null").select(
        F.concat(F.lit(url_base), F.col("link.href")).alias("uri"),
        F.coalesce("link.text", F.lit("")).alias(columns[0]),
        *rest,
    )


def compound_rules(namespace: str) -> list[Rule]:
    """The nine triples of a compound row `(uri, id, cas_id, name, formula, mass, taxon)`."""
    obo = "http://www.geneontology.org/formats/oboInOwl#"
    chebi = "http://purl.obolibrary.org/obo/chebi#"
    return [
        Rule(V.RDF_TYPE, "uri", f"'{namespace}Compound'"),
        Rule(V.RDF_TYPE, "uri", f"'{namespace}KnapsackCompound'"),
        Rule(V.RDFS_LABEL, "uri", "name", V.XSD_STRING),
        Rule(V.RDFS_LABEL, "uri", "id", V.XSD_STRING),
        Rule(obo + "hasExactSynonym", "uri", "name", V.XSD_STRING),
        Rule(chebi + "formula", "uri", "formula", V.XSD_STRING),
        Rule(chebi + "mass", "uri", "mass", V.XSD_STRING),
        Rule(namespace + "taxon", "uri", "taxon", V.XSD_STRING),
        Rule(obo + "hasDbXref", "uri", "concat('CAS:', cas_id)", V.XSD_STRING),
    ]
