"""Triple schema and native expressions over its columns.

A triple is `(s, s_kind, p, o, o_kind, o_datatype, o_lang)`. IRIs carry no angle
brackets, blank nodes start with `_:`, and a literal always has a datatype.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kglake.functions import vocab as V

IRI, BNODE, LITERAL = "iri", "bnode", "literal"

TRIPLE_COLUMNS = ["s", "s_kind", "p", "o", "o_kind", "o_datatype", "o_lang"]
OBJECT_COLUMNS = ["o", "o_kind", "o_datatype", "o_lang"]
TRIPLE_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in TRIPLE_COLUMNS])


@dataclass(frozen=True)
class Literal:
    """A constant literal of a graph pattern."""

    value: str
    datatype: str = V.XSD_STRING
    lang: str | None = None


def empty_triples(spark) -> DataFrame:
    return spark.createDataFrame([], TRIPLE_SCHEMA)


def resource_triples(df: DataFrame, s, p, o) -> DataFrame:
    """Rows of `df` as triples between resources; kinds follow from the `_:` prefix."""
    s, o = (F.col(c) if isinstance(c, str) else c for c in (s, o))
    p = F.col(p) if isinstance(p, str) else p
    return df.select(
        s.alias("s"), kind_of(s).alias("s_kind"), p.alias("p"), o.alias("o"), kind_of(o).alias("o_kind"),
        F.lit(None).cast("string").alias("o_datatype"), F.lit(None).cast("string").alias("o_lang"),
    )


def kind_of(resource: Column) -> Column:
    return F.when(resource.startswith("_:"), F.lit(BNODE)).otherwise(F.lit(IRI))


def is_iri(position: str) -> Column:
    return F.lit(True) if position == "p" else F.col(f"{position}_kind") == IRI


def is_blank(position: str) -> Column:
    return F.lit(False) if position == "p" else F.col(f"{position}_kind") == BNODE


def is_literal(position: str) -> Column:
    return F.col("o_kind") == LITERAL if position == "o" else F.lit(False)


def predicate_matches(iri: str) -> Column:
    return F.col("p") == iri


def object_matches(iri: str) -> Column:
    return (F.col("o") == iri) & (F.col("o_kind") == IRI)


def namespace(iri: Column) -> Column:
    """The IRI without its longest tail that is an XML name without a colon.

    The text up to the last character no name can hold, and then what no name can start
    with. The match works back from the end, so long IRIs cost no more than short ones.
    """
    return F.regexp_extract(iri, r"(?s)^((?:.*[^\p{L}\p{N}_.\-·])?[\p{N}.\-·]*+)", 1)


def lexical_length() -> Column:
    return F.length("o")


def has_datatype() -> Column:
    return is_literal("o") & (F.coalesce("o_datatype", F.lit("")) != "")


def has_language() -> Column:
    return is_literal("o") & (F.coalesce("o_lang", F.lit("")) != "")


# The string escapes of N-Triples, backslash first.
_ESCAPES = [("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"), ("\b", "\\b"), ("\f", "\\f")]


def escape_literal(text: Column) -> Column:
    for raw, escaped in _ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(escaped))
    return text


# Fixed value: what an IRI holds only as an escape.
_NOT_IN_IRI = r"[\x00-\x20<>\"{}|^`\\]"


def escape_iri(term: Column) -> Column:
    """The term with characters outside the IRI set as `\\uXXXX`; all of them are ASCII."""
    characters = F.regexp_extract_all(term, F.lit("(?s)."), F.lit(0))
    escaped = F.array_join(F.transform(characters, lambda c: F.when(
        c.rlike(_NOT_IN_IRI), F.concat(F.lit("\\u"), F.lpad(F.hex(F.ascii(c)), 4, "0"))).otherwise(c)), "")
    return F.when(term.rlike(_NOT_IN_IRI), escaped).otherwise(term)


def _iri_reference(term: Column, escape: bool = True) -> Column:
    return F.concat(F.lit("<"), escape_iri(term) if escape else term, F.lit(">"))


def format_resource(term: Column, kind: Column, escape: bool = True) -> Column:
    return F.when(kind == BNODE, term).otherwise(_iri_reference(term, escape))


def format_object(escape: bool = True) -> Column:
    """The object as an N-Triples term; plain strings carry no datatype suffix. Without `escape` its IRIs need none."""
    suffix = (
        F.when(F.col("o_lang").isNotNull(), F.concat(F.lit("@"), F.col("o_lang")))
        .when(F.col("o_datatype") == V.XSD_STRING, F.lit(""))
        .otherwise(F.concat(F.lit("^^"), _iri_reference(F.col("o_datatype"), escape)))
    )
    literal = F.concat(F.lit('"'), escape_literal(F.col("o")), F.lit('"'), suffix)
    return F.when(is_literal("o"), literal).otherwise(format_resource(F.col("o"), F.col("o_kind"), escape))


def format_line() -> Column:
    """The statement as an N-Triples line; a triple that lacks a term fails instead of becoming a broken line.

    One match over all its IRIs tells whether any needs escapes; few do. `coalesce` asks for the line once.
    """
    def line(escape: bool) -> Column:
        return F.concat(
            format_resource(F.col("s"), F.col("s_kind"), escape), F.lit(" "), _iri_reference(F.col("p"), escape),
            F.lit(" "), format_object(escape), F.lit(" ."),
        )

    datatype = F.when(F.col("o_datatype") != V.XSD_STRING, F.col("o_datatype"))
    iris = F.concat_ws("", "s", "p", F.when(is_literal("o"), datatype).otherwise(F.col("o")))
    made = F.when(iris.rlike(_NOT_IN_IRI), line(True)).otherwise(line(False))
    return F.coalesce(made, F.raise_error(F.lit("a triple without subject, predicate or object")))


def term_to_string() -> Column:
    """The object for display: IRIs bare, literals quoted."""
    return F.when(is_literal("o"), format_object()).otherwise(F.col("o"))


def _code_unit(value: Column) -> Column:
    return F.concat(F.lit("\\u"), F.lpad(F.hex(value), 4, "0"))


def _json_escape_of(hex8: Column) -> Column:
    """`\\UXXXXXXXX` as one or two JSON escapes."""
    point = F.conv(hex8, 16, 10).cast("bigint")
    above = point - 0x10000
    pair = F.concat(
        _code_unit(F.shiftright(above, 10) + 0xD800), _code_unit(above.bitwiseAND(F.lit(0x3FF)) + 0xDC00)
    )
    return F.when(point < 0x10000, _code_unit(point)).otherwise(pair)


def unescape_literal(text: Column) -> Column:
    """Decode N-Triples escapes with the JSON string decoder.

    Escaped backslashes become a `\\u` escape first, so each backslash left starts
    one escape; the two N-Triples escapes JSON lacks are then rewritten.
    """
    plain = F.regexp_replace(text, r"\G([^\\]*+(?:\\[^\\][^\\]*+)*+)\\\\", r"$1\\u005C")
    plain = F.replace(plain, F.lit("\\'"), F.lit("'"))
    first_then_rest = F.split(plain, r"\\U")
    expanded = F.transform(
        first_then_rest,
        lambda part, i: F.when(i == 0, part).otherwise(
            F.concat(_json_escape_of(F.substring(part, 1, 8)), F.substr(part, F.lit(9)))
        ),
    )
    plain = F.when(F.instr(plain, "\\U") > 0, F.array_join(expanded, "")).otherwise(plain)
    decoded = F.from_json(
        F.concat(F.lit('["'), plain, F.lit('"]')), "array<string>", {"allowUnquotedControlChars": "true"}
    )[0]
    return F.when(F.instr(text, "\\") > 0, decoded).otherwise(text)


def ends_with_item(item: Column, pattern: Column) -> Column:
    return F.endswith(item, pattern)


def contains_item(item: Column, pattern: Column) -> Column:
    return F.contains(item, pattern)


def suffix_after(text: Column, basis: str) -> Column:
    """The text after the first `basis`, or the empty string where it is absent."""
    at = F.instr(text, basis)
    return F.when(at > 0, F.substr(text, at + len(basis))).otherwise(F.lit(""))


def try_long(text: Column) -> Column:
    return text.try_cast("bigint")


def empty_results(spark):
    return spark.createDataFrame([], "run_id bigint, s string, p string, o string")


RESULT_LINE = r"^<([^>]+)> <([^>]+)> <([^>]+)>(?:\s*\.)?$"


def parse_result_line(line: Column) -> Column:
    """A `(s, p, o)` struct of a result line, null where the line is something else."""
    text = F.trim(line)
    fields = F.struct(*(F.regexp_extract(text, RESULT_LINE, i + 1).alias(c) for i, c in enumerate("spo")))
    return F.when(text.rlike(RESULT_LINE), fields)


def is_supported_format(fmt: Column) -> Column:
    return fmt.isin(V.RDF_FORMATS)


def format_size(n: Column) -> Column:
    """`6.86e+06 triples` above ten thousand, the plain number below, blank for none."""
    return (
        F.when(n > 10000, F.format_string("%.2e triples", n.cast("float").cast("double")))
        .when(F.coalesce(n, F.lit(0)) != 0, F.concat(n.cast("string"), F.lit(" triples")))
        .otherwise(F.lit(""))
    )
