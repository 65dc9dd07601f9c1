"""Readers of stored graphs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.plans import storage

# The characters an IRI may hold as they are, and the escapes of IRIs and of literals.
IRI = r"<[^\x00-\x20<>\"{}|^`\\]*+(?:\\[uU][^\x00-\x20<>\"{}|^`\\]*+)*+>"
LITERAL = r"[^\"\\]*+(?:\\[tbnrf\"'\\uU][^\"\\]*+)*+"
# One N-Triples statement. Possessive and unrolled, so long literals need no backtracking stack.
NTRIPLES_LINE = (
    rf"^\s*+({IRI}|_:\S++)\s*+({IRI})\s*+"
    rf'(?:({IRI})|(_:[^\s]*[^\s.])|"({LITERAL})"(?:@([A-Za-z]++(?:-[A-Za-z0-9]++)*+)|\^\^({IRI}))?)'
    r"\s*+\.\s*+(?:#.*)?$"
)
# A numeric escape without its digits, above the last code point, or of half a surrogate pair.
BAD_ESCAPE = (
    r"(?<!\\)(?:\\\\)*+\\(?:u(?![0-9A-Fa-f]{4})|u[dD][89A-Fa-f]|U(?!(?:000[0-9A-Fa-f]|0010)[0-9A-Fa-f]{4})"
    r"|U0000[dD][89A-Fa-f])"
)
BLANK_LINE = r"^\s*(?:#.*)?$"


def _lines(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    paths = [paths] if isinstance(paths, str) else list(paths)
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file_path"))
    # What a statement begins with spares it the match.
    first = F.col("value").substr(1, 1)
    return lines.where((first == "<") | (first == "_") | ~F.col("value").rlike(BLANK_LINE))


def _rewritten(lines: DataFrame) -> DataFrame:
    """`lines` with `fields`: a statement as its seven fields with line feeds between them, which no line can contain.

    Readers of statements and of rejects share `_is_statement`. The explode of one value keeps the match in a step of its own:
    without it the optimizer copies the regular expression into every filter and column that asks for it.
    """
    rewritten = F.regexp_replace("value", NTRIPLES_LINE, "$1\n$2\n$3\n$4\n$5\n$6\n$7")
    return lines.select("*", F.explode(F.array(rewritten)).alias("fields"))


def _is_statement() -> Column:
    escapes = F.contains("fields", F.lit("\\")) & F.col("fields").rlike(BAD_ESCAPE)
    return (F.instr("fields", "\n") > 0) & ~escapes


def read_ntriples(spark: SparkSession, paths: str | Iterable[str], blank_nodes: str = "file") -> DataFrame:
    """N-Triples files as triples; see `ntriples_rejects` for the lines that are none.

    Every line that is not blank and no comment is in exactly one of the two. Blank node labels are local to a
    file, so `blank_nodes="file"` qualifies them; "shared" keeps them as
    they are, for part files of one graph.
    """
    rows = _rewritten(_lines(spark, paths)).where(_is_statement()).select("file_path", "fields", F.split("fields", "\n").alias("f"))
    # Few lines have an escape. The decoder is a large expression: stated once, within a lambda, it leaves the code of all other lines small
    # enough to be compiled. Blank node labels, fields 0 and 3, are not decoded.
    decoded = F.transform("f", lambda token, i: F.when((i == 3) | ((i == 0) & ~token.startswith("<")), token).otherwise(t.unescape_literal(token)))
    rows = rows.select("file_path", F.when(F.contains("fields", F.lit("\\")), decoded).otherwise(F.col("f")).alias("f"))
    f = [F.col("f")[i] for i in range(7)]

    def iri(token):
        return F.substr(token, F.lit(2), F.length(token) - 2)

    def bnode(token):
        if blank_nodes == "shared":
            return token
        return F.concat(F.lit("_:f"), F.md5("file_path"), F.lit("_"), F.substr(token, F.lit(3)))

    s_is_iri = f[0].startswith("<")
    o_kind = F.when(f[2] != "", t.IRI).when(f[3] != "", t.BNODE).otherwise(t.LITERAL)
    literal = o_kind == t.LITERAL
    datatype = F.when(f[5] != "", V.RDF_LANG_STRING).when(f[6] != "", iri(f[6])).otherwise(V.XSD_STRING)
    return rows.select(
        F.when(s_is_iri, iri(f[0])).otherwise(bnode(f[0])).alias("s"),
        F.when(s_is_iri, t.IRI).otherwise(t.BNODE).alias("s_kind"),
        iri(f[1]).alias("p"),
        F.when(f[2] != "", iri(f[2])).when(f[3] != "", bnode(f[3])).otherwise(f[4]).alias("o"),
        o_kind.alias("o_kind"),
        F.when(literal, datatype).alias("o_datatype"),
        F.when(literal & (f[5] != ""), f[5]).alias("o_lang"),
    )


def ntriples_rejects(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Lines that are neither a statement, nor blank, nor a comment, with their file."""
    return _rewritten(_lines(spark, paths)).where(~_is_statement()).drop("fields")


def read_triples_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    """Typed triples of one or more stored graphs, in one scan."""
    return spark.read.schema(t.TRIPLE_SCHEMA).parquet(*paths)


def latest_parquet_run(spark: SparkSession, graph_dir: str) -> str | None:
    """The newest complete Parquet copy of a graph, if there is one."""
    root = graph_dir.rstrip("/") + ".parquet"
    names = storage.child_names(spark, root)
    if "_SUCCESS" in names:
        return root
    runs = sorted((n for n in names if n.startswith("run-")), key=lambda n: int(n[4:]), reverse=True)
    for run in runs:
        if storage.path_exists(spark, f"{root}/{run}/_SUCCESS"):
            return f"{root}/{run}"
    return None


def _catalog_row(catalog: DataFrame, name: str, version: str):
    from kglake.operators.catalog import find_graph

    return find_graph(catalog, name, version)


def _require_ntriples(row) -> None:
    """Unknown formats, and formats this library does not read as text, raise."""
    if row["format"] not in V.RDF_FORMATS:
        raise ValueError(f"{row['dir_name']} with format {row['format']} is not a known RDF format")
    if row["format"] not in ("NT", "NTRIPLES"):
        raise ValueError(f"{row['dir_name']} is {row['format']}: convert it to N-Triples or Parquet first")


def read_graph(catalog: DataFrame, name: str, version: str = "", force_parquet: bool = False) -> DataFrame:
    """A graph by name; Parquet when a copy is present, its source files otherwise."""
    spark = catalog.sparkSession
    row = _catalog_row(catalog, name, version)
    if row["format"] not in V.RDF_FORMATS:
        raise ValueError(f"{name} with format {row['format']} is not a known RDF format")
    run = latest_parquet_run(spark, row["graph_dir"])
    if run:
        return read_triples_parquet(spark, run)
    if force_parquet:
        raise FileNotFoundError(f"no Parquet copy of {name} {row['version']} at {row['graph_dir']}.parquet")
    _require_ntriples(row)
    return read_ntriples(spark, [f"{row['graph_dir']}/{file}" for file in row["actual_file_list"]])


def read_graph_files(catalog: DataFrame, name: str, version: str = "", file_list: Iterable[str] = ()) -> DataFrame:
    """Only the listed source files of a graph, given as names or paths; none listed means all."""
    row = _catalog_row(catalog, name, version)
    _require_ntriples(row)
    wanted = set(file_list)
    paths = [(file, f"{row['graph_dir']}/{file}") for file in row["actual_file_list"]]
    kept = [path for file, path in paths if not wanted or file in wanted or path in wanted]
    if not kept:
        return t.empty_triples(catalog.sparkSession)
    return read_ntriples(catalog.sparkSession, kept)


def read_graphs(catalog: DataFrame, graphs: Iterable[tuple[str, str]]) -> DataFrame:
    """The triples of several `(name, version)` graphs as one bag."""
    spark = catalog.sparkSession
    stored, others = [], []
    for name, version in graphs:
        row = _catalog_row(catalog, name, version)
        run = latest_parquet_run(spark, row["graph_dir"])
        if run and row["format"] in V.RDF_FORMATS:
            stored.append(run)
        else:
            others.append(read_graph(catalog, name, version))
    frames = ([read_triples_parquet(spark, *stored)] if stored else []) + others
    result = frames[0] if frames else t.empty_triples(spark)
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
