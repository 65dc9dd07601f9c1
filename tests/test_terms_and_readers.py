import pytest
from pyspark.sql import functions as F

from kglake.functions import terms as t
from kglake.functions import vocab as V
from kglake.operators import stats
from kglake.sinks import triples as sink
from kglake.sources import triples as src
from tests.graphs import write

LINES = [
    "# comment",
    "",
    "<http://e/s> <http://e/p> <http://e/o> .",
    '<http://e/s> <http://e/p> "plain" .',
    '<http://e/s> <http://e/p> "" .',
    '<http://e/s>\t<http://e/p> "tag\\"ged\\n"@en-GB . # trailing',
    '_:b1 <http://e/p> "5"^^<http://www.w3.org/2001/XMLSchema#integer>.',
    "<http://e/s> <http://e/p> _:b1.",
    '<http://e/s> <http://e/p> "a\\\\nb \\u00e9 \\U0001F600 it\\\'s \\\\U0001F600 \\t." .',
    '<http://e/s> <http://e/p> "' + "x\\\\" * 40000 + '" .',
    "<http://e/s> <http://e/p> broken .",
]


def test_read_ntriples(spark, tmp_path):
    path = write(tmp_path / "g.nt", LINES)
    rows = src.read_ntriples(spark, path).collect()
    assert len(rows) == 8
    objects = {(r.o, r.o_kind, r.o_datatype, r.o_lang) for r in rows}
    assert ("http://e/o", "iri", None, None) in objects
    assert ("plain", "literal", V.XSD_STRING, None) in objects
    assert ("", "literal", V.XSD_STRING, None) in objects
    assert ('tag"ged\n', "literal", V.RDF_LANG_STRING, "en-GB") in objects
    assert ("5", "literal", V.XSD + "integer", None) in objects
    assert ("a\\nb é \U0001F600 it's \\U0001F600 \t.", "literal", V.XSD_STRING, None) in objects
    assert ("x\\" * 40000, "literal", V.XSD_STRING, None) in objects
    bnodes = {r.s for r in rows if r.s_kind == "bnode"} | {r.o for r in rows if r.o_kind == "bnode"}
    assert len(bnodes) == 1 and bnodes.pop().endswith("_b1")
    assert [r.value for r in src.ntriples_rejects(spark, path).collect()] == [LINES[-1]]


def test_blank_nodes_are_local_to_a_file(spark, tmp_path):
    a = write(tmp_path / "a.nt", ["_:x <http://e/p> <http://e/o> ."])
    b = write(tmp_path / "b.nt", ["_:x <http://e/p> <http://e/o> ."])
    assert src.read_ntriples(spark, [a, b]).select("s").distinct().count() == 2
    assert src.read_ntriples(spark, [a, b], blank_nodes="shared").select("s").distinct().count() == 1


def test_round_trips_keep_types(spark, tmp_path):
    path = write(tmp_path / "g.nt", LINES)
    original = src.read_ntriples(spark, path, "shared")
    sink.write_triples_parquet(original, str(tmp_path / "g.parquet"), 3)
    assert len(list((tmp_path / "g.parquet").glob("part-*"))) == 3
    stored = src.read_triples_parquet(spark, str(tmp_path / "g.parquet"))
    assert stored.exceptAll(original).isEmpty() and original.exceptAll(stored).isEmpty()
    sink.write_ntriples(stored, str(tmp_path / "out"))
    again = src.read_ntriples(spark, str(tmp_path / "out"), "shared")
    assert again.exceptAll(original).isEmpty() and again.count() == 8


def test_namespace(spark):
    cases = {
        "http://e/a#b": "http://e/a#",
        "http://e/path/Name.x-1": "http://e/path/",
        "http://e/reference/23488078": "http://e/reference/23488078",
        "http://e/12ab": "http://e/12",
        "http://e/": "http://e/",
    }
    df = spark.createDataFrame(list(cases.items()), "iri string, expected string")
    assert df.where(t.namespace(F.col("iri")) != F.col("expected")).collect() == []


def test_suffix_and_size(spark):
    names = ["hdfs://h/d/out-1716875255957", "hdfs://h/d/out-1716901360159.log", "other"]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    ids = [r[0] for r in df.select(t.try_long(t.suffix_after(F.col("name"), "/d/out-"))).collect()]
    assert ids == [1716875255957, None, None]
    sizes = spark.createDataFrame([(6860047,), (576,), (0,), (None,)], "n bigint").select(t.format_size(F.col("n")))
    assert [r[0] for r in sizes.collect()] == ["6.86e+06 triples", "576 triples", "", ""]


def test_result_line(spark):
    lines = ["<a> <b> <c>", " <a> <b> <c> .", "# no", "<a> <b>"]
    df = spark.createDataFrame([(x,) for x in lines], "line string")
    parsed = [r[0] for r in df.select(t.parse_result_line(F.col("line"))).collect()]
    assert parsed[0] == parsed[1] == ("a", "b", "c") and parsed[2] is None and parsed[3] is None


def test_statements_and_rejects_share_the_lines(spark, tmp_path):
    good = [r'<http://e/a> <http://e/p> "C:\\dir \u00e9 \U0001F600 \t\"q\"" .', r"<http://e/c\u003Ed> <http://e/p> <http://e/o> . # \q",
            '_:b <http://e/p> "x"@en-GB .', '<http://e/a> <http://e/p> "1"^^<http://e/t\\u0020y> .']
    bad = [r'<http://e/a> <http://e/p> "C:\qdir" .', r'<http://e/a> <http://e/p> "bad \u12G4" .', r'<http://e/a> <http://e/p> "a\/b" .',
           r'<http://e/a> <http://e/p> "\uD800" .', "<http://e/a b> <http://e/p> <http://e/o> .", r'<http://e/a> <http://e/p> "\U00110000" .',
           "<http://e/a> <http://e/p> <http://e/{o}> .", '<http://e/a> <http://e/p> "x"@9 .']
    path = tmp_path / "g.nt"
    path.write_text("\n".join([*good, "", "# comment", *bad]) + "\n")
    read = src.read_ntriples(spark, str(path))
    assert read.count() == len(good) and read.where("o is null or s is null").isEmpty()
    assert sorted(r.value for r in src.ntriples_rejects(spark, str(path)).collect()) == sorted(bad)
    sink.write_ntriples(read, str(tmp_path / "out"))
    again = src.read_ntriples(spark, str(tmp_path / "out"), "shared")
    assert again.exceptAll(read).isEmpty() and again.count() == len(good)
    with pytest.raises(Exception, match="without subject"):
        sink.write_ntriples(read.withColumn("o", F.lit(None).cast("string")), str(tmp_path / "broken"))


def test_greatest_value_is_exact(spark):
    big = ["9999999999999999999", "10000000000000000001", "-3", "10000000000000000000.5", "010000000000000000000"]
    rows = [("http://e/s", t.IRI, "http://e/p", o, t.LITERAL, V.XSD + "decimal", None) for o in big]
    rows += [("http://e/s", t.IRI, "http://e/n", o, t.LITERAL, V.XSD + "decimal", None) for o in ("-1.51", "-1.5", "-10000000000000000001")]
    found = stats.max_per_property(spark.createDataFrame(rows, t.TRIPLE_SCHEMA)).collect()
    assert {r.property: r.o for r in found} == {"http://e/p": "10000000000000000001", "http://e/n": "-1.5"}


def test_one_latest_version_of_each_graph(spark):
    from kglake.operators import catalog as cat
    from kglake.testbed import graph as g

    catalog = cat.all_graphs(g.catalog(spark, "/root/testdata/sf0.001")).limit(1)
    added = catalog.withColumn("version", F.explode(F.array(F.lit("2099-01"), F.lit("2099-02"))))
    registered = cat.register_version(catalog, added, "2099-03-01 00:00:00")
    assert [r.version for r in cat.latest_graphs(registered).collect()] == ["2099-02"]


def test_a_line_is_matched_once(spark, tmp_path):
    """The optimizer does not copy the line's regular expression into filters and columns."""
    path = tmp_path / "lines.nt"
    path.write_text('<http://e/s> <http://e/p> "a\\tb" .\nno statement\n<http://e/s> <http://e/p> "\\u12" .\n')
    from kglake.sources import triples as readers

    read = readers.read_ntriples(spark, f"file://{path}")
    assert [r.o for r in read.collect()] == ["a\tb"]
    assert [r.value for r in readers.ntriples_rejects(spark, f"file://{path}").select("value").collect()] == [
        "no statement", '<http://e/s> <http://e/p> "\\u12" .']
    for frame in (read, readers.ntriples_rejects(spark, f"file://{path}")):
        assert frame._jdf.queryExecution().optimizedPlan().toString().count("$7") == 1


def test_lines_are_made_once_and_escaped_where_needed(spark):
    """A null check that repeats the line computes every escape twice; IRIs without odd characters take one match in all."""
    schema = t.TRIPLE_SCHEMA
    rows = [("http://e/s", "iri", "http://e/p", "http://e/o", "iri", None, None), ("_:b", "bnode", "http://e/p", 'a"b', "literal", V.XSD_STRING, None),
            ("http://e/s", "iri", "http://e/p", "a b", "literal", V.RDF_LANG_STRING, "en"), ("http://e/ s", "iri", "http://e/p", "_:b", "bnode", None, None),
            ("http://e/s", "iri", "http://e/<p", "x", "literal", "http://e/d", None), ("http://e/s", "iri", "http://e/p", "http://e/{o", "iri", None, None),
            ("http://e/s", "iri", "http://e/p", "a\\b", "literal", "http://e/|d", None)]
    lines = spark.createDataFrame(rows, schema).repartition(1).select(t.format_line().alias("line"))
    assert {r.line for r in lines.collect()} == {
        "<http://e/s> <http://e/p> <http://e/o> .", '_:b <http://e/p> "a\\"b" .', '<http://e/s> <http://e/p> "a b"@en .',
        "<http://e/\\u0020s> <http://e/p> _:b .", '<http://e/s> <http://e/\\u003Cp> "x"^^<http://e/d> .',
        "<http://e/s> <http://e/p> <http://e/\\u007Bo> .", '<http://e/s> <http://e/p> "a\\\\b"^^<http://e/\\u007Cd> .'}
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("http://www.w3.org/2001/XMLSchema#string") <= 3 and "isnull(concat" not in plan


def test_ntriples_are_stored_compressed_in_small_files(spark, tmp_path, monkeypatch):
    """Plain text of a large graph takes over ten times the tables' size; a compressed file cannot be split, so it is kept small."""
    from kglake.plans import storage

    monkeypatch.setattr(storage, "ROWS_PER_FILE", 1000)
    subject = F.concat(F.lit("http://ex.org/vocabulary/order/O"), "id")
    given = t.resource_triples(spark.range(0, 4000, 1, 1), subject, F.lit("http://ex.org/vocabulary#within"), F.lit("_:customer"))
    sizes = {}
    for compression in ("gzip", "none"):
        path = tmp_path / compression
        sink.write_ntriples(given, str(path), compression)
        files = [p for p in path.iterdir() if p.name.startswith("part-")]
        assert len(files) == 4
        sizes[compression] = sum(p.stat().st_size for p in files)
        back = src.read_ntriples(spark, str(path), "shared")
        assert back.count() == 4000 and back.exceptAll(given).isEmpty()
    assert sizes["gzip"] * 5 < sizes["none"]
    sink.write_ntriples(given, str(tmp_path / "default"))
    assert all(p.name.endswith(".gz") for p in (tmp_path / "default").iterdir() if p.name.startswith("part-"))


def test_the_decoder_is_stated_once_and_labels_are_kept(spark, tmp_path):
    """Six copies of it made the reader's code too large to be compiled. Escapes of blank node labels are none."""
    path = tmp_path / "g.nt"
    path.write_text('_:a\\tb <http://e/p\\u0041> _:c\\td .\n<http://e/\\u0042> <http://e/p> "_:\\t\\u0043"^^<http://e/\\u0044> .\n'
                    '  <http://e/s> <http://e/p> <http://e/o> .\n \t\n  # <http://e/s> <http://e/p> <http://e/o> .\n')
    read = src.read_ntriples(spark, str(path), "shared")
    assert {(r.s, r.p, r.o, r.o_datatype) for r in read.collect()} == {
        ("_:a\\tb", "http://e/pA", "_:c\\td", None), ("http://e/B", "http://e/p", "_:\tC", "http://e/D"), ("http://e/s", "http://e/p", "http://e/o", None)}
    assert src.ntriples_rejects(spark, str(path)).isEmpty()
    assert read._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
