import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kglake.operators import catalog as cat
from kglake.operators import results as res
from kglake.operators import search
from kglake.plans import enhance, void_job
from kglake.sinks import single_file
from kglake.sinks import triples as sink
from kglake.sources import catalog as catalog_src
from kglake.sources import results as results_src
from kglake.sources import tables
from kglake.sources import triples as src
from kglake.sources import void as void_src
from kglake.functions import vocab as V

FACTS = [f'<http://e.org/s{i}> <http://e.org/predicate> "Object {i}" .' for i in (1, 2, 3)]


def lake(tmp_path, fmt="NT", files=("a.nt",), onto="", name="g", versions=("2", "1")):
    """Metadata and files of one graph, the first version being the latest."""
    for i, version in enumerate(versions):
        info = {
            "download_url": "https://e.org/", "version": version, "actual_file_list": list(files), "dir_name": name,
            "compression": "", "format": fmt, "date_importation_msd": f"202{9 - i}-01-04T12:14:14.839735",
            "ontology_namespace": onto,
        }
        text = json.dumps(info)
        (tmp_path / f"{name}_metadata_v{version}").write_text(text)
        if i == 0:
            (tmp_path / f"{name}_metadata_latest").write_text(text)
        folder = tmp_path / f"{name}_v{version}"
        folder.mkdir(exist_ok=True)
        for file in files:
            (folder / file).write_text("\n".join(FACTS) + "\n")
    return str(tmp_path)


def test_catalog_of_a_folder(spark, tmp_path):
    catalog = catalog_src.read_catalog(spark, lake(tmp_path))
    assert catalog.count() == 3 and cat.all_graphs(catalog).count() == 2
    row = cat.find_graph(catalog, "g")
    assert (row.version, row.graph_dir) == ("2", f"{tmp_path}/g_v2")
    assert row.date_importation == datetime(2029, 1, 4, 12, 14, 14, 839735)
    assert cat.find_graph(catalog, "g", "1").version == "1"
    with pytest.raises(LookupError):
        cat.find_graph(catalog, "absent")
    assert [r.line for r in cat.graph_listing(catalog).collect()] == ["g 2, NT"]
    meta = json.loads(cat.graph_metadata(catalog).where("version = '2'").first().metadata)
    assert meta["actual_file_list"] == ["a.nt"] and meta["format"] == "NT"


def test_empty_and_broken_catalogs(spark, tmp_path):
    assert catalog_src.read_catalog(spark, str(tmp_path)).count() == 0
    (tmp_path / "g_metadata_latest").write_text('{"download_url": "x",\n"version\n}')
    with pytest.raises(Exception, match="g_metadata_latest"):
        catalog_src.read_catalog(spark, str(tmp_path)).collect()


def test_graph_content_by_file_and_parquet(spark, tmp_path):
    catalog = catalog_src.read_catalog(spark, lake(tmp_path, files=("f1.nt", "f2.nt", "f3.nt")))
    assert src.read_graph(catalog, "g").count() == 9
    assert src.read_graph_files(catalog, "g", "2", ["f1.nt"]).count() == 3
    assert src.read_graph_files(catalog, "g", "2", [f"{tmp_path}/g_v2/f1.nt", "f2.nt"]).count() == 6
    assert src.read_graph_files(catalog, "g", "2").count() == 9
    assert src.read_graph_files(catalog, "g", "2", ["none.nt"]).count() == 0
    with pytest.raises(FileNotFoundError):
        src.read_graph(catalog, "g", force_parquet=True)
    first = sink.serialize_graph(catalog, "g", max_triples_per_file=2)
    second = sink.serialize_graph(catalog, "g", max_triples_per_file=2)
    assert first != second and (tmp_path / "g_v2.parquet").is_dir()
    stored = src.read_graph(catalog, "g", force_parquet=True)
    assert stored.count() == 9 and stored.where("o_kind = 'literal'").count() == 9
    assert src.read_graphs(catalog, [("g", "2"), ("g", "1")]).count() == 18
    assert src.read_graphs(catalog, []).count() == 0


def test_unknown_format(spark, tmp_path):
    catalog = catalog_src.read_catalog(spark, lake(tmp_path, fmt="NON_RDF_FORMAT"))
    with pytest.raises(ValueError, match="NON_RDF_FORMAT"):
        src.read_graph(catalog, "g")
    assert void_job.write_graph_void(catalog, "g") is None


def test_void_of_a_catalog_graph(spark, tmp_path):
    catalog = catalog_src.read_catalog(spark, lake(tmp_path))
    path = void_job.write_graph_void(catalog, "g")
    assert path == f"{tmp_path}/g_v2_analysis/void"
    texts = void_src.read_void(spark, path)
    items = search.items_frame(spark, [("property", "predicate")])
    found = search.find_graphs(void_src.void_partition(texts), catalog, items).collect()
    assert [(r.graph, r.version, r.item, r.triples) for r in found] == [("g", "2", "http://e.org/predicate", 3)]
    assert cat.raw_void(texts, "g", "2").first().value.startswith("@prefix rdf:")
    assert cat.raw_void(texts, "g", "1").first().value == ""
    sizes = cat.graph_listing(catalog, void_src.void_dataset(texts)).first().line
    assert sizes == "g 2, NT, 3 triples, instance graph"


def test_search_semantics(spark):
    rows = [("a", "1", "class", "http://x#Datatype", 2), ("a", "1", "property", "http://x#first", 4),
            ("b", "1", "class", "http://x#DatatypeProperty", 1), ("b", "1", "property", "http://x#first", 1)]
    part = spark.createDataFrame(rows, "graph string, version string, kind string, item string, triples bigint")

    def graphs(operator, items):
        return sorted(r.graph for r in operator(part, search.items_frame(spark, items)).collect())

    assert graphs(search.graphs_with_all_suffixes, [("class", "#Datatype")]) == ["a"]
    assert graphs(search.graphs_with_all_suffixes, [("property", "first")]) == ["a", "b"]
    assert graphs(search.graphs_with_all_suffixes, [("property", "first"), ("property", "first")]) == ["a", "b"]
    assert graphs(search.graphs_with_all_suffixes, [("property", "")]) == ["a", "b"]
    assert graphs(search.graphs_with_all_suffixes, [("property", "nawak"), ("property", "first")]) == []
    assert graphs(search.graphs_with_all_suffixes, []) == []
    assert graphs(search.graphs_with_all_items, [("class", "Datatype")]) == []
    assert graphs(search.graphs_with_all_items, [("any", "http://x#first"), ("class", "http://x#Datatype")]) == ["a"]


def test_retention_and_updates(spark, tmp_path):
    lake(tmp_path, versions=("E", "D", "C", "B"))
    lake(tmp_path, name="x_g", versions=("Z",))
    catalog = catalog_src.read_catalog(spark, str(tmp_path))
    expired = {(r.dir_name, r.version) for r in cat.expired_versions(catalog, 2).collect()}
    assert expired == {("g", "C"), ("g", "B")}
    offered = spark.createDataFrame([("g", "E"), ("x_g", "Y"), ("new", "1")], "dir_name string, version string")
    assert {r.dir_name for r in cat.pending_updates(offered, catalog).collect()} == {"x_g", "new"}
    assert cat.pending_updates(offered, catalog, force=True).count() == 3
    assert cat.available_together(catalog, ["g", "x_g"]).count() == 0
    added = cat.all_graphs(catalog).where("version = 'E'").withColumn("version", F.lit("F"))
    registered = cat.register_version(cat.all_graphs(catalog), added, "2030-01-01 00:00:00")
    assert [r.version for r in cat.latest_graphs(registered).where("dir_name = 'g'").collect()] == ["F"]
    assert registered.count() == 6


def test_results_of_successive_runs(spark, tmp_path):
    def run(stamp, names):
        body = "#comment\n\n" + "".join(f"<http://c/{n}> <{V.SKOS_RELATED}> <http://t/1>\n" for n in names)
        (tmp_path / f"out-{stamp}").write_text(body)
        (tmp_path / f"out-{stamp}.log").write_text(body + "<http://c/log> <p> <o>\n")

    def read():
        return results_src.read_results(spark, str(tmp_path), "out-")

    run(1716875255957, ["a", "b", "c"])
    assert res.new_results(*reversed(read())).count() == 3
    run(1716884614734, ["a", "b", "c", "d"])
    runs, results = read()
    assert [r.s for r in res.new_results(results, runs).collect()] == ["http://c/d"] and res.has_news(results, runs)
    report = res.diff_report(results, runs, "http://r/new", "http://r/out-")
    lines = [r.line for r in report.orderBy("section").collect()]
    assert lines == [f"<http://r/new> <{V.PROV_DERIVED}> <http://r/out-1716884614734>",
                     f"<http://c/d> <{V.SKOS_RELATED}> <http://t/1>"]
    single_file.write_single_file(report.orderBy("section").select("line"), str(tmp_path / "report"))
    assert (tmp_path / "report").read_text().splitlines() == lines
    run(1716888767913, ["a"])
    runs, results = read()
    same = res.diff_report(results, runs, "http://r/new", "http://r/out-").collect()
    assert [r.line for r in same] == ["# NO newer results"] and not res.has_news(results, runs)
    assert {r.s for r in res.newest_run(results, runs).collect()} == {"http://c/a"}
    single_file.write_single_file(report.orderBy("section").select("line"), str(tmp_path / "report"))  # a second time
    assert (tmp_path / "report").read_text().splitlines() == lines
    (tmp_path / "out-1716888767914").write_text("# nothing found\n")  # the newest run is empty
    runs, results = read()
    assert not res.has_news(results, runs) and res.newest_run(results, runs).isEmpty()
    run(1716888767915, ["b"])  # the run before was empty
    runs, results = read()
    assert [r.s for r in res.new_results(results, runs).collect()] == ["http://c/b"]


def test_no_run_and_one_run_without_lines(spark, tmp_path):
    runs, results = results_src.read_results(spark, str(tmp_path), "out-")
    assert runs.isEmpty() and not res.has_news(results, runs)
    (tmp_path / "out-5").write_text("")
    runs, results = results_src.read_results(spark, str(tmp_path), "out-")
    assert [r.run_id for r in runs.collect()] == [5] and not res.has_news(results, runs)


def test_enhanced_void(spark, tmp_path):
    cito, dct = "http://purl.org/spar/cito/", "http://purl.org/dc/terms/"
    path = tmp_path / "o.nt"
    path.write_text("\n".join([
        f"<{cito}hasCitationTimeSpan> <{V.RDFS_DOMAIN}> <{cito}Citation> .",
        f"<{cito}hasCitationTimeSpan> <{V.RDFS_RANGE}> <{V.XSD}duration> .",
        f"<{dct}creator> <{V.DCAM_RANGE_INCLUDES}> <{dct}Agent> .",
        f"<{dct}unused> <{V.RDFS_RANGE}> <{dct}Agent> .",
    ]))
    rows = [("g", "1", "property", p, 1) for p in (cito + "confirms", cito + "hasCitationTimeSpan", dct + "creator")]
    part = spark.createDataFrame(rows, "graph string, version string, kind string, item string, triples bigint")
    enhanced = enhance.enhance_void(part, src.read_ntriples(spark, str(path)))
    ranges = {r.property: r.ranges for r in enhance.ranges_of(enhanced).collect()}
    assert ranges == {cito + "hasCitationTimeSpan": [V.XSD + "duration"], dct + "creator": [dct + "Agent"]}
    domains = {r.property: r.domains for r in enhance.domains_of(enhanced).collect()}
    assert domains == {cito + "hasCitationTimeSpan": [cito + "Citation"]}
    back = void_src.enhanced_void_partition(enhance.enhanced_as_triples(enhanced))
    assert back.count() == 3 and back.where("size(ranges) = 1").count() == 2


def test_ontology_choice(spark, tmp_path):
    lake(tmp_path, onto="http://o#", name="small")
    lake(tmp_path, onto="http://o#", name="big")
    lake(tmp_path, onto="http://o#", name="unknown")
    lake(tmp_path, name="facts")
    catalog = catalog_src.read_catalog(spark, str(tmp_path))
    sizes = spark.createDataFrame([("small", "2", 576, True), ("big", "2", 6860047, True)],
                                  "graph string, version string, triples bigint, is_valid boolean")
    chosen = {r.dir_name for r in enhance.select_ontologies(catalog, sizes, 4000).collect()}
    assert chosen == {"small", "unknown"}


def test_nested_json_table(spark, tmp_path):
    dump = [
        {"children": [{"text": "C_ID"}, {"text": "CAS ID"}]},
        {"children": [{"children": [{"href": "i?w=C1", "text": "C1"}]}, {"text": "50-00-0"}, {"text": "Name"}]},
    ]
    path = tmp_path / "dump.json"
    path.write_text(json.dumps(dump))
    columns = ["id", "cas_id", "name", "formula", "mass", "taxon"]
    rows = tables.read_json_rows(spark, str(path), columns, "http://base/", multiline=True).collect()
    assert [tuple(r) for r in rows] == [("http://base/i?w=C1", "C1", "50-00-0", "Name", "", "", "")]


def test_enhancement_and_summary_jobs_may_run_again(spark, tmp_path):
    lake(tmp_path)
    lake(tmp_path, onto="http://e.org/", name="o", versions=("1",))
    (tmp_path / "o_v1" / "a.nt").write_text(
        f"<http://e.org/predicate> <{V.RDFS_RANGE}> <http://e.org/Thing> .\n<http://e.org/predicate> <{V.RDFS_DOMAIN}> <http://e.org/S> .\n")
    catalog = cat.all_graphs(catalog_src.read_catalog(spark, str(tmp_path)))
    for _ in range(2):
        path = enhance.write_enhanced_void(catalog, "g")
        triples = src.read_ntriples(spark, path, "shared")
        back = void_src.enhanced_void_partition(triples)
        assert [(r["item"], r.ranges, r.domains) for r in back.collect()] == [
            ("http://e.org/predicate", ["http://e.org/Thing"], ["http://e.org/S"])]
        counters = {r.p.removeprefix(V.VOID): r.o for r in triples.where(F.col("s").startswith(V.VOID_SOURCE)).collect()}
        assert (counters["triples"], counters["distinctSubjects"], counters["properties"]) == ("3", "3", "1")
        assert "http://e.org/" in [r.o for r in triples.where(F.col("p") == V.VOID + "vocabulary").collect()]
        assert void_job.write_graph_void(catalog, "g") == f"{tmp_path}/g_v2_analysis/void"
    assert not [p.name for p in (tmp_path / "g_v2_analysis").iterdir() if p.name.endswith((".temp", ".old"))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_names_are_found_by_keys(spark):
    """Every ending and every piece of every name, by any index, equals a comparison of all names with all texts; no nested loop."""
    from kglake.operators import search

    names = ["http://e/a#Size", "http://e/b#size", "Größe", "ab", "", "http://e/very/long/name#withAnEndingOfManyLetters", "a://#"]
    void = spark.createDataFrame([(f"g{k % 3}", "1", "class" if k % 2 else "property", x, 1) for k, x in enumerate(names)],
                                 "graph string, version string, kind string, item string, triples long")
    texts = sorted({x[k:] for x in names for k in range(len(x) + 1)} | {x[2:5] for x in names} | {"no such", "SIZE", "#S"})
    items = search.items_frame(spark, [("any", x) for x in texts])
    for index, lengths, matches, exactly in (
            (search.ending_index, search.ENDING_LENGTHS, str.endswith, search.t.ends_with_item),
            (search.piece_index, search.PIECE_LENGTHS, str.__contains__, search.t.contains_item)):
        want = {(x, text) for x in names for text in texts if matches(x, text)}
        stored = index(search._names(void))
        for source in (index, stored):
            met = search._met(search._names(void), items, source, lengths, exactly)
            rows = [(r.item, r.pattern) for r in met.collect()]
            assert set(rows) == want and len(rows) == len(want)
    catalog = spark.createDataFrame([("g0", "1", "/g0", True)], "dir_name string, version string, graph_dir string, is_latest boolean")
    plan = plan_of(search.find_graphs(void, catalog, search.items_frame(spark, [("any", "ize"), ("property", "#Size")])))
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_stored_tables_bound_the_rows_of_a_file(spark, tmp_path, monkeypatch):
    """Rows that compress to nothing would all be one task's: what its aggregates hold follows rows, not bytes."""
    from kglake.plans import storage

    monkeypatch.setattr(storage, "ROWS_PER_FILE", 10)
    stored = storage.materialize(spark.range(25).coalesce(1), str(tmp_path), "rows")
    assert sorted(r.n for r in stored.groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()) == [5, 10, 10]
    assert sorted(r.id for r in stored.collect()) == list(range(25))


def test_summary_reads_the_triples_once(spark, tmp_path):
    """Counting distinct triples took a second pass, which derived and shuffled whole triples again; nulls and empty strings differ."""
    from kglake.functions import terms as t
    from kglake.plans.void_job import void_stats

    texts = [("x", None), (None, "x"), ("x", ""), ("", "x"), ("", None), (None, ""), (None, None), ("x", "x"), ("xx", None)]
    rows = [("http://e/s", "iri", "http://e/p", "o", "literal", d, lang) for d, lang in texts * 2]
    rows += [("http://e/s", "iri", "http://e/" + p, "http://e/" + o, "iri", None, None) for p, o in [("a", "bc"), ("ab", "c"), ("a", "bc")]]
    sink.write_triples_parquet(spark.createDataFrame(rows, t.TRIPLE_SCHEMA), str(tmp_path / "g"))
    dataset = void_stats(src.read_triples_parquet(spark, str(tmp_path / "g")), "g", "1").dataset
    assert dataset.inputFiles() and not [f for f in dataset.inputFiles() if str(tmp_path) in f]
    row = dataset.first()
    assert (row.triples, row.entities, row.distinct_subjects, row.distinct_objects, row.properties) == (len(texts) + 2, 6, 1, 2, 3)
