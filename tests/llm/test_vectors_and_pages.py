import base64
import hashlib
import math
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kglake.llm import neighbours, pages, shared, warc


def brute(rows, asks, k):
    good = {i: np.array(v, float) for i, v in rows if i is not None and v is not None and len(v) == 16
            and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    out = {}
    for q in good:
        if asks(q):
            scores = sorted((-float((good[i] * good[q]).sum()), i) for i in good if i != q)[:k]
            out[q] = [i for _, i in scores]
    return out


def test_nearest_reaches_its_recall(spark):
    r = np.random.default_rng(4)
    centers = r.normal(size=(12, 16))
    rows = [(i, (centers[r.integers(12)] + 0.4 * r.normal(size=16)).astype(np.float32).tolist()) for i in range(2500)]
    rows += [(3000 + i, [float(np.float32(1.5 * x)) for x in rows[5][1]]) for i in range(60)]  # one vector many times, nearest to itself
    rows += [(4000, None), (4001, [0.0] * 16), (4002, [1.0] * 15 + [None]), (4003, [1.0] * 15 + [float("nan")]), (4020, [1.0] * 3),
             (4004, [float("inf")] * 16), (None, rows[7][1]), (10, rows[10][1]), (10, rows[10][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit(1)).withColumn("part", F.lit("p"))
    found = {}
    for x in neighbours.nearest(frame, F.col("vec_id") % 20 == 0, 20).collect():
        found.setdefault(x.query_id, {})[x.rank] = (x.vec_id, x.score)
    vectors = dict(rows)
    want = brute(rows, lambda q: q % 20 == 0, 20)
    assert found.keys() == want.keys()
    hits = 0
    for q, ranks in found.items():
        got = [ranks[k] for k in range(1, 21)]
        assert got == sorted(got, key=lambda x: (-x[1], x[0]))
        for i, score in got:
            assert score == pytest.approx(float(np.dot(np.array(vectors[i], float), np.array(vectors[q], float))), abs=1e-9)
        hits += len({i for i, _ in got} & set(want[q]))
    assert hits / (20 * len(want)) >= 0.95
    # Fifty-nine vectors tie: the smallest ids come first.
    assert [found[3000][k][0] for k in range(1, 21)] == want[3000] == list(range(3001, 3021))
    assert [found[3020][k][0] for k in range(1, 21)] == want[3020] == list(range(3000, 3020))


def test_nearest_edge_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert neighbours.nearest(spark.createDataFrame([], schema), F.lit(True)).count() == 0
    one = spark.createDataFrame([(20, [1.0, 2.0])], schema)
    assert neighbours.nearest(one, F.lit(True)).count() == 0
    three = spark.createDataFrame([(20, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.5, -0.5])], schema)
    rows = [(x.rank, x.vec_id, x.score) for x in neighbours.nearest(three, F.col("vec_id") == 20).collect()]
    assert sorted(rows) == [(1, 1, 0.5), (2, 2, 0.5)]


def test_graph_walk_finds_what_a_scan_finds():
    r = np.random.default_rng(8)
    sample = r.normal(size=(3000, 8)).astype(np.float32)
    lists = neighbours.fit(sample, float(np.sqrt((sample**2).sum(1).max())), 60, 10)
    x = lists.query(sample[:200])
    all_of = neighbours._distances(x, lists.centers)
    walked = lists.search(x, 1.2)
    within = all_of <= all_of.min(1, keepdims=True) * 1.2
    assert (np.isfinite(walked) & within).sum() >= 0.98 * within.sum()


def test_archive_round_trip(spark):
    html = ["<p>ä</p>", "<p>b</p>", None, "", "<p>ä</p>", "x" * 300_000, "<p>b</p>", "<p>ä</p>"]
    rows = [(10 - i, None if i == 1 else f"http://a/{i}", h, "z") for i, h in enumerate(html)] + [(None, "http://n", "<p>b</p>", "z")]
    folder = shared.new_folder(spark, "warc")
    index = warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string, sha string").repartition(3), folder)
    got = {x.page_id: x for x in warc.archive_summary(spark, folder).collect()}
    first: dict[str, int] = {}
    for i, _, h, _ in rows:
        if i is not None:
            first[h or ""] = min(first.get(h or "", i), i)
    for i, _, h, _ in rows:
        payload = (h or "").encode()
        of = first[h or ""]
        assert (got[i].payload_bytes, got[i].payload_digest) == (len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert (got[i].record_type, got[i].refers_to) == (("response", None) if of == i else ("revisit", of))
    few = warc.read_records(index.where("page_id in (5, 9)"), folder).collect()
    assert {x.page_id: x.payload and bytes(x.payload) for x in few} == {5: b"x" * 300_000, 9: None}
    assert warc.read_index(spark, folder).count() == len(rows)


@pytest.mark.parametrize("url", ["http://a/b?c=%0A&d=é", "http://a/\r\nX: y", "a\nb", " http://a ", "", "x\u2028y%20", "\n", None])
def test_addresses_come_back_unchanged(url):
    raw = warc.record_bytes(7, url, b"<p>", warc.digest(b"<p>"), None, "2024-01-01T00:00:00Z")
    head = raw.partition(b"\r\n\r\n")[0].decode()
    assert all(len(line.splitlines()) == 1 for line in head.split("\r\n"))
    assert warc.parse_record(raw)["url"] == url


def test_archive_edge_tables(spark):
    schema = "page_id long, url string, html string"
    folder = shared.new_folder(spark, "warc")
    warc.write_warc(spark.createDataFrame([], schema), folder)
    assert warc.archive_summary(spark, folder).count() == 0
    folder = shared.new_folder(spark, "warc")
    warc.write_warc(spark.createDataFrame([(1, "u", "a")] * 3 + [(2, "u", "a")], schema), folder)
    assert Counter((x.page_id, x.record_type) for x in warc.archive_summary(spark, folder).collect()) == {
        (1, "response"): 3, (2, "revisit"): 1}


def test_ranges_are_coalesced():
    assert warc.ranges([(0, 10), (10, 5), (40, 5), (500, 3)], gap=30, most=100) == [(0, 45, 3), (500, 503, 1)]
    assert warc.ranges([(0, 60), (60, 60)], gap=30, most=100) == [(0, 60, 1), (60, 120, 1)]


def test_damaged_records_are_noticed():
    record = warc.record_bytes(1, "u", b"payload", warc.digest(b"payload"), None, "2024-01-01T00:00:00Z")
    assert warc.parse_record(record)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse_record(record.replace(b"payload\r\n", b"pxyload\r\n"))


@pytest.fixture(scope="module")
def trees(spark, shipped):
    return pages.fit_trees(spark)


def test_page_reading():
    nodes, texts = pages.read_page("<div>a<b>b</b> c<br>d<script>x<p></script><!-- n --><p>e &amp; f<p>g</div>h<p title='>'>i")
    assert pages.text_of(texts, np.ones(len(nodes), bool)) == "ab c d e & f g h i"
    assert [n.tag for n in nodes] == ["#root", "div", "b", "script", "p", "p", "p"]
    assert pages.read_page(None)[1] == [] and pages.read_page("<<a <!-- x")[0]


def test_held_out_pages(trees):
    right = 0
    for seed in range(50_000, 50_200):
        source = pages.training_page(seed)
        nodes, texts = pages.read_page(source)
        right += pages.extract([source], trees)[0] == pages.text_of(texts, np.array([n.label == 1 for n in nodes]))
    assert right >= 170


def test_supplied_page_pattern(trees):
    page = ("<!DOCTYPE html><html lang='en'><head><meta charset='utf-8'><title>T</title><style>p{}</style></head><body><nav><ul>"
            "<li><a href='/a'>one</a></li><li><a href='/b'>two,</a></li></ul></nav><!-- ad 0 --><div class='ad'>Buy this.</div>"
            "<article><h1>Head line of it</h1><p><b>First part &amp; more.<br><p>Second part, of it.</p><p>Third.</p></article>"
            "<footer>&copy; site &middot; foot</footer>")
    assert pages.extract([page, None, ""], trees) == ["Head line of it First part & more. Second part, of it. Third.", "", ""]


def test_label_attributes_of_supplied_pages_are_ignored(trees):
    page = "<article><h1>Head line of it</h1><p>First part, and more of it.</p><table><tr><td{}>Second part.</table></article>"
    plain = pages.extract([page.format("")], trees)
    for attribute in ('data-label="Price"', "data-label='9'", f'{pages.LABEL}="Price"', f'{pages.LABEL}="²"', f'{pages.LABEL}="1"'):
        assert pages.extract([page.format(" " + attribute)], trees) == plain


def test_decoding_never_keeps_below_clutter(trees):
    r = np.random.default_rng(3)
    for seed in range(20):
        nodes, _ = pages.read_page(pages.training_page(seed))
        kept = pages.decode(nodes, np.clip(r.random(len(nodes)), 0.01, 0.99))
        left = set()
        for k in range(1, len(nodes)):
            above = nodes[k].parent
            if above in left or kept[above] and not kept[k]:
                left.add(k)
                assert not kept[k]


def test_page_edge_tables(spark):
    schema = "page_id long, url string, html string, text string, n_chars string"
    rows = [(1, "u", None, "t", "n"), (2, None, "", "t", "n"), (None, "v", "plain words", "t", "n"), (2, None, "", "t", "n")]
    got = pages.main_texts(spark.createDataFrame(rows, schema), 60)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert Counter((x.page_id, x.n_chars == len(x.text)) for x in got.collect()) == {(1, True): 1, (2, True): 2, (None, True): 1}
    assert pages.main_texts(spark.createDataFrame([], schema), 60).count() == 0


def test_a_query_reads_each_part_once():
    """Parts of a query's lists are found before rows are copied: many lists in one part make one row."""
    import numpy as np

    from kglake.llm import neighbours

    spans = {c: (0, 1) for c in range(200)} | {200: (1, 3)}
    assert neighbours.read_parts(np.arange(200), spans).tolist() == [0]
    assert neighbours.read_parts(np.array([3, 200]), spans).tolist() == [0, 1, 2, 3]
