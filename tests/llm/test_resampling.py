import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from kglake.llm import resampling as rs

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def runs(text):
    found = WORD.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return len(found), [" ".join(found[i:i + k]) for k in (1, 2, 3) for i in range(len(found) - k + 1)]


def expected(rows, target, percent=5, least_words=20):
    """Brute force, one document at a time."""
    def bucket(feature):
        return zlib.crc32(feature.encode()) % 10000

    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, runs(text)[1]))
    for text in target:
        t.update(map(bucket, runs(text)[1]))
    all_s, all_t = s.total(), t.total()
    out = []
    for doc_id, text in rows:
        n, found = runs(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (all_s + 10000) / ((s[b] + 1) * (all_t + 10000))))
                     for b in map(bucket, found))
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, score, None, n])
    able = sorted((r for r in out if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, row in enumerate(able[:percent * len(able) // 100], 1):
        row[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=repr)


def test_resample_equals_brute_force(spark, docs, texts):
    target = [t for i, t, _ in texts if i % 9 == 4] + [None, "É É é 12 a_b"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    for percent in (5, 60, 100):
        got = sorted(map(tuple, rs.resample(docs, frame, percent).collect()), key=repr)
        assert got == expected([(i, t) for i, t, _ in texts], target, percent)


def test_ties_nulls_and_repeated_rows(spark):
    text = "ab cd 12 Ef " * 8
    rows = [(3, text)] * 3 + [(None, text)] * 4 + [(1, None), (2, ""), (4, "x " * 25), (5, "y " * 19)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {name: F.lit("mine") for name in ("row", "rank", "score", "weight", "place", "part", "digit", "n", "least", "id")})
    got = sorted(map(tuple, rs.resample(docs, docs.select("text").limit(0), 100).collect()), key=repr)
    assert got == expected(rows, [], 100)
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 9))


def test_no_rows(empty_docs, docs):
    assert rs.resample(empty_docs, docs.select("text")).collect() == []


@pytest.mark.parametrize("bits", [1, 5, 12])
def test_radix_places_are_those_of_a_sort(spark, bits):
    r = random.Random(bits)
    rows = [(r.choice([-(1 << 63), (1 << 63) - 1, 0, r.getrandbits(40)]), r.randint(-3, 3), k) for k in range(600)]
    frame = spark.createDataFrame(rows, "a long, b long, c long").repartition(5)
    got = {x.place: (x.a, x.b, x.c) for x in rs.radix_ranks(frame.where("b <> 0 or a <> 0"), ["b", "c"], bits).collect()}
    assert [got[k] for k in range(len(got))] == sorted((x for x in rows if x[1] or x[0]), key=lambda x: x[1:])
    if bits == 12:
        wide = {x.place: (x.a, x.b, x.c) for x in rs.radix_ranks(frame, ["a", "c"], bits).collect()}
        assert [wide[k] for k in range(len(rows))] == sorted(rows, key=lambda x: (x[0], x[2]))


def test_places_of_equal_rows_have_no_gaps(spark):
    frame = spark.range(50).select(F.lit(7).cast("long").alias("a")).repartition(7)
    assert sorted(r.place for r in rs.radix_ranks(frame, ["a"]).collect()) == list(range(50))


def test_head_keeps_all_that_can_be_in_it(spark):
    r = random.Random(6)
    values = [r.randint(-(10 ** 9), 10 ** 9) for _ in range(2000)]
    frame = spark.createDataFrame([(v,) for v in values], "k long")
    kept = [r.k for r in rs.head(frame, "k", 100).collect()]
    assert set(sorted(values)[-100:]) <= set(kept) and len(kept) < 120
    assert len(rs.head(frame.select(F.lit(1).cast("long").alias("k")), "k", 3).collect()) == 2000


def test_gains_use_every_bucket():
    got = rs.gains(np.array([3, 0]), np.array([0, 1]))
    assert got.tolist() == [math.floor(1000 * math.log(1 * 5 / (4 * 3))), math.floor(1000 * math.log(2 * 5 / (1 * 3)))]
