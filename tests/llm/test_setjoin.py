import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from kglake.llm import setjoin
from tests.llm.conftest import words


def grams(text):
    found = (text or "").encode().lower().split()
    return {b" ".join(found[k:k + 5]) for k in range(max(1, len(found) - 4))} if found else set()


def brute(rows, t):
    """`[(doc_id, size, component)]` over all pairs that share a shingle; `rows` are `(doc_id, text)` with ids that differ."""
    sets = {i: grams(text) for i, text in rows}
    names = {s: k for k, s in enumerate(set().union(*sets.values()))}
    arrays = {i: np.array(sorted(names[s] for s in group), np.int64) for i, group in sets.items()}
    ids = sorted(arrays)
    used = np.zeros((len(ids), len(names)), np.float32)
    for k, i in enumerate(ids):
        used[k, arrays[i]] = 1
    both = used @ used.T
    size = used.sum(1)
    link = (size[:, None] > 0) & (size > 0) & (t.denominator * both >= t.numerator * (size[:, None] + size - both))
    root = np.arange(len(ids))
    while True:
        low = np.array([root[row].min() if row.any() else root[k] for k, row in enumerate(link)])
        low = low[low]
        if (low == root).all():
            return sorted((i, int(size[k]), ids[root[k]]) for k, i in enumerate(ids))
        root = low


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


@pytest.mark.parametrize("threshold", ["1/2", "13/20", "9/10"])
def test_any_threshold_equals_brute_force(spark, texts, threshold):
    t = Fraction(threshold)
    rows = [(i, text) for i, text, _ in texts]
    r = random.Random(7)
    for size in (70, 200, 300, 600):  # with shared halves, for low thresholds
        base = words(r, size)
        for share in (0.5, 0.7, 0.8, 0.95):
            rows.append((len(rows), " ".join(base[:int(size * share)] + words(r, size - int(size * share)))))
        rows.append((len(rows), " ".join(base)))
    got = sorted(map(tuple, setjoin.near_duplicates(frame(spark, rows), threshold=t).collect()))
    assert got == brute(rows, t)


def family(seed, n, size=90):
    """Copies of one text, each with so many edits that few are near each other."""
    r = random.Random(seed)
    base, rows = words(r, size), []
    for k in range(n):
        near = list(base)
        for _ in range(r.choice([1, 2, 3, 4, 5, 7])):
            near[r.randrange(size)] = "z" + "".join(words(r, 2))
        rows.append((k, " ".join(near)))
    return rows


def test_large_family_of_near_copies(spark):
    rows = family(1, 1500)
    got = sorted(map(tuple, setjoin.near_duplicates(frame(spark, rows)).collect()))
    assert got == brute(rows, Fraction(3, 4))
    assert len({r[2] for r in got}) > 20


def test_small_blocks_change_nothing(spark, monkeypatch):
    """Tiles of a few sets only place the work."""
    rows = family(2, 300)
    want = brute(rows, Fraction(3, 4))
    monkeypatch.setattr(setjoin, "BLOCK_SETS", 8)
    assert sorted(map(tuple, setjoin.near_duplicates(frame(spark, rows)).collect())) == want


def test_spread_signatures_still_meet(monkeypatch):
    monkeypatch.setattr(setjoin, "SPREAD_SETS", 3)
    r = np.random.default_rng(3)
    t = Fraction(3, 4)
    bands = setjoin.Bands(t)
    bands.of(1 << 16)
    cost = np.full(1 << setjoin.COST_BITS, 10, np.float32)  # every signature in four parts
    for size in [4, 30, 70, 150, 240, 400] * 5:
        a = np.unique(r.integers(0, 2**63, size, dtype=np.uint64))
        b = np.delete(a, r.choice(len(a), len(a) // 5, replace=False))
        (sa, ra), (sb, rb) = (setjoin.signatures(x, cost, bands, setjoin.set_id(x)) for x in (a, b))
        assert set(sa[ra & 2 > 0].tolist()) & set(sb[rb & 1 > 0].tolist())
        one, _ = setjoin.signatures(a, cost / 10, bands, setjoin.set_id(a))
        assert not set(one.tolist()) & set(sa.tolist())


def test_costs_of_a_signature_agree_between_sets():
    """A subset with one n-gram deleted costs what the remaining subset costs where it is whole."""
    r = np.random.default_rng(5)
    cost = r.random(1 << setjoin.COST_BITS).astype(np.float32)
    a = np.unique(r.integers(0, 2**63, 200, dtype=np.uint64))
    whole = {}
    for k in range(len(a)):
        signature, price, *_ = setjoin._subsets(np.delete(a, k), cost, 80, 3, False)
        whole |= dict(zip(signature.tolist(), price.tolist()))
    _, _, deleted, price, _, _ = setjoin._subsets(a, cost, 80, 3, True)
    assert len(deleted) > 50
    assert all(whole[s] == p for s, p in zip(deleted.tolist(), price.tolist()))


def test_sets_whose_names_clash_are_told_apart(spark, monkeypatch):
    """With names cut to a few values, all sets of a name get others, and the result is that of whole names."""
    rows = family(4, 60) + [(100 + k, " ".join(words(random.Random(k), 40))) for k in range(40)]
    texts = [text for _, text in rows]
    whole = {setjoin.set_id(setjoin.shingles(x)) for x in texts}
    some = frozenset(sorted(whole)[:50])
    assert len({setjoin.set_id(setjoin.shingles(x), some) for x in texts}) == len(whole)
    assert not {setjoin.set_id(setjoin.shingles(x), some) for x in texts} & some
    assert setjoin.second_id(setjoin.shingles(texts[0])) not in whole


COLUMNS = ("no_id", "__id", "__row", "row", "Text_Name", "second_name", "set_id", "k0", "root", "leader", "size", "nth")


def test_survivors_keep_every_column(spark):
    text = "one two three four five six seven eight. "
    rows = [(3, text * 9), (2, text * 9), (2, text * 9), (None, text * 9), (5, "alone it is"), (None, None), (6, ""), (6, " \n")]
    docs = frame(spark, rows).withColumns({name: F.concat(F.lit(name), F.col("doc_id").cast("string")) for name in COLUMNS})
    docs = docs.withColumn("map", F.create_map(F.lit("a"), F.coalesce("doc_id", F.lit(0))))
    kept = setjoin.survivors(docs)
    assert kept.columns == docs.columns and kept.schema["map"].dataType == docs.schema["map"].dataType
    got = Counter((r.doc_id, r.text) for r in kept.collect())
    assert got == Counter([(2, text * 9), (5, "alone it is"), (None, None), (6, ""), (6, " \n")])
    for r in kept.collect():
        assert all(r[name] == (None if r.doc_id is None else f"{name}{r.doc_id}") for name in COLUMNS)
        assert r["map"] == {"a": r.doc_id or 0}
