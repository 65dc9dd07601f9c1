import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from kglake.llm import fingerprints as fp


def by_hand(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def components(nodes, linked):
    """`{node: least reachable}` over all pairs."""
    root = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(root[a], root[b])
            if (root[a], root[b]) != (low, low):
                root[a] = root[b] = low
                changed = True
    return root


def expected(rows, radius=4):
    """Brute force over all pairs: rows of `(doc_id, text)`."""
    prints = [by_hand(t) for _, t in rows]
    distinct = sorted(set(prints))
    linked = [(a, b) for i, a in enumerate(distinct) for b in distinct[:i] if (a ^ b).bit_count() <= radius]
    root = components(distinct, linked)
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    return sorted(((d, f"{p:016x}", least.get(root[p])) for (d, _), p in zip(rows, prints)), key=repr)


def test_fingerprint_bits(texts):
    r = random.Random(2)
    for text in [None, "", " \n", "A", "a b c", "a b c d", "É ß a b c", " ".join(r.choices("abcd", k=1021))]:
        assert fp.fingerprint(text) == by_hand(text)
    for _, text, _ in texts:
        assert fp.fingerprint(text) == by_hand(text)


def test_near_duplicates_equal_all_pairs(docs, texts):
    got = sorted(map(tuple, fp.near_duplicates(docs).collect()), key=repr)
    assert got == expected([(i, t) for i, t, _ in texts])


def test_null_and_repeated_ids(spark):
    text = "one two three four five six seven. " * 20
    rows = [(7, text), (7, text), (None, text), (None, None), (5, ""), (None, "z y x"), (3, None), (9, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns(
        {name: F.lit(1) for name in ("fp", "a", "b", "root", "least", "leaf", "fingerprint", "component_id", "node")})
    got = sorted(map(tuple, fp.near_duplicates(docs).collect()), key=repr)
    assert got == expected(rows)
    assert (None, f"{by_hand('z y x'):016x}", None) in got


def test_no_rows(empty_docs):
    assert fp.near_duplicates(empty_docs).collect() == []


def test_odd_radius_is_refused(docs):
    with pytest.raises(ValueError):
        fp.links(docs.select(F.lit(1).cast("long").alias("fp")), 3)


def family(seed, size):
    """Random values, and families whose members differ from their first in up to six bits."""
    r = random.Random(seed)
    values = [r.getrandbits(64) for _ in range(size)]
    for base in values[: size // 10]:
        for _ in range(20):
            for _ in range(r.randint(1, 6)):
                base ^= 1 << r.randrange(64)
            values.append(base)
    return values


@pytest.mark.parametrize("radius", [2, 4])
def test_links_of_planted_families(spark, radius):
    values = family(4, 200)
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    found = fp.links(spark.createDataFrame([(v,) for v in signed], "fp long"), radius).collect()
    got = components(set(signed), [(r.a, r.b) for r in found])
    pairs = [(a, b) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= radius]
    assert got == components(set(signed), pairs)


def test_small_blocks_and_deep_trees_change_nothing(monkeypatch):
    """Leaves and blocks only place the work: a dense family in many leaves, in blocks of a few variants, keeps every link."""
    values = np.unique(np.array(family(8, 60), np.uint64))
    whole = dict(zip(*map(np.ndarray.tolist, fp.meetings(values, 0, 0, 4))))
    histogram = np.bincount((values >> np.uint64(48)).astype(np.int64), minlength=1 << 16)
    monkeypatch.setattr(fp, "BLOCK_VARIANTS", 3000)
    tree = fp.leaves(histogram, 5)
    assert max(depth for _, depth in tree) > 10
    parts = [fp.meetings(values[some], *tree[k], 4) for k, some in fp.touched(values, tree, 2)]
    a, b = (np.concatenate(side) for side in zip(*parts))
    assert dict(zip(*map(np.ndarray.tolist, fp.forest(a, b)))) == whole


def test_every_variant_is_in_one_block():
    values = np.array(family(9, 3), np.uint64)
    seen = []
    for variants, owners in fp.blocks(values, 0, 0, 2, most=500):
        seen += [int(values[o]) for o in owners]
        assert len(variants) <= 500
    counts = {v: seen.count(v) for v in set(values.tolist())}
    assert set(counts.values()) <= {2081 * k for k in range(1, 4)}
