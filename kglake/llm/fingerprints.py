"""SimHash near-duplicates by meeting in the middle of Hamming balls.

Two fingerprints within radius r share a variant: a value within r / 2 of both. So every fingerprint stands for all its
variants within half the radius, variants meet, and fingerprints that meet are at most r apart. Variants are shuffled
by their leading bits: those of one fingerprint that go the same way travel as the fingerprint itself, once for each
leaf of a prefix tree that its ball touches, and are written out in the leaf's task, in blocks of bounded size. The
tree is deeper where fingerprints are dense, so a family of near copies is spread over many leaves.

All that share a variant are linked with each other, so one star per variant carries every link that it shows: pairs are
never spelt out within a group. Stars are deduplicated, verified by the differing bits and thinned to a forest.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kglake.llm import components as cc
from kglake.llm import shared

U = np.uint64
BITS = 64
SEED = 42
SHINGLE_WORDS = 4
# Prefix tree: a leaf with more fingerprints than this is split, down to the bits of the histogram.
LEAF_FINGERPRINTS = 4096
HISTOGRAM_BITS = 16
LEAST_DEPTH = 6
BLOCK_VARIANTS = 1 << 20


def fingerprint(text: str | None, n: int = SHINGLE_WORDS) -> int:
    """Majority of the bits of all shingles' hashes, repeats included; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    count = max(1, len(words) - n + 1)
    first, last = (ends - lengths)[:count].tolist(), ends[min(n, len(words)) - 1:][:count].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(line[a:b], SEED) for a, b in zip(first, last)), U, count)
    # Bits are counted eight at a time in the bytes of a word, over at most 255 hashes so that no byte overflows.
    padded = np.zeros(-(-count // 255) * 255, U)
    padded[:count] = hashes
    lanes = np.stack([np.add.reduce((padded.reshape(-1, 255) >> U(k)) & U(0x0101010101010101), axis=1) for k in range(8)])
    ones = lanes.view(np.uint8).reshape(8, -1, 8).sum(axis=1, dtype=np.int64)  # [bit of its byte, byte]
    return int(np.packbits((2 * ones > count).T.reshape(-1), bitorder="little").view(U)[0])


@cache
def flips(width: int, radius: int) -> np.ndarray:
    """All masks over the `width` lowest bits with at most `radius` bits set."""
    return np.array([sum(1 << b for b in bits) for r in range(min(radius, width) + 1)
                     for bits in combinations(range(width), r)], U)


def leaves(histogram: np.ndarray, most: int = LEAF_FINGERPRINTS) -> list[tuple[int, int]]:
    """`(prefix, depth)` of a prefix tree's leaves: all values, none twice. `histogram` counts leading bits."""
    deepest = len(histogram).bit_length() - 1
    found, open_nodes = [], [(0, 0)]
    while open_nodes:
        prefix, depth = open_nodes.pop()
        span = len(histogram) >> depth
        inside = histogram[prefix * span:(prefix + 1) * span].sum()
        if depth < deepest and (depth < LEAST_DEPTH or inside > most):
            open_nodes += [(2 * prefix, depth + 1), (2 * prefix + 1, depth + 1)]
        else:
            found.append((prefix, depth))
    return sorted(found)


def touched(values: np.ndarray, tree: list[tuple[int, int]], radius: int) -> Iterator[tuple[int, np.ndarray]]:
    """`(leaf number, positions of values)`: whose ball of `radius` reaches into the leaf."""
    for number, (prefix, depth) in enumerate(tree):
        apart = np.bitwise_count((values >> U(BITS - depth)) ^ U(prefix)) if depth else np.zeros(len(values), np.uint8)
        some = np.flatnonzero(apart <= radius)
        if len(some):
            yield number, some


def blocks(values: np.ndarray, prefix: int, depth: int, radius: int,
           most: int = BLOCK_VARIANTS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """`(variants, owner positions)` of all variants of `values` that begin with `prefix`, in blocks of bounded size.

    A block that would be larger is split by the next bit. At the last bit a block is one variant, which at
    most one fingerprint for each mask has.
    """
    waiting = [(prefix, depth, np.arange(len(values)))]
    while waiting:
        prefix, depth, who = waiting.pop()
        left = BITS - depth
        apart = np.bitwise_count((values[who] >> U(left)) ^ U(prefix)) if depth else np.zeros(len(who), np.uint8)
        who, apart = who[apart <= radius], apart[apart <= radius]
        if not len(who):
            continue
        masks = [flips(left, radius - spent) for spent in range(radius + 1)]
        total = sum(int((apart == spent).sum()) * len(mask) for spent, mask in enumerate(masks))
        if total > most and left:
            waiting += [(2 * prefix, depth + 1, who), (2 * prefix + 1, depth + 1, who)]
            continue
        low = values[who] & (U((1 << left) - 1) if left < BITS else ~U(0))
        variants, owners = [], []
        for spent, mask in enumerate(masks):
            some = np.flatnonzero(apart == spent)
            variants.append((low[some][:, None] ^ mask[None, :]).reshape(-1))
            owners.append(np.repeat(who[some], len(mask)))
        yield np.concatenate(variants), np.concatenate(owners)


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value with the least one reachable over the links `a - b`, where that is another."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[:len(a)], at[len(a):]
    root = np.arange(len(names))
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, root[x], low)
        np.minimum.at(root, root[y], low)
        while (root[root] != root).any():
            root = root[root]
        if (root == before).all():
            break
    other = np.flatnonzero(root != np.arange(len(names)))
    return names[other], names[root[other]]


def meetings(values: np.ndarray, prefix: int, depth: int, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A forest of the links that variants in one leaf show, `(fingerprint, smaller fingerprint)`."""
    values = np.unique(values)
    links, size = [np.empty((0, 2), U)], 0

    def thinned() -> np.ndarray:
        both = np.concatenate(links)
        return np.stack(forest(both[:, 0], both[:, 1]), 1)

    for variants, owners in blocks(values, prefix, depth, radius // 2):
        order = np.argsort(variants, kind="stable")
        variants, owners = variants[order], owners[order]
        same = np.concatenate([[False], variants[1:] == variants[:-1]])
        if not same.any():
            continue
        leader = np.minimum.reduceat(owners, np.flatnonzero(~same))[np.cumsum(~same) - 1]
        stars = np.unique(np.stack([values[owners], values[leader]], 1)[owners != leader], axis=0)
        links.append(stars[np.bitwise_count(stars[:, 0] ^ stars[:, 1]) <= radius])
        size += len(stars)
        if size > BLOCK_VARIANTS:
            links = [thinned()]
            size = len(links[0])
    found = thinned()
    return found[:, 0], found[:, 1]


def fingerprints(docs: DataFrame, n: int = SHINGLE_WORDS) -> DataFrame:
    """`doc_id, fp`, one row per row of `docs`, stored; `fp` is the fingerprint as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(text, n) for text in batch.column(1).to_pylist()), U, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")
    return shared.stored(rows, "fingerprints")


def links(found: DataFrame, radius: int = 4) -> DataFrame:
    """`a, b` (`fp` values) whose components are those of all pairs of `found` (`fp`) at most `radius` bits apart.

    `radius` is even, for it is split into two equal halves; an odd one raises.
    """
    if radius % 2:
        raise ValueError("the radius must be even: it is split into two equal halves")
    half = radius // 2
    distinct = shared.stored(found.select("fp").distinct(), "distinct-fingerprints")
    leading = F.shiftrightunsigned("fp", BITS - HISTOGRAM_BITS).cast("int")
    histogram = np.zeros(1 << HISTOGRAM_BITS, np.int64)
    for at, count in distinct.groupBy(leading.alias("at")).count().collect():  # at most one row per leading value
        histogram[at] = count
    tree = leaves(histogram)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.asarray(batch.column(0)).view(U)
            rows = [(number, values[some].tobytes()) for number, some in touched(values, tree, half)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()),
                                              pa.array([r[1] for r in rows], pa.binary())], names=["leaf", "fps"])

    def meet(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        values = np.frombuffer(b"".join(table.column("fps").to_pylist()), U)
        a, b = meetings(values, *tree[key[0].as_py()], radius)
        return pa.table([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    dealt = distinct.mapInArrow(deal, "leaf int, fps binary")
    return dealt.groupBy("leaf").applyInArrow(meet, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, radius: int = 4, n: int = SHINGLE_WORDS) -> DataFrame:
    """`doc_id, fingerprint, component_id` of each row of `docs` (`doc_id`, `text`; other columns are ignored).

    `fingerprint` has 16 hexadecimal digits. `component_id` is the smallest `doc_id` reachable by links. Null
    texts and texts without words have fingerprint zero, which links like any other. Rows of a null id are
    linked like others; a component of such rows alone has a null id. Repeated rows count each. Equal fingerprints are
    one throughout. An empty table gives an empty result.
    """
    found = fingerprints(docs, n)
    least = found.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = cc.components(links(found, radius)).withColumnRenamed("node", "fp")
    rooted = shared.stored(least.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")), "rooted")
    joined = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "component_id")
    return found.join(joined, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
