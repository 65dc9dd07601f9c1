"""N-gram Jaccard join by universe partition.

Sets of word n-grams link when their Jaccard similarity reaches a threshold, which is the same as a bound on
what the two do not share: `J >= t` where `|A xor B| <= (1 - t) / (1 + t) * (|A| + |B|)`. The universe of n-grams is
hashed into segments, more of them for larger sizes, so a set falls into segment subsets. Every set is indexed in the
segmentation of its own size band: each subset, and for small sets each subset with one n-gram deleted. A set
looks for partners of at most its size in the one or two bands they can be in, with as many units as could differ,
plus one: a segment looked up as it is counts one unit, and looked up with its one-deletion neighbours as well
counts two. Whatever differs, some unit must agree (pigeonhole), so no link is lost. Units are allocated
by cost, an estimate of how many sets share the subset, which steers around passages that many documents share.
Sets of one size class so small that units might not suffice take every n-gram as a segment.

Equal sets are one class throughout. Of sets that share a signature each is first verified with one other, the
leader, so near copies join. Sets that met under one leader and are not all joined are compared further, in tiles: the
sets that look up and those that are indexed are cut into blocks of bounded size, and a tile compares two blocks.
Sketches that never overstate a difference leave the pairs that may link; those are verified on the whole sets in the
order of their difference, as long as their ends are not joined yet. So pairs never leave a task: links do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from fractions import Fraction
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kglake.llm import components as cc
from kglake.llm import shared

U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
COST_BITS = 17
BAND_RATIO = Fraction(4, 3)
SINGLE_SIZE = 64
DELETION_SIZE = 256
# n-grams per segment at the lower end of a band.
SEGMENT_LOAD = 1.75
CHUNK_ENTRIES = 700_000
BUCKET_ENTRIES = 2_000_000
# A signature that more sets may share is spread: its index entries are dealt to parts, its lookups go to all parts.
SPREAD_SETS = 500_000
# Blocks of a tile: at most about so many sets and so many n-grams.
BLOCK_SETS = 1024
BLOCK_GRAMS = 1_000_000
PAIRS_AT_ONCE = 1 << 18
# Bits of the filter of wanted texts, 8 MB.
FILTER_BITS = 1 << 26
# 64-bit names of 10 ** 11 different sets clash about 300 times.
CLASHES = 100_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: equal inputs only have equal outputs."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


_powers = {"up": np.ones(1, U), "down": np.ones(1, U)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["up"]) < n:
        size = max(n, 2 * len(_powers["up"]), 1 << 16)
        with np.errstate(over="ignore"):
            _powers["up"] = np.cumprod(np.concatenate([[U(1)], np.full(size - 1, BASE)]), dtype=U)
            _powers["down"] = np.cumprod(np.concatenate([[U(1)], np.full(size - 1, BASE_INVERSE)]), dtype=U)
    return _powers["up"], _powers["down"]


def shingles(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct n-grams of words of a whole text, lower-case in A-Z.

    With fewer words the whole sequence is one n-gram; without words there is none. A hash covers the
    words' bytes with one space between words.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, U)
    line = np.frombuffer(b" ".join(words), np.uint8)
    up, down = powers(len(line) + 1)
    sums = np.zeros(len(line) + 1, U)
    np.cumsum((line.astype(U) + U(1)) * up[:len(line)], dtype=U, out=sums[1:])
    ends = np.append(np.flatnonzero(line == 32), len(line))
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = max(1, len(words) - n + 1)
    first, last = starts[:k], ends[min(n, len(words)) - 1:][:k]
    hashes = mixed((sums[last] - sums[first]) * down[first] + U(0x632BE59BD9B4E019) * (last - first).astype(U))
    return np.unique(hashes)


def set_id(hashes: np.ndarray, clashing: frozenset[int] = frozenset()) -> int:
    """One 64-bit name for a set, from the sum and the size of its hashes.

    Names in `clashing`, which different sets share, are told apart by a second sum.
    """
    total = np.add.reduce(mixed(hashes ^ U(0xD6E8FEB86659FD93)), dtype=U)
    name = int(mixed(np.array([total ^ U(len(hashes))], U)).view(np.int64)[0])
    if name in clashing:
        return int(mixed(np.array([name, second_id(hashes)], np.int64).view(U)).sum(dtype=U).view(np.int64))
    return name


def second_id(hashes: np.ndarray) -> int:
    """Another 64-bit name, independent of the first: together they tell sets apart."""
    return int(np.add.reduce(mixed(hashes * U(0x9FB21C651E98DF25) ^ U(0xC2B2AE3D27D4EB4F)), dtype=U).view(np.int64))


def text_id(text: Column) -> Column:
    """One 64-bit name for a text, whatever id its row has; who fetches a text by it checks the text's set."""
    return F.xxhash64(text)


class Bands:
    """Size bands and what may differ between sets, for one threshold."""

    def __init__(self, threshold: Fraction):
        self.t = threshold
        self.low = [1]
        self.differ = (1 - threshold) / (1 + threshold)

    def of(self, size: int) -> int:
        while self.low[-1] <= size:
            self.low.append(max(self.low[-1] + 1, math.ceil(self.low[-1] * BAND_RATIO)))
        at = int(np.searchsorted(self.low, size, "right")) - 1
        return at

    @cache
    def segments(self, band: int) -> int:
        """Number of segments of a band; 0 stands for one segment per n-gram.

        Segments must outnumber what may differ: for thresholds so low that they might not, n-grams stand alone.
        """
        low, high = self.low[band], self.low[band + 1] - 1
        m = math.ceil(low / SEGMENT_LOAD)
        if low <= SINGLE_SIZE:
            return 0
        for size in (low, high, math.floor(high / self.t)):
            filled = m * (1 - math.exp(-size / m))
            units = math.floor(self.differ * (size + min(size, high))) + 1
            if units > 0.9 * filled:
                return 0
        return m

    @cache
    def lookups(self, size: int) -> list[tuple[int, int]]:
        """`(band, units)` of where a set of this size looks for sets of at most its size."""
        least = math.ceil(self.t * size)
        own, found = self.of(size), []
        for band in range(self.of(least), own + 1):
            largest = min(size, self.low[band + 1] - 1) if band < own else size
            found.append((band, math.floor(self.differ * (size + largest)) + 1))
        return found


def _subsets(hashes: np.ndarray, cost: np.ndarray, m: int, band: int, deletions: bool):
    """Subset signatures of a set in a band's segments, their costs and, if asked, one-deletion neighbours.

    Returns `(signature, cost, deletion signature, its own cost, owner of each deletion, cost of each owner's deletions)`. The cost
    of a signature, the sets that hold its rarest n-gram, is the same for all sets that have the signature.
    """
    salt = mixed(np.array([band + 1], U))[0]
    token_cost = cost[(hashes >> U(64 - COST_BITS)).astype(np.int64)]
    if m == 0:
        return mixed(hashes ^ U(0xA0761D6478BD642F)), token_cost, np.empty(0, U), np.empty(0), np.empty(0, np.int64), None
    segment = (mixed(hashes ^ salt) % U(m)).astype(np.int64)
    order = np.lexsort((token_cost, segment))
    segment, token, price = segment[order], mixed(hashes[order] ^ U(0xE7037ED1A0B428DB)), token_cost[order]
    starts = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]]))
    sizes = np.diff(np.append(starts, len(segment)))
    sums = np.add.reduceat(token, starts)
    names = mixed(segment[starts].astype(U) + salt)
    own = price[starts]
    signature = mixed(sums + names)
    if not deletions:
        return signature, own, np.empty(0, U), np.empty(0), np.empty(0, np.int64), None
    owner = np.repeat(np.arange(len(starts)), sizes)
    many = sizes[owner] > 1
    deleted = mixed(sums[owner] - token + names[owner])[many]
    second = price[np.minimum(starts + 1, len(price) - 1)]
    deletion_cost = np.where(sizes > 1, (sizes - 1) * own + second, np.inf)
    is_first = np.zeros(len(token), bool)
    is_first[starts] = True
    left = np.where(is_first, second[owner], own[owner])[many]
    return signature, own, deleted, left, owner[many], deletion_cost


def spread(signature: np.ndarray, role: np.ndarray, cost: np.ndarray, name: int) -> tuple[np.ndarray, np.ndarray]:
    """Entries whose signature very many sets may share, in parts: an index entry goes to one part, by its set, a lookup to all."""
    parts = np.maximum(1, np.ceil(cost / SPREAD_SETS)).astype(np.int64)
    if not (parts > 1).any():
        return signature, role
    owner = np.repeat(np.arange(len(parts)), parts)
    part = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
    own = part == int(name) % parts[owner]
    kept = np.where(own, role[owner], role[owner] & 2).astype(np.int8)
    salted = np.where(parts[owner] > 1, mixed(signature[owner] + mixed(part.astype(U) + U(1))), signature[owner])
    return salted[kept > 0], kept[kept > 0]


def signatures(hashes: np.ndarray, cost: np.ndarray, bands: Bands, name: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """`(signature, role)` of a set: role bit 1 is an index entry, bit 2 a lookup."""
    size, out, roles, costs = len(hashes), [], [], []
    own_band = bands.of(size)
    for band, units in bands.lookups(size):
        m = bands.segments(band)
        deletions = 0 < m and bands.low[band] <= DELETION_SIZE
        if band != own_band and m == 0 and bands.segments(own_band) == 0:
            continue  # every band of single n-grams has the same signatures
        signature, price, deleted, deleted_price, owner, deletion_price = _subsets(hashes, cost, m, band, deletions)
        # Units in the order of their cost; ties by signature, so that the choice is a function of the set.
        prices = price if deletion_price is None else np.concatenate([price, deletion_price])
        tie = np.concatenate([signature, signature]) if deletion_price is not None else signature
        units = min(units, len(signature)) if m == 0 else units  # all n-grams of a set miss no link
        usable = np.lexsort((tie, np.arange(len(prices)) >= len(price), prices))[:units]
        if len(usable) < units or not np.isfinite(prices[usable]).all():
            # Fewer n-gram groups than differences: reached with a chance below 1e-18 at these loads.
            raise RuntimeError(f"a set of {size} n-grams has too few segments in band {band}")
        looked = np.zeros(len(signature), np.int8)
        looked[usable[usable < len(price)]] = 2
        with_deletions = np.zeros(len(signature), bool)
        with_deletions[usable[usable >= len(price)] - len(price)] = True
        if band == own_band:
            out += [signature, deleted]
            roles += [looked | 1, np.where(with_deletions[owner], 3, 1).astype(np.int8)]
            costs += [price, deleted_price]
        else:
            some, chosen = looked == 2, with_deletions[owner]
            out += [signature[some], deleted[chosen]]
            roles += [looked[some], np.full(int(chosen.sum()), 2, np.int8)]
            costs += [price[some], deleted_price[chosen]]
    return spread(np.concatenate(out), np.concatenate(roles), np.concatenate(costs), name)


def sets_of(docs: DataFrame, n: int) -> tuple[DataFrame, DataFrame, frozenset[int]]:
    """`doc_id, n_shingles, set_id, text_id, sketch` of each row, stored, the number of sets per slot of n-grams, and the names that clashed.

    `text_id` is the `text_id` of the row's text. A task gives the `sketch` of a set with the first of its rows only.
    """
    schema = "doc_id long, n_shingles long, set_id long, second long, text_id long, sketch binary, slot int, sets long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots, seen = np.zeros(1 << COST_BITS, np.int64), set()
        names = ["doc_id", "n_shingles", "set_id", "second", "text_id", "sketch", "slot", "sets"]
        kinds = [pa.int64()] * 5 + [pa.binary(), pa.int32(), pa.int64()]
        for batch in batches:
            sizes, ids, seconds, sketches = [], [], [], []
            for text in batch.column(1).to_pylist():
                hashes = shingles(text, n)
                sizes.append(len(hashes))
                ids.append(set_id(hashes))
                seconds.append(second_id(hashes))
                known = (ids[-1], seconds[-1]) in seen
                sketches.append(None if known else sketch(hashes))
                seen.add((ids[-1], seconds[-1]))
                slots += np.bincount((hashes >> U(64 - COST_BITS)).astype(np.int64), minlength=len(slots)) if len(
                    hashes) > 20_000 else 0
                if len(hashes) <= 20_000:
                    np.add.at(slots, (hashes >> U(64 - COST_BITS)).astype(np.int64), 1)
            none = pa.nulls(len(sizes))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, kinds[1]), pa.array(ids, kinds[2]), pa.array(seconds, kinds[3]), batch.column(2),
                 pa.array(sketches, kinds[5]), none.cast(kinds[6]), none.cast(kinds[7])], names=names)
        some = np.flatnonzero(slots)
        none = [pa.nulls(len(some)).cast(kind) for kind in kinds[:6]]
        yield pa.RecordBatch.from_arrays([*none, pa.array(some, kinds[6]), pa.array(slots[some], kinds[7])], names=names)

    rows = shared.stored(docs.select("doc_id", "text", text_id(F.col("text")).alias("text_id")).mapInArrow(run, schema), "sets")
    sets = rows.where("slot is null")
    twice = sets.groupBy("set_id").agg(F.min("second").alias("x"), F.max("second").alias("y")).where("x <> y").select("set_id")
    clashing = [r[0] for r in twice.limit(CLASHES + 1).collect()]
    if len(clashing) > CLASHES:
        raise RuntimeError("more names of sets clash than any number of documents explains")
    if clashing:
        told = F.udf(lambda name, second: int(mixed(np.array([name, second], np.int64).view(U)).sum(dtype=U).view(np.int64)), "long")
        own = F.when(F.col("set_id").isin(clashing), told("set_id", "second")).otherwise(F.col("set_id"))
        sets = sets.withColumn("set_id", own)
    return (sets.select("doc_id", "n_shingles", "set_id", "text_id", "sketch"),
            rows.where("slot is not null").groupBy("slot").agg(F.sum("sets").alias("sets")), frozenset(clashing))


def indexed(docs: DataFrame, n: int, bands: Bands, cost, buckets: int, clashing: frozenset[int] = frozenset()) -> DataFrame:
    """Signatures of all sets as rows `bucket, signatures, sets, sizes, counts` of packed numbers.

    A task emits each set once, however many of its rows hold it.
    """
    schema = "bucket int, signatures binary, sets binary, sizes binary, counts binary"
    names = [field.split()[0] for field in schema.split(", ")]

    def packed(entries: list) -> pa.RecordBatch:
        signature = np.concatenate([e[0] for e in entries])
        role = np.concatenate([e[1] for e in entries])
        who = np.repeat(np.arange(len(entries)), [len(e[0]) for e in entries])
        bucket = (signature % U(buckets)).astype(np.int64)
        order = np.lexsort((who, bucket))
        signature, role, who, bucket = signature[order], role[order], who[order], bucket[order]
        ids = np.array([e[2] for e in entries], np.int64)
        sizes = np.array([e[3] for e in entries], np.int32)
        rows = []
        edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            members, counts = np.unique(who[a:b], return_counts=True)
            # Two bits of role and 38 of signature: enough to tell those of a bucket apart, as equal ones are verified.
            short = ((signature[a:b] // U(buckets)) << U(2) | role[a:b].astype(U)).view(np.uint8).reshape(-1, 8)[:, :5]
            rows.append((int(bucket[a]), short.tobytes(), ids[members].tobytes(), sizes[members].tobytes(),
                         counts.astype(np.int32).tobytes()))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(c), kind) for c, kind in zip(zip(*rows), (pa.int32(), *[pa.binary()] * 4))], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        price, seen, entries, total = cost.value, set(), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                hashes = shingles(text, n)
                if not len(hashes):
                    continue
                name = set_id(hashes, clashing)
                if name in seen:
                    continue
                seen.add(name)
                signature, role = signatures(hashes, price, bands, name)
                entries.append((signature, role, name, len(hashes)))
                total += len(signature)
                if total >= CHUNK_ENTRIES:
                    yield packed(entries)
                    entries, total = [], 0
        if entries:
            yield packed(entries)

    return docs.select("text").mapInArrow(run, schema)


def bucket_candidates(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Pairs `(a, b)` of a bucket to verify first, and its cells `(leader, set, size, roles)` for later.

    A set is first tried with the smallest name, the leader, of the largest group it is in. A cell holds the sets of
    all groups that a leader has here, so the sets of any two entries of a signature are in one cell.
    """
    parts = {name: b"".join(table.column(name).to_pylist()) for name in ("signatures", "sets", "sizes", "counts")}
    raw = np.frombuffer(parts["signatures"], np.uint8).reshape(-1, 5)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, :5] = raw
    signature = wide.view(U).reshape(-1)
    role, signature = (signature & U(3)).astype(np.int8), signature >> U(2)
    counts = np.frombuffer(parts["counts"], np.int32)
    ids = np.repeat(np.frombuffer(parts["sets"], np.int64), counts)
    sizes = np.repeat(np.frombuffer(parts["sizes"], np.int32), counts).astype(np.int64)
    order = np.lexsort((ids, signature))
    signature, ids, sizes, role = signature[order], ids[order], sizes[order], role[order]
    # A set may carry a signature more than once, here or from several tasks: its roles are joined.
    new = np.concatenate([[True], (signature[1:] != signature[:-1]) | (ids[1:] != ids[:-1])])
    starts = np.flatnonzero(new)
    role = np.bitwise_or.reduceat(role, starts)
    signature, ids, sizes = signature[starts], ids[starts], sizes[starts]
    edges = np.flatnonzero(np.concatenate([[True], signature[1:] != signature[:-1], [True]]))
    first, length = edges[:-1], np.diff(edges)
    looked = np.bitwise_or.reduceat(role, first) & 2
    # Groups of the same sets in the same roles, as near copies make by the hundred, are one.
    names = np.add.reduceat(mixed(ids.view(U) ^ mixed(role.astype(U) + U(1))), first)
    large = np.flatnonzero((length > 1) & (looked > 0))
    large = large[np.unique(names[large], return_index=True)[1]]
    span = length[large]
    at = np.repeat(first[large] - np.concatenate([[0], np.cumsum(span)[:-1]]).astype(np.int64), span) + np.arange(span.sum())
    leader = np.repeat(ids[first[large]], span)
    best = np.lexsort((leader, -np.repeat(span, span), ids[at]))
    best = best[np.unique(ids[at][best], return_index=True)[1]]
    stars = np.stack([leader[best], ids[at][best]], 1)
    # All groups of a leader are one cell: a set is in it once, with all its roles.
    order = np.lexsort((ids[at], leader))
    leader, at = leader[order], at[order]
    new = np.flatnonzero(np.concatenate([[True], (leader[1:] != leader[:-1]) | (ids[at][1:] != ids[at][:-1])])) if len(at) else at
    roles = np.bitwise_or.reduceat(role[at], new) if len(at) else at
    at, leader = at[new], leader[new]
    cells = np.stack([leader, ids[at], sizes[at], roles.astype(np.int64)], 1)
    return np.unique(stars[stars[:, 0] != stars[:, 1]], axis=0), cells


CANDIDATES = "a long, b long, leader long, size long, role long"


def candidates(index: DataFrame, parts: int) -> DataFrame:
    """`a, b` pairs with null `leader`, and `leader, a, size, role` rows of cells, all distinct.

    Sets that are near each other meet in many buckets. A bucket's pairs and cells leave it packed, one row for each part of those to
    be made distinct.
    """
    schema = "cell boolean, part int, rows binary"

    def whole(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        out = []
        for is_cell, rows in zip((False, True), bucket_candidates(table)):
            part = (mixed(rows[:, 0].astype(U) + mixed(rows[:, 1].astype(U))) % U(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                if len(some):
                    out.append((is_cell, int(part[some[0]]), rows[some].astype(np.int64).tobytes()))
        return pa.table([pa.array([r[k] for r in out], kind) for k, kind in enumerate((pa.bool_(), pa.int32(), pa.binary()))],
                        names=["cell", "part", "rows"])

    def distinct(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(table.column("rows").to_pylist()), np.int64)
        names = ["a", "b", "leader", "size", "role"]
        if not key[0].as_py():
            rows = np.unique(rows.reshape(-1, 2), axis=0)
            columns = {"a": rows[:, 0], "b": rows[:, 1]}
        else:
            rows = rows.reshape(-1, 4)
            rows = rows[np.lexsort((rows[:, 1], rows[:, 0]))]
            new = np.flatnonzero(np.concatenate([[True], (rows[1:, :2] != rows[:-1, :2]).any(1)]))
            columns = {"leader": rows[new, 0], "a": rows[new, 1], "size": rows[new, 2], "role": np.bitwise_or.reduceat(rows[:, 3], new)}
        n = len(columns["a"])
        return pa.table([pa.array(np.ascontiguousarray(columns[c])) if c in columns else pa.nulls(n, pa.int64()) for c in names], names=names)

    packed = index.groupBy("bucket").applyInArrow(whole, schema)
    return packed.groupBy("cell", "part").applyInArrow(distinct, CANDIDATES)


def sketch(hashes: np.ndarray) -> bytes:
    """Parities of the n-grams in as many bits as at least twice their number: two sketches, the longer one
    folded, differ in at most as many bits as their sets in n-grams."""
    bits = 1 << max(8, (2 * len(hashes) - 1).bit_length())
    at = np.bincount((mixed(hashes) & U(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(at.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: list[bytes], words: int) -> np.ndarray:
    """Sketches, each of at least `words` 64-bit words, folded to that length."""
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(x, U).reshape(-1, words), 0) for x in sketches])


def close_pairs(left: dict, right: dict, t: Fraction) -> np.ndarray:
    """`(i, j, difference)` of pairs that may link: of `left` and `right`, which hold arrays `root` and `size` and a list `sketch`.

    Pairs have different roots, a right size of at most the left one and of at least its share, and sketches
    that allow the threshold.
    """
    found = [np.empty((0, 3), np.int64)]
    words = [np.array([len(x) // 8 for x in side["sketch"]], np.int64) for side in (left, right)]
    for a in np.unique(words[0]).tolist():
        for b in np.unique(words[1]).tolist():
            some = [np.flatnonzero(w == k) for w, k in zip(words, (a, b))]
            x, y = (folded([side["sketch"][k] for k in at.tolist()], min(a, b)) for side, at in zip((left, right), some))
            (size_x, root_x), (size_y, root_y) = ((side["size"][at], side["root"][at]) for side, at in zip((left, right), some))
            step = max(1, PAIRS_AT_ONCE // max(1, len(y)))
            for k in range(0, len(x), step):
                part = size_x[k:k + step, None]
                i, j = np.nonzero((root_x[k:k + step, None] != root_y) & (size_y <= part) & (size_y * t.denominator >= part * t.numerator))
                for cut in range(0, len(i), PAIRS_AT_ONCE):
                    p, q = i[cut:cut + PAIRS_AT_ONCE] + k, j[cut:cut + PAIRS_AT_ONCE]
                    differ = np.bitwise_count(x[p] ^ y[q]).sum(1, dtype=np.int64)
                    keep = differ * (t.denominator + t.numerator) <= (size_x[p] + size_y[q]) * (t.denominator - t.numerator)
                    found.append(np.stack([some[0][p[keep]], some[1][q[keep]], differ[keep]], 1))
    return np.concatenate(found)


def linked(x: np.ndarray, y: np.ndarray, t: Fraction) -> bool:
    """Whether two sorted sets reach the threshold."""
    at = np.searchsorted(y, x)
    both = int((y[np.minimum(at, len(y) - 1)] == x).sum()) if len(y) else 0
    return t.denominator * both >= t.numerator * (len(x) + len(y) - both)


TILE = ["leader", "left_block", "right_block"]


def tiled(cells: DataFrame) -> DataFrame:
    """Rows of `cells` (`leader, set_id, size, role, root`) as `leader, left_block, right_block, side, set_id, size, root`.

    Sets that look up are the left side, indexed ones the right side. A component with many sets of a cell has blocks of its own; tiles
    of one component alone are left out. Blocks follow counts, so no cell is ever gathered in a task.
    """
    sides = cells.select("leader", "set_id", "size", "root", F.explode(F.array(
        F.when(F.col("role").bitwiseAND(F.lit(2)) > 0, F.lit(0)), F.when(F.col("role").bitwiseAND(F.lit(1)) > 0, F.lit(1)))).alias(
        "side")).where("side is not null")
    load = F.greatest(F.count(F.lit(1)) / BLOCK_SETS, F.sum("size") / BLOCK_GRAMS)
    roots = sides.groupBy("leader", "side", "root").agg(load.alias("load")).withColumn("alone", F.col("load") >= 0.5)
    rest = roots.where("not alone").groupBy("leader", "side").agg(F.greatest(F.lit(1), F.ceil(F.sum("load"))).alias("rest"))
    placed = roots.join(rest, ["leader", "side"], "left").select(
        "leader", "side", "root", "alone", F.when(F.col("alone"), F.ceil("load")).otherwise(F.col("rest")).alias("parts"))
    spread_sets = sides.join(placed, ["leader", "side", "root"])
    # Two blocks of one name are one block, which costs time only.
    block = F.when(F.col("alone"), F.xxhash64("root", F.pmod(F.xxhash64("set_id"), "parts"))).otherwise(
        F.pmod(F.xxhash64("root"), "parts"))
    named = shared.stored(spread_sets.select("leader", "side", "set_id", "size", "root", F.when(F.col("alone"), F.col("root")).alias(
        "only"), block.alias("block")), "blocks")
    blocks = named.groupBy("leader", "side", "block").agg(F.min("only").alias("low"), F.max("only").alias("high"), F.count("only").alias(
        "known"), F.count(F.lit(1)).alias("n"))
    one = F.when((F.col("known") == F.col("n")) & (F.col("low") == F.col("high")), F.col("low"))
    left, right = (blocks.where(F.col("side") == k).select("leader", F.col("block").alias(f"{name}_block"), one.alias(f"{name}_root"))
                   for k, name in ((0, "left"), (1, "right")))
    tiles = shared.stored(left.join(right, "leader").where(
        "left_root is null or right_root is null or left_root <> right_root").select(*TILE), "tiles")
    rows = [named.where(F.col("side") == k).withColumnRenamed("block", f"{name}_block").join(tiles, ["leader", f"{name}_block"]).select(
        *TILE, "side", "set_id", "size", "root") for k, name in ((0, "left"), (1, "right"))]
    return rows[0].unionByName(rows[1])


def _sides(table: pa.Table) -> list[dict]:
    """The two sides of a tile, with their columns as arrays and lists."""
    side, out = np.asarray(table.column("side")), []
    for k in (0, 1):
        some = table.filter(pa.array(side == k))
        out.append({name: some.column(name).to_pylist() if name in ("sketch", "text") else np.asarray(some.column(name))
                    for name in some.column_names})
    return out


def may_link(tiles: DataFrame, sketches: DataFrame, t: Fraction) -> DataFrame:
    """Those rows of `tiles` that have a partner in their tile by their sketches."""
    columns = [*TILE, "side", "set_id", "size", "root"]

    def compare(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        pairs = close_pairs(*_sides(table), t)
        side = np.asarray(table.column("side"))
        rows = [np.flatnonzero(side == k)[np.unique(pairs[:, k])] for k in (0, 1)]
        return table.select(columns).take(pa.array(np.concatenate(rows)))

    schema = "leader long, left_block long, right_block long, side int, set_id long, size long, root long"
    return tiles.join(sketches, "set_id").select(*columns, "sketch").groupBy(*TILE).applyInArrow(compare, schema)


def verified_tiles(tiles: DataFrame, texts: DataFrame, n: int, t: Fraction) -> DataFrame:
    """Links `a, b` between set ids that join all sets of a tile that are reachable from each other in it."""
    def verify(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        left, right = _sides(table)
        hashes = [[shingles(text, n) for text in side["text"]] for side in (left, right)]
        for side, known in zip((left, right), hashes):
            side["sketch"] = [sketch(x) for x in known]
        pairs = close_pairs(left, right, t)
        share = pairs[:, 2] / np.maximum(1, left["size"][pairs[:, 0]] + right["size"][pairs[:, 1]])
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.get(x, x) != x:
                parent[x] = x = parent.get(parent[x], parent[x])
            return x

        roots, names, links = (left["root"].tolist(), right["root"].tolist()), (left["set_id"], right["set_id"]), []
        for i, j, _ in pairs[np.argsort(share, kind="stable")].tolist():
            x, y = root(roots[0][i]), root(roots[1][j])
            if x != y and linked(hashes[0][i], hashes[1][j], t):
                parent[max(x, y)] = min(x, y)
                links.append((int(names[0][i]), int(names[1][j])))
        return pa.table([pa.array([k[side] for k in links], pa.int64()) for side in (0, 1)], names=["a", "b"])

    return tiles.join(texts, "set_id").groupBy(*TILE).applyInArrow(verify, "a long, b long")


def likely(pairs: DataFrame, sketches: DataFrame, t: Fraction) -> DataFrame:
    """Those of `pairs` (`a, b`) whose sketches allow the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [np.asarray(batch.column(c)) for c in (2, 3)]
            keep = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(*(batch.column(c).to_pylist() for c in (4, 5)))):
                words = min(len(x), len(y)) // 8
                differ = int(np.bitwise_count(folded([x], words) ^ folded([y], words)).sum())
                keep[k] = differ * (t.denominator + t.numerator) <= int(sizes[0][k] + sizes[1][k]) * (t.denominator - t.numerator)
            yield batch.select(["a", "b"]).filter(pa.array(keep))

    one, other = (sketches.select(F.col("set_id").alias(c), F.col("size").alias(f"size_{c}"), F.col("sketch").alias(f"sketch_{c}"))
                  for c in "ab")
    return pairs.join(one, "a").join(other, "b").select("a", "b", "size_a", "size_b", "sketch_a", "sketch_b").mapInArrow(
        run, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame, n: int, t: Fraction) -> DataFrame:
    """Those of `pairs` (`a, b`, set ids) whose whole sets reach the threshold; `texts` has `set_id, text`."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            known: dict[int, np.ndarray] = {}
            a, b, text_a, text_b = (c.to_pylist() for c in batch.columns)
            for name, text in zip(a + b, text_a + text_b):
                if name not in known:
                    known[name] = shingles(text, n)
            keep = [k for k in range(len(a)) if linked(known[a[k]], known[b[k]], t)]
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    sided = pairs.join(texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a")), "a").join(
        texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b")), "b")
    return sided.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def texts_of(docs: DataFrame, wanted: DataFrame, n: int, clashing: frozenset[int]) -> DataFrame:
    """`set_id, text` of each set of `wanted` (`set_id, text_id`), from one of its texts.

    A bitmap of fixed size, from the wanted names, keeps most other texts out of the shuffle; the join decides.
    """
    words = wanted.select(F.pmod("text_id", F.lit(FILTER_BITS)).alias("bit")).groupBy(F.expr("bit div 64").alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("bit") % 64).cast("int"))).alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 64, np.int64)  # as many words at most, whatever the table
    bits[np.asarray(words.column("word"))] = np.asarray(words.column("bits"))
    shared_bits = docs.sparkSession.sparkContext.broadcast(bits)

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = shared_bits.value, set()
        for batch in batches:
            names = np.asarray(batch.column(0))
            bit = names % FILTER_BITS
            hit = np.flatnonzero(known[bit // 64] >> (bit % 64) & 1)
            keep = [k for k in hit.tolist() if names[k] not in seen and not seen.add(names[k])]  # copies of a text in one task go
            yield batch.take(pa.array(keep, pa.int64()))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = [set_id(shingles(text, n), clashing) == name for name, text in zip(names, texts)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    each = docs.where("text is not null").select(text_id(F.col("text")).alias("text_id"), "text").mapInArrow(first, "text_id long, text string")
    found = each.join(wanted, "text_id").select("set_id", "text").mapInArrow(own, "set_id long, text string")
    return shared.stored(found.dropDuplicates(["set_id"]), "texts")


def similar_sets(docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(3, 4)) -> tuple[DataFrame, DataFrame]:
    """`(doc_id, n_shingles, set_id, text_id, sketch)` of each row and the verified links `(a, b)` between set ids.

    The links join all sets that are reachable from each other; pairs within what is already joined are not
    spelt out. `threshold` is above 0 and at most 1.
    """
    bands = Bands(threshold)
    bands.of(1 << 31)
    sets, slots, clashing = sets_of(docs, n)
    cost = np.zeros(1 << COST_BITS)
    for slot, count in slots.collect():  # at most one row per slot, a fixed number
        cost[slot] = count
    spark = docs.sparkSession
    total = float(cost.sum())
    index = indexed(docs, n, bands, spark.sparkContext.broadcast(cost.astype(np.float32)),
                    max(1, math.ceil(total / BUCKET_ENTRIES)), clashing)
    found = shared.stored(candidates(index, int(spark.conf.get("spark.sql.shuffle.partitions"))), "candidates")
    pairs = found.where("leader is null").select("a", "b")
    cells = found.where("leader is not null").select("leader", F.col("a").alias("set_id"), "size", "role")
    # One text of each class stands for it, whatever ids its rows have.
    classes = sets.where("n_shingles > 0").groupBy("set_id").agg(F.min("text_id").alias("text_id"))
    named = found.select(F.col("a").alias("set_id")).union(pairs.select("b")).distinct()
    sketches = shared.stored(sets.where("sketch is not null").select("set_id", F.col("n_shingles").alias("size"), "sketch").join(
        named, "set_id", "left_semi").dropDuplicates(["set_id"]), "sketches")

    def texts(rows: DataFrame) -> DataFrame:
        """The texts of the sets of `rows` (`set_id`)."""
        return texts_of(docs, classes.join(rows.distinct(), "set_id"), n, clashing)

    stars = shared.stored(likely(pairs, sketches, threshold), "star-pairs")
    star_texts = texts(stars.select(F.col("a").alias("set_id")).union(stars.select("b")))
    stars = shared.stored(verified(stars, star_texts, n, threshold), "star-links")
    placed = cells.join(cc.components(stars).withColumnRenamed("node", "set_id"), "set_id", "left").select(
        "leader", "set_id", "size", "role", F.coalesce("root", "set_id").alias("root"))
    placed = shared.stored(placed, "cells")
    split = placed.groupBy("leader").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("leader")
    tiles = tiled(placed.join(split, "leader"))
    near = shared.stored(may_link(tiles, sketches.select("set_id", "sketch"), threshold), "near")
    return sets, stars.union(shared.stored(verified_tiles(near, texts(near.select("set_id")), n, threshold), "tile-links"))


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind)
    return isinstance(kind, T.MapType) or isinstance(kind, T.ArrayType) and _has_map(kind.elementType)


def survivors(docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(3, 4)) -> DataFrame:
    """`docs` with one row of each component: of its smallest id, or a null one if no row has another.

    Rows that share an id are told apart by their texts; of equal id and text the least in the other columns
    stays, maps compared as JSON. Rows without words are linked with nothing, so all of them stay. All columns are
    returned as they are, whatever their names.
    """
    name, second, row = shared.unused(docs.columns, "text_name", "second_name", "row")
    text = F.col("text").cast("string")
    sets, links = similar_sets(docs.select(F.col("doc_id").cast("long"), text.alias("text")), n, threshold)
    # By class first: partial minima keep a class of very many rows out of one task.
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_id"))
    classes = sets.where("n_shingles > 0").groupBy("set_id").agg(least.alias("row"))
    rooted = classes.join(cc.components(links).withColumnRenamed("node", "set_id"), "set_id", "left")
    first = rooted.groupBy(F.coalesce("root", "set_id")).agg(F.min("row").alias("row")).select(F.col("row.text_id").alias(name))
    doc_id = F.col("doc_id").cast("long")
    others = [F.to_json(F.struct(f.name)) if _has_map(f.dataType) else F.col(f.name) for f in docs.schema if f.name not in ("doc_id", "text")]
    order = F.struct(*[c.alias(f"k{k}") for k, c in enumerate([doc_id.isNull(), doc_id, *others])])
    words = F.coalesce(text.rlike(shared.WORD), F.lit(False))
    keyed = docs.where(words).withColumns({name: text_id(text), second: F.xxhash64(F.lit(1), text)})
    # With both names the texts stay where the grouping has put them.
    first = keyed.select(name, second).distinct().join(first, name, "left_semi")
    kept = keyed.groupBy(name, second).agg(F.min_by(F.struct(*docs.columns), order).alias(row)).join(first, [name, second], "left_semi")
    return kept.select(*[F.col(row)[c].alias(c) for c in docs.columns]).union(docs.where(~words))


def near_duplicates(docs: DataFrame, n: int = 5, threshold: Fraction = Fraction(3, 4)) -> DataFrame:
    """`doc_id, n_shingles, component_id` of each row of `docs` (`doc_id`, `text`; other columns are ignored).

    `component_id` is the smallest `doc_id` reachable by links. Null texts and texts without words have an empty
    set and are linked with nothing. Rows of a null id are linked like others; a component of such rows alone has
    a null id. Repeated rows count each. An empty table gives an empty result.
    """
    sets, links = similar_sets(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), n, threshold)
    least = sets.where("n_shingles > 0").groupBy("set_id").agg(F.min("doc_id").alias("least"))
    roots = cc.components(links).withColumnRenamed("node", "set_id")
    rooted = least.join(roots, "set_id", "left").select("set_id", "least", F.coalesce("root", "set_id").alias("root"))
    component = rooted.join(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "root").select(
        "set_id", "component_id")
    full = sets.where("n_shingles > 0").join(component, "set_id").select("doc_id", "n_shingles", "component_id")
    return full.union(sets.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))
