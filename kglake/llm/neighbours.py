"""Approximate nearest neighbours by balanced posting lists.

Vectors are put on lists around centroids; a vector near a boundary goes on each list whose centroid is nearly as
close as its nearest. Centroids are found by a search through a graph that links each with its nearest
others, held in memory by every task. A query reads the lists whose centroid is at most a ratio farther than its
nearest one; the ratio is fitted on the sample so that a stated share of true neighbours lies on those lists. Inner
products become distances by one more coordinate that gives all vectors one length.

The centroids, the graph and the ratio come from a bounded sample; every vector is on a list. Lists that
many vectors share are split at random into parts that are all read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kglake.llm import shared

SAMPLE = 20_000
SAMPLE_QUERIES = 400
LIST_SIZE = 200
REPLICAS = 6
REPLICA_RATIO = 1.06
DEGREE = 16
PART_VECTORS = 16_384
QUERY_BLOCK = 65_536
WANTED_SHARE = 0.96


def usable(vector: Column) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    values = F.transform(vector, lambda x: x.cast("double"))
    bad = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(values, lambda x: x != 0)


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (centers * centers).sum(1)[None, :] - 2 * (x @ centers.T)
    return np.sqrt(np.maximum(d, 1e-12))


class Lists:
    """Centroids with their graph, and the ratio up to which a query reads lists."""

    def __init__(self, centers: np.ndarray, longest: float):
        self.centers, self.longest, self.ratio = centers, longest, 1.0
        k = len(centers)
        near = np.argsort(_distances(centers, centers), axis=1, kind="stable")[:, :DEGREE + 1]
        ring = np.random.default_rng(7).permutation(k)
        follow = np.empty(k, np.int64)
        follow[ring] = np.roll(ring, -1)  # the ring keeps every centroid reachable
        self.links = np.concatenate([near, follow[:, None]], 1)
        self.entries = ring[:max(1, min(k, math.isqrt(k)))]

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Vectors with the coordinate that makes all of them `longest` long."""
        x = x.astype(np.float64)
        rest = np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(1), 0.0))
        return np.concatenate([x, rest[:, None]], 1)

    def query(self, q: np.ndarray) -> np.ndarray:
        q = q.astype(np.float64)
        norms = np.sqrt((q * q).sum(1, keepdims=True))
        return np.concatenate([q / norms * self.longest, np.zeros((len(q), 1))], 1)

    def search(self, x: np.ndarray, ratio: float) -> np.ndarray:
        """Distances to centroids, infinite where the walk through the graph did not find one within `ratio`.

        All rows walk at once: each step expands every row's nearest centroid not yet expanded, until that
        is farther than the ratio allows.
        """
        rows, k = np.arange(len(x)), len(self.centers)
        found = np.full((len(x), k), np.inf)
        found[:, self.entries] = _distances(x, self.centers[self.entries])
        waiting = found.copy()
        while len(rows):
            best = waiting[rows].argmin(1)
            at = waiting[rows, best]
            # Some slack past the ratio lets the walk pass over a ridge between near centroids.
            live = at <= found[rows].min(1) * (ratio + 0.02)
            rows, best = rows[live], best[live]
            if not len(rows):
                break
            waiting[rows, best] = np.inf
            to = self.links[best]
            gap = x[rows][:, None, :] - self.centers[to]
            d = np.sqrt(np.maximum((gap * gap).sum(2), 1e-12))
            fresh = np.isinf(np.take_along_axis(found[rows], to, 1))
            flat_rows, flat_to = np.repeat(rows, to.shape[1])[fresh.ravel()], to[fresh]
            found[flat_rows, flat_to] = d[fresh]
            waiting[flat_rows, flat_to] = d[fresh]
        return np.where(found <= found.min(1, keepdims=True) * ratio, found, np.inf)

    def homes(self, x: np.ndarray) -> list[np.ndarray]:
        """Lists of each vector: the nearest and, near a boundary, up to `REPLICAS` in all."""
        d = self.search(x, REPLICA_RATIO)
        order = np.argsort(d, axis=1, kind="stable")[:, :REPLICAS]
        kept = np.isfinite(np.take_along_axis(d, order, 1))
        return [o[k] for o, k in zip(order, kept)]


def fit(sample: np.ndarray, longest: float, lists: int, k: int) -> Lists:
    """Lists from a sample: k-means whose oversized clusters are halved and starved ones moved there."""
    rng = np.random.default_rng(11)
    probe = Lists(np.zeros((1, sample.shape[1] + 1)), longest)
    x = probe.lifted(sample)
    centers = x[rng.choice(len(x), min(lists, len(x)), replace=False)].copy()
    for turn in range(10):
        home = np.concatenate([_distances(part, centers).argmin(1) for part in np.array_split(x, math.ceil(len(x) / 4096))])
        size = np.bincount(home, minlength=len(centers))
        for c in np.flatnonzero(size):
            centers[c] = x[home == c].mean(0)
        if turn < 9:
            small, large = np.argsort(size, kind="stable"), np.argsort(-size, kind="stable")
            for a, b in zip(small, large):
                if size[b] <= 2 * len(x) / len(centers) or size[a] > 0.25 * len(x) / len(centers):
                    break
                centers[a] = x[rng.choice(np.flatnonzero(home == b))]
    found = Lists(np.unique(centers, axis=0), longest)
    asked = rng.choice(len(x), min(SAMPLE_QUERIES, len(x)), replace=False)
    scores = sample[asked].astype(np.float64) @ sample.astype(np.float64).T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :min(k, len(x) - 1)]
    d = _distances(found.query(sample[asked]), found.centers)
    d /= d.min(1, keepdims=True)
    unique, where = np.unique(best, return_inverse=True)
    homes = found.homes(x[unique]) if len(unique) else []
    where = where.reshape(best.shape)
    needed = [min(d[q][homes[where[q, j]]]) for q in range(len(asked)) for j in range(best.shape[1])]
    found.ratio = float(np.quantile(needed, WANTED_SHARE)) + 0.005 if needed else 10.0
    return found


def nearest(vectors: DataFrame, queries: Column, k: int = 20, id_column: str = "vec_id",
            vector_column: str = "embedding") -> DataFrame:
    """`query_id, rank, vec_id, score`: each query's `k` found neighbours of largest inner product, ties to smaller ids.

    Queries are the rows where `queries` holds, candidates all rows but the query's own id. Rows whose id or
    vector is null, whose vector is zero or holds null or non-finite components, or is not of the most
    frequent dimension (ties to the larger), take no part. Rows of one id count once, by their smallest
    vector. Scores are sums in double precision over the original vectors. Other columns are ignored; an
    empty table gives an empty result.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"),
                          F.col(vector_column).cast("array<float>").alias("v"), queries.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v"), F.max("asks").alias("asks"))
    rows = shared.stored(rows.withColumn("dim", F.size("v")), "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    dims = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate(
        "v", F.lit(0.0).cast("double"), lambda a, x: a + x.cast("double") * x.cast("double"))).alias("norm"),
        F.sum(F.col("asks").cast("long")).alias("q")).orderBy(F.desc("n"), F.desc("dim")).first()
    if dims is None or not dims["q"] or dims["n"] < 2:
        return empty
    rows = rows.where(F.col("dim") == dims["dim"]).select("vec_id", "v", "asks")
    total = dims["n"]
    sample = np.array([r[0] for r in rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()],
                      np.float32)
    lists = fit(sample, math.sqrt(dims["norm"]) * (1 + 1e-9), max(1, min(len(sample) // 10, total // LIST_SIZE)), k)
    model = spark.sparkContext.broadcast(lists)  # bounded by the sample

    def parts(batches: Iterator[pa.RecordBatch], asked: bool) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
        lists = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                x = np.asarray(part.column(1).flatten(), np.float32).reshape(part.num_rows, -1)
                if asked:
                    d = lists.search(lists.query(x), lists.ratio)
                    yield part, [np.flatnonzero(np.isfinite(row)) for row in d]
                else:
                    yield part, lists.homes(lists.lifted(x))

    def on_lists(spans: dict[int, tuple[int, int]] | None = None):
        """The lists of each vector or, given the first part and the number of parts of each list, the parts that each query reads."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, homes in parts(batches, spans is not None):
                if spans is not None:
                    homes = [read_parts(h, spans) for h in homes]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([h.tolist() for h in homes], pa.list_(pa.int32()))],
                    names=["vec_id", "v", "lists" if spans is None else "parts"])
        return run

    schema = "vec_id long, v array<float>, lists array<int>"
    posted = shared.stored(rows.select("vec_id", "v").mapInArrow(on_lists(), schema), "posted")
    # Lists fill parts of bounded size in turn; a list beyond that has parts of its own.
    sizes = dict(posted.select(F.explode("lists").alias("list")).groupBy("list").count().collect())
    spans, base, room = [], 0, PART_VECTORS
    for c in range(len(lists.centers)):
        n = sizes.get(c, 0)
        if n > PART_VECTORS:
            base += 1 if room < PART_VECTORS else 0
            count = math.ceil(n / PART_VECTORS)
            spans.append((c, base, count))
            base, room = base + count, PART_VECTORS
            continue
        if n > room:
            base, room = base + 1, PART_VECTORS
        spans.append((c, base, 1))
        room -= n
    table = F.broadcast(spark.createDataFrame(spans, "list int, base int, parts int"))  # a row per centroid
    # A query has a row per part, not per list: a part holds very many lists.
    asked = rows.where("asks").select("vec_id", "v").mapInArrow(
        on_lists({c: (base, count) for c, base, count in spans}), "vec_id long, v array<float>, parts array<int>")
    on_part = shared.stored(asked, "asked").select("vec_id", "v", F.explode("parts").alias("part"))
    # A part is copied for each block of the queries that read it, not of all; one that no query reads stays where it is.
    loads = shared.stored(on_part.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / QUERY_BLOCK).cast("int").alias("blocks")), "loads")
    asks = on_part.join(loads, "part").select("vec_id", "v", "part", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).cast("int").alias("block"))
    base_part = posted.select("vec_id", "v", F.explode("lists").alias("list")).join(table, "list").select(
        "vec_id", "v", (F.col("base") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).cast("int").alias("part"))
    data = base_part.join(loads, "part").distinct().select(
        "vec_id", "v", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        return best_of(left, right, k)

    found = data.groupBy("part", "block").cogroup(asks.groupBy("part", "block")).applyInArrow(
        score, "query_id long, vec_id long, score double")
    ranked = found.distinct().withColumn("rank", F.row_number().over(
        W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")).cast("int"))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def read_parts(lists: np.ndarray, spans: dict[int, tuple[int, int]]) -> np.ndarray:
    """The parts, each once, that hold `lists`."""
    return np.array(sorted({part for c in lists.tolist() for part in range(spans[c][0], sum(spans[c]))}), np.int32)


def best_of(data: pa.Table, asks: pa.Table, k: int) -> pa.Table:
    """Each query's `k` best of the vectors of a part, by exact scores and then ids."""
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    n, m = data.num_rows, asks.num_rows
    if not n or not m:
        return schema.empty_table()

    def matrix(table: pa.Table) -> np.ndarray:
        return np.asarray(table.column("v").combine_chunks().flatten(), np.float64).reshape(table.num_rows, -1)

    ids, x, asked, q = np.asarray(data.column("vec_id")), matrix(data), np.asarray(asks.column("vec_id")), matrix(asks)
    width = min(n, k + 13)
    out = []
    for at in range(0, m, 256):
        block, own = q[at:at + 256], asked[at:at + 256]
        rough = block @ x.T
        rough[own[:, None] == ids[None, :]] = -np.inf
        some = np.argpartition(-rough, width - 1, axis=1)[:, :width]
        # Products summed row by row give equal vectors equal scores wherever they lie.
        exact = (x[some] * block[:, None, :]).sum(2)
        exact[np.isneginf(np.take_along_axis(rough, some, 1))] = -np.inf
        order = np.lexsort((ids[some], -exact), axis=1)[:, :k]
        top, names = np.take_along_axis(exact, order, 1), np.take_along_axis(ids[some], order, 1)
        slack = 1e-9 * (1 + np.abs(np.take_along_axis(rough, some, 1)).max(1, where=np.isfinite(
            np.take_along_axis(rough, some, 1)), initial=0))
        edge = np.take_along_axis(rough, some, 1).min(1)
        for r in range(len(block)):
            if width < n and edge[r] >= top[r, -1] - slack[r]:  # as good as the last: more may be
                near = np.flatnonzero(rough[r] >= top[r, -1] - slack[r])
                values = (x[near] * block[r]).sum(1)
                pick = np.lexsort((ids[near], -values))[:k]
                top[r, :len(pick)], names[r, :len(pick)] = values[pick], ids[near][pick]
        good = np.isfinite(top)
        out.append(pa.table([np.repeat(own, top.shape[1]).reshape(top.shape)[good], names[good], top[good]], schema=schema))
    return pa.concat_tables(out)
