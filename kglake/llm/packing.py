"""Packing token sequences by non-negative least squares over the histogram of lengths.

A document's ids are cut into full windows, which need no partner, and a tail. All combinations of two or three
tail lengths that fill a window exactly are enumerated; non-negative least squares fits how often each
combination is used to the histogram of tail lengths. The counts are rounded, then the combinations are used
greedily, best fitted first, for what is left. Tails that find no partners are cut into powers of two, which in
falling order fill windows without gaps. The histogram has one entry per length below the window, so fitting does not
grow with the data; tails find their place by their rank among tails of one length, from counts per
partition and a prefix sum, so no length is gathered anywhere.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kglake.llm import shared, tokens

CUT_SCHEMA = ("doc_id long, doc_tokens long, part int, first_window long, window_crcs array<long>, tail int,"
              " tail_rank long, tail_crc long, block_crcs array<long>")
PIECE_SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long,"
                " offset long")
FIT_STEPS = 300


def cut_documents(docs: DataFrame, window: int, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """One row per document: checksums of its full windows, its tail and the tail's powers of two.

    `first_window` and `tail_rank` count windows, and tails of that length, before it in its partition.
    """
    path = tokenizer or tokens.default_path()
    end = np.array([end_id], np.uint32).tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, windows, ranks = TaskContext.get().partitionId(), 0, [0] * window
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), tokens.encoded(batch.column(1).to_pylist(), path)):
                ids += end
                n = len(ids) // 4
                full, tail = divmod(n, window)
                crcs = [zlib.crc32(ids[4 * window * k:4 * window * (k + 1)]) for k in range(full)]
                rest, blocks, at = ids[4 * window * full:], [], 0
                for bit in range(window.bit_length() - 2, -1, -1):
                    if tail >> bit & 1:
                        blocks.append(zlib.crc32(rest[4 * at:4 * (at + (1 << bit))]))
                        at += 1 << bit
                rows.append((doc_id, n, part, windows, crcs, tail, ranks[tail], zlib.crc32(rest), blocks))
                windows += full
                ranks[tail] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(column), kind) for column, kind in zip(zip(*rows) if rows else [()] * 9, (
                    pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.int64(),
                    pa.int64(), pa.list_(pa.int64())))],
                names=[field.split()[0] for field in CUT_SCHEMA.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, CUT_SCHEMA)


def combinations(window: int) -> np.ndarray:
    """Every pair and triple of lengths that fills the window, a length of 0 marking the unused third slot."""
    pairs = [(a, window - a, 0) for a in range((window + 1) // 2, window)]
    triples = [np.empty((0, 3), np.int64)]
    for a in range((window + 2) // 3, window - 1):
        b = np.arange(max(1, (window - a + 1) // 2), min(a, window - a - 1) + 1)
        triples.append(np.stack([np.full(len(b), a), b, window - a - b], 1))
    return np.concatenate([np.array(pairs, np.int64).reshape(-1, 3), *triples])


def fit_counts(histogram: np.ndarray, combos: np.ndarray) -> np.ndarray:
    """Non-negative least squares, by accelerated projected gradient: uses of each combination."""
    window = len(histogram)
    used = (combos > 0).astype(float)
    slots = combos.reshape(-1)

    def lengths(x):
        return np.bincount(slots, (used * x[:, None]).reshape(-1), window)[:window] * (np.arange(window) > 0)

    def correlate(r):
        return (r[combos] * used).sum(1)

    v = np.ones(len(combos))
    for _ in range(20):
        v = correlate(lengths(v))
        v /= np.linalg.norm(v) or 1.0
    step = 1.0 / max(1e-9, 1.05 * float(v @ correlate(lengths(v))))
    x = np.zeros(len(combos))
    y, t = x, 1.0
    for _ in range(FIT_STEPS):
        after = np.maximum(0.0, y - step * correlate(lengths(y) - histogram))
        t_after = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = after + (t - 1) / t_after * (after - x)
        x, t = after, t_after
    return x


def plan(histogram: np.ndarray) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray, int]:
    """Slots `(length, first rank, count, first sequence, offset)`, tails placed per length, sequences used."""
    window = len(histogram)
    combos = combinations(window)
    x = fit_counts(histogram.astype(float), combos)
    left = histogram.astype(np.int64).tolist()
    placed = [0] * window
    slots, sequences = [], 0
    order = np.argsort(-x, kind="stable").tolist()
    rounded = np.floor(x + 0.5).astype(np.int64).tolist()
    rows = combos.tolist()
    for limit in (rounded, None):
        for k in order:
            a, b, c = rows[k]
            need = [a, b] + ([c] if c else [])
            times = min(left[length] // need.count(length) for length in need)
            if limit is not None:
                times = min(times, limit[k])
            if times <= 0:
                continue
            offset = 0
            for length in need:
                slots.append((length, placed[length], times, sequences, offset))
                placed[length] += times
                left[length] -= times
                offset += length
            sequences += times
    return slots, np.array(placed, np.int64), sequences


def pack(docs: DataFrame, window: int = 1024, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """Pieces of all documents in sequences of at most `window` ids; `window` is a power of two.

    Each row of `docs` is a document, repeated rows included. Null and empty texts are the end id alone.
    Returns `doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`. Other columns are ignored,
    an empty table gives no pieces. Only the last window of power-of-two blocks can fall short; it is
    cut into sequences of powers of two.
    """
    if window < 4 or window & (window - 1):
        raise ValueError("window must be a power of two")
    spark = docs.sparkSession
    rows = shared.stored(cut_documents(docs, window, tokenizer, end_id), "packing")
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    windows = rows.groupBy("part").agg(F.sum(F.size("window_crcs")).alias("n")).select(
        "part", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("windows_before"))
    tails = rows.where("tail > 0").groupBy("part", "tail").agg(F.count(F.lit(1)).alias("n")).select(
        "part", "tail", "n", F.coalesce(F.sum("n").over(
            W.partitionBy("tail").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("tails_before"))
    full = windows.agg(F.sum("n")).first()[0] or 0
    histogram = np.zeros(window, np.int64)
    for length, n in tails.groupBy("tail").agg(F.sum("n")).collect():  # at most one row per length below the window
        histogram[length] = n
    slots, placed, sequences = plan(histogram)
    table = np.array(sorted(slots), np.int64).reshape(-1, 5)
    blocks_from = full + sequences
    left = histogram - placed
    bits = window.bit_length() - 1
    has = np.arange(window)[:, None] >> np.arange(bits)[None, :] & 1
    per_block = has * left[:, None]
    block_before = np.cumsum(per_block, 0) - per_block  # blocks of this size from shorter tails
    size_before = np.zeros(bits, np.int64)  # ids in larger blocks
    for bit in range(bits - 2, -1, -1):
        size_before[bit] = size_before[bit + 1] + (int(per_block[:, bit + 1].sum()) << (bit + 1))
    total = int((np.arange(window) * left).sum())
    shared_plan = spark.sparkContext.broadcast((table, placed, block_before, size_before))  # bounded by the window

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, placed, block_before, size_before = shared_plan.value
        keys = table[:, 0] << 44 | table[:, 1]
        last, last_size = divmod(total, window)
        for batch in batches:
            pieces = []
            doc, n, first, crcs, tail, rank, crc, blocks = (batch.column(k).to_pylist() for k in range(8))
            at = np.searchsorted(keys, np.array(tail, np.int64) << 44 | np.array(rank, np.int64), "right") - 1
            for k, i in enumerate(at.tolist()):
                start = 0
                for j, c in enumerate(crcs[k]):
                    pieces.append((doc[k], start, window, c, n[k], first[k] + j, 0))
                    start += window
                length = tail[k]
                if not length:
                    continue
                if rank[k] < placed[length]:
                    _, lo, _, sequence, offset = table[i].tolist()
                    pieces.append((doc[k], start, length, crc[k], n[k], full + sequence + rank[k] - lo, offset))
                    continue
                own, which = rank[k] - int(placed[length]), 0
                for bit in range(bits - 1, -1, -1):
                    if not length >> bit & 1:
                        continue
                    position = int(size_before[bit]) + (int(block_before[length, bit]) + own << bit)
                    sequence, offset = divmod(position, window)
                    if sequence == last:  # the last window is cut by the bits of its size
                        for b in range(bits - 1, -1, -1):
                            if last_size >> b & 1:
                                if offset < 1 << b:
                                    break
                                offset -= 1 << b
                                sequence += 1
                    pieces.append((doc[k], start, 1 << bit, blocks[k][which], n[k], blocks_from + sequence, offset))
                    start += 1 << bit
                    which += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(column), pa.int64()) for column in (zip(*pieces) if pieces else [()] * 7)],
                names=[field.split()[0] for field in PIECE_SCHEMA.split(", ")])

    placed_rows = rows.join(windows.select("part", "windows_before"), "part").join(
        tails.select("part", "tail", "tails_before"), ["part", "tail"], "left")
    return placed_rows.select(
        "doc_id", "doc_tokens", (F.col("windows_before") + F.col("first_window")).alias("first"), "window_crcs", "tail",
        F.coalesce(F.col("tails_before") + F.col("tail_rank"), F.lit(0)).alias("rank"), "tail_crc", "block_crcs",
    ).mapInArrow(place, PIECE_SCHEMA)
