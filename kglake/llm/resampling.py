"""Resampling towards a target distribution: importance weights by hashed n-grams, drawn by Gumbel scores.

Weights are scored with arrays: every run of 1 to 3 words falls into one of a fixed number of buckets by its CRC-32, a
bucket's gain is the logarithm of its share in the target over its share in the documents, and a document's
weight is the sum of the gains its features pick from that array.

The draw is the head of an order. It is sorted by least significant digits first: a pass over a digit of the
composite key counts the digit's values per part, a prefix sum over values and parts gives each cell its first place, and
rows move to `first place + rank within the cell`. Passes are stable, so after the last one a row's place is its rank.
Only rows whose leading score can be in the head are sorted.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kglake.llm import shared

BUCKETS = 10_000
LONGEST = 3
DIGIT_BITS = 12
HEAD_BINS = 4096
PART_ROWS = 1 << 20

# Words are runs of digits, letters a-z and bytes from 0x80; A-Z are lower-cased, all else separates.
_KEPT = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_KEPT).split() if text else []


def features(found: list[bytes], longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of all runs of 1 to `longest` words, joined by one space, repeats included.

    The checksum of a run goes on from that of the run without its last word, so no run is joined.
    """
    follow = [b" " + word for word in found]
    sums = list(map(crc32, found))
    out = [sums]
    for k in range(1, min(longest, len(found))):
        sums = list(map(crc32, follow[k:], sums))
        out.append(sums)
    return np.concatenate([np.array(s, np.uint32) for s in out]) % np.uint32(buckets)


def bucket_counts(docs: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all rows of `docs` (`text`) fall into each bucket: an array of fixed size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts += np.bincount(features(words(text), longest, buckets), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some])], names=["bucket", "n"])

    rows = docs.select(F.col("text").cast("string")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n"))
    counts = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():  # at most one row per bucket
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """A bucket's gain in thousandths of a natural logarithm, with one feature added to every bucket."""
    k, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (all_source + k) / ((s + 1.0) * (all_target + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, longest: int = LONGEST) -> DataFrame:
    """`doc_id, n_words, n_features, weight`, one row per row of `docs`."""
    shared_gain = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared_gain.value
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                found = words(text)
                at = features(found, longest, len(table))
                rows.append((len(found), len(at), int(table[at].sum())))
            columns = [pa.array(list(c), pa.int64()) for c in zip(*rows)] or [pa.array([], pa.int64())] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_words", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(doc_id: Column, seed: int = 42) -> Column:
    """Thousandths of a Gumbel number that is a function of the id alone; a null id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def head(rows: DataFrame, key: str, wanted: int) -> DataFrame:
    """Those of `rows` whose `key` can be among the `wanted` largest: all from the bin on in which the count is reached."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None or wanted <= 0:
        return rows.where(F.lit(False))
    width = (high - low) // HEAD_BINS + 1
    bins = rows.groupBy(F.expr(f"cast(({high} - {key}) div {width} as int)").alias("bin")).count().orderBy("bin").collect()
    total, last = 0, 0  # at most `HEAD_BINS` bins
    for last, count in bins:
        total += count
        if total >= wanted:
            break
    return rows.where(F.col(key) >= high - (last + 1) * width + 1)


def radix_ranks(rows: DataFrame, keys: list[str], digit_bits: int = DIGIT_BITS) -> DataFrame:
    """`rows` with `place`, from 0, in ascending order of `keys` (longs without nulls), by counting-sort passes.

    Rows equal in all keys get places in any order. The key's digits are those that its values differ in: each key
    counts from its least value, in as many equal digits of at most `digit_bits` bits as its range needs.
    """
    bounds = rows.agg(F.count(F.lit(1)).alias("n"), *[f(k).alias(f"{f.__name__}_{k}") for k in keys for f in (F.min, F.max)]).first()
    n = bounds["n"]
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // PART_ROWS))
    size = max(1, -(-n // parts))
    # Before the first pass a row's place only has to be its own: parts need not be equal for a counting sort.
    placed = shared.stored(rows.withColumn("place", F.monotonically_increasing_id()), "radix")
    part = F.pmod(F.xxhash64("place"), F.lit(parts))
    columns = rows.columns
    for key in reversed(keys):
        low = bounds[f"min_{key}"]
        bits = (bounds[f"max_{key}"] - low).bit_length() if n else 0
        passes = max(-(-bits // digit_bits), int(key == keys[0]))  # one at least, for places without gaps
        width = -(-bits // max(1, passes))
        unsigned = F.col(key) - F.lit(low) if bits < 64 else F.col(key).bitwiseXOR(F.lit(-1 << 63))
        for k in range(passes):
            digit = F.shiftrightunsigned(unsigned, k * width).bitwiseAND(F.lit((1 << width) - 1))
            dealt = placed.select(*columns, "place", part.alias("part"), digit.alias("digit")).repartition(parts, "part")
            cell = W.partitionBy("part", "digit").orderBy("place")
            counted = shared.stored(dealt.withColumn("within", F.row_number().over(cell) - 1), "radix-cells")
            cells = counted.groupBy("part", "digit").agg(F.count(F.lit(1)).alias("n"))
            cells = shared.stored(cells, "radix-counts")
            # First places: all smaller digits, of which there are at most 2 ** digit_bits, then this digit in earlier parts.
            smaller = cells.groupBy("digit").agg(F.sum("n").alias("n")).select("digit", F.coalesce(F.sum("n").over(
                W.orderBy("digit").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("smaller"))
            earlier = F.coalesce(F.sum("n").over(
                W.partitionBy("digit").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
            first = cells.withColumn("earlier", earlier).join(smaller, "digit").select(
                "part", "digit", (F.col("smaller") + F.col("earlier")).alias("first"))
            placed = counted.join(first, ["part", "digit"]).select(
                *columns, (F.col("first") + F.col("within")).alias("place"))
            part = F.expr(f"place div {size}")
    return placed


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42) -> DataFrame:
    """`doc_id, n_features, weight, score, rank` of each row of `docs` (`doc_id`, `text`) for the texts of `target`.

    Of the N rows with `least_words` words the `percent * N / 100` of highest score are drawn and ranked from 1, ties to
    smaller ids, a null id last; other rows have a null rank. Null texts have no words and weight 0. Rows that share an
    id have the same random number; of those with equal scores the one with fewer features comes first. Other columns
    are ignored; an empty `docs` gives an empty result, an empty `target` weighs each bucket by the documents alone.
    """
    gain = gains(bucket_counts(docs), bucket_counts(target))
    scored = weights(docs, gain).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    scored = shared.stored(scored.withColumn("row", F.monotonically_increasing_id()), "scores")
    able = scored.where(F.col("n_words") >= least_words)
    wanted = percent * able.count() // 100
    chosen = head(able, "score", wanted).select(
        "row", (-F.col("score")).alias("least"), F.col("doc_id").isNull().cast("long").alias("no_id"),
        F.coalesce("doc_id", F.lit(0)).alias("id"), "n_features")
    ranked = radix_ranks(chosen, ["least", "no_id", "id", "n_features"]).where(F.col("place") < wanted).select(
        "row", (F.col("place") + 1).alias("rank"))
    return scored.join(ranked, "row", "left").select("doc_id", "n_features", "weight", "score", "rank")
