"""Token ids of documents as ORC files, and their use without reading what a query does not need.

Documents are sorted by id across files, so file, stripe and row-group statistics bound the ids in each; a Bloom
filter on the id skips the row groups between. ORC run-length encodes the integers. Each stripe is a unit
of parallel reading. A row carries the number of ids before it in its file; what files hold before it is
a prefix sum over one row per file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kglake.llm import tokens

SCHEMA = "doc_id long, part_start long, n_tokens long, ids array<int>"
ROWS_IDS = 2_000_000


def _batch(doc_ids: list, starts: list[int], coded: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(coded), np.int32)
    counts = np.array([len(c) // 4 for c in coded], np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(counts, pa.int64()),
         pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))],
        names=["doc_id", "part_start", "n_tokens", "ids"])


def token_rows(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0,
               special_as_text: bool = False) -> DataFrame:
    """`doc_id, part_start, n_tokens, ids` of each row of `docs` in its own partition's order.

    `ids` are the whole text's, then `end_id`; null and empty texts have the end id alone. `part_start`
    counts the ids before the row in its partition.
    """
    path = tokenizer or tokens.default_path()
    end = np.array([end_id], np.uint32).tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        start = 0
        for batch in batches:
            doc_ids, starts, coded, size = [], [], [], 0
            for doc_id, ids in zip(batch.column(0).to_pylist(),
                                   tokens.encoded(batch.column(1).to_pylist(), path, special_as_text)):
                ids += end
                doc_ids.append(doc_id)
                starts.append(start)
                coded.append(ids)
                start += len(ids) // 4
                size += len(ids) // 4
                if size >= ROWS_IDS:
                    yield _batch(doc_ids, starts, coded)
                    doc_ids, starts, coded, size = [], [], [], 0
            if doc_ids:
                yield _batch(doc_ids, starts, coded)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(encode, SCHEMA)


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0,
                 stripe_bytes: int = 16 << 20) -> None:
    """Write the ids of all documents under `path` in ascending `doc_id` order, null ids first.

    Rows of one id are ordered by a hash of their text; copies of a row stay copies. A hash beside the id
    in the range keys lets an id that many rows share spread over files.
    """
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    ordered = keyed.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h", "text")
    (token_rows(ordered, tokenizer, end_id).write
     .option("compression", "zstd").option("orc.stripe.size", stripe_bytes)
     .option("orc.row.index.stride", 1000).option("orc.create.index", "true")
     .option("orc.bloom.filter.columns", "doc_id").option("orc.bloom.filter.fpp", 0.01).orc(path))


def read_rows(spark: SparkSession, path: str) -> DataFrame:
    """The files' rows with the file of each."""
    return spark.read.schema(SCHEMA).orc(path).withColumn("file", F.input_file_name())


def with_starts(rows: DataFrame, files: DataFrame) -> DataFrame:
    """Replace `file, part_start` of `rows` by `start`, the ids of all documents before; `files` are all rows written.

    The prefix sum runs over one row per file, in the order of the numbers in their names, which have more digits the more files there are.
    """
    sizes = files.groupBy("file").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("n"))
    number = F.regexp_extract("file", r"part-(\d+)[^/]*$", 1).cast("long")
    before = W.orderBy(number, "file").rowsBetween(W.unboundedPreceding, -1)
    base = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    others = [c for c in rows.columns if c not in ("doc_id", "file", "part_start")]
    return rows.join(base, "file").select("doc_id", (F.col("base") + F.col("part_start")).alias("start"), *others)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids` of every document written."""
    rows = read_rows(spark, path)
    return with_starts(rows, rows)


def lookup_tokens(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of few documents: the filter reaches the files' statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).where(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def checksums(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every document written; the ids stay in the task that reads them."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(4)
            flat = np.asarray(ids.flatten()).view(np.uint32)
            ends = np.asarray(ids.offsets, np.int64)
            ends = ends - ends[0]
            crc = [zlib.crc32(flat[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())],
                                             names=["doc_id", "file", "part_start", "n_tokens", "ids_crc32"])

    rows = read_rows(spark, path)
    checked = rows.select("doc_id", "file", "part_start", "n_tokens", "ids").mapInArrow(
        check, "doc_id long, file string, part_start long, n_tokens long, ids_crc32 long")
    return with_starts(checked, rows)
