"""Token counts of documents in flat token files that have no index, by their end-of-document ids.

Files are read in blocks by many tasks. Within a block a vectorised comparison finds the separators; a prefix
scan over the blocks' counts, one narrow row per block, gives each block its place in the file, the number of
documents that ended before it and where the last one ended. So a document that spans blocks is counted whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kglake.llm import shared, tokens

# The vocabulary's ids fit into two bytes.
ID = np.dtype("<u2")
END_ID = 50256  # the vocabulary's own end of text, which no text encodes to when its string is plain text
FILE_BYTES = 256 << 20
BLOCK_IDS = 1 << 20


def write_flat(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the ids of every row of `docs`, each followed by `end_id`, as files of unsigned little-endian `ID`s.

    An id that does not fit raises.

    Returns the stored table `file, ordinal, doc_id` of what was written in which order: names alone, no positions. Null and
    empty texts are the end id alone.
    """
    path = tokenizer or tokens.default_path()
    end = np.array([end_id], ID).tobytes()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared.file_system(folder)
        fs.create_dir(f"{root}/flat", recursive=True)
        out, name, size, ordinal = None, None, 0, 0
        for batch in batches:
            files, ordinals = [], []
            for ids in tokens.encoded(batch.column(1).to_pylist(), path, True):
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        out.close()
                    name, size, ordinal = f"{uuid.uuid4().hex}.ids", 0, 0
                    out = fs.open_output_stream(f"{root}/flat/{name}", compression=None)
                wide = np.frombuffer(ids, np.uint32)
                if len(wide) and wide.max() > np.iinfo(ID).max:
                    raise ValueError("an id needs more bytes")
                out.write(wide.astype(ID).tobytes() + end)
                files.append(name)
                ordinals.append(ordinal)
                size += ID.itemsize * (len(wide) + 1)
                ordinal += 1
            yield pa.RecordBatch.from_arrays([pa.array(files, pa.string()), pa.array(ordinals, pa.int64()), batch.column(0)],
                                             names=["file", "ordinal", "doc_id"])
        if out is not None:
            out.close()

    named = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        write, "file string, ordinal long, doc_id long")
    named.write.parquet(f"{folder}/names")
    return docs.sparkSession.read.schema("file string, ordinal long, doc_id long").parquet(f"{folder}/names")


def scan(spark: SparkSession, folder: str, files: DataFrame, end_id: int = END_ID,
         block_ids: int = BLOCK_IDS) -> DataFrame:
    """`file, ordinal, start, n_tokens, complete` of every document of the flat files named by `files` (`file`).

    `n_tokens` counts the end id. Ids after the last separator are a document that is not complete. `start`
    counts the ids before the document in its file.
    """
    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared.file_system(folder)
        for batch in batches:
            sizes = [fs.get_file_info(f"{root}/flat/{name}").size // ID.itemsize for name in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64())], names=["file", "ids"])

    blocks = files.select("file").distinct().mapInArrow(sized, "file string, ids long").where("ids > 0").select(
        "file", "ids", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(ids - 1) div {block_ids}"))).alias("block"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = shared.file_system(folder)
        for batch in batches:
            for name, ids, block in zip(*(c.to_pylist() for c in batch.columns)):
                with fs.open_input_file(f"{root}/flat/{name}") as source:
                    source.seek(ID.itemsize * block * block_ids)
                    data = np.frombuffer(source.read(ID.itemsize * min(block_ids, ids - block * block_ids)), ID)
                at = np.flatnonzero(data == end_id)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name]), pa.array([block], pa.int64()), pa.array([len(data)], pa.int64()),
                     pa.array([len(at)], pa.int64()), pa.array([int(at[-1]) if len(at) else None], pa.int64()),
                     pa.array([at.tolist()], pa.list_(pa.int64()))],
                    names=["file", "block", "n", "ends", "last_end", "at"])

    found = shared.stored(blocks.repartition("file", "block").mapInArrow(
        find, "file string, block long, n long, ends long, last_end long, at array<long>"), "separators")
    earlier = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    later = W.partitionBy("file").orderBy("block").rowsBetween(1, W.unboundedFollowing)
    placed = found.select("file", "block", "n", "ends", "last_end").withColumn(
        "begin", F.coalesce(F.sum("n").over(earlier), F.lit(0))).withColumn(
        "ended", F.coalesce(F.sum("ends").over(earlier), F.lit(0)))
    placed = placed.withColumn(
        "open_from", F.coalesce(F.max(F.col("begin") + F.col("last_end") + 1).over(earlier), F.lit(0))).withColumn(
        "is_last", F.count(F.lit(1)).over(later) == 0)
    whole = found.select("file", "block", "at").join(placed, ["file", "block"])
    # Blocks are few and short as rows, however many documents they hold: they are dealt out before the documents appear.
    dealt = whole.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "file", "block")
    ends = F.concat(F.transform("at", lambda p: p + F.col("begin") + 1), F.when(F.col("is_last"), F.array(
        F.col("begin") + F.col("n"))).otherwise(F.array().cast("array<bigint>")))
    spans = F.arrays_zip(F.concat(F.array("open_from"), ends).alias("start"), ends.alias("stop"))
    rows = dealt.select("file", "ended", "ends", F.posexplode(spans).alias("i", "s")).where("s.stop is not null")
    return rows.select(
        "file", (F.col("ended") + F.col("i")).alias("ordinal"), F.col("s.start").alias("start"),
        (F.col("s.stop") - F.col("s.start")).alias("n_tokens"), (F.col("i") < F.col("ends")).alias("complete")).where("n_tokens > 0")


def token_counts(docs: DataFrame, folder: str, tokenizer: str | None = None) -> DataFrame:
    """`doc_id, start, n_tokens` of each row of `docs`: written as flat files, counted by their separators.

    Repeated rows count each; other columns are ignored; an empty table gives an empty result.
    """
    names = write_flat(docs, folder, tokenizer)
    counted = scan(docs.sparkSession, folder, names)
    return counted.join(names, ["file", "ordinal"]).select("doc_id", "n_tokens", "start", "complete")
