"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kglake.llm import (
    audit,
    fingerprints,
    mixing,
    neighbours,
    packing,
    pages,
    private,
    quality,
    resampling,
    separators,
    setjoin,
    shared,
    token_files,
    warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn: Query) -> Query:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            shared.ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@query("op9_orc_tokens")
def op9_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids written as ORC and read back."""
    path = shared.new_folder(spark, "op9") + "/tokens"
    token_files.write_tokens(shared.table(spark, sf_dir, "documents"), path)
    return token_files.checksums(spark, path)


@query("op8_nnls_packing")
def op8_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 ids."""
    return packing.pack(shared.table(spark, sf_dir, "documents"), 1024)


@query("op1_sainte_lague_mixing", mixing.mixture_sql())
def op1_sainte_lague_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document a mixture of all sources takes."""
    return mixing.mix(shared.table(spark, sf_dir, "documents"))


@query("op10_warc_index")
def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, then read back by the index."""
    folder = shared.new_folder(spark, "op10")
    warc.write_warc(shared.table(spark, sf_dir, "pages"), folder)
    return warc.archive_summary(spark, folder)


@query("op2_weak_supervision_quality")
def op2_weak_supervision_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's base measures and the verdict of the rules together."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.judge(docs, with_text=False).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "p_quality")


@query("op7_pii_surrogates")
def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its personal data and secrets replaced."""
    docs = shared.table(spark, sf_dir, "documents").select("doc_id", "text")
    return private.replace_private(docs)


@query("op4_partition_jaccard")
def op4_partition_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 5-word shingles reach a Jaccard similarity of 0.75."""
    return setjoin.near_duplicates(shared.table(spark, sf_dir, "documents"))


@query("op6_posting_lists")
def op6_posting_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20, among all others."""
    return neighbours.nearest(shared.table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op5_separator_scan")
def op5_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document with its end id, counted in flat files by the separators."""
    folder = shared.new_folder(spark, "op5")
    return separators.token_counts(shared.table(spark, sf_dir, "documents"), folder).select("doc_id", "n_tokens")


@query("op3_boosted_main_text")
def op3_boosted_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pages.main_texts(shared.table(spark, sf_dir, "pages"))


@query("op11_hamming_balls")
def op11_hamming_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose SimHash fingerprints differ in 4 bits or fewer."""
    return fingerprints.near_duplicates(shared.table(spark, sf_dir, "documents"))


@query("op12_radix_resampling")
def op12_radix_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's importance for the benchmark's distribution, and the rank of those drawn."""
    return resampling.resample(shared.table(spark, sf_dir, "documents"), shared.table(spark, sf_dir, "benchmark"))


@query("op13_filter_audit", audit.AUDIT_SQL)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from every source in each of their 120 orders."""
    failed = audit.failures(shared.table(spark, sf_dir, "documents"))
    return audit.audit(failed, shared.table(spark, sf_dir, "labels"))
