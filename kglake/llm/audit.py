"""How quality filters interact: what each removes in every order of application.

Words are dictionary-encoded for the whole table and documents become rows of a sparse document-term matrix in compressed
sparse rows (CSR). Each input batch is a shard with its own list of distinct words; the lists are dealt by word to the tasks that give
every word its one number, and the numbers return to the shards, so a word moves once per shard and not once per
document. Row sums and nonzero counts of the matrix decide the two filters on words; the others are flags of a
text. Of the documents only a mask of failed filters and two labels are left, and those are counted per source
before any order is looked at.
"""

from __future__ import annotations

import uuid
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kglake.llm import shared

FILTERS = "ABCDE"
LEAST_WORDS = 200
SHARD_BYTES = 8 << 20


def _shard(texts: list[bytes], rows: pa.Array, parts: int) -> Iterator[tuple]:
    """One shard: its word lists by part of the dictionary, then its matrix with the shard's own word numbers."""
    numbers: dict[bytes, int] = {}
    starts, columns, counts = [0], [], []
    for text in texts:
        found = Counter(text.split())
        columns += [numbers.setdefault(word, len(numbers)) for word in found]
        counts += found.values()
        starts.append(len(columns))
    name, words = uuid.uuid4().hex, list(numbers)
    part = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % np.uint32(parts)
    order = np.argsort(part, kind="stable").astype(np.int32)
    for slots in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
        if len(slots):
            # No word holds a space, so spaces tell the words of a list apart.
            yield name, int(part[slots[0]]), b" ".join([words[k] for k in slots.tolist()]), slots, *[None] * 4
    yield name, None, None, None, rows, *(np.array(x, np.int32) for x in (starts, columns, counts))


def term_matrix(texts: DataFrame, parts: int | None = None, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The document-term matrix of `texts` (`row`, `text`) as CSR shards `shard, rows, starts, columns, counts`.

    `row` is whatever names a row, of any type, and need not be unique. Row k of a shard is `rows[k]`; its entries are
    `[starts[k], starts[k + 1])` of `columns` (the words' numbers, one for a word in the whole table) and of `counts`. Words are
    runs without white space, as they are written; null texts have none. `parts` is the number of parts of the
    dictionary, the session's shuffle partitions if not given. A shard ends after `shard_bytes` of text.
    """
    parts = parts or int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    row_type = texts.schema["row"].dataType.simpleString()
    names = ["shard", "part", "words", "slots", "rows", "starts", "columns", "counts"]
    schema = (f"shard string, part int, words binary, slots array<int>, rows array<{row_type}>, starts array<int>,"
              " columns array<int>, counts array<int>")

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(found: list[bytes], rows: list[pa.Array]) -> pa.RecordBatch:
            kept = pa.concat_arrays(rows)
            kinds = [pa.string(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(kept.type), *[pa.list_(pa.int32())] * 3]
            columns = [list(c) for c in zip(*_shard(found, kept, parts))]
            ends = [0] * len(columns[0]) + [len(kept)]
            filled = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), kept)
            columns[4] = pa.ListArray.from_arrays(
                filled.offsets, kept, mask=pa.array([x is None for x in columns[4]])).cast(kinds[4])
            return pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, kind) for c, kind in zip(columns, kinds)], names=names)

        found, rows, size = [], [], 0
        for batch in batches:
            begin = 0
            for k, text in enumerate(batch.column(1).to_pylist(), 1):
                found.append(text.encode("utf-8", "surrogatepass") if text else b"")
                size += len(found[-1])
                if size >= shard_bytes:
                    yield batch_of(found, [*rows, batch.column(0).slice(begin, k - begin)])
                    found, rows, size, begin = [], [], 0, k
            rows.append(batch.column(0).slice(begin))
        if found:
            yield batch_of(found, rows)

    def number(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        """Numbers of a part's words: each `parts`-th number belongs to the part."""
        known: dict[bytes, int] = {}
        ids = [np.array([known.setdefault(word, len(known)) for word in words.split(b" ")], np.int64) * parts + key[0].as_py()
               for words in table.column("words").to_pylist()]
        return pa.table([table.column("shard"), table.column("slots"), pa.array(ids, pa.list_(pa.int64()))],
                        names=["shard", "slots", "ids"])

    def encode(key: tuple[pa.Scalar, ...], matrix: pa.Table, numbers: pa.Table) -> pa.Table:
        slots, ids = (np.asarray(numbers.column(c).combine_chunks().flatten()) for c in ("slots", "ids"))
        lookup = np.zeros(len(ids), np.int64)
        lookup[slots] = ids
        columns = lookup[np.asarray(matrix.column("columns").combine_chunks().flatten())]
        return matrix.set_column(matrix.column_names.index("columns"), "columns", pa.array([columns], pa.list_(pa.int64())))

    shards = shared.stored(texts.select("row", F.col("text").cast("string")).mapInArrow(build, schema), "shards")
    numbers = shards.where("part is not null").select("part", "shard", "words", "slots").groupBy("part").applyInArrow(
        number, "shard string, slots array<int>, ids array<bigint>")
    matrix = shards.where("part is null").select("shard", "rows", "starts", "columns", "counts")
    return matrix.groupBy("shard").cogroup(numbers.groupBy("shard")).applyInArrow(
        encode, f"shard string, rows array<{row_type}>, starts array<int>, columns array<bigint>, counts array<int>")


def row_measures(matrix: DataFrame) -> DataFrame:
    """`row, n_words, n_distinct`: sums and nonzero counts of the matrix's rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                starts, counts = (np.asarray(batch.column(c)[k].values) for c in (1, 2))
                sums = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[k].values, pa.array(np.diff(sums[starts])), pa.array(np.diff(starts).astype(np.int64))],
                    names=["row", "n_words", "n_distinct"])

    row_type = matrix.schema["rows"].dataType.elementType.simpleString()
    return matrix.select("rows", "starts", "counts").mapInArrow(run, f"row {row_type}, n_words long, n_distinct long")


def failures(docs: DataFrame) -> DataFrame:
    """`source, doc_id, mask` of each row of `docs`: the bit of every filter of `FILTERS` that the row fails.

    A fails under 200 words; B with fewer distinct words than half the words; C where capitals A-Z are more than 2% of the code
    points; D with any of `#$%&*|`; E where a row of smaller id has the same text, which for null ids no row has. Null
    texts are empty ones. Other columns are ignored.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    capitals = F.length(text) - F.length(F.translate(text, "".join(map(chr, range(65, 91))), ""))
    row = F.struct(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.unhex(F.sha2(text, 256)).alias("name"), (100 * capitals > 2 * F.length(text)).alias("c"),
        text.rlike("[#$%&*|]").alias("d"))
    measured = row_measures(term_matrix(docs.select(row.alias("row"), text.alias("text"))))
    rows = shared.stored(measured.select("row.*", "n_words", "n_distinct"), "audit-rows")
    first = rows.groupBy("name").agg(F.min("doc_id").alias("first"))
    bits = [F.col("n_words") < LEAST_WORDS, 100 * F.col("n_distinct") < 50 * F.col("n_words"), F.col("c"), F.col("d"),
            F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))]
    mask = sum((F.when(bit, 1 << k).otherwise(0) for k, bit in enumerate(bits)), start=F.lit(0))
    return rows.join(first, "name").select("source", "doc_id", mask.alias("mask"))


def audit(failed: DataFrame, labels: DataFrame, filters: str = FILTERS) -> DataFrame:
    """What each filter removes, in every order of `filters`: one row per source, order and step, zeros included.

    `failed` has `source, doc_id, mask`; `labels` has `doc_id, quality, toxic`, where an id counts as good or toxic if any of its rows
    says so and a null id matches none. A null source is the empty one. Columns are `part, filter_order, step` (from 1; the step's filter is
    that letter of the order) and the counts of documents: `kept`, `removed`, `redundant`, `unique_fails`, `good_lost`,
    `toxic_lost` and `shapley`, the filter's `removed` summed over all orders. An empty table gives an empty result.
    """
    known = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    # Rows that differ in nothing but their id's labels are one before labels are joined, and again after.
    joined = failed.groupBy(F.coalesce("source", F.lit("")).alias("part"), "doc_id", "mask").agg(
        F.count(F.lit(1)).alias("n")).join(known, "doc_id", "left")
    cells = joined.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good") == 1, F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("toxic"))
    # At most one cell per mask, so a part is a short row whatever its size.
    part = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    orders = "".join("".join(order) for order in permutations(filters))
    steps = F.explode(F.sequence(F.lit(0), F.lit(len(orders) - 1)))
    at = part.select("part", "cells", steps.alias("at")).withColumns({
        "filter_order": F.substring(F.lit(orders), F.expr(f"at div {len(filters)} * {len(filters)} + 1"), F.lit(len(filters))),
        "step": F.expr(f"at % {len(filters)} + 1")})

    def bits(letters: Column) -> Column:
        return sum((F.when(F.contains(letters, F.lit(f)), 1 << k).otherwise(0) for k, f in enumerate(filters)), start=F.lit(0))

    at = at.withColumns({"own": bits(F.substring("filter_order", F.col("step"), F.lit(1))),
                         "before": bits(F.substring("filter_order", F.lit(1), F.col("step") - 1))})

    def total(keep, value="n", times=lambda mask: F.lit(1).cast("long")) -> Column:
        return F.aggregate(F.filter("cells", lambda c: keep(c["mask"])), F.lit(0).cast("long"),
                           lambda a, c: a + c[value] * times(c["mask"]))

    def fails(mask: Column, some: str) -> Column:
        return mask.bitwiseAND(F.col(some)) != 0

    def here(mask: Column) -> Column:
        return fails(mask, "own") & ~fails(mask, "before")

    # A document that fails k filters is removed by each of them in the k-th part of all orders.
    return at.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total(lambda m: ~fails(m, "own") & ~fails(m, "before")).alias("kept"), total(here).alias("removed"),
        total(lambda m: fails(m, "own") & fails(m, "before")).alias("redundant"),
        total(lambda m: m == F.col("own")).alias("unique_fails"), total(here, "good").alias("good_lost"),
        total(here, "toxic").alias("toxic_lost"),
        total(lambda m: fails(m, "own"), times=lambda m: (F.lit(factorial(len(filters))) / F.bit_count(m)).cast("long")).alias(
            "shapley"))


AUDIT_SQL = """
with words as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as text,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
firsts as (select text, min(doc_id) as first from words group by text),
failed as (select d.part, d.doc_id,
    (len(w) < 200)::int + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::int
    + 4 * (100 * (length(d.text) - length(regexp_replace(d.text, '[A-Z]', '', 'g'))) > 2 * length(d.text))::int
    + 8 * regexp_matches(d.text, '[#$%&*|]')::int + 16 * coalesce(d.doc_id > first, false)::int as mask
    from words d join firsts f on d.text = f.text),
known as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
cells as (select part, mask, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic
    from failed f left join known k on f.doc_id = k.doc_id group by part, mask),
letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter),
orders as (select concat(a.letter, b.letter, c.letter, d.letter, e.letter) as filter_order
    from letters a, letters b, letters c, letters d, letters e
    where len(list_distinct([a.letter, b.letter, c.letter, d.letter, e.letter])) = 5),
steps as (select filter_order, step, substr(filter_order, step, 1) as letter,
    1 << (ascii(substr(filter_order, step, 1)) - 65) as own,
    list_sum([0] || [1 << (ascii(substr(filter_order, i, 1)) - 65) for i in range(1, step)])::int as before
    from orders, (select unnest(range(1, 6))::int as step)),
counted as (select part, filter_order, step, letter,
    sum(case when mask & (own | before) = 0 then n else 0 end)::bigint as kept,
    sum(case when mask & own <> 0 and mask & before = 0 then n else 0 end)::bigint as removed,
    sum(case when mask & own <> 0 and mask & before <> 0 then n else 0 end)::bigint as redundant,
    sum(case when mask = own then n else 0 end)::bigint as unique_fails,
    sum(case when mask & own <> 0 and mask & before = 0 then good else 0 end)::bigint as good_lost,
    sum(case when mask & own <> 0 and mask & before = 0 then toxic else 0 end)::bigint as toxic_lost
    from cells, steps group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) over (partition by part, letter))::bigint as shapley from counted"""
