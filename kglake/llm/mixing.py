"""Mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

A source's documents lie on one line per shard, in an order seeded by a hash of the document's id and text, and the line is
tiled by blocks of `block_words` words; a line read again and again goes round like a circle. Blocks go to
sources by highest quotients `target / (2k + 1)`, and a source's blocks to its shards by the same rule over the
shards' words. The seed picks the block at which a shard's reading starts; as the line's order is random, the
blocks from there are a random choice that keeps documents whole, but for the two at its ends. A source
whose target reaches `max_repeats` times its size is read whole that often and has no blocks to choose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kglake.llm import shared

WEIGHTS = (1, 2, 3)


def _seeded(seed: str, *columns: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in columns]))


def _number(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3) -> DataFrame:
    """`source, sid, source_size, source_rows, capped, target`, one row per source of `sizes` (`source, size`).

    Sources by code point, null last, weigh `weights` in turn and share all words. A target stops at
    `max_repeats` times its source's size and the excess goes to the others by weight: the common rate per
    weight is found in one pass over the sources in the order in which they fill up.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    sources = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
               .withColumn("sid", (F.row_number().over(by_name) - 1).cast("long"))
               .withColumn("weight", weight.cast("long")).withColumn("most", F.col("source_size") * max_repeats))
    filling = W.orderBy(F.col("most") / F.col("weight"), "sid").rowsBetween(W.unboundedPreceding, -1)
    rate = ((F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("most").over(filling), F.lit(0)))
            / (F.sum("weight").over(W.partitionBy()) - F.coalesce(F.sum("weight").over(filling), F.lit(0))))
    rated = sources.withColumn("rate", rate).withColumn("capped", F.col("most") <= F.col("rate") * F.col("weight"))
    final = F.first(F.when(~F.col("capped"), F.col("rate")), ignorenulls=True).over(
        W.orderBy(F.col("most") / F.col("weight"), "sid").rowsBetween(W.unboundedPreceding, W.unboundedFollowing))
    return rated.select(
        "source", "sid", "source_size", "source_rows", "capped",
        F.when(F.col("capped"), F.col("most").cast("double")).otherwise(final * F.col("weight")).alias("target"))


def apportion(votes: DataFrame, group: list[str], key: str, seats: str) -> DataFrame:
    """`group..., key, quota`: Sainte-Laguë seats of each `key` of a group (columns `votes` and `seats`).

    Rounding each fair share gives the seats of all but a few; the highest quotients win those that are
    missing, the lowest give back those that are over. Only those quotients are ranked.
    """
    total = W.partitionBy(*group)
    shared_out = votes.withColumn("all_votes", F.sum("votes").over(total)).withColumn(
        "base", F.when(F.col("all_votes") > 0, F.floor(
            F.try_divide(F.col("votes") * F.col(seats), F.col("all_votes")) + F.lit(0.5))).otherwise(0).cast("long")
    ).withColumn("short", F.col(seats) - F.sum("base").over(total))
    steps = shared_out.where("short <> 0 and votes > 0").select(
        *group, key, "short", "votes", "base", F.explode(F.sequence(F.lit(1), F.abs("short"))).alias("step"))
    steps = steps.where("short > 0 or step <= base").withColumn("divisor", F.when(
        F.col("short") > 0, 2 * (F.col("base") + F.col("step")) - 1).otherwise(2 * (F.col("base") - F.col("step")) + 1))
    quotient = F.col("votes") / F.col("divisor")
    place = F.row_number().over(W.partitionBy(*group).orderBy(
        F.when(F.col("short") > 0, -quotient).otherwise(quotient), key, "step"))
    changed = steps.withColumn("place", place).where(F.col("place") <= F.abs("short")).groupBy(*group, key).agg(
        F.sum(F.signum(F.col("short").cast("double"))).cast("long").alias("change"))
    return shared_out.join(changed, [*group, key], "left").select(
        *group, key, (F.col("base") + F.coalesce(F.col("change"), F.lit(0))).alias("quota"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3, block_words: int = 16,
        shard_words: int = 100_000, seed: str = "mix") -> DataFrame:
    """How many words of each row of `docs` the mixture takes.

    Returns `doc_id, source, size, source_size, target, taken` and where: `passes` whole readings, and the words
    `[from1, to1)` and `[from2, to2)` of one more, numbered from 0 (both empty if none); `h` names id and text. Rows without words
    take none; a null `doc_id` or `source` is a value like others. Repeated rows count each. Columns
    beyond `doc_id, text, source` are ignored. An empty table gives an empty result.
    """
    sizes = shared.stored(docs.select(
        "doc_id", "source", shared.word_count(F.col("text")).alias("size"),
        _seeded(seed, F.col("doc_id"), F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")))).alias("h")), "mixing")
    targets = shared.stored(source_targets(sizes, weights, max_repeats), "mixing-targets")
    open_targets = targets.where("not capped").withColumnRenamed("target", "votes")
    seats = F.round(F.sum("votes").over(W.partitionBy()) / block_words).cast("long")
    blocks = apportion(open_targets.select(F.lit(0).alias("one"), "sid", "votes", seats.alias("seats")),
                       ["one"], "sid", "seats").select("sid", F.col("quota").alias("blocks"))
    # Rows count like words, so that very many rows without words have shards too.
    shards = F.greatest(F.lit(1), F.ceil((F.col("source_size") + F.col("source_rows")) / shard_words)).cast("long")
    placed = sizes.join(targets.select(F.col("source").alias("s"), "sid", "source_size", "source_rows", "target", "capped"),
                        F.col("source").eqNullSafe(F.col("s"))).drop("s").withColumn(
        "shard", F.pmod(_number(F.col("h")), shards))
    cells = placed.groupBy("sid", "shard", "capped").agg(F.sum("size").alias("votes"))
    open_cells = cells.where("not capped").join(blocks, "sid")
    quotas = apportion(open_cells, ["sid"], "shard", "blocks")
    arcs = cells.join(quotas, ["sid", "shard"], "left").select(
        "sid", "shard", F.col("votes").alias("line"),
        F.when(F.col("capped"), F.col("votes") * max_repeats).otherwise(
            F.least(F.coalesce("quota", F.lit(0)) * block_words, F.col("votes") * max_repeats)).alias("arc"),
        (F.pmod(_number(_seeded(seed, F.col("sid"), F.col("shard"))),
                F.greatest(F.lit(1), F.ceil(F.col("votes") / block_words)).cast("long")) * block_words).alias("begin"))
    order = W.partitionBy("sid", "shard").orderBy("h", "doc_id", "size").rowsBetween(W.unboundedPreceding, -1)
    at = placed.withColumn("at", F.coalesce(F.sum("size").over(order), F.lit(0))).join(arcs, ["sid", "shard"])
    passes = F.when(F.col("line") > 0, F.floor(F.try_divide("arc", "line"))).otherwise(0).cast("long")
    at = at.withColumn("passes", passes).withColumn("rest", F.col("arc") - F.col("passes") * F.col("line"))

    def within(value: Column) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), value - F.col("at"))).cast("long")

    stop = F.col("begin") + F.col("rest")
    parts = at.withColumn("from1", within(F.col("begin"))).withColumn("to1", within(stop)).withColumn(
        "from2", F.lit(0).cast("long")).withColumn("to2", within(stop - F.col("line")))
    return parts.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("passes") * F.col("size") + F.col("to1") - F.col("from1") + F.col("to2")).alias("taken"),
        "passes", "from1", "to1", "from2", "to2", "h")


def mixture_sql(weights: tuple[int, ...] = WEIGHTS, max_repeats: int = 3, block_words: int = 16,
                shard_words: int = 100_000, seed: str = "mix") -> str:
    """The same as DuckDB SQL over `documents`."""
    weight = f"list_extract([{', '.join(map(str, weights))}], (sid % {len(weights)} + 1)::int)"

    def seats(votes: str, group: str, key: str, number: str, name: str) -> str:
        return f"""
{name}_a as (select *, case when sum(votes) over (partition by {group}) > 0
    then floor(votes * {number} / sum(votes) over (partition by {group}) + 0.5) else 0 end::bigint as base from {votes}),
{name}_b as (select *, ({number} - sum(base) over (partition by {group}))::bigint as short from {name}_a),
{name}_c as (select *, unnest(range(1, abs(short) + 1)) as step from {name}_b where short <> 0 and votes > 0),
{name}_d as (select *, case when short > 0 then 2 * (base + step) - 1 else 2 * (base - step) + 1 end as divisor
    from {name}_c where short > 0 or step <= base),
{name}_e as (select *, row_number() over (partition by {group} order by
    case when short > 0 then -(votes / divisor) else votes / divisor end, {key}, step) as place from {name}_d),
{name}_f as (select {group}, {key}, sum(sign(short)) as change from {name}_e where place <= abs(short) group by all),
{name} as (select b.*, (base + coalesce(change, 0))::bigint as quota from {name}_b b
    left join {name}_f f on b.{group} = f.{group} and b.{key} = f.{key})"""

    return f"""
with sizes as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
    md5(concat('{seed}:', coalesce(doc_id::varchar, ''), ':', md5(coalesce(text, '')))) as h from documents),
named as (select source, sum(size)::bigint as source_size, count(*) as source_rows, row_number() over (order by source nulls last) - 1 as sid
    from sizes group by source),
weighted as (select *, {weight}::bigint as weight, source_size * {max_repeats} as most from named),
rated as (select *, (sum(source_size) over () - coalesce(sum(most) over filling, 0))::double
    / (sum(weight) over () - coalesce(sum(weight) over filling, 0))::double as rate from weighted
    window filling as (order by most / weight, sid rows between unbounded preceding and 1 preceding)),
targets as (select *, most <= rate * weight as capped, case when most <= rate * weight then most::double else
    (select r.rate from rated r where r.most > r.rate * r.weight order by r.most / r.weight, r.sid limit 1) * weight
    end as target from rated),
open_targets as (select 0 as one, sid, target as votes,
    round(sum(target) over () / {block_words})::bigint as seats from targets where not capped),
{seats('open_targets', 'one', 'sid', 'seats', 'blocks')},
placed as (select s.*, t.sid, t.source_size, t.target, t.capped,
    ('0x' || substr(h, 1, 8))::bigint % greatest(1, ceil((t.source_size + t.source_rows) / {shard_words}))::bigint as shard
    from sizes s join targets t on s.source is not distinct from t.source),
cells as (select sid, shard, capped, sum(size)::bigint as votes from placed group by all),
open_cells as (select c.*, b.quota as blocks from cells c join blocks b using (sid) where not capped),
{seats('open_cells', 'sid', 'shard', 'blocks', 'quotas')},
arcs as (select c.sid, c.shard, c.votes as line, case when c.capped then c.votes * {max_repeats}
    else least(coalesce(q.quota, 0) * {block_words}, c.votes * {max_repeats}) end as arc,
    ('0x' || substr(md5(concat('{seed}:', c.sid, ':', c.shard)), 1, 8))::bigint
        % greatest(1, ceil(c.votes / {block_words}))::bigint * {block_words} as begins
    from cells c left join quotas q on c.sid = q.sid and c.shard = q.shard),
lined as (select p.*, a.line, a.arc, a.begins, case when a.line > 0 then a.arc // a.line else 0 end as passes,
    coalesce(sum(size) over (partition by p.sid, p.shard order by h, doc_id, size
        rows between unbounded preceding and 1 preceding), 0)::bigint as ahead
    from placed p join arcs a on p.sid = a.sid and p.shard = a.shard),
parts as (select *, greatest(0, least(size, begins - ahead)) as from1,
    greatest(0, least(size, begins + arc - passes * line - ahead)) as to1, 0::bigint as from2,
    greatest(0, least(size, begins + arc - passes * line - line - ahead)) as to2 from lined)
select doc_id, source, size, source_size, target, (passes * size + to1 - from1 + to2)::bigint as taken,
    passes::bigint as passes, from1::bigint as from1, to1::bigint as to1, from2, to2::bigint as to2, h from parts"""


def mixed_documents(docs: DataFrame, seed: str = "mix", **options) -> DataFrame:
    """`docs` as the mixture reads them: a row for each whole reading and one for each part, with `docs`'s columns.

    Rows without words are not read. A part keeps its words and the white space after them. `n_chars`, where present, is the new
    text's; all other columns keep their values, whatever their names.
    """
    h, part_source, nth, size, reads, read = shared.unused(docs.columns, "h", "part_source", "nth", "words", "reads", "read")
    taken = mix(docs, seed=seed, **options)
    whole = F.array_repeat(F.struct(F.lit(0).cast("long").alias("a"), F.col("size").alias("b")), F.col("passes").cast("int"))
    parts = F.filter(F.array(F.struct(F.col("from1").alias("a"), F.col("to1").alias("b")),
                             F.struct(F.col("from2").alias("a"), F.col("to2").alias("b"))), lambda p: p["a"] < p["b"])
    # Rows of one id, text and source are alike for the mixture: they are matched by their number, which spreads them too.
    alike = W.partitionBy("h", "source").orderBy("passes", "from1", "to1", "from2", "to2")
    picked = taken.where("size > 0").select(
        F.col("h").alias(h), F.col("source").alias(part_source), F.col("size").alias(size), F.concat(whole, parts).alias(reads),
        F.row_number().over(alike).alias(nth))
    text = F.col("text").cast("string")
    named = docs.withColumn(h, _seeded(seed, F.col("doc_id"), F.md5(F.coalesce(text, F.lit("")))))
    numbered = named.withColumn(nth, F.row_number().over(W.partitionBy(h, "source").orderBy(h)))
    joined = numbered.join(picked, [h, nth]).where(F.col("source").eqNullSafe(F.col(part_source)))
    rows = joined.select(*docs.columns, size, F.explode(reads).alias(read))
    found = F.regexp_extract_all(text, F.lit(shared.WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    a, b = F.col(read)["a"], F.col(read)["b"]
    part = F.array_join(F.slice(found, (a + 1).cast("int"), (b - a).cast("int")), "")
    out = rows.withColumn("text", F.when((a == 0) & (b == F.col(size)), text).otherwise(part))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)
