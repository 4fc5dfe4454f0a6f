"""Mixing sources to target weights: blocks, shard draws, index permutations.

1. *Pack*: the words of a source's documents form one stream, cut into blocks
   of ``block_words``.  The order inside a source is (slice, doc_id, size),
   slices being hash buckets of ids, so the prefix sum that places documents
   runs per slice and a source with a third of all rows is no hot group.
2. *Draw*: the output is cut into shards of ``shard_slots`` slots, and every shard
   draws its source counts by the target weights: a multinomial draw whose K
   numbers are stratified, the j-th one uniform in [j/K, (j+1)/K).  Each count is
   unbiased and within one of K times its weight, where free draws would miss
   by the square root.  Only the numbers at the borders between two sources
   decide anything, so a shard's counts come from as many hashes as sources.
   What a source is given over all shards follows from these draws.
3. *Map*: a source's slots are numbered through the shards; slot i reads block
   perm(i mod blocks) with a fresh permutation for every pass over the source, so
   a block is used floor or ceil of slots/blocks times.  Slots beyond three
   passes stay empty: no document is taken more often.
4. *Join*: slots and document pieces meet on (source, block index).

Permutations are swap-or-not shuffles (each round swaps x with K-x or not, by a
bit of their larger): bijections of [0, n) for any n, in integer arithmetic that
any SQL engine repeats.  Only built-in functions run.

Defined cases: null and empty texts have size 0 and are never taken; a null
source is a source of its own, after all others; null ids are packed first;
repeated rows (same id, source and size) are packed one after the other and each
gets its own ``taken``; with no words at all every target is 0; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import partitions, stored, word_count

BLOCK_WORDS = 128
SHARD_SLOTS = 4_096
#: Shards grow beyond SHARD_SLOTS so that there are at most so many of them.
MOST_SHARDS = 65_536
SLICE_DOCS = 4_096
WEIGHTS = (1, 2, 3)
MOST = 3  # times a source's size
PRIME = 2_147_483_647
ROUNDS = 12
#: The per-source table is broadcast up to this many sources.
BROADCAST_SOURCES = 100_000


def _factor(r: int, salt: int) -> int:
    return pow(48_271, 5 * r + salt, PRIME)


def permuted(df: DataFrame, x: str, n: str, key: str, salt: int) -> DataFrame:
    """Replace column ``x`` in [0, n) by its image under the permutation that
    ``key`` (a non-negative integer expression below 2^31) selects.  One fold
    over the rounds' constants: the plan stays small whatever their number."""
    rounds = ", ".join("named_struct('r', {}L, 'a', {}L, 'b', {}L, 'c', {}L)".format(
        r, *(_factor(r, salt + j) for j in (1, 2, 3))) for r in range(ROUNDS))
    k = f"((((_key + t.r) % {PRIME} * t.a) % {PRIME} * {PRIME}L + ((_key + t.b) % {PRIME} * t.c) % {PRIME}) % _n)"
    bit = f"(((greatest(x, y) % {PRIME} * t.b + t.a + _key) % {PRIME}) div 65536) % 2"
    # the one-element transform names the partner y, so that it is computed once
    fold = (f"aggregate(array({rounds}), _x, (x, t) -> element_at("
            f"transform(array(({k} - x + _n) % _n), y -> if({bit} = 1, y, x)), 1))")
    inputs = {"_x": x, "_n": n, "_key": key}
    named = df.withColumns({name: F.expr(f"cast({e} as long)") for name, e in inputs.items()})
    return named.withColumn(x, F.expr(fold)).drop(*inputs)


def with_targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """Adds ``no`` (rank by code point, null last), ``weight`` and ``target`` to
    (source, source_size).  Resharing the excess until none is above its limit
    ends at one level L with target = min(most * size, L * weight); taking
    sources by limit/weight, L is the largest of (words left)/(weight left).
    One row per source passes the windows, never documents."""
    ranked = sources.withColumn("no", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("no") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("_limit", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("_limit") / F.col("weight"), "no")
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("_limit").over(before), F.lit(0))
    weight_left = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    level = ranked.withColumn("_level", left / weight_left).withColumn("_level", F.max("_level").over(every))
    return level.withColumn("target", F.least(F.col("_limit").cast("double"), F.col("_level") * F.col("weight"))).drop("_limit", "_level")


def drawn(cumulative: str) -> str:
    """SQL for the numbers of a shard (of ``size`` slots) that fall below a border,
    ``cumulative`` of ``tickets``: those of whole strata, and that of the border's own
    stratum if its hash, uniform in [0, tickets), is below the rest."""
    at, rest = f"(size * {cumulative} div tickets)", f"(size * {cumulative} % tickets)"
    mixed_ = lambda a, b, c: f"((((shard * {a} + {at} * {b}) % {PRIME} + {c}) * 48271) % {PRIME})"
    x = f"({mixed_(69_621, 40_014, 7)} * {PRIME}L + {mixed_(39_373, 16_807, 101)}) % tickets"
    return f"{at} + if({x} < {rest}, 1, 0)"


@dataclass
class Mix:
    """``sources``: one row each; ``pieces``: document words in blocks;
    ``slots``: (shard, position, no, block); ``units``: documents with sizes."""

    units: DataFrame
    sources: DataFrame
    pieces: DataFrame
    slots: DataFrame


def _div(x: str, n: str) -> Column:
    return F.expr(f"({x}) div ({n})")


def mix(docs: DataFrame, doc: str = "doc_id", text: str = "text", source: str = "source", weights=WEIGHTS,
        block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, slice_docs: int = SLICE_DOCS) -> Mix:
    skey = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    sized = docs.select(F.col(doc).cast("long").alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    units = stored(sized.groupBy("doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")).withColumn("_s", skey), "mix-units")
    per_source = units.groupBy("_s").agg(F.first("source").alias("source"), F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    sources = with_targets(per_source, weights)
    sources = sources.withColumn("blocks", _div(f"source_size + {block_words - 1}", str(block_words)))
    sources = sources.withColumn("n_slots", F.when(F.col("source_size") > 0, F.floor(
        F.col("target") * F.col("blocks") / F.col("source_size") + 0.5)).otherwise(0).cast("long"))
    sources = sources.withColumn("n_slots", F.least("n_slots", F.col("blocks") * MOST)).withColumn(
        "first_ticket", F.coalesce(F.sum("n_slots").over(Window.orderBy("no").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    sources = stored(sources.withColumn("tickets", F.sum("n_slots").over(Window.partitionBy())), "mix-sources")
    n_sources, = sources.agg(F.count(F.lit(1))).first()
    small = F.broadcast if n_sources <= BROADCAST_SOURCES else (lambda d: d)

    # pack: offset of the slice in its source, then of the document in its slice
    n_slices = units.count() // slice_docs + 1
    sliced = units.join(small(sources.select("_s", "no")), "_s").withColumn(
        "slice", F.expr(f"(pmod(coalesce(doc_id, 0), {PRIME}) * 48271) % {PRIME} % {n_slices}"))
    words = F.col("size") * F.col("copies")
    per_slice = sliced.groupBy("no", "slice").agg(F.sum(words).alias("_w"))
    earlier = Window.partitionBy("no").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    per_slice = per_slice.select("no", "slice", F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("no", "slice").orderBy(F.asc_nulls_first("doc_id"), "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("_in", F.coalesce(F.sum(words).over(inside), F.lit(0))).join(per_slice, ["no", "slice"])
    copies = placed.filter("size > 0").withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    copies = copies.withColumn("_at", F.col("_before") + F.col("_in") + F.col("copy") * F.col("size"))
    pieces = copies.withColumn("block", F.explode(F.sequence(_div("_at", str(block_words)), _div("_at + size - 1", str(block_words)))))
    start, end = F.greatest("_at", F.col("block") * block_words), F.least(F.col("_at") + F.col("size"), (F.col("block") + 1) * block_words)
    pieces = pieces.select("no", "block", "doc_id", "size", "copy", (start - F.col("_at")).alias("from_word"), (end - start).alias("words"))

    # draw: a row for each source and shard
    tickets = F.col("tickets")
    shards = sources.filter("tickets > 0").withColumn("_full", F.greatest(F.lit(shard_slots), F.ceil(tickets / MOST_SHARDS)).cast("long"))
    shards = shards.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.expr("(tickets - 1) div _full"))))
    shards = shards.withColumn("size", F.least("_full", tickets - F.col("shard") * F.col("_full")))
    shards = shards.withColumn("_from", F.expr(drawn("first_ticket"))).withColumn("_to", F.expr(drawn("(first_ticket + n_slots)")))
    shards = shards.withColumn("_count", F.col("_to") - F.col("_from"))
    before = Window.partitionBy("no").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.withColumn("_first", F.coalesce(F.sum("_count").over(before), F.lit(0)).cast("long"))
    shards = shards.withColumn("_last", F.least(F.col("_first") + F.col("_count"), F.col("blocks") * MOST) - 1).filter("_last >= _first")

    # map
    spans = shards.select("no", "blocks", "shard", "size", "_from", "_first", "_last").repartition(partitions(shards), "no", "shard")
    slots = spans.withColumn("_i", F.explode(F.sequence("_first", "_last")))
    slots = slots.select("no", "blocks", "shard", "size", (F.col("_from") + F.col("_i") - F.col("_first")).alias("position"),
                         F.expr("_i % blocks").alias("block"), _div("_i", "blocks").alias("_pass"))
    slots = permuted(slots, "block", "blocks", "no * 4 + _pass", 0)
    slots = permuted(slots, "position", "size", f"shard % {PRIME}", 50)
    slots = slots.select("shard", "position", "no", "block")
    return Mix(units, sources, pieces, slots)


def mixed(m: Mix) -> DataFrame:
    """The mix in detail: (shard, position, no, block, doc_id, size, copy,
    from_word, words), one row for each document piece of each slot."""
    # the planner takes exploded slots for as small as the table of sources and would broadcast them
    return m.slots.hint("merge").join(m.pieces, ["no", "block"])


def taken(m: Mix) -> DataFrame:
    """One row per document row: doc_id, source, size, source_size, target, taken."""
    per_doc = mixed(m).groupBy("no", "doc_id", "size", "copy").agg(F.sum("words").alias("taken"))
    rows = m.units.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    small = F.broadcast if m.sources.count() <= BROADCAST_SOURCES else (lambda d: d)
    rows = rows.join(small(m.sources.select("_s", "no", "source_size", "target")), "_s").alias("r")
    t = per_doc.alias("t")
    same = [F.col("r.no") == F.col("t.no"), F.col("r.size") == F.col("t.size"), F.col("r.copy") == F.col("t.copy"),
            F.col("r.doc_id").eqNullSafe(F.col("t.doc_id"))]
    return rows.join(t, same, "left").select(
        "r.doc_id", "r.source", "r.size", "r.source_size", "r.target", F.coalesce("t.taken", F.lit(0)).cast("long").alias("taken"))
