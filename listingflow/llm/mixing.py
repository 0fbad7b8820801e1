"""Mixing sources to target weights by Sainte-Laguë apportionment.

Sources get targets in words (weights share a budget; a target stops at ``max_repeats`` times its source's size, and
the excess is shared again). The budget is dealt in blocks of ``block_words`` words: blocks go to sources by highest
quotient target / (2 s + 1), and a source's blocks to its shards by highest quotient size / (2 s + 1). A shard is a
part of a source of about ``shard_words`` words, dealt by a hash of the document, so a source with a third of all rows
is many shards. Inside a shard, documents stand in a seeded order, and their words form one run cut into blocks. A
quota of q blocks takes every block q div m times (m is the shard's number of blocks) and q mod m of them once more:
those at evenly spaced places from a seeded start. How much of a document falls into taken blocks is arithmetic on
its place in the run, so no block is ever a row.

Defined cases: null texts have no words; documents without words get 0. The null source comes last and is a source
like others. Rows may repeat and ids may be null: order is by hash, id and size, and rows that tie in all of these
are equal in all that is returned. Without any words all targets are 0. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from listingflow.functions.ordering import with_row_index
from listingflow.llm.words import n_spaced_words
from listingflow.session import materialize

# Small, as blocks cost nothing and a source's words come as near to its target as a block is long.
BLOCK_WORDS = 16
SHARD_WORDS = 1_000_000
MAX_REPEATS = 3
SEED = 42


def weigh_in_turn(sources: DataFrame, weights: Sequence[float] = (1, 2, 3)) -> DataFrame:
    """Adds ``weight``: the given weights over and over, to the sources in order of code points, null last."""
    placed = with_row_index(sources, [F.col("source").asc_nulls_last()], "_place")
    turn = F.get(F.array(*(F.lit(float(w)) for w in weights)), (F.col("_place") % len(weights)).cast("int"))
    return placed.withColumn("weight", turn).drop("_place")


def targets(sources: DataFrame, budget: float, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Adds ``target`` to (source, source_size, weight, ...): the budget by weight, none above its cap.

    Each round caps the sources that are above and shares the rest anew; a round is one sum over the sources.
    """
    cap = max_repeats * F.col("source_size")
    sources = sources.withColumn("_capped", F.lit(False))
    while True:
        open_weight = F.sum(F.when(~F.col("_capped"), F.col("weight")))
        left = budget - F.coalesce(F.sum(F.when(F.col("_capped"), cap)), F.lit(0))
        share = sources.agg((left / open_weight).alias("share")).first()["share"] or 0.0
        above = ~F.col("_capped") & (F.col("weight") * F.lit(share) > cap)
        if sources.where(above).isEmpty():
            break
        sources = sources.withColumn("_capped", F.col("_capped") | above)
    exact = F.when(F.col("_capped"), cap.cast("double")).otherwise(F.col("weight") * F.lit(share))
    return sources.withColumn("target", exact).drop("_capped")


def apportion(shares: DataFrame, group: Sequence[str], key: Sequence[str], weight: str, seats: str, most: str) -> DataFrame:
    """Adds ``quota``: each group's ``seats`` by highest quotients weight / (2 s + 1), at most ``most`` to a row.

    Quotients beyond a divisor that is too high are all seated, those below one that is too low are not; both follow
    from the group's sum, and at most about two seats a row lie between. Only these are ranked. Ties go by ``key``.
    """
    total, rows = F.sum(weight).cast("double").alias("_total"), F.count(F.lit(1)).alias("_rows")
    sums = materialize(shares.groupBy(*group).agg(total, rows, F.first(seats).alias("_seats")), "seats")
    on = [shares[g].eqNullSafe(sums[g]) for g in group]
    joined = shares.join(sums, on).select(*(shares[c] for c in shares.columns), "_total", "_rows", "_seats")

    def seated(seats_now: Column) -> Column:
        divisor_seats = F.floor(F.col(weight) * seats_now / F.col("_total") + 0.5)
        return F.least(F.when((seats_now > 0) & (F.col("_total") > 0), divisor_seats).otherwise(0), F.col(most)).cast("long")

    sure, possible = F.col("_seats") - F.col("_rows") / 2 - 1, F.col("_seats") + F.col("_rows") / 2 + 1
    bounded = materialize(joined.withColumn("_sure", seated(sure)).withColumn("_possible", seated(possible)), "seats-bounded")
    left = bounded.groupBy(*group).agg((F.first("_seats") - F.sum("_sure")).alias("_left"))
    open_seats = bounded.where("_possible > _sure").select(
        *group, *key, weight, F.explode(F.sequence("_sure", F.col("_possible") - 1)).alias("_seat")
    )
    order = [(F.col(weight) / (2 * F.col("_seat") + 1)).desc(), *(F.col(k).asc_nulls_last() for k in key), "_seat"]
    ranked = open_seats.withColumn("_rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    ranked = ranked.join(
        left.select(*(F.col(g).alias(f"_group_{g}") for g in group), "_left"),
        [F.col(g).eqNullSafe(F.col(f"_group_{g}")) for g in group],
    )
    extra = ranked.where("_rank <= _left").groupBy(*key).agg(F.count(F.lit(1)).alias("_extra"))
    extra = materialize(extra, "seats-ranked").select(*(F.col(k).alias(f"_key_{k}") for k in key), "_extra")
    out = bounded.join(extra, [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in key], "left")
    return out.withColumn("quota", F.col("_sure") + F.coalesce("_extra", F.lit(0))).select(*shares.columns, "quota")


def _taken_up_to(end: Column) -> Column:
    """Words that one pass over the picked blocks takes from the first ``end`` words of a shard."""
    blocks, words = F.floor(end / F.col("_block")), end % F.col("_block")

    def picked(n):  # picked blocks among the first n
        return F.floor((n * F.col("_odd") + F.col("_start")) / F.col("_blocks"))

    return picked(blocks) * F.col("_block") + F.when(picked(blocks + 1) > picked(blocks), words).otherwise(0)


def mix(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS, max_repeats: int = MAX_REPEATS, seed: int = SEED,
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of each row of ``docs``."""
    sized = materialize(
        docs.select("doc_id", "source", n_spaced_words(F.col("text")).alias("size")), "document-sizes"
    )
    sources = materialize(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    budget = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    aimed = targets(materialize(weigh_in_turn(sources, weights), "weighed"), float(budget), max_repeats)
    aimed = materialize(aimed.withColumn("_all", F.lit(0)), "targets")  # one group, as a column to join on
    # What one shard's last, shorter block may cost is small only if a shard has many blocks.
    dealt = F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "doc_id", "size"),
                   F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)))
    blocks = F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words))
    by_source = apportion(
        aimed.withColumns({"_seats_in_all": F.lit(round(budget / block_words)), "_most": max_repeats * blocks}),
        ["_all"], ["source"], "target", "_seats_in_all", "_most",
    ).select(F.col("source").alias("_source"), "source_size", "target", F.col("quota").alias("source_quota"))
    by_source = materialize(by_source, "source-quotas")
    placed = sized.join(by_source, sized["source"].eqNullSafe(by_source["_source"])).withColumn("shard", dealt)
    shards = materialize(
        placed.groupBy("source", "shard").agg(F.sum("size").alias("shard_size"), F.first("source_quota").alias("source_quota"))
        .withColumn("_blocks", F.ceil(F.col("shard_size") / block_words)),
        "shards",
    )
    quotas = apportion(
        shards.withColumn("_most", max_repeats * F.col("_blocks")),
        ["source"], ["source", "shard"], "shard_size", "source_quota", "_most",
    )
    quotas = materialize(quotas, "shard-quotas").select(
        F.col("source").alias("_source"), F.col("shard").alias("_shard"), "quota", "_blocks",
    )
    order = Window.partitionBy("source", "shard").orderBy(
        F.xxhash64(F.lit(seed), F.lit("order"), "doc_id", "size"), "doc_id", "size"
    )
    run = placed.withColumn("_end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    seeded = F.pmod(F.xxhash64(F.lit(seed), F.lit("start"), "_source", "_shard"), F.greatest(F.col("_blocks"), F.lit(1)))
    joined = run.drop("_source").join(
        quotas.withColumn("_start", seeded),
        F.col("source").eqNullSafe(F.col("_source")) & (F.col("shard") == F.col("_shard")),
    )
    full = F.when(F.col("_blocks") > 0, F.floor(F.col("quota") / F.col("_blocks"))).otherwise(0)
    joined = (
        joined.withColumn("_block", F.lit(block_words)).withColumn("_full", full)
        .withColumn("_odd", F.col("quota") - F.col("_full") * F.col("_blocks"))
    )
    part = F.when(F.col("_odd") > 0, _taken_up_to(F.col("_end")) - _taken_up_to(F.col("_end") - F.col("size"))).otherwise(0)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("_full") * F.col("size") + part).cast("long").alias("taken"),
    )
