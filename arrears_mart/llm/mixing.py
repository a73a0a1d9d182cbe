"""Mixing sources to target weights with Sainte-Lague quotas of equal token blocks. DataFrame operations only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrears_mart.llm.columns import fields, whole_row, words
from arrears_mart.stages import stage_table

#: Documents of a source are dealt to so many bins by a seeded hash; neighbouring bins make up a shard.
BINS, SHARDS = 4096, 16
#: Tokens in a block, and the least number of blocks; a small corpus has smaller blocks.
BLOCK, LEAST_BLOCKS = 64, 10_000
MOST_REPEATS = 3


def token_size(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def targets(totals: DataFrame, weights: Sequence[int]) -> DataFrame:
    """`totals` (src, none, source_size) with rank and target.

    Sources by code point, null last, take the weights in turn and share the sum of all sizes. A target is at most
    MOST_REPEATS times its source's size; what is over goes to the others by weight until none is above. With sources
    sorted by cap over weight, the level of the rest, if all before are capped, rises and then falls: its greatest
    value is the one that holds.
    """
    rank = F.row_number().over(Window.orderBy("none", "src")) - 1
    weighted = totals.withColumn("rank", rank).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), F.col("rank") % len(weights) + 1)
    )
    weighted = weighted.withColumn("cap", MOST_REPEATS * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    total = F.sum("source_size").over(Window.partitionBy())
    leveled = weighted.withColumn("level", (total - before) / left)
    share = F.col("weight") * F.max("level").over(Window.partitionBy())
    return leveled.withColumn("target", F.least(F.col("cap").cast("double"), share)).drop("cap", "level")


def apportion(units: DataFrame, group: Sequence[str], unit: Sequence[str], size: str, seats: str) -> DataFrame:
    """`units` with `quota`: the seats of each group dealt to its units by highest quotients size / (2 * quota + 1).

    All quotients above a level that surely leaves at most as many seats as there are n units are counted at once. Another
    level surely gives out all seats, so only quotients between the two, at most n and one a unit, are ranked: the work
    depends neither on the number of seats nor on the square of n. Ties go to the unit that comes first. Without a group
    the units are ranked in one task, as narrow rows.
    """
    whole = Window.partitionBy(*group)
    n, total = F.count(F.lit(1)).over(whole), F.sum(size).over(whole).cast("double")
    level = F.when((2 * F.col(seats) > n) & (total > 0), (2 * F.col(seats) - n) / total).otherwise(F.lit(0.0))
    top = F.when(total > 0, (2 * F.col(seats) + n) / total).otherwise(F.lit(0.0))
    at = lambda x: F.floor((F.col(size) * x + 1) / 2).cast("long")
    base = units.withColumns({"_base": at(level), "_most": at(top) - at(level) + 1})  # one more for rounded doubles
    base = base.withColumn("_open", F.col(seats) - F.sum("_base").over(whole))
    rounds = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_most"))).alias("_more")
    quotient = F.col(size) / (2 * (F.col("_base") + F.col("_more")) + 1)
    asked = base.select("*", rounds).where(F.col(size) > 0)
    asked = asked.withColumn("_place", F.row_number().over(whole.orderBy(F.desc(quotient), *unit, "_more")))
    won = asked.where("_place <= _open").groupBy(*group, *unit).agg(F.count(F.lit(1)).alias("_won"))
    return (
        base.join(won, [*group, *unit], "left")
        .withColumn("quota", F.col("_base") + F.coalesce("_won", F.lit(0)))
        .drop("_base", "_most", "_open", "_won")
    )


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), seed: str = "mix", block: int = BLOCK) -> DataFrame:
    """`docs`, which has doc_id, source and size, with source_size, target and taken (columns so named are replaced, all
    others kept).

    Blocks of equal numbers of tokens are dealt to sources by Sainte-Lague, then each source's blocks to its shards by
    the shards' sizes. Within a shard the documents stand in a seeded order; the quota takes the whole sequence as often
    as it can, and then the first blocks of it, so a document may be taken in part. No document is taken more than
    MOST_REPEATS times. Rows of equal id keep apart and are ordered by size. Null sources are one source, null ids are
    ordered as empty ones, null sizes count 0, and documents of size 0 have nothing taken. Empty tables give an empty
    result. `docs` is read twice: store it first if its columns are costly.
    """
    names = [c for c in docs.columns if c not in ("size", "source_size", "target", "taken")]
    docs = docs.select("doc_id", "source", "size", whole_row(docs).alias("_row"))
    code = F.md5(F.concat_ws("|", F.lit(seed), F.col("doc_id").cast("string")).cast("binary"))
    keyed = docs.withColumns(
        {
            "size": F.coalesce(F.col("size"), F.lit(0)).cast("long"),
            "_src": F.coalesce(F.col("source").cast("string"), F.lit("")),
            "_none": F.col("source").isNull(),
            "_code": code,
        }
    ).withColumn("_bin", F.conv(F.substring("_code", 1, 3), 16, 10).cast("int"))
    key = ["_src", "_none", "_bin"]
    bins = keyed.groupBy(*key).agg(F.sum("size").alias("held"))
    bins = stage_table(bins.select(F.col("_src").alias("src"), F.col("_none").alias("none"), F.col("_bin").alias("bin"), "held"), "mix-bins")
    shards = bins.groupBy("src", "none", F.floor(F.col("bin") / (BINS // SHARDS)).alias("shard")).agg(F.sum("held").alias("length"))
    totals = bins.groupBy("src", "none").agg(F.sum("held").alias("source_size"))
    goal = targets(totals, weights)
    everything = F.sum("source_size").over(Window.partitionBy())
    tokens = F.greatest(F.least(F.lit(block), F.floor(everything / LEAST_BLOCKS)), F.lit(1)).cast("long")
    goal = goal.withColumn("tokens", tokens).withColumn("seats", F.floor(everything / F.col("tokens") + 0.5))
    by_source = apportion(goal, [], ["rank"], "target", "seats").select(
        "src", "none", "source_size", "target", "tokens", F.col("quota").alias("seats")
    )
    dealt = apportion(shards.join(by_source, ["src", "none"]), ["src", "none"], ["shard"], "length", "seats")
    take = F.least(F.col("quota") * F.col("tokens"), MOST_REPEATS * F.col("length"))
    dealt = dealt.withColumn("take", take).select(
        "src",
        "none",
        "shard",
        "source_size",
        "target",
        F.when(F.col("length") > 0, F.floor(F.col("take") / F.col("length"))).otherwise(0).cast("long").alias("passes"),
        F.when(F.col("length") > 0, F.col("take") % F.col("length")).otherwise(0).cast("long").alias("rest"),
    )
    shard = F.floor(F.col("bin") / (BINS // SHARDS))
    in_shard = Window.partitionBy("src", "none", shard).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    plan = bins.withColumn("bin_start", F.coalesce(F.sum("held").over(in_shard), F.lit(0))).withColumn("shard", shard)
    plan = stage_table(plan.join(dealt, ["src", "none", "shard"]).drop("shard", "held"), "mix-plan")
    in_bin = Window.partitionBy(*key).orderBy("_code", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = keyed.withColumn("_before", F.coalesce(F.sum("size").over(in_bin), F.lit(0)))
    on = [placed["_src"] == plan["src"], placed["_none"] == plan["none"], placed["_bin"] == plan["bin"]]
    start = F.col("bin_start") + F.col("_before")
    part = F.greatest(F.least(F.col("rest") - start, F.col("size")), F.lit(0))
    return placed.join(plan, on).select(
        *fields("_row", names),
        placed["size"],
        plan["source_size"],
        plan["target"],
        (F.col("passes") * F.col("size") + part).cast("long").alias("taken"),
    )


def mixed_documents(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), seed: str = "mix") -> DataFrame:
    """The mixed corpus with the columns of `docs`, whatever their names: each document as often as its taken words,
    rounded, fill it.

    The quota of a shard ends inside one document at most, so whole copies miss a source's target by at most half a
    document in each of its SHARDS shards. Documents without words, null texts among them, are left out. Null ids and
    sources, ties, repeated rows and long texts are treated as in `mix`; an empty table gives an empty result.
    """
    sized = docs.select("doc_id", "source", token_size(F.col("text")).alias("size"), whole_row(docs).alias("row"))
    taken = mix(sized, weights, seed)
    times = F.when(F.col("size") > 0, F.round(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    copies = taken.select("row", times.alias("times")).where("times > 0")
    return copies.select("row", F.explode(F.sequence(F.lit(1), "times"))).select(*fields("row", docs.columns))
