"""Mixing sources to target weights by a multivariate hypergeometric splitting tree.

A source's target is its weight's share of all words, at most ``most_epochs`` times what it
has; what a source cannot take is shared again by weight. A target is some whole passes
over the source and a part of one more. For the part the source's documents are dealt to
blocks, BLOCKS of them or as many as have about BLOCK words, by a keyed hash of their id, which is a
random permutation, and blocks are drawn in a hashed order while they fit. In the one block where the target ends,
documents are drawn in hashed order while they fit, so that a target is met to within less
than the smallest document left over.

How many drawn blocks of each source go to which output shard comes from a tree over the
shards: a node's blocks are divided between its halves by a multivariate hypergeometric
draw, down to single shards, so quotas are exact and as random as if all blocks had been
shuffled. There are SHARDS of them, or as many as have about SHARD_WORDS words. Every shard then takes
the next blocks of a source's permutation, disjoint from all others, and is shuffled by itself.

What is counted per document is narrow (an id, a source and a size); only ``mix`` moves
texts. A task of the draw sees one block's documents; windows run over the blocks
of a source; one row per source, aggregated, is ranked and split in single tasks.

Null sources are a source, last in order. A null or empty text has size 0 and is never
taken. Rows with an id of their own are drawn alike however the table is cut into files;
rows that repeat an id, or have none, are told apart by their position. No row is taken over
``most_epochs`` times. In an empty table nothing is taken. Texts of any length are counted whole, and ties in
a hashed order are broken by position. Columns that have the names of new ones are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barstats.llm.common import WORD
from barstats.sources.scratch import staged

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
#: Words of a block and of a shard in large tables; any table has this many of both at least.
BLOCK = 200_000
SHARD_WORDS = 10_000_000
BLOCKS = 64
SHARDS = 16
SEED = 17
_TOP_NODES = 32


def source_targets(
    rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """A row per source: source, sid (rank by code point, null last), size and target.

    ``rows`` has columns source and size. Weights repeat along the rank. The water level
    (words a unit of weight) rises until no uncapped source is above its cap; two sums a
    round come to the driver.
    """
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    pick = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    sources = sources.withColumn("sid", rank).withColumn("weight", pick.cast("double"))
    sources = staged(sources.withColumn("cap", F.col("source_size") * most_epochs), "sources")
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * level > F.col("cap")
        total, full, open_weight, n = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(above, F.col("cap")).otherwise(0)),
            F.sum(F.when(above, 0.0).otherwise(F.col("weight"))),
            F.count_if(above),
        ).first()
        if n == capped or not open_weight:
            break
        level, capped = (total - full) / open_weight, n
    target = F.least(F.col("weight") * level, F.col("cap").cast("double"))
    return sources.select("source", "sid", "source_size", target.alias("target"))


def split_counts(
    counts: np.ndarray, capacities: np.ndarray, lo: int, hi: int, seed: int, nodes: int | None = None
):
    """Divide counts of things by kind among the shards lo to hi, a node at a time.

    Yields (lo, hi, counts) of the leaves, or of ``nodes`` subtrees. The random numbers of a node
    depend on the seed and the node alone.
    """
    if hi - lo == 1 or nodes == 1:
        yield lo, hi, counts
        return
    mid = (lo + hi) // 2
    rng = np.random.default_rng([seed, lo, hi])
    left = rng.multivariate_hypergeometric(counts, int(capacities[lo:mid].sum()), method="marginals")
    below = nodes and nodes // 2
    yield from split_counts(left, capacities, lo, mid, seed, below)
    yield from split_counts(counts - left, capacities, mid, hi, seed, below)


def shard_quotas(drawn: DataFrame, shards: int, seed: int) -> DataFrame:
    """shard, sid, quota: how many of each source's drawn blocks go to each shard.

    ``drawn`` has a row per source: sid and blocks. The top of the tree is split in one
    task, each of its subtrees in a task of its own.
    """
    total = drawn.agg(F.sum("blocks")).first()[0] or 0
    capacities = np.diff(np.arange(shards + 1) * total // shards)

    def part(frame: pd.DataFrame, lo: int, hi: int, nodes: int | None) -> pd.DataFrame:
        frame = frame.sort_values("sid")
        sid = frame["sid"].to_numpy()
        parts = [
            pd.DataFrame({"lo": a, "hi": b, "sid": sid[c > 0], "blocks": c[c > 0]})
            for a, b, c in split_counts(frame["blocks"].to_numpy(), capacities, lo, hi, seed, nodes)
        ]
        return pd.concat(parts)

    schema = "lo int, hi int, sid int, blocks long"
    top = drawn.select("sid", "blocks", F.lit(0).alias("root")).groupBy("root").applyInPandas(
        lambda frame: part(frame, 0, shards, _TOP_NODES), schema
    )
    leaves = top.groupBy("lo", "hi").applyInPandas(
        lambda key, frame: part(frame, int(key[0]), int(key[1]), None), schema
    )
    return leaves.select(F.col("lo").alias("shard"), "sid", F.col("blocks").alias("quota"))


def _closing_draw(frame: pd.DataFrame) -> pd.DataFrame:
    """In the block where a target ends: the rows that fit in what is left, in hashed order."""
    frame = frame.sort_values(["perm", "row"])
    left, taken = float(frame["left"].iloc[0]), []
    sizes, rows = frame["size"].to_numpy(), frame["row"].to_numpy()
    rest = []
    for size, row in zip(sizes.tolist(), rows.tolist()):
        if size <= left:
            taken.append(row)
            left -= size
        else:
            rest.append((size, row))
    if rest and min(rest)[0] - left < left:  # nearer with it than without
        taken.append(min(rest)[1])
    return pd.DataFrame({"row": taken}, dtype="int64")


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    row_col: str | None = None,
    weights: tuple[int, ...] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    blocks: int = BLOCKS,
    shards: int = SHARDS,
) -> DataFrame:
    """A row per document: row, doc_id, size, source_size, target and copies, an array with
    epoch and shard of every time the mix takes it."""
    row = F.col(row_col) if row_col else F.monotonically_increasing_id()
    rows = staged(_measured(docs, row, id_col, text_col, source_col), "sizes")
    draw = _draw(rows, weights, most_epochs, block, shard_words, seed, blocks, shards)
    taken = draw.taken(rows).select("row", "doc_id", "sid", "size", "copies")
    return taken.join(draw.targets.select("sid", "source_size", "target"), "sid").drop("sid")


def _place(seed: int, shard: Column, epoch: Column) -> Column:
    """Where a copy comes in the shuffled order of its shard."""
    return F.xxhash64(F.lit(seed), shard, epoch, F.col("row"))


def with_positions(plan: DataFrame, seed: int = SEED) -> DataFrame:
    """The plan with copies that also have their position in their shuffled shard, from 0.

    A task orders one shard, whose size is bounded; rows here have no texts.
    """
    each = plan.select("row", F.explode("copies").alias("c")).select("row", "c.epoch", "c.shard")
    place = _place(seed, F.col("shard"), F.col("epoch"))
    order = Window.partitionBy("shard").orderBy("place", "row", "epoch")
    each = each.withColumn("place", place).withColumn("position", F.row_number().over(order) - 1)
    copies = each.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("epoch", "shard", "position"))).alias("placed"))
    kind = "array<struct<epoch:int,shard:int,position:int>>"
    out = plan.join(copies, "row", "left").withColumn("copies", F.expr(f"coalesce(placed, cast(array() AS {kind}))"))
    return out.drop("placed")


def _measured(docs: DataFrame, row: Column, id_col: str, text_col: str, source_col: str, *more: Column) -> DataFrame:
    size = F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("long")
    source = F.col(source_col).cast("string").alias("source")
    return docs.select(row.alias("row"), F.col(id_col).alias("doc_id"), source, size.alias("size"), *more)


@dataclass(frozen=True)
class Draw:
    """What was drawn, in tables that are small beside the documents: a row per repeated id,
    source, block, and document of a block where a target ends. Spark sends those to the tasks
    whose files are small enough."""

    seed: int
    odd: DataFrame
    targets: DataFrame
    sources: DataFrame
    copies: DataFrame
    fits: DataFrame

    def dealt(self, rows: DataFrame) -> DataFrame:
        """Rows (with row, doc_id, source, size) with their source's number and their block."""
        apart = F.when(F.col("odd") | F.col("doc_id").isNull(), F.col("row"))
        perm = F.xxhash64(F.lit(self.seed), "doc_id", apart)
        dealt = _with_source(rows.join(self.odd, "doc_id", "left").withColumn("perm", perm), self.sources)
        number = F.expr("CASE WHEN size > 0 THEN pmod(xxhash64(perm), n) END").cast("int")
        return dealt.withColumn("block", number).drop("odd", "n")

    def taken(self, rows: DataFrame) -> DataFrame:
        """The rows with an array of their copies."""
        found = self.dealt(rows).join(self.copies, ["sid", "block"], "left").join(self.fits, "row", "left")
        kept = F.expr(
            "CASE WHEN copies IS NULL THEN cast(array() AS array<struct<epoch:int,shard:int>>)"
            " WHEN closing AND fits IS NULL THEN filter(copies, c -> c.epoch < epochs) ELSE copies END"
        )
        return found.withColumn("copies", kept)


def _draw(
    rows: DataFrame, weights: tuple[int, ...], most_epochs: int, block: int, shard_words: int, seed: int,
    least_blocks: int, least_shards: int,
) -> Draw:
    targets = staged(source_targets(rows, weights, most_epochs), "targets")
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    sources = targets.withColumn("epochs", epochs.cast("int")).withColumns(
        {
            "part": F.col("target") - F.col("epochs") * F.col("source_size"),
            "blocks": F.greatest(F.lit(least_blocks), F.ceil(F.col("source_size") / block)).cast("int"),
        }
    )
    sources = staged(sources, "sources")
    odd = rows.groupBy("doc_id").count().where("count > 1 AND doc_id IS NOT NULL")
    odd = staged(odd.select("doc_id", F.lit(True).alias("odd")), "odd")
    draw = Draw(seed, odd, targets, sources, odd, odd)
    dealt = staged(draw.dealt(rows), "dealt")

    # One row for each block from here on.
    order = Window.partitionBy("sid").orderBy(F.xxhash64(F.lit(seed), "sid", "block"), "block")
    before = F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1))
    blocks = dealt.where("block IS NOT NULL").groupBy("sid", "block").agg(F.sum("size").alias("words"))
    blocks = blocks.withColumns({"pos": F.row_number().over(order) - 1, "before": F.coalesce(before, F.lit(0))})
    blocks = blocks.withColumn("of", F.count("*").over(Window.partitionBy("sid")))
    blocks = blocks.join(sources.select("sid", "epochs", "part"), "sid")
    whole = F.expr("part > 0 AND before + words <= part")
    closing = F.expr("part > 0 AND before < part AND before + words > part")
    blocks = staged(blocks.withColumns({"whole": whole, "closing": closing, "left": F.expr("part - before")}), "blocks")

    times = F.col("epochs") + F.when(F.col("whole") | F.col("closing"), 1).otherwise(0)
    slots = blocks.where(times > 0).select(
        "sid", "block", "pos", "of", F.explode(F.sequence(F.lit(0), times - 1)).alias("epoch")
    )
    slots = slots.select("sid", "block", "epoch", (F.col("epoch") * F.col("of") + F.col("pos")).alias("slot"))
    drawn = staged(slots.groupBy("sid").agg(F.count("*").alias("blocks")), "drawn")
    words = targets.agg(F.sum("target")).first()[0] or 0.0
    quotas = staged(shard_quotas(drawn, max(least_shards, ceil(words / shard_words)), seed), "quotas")
    upto = F.sum("quota").over(Window.partitionBy("sid").orderBy("shard"))
    of_shard = quotas.withColumn("upto", upto).select(
        "sid", "shard", F.explode(F.sequence(F.col("upto") - F.col("quota"), F.col("upto") - 1)).alias("slot")
    )
    copies = slots.join(of_shard, ["sid", "slot"]).groupBy("sid", "block").agg(
        F.sort_array(F.collect_list(F.struct("epoch", "shard"))).alias("copies")
    )
    copies = copies.join(blocks.select("sid", "block", "epochs", "closing"), ["sid", "block"])

    last = dealt.join(blocks.where("closing").select("sid", "block", "left"), ["sid", "block"])
    last = last.select("sid", "row", "perm", "size", "left").groupBy("sid").applyInPandas(_closing_draw, "row long")
    fits = staged(last.withColumn("fits", F.lit(True)), "closing")
    return replace(draw, copies=staged(copies, "copies"), fits=fits)


def _with_source(dealt: DataFrame, sources: DataFrame) -> DataFrame:
    """The rows with sid and number of blocks of their source, null or not."""
    known = sources.select(F.col("source").alias("_source"), "sid", F.col("blocks").alias("n"))
    same = F.col("source").eqNullSafe(F.col("_source"))
    return dealt.join(known, same).drop("_source", "source")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    most_epochs: int = MOST_EPOCHS,
    block: int = BLOCK,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
    blocks: int = BLOCKS,
    shards: int = SHARDS,
) -> DataFrame:
    """The documents as often as the mix takes them, with mix_copy, mix_shard and mix_place.

    Documents are written to the shared folder once with their size and a row number, for the draw
    and the texts must mean the same rows. Texts meet only tables far smaller than they
    are, and are not shuffled while Spark can send those to the tasks.
    """
    own = [F.col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    held = staged(_measured(docs, F.monotonically_increasing_id(), id_col, text_col, source_col, *own), "rows")
    rows = held.select("row", "doc_id", "source", "size")
    draw = _draw(rows, weights, most_epochs, block, shard_words, seed, blocks, shards)
    out = draw.taken(held).withColumn("_copy", F.explode("copies"))
    added = ("mix_copy", "mix_shard", "mix_place")
    back = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns) if c.lower() not in added]
    place = _place(seed, F.col("_copy.shard"), F.col("_copy.epoch"))
    return out.select(
        *back,
        F.col("_copy.epoch").alias("mix_copy"),
        F.col("_copy.shard").alias("mix_shard"),
        place.alias("mix_place"),
    )


def write_shards(mixed: DataFrame, path: str) -> None:
    """The mix as a folder for each shard, in its shuffled order; a shard may be several files."""
    rows = mixed.repartitionByRange("mix_shard", "mix_place").sortWithinPartitions("mix_shard", "mix_place")
    rows.write.partitionBy("mix_shard").parquet(path)
