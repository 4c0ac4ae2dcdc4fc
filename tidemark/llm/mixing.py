"""Sources mixed to target weights of a total size.

Every source gives an exact number of whole passes over its texts and a part of
one more; passes are cut into blocks of texts in permuted order. A splitting
tree deals the blocks out: at every node the block counts of the sources are
split between the two halves of its shards by a multivariate hypergeometric
draw, so each shard holds a random mix and the totals stay exact. Shards are
shuffled locally.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ranks import permuted_rank, range_bits
from tidemark.session import checkpointed, if_small


#: Uses of texts that a shard is to hold, and blocks that it is put together from.
USES_A_SHARD, BLOCKS_A_SHARD = 5_000, 256
#: Level of the splitting tree from which its nodes are spread over tasks.
SPREAD_LEVEL = 6


def source_plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target line: wanted, held, planned (tokens), n_texts, passes (whole) and part (tokens of one more pass).

    ``sizes`` has source and n_tokens by text. A source plans at most
    max_repeats passes. A source without texts holds 0 tokens; null max_repeats
    counts as 0, null shares as 0. Repeated lines count once.
    """
    held = sizes.groupBy("source").agg(F.sum("n_tokens").alias("held"), F.count_if(F.col("n_tokens") > 0).alias("n_texts"))
    wanted = F.coalesce(F.col("target_share") * F.col("total_tokens"), F.lit(0.0))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("held", "n_texts", "max_repeats")}
    lines = targets.where("source is not null").distinct().join(held, "source", "left").withColumns(zero | {"wanted": wanted})
    lines = lines.withColumn("planned", F.least(F.round("wanted").cast("long"), F.col("held") * F.col("max_repeats")))
    passes = F.coalesce(F.floor(F.col("planned") / F.nullif("held", F.lit(0))), F.lit(0)).cast("int")
    return lines.withColumn("passes", passes).withColumn("part", F.col("planned") - F.col("passes") * F.col("held"))


def drawn_blocks(sizes: DataFrame, plan: DataFrame, seed: int, texts: float) -> DataFrame:
    """source, copy, block, key, n_tokens: the texts that are drawn, by pass and block.

    Blocks are ranges of a hash of pass and key, of about ``texts`` texts. Of the partial pass the first
    blocks count whole, and of the block at the border its first texts, up to the
    one nearest to the plan; only that block is sorted.
    """
    keep = plan.select("source", "passes", "part", range_bits(F.col("n_texts"), texts).alias("block_bits")).where("passes > 0 or part > 0")
    rows = sizes.where("n_tokens > 0").join(if_small(keep), "source")
    rows = rows.withColumn("copy", F.explode(F.expr("sequence(0, passes - if(part > 0, 0, 1))")))
    rows = rows.withColumn("_h", F.xxhash64(F.lit(seed), "copy", "key")).withColumn("block", F.expr("shiftrightunsigned(_h, 64 - block_bits)"))
    whole, partial = rows.where("copy < passes"), rows.where("copy = passes")
    blocks = partial.groupBy("source", "block").agg(F.sum("n_tokens").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("source").orderBy("block")) - F.col("_n")
    starts = checkpointed(blocks.withColumn("_before", before).join(keep.select("source", "part"), "source").where("_before < part").drop("part"))
    partial = partial.join(if_small(starts), ["source", "block"])
    inside = F.sum("n_tokens").over(Window.partitionBy("source", "block").orderBy("_h", "key"))
    border = partial.where("_before + _n > part").withColumn("_upto", F.col("_before") + inside).where("_upto - n_tokens / 2 <= part")
    columns = ["source", "copy", "block", "key", "n_tokens"]
    return whole.select(*columns).unionAll(partial.where("_before + _n <= part").select(*columns)).unionAll(border.select(*columns))


def split_quotas(blocks: DataFrame, depth: int, seed: int) -> DataFrame:
    """source, shard, quota: blocks of every source dealt out over ``2 ** depth`` shards.

    One row per node of the splitting tree goes from level to level; its children
    come from a hypergeometric draw seeded by the node. From ``SPREAD_LEVEL`` on
    the nodes are spread over tasks. Rows are bounded by the shards, their arrays
    by the sources.
    """
    counts = blocks.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    nodes = counts.groupBy().agg(F.array_sort(F.collect_list(F.struct("source", "n"))).alias("c")).select(F.lit(1).cast("long").alias("node"), F.col("c.source").alias("sources"), F.col("c.n").alias("counts"))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for node, sources, n in batch.itertuples(index=False, name=None):
                n = np.asarray(n, np.int64)
                rng = np.random.default_rng([seed, int(node)])
                half = (int(n.sum()) + 1) // 2
                left = rng.multivariate_hypergeometric(n, half, method="marginals") if half else n
                out += [(2 * node, sources, left.tolist()), (2 * node + 1, sources, (n - left).tolist())]
            yield pd.DataFrame(out, columns=["node", "sources", "counts"])

    for level in range(depth):
        nodes = nodes.repartition("node") if level == SPREAD_LEVEL else nodes
        nodes = nodes.mapInPandas(split, "node long, sources array<string>, counts array<long>")
    quotas = nodes.select((F.col("node") - (1 << depth)).alias("shard"), F.explode(F.arrays_zip("sources", "counts")).alias("q"))
    return quotas.select("shard", F.col("q.sources").alias("source"), F.col("q.counts").alias("quota"))


def dealt_blocks(blocks: DataFrame, depth: int, seed: int) -> DataFrame:
    """source, copy, block, shard: disjoint runs of a source's blocks in permuted order, as long as the quotas of the tree."""
    quotas = checkpointed(split_quotas(blocks, depth, seed).where("quota > 0"))
    upto = F.sum("quota").over(Window.partitionBy("source").orderBy("shard"))
    places = quotas.withColumn("_to", upto).select("source", "shard", F.explode(F.sequence(F.col("_to") - F.col("quota") + 1, F.col("_to"))).alias("rank"))
    ranked = permuted_rank(blocks, ["source"], ["copy", "block"], seed + 1)
    return ranked.join(places, ["source", "rank"]).select("source", "copy", "block", "shard")


def mix_sources(sizes: DataFrame, targets: DataFrame, depth: int | None = None, seed: int = 5) -> DataFrame:
    """The mix: shard, position, source, key, copy, n_tokens; one row per use of a text.

    ``sizes`` has key, source and n_tokens by text (it is read several times). A
    text is used at most max_repeats times, the tokens of a source stay within one
    text of its plan. The tree is as deep as shards of about ``USES_A_SHARD`` uses
    need, or ``depth``; a shard is an even share of the blocks and is shuffled by
    itself. Empty texts have no size and aren't drawn.
    """
    plan = checkpointed(source_plan(sizes, targets))
    uses = plan.agg(F.sum(F.col("n_texts") * F.col("planned") / F.nullif("held", F.lit(0)))).first()[0] or 1.0
    depth = max(0, math.ceil(math.log2(uses / USES_A_SHARD))) if depth is None else depth
    drawn = checkpointed(drawn_blocks(sizes, plan, seed, uses / (1 << depth) / BLOCKS_A_SHARD))
    blocks = checkpointed(drawn.select("source", "copy", "block").distinct())
    rows = drawn.join(if_small(checkpointed(dealt_blocks(blocks, depth, seed))), ["source", "copy", "block"])
    order = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed + 2), "key", "copy"), "key", "copy")
    return rows.select("shard", F.row_number().over(order).alias("position"), "source", "key", "copy", "n_tokens")


def mix_report(sizes: DataFrame, targets: DataFrame, seed: int = 5) -> DataFrame:
    """By target line: target_share, wanted, held, planned and drawn tokens, actual_share of all drawn, repeats, met.

    drawn counts what the shards of ``mix_sources`` hold. repeats is how often a
    text is used at most; met is false where the source can't give its share
    within max_repeats.
    """
    plan = checkpointed(source_plan(sizes, targets))
    drawn = mix_sources(sizes, targets, seed=seed).groupBy("source").agg(F.sum("n_tokens").alias("drawn"))
    lines = plan.join(drawn, "source", "left").withColumn("drawn", F.coalesce("drawn", F.lit(0)))
    total = F.sum("drawn").over(Window.partitionBy())
    repeats = F.col("passes") + F.when(F.col("part") > 0, 1).otherwise(0)
    return lines.select("source", "target_share", "wanted", "held", "planned", "drawn", (F.col("drawn") / F.nullif(total, F.lit(0))).alias("actual_share"), repeats.alias("repeats"), (F.col("held") * F.col("max_repeats") >= F.col("wanted")).alias("met"))


def short_sources(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Lines whose source can't give its share: source, held, wanted, drawn.

    The mix is drawn and dealt out; a source that can't give its share comes out
    short of it in the shards. Of the sources that did, those count whose tokens
    times max_repeats are less than the share (others miss it by part of a text).
    """
    return mix_report(sizes, targets).where((F.col("drawn") < F.col("wanted")) & ~F.col("met")).select("source", "held", "wanted", "drawn")
