"""Samples whose categories meet target shares, allocated top-down over a category tree.

The tree of a design: its dimension, the categories of that dimension, and under
each category its leaves. Quotas go from the top down. What a leaf can't give
passes first to its siblings (leaves of the same category), then to cousins
(leaves of other categories). Leaves are drawn by a permuted dense rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ranks import permuted_rank, shared_out
from tidemark.session import checkpointed, if_small


def _dimensions() -> dict[str, tuple[Column, Column]]:
    """Category and leaf of a record by dimension."""
    decade = F.concat((F.floor(F.col("decimal_year") / 10) * 10).cast("long").cast("string"), F.lit("s"))
    return {
        "host_group": (F.col("host_group"), F.col("country")),
        "clade": (F.col("clade"), F.col("host_group")),
        "decade": (decade, F.floor(F.col("decimal_year")).cast("string")),
    }


def category_members(records: DataFrame) -> DataFrame:
    """dimension, category, accession, leaf, at: each record under the categories it belongs to.

    Null categories and accessions are none; a null leaf is the leaf ''. ``at``
    orders rows of an accession (the latest load last).
    """
    parts = F.array(*(F.struct(F.lit(d).alias("dimension"), c.cast("string").alias("category"), F.coalesce(leaf.cast("string"), F.lit("")).alias("leaf")) for d, (c, leaf) in _dimensions().items()))
    rows = records.select("accession", F.struct("load_id", "row_id").alias("at"), F.explode(parts).alias("p"))
    return rows.select("p.dimension", "p.category", "p.leaf", "accession", "at").where("category is not null and accession is not null")


def available(members: DataFrame) -> DataFrame:
    """dimension, category, n_available: distinct accessions of every category."""
    return members.groupBy("dimension", "category", "accession").agg(F.lit(1).alias("one")).groupBy("dimension", "category").agg(F.count(F.lit(1)).alias("n_available"))


def target_needs(targets: DataFrame) -> DataFrame:
    """Distinct targets with ``need``: the larger of target_share x sample_size and min_rows (null as 0)."""
    return targets.distinct().withColumn("need", F.greatest(F.col("target_share") * F.col("sample_size"), F.coalesce("min_rows", F.lit(0)).cast("double")))


def unmet_targets(members: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """design_id, category, n_available, need of the targets that their category can't meet.

    The designs are drawn (``draw_samples``) and their drawn records counted: a
    category that can't meet its need is drawn short of it. An accession is drawn
    under its latest category only, so the lines that came out short are counted
    again exactly, over every category in which an accession was ever recorded.
    Repeated lines count once.
    """
    drawn = draw_samples(members, targets, seed).groupBy("design_id", "category").agg(F.count(F.lit(1)).alias("n_drawn"))
    lines = target_needs(targets).join(drawn, ["design_id", "category"], "left")
    short = checkpointed(lines.where(F.coalesce("n_drawn", F.lit(0)) < F.col("need")).drop("n_drawn"))
    held = available(members.join(if_small(short.select("dimension", "category").distinct()), ["dimension", "category"], "left_semi"))
    exact = short.join(held, ["dimension", "category"], "left").withColumn("n_available", F.coalesce("n_available", F.lit(0)))
    return exact.where("n_available < need").select("design_id", "category", "n_available", "need")


def allocate(members: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Top-down allocation: (pool, leaf quotas, category report).

    pool has one row per dimension and accession (by its latest row). A category
    starts from its need, rounded up; leaves share it evenly up to what they hold
    (siblings take over), and what the category lacks of it goes to the other
    categories of the design (cousins) by their target shares, again up to what
    they hold.
    """
    pool = checkpointed(members.groupBy("dimension", "accession").agg(F.max_by(F.struct("category", "leaf"), "at").alias("m")).select("dimension", "accession", "m.category", "m.leaf"))
    leaves = checkpointed(pool.groupBy("dimension", "category", "leaf").agg(F.count(F.lit(1)).alias("capacity")))
    held = leaves.groupBy("dimension", "category").agg(F.sum("capacity").alias("held"))
    lines = target_needs(targets).join(held, ["dimension", "category"], "left").withColumn("held", F.coalesce("held", F.lit(0)))
    lines = lines.withColumn("quota", F.ceil(F.round("need", 6)).cast("long")).withColumn("own", F.least("quota", "held"))
    design = Window.partitionBy("design_id")
    lines = lines.withColumn("_unmet", F.sum(F.col("quota") - F.col("own")).over(design)).withColumn("_spare", F.col("held") - F.col("own"))
    lines = shared_out(lines, ["design_id"], "_unmet", "_spare", ["category"], "from_cousins", "target_share")
    report = lines.select("design_id", "dimension", "category", "target_share", "min_rows", "sample_size", "need", "held", "quota", "own", "from_cousins", (F.col("own") + F.col("from_cousins")).alias("n_drawn"))
    plan = report.select("design_id", "dimension", "category", "n_drawn").join(leaves, ["dimension", "category"])
    quotas = shared_out(plan, ["design_id", "category"], "n_drawn", "capacity", ["leaf"], "leaf_quota")
    return pool, quotas.select("design_id", "dimension", "category", "leaf", "capacity", "leaf_quota"), report


def draw_samples(members: DataFrame, targets: DataFrame, seed: int = 17) -> DataFrame:
    """design_id, category, leaf, accession: the records drawn for every design.

    An accession is drawn at most once per design. Ranks come from a hash of
    design and accession, so a run can be repeated. A leaf is ranked in hash ranges
    as many as it holds, and only ranges that reach into its quota are sorted.
    """
    pool, quotas, _ = allocate(members, targets)
    wanted = checkpointed(quotas.where("leaf_quota > 0"))
    candidates = pool.join(if_small(wanted), ["dimension", "category", "leaf"]).withColumn("_seed", F.col("design_id") * 1_000_003 + seed)
    ranked = permuted_rank(candidates, ["design_id", "category", "leaf"], ["accession"], F.col("_seed"), size="capacity", upto="leaf_quota")
    return ranked.select("design_id", "category", "leaf", "accession")


def sample_report(members: DataFrame, targets: DataFrame) -> DataFrame:
    """Target against allocation by design and category: n_drawn, actual_share, met, from_cousins."""
    _, _, report = allocate(members, targets)
    total = F.sum("n_drawn").over(Window.partitionBy("design_id"))
    return report.select("design_id", "dimension", "category", "target_share", "need", "held", "n_drawn", "from_cousins", (F.col("n_drawn") / F.nullif(total, F.lit(0))).alias("actual_share"), (F.col("held") >= F.col("need")).alias("met"))
