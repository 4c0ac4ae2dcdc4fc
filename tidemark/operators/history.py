"""States through time from intervals, and stratified samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ranks import joined_null_safe, ordered_rank
from tidemark.session import checkpointed, if_small


def states_through_time(intervals: DataFrame, unit: str, start: str, end: str, state: str, step: float = 1.0, min_total: float = 0.0) -> DataFrame:
    """slice, state, mean, proportion, enrichment: intervals that cover each grid point, by state.

    A slice covers both ends. mean is over the units (trees, orders), proportion
    within the slice, enrichment against the state's share of all intervals.
    Intervals are exploded to the grid points they cover, so no range join is needed.
    """
    rows = intervals.where(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
    units = rows.agg(F.count_distinct(unit)).first()[0] or 1
    grid = rows.select(state, F.explode(F.expr(f"if(ceil({start} / {step}) <= floor({end} / {step}), sequence(cast(ceil({start} / {step}) as bigint), cast(floor({end} / {step}) as bigint)), array())")).alias("slice"))
    counts = grid.groupBy("slice", state).agg(F.count(F.lit(1)).alias("n"))
    shares = rows.groupBy(state).agg(F.count(F.lit(1)).alias("m"))
    shares = shares.select(state, (F.col("m") / F.sum("m").over(Window.partitionBy())).alias("share"))
    total = F.sum("n").over(Window.partitionBy("slice"))
    out = counts.withColumn("total", total).where(F.col("total") >= min_total).join(if_small(checkpointed(shares)), state)
    p = F.col("n") / F.col("total")
    return out.select((F.col("slice") * step).alias("slice"), state, F.round(F.col("n") / units, 6).alias("mean"), F.round(p, 6).alias("proportion"), F.round(p / F.col("share"), 6).alias("enrichment"), "n", "total")


def enrichment_thirds(series: DataFrame, state: str) -> DataFrame:
    """state, third, enrichment, n_slices: early, middle and late thirds of the slices, weighted by their totals, and how to read it.

    The third is max(1, slices // 3); enriched from 1.25, strongly from 1.5.
    """
    slices = series.select("slice").distinct()
    numbered = slices.select("slice", F.row_number().over(Window.orderBy("slice")).alias("i"), F.count(F.lit(1)).over(Window.partitionBy()).alias("n"))
    third = F.greatest(F.lit(1), F.floor(F.col("n") / 3))
    label = F.when(F.col("i") <= third, "early").when(F.col("i") > F.col("n") - third, "late").otherwise("middle")
    out = series.join(if_small(checkpointed(numbered.select("slice", label.alias("third")))), "slice").groupBy(state, "third").agg((F.sum(F.col("enrichment") * F.col("total")) / F.sum("total")).alias("e"), F.count(F.lit(1)).alias("n_slices"))
    return out.select(state, "third", F.round("e", 4).alias("enrichment"), "n_slices", F.when(F.col("e") >= 1.5, "strong").when(F.col("e") >= 1.25, "enriched").otherwise("none").alias("reading"))


def stratified_sample(df: DataFrame, strata: list[str], key: str, better: list, target: int, least: int = 1, first: Column | None = None) -> DataFrame:
    """``strata``, key, n_stratum: about ``target`` rows spread over strata, the best of each.

    Every stratum gives ``least``; the rest goes by the square root of what is left
    of a stratum, cut to whole rows, and what that leaves goes to the largest strata
    in turn. With ``target`` strata or more, those where ``first`` holds, then the
    largest, give one each. Nulls in ``strata`` are values. Strata are few; their
    rows are ranked by one sort over all partitions.
    """
    sizes = df.groupBy(*strata).agg(F.count(F.lit(1)).alias("n_stratum"))
    whole = Window.partitionBy()
    name = F.concat_ws("|", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in strata))
    by_size = Window.orderBy(F.desc("n_stratum"), name)
    by_turn = Window.orderBy(*([F.desc(F.coalesce(first, F.lit(False)))] if first is not None else []), F.desc("n_stratum"), name)
    sizes = sizes.withColumns({"k": F.count(F.lit(1)).over(whole), "w": F.sqrt(F.greatest(F.col("n_stratum") - least, F.lit(0))), "place": F.row_number().over(by_turn)})
    rest = F.greatest(F.lit(target) - F.col("k") * least, F.lit(0))
    share = F.coalesce(F.floor(F.round(rest * F.col("w") / F.nullif(F.sum("w").over(whole), F.lit(0.0)), 6)), F.lit(0))
    sizes = sizes.withColumn("base", F.least("n_stratum", least + share))
    sizes = sizes.withColumn("room", F.col("n_stratum") - F.col("base"))
    left = F.greatest(F.lit(target) - F.sum("base").over(whole), F.lit(0))
    upto = F.sum("room").over(by_size)
    extra = F.greatest(F.lit(0), F.least(F.col("room"), left - (upto - F.col("room"))))
    quota = F.when(F.col("k") >= target, F.when(F.col("place") <= target, 1).otherwise(0)).otherwise(F.col("base") + extra)
    quotas = checkpointed(sizes.select(*strata, "n_stratum", quota.alias("quota")))
    ranked = ordered_rank(joined_null_safe(df, quotas.where("quota > 0"), strata), strata, [*better, key], "_r")
    return ranked.where(F.col("_r") <= F.col("quota")).select(*strata, key, "n_stratum")
