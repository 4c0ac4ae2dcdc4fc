"""Statistics of dated, labelled rows that end in a verdict."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ranks import md5_rank
from tidemark.session import checkpointed

try:
    from _md5 import md5  # for short texts it takes under half the time of hashlib's
except ImportError:
    from hashlib import md5

#: Rows of a group up to which one task takes it whole, in arrays.
ROWS_A_TASK = 3_000_000
#: Tasks among which the replicates of a group are dealt; each gets the rows of the group.
PARTS = 2


def decimal_year(ts: Column) -> Column:
    """Year and the share of it that has passed, by whole days."""
    y = F.year(ts)
    return y + (F.dayofyear(ts) - 1) / F.dayofyear(F.make_date(y, F.lit(12), F.lit(31)))


def regressions(df: DataFrame, group: str, x: str, y: str) -> DataFrame:
    """group, n, slope, intercept, r_squared, x_intercept (with a positive slope only); zeros where x or y doesn't vary or n < 3."""
    agg = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.regr_slope(y, x).alias("s"), F.regr_intercept(y, x).alias("i"), F.corr(x, y).alias("r"), F.avg(y).alias("m"))
    fit = (F.col("n") >= 3) & F.col("s").isNotNull() & F.col("r").isNotNull() & ~F.isnan("r")
    slope = F.when(fit, F.col("s")).otherwise(0.0)
    intercept = F.when(fit, F.col("i")).otherwise(F.col("m"))
    return agg.select(group, "n", slope.alias("slope"), intercept.alias("intercept"), F.when(fit, F.col("r") * F.col("r")).otherwise(0.0).alias("r_squared"), F.when(slope > 0, -intercept / slope).alias("x_intercept"))


def sampling_diagnostics(df: DataFrame, group: str, x: str, window: int = 10) -> DataFrame:
    """group, span, occupancy (years with a row over years spanned) and densest (greatest share of rows in ``window`` whole years).

    Years are counted first; the window runs over counts.
    """
    years = df.where(F.col(x).isNotNull()).groupBy(group, F.floor(x).cast("int").alias("yr")).agg(F.count(F.lit(1)).alias("c"), F.min(x).alias("lo"), F.max(x).alias("hi"))
    ahead = F.sum("c").over(Window.partitionBy(group).orderBy("yr").rangeBetween(0, window - 1))
    return years.withColumn("w", ahead).groupBy(group).agg((F.max("hi") - F.min("lo")).alias("span"), (F.count(F.lit(1)) / (F.max("yr") - F.min("yr") + 1)).alias("occupancy"), (F.max("w") / F.sum("c")).alias("densest"))


def permutation_p(df: DataFrame, group: str, key: str, x: str, y: str, replicates: int) -> DataFrame:
    """group, p: (hits + 1) / (n + 1) of slopes under permuted y at least as great as the real one.

    A replicate pairs the rows in order of one hash with the rows in order of
    another: both ranks come from hash ranges, so no group is sorted in one task.
    """
    rows = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    reps = rows.select(group, key, x, y, F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("rep"))

    def ranked(salt: str, value: str) -> DataFrame:
        salted = F.concat_ws("|", F.lit(salt), F.col("rep").cast("string"), F.col(key).cast("string"))
        return md5_rank(reps, [group, "rep"], salted, "r").select(group, "rep", "r", value)

    slopes = ranked("x", x).join(ranked("y", y), [group, "rep", "r"]).groupBy(group, "rep").agg(F.regr_slope(y, x).alias("s"))
    real = rows.groupBy(group).agg(F.regr_slope(y, x).alias("real"))
    hits = F.count_if(F.round("s", 9) >= F.round("real", 9))
    return slopes.join(real, group).groupBy(group).agg(((hits + 1) / (F.count(F.lit(1)) + 1)).alias("p"))


def grouped_p(df: DataFrame, group: str, key: str, x: str, y: str, replicates: int, drawn: bool = False, seed: int = 12345, rows_a_task: int = ROWS_A_TASK) -> DataFrame:
    """As ``permutation_p``, for few groups of many rows: a group stays in arrays, so no row is repeated by replicate.

    With ``drawn`` permutations are random orders of y (by seed, replicate and
    size, whatever the order of rows) instead of those by md5. Rows are sent once
    for each of ``PARTS`` parts of the replicates. Groups over ``rows_a_task`` rows,
    which are too large for that, go through ``permutation_p`` with all their rows.
    """
    rows = df.where(F.col(group).isNotNull() & F.col(x).isNotNull() & F.col(y).isNotNull()).select(F.col(group).alias("g"), F.lit("").alias("k") if drawn else F.col(key).cast("string").alias("k"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    sizes = checkpointed(df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n")))
    large = sizes.where(F.col("n") > rows_a_task).select(group)
    parts = min(PARTS, replicates)

    def hits(table):
        import numpy as np
        import pyarrow as pa

        def md5_order(salt: bytes) -> np.ndarray:
            digests = [np.frombuffer(b"".join([md5(salt + k).digest() for k in names[i : i + 50_000]]), ">u8").reshape(-1, 2).astype(np.uint64) for i in range(0, len(names), 50_000)]
            high, low = np.concatenate(digests).T
            order = np.argsort(high)
            ties = high[order]
            return np.lexsort((low, high)) if (ties[1:] == ties[:-1]).any() else order

        names = [] if drawn else [b"" if k is None else b"|" + k.encode() for chunk in table["k"].chunks for k in chunk.to_pylist()]
        part = table["part"][0].as_py()
        a, b = (table[c].to_numpy() for c in "xy")
        a, b, n, varies = a - a.mean(), b - b.mean(), len(a), a.min() != a.max()
        mine, found = range(part + 1, replicates + 1, parts), 0
        if varies:
            if drawn:
                order = np.lexsort((b, a))
                a, b = a[order], b[order]
            square = a @ a
            real = a @ b / square
            for rep in mine:
                if drawn:
                    cross = a @ np.random.default_rng([seed, rep, n]).permutation(b)
                else:
                    cross = a[md5_order(b"x|%d" % rep)] @ b[md5_order(b"y|%d" % rep)]
                found += bool(np.isnan(real) or np.round(cross / square, 9) >= np.round(real, 9))
        return pa.table({"g": table["g"].slice(0, 1), "hits": pa.array([found], pa.int64()), "n": pa.array([len(mine)], pa.int64())})

    fitting = rows.join(F.broadcast(large.withColumnRenamed(group, "g")), "g", "left_anti").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # The number of partitions is given, as few bytes would else be put into few tasks.
    tasks = max(1, min(200, 4 * parts * sizes.count()))
    done = fitting.repartition(tasks, "g", "part").groupBy("g", "part").applyInArrow(hits, f"g {dict(df.dtypes)[group]}, hits long, n long")
    out = done.groupBy(F.col("g").alias(group)).agg(((F.sum("hits") + 1) / (F.sum("n") + 1)).alias("p"))
    return out if large.isEmpty() else out.unionByName(permutation_p(df.join(F.broadcast(large), group), group, key, x, y, replicates))


def temporal_signal(df: DataFrame, group: str, key: str, x: str, y: str, replicates: int = 1000, min_r2: float = 0.1, min_span: float = 5.0, max_concentration: float = 0.75, drawn: bool = False) -> DataFrame:
    """Regression, sampling diagnostics, permutation p and verdict of each group; ``drawn`` as in ``grouped_p``.

    ``fail``: no positive slope, p above 0.05 or too short a span, or a slope near
    -1 with a high r_squared (lengths are years and run backwards); ``weak``: low
    r_squared or most rows within ten years; else ``pass``.
    """
    out = regressions(df, group, x, y).join(sampling_diagnostics(df, group, x), group).join(grouped_p(df, group, key, x, y, replicates, drawn), group)
    inverted = (F.abs(F.col("slope") + 1) < 0.05) & (F.col("r_squared") > 0.8)
    verdict = F.when(inverted | (F.col("slope") <= 0) | (F.col("p") > 0.05) | (F.col("span") < min_span), "fail").when((F.col("r_squared") < min_r2) | (F.col("densest") > max_concentration), "weak").otherwise("pass")
    return out.select(group, "n", *(F.round(c, 6).alias(c) for c in ("slope", "r_squared", "span", "occupancy", "densest", "p")), verdict.alias("verdict"))


def rayleigh(df: DataFrame, group: str, phase: str) -> DataFrame:
    """group, n, r, z, p of the Rayleigh test on phases in [0, 1); (0, 0, 1) with fewer than eight rows."""
    angle = F.col(phase) * (2 * math.pi)
    agg = df.where(F.col(phase).isNotNull()).groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.avg(F.cos(angle)).alias("c"), F.avg(F.sin(angle)).alias("s"))
    agg = agg.withColumn("r", F.sqrt(F.col("c") ** 2 + F.col("s") ** 2)).withColumn("z", F.col("n") * F.col("r") ** 2)
    z, n = F.col("z"), F.col("n")
    p = F.exp(-z) * (1 + (2 * z - z**2) / (4 * n))
    few = n < 8
    return agg.select(group, "n", F.round(F.when(few, 0.0).otherwise(F.col("r")), 6).alias("r"), F.round(F.when(few, 0.0).otherwise(z), 6).alias("z"), F.round(F.when(few, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), p))), 6).alias("p"))


#: Half width in years of a date by its precision; others count as ``unknown``. Fixed values.
HALF_WIDTHS = {"day": 0.5 / 365.25, "month": 0.5 / 12, "year": 0.5, "range": 0.5, "unknown": 0.5}
PRECISE = ("day", "month")


def date_policies(records: DataFrame, group: str, year: str = "decimal_year", precision: str = "date_precision", substitutions: float | None = None, floor: float = 0.3, ceiling: float = 1.0, alpha: float = 0.05, max_shift: float = 0.08, exclude: float = 0.1) -> DataFrame:
    """By group, how imprecise dates are to be used: ``midpoint`` or ``interval``, and how sure that is.

    Columns: group, n, n_imprecise, imprecise_share, mean_half_width, n_precise, r,
    p (Rayleigh test on the precise dates within their year), shift (their mean
    place in the year less a half), seasonal, policy, confidence. In this order:
    no imprecise date, ``midpoint`` strong; a share under ``exclude`` without
    seasonal bias, the same; seasonal bias (p below ``alpha`` and a shift beyond
    ``max_shift``, from eight precise dates on), ``interval`` strong; without
    ``substitutions`` (those of a genome in a year), ``midpoint`` marginal; at
    least ``ceiling`` of them, ``interval``, strong from a share of a half on, else
    moderate; under ``floor``, ``midpoint`` strong; else ``interval`` marginal.
    Rows without a year don't count.
    """
    kind = F.when(F.col(precision).isin(*HALF_WIDTHS), F.col(precision)).otherwise("unknown")
    rows = records.where(F.col(year).isNotNull()).select(F.col(group).alias("_g"), F.col(year).alias("y"), kind.alias("kind"))
    width = F.coalesce(*(F.when(F.col("kind") == k, F.lit(v)) for k, v in HALF_WIDTHS.items()))
    precise = F.col("kind").isin(*PRECISE)
    phase = F.when(precise, F.col("y") - F.floor("y"))
    angle = phase * (2 * math.pi)
    agg = rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), F.count_if(~precise).alias("n_imprecise"), F.avg(width).alias("w"), F.count_if(precise).alias("n_precise"), F.avg(F.cos(angle)).alias("c"), F.avg(F.sin(angle)).alias("s"), F.avg(phase).alias("mean"))
    enough = F.col("n_precise") >= 8
    agg = agg.withColumns({"share": F.col("n_imprecise") / F.col("n"), "r": F.when(enough, F.sqrt(F.col("c") ** 2 + F.col("s") ** 2))})
    z = F.col("n_precise") * F.col("r") ** 2
    agg = agg.withColumns({"p": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.exp(-z) * (1 + (2 * z - z**2) / (4 * F.col("n_precise"))))), "shift": F.when(enough, F.col("mean") - 0.5)})
    p = F.when(enough, F.col("p"))
    seasonal = F.coalesce((p < alpha) & (F.abs("shift") > max_shift), F.lit(False))
    answer = lambda policy, confidence: F.struct(F.lit(policy).alias("policy"), F.lit(confidence).alias("confidence"))
    chosen = F.when(F.col("n_imprecise") == 0, answer("midpoint", "strong")).when((F.col("share") < exclude) & ~seasonal, answer("midpoint", "strong")).when(seasonal, answer("interval", "strong"))
    if substitutions is None:
        chosen = chosen.otherwise(answer("midpoint", "marginal"))
    elif substitutions >= ceiling:
        chosen = chosen.when(F.col("share") < 0.5, answer("interval", "moderate")).otherwise(answer("interval", "strong"))
    else:
        chosen = chosen.otherwise(answer("midpoint", "strong") if substitutions < floor else answer("interval", "marginal"))
    six = lambda c, name: F.round(c, 6).alias(name)
    return agg.select(F.col("_g").alias(group), "n", "n_imprecise", six("share", "imprecise_share"), six("w", "mean_half_width"), "n_precise", six("r", "r"), six(p, "p"), six("shift", "shift"), seasonal.alias("seasonal"), chosen.alias("a")).select("*", "a.*").drop("a")


def verdict_changes(table: DataFrame) -> DataFrame:
    """Clades whose verdict differs from that in the next earlier file: rank compared, ``worse``, ``better``, ``gone`` or ``new``.

    Ranks: pass 3, weak 2, inconclusive 1, fail 0; other texts have none and
    count as ``other``.
    """
    files = table.select("pathogen", "kind", "build_date").distinct()
    pairs = files.withColumn("prev", F.lag("build_date").over(Window.partitionBy("pathogen", "kind").orderBy("build_date"))).where("prev is not null")
    keep = table.where("clade is not null").groupBy("pathogen", "kind", "build_date", "clade").agg(F.max("verdict").alias("verdict"))
    now = keep.join(pairs, ["pathogen", "kind", "build_date"]).select("pathogen", "kind", "build_date", "clade", F.col("verdict").alias("after"), F.lit(1).alias("has_after"))
    then = keep.withColumnRenamed("build_date", "prev").join(pairs, ["pathogen", "kind", "prev"]).select("pathogen", "kind", "build_date", "clade", F.col("verdict").alias("before"), F.lit(1).alias("has_before"))
    both = now.join(then, ["pathogen", "kind", "build_date", "clade"], "full_outer")
    rank = lambda c: F.when(F.col(c) == "pass", 3).when(F.col(c) == "weak", 2).when(F.col(c) == "inconclusive", 1).when(F.col(c) == "fail", 0)
    change = F.when(F.col("has_before").isNull(), "new").when(F.col("has_after").isNull(), "gone").when(rank("after") < rank("before"), "worse").when(rank("after") > rank("before"), "better").otherwise("other")
    return both.where("has_before is null or has_after is null or not (before <=> after)").select("pathogen", "kind", "build_date", "clade", "before", "after", change.alias("change"))


def prior_checks(fits: DataFrame, group: str, prior: float) -> DataFrame:
    """group, slope, ratio, level: a prior rate against the measured slope.

    ``error`` without a positive slope or beyond a factor of 10, ``warn`` beyond 3, else ``ok``.
    """
    ratio = F.when(F.col("slope") > 0, F.lit(prior) / F.col("slope"))
    level = F.when(ratio.isNull() | (ratio > 10) | (ratio < 0.1), "error").when((ratio > 3) | (ratio < 1 / 3), "warn").otherwise("ok")
    return fits.select(group, F.round("slope", 6).alias("slope"), F.round(ratio, 4).alias("ratio"), level.alias("level"))


def state_designs(records: DataFrame, by: str, state: str, min_share: float = 0.05) -> DataFrame:
    """by, n_states, n_other, n_rates, smallest: states of each part once those under ``min_share`` are one state ``other``.

    n_rates is that of a symmetric exchange between all states. Null states don't count.
    """
    counts = records.where(F.col(state).isNotNull()).groupBy(by, state).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(by))
    folded = counts.withColumn("s", F.when(share < min_share, "other").otherwise(F.col(state))).groupBy(by, "s").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
    out = folded.groupBy(by).agg(F.count(F.lit(1)).alias("n_states"), F.coalesce(F.sum(F.when(F.col("s") == "other", F.col("k"))), F.lit(0)).alias("n_other"), F.min("n").alias("smallest"))
    return out.select(by, "n_states", "n_other", (F.col("n_states") * (F.col("n_states") - 1) / 2).cast("long").alias("n_rates"), "smallest")
