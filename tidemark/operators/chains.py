"""Sample chains: burn-in, intervals, overlap, effective size, and the verdicts on them.

A chain is a group of rows in an order; its values are samples. Orders inside a
chain come from ranks by value ranges, so a long chain is never sorted in one task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.ranks import value_rank
from tidemark.session import checkpointed, if_small


def after_burnin(df: DataFrame, chain: str, order: str, fraction: float, every: int = 1) -> DataFrame:
    """``df`` without the first round(fraction x n) rows of each chain (half to even), of the rest every ``every``-th; adds idx."""
    sizes = df.groupBy(chain).agg(F.count(order).alias("_size"))
    ranked = value_rank(df, [chain], order, order, "_r").join(sizes, chain)
    skip = F.bround(F.col("_size") * fraction)
    idx = F.col("_r") - 1 - skip
    return ranked.where((idx >= 0) & (idx % every == 0)).withColumn("idx", (idx / every).cast("long")).drop("_size", "_r")


def shortest_intervals(df: DataFrame, chain: str, value: str, key: str, level: float = 0.95) -> DataFrame:
    """chain, n, lo, hi: the shortest interval over k = max(1, floor(level x n)) steps of the sorted values, the lowest of equals."""
    ranked = value_rank(df, [chain], value, key).select(chain, value, "rank")
    sizes = ranked.groupBy(chain).agg(F.count(F.lit(1)).alias("n"))
    ranked = ranked.join(sizes, chain).withColumn("k", F.least(F.greatest(F.lit(1), F.floor(F.col("n") * level)), F.greatest(F.col("n") - 1, F.lit(0))))
    ends = ranked.select(chain, F.col(value).alias("_hi"), (F.col("rank") - F.col("k")).alias("rank"))
    pairs = ranked.join(ends, [chain, "rank"]).withColumn("w", F.round(F.col("_hi") - F.col(value), 9))
    return pairs.groupBy(chain).agg(F.max("n").alias("n"), F.min(F.struct("w", "rank", F.col(value).alias("lo"), F.col("_hi").alias("hi"))).alias("b")).select(chain, "n", "b.lo", "b.hi")


def overlaps(df: DataFrame, chain: str, value: str, bins: int = 100) -> DataFrame:
    """chain_a, chain_b, overlap: shared area of the histograms of every two chains, over equal bins of their common range."""
    ranges = df.where(F.col(value).isNotNull()).groupBy(chain).agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.count(F.lit(1)).alias("n"))
    a, b = (ranges.select(*(F.col(c).alias(f"{c}_{s}") for c in (chain, "lo", "hi", "n"))) for s in "ab")
    pairs = a.join(b, F.col(f"{chain}_a") < F.col(f"{chain}_b"))
    pairs = pairs.select(F.col(f"{chain}_a").alias("a"), F.col(f"{chain}_b").alias("b"), F.least("lo_a", "lo_b").alias("lo"), F.greatest("hi_a", "hi_b").alias("hi"), "n_a", "n_b")
    sided = pairs.select("a", "b", "lo", "hi", F.explode(F.array(F.struct(F.col("a").alias(chain), F.col("n_a").alias("n"), F.lit(0).alias("side")), F.struct(F.col("b").alias(chain), F.col("n_b").alias("n"), F.lit(1).alias("side")))).alias("x")).select("a", "b", "lo", "hi", "x.*")
    # Values are counted before they meet the pairs, so a chain's rows are not repeated per pair.
    values = df.where(F.col(value).isNotNull()).groupBy(chain, value).agg(F.count(F.lit(1)).alias("c"))
    bin_ = F.least(F.floor((F.col(value) - F.col("lo")) / F.nullif((F.col("hi") - F.col("lo")) / bins, F.lit(0.0))), F.lit(bins - 1))
    shares = values.join(if_small(checkpointed(sided)), chain).groupBy("a", "b", F.coalesce(bin_, F.lit(0)).alias("bin")).agg(*(F.sum(F.when(F.col("side") == s, F.col("c") / F.col("n")).otherwise(0.0)).alias(f"p{s}") for s in (0, 1)))
    return shares.groupBy(F.col("a").alias("chain_a"), F.col("b").alias("chain_b")).agg(F.round(F.sum(F.least("p0", "p1")), 6).alias("overlap"))


def effective_sizes(df: DataFrame, chain: str, order: str, value: str, max_lag: int = 2000, block: int = 50_000) -> DataFrame:
    """chain, n, ess: effective sample size from the autocovariance, summed in pairs of lags while positive, at most n.

    The products of a lag are summed and divided by their number, n - lag; lags
    run up to the lesser of n and ``max_lag``, that one left out. Chains of under
    ten values, or of one value only, count whole. Chains are cut into blocks that
    carry the first ``max_lag`` rows of the next block along; products by lag are
    summed over blocks, so no task holds more than a block.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(chain).alias("_chain"), F.col(order).alias("_order"), F.col(value).cast("double").alias("v"))
    ranked = value_rank(rows, ["_chain"], "_order", "_order")
    means = checkpointed(ranked.groupBy("_chain").agg(F.avg("v").alias("m"), F.count(F.lit(1)).alias("n")))
    rows = ranked.join(if_small(means), "_chain").select("_chain", "n", (F.col("rank") - 1).alias("i"), (F.col("v") - F.col("m")).alias("x"))
    own = F.floor(F.col("i") / block)
    tail = F.when((own > 0) & (F.col("i") % block < max_lag), F.array(own, own - 1)).otherwise(F.array(own))
    blocks = rows.select("_chain", "n", "i", "x", F.explode(tail).alias("block"))

    def products(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("i")
        x, head = pdf.x.to_numpy(), int((pdf.i < (pdf.block.iloc[0] + 1) * block).sum())
        size = 1 << int(np.ceil(np.log2(len(x) + head + 1)))
        full = np.fft.irfft(np.conj(np.fft.rfft(x[:head], size)) * np.fft.rfft(x, size), size)[: min(max_lag, len(x))]
        return pd.DataFrame({"_chain": pdf._chain.iloc[0], "n": pdf.n.iloc[0], "lag": np.arange(len(full)), "c": full})

    kind = dict(df.dtypes)[chain]
    lags = blocks.groupBy("_chain", "block").applyInPandas(products, f"_chain {kind}, n long, lag long, c double").groupBy("_chain", "n", "lag").agg(F.sum("c").alias("c"))

    def tau(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("lag")
        n = int(pdf.n.iloc[0])
        cov = pdf.c.to_numpy() / (n - pdf.lag.to_numpy())
        total = cov[0]
        for lag in range(2, len(cov), 2):
            pair = cov[lag - 1] + cov[lag]
            if pair <= 0:
                break
            total += 2 * pair
        whole = n < 10 or cov[0] <= 0 or total <= 0
        return pd.DataFrame({"_chain": [pdf._chain.iloc[0]], "n": [n], "ess": [float(n) if whole else min(float(n), n * cov[0] / total)]})

    return lags.groupBy("_chain").applyInPandas(tau, f"_chain {kind}, n long, ess double").withColumnRenamed("_chain", chain)


def convergence(sizes: DataFrame, shared: DataFrame, min_ess: float = 200.0, min_overlap: float = 0.5) -> DataFrame:
    """One row: n_chains, pooled_ess (the sum over chains), min_ess, min_overlap, verdict (fail, warn with one chain, pass)."""
    a = sizes.agg(F.count(F.lit(1)).alias("n_chains"), F.round(F.sum("ess"), 4).alias("pooled_ess"), F.round(F.min("ess"), 4).alias("min_ess"), F.lit(1).alias("k"))
    b = shared.agg(F.min("overlap").alias("min_overlap"), F.lit(1).alias("k"))
    verdict = F.when((F.col("pooled_ess") < min_ess) | (F.col("min_overlap") < min_overlap), "fail").when(F.col("n_chains") < 2, "warn").otherwise("pass")
    return a.join(b, "k").drop("k").withColumn("verdict", verdict)


def randomisation_verdict(intervals: DataFrame, means: DataFrame, chain: str, real: str) -> DataFrame:
    """One row: how the real chain stands against the others (replicates).

    ``pass`` if no replicate's interval overlaps the real one, ``weak`` if the
    real mean lies outside the envelope of all replicates' intervals, else
    ``fail``. (The range of the replicates' means would not do: it narrows with
    the number of samples, so nearly any mean would lie outside.)
    """
    rows = intervals.join(means, chain)
    is_real = F.col(chain) == real
    own = rows.where(is_real).select(F.col("lo").alias("rlo"), F.col("hi").alias("rhi"), F.col("mean").alias("rmean"), F.lit(1).alias("k"))
    other = rows.where(~is_real).withColumn("k", F.lit(1)).join(F.broadcast(own), "k")
    out = other.groupBy("rlo", "rhi", "rmean").agg(
        F.count(F.lit(1)).alias("n_replicates"), F.count_if((F.col("lo") <= F.col("rhi")) & (F.col("rlo") <= F.col("hi"))).alias("n_overlapping"),
        F.min("lo").alias("envelope_lo"), F.max("hi").alias("envelope_hi"), F.round(F.stddev_pop("mean"), 6).alias("spread"),
    )
    verdict = F.when(F.col("n_overlapping") == 0, "pass").when(~F.col("rmean").between(F.col("envelope_lo"), F.col("envelope_hi")), "weak").otherwise("fail")
    return out.select("n_replicates", "n_overlapping", F.round("rmean", 6).alias("real_mean"), F.round("envelope_lo", 6).alias("envelope_lo"), F.round("envelope_hi", 6).alias("envelope_hi"), "spread", verdict.alias("verdict"))


def randomisation_checked(intervals: DataFrame, means: DataFrame, sizes: DataFrame, chain: str, real: str, min_ess: float = 100.0) -> DataFrame:
    """``randomisation_verdict`` with the state of the replicates: adds n_low_ess, n_wide and mc_error.

    Replicates below ``min_ess`` overlap everything, so they turn ``weak`` and
    ``fail`` into ``inconclusive``. Several replicates whose means spread by no
    more than the median Monte Carlo error of one (width / 3.92 / sqrt(ess)) count
    as one draw, which turns ``pass`` into ``inconclusive``. n_wide: intervals of
    more than three times the real width.
    """
    rows = intervals.join(means, chain).join(sizes.select(chain, "ess"), chain).withColumn("width", F.col("hi") - F.col("lo")).withColumn("k", F.lit(1))
    own = rows.where(F.col(chain) == real).select("k", F.col("width").alias("rwidth"))
    error = F.percentile(F.col("width") / 3.92 / F.sqrt(F.greatest("ess", F.lit(1.0))), 0.5)
    state = rows.where(F.col(chain) != real).join(F.broadcast(own), "k").groupBy("k").agg(
        F.count_if(F.col("ess") < min_ess).alias("n_low_ess"), F.count_if(F.col("width") > 3 * F.col("rwidth")).alias("n_wide"), error.alias("mc_error"), F.stddev_pop("mean").alias("_spread")
    )
    out = randomisation_verdict(intervals, means, chain, real).withColumn("k", F.lit(1)).join(state, "k")
    one = (F.col("n_replicates") > 1) & (F.col("mc_error") > 0) & (F.col("_spread") <= F.col("mc_error"))
    unsure = ((F.col("n_low_ess") > 0) & F.col("verdict").isin("weak", "fail")) | (one & (F.col("verdict") == "pass"))
    return out.withColumn("verdict", F.when(unsure, "inconclusive").otherwise(F.col("verdict"))).withColumn("mc_error", F.round("mc_error", 6)).drop("k", "_spread")
