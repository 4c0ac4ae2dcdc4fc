"""Ranks in a permuted order, without sorting a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed, if_small


#: Rows that one range of a group should hold: what a task sorts at once.
ROWS_A_RANGE = 20_000


def range_bits(size: Column, rows: float = ROWS_A_RANGE) -> Column:
    """Bits of a hash that cut ``size`` rows into ranges of about ``rows``, at least one bit."""
    return F.greatest(F.lit(1), F.ceil(F.log2(F.greatest(size, F.lit(1)) / rows))).cast("int")


def joined_null_safe(rows: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """``rows`` with the columns of ``small`` (few rows: broadcast behind their count) where the columns ``on`` are equal or both null."""
    renamed = if_small(small.withColumnsRenamed({c: f"_on_{c}" for c in on}))
    met = F.lit(True)
    for c in on:
        met = met & F.col(c).eqNullSafe(F.col(f"_on_{c}"))
    return rows.join(renamed, met).drop(*(f"_on_{c}" for c in on))


def permuted_rank(df: DataFrame, group: list[str], key: list[str], seed: Column | int = 0, name: str = "rank", size: str | None = None, upto: str | None = None) -> DataFrame:
    """``df`` with a rank from 1 in the order of a hash of ``seed`` and ``key`` in each group.

    Rows fall into hash ranges of about ``ROWS_A_RANGE`` rows, as many as the size
    of their group calls for (counted, or given in the column ``size``); counts by
    range give each range its offset and rows are ranked inside their range only.
    With ``upto`` (a column that is the same in a group) ranks beyond it are left
    out, and ranges that lie beyond it are not sorted. The result depends on the
    keys and the seed, not on partitions. Equal keys get ranks of their own in no
    stated order.
    """
    if size is None:
        df = joined_null_safe(df, checkpointed(df.groupBy(*group).agg(F.count(F.lit(1)).alias("_size"))), group)
    h = F.xxhash64(F.lit(seed) if isinstance(seed, int) else seed, *(F.col(k) for k in key))
    rows = df.withColumns({"_h": h, "_bits": range_bits(F.col(size or "_size"))}).withColumn("_range", F.expr("shiftrightunsigned(_h, 64 - _bits)")).drop("_bits", "_size")
    counts = rows.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"), *([F.max(upto).alias("_upto")] if upto else []))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_range")) - F.col("_n")
    offsets = counts.withColumn("_before", before)
    offsets = checkpointed((offsets.where("_before < _upto") if upto else offsets).select(*group, "_range", "_before"))
    joined = joined_null_safe(rows, offsets, [*group, "_range"])
    inside = F.row_number().over(Window.partitionBy(*group, "_range").orderBy("_h", *key))
    ranked = joined.withColumn(name, inside + F.col("_before")).drop("_h", "_range", "_before")
    return ranked.where(F.col(name) <= F.col(upto)) if upto else ranked


def shared_out(df: DataFrame, group: list[str], quota: str, capacity: str, order: list[str], name: str, weight: str | None = None) -> DataFrame:
    """``df`` with the share of each row in its group's quota: by weight (even without one), at most its capacity.

    What a row can't take passes to the others of its group (those that fill up
    first come first); what remains of a division goes to the first of the rows
    that are not full. Shares add up to the least of the quota and all
    capacities. Weights that are null or not positive count as 1e-9. Rows of a
    group are few (nodes of a category tree), so groups are windows.
    """
    w = F.greatest(F.coalesce(F.col(weight), F.lit(0.0)), F.lit(1e-9)) if weight else F.lit(1.0)
    rows = df.withColumn("_w", w)
    rows = rows.withColumn("_fill", F.col(capacity) / F.col("_w"))
    ascending = Window.partitionBy(*group).orderBy("_fill", *order)
    whole = Window.partitionBy(*group)
    rows = rows.withColumns(
        {"_before": F.coalesce(F.sum(capacity).over(ascending.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), "_left": F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(ascending.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))}
    )
    rows = rows.withColumn("_full", F.col("_fill") * F.col("_left") + F.col("_before") <= F.col(quota) + F.lit(1e-6))
    rows = rows.withColumns({"_rest": F.col(quota) - F.min(F.when(~F.col("_full"), F.col("_before"))).over(whole), "_open": F.max(F.when(~F.col("_full"), F.col("_left"))).over(whole)})
    rows = rows.withColumn("_share", F.when(F.col("_full"), F.col(capacity)).otherwise(F.least(F.col(capacity), F.floor(F.col("_rest") * F.col("_w") / F.col("_open") + F.lit(1e-9)))).cast("long"))
    rows = rows.withColumns({"_over": F.col("_rest") - F.sum(F.when(~F.col("_full"), F.col("_share"))).over(whole), "_nth": F.sum(F.when(F.col("_full") | (F.col("_share") >= F.col(capacity)), 0).otherwise(1)).over(ascending)})
    extra = F.when(~F.col("_full") & (F.col("_share") < F.col(capacity)) & (F.col("_nth") <= F.col("_over")), 1).otherwise(0)
    share = F.greatest(F.col("_share") + extra, F.lit(0)).cast("long")
    return rows.withColumn(name, share).drop("_w", "_fill", "_before", "_left", "_full", "_rest", "_open", "_share", "_over", "_nth")


def ordered_rank(df: DataFrame, group: list[str], order: list[str | Column], name: str = "rank") -> DataFrame:
    """``df`` with the exact rank from 1 in ``order`` in each group.

    Rows are sorted once over all partitions by group and order, so neither a long
    group nor a value that fills one is sorted in one task. The part of a group in
    a partition gets its offset from the counts of the parts before it. Rows that
    are equal in ``order`` get ranks of their own in no stated order.
    """
    laid = df.repartitionByRange(*group, *order).sortWithinPartitions(*group, *order)
    laid = checkpointed(laid.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33)))
    parts = laid.groupBy(*group, "_part").agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(*group).orderBy("_part")) - F.col("_n")
    offsets = checkpointed(parts.select(*group, "_part", (before - F.col("_first") + 1).alias("_shift")))
    return joined_null_safe(laid, offsets, [*group, "_part"]).withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def value_rank(df: DataFrame, group: list[str], value: str, key: str, name: str = "rank") -> DataFrame:
    """``df`` with the exact rank from 1 by value, then key, in each group; rows without a value are left out."""
    return ordered_rank(df.where(F.col(value).isNotNull()), group, [value, key], name)


def md5_rank(df: DataFrame, group: list[str], salted: Column, name: str = "rank") -> DataFrame:
    """``df`` with a rank from 1 by the md5 of a text in each group, taken in 256 ranges of the digest.

    The order is one that SQL engines share, so permutations can be checked there.
    """
    rows = df.withColumn("_h", F.md5(salted)).withColumn("_range", F.substring("_h", 1, 2))
    counts = rows.groupBy(*group, "_range").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_before", F.sum("_n").over(Window.partitionBy(*group).orderBy("_range")) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*group, "_range").orderBy("_h"))
    return rows.join(offsets, [*group, "_range"]).withColumn(name, inside + F.col("_before")).drop("_h", "_range", "_before")
