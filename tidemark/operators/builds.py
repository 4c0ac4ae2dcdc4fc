"""Builds held against the one before: records, measures, verdicts, and the sanity of a download."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.snapshots import SnapshotSpec, snapshot_changes, snapshot_rows
from tidemark.session import checkpointed, if_small


def build_sizes(df: DataFrame, spec: SnapshotSpec = SnapshotSpec()) -> DataFrame:
    """series, version, n_now, n_before: records of every build and of the one before (null for the first)."""
    sizes = snapshot_rows(df, spec).groupBy("grp", "ver").agg(F.count(F.lit(1)).alias("n_now"))
    before = F.lag("n_now").over(Window.partitionBy("grp").orderBy("ver"))
    return sizes.select(F.col("grp").alias(spec.group), F.col("ver").alias(spec.version), "n_now", before.alias("n_before"))


def build_findings(df: DataFrame, spec: SnapshotSpec = SnapshotSpec(), shown: int = 10) -> DataFrame:
    """What can be said of every build against the one before it.

    Columns: series, version, n_before, n_now, delta, n_added, n_removed, swapped
    (as many records, but others), first_lost (the first ``shown`` lost keys in
    order, by ", "), level and verdict. Lost records are an ``error``, so the
    verdict is ``regression``; swapped ones would be a ``warn`` (``review``), else
    it is a ``note`` (``ok``). The first build of a series has no row.
    """
    changes = checkpointed(snapshot_changes(df, spec))
    by = [spec.group, spec.version]
    counts = changes.groupBy(*by).agg(F.count_if(F.col("change_kind") == "added").alias("n_added"), F.count_if(F.col("change_kind") == "removed").alias("n_removed"))
    place = F.row_number().over(Window.partitionBy(*by).orderBy(spec.key))
    lost = changes.where("change_kind = 'removed'").withColumn("_place", place).where(F.col("_place") <= shown)
    lost = lost.groupBy(*by).agg(F.array_join(F.array_sort(F.collect_list(spec.key)), ", ").alias("first_lost"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    rows = build_sizes(df, spec).where("n_before is not null").join(counts, by, "left").join(lost, by, "left")
    rows = rows.withColumns({"n_added": zero("n_added"), "n_removed": zero("n_removed")})
    swapped = (F.col("n_removed") > 0) & (F.col("n_added") > 0) & (F.col("n_now") == F.col("n_before"))
    level = F.when(F.col("n_removed") > 0, "error").when(swapped, "warn").otherwise("note")
    verdict = F.when(level == "error", "regression").when(level == "warn", "review").otherwise("ok")
    return rows.select(*by, "n_before", "n_now", (F.col("n_now") - F.col("n_before")).alias("delta"), "n_added", "n_removed", swapped.alias("swapped"), "first_lost", level.alias("level"), verdict.alias("verdict"))


def download_checks(df: DataFrame, spec: SnapshotSpec = SnapshotSpec(), few: int = 20, max_new: int = 1_000_000_000) -> DataFrame:
    """series, version, n_now, n_before, level, finding of every build as a download.

    ``error``: empty or fewer records than before; ``warn``: more than ``max_new``
    new ones, or under ``few`` in all; else ``ok``.
    """
    n, delta = F.col("n_now"), F.col("n_now") - F.col("n_before")
    finding = F.when(n == 0, "empty").when(delta < 0, "shrunk").when(delta > max_new, "many_new").when(n < few, "few").otherwise("fine")
    level = F.when(finding.isin("empty", "shrunk"), "error").when(finding.isin("many_new", "few"), "warn").otherwise("ok")
    return build_sizes(df, spec).select(spec.group, spec.version, "n_now", "n_before", level.alias("level"), finding.alias("finding"))


def measure_changes(df: DataFrame, series: list[str], order: str, measures: dict[str, float], shifts: dict[str, float] | None = None) -> DataFrame:
    """series, order, measure, before, after, change, level: signed changes from each row of a series to the next.

    ``measures`` names columns with the share of change that is let pass: change is
    (after - before) / |before|, ``warn`` beyond it; rows whose measure is null or
    was 0 before have none. ``shifts`` names columns by their greatest difference:
    beyond it ``error``. Else ``note``. One row per series and order is taken as given.
    """
    shifts = shifts or {}
    entry = lambda c, limit, kind: F.struct(F.lit(c).alias("measure"), F.col(c).cast("double").alias("after"), F.lit(float(limit)).alias("limit"), F.lit(kind).alias("kind"))
    rows = df.select(*series, order, F.explode(F.array(*(entry(c, v, "share") for c, v in measures.items()), *(entry(c, v, "shift") for c, v in shifts.items()))).alias("m")).select(*series, order, "m.*")
    rows = rows.withColumn("before", F.lag("after").over(Window.partitionBy(*series, "measure").orderBy(order)))
    share = F.col("kind") == "share"
    change = F.when(share, (F.col("after") - F.col("before")) / F.nullif(F.abs("before"), F.lit(0.0))).otherwise(F.col("after") - F.col("before"))
    level = F.when(F.abs("change") <= F.col("limit"), "note").when(share, "warn").otherwise("error")
    return rows.withColumn("change", change).where("change is not null").select(*series, order, "measure", F.round("before", 6).alias("before"), F.round("after", 6).alias("after"), F.round("change", 6).alias("change"), level.alias("level"))


def bare(accession: Column) -> Column:
    """An accession in upper case, without outer blanks and version."""
    return F.upper(F.trim(F.split(accession, r"\.")[0]))


def latest_records(records: DataFrame, key: str, order: list[str], keep: list[str]) -> DataFrame:
    """key (bare) and ``keep`` of the last row of every record."""
    rows = records.where(F.col(key).isNotNull()).groupBy(bare(F.col(key)).alias(key)).agg(F.max_by(F.struct(*keep), F.struct(*order)).alias("r"))
    return rows.select(key, "r.*")


def with_context(rows: DataFrame, records: DataFrame, key: str, order: list[str], defaults: dict[str, str]) -> DataFrame:
    """``rows`` with columns of the last record of their bare key; ``defaults`` names the columns and what a missing value becomes."""
    known = latest_records(records, key, order, list(defaults)).withColumnsRenamed({key: "_key"} | {c: f"_{c}" for c in defaults})
    joined = rows.withColumn("_key", bare(F.col(key))).join(known, "_key", "left")
    return joined.select(*rows.columns, *(F.coalesce(f"_{c}", F.lit(v)).alias(c) for c, v in defaults.items()))


def match_rates(rows: DataFrame, records: DataFrame, by: list[str], key: str, least: float = 0.9) -> DataFrame:
    """by, n, n_matched, rate, enough: distinct keys of each part that ``records`` has."""
    keys = rows.where(F.col(key).isNotNull()).select(*by, bare(F.col(key)).alias("k")).distinct()
    known = records.where(F.col(key).isNotNull()).select(bare(F.col(key)).alias("k"), F.lit(1).alias("hit")).distinct()
    out = keys.join(known, "k", "left").groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count("hit").alias("n_matched"))
    rate = F.col("n_matched") / F.col("n")
    return out.select(*by, "n", "n_matched", F.round(rate, 6).alias("rate"), (rate >= least).alias("enough"))


def composition(df: DataFrame, by: str, group: str, thin: int = 5) -> DataFrame:
    """by, group, n, share, is_thin: rows by group in each part; groups of under ``thin`` rows are thin. Nulls are groups."""
    counts = df.groupBy(by, group).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(by))
    return counts.select(by, group, "n", F.round(share, 6).alias("share"), (F.col("n") < thin).alias("is_thin"))


def length_report(df: DataFrame, by: str, length: str, tolerance: float = 0.02) -> DataFrame:
    """by, n, median, n_partial, n_off_frame, n_over: lengths of each part against its median, the expected length.

    Partial ones are shorter, off-frame ones no multiple of 3, over-length ones
    beyond ``tolerance`` of it. The median is that of counts by length, so no part
    is sorted in one task. Null parts and lengths don't count.
    """
    counts = checkpointed(df.where(F.col(by).isNotNull() & F.col(length).isNotNull()).groupBy(by, F.col(length).alias("l")).agg(F.count(F.lit(1)).alias("c")))
    upto, whole = F.sum("c").over(Window.partitionBy(by).orderBy("l")), F.sum("c").over(Window.partitionBy(by))
    placed = counts.withColumns({"upto": upto, "n": whole})
    holds = lambda place: (F.col("upto") >= place) & (F.col("upto") - F.col("c") < place)
    low, high = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    medians = placed.groupBy(by).agg(F.max("n").alias("n"), ((F.max(F.when(holds(low), F.col("l"))) + F.max(F.when(holds(high), F.col("l")))) / 2).alias("median"))
    rows = counts.join(if_small(checkpointed(medians)), by)
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("c"))), F.lit(0))
    return rows.groupBy(by, "n", "median").agg(total(F.col("l") < F.col("median")).alias("n_partial"), total(F.col("l") % 3 != 0).alias("n_off_frame"), total(F.col("l") > F.col("median") * (1 + tolerance)).alias("n_over"))


def country_name(text: Column) -> Column:
    """The text before its first colon, without outer blanks."""
    return F.trim(F.split(text, ":")[0])
