"""What changed between full snapshots of a table.

Keys are spread over hash ranges. Every snapshot gets a digest tree over those
ranges; two consecutive snapshots are compared from the root down, and rows are
looked at only in ranges whose digests differ. No step gathers a snapshot, or a
range of fixed size, in one task: a snapshot that holds a third of all rows is
spread over as many ranges as its rows call for.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed, if_small

BLANKS = r"[\s\p{Z}]+"
OUTER_BLANKS = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def folded(value: Column) -> Column:
    """Text without case and surplus blanks; '' for null and blank."""
    text = F.regexp_replace(F.regexp_replace(value.cast("string"), OUTER_BLANKS, ""), BLANKS, " ")
    return F.coalesce(F.lower(text), F.lit(""))


@dataclass(frozen=True)
class SnapshotSpec:
    """Columns of a snapshot table.

    ``group`` names the series, ``version`` the snapshot in it (ordered as text),
    ``key`` the record, ``values`` what is compared, ``order`` which of several
    rows of a record in a snapshot counts (the greatest).
    """

    group: str = "pathogen"
    version: str = "build_date"
    key: str = "accession"
    values: tuple[str, ...] = ("host_group", "country", "collection_date", "lat_lon", "seq_length")
    order: tuple[str, ...] = ("loaded_at", "snap_row_id")


def snapshot_rows(df: DataFrame, spec: SnapshotSpec) -> DataFrame:
    """One row per series, snapshot and record: grp, ver, key and the digest d1, d2 of what is compared.

    The key is in upper case, without outer blanks and without the version after
    its first dot; that version is the first compared value. Rows whose series,
    snapshot or key is null or blank are no records and are left out. Values are
    carried as two 64-bit digests, so long texts are neither shuffled nor stored.
    """
    text = F.upper(F.regexp_replace(F.col(spec.key), OUTER_BLANKS, ""))
    parts = F.split(text, r"\.", 2)
    body = F.concat_ws("\u0001", F.coalesce(F.get(parts, F.lit(1)), F.lit("")), *(folded(F.col(c)) for c in spec.values))
    rows = df.select(
        F.col(spec.group).cast("string").alias("grp"),
        F.col(spec.version).cast("string").alias("ver"),
        F.get(parts, F.lit(0)).alias("key"),
        body.alias("body"),
        F.struct(*(F.col(c) for c in spec.order)).alias("at"),
    ).where("trim(grp) <> '' and trim(ver) <> '' and key <> ''")
    digests = F.struct(F.xxhash64("body").alias("d1"), F.xxhash64(F.lit(97), "body").alias("d2"))
    rows = rows.withColumn("d", digests).groupBy("grp", "ver", "key").agg(F.max(F.struct("at", "d")).alias("m"))
    return rows.select("grp", "ver", "key", "m.d.d1", "m.d.d2")


def leaf_depth(rows: DataFrame, fan_out_bits: int, rows_a_leaf: int) -> int:
    """Levels below the root at which a leaf of the largest snapshot holds about ``rows_a_leaf`` rows."""
    largest = rows.groupBy("grp", "ver").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    return max(1, math.ceil(math.log2(max(largest / rows_a_leaf, 1)) / fan_out_bits))


def digest_levels(rows: DataFrame, fan_out_bits: int, depth: int) -> list[DataFrame]:
    """Digests by level, the root first: grp, ver, node, n, d1, d2."""
    leaves = rows.groupBy("grp", "ver", F.col("leaf").alias("node")).agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("key", "d1", "d2")).alias("d1"),
        F.bit_xor(F.xxhash64(F.lit(97), "d2", "d1", "key")).alias("d2"),
    )
    levels = [checkpointed(leaves)]
    for _ in range(depth):
        levels.append(
            levels[-1]
            .groupBy("grp", "ver", F.shiftright("node", fan_out_bits).alias("node"))
            .agg(F.sum("n").alias("n"), F.bit_xor("d1").alias("d1"), F.bit_xor("d2").alias("d2"))
        )
    return levels[::-1]


def consecutive(level0: DataFrame) -> DataFrame:
    """Pairs of consecutive snapshots of a series: grp, prev, cur."""
    order = Window.partitionBy("grp").orderBy("ver")
    return (
        level0.select("grp", "ver").distinct()
        .select("grp", F.lag("ver").over(order).alias("prev"), F.col("ver").alias("cur"))
        .where("prev is not null")
    )


def differing_nodes(levels: list[DataFrame], pairs: DataFrame, fan_out_bits: int) -> DataFrame:
    """Leaves that differ between the snapshots of a pair, found from the root down.

    What is open after a level is written down, so every level reads the one
    before once, and the join with the next is a broadcast if few nodes differ.
    """
    open_nodes = pairs.withColumn("parent", F.lit(0).cast("long"))
    for k, level in enumerate(levels):
        keyed = level.withColumn("parent", F.shiftright("node", fan_out_bits) if k else F.col("node"))
        sides = [
            keyed.withColumnRenamed("ver", side).join(if_small(open_nodes), ["grp", side, "parent"]).select("grp", "prev", "cur", "node", F.struct("n", "d1", "d2").alias("d"))
            for side in ("prev", "cur")
        ]
        open_nodes = checkpointed(
            sides[0].unionAll(sides[1])
            .groupBy("grp", "prev", "cur", F.col("node").alias("parent"))
            .agg(F.count(F.lit(1)).alias("c"), F.min("d").alias("lo"), F.max("d").alias("hi"))
            .where("c = 1 or lo <> hi")
            .select("grp", "prev", "cur", "parent")
        )
    return open_nodes.withColumnRenamed("parent", "leaf")


def snapshot_changes(df: DataFrame, spec: SnapshotSpec = SnapshotSpec(), fan_out_bits: int = 4, rows_a_leaf: int = 16) -> DataFrame:
    """Records added, removed or changed from each snapshot to the next.

    Columns: the series, version and key columns of ``spec`` and ``change_kind``.
    The first snapshot of a series has no changes; a record that comes back is
    ``added``; letter case, blanks, and null against empty make no difference.
    Repeated rows count once, ties of ``order`` go to one of the contents, always
    the same. An empty table gives no rows; other columns of ``df`` are not read.
    The tree is as deep as leaves of about ``rows_a_leaf`` rows need in the largest
    snapshot, so what is compared row by row stays near to what changed.
    """
    rows = checkpointed(snapshot_rows(df, spec))
    depth = leaf_depth(rows, fan_out_bits, rows_a_leaf)
    rows = rows.withColumn("leaf", F.shiftrightunsigned(F.xxhash64("key"), 64 - fan_out_bits * depth))
    levels = digest_levels(rows, fan_out_bits, depth)
    leaves = if_small(differing_nodes(levels, consecutive(levels[0]), fan_out_bits))
    none, body = F.lit(None).cast("struct<d1:bigint,d2:bigint>"), F.struct("d1", "d2")
    bodies = {"prev": (body, none), "cur": (none, body)}
    sides = [
        rows.withColumnRenamed("ver", side).join(leaves, ["grp", side, "leaf"]).select("grp", "cur", "key", before.alias("before"), after.alias("after"))
        for side, (before, after) in bodies.items()
    ]
    both = sides[0].unionAll(sides[1]).groupBy("grp", "cur", "key").agg(F.max("before").alias("before"), F.max("after").alias("after"))
    kind = F.when(F.col("before").isNull(), "added").when(F.col("after").isNull(), "removed").otherwise("changed")
    return both.where("not (before <=> after)").select(
        F.col("grp").alias(spec.group), F.col("cur").alias(spec.version), F.col("key").alias(spec.key), kind.alias("change_kind")
    )


def snapshot_decisions(changes: DataFrame, spec: SnapshotSpec = SnapshotSpec()) -> DataFrame:
    """Counts of each kind of change by snapshot, with the verdict they lead to.

    ``regression`` if records were lost, ``review`` if records changed, else ``ok``.
    """
    counted = changes.groupBy(spec.group, spec.version).agg(*(F.count_if(F.col("change_kind") == k).alias(f"n_{k}") for k in ("added", "removed", "changed")))
    return counted.withColumn("delta", F.col("n_added") - F.col("n_removed")).withColumn(
        "verdict", F.when(F.col("n_removed") > 0, "regression").when(F.col("n_changed") > 0, "review").otherwise("ok")
    )
