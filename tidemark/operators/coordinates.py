"""Positions of a reference row in an alignment, variable columns and amino acids."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.alignment import GAPS, UNCERTAIN, base_counts


def reference_row(rows: DataFrame, name: str | None = None) -> DataFrame:
    """name, seq: the row of that name, else the one with the fewest gaps (of equals the lowest name); columns beyond its end are gaps of a row."""
    if name is not None:
        return rows.where(F.col("name") == name)
    bases = F.length(F.regexp_replace("seq", f"[{GAPS}]", ""))
    best = rows.agg(F.min(F.struct((-bases).alias("gaps"), "name", "seq")).alias("b"))
    return best.where("b is not null").select("b.name", "b.seq")


def reference_positions(reference: DataFrame) -> DataFrame:
    """col, base, position: the columns of a reference row, and which of its bases each holds (null at a gap).

    A row is as long as the alignment is wide, so running counts go over one row.
    """
    cells = reference.select(F.posexplode(F.split("seq", "")).alias("p", "base")).where("base <> ''").select((F.col("p") + 1).alias("col"), "base")
    is_base = ~F.col("base").isin(*GAPS)
    upto = F.count_if(is_base).over(Window.orderBy("col").rowsBetween(Window.unboundedPreceding, 0))
    return cells.select("col", "base", F.when(is_base, upto).alias("position"))


def codon_columns(positions: DataFrame, start: int = 1) -> DataFrame:
    """codon, cols: the alignment columns of each whole codon of a reference that is read from position ``start``."""
    codon = F.floor((F.col("position") - start) / 3) + 1
    cols = positions.where(F.col("position") >= start).groupBy(codon.alias("codon")).agg(F.array_sort(F.collect_list("col")).alias("cols"))
    return cols.where(F.size("cols") == 3)


def variable_columns(rows: DataFrame) -> DataFrame:
    """One row: n_columns, n_variable (more than one of A, C, G and T), n_differing (more than one certain character)."""
    per = base_counts(rows).groupBy("col").agg(F.count_if(F.col("base").isin(*"ACGT")).alias("k"), F.count_if(~F.col("base").isin(*UNCERTAIN)).alias("c"))
    return per.agg(F.count(F.lit(1)).alias("n_columns"), F.count_if(F.col("k") > 1).alias("n_variable"), F.count_if(F.col("c") > 1).alias("n_differing"))


def mutation_counts(changes: DataFrame, positions: DataFrame) -> DataFrame:
    """codon_place, from_base, to_base, n, n_inserted: changes (node, col, from_base, to_base) by place in the codon of the reference.

    Changes in columns where the reference has a gap have no place and are counted as inserted.
    """
    placed = changes.join(positions.select("col", "position"), "col", "left")
    place = (F.col("position") - 1) % 3 + 1
    return placed.groupBy(place.alias("codon_place"), "from_base", "to_base").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("position").isNull()).alias("n_inserted"))
