"""Statistics of aligned rows of characters, by column and by row.

A row is a name and its characters; columns are positions from 1. Rows may be
of any length: a row that ends before a column has a gap there. Column work is
a count by (column, character), so partial counts keep the shuffle at
columns x characters whatever the number of rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

GAPS = "-."
UNCERTAIN = "-.NX?"
STOPS = ("TAA", "TAG", "TGA")
#: The standard genetic code, codons in the order of the bases TCAG. Fixed values.
CODE = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"


def as_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """name, seq: whole texts as alignment rows; characters outside printable ASCII become N, letters upper case, blanks gaps."""
    return df.where(F.col(text).isNotNull()).select(F.col(key).alias("name"), F.translate(F.upper(F.regexp_replace(text, r"[^ -~]", "N")), " ", "-").alias("seq"))


def as_bases(df: DataFrame, key: str, text: str) -> DataFrame:
    """name, seq: the letters a to z of whole texts read as bases (by their place in the alphabet), all else dropped."""
    letters = F.regexp_replace(F.lower(text), "[^a-z]", "")
    return df.where(F.col(text).isNotNull()).select(F.col(key).alias("name"), F.translate(letters, "abcdefghijklmnopqrstuvwxyz", "ACGTACGTACGTACGTACGTACGTAC").alias("seq"))


def cells(rows: DataFrame) -> DataFrame:
    """name, col, base of every character."""
    return rows.select("name", F.posexplode(F.split("seq", "")).alias("p", "base")).select("name", (F.col("p") + 1).alias("col"), "base").where("base <> ''")


def base_counts(rows: DataFrame) -> DataFrame:
    """col, base, n, first: how often each character stands in a column, and the lowest name that has it."""
    return cells(rows).groupBy("col", "base").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("first"))


def column_coverage(rows: DataFrame) -> DataFrame:
    """col, n_bases, coverage: rows with a character that is no gap, and their share of all rows."""
    total = rows.agg(F.count(F.lit(1)).alias("total"))
    counts = base_counts(rows).groupBy("col").agg(F.coalesce(F.sum(F.when(~F.col("base").isin(*GAPS), F.col("n"))), F.lit(0)).alias("n_bases"))
    return counts.join(F.broadcast(total.withColumn("_k", F.lit(1))), F.lit(1) == F.col("_k")).select("col", "n_bases", F.round(F.col("n_bases") / F.col("total"), 6).alias("coverage"))


def consensus(rows: DataFrame) -> DataFrame:
    """col, base: the most common certain character of each column; a tie goes to the one of the lowest name; none is a gap."""
    certain = F.when(~F.col("base").isin(*UNCERTAIN), F.struct("n", (-F.col("first")).alias("f"), "base"))
    return base_counts(rows).groupBy("col").agg(F.coalesce(F.max(certain)["base"], F.lit("-")).alias("base"))


def row_quality(rows: DataFrame, max_gap: float = 0.5, min_identity: float = 0.8, max_uncertain: float = 0.05) -> DataFrame:
    """name, n_bases, gap_share, uncertain_share, identity, flags of each row.

    identity is the share of certain characters equal to the consensus; flags
    joins what applies of gappy, divergent and uncertain by ``;``.
    """
    joined = cells(rows).join(consensus(rows).withColumnRenamed("base", "c"), "col")
    gap, sure = F.col("base").isin(*GAPS), ~F.col("base").isin(*UNCERTAIN) & (F.col("c") != "-")
    out = joined.groupBy("name").agg(F.count(F.lit(1)).alias("len"), F.count_if(~gap).alias("n_bases"), F.count_if(F.col("base").isin("N", "X", "?")).alias("unc"), F.count_if(sure).alias("sure"), F.count_if(sure & (F.col("base") == F.col("c"))).alias("same"))
    out = out.select("name", "n_bases", (1 - F.col("n_bases") / F.col("len")).alias("g"), (F.col("unc") / F.nullif("n_bases", F.lit(0))).alias("u"), (F.col("same") / F.nullif("sure", F.lit(0))).alias("i"))
    flags = F.concat_ws(";", F.when(F.col("g") > max_gap, "gappy"), F.when(F.col("i") < min_identity, "divergent"), F.when(F.col("u") > max_uncertain, "uncertain"))
    return out.select("name", "n_bases", F.round("g", 6).alias("gap_share"), F.round("u", 6).alias("uncertain_share"), F.round("i", 6).alias("identity"), flags.alias("flags"))


def codons(rows: DataFrame) -> DataFrame:
    """name, frame, i, codon: the whole codons of each row in the frames 0, 1 and 2."""
    framed = rows.select("name", F.explode(F.array(*(F.lit(k) for k in range(3)))).alias("frame"), "seq")
    n = F.floor((F.length("seq") - F.col("frame")) / 3).cast("int")
    return framed.where(n > 0).select("name", "frame", F.posexplode(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.substring(F.col("seq"), F.col("frame") + 1 + i * 3, F.lit(3)))).alias("i", "codon"))


def reading_frames(rows: DataFrame) -> DataFrame:
    """name, frame, n_stops: the frame with the fewest stop codons inside (the last codon aside), the lowest of equals."""
    stops = lambda k: F.expr(f"size(filter(sequence(0, greatest(cast(floor((length(seq) - {k}) / 3) as int) - 2, 0)), i -> i < floor((length(seq) - {k}) / 3) - 1 and substring(seq, {k} + 1 + i * 3, 3) in {STOPS}))")
    best = F.array_min(F.array(*(F.struct(stops(k).alias("n"), F.lit(k).alias("frame")) for k in range(3))))
    return rows.select("name", best.alias("b")).select("name", "b.frame", F.col("b.n").alias("n_stops"))


def amino_counts(rows: DataFrame) -> DataFrame:
    """frame, amino, n: amino acids of all codons; a codon with an uncertain base is X."""
    order = "TCAG"
    index = sum((F.instr(F.lit(order), F.substring("codon", k + 1, 1)) * (4 ** (2 - k)) for k in range(3)), F.lit(0)) - 21
    amino = F.when(F.col("codon").rlike("^[ACGT]{3}$"), F.substring(F.lit(CODE), index + 1, F.lit(1))).otherwise("X")
    return codons(rows).groupBy("frame", amino.alias("amino")).agg(F.count(F.lit(1)).alias("n"))


def gap_runs(rows: DataFrame, below: float = 0.5) -> DataFrame:
    """first_col, last_col, n_cols: runs of columns whose coverage is under ``below``."""
    low = column_coverage(rows).where(F.col("coverage") < below)
    island = low.withColumn("g", F.col("col") - F.row_number().over(Window.orderBy("col")))
    return island.groupBy("g").agg(F.min("col").alias("first_col"), F.max("col").alias("last_col"), F.count(F.lit(1)).alias("n_cols")).drop("g")


def identical_rows(rows: DataFrame) -> DataFrame:
    """first_name, n, of rows equal once gaps are dropped (two and more)."""
    bare = F.translate("seq", GAPS, "")
    return rows.groupBy(F.sha2(bare, 256).alias("h")).agg(F.min("name").alias("first_name"), F.count(F.lit(1)).alias("n"), F.max(F.length(bare)).alias("n_bases")).where("n > 1").drop("h")


def kept_columns(rows: DataFrame, at_least: float = 0.5) -> DataFrame:
    """col, position: columns of enough coverage and their number once the others are stripped."""
    kept = column_coverage(rows).where(F.col("coverage") >= at_least)
    return kept.select("col", F.row_number().over(Window.orderBy("col")).alias("position"))
