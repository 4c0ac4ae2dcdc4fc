"""Queries that hold builds, compositions and columns against each other, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import alignment, builds, coordinates
from tidemark.plans.alignments import _CELLS
from tidemark.plans.problems import _P2
from tidemark.sources import read_table

ORDER = ["load_id", "row_id"]


def _records(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "metadata_all")


def build_findings(spark: SparkSession, sf: str) -> DataFrame:
    return builds.build_findings(read_table(spark, sf, "snapshots"))


def download_checks(spark: SparkSession, sf: str) -> DataFrame:
    return builds.download_checks(read_table(spark, sf, "snapshots"), max_new=40)


def build_measures(spark: SparkSession, sf: str) -> DataFrame:
    """Rows and mean length of every snapshot against the one before; a shift of the mean beyond 50 is an error."""
    rows = read_table(spark, sf, "snapshots").groupBy("pathogen", "build_date").agg(F.count(F.lit(1)).cast("double").alias("n_rows"), F.round(F.avg("seq_length"), 6).alias("mean_length"))
    return builds.measure_changes(rows, ["pathogen"], "build_date", {"n_rows": 0.5}, {"mean_length": 50.0})


def snapshot_context(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of the snapshots by clade and date precision of their last record."""
    rows = read_table(spark, sf, "snapshots").select("pathogen", "accession")
    out = builds.with_context(rows, _records(spark, sf), "accession", ORDER, {"clade": "unassigned", "date_precision": "unknown"})
    return out.groupBy("pathogen", "clade", "date_precision").agg(F.count(F.lit(1)).alias("n"))


def snapshot_match(spark: SparkSession, sf: str) -> DataFrame:
    return builds.match_rates(read_table(spark, sf, "snapshots"), _records(spark, sf), ["pathogen", "build_date"], "accession")


def clade_composition(spark: SparkSession, sf: str) -> DataFrame:
    return builds.composition(_records(spark, sf), "clade", "host_group")


def segment_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return builds.length_report(_records(spark, sf), "segment", "seq_length")


def country_names(spark: SparkSession, sf: str) -> DataFrame:
    return _records(spark, sf).select(builds.country_name(F.col("country_raw")).alias("country")).groupBy("country").agg(F.count(F.lit(1)).alias("n"))


def variable_columns(spark: SparkSession, sf: str) -> DataFrame:
    return coordinates.variable_columns(alignment.as_rows(read_table(spark, sf, "documents"), "doc_id", "text"))


def reference_codons(spark: SparkSession, sf: str) -> DataFrame:
    """Codons of the row with the fewest gaps and their columns."""
    rows = alignment.as_rows(read_table(spark, sf, "documents"), "doc_id", "text").where("seq <> ''")
    codons = coordinates.codon_columns(coordinates.reference_positions(coordinates.reference_row(rows)))
    return codons.select("codon", F.array_join("cols", ",").alias("cols"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (build_findings, download_checks, build_measures, snapshot_context, snapshot_match, clade_composition, segment_lengths, country_names, variable_columns, reference_codons)
}

_SIZES = _P2 + ", s AS (SELECT pathogen, build_date, n_now, lag(n_now) OVER (PARTITION BY pathogen ORDER BY build_date) AS n_before FROM (SELECT pathogen, build_date, count(*) AS n_now FROM l GROUP BY 1, 2))"
_BARE = "upper(trim(split_part(accession, '.', 1)))"

SQL: dict[str, str] = {
    "build_findings": _SIZES
    + """, c AS (SELECT pathogen, build_date, count(*) FILTER (change_kind = 'added') AS a, count(*) FILTER (change_kind = 'removed') AS r, string_agg(accession, ', ' ORDER BY accession) FILTER (change_kind = 'removed' AND i <= 10) AS first_lost
  FROM (SELECT *, row_number() OVER (PARTITION BY pathogen, build_date, change_kind ORDER BY accession) AS i FROM f) GROUP BY 1, 2)
SELECT pathogen, build_date, n_before, n_now, n_now - n_before AS delta, coalesce(a, 0) AS n_added, coalesce(r, 0) AS n_removed, coalesce(a > 0 AND r > 0 AND n_now = n_before, false) AS swapped, first_lost,
  CASE WHEN r > 0 THEN 'error' ELSE 'note' END AS level, CASE WHEN r > 0 THEN 'regression' ELSE 'ok' END AS verdict FROM s LEFT JOIN c USING (pathogen, build_date) WHERE n_before IS NOT NULL""",
    "download_checks": _SIZES
    + """, g AS (SELECT *, CASE WHEN n_now < n_before THEN 'shrunk' WHEN n_now - n_before > 40 THEN 'many_new' WHEN n_now < 20 THEN 'few' ELSE 'fine' END AS finding FROM s)
SELECT pathogen, build_date, n_now, n_before, CASE finding WHEN 'shrunk' THEN 'error' WHEN 'fine' THEN 'ok' ELSE 'warn' END AS level, finding FROM g""",
    "build_measures": """
WITH r AS (SELECT pathogen, build_date, CAST(count(*) AS DOUBLE) AS n, round(avg(seq_length), 6) AS m FROM snapshots GROUP BY 1, 2),
u AS (SELECT pathogen, build_date, 'n_rows' AS measure, n AS after FROM r UNION ALL SELECT pathogen, build_date, 'mean_length', m FROM r),
c AS (SELECT *, lag(after) OVER (PARTITION BY pathogen, measure ORDER BY build_date) AS before FROM u),
d AS (SELECT *, CASE measure WHEN 'n_rows' THEN (after - before) / nullif(abs(before), 0) ELSE after - before END AS change FROM c)
SELECT pathogen, build_date, measure, round(before, 6) AS before, round(after, 6) AS after, round(change, 6) AS change,
  CASE WHEN measure = 'n_rows' THEN CASE WHEN abs(change) > 0.5 THEN 'warn' ELSE 'note' END WHEN abs(change) > 50 THEN 'error' ELSE 'note' END AS level FROM d WHERE change IS NOT NULL""",
    "snapshot_context": f"""
WITH m AS (SELECT {_BARE} AS k, clade, date_precision FROM metadata_all WHERE accession IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {_BARE} ORDER BY load_id DESC, row_id DESC) = 1)
SELECT pathogen, coalesce(clade, 'unassigned') AS clade, coalesce(date_precision, 'unknown') AS date_precision, count(*) AS n FROM snapshots LEFT JOIN m ON k = {_BARE} GROUP BY 1, 2, 3""",
    "snapshot_match": f"""
WITH a AS (SELECT DISTINCT pathogen, build_date, {_BARE} AS k FROM snapshots WHERE accession IS NOT NULL), m AS (SELECT DISTINCT {_BARE} AS h FROM metadata_all WHERE accession IS NOT NULL)
SELECT pathogen, build_date, count(*) AS n, count(h) AS n_matched, round(count(h) / count(*), 6) AS rate, count(h) / count(*) >= 0.9 AS enough FROM a LEFT JOIN m ON h = k GROUP BY 1, 2""",
    "clade_composition": "SELECT clade, host_group, count(*) AS n, round(count(*) / sum(count(*)) OVER (PARTITION BY clade), 6) AS share, count(*) < 5 AS is_thin FROM metadata_all GROUP BY 1, 2",
    "segment_lengths": """
WITH m AS (SELECT segment, count(*) AS n, median(seq_length) AS median FROM metadata_all WHERE segment IS NOT NULL AND seq_length IS NOT NULL GROUP BY 1)
SELECT segment, n, median, count(*) FILTER (seq_length < median) AS n_partial, count(*) FILTER (seq_length % 3 <> 0) AS n_off_frame, count(*) FILTER (seq_length > median * 1.02) AS n_over FROM metadata_all JOIN m USING (segment) WHERE seq_length IS NOT NULL GROUP BY 1, 2, 3""",
    "country_names": "SELECT trim(split_part(country_raw, ':', 1)) AS country, count(*) AS n FROM metadata_all GROUP BY 1",
    "variable_columns": _CELLS
    + """, w AS (SELECT col, count(*) FILTER (base IN ('A', 'C', 'G', 'T')) AS k, count(*) FILTER (base NOT IN ('-', '.', 'N', 'X', '?')) AS c FROM b GROUP BY 1)
SELECT count(*) AS n_columns, count(*) FILTER (k > 1) AS n_variable, count(*) FILTER (c > 1) AS n_differing FROM w""",
    "reference_codons": _CELLS
    + """, r AS (SELECT name FROM a WHERE seq <> '' ORDER BY length(replace(replace(seq, '-', ''), '.', '')) DESC, name LIMIT 1),
p AS (SELECT col, row_number() OVER (ORDER BY col) AS position FROM x WHERE name = (SELECT name FROM r) AND base NOT IN ('-', '.'))
SELECT (position - 1) // 3 + 1 AS codon, string_agg(CAST(col AS VARCHAR), ',' ORDER BY col) AS cols FROM p GROUP BY 1 HAVING count(*) = 3""",
}
