"""Queries of alignment statistics over whole texts, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators import alignment
from tidemark.sources import read_table


def _rows(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.as_rows(read_table(spark, sf, "documents"), "doc_id", "text")


def _bases(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.as_bases(read_table(spark, sf, "documents"), "doc_id", "text")


def alignment_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.column_coverage(_rows(spark, sf))


def alignment_consensus(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.consensus(_rows(spark, sf))


def alignment_qc(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.row_quality(_rows(spark, sf))


def gap_runs(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.gap_runs(_rows(spark, sf), 0.2)


def strip_columns(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.kept_columns(_rows(spark, sf), 0.2)


def duplicate_sets(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.identical_rows(_rows(spark, sf))


def reading_frame(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.reading_frames(_bases(spark, sf))


def codon_translate(spark: SparkSession, sf: str) -> DataFrame:
    return alignment.amino_counts(_bases(spark, sf))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (alignment_coverage, alignment_consensus, alignment_qc, gap_runs, strip_columns, duplicate_sets, reading_frame, codon_translate)
}

_CELLS = r"""
WITH a AS (SELECT doc_id AS name, translate(upper(regexp_replace(text, '[^ -~]', 'N', 'g')), ' ', '-') AS seq FROM documents WHERE text IS NOT NULL),
x AS (SELECT name, unnest(range(1, len(seq) + 1)) AS col, unnest(string_split(seq, '')) AS base FROM a WHERE seq <> ''),
b AS (SELECT col, base, count(*) AS n, min(name) AS first FROM x GROUP BY 1, 2),
v AS (SELECT col, CAST(coalesce(sum(n) FILTER (base NOT IN ('-', '.')), 0) AS BIGINT) AS n_bases, round(coalesce(sum(n) FILTER (base NOT IN ('-', '.')), 0) / (SELECT count(*) FROM a), 6) AS coverage FROM b GROUP BY 1),
k AS (SELECT c.col, coalesce(d.base, '-') AS base FROM (SELECT DISTINCT col FROM b) c LEFT JOIN
  (SELECT col, base FROM b WHERE base NOT IN ('-', '.', 'N', 'X', '?') QUALIFY row_number() OVER (PARTITION BY col ORDER BY n DESC, first, base DESC) = 1) d ON d.col = c.col)
"""
_BASES = r"""
WITH a AS (SELECT doc_id AS name, translate(regexp_replace(lower(text), '[^a-z]', '', 'g'), 'abcdefghijklmnopqrstuvwxyz', 'ACGTACGTACGTACGTACGTACGTAC') AS seq FROM documents WHERE text IS NOT NULL),
f AS (SELECT name, seq, unnest([0, 1, 2]) AS frame FROM a),
c AS (SELECT name, frame, (length(seq) - frame) // 3 AS n, unnest(range((length(seq) - frame) // 3)) AS i, seq FROM f),
d AS (SELECT name, frame, n, i, substr(seq, frame + 1 + i * 3, 3) AS codon FROM c)
"""
SQL: dict[str, str] = {
    "alignment_coverage": _CELLS + "SELECT * FROM v",
    "alignment_consensus": _CELLS + "SELECT * FROM k",
    "alignment_qc": _CELLS
    + """, j AS (SELECT x.name, x.base, k.base AS c FROM x JOIN k ON k.col = x.col),
g AS (SELECT name, count(*) AS len, count(*) FILTER (base NOT IN ('-', '.')) AS n_bases, count(*) FILTER (base IN ('N', 'X', '?')) AS unc,
  count(*) FILTER (base NOT IN ('-', '.', 'N', 'X', '?') AND c <> '-') AS sure, count(*) FILTER (base NOT IN ('-', '.', 'N', 'X', '?') AND c <> '-' AND base = c) AS same FROM j GROUP BY 1),
h AS (SELECT name, n_bases, 1 - n_bases / len AS g, unc / nullif(n_bases, 0) AS u, same / nullif(sure, 0) AS i FROM g)
SELECT name, n_bases, round(g, 6) AS gap_share, round(u, 6) AS uncertain_share, round(i, 6) AS identity,
  concat_ws(';', CASE WHEN g > 0.5 THEN 'gappy' END, CASE WHEN i < 0.8 THEN 'divergent' END, CASE WHEN u > 0.05 THEN 'uncertain' END) AS flags FROM h""",
    "gap_runs": _CELLS + ", r AS (SELECT col, col - row_number() OVER (ORDER BY col) AS g FROM v WHERE coverage < 0.2) SELECT min(col) AS first_col, max(col) AS last_col, count(*) AS n_cols FROM r GROUP BY g",
    "strip_columns": _CELLS + "SELECT col, row_number() OVER (ORDER BY col) AS position FROM v WHERE coverage >= 0.2",
    "duplicate_sets": _CELLS + ", e AS (SELECT name, translate(seq, '-.', '') AS bare FROM a) SELECT min(name) AS first_name, count(*) AS n, length(bare) AS n_bases FROM e GROUP BY bare HAVING count(*) > 1",
    "reading_frame": _BASES
    + """, s AS (SELECT name, frame, count(*) FILTER (codon IN ('TAA', 'TAG', 'TGA') AND i < n - 1) AS n_stops FROM d GROUP BY 1, 2),
z AS (SELECT f.name, f.frame, coalesce(s.n_stops, 0) AS n_stops FROM f LEFT JOIN s ON s.name = f.name AND s.frame = f.frame)
SELECT name, frame, n_stops FROM z QUALIFY row_number() OVER (PARTITION BY name ORDER BY n_stops, frame) = 1""",
    "codon_translate": _BASES
    + f"""SELECT frame, CASE WHEN regexp_full_match(codon, '[ACGT]{{3}}') THEN substr('{alignment.CODE}', (strpos('TCAG', substr(codon, 1, 1)) - 1) * 16 + (strpos('TCAG', substr(codon, 2, 1)) - 1) * 4 + strpos('TCAG', substr(codon, 3, 1)), 1) ELSE 'X' END AS amino, count(*) AS n
FROM d GROUP BY 1, 2""",
}
