"""Queries of the general problems over the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import drift, hotkeys, profile, snapshots, timestamps
from tidemark.sources import read_table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.snapshot_changes(read_table(spark, sf, "snapshots"))


def p2_decisions(spark: SparkSession, sf: str) -> DataFrame:
    return snapshots.snapshot_decisions(p2_found(spark, sf))


def p3_normalised(spark: SparkSession, sf: str) -> DataFrame:
    return timestamps.normalise_timestamps(read_table(spark, sf, "dates_in"), read_table(spark, sf, "sites"))


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    return p3_normalised(spark, sf).where("outcome = 'ok'").drop("outcome")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return profile.quality_cases(read_table(spark, sf, "metadata_all"))


def p5_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.column_profile(read_table(spark, sf, "metadata_all"))


def p5_drift(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distribution_changes(read_table(spark, sf, "metadata_all"))


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    return drift.schema_changes(read_table(spark, sf, "builds")).select("build_id", "field_name", "change_kind")


def p6_table(spark: SparkSession, sf: str) -> DataFrame:
    return drift.clade_table(read_table(spark, sf, "builds")).withColumns({c: F.to_json(c) for c in ("failed", "rest")})


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "metadata_all")
    return hotkeys.key_medians(rows, ["host_group", "country"], "decimal_year", "row_id").select("host_group", "country", "row_id")


def p7_snapshot_pairs(spark: SparkSession, sf: str) -> DataFrame:
    records, snaps = read_table(spark, sf, "metadata_all"), read_table(spark, sf, "snapshots")
    keep = snaps.select("accession", F.col("seq_length").cast("long").alias("snapshot_length"))
    return hotkeys.eager_join_sums(records.select("accession", "host_group", "country", F.col("seq_length").cast("long").alias("record_length")), keep, ["accession"], ["host_group", "country"], ["record_length"], ["snapshot_length"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p2_found, p2_decisions, p3_found, p3_normalised, p5_found, p5_profile, p5_drift, p6_found, p6_table, p7_found, p7_snapshot_pairs)
}

_P2 = r"""
WITH n AS (
  SELECT pathogen, build_date, loaded_at, snap_row_id,
         split_part(upper(regexp_replace(accession, '^\s+|\s+$', '', 'g')), '.', 1) AS accession,
         CASE WHEN strpos(accession, '.') > 0 THEN regexp_replace(upper(regexp_replace(accession, '^\s+|\s+$', '', 'g')), '^[^.]*\.', '') ELSE '' END AS v,
         coalesce(lower(regexp_replace(trim(host_group), '\s+', ' ', 'g')), '') AS a,
         coalesce(lower(regexp_replace(trim(country), '\s+', ' ', 'g')), '') AS b,
         coalesce(lower(regexp_replace(trim(collection_date), '\s+', ' ', 'g')), '') AS c,
         coalesce(lower(regexp_replace(trim(lat_lon), '\s+', ' ', 'g')), '') AS d,
         coalesce(CAST(seq_length AS VARCHAR), '') AS e
  FROM snapshots),
l AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY pathogen, build_date, accession ORDER BY loaded_at DESC, snap_row_id DESC) = 1),
b AS (SELECT pathogen, build_date AS cur, lag(build_date) OVER (PARTITION BY pathogen ORDER BY build_date) AS prev FROM (SELECT DISTINCT pathogen, build_date FROM l)),
x AS (SELECT b.pathogen, b.cur, l.* EXCLUDE (pathogen) FROM b JOIN l ON l.pathogen = b.pathogen AND l.build_date = b.cur WHERE b.prev IS NOT NULL),
y AS (SELECT b.pathogen, b.cur, l.* EXCLUDE (pathogen) FROM b JOIN l ON l.pathogen = b.pathogen AND l.build_date = b.prev WHERE b.prev IS NOT NULL),
f AS (
  SELECT coalesce(x.pathogen, y.pathogen) AS pathogen, coalesce(x.cur, y.cur) AS build_date, coalesce(x.accession, y.accession) AS accession,
         CASE WHEN y.accession IS NULL THEN 'added' WHEN x.accession IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
  FROM x FULL OUTER JOIN y ON x.pathogen = y.pathogen AND x.cur = y.cur AND x.accession = y.accession
  WHERE x.accession IS NULL OR y.accession IS NULL OR (x.v, x.a, x.b, x.c, x.d, x.e) IS DISTINCT FROM (y.v, y.a, y.b, y.c, y.d, y.e))
"""

_DAY = r"(regexp_full_match({0}, '\d{{4}}(-\d{{2}}){{0,2}}') AND CAST(left({0}, 4) AS INT) BETWEEN 1900 AND 2025 AND try_cast({0} || CASE length({0}) WHEN 4 THEN '-01-01' WHEN 7 THEN '-01' ELSE '' END AS DATE) IS NOT NULL)"
_SINGLE = "CASE length(v) WHEN 10 THEN 'day' WHEN 7 THEN 'month' ELSE 'year' END"
_FORM = rf"""CASE f WHEN 'collection_date' THEN CASE WHEN {_DAY.format("v")} THEN {_SINGLE} WHEN length(v) - length(replace(v, '/', '')) = 1 AND {_DAY.format("split_part(v, '/', 1)")} AND {_DAY.format("split_part(v, '/', 2)")} THEN 'range' END
  WHEN 'lat_lon' THEN CASE WHEN regexp_full_match(v, '\d{{1,3}}(\.\d+)? [NS] \d{{1,3}}(\.\d+)? [EW]') AND try_cast(split_part(v, ' ', 1) AS DOUBLE) <= 90 AND try_cast(split_part(v, ' ', 3) AS DOUBLE) <= 180 THEN split_part(v, ' ', 2) || split_part(v, ' ', 4) END
  WHEN 'segment' THEN CASE WHEN regexp_full_match(v, '[1-9]|10') THEN v END END"""

#: Columns of metadata_all as texts, written as Spark writes them.
_TEXTS = {"number": ("row_id", "seq_length", "decimal_year", "date_uncertainty_years"), "text": ("accession", "description", "segment", "host_canonical", "host_group", "country_raw", "country", "collection_date", "date_precision", "date_reason", "strain", "isolate", "lat_lon", "clade"), "flag": ("host_ambiguous", "is_vaccine")}
_UNPIVOT = " UNION ALL ".join(
    [f"SELECT load_id, '{c}' AS f, CAST({c} AS VARCHAR) AS v, '{kind}' AS kind FROM metadata_all" for kind, columns in _TEXTS.items() for c in columns]
    + ["SELECT load_id, 'loaded_at', regexp_replace(strftime(loaded_at, '%Y-%m-%d %H:%M:%S.%f'), '\\.?0*$', ''), 'text' FROM metadata_all"]
)

SQL: dict[str, str] = {
    "p2_found": _P2 + "SELECT * FROM f",
    "p2_decisions": _P2
    + """, g AS (SELECT pathogen, build_date, count(*) FILTER (change_kind = 'added') AS n_added, count(*) FILTER (change_kind = 'removed') AS n_removed, count(*) FILTER (change_kind = 'changed') AS n_changed FROM f GROUP BY 1, 2)
SELECT *, n_added - n_removed AS delta, CASE WHEN n_removed > 0 THEN 'regression' WHEN n_changed > 0 THEN 'review' ELSE 'ok' END AS verdict FROM g""",
    "p5_found": f"""
WITH u AS (SELECT row_id, load_id, f, v FROM (SELECT row_id, load_id, unnest(['collection_date', 'lat_lon', 'segment']) AS f, unnest([collection_date, lat_lon, segment]) AS v FROM metadata_all)),
k AS (SELECT *, (v IS NULL OR v = '') AS missing, CASE WHEN v <> '' THEN {_FORM} END AS form FROM u),
t AS (SELECT load_id, f, count(*) AS n, count(form) AS valid FROM k GROUP BY 1, 2),
s AS (SELECT k.load_id, k.f, k.form, CASE WHEN k.form IS NULL THEN count(*) / any_value(t.n) ELSE count(*) / any_value(t.valid) END AS share FROM k JOIN t ON t.load_id = k.load_id AND t.f = k.f WHERE k.missing OR k.form IS NOT NULL GROUP BY 1, 2, 3),
o AS (SELECT load_id, lag(load_id) OVER (ORDER BY load_id) AS prev FROM (SELECT DISTINCT load_id FROM metadata_all)),
d AS (SELECT load_id, f, form, sum(share) AS c FROM (SELECT load_id, f, form, share FROM s JOIN o USING (load_id) WHERE prev IS NOT NULL UNION ALL SELECT o.load_id, f, form, -share FROM s JOIN o ON o.prev = s.load_id) GROUP BY 1, 2, 3)
SELECT f AS field_name, 'cell' AS case_kind, row_id AS case_id FROM k WHERE NOT missing AND form IS NULL
UNION ALL SELECT DISTINCT f, 'load', CAST(load_id AS BIGINT) FROM d WHERE abs(c) > 0.25""",
    "p5_profile": f"""
WITH u AS ({_UNPIVOT}),
k AS (SELECT load_id, f, v, kind, (v IS NULL OR v = '') AS missing, CASE WHEN v <> '' THEN CASE WHEN f IN ('collection_date', 'lat_lon', 'segment') THEN {_FORM} ELSE 'any' END END AS form FROM u)
SELECT load_id, f AS field_name, count(*) AS n_rows, count(*) FILTER (missing) AS n_missing, count(DISTINCT v) FILTER (NOT missing) AS n_distinct, min(v) FILTER (NOT missing) AS min_text, max(v) FILTER (NOT missing) AS max_text,
  min(TRY_CAST(v AS DOUBLE)) FILTER (NOT missing AND kind = 'number') AS min_number, max(TRY_CAST(v AS DOUBLE)) FILTER (NOT missing AND kind = 'number') AS max_number,
  count(*) FILTER (NOT missing AND form IS NULL) AS n_broken, count(*) FILTER (missing) / count(*) AS missing_rate FROM k GROUP BY 1, 2""",
    "p7_found": """
SELECT host_group, country, row_id FROM (
  SELECT host_group, country, row_id, row_number() OVER w AS r, count(*) OVER (PARTITION BY host_group, country) AS n FROM metadata_all
  WHERE host_group IS NOT NULL AND country IS NOT NULL AND decimal_year IS NOT NULL WINDOW w AS (PARTITION BY host_group, country ORDER BY decimal_year, row_id))
WHERE r = (n + 1) // 2""",
    "p7_snapshot_pairs": """
SELECT m.host_group, m.country, count(*) AS n_pairs, CAST(sum(m.seq_length) AS BIGINT) AS sum_record_length, CAST(sum(s.seq_length) AS BIGINT) AS sum_snapshot_length
FROM metadata_all m JOIN snapshots s ON s.accession = m.accession GROUP BY 1, 2""",
}
