"""Queries of record curation, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import curation
from tidemark.sources import read_table

#: What the screening query looks for in descriptions, in this order.
SCREEN = ["vaccine", "attenuated", "matrix protein", "partial cds"]


def host_normalise(spark: SparkSession, sf: str) -> DataFrame:
    return curation.first_rule(read_table(spark, sf, "hosts_in"), read_table(spark, sf, "host_rules"), "host_id", "host_raw")


def host_rule_usage(spark: SparkSession, sf: str) -> DataFrame:
    return curation.rule_usage(read_table(spark, sf, "hosts_in"), read_table(spark, sf, "host_rules"), "host_id", "host_raw")


def pattern_screen(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "metadata_all").select("load_id", curation.first_pattern(F.col("description"), SCREEN).alias("pattern"))
    return rows.groupBy("load_id", "pattern").agg(F.count(F.lit(1)).alias("n"))


def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    return curation.collection_dates(read_table(spark, sf, "metadata_all"), "row_id", "collection_date")


def curation_cascade(spark: SparkSession, sf: str) -> DataFrame:
    rows = curation.routed(read_table(spark, sf, "metadata_all"))
    return rows.groupBy("exclude_reason", "review_reason", "flagged").agg(F.count(F.lit(1)).alias("n"))


def retention_checks(spark: SparkSession, sf: str) -> DataFrame:
    return curation.retention(read_table(spark, sf, "metadata_all"))


def country_group_counts(spark: SparkSession, sf: str) -> DataFrame:
    return curation.group_counts(read_table(spark, sf, "metadata_all"))


def label_consistency(spark: SparkSession, sf: str) -> DataFrame:
    return curation.label_consistency(read_table(spark, sf, "metadata_all"))


def isolate_linkage(spark: SparkSession, sf: str) -> DataFrame:
    return curation.isolate_linkage(read_table(spark, sf, "metadata_all"))


def dedupe_best(spark: SparkSession, sf: str) -> DataFrame:
    return curation.best_of_identical(read_table(spark, sf, "documents"), "text", "doc_id", [F.coalesce("verified", F.lit(False)), F.coalesce("rating", F.lit(-1))])


def rebuild_decision(spark: SparkSession, sf: str) -> DataFrame:
    return curation.rebuild_decisions(read_table(spark, sf, "snapshots"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (host_normalise, host_rule_usage, pattern_screen, parse_dates, curation_cascade, retention_checks, country_group_counts, label_consistency, isolate_linkage, dedupe_best, rebuild_decision)
}

_UNKNOWN = ", ".join(f"'{x}'" for x in curation.UNKNOWN_DATES)
_TIDY = r"trim(regexp_replace(lower(coalesce({0}, '')), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
_HITS = rf"""
WITH r AS (SELECT lineno, canonical, host_group, {_TIDY.format("pattern")} AS p FROM host_rules),
t AS (SELECT host_id, {_TIDY.format("host_raw")} AS t FROM hosts_in),
h AS (SELECT DISTINCT host_id, lineno FROM t JOIN r ON p <> '' AND (strpos(' ' || t || ' ', ' ' || p || ' ') > 0 OR strpos(' ' || t || ' ', ' ' || p || 's ') > 0 OR strpos(' ' || t || ' ', ' ' || p || 'es ') > 0))
"""
_ROUTED = f"""
WITH t AS (SELECT *, coalesce(lower(trim(collection_date)), '') AS cd FROM metadata_all),
q AS (SELECT *, CASE WHEN is_vaccine THEN 'vaccine_strain' WHEN coalesce(trim(segment), '') = '' THEN 'no_locus' WHEN seq_length < 400 THEN 'too_short' WHEN seq_length > 1.15 * 1824 THEN 'too_long'
  WHEN decimal_year IS NULL THEN 'no_usable_date' WHEN coalesce(host_group, 'unknown') = 'unknown' THEN 'host_unknown' END AS exclude_reason,
  CASE WHEN host_ambiguous THEN 'host_ambiguous' WHEN decimal_year IS NULL AND cd <> '' AND cd NOT IN ({_UNKNOWN}) THEN 'date_unreadable' END AS review_reason FROM t)
"""
_MONTHS = "strpos('janfebmaraprmayjunjulaugsepoctnovdec', left({0}, 3)) // 3 + 1"
_ONE = rf"""CASE WHEN regexp_full_match(@, '\d{{4}}-\d{{1,2}}-\d{{1,2}}') THEN struct_pack(f := 'day', y := CAST(split_part(@, '-', 1) AS INT), m := CAST(split_part(@, '-', 2) AS INT), d := CAST(split_part(@, '-', 3) AS INT))
 WHEN regexp_full_match(@, '\d{{4}}-\d{{1,2}}') THEN struct_pack(f := 'month', y := CAST(split_part(@, '-', 1) AS INT), m := CAST(split_part(@, '-', 2) AS INT), d := 1)
 WHEN regexp_full_match(@, '\d{{1,2}}-[a-z]{{3,}}-\d{{4}}') THEN struct_pack(f := 'day', y := CAST(split_part(@, '-', 3) AS INT), m := {_MONTHS.format("split_part(@, '-', 2)")}, d := CAST(split_part(@, '-', 1) AS INT))
 WHEN regexp_full_match(@, '[a-z]{{3,}}-\d{{4}}') THEN struct_pack(f := 'month', y := CAST(split_part(@, '-', 2) AS INT), m := {_MONTHS.format("split_part(@, '-', 1)")}, d := 1)
 WHEN regexp_full_match(@, '\d{{4}}') THEN struct_pack(f := 'year', y := CAST(@ AS INT), m := 1, d := 1) END"""
_LEN = "day(last_day(make_date(@.y, @.m, 1)))"
_FAIL = f"CASE WHEN @ IS NULL OR @.f IS NULL THEN 'unrecognised_format' WHEN @.y < 1900 OR @.y > 2026 THEN 'year_out_of_range' WHEN @.m < 1 OR @.m > 12 THEN 'invalid_month' WHEN @.d < 1 OR @.d > {_LEN} THEN 'invalid_day' END"
_DEC = "@.y + (dayofyear(make_date(@.y, @.m, {d})) - 1) / (CASE WHEN dayofyear(make_date(@.y, 12, 31)) = 366 THEN 366 ELSE 365 END)"
_MID = f"CASE @.f WHEN 'year' THEN @.y + 0.5::DOUBLE WHEN 'month' THEN {_DEC.format(d=f'CAST(floor({_LEN} / 2) AS INT) + 1')} ELSE {_DEC.format(d='@.d')} END"
_HALF = f"CASE @.f WHEN 'year' THEN 0.5::DOUBLE WHEN 'month' THEN {_LEN} / 2 / 365.25::DOUBLE ELSE 0.5::DOUBLE / 365.25 END"

SQL: dict[str, str] = {
    "host_normalise": _HITS
    + """, w AS (SELECT host_id, min(lineno) AS lineno FROM h GROUP BY 1)
SELECT t.host_id, r.canonical, r.host_group, w.lineno IS NULL AS ambiguous, w.lineno, CASE WHEN w.lineno IS NOT NULL THEN NULL WHEN t.t = '' THEN 'empty_host_field' ELSE 'no_pattern_matched' END AS reason
FROM t LEFT JOIN w ON w.host_id = t.host_id LEFT JOIN r ON r.lineno = w.lineno""",
    "host_rule_usage": _HITS
    + """, f AS (SELECT lineno, min(lineno) OVER (PARTITION BY host_id) AS first FROM h), c AS (SELECT lineno, count(*) AS m, count(*) FILTER (lineno = first) AS w FROM f GROUP BY 1)
SELECT r.lineno, r.canonical, coalesce(m, 0) AS n_matched, coalesce(w, 0) AS n_won, coalesce(m, 0) - coalesce(w, 0) AS n_shadowed FROM r LEFT JOIN c ON c.lineno = r.lineno""",
    "pattern_screen": "SELECT load_id, CASE " + " ".join(f"WHEN contains(lower(description), '{p}') THEN '{p}'" for p in SCREEN) + " END AS pattern, count(*) AS n FROM metadata_all GROUP BY 1, 2",
    "parse_dates": f"""
WITH t AS (SELECT row_id, lower(trim(coalesce(collection_date, ''))) AS t FROM metadata_all),
s AS (SELECT row_id, t, len(string_split(t, '/')) = 2 AS two, trim(split_part(t, '/', 1)) AS t1, trim(split_part(t, '/', 2)) AS t2 FROM t),
p AS (SELECT *, {_ONE.replace("@", "t")} AS x, {_ONE.replace("@", "t1")} AS a, {_ONE.replace("@", "t2")} AS b FROM s),
f AS (SELECT *, {_FAIL.replace("@", "x")} AS fx, {_FAIL.replace("@", "a")} AS fa, {_FAIL.replace("@", "b")} AS fb FROM p),
c AS (SELECT *, CASE WHEN fx IS NULL THEN {_MID.replace("@", "x")} END AS cx, CASE WHEN fx IS NULL THEN {_HALF.replace("@", "x")} END AS hx,
  CASE WHEN two AND coalesce(fa, fb) IS NULL THEN least({_MID.replace("@", "a")} - ({_HALF.replace("@", "a")}), {_MID.replace("@", "b")} - ({_HALF.replace("@", "b")})) END AS lo,
  CASE WHEN two AND coalesce(fa, fb) IS NULL THEN greatest({_MID.replace("@", "a")} + ({_HALF.replace("@", "a")}), {_MID.replace("@", "b")} + ({_HALF.replace("@", "b")})) END AS hi FROM f)
SELECT row_id, CASE WHEN t = '' OR t IN ({_UNKNOWN}) THEN 'none' WHEN two AND lo IS NOT NULL THEN 'range' WHEN two THEN 'none' WHEN fx IS NULL THEN x.f ELSE 'none' END AS precision,
  round(CASE WHEN t = '' OR t IN ({_UNKNOWN}) THEN NULL WHEN two THEN (lo + hi) / 2 ELSE cx END, 6) AS decimal_year, round(CASE WHEN t = '' OR t IN ({_UNKNOWN}) THEN NULL WHEN two THEN (hi - lo) / 2 ELSE hx END, 6) AS uncertainty,
  CASE WHEN t = '' THEN 'empty' WHEN t IN ({_UNKNOWN}) THEN 'explicitly_unknown' WHEN two THEN coalesce(fa, fb, '') ELSE coalesce(fx, '') END AS reason FROM c""",
    "curation_cascade": _ROUTED + "SELECT exclude_reason, review_reason, coalesce(seq_length > 1.02 * 1824 OR seq_length % 3 <> 0, FALSE) AND review_reason IS NULL AS flagged, count(*) AS n FROM q GROUP BY 1, 2, 3",
    "retention_checks": _ROUTED
    + """, g AS (SELECT load_id, exclude_reason, count(*) AS n FROM q GROUP BY 1, 2)
, k AS (SELECT load_id, sum(n)::BIGINT AS n_rows, coalesce(sum(n) FILTER (exclude_reason IS NULL), 0)::BIGINT AS n_kept FROM g GROUP BY 1)
, m AS (SELECT load_id, exclude_reason AS main_reason FROM g WHERE exclude_reason IS NOT NULL QUALIFY row_number() OVER (PARTITION BY load_id ORDER BY n DESC, exclude_reason DESC) = 1)
SELECT k.load_id, n_rows, n_kept, main_reason, round(n_kept / n_rows, 6) AS kept_share, CASE WHEN n_kept = 0 THEN 'error' WHEN n_kept / n_rows < 0.5 OR n_kept < 20 THEN 'warn' ELSE 'ok' END AS verdict FROM k LEFT JOIN m ON m.load_id = k.load_id""",
    "country_group_counts": "SELECT host_group, date_precision, count(*) AS n, count(DISTINCT country) AS n_countries, min(decimal_year) AS first_year, max(decimal_year) AS last_year FROM metadata_all GROUP BY 1, 2",
    "label_consistency": """
SELECT coalesce(host_group, 'unknown') AS host_group, count(*) AS n_labels, 0 AS n_host_mismatch, count(*) FILTER (abs(round(decimal_year, 3) - decimal_year) > 0.01) AS n_year_mismatch, 0 AS n_unparsed
FROM metadata_all WHERE decimal_year IS NOT NULL AND accession IS NOT NULL GROUP BY 1""",
    "isolate_linkage": """
SELECT key, count(*) AS n_records, count(DISTINCT segment) AS n_segments FROM (SELECT coalesce(nullif(trim(isolate), ''), nullif(trim(strain), '')) AS key, segment FROM metadata_all) WHERE key IS NOT NULL GROUP BY 1 HAVING count(*) > 1""",
    "dedupe_best": """
SELECT doc_id, n_copies FROM (SELECT doc_id, count(*) OVER (PARTITION BY text) AS n_copies, row_number() OVER (PARTITION BY text ORDER BY coalesce(verified, FALSE) DESC, coalesce(rating, -1) DESC, doc_id) AS r FROM documents) WHERE r = 1""",
    "rebuild_decision": """
WITH s AS (SELECT pathogen, build_date, count(DISTINCT upper(split_part(trim(accession), '.', 1))) AS n FROM snapshots WHERE accession IS NOT NULL GROUP BY 1, 2),
l AS (SELECT *, lag(n) OVER (PARTITION BY pathogen ORDER BY build_date) AS previous FROM s)
SELECT *, n - previous AS delta, CASE WHEN previous IS NULL THEN 'first' WHEN n < previous THEN 'shrunk' WHEN n = previous THEN 'unchanged' WHEN n - previous < 5 THEN 'too_few' WHEN n - previous > 500 THEN 'rebuild_warn' ELSE 'rebuild' END AS decision FROM l""",
}
