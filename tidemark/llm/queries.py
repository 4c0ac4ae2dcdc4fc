"""Queries of the training-data problems over the given tables, and their SQL where SQL can say it.

Modules that need numpy, pandas or Spark ML are imported by the queries that use
them, which keeps the driver of the others small.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import canonical, sampling
from tidemark.session import checkpointed
from tidemark.sources import read_table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return p1_hosts(spark, sf).where("not ambiguous").select("host_id", "canonical")


def p1_hosts(spark: SparkSession, sf: str) -> DataFrame:
    return canonical.canonical_values(read_table(spark, sf, "hosts_in"), read_table(spark, sf, "host_rules"))


def _members(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.category_members(read_table(spark, sf, "metadata_all"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.unmet_targets(_members(spark, sf), read_table(spark, sf, "sample_targets")).select("design_id", "category")


def p4_sample(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.draw_samples(_members(spark, sf), read_table(spark, sf, "sample_targets"))


def p4_report(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.sample_report(_members(spark, sf), read_table(spark, sf, "sample_targets"))


def p8_ids(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm import encode

    return encode.encoded(read_table(spark, sf, "documents"))


def p8_sizes(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm import encode

    sizes = read_table(spark, sf, "documents").select("source", encode.token_count(F.col("text")).alias("n"))
    return sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n").alias("n_tokens"), F.max("n").alias("longest"))


def _sizes(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm import encode

    docs = read_table(spark, sf, "documents").where("source is not null")
    return checkpointed(docs.select(F.col("doc_id").alias("key"), "source", encode.token_count(F.col("text")).alias("n_tokens")))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm import mixing

    return mixing.short_sources(_sizes(spark, sf), read_table(spark, sf, "mix_targets")).select("source")


def p9_mix(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm import mixing

    return mixing.mix_sources(_sizes(spark, sf), read_table(spark, sf, "mix_targets"))


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm import mixing

    return mixing.mix_report(_sizes(spark, sf), read_table(spark, sf, "mix_targets"))


def _subject_tables(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(read_table(spark, sf, t) for t in ("documents", "subjects", "subject_labels"))


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm import subjects

    return subjects.document_subjects(*_subject_tables(spark, sf)).select("doc_id", "subject")


def p10_leaves(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.llm import subjects

    return subjects.leaf_terms(*_subject_tables(spark, sf))


def p10_composition(spark: SparkSession, sf: str) -> DataFrame:
    """Documents and characters of the corpus by source and subject (``none`` for documents without one)."""
    from tidemark.llm import subjects

    tables = _subject_tables(spark, sf)
    found = subjects.document_subjects(*tables).select("doc_id", "subject")
    docs = tables[0].select("doc_id", "source", "n_chars").join(found, "doc_id", "left")
    return docs.groupBy("source", F.coalesce("subject", F.lit("none")).alias("subject")).agg(F.count(F.lit(1)).alias("n_documents"), F.sum("n_chars").alias("n_chars"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_hosts, p4_found, p4_sample, p4_report, p8_ids, p8_sizes, p9_found, p9_mix, p9_shares, p10_found, p10_leaves, p10_composition)}



def _plain(text: str) -> str:
    """A text as ``canonical.normalised`` reads it."""
    letters = f"translate(lower({text}), '{canonical.ACCENTED}', '{canonical.PLAIN}')"
    return rf"trim(regexp_replace(regexp_replace(regexp_replace({letters}, '[^a-z0-9]+', ' ', 'g'), '([a-z])0', '\1o', 'g'), '0([a-z])', 'o\1', 'g'))"


def _swapped(word: str) -> str:
    return f"list_transform(range(1, greatest(length({word}) - 1, 1) + 1), lambda i: substr({word}, 1, i - 1) || substr({word}, i + 1, 1) || substr({word}, i, 1) || substr({word}, i + 2))"


_NAMED = f"""
WITH h AS (SELECT host_id, coalesce({_plain("host_raw")}, '') AS t FROM hosts_in),
x AS (SELECT t, list_filter(string_split(t, ' '), lambda v: v <> '') AS l FROM (SELECT DISTINCT t FROM h WHERE t <> '')),
w AS (SELECT t, l[i] AS token, i - 1 AS pos, CASE WHEN i > 1 THEN left(l[i - 1], 1) END AS initial FROM (SELECT t, l, unnest(range(1, len(l) + 1)) AS i FROM x)),
p AS (SELECT lineno, canonical, host_group, w, len(w) AS n FROM (SELECT *, string_split({_plain("pattern")}, ' ') AS w FROM host_rules WHERE {_plain("pattern")} <> '')),
c AS (SELECT 'one' AS kind, w[1] AS w1, '' AS w2, '' AS w3, lineno, canonical, host_group FROM p WHERE n = 1
  UNION ALL SELECT 'two', w[n - 1], w[n], '', lineno, canonical, host_group FROM p WHERE n > 1
  UNION ALL SELECT 'two', w[2], w[1], '', lineno, canonical, host_group FROM p WHERE n = 2
  UNION ALL SELECT 'three', w[n], w[1], w[2], lineno, canonical, host_group FROM p WHERE n > 2
  UNION ALL SELECT 'one', w[n - 1] || w[n], '', '', lineno, canonical, host_group FROM p WHERE n > 1
  UNION ALL SELECT 'one', array_to_string(w, ''), '', '', lineno, canonical, host_group FROM p WHERE n > 1
  UNION ALL SELECT 'short', left(w[1], 1), w[2], '', lineno, canonical, host_group FROM p WHERE n = 2 AND lower(canonical) = array_to_string(w, ' ')
  UNION ALL SELECT 'one', left(w[1], 1) || w[2], '', '', lineno, canonical, host_group FROM p WHERE n = 2 AND lower(canonical) = array_to_string(w, ' ')),
n AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY kind, w1, w2, w3 ORDER BY lineno, canonical, host_group) = 1),
v AS (SELECT word, CASE WHEN length(word) >= 6 THEN 2 WHEN length(word) >= 3 THEN 1 ELSE 0 END AS k FROM (
  SELECT w1 AS word FROM n WHERE kind <> 'short' UNION SELECT w2 FROM n UNION SELECT w3 FROM n) WHERE word <> ''),
d AS (SELECT token, word, k, levenshtein(word, token) AS d FROM (SELECT DISTINCT token FROM w) JOIN v ON abs(length(word) - length(token)) <= greatest(k, 1)),
m AS (SELECT token, word, CASE WHEN token = word || 's' THEN 0 ELSE d END AS d FROM d WHERE token = word || 's' OR d <= k OR (k >= 1 AND d <= 2 * k AND (
  list_min(list_transform({_swapped("word")}, lambda s: levenshtein(s, token))) <= k - 1
  OR (k = 2 AND (list_min(list_transform({_swapped("token")}, lambda s: levenshtein(s, word))) <= 1 OR list_has_any({_swapped("word")}, {_swapped("token")})))))),
e AS (SELECT t, pos, initial, word FROM w JOIN (SELECT * FROM m QUALIFY d = min(d) OVER (PARTITION BY token)) USING (token)),
f AS (SELECT t, pos AS a, pos AS z, kind, canonical, host_group FROM e JOIN n ON kind = 'one' AND w1 = word
  UNION ALL SELECT t, pos - 1, pos, kind, canonical, host_group FROM e JOIN n ON kind = 'short' AND w1 = initial AND w2 = word
  UNION ALL SELECT i.t, i.pos, i.pos + 1, kind, canonical, host_group FROM e i JOIN e j ON j.t = i.t AND j.pos = i.pos + 1 JOIN n ON kind = 'two' AND w1 = i.word AND w2 = j.word
  UNION ALL SELECT i.t, i.pos, i.pos + 2, kind, canonical, host_group FROM e i JOIN e j ON j.t = i.t AND j.pos = i.pos + 1 JOIN e k ON k.t = i.t AND k.pos = i.pos + 2 JOIN n ON kind = 'three' AND w1 = i.word AND w2 = j.word AND w3 = k.word),
g AS (SELECT DISTINCT t, canonical, host_group FROM (SELECT t, unnest(range(a, z + 1)) AS pos, kind <> 'one' AS wide, canonical, host_group FROM f) QUALIFY wide = max(wide) OVER (PARTITION BY t, pos)),
r AS (SELECT * FROM g WHERE NOT (canonical LIKE '% sp.' AND EXISTS (SELECT 1 FROM g o WHERE o.t = g.t AND o.canonical <> g.canonical AND split_part(o.canonical, ' ', 1) = split_part(g.canonical, ' ', 1)))),
q AS (SELECT t, count(*) AS n, min(canonical) AS canonical, min(host_group) AS host_group FROM r GROUP BY 1)
"""

SQL: dict[str, str] = {
    "p1_found": _NAMED + "SELECT host_id, canonical FROM h JOIN q USING (t) WHERE n = 1",
    "p1_hosts": _NAMED
    + """SELECT host_id, CASE WHEN n = 1 THEN canonical END AS canonical, CASE WHEN n = 1 THEN host_group END AS host_group, coalesce(n <> 1, true) AS ambiguous, CAST(coalesce(n, 0) AS INT) AS n_named,
  CASE WHEN n = 1 THEN NULL WHEN n > 1 THEN 'several' WHEN t = '' THEN 'empty' ELSE 'unmatched' END AS reason FROM h LEFT JOIN q USING (t)""",
    "p4_found": """
WITH m AS (
  SELECT 'host_group' AS dimension, host_group AS category, accession FROM metadata_all
  UNION ALL SELECT 'clade', clade, accession FROM metadata_all
  UNION ALL SELECT 'decade', CAST(CAST(floor(decimal_year / 10) * 10 AS BIGINT) AS VARCHAR) || 's', accession FROM metadata_all),
a AS (SELECT dimension, category, count(DISTINCT accession) AS n FROM m WHERE category IS NOT NULL GROUP BY 1, 2)
SELECT t.design_id, t.category FROM sample_targets t LEFT JOIN a ON a.dimension = t.dimension AND a.category = t.category
WHERE coalesce(a.n, 0) < greatest(t.target_share * t.sample_size, coalesce(t.min_rows, 0))""",
}
