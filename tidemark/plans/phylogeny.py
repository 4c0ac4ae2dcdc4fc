"""Queries on trees, and their SQL. Events make the nodes: event k hangs below event k div 2."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import trees
from tidemark.session import checkpointed
from tidemark.sources import read_table


def _nodes(spark: SparkSession, sf: str) -> DataFrame:
    """event_id counts from 0 or 1; the least id is the root."""
    events = read_table(spark, sf, "events")
    low = events.agg(F.min("event_id")).first()[0] or 0
    node = F.col("event_id") - low + 1
    up = F.floor(node / 2).cast("long")
    return checkpointed(events.select(node.alias("node"), F.when(node > 1, up).alias("parent"), F.abs(F.coalesce("value", F.lit(0.0))).alias("length"), F.col("event_type").alias("state")))


def _turned(nodes: DataFrame) -> DataFrame:
    """The same nodes under other parents: each hangs below the third of its number."""
    up = F.greatest(F.floor(F.col("node") / 3).cast("long"), F.lit(1))
    return nodes.withColumn("parent", F.when(F.col("node") > 1, up))


def tree_depths(spark: SparkSession, sf: str) -> DataFrame:
    return trees.node_depths(trees.ancestors(_nodes(spark, sf))).select("node", F.round("depth", 6).alias("depth"), "level")


def clade_cut(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _nodes(spark, sf)
    return trees.clade_cut(trees.ancestors(nodes), trees.tips(nodes), 300.0, 4)


def split_distance(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _nodes(spark, sf)
    leaves = checkpointed(trees.tips(nodes).select("node").intersect(trees.tips(_turned(nodes)).select("node")))
    return trees.split_distance(*(trees.splits(trees.ancestors(t), leaves) for t in (nodes, _turned(nodes))))


def association_index(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _nodes(spark, sf)
    leaves = checkpointed(trees.tips(nodes))
    return trees.association_index(trees.state_counts(trees.ancestors(nodes), leaves.select("node", "state")), leaves)


def monophyletic_clades(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _nodes(spark, sf)
    return trees.pure_clades(trees.state_counts(trees.ancestors(nodes), trees.tips(nodes).select("node", "state")))


def trait_signal(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _nodes(spark, sf)
    return trees.trait_signal(trees.ancestors(nodes), trees.tips(nodes))


def trait_verdict(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _nodes(spark, sf)
    return trees.trait_verdict(nodes, None, trees.tips(nodes))


def fitch_score(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _nodes(spark, sf)
    states = nodes.select("state").where("state is not null").distinct()
    bits = states.select("state", F.pow(F.lit(2), F.row_number().over(Window.orderBy("state")) - 1).cast("long").alias("mask"))
    masks = trees.tips(nodes).join(F.broadcast(bits), "state").select("node", "mask")
    return trees.parsimony_score(nodes, trees.node_depths(trees.ancestors(nodes)), masks)


def _jumps(spark: SparkSession, sf: str) -> DataFrame:
    nodes = _nodes(spark, sf)
    return trees.transitions(nodes, checkpointed(trees.node_depths(trees.ancestors(nodes))), trees.tips(nodes), 2025.0)


def jumps(spark: SparkSession, sf: str) -> DataFrame:
    decade = (F.floor(F.col("year") / 10) * 10).cast("long")
    rows = _jumps(spark, sf).groupBy("parent_state", "state", decade.alias("decade"))
    return rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("terminal").alias("n_terminal"))


def jump_summary(spark: SparkSession, sf: str) -> DataFrame:
    return trees.transition_summary(_jumps(spark, sf), 1800.0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (tree_depths, clade_cut, split_distance, association_index, monophyletic_clades, trait_signal, trait_verdict, fitch_score, jumps, jump_summary)
}

_NODES = """
WITH RECURSIVE n AS MATERIALIZED (SELECT node, CASE WHEN node > 1 THEN node // 2 END AS parent, length, state FROM (SELECT event_id - (SELECT min(event_id) FROM events) + 1 AS node, abs(coalesce(value, 0)) AS length, event_type AS state FROM events)),
c(node, ancestor, hops, dist) AS (SELECT node, node, 0, 0.0::DOUBLE FROM n UNION ALL SELECT c.node, p.parent, c.hops + 1, c.dist + p.length FROM c JOIN n p ON p.node = c.ancestor WHERE p.parent IS NOT NULL),
t AS (SELECT * FROM n WHERE node NOT IN (SELECT parent FROM n WHERE parent IS NOT NULL)),
s AS (SELECT c.ancestor AS node, t.state, count(*) AS n FROM c JOIN t ON t.node = c.node WHERE t.state IS NOT NULL GROUP BY 1, 2),
d AS (SELECT node, max(dist) AS depth, max(hops) AS level FROM c GROUP BY 1)
"""
_JUMPS = (
    _NODES
    + """, j AS (SELECT p.state AS parent_state, n.state, round(2025.0::DOUBLE - ((SELECT max(depth) FROM d) - d.depth) - n.length / 2, 6) AS year, n.node IN (SELECT node FROM t) AS terminal
FROM n JOIN n p ON p.node = n.parent JOIN d ON d.node = n.node WHERE n.state <> p.state)
"""
)
_HASH = "CAST(('0x' || substr(md5(CAST(node AS VARCHAR)), 1, 12)) AS HUGEINT)"
SQL: dict[str, str] = {
    "tree_depths": _NODES + "SELECT node, round(depth, 6) AS depth, level FROM d",
    "clade_cut": _NODES
    + """, b AS (SELECT c.ancestor AS node, c.dist, row_number() OVER (PARTITION BY c.ancestor ORDER BY c.dist DESC) AS r FROM c JOIN t ON t.node = c.node),
z AS (SELECT node, count(*) AS n_tips, CASE WHEN count(*) > 1 THEN max(dist) + max(dist) FILTER (r = 2) ELSE 0 END AS diameter FROM b GROUP BY 1),
g AS (SELECT * FROM z WHERE diameter <= 300)
SELECT node AS clade, n_tips, round(diameter, 6) AS diameter, n_tips >= 4 AS kept FROM g WHERE node NOT IN (SELECT c.node FROM c JOIN g ON g.node = c.ancestor WHERE c.hops > 0)""",
    "split_distance": _NODES.replace("t AS (", "n2 AS (SELECT node, CASE WHEN node > 1 THEN greatest(node // 3, 1) END AS parent FROM n),\nc2(node, ancestor) AS (SELECT node, node FROM n2 UNION ALL SELECT c2.node, p.parent FROM c2 JOIN n2 p ON p.node = c2.ancestor WHERE p.parent IS NOT NULL),\nt AS (")
    + f""", h AS (SELECT node, {_HASH} AS h FROM t WHERE node NOT IN (SELECT parent FROM n2 WHERE parent IS NOT NULL)),
w AS (SELECT count(*) AS an, sum(h) AS asig FROM h),
r1 AS (SELECT ancestor, count(*) AS n, sum(h) AS sig FROM c JOIN h ON h.node = c.node GROUP BY 1), r2 AS (SELECT ancestor, count(*) AS n, sum(h) AS sig FROM c2 JOIN h ON h.node = c2.node GROUP BY 1),
u AS (SELECT DISTINCT 1 AS k, CASE WHEN an - n < n OR (an - n = n AND asig - sig < sig) THEN asig - sig ELSE sig END AS sig FROM r1, w WHERE n > 1 AND an - n > 1
  UNION ALL SELECT DISTINCT 2, CASE WHEN an - n < n OR (an - n = n AND asig - sig < sig) THEN asig - sig ELSE sig END FROM r2, w WHERE n > 1 AND an - n > 1),
v AS (SELECT sig, sum(k) AS k FROM u GROUP BY 1), f AS (SELECT count(*) FILTER (k <> 2) AS n_a, count(*) FILTER (k <> 1) AS n_b, count(*) FILTER (k = 3) AS n_shared FROM v)
SELECT *, round(coalesce((n_a + n_b - 2 * n_shared) / nullif(n_a + n_b, 0), 0), 6) AS distance FROM f""",
    "association_index": _NODES
    + """, i AS (SELECT node, max(n) AS top, sum(n) AS n FROM s WHERE node NOT IN (SELECT node FROM t) GROUP BY 1)
SELECT count(*) AS n_nodes, round(coalesce(sum(CASE WHEN n > 1024 THEN 0 ELSE (1 - top / n) / pow(2, n - 1) END), 0), 6) AS ai FROM i""",
    "monophyletic_clades": _NODES + ", g AS (SELECT *, sum(n) OVER (PARTITION BY node) AS total FROM s) SELECT state, max(n) AS n_tips, max(n) FILTER (n = total) AS largest FROM g GROUP BY 1",
    "trait_signal": _NODES
    + """, e AS (SELECT node, state, unnest(range(1, 20)) AS rep FROM t WHERE state IS NOT NULL),
a AS (SELECT rep, node, row_number() OVER (PARTITION BY rep ORDER BY md5('a|' || rep || '|' || node)) AS r FROM e), b AS (SELECT rep, state, row_number() OVER (PARTITION BY rep ORDER BY md5('b|' || rep || '|' || node)) AS r FROM e),
l AS (SELECT 0 AS rep, node, state FROM t WHERE state IS NOT NULL UNION ALL SELECT a.rep, a.node, b.state FROM a JOIN b ON b.rep = a.rep AND b.r = a.r),
k AS (SELECT l.rep, c.ancestor, l.state, count(*) AS n FROM c JOIN l ON l.node = c.node WHERE c.hops > 0 GROUP BY 1, 2, 3), q AS (SELECT rep, ancestor, max(n) AS top, sum(n) AS n FROM k GROUP BY 1, 2),
i AS (SELECT rep, round(sum(CASE WHEN n > 1024 THEN 0 ELSE (1 - top / n) / pow(2, n - 1) END), 6) AS ai FROM q GROUP BY 1),
z AS (SELECT (SELECT ai FROM i WHERE rep = 0) AS ai, avg(ai) FILTER (rep > 0) AS m, (count(*) FILTER (rep > 0 AND ai <= (SELECT ai FROM i WHERE rep = 0)) + 1) / (count(*) FILTER (rep > 0) + 1) AS p FROM i)
SELECT (SELECT count(*) FROM t WHERE state IS NOT NULL) AS n_tips, ai, round(m, 6) AS null_mean, round(p, 6) AS p, CASE WHEN p <= 0.05 THEN 'pass' ELSE 'fail' END AS verdict FROM z""",
    "jumps": _JUMPS + "SELECT parent_state, state, CAST(floor(year / 10) * 10 AS BIGINT) AS decade, count(*) AS n, count(*) FILTER (terminal) AS n_terminal FROM j GROUP BY 1, 2, 3",
    "jump_summary": _JUMPS
    + """SELECT parent_state, state, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share, round(quantile_cont(year, 0.5), 6) AS median_year, round(quantile_cont(year, 0.75) - quantile_cont(year, 0.25), 6) AS iqr,
  round(avg(CAST(terminal AS INT)), 6) AS terminal_share, round(avg(CAST(year < 1800 AS INT)), 6) AS deep_share FROM j GROUP BY 1, 2""",
}
