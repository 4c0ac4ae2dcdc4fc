"""Queries on many trees at once, and their SQL.

Every order date makes a tree over the nations: a nation is a tip, ranked by the
total price of that day's orders of its customers; rank r stands at node 24 + r
and every node hangs below half its number. Its state is its region. The operators
need numpy and pandas; only queries that use them import them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed
from tidemark.sources import read_table


def _trees(spark: SparkSession, sf: str, tree: str = "o_orderdate") -> DataFrame:
    """Node tables by day, or by another column of orders and customers (``tree``)."""
    orders, customers, nations = (read_table(spark, sf, t) for t in ("orders", "customer", "nation"))
    sold = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).where(F.col(tree).isNotNull()).groupBy(F.col(tree).cast("string").alias("tree"), F.col("c_nationkey").alias("name")).agg(F.round(F.sum("o_totalprice"), 2).alias("total"))
    last = nations.agg(F.max("n_nationkey")).first()[0] or 0
    grid = sold.select("tree").distinct().select("tree", F.explode(F.sequence(F.lit(0), F.lit(last))).alias("name"))
    ranked = grid.join(sold, ["tree", "name"], "left").withColumn("total", F.coalesce("total", F.lit(0.0)))
    node = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("total"), "name")) + last
    tips = ranked.select("tree", node.cast("long").alias("node"), "name", (1 + F.col("total") / 1e6).alias("length"))
    inner = sold.select("tree").distinct().select("tree", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(last).cast("long"))).alias("node"), F.lit(None).cast("int").alias("name")).withColumn("length", 1 + F.col("node") / 100)
    nodes = tips.unionByName(inner)
    up = F.when(F.col("node") > 1, F.floor(F.col("node") / 2).cast("long"))
    support = F.when(F.col("name").isNull() & (F.col("node") % 5 > 0), (F.col("node") * 7 % 60 + 40).cast("double"))
    return checkpointed(nodes.select("tree", "node", up.alias("parent"), F.col("name").cast("string").alias("name"), "length", support.alias("support")))


def _states(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("name"), F.col("n_regionkey").cast("string").alias("state"))


def forest_nodes(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import forests

    stats = forests.node_stats(_trees(spark, sf), max_diameter=10.0)
    return stats.select("tree", "node", "level", *(F.round(c, 9).alias(c) for c in ("depth", "d1", "d2")), "n_tips", "min_support", "clade")


def forest_association(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import forests

    values = forests.signal_values(_trees(spark, sf), _states(spark, sf), replicates=0)
    return values.select("statistic", "state", F.round("x", 6).alias("x"))


def forest_signal(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import forests

    return forests.forest_signal(_trees(spark, sf), _states(spark, sf))


def forest_clades(spark: SparkSession, sf: str) -> DataFrame:
    """Clades of every day's tree; a nation's year is that of its number, its lineage its region."""
    from tidemark.operators import forests

    tips = _states(spark, sf).select("name", (1990 + F.col("name").cast("double") / 2).alias("year"), F.col("state").alias("lineage"))
    return forests.clade_rows(forests.node_stats(_trees(spark, sf), max_diameter=6.0), tips, min_size=4, replicates=100)


def forest_congruence(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import forests

    return forests.congruence(_trees(spark, sf, "c_mktsegment"))


def forest_distances(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import forests

    nodes = _trees(spark, sf, "c_mktsegment")
    splits = forests.forest_splits(nodes, forests.shared_tips(nodes))
    return forests.split_distances(checkpointed(splits), nodes.select("tree")).withColumn("distance", F.round("distance", 6))


def forest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import forests

    nodes = _trees(spark, sf)
    return forests.nearest_tips(nodes, forests.shared_tips(nodes)).select("tree", "name", F.array_join("near", ",").alias("near"))


def _with_states(spark: SparkSession, sf: str, nodes: DataFrame) -> DataFrame:
    """Inner node k has the state of the nation of rank k."""
    last = read_table(spark, sf, "nation").agg(F.max("n_nationkey")).first()[0] or 0
    states = nodes.where("name is not null").join(_states(spark, sf), "name").select("tree", "node", "state")
    inner = states.select("tree", (F.col("node") - last).alias("node"), "state").where(F.col("node") <= last)
    return nodes.join(states.unionByName(inner), ["tree", "node"], "left")


def forest_transitions(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import forests

    nodes = checkpointed(_with_states(spark, sf, _trees(spark, sf)))
    return forests.transition_table(forests.branches(nodes, checkpointed(forests.node_stats(nodes)), 2000.0), 1996.0, digits=3)


def forest_roots(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import forests

    return forests.root_states(_with_states(spark, sf, _trees(spark, sf)))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (forest_nodes, forest_association, forest_signal, forest_clades, forest_congruence, forest_distances, forest_neighbours, forest_transitions, forest_roots)}


def _nodes(tree: str) -> str:
    return f"""
WITH s AS (SELECT {tree} AS tree, c_nationkey AS name, round(sum(o_totalprice), 2) AS total FROM orders JOIN customer ON o_custkey = c_custkey WHERE {tree} IS NOT NULL GROUP BY 1, 2),
m AS (SELECT max(n_nationkey) AS m FROM nation), d AS (SELECT DISTINCT tree FROM s),
g AS (SELECT tree, unnest(range(0, m + 1)) AS name FROM d, m),
t AS (SELECT g.tree, row_number() OVER (PARTITION BY g.tree ORDER BY coalesce(total, 0) DESC, g.name) + m AS node, g.name, 1 + coalesce(total, 0) / 1e6 AS length FROM g JOIN m ON true LEFT JOIN s ON s.tree = g.tree AND s.name = g.name),
n AS (SELECT tree, node, CAST(name AS VARCHAR) AS name, length, NULL AS support FROM t
      UNION ALL SELECT tree, k, NULL, 1 + k / 100, CASE WHEN k % 5 > 0 THEN CAST(k * 7 % 60 + 40 AS DOUBLE) END FROM (SELECT tree, unnest(range(1, m + 1)) AS k FROM d, m)),
a AS (SELECT tree, node, name, length, support, node >> k AS up, k FROM (SELECT *, unnest(range(0, 12)) AS k FROM n) WHERE node >> k >= 1),
p AS (SELECT a.tree, a.node, a.up, a.name, sum(n.length) FILTER (n.node > 1) AS above FROM a JOIN n ON n.tree = a.tree AND n.node = a.up GROUP BY ALL),
z AS (SELECT tree, node, max(k) AS level, sum(l) AS depth FROM (SELECT a.tree, a.node, a.k, CASE WHEN n.node > 1 THEN n.length ELSE 0 END AS l FROM a JOIN n ON n.tree = a.tree AND n.node = a.up) GROUP BY 1, 2),
b AS (SELECT a.tree, a.up AS node, a.node AS tip, a.name, z.depth - y.depth AS dist, row_number() OVER (PARTITION BY a.tree, a.up ORDER BY z.depth DESC, a.node) AS r
      FROM a JOIN z ON z.tree = a.tree AND z.node = a.node JOIN z y ON y.tree = a.tree AND y.node = a.up WHERE a.name IS NOT NULL),
c AS (SELECT tree, node, count(*) AS n_tips, max(CASE WHEN r = 1 THEN dist END) AS d1, coalesce(max(CASE WHEN r = 2 THEN dist END), 0) AS d2 FROM b GROUP BY 1, 2)
"""


_DAY = _nodes("strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')")

_INNER = """, o AS (SELECT n.tree, n.node, CAST(n_regionkey AS VARCHAR) AS state FROM n JOIN nation ON CAST(n_nationkey AS VARCHAR) = n.name),
i AS (SELECT * FROM o UNION ALL SELECT tree, node - m, state FROM o, m WHERE node - m <= m)
"""
_TIPS = "SELECT n.tree, n.node, 1 << n_regionkey AS mask, 0 AS cost FROM n JOIN nation ON CAST(n_nationkey AS VARCHAR) = n.name WHERE CAST(floor(log2(n.node)) AS INT) = {level}"
_UP = """ UNION ALL SELECT l.tree, l.node >> 1, CASE WHEN l.mask & r.mask <> 0 THEN l.mask & r.mask ELSE l.mask | r.mask END, l.cost + r.cost + CASE WHEN l.mask & r.mask = 0 THEN 1 ELSE 0 END
    FROM f{below} l JOIN f{below} r ON r.tree = l.tree AND r.node = l.node + 1 WHERE l.node % 2 = 0"""
_FITCH = "".join(f", f{k} AS ({_TIPS.format(level=k)}{_UP.format(below=k + 1) if k < 5 else ''})" for k in range(5, -1, -1))

SQL: dict[str, str] = {
    "forest_nodes": _DAY
    + """, q AS (SELECT tree, node FROM c WHERE CASE WHEN n_tips > 1 THEN d1 + d2 ELSE 0 END <= 10),
e AS (SELECT a.tree, a.node, min(a.up) AS clade FROM a JOIN q ON q.tree = a.tree AND q.node = a.up GROUP BY 1, 2),
u AS (SELECT tree, up AS node, min(support) AS min_support FROM a GROUP BY 1, 2)
SELECT z.tree, z.node, z.level, round(z.depth, 9) AS depth, round(d1, 9) AS d1, round(d2, 9) AS d2, n_tips, min_support, clade
FROM z JOIN c USING (tree, node) JOIN u USING (tree, node) LEFT JOIN e USING (tree, node)""",
    "forest_association": _DAY
    + _FITCH
    + """, x AS (SELECT b.tree, b.node, CAST(n_regionkey AS VARCHAR) AS state, count(*) AS k FROM b JOIN nation ON CAST(n_nationkey AS VARCHAR) = b.name GROUP BY 1, 2, 3),
w AS (SELECT x.tree, x.node, max(k) AS top, sum(k) AS n FROM x GROUP BY 1, 2),
i AS (SELECT tree, sum((1 - top / n) / 2 ** (n - 1)) AS ai FROM w WHERE node < (SELECT min(node) FROM n WHERE name IS NOT NULL) GROUP BY 1),
o AS (SELECT x.tree, x.state, max(CASE WHEN x.k = w.n THEN x.k END) AS mc FROM x JOIN w USING (tree, node) GROUP BY 1, 2)
SELECT 'AI' AS statistic, NULL AS state, round(avg(ai), 6) AS x FROM i UNION ALL SELECT 'MC', state, round(avg(mc), 6) FROM o GROUP BY 2
UNION ALL SELECT 'PS', NULL, round(avg(cost), 6) FROM f0""",
    "forest_transitions": _DAY
    + _INNER
    + """, w AS (SELECT i.tree, i.node, i.state, p.state AS parent_state, z.depth, y.depth AS above, n.name IS NOT NULL AS terminal, max(z.depth) OVER (PARTITION BY i.tree) AS deepest
  FROM i JOIN i p ON p.tree = i.tree AND p.node = i.node >> 1 JOIN z ON z.tree = i.tree AND z.node = i.node JOIN z y ON y.tree = i.tree AND y.node = i.node >> 1 JOIN n ON n.tree = i.tree AND n.node = i.node),
j AS (SELECT *, round((2 * (2000 - deepest) + depth + above) / 2, 3) AS mid FROM w WHERE state <> parent_state)
SELECT parent_state, state, count(*) AS n, round(count(*) / (SELECT count(*) FROM j), 3) AS share, round(count(*) / (SELECT count(*) FROM d), 3) AS per_tree, round(quantile_cont(mid, 0.5), 3) AS median_year,
  round(quantile_cont(mid, 0.75) - quantile_cont(mid, 0.25), 3) AS iqr, round(avg(CAST(terminal AS INT)), 3) AS terminal_share, round(avg(CAST(mid < 1996 AS INT)), 3) AS deep_share FROM j GROUP BY 1, 2""",
    "forest_roots": _DAY + _INNER + "SELECT state, count(*) AS n_trees, round(count(*) / (SELECT count(*) FROM d), 6) AS share FROM i WHERE node = 1 GROUP BY 1",
    "forest_distances": _nodes("c_mktsegment")
    + """, h AS (SELECT b.tree, b.node, count(*) AS n, list_sort(list(b.name)) AS side FROM b JOIN n USING (tree, node) WHERE n.support IS NULL OR n.support >= 70 GROUP BY 1, 2),
l AS (SELECT list_sort(list(CAST(n_nationkey AS VARCHAR))) AS whole FROM nation),
k AS (SELECT DISTINCT tree, CASE WHEN 2 * n < len(whole) THEN side ELSE list_sort(list_filter(whole, lambda v: NOT list_contains(side, v))) END AS s FROM h, l WHERE n > 1 AND len(whole) - n > 1),
v AS (SELECT tree, count(*) AS n FROM k GROUP BY 1)
SELECT x.tree AS tree_a, y.tree AS tree_b, round((x.n + y.n - 2 * (SELECT count(*) FROM k i JOIN k j ON i.s = j.s WHERE i.tree = x.tree AND j.tree = y.tree)) / (x.n + y.n), 6) AS distance FROM v x JOIN v y ON x.tree < y.tree""",
}
