"""Queries of tree texts, branch changes, designs and streams, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.ranks import value_rank
from tidemark.operators import alignment, gates, mutations, newick
from tidemark.session import checkpointed
from tidemark.sources import read_table
from tidemark.streaming import daily_counts_stream, rebuild_calls
from tidemark.streaming.rebuilds import table_stream


def newick_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Every order as a tree text (return flag, line), parsed again and summed up."""
    lines = read_table(spark, sf, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("mid"), F.col("l_linenumber").alias("tip"), F.col("l_quantity").alias("length"))
    nodes = newick.tree_nodes(newick.small_tree_texts(lines, "l_orderkey"), "l_orderkey", "newick")
    tip = (F.col("n_children") == 0).cast("int")
    kids = newick.annotation_value(F.col("annotation"), "n").try_cast("long")
    return nodes.groupBy("l_orderkey").agg(F.sum(tip).alias("n_tips"), F.round(F.sum(F.when(F.col("n_children") == 0, F.col("length"))), 6).alias("total_length"), F.count("annotation").alias("n_mids"), F.sum(kids).alias("n_noted"))


def branch_mutations(spark: SparkSession, sf: str) -> DataFrame:
    """Changes by base on a balanced tree whose tips are all documents in order, over all columns."""
    docs = read_table(spark, sf, "documents").where("text is not null").select("doc_id", "text")
    n, span = docs.count(), mutations.LEVELS_A_BLOCK
    packed = mutations.packed_masks(alignment.as_bases(docs, "doc_id", "text")).withColumn("one", F.lit(1))
    tips = value_rank(packed.withColumnRenamed("node", "doc_id"), ["one"], "doc_id", "doc_id").select((F.col("rank") + (n - 1)).alias("node"), "masks")
    level = F.floor(F.log2("node") + F.lit(1e-12)).cast("int")

    def placed(rows: DataFrame) -> DataFrame:
        """With the columns of ``mutations.tree_blocks``, which follow from the number of a node."""
        half = lambda node, times: F.call_function("shiftright", node, times)
        rows = rows.withColumn("level", level).withColumn("parent", F.when(F.col("node") > 1, half(F.col("node"), F.lit(1))))
        return rows.withColumns({"top": half(F.col("node"), F.col("level") % span), "above": half(F.col("parent"), (F.col("level") - 1) % span)})

    counts = mutations.change_counts(placed(spark.range(1, max(2 * n, 1)).withColumnRenamed("id", "node")), placed(tips), span)
    return counts.groupBy("from_base", "to_base").agg(F.sum("n").alias("n"), F.count_distinct("col").alias("n_columns"))


def trait_state_design(spark: SparkSession, sf: str) -> DataFrame:
    return gates.state_designs(read_table(spark, sf, "metadata_all"), "load_id", "host_group")


def clock_prior_check(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "metadata_all").where("host_group is not null").select("host_group", "decimal_year", F.col("seq_length").cast("double").alias("seq_length"))
    return gates.prior_checks(gates.regressions(rows, "host_group", "decimal_year", "seq_length"), "host_group", 0.5)


def stream_rebuild(spark: SparkSession, sf: str) -> DataFrame:
    return rebuild_calls(daily_counts_stream(table_stream(spark, sf, "events"), "ts", "event_type"), "event_type")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (newick_roundtrip, branch_mutations, trait_state_design, clock_prior_check, stream_rebuild)}

SQL: dict[str, str] = {
    "newick_roundtrip": "SELECT l_orderkey, count(*) AS n_tips, round(sum(l_quantity), 6) AS total_length, count(DISTINCT l_returnflag) AS n_mids, count(*) AS n_noted FROM lineitem GROUP BY 1",
    "trait_state_design": """
WITH c AS (SELECT load_id, host_group, count(*) AS n FROM metadata_all WHERE host_group IS NOT NULL GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN n / sum(n) OVER (PARTITION BY load_id) < 0.05 THEN 'other' ELSE host_group END AS s FROM c),
f AS (SELECT load_id, s, CAST(sum(n) AS BIGINT) AS n, count(*) AS k FROM s GROUP BY 1, 2)
SELECT load_id, count(*) AS n_states, CAST(coalesce(sum(k) FILTER (s = 'other'), 0) AS BIGINT) AS n_other, CAST(count(*) * (count(*) - 1) / 2 AS BIGINT) AS n_rates, min(n) AS smallest FROM f GROUP BY 1""",
    "clock_prior_check": """
WITH g AS (SELECT host_group, count(*) AS n, regr_slope(seq_length, decimal_year) AS s FROM metadata_all WHERE host_group IS NOT NULL AND decimal_year IS NOT NULL AND seq_length IS NOT NULL GROUP BY 1),
f AS (SELECT host_group, CASE WHEN n >= 3 AND s IS NOT NULL THEN s ELSE 0 END AS s FROM g), r AS (SELECT *, CASE WHEN s > 0 THEN 0.5 / s END AS r FROM f)
SELECT host_group, round(s, 6) AS slope, round(r, 4) AS ratio, CASE WHEN r IS NULL OR r > 10 OR r < 0.1 THEN 'error' WHEN r > 3 OR r < 1.0 / 3 THEN 'warn' ELSE 'ok' END AS level FROM r""",
    "stream_rebuild": """
WITH d AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE ts IS NOT NULL GROUP BY 1, 2),
l AS (SELECT *, n - lag(n) OVER (PARTITION BY event_type ORDER BY day) AS change FROM d)
SELECT event_type, day, n, change, CASE WHEN change IS NULL THEN 'first' WHEN change < 0 THEN 'shrunk' WHEN change < 2 THEN 'few' ELSE 'rebuild' END AS call FROM l""",
}
