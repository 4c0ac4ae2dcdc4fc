"""Per-key results where a few keys hold most rows.

Rows are pre-aggregated by key before any join or shuffle by key alone, so a key
that holds a third of the table reaches a task as compact states, not as rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import checkpointed, if_small


def eager_join_sums(left: DataFrame, right: DataFrame, on: list[str], group: list[str], left_sums: list[str] = (), right_sums: list[str] = ()) -> DataFrame:
    """Counts and sums of an inner join by ``group`` (columns of ``left``), without joining rows.

    Both inputs are aggregated by the join key (and the group) first; joined
    states multiply: pairs = n_left * n_right, a sum of one side is scaled by the
    count of the other. Columns: group, n_pairs, sum_<column>. Null join keys
    match nothing; null groups are groups; null summands are skipped.
    """
    lefts = left.groupBy(*on, *group).agg(F.count(F.lit(1)).alias("_nl"), *(F.sum(c).alias(f"_l_{c}") for c in left_sums))
    rights = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_nr"), *(F.sum(c).alias(f"_r_{c}") for c in right_sums))
    joined = lefts.join(rights, on)
    return joined.groupBy(*group).agg(
        F.sum(F.col("_nl") * F.col("_nr")).alias("n_pairs"),
        *(F.sum(F.col(f"_l_{c}") * F.col("_nr")).alias(f"sum_{c}") for c in left_sums),
        *(F.sum(F.col(f"_r_{c}") * F.col("_nl")).alias(f"sum_{c}") for c in right_sums),
    )


def _fetched(rows: DataFrame, chosen: DataFrame, on: list[str]) -> DataFrame:
    """Rows of the one state that is chosen for each key."""
    return rows.join(if_small(chosen.select(*on)), on, "left_semi")


def _states(rows: DataFrame, key: list[str], state: str) -> DataFrame:
    """Rows pre-aggregated: their count by key and state."""
    return rows.groupBy(*key, state).agg(F.count(F.lit(1)).alias("_n"))


def _chosen(states: DataFrame, key: list[str], state: str, places: DataFrame) -> DataFrame:
    """key, ``state``, rest: the state that holds place ``rest`` of its key, and the place inside it.

    Both inputs are compact: counts by key and state, and one place by key.
    Running sums of the counts of a key say where each state begins.
    """
    upto = F.sum("_n").over(Window.partitionBy(*key).orderBy(state))
    held = states.join(if_small(places), key).withColumn("_before", upto - F.col("_n")).where("_before < rest and rest <= _before + _n")
    return checkpointed(held.select(*key, state, (F.col("rest") - F.col("_before")).alias("rest")))


def key_medians(df: DataFrame, key: list[str], value: str, row_id: str) -> DataFrame:
    """The lower median row of every key: key, row_id, value and ``n_rows``.

    It is the row at place ceil(n / 2) by value, then row_id. Rows with a null in
    the key or value don't count; repeated row ids give one row. Eager
    aggregation through joins: rows are counted by key and whole number of the
    value; these states roll up to the totals by key, and states and totals are
    joined. The state that holds the place is taken apart by value, then by block
    of row ids, then by row id; only rows of a chosen state are read again, and
    no key is ever gathered.
    """
    rows = df.select(*key, F.col(value).alias("_value"), F.col(row_id).cast("long").alias("_id")).where(" and ".join(f"{c} is not null" for c in [*key, "_value", "_id"]))
    rows = rows.withColumn("_whole", F.floor("_value"))
    states = checkpointed(_states(rows, key, "_whole"))
    totals = checkpointed(states.groupBy(*key).agg(F.sum("_n").alias("n_rows")))
    chosen = _chosen(states, key, "_whole", totals.select(*key, F.ceil(F.col("n_rows") / 2).alias("rest")))
    near = checkpointed(_fetched(rows, chosen, [*key, "_whole"]).select(*key, "_value", "_id"))
    values = chosen = _chosen(_states(near, key, "_value"), key, "_value", chosen.select(*key, "rest"))
    near = _fetched(near, chosen, [*key, "_value"])
    near = near.withColumn("_block", F.shiftright("_id", 20))
    chosen = _chosen(_states(near, key, "_block"), key, "_block", chosen.select(*key, "rest"))
    near = _fetched(near, chosen, [*key, "_block"])
    ids = _chosen(_states(near, key, "_id"), key, "_id", chosen.select(*key, "rest"))
    found = ids.join(if_small(values.drop("rest")), key).join(if_small(totals), key)
    return found.select(*key, F.col("_id").alias(row_id), F.col("_value").alias(value), "n_rows")
