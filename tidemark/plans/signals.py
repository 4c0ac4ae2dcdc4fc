"""Queries of temporal signals, chains, histories and samples, and their SQL.

The chain module needs numpy and pandas; only the queries that use it import it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import drift, gates, history
from tidemark.sources import read_table


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice", gates.decimal_year(F.col("o_orderdate")).alias("year"))


def temporal_signal(spark: SparkSession, sf: str) -> DataFrame:
    """Check of the operator against its SQL, which has 19 permutations; the verdicts to use are those of temporal_verdict."""
    return gates.temporal_signal(_orders(spark, sf), "o_orderpriority", "o_orderkey", "year", "o_totalprice", replicates=19)


def temporal_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return gates.temporal_signal(_orders(spark, sf), "o_orderpriority", "o_orderkey", "year", "o_totalprice", drawn=True)


def temporal_by_group(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "metadata_all").where("host_group is not null").select("host_group", "row_id", "decimal_year", F.col("seq_length").cast("double").alias("seq_length"))
    out = gates.regressions(rows, "host_group", "decimal_year", "seq_length").join(gates.sampling_diagnostics(rows, "host_group", "decimal_year"), "host_group")
    return out.select("host_group", "n", *(F.round(c, 6).alias(c) for c in ("slope", "r_squared", "span", "occupancy", "densest")))


def rayleigh_season(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "orders").select("o_orderpriority", (gates.decimal_year(F.col("o_orderdate")) - F.year("o_orderdate")).alias("phase"))
    return gates.rayleigh(rows, "o_orderpriority", "phase")


def date_policy(spark: SparkSession, sf: str) -> DataFrame:
    return gates.date_policies(read_table(spark, sf, "metadata_all"), "host_group", substitutions=1.4)


def burnin_thin(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import chains

    kept = chains.after_burnin(read_table(spark, sf, "events"), "event_type", "event_id", 0.1, 3)
    return kept.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_id"), F.max("event_id").alias("last_id"), F.max("idx").alias("last_idx"))


def chain_hpd(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import chains

    return chains.shortest_intervals(read_table(spark, sf, "events"), "event_type", "value", "event_id")


def chain_overlap(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import chains

    return chains.overlaps(read_table(spark, sf, "events"), "event_type", "value")


def chain_ess(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import chains

    return chains.effective_sizes(read_table(spark, sf, "events"), "event_type", "event_id", "value")


def convergence_gate(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import chains

    return chains.convergence(chain_ess(spark, sf), chain_overlap(spark, sf))


def drt_gate(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import chains

    means = read_table(spark, sf, "events").groupBy("event_type").agg(F.avg("value").alias("mean"))
    return chains.randomisation_verdict(chain_hpd(spark, sf), means, "event_type", "click")


def drt_verdict(spark: SparkSession, sf: str) -> DataFrame:
    from tidemark.operators import chains

    means = read_table(spark, sf, "events").groupBy("event_type").agg(F.avg("value").alias("mean"))
    return chains.randomisation_checked(chain_hpd(spark, sf), means, chain_ess(spark, sf), "event_type", "click")


def _intervals(spark: SparkSession, sf: str) -> DataFrame:
    days = F.unix_date(F.to_date("l_shipdate"))
    lines = read_table(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.min(days).alias("lo"), F.max(days).alias("hi"))
    return lines.withColumnsRenamed({"l_orderkey": "unit", "l_returnflag": "state"})


def state_through_time(spark: SparkSession, sf: str) -> DataFrame:
    return history.states_through_time(_intervals(spark, sf), "unit", "lo", "hi", "state", 30.0)


def enrichment_thirds(spark: SparkSession, sf: str) -> DataFrame:
    return history.enrichment_thirds(history.states_through_time(_intervals(spark, sf), "unit", "lo", "hi", "state", 30.0, 3.0), "state")


def stratified_sample(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_table(spark, sf, "metadata_all").withColumn("bin", F.coalesce((F.floor(F.col("decimal_year") / 10) * 10).cast("int"), F.lit(-1)))
    return history.stratified_sample(rows.select("clade", "host_group", "bin", "row_id", "date_uncertainty_years", "seq_length"), ["clade", "host_group", "bin"], "row_id", [F.col("date_uncertainty_years"), F.desc("seq_length")], 500)


def verdict_changes(spark: SparkSession, sf: str) -> DataFrame:
    return gates.verdict_changes(drift.clade_table(read_table(spark, sf, "builds")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        temporal_signal, temporal_verdict, temporal_by_group, rayleigh_season, date_policy, burnin_thin, chain_hpd, chain_overlap, chain_ess, convergence_gate, drt_gate, drt_verdict,
        state_through_time, enrichment_thirds, stratified_sample, verdict_changes,
    )
}

_YEAR = "(year(o_orderdate) + (dayofyear(o_orderdate) - 1) / dayofyear(make_date(year(o_orderdate), 12, 31)))"


def _signal(source: str, group: str, x: str, y: str) -> str:
    return f"""
WITH o AS ({source}),
g AS (SELECT {group}, count(*) AS n, regr_slope({y}, {x}) AS s, corr({x}, {y}) AS r FROM o WHERE {x} IS NOT NULL AND {y} IS NOT NULL GROUP BY 1),
f AS (SELECT *, n >= 3 AND s IS NOT NULL AND r IS NOT NULL AND NOT isnan(r) AS ok FROM g),
y AS (SELECT {group}, CAST(floor({x}) AS INT) AS yr, count(*) AS c, min({x}) AS lo, max({x}) AS hi FROM o WHERE {x} IS NOT NULL GROUP BY 1, 2),
w AS (SELECT *, sum(c) OVER (PARTITION BY {group} ORDER BY yr RANGE BETWEEN CURRENT ROW AND 9 FOLLOWING) AS w FROM y),
d AS (SELECT {group}, max(hi) - min(lo) AS span, count(*) / (max(yr) - min(yr) + 1) AS occupancy, max(w) / sum(c) AS densest FROM w GROUP BY 1)
"""


_HPD = """
WITH r AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS rank, count(*) OVER (PARTITION BY event_type) AS n FROM events WHERE value IS NOT NULL),
k AS (SELECT *, CAST(least(greatest(1, floor(n * 0.95)), greatest(n - 1, 0)) AS BIGINT) AS k FROM r),
p AS (SELECT a.event_type, a.n, a.rank, a.value AS lo, b.value AS hi FROM k a JOIN k b ON b.event_type = a.event_type AND b.rank = a.rank + a.k),
h AS (SELECT event_type, n, lo, hi FROM p QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY round(hi - lo, 9), rank) = 1)
"""
_STT = """
WITH i AS (SELECT l_orderkey AS unit, l_returnflag AS state, min(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS lo, max(datediff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS hi FROM lineitem GROUP BY 1, 2),
g AS (SELECT state, unnest(range(CAST(ceil(lo / 30) AS BIGINT), CAST(floor(hi / 30) AS BIGINT) + 1)) AS s FROM i),
c AS (SELECT s, state, count(*) AS n FROM g GROUP BY 1, 2),
h AS (SELECT state, count(*) / (SELECT count(*) FROM i) AS share FROM i GROUP BY 1),
t AS (SELECT s * 30.0::DOUBLE AS slice, c.state, round(n / (SELECT count(DISTINCT unit) FROM i), 6) AS mean, n / sum(n) OVER (PARTITION BY s) AS p, share, n, CAST(sum(n) OVER (PARTITION BY s) AS BIGINT) AS total FROM c JOIN h ON h.state = c.state),
x AS (SELECT slice, state, mean, round(p, 6) AS proportion, round(p / share, 6) AS enrichment, n, total FROM t)
"""
SQL: dict[str, str] = {
    "temporal_signal": _signal(f"SELECT *, {_YEAR} AS x FROM orders WHERE o_totalprice IS NOT NULL AND o_orderdate IS NOT NULL", "o_orderpriority", "x", "o_totalprice")
    + """, e AS (SELECT o.*, unnest(range(1, 20)) AS rep FROM o),
a AS (SELECT o_orderpriority, rep, x, row_number() OVER (PARTITION BY o_orderpriority, rep ORDER BY md5('x|' || rep || '|' || o_orderkey)) AS r FROM e),
b AS (SELECT o_orderpriority, rep, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority, rep ORDER BY md5('y|' || rep || '|' || o_orderkey)) AS r FROM e),
q AS (SELECT a.o_orderpriority, a.rep, regr_slope(o_totalprice, x) AS s FROM a JOIN b ON b.o_orderpriority = a.o_orderpriority AND b.rep = a.rep AND b.r = a.r GROUP BY 1, 2),
p AS (SELECT q.o_orderpriority, (count(*) FILTER (round(q.s, 9) >= round(f.s, 9)) + 1) / (count(*) + 1) AS p FROM q JOIN f ON f.o_orderpriority = q.o_orderpriority GROUP BY 1),
z AS (SELECT f.o_orderpriority, n, CASE WHEN ok THEN s ELSE 0 END AS slope, CASE WHEN ok THEN r * r ELSE 0 END AS r_squared, span, occupancy, densest, p FROM f JOIN d USING (o_orderpriority) JOIN p USING (o_orderpriority))
SELECT o_orderpriority, n, round(slope, 6) AS slope, round(r_squared, 6) AS r_squared, round(span, 6) AS span, round(occupancy, 6) AS occupancy, round(densest, 6) AS densest, round(p, 6) AS p,
  CASE WHEN slope <= 0 OR p > 0.05 OR span < 5 THEN 'fail' WHEN r_squared < 0.1 OR densest > 0.75 THEN 'weak' ELSE 'pass' END AS verdict FROM z""",
    "temporal_by_group": _signal("SELECT host_group, decimal_year, seq_length FROM metadata_all WHERE host_group IS NOT NULL", "host_group", "decimal_year", "seq_length")
    + "SELECT host_group, n, round(CASE WHEN ok THEN s ELSE 0 END, 6) AS slope, round(CASE WHEN ok THEN r * r ELSE 0 END, 6) AS r_squared, round(span, 6) AS span, round(occupancy, 6) AS occupancy, round(densest, 6) AS densest FROM f JOIN d USING (host_group)",
    "rayleigh_season": f"""
WITH a AS (SELECT o_orderpriority, count(*) AS n, avg(cos(2 * pi() * ({_YEAR} - year(o_orderdate)))) AS c, avg(sin(2 * pi() * ({_YEAR} - year(o_orderdate)))) AS s FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1),
b AS (SELECT *, sqrt(c * c + s * s) AS r, n * (c * c + s * s) AS z FROM a)
SELECT o_orderpriority, n, round(CASE WHEN n < 8 THEN 0 ELSE r END, 6) AS r, round(CASE WHEN n < 8 THEN 0 ELSE z END, 6) AS z,
  round(CASE WHEN n < 8 THEN 1 ELSE greatest(0, least(1, exp(-z) * (1 + (2 * z - z ** 2) / (4 * n)))) END, 6) AS p FROM b""",
    "date_policy": """
WITH a AS (SELECT host_group, decimal_year - floor(decimal_year) AS w, coalesce(date_precision IN ('day', 'month'), false) AS fine,
                  CASE date_precision WHEN 'day' THEN 0.5 / 365.25 WHEN 'month' THEN 0.5 / 12 ELSE 0.5 END AS half FROM metadata_all WHERE decimal_year IS NOT NULL),
b AS (SELECT host_group, count(*) AS n, count(*) FILTER (NOT fine) AS ni, count(*) FILTER (fine) AS np, avg(CAST(half AS DOUBLE)) AS half,
             avg(cos(2 * pi() * w)) FILTER (fine) AS c, avg(sin(2 * pi() * w)) FILTER (fine) AS s, avg(w) FILTER (fine) AS m FROM a GROUP BY 1),
c AS (SELECT *, ni / n AS share, CASE WHEN np >= 8 THEN sqrt(c * c + s * s) END AS r, CASE WHEN np >= 8 THEN m - 0.5 END AS shift FROM b),
d AS (SELECT *, CASE WHEN np >= 8 THEN greatest(0, least(1, exp(-np * r * r) * (1 + (2 * np * r * r - (np * r * r) ** 2) / (4 * np)))) END AS p FROM c),
e AS (SELECT *, coalesce(p < 0.05 AND abs(shift) > 0.08, false) AS seasonal FROM d)
SELECT host_group, n, ni AS n_imprecise, round(share, 6) AS imprecise_share, round(half, 6) AS mean_half_width, np AS n_precise, round(r, 6) AS r, round(p, 6) AS p, round(shift, 6) AS shift, seasonal,
  CASE WHEN ni = 0 OR (share < 0.1 AND NOT seasonal) THEN 'midpoint' ELSE 'interval' END AS policy,
  CASE WHEN ni = 0 OR share < 0.1 OR seasonal OR share >= 0.5 THEN 'strong' ELSE 'moderate' END AS confidence FROM e""",
    "burnin_thin": """
WITH r AS (SELECT event_type, event_id, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 - round_even(count(*) OVER (PARTITION BY event_type) * 0.1, 0) AS i FROM events)
SELECT event_type, count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id, CAST(max(i) / 3 AS BIGINT) AS last_idx FROM r WHERE i >= 0 AND i % 3 = 0 GROUP BY 1""",
    "chain_hpd": _HPD + "SELECT * FROM h",
    "chain_overlap": """
WITH r AS (SELECT event_type AS e, min(value) AS lo, max(value) AS hi, count(*) AS n FROM events WHERE value IS NOT NULL GROUP BY 1),
p AS (SELECT a.e AS a, b.e AS b, least(a.lo, b.lo) AS lo, greatest(a.hi, b.hi) AS hi, a.n AS na, b.n AS nb FROM r a JOIN r b ON a.e < b.e),
v AS (SELECT a, b, least(floor((value - lo) / ((hi - lo) / 100)), 99) AS bin, sum(CASE WHEN event_type = a THEN 1 ELSE 0 END) / any_value(na) AS pa, sum(CASE WHEN event_type = b THEN 1 ELSE 0 END) / any_value(nb) AS pb FROM events JOIN p ON event_type = a OR event_type = b WHERE value IS NOT NULL GROUP BY 1, 2, 3)
SELECT a AS chain_a, b AS chain_b, round(sum(least(pa, pb)), 6) AS overlap FROM v GROUP BY 1, 2""",
    "drt_gate": _HPD
    + """, m AS (SELECT event_type, avg(value) AS mean FROM events GROUP BY 1), j AS (SELECT h.*, mean FROM h JOIN m USING (event_type)), o AS (SELECT * FROM j WHERE event_type = 'click'),
z AS (SELECT count(*) AS n_replicates, count(*) FILTER (j.lo <= o.hi AND o.lo <= j.hi) AS n_overlapping, any_value(o.mean) AS rm, min(j.lo) AS elo, max(j.hi) AS ehi, stddev_pop(j.mean) AS spread FROM j, o WHERE j.event_type <> 'click')
SELECT n_replicates, n_overlapping, round(rm, 6) AS real_mean, round(elo, 6) AS envelope_lo, round(ehi, 6) AS envelope_hi, round(spread, 6) AS spread, CASE WHEN n_overlapping = 0 THEN 'pass' WHEN rm < elo OR rm > ehi THEN 'weak' ELSE 'fail' END AS verdict FROM z""",
    "state_through_time": _STT + "SELECT * FROM x",
    "enrichment_thirds": _STT
    + """, v AS (SELECT * FROM x WHERE total >= 3), q AS (SELECT slice, row_number() OVER (ORDER BY slice) AS i, count(*) OVER () AS n FROM (SELECT DISTINCT slice FROM v)),
l AS (SELECT slice, CASE WHEN i <= greatest(1, n // 3) THEN 'early' WHEN i > n - greatest(1, n // 3) THEN 'late' ELSE 'middle' END AS third FROM q),
e AS (SELECT state, third, sum(enrichment * total) / sum(total) AS e, count(*) AS n_slices FROM v JOIN l USING (slice) GROUP BY 1, 2)
SELECT state, third, round(e, 4) AS enrichment, n_slices, CASE WHEN e >= 1.5 THEN 'strong' WHEN e >= 1.25 THEN 'enriched' ELSE 'none' END AS reading FROM e""",
    "stratified_sample": """
WITH m AS (SELECT clade, host_group, coalesce(CAST(floor(decimal_year / 10) * 10 AS INT), -1) AS bin, row_id, date_uncertainty_years AS u, seq_length FROM metadata_all),
s AS (SELECT clade, host_group, bin, count(*) AS n, concat_ws('|', coalesce(clade, ''), coalesce(host_group, ''), CAST(bin AS VARCHAR)) AS name FROM m GROUP BY 1, 2, 3),
a AS (SELECT *, count(*) OVER () AS k, row_number() OVER (ORDER BY n DESC, name) AS place, sqrt(n - 1) AS w, sum(sqrt(n - 1)) OVER () AS tw FROM s),
b AS (SELECT *, 1 + least(n - 1, coalesce(floor(round(greatest(500 - k, 0) * w / nullif(tw, 0), 6)), 0)) AS base FROM a),
c AS (SELECT *, n - base AS room, 500 - sum(base) OVER () AS rest, sum(n - base) OVER (ORDER BY n DESC, name) AS upto FROM b),
q AS (SELECT *, CASE WHEN k >= 500 THEN CASE WHEN place <= 500 THEN 1 ELSE 0 END ELSE base + greatest(0, least(room, rest - (upto - room))) END AS quota FROM c),
r AS (SELECT *, row_number() OVER (PARTITION BY clade, host_group, bin ORDER BY u NULLS FIRST, seq_length DESC NULLS LAST, row_id) AS r FROM m)
SELECT r.clade, r.host_group, r.bin, r.row_id, q.n AS n_stratum FROM r JOIN q ON q.clade IS NOT DISTINCT FROM r.clade AND q.host_group IS NOT DISTINCT FROM r.host_group AND q.bin = r.bin WHERE r.r <= q.quota""",
}
