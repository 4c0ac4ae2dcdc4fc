import random

from tidemark.functions.ranks import permuted_rank, shared_out, value_rank
from tidemark.operators.hotkeys import eager_join_sums, key_medians


def test_medians_with_a_hot_key_and_ties(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a"] * 5 + ["b", None]), "x", rng.choice([2018.5, 2018.5, 1999.25, -3.5, None]), i * 70_000 + 5, 1) for i in range(3000)]
    df = spark.createDataFrame(rows, "g string, c string, v double, id long, n_rows int")
    got = {(r.g, r.c): (r.id, r.n_rows) for r in key_medians(df, ["g", "c"], "v", "id").collect()}
    for g in "ab":
        own = sorted((v, i) for k, _, v, i, _ in rows if k == g and v is not None)
        assert got[g, "x"] == (own[(len(own) + 1) // 2 - 1][1], len(own))
    assert set(got) == {("a", "x"), ("b", "x")}
    assert key_medians(df.where("false"), ["g", "c"], "v", "id").count() == 0


def test_eager_join_equals_join(spark):
    rng = random.Random(2)
    left = spark.createDataFrame([(rng.choice([1, 1, 1, 2, None]), rng.choice(["p", None]), rng.choice([5, None])) for _ in range(200)], "k int, g string, x int")
    right = spark.createDataFrame([(rng.choice([1, 1, 2, 3, None]), rng.choice([7, None])) for _ in range(100)], "k int, y int")
    got = {tuple(r) for r in eager_join_sums(left, right, ["k"], ["g"], ["x"], ["y"]).collect()}
    plain = left.join(right, "k").groupBy("g").agg({"*": "count"}).collect()
    assert {(r[0], r[1]) for r in got} == {(r[0], r[1]) for r in plain}
    sums = left.join(right, "k").groupBy("g").sum("x", "y").collect()
    assert {(r[0], r[2], r[3]) for r in got} == {tuple(r) for r in sums}


def test_ranks_are_permutations(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 as g", "cast(id % 10 as double) as v")
    for r in (permuted_rank(df, ["g"], ["id"], 4), value_rank(df, ["g"], "v", "id")):
        rows = r.collect()
        for g in range(3):
            own = sorted((x["rank"], x.v, x.id) for x in rows if x.g == g)
            assert [x[0] for x in own] == list(range(1, len(own) + 1))
    assert [(x.v, x.id) for x in sorted(rows, key=lambda x: (x.g, x["rank"]))] == [(x.v, x.id) for x in sorted(rows, key=lambda x: (x.g, x.v, x.id))]


def test_shares_never_exceed_and_add_up(spark):
    rng = random.Random(5)
    rows = [(g, i, rng.randrange(0, 40), quota, rng.random()) for g, quota in enumerate([0, 7, 60, 100, 10_000]) for i in range(9)]
    df = spark.createDataFrame(rows, "g int, i int, cap long, quota long, w double")
    for weight in (None, "w"):
        out = shared_out(df, ["g"], "quota", "cap", ["i"], "share", weight).collect()
        for g in range(5):
            own = [r for r in out if r.g == g]
            assert all(0 <= r.share <= r.cap for r in own)
            assert sum(r.share for r in own) == min(own[0].quota, sum(r.cap for r in own))
