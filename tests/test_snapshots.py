import datetime as dt
import random

from tidemark.operators.snapshots import snapshot_changes, snapshot_decisions

SCHEMA = "snap_row_id long, pathogen string, build_date string, accession string, host_group string, country string, collection_date string, lat_lon string, seq_length int, loaded_at timestamp, key string, grp string, leaf long"


def make(spark, rows):
    full = [(i, p, b, a, h, "X", None, "", 5, dt.datetime(2025, 1, 1) + dt.timedelta(seconds=t), "k", "g", 1) for i, (p, b, a, h, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def changes(spark, rows):
    return {(r.pathogen, r.build_date, r.accession, r.change_kind) for r in snapshot_changes(make(spark, rows)).collect()}


def test_kinds_spelling_and_late_rows(spark):
    rows = [
        ("p", "1", "A.1", "dog", 0), ("p", "1", "B.1", "dog", 0), ("p", "1", "C.1", None, 0),
        ("p", "2", " a.1 ", "DOG ", 1), ("p", "2", "C.2", "", 1), ("p", "2", "D", "cat", 1), ("p", "2", "D", "dog", 0),
        ("p", "3", "A.1", "dog", 9), ("p", "3", "B.1", "dog", 9), ("p", "3", "C.2", " ", 9), ("p", "3", "D", "cat", 9), ("p", "3", "D", "cat", 9),
        ("p", "3", None, "dog", 9), ("p", "3", " ", "dog", 9), (None, "3", "Z", "dog", 9),
    ]
    assert changes(spark, rows) == {("p", "2", "B", "removed"), ("p", "2", "C", "changed"), ("p", "2", "D", "added"), ("p", "3", "B", "added")}


def test_empty_and_single_snapshot(spark):
    assert changes(spark, []) == set()
    assert changes(spark, [("p", "1", "A.1", "dog", 0)]) == set()


def test_random_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(p, b, f"K{rng.randrange(120)}.{rng.randrange(1, 3)}", rng.choice(["a", "b", None]), rng.randrange(50)) for p in "pq" for b in "123" for _ in range(150)]
    latest = {}
    for i, (p, b, a, h, t) in enumerate(rows):
        key, version = a.split(".")
        if (t, i) >= latest.get((p, b), {}).get(key, ((-1, -1),))[0]:
            latest.setdefault((p, b), {})[key] = ((t, i), version, h)
    wanted = set()
    for p in "pq":
        for b, c in (("1", "2"), ("2", "3")):
            old, new = latest[p, b], latest[p, c]
            wanted |= {(p, c, k, "added") for k in new.keys() - old.keys()} | {(p, c, k, "removed") for k in old.keys() - new.keys()}
            wanted |= {(p, c, k, "changed") for k in new.keys() & old.keys() if new[k][1:] != old[k][1:]}
    assert changes(spark, rows) == wanted


def test_decisions(spark):
    rows = [("p", "1", "A", "x", 0), ("p", "2", "B", "x", 0), ("p", "3", "B", "y", 0), ("p", "4", "B", "y", 0), ("p", "4", "C", "y", 0)]
    got = {(r.build_date, r.verdict, r.delta) for r in snapshot_decisions(snapshot_changes(make(spark, rows))).collect()}
    assert got == {("2", "regression", 0), ("3", "review", 0), ("4", "ok", 1)}
