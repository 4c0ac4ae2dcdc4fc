import itertools
import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import forests

STATES = {f"t{k}": "abc"[k % 3] for k in range(9)} | {"t9": None}


def random_tree(rng, tips):
    """node -> (parent, length, name), with nodes of several children."""
    tree, open_nodes, n = {}, [], 0
    for t in tips:
        tree[n] = [None, rng.randrange(1, 9) / 4, t]
        open_nodes.append(n)
        n += 1
    while len(open_nodes) > 1:
        kids = rng.sample(open_nodes, min(len(open_nodes), rng.choice([2, 2, 3])))
        tree[n] = [None, rng.randrange(0, 9) / 4, None]
        for k in kids:
            tree[k][0] = n
            open_nodes.remove(k)
        open_nodes.append(n)
        n += 1
    return tree


@pytest.fixture(scope="module")
def trees(spark):
    rng = random.Random(3)
    made = {f"tree{i}": random_tree(rng, [f"t{k}" for k in rng.sample(range(10), 10)]) for i in range(6)}
    made["twin"] = made["tree0"]
    support = {(t, n): rng.choice([None, 50.0, 90.0]) for t in made for n in made[t]}
    support |= {("twin", n): support["tree0", n] for n in made["tree0"]}
    rows = [(t, n, p, name, length, support[t, n]) for t, tree in made.items() for n, (p, length, name) in tree.items()]
    rng.shuffle(rows)
    return made, support, spark.createDataFrame(rows, "tree string, node long, parent long, name string, length double, support double")


def path(tree, n):
    while n is not None:
        yield n
        n = tree[n][0]


def below(tree, n):
    return [k for k, (_, _, name) in tree.items() if name is not None and n in path(tree, k)]


def distance(tree, a, b):
    shared = set(path(tree, a)) & set(path(tree, b))
    return sum(tree[x][1] for end in (a, b) for x in path(tree, end) if x not in shared)


def test_node_stats(trees):
    made, support, nodes = trees
    rows = forests.node_stats(nodes, max_diameter=6.0).collect()
    assert len(rows) == sum(map(len, made.values()))
    for r in rows:
        tree = made[r.tree]
        far = sorted((sum(tree[x][1] for x in path(tree, k)) - sum(tree[x][1] for x in path(tree, r.node)) for k in below(tree, r.node)), reverse=True)
        assert (r.level, r.n_tips) == (len(list(path(tree, r.node))) - 1, len(far))
        assert (r.d1, r.d2) == pytest.approx((far[0], far[1] if len(far) > 1 else 0.0))
        inner = [support[r.tree, n] for n in tree if tree[n][2] is None and r.node in path(tree, n) and support[r.tree, n] is not None]
        assert r.min_support == (min(inner) if inner else None)
    bound = {(r.tree, r.node): r.d1 + r.d2 if r.n_tips > 1 else 0.0 for r in rows}
    for r in rows:
        fit = [n for n in path(made[r.tree], r.node) if bound[r.tree, n] <= 6.0]
        assert r.clade == (fit[-1] if fit else None)


def test_nearest_and_splits(trees):
    made, support, nodes = trees
    taxa = forests.shared_tips(nodes)
    assert {r.name for r in taxa.collect()} == set(STATES)
    for r in forests.nearest_tips(nodes, taxa, 3).collect():
        tree = made[r.tree]
        at = {name: n for n, (_, _, name) in tree.items() if name}
        want = sorted((distance(tree, at[r.name], n), name) for name, n in at.items() if name != r.name)[:3]
        assert r.near == [x for _, x in want], (r.tree, r.name)
    sides = {}
    for t, tree in made.items():
        inner = [n for n in tree if tree[n][2] is None and not (support[t, n] or 100) < 70]
        names = [frozenset(tree[k][2] for k in below(tree, n)) for n in inner]
        sides[t] = {min(s, frozenset(STATES) - s, key=lambda x: (len(x), sorted(x))) for s in names if 2 <= len(s) <= 8}
    got = {(r.tree_a, r.tree_b): r.distance for r in forests.split_distances(forests.forest_splits(nodes, taxa), nodes).collect()}
    for a, b in itertools.combinations(sorted(made), 2):
        whole = len(sides[a]) + len(sides[b])
        assert got[a, b] == pytest.approx(len(sides[a] ^ sides[b]) / whole if whole else 0.0)
    assert got["tree0", "twin"] == 0.0


def test_congruence(trees):
    _, _, nodes = trees
    twins = forests.congruence(nodes.where("tree in ('tree0', 'twin')")).first()
    assert (twins.verdict, twins.concatenate, twins.n_shared, twins.n_reassortants) == ("congruent", True, 10, 0)
    assert forests.congruence(nodes).first().verdict == "decoupled"
    assert forests.congruence(nodes.where("tree = 'twin'")).first().verdict == "congruent"
    few = nodes.where("name is null or name in ('t0', 't1', 't2')")
    assert forests.congruence(few).first().verdict == "unknown"


def test_signal_values(spark, trees):
    made, _, nodes = trees
    states = spark.createDataFrame(list(STATES.items()), "name string, state string")
    got = {(r.statistic, r.state): r.x for r in forests.signal_values(nodes, states, replicates=3).where("rep = 0").collect()}
    ai, ps, mc = [], [], {s: [] for s in "abc"}
    for tree in made.values():
        kids = {n: [k for k in tree if tree[k][0] == n] for n in tree}
        total, score, masks = 0.0, 0, {}
        for n in tree:  # children come before their parents here
            known = [STATES[tree[k][2]] for k in below(tree, n) if STATES[tree[k][2]]]
            if kids[n]:
                if known:
                    total += (1 - max(map(known.count, known)) / len(known)) / 2 ** (len(known) - 1)
                ordered = kids[n]
                masks[n] = masks[ordered[0]]
                for k in ordered[1:]:
                    both = masks[n] & masks[k]
                    score += not both
                    masks[n] = both or masks[n] | masks[k]
            else:
                masks[n] = set(known) or set("abc")
        ai.append(total)
        ps.append(score)
        for s in mc:
            pure = [[STATES[tree[k][2]] for k in below(tree, n) if STATES[tree[k][2]]] for n in tree]
            mc[s].append(max(len(p) for p in pure if set(p) == {s}))
    mean = lambda x: sum(x) / len(x)
    assert got["AI", None] == pytest.approx(mean(ai))
    assert abs(got["PS", None] - mean(ps)) < 0.5  # the order of many children is not stated
    assert {s: got["MC", s] for s in mc} == pytest.approx({s: mean(v) for s, v in mc.items()})


def test_signal_verdicts(spark):
    sides = "ab" * 16
    rows = [(t, n, n // 2 or None, f"t{n}" if n >= 32 else None, 1.0, None) for t in (1, 2) for n in range(1, 64)]
    nodes = spark.createDataFrame(rows, "tree int, node long, parent long, name string, length double, support double")
    split = spark.createDataFrame([(f"t{n}", "x" if n < 48 else "y") for n in range(32, 64)], "name string, state string")
    mixed = spark.createDataFrame([(f"t{n}", sides[n - 32]) for n in range(32, 64)], "name string, state string")
    assert {r.verdict for r in forests.forest_signal(nodes, split, 200).collect()} == {"pass"}
    assert {r.verdict for r in forests.forest_signal(nodes, mixed, 200).collect()} == {"fail"}


def test_clade_rows(spark):
    rows = [("a", n, n // 2 or None, f"t{n}" if n >= 16 else None, 0.1 * (n - 15) if n >= 16 else 1.0, 80.0 if n == 2 else None) for n in range(1, 32)]
    nodes = spark.createDataFrame(rows, "tree string, node long, parent long, name string, length double, support double")
    tips = spark.createDataFrame([(f"t{n}", 2000.0 + n, "L2" if n % 2 else "L1") for n in range(16, 32)], "name string, year double, lineage string")
    out = forests.clade_rows(forests.node_stats(nodes, 6.0), tips, min_size=5, replicates=200).collect()
    assert [(r.clade, r.clade_nr, r.n_tips, r.stem_support, r.min_internal_support, r.reference_lineages) for r in out] == [(2, 1, 8, 80.0, 80.0, "L1;L2")]
    assert (out[0].slope, out[0].r_squared, out[0].verdict) == (pytest.approx(0.1), 1.0, "weak")
    assert forests.clade_rows(forests.node_stats(nodes, 0.5), tips).count() == 0


def test_histories(spark):
    rows = [("a", 1, None, None, "x", 0.0), ("a", 2, 1, "p", "x", 1.0), ("a", 3, 1, None, "y", 2.0), ("a", 4, 3, "q", "y", 1.0), ("a", 5, 3, "r", None, 0.5), ("b", 1, None, None, None, 0.0), ("b", 2, 1, None, "y", 1.0), ("b", 3, 2, "p", "x", 4.0)]
    nodes = spark.createDataFrame(rows, "tree string, node long, parent long, name string, state string, length double").withColumn("support", F.lit(None).cast("double"))
    stats = forests.node_stats(nodes)
    found = forests.branches(nodes, stats, 2020.0).collect()
    assert {(r.tree, r.node): (r.parent_state, r.state, r.parent_year, r.year, r.terminal) for r in found} == {
        ("a", 2): ("x", "x", 2017.0, 2018.0, True), ("a", 3): ("x", "y", 2017.0, 2019.0, False), ("a", 4): ("y", "y", 2019.0, 2020.0, True), ("b", 3): ("y", "x", 2016.0, 2020.0, True),
    }
    table = {(r.parent_state, r.state): (r.n, r.median_year, r.terminal_share, r.deep_share, r.per_tree) for r in forests.transition_table(forests.branches(nodes, stats, 2020.0), 2018.0).collect()}
    assert table == {("x", "y"): (1, 2018.0, 0.0, 0.0, 0.5), ("y", "x"): (1, 2018.0, 1.0, 0.0, 0.5)}
    assert {r.state: (r.n_trees, r.share) for r in forests.root_states(nodes).collect()} == {"x": (1, 0.5), "y": (1, 0.5)}
    tips = spark.createDataFrame([("p", 2018.0), ("q", 2020.0), ("r", None)], "name string, year double")
    assert {r.tree: (r.n_tips, r.worst, r.n_off) for r in forests.date_errors(stats, tips, 2020.0).collect()} == {"a": (2, 0.0, 0), "b": (1, 2.0, 1)}
