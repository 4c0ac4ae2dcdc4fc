import random
from collections import Counter

from tidemark.operators import alignment, chains, gates, mutations, newick, trees

NODES = "node long, parent long, length double, state string"


def random_tree(rng, n):
    rows = [(1, None, 0.0, "r")] + [(i, rng.randrange(1, i), float(rng.randrange(1, 9)), rng.choice("xyz")) for i in range(2, n + 1)]
    return rows, {i: (p, w) for i, p, w, _ in rows}


def path(up, i):
    out = [(i, 0.0)]
    while up[i][0] is not None:
        out.append((up[i][0], out[-1][1] + up[i][1]))
        i = up[i][0]
    return out


def test_closure_depths_and_cut(spark):
    rng = random.Random(3)
    rows, up = random_tree(rng, 120)
    rows += [(i, i - 1, 1.0, "x") for i in range(121, 160)]
    up |= {i: (i - 1, 1.0) for i in range(121, 160)}
    nodes = spark.createDataFrame(rows, NODES)
    closure = trees.ancestors(nodes)
    want = {(i, a, h, d) for i in up for h, (a, d) in enumerate(path(up, i))}
    assert {tuple(r) for r in closure.collect()} == want
    leaves = set(up) - {p for p, _ in up.values()}
    assert {r.node for r in trees.tips(nodes).collect()} == leaves
    tops = {a: sorted((d for i, b, _, d in want if b == a and i in leaves), reverse=True) for a in up}
    good = {a for a, d in tops.items() if (d[0] + d[1] if len(d) > 1 else 0) <= 12}
    cut = {a for a in good if not any(b in good for b, _ in path(up, a)[1:])}
    got = trees.clade_cut(closure, trees.tips(nodes), 12.0, 3).collect()
    assert {r.clade for r in got} == cut and all(r.kept == (len(tops[r.clade]) >= 3) for r in got)


def test_four_tips(spark):
    rows = [(1, None, 0.0, None), (2, 1, 1.0, None), (3, 1, 1.0, None), (4, 2, 1.0, "A"), (5, 2, 1.0, "A"), (6, 3, 1.0, "B"), (7, 3, 1.0, "B")]
    mixed = [(*r[:3], s) for r, s in zip(rows, [None, None, None, "A", "B", "A", "B"], strict=True)]
    for table, score, ai, largest in ((rows, 1, 0.0625, 2), (mixed, 2, 0.5625, 1)):
        nodes = spark.createDataFrame(table, NODES)
        closure, leaves = trees.ancestors(nodes), trees.tips(nodes)
        masks = leaves.selectExpr("node", "cast(if(state = 'A', 1, 2) as bigint) as mask")
        assert trees.parsimony_score(nodes, trees.node_depths(closure), masks).first().score == score
        counts = trees.state_counts(closure, leaves.select("node", "state"))
        assert trees.association_index(counts, leaves).first().ai == ai
        assert {r.largest for r in trees.pure_clades(counts).collect()} == {largest}


def test_parsimony_against_brute_force(spark):
    rng = random.Random(9)
    tips = {i: 1 << rng.randrange(3) for i in range(64, 128)}

    def fitch(i):
        if i >= 64:
            return tips[i], 0
        (a, x), (b, y) = fitch(2 * i), fitch(2 * i + 1)
        return (a & b, x + y) if a & b else (a | b, x + y + 1)

    nodes = spark.createDataFrame([(i, i // 2 or None, 1.0, "s") for i in range(1, 128)], NODES)
    masks = spark.createDataFrame(list(tips.items()), "node long, mask long")
    assert trees.parsimony_score(nodes, trees.node_depths(trees.ancestors(nodes)), masks).first().score == fitch(1)[1]


def test_branch_changes_against_brute_force(spark):
    rng = random.Random(10)
    seqs = {i: "".join(rng.choice("ACGTN") for _ in range(12)) for i in range(16, 32)}
    want = set()
    for col in range(12):
        masks = {i: 1 << "ACGT".index(s[col]) for i, s in seqs.items() if s[col] != "N"}
        for i in range(15, 0, -1):
            kids = [masks[k] for k in (2 * i, 2 * i + 1) if k in masks]
            if kids:
                both = kids[0] & kids[-1]
                masks[i] = both or kids[0] | kids[-1]
        state = {1: masks[1] & -masks[1]} if 1 in masks else {}
        for i in range(2, 32):
            if i in masks:
                up = state.get(i // 2, 0)
                state[i] = up if masks[i] & up else masks[i] & -masks[i]
                if up and state[i] != up:
                    want.add((i, col + 1, "ACGT"[up.bit_length() - 1], "ACGT"[state[i].bit_length() - 1]))
    nodes = spark.createDataFrame([(i, i // 2 or None) for i in range(1, 32)], "node long, parent long")
    levels = spark.createDataFrame([(i, i.bit_length() - 1) for i in range(1, 32)], "node long, level int")
    cells = spark.createDataFrame([(i, c + 1, b) for i, s in seqs.items() for c, b in enumerate(s)], "node long, col int, base string")
    assert {tuple(r) for r in mutations.branch_changes(nodes, levels, mutations.base_masks(cells)).collect()} == want


def test_change_counts_keep_nothing_by_cell(spark):
    """Blocks of any height give the changes of the cells, over forks, stems, many children, missing and empty tips."""
    rng = random.Random(11)
    up = {1: None, 2: None} | {i: max(1, i // rng.choice((2, 3, 9))) for i in range(3, 90)}
    level = {}
    for i, p in up.items():
        level[i] = 0 if p is None else level[p] + 1
    seqs = {i: "".join(rng.choice("ACGTN") for _ in range(rng.randrange(20))) for i in up if i not in up.values() and i % 7}
    nodes = spark.createDataFrame(list(up.items()), "node long, parent long")
    levels = spark.createDataFrame(list(level.items()), "node long, level int")
    rows = spark.createDataFrame(list(seqs.items()), "name long, seq string")
    changes = mutations.branch_changes(nodes, levels, mutations.base_masks(alignment.cells(rows).withColumnRenamed("name", "node"))).collect()
    want = Counter((r.col, r.from_base, r.to_base) for r in changes)
    for span, most in ((1, 1000), (2, 1000), (11, 1000), (2, 3)):
        tree = mutations.tree_blocks(nodes, levels, span)
        got = mutations.change_counts(tree, tree.join(mutations.packed_masks(rows), "node"), span, most).collect()
        assert {(r.col, r.from_base, r.to_base): r.n for r in got} == want, span


def test_newick_forms(spark):
    deep = "(" * 5000 + "a" + ")" * 5000 + ";"
    cases = {
        "((A:1,B:2)x:0.5,'C (d)''s':3)r;": [("A", 1.0), ("B", 2.0), ("C (d)'s", 3.0)], "(A,B[&rate=1,set={u,v}]:1);": [("A", None), ("B", 1.0)], "A;": [("A", None)], deep: [("a", None)],
        None: [], "": [], "((A,B);": [], "A)B;": [], "(A:x);": [],
    }
    df = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(cases)], "id int, newick string, node string")
    rows = newick.tree_nodes(df.drop("node"), "id", "newick").withColumn("s", newick.annotation_value(newick.F.col("annotation"), "set")).collect()
    for i, t in enumerate(cases):
        assert sorted(((r.label, r.length) for r in rows if r.id == i and r.n_children == 0), key=str) == sorted(cases[t], key=str), t
    assert [r.s for r in rows if r.s] == ["u,v"]


def test_thousand_permutations(spark):
    rng = random.Random(4)
    rows = [("g", i, 2000.0 + i / 2, i / 2 + rng.random()) for i in range(40)]
    got = gates.temporal_signal(spark.createDataFrame(rows, "g string, k long, x double, y double"), "g", "k", "x", "y").first()
    assert got.p == round(1 / 1001, 6) and got.verdict == "pass"


def test_permutations_repeat_no_row(spark):
    """Groups that fit a task have the p of the rows sorted by md5, without a row for each replicate."""
    rng = random.Random(5)
    rows = [(g, f"{g}{i}", 2000.0 + rng.randrange(9), 100.0 if g == "flat" else rng.random() * 9) for g in ("a", "b", "flat", "one") for i in range(1 if g == "one" else 60)] + [("a", None, 2001.0, 3.0), ("a", "n", None, 3.0)]
    df = spark.createDataFrame(rows, "g string, k string, x double, y double")
    want = dict(gates.permutation_p(df, "g", "k", "x", "y", 19).collect())
    got = gates.grouped_p(df, "g", "k", "x", "y", 19)
    assert dict(got.collect()) == want and dict(gates.grouped_p(df, "g", "k", "x", "y", 19, rows_a_task=60).collect()) == want
    assert "Window" not in got._jdf.queryExecution().optimizedPlan().toString() and want["flat"] == 1.0 and want["one"] == 0.05


def test_drawn_permutations(spark):
    rng = random.Random(6)
    rows = [(g, i, 2000.0 + i / 2, i / 2 * (g == "up") + rng.random()) for g in ("up", "none") for i in range(40)]
    df = spark.createDataFrame(rows, "g string, k long, x double, y double")
    got, again = ({r.g: (r.p, r.verdict) for r in gates.temporal_signal(t, "g", "k", "x", "y", drawn=True).collect()} for t in (df, df.orderBy("y").repartition(5)))
    by_md5 = dict(gates.permutation_p(df, "g", "k", "x", "y", 1000).collect())
    assert got == again and got["up"] == (round(1 / 1001, 6), "pass") and got["none"][1] == "fail" and abs(got["none"][0] - by_md5["none"]) < 0.06


def test_trait_verdict_needs_ai_ps_and_mc(spark):
    clustered = {i: "AB"[i >= 24] for i in range(16, 32)}
    mixed = {i: "AB"[i % 2] for i in range(16, 32)}
    for states, score, verdict in ((clustered, 1, "pass"), (mixed, 8, "fail")):
        nodes = spark.createDataFrame([(i, i // 2 or None, 1.0, states.get(i)) for i in range(1, 32)], NODES)
        got = {(r.statistic, r.state): r for r in trees.trait_verdict(nodes, trees.ancestors(nodes), trees.tips(nodes)).collect()}
        assert set(got) == {("AI", None), ("PS", None), ("MC", "A"), ("MC", "B")} and {r.verdict for r in got.values()} == {verdict}
        assert got["PS", None].observed == score and got["MC", "A"].n_tips == 8 and got["PS", None].null_lo <= got["PS", None].null_mean <= got["PS", None].null_hi


def test_trait_verdict_in_arrays(spark):
    """Without a closure, over forks, stems, many children and tips without a state, as by joins."""
    rng = random.Random(7)
    rows = [(i, None if i < 3 else rng.randrange(1, max(2, i // 2)), 1.0, rng.choice(["a", "b", "b", "c", None])) for i in range(1, 160)] + [(i, 5, 1.0, "a") for i in range(200, 240)]
    nodes = spark.createDataFrame(rows, NODES)
    got, want = ({(r.statistic, r.state): r for r in trees.trait_verdict(nodes, None, trees.tips(nodes), 1000, nodes_a_task=k).collect()} for k in (1000, 10))
    assert set(got) == set(want) == {("AI", None), ("PS", None), *(("MC", s) for s in "abc")}
    for k, r in want.items():
        assert (got[k].observed, got[k].n_tips, got[k].thin, got[k].verdict) == (r.observed, r.n_tips, r.thin, r.verdict), k
        assert abs(got[k].null_mean - r.null_mean) < 0.05 * r.null_mean and abs(got[k].p - r.p) < 0.1, k
    shuffled = {(r.statistic, r.state): r for r in trees.trait_verdict(nodes.orderBy("length", trees.F.desc("node")), None, trees.tips(nodes)).collect()}
    assert shuffled == got


def test_randomisation_is_inconclusive(spark):
    def verdict(real, reps, ess):
        rows = [("real", real), *((f"r{i}", m) for i, m in enumerate(reps))]
        intervals = spark.createDataFrame([(c, 1000, m - 1, m + 1) for c, m in rows], "c string, n long, lo double, hi double")
        means, sizes = spark.createDataFrame(rows, "c string, mean double"), spark.createDataFrame([(c, 1000, ess) for c, _ in rows], "c string, n long, ess double")
        return chains.randomisation_checked(intervals, means, sizes, "c", "real").first().verdict

    assert verdict(9.0, [1.0, 2.0, 3.0], 1000.0) == "pass" and verdict(9.0, [2.0, 2.0, 2.001], 1000.0) == "inconclusive"
    assert verdict(2.0, [1.0, 2.0, 3.0], 1000.0) == "fail" and verdict(2.0, [1.0, 2.0, 3.0], 50.0) == "inconclusive"
