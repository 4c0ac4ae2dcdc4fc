"""Many trees at once: a node table with a column ``tree``.

Trees of a posterior are many and each fits a task. They are dealt out by a hash
of the tree, about ``NODES_A_GROUP`` nodes to a group, and a group is walked up
and down in one Arrow batch (numpy over nodes and replicates, without recursion).
What comes out is one row per node, or sums over the trees of a group; everything
after that is DataFrame work. A single tree too large for a task belongs to
``operators.trees``.

Columns of a node table: tree, node, parent (null at the root), name (of tips),
length, support (null if there is none). Null lengths count as 0. Nodes whose
parent is missing are roots of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.gates import permutation_p
from tidemark.operators.trees import tip_hash, trait_report
from tidemark.session import checkpointed, if_small

NODES_A_GROUP = 10_000
STATS = "tree {tree}, node long, parent long, name string, is_tip boolean, level int, depth double, n_tips int, d1 double, d2 double, sig long, support double, min_support double, clade long"


class _Tree:
    """A tree as arrays: nodes in an order in which parents come before their children."""

    def __init__(self, pdf: pd.DataFrame) -> None:
        place = {n: i for i, n in enumerate(pdf.node.tolist())}
        self.up = np.array([place.get(p, -1) if p == p and p is not None else -1 for p in pdf.parent.tolist()], np.int64)
        self.children: list[list[int]] = [[] for _ in range(len(pdf))]
        for i, p in enumerate(self.up):
            if p >= 0:
                self.children[p].append(i)
        self.order = [i for i, p in enumerate(self.up) if p < 0]
        for i in self.order:
            self.order += self.children[i]
        self.tips = np.array([not c for c in self.children], bool)


def _grouped(nodes: DataFrame, work: Callable[[Iterator[pd.DataFrame]], pd.DataFrame], schema: str, nodes_a_group: int) -> DataFrame:
    """``work`` over the trees of each group."""
    groups = max(1, -(-nodes.count() // nodes_a_group))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        return work(part for _, part in pdf.groupby("tree", sort=True))

    # The number of partitions is given, as small node tables would else be put into one task.
    dealt = nodes.withColumn("_group", F.pmod(F.xxhash64("tree"), F.lit(groups))).repartition(groups, "_group")
    return dealt.groupBy("_group").applyInPandas(run, schema)


def node_stats(nodes: DataFrame, max_diameter: float = 0.1, nodes_a_group: int = NODES_A_GROUP) -> DataFrame:
    """One row per node: level, depth (path length from the root), n_tips, d1 and d2, sig, min_support, clade.

    d1 and d2 are the two greatest path lengths to tips below (0 with fewer); sig is
    the sum of the hashes of the names of those tips; min_support the least support
    of inner nodes below it, itself included (null without any). clade is the node
    of the greatest subtree around it whose d1 + d2 is at most ``max_diameter`` (0
    for a tip by itself), null above those.
    """
    hashed = nodes.withColumn("hash", F.when(F.col("name").isNotNull(), tip_hash("name").cast("long")))

    def stats(trees: Iterator[pd.DataFrame]) -> pd.DataFrame:
        out = []
        for pdf in trees:
            t, n = _Tree(pdf), len(pdf)
            length, support = np.nan_to_num(pdf.length.to_numpy(float)), pdf.support.to_numpy(float)
            level, depth = np.zeros(n, np.int32), np.zeros(n)
            for i in t.order:
                if t.up[i] >= 0:
                    level[i], depth[i] = level[t.up[i]] + 1, depth[t.up[i]] + length[i]
            count = t.tips.astype(np.int32)
            sig = np.where(t.tips, pdf.hash.fillna(0).to_numpy(np.int64), 0)
            top = np.zeros((n, 2))
            least = np.where(t.tips | np.isnan(support), np.inf, support)
            for i in reversed(t.order):
                p = t.up[i]
                if p >= 0:
                    count[p] += count[i]
                    sig[p] += sig[i]
                    least[p] = min(least[p], least[i])
                    far = [top[i, 0] + length[i]] + ([top[i, 1] + length[i]] if count[i] > 1 else [])
                    top[p] = sorted([*top[p], *far])[-2:][::-1]
            good = np.where(count > 1, top.sum(1), 0.0) <= max_diameter
            clade = np.full(n, -1, np.int64)
            node = pdf.node.to_numpy(np.int64)
            for i in t.order:
                above = clade[t.up[i]] if t.up[i] >= 0 else -1
                clade[i] = above if above >= 0 else (node[i] if good[i] else -1)
            out.append(pd.DataFrame({
                "tree": pdf.tree.to_numpy(), "node": node, "parent": pdf.parent.astype("Int64").to_numpy(), "name": pdf.name.to_numpy(), "is_tip": t.tips, "level": level, "depth": depth, "n_tips": count, "d1": top[:, 0], "d2": top[:, 1],
                "sig": sig, "support": pdf.support.astype("Float64").to_numpy(), "min_support": pd.array(np.where(np.isinf(least), 0, least), "Float64"), "clade": pd.array(clade, "Int64"),
            }).assign(min_support=lambda d, m=np.isinf(least): d.min_support.mask(m), clade=lambda d: d.clade.mask(d.clade < 0)))
        return pd.concat(out)

    return _grouped(hashed.select("tree", F.col("node").cast("long").alias("node"), F.col("parent").cast("long").alias("parent"), F.col("name").cast("string").alias("name"), "length", "support", "hash"), stats, STATS.format(tree=dict(nodes.dtypes)["tree"]), nodes_a_group)


def clade_rows(stats: DataFrame, tips: DataFrame, min_size: int = 30, replicates: int = 1000, min_r2: float = 0.1, min_span: float = 5.0, max_concentration: float = 0.75) -> DataFrame:
    """One row per kept clade of every tree, the largest first: clade_nr and what is known of it.

    ``tips`` has name, year and lineage by tip, the last two may be null. Columns:
    tree, clade, clade_nr, n_tips, n_dated, diversity, span_years, earliest, latest,
    slope, r_squared, perm_p, implied_root (with a positive slope), stem_support,
    min_internal_support (null without supports), verdict and reference_lineages
    (sorted, by ``;``). Distances are from the clade's own node. Clades under
    ``min_size`` tips, or with under three dated ones, are left out.
    """
    roots = stats.where((F.col("node") == F.col("clade")) & (F.col("n_tips") >= min_size)).select("tree", "clade", F.col("depth").alias("d0"), F.col("n_tips").alias("size"), F.when(F.col("n_tips") > 1, F.col("d1") + F.col("d2")).otherwise(0.0).alias("diversity"), F.col("support").alias("stem"), "min_support")
    rows = stats.where("is_tip and clade is not null").select("tree", "clade", "node", "name", "depth").join(if_small(checkpointed(roots)), ["tree", "clade"]).join(if_small(tips.select("name", "year", "lineage")), "name", "left")
    rows = checkpointed(rows.withColumns({"dist": F.col("depth") - F.col("d0"), "g": F.concat_ws("|", F.col("tree").cast("string"), F.col("clade").cast("string"))}))
    years = rows.where("year is not null").groupBy("g", F.floor("year").alias("yr")).agg(F.count(F.lit(1)).alias("c"))
    ahead = F.sum("c").over(Window.partitionBy("g").orderBy("yr").rangeBetween(0, 9))
    dense = years.withColumn("w", ahead).groupBy("g").agg((F.max("w") / F.sum("c")).alias("densest"))
    fit = rows.groupBy("tree", "clade", "g", "size", "diversity", "stem", "min_support").agg(
        F.count("year").alias("n_dated"), F.min("year").alias("lo"), F.max("year").alias("hi"), F.regr_slope("dist", "year").alias("s"), F.corr("dist", "year").alias("r"), F.regr_intercept("dist", "year").alias("i"),
        F.array_join(F.array_sort(F.collect_set("lineage")), ";").alias("reference_lineages"),
    ).where("n_dated >= 3")
    known = F.col("s").isNotNull() & F.col("r").isNotNull() & ~F.isnan("r")
    fit = fit.withColumns({"slope": F.when(known, F.col("s")).otherwise(0.0), "r2": F.when(known, F.col("r") ** 2).otherwise(0.0)}).withColumn("span", F.col("hi") - F.col("lo"))
    out = fit.join(dense, "g").join(permutation_p(rows, "g", "node", "year", "dist", replicates), "g", "left")
    p = F.coalesce("p", F.lit(1.0))
    inverted = (F.abs(F.col("slope") + 1) < 0.05) & (F.col("r2") > 0.8)
    verdict = F.when(inverted | (F.col("slope") <= 0) | (p > 0.05) | (F.col("span") < min_span), "fail").when((F.col("r2") < min_r2) | (F.col("densest") > max_concentration), "weak").otherwise("pass")
    nr = F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("size"), "clade"))
    four = lambda c, k=4: F.bround(c, k)
    return out.select(
        "tree", "clade", nr.alias("clade_nr"), F.col("size").alias("n_tips"), "n_dated", four(F.col("diversity")).alias("diversity"), four("span", 1).alias("span_years"), four("lo", 2).alias("earliest"), four("hi", 2).alias("latest"), "slope",
        four("r2").alias("r_squared"), four(p).alias("perm_p"), four(F.when(F.col("slope") > 0, -F.col("i") / F.col("slope")), 1).alias("implied_root"), four("stem", 1).alias("stem_support"), four("min_support", 1).alias("min_internal_support"), verdict.alias("verdict"), "reference_lineages",
    )


def shared_tips(nodes: DataFrame) -> DataFrame:
    """name: tips that every tree has."""
    inner = nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    tips = nodes.join(inner, ["tree", "node"], "left_anti").select("tree", "name").where("name is not null").distinct()
    n = nodes.agg(F.count_distinct("tree")).first()[0]
    return tips.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == n).select("name")


def forest_splits(nodes: DataFrame, taxa: DataFrame, collapse: float | None = 70.0) -> DataFrame:
    """tree, n, sig: the distinct non-trivial splits of the taxa in every tree, by their smaller side (by size, then hash sum).

    Inner nodes whose support is below ``collapse`` make none; a node without a support does.
    """
    keep = if_small(checkpointed(taxa.select(F.col("name").cast("string").alias("name"), F.lit(True).alias("in"))))
    marked = nodes.withColumn("name", F.col("name").cast("string")).join(keep, "name", "left").withColumn("name", F.when(F.col("in"), F.col("name"))).drop("in")
    flagged = node_stats(marked).where("not is_tip")
    below = node_taxa(marked)
    total = taxa.agg(F.count(F.lit(1)).alias("n"), F.sum(tip_hash("name").cast("long")).alias("sig")).first()
    rows = flagged.where(F.lit(True) if collapse is None else F.col("support").isNull() | (F.col("support") >= collapse)).select("tree", "node", "sig").join(below, ["tree", "node"])
    n, sig = F.col("n_taxa"), F.col("sig")
    other_n, other_sig = F.lit(total.n or 0) - n, F.lit(total.sig or 0) - sig
    flip = (other_n < n) | ((other_n == n) & (other_sig < sig))
    return rows.where((n > 1) & (other_n > 1)).select("tree", F.when(flip, other_n).otherwise(n).alias("n"), F.when(flip, other_sig).otherwise(sig).alias("sig")).distinct()


def node_taxa(nodes: DataFrame, nodes_a_group: int = NODES_A_GROUP) -> DataFrame:
    """tree, node, n_taxa: named tips below every node."""

    def count(trees: Iterator[pd.DataFrame]) -> pd.DataFrame:
        out = []
        for pdf in trees:
            t = _Tree(pdf)
            n = (t.tips & pdf.name.notna().to_numpy()).astype(np.int64)
            for i in reversed(t.order):
                if t.up[i] >= 0:
                    n[t.up[i]] += n[i]
            out.append(pd.DataFrame({"tree": pdf.tree.to_numpy(), "node": pdf.node.to_numpy(np.int64), "n_taxa": n}))
        return pd.concat(out)

    return _grouped(nodes.select("tree", "node", "parent", "name"), count, f"tree {dict(nodes.dtypes)['tree']}, node long, n_taxa long", nodes_a_group)


def nearest_tips(nodes: DataFrame, taxa: DataFrame, k: int = 5, nodes_a_group: int = NODES_A_GROUP) -> DataFrame:
    """tree, name, near: the k nearest other taxa of every taxon by path length, ties by name.

    Every node passes its k nearest tips up, then down, so a tree takes k steps a
    node and no two tips are compared as such.
    """
    keep = if_small(checkpointed(taxa.select(F.col("name").cast("string").alias("name"), F.lit(True).alias("in"))))
    marked = nodes.select("tree", "node", "parent", F.col("name").cast("string").alias("name"), "length").join(keep, "name", "left").withColumn("name", F.when(F.col("in"), F.col("name"))).drop("in")

    def near(trees: Iterator[pd.DataFrame]) -> pd.DataFrame:
        out = []
        for pdf in trees:
            t, names = _Tree(pdf), pdf.name.tolist()
            length = np.nan_to_num(pdf.length.to_numpy(float))
            moved = lambda some, by: [(d + by, x) for d, x in some]
            below: list[list] = [[(0.0, names[i])] if t.tips[i] and names[i] is not None else [] for i in range(len(pdf))]
            for i in reversed(t.order):
                for c in t.children[i]:
                    below[i] = sorted(below[i] + moved(below[c], length[c]))[: k + 1]
            above: list[list] = [[] for _ in range(len(pdf))]
            for i in t.order:
                kids = t.children[i]
                # What lies beside a child: the k nearest of its siblings, from the left and from the right.
                left: list[list] = [[]]
                for c in kids[:-1]:
                    left.append(sorted(left[-1] + moved(below[c], length[c]))[: k + 1])
                right: list = []
                for c, l in zip(reversed(kids), reversed(left[: len(kids)]), strict=True):
                    above[c] = moved(sorted(above[i] + l + right)[: k + 1], length[c])
                    right = sorted(right + moved(below[c], length[c]))[: k + 1]
            rows = [(pdf.tree.iloc[0], names[i], [x for _, x in above[i][:k]]) for i in range(len(pdf)) if t.tips[i] and names[i] is not None]
            out.append(pd.DataFrame(rows, columns=["tree", "name", "near"]))
        return pd.concat(out)

    return _grouped(marked, near, f"tree {dict(nodes.dtypes)['tree']}, name string, near array<string>", nodes_a_group)


def reassortants(near: DataFrame, threshold: float = 0.6) -> DataFrame:
    """name, incongruence: taxa whose neighbours differ between trees, 1 less the mean Jaccard similarity over all pairs of (few) trees."""
    sets = near.groupBy("name").agg(F.array_sort(F.collect_list(F.struct("tree", "near"))).alias("s"))
    jaccard = lambda a, b: F.size(F.array_intersect(a["near"], b["near"])) / F.size(F.array_union(a["near"], b["near"]))
    pairs = F.flatten(F.transform("s", lambda a, i: F.transform(F.filter("s", lambda b, j: j > i), lambda b: F.when(F.size(a["near"]) + F.size(b["near"]) > 0, jaccard(a, b)))))
    known = F.filter(pairs, lambda x: x.isNotNull())
    mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known)
    return sets.select("name", F.size(known).alias("n"), mean.alias("m")).where("n > 0").select("name", (1 - F.col("m")).alias("score")).where(F.col("score") >= threshold).select("name", F.bround("score", 3).alias("incongruence"))


def split_distances(splits: DataFrame, trees: DataFrame) -> DataFrame:
    """tree_a, tree_b, distance: share of splits that only one of two trees has, for all pairs of the (few) ``trees``; 0 if neither has any."""
    sizes = trees.select("tree").distinct().join(splits.groupBy("tree").agg(F.count(F.lit(1)).alias("n")), "tree", "left").select("tree", F.coalesce("n", F.lit(0)).alias("n"))
    a, b = (sizes.select(F.col("tree").alias(f"tree_{s}"), F.col("n").alias(f"n_{s}")) for s in "ab")
    left, right = (splits.withColumnRenamed("tree", f"tree_{s}") for s in "ab")
    shared = left.join(right, ["n", "sig"]).where("tree_a < tree_b").groupBy("tree_a", "tree_b").agg(F.count(F.lit(1)).alias("shared"))
    pairs = a.join(b, F.col("tree_a") < F.col("tree_b")).join(shared, ["tree_a", "tree_b"], "left")
    whole = F.col("n_a") + F.col("n_b")
    return pairs.select("tree_a", "tree_b", F.coalesce((whole - 2 * F.coalesce("shared", F.lit(0))) / F.nullif(whole, F.lit(0)), F.lit(0.0)).alias("distance"))


def congruence(nodes: DataFrame, collapse: float | None = 70.0, congruent: float = 0.15, decoupled: float = 0.4, k: int = 5, threshold: float = 0.6) -> DataFrame:
    """One row: whether the trees of (few) segments agree: n_trees, n_shared, n_taxa, mean_distance, max_distance, n_reassortants, verdict, concatenate.

    ``congruent`` with one tree, ``unknown`` with under four shared taxa; else by
    the greatest split distance: ``congruent`` up to ``congruent``, ``decoupled``
    from ``decoupled`` on, ``mixed`` between.
    """
    nodes = checkpointed(nodes)
    taxa = checkpointed(shared_tips(nodes))
    one = F.lit(1).alias("k")
    inner = nodes.select("tree", F.col("parent").alias("node")).where("node is not null").distinct()
    counts = nodes.join(inner, ["tree", "node"], "left_anti").agg(F.count_distinct("name").alias("n_taxa"), one).join(nodes.agg(F.count_distinct("tree").alias("n_trees"), one), "k").join(taxa.agg(F.count(F.lit(1)).alias("n_shared"), one), "k")
    far = split_distances(checkpointed(forest_splits(nodes, taxa, collapse)), nodes.select("tree")).agg(F.bround(F.avg("distance"), 4).alias("mean_distance"), F.bround(F.max("distance"), 4).alias("max_distance"), one)
    moved = reassortants(nearest_tips(nodes, taxa, k), threshold).agg(F.count(F.lit(1)).alias("n_reassortants"), one)
    few, top = F.col("n_shared") < 4, F.col("max_distance")
    verdict = F.when(F.col("n_trees") < 2, "congruent").when(few, "unknown").when(top <= congruent, "congruent").when(top >= decoupled, "decoupled").otherwise("mixed")
    out = counts.join(far, "k").join(moved, "k").withColumn("verdict", verdict)
    return out.select("n_trees", "n_shared", "n_taxa", "mean_distance", "max_distance", "n_reassortants", "verdict", (F.col("verdict") == "congruent").alias("concatenate"))


def branches(nodes: DataFrame, stats: DataFrame, most_recent: float) -> DataFrame:
    """tree, node, parent_state, state, parent_year, year, length, terminal: every branch of every tree.

    ``nodes`` has a state by node. The deepest node of a tree is of the year
    ``most_recent``, others are as much older as their depth is less. Branches from
    or to a node without a state are left out.
    """
    deepest = stats.groupBy("tree").agg(F.max("depth").alias("deepest"))
    rows = nodes.select("tree", "node", "parent", "state").join(stats.select("tree", "node", "depth", "is_tip"), ["tree", "node"]).join(deepest, "tree")
    rows = rows.withColumn("year", F.lit(most_recent) - (F.col("deepest") - F.col("depth")))
    above = rows.select("tree", F.col("node").alias("parent"), F.col("state").alias("parent_state"), F.col("year").alias("parent_year"))
    out = rows.join(above, ["tree", "parent"]).where("state is not null and parent_state is not null")
    return out.select("tree", "node", "parent_state", "state", "parent_year", "year", (F.col("year") - F.col("parent_year")).alias("length"), F.col("is_tip").alias("terminal"))


def transition_table(rows: DataFrame, recent: float, digits: int = 6) -> DataFrame:
    """parent_state, state, n, share, per_tree, median_year, iqr, terminal_share, deep_share of ``branches`` whose ends differ in state.

    A change is dated to the middle of its branch; deep ones are before ``recent``.
    Quartiles are those of counts by year and thousandth, so no pair of states is
    gathered.
    """
    year = F.round((F.col("year") + F.col("parent_year")) / 2, 3)
    jumps = checkpointed(rows.where("state <> parent_state").groupBy("parent_state", "state", year.alias("mid"), "terminal").agg(F.count(F.lit(1)).alias("c")))
    trees = rows.agg(F.count_distinct("tree")).first()[0] or 1
    pair = ["parent_state", "state"]
    years = jumps.groupBy(*pair, "mid").agg(F.sum("c").alias("c"))
    upto, n = F.sum("c").over(Window.partitionBy(*pair).orderBy("mid")), F.sum("c").over(Window.partitionBy(*pair))
    placed = years.withColumns({"upto": upto, "n": n})

    def quantile(q: float) -> Column:
        """Linear between the two values around place q (n - 1), from 0."""
        at = (F.col("n") - 1) * q
        value = lambda k: F.max(F.when((F.col("upto") > k) & (F.col("upto") - F.col("c") <= k), F.col("mid")))
        low, high = value(F.floor(at)), value(F.ceil(at))
        return low + (high - low) * (F.max(at) - F.max(F.floor(at)))

    quartiles = placed.groupBy(*pair).agg(*(quantile(q).alias(name) for q, name in ((0.25, "q1"), (0.5, "q2"), (0.75, "q3"))))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("c"))), F.lit(0))
    counts = jumps.groupBy(*pair).agg(F.sum("c").alias("n"), total(F.col("terminal")).alias("t"), total(F.col("mid") < recent).alias("d"))
    out = counts.join(quartiles, pair).withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy()))
    r = lambda c, name: F.round(c, digits).alias(name)
    return out.select(*pair, "n", r("share", "share"), r(F.col("n") / trees, "per_tree"), r("q2", "median_year"), r(F.col("q3") - F.col("q1"), "iqr"), r(F.col("t") / F.col("n"), "terminal_share"), r(F.col("d") / F.col("n"), "deep_share"))


def root_states(nodes: DataFrame) -> DataFrame:
    """state, n_trees, share: the state at the root over all trees.

    A root without a state that has one child only (a stem) takes that child's;
    trees whose root has none even so count as null.
    """
    kids = nodes.where("parent is not null").groupBy("tree", F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("k"), F.max("state").alias("below"))
    roots = nodes.where("parent is null").join(kids, ["tree", "node"], "left")
    state = F.coalesce("state", F.when(F.col("k") == 1, F.col("below")))
    counts = roots.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n_trees"))
    return counts.select("state", "n_trees", F.round(F.col("n_trees") / F.sum("n_trees").over(Window.partitionBy()), 6).alias("share"))


def date_errors(stats: DataFrame, tips: DataFrame, most_recent: float, tolerance: float = 0.05) -> DataFrame:
    """tree, n_tips, worst, n_off: how far the heights of dated tips (name, year) are from what their years say, and whether times fit.

    The height of a tip is the depth of the deepest node less its own; it should be
    ``most_recent`` less its year.
    """
    deepest = stats.groupBy("tree").agg(F.max("depth").alias("deepest"))
    rows = stats.where("is_tip").join(if_small(checkpointed(tips.where("year is not null").select("name", "year"))), "name").join(deepest, "tree")
    off = F.abs((F.lit(most_recent) - F.col("year")) - (F.col("deepest") - F.col("depth")))
    return rows.groupBy("tree").agg(F.count(F.lit(1)).alias("n_tips"), F.round(F.max(off), 6).alias("worst"), F.count_if(off > tolerance).alias("n_off"))


@lru_cache(maxsize=4)
def _permutations(n: int, replicates: int, seed: int) -> np.ndarray:
    """Row 0 in order, then ``replicates`` random orders of n labels; the same for every tree."""
    rows = np.tile(np.arange(n), (replicates + 1, 1))
    rows[1:] = np.random.default_rng([seed, n]).permuted(rows[1:], axis=1)
    return rows


def _signal_sums(pdf: pd.DataFrame, n_states: int, replicates: int, seed: int) -> np.ndarray:
    """(replicates + 1) x (2 + states): association index, parsimony score and largest pure clades of one tree under every labelling."""
    t = _Tree(pdf)
    code = pdf.code.to_numpy()
    labelled = np.flatnonzero(t.tips & (code >= 0))
    labelled = labelled[np.argsort(pdf.name.to_numpy()[labelled].astype(str), kind="stable")]
    given = code[labelled].astype(np.int64)[_permutations(len(labelled), replicates, seed)]
    out = np.zeros((replicates + 1, 2 + n_states))
    block = max(1, 20_000_000 // (len(pdf) * n_states))
    for start in range(0, replicates + 1, block):
        states = given[start : start + block]
        r = len(states)
        counts = np.zeros((len(pdf), n_states, r), np.int32)
        mask = np.full((len(pdf), r), -1, np.int64)
        for j, i in enumerate(labelled):
            counts[i, states[:, j], np.arange(r)] = 1
            mask[i] = np.left_shift(np.int64(1), states[:, j])
        cost = np.zeros(r)
        for i in reversed(t.order):
            kids = t.children[i]
            if kids:
                for c in kids:
                    counts[i] += counts[c]
                mask[i] = mask[kids[0]]
                for c in kids[1:]:  # a node with many children is resolved from the left
                    both = mask[i] & mask[c]
                    cost += both == 0
                    mask[i] = np.where(both != 0, both, mask[i] | mask[c])
        n, top = counts.sum(1, dtype=np.int32), counts.max(1)
        inner = ~t.tips[:, None] & (n > 0)
        weight = np.where(inner & (n <= 1024), (1 - top / np.maximum(n, 1)) * np.exp2(1.0 - n), 0.0)
        pure = (counts * (counts == n[:, None, :])).max(0)
        out[start : start + r] = np.column_stack([weight.sum(0), cost, pure.T])
    return out


def signal_values(nodes: DataFrame, tip_states: DataFrame, replicates: int, seed: int = 12345, nodes_a_group: int = NODES_A_GROUP) -> DataFrame:
    """rep, statistic (AI, PS, MC), state (of MC), x: means over all trees under the known states (rep 0) and each relabelling.

    ``tip_states`` has name and state; a relabelling is one order of the states of
    the labelled tips, the same for every tree that has them. Tips without a state
    fit any. States have one bit each, so there are at most 63.
    """
    known = tip_states.where("state is not null and name is not null").select(F.col("name").cast("string").alias("name"), F.col("state").cast("string").alias("state")).dropDuplicates(["name"])
    states = sorted(r.state for r in known.select("state").distinct().collect())
    code = F.coalesce(*(F.when(F.col("state") == s, F.lit(k)) for k, s in enumerate(states)), F.lit(-1)) if states else F.lit(-1)
    rows = nodes.select("tree", "node", "parent", F.col("name").cast("string").alias("name")).join(if_small(checkpointed(known)), "name", "left").withColumn("code", code).drop("state")
    names = [("AI", None), ("PS", None), *(("MC", s) for s in states)]

    def sums(trees: Iterator[pd.DataFrame]) -> pd.DataFrame:
        total, n = 0.0, 0
        for pdf in trees:
            total, n = total + _signal_sums(pdf, max(len(states), 1), replicates, seed), n + 1
        total = np.asarray(total)[:, : len(names)]
        rep = np.arange(replicates + 1)
        return pd.concat([pd.DataFrame({"rep": rep, "statistic": a, "state": s, "x": total[:, k], "n": n}) for k, (a, s) in enumerate(names)])

    parts = _grouped(rows, sums, "rep int, statistic string, state string, x double, n long", nodes_a_group)
    return parts.groupBy("rep", "statistic", "state").agg((F.sum("x") / F.sum("n")).alias("x"))


def forest_signal(nodes: DataFrame, tip_states: DataFrame, replicates: int = 1000, alpha: float = 0.05, seed: int = 12345) -> DataFrame:
    """Association of states with the trees of a posterior, by statistic: as ``trees.trait_verdict``, of means over all trees.

    The mean of the real labelling stands against the means of the relabellings.
    """
    known = tip_states.where("state is not null").select("name", "state").dropDuplicates(["name"])
    return trait_report(checkpointed(signal_values(nodes, tip_states, replicates, seed)), known, alpha)
