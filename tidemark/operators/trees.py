"""Rooted trees as flat node tables: node, parent (null at the root), length, state.

Paths to the root come from pointer doubling: every round joins each node's
farthest known ancestor with that ancestor's own, so a tree of depth d takes
log2(d) joins whatever its shape. Clades are sets of tips below a node; they are
compared by sums of tip hashes, never as collected sets.
"""

from __future__ import annotations

import zlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.ranks import md5_rank
from tidemark.session import checkpointed

#: Nodes, and nodes times states, up to which one tree is relabelled in arrays, whole in each task.
NODES_A_TASK = 8_000_000
CELLS_A_TASK = 60_000_000
#: Tasks among which the relabellings are dealt.
PARTS = 24


def ancestors(nodes: DataFrame, max_rounds: int = 40) -> DataFrame:
    """node, ancestor, hops, dist: every node with itself and all nodes above it.

    dist is the path length from the ancestor down to the node.
    """
    base = nodes.select("node", F.col("parent").alias("ancestor"), F.lit(1).alias("hops"), F.coalesce("length", F.lit(0.0)).alias("dist")).where("ancestor is not null")
    closure = nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("hops"), F.lit(0.0).alias("dist")).unionAll(base)
    closure = checkpointed(closure)
    span = 1
    for _ in range(max_rounds):
        top = closure.where(F.col("hops") == span)
        upper = closure.where("hops > 0").select(F.col("node").alias("mid"), F.col("ancestor").alias("up"), F.col("hops").alias("h"), F.col("dist").alias("d"))
        more = top.join(upper, top["ancestor"] == upper["mid"]).select("node", F.col("up").alias("ancestor"), (F.col("hops") + F.col("h")).alias("hops"), (F.col("dist") + F.col("d")).alias("dist"))
        more = checkpointed(more)
        if more.isEmpty():
            break
        closure = checkpointed(closure.unionAll(more))
        span *= 2
    return closure


def tips(nodes: DataFrame) -> DataFrame:
    """Nodes that are nobody's parent."""
    return nodes.join(nodes.select(F.col("parent").alias("node")).where("node is not null").distinct(), "node", "left_anti")


def node_depths(closure: DataFrame) -> DataFrame:
    """node, depth (path length from the root), level (edges from the root)."""
    return closure.groupBy("node").agg(F.max("dist").alias("depth"), F.max("hops").alias("level"))


def clade_sizes(closure: DataFrame, tip_nodes: DataFrame) -> DataFrame:
    """node, n_tips, d1, d2: tips below each node and the two greatest path lengths to them (d2 0 with one tip).

    The greatest two come from max and the max of those of lower rank, all by
    partial aggregates: no clade is sorted in one task.
    """
    below = closure.join(tip_nodes.select("node"), "node").select(F.col("ancestor").alias("clade"), "node", "dist")
    first = below.groupBy("clade").agg(F.count(F.lit(1)).alias("n_tips"), F.max(F.struct("dist", "node")).alias("top"))
    rest = below.join(first, "clade").where("not (dist = top.dist and node = top.node)").groupBy("clade").agg(F.max("dist").alias("d2"))
    return first.join(rest, "clade", "left").select(F.col("clade").alias("node"), "n_tips", F.col("top.dist").alias("d1"), F.coalesce("d2", F.lit(0.0)).alias("d2"))


def clade_cut(closure: DataFrame, tip_nodes: DataFrame, max_diameter: float, min_size: int) -> DataFrame:
    """clade, n_tips, diameter, kept: greatest subtrees whose diameter bound is at most ``max_diameter``.

    The bound is the sum of the two greatest depths. A clade has no qualifying
    node above it; it is kept with at least ``min_size`` tips.
    """
    sizes = checkpointed(clade_sizes(closure, tip_nodes).withColumn("diameter", F.when(F.col("n_tips") > 1, F.col("d1") + F.col("d2")).otherwise(0.0)))
    good = sizes.where(F.col("diameter") <= max_diameter)
    under = closure.where("hops > 0").join(good.select(F.col("node").alias("ancestor")), "ancestor").select("node").distinct()
    return good.join(under, "node", "left_anti").select(F.col("node").alias("clade"), "n_tips", F.round("diameter", 6).alias("diameter"), (F.col("n_tips") >= min_size).alias("kept"))


def tip_hash(name: str) -> Column:
    """A 48-bit number of a tip's name, the same in every engine."""
    return F.conv(F.substring(F.md5(F.col(name).cast("string")), 1, 12), 16, 10).cast("decimal(38,0)")


def splits(closure: DataFrame, tip_nodes: DataFrame) -> DataFrame:
    """Distinct non-trivial splits of the tips: n, sig. The smaller side stands for the split (by size, then hash sum)."""
    hashed = tip_nodes.select("node", tip_hash("node").alias("h"))
    below = closure.join(hashed, "node").groupBy("ancestor").agg(F.count(F.lit(1)).alias("n"), F.sum("h").alias("sig"))
    total = hashed.agg(F.count(F.lit(1)).alias("all_n"), F.sum("h").alias("all_sig"))
    row = total.first()
    n, sig = F.col("n"), F.col("sig")
    other_n, other_sig = F.lit(row["all_n"]) - n, F.lit(row["all_sig"]).cast("decimal(38,0)") - sig
    flip = (other_n < n) | ((other_n == n) & (other_sig < sig))
    return below.where((n > 1) & (other_n > 1)).select(F.when(flip, other_n).otherwise(n).alias("n"), F.when(flip, other_sig).otherwise(sig).alias("sig")).distinct()


def split_distance(a: DataFrame, b: DataFrame) -> DataFrame:
    """n_a, n_b, n_shared, distance: splits of two trees and the share that only one of them has (0 if neither has any)."""
    both = a.withColumn("t", F.lit(1)).unionAll(b.withColumn("t", F.lit(2))).groupBy("n", "sig").agg(F.sum("t").alias("t"))
    out = both.agg(F.count_if(F.col("t") != 2).alias("n_a"), F.count_if(F.col("t") != 1).alias("n_b"), F.count_if(F.col("t") == 3).alias("n_shared"))
    whole = F.col("n_a") + F.col("n_b")
    return out.withColumn("distance", F.round(F.coalesce((whole - 2 * F.col("n_shared")) / F.nullif(whole, F.lit(0)), F.lit(0.0)), 6))


def state_counts(closure: DataFrame, tip_states: DataFrame) -> DataFrame:
    """node, state, n: tips of each state below each node; tips without a state don't count."""
    return closure.join(tip_states.where("state is not null"), "node").groupBy(F.col("ancestor").alias("node"), "state").agg(F.count(F.lit(1)).alias("n"))


def association_index(counts: DataFrame, tip_nodes: DataFrame) -> DataFrame:
    """One row: n_nodes, ai. The sum of (1 - share of the main state) / 2^(tips - 1) over inner nodes."""
    inner = counts.groupBy("node").agg(F.max("n").alias("top"), F.sum("n").alias("n")).join(tip_nodes.select("node"), "node", "left_anti")
    weight = F.when(F.col("n") > 1024, 0.0).otherwise((1 - F.col("top") / F.col("n")) / F.pow(F.lit(2.0), F.col("n") - 1))
    return inner.agg(F.count(F.lit(1)).alias("n_nodes"), F.round(F.coalesce(F.sum(weight), F.lit(0.0)), 6).alias("ai"))


def pure_clades(counts: DataFrame) -> DataFrame:
    """state, n_tips, largest: tips of a state and the size of its largest clade without another state."""
    total = F.sum("n").over(Window.partitionBy("node"))
    rows = counts.withColumn("total", total)
    return rows.groupBy("state").agg(F.max("n").alias("n_tips"), F.max(F.when(F.col("n") == F.col("total"), F.col("n"))).alias("largest"))


def parsimony_score(nodes: DataFrame, depths: DataFrame, tip_masks: DataFrame) -> DataFrame:
    """One row: score, the least number of state changes on a binary tree (Fitch), level by level from the tips.

    Masks have one bit per state. A node's mask is the intersection of its
    children's if it isn't empty, else their union, which costs one change.
    """
    rows = checkpointed(nodes.join(depths.select("node", "level"), "node").join(tip_masks, "node", "left").select("node", "parent", "level", "mask"))
    deepest = rows.agg(F.max("level")).first()[0] or 0
    done = rows.where(F.col("level") == deepest).select("parent", "mask", F.lit(0).cast("long").alias("cost"))
    done = done.where("mask is not null")
    for level in range(deepest - 1, -1, -1):
        agg = done.groupBy("parent").agg(F.bit_and("mask").alias("both"), F.bit_or("mask").alias("any"), F.sum("cost").alias("cost"))
        here = rows.where(F.col("level") == level).join(agg.withColumnRenamed("parent", "up"), F.col("node") == F.col("up"), "left")
        mask = F.when(F.col("up").isNull(), F.col("mask")).when(F.col("both") != 0, F.col("both")).otherwise(F.col("any"))
        cost = F.coalesce("cost", F.lit(0)) + F.when(F.col("both") == 0, 1).otherwise(0)
        done = checkpointed(here.select("parent", mask.alias("mask"), cost.alias("cost")).where("mask is not null"))
    return done.agg(F.coalesce(F.sum("cost"), F.lit(0)).alias("score"))


def transitions(nodes: DataFrame, depths: DataFrame, tip_nodes: DataFrame, most_recent: float) -> DataFrame:
    """parent_state, state, year, length, terminal: branches whose ends differ in state.

    year is that of the branch's middle, counted back from ``most_recent`` at the deepest node.
    """
    deepest = depths.agg(F.max("depth")).first()[0] or 0.0
    child = nodes.join(depths.select("node", "depth"), "node").join(tip_nodes.select("node", F.lit(True).alias("tip")), "node", "left")
    parent = nodes.select(F.col("node").alias("p"), F.col("state").alias("parent_state"))
    rows = child.join(parent, F.col("parent") == F.col("p")).where("state <> parent_state")
    year = F.lit(most_recent) - (F.lit(deepest) - F.col("depth")) - F.col("length") / 2
    return rows.select("parent_state", "state", F.round(year, 6).alias("year"), "length", F.coalesce("tip", F.lit(False)).alias("terminal"))


def transition_summary(rows: DataFrame, recent: float = 0.0) -> DataFrame:
    """parent_state, state, n, share, median_year, iqr, terminal_share, deep_share of transitions."""
    q = F.percentile("year", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)))
    out = rows.groupBy("parent_state", "state").agg(F.count(F.lit(1)).alias("n"), q.alias("q"), F.avg(F.col("terminal").cast("int")).alias("t"), F.avg((F.col("year") < recent).cast("int")).alias("d"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy())
    return out.select("parent_state", "state", "n", F.round(share, 6).alias("share"), F.round(F.col("q")[1], 6).alias("median_year"), F.round(F.col("q")[2] - F.col("q")[0], 6).alias("iqr"), F.round("t", 6).alias("terminal_share"), F.round("d", 6).alias("deep_share"))


def relabelled(tip_states: DataFrame, replicates: int) -> DataFrame:
    """node, state, rep: the known states (rep 0) and as given to each other in an order of md5 in every replicate."""
    known = tip_states.where("state is not null").select("node", "state")
    reps = known.select("node", "state", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("rep"))
    salt = lambda s: F.concat_ws("|", F.lit(s), F.col("rep").cast("string"), F.col("node").cast("string"))
    places = md5_rank(reps, ["rep"], salt("a"), "r").select("rep", "r", "node")
    given = md5_rank(reps, ["rep"], salt("b"), "r").select("rep", "r", "state")
    return checkpointed(known.select("node", "state", F.lit(0).alias("rep")).unionByName(places.join(given, ["rep", "r"]).select("node", "state", "rep")))


def trait_signal(closure: DataFrame, tip_states: DataFrame, replicates: int = 19, alpha: float = 0.05) -> DataFrame:
    """One row: n_tips, ai, null_mean, p, verdict of the association of states with the tree.

    A replicate gives the tips each other's states in an order of md5; one
    relabelling holds for the whole tree. p is (replicates with an index as low
    + 1) / (replicates + 1); ``pass`` if it is at most ``alpha``. Closure rows
    meet all replicates of a tip at once and are counted by node and state.
    """
    known = tip_states.where("state is not null").select("node", "state")
    labelled = relabelled(tip_states, replicates)
    inner = closure.where("hops > 0").select("node", F.col("ancestor").alias("clade"))
    counts = inner.join(labelled, "node").groupBy("rep", "clade", "state").agg(F.count(F.lit(1)).alias("n"))
    per_clade = counts.groupBy("rep", "clade").agg(F.max("n").alias("top"), F.sum("n").alias("n"))
    weight = F.when(F.col("n") > 1024, 0.0).otherwise((1 - F.col("top") / F.col("n")) / F.pow(F.lit(2.0), F.col("n") - 1))
    index = per_clade.groupBy("rep").agg(F.round(F.sum(weight), 6).alias("ai"))
    real, null = F.max(F.when(F.col("rep") == 0, F.col("ai"))).over(Window.partitionBy()), F.col("rep") > 0
    index = index.withColumn("real", real)
    out = index.agg(F.max("real").alias("ai"), F.round(F.avg(F.when(null, F.col("ai"))), 6).alias("null_mean"), ((F.count_if(null & (F.col("ai") <= F.col("real"))) + 1) / (F.count_if(null) + 1)).alias("p"))
    tips_n = known.agg(F.count(F.lit(1)).alias("n_tips"), F.lit(1).alias("k"))
    return out.withColumn("k", F.lit(1)).join(F.broadcast(tips_n), "k").select("n_tips", "ai", "null_mean", F.round("p", 6).alias("p"), F.when(F.col("p") <= alpha, "pass").otherwise("fail").alias("verdict"))


def parsimony_scores(nodes: DataFrame, depths: DataFrame, labelled: DataFrame) -> DataFrame:
    """rep, score: the parsimony score of each replicate in ``labelled`` (node, rep, mask); tips without a mask fit any state."""
    rows = checkpointed(nodes.select("node", "parent").join(depths.select("node", "level"), "node"))
    masks = checkpointed(rows.join(labelled, "node").select("parent", "level", "rep", "mask", F.lit(0).cast("long").alias("cost")))
    done = None
    for level in range(rows.agg(F.max("level")).first()[0] or 0, -1, -1):
        here = masks.where(F.col("level") == level).drop("level")
        if done is not None:
            agg = done.groupBy(F.col("parent").alias("node"), "rep").agg(F.bit_and("mask").alias("both"), F.bit_or("mask").alias("any"), F.sum("cost").alias("cost"))
            mask, cost = F.when(F.col("both") != 0, F.col("both")).otherwise(F.col("any")), F.col("cost") + F.when(F.col("both") == 0, 1).otherwise(0)
            here = here.unionByName(agg.join(rows.where(F.col("level") == level), "node").select("parent", "rep", mask.alias("mask"), cost.alias("cost")))
        done = checkpointed(here)
    return done.groupBy("rep").agg(F.sum("cost").alias("score"))


def tree_bytes(nodes: DataFrame, codes: DataFrame) -> DataFrame:
    """One row: fan, code, roots of a whole tree, compressed: children and state (-1 if none) of nodes by level, those of one parent together.

    Levels follow from the fans, as the children of a level are the next one, in
    order. Nodes whose parent is missing are roots of their own.
    """

    def lay(table):
        import numpy as np
        import pyarrow as pa

        ids = table["node"].to_numpy()
        by_id = np.argsort(ids, kind="stable")
        ids, code = ids[by_id], table["code"].to_numpy().astype(np.int8)[by_id]
        parent, rooted = table["parent"].fill_null(0).to_numpy()[by_id], table["parent"].is_null().to_numpy()[by_id]
        up = np.minimum(np.searchsorted(ids, parent), len(ids) - 1)
        up = np.where(~rooted & (ids[up] == parent), up, -1)
        below = np.argsort(up, kind="stable")
        fan = np.bincount(up[up >= 0], minlength=len(ids))
        level = below[: (up < 0).sum()]
        first = np.cumsum(fan) - fan + len(level)
        order, roots = [level], len(level)
        while len(level := level[fan[level] > 0]):
            n = fan[level]
            level = below[np.repeat(first[level] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            order.append(level)
        order = np.concatenate(order)
        if len(order) < len(ids):
            raise ValueError("nodes hang below themselves")
        fan, code = fan[order], np.where(fan[order] > 0, -1, code[order])
        row = {"fan": zlib.compress(fan.astype(np.int32).tobytes(), 1), "code": zlib.compress(code.astype(np.int8).tobytes(), 1), "roots": roots}
        return pa.table({"fan": pa.array([row["fan"]], pa.binary()), "code": pa.array([row["code"]], pa.binary()), "roots": pa.array([roots], pa.int64())})

    rows = nodes.select(F.col("node").cast("long").alias("node"), F.col("parent").cast("long").alias("parent")).join(codes, "node", "left")
    rows = rows.select(F.lit(1).alias("k"), "node", "parent", F.coalesce("code", F.lit(-1)).cast("int").alias("code"))
    return rows.groupBy("k").applyInArrow(lay, "fan binary, code binary, roots long")


class _Levels:
    """A tree of ``tree_bytes`` as arrays by level, from which statistics of any labelling follow level by level."""

    def __init__(self, fan, code, roots: int, n_states: int) -> None:
        import numpy as np

        self.np, self.n_states = np, n_states
        self.kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if n_states <= 8 * np.dtype(t).itemsize)
        self.labels = code[code >= 0].astype(np.uint8)
        bounds = [0, roots]
        while (n := int(fan[bounds[-2] : bounds[-1]].sum())) > 0:
            bounds.append(bounds[-1] + n)
        self.levels, sizes, label = [], None, len(self.labels)
        for start, stop in reversed(list(zip(bounds, bounds[1:]))):
            f, tips = fan[start:stop], np.flatnonzero(code[start:stop] >= 0)
            inner = np.flatnonzero(f > 0)
            own = np.zeros(stop - start, np.int64)
            own[tips] = 1
            steps, cuts = [], None
            if len(inner):
                kids = f[inner]
                cuts = np.cumsum(kids) - kids
                own[inner] = np.add.reduceat(sizes, cuts)
                if kids.max() <= 16:  # else children are many, and summed up by segments
                    steps = [(self._slice(at := np.flatnonzero(kids > k)), self._slice(cuts[at] + k)) for k in range(int(kids.max()))]
            n = own[inner]
            weight = np.where((n > 0) & (n <= 1024), np.exp2(1.0 - np.minimum(n, 1025)), 0.0)
            self.levels.append((stop - start, self._slice(tips), slice(label - len(tips), label), self._slice(inner), len(inner), steps, cuts, np.maximum(n, 1).astype(np.float64), weight, n))
            label, sizes = label - len(tips), own

    def _slice(self, at):
        """Places at equal distances as a slice, which numpy reads faster."""
        if len(at) and (len(at) == 1 or (self.np.diff(at) == at[1] - at[0]).all()):
            step = int(at[1] - at[0]) if len(at) > 1 else 1
            return slice(int(at[0]), int(at[-1]) + 1, step)
        return at

    def _sum(self, op, rows, steps, cuts):
        if not steps:
            return op.reduceat(rows, cuts, axis=-1)
        out = rows[..., steps[0][1]].copy()
        for to, at in steps[1:]:
            out[..., to] = op(out[..., to], rows[..., at])
        return out

    def sums(self, labels) -> list[float]:
        """AI, PS and the largest pure clade of each state under the labels of the labelled tips."""
        np, one = self.np, self.kind(1)
        full = ~self.kind(0)
        ai, cost, pure = 0.0, 0, (np.bincount(labels, minlength=self.n_states) > 0).astype(np.int64)
        counts = masks = unions = None
        for size, tips, mine, inner, n_inner, steps, cuts, n, weight, whole in self.levels:
            own = labels[mine]
            c, m, u = np.zeros((self.n_states, size), np.uint16), np.zeros(size, self.kind), np.zeros(size, self.kind)
            if len(own):
                c[:, tips] = own == np.arange(self.n_states, dtype=np.uint8)[:, None]
                m[tips] = u[tips] = np.left_shift(one, own.astype(self.kind))
            if n_inner:
                below = self._sum(np.add, counts, steps, cuts)
                c[:, inner] = below
                ai += float(((1 - below.max(0) / n) * weight).sum())
                any_of = self._sum(np.bitwise_or, masks, steps, cuts)
                both = self._sum(np.bitwise_and, np.where(masks == 0, full, masks), steps, cuts) & any_of
                cost += int(((both == 0) & (any_of != 0)).sum())
                m[inner] = np.where(both != 0, both, any_of)
                union = self._sum(np.bitwise_or, unions, steps, cuts)
                u[inner] = union
                sole = np.flatnonzero((union & (union - one)) == 0)
                for s in range(self.n_states):
                    here = whole[sole[union[sole] == one << self.kind(s)]]
                    pure[s] = max(pure[s], here.max(initial=0))
            counts, masks, unions = c, m, u
        return [ai, float(cost), *map(float, pure)]


def array_values(nodes: DataFrame, known: DataFrame, states: list, replicates: int, seed: int) -> DataFrame:
    """rep, statistic, state, x of ``trait_verdict``: each task has the whole tree and some of the relabellings, so no row is repeated by replicate.

    A relabelling is a random order of the states of the labelled tips by seed and
    replicate, the same whatever the order of rows.
    """
    code = F.coalesce(*(F.when(F.col("state") == s, F.lit(k)) for k, s in enumerate(states)), F.lit(-1))
    parts = min(PARTS, replicates + 1)
    n_states = len(states)

    def relabel(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                tree = _Levels(np.frombuffer(zlib.decompress(row["fan"]), np.int32), np.frombuffer(zlib.decompress(row["code"]), np.int8), row["roots"], n_states)
                for rep in range(row["part"], replicates + 1, parts):
                    found = tree.sums(np.random.default_rng([seed, rep]).permutation(tree.labels) if rep else tree.labels)
                    yield pa.record_batch({"rep": pa.array([rep], pa.int32()), "x": pa.array([found], pa.list_(pa.float64()))})

    tree = tree_bytes(nodes, known.select(F.col("node").cast("long").alias("node"), code.alias("code")))
    dealt = tree.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartition(parts)
    names = F.array(*(F.struct(F.lit(a).alias("statistic"), F.lit(s).cast("string").alias("state")) for a, s in (("AI", None), ("PS", None), *(("MC", str(s)) for s in states))))
    rows = dealt.mapInArrow(relabel, "rep int, x array<double>").select("rep", F.explode(F.arrays_zip(names.alias("name"), F.col("x").alias("x"))).alias("z"))
    return rows.select("rep", "z.name.statistic", "z.name.state", "z.x")


def joined_values(nodes: DataFrame, closure: DataFrame, known: DataFrame, replicates: int) -> DataFrame:
    """rep, statistic, state, x of ``trait_verdict`` for a tree of any size: closure rows meet all relabellings of a tip."""
    bits = known.select("state").distinct().select("state", (F.row_number().over(Window.orderBy("state")) - 1).alias("r")).select("state", F.expr("shiftleft(1L, r)").alias("mask"))
    labelled = relabelled(known, replicates)
    counts = closure.select("node", F.col("ancestor").alias("clade")).join(labelled, "node").groupBy("rep", "clade", "state").agg(F.count(F.lit(1)).alias("n"))
    clades = checkpointed(counts.groupBy("rep", "clade").agg(F.max(F.struct("n", "state")).alias("top"), F.sum("n").alias("n")))
    weight = F.when(F.col("n") > 1024, 0.0).otherwise((1 - F.col("top.n") / F.col("n")) / F.pow(F.lit(2.0), F.col("n") - 1))
    ai = clades.groupBy("rep").agg(F.round(F.sum(weight), 9).alias("x")).select("rep", F.lit("AI").alias("statistic"), F.lit(None).cast("string").alias("state"), "x")
    mc = clades.where("top.n = n").groupBy("rep", F.col("top.state").alias("state")).agg(F.max("n").cast("double").alias("x")).select("rep", F.lit("MC").alias("statistic"), F.col("state").cast("string").alias("state"), "x")
    scores = parsimony_scores(nodes, node_depths(closure), labelled.join(F.broadcast(bits), "state").select("node", "rep", "mask"))
    ps = scores.select("rep", F.lit("PS").alias("statistic"), F.lit(None).cast("string").alias("state"), F.col("score").cast("double").alias("x"))
    return ai.unionAll(ps).unionAll(mc)


def trait_verdict(nodes: DataFrame, closure: DataFrame | None, tip_states: DataFrame, replicates: int = 1000, alpha: float = 0.05, seed: int = 12345, nodes_a_task: int = NODES_A_TASK) -> DataFrame:
    """One row per statistic: observed, null_mean, null_lo, null_hi, p, n_tips, thin, verdict of the association of states with the tree.

    Statistics are the association index (AI), the parsimony score (PS) and the
    largest pure clade of each state (MC, with the state), all from the same
    relabellings; null_lo and null_hi are their 2.5 and 97.5 percentiles. p is
    (replicates at least as extreme + 1) / (replicates + 1): low AI and PS, high
    MC. ``pass`` if AI, PS and at least one MC are below ``alpha``, ``weak`` if AI or PS
    is, else ``fail``. ``thin``: under 20 tips, or under 5 of the state. States
    have one bit each, so there are at most 63. A tree with whole-number nodes that
    fits a task is relabelled in arrays; a larger one by joins with ``closure``,
    which is made then if it isn't given.
    """
    known = checkpointed(tip_states.where("state is not null").select("node", "state"))
    states = sorted(r.state for r in known.select("state").distinct().collect())
    n = nodes.count()
    if states and dict(nodes.dtypes)["node"] in ("tinyint", "smallint", "int", "bigint") and n <= nodes_a_task and n * len(states) <= CELLS_A_TASK:
        values = array_values(nodes, known, states, replicates, seed)
    else:
        values = joined_values(nodes, ancestors(nodes) if closure is None else closure, known, replicates)
    return trait_report(checkpointed(values), known, alpha)


def trait_report(values: DataFrame, known: DataFrame, alpha: float) -> DataFrame:
    """The rows of ``trait_verdict`` from values (rep, statistic, state, x; rep 0 is real) and the known states of tips.

    AI and PS are rounded to nine digits before they are compared, as sums differ in their last digit by their order.
    """
    values = values.withColumn("x", F.round("x", 9))
    real = values.where("rep = 0").select(F.col("statistic").alias("s"), F.col("state").alias("t"), F.col("x").alias("observed"))
    null = values.where("rep > 0").join(F.broadcast(real), F.col("statistic").eqNullSafe(F.col("s")) & F.col("state").eqNullSafe(F.col("t")))
    extreme = F.when(F.col("statistic") == "MC", F.col("x") >= F.col("observed")).otherwise(F.col("x") <= F.col("observed"))
    ends = F.percentile("x", F.array(F.lit(0.025), F.lit(0.975)))
    out = null.groupBy("statistic", "state").agg(F.max("observed").alias("observed"), F.avg("x").alias("null_mean"), ends.alias("e"), ((F.count_if(extreme) + 1) / (F.count(F.lit(1)) + 1)).alias("p"))
    sizes = known.groupBy(F.col("state").cast("string").alias("t")).agg(F.count(F.lit(1)).alias("k"))
    whole = Window.partitionBy()
    hit = lambda name: F.coalesce(F.max(F.when(F.col("statistic") == name, F.col("p") < alpha)).over(whole), F.lit(False))
    out = out.join(F.broadcast(sizes), F.col("state") == F.col("t"), "left").withColumn("n_tips", F.coalesce("k", F.sum("k").over(whole)))
    verdict = F.when(hit("AI") & hit("PS") & hit("MC"), "pass").when(hit("AI") | hit("PS"), "weak").otherwise("fail")
    thin = F.col("n_tips") < F.when(F.col("statistic") == "MC", 5).otherwise(20)
    return out.select("statistic", "state", *(F.round(c, 6).alias(n) for c, n in ((F.col("observed"), "observed"), (F.col("null_mean"), "null_mean"), (F.col("e")[0], "null_lo"), (F.col("e")[1], "null_hi"), (F.col("p"), "p"))), "n_tips", thin.alias("thin"), verdict.alias("verdict"))
