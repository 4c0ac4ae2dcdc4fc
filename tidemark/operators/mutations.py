"""Characters of inner nodes by parsimony, and the changes on branches.

Every (node, column) has a mask of the characters it may have: for tips one bit,
for inner nodes the intersection of their children's masks if it isn't empty,
else their union; uncertain tips are left out. From the root down a node keeps
its parent's character if it may, else takes the alphabetically least.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import checkpointed

BASES = "ACGT"


def base_masks(cells: DataFrame) -> DataFrame:
    """node, col, mask of cells (node, col, base); characters other than A, C, G and T have none."""
    place = F.instr(F.lit(BASES), F.col("base"))
    return cells.where(place > 0).select("node", "col", F.pow(F.lit(2), place - 1).cast("int").alias("mask"))


def branch_changes(nodes: DataFrame, levels: DataFrame, masks: DataFrame) -> DataFrame:
    """node, col, from_base, to_base: changes between a node and its parent.

    ``nodes`` has node and parent, ``levels`` node and level (edges from the
    root), ``masks`` those of the tips. One join up and one down per level.
    """
    tree = checkpointed(nodes.select("node", "parent").join(levels.select("node", "level"), "node"))
    deepest = tree.agg(F.max("level")).first()[0] or 0
    up = [None] * (deepest + 1)
    for level in range(deepest, -1, -1):
        here = tree.where(F.col("level") == level).select("node", "parent")
        own = here.join(masks, "node").select("node", "parent", "col", "mask")
        if level < deepest:
            kids = up[level + 1].groupBy(F.col("parent").alias("node"), "col").agg(F.bit_and("mask").alias("both"), F.bit_or("mask").alias("any"))
            own = own.unionAll(here.join(kids, "node").select("node", "parent", "col", F.when(F.col("both") != 0, F.col("both")).otherwise(F.col("any")).alias("mask")))
        up[level] = checkpointed(own)
    least = F.coalesce(*(F.when(F.col("mask").bitwiseAND(1 << k) != 0, F.lit(1 << k)) for k in range(len(BASES))))
    state = checkpointed(up[0].select("node", "col", least.alias("state")))
    changes = []
    for level in range(1, deepest + 1):
        above = state.withColumnsRenamed({"node": "parent", "state": "parent_state"})
        keep = F.col("mask").bitwiseAND(F.col("parent_state")) != 0
        joined = up[level].join(above, ["parent", "col"], "left")
        below = checkpointed(joined.select("node", "col", "parent_state", F.when(keep, F.col("parent_state")).otherwise(least).alias("state")))
        changes.append(below.where("parent_state is not null and state <> parent_state"))
        state = below.select("node", "col", "state")
    name = lambda c: F.substring(F.lit(BASES), (F.log2(F.col(c)) + 1).cast("int"), F.lit(1))
    out = changes[0] if changes else state.select("node", "col", F.col("state").alias("parent_state"), "state").where("false")
    for more in changes[1:]:
        out = out.unionByName(more)
    return out.select("node", "col", name("parent_state").alias("from_base"), name("state").alias("to_base"))


#: Levels of a tree that one block spans, and rows of a block, or of blocks below one, up to which it is taken in a task.
LEVELS_A_BLOCK = 11
ROWS_A_BLOCK = 50_000
ROWS_A_GROUP = 10_000
_ROW = "node long, parent long, level int, top long, above long, masks binary, state binary"


def packed_masks(rows: DataFrame) -> DataFrame:
    """node, masks of alignment rows (name, seq): a byte for each column as in ``base_masks`` (0 for none), compressed."""
    table = bytes(1 << BASES.index(chr(k)) if chr(k) in BASES else 0 for k in range(256))

    @F.pandas_udf("binary")
    def packed(seq: pd.Series) -> pd.Series:
        return seq.map(lambda s: zlib.compress(s.encode("ascii", "replace").translate(table), 1))

    return rows.where("name is not null and seq is not null").select(F.col("name").alias("node"), packed("seq").alias("masks"))


def tree_blocks(nodes: DataFrame, levels: DataFrame, span: int = LEVELS_A_BLOCK) -> DataFrame:
    """node, parent, level, top, above: the tree cut into blocks of ``span`` levels; top is the block's highest node, above that of the parent's block."""
    tree = checkpointed(nodes.select("node", "parent").join(levels.select("node", "level"), "node"))
    here = tree.where(F.col("level") % span == 0).withColumn("top", F.col("node"))
    found = [here]
    for step in range(1, span):
        here = checkpointed(tree.where(F.col("level") % span == step).join(here.select(F.col("node").alias("parent"), "top"), "parent").select(*tree.columns, "top"))
        found.append(here)
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    out = checkpointed(out)
    tops = out.where("node = top").join(out.select(F.col("node").alias("parent"), F.col("top").alias("above")), "parent", "left")
    return out.where("node <> top").withColumn("above", F.col("top")).unionByName(tops.select(*out.columns, "above"))


class _Block:
    """Masks of the nodes of a block from those of its tips and of the blocks below it."""

    def __init__(self, rows: list[dict]) -> None:
        own = {r["node"]: r["masks"] for r in rows if r["masks"] is not None}
        self.nodes = sorted({r["node"]: (r["level"], r["node"], r["parent"]) for r in rows if r["level"] is not None}.values())
        self.masks: dict[int, np.ndarray] = {}
        below: dict[int, list[np.ndarray]] = {}
        for _, node, parent in reversed(self.nodes):
            if node in own:
                mask = np.frombuffer(zlib.decompress(own[node]), np.uint8)
            elif node in below:
                both, any_of = below.pop(node)
                both &= any_of
                mask = np.where(both != 0, both, any_of)
            else:
                continue
            self.masks[node] = mask
            if parent is None:
                continue
            both, any_of = below.get(parent, (np.full(len(mask), 15, np.uint8), np.zeros(len(mask), np.uint8)))
            if len(mask) > len(any_of):
                both, any_of = _longer(both, len(mask), 15), _longer(any_of, len(mask), 0)
            any_of[: len(mask)] |= mask
            both[: len(mask)] &= np.where(mask == 0, np.uint8(15), mask)
            below[parent] = [both, any_of]

    def states(self, top: int, given: bytes | None, counts: np.ndarray) -> tuple[dict[int, np.ndarray], np.ndarray]:
        """State by node, from the given one of the top (else its least), and ``counts`` by column and pair of bases with the changes below the top added."""
        bit = np.zeros(16, np.int64)
        bit[[1, 2, 4, 8]] = range(4)
        out: dict[int, np.ndarray] = {}
        for _, node, parent in self.nodes:
            mask = self.masks.get(node)
            if mask is None:
                continue
            least = mask & (~mask + np.uint8(1))
            if node == top:
                out[node] = least if given is None else np.frombuffer(zlib.decompress(given), np.uint8)
                continue
            above = out.get(parent)
            if above is None:
                continue
            above = _longer(above, len(mask), 0)[: len(mask)]
            state = np.where(mask & above != 0, above, least)
            out[node] = state
            at = np.flatnonzero((state != above) & (state != 0) & (above != 0))
            if len(mask) * 16 > len(counts):
                counts = _longer(counts, max(len(mask) * 16, 2 * len(counts)), 0)
            counts[at * 16 + bit[above[at]] * 4 + bit[state[at]]] += 1
        return out, counts


def _longer(a: np.ndarray, n: int, fill: int) -> np.ndarray:
    return a if len(a) >= n else np.concatenate([a, np.full(n - len(a), fill, a.dtype)])


def _blocks(table) -> list[tuple[int, list[dict]]]:
    """Rows by block; those of blocks below belong to the block above them."""
    rows: dict[int, list[dict]] = {}
    for r in table.to_pylist():
        rows.setdefault(r["at"], []).append(r)
    return list(rows.items())


def _by_block(rows: DataFrame, work, schema: str, groups: int) -> DataFrame:
    """``work`` over groups of blocks: of the rows with a column at, the block's top."""
    # The number of partitions is given, as compressed rows would else be put into few tasks.
    return rows.withColumn("_group", F.pmod(F.xxhash64("at"), F.lit(groups))).repartition(groups, "_group").groupBy("_group").applyInArrow(work, schema)


def change_counts(tree: DataFrame, tips: DataFrame, span: int = LEVELS_A_BLOCK, rows_a_block: int = ROWS_A_BLOCK) -> DataFrame:
    """col, from_base, to_base, n: how many branches change so in a column, as ``branch_changes`` has them one by one.

    ``tree`` is that of ``tree_blocks`` with the same ``span``, ``tips`` has its
    columns and masks of ``packed_masks``. A block is walked in one task, all
    columns at once: first up, which leaves the masks of its top only, then, from
    the root's block down, once more for its states. So texts are sent twice, and
    nothing is kept by node and column. Trees with a block of more rows than
    ``rows_a_block`` go through ``branch_changes``.
    """
    rows = tree.select(*(c.split()[0] for c in _ROW.split(", ")[:5]), F.lit(None).cast("binary").alias("masks"))
    rows = rows.unionByName(tips.select(*rows.columns)).withColumn("state", F.lit(None).cast("binary"))
    sizes = tree.groupBy("top").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"), F.sum("n").alias("all"))
    below = tree.where("node = top and above is not null").groupBy("above").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n"))
    size, most_below = sizes.first(), below.first()["n"] or 0
    if max(size["n"] or 0, most_below) > rows_a_block:
        cells = tips.select("node", F.posexplode(_unpacked("masks")).alias("p", "mask")).where("mask > 0").select("node", (F.col("p") + 1).alias("col"), F.col("mask").cast("int").alias("mask"))
        changes = branch_changes(tree.select("node", "parent"), tree.select("node", "level"), cells)
        return changes.groupBy("col", "from_base", "to_base").agg(F.count(F.lit(1)).alias("n"))
    groups = max(1, -(-(size["all"] or 0) // ROWS_A_GROUP))
    layer = F.floor(F.col("level") / span)
    deepest = tree.agg(F.max(layer)).first()[0] or 0

    def up(table):
        out = []
        for top, part in _blocks(table):
            mask = _Block(part).masks.get(top)
            if mask is not None:
                own = next(r for r in part if r["node"] == top)
                out.append({**{k: own[k] for k in ("node", "parent", "level", "top", "above")}, "masks": zlib.compress(mask.tobytes(), 1), "state": None})
        return pa.Table.from_pylist(out, schema=pa.schema([(k, pa.binary() if t == "binary" else pa.int32() if t == "int" else pa.int64()) for k, t in (c.split() for c in _ROW.split(", "))]))

    def down(table):
        counts, out = np.zeros(16, np.int64), []
        for top, part in _blocks(table):
            given = next((r["state"] for r in part if r["state"] is not None), None)
            block = _Block([r for r in part if r["state"] is None])
            states, counts = block.states(top, given, counts)
            out += [(r["node"], zlib.compress(states[r["node"]].tobytes(), 1)) for r in part if r["top"] != top and r["node"] in states]
        at = np.flatnonzero(counts)
        none = lambda n, t: pa.nulls(n, t)
        return pa.table({
            "node": pa.concat_arrays([pa.array([n for n, _ in out], pa.int64()), none(len(at), pa.int64())]), "state": pa.concat_arrays([pa.array([s for _, s in out], pa.binary()), none(len(at), pa.binary())]),
            "col": pa.concat_arrays([none(len(out), pa.int32()), pa.array(at // 16 + 1, pa.int32())]), "pair": pa.concat_arrays([none(len(out), pa.int32()), pa.array(at % 16, pa.int32())]), "n": pa.concat_arrays([none(len(out), pa.int64()), pa.array(counts[at], pa.int64())]),
        })

    inside = [rows.where(layer == k).withColumn("at", F.col("top")) for k in range(deepest + 1)]
    for k in range(deepest, 0, -1):
        tops = checkpointed(_by_block(inside[k], up, _ROW, groups))
        inside[k - 1] = inside[k - 1].unionByName(tops.where("above is not null").withColumn("at", F.col("above")))
    counts, states = None, None
    for k in range(deepest + 1):
        here = inside[k]
        if states is not None:
            here = here.unionByName(states.select("node", *(F.lit(None).cast(t).alias(c) for c, t in (x.split() for x in _ROW.split(", ")[1:3])), F.col("node").alias("top"), F.lit(None).cast("long").alias("above"), F.lit(None).cast("binary").alias("masks"), "state", F.col("node").alias("at")))
        done = _by_block(here, down, "node long, state binary, col int, pair int, n long", groups)
        done = checkpointed(done) if k < deepest else done
        states, found = done.where("state is not null"), done.where("n is not null").select("col", "pair", "n")
        counts = found if counts is None else counts.unionAll(found)
    base = lambda place: F.substring(F.lit(BASES), place + 1, F.lit(1))
    return counts.groupBy("col", base(F.floor(F.col("pair") / 4).cast("int")).alias("from_base"), base(F.col("pair") % 4).alias("to_base")).agg(F.sum("n").alias("n"))


def _unpacked(column: str):
    @F.pandas_udf("array<int>")
    def unpacked(masks: pd.Series) -> pd.Series:
        return masks.map(lambda m: np.frombuffer(zlib.decompress(m), np.uint8).astype(np.int32))

    return unpacked(column)
