"""Gradient boosting on histograms, with missing values in a bin of their own.

Values are cut once into at most 255 bins per input at exact ranks, and a missing value is bin 255. A tree
grows level by level: every task adds up gradients, curvatures and rows per (node, input, bin) of its rows,
one shuffle adds the tasks' cells, and the splits are searched where the cells of an input lie, so one row per
node and task reaches the driver. A split tries the missing rows on both sides and keeps the better one as its
default side; without missing rows in training they go where more rows go.

Gradients are rounded to integers (24 bits after the point), whose sums don't depend on order: a task that
runs again, another partitioning or a recovered executor give the same trees.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldloom.operators.longform import values
from yieldloom.operators.ranking import prefix_sums, ranges_for
from yieldloom.sources.workspace import forget, new_folder

BINS = 255
MISSING = 255
SCALE = float(1 << 24)
# A child's curvature below this makes its value unstable.
LEAST_CURVATURE = 1e-3
# Trees after which the rows' scores are written down; in between, tasks apply the newer trees on the fly.
TREES_PER_STATE = 10
# Bytes of cells that a task may hold; a level with more nodes takes several passes.
CELL_BYTES = 1 << 28
NODES = "tree int, node int, feature int, cut double, missing_below boolean, below int, above int, value double, gain double, rows long"


@dataclass(frozen=True)
class Settings:
    rounds: int = 200
    max_depth: int = 6
    max_leaves: int = 31
    step: float = 0.1
    min_leaf: int = 20
    l2: float = 0.0


@dataclass
class Tree:
    """One tree as parallel lists; node 0 is the root, `feature` is -1 in a leaf, and a value goes below if its
    bin is <= `bin`, or to the side `missing_below` names if it is missing."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [-1])
    missing_below: list[bool] = field(default_factory=lambda: [False])
    below: list[int] = field(default_factory=lambda: [-1])
    above: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    rows: list[int] = field(default_factory=lambda: [0])

    def add(self, value: float, rows: int) -> int:
        for column, v in ((self.feature, -1), (self.bin, -1), (self.missing_below, False), (self.below, -1), (self.above, -1), (self.value, value), (self.gain, 0.0), (self.rows, rows)):
            column.append(v)
        return len(self.feature) - 1

    def leaf_of(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row of binned inputs ends in."""
        feature, cut, missing_below, below, above = (np.array(c) for c in (self.feature, self.bin, self.missing_below, self.below, self.above))
        at, every = np.zeros(len(bins), dtype=np.int64), np.arange(len(bins))
        while True:
            f = feature[at]
            inner = f >= 0
            if not inner.any():
                return at
            held = bins[every, np.maximum(f, 0)]
            goes_below = np.where(held == MISSING, missing_below[at], held <= cut[at])
            at = np.where(inner, np.where(goes_below, below[at], above[at]), at)


def bin_edges(table: DataFrame, inputs: Sequence[str], bins: int = BINS) -> list[np.ndarray]:
    """Per input the ascending cuts between its bins: midpoints between neighbouring values of different bins.

    An input with at most `bins` different values has a bin per value; otherwise a value's bin is that of its
    exact rank. What reaches the driver is `bins` pairs per input.
    """
    present = values(table, inputs).where(F.col("value").isNotNull())
    counts = present.groupBy("ordinal", "value").agg(F.count("*").alias("n")).withColumn("one", F.lit(1).cast("long"))
    ranked = prefix_sums(counts, ["ordinal"], "value", ["n", "one"], ranges_for(table.sparkSession, len(inputs)), few_groups=True)
    place = F.when(F.col("one_total") <= bins, F.col("one_before")).otherwise(F.floor(F.col("n_before") * bins / F.col("n_total")))
    ends = ranked.groupBy("ordinal", place.alias("bin")).agg(F.min("value").alias("low"), F.max("value").alias("high"))
    held: dict[int, list] = {}
    for r in ends.collect():
        held.setdefault(r.ordinal, []).append((r.low, r.high))
    edges = []
    for i in range(len(inputs)):
        spans = sorted(held.get(i, []))
        edges.append(np.array([(a[1] + b[0]) / 2 for a, b in zip(spans, spans[1:])]))
    return edges


def _matrix(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in columns])


def binned(table: DataFrame, inputs: Sequence[str], edges: list[np.ndarray], base: float) -> DataFrame:
    """(y, raw, bins): the label, the score so far and one byte per input."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, inputs)
            out = np.full(x.shape, MISSING, dtype=np.uint8)
            for i, at in enumerate(edges):
                there = ~np.isnan(x[:, i])
                out[there, i] = np.searchsorted(at, x[there, i], side="left")
            packed = pa.array([row.tobytes() for row in out], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(np.full(len(x), base)), packed], names=["y", "raw", "bins"])

    plain = table.select(F.col("y").cast("int"), *[F.col(f"`{c}`").cast("double") for c in inputs])
    return plain.mapInArrow(cut, "y int, raw double, bins binary")


def _bytes(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, width)


def _advanced(batch: pa.RecordBatch, trees: Sequence[Tree], width: int) -> tuple[np.ndarray, np.ndarray]:
    x = _bytes(batch.column("bins"), width)
    raw = batch.column("raw").to_numpy().copy()
    for tree in trees:
        raw += np.array(tree.value)[tree.leaf_of(x)]
    return x, raw


def advance(state: DataFrame, trees: Sequence[Tree], width: int) -> DataFrame:
    """`state` with the values of `trees` added to the scores."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, raw = _advanced(batch, trees, width)
            yield pa.RecordBatch.from_arrays([batch.column("y"), pa.array(raw), batch.column("bins")], names=["y", "raw", "bins"])

    return state.mapInArrow(add, state.schema)


def histograms(state: DataFrame, newer: Sequence[Tree], tree: Tree, wanted: Sequence[int], width: int) -> DataFrame:
    """(node, feature, bin, g, h, n) of the rows that lie in the `wanted` nodes of `tree`, a row per task and cell."""
    size = len(wanted) * width * (BINS + 1)

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros((3, size))
        slots = np.full(len(tree.feature), -1)
        slots[list(wanted)] = np.arange(len(wanted))
        for batch in batches:
            x, raw = _advanced(batch, newer, width)
            slot = slots[tree.leaf_of(x)]
            held = np.flatnonzero(slot >= 0)
            p = 1.0 / (1.0 + np.exp(-raw[held]))
            g = np.rint((p - batch.column("y").to_numpy()[held]) * SCALE)
            h = np.rint(p * (1.0 - p) * SCALE)
            cell = ((slot[held, None] * width + np.arange(width)) * (BINS + 1) + x[held]).ravel()
            for row, weight in zip(cells, (np.repeat(g, width), np.repeat(h, width), None)):
                row += np.bincount(cell, weight, minlength=size)
        at = np.flatnonzero(cells[2])
        node = np.array(wanted, dtype=np.int32)[at // (width * (BINS + 1))]
        feature, place = (at // (BINS + 1)) % width, at % (BINS + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(node), pa.array(feature.astype(np.int32)), pa.array(place.astype(np.int32)), *[pa.array(row[at].astype(np.int64)) for row in cells]],
            names=["node", "feature", "bin", "g", "h", "n"],
        )

    return state.mapInArrow(accumulate, "node int, feature int, bin int, g long, h long, n long")


SPLITS = "node int, feature int, bin int, missing_below boolean, gain double, " + ", ".join(f"{s}_{c} long" for s in ("all", "below", "above") for c in "ghn")


def best_splits(cells: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per node and task the best split among the inputs dealt to that task, with the sums on both sides.

    All cells of a (node, input) lie in one task, at most bins rows from each task before. Equal gains take
    the first input, then the first cut, then missing rows above; splits without a gain are left out.
    """
    ridge = settings.l2 * SCALE

    def strength(sums: np.ndarray) -> np.ndarray:
        g, h = sums[0].astype(float), sums[1]
        return g * g / np.where(h + ridge > 0, (h + ridge) * SCALE, np.inf)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if dealt is None:
            return
        held = [dealt.column(c).to_numpy() for c in ("node", "feature", "bin", "g", "h", "n")]
        node, feature, place = (c.astype(np.int64) for c in held[:3])
        keys, slot = np.unique(node << 32 | feature, return_inverse=True)
        sums = np.zeros((3, len(keys), BINS + 1), dtype=np.int64)
        for row, amounts in zip(sums, held[3:]):
            np.add.at(row, (slot, place), amounts)
        whole, gap = sums.sum(axis=2, keepdims=True), sums[:, :, MISSING:]
        low = np.cumsum(sums[:, :, :MISSING], axis=2)
        # both sides for the missing rows, the one above first; the last cut parts them from all others
        below = np.stack([low, low + gap], axis=3)
        above = whole[..., None] - below
        gain = strength(below) + strength(above) - strength(whole[..., None])
        allowed = (np.minimum(below[2], above[2]) >= settings.min_leaf) & (np.minimum(below[1], above[1]) >= LEAST_CURVATURE * SCALE)
        # a bin without rows cuts where the one before it does
        allowed &= (sums[2, :, :MISSING] > 0)[:, :, None]
        lacks = gap[2, :, 0] > 0
        allowed[~lacks, :, 1] = False
        gain = np.where(allowed, gain, 0.0).reshape(len(keys), -1)
        best = gain.argmax(axis=1)
        cut, side = best // 2, best % 2
        every = np.arange(len(keys))
        found, nodes = gain[every, best], keys >> 32
        # keys ascend by node, then input
        order = np.lexsort((every, -found, nodes))
        first = order[np.unique(nodes[order], return_index=True)[1]]
        first = first[found[first] > 0]
        cut, side = cut[first], side[first]
        totals, lows, highs = whole[:, first, 0], below[:, first, cut, side], above[:, first, cut, side]
        default = np.where(lacks[first], side == 1, lows[2] > highs[2])
        columns = [nodes[first].astype(np.int32), (keys[first] & 0xFFFFFFFF).astype(np.int32), cut.astype(np.int32), default, found[first], *totals, *lows, *highs]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[c.split()[0] for c in SPLITS.split(", ")])

    return cells.repartition("node", "feature").mapInArrow(search, SPLITS)


def _preference(split: Any) -> tuple:
    return split.gain, -split.feature, -split.bin, not split.missing_below


def _pruned(tree: Tree, most: int) -> Tree:
    """`tree` with its splits taken in order of gain until it has `most` leaves: what growing best-first gives."""
    kept, leaves, waiting = set(), 1, [(-tree.gain[0], 0)] if tree.feature[0] >= 0 else []
    while waiting and leaves < most:
        _, node = heapq.heappop(waiting)
        kept.add(node)
        leaves += 1
        for child in (tree.below[node], tree.above[node]):
            if tree.feature[child] >= 0:
                heapq.heappush(waiting, (-tree.gain[child], child))
    for node in range(len(tree.feature)):
        if node not in kept:
            tree.feature[node] = -1
    return tree


def grow_tree(state: DataFrame, newer: Sequence[Tree], width: int, settings: Settings) -> Tree:
    """The next tree for rows scored by `state` and the `newer` trees. One aggregate per level."""
    tree = Tree()
    level = [0]
    group = max(1, CELL_BYTES // (width * (BINS + 1) * 24))

    def value(g: int, h: int) -> float:
        return -settings.step * (g / SCALE) / (h / SCALE + settings.l2 + 1e-15)

    for _ in range(settings.max_depth):
        wanted = [v for v in level if v == 0 or tree.rows[v] >= 2 * settings.min_leaf]
        level = []
        for start in range(0, len(wanted), group):
            cells = histograms(state, newer, tree, wanted[start : start + group], width)
            # a row per node and task
            found: dict[int, Any] = {}
            for r in best_splits(cells, settings).collect():
                if r.node not in found or _preference(r) > _preference(found[r.node]):
                    found[r.node] = r
            for v, r in sorted(found.items()):
                tree.rows[v] = r.all_n
                tree.feature[v], tree.bin[v], tree.missing_below[v], tree.gain[v] = r.feature, r.bin, r.missing_below, r.gain
                tree.below[v] = tree.add(value(r.below_g, r.below_h), r.below_n)
                tree.above[v] = tree.add(value(r.above_g, r.above_h), r.above_n)
                level += [tree.below[v], tree.above[v]]
        if not level:
            break
    return _pruned(tree, settings.max_leaves)


def fit_boosting(table: DataFrame, inputs: Sequence[str], settings: Settings = Settings()) -> tuple[float, DataFrame]:
    """The base score (log odds of a fail) and the trees as rows of NODES, from (y, inputs) rows that may lack values.

    Only nodes that the root leads to are rows, numbered as they were grown.
    """
    spark = table.sparkSession
    n, fails = table.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).head()
    if n == 0:
        raise ValueError("no rows to fit")
    share = min(max(fails / n, 1e-9), 1 - 1e-9)
    base = float(np.log(share / (1 - share)))
    edges = bin_edges(table, inputs)
    width = len(inputs)

    def written(df: DataFrame) -> tuple[DataFrame, str]:
        folder = new_folder(spark, "boosting")
        df.write.parquet(folder)
        return spark.read.schema(df.schema).parquet(folder), folder

    state, folder = written(binned(table, inputs, edges, base))
    trees: list[Tree] = []
    newer: list[Tree] = []
    for _ in range(settings.rounds):
        tree = grow_tree(state, newer, width, settings)
        if tree.feature[0] < 0:
            # nothing to gain for this state of the scores, nor for any later tree
            break
        trees.append(tree)
        newer.append(tree)
        if len(newer) == TREES_PER_STATE:
            old = folder
            state, folder = written(advance(state, newer, width))
            forget(spark, old)
            newer = []
    forget(spark, folder)

    rows = []
    for number, tree in enumerate(trees):
        reached = [0]
        for v in reached:
            f = tree.feature[v]
            # bins end with the last cut; a split behind it parts the missing rows from all others
            cut = None if f < 0 else float(edges[f][tree.bin[v]]) if tree.bin[v] < len(edges[f]) else float("inf")
            inner = f >= 0
            rows.append((number, v, f, cut, bool(tree.missing_below[v]), tree.below[v] if inner else -1, tree.above[v] if inner else -1, float(tree.value[v]), float(tree.gain[v]) if inner else 0.0, int(tree.rows[v])))
            if inner:
                reached += [tree.below[v], tree.above[v]]
    return base, spark.createDataFrame(rows, NODES)


def score_boosting(table: DataFrame, inputs: Sequence[str], nodes: DataFrame, base: float, entity: str = "entity_id") -> DataFrame:
    """(id, risk): the probability of a fail. The trees (rounds x 2 x leaves rows) travel to the tasks."""
    grown: dict[int, list] = {}
    for r in nodes.orderBy("tree", "node").collect():
        grown.setdefault(r.tree, []).append(r)
    packed = []
    for rows in grown.values():
        place = {r.node: i for i, r in enumerate(rows)}
        packed.append(
            tuple(
                np.array(c)
                for c in zip(*[(r.feature, np.inf if r.cut is None else r.cut, r.missing_below, place.get(r.below, -1), place.get(r.above, -1), r.value) for r in rows])
            )
        )
    id_type = dict(table.dtypes)[entity]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch, inputs)
            raw, every = np.full(len(x), base), np.arange(len(x))
            for feature, cut, missing_below, below, above, value in packed:
                at = np.zeros(len(x), dtype=np.int64)
                while (inner := feature[at] >= 0).any():
                    held = x[every, np.maximum(feature[at], 0)]
                    goes_below = np.where(np.isnan(held), missing_below[at], held <= cut[at])
                    at = np.where(inner, np.where(goes_below, below[at], above[at]), at)
                raw += value[at]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(1.0 / (1.0 + np.exp(-raw)))], names=["id", "risk"])

    plain = table.select(F.col(entity).alias("id"), *[F.col(f"`{c}`").cast("double") for c in inputs])
    return plain.mapInArrow(walk, f"id {id_type}, risk double").withColumnRenamed("id", entity)
