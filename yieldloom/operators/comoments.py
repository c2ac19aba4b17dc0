"""Counts, means, squared deviations and co-deviations of all feature pairs: an aggregate that merges.

The state of a feature pair over the rows where both are present is (n, mean of x, mean of y, deviations of x
and of y, co-deviation). Two states merge without going back to the rows and without a reference value
(Chan, Golub and LeVeque 1979), so nothing is lost far from zero. States travel as square tiles of features,
one packed row per (group, tile pair): every task folds its rows into tiles in one scan, tasks are merged in
two keyed levels, the first dealing about the square root of the number of tasks to a merge, so no merge
holds more than that many tiles. Merges go in a fixed order, so a task that runs again gives the same sums.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PARTS = ("n", "mean_x", "mean_y", "dev_x", "dev_y", "dev_xy")
TILE = 128
# Bytes of tiles that a task may hold; wider tables or more groups take further scans.
TASK_BYTES = 1 << 28
# Rows folded at a time.
LOT = 4_096
PACKED = "group int, a int, b int, state binary"


def merged(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """The state of the rows of both; states are arrays whose first axis is PARTS."""
    n, m = one[0], other[0]
    total = n + m
    share = np.divide(m, total, out=np.zeros_like(total), where=total > 0)
    gap_x, gap_y = other[1] - one[1], other[2] - one[2]
    both = n * share
    return np.stack([
        total,
        one[1] + gap_x * share,
        one[2] + gap_y * share,
        one[3] + other[3] + gap_x * gap_x * both,
        one[4] + other[4] + gap_y * gap_y * both,
        one[5] + other[5] + gap_x * gap_y * both,
    ])


def state_of(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The state of every column of x with every column of y, where NaN is missing."""

    def shifted(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        there = ~np.isnan(v)
        count = there.sum(axis=0)
        middle = np.divide(np.where(there, v, 0.0).sum(axis=0), count, out=np.zeros(v.shape[1]), where=count > 0)
        return there.astype(float), np.where(there, v - middle, 0.0), middle

    (mx, cx, x0), (my, cy, y0) = shifted(x), shifted(y)
    n = mx.T @ my
    if mx.all() and my.all():
        wide, tall = np.ones(y.shape[1]), np.ones(x.shape[1])
        sx, sy = np.outer(cx.sum(axis=0), wide), np.outer(tall, cy.sum(axis=0))
        sxx, syy = np.outer((cx * cx).sum(axis=0), wide), np.outer(tall, (cy * cy).sum(axis=0))
    else:
        sx, sy, sxx, syy = cx.T @ my, mx.T @ cy, (cx * cx).T @ my, mx.T @ (cy * cy)
    safe = np.maximum(n, 1.0)
    return np.stack([
        n,
        np.where(n > 0, x0[:, None] + sx / safe, 0.0),
        np.where(n > 0, y0[None, :] + sy / safe, 0.0),
        np.maximum(sxx - sx * sx / safe, 0.0),
        np.maximum(syy - sy * sy / safe, 0.0),
        cx.T @ cy - sx * sy / safe,
    ])


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)


def pair_states(rows: DataFrame, width: int, groups: int, tile: int = TILE) -> DataFrame:
    """(group, a, b, state): the merged state of tiles a <= b of the features for every group.

    `rows` holds `groups`, an array of the groups 0.. that a row counts in, and `v`, its `width` values, null if missing.
    """
    starts = list(range(0, width, tile))
    pairs = [(a, b) for a in range(len(starts)) for b in range(a, len(starts))]
    size = min(tile, width) ** 2 * len(PARTS) * 8
    at_once = max(1, TASK_BYTES // (size * max(1, groups)))
    scans = [_task_states(rows, width, pairs[i : i + at_once], tile) for i in range(0, len(pairs), at_once)]
    states = scans[0]
    for scan in scans[1:]:
        states = states.unionByName(scan)
    return merged_states(states, ["group", "a", "b"])


def _task_states(rows: DataFrame, width: int, pairs: Sequence[tuple[int, int]], tile: int) -> DataFrame:
    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, LOT):
                part = batch.slice(at, LOT)
                x = _matrix(part.column("v"), width)
                listed = part.column("groups")
                row = np.repeat(np.arange(len(x)), listed.value_lengths().to_numpy(zero_copy_only=False))
                group = listed.flatten().to_numpy(zero_copy_only=False)
                for g in np.unique(group):
                    inside = x[row[group == g]]
                    for a, b in pairs:
                        state = state_of(inside[:, a * tile : (a + 1) * tile], inside[:, b * tile : (b + 1) * tile])
                        old = held.get((int(g), a, b))
                        held[int(g), a, b] = state if old is None else merged(old, state)
        for (g, a, b), state in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([g], pa.int32()), pa.array([a], pa.int32()), pa.array([b], pa.int32()), pa.array([state.tobytes()], pa.binary())], names=["group", "a", "b", "state"])

    return rows.select("groups", "v").mapInArrow(accumulate, PACKED)


def merged_states(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state per key, whatever the number of states; in two levels, in an order fixed by the tasks they come from."""

    def merge(pdf):
        pdf = pdf.sort_values("place", kind="stable")
        total = None
        for packed in pdf["state"]:
            state = np.frombuffer(packed).reshape(len(PARTS), -1)
            total = state if total is None else merged(total, state)
        return pdf.iloc[:1].assign(state=[total.tobytes()])

    columns = ", ".join(f"{k} int" for k in keys)
    numbered = states.select(*keys, F.spark_partition_id().alias("place"), "state")
    # place / lot and place % lot both stay near the square root of the number of tasks
    lot = F.floor(F.sqrt(F.col("place"))).cast("int")
    first = numbered.withColumn("lot", lot).groupBy(*keys, "lot").applyInPandas(merge, f"{columns}, lot int, place int, state binary")
    again = first.select(*keys, F.col("lot").alias("place"), "state")
    return again.groupBy(*keys).applyInPandas(merge, f"{columns}, place int, state binary").select(*keys, "state")


def by_fold(states: DataFrame, n_folds: int) -> DataFrame:
    """States per (fold, a, b) from those of blocks: fold k is the merge of the groups 0..k."""
    folds = states.select(F.explode(F.sequence(F.col("group"), F.lit(n_folds - 1))).alias("fold"), "a", "b", "group", "state")

    def merge(pdf):
        total = None
        for packed in pdf.sort_values("group")["state"]:
            state = np.frombuffer(packed).reshape(len(PARTS), -1)
            total = state if total is None else merged(total, state)
        return pdf.iloc[:1][["fold", "a", "b"]].assign(state=[total.tobytes()])

    return folds.groupBy("fold", "a", "b").applyInPandas(merge, "fold int, a int, b int, state binary")


def pair_rows(states: DataFrame, key: str, width: int, tile: int = TILE) -> DataFrame:
    """(key, i, j, parts) for every feature pair i < j."""

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                rows = np.arange(r["a"] * tile, min(width, (r["a"] + 1) * tile))
                columns = np.arange(r["b"] * tile, min(width, (r["b"] + 1) * tile))
                i, j = np.repeat(rows, len(columns)), np.tile(columns, len(rows))
                upper = i < j
                state = np.frombuffer(r["state"]).reshape(len(PARTS), -1)[:, upper]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(int(upper.sum()), r[key], dtype=np.int32)), pa.array(i[upper].astype(np.int32)), pa.array(j[upper].astype(np.int32)), *[pa.array(p) for p in state]],
                    names=[key, "i", "j", *PARTS],
                )

    return states.mapInArrow(unpack, f"{key} int, i int, j int, " + ", ".join(f"{p} double" for p in PARTS))


def correlation() -> Column:
    """Pearson's r of `pair_rows`; NULL where a deviation is no more than the rounding of its mean."""

    def real(dev: str, mean: str) -> Column:
        return F.col(dev) > F.col("n") * F.pow(F.lit(1e-13) * F.col(mean), F.lit(2))

    r = F.col("dev_xy") / (F.sqrt("dev_x") * F.sqrt("dev_y"))
    return F.when(real("dev_x", "mean_x") & real("dev_y", "mean_y"), r)


def covariances(states: DataFrame, width: int, tile: int = TILE) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Per group its rows, mean and population covariance: features squared numbers a group, in packed tiles."""
    out: dict[int, tuple[int, np.ndarray, np.ndarray]] = {}
    for r in states.collect():
        rows, columns = (min(tile, width - x * tile) for x in (r.a, r.b))
        state = np.frombuffer(r.state).reshape(len(PARTS), rows, columns)
        n, mean, full = out.setdefault(r.group, (int(state[0].max()), np.zeros(width), np.zeros((width, width))))
        at, to = slice(r.a * tile, r.a * tile + rows), slice(r.b * tile, r.b * tile + columns)
        full[at, to] = state[5] / n
        full[to, at] = full[at, to].T
        if r.a == r.b:
            mean[at] = np.diag(state[1])
    return out
