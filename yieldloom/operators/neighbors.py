"""Exact k-nearest-neighbour join and local outlier factor.

Reference points are held in a two-level tree of pivots: every point belongs to the nearest of a few top
pivots and there to the nearest of that top's own pivots, whose points are a cell; cells are cut into blocks
of bounded size and queries into chunks of bounded size. The tree is a table of cells with their pivots and
radii. A first pass against one block of its own cell gives every query an upper bound for its k-th distance.
Then a query is dealt to the tops, and by a join on the top to the cells, that can hold something closer
(triangle inequality), as one row with the list of the cells it visits. A block meets a chunk inside one
task, where the distances are a matrix product and only what is within the bound, at most k rows per query,
leaves. The result does not depend on pivots, blocks or chunks.

A query travels once per block that it visits and a point once per chunk that visits it. Where nothing can be
pruned, as with many features, that is all of them, so blocks and chunks are large: memory alone limits them.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.functions import unit_hash
from yieldloom.sources.workspace import settled

# Points of a block and queries of a chunk: what a task holds of each.
BLOCK = 1 << 16
# Points that one cell holds alone; beyond, there are cells enough to busy several tasks.
ALONE = 4096
LEAST_CELLS = 16
# Rows that meet the cells of a top at a time.
CHUNK = 1 << 14
# Distances of a block and a chunk held at a time, and values of vectors measured exactly at a time.
MEASURED = 2_000_000
# Rounding in the distances must not prune a true neighbour.
SLACK = 1e-9


def cells_for(n_points: int, block: int = BLOCK) -> int:
    """Cells for a number of points: one for few, else LEAST_CELLS of 1,024 points or more, or as many of half a block."""
    return 1 if n_points <= min(block, ALONE) else max(min(LEAST_CELLS, math.ceil(n_points / 1024)), math.ceil(2 * n_points / block))


@dataclass
class PivotIndex:
    """Points (id, v, top, sub, part), their cells (top, sub, pivot, radius, blocks), and of the tops that have
    points, about the square root of the number of cells, numbers, pivots and radii."""

    points: DataFrame
    cells: DataFrame
    tops: np.ndarray
    pivots: np.ndarray
    radii: np.ndarray
    id_type: str
    block: int


def _plain(df: DataFrame, entity: str) -> DataFrame:
    return df.select(F.col(entity).alias("id"), vector_to_array("features").alias("v"))


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """The vectors of a column as rows, without an object per row."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _lists(values: pa.Array, row: np.ndarray, rows: int) -> pa.ListArray:
    """One list per row from values in order of their rows."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)), values)


def _gaps(x, pivots):
    """Distances of rows to pivots."""
    return np.column_stack([np.sqrt(((x - p) ** 2).sum(axis=1)) for p in pivots])


def _to_nearest_top(df: DataFrame, pivots, tops, id_type: str) -> DataFrame:
    """(id, v, top, far): the nearest top pivot and the distance to it."""

    def nearest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                d = _gaps(_matrix(batch.column(1)), pivots)
                at = d.argmin(axis=1)
                columns = [batch.column(0), batch.column(1), pa.array(tops[at], pa.int32()), pa.array(d[np.arange(len(d)), at])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "v", "top", "far"])

    return df.select("id", "v").mapInArrow(nearest, f"id {id_type}, v array<double>, top int, far double")


def _with_cells(rows: DataFrame, cells: DataFrame, work: Callable, schema: str) -> DataFrame:
    """`work` on the rows of a top, a chunk at a time, and the cells of that top."""
    # one row per top
    load = F.broadcast(rows.groupBy("top").agg(F.ceil(F.count("*") / CHUNK).alias("chunks")))
    dealt = rows.join(load, "top").withColumn("chunk", F.pmod(F.xxhash64("id"), F.col("chunks"))).drop("chunks")
    # the cells of a top are repeated once per chunk; they may stem from the rows, so their columns get new identities
    copies = cells.select(*[F.col(c).alias(c) for c in cells.columns]).join(load, "top").withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))).drop("chunks")
    keys = ["top", "chunk"]
    return dealt.groupBy(*keys).cogroup(copies.groupBy(*keys)).applyInArrow(work, schema)


def _to_nearest_cell(rows: DataFrame, cells: DataFrame, id_type: str) -> DataFrame:
    """(id, v, top, sub, radius) of rows (id, v, top): the nearest pivot of the top and the distance to it."""

    def nearest(p: pa.Table, c: pa.Table) -> pa.Table:
        if not p.num_rows or not c.num_rows:
            p, sub, radius = p.slice(0, 0), c["sub"].slice(0, 0), np.zeros(0)
        else:
            c = c.sort_by("sub")
            d = _gaps(_matrix(p["v"]), _matrix(c["pivot"]))
            at = d.argmin(axis=1)
            sub, radius = c["sub"].take(pa.array(at)), d[np.arange(len(d)), at]
        return pa.table({"id": p["id"], "v": p["v"], "top": p["top"], "sub": sub, "radius": radius})

    return _with_cells(rows.select("id", "v", "top"), cells.select("top", "sub", "pivot"), nearest, f"id {id_type}, v array<double>, top int, sub {id_type}, radius double")


def pivot_index(points: DataFrame, entity: str = "entity_id", cells: int | None = None, block: int = BLOCK) -> PivotIndex:
    """The tree of `points` (id, features). Pivots are points drawn by hash of the id, so the tree is repeatable."""
    id_type = dict(points.dtypes)[entity]
    plain = _plain(points, entity)
    n = plain.count()
    if n == 0:
        raise ValueError("no points to search")
    cells = cells or cells_for(n, block)
    # the square root of the number of cells
    drawn = plain.withColumn("h", unit_hash(F.col("id"), "pivot")).orderBy("h").limit(math.ceil(math.sqrt(cells))).collect()
    pivots, numbers = np.array([r.v for r in drawn]), np.arange(len(drawn), dtype="int32")
    if cells == 1:
        # one cell is always visited, so nothing has to be measured for it
        blocks = -(-n // block)
        only = [(0, drawn[0].id, drawn[0].v, math.inf, blocks)]
        table = points.sparkSession.createDataFrame(only, f"top int, sub {id_type}, pivot array<double>, radius double, blocks long")
        part = F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("part")
        here = plain.select("id", "v", F.lit(0).alias("top"), F.lit(drawn[0].id).cast(id_type).alias("sub"), part)
        return PivotIndex(here, table, numbers, pivots, np.array([math.inf]), id_type, block)
    near = settled(_to_nearest_top(plain, pivots, numbers, id_type))
    chosen = near.where((F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n)) < cells) | F.col("id").isin([r.id for r in drawn]))
    grid = settled(chosen.select("top", F.col("id").alias("sub"), F.col("v").alias("pivot")))
    here = settled(_to_nearest_cell(near, grid, id_type))
    sizes = here.groupBy("top", "sub").agg(F.max("radius").alias("radius"), F.ceil(F.count("*") / block).alias("blocks"))
    table = settled(grid.join(sizes, ["top", "sub"]))
    # one narrow row per cell
    dealt = here.join(F.broadcast(table.select("top", "sub", "blocks")), ["top", "sub"])
    dealt = dealt.select("id", "v", "top", "sub", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("part"))
    reach = {r.top: r.far for r in near.groupBy("top").agg(F.max("far").alias("far")).collect()}
    tops = np.array(sorted(reach), dtype="int32")
    return PivotIndex(dealt, table, tops, pivots[tops], np.array([reach[t] for t in tops.tolist()]), id_type, block)


def nearest_neighbors(
    points: DataFrame | PivotIndex,
    queries: DataFrame,
    k: int,
    entity: str = "entity_id",
    exclude_self: bool = False,
    cells: int | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """(query id, neighbor id, distance, rank) of the k nearest points of every query, ties by neighbor id.

    Both sides are (id, features vector); the points may be indexed already. With `exclude_self`, a point is
    not its own neighbour.
    """
    index = points if isinstance(points, PivotIndex) else pivot_index(points, entity, cells, block)
    id_type, asked = index.id_type, _plain(queries, entity)
    if len(index.tops) == 1 and math.isinf(index.radii[0]):
        # every block of the one cell is visited
        only = index.cells.head()
        visits = asked.select("id", "v", F.lit(only.top).alias("top"), F.lit(only.sub).cast(id_type).alias("sub"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(only.blocks - 1))).alias("part"), F.lit(None).cast("double").alias("upper"))
    else:
        asked = settled(asked)
        visits = _visits(index, asked, _upper_bounds(index, asked, k, exclude_self))
    found = _block_search(index.points, visits, k, exclude_self, id_type, index.block)
    best = Window.partitionBy("qid").orderBy("distance", "nid")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(F.col("qid").alias(entity), F.col("nid").alias("neighbor_id"), "distance", "rank")
    )


def _upper_bounds(index: PivotIndex, asked: DataFrame, k: int, exclude_self: bool) -> DataFrame:
    """(id, upper): the k-th distance within one block of the query's own cell, missing if that holds too few."""
    # each step reads its rows twice, to count and to deal them, so what it reads is written down
    near = settled(_to_nearest_top(asked, index.pivots, index.tops, index.id_type))
    own = _to_nearest_cell(near, index.cells, index.id_type).join(F.broadcast(index.cells.select("top", "sub", "blocks")), ["top", "sub"])
    own = settled(own.select("id", "v", "top", "sub", F.pmod(F.xxhash64("id"), F.col("blocks")).alias("part"), F.lit(None).cast("double").alias("upper")))
    found = _block_search(index.points, own, k, exclude_self, index.id_type, index.block)
    bound = found.groupBy("qid").agg(F.count("*").alias("found"), F.max("distance").alias("farthest"))
    return settled(bound.select(F.col("qid").alias("id"), F.when(F.col("found") >= k, F.col("farthest")).alias("upper")))


def _visits(index: PivotIndex, asked: DataFrame, bounds: DataFrame) -> DataFrame:
    """(id, v, upper, top, sub, part) for every block that may hold a point within the query's bound."""
    pivots, radii, tops, id_type = index.pivots, index.radii, index.tops, index.id_type

    def by_top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                upper = batch.column(2).fill_null(np.inf)
                d = _gaps(_matrix(batch.column(1)), pivots)
                # a point lies within its top's radius, and nearer to its own top than to any other
                gap = np.maximum(d - radii, (d - d.min(axis=1, keepdims=True)) / 2)
                row, col = np.nonzero(gap <= upper.to_numpy()[:, None] * (1 + SLACK) + SLACK)
                listed = _lists(pa.array(tops[col], pa.int32()), row, len(d))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), upper, listed], ["id", "v", "upper", "tops"])

    def by_cell(q: pa.Table, c: pa.Table) -> pa.Table:
        if not q.num_rows or not c.num_rows:
            q, row, place, part = q.slice(0, 0), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            c = c.sort_by("sub")
            d = _gaps(_matrix(q["v"]), _matrix(c["pivot"]))
            gap = np.maximum(d - c["radius"].to_numpy(), (d - d.min(axis=1, keepdims=True)) / 2)
            row, place = np.nonzero(gap <= q["upper"].to_numpy()[:, None] * (1 + SLACK) + SLACK)
            blocks = c["blocks"].to_numpy()[place]
            part = np.arange(int(blocks.sum())) - np.repeat(np.cumsum(blocks) - blocks, blocks)
            row, place = np.repeat(row, blocks), np.repeat(place, blocks)
        subs = c["sub"].combine_chunks().take(pa.array(place))
        lists = [_lists(x, row, q.num_rows) for x in (subs, pa.array(part, pa.int64()))]
        return pa.table({"id": q["id"], "v": q["v"], "upper": q["upper"], "top": q["top"], "subs": lists[0], "parts": lists[1]})

    # a row per query, then one per query and top, that list what they visit: the vectors are not repeated for it
    topped = settled(asked.join(bounds, "id", "left").select("id", "v", "upper").mapInArrow(by_top, f"id {id_type}, v array<double>, upper double, tops array<int>"))
    dealt = topped.select("id", "v", "upper", F.explode("tops").alias("top"))
    schema = f"id {id_type}, v array<double>, upper double, top int, subs array<{id_type}>, parts array<bigint>"
    listed = settled(_with_cells(dealt, index.cells.select("top", "sub", "pivot", "radius", "blocks"), by_cell, schema))
    placed = listed.select("id", "v", "upper", "top", F.explode(F.arrays_zip("subs", "parts")).alias("at"))
    return placed.select("id", "v", "upper", "top", F.col("at.subs").alias("sub"), F.col("at.parts").alias("part"))


def _closest(d2: np.ndarray, norms: np.ndarray, limit: np.ndarray, need: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of all that may be within a row's limit and among its `need` least."""
    # the product form is rounded: all points that may reach the last place are measured exactly
    slack = 1e-12 * norms.max(axis=1)
    close = d2 <= (limit * limit + slack)[:, None]
    if close.sum() > 4 * need * len(d2):
        least = np.partition(d2, need - 1, axis=1)[:, need - 1]
        close &= d2 <= (least + slack)[:, None]
    return np.nonzero(close)


def _block_search(
    points: DataFrame, queries: DataFrame, k: int, exclude_self: bool, id_type: str, block: int
) -> DataFrame:
    """The k nearest points of every query within the block it visits, none beyond its bound."""
    # how many query chunks meet each block, one row per block; the points of a block are repeated once per chunk
    place = ["top", "sub", "part"]
    load = F.broadcast(queries.groupBy(*place).agg(F.ceil(F.count("*") / block).alias("chunks")))
    left = points.join(load, place).select(
        "id", "v", *place, F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk")
    )
    right = queries.join(load, place).select("id", "v", "upper", *place, F.pmod(F.xxhash64("id", F.lit(1)), F.col("chunks")).alias("chunk"))
    keys = [*place, "chunk"]

    def search(p: pa.Table, q: pa.Table) -> pa.Table:
        if not p.num_rows or not q.num_rows:
            return pa.table({"qid": q["id"].slice(0, 0), "nid": p["id"].slice(0, 0), "distance": np.zeros(0)})
        p = p.sort_by("id")
        x, y = _matrix(p["v"]), _matrix(q["v"])
        pid, qid = p["id"].to_pandas().to_numpy(), q["id"].to_pandas().to_numpy()
        limits = q["upper"].fill_null(np.inf).to_numpy() * (1 + SLACK) + SLACK
        squares, need = (x * x).sum(axis=1), min(k + int(exclude_self), len(x))
        asks, nears, distances = [], [], []
        step, lot = max(1, MEASURED // len(x)), max(1, MEASURED // x.shape[1])
        for s in range(0, len(y), step):
            part, limit = y[s : s + step], limits[s : s + step]
            norms = (part * part).sum(axis=1)[:, None] + squares[None, :]
            row, col = _closest(norms - 2.0 * part @ x.T, norms, limit, need)
            exact = np.empty(len(row))
            for r in range(0, len(row), lot):
                gaps = x[col[r : r + lot]] - part[row[r : r + lot]]
                exact[r : r + lot] = np.sqrt((gaps**2).sum(axis=1))
            kept = exact <= limit[row]
            if exclude_self:
                kept &= pid[col] != qid[s + row]
            row, col, exact = row[kept], col[kept], exact[kept]
            # of each row the least, ties by the point's id
            order = np.lexsort((col, exact, row))
            row, col, exact = row[order], col[order], exact[order]
            least = np.arange(len(row)) - np.searchsorted(row, row) < k
            asks.append(s + row[least])
            nears.append(col[least])
            distances.append(exact[least])
        return pa.table({"qid": q["id"].take(pa.array(np.concatenate(asks))), "nid": p["id"].take(pa.array(np.concatenate(nears))), "distance": np.concatenate(distances)})

    schema = f"qid {id_type}, nid {id_type}, distance double"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def neighbor_vote(points: DataFrame, queries: DataFrame, k: int = 5, entity: str = "entity_id") -> DataFrame:
    """(id, risk): the share of fails among the k nearest points, which carry `y`."""
    pairs = nearest_neighbors(points, queries, k, entity)
    labels = points.select(F.col(entity).alias("neighbor_id"), F.col("y").alias("neighbor_y"))
    return pairs.join(labels, "neighbor_id").groupBy(entity).agg(F.avg("neighbor_y").alias("risk"))


def outlier_neighbors(n_pass: int) -> int:
    """Neighbourhood size of the outlier factor for a number of passes."""
    k = min(20, max(5, int(n_pass * 0.5))) if n_pass > 0 else 5
    return max(1, min(k, n_pass - 1))


def _density(pairs: DataFrame, reach: DataFrame, entity: str) -> DataFrame:
    far = F.greatest("distance", "k_distance")
    return pairs.join(reach, "neighbor_id").groupBy(entity).agg((F.lit(1.0) / (F.avg(far) + F.lit(1e-10))).alias("density"))


def point_densities(points: DataFrame, k: int, entity: str = "entity_id", index: PivotIndex | None = None) -> DataFrame:
    """(neighbor_id, k_distance, neighbor_density) of the points among themselves: what scoring needs to know of them."""
    inner = settled(nearest_neighbors(points if index is None else index, points, k, entity, exclude_self=True))
    reach = inner.groupBy(F.col(entity).alias("neighbor_id")).agg(F.max("distance").alias("k_distance"))
    density = _density(inner, reach, entity).select(F.col(entity).alias("neighbor_id"), F.col("density").alias("neighbor_density"))
    return settled(reach.join(density, "neighbor_id"))


def local_outlier_factor(
    points: DataFrame, queries: DataFrame, k: int, entity: str = "entity_id", densities: DataFrame | None = None
) -> DataFrame:
    """(id, risk): density of the neighbours over the query's own density, about 1 for inliers.

    `densities` are those of `points`, if they are known already; a query only looks up points.
    """
    index = pivot_index(points, entity)
    known = point_densities(points, k, entity, index) if densities is None else densities
    outer = settled(nearest_neighbors(index, queries, k, entity))
    around = outer.join(known, "neighbor_id").groupBy(entity).agg(F.avg("neighbor_density").alias("around"))
    own = _density(outer, known.select("neighbor_id", "k_distance"), entity)
    return around.join(own, entity).select(entity, (F.col("around") / F.col("density")).alias("risk"))
