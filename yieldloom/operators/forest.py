"""Isolation forest: trees grown in parallel on small hash samples, scored where the entities are."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.sources.workspace import settled

TREES = 200
SAMPLE = 256
OVERSAMPLE = 2.0
NODES = "tree int, node int, feature int, cut double, below int, above int, size int"


def tree_samples(points: DataFrame, n_points: int, trees: int, sample: int, seed: int, entity: str) -> DataFrame:
    """(tree, entity, v): for every tree its own `sample` points, chosen by digests of tree and id, alike at every table size.

    Every tree digests every point and keeps those below a bound that leaves about `OVERSAMPLE` times as many
    as it needs (all of them in a small table); of these it takes the `sample` lowest digests.
    """
    share = min(1.0, OVERSAMPLE * sample / max(1, n_points))
    bound = "g" if share == 1.0 else f"{int(share * 16**8):08x}"

    def digest(tree: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(str(seed)), tree.cast("string"), F.col(entity).cast("string")))

    chosen = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.substring(digest(t), 1, 8) < F.lit(bound))
    lowest = Window.partitionBy("tree").orderBy("digest", entity)
    return (
        points.select("*", F.explode(chosen).alias("tree"))
        .withColumn("digest", digest(F.col("tree")))
        .withColumn("place", F.row_number().over(lowest))
        .where(F.col("place") <= sample)
        .select("tree", entity, vector_to_array("features").alias("v"))
    )


def grow_forest(
    points: DataFrame, n_points: int, trees: int = TREES, sample: int = SAMPLE, seed: int = 42, entity: str = "entity_id"
) -> DataFrame:
    """The trees as rows, one per node. Each task grows a tree from at most `sample` points."""

    def grow(pdf):
        import math

        import numpy as np
        import pandas as pd

        tree = int(pdf["tree"].iloc[0])
        x = np.stack(pdf["v"].to_numpy())
        # row order inside a group is not fixed; the tree must be
        x = x[np.lexsort(x.T[::-1])]
        random = np.random.default_rng([seed, tree])
        limit = max(1, math.ceil(math.log2(max(2, len(x)))))
        nodes = []
        waiting = [(0, np.arange(len(x)), 0)]
        nodes.append([tree, 0, -1, 0.0, -1, -1, len(x)])
        while waiting:
            at, rows, depth = waiting.pop()
            lo, hi = x[rows].min(axis=0), x[rows].max(axis=0)
            varied = np.flatnonzero(hi > lo)
            if depth >= limit or len(rows) < 2 or len(varied) == 0:
                continue
            f = int(random.choice(varied))
            cut = float(random.uniform(lo[f], hi[f]))
            under = x[rows, f] < cut
            for slot, part in ((4, rows[under]), (5, rows[~under])):
                child = len(nodes)
                nodes.append([tree, child, -1, 0.0, -1, -1, len(part)])
                nodes[at][slot] = child
                if len(part):
                    waiting.append((child, part, depth + 1))
            nodes[at][2], nodes[at][3] = f, cut
        return pd.DataFrame(nodes, columns=["tree", "node", "feature", "cut", "below", "above", "size"])

    samples = tree_samples(points, n_points, trees, sample, seed, entity)
    return samples.select("tree", "v").groupBy("tree").applyInPandas(grow, NODES)


def score_forest(queries: DataFrame, nodes: DataFrame, sample: int, entity: str = "entity_id") -> DataFrame:
    """(id, risk) with risk = 2 ** (-mean path length / expected path length).

    The forest is at most trees x 2 x sample nodes, so it travels to the tasks; entities stay in place.
    """
    import numpy as np

    rows = nodes.orderBy("tree", "node").collect()
    trees: dict[int, np.ndarray] = {}
    for r in rows:
        trees.setdefault(r.tree, []).append((r.feature, r.cut, r.below, r.above, r.size))
    packed = [np.array(t, dtype=float) for t in trees.values()]
    id_type = dict(queries.dtypes)[entity]

    def walk(batches: Iterator) -> Iterator:
        import numpy as np

        def expected(n):
            n = np.asarray(n, dtype=float)
            safe = np.maximum(n, 3.0)
            long = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
            return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, long))

        for pdf in batches:
            if not len(pdf):
                continue
            x = np.stack(pdf["v"].to_numpy())
            total = np.zeros(len(x))
            every = np.arange(len(x))
            for tree in packed:
                at = np.zeros(len(x), dtype=int)
                depth = np.zeros(len(x))
                while True:
                    feature = tree[at, 0].astype(int)
                    inner = feature >= 0
                    if not inner.any():
                        break
                    value = x[every, np.maximum(feature, 0)]
                    step = np.where(value < tree[at, 1], tree[at, 2], tree[at, 3]).astype(int)
                    at = np.where(inner, step, at)
                    depth += inner
                total += depth + expected(tree[at, 4])
            norm = float(expected(sample)) or 1.0
            yield pdf[["id"]].assign(risk=np.power(2.0, -(total / max(1, len(packed))) / norm))

    plain = queries.select(F.col(entity).alias("id"), vector_to_array("features").alias("v"))
    scored = plain.mapInPandas(walk, f"id {id_type}, risk double")
    return scored.withColumnRenamed("id", entity)


def settled_forest(points: DataFrame, n_points: int, trees: int, sample: int, seed: int, entity: str) -> DataFrame:
    """`grow_forest` written down once, so that scoring and saving read the same trees."""
    return settled(grow_forest(points, n_points, trees, sample, seed, entity))
