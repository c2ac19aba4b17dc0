"""Robust distance from the centre of the passing entities: minimum covariance determinant.

Several starts, each a small part of the points drawn by hash, are improved by concentration steps: centre
and covariance of the chosen points, distances of all points from them, and the h closest points are chosen
next, which never raises the determinant (Rousseeuw and Van Driessen 1999). All starts share each step's two
passes. After a few steps the best ones go on until their points no longer change. The winner's covariance is
scaled to the median distance of a normal sample, and centre and covariance are taken once more from the
points within the 97.5 % quantile of that scale.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldloom.operators.comoments import TILE, covariances, pair_states
from yieldloom.operators.ranking import exact_quantiles
from yieldloom.sources.workspace import settled

STARTS = 6
FIRST_STEPS = 2
FINALISTS = 2
MOST_STEPS = 30
# Points a start is drawn from, per feature.
POINTS_PER_FEATURE = 3
CUT_SHARE = 0.975


def _plain(points: DataFrame, entity: str) -> DataFrame:
    return points.select(F.col(entity).alias("id"), vector_to_array("features").alias("v"))


def distances(queries: DataFrame, mean, inverse, entity: str = "entity_id") -> DataFrame:
    """(id, risk): squared Mahalanobis distance from `mean`."""
    measured = _measured(_plain(queries, entity), [(np.asarray(mean), np.asarray(inverse))])
    return measured.select(F.col("id").alias(entity), F.get("d", F.lit(0)).alias("risk"))


def _measured(plain: DataFrame, fits: list[tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """(id, v, d): the squared distance from every fit's centre in units of its covariance."""
    kept = plain.select("id", "v")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                d = np.column_stack([(((x - mean) @ inverse) * (x - mean)).sum(axis=1) for mean, inverse in fits])
                ends = np.arange(len(d) + 1, dtype=np.int32) * len(fits)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(ends), pa.array(d.reshape(-1)))], ["id", "v", "d"])

    id_type = dict(kept.dtypes)["id"]
    return kept.mapInArrow(measure, f"id {id_type}, v array<double>, d array<double>")


def _inverse(covariance: np.ndarray) -> np.ndarray:
    return np.linalg.pinv(covariance, hermitian=True)


def _determinant(covariance: np.ndarray) -> float:
    """Logarithm of the determinant; a singular covariance is the least there is."""
    sign, log = np.linalg.slogdet(covariance)
    return log if sign > 0 else -math.inf


def _cuts(measured: DataFrame, starts: int, h: int, n: int) -> list[float]:
    """A distance between the h-th smallest and the next of every start."""
    each = measured.select(F.posexplode("d").alias("start", "risk"))
    share = min(1.0, (h - 0.5) / (n - 1)) if n > 1 else 1.0
    rows = exact_quantiles(each, ["start"], "risk", {"cut": share}, few_groups=True).collect()
    held = {r.start: r.cut for r in rows}
    return [held[s] for s in range(starts)]


def _fits(rows: DataFrame, width: int, starts: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    held = covariances(pair_states(rows, width, starts), width, TILE)
    return [held.get(s, (0, np.zeros(width), np.zeros((width, width)))) for s in range(starts)]


def _concentrated(plain: DataFrame, fits: list, h: int, n: int) -> list:
    """Centre and covariance of the h points closest to each fit (more, if distances tie)."""
    width = len(fits[0][1])
    measured = _measured(plain, [(mean, _inverse(cov)) for _, mean, cov in fits])
    cuts = _cuts(measured, len(fits), h, n)
    chosen = F.filter(F.sequence(F.lit(0), F.lit(len(fits) - 1)), lambda s: F.get("d", s) <= F.get(F.array(*[F.lit(c) for c in cuts]), s))
    return _fits(measured.select(chosen.alias("groups"), "v"), width, len(fits))


def support_size(n: int, width: int) -> int:
    """The points a robust fit rests on: the most central (n + p + 1) / 2."""
    return min(n, math.ceil((n + width + 1) / 2))


def start_groups(plain: DataFrame, n: int, width: int, starts: int, seed: int):
    """Per point the starts it belongs to, by digest of start and id; everyone's points in a table too small to draw from."""
    share = POINTS_PER_FEATURE * (width + 1) / n
    bound = "g" if share >= 0.5 else f"{int(share * 16**8):08x}"
    digest = lambda s: F.md5(F.concat_ws(":", F.lit(str(seed)), s.cast("string"), F.col("id").cast("string")))
    return plain.select(F.filter(F.sequence(F.lit(0), F.lit(starts - 1)), lambda s: F.substring(digest(s), 1, 8) < F.lit(bound)).alias("groups"), "v")


def minimum_covariance(plain: DataFrame, starts: int = STARTS, first_steps: int = FIRST_STEPS, most_steps: int = MOST_STEPS, seed: int = 42) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean and covariance of the most central half of points (id, v), and their number n."""
    row = plain.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).head()
    n, width = row.n, row.width
    if not n:
        raise ValueError("no points to fit")
    h = support_size(n, width)
    fits = _fits(start_groups(plain, n, width, starts, seed), width, starts)
    # a start without points draws on all of them
    if not all(f[0] for f in fits):
        whole = _fits(plain.select(F.array(F.lit(0)).alias("groups"), "v"), width, 1)[0]
        fits = [f if f[0] else whole for f in fits]
    for _ in range(first_steps):
        fits = _concentrated(plain, fits, h, n)
    order = sorted(range(len(fits)), key=lambda s: (_determinant(fits[s][2]), s))
    fits = [fits[s] for s in order[:FINALISTS]]
    for _ in range(max(0, most_steps - first_steps)):
        again = _concentrated(plain, fits, h, n)
        done = all(np.array_equal(a[1], b[1]) and np.array_equal(a[2], b[2]) for a, b in zip(again, fits))
        fits = again
        if done:
            break
    _, mean, covariance = min(fits, key=lambda f: _determinant(f[2]))
    return mean, covariance, n


def robust_center(points: DataFrame, entity: str = "entity_id", **options):
    """Centre and inverse covariance of (id, features) points: minimum covariance determinant, scaled and reweighted."""
    # every step reads the points, so they are prepared and assembled once
    plain = settled(_plain(points, entity))
    mean, covariance, n = minimum_covariance(plain, **options)
    width = len(mean)
    measured = _measured(plain, [(mean, _inverse(covariance))])
    each = measured.select(F.get("d", F.lit(0)).alias("risk"))
    median = exact_quantiles(each, [], "risk", {"m": 0.5}).head().m
    cut = chi_square_quantile(CUT_SHARE, width) * median / chi_square_quantile(0.5, width)
    # points on one plane all have distance 0
    near = F.when((F.get("d", F.lit(0)) < F.lit(cut)) | F.lit(median == 0), F.lit(0))
    count, center, spread = _fits(measured.select(F.array_compact(F.array(near)).alias("groups"), "v"), width, 1)[0]
    return (center, _inverse(spread)) if count else (mean, _inverse(covariance))


def chi_square_quantile(share: float, freedom: int) -> float:
    """The value below which a chi-square variable falls with chance `share`, by bisection of the lower gamma series."""

    def below(x: float) -> float:
        a, half = freedom / 2, x / 2
        term = total = 1 / a
        step = a
        while term > total * 1e-16:
            step += 1
            term *= half / step
            total += term
        return total * math.exp(a * math.log(half) - half - math.lgamma(a)) if half > 0 else 0.0

    low, high = 0.0, freedom + 10 * math.sqrt(2 * freedom) + 20
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < share else (low, mid)
    return (low + high) / 2
