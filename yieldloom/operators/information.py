"""Mutual information of a continuous feature and the outcome, by nearest neighbours (Ross 2014).

For an entity, r is the distance to its k-th nearest entity of the same class along one feature, and m the
number of entities nearer than r, itself included; the estimate is psi(n) - mean psi(class size)
+ mean psi(k) - mean psi(m), at least 0. Missing values are filled with the training median; equal values are
told apart by a repeatable shift of a 1e-10 part, from a digest of the id.

Nothing is sorted as a whole: the values of a (fold, feature) are cut into ranges at sampled bounds, each
range hands the k outermost values of each class to its neighbours and so every radius is found inside one
range. Counts within a radius are differences of ranks: most lie in the range itself, the others are looked
up in the range the radius ends in.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.functions import unit_hash, without_nan
from yieldloom.operators.longform import feature_name
from yieldloom.operators.selectors import train_blocks
from yieldloom.sources.workspace import settled, stored
from yieldloom.spec import DEFAULT_SPEC, EntitySpec

NEIGHBORS = 3
NUDGE = 1e-10
PER_RANGE = 50_000
SAMPLE_PER_RANGE = 32
# Bounds of all (fold, feature) groups together, which are broadcast; ranges grow beyond that.
MOST_BOUNDS = 1 << 20
GROUP = ["fold", "ordinal"]


def digamma(n: np.ndarray) -> np.ndarray:
    """psi of whole numbers from 1."""
    x = np.asarray(n, dtype=float).copy()
    out = np.zeros_like(x)
    for _ in range(10):
        low = x < 10
        out[low] -= 1 / x[low]
        x[low] += 1
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def filled_values(df: DataFrame, in_train: Sequence[Column], scores: DataFrame, spec: EntitySpec = DEFAULT_SPEC, nudge: float = NUDGE) -> DataFrame:
    """(fold, ordinal, y, x) of every training entity and varied feature, folds from 1."""
    features = spec.prefixed(df)
    rows = train_blocks(df, in_train, spec)
    shift = F.conv(F.substring(unit_hash(F.col(spec.id), "nudge"), 1, 8), 16, 10).cast("double") / F.lit(2.0**31) - 1.0
    packed = F.array(*[without_nan(F.col(f"`{c}`")) for c in features])
    cells = rows.select("y", F.col("block"), shift.alias("shift"), F.posexplode(packed).alias("ordinal", "value"))
    each = cells.select("*", F.explode(F.sequence(F.col("block") + 1, F.lit(len(in_train)))).alias("fold"))
    facts = scores.where(F.col("fill_std") > 0).select("fold", F.col("feature_ordinal").alias("ordinal"), "median", F.greatest("fill_std", F.abs("fill_mean")).alias("scale"))
    x = F.coalesce("value", "median") + F.lit(nudge) * F.col("scale") * F.col("shift")
    # folds x columns rows
    return each.join(F.broadcast(facts), GROUP).select(*GROUP, "y", x.alias("x"))


def neighbor_information(
    df: DataFrame, in_train: Sequence[Column], scores: DataFrame, spec: EntitySpec = DEFAULT_SPEC, k: int = NEIGHBORS, per_range: int = PER_RANGE
) -> DataFrame:
    """(fold, feature_ordinal, feature_name, mutual_info) for every row of `scores`; constant or empty features have 0."""
    features = spec.prefixed(df)
    values = stored(filled_values(df, in_train, scores, spec), "filled")
    sizes = settled(values.groupBy(*GROUP).agg(F.count("*").alias("n"), F.sum("y").cast("long").alias("fails")))
    # of a class with one entity nothing can be learned: it does not count
    alone = (F.col("y") == 1) & (F.col("fails") < 2) | (F.col("y") == 0) & (F.col("n") - F.col("fails") < 2)
    kept = values.join(F.broadcast(sizes), GROUP).where(~alone)
    ranges = F.least(F.lit(max(1, MOST_BOUNDS // max(1, sizes.count()))), F.ceil(F.col("n") / per_range)).cast("int")
    bounds = settled(_bounds(kept.withColumn("ranges", ranges)))
    placed = stored(_placed(kept, bounds, F.col("x"), "range").select(*GROUP, "range", "y", "x", "n", "fails"), "ranges")
    outer = settled(placed.groupBy(*GROUP).agg(F.min("x").alias("least"), F.max("x").alias("most")))
    keys = [*GROUP, "range"]
    totals = placed.groupBy(*keys).agg(F.count("*").alias("held"))
    before = F.coalesce(F.sum("held").over(Window.partitionBy(*GROUP).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = settled(totals.select(*keys, before.alias("before")))
    counted = settled(_radii(placed, _borders(placed, k).join(F.broadcast(outer), GROUP), offsets, k))
    terms = counted.where("held IS NOT NULL").select(*GROUP, "held", "total")
    asked = counted.where("held IS NULL")
    if not asked.isEmpty():
        # the few whose radius leaves the range, one end after the other
        upper = _looked_up(asked.where("upper IS NULL"), placed, offsets, bounds, outer, "upper")
        both = asked.where("upper IS NOT NULL").select(*upper.columns).unionByName(upper)
        lower = _looked_up(both.where("lower IS NULL"), placed, offsets, bounds, outer, "lower")
        full = both.where("lower IS NOT NULL").unionByName(lower)
        terms = terms.unionByName(_terms(full.select(*GROUP, "k", "class_size", (F.col("upper") - F.col("lower")).alias("m"))))
    psi = terms.groupBy(*GROUP).agg(F.sum("held").alias("held"), F.sum("total").alias("total"))
    raw = _with_psi(psi).select("fold", F.col("ordinal").alias("feature_ordinal"), F.greatest("information", F.lit(0.0)).alias("mutual_info"))
    every = scores.select("fold", "feature_ordinal", feature_name(features, "feature_ordinal").alias("feature_name"))
    return every.join(F.broadcast(raw), ["fold", "feature_ordinal"], "left").withColumn("mutual_info", F.coalesce("mutual_info", F.lit(0.0)))


def _bounds(values: DataFrame) -> DataFrame:
    """(fold, ordinal, bounds): values that cut a group into about `ranges` parts, drawn by hash of the value."""
    every = F.greatest(F.lit(1).cast("long"), F.floor(F.col("n") / (SAMPLE_PER_RANGE * F.col("ranges"))))
    drawn = values.where((F.col("ranges") > 1) & (F.pmod(F.xxhash64("x"), every) == 0))
    sample = drawn.groupBy(*GROUP).agg(F.array_sort(F.collect_set("x")).alias("drawn"), F.max("ranges").alias("ranges"))
    steps = F.sequence(F.lit(1), F.col("ranges") - 1)
    cuts = F.transform(steps, lambda i: F.get("drawn", F.floor(i * F.size("drawn") / F.col("ranges")).cast("int")))
    return sample.select(*GROUP, F.array_distinct(cuts).alias("bounds"))


def _placed(df: DataFrame, bounds: DataFrame, at: Column, name: str) -> DataFrame:
    """`df` plus the number of its group's bounds below `at`: a binary search."""
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(MOST_BOUNDS.bit_length()))])
    joined = df.join(F.broadcast(bounds), GROUP, "left").withColumn("__at", at)
    place = F.aggregate(powers, F.lit(0), lambda found, step: F.when(F.get("bounds", found + step - 1) < F.col("__at"), found + step).otherwise(found))
    return joined.withColumn(name, place).drop("bounds", "__at")


def _borders(placed: DataFrame, k: int) -> DataFrame:
    """Per range and class the k nearest values outside: `below` and `above`."""
    keys = [*GROUP, "range"]

    def ends(pdf):
        x = np.sort(pdf["x"].to_numpy())
        return pdf.iloc[:1][[*keys, "y"]].assign(low=[x[:k].tolist()], high=[x[-k:].tolist()])

    tails = placed.select(*keys, "y", "x").groupBy(*keys, "y").applyInPandas(ends, "fold int, ordinal int, range int, y int, low array<double>, high array<double>")

    def carry(pdf):
        ranges = np.sort(pdf["range"].unique())
        out = []
        for y, own in pdf.groupby("y"):
            own = own.set_index("range")
            below: list[float] = []
            found = {}
            for r in ranges.tolist():
                found[r] = [below, []]
                if r in own.index:
                    below = (below + list(own.at[r, "high"]))[-k:]
            above: list[float] = []
            for r in ranges.tolist()[::-1]:
                found[r][1] = above
                if r in own.index:
                    above = (list(own.at[r, "low"]) + above)[:k]
            out += [(int(pdf["fold"].iloc[0]), int(pdf["ordinal"].iloc[0]), r, int(y), b, a) for r, (b, a) in found.items()]
        return pd.DataFrame(out, columns=[*keys, "y", "below", "above"])

    # a row per range and class: no more than the bounds of the group
    return tails.groupBy(*GROUP).applyInPandas(carry, "fold int, ordinal int, range int, y int, below array<double>, above array<double>")


def nearest_in_class(x: np.ndarray, first: int, last: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """For the sorted values x[first:last] the k-th smallest distance to another value of x, and the value it ends at."""
    held = np.concatenate([np.full(k, -np.inf), x, np.full(k, np.inf)])
    at = np.arange(first, last) + k
    radius, end = np.full(last - first, np.inf), np.full(last - first, np.nan)
    for j in range(k + 1):
        down, up = held[at] - held[at - j], held[at + k - j] - held[at]
        far = np.maximum(down, up)
        better = far < radius
        radius[better] = far[better]
        end[better] = np.where(down >= up, held[at - j], held[at + k - j])[better]
    return radius, end


def nearer(x: np.ndarray, at: np.ndarray, radius: np.ndarray, upper: bool) -> np.ndarray:
    """How many of the sorted x lie below the upper end (or below the lower end) of the open intervals at +- radius.

    An end is judged by the rounded difference, as a search over all pairs would."""
    if upper:
        place = np.searchsorted(x, at + radius)
        inside = lambda p: (p >= 0) & (p < len(x)) & (x[np.clip(p, 0, len(x) - 1)] - at < radius)
        for _ in range(len(x)):
            more = inside(place)
            less = ~more & (place > 0) & ~inside(place - 1)
            if not (more | less).any():
                break
            place = place + more - less
        return place
    return len(x) - nearer(-x[::-1], -at, radius, True)


def _radii(placed: DataFrame, borders: DataFrame, offsets: DataFrame, k: int) -> DataFrame:
    """Per range the number of its settled entities and the sum of their terms (held, total), and a row for each
    other entity with the ends that are known (upper, lower: ranks) and where the others lie (reach_up, reach_down)."""
    keys = [*GROUP, "range"]
    context = borders.join(offsets, keys)
    schema = "fold int, ordinal int, held long, total double, x double, radius double, reach_up double, reach_down double, upper long, lower long, k int, class_size long"

    def measure(pdf, around):
        every = np.sort(pdf["x"].to_numpy())
        n, fails = int(pdf["n"].iloc[0]), int(pdf["fails"].iloc[0])
        before = int(around["before"].iloc[0])
        held, total, rest = 0, 0.0, []
        for y, own in pdf.groupby("y"):
            size = fails if y == 1 else n - fails
            near = min(k, size - 1)
            edge = around[around["y"] == y].iloc[0]
            below, above = (np.array(edge[c], dtype=float) for c in ("below", "above"))
            x = np.concatenate([below, np.sort(own["x"].to_numpy()), above])
            first, last = len(below), len(x) - len(above)
            radius, end = nearest_in_class(x, first, last, near)
            at = x[first:last]
            # an end that a value marks is that value; the other one follows from the radius
            up, down = np.where(end > at, end, at + radius), np.where(end < at, end, at - radius)
            upper, lower = before + nearer(every, at, radius, True), before + nearer(every, at, radius, False)
            # the end lies inside if a value of the range is at or behind it, or if no other range follows
            in_up = (up <= every[-1]) | (every[-1] == around["most"].iloc[0])
            in_down = (down >= every[0]) | (every[0] == around["least"].iloc[0])
            done = in_up & in_down
            held += int(done.sum())
            # m counts the entity itself also where the radius is 0
            m = np.maximum(upper - lower, 1)[done]
            total += float((digamma(np.full(len(m), near)) - digamma(np.full(len(m), size)) - digamma(m)).sum())
            if (~done).any():
                rest.append(pd.DataFrame({"x": at, "radius": radius, "reach_up": up, "reach_down": down, "upper": np.where(in_up, upper, -1), "lower": np.where(in_down, lower, -1), "k": near, "class_size": size})[~done])
        out = pd.concat([pd.DataFrame({"held": [held], "total": [total]}), *rest])
        for c in ("upper", "lower"):
            if c in out:
                out[c] = out[c].where(out[c] >= 0)
        out = out.reindex(columns=["held", "total", "x", "radius", "reach_up", "reach_down", "upper", "lower", "k", "class_size"])
        whole = {c: "Int64" for c in ("held", "upper", "lower", "k", "class_size")}
        return out.astype(whole).assign(fold=int(pdf["fold"].iloc[0]), ordinal=int(pdf["ordinal"].iloc[0]))[[c.split()[0] for c in schema.split(", ")]]

    return placed.groupBy(*keys).cogroup(context.groupBy(*keys)).applyInPandas(lambda p, a: measure(p, a) if len(p) else _nothing(schema), schema)


def _nothing(schema: str) -> pd.DataFrame:
    return pd.DataFrame({c.split()[0]: [] for c in schema.split(", ")})


def _looked_up(asked: DataFrame, placed: DataFrame, offsets: DataFrame, bounds: DataFrame, outer: DataFrame, end: str) -> DataFrame:
    """`asked` with its `end` from the range that the radius reaches, the outermost one where it reaches beyond all."""
    keys = [*GROUP, "range"]
    columns = [*GROUP, "x", "radius", "reach_up", "reach_down", "upper", "lower", "k", "class_size"]
    # beyond the group's outermost value nothing is left to count
    reach = F.least("reach_up", "most") if end == "upper" else F.greatest("reach_down", "least")
    schema = "fold int, ordinal int, x double, radius double, reach_up double, reach_down double, upper long, lower long, k int, class_size long"

    def count(pdf, points):
        if not len(pdf) or not len(points):
            return pdf[columns] if len(pdf) else _nothing(schema)
        every = np.sort(points["x"].to_numpy())
        found = int(points["before"].iloc[0]) + nearer(every, pdf["x"].to_numpy(), pdf["radius"].to_numpy(), end == "upper")
        return pdf.assign(**{end: found})[columns]

    # bounds are values, so every range up to the outermost value holds one
    located = _placed(asked.select(*columns).join(F.broadcast(outer), GROUP), bounds, reach, "range").select(*columns, "range")
    held = placed.select(*keys, "x").join(offsets, keys)
    return located.groupBy(*keys).cogroup(held.join(located.select(*keys).distinct(), keys, "left_semi").groupBy(*keys)).applyInPandas(count, schema)


def _terms(far: DataFrame) -> DataFrame:
    """(fold, ordinal, held, total) of entities with a known m."""

    def total(batches):
        for pdf in batches:
            if len(pdf):
                m = np.maximum(pdf["m"].to_numpy(), 1)
                term = digamma(pdf["k"].to_numpy()) - digamma(pdf["class_size"].to_numpy()) - digamma(m)
                yield pdf[GROUP].assign(held=1, total=term).groupby(GROUP, as_index=False).sum()

    return far.mapInPandas(total, "fold int, ordinal int, held long, total double")


def _with_psi(psi: DataFrame) -> DataFrame:
    """A row per (fold, feature): psi(n) plus the mean of the terms."""

    def add(batches):
        for pdf in batches:
            if len(pdf):
                yield pdf[GROUP].assign(information=digamma(pdf["held"].to_numpy()) + pdf["total"].to_numpy() / pdf["held"].to_numpy())

    return psi.mapInPandas(add, "fold int, ordinal int, information double")
