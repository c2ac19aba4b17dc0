"""Ranking and threshold metrics of scored entities.

Scored rows are (keys..., entity_id, y_true, risk); every function works on any number of key groups at
once (models, feature sets, folds) and never holds a group in one task. Rows without a score are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.functions import edge_index, half_even, ratio_or_zero, unit_hash, without_nan
from yieldloom.operators.ranking import first_by_hash, prefix_sums

INSPECTION_RATES = (0.05, 0.10, 0.20)
# 0.01 + i * 0.01 in doubles, which is not i / 100 everywhere
THRESHOLDS = tuple(0.01 + i * 0.01 for i in range(99))


def with_score(scored: DataFrame) -> DataFrame:
    """Rows that have a score."""
    return scored.withColumn("risk", without_nan(F.col("risk"))).where(F.col("risk").isNotNull())


def score_counts(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Entities and fails per distinct score: everything the ranking metrics need, ties already merged."""
    return with_score(scored).groupBy(*keys, "risk").agg(F.count("*").alias("n"), F.sum("y_true").alias("pos"))


def ranked_scores(scored: DataFrame, keys: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """`score_counts` with the entities and fails at higher scores, and the group totals."""
    counts = score_counts(scored, keys).withColumn("down", -F.col("risk"))
    return prefix_sums(counts, keys, "down", ["n", "pos"], few_groups=few_groups)


def cumulative_hits(scored: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Entities inspected and fails caught down to and including each score."""
    return ranked_scores(scored, keys).select(
        *keys,
        "risk",
        (F.col("n_before") + F.col("n")).alias("inspected"),
        (F.col("pos_before") + F.col("pos")).alias("captured_fails"),
    )


def discrimination(scored: DataFrame, keys: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """Average precision, ROC AUC and median score per group, ties handled exactly; one class gives NULL."""
    return discrimination_of(ranked_scores(scored, keys, few_groups), keys)


def discrimination_of(ranked: DataFrame, keys: Sequence[str]) -> DataFrame:
    n, pos = F.col("n"), F.col("pos")
    neg = n - pos
    total_neg = F.col("n_total") - F.col("pos_total")
    neg_below = total_neg - (F.col("n_before") - F.col("pos_before")) - neg
    precision_here = (F.col("pos_before") + pos) / (F.col("n_before") + n)
    # the two middle ranks of the group, counted from either end
    low, high = F.floor((F.col("n_total") - 1) / 2), F.floor(F.col("n_total") / 2)

    def score_at(rank: Column) -> Column:
        return F.max(F.when((F.col("n_before") <= rank) & (rank < F.col("n_before") + n), F.col("risk")))

    sums = ranked.groupBy(*keys).agg(
        F.max("n_total").alias("n_total"),
        F.max("pos_total").alias("pos_total"),
        F.sum(pos * precision_here).alias("precision_mass"),
        F.sum(pos * (neg_below + neg / 2)).alias("pairs_won"),
        ((score_at(low) + score_at(high)) / 2).alias("median_risk"),
    )
    n_neg = F.col("n_total") - F.col("pos_total")
    both = (F.col("pos_total") > 0) & (n_neg > 0)
    return sums.select(
        *keys,
        F.col("n_total").alias("n_scored"),
        F.col("pos_total").alias("n_fails"),
        F.when(both, F.try_divide(F.col("precision_mass"), F.col("pos_total"))).alias("pr_auc"),
        F.when(both, F.try_divide(F.col("pairs_won"), F.col("pos_total") * n_neg)).alias("roc_auc"),
        "median_risk",
    )


def confusion(scored: DataFrame, threshold: Column | float, keys: Sequence[str] = ()) -> DataFrame:
    """The four confusion cells at a threshold, always all four."""
    limit = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    hit, fail = F.col("risk") >= limit, F.col("y_true") == 1
    return with_score(scored).groupBy(*keys).agg(
        F.count_if(~hit & ~fail).alias("tn"),
        F.count_if(hit & ~fail).alias("fp"),
        F.count_if(~hit & fail).alias("fn"),
        F.count_if(hit & fail).alias("tp"),
    )


def with_rates(cells: DataFrame) -> DataFrame:
    """Precision, recall, F1 (0 where undefined) and balanced accuracy (over the classes present)."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    recall, specificity = F.try_divide(tp, tp + fn), F.try_divide(tn, tn + fp)
    balanced = F.coalesce((recall + specificity) / 2, recall, specificity)
    return (
        cells.withColumn("precision", ratio_or_zero(tp, tp + fp))
        .withColumn("recall", ratio_or_zero(tp, tp + fn))
        .withColumn("f1", ratio_or_zero(2 * tp, 2 * tp + fp + fn))
        .withColumn("balanced_accuracy", balanced)
    )


def median_cut_rates(scored: DataFrame, keys: Sequence[str] = (), few_groups: bool = False) -> DataFrame:
    """Ranking metrics plus the classification rates when the upper half of the scores is called a fail."""
    cut = discrimination(scored, keys, few_groups)
    # the cells only need the counts per score, not their order
    counts = score_counts(scored, keys)
    small = F.broadcast(cut) if few_groups or not keys else cut
    joined = counts.join(small, list(keys)) if keys else counts.join(small)
    hit = F.col("risk") >= F.col("median_risk")
    cells = joined.groupBy(*keys).agg(
        *[F.max(c).alias(c) for c in ("n_scored", "n_fails", "pr_auc", "roc_auc", "median_risk")],
        F.sum(F.when(hit, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, F.col("n") - F.col("pos")).otherwise(0)).alias("fp"),
        F.sum(F.when(hit, 0).otherwise(F.col("pos"))).alias("fn"),
        F.sum(F.when(hit, 0).otherwise(F.col("n") - F.col("pos"))).alias("tn"),
    )
    return with_rates(cells)


def threshold_sweep(
    scored: DataFrame, keys: Sequence[str] = (), thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """Precision, recall, F1 and counts at every threshold; `selected` marks the lowest one with the best F1.

    Each row is reduced to the number of thresholds it reaches, so one aggregate with at most
    len(thresholds) + 1 rows per group replaces a pass per threshold.
    """
    keys = list(keys)
    grid = sorted(float(t) for t in thresholds)
    reached = (
        with_score(scored)
        .groupBy(*keys, edge_index(F.col("risk"), grid).alias("reached"))
        .agg(F.count("*").alias("n"), F.sum("y_true").alias("pos"))
    )
    # without any score the sums are NULL, the counts of the sweep 0
    totals = reached.groupBy(*keys).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_total") for c in ("n", "pos")])
    steps = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(t).alias("cut")) for i, t in enumerate(grid)])
    points = totals.select("*", F.explode(steps).alias("point")).select(*keys, "n_total", "pos_total", "point.*")
    hits = reached.withColumnRenamed("reached", "step")
    # suffix sums over the grid: at most one row per threshold and group
    upward = Window.partitionBy(*keys).orderBy(F.col("step").desc())
    filled = (
        points.join(hits, [*keys, "step"], "left")
        .withColumn("predicted_fail_count", F.sum(F.coalesce("n", F.lit(0))).over(upward))
        .withColumn("tp", F.sum(F.coalesce("pos", F.lit(0))).over(upward))
        .withColumn("fp", F.col("predicted_fail_count") - F.col("tp"))
        .withColumn("fn", F.col("pos_total") - F.col("tp"))
        .withColumn("tn", F.col("n_total") - F.col("predicted_fail_count") - F.col("fn"))
    )
    rated = with_rates(filled)
    best = Window.partitionBy(*keys).orderBy(F.col("f1").desc(), F.col("cut"))
    return rated.select(
        *keys,
        F.round("cut", 2).alias("threshold"),
        "cut",
        "precision",
        "recall",
        "f1",
        "predicted_fail_count",
        F.col("fp").alias("false_positive_count"),
        F.col("fn").alias("false_negative_count"),
        half_even(ratio_or_zero(F.col("predicted_fail_count"), F.col("n_total")), 4).alias("inspection_rate"),
        (F.row_number().over(best) == 1).alias("selected"),
    )


def threshold_analysis(sweep: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return sweep.select(*keys, "threshold", "precision", "recall", "f1", "selected")


def threshold_cost_curve(sweep: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return sweep.drop("cut")


def score_quantile_grid(scored: DataFrame, points: int = 99) -> list[float]:
    """Thresholds for scores that do not live on [0, 1]: distinct approximate score quantiles."""
    steps = [(i + 1) / (points + 1) for i in range(points)]
    row = with_score(scored).agg(F.percentile_approx("risk", steps, 10000).alias("grid")).first()
    return sorted(set(row.grid or []))


def probability_bins(scored: DataFrame, keys: Sequence[str] = (), n_bins: int = 5) -> DataFrame:
    """Entities and fails in equal bins of [0, 1], the last bin closed; empty bins are kept."""
    keys = list(keys)
    edges = [i / n_bins for i in range(n_bins)]
    inside = with_score(scored).where((F.col("risk") >= 0.0) & (F.col("risk") <= 1.0))
    counts = inside.groupBy(*keys, (edge_index(F.col("risk"), edges) - 1).alias("bin")).agg(
        F.count("*").alias("n"), F.sum("y_true").alias("pos")
    )
    grid = F.array(
        *[
            F.struct(F.lit(i).alias("bin"), F.lit(i / n_bins).alias("lo"), F.lit((i + 1) / n_bins).alias("hi"))
            for i in range(n_bins)
        ]
    )
    groups = scored.select(*keys).distinct() if keys else scored.sparkSession.range(0, 1, 1, 1)
    bins = groups.select(*keys, F.explode(grid).alias("b")).select(*keys, "b.*")
    n, pos = F.coalesce("n", F.lit(0)).cast("long"), F.coalesce("pos", F.lit(0)).cast("long")
    return bins.join(counts, [*keys, "bin"], "left").select(
        *keys,
        F.round("lo", 2).alias("bin_min"),
        F.round("hi", 2).alias("bin_max"),
        n.alias("total_entities"),
        pos.alias("fail_count"),
        half_even(ratio_or_zero(pos, n), 4).alias("fail_rate"),
    )


def inspection(
    scored: DataFrame,
    keys: Sequence[str] = (),
    rates: Sequence[float] = INSPECTION_RATES,
    entity: str = "entity_id",
    seed: int = 0,
    few_groups: bool = False,
) -> DataFrame:
    """Fails caught when the riskiest share of the entities is inspected, one row per group and rate.

    k = max(1, rate * n rounded half to even). The cut falls inside one distinct score; when that score is
    shared, entities are taken in hash order of their id, which is neutral and repeatable. Only the tied
    entities of a cut are looked at again, and only those of one digest range are sorted.
    """
    keys = list(keys)
    ranked = ranked_scores(scored, keys, few_groups)

    def inspected(n: Column, rate: float) -> Column:
        return F.greatest(F.lit(1).cast("long"), F.rint(n * F.lit(float(rate))).cast("long"))

    def targets(n: Column) -> Column:
        return F.array(*[F.struct(F.lit(float(r)).alias("rate"), inspected(n, r).alias("k")) for r in rates])

    upto = F.col("n_before") + F.col("n")
    here = F.filter(targets(F.col("n_total")), lambda t: (t["k"] > F.col("n_before")) & (t["k"] <= upto))
    crossing = (
        ranked.select("*", F.explode(here).alias("t"))
        .withColumn("rate", F.col("t.rate"))
        .withColumn("take", F.col("t.k") - F.col("n_before"))
        .select(*keys, "rate", "take", "risk", "n", "pos", "pos_before")
    )
    shared = crossing.where(F.col("take") < F.col("n")).select(*keys, "risk", "take").distinct()
    # one cut score per group and rate: bounded for few groups, for many AQE sees the size
    cut_scores = shared.select(*keys, "risk").distinct()
    bounded = few_groups or not keys
    tied = (
        with_score(scored)
        .select(*keys, "risk", "y_true", unit_hash(F.col(entity), seed).alias("digest"))
        .join(F.broadcast(cut_scores) if bounded else cut_scores, [*keys, "risk"], "left_semi")
    )
    partial = first_by_hash(tied, [*keys, "risk"], "digest", shared, ["y_true"]).drop("cut")
    caught = crossing.join(partial, [*keys, "risk", "take"], "left").select(
        *keys,
        "rate",
        (
            F.col("pos_before") + F.when(F.col("take") == F.col("n"), F.col("pos")).otherwise(F.col("y_true_taken"))
        ).alias("captured_fails"),
    )
    totals = with_score(scored).groupBy(*keys).agg(F.count("*").alias("n"), F.coalesce(F.sum("y_true"), F.lit(0)).alias("p"))
    wanted = totals.select("*", F.explode(targets(F.col("n"))).alias("t")).select(*keys, "n", "p", "t.*")
    joined = wanted.join(caught, [*keys, "rate"], "left")
    hits = F.coalesce("captured_fails", F.lit(0)).cast("long")
    precision = ratio_or_zero(hits, F.col("k"))
    return joined.select(
        *keys,
        F.col("rate").alias("inspection_rate"),
        F.col("k").alias("inspected"),
        half_even(ratio_or_zero(hits, F.col("p")), 4).alias("recall"),
        half_even(precision, 4).alias("precision"),
        half_even(ratio_or_zero(precision, ratio_or_zero(F.col("p"), F.col("n"))), 4).alias("lift"),
        hits.alias("captured_fails"),
    )


def inspection_curve(scored: DataFrame, keys: Sequence[str] = (), n_points: int = 20, **kwargs) -> DataFrame:
    """`inspection` at n_points equally spaced rates up to everything."""
    rates = [i / n_points for i in range(1, n_points + 1)]
    curve = inspection(scored, keys, rates, **kwargs)
    return curve.withColumn("inspection_rate", F.round("inspection_rate", 2)).drop("inspected")


def rate_label(rate: float) -> str:
    return f"{int(rate * 100):02d}pct"


def inspection_metrics(
    scored: DataFrame, keys: Sequence[str] = (), rates: Sequence[float] = INSPECTION_RATES, **kwargs
) -> DataFrame:
    """`inspection` as one row per group with columns recall_at_05pct, precision_at_05pct, ..."""
    rows = inspection(scored, keys, rates, **kwargs)
    columns = []
    for rate in rates:
        here = F.col("inspection_rate") == F.lit(float(rate))
        for name in ("recall", "precision", "captured_fails", "lift"):
            columns.append(F.max(F.when(here, F.col(name))).alias(f"{name}_at_{rate_label(rate)}"))
    return rows.groupBy(*keys).agg(*columns)


def curve_point(curve: DataFrame, rate: float) -> DataFrame:
    """One row: the curve at a rate, zeros if the curve has no such point."""
    near = curve.where(F.abs(F.col("inspection_rate") - F.lit(float(rate))) < F.lit(0.001))
    return near.agg(
        *[F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in ("recall", "precision", "lift")],
        F.coalesce(F.max("captured_fails"), F.lit(0)).cast("long").alias("captured_fails"),
    ).select(F.lit(float(rate)).alias("inspection_rate"), "*")
