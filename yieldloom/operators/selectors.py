"""Fold-local feature statistics and feature selection.

Every statistic uses training rows only. Expanding folds are nested, so a row is tagged once with the
first fold that trains on it (its block); fold k is the merge of blocks 0..k. No row is copied per fold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.functions import without_nan
from yieldloom.operators.comoments import TILE, by_fold, correlation, pair_rows, pair_states
from yieldloom.operators.longform import feature_name, values
from yieldloom.operators.ranking import prefix_sums, ranges_for
from yieldloom.sources.workspace import settled, stored
from yieldloom.spec import DEFAULT_SPEC, EntitySpec

# fixed values: names of the feature sets
FEATURE_SETS = [
    "keep_only",
    "keep_plus_review",
    "top_20_effect",
    "top_50_effect",
    "top_100_effect",
    "correlation_pruned_070",
    "correlation_pruned_085",
    "top_25_mutual_info",
    "top_50_mutual_info",
    "top_25_auc_gap",
    "top_50_auc_gap",
    "missingness_indicators_keep",
]
# score column and size of the ranked sets, threshold of the pruned ones
RANKED_SETS = {
    "top_20_effect": ("cohens_d", 20),
    "top_50_effect": ("cohens_d", 50),
    "top_100_effect": ("cohens_d", 100),
    "top_25_mutual_info": ("mutual_info", 25),
    "top_50_mutual_info": ("mutual_info", 50),
    "top_25_auc_gap": ("auc_gap", 25),
    "top_50_auc_gap": ("auc_gap", 50),
}
PRUNED_SETS = {"correlation_pruned_070": 0.70, "correlation_pruned_085": 0.85}


def train_blocks(df: DataFrame, in_train: Sequence[Column], spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Rows used for training, with y and the index of the first fold that trains on them.

    `in_train` holds one condition per fold, each implying the next one.
    """
    outside = [F.when(cond, 0).otherwise(1) for cond in in_train]
    block = sum(outside[1:], outside[0])
    return df.withColumn("y", spec.y()).withColumn("block", block).where(F.col("block") < len(in_train))


def fold_moments(rows: DataFrame, features: Sequence[str], n_folds: int) -> DataFrame:
    """Counts, means and squared deviations per (fold, feature) and class.

    One pass aggregates per block with map-side partials; merging blocks into folds touches only
    blocks x features rows.
    """
    classes = {"pass": 0, "fail": 1}
    aggs = [F.count("*").alias("rows"), F.sum("y").alias("fail_rows")]
    for name, y in classes.items():
        v = F.when(F.col("y") == y, F.col("value"))
        aggs += [
            F.count(v).alias(f"{name}_n"),
            F.avg(v).alias(f"{name}_mean"),
            F.var_pop(v).alias(f"{name}_var"),
            F.min(v).alias(f"{name}_min"),
            F.max(v).alias(f"{name}_max"),
        ]
    per_block = values(rows, features, ["y", "block"]).groupBy("block", "ordinal").agg(*aggs)
    of_fold = per_block.select("*", F.explode(F.sequence(F.col("block"), F.lit(n_folds - 1))).alias("fold"))

    merged = [F.sum("rows").alias("rows"), F.sum("fail_rows").alias("fail_rows")]
    for name in classes:
        # at most one state per block
        state = F.when(F.col(f"{name}_n") > 0, F.struct(*[F.col(f"{name}_{s}").alias(s) for s in ("n", "mean", "var")]))
        merged += [
            F.sum(f"{name}_n").alias(f"{name}_n"),
            F.min(f"{name}_min").alias(f"{name}_min"),
            F.max(f"{name}_max").alias(f"{name}_max"),
            F.collect_list(state).alias(f"{name}_states"),
        ]
    folds = of_fold.groupBy("fold", "ordinal").agg(*merged)

    def total(name: str, term) -> Column:
        return F.aggregate(f"{name}_states", F.lit(0.0), lambda acc, s: acc + term(s))

    for name in classes:
        mean = F.try_divide(total(name, lambda s: s["n"] * s["mean"]), F.col(f"{name}_n").cast("double"))
        folds = folds.withColumn(f"{name}_mean", mean)
    for name in classes:
        # deviations around the merged mean: within blocks plus between blocks
        mean = F.col(f"{name}_mean")
        m2 = total(name, lambda s, m=mean: s["n"] * (s["var"] + (s["mean"] - m) * (s["mean"] - m)))
        folds = folds.withColumn(f"{name}_m2", F.when(F.col(f"{name}_n") > 0, m2)).drop(f"{name}_states")
    return folds


def cohens_d() -> Column:
    """|mean gap| over the pooled sample deviation; 0 where undefined (a class with fewer than two values,
    or no spread, which is judged by the range because a rounded deviation can be tiny but not zero)."""
    pass_n, fail_n = F.col("pass_n"), F.col("fail_n")
    pooled = F.sqrt(F.try_divide(F.col("pass_m2") + F.col("fail_m2"), pass_n + fail_n - 2))
    spread = (F.col("pass_min") < F.col("pass_max")) | (F.col("fail_min") < F.col("fail_max"))
    d = F.abs(F.try_divide(F.col("pass_mean") - F.col("fail_mean"), pooled))
    return F.coalesce(F.when(spread & (pass_n > 1) & (fail_n > 1), d), F.lit(0.0))


def value_counts(rows: DataFrame, features: Sequence[str], n_folds: int) -> DataFrame:
    """(ordinal, value) with entities n_k and fails pos_k of every fold k.

    One shuffle by (feature, value) serves all folds: each fold is a pair of counters in the same row.
    """
    counters = [
        F.sum(F.when(F.col("block") <= k, weight).otherwise(0)).cast("long").alias(f"{kind}_{k}")
        for k in range(n_folds)
        for kind, weight in (("n", F.lit(1)), ("pos", F.col("y")))
    ]
    present = values(rows, features, ["y", "block"]).where(F.col("value").isNotNull())
    return present.groupBy("ordinal", "value").agg(*counters)


def value_ranks(counts: DataFrame, n_folds: int, ranges: int | None = None, at: Column | None = None) -> DataFrame:
    """(fold, ordinal, value) with its entities and fails, and those at smaller values of the same fold."""
    sums = [f"{kind}_{k}" for k in range(n_folds) for kind in ("n", "pos")]
    ranked = prefix_sums(counts, ["ordinal"], "value", sums, ranges, at, few_groups=True)
    per_fold = F.array(
        *[
            F.struct(
                F.lit(k).alias("fold"),
                *[
                    F.col(f"{kind}_{k}{suffix}").alias(f"{kind}{suffix}")
                    for kind in ("n", "pos")
                    for suffix in ("", "_before", "_total")
                ],
            )
            for k in range(n_folds)
        ]
    )
    return ranked.select("ordinal", "value", F.inline(per_fold)).where(F.col("n") > 0)


def fold_medians(counts: DataFrame, n_folds: int, ranges: int | None = None) -> DataFrame:
    """Exact median per (fold, feature). Only value ranges that hold a middle rank are sorted."""
    middle = F.lit(False)
    for k in range(n_folds):
        before, here, total = (F.col(c) for c in (f"range_before_n_{k}", f"range_n_{k}", f"n_{k}_total"))
        middle |= (before <= F.floor(total / 2)) & (F.floor((total - 1) / 2) < before + here)
    low, high = F.floor((F.col("n_total") - 1) / 2), F.floor(F.col("n_total") / 2)

    def value_at(rank: Column) -> Column:
        here = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
        return F.max(F.when(here, F.col("value")))

    ranks = value_ranks(counts, n_folds, ranges, middle)
    return ranks.groupBy("fold", "ordinal").agg(((value_at(low) + value_at(high)) / 2).alias("median"))


def feature_scores(
    df: DataFrame, in_train: Sequence[Column], spec: EntitySpec = DEFAULT_SPEC, bins: int = 16
) -> DataFrame:
    """All fold-local statistics of every feature, one row per (fold, feature).

    Cohen's d; median; AUC gap and mutual information after filling missing values with the median; mean
    and population deviation after filling. Folds are numbered from 1.
    """
    features = spec.prefixed(df)
    n_folds = len(in_train)
    keys = ["fold", "ordinal"]
    rows = train_blocks(df, in_train, spec)
    # the one pass over all cells; medians and ranks, which are separate jobs, read its result
    counts = stored(value_counts(rows, features, n_folds), "value-counts")
    ranges = ranges_for(df.sparkSession, len(features))
    facts = fold_moments(rows, features, n_folds).join(fold_medians(counts, n_folds, ranges), keys, "left")
    facts = facts.withColumn("null_count", F.col("rows") - F.col("pass_n") - F.col("fail_n")).withColumn(
        "null_fails", F.col("fail_rows") - F.col("fail_n")
    )
    # folds x columns rows, read three times below
    facts = settled(facts)

    # one pass over the ranked values, reduced to at most `bins` rows per feature and fold
    filler = facts.select(*keys, "median", "rows", "null_count", "null_fails")
    placed = value_ranks(counts, n_folds, ranges).join(F.broadcast(filler), keys)
    n, pos = F.col("n"), F.col("pos")
    neg, neg_before = n - pos, F.col("n_before") - F.col("pos_before")
    null_negs = F.col("null_count") - F.col("null_fails")
    above, at = F.col("value") > F.col("median"), F.col("value") == F.col("median")
    share_below = F.when(above, 1.0).when(at, 0.5).otherwise(0.0)

    # rank bins after filling: equal values share a bin, the filled rows sit at the median
    def bin_of(before: Column) -> Column:
        return F.floor(before * bins / F.col("rows"))

    cells = placed.groupBy(
        *keys, bin_of(F.col("n_before") + F.when(above, F.col("null_count")).otherwise(0)).alias("bin")
    ).agg(
        F.sum("n").alias("n"),
        F.sum("pos").alias("pos"),
        F.count("*").alias("values"),
        F.sum(pos * (neg_before + neg / 2)).alias("own_pairs"),
        F.sum(pos * null_negs * share_below).alias("over_filler"),
        F.sum(neg * (F.lit(1.0) - share_below)).alias("under_filler"),
        F.sum(F.when(F.col("value") < F.col("median"), n).otherwise(0)).alias("below_median"),
    )
    pair_sums = ["values", "own_pairs", "over_filler", "under_filler", "below_median"]
    of_feature = cells.groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in pair_sums],
        F.collect_list(F.struct("bin", "n", "pos")).alias("cells"),
    )
    facts = facts.join(of_feature, keys, "left")
    won = F.col("own_pairs") + F.col("over_filler") + F.col("null_fails") * (F.col("under_filler") + null_negs / 2)
    all_pairs = F.col("fail_rows") * (F.col("rows") - F.col("fail_rows"))
    # |AUC - 0.5| from whole and half pairs, so mirrored rankings get the very same number
    gap = F.try_divide(F.abs(2 * won - all_pairs), (2 * all_pairs).cast("double"))
    auc_gap = F.coalesce(F.when(F.col("values") > 1, gap), F.lit(0.0))

    filled_bin = bin_of(F.col("below_median"))
    here = F.filter("cells", lambda c: c["bin"] == filled_bin)

    def information(cell_n: Column, cell_pos: Column) -> Column:
        def term(joint: Column, margin: Column) -> Column:
            ratio = joint * F.col("rows") / (cell_n * margin)
            return F.when(joint > 0, joint / F.col("rows") * F.log(ratio)).otherwise(0.0)

        return term(cell_pos, F.col("fail_rows")) + term(cell_n - cell_pos, F.col("rows") - F.col("fail_rows"))

    own = F.aggregate(
        F.filter("cells", lambda c: (c["bin"] != filled_bin) | (F.col("null_count") == 0)),
        F.lit(0.0),
        lambda acc, c: acc + information(c["n"], c["pos"]),
    )
    with_filler = information(
        F.coalesce(F.get(here, 0)["n"], F.lit(0)) + F.col("null_count"),
        F.coalesce(F.get(here, 0)["pos"], F.lit(0)) + F.col("null_fails"),
    )
    mutual_info = own + F.when(F.col("null_count") > 0, with_filler).otherwise(0.0)

    value_n = F.col("pass_n") + F.col("fail_n")
    own_sum = F.col("pass_n") * F.coalesce("pass_mean", F.lit(0.0)) + F.col("fail_n") * F.coalesce("fail_mean", F.lit(0.0))
    fill_mean = (own_sum + F.col("null_count") * F.coalesce("median", F.lit(0.0))) / F.col("rows")

    def around(count: Column, mean: str, m2: str) -> Column:
        return F.coalesce(F.col(m2) + count * F.pow(F.col(mean) - F.col("fill_mean"), F.lit(2)), F.lit(0.0))

    fill_m2 = (
        around(F.col("pass_n"), "pass_mean", "pass_m2")
        + around(F.col("fail_n"), "fail_mean", "fail_m2")
        + F.col("null_count") * F.coalesce(F.pow(F.col("median") - F.col("fill_mean"), F.lit(2)), F.lit(0.0))
    )
    constant = F.least("pass_min", "fail_min") == F.greatest("pass_max", "fail_max")
    scored = facts.withColumn("fill_mean", F.when(value_n > 0, fill_mean))
    return scored.select(
        (F.col("fold") + 1).alias("fold"),
        F.col("ordinal").alias("feature_ordinal"),
        feature_name(features).alias("feature_name"),
        "rows",
        F.col("fail_rows").cast("long").alias("fail_rows"),
        "null_count",
        value_n.alias("value_count"),
        cohens_d().alias("cohens_d"),
        auc_gap.alias("auc_gap"),
        F.greatest(F.coalesce(F.when(F.col("values") > 1, mutual_info), F.lit(0.0)), F.lit(0.0)).alias("mutual_info"),
        "median",
        "fill_mean",
        F.when(constant, 0.0).when(value_n > 0, F.sqrt(fill_m2 / F.col("rows"))).alias("fill_std"),
    )


def correlations(
    df: DataFrame,
    features: Sequence[str],
    in_train: Sequence[Column] | None = None,
    spec: EntitySpec = DEFAULT_SPEC,
    tile: int = TILE,
) -> DataFrame:
    """Pairwise-complete Pearson correlation of every feature pair i < j per fold; undefined is NULL.

    Each task folds its rows into co-moment tiles of the blocks it meets, so neither entities nor pairs per
    entity are shuffled; see `comoments`.
    """
    rows = train_blocks(df, in_train or [F.lit(True)], spec)
    n_folds = len(in_train or [None])
    packed = F.array(*[without_nan(F.col(f"`{c}`")) for c in features])
    states = pair_states(rows.select(F.array(F.col("block").cast("int")).alias("groups"), packed.alias("v")), len(features), n_folds, tile)
    return pair_rows(by_fold(states, n_folds), "fold", len(features), tile).select(
        (F.col("fold") + 1).alias("fold"),
        feature_name(features, "i").alias("feature_i"),
        feature_name(features, "j").alias("feature_j"),
        F.col("n").cast("long").alias("n"),
        correlation().alias("r"),
    )


def correlation_pruned(pairs: DataFrame, features: Sequence[str], threshold: float) -> DataFrame:
    """Features left after dropping, per fold, the later one of each pair with |r| >= threshold.

    A dropped feature still counts as a partner, so the result is an anti join, not a scan in order.
    """
    dropped = pairs.where(F.abs("r") >= F.lit(threshold)).select("fold", F.col("feature_j").alias("feature_name")).distinct()
    folds = pairs.select("fold").distinct()
    # folds x columns rows
    every = folds.select("fold", F.posexplode(F.array(*[F.lit(c) for c in features])).alias("feature_ordinal", "feature_name"))
    return every.join(dropped, ["fold", "feature_name"], "left_anti").select("fold", "feature_ordinal", "feature_name")


def top_by_score(scores: DataFrame, score: str, n: int) -> DataFrame:
    """The n best features of each fold; equal scores (to 12 digits) keep column order."""
    best = Window.partitionBy("fold").orderBy(F.round(score, 12).desc(), "feature_ordinal")
    return (
        scores.withColumn("position", F.row_number().over(best))
        .where(F.col("position") <= n)
        .select("fold", "position", "feature_name")
    )


def static_feature_sets(catalog: DataFrame) -> DataFrame:
    """keep_only and keep_plus_review as rows, in column order."""
    action = F.col("recommended_action")
    sets = F.array_compact(
        F.array(
            F.when(action == "keep", "keep_only"),
            F.when(action.isin("keep", "review_high_missing"), "keep_plus_review"),
        )
    )
    return catalog.select(F.explode(sets).alias("feature_set"), "feature_ordinal", "feature_name")


def missing_indicators(scores: DataFrame, keep_only: DataFrame) -> DataFrame:
    """keep_only features followed by an indicator `<feature>_missing` for those incomplete in training."""
    kept = scores.join(keep_only.select("feature_name"), "feature_name", "left_semi")
    base = kept.select("fold", F.lit(0).alias("part"), "feature_ordinal", "feature_name")
    flags = kept.where(F.col("null_count") > 0).select(
        "fold", F.lit(1).alias("part"), "feature_ordinal", F.concat("feature_name", F.lit("_missing")).alias("feature_name")
    )
    order = Window.partitionBy("fold").orderBy("part", "feature_ordinal")
    return base.unionByName(flags).select("fold", F.row_number().over(order).alias("position"), "feature_name")


def resolve_feature_sets(
    scores: DataFrame,
    catalog: DataFrame,
    pairs: DataFrame | None = None,
    names: Sequence[str] = tuple(FEATURE_SETS),
) -> DataFrame:
    """(feature_set, fold, position, feature_name) for the named sets; a set without features has no rows.

    `pairs` are the correlations of the keep_plus_review features, needed for the pruned sets.
    """
    static = static_feature_sets(catalog)
    folds = scores.select("fold").distinct()
    in_order = Window.partitionBy("fold").orderBy("feature_ordinal")

    def placed(df: DataFrame) -> DataFrame:
        return df.select("fold", F.row_number().over(in_order).alias("position"), "feature_name")

    parts = []
    for name in names:
        if name in RANKED_SETS:
            part = top_by_score(scores, *RANKED_SETS[name])
        elif name in PRUNED_SETS:
            if pairs is None:
                raise ValueError(f"{name} needs the correlation pairs")
            base = static.where(F.col("feature_set") == "keep_plus_review").select("feature_ordinal", "feature_name")
            dropped = pairs.where(F.abs("r") >= F.lit(PRUNED_SETS[name])).select(
                "fold", F.col("feature_j").alias("feature_name")
            )
            # folds x columns rows
            every = scores.select("fold", "feature_name").join(base, "feature_name")
            part = placed(every.join(dropped, ["fold", "feature_name"], "left_anti"))
        elif name == "missingness_indicators_keep":
            part = missing_indicators(scores, static.where(F.col("feature_set") == "keep_only"))
        else:
            chosen = static.where(F.col("feature_set") == name).select("feature_ordinal", "feature_name")
            part = placed(scores.select("fold", "feature_name").join(chosen, "feature_name"))
        parts.append(part.select(F.lit(name).alias("feature_set"), "fold", "position", "feature_name"))
    resolved = parts[0]
    for part in parts[1:]:
        resolved = resolved.unionByName(part)
    return resolved
