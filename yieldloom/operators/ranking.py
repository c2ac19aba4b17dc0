"""Exact ranks, quantiles and first-m selections that no single task has to sort.

A window ordered over a whole group puts the group into one task. Here a group is cut into value ranges
first: the range totals are tiny and are summed up in order, and only rows of one range are ever sorted
together.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGES = 64
MOST_RANGES = 1 << 16
SAMPLE_PER_RANGE = 16
# Values per range to aim at: a group with more of them than its ranges would hold gets more ranges.
ROWS_PER_RANGE = 100_000
LEAST_DIGITS = 3
# A group is large if it holds more than this part of all rows, so there are no more large groups than that.
LARGE_GROUPS = 10_000


def ranges_for(spark: SparkSession, groups: int = 1) -> int:
    """Value ranges per group so that all groups together keep the cluster's shuffle partitions busy."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(RANGES, min(MOST_RANGES, -(-2 * partitions // max(1, groups))))


def large_groups(sizes: DataFrame, keys: Sequence[str], size: str) -> DataFrame:
    """(keys, __parts) of the groups that hold a large share of all rows: at most LARGE_GROUPS rows, whatever the
    number of groups, since each of them has more than that share."""
    share = F.floor(sizes.agg(F.coalesce(F.sum(size), F.lit(0))).scalar() / LARGE_GROUPS)
    least = F.greatest(F.lit(ROWS_PER_RANGE).cast("long"), share)
    return sizes.where(F.col(size) > least).select(*keys, F.ceil(F.col(size) / least).cast("int").alias("__parts"))


def salted_join(left: DataFrame, right: DataFrame, keys: Sequence[str], spread: str, heavy: DataFrame, how: str = "inner") -> DataFrame:
    """`left` joined with one row per group of `right`; groups of `heavy` meet in parts, dealt by hash of `spread`,
    and their row of `right` is repeated once per part."""
    parts = F.coalesce("__parts", F.lit(1))
    dealt = left.join(F.broadcast(heavy), list(keys), "left").withColumn("__part", F.pmod(F.xxhash64(spread), parts).cast("int")).drop("__parts")
    copies = right.join(F.broadcast(heavy), list(keys), "left").withColumn("__part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("__parts")
    return dealt.join(copies, [*keys, "__part"], how).drop("__part")


def prefix_sums(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    sums: Sequence[str],
    ranges: int | None = None,
    at: Column | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """`df` plus `<s>_before`, the sum of s over rows of the same group with a smaller `order` value, and
    `<s>_total`, the group's sum.

    `df` must hold one row per (keys, order), i.e. be aggregated by value already, so a value shared by a
    third of the input is one row here; the columns in `sums` are counts. Range bounds are a hash sample
    of the values, so they depend on the values alone: a task that runs again, or a plan that reads `df`
    twice, cuts at the same places. (A quantile sketch depends on merge order and would not.) `at`, a
    condition on the columns `range_<s>`, `range_before_<s>` and `<s>_total`, keeps only the ranges a
    caller needs rows of, and so spares the others the sort. `few_groups` says that the groups are bounded
    by the columns, folds or model configurations at hand, so that their bounds can be broadcast. Otherwise
    a large group meets its bounds in as many parts as its counted size asks for (see `salted_join`).
    """
    keys = list(keys)
    bounded = few_groups or not keys
    # a single group alone has to fill the cluster; an unknown number of groups does so together
    ranges = ranges or (RANGES if keys else ranges_for(df.sparkSession))

    # always true; with it every branch below reads the same columns, so the shuffle under `df` runs once
    counts = df
    for s in sums:
        counts = counts.where(F.col(s) >= 0)

    sizes = counts.groupBy(*keys).agg(F.count(order).alias("__size"))
    heavy = None if bounded else large_groups(sizes, keys, "__size")

    def join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
        if not on:
            return left.join(F.broadcast(right), how=how)
        # a range is small, so it needs no parts
        return left.join(F.broadcast(right) if bounded else right, on, how) if bounded or "__range" in on else salted_join(left, right, on, order, heavy, how)

    # a group's own number of ranges, by its counted size
    own = F.least(F.lit(MOST_RANGES), F.greatest(F.lit(ranges), F.ceil(F.col("__size") / ROWS_PER_RANGE).cast("int")))
    sizes = sizes.withColumn("__ranges", own)
    every = F.greatest(F.lit(1).cast("long"), F.floor(F.col("__size") / (SAMPLE_PER_RANGE * F.col("__ranges"))))
    sample = join(counts, sizes, keys).where(F.pmod(F.xxhash64(order), every) == 0)
    drawn = sample.groupBy(*keys).agg(F.array_sort(F.collect_set(order)).alias("__drawn"), F.max("__ranges").alias("__ranges"))
    steps = F.filter(F.sequence(F.lit(0), F.col("__ranges") - 1), lambda i: i > 0)
    cuts = F.transform(steps, lambda i: F.get("__drawn", F.floor(i * F.size("__drawn") / F.col("__ranges")).cast("int")))
    bounds = drawn.select(*keys, F.array_distinct(cuts).alias("__bounds"))

    # Binary search for the number of bounds below the value, a step per power of two. A lambda variable holds
    # the place so far; as nested expressions each step would repeat the ones before it.
    powers = F.array(*[F.lit(1 << i) for i in reversed(range(MOST_RANGES.bit_length() - 1))])
    place = F.aggregate(
        powers, F.lit(0), lambda at, step: F.when(F.get("__bounds", at + step - 1) < F.col(order), at + step).otherwise(at)
    )
    located = join(counts, bounds, keys, "left").withColumn("__range", place).drop("__bounds")
    group = Window.partitionBy(*keys)
    earlier = group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        located.groupBy(*keys, "__range")
        .agg(*[F.sum(s).alias(f"range_{s}") for s in sums])
        .select(
            "*",
            *[F.coalesce(F.sum(f"range_{s}").over(earlier), F.lit(0)).alias(f"range_before_{s}") for s in sums],
            *[F.sum(f"range_{s}").over(group).alias(f"{s}_total") for s in sums],
        )
    )
    if at is not None:
        offsets = offsets.where(at)
    offsets = offsets.drop(*[f"range_{s}" for s in sums])
    inside = Window.partitionBy(*keys, "__range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    joined = join(located, offsets, [*keys, "__range"])
    for s in sums:
        before = F.col(f"range_before_{s}") + F.coalesce(F.sum(s).over(inside), F.lit(0))
        joined = joined.withColumn(f"{s}_before", before)
    return joined.drop("__range", *[f"range_before_{s}" for s in sums])


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    ranges: int | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry of `probs`, missing values ignored.

    Same result as the built-in `percentile`, without its per-group map of all distinct values.
    """
    keys = list(keys)
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    return quantiles_of_counts(counts, keys, value, probs, ranges, few_groups)


def quantiles_of_counts(
    counts: DataFrame,
    keys: Sequence[str],
    value: str,
    probs: Mapping[str, float],
    ranges: int | None = None,
    few_groups: bool = False,
) -> DataFrame:
    """`exact_quantiles` on rows (keys, value, n)."""
    keys = list(keys)
    spots = {name: (F.col("n_total") - 1) * F.lit(float(p)) for name, p in probs.items()}
    wanted = F.lit(False)
    for spot in spots.values():
        wanted |= (F.col("range_before_n") <= F.ceil(spot)) & (
            F.floor(spot) < F.col("range_before_n") + F.col("range_n")
        )
    placed = prefix_sums(counts, keys, value, ["n"], ranges, wanted, few_groups)
    picks = []
    for name, spot in spots.items():
        for side, rank in (("lo", F.floor(spot)), ("hi", F.ceil(spot))):
            here = (F.col("n_before") <= rank) & (rank < F.col("n_before") + F.col("n"))
            picks.append(F.max(F.when(here, F.col(value))).alias(f"{name}_{side}"))
    chosen = placed.groupBy(*keys).agg(F.max("n_total").alias("n_total"), *picks)
    out = []
    for name, spot in spots.items():
        lo, hi = F.col(f"{name}_lo"), F.col(f"{name}_hi")
        out.append((lo + (hi - lo) * (spot - F.floor(spot))).alias(name))
    return chosen.select(*keys, *out)


def head_digits(spark: SparkSession) -> int:
    """Hex digits that cut a group into at least 64 digest ranges for each of the cluster's shuffle partitions."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    digits = LEAST_DIGITS
    while 16**digits < 64 * partitions:
        digits += 1
    return digits


def head_counts(df: DataFrame, keys: Sequence[str], digest: str, carry: Sequence[str] = (), digits: int | None = None) -> DataFrame:
    """(keys, head, head_one, head_<c>): rows and sums of c by the first digits of a hex digest; few rows, one per range."""
    head = F.substring(digest, 1, digits or head_digits(df.sparkSession)).alias("head")
    return df.groupBy(*keys, head).agg(F.count("*").alias("head_one"), *[F.sum(c).alias(f"head_{c}") for c in carry])


def first_by_hash(
    df: DataFrame, keys: Sequence[str], digest: str, wanted: DataFrame, carry: Sequence[str] = (), heads: DataFrame | None = None
) -> DataFrame:
    """Where the first `take` rows of a group end in digest order, for every row (keys, take) of `wanted`.

    Returns (keys, take, cut, <c>_taken): rows with digest <= cut are the first `take`, and <c>_taken is
    the sum of c over them. `digest` is a hex hash, so its first characters cut any group into ranges of
    nearly equal size, more of them on a larger cluster: one counting pass (or `heads`, if the caller has
    its `head_counts` already) finds the range a cut lies in, a second pass sorts the rows of that range only.
    """
    keys = list(keys)
    sums = ["one", *carry]
    digits = head_digits(df.sparkSession)
    headed = df.withColumn("head", F.substring(digest, 1, digits)).withColumn("one", F.lit(1).cast("long"))
    totals = head_counts(df, keys, digest, carry, digits) if heads is None else heads
    earlier = Window.partitionBy(*keys).orderBy("head").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("*", *[F.coalesce(F.sum(f"head_{s}").over(earlier), F.lit(0)).alias(f"before_{s}") for s in sums])
    hits = (
        offsets.join(wanted.select(*keys, "take"), keys)
        .where((F.col("before_one") < F.col("take")) & (F.col("take") <= F.col("before_one") + F.col("head_one")))
        .select(*keys, "head", "take", *[f"before_{s}" for s in sums])
    )
    inside = Window.partitionBy(*keys, "take").orderBy(digest).rowsBetween(Window.unboundedPreceding, 0)
    rows = headed.join(hits, [*keys, "head"]).select(
        *keys, "take", digest, *[(F.col(f"before_{s}") + F.sum(s).over(inside)).alias(f"upto_{s}") for s in sums]
    )
    return rows.where(F.col("upto_one") == F.col("take")).select(
        *keys, "take", F.col(digest).alias("cut"), *[F.col(f"upto_{c}").alias(f"{c}_taken") for c in carry]
    )
