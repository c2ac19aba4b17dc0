"""Leakage-safe splits on whole calendar dates, and repeatable random splits."""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.functions import ratio_or_zero, unit_hash
from yieldloom.operators.ranking import first_by_hash, head_counts
from yieldloom.sources.workspace import settled
from yieldloom.spec import DEFAULT_SPEC, EntitySpec


def date_counts(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Dates in order with their ordinal and running totals: one row per calendar day."""
    daily = (
        df.select(spec.date().alias("event_date"), spec.y().alias("y"))
        .where(F.col("event_date").isNotNull())
        .groupBy("event_date")
        .agg(F.count("*").alias("row_count"), F.sum("y").alias("fail_count"))
    )
    in_order = Window.orderBy("event_date")
    return daily.select(
        "*",
        (F.row_number().over(in_order) - 1).alias("date_ordinal"),
        F.sum("row_count").over(in_order).alias("rows_so_far"),
        F.sum("fail_count").over(in_order).alias("fails_so_far"),
    )


def test_start(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC, test_size: float = 0.15) -> DataFrame:
    """One row: the first date of the newest `test_size` share of dates (at least one date)."""
    dates = date_counts(df, spec).select("event_date", "date_ordinal")
    n = dates.agg(F.count("*")).scalar()
    n_test = F.greatest(F.lit(1), F.rint(n * F.lit(test_size)).cast("int"))
    n_dev = F.when(n - n_test > 0, n - n_test).otherwise(n - 1)
    return dates.where(F.col("date_ordinal") == n_dev).agg(F.min("event_date").alias("test_start"))


def _test_from(df: DataFrame, spec: EntitySpec, test_size: float) -> Column:
    """Midnight of the first test date, as a literal of the timestamp column's own type. Reads the dates once."""
    start = test_start(df, spec, test_size).first().test_start
    return F.lit(start).cast(df.schema[spec.ts].dataType)


def split_dev_test(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC, test_size: float = 0.15) -> DataFrame:
    """`df` plus `split`: dev for the oldest dates, test for the newest. No date is in both.

    To read one part only, take `dev_and_test`: a filter on `split` does not reach a scan.
    """
    late = F.col(spec.ts) >= _test_from(df, spec, test_size)
    return df.where(F.col(spec.ts).isNotNull()).withColumn("split", F.when(late, "test").otherwise("dev"))


def dev_and_test(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC, test_size: float = 0.15) -> tuple[DataFrame, DataFrame]:
    """The oldest dates and the newest, each behind a timestamp filter that a scan takes over."""
    start = _test_from(df, spec, test_size)
    return df.where(F.col(spec.ts) < start), df.where(F.col(spec.ts) >= start)


def expanding_folds(
    df: DataFrame, spec: EntitySpec = DEFAULT_SPEC, n_splits: int = 4, min_fails: int = 8
) -> DataFrame:
    """Expanding-window folds as rows: fold i trains on all dates before its test block.

    All split counts from `n_splits` down to 1 are laid out at once over the per-day totals; the largest
    one whose folds all have `min_fails` fails on both sides is returned, and no rows if none has.
    """
    dates = date_counts(df, spec)
    totals = dates.agg(F.count("*").alias("n_dates"), F.sum("fail_count").alias("n_fails"))
    layout = (
        totals.select("*", F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("n_splits"))
        .where((F.col("n_dates") > F.col("n_splits")) & (F.col("n_fails") >= (F.col("n_splits") + 1) * min_fails))
        .select("*", F.explode(F.sequence(F.lit(1), F.col("n_splits"))).alias("fold"))
        .select(
            "n_splits",
            "fold",
            F.expr("fold * n_dates div (n_splits + 1)").alias("lo"),
            F.expr("(fold + 1) * n_dates div (n_splits + 1)").alias("hi"),
        )
    )

    def at(ordinal: str, **columns: str) -> DataFrame:
        return dates.select(F.col("date_ordinal").cast("long").alias(ordinal), *[F.col(c).alias(n) for n, c in columns.items()])

    folds = (
        layout.withColumn("train_last", F.col("lo") - 1)
        .withColumn("test_last", F.col("hi") - 1)
        .join(
            at("train_last", train_end_date="event_date", train_fails="fails_so_far", train_rows="rows_so_far"),
            "train_last",
        )
        .join(at("lo", test_start_date="event_date"), "lo")
        .join(at("test_last", test_end_date="event_date", fails_upto="fails_so_far", rows_upto="rows_so_far"), "test_last")
        .withColumn("test_fails", F.col("fails_upto") - F.col("train_fails"))
        .withColumn("test_rows", F.col("rows_upto") - F.col("train_rows"))
        .where((F.col("lo") > 0) & (F.col("hi") > F.col("lo")))
        .where((F.col("train_fails") >= min_fails) & (F.col("test_fails") >= min_fails))
    )
    of_layout = Window.partitionBy("n_splits")
    complete = folds.withColumn("n_valid", F.count("*").over(of_layout)).where(F.col("n_valid") == F.col("n_splits"))
    best = complete.withColumn("best", F.max("n_splits").over(Window.partitionBy())).where("n_splits = best")
    first_date = dates.agg(F.min("event_date")).scalar()
    return best.select(
        "n_splits",
        "fold",
        first_date.alias("train_start_date"),
        "train_end_date",
        "test_start_date",
        "test_end_date",
        "train_rows",
        "test_rows",
        "train_fails",
        "test_fails",
    )


@dataclass(frozen=True)
class Fold:
    """Date bounds of one fold. Membership is a condition on the date, so no join assigns rows to folds."""

    fold: int
    n_splits: int
    train_start_date: datetime.date
    train_end_date: datetime.date
    test_start_date: datetime.date | None
    test_end_date: datetime.date | None
    train_fails: int
    test_fails: int

    def in_train(self, spec: EntitySpec = DEFAULT_SPEC) -> Column:
        return spec.date() <= F.lit(self.train_end_date)

    def in_test(self, spec: EntitySpec = DEFAULT_SPEC) -> Column:
        return spec.date().between(F.lit(self.test_start_date), F.lit(self.test_end_date))


def read_folds(folds: DataFrame) -> list[Fold]:
    """The fold bounds on the driver: at most `n_splits` rows."""
    rows = folds.orderBy("fold").collect()
    if not rows:
        raise ValueError("no split leaves enough fails in every fold")
    return [Fold(**{k: r[k] for k in Fold.__dataclass_fields__}) for r in rows]


def assign_folds(df: DataFrame, folds: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Rows with the folds they belong to and their role there; one row can train several folds.

    A range join against the fold bounds, which are at most `n_splits` rows and therefore broadcast.
    """
    bounds = folds.select("fold", "test_start_date", "test_end_date")
    joined = df.withColumn("event_date", spec.date()).join(
        F.broadcast(bounds), F.col("event_date") <= F.col("test_end_date")
    )
    role = F.when(F.col("event_date") < F.col("test_start_date"), "train").otherwise("test")
    return joined.withColumn("role", role).drop("test_start_date", "test_end_date")


def stratified_split(
    df: DataFrame, spec: EntitySpec = DEFAULT_SPEC, test_size: float = 0.30, seed: int = 42
) -> DataFrame:
    """`df` plus `split`: train or test, with the same test share in each class, in repeatable hash order.

    Reads the ids twice, for the two cut digests; these are literals then, so each part is a plain filter
    and needs no copy of the table.
    """
    digested = df.select(spec.y().alias("y"), unit_hash(F.col(spec.id), seed).alias("digest"))
    heads = settled(head_counts(digested, ["y"], "digest"))
    counts = heads.groupBy("y").agg(F.sum("head_one").alias("n"))
    wanted = counts.select("y", F.rint(F.col("n") * F.lit(test_size)).cast("long").alias("take"))
    cuts = {r["y"]: r["cut"] for r in first_by_hash(digested, ["y"], "digest", wanted, heads=heads).select("y", "cut").collect()}
    digest = unit_hash(F.col(spec.id), seed)
    inside = F.lit(False)
    for y, cut in cuts.items():
        inside |= (spec.y() == y) & (digest <= F.lit(cut))
    return df.withColumn("split", F.when(inside, "test").otherwise("train"))


def undersample(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC, seed: int = 42) -> DataFrame:
    """All fails and equally many passes in repeatable hash order; no rows if there are too few passes.

    Reads the ids twice, for one cut digest, and returns a filter on `df`.
    """
    digested = df.select(spec.y().alias("y"), unit_hash(F.col(spec.id), seed).alias("digest"))
    heads = settled(head_counts(digested, ["y"], "digest"))
    n = {r["y"]: r["n"] for r in heads.groupBy("y").agg(F.sum("head_one").alias("n")).collect()}
    n_pass, n_fail = n.get(0, 0), n.get(1, 0)
    if not n_pass > n_fail > 0:
        return df.where(F.lit(False))
    wanted = df.sparkSession.range(1).select(F.lit(0).alias("y"), F.lit(n_fail).cast("long").alias("take"))
    cut = first_by_hash(digested.where("y = 0"), ["y"], "digest", wanted, heads=heads.where("y = 0")).first()["cut"]
    return df.where((spec.y() == 1) | (unit_hash(F.col(spec.id), seed) <= F.lit(cut)))


def class_weights(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Balanced weight n / (2 n_class) per class, and the fail class's negatives-to-positives ratio."""
    counts = df.groupBy(spec.y().alias("y")).agg(F.count("*").alias("class_count"))
    every = Window.partitionBy()
    n = F.sum("class_count").over(every)
    return counts.select(
        "y",
        "class_count",
        F.try_divide(n.cast("double"), 2.0 * F.col("class_count")).alias("weight"),
        F.when(F.col("y") == 1, ratio_or_zero(n - F.col("class_count"), F.col("class_count")))
        .otherwise(F.lit(1.0))
        .alias("scale_pos_weight"),
    )
