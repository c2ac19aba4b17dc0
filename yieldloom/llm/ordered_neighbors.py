"""The next row in id order without one task that sees all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS_PER_PARTITION = 4
LEAST_KEY = -(2**63)


def id_bounds(df: DataFrame, key: str, buckets: int) -> list[int]:
    """At most `buckets` - 1 ascending values of `key` that cut it into ranges of about equal row counts."""
    shares = [i / buckets for i in range(1, buckets)]
    row = df.agg(F.percentile_approx(key, shares, 10 * buckets).alias("p"), F.min(key).alias("least")).head() if shares else None
    return sorted(set(row["p"] or []) - {row["least"]}) if row else []


def bounds_upto(bounds: Sequence[int], key: Column) -> Column:
    """How many of the ascending `bounds` are <= key: a binary search, one step per power of two."""
    if not bounds:
        return F.lit(0)
    cuts = F.array(*[F.lit(int(b)) for b in bounds])
    steps = [1 << i for i in range(len(bounds).bit_length() - 1, -1, -1)]
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(F.coalesce(F.get(cuts, at + step - 1) <= key, F.lit(False)), at + step).otherwise(at),
    )


def with_next(df: DataFrame, id_col: str, tie: str, carried: dict[str, str], buckets: int | None = None) -> DataFrame:
    """`df` plus, for each (column, name) of `carried`, that column of the row next in (id, tie) order; after the last row: the first.

    Rows are cut into id ranges at sampled bounds that are themselves ids; the first row of each range is
    copied behind the range before it, so a window over one range sees each row's successor. The number of
    ranges follows the session's shuffle partitions. A null id comes first; rows that share an id are
    ordered by `tie` and lie in one range.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keyed = df.withColumn("__key", F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST_KEY)))
    ids = keyed.select("__key")
    bounds = id_bounds(ids, "__key", buckets or BUCKETS_PER_PARTITION * partitions)
    least = ids.agg(F.min("__key")).head()[0]
    own = keyed.withColumn("__range", bounds_upto(bounds, F.col("__key")))
    starts = F.when(F.col("__key") == F.lit(least), F.lit(len(bounds)))
    if bounds:
        starts = starts.when(F.get(F.array(*[F.lit(b) for b in bounds]), F.col("__range") - 1) == F.col("__key"), F.col("__range") - 1)
    places = F.array_compact(F.array(F.struct(F.col("__range").alias("at"), F.lit(False).alias("copy")), F.when(starts.isNotNull(), F.struct(starts.alias("at"), F.lit(True).alias("copy")))))
    placed = own.withColumn("__place", F.explode(places))
    inside = Window.partitionBy("__place.at").orderBy("__place.copy", "__key", tie)
    following = placed.select("*", *[F.lead(c).over(inside).alias(name) for c, name in carried.items()])
    return following.where(~F.col("__place.copy")).drop("__key", "__range", "__place")
