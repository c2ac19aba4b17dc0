"""Wide to long."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldloom.functions import without_nan
from yieldloom.spec import DEFAULT_SPEC, EntitySpec


def signal_values_long(df: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """One row per entity and feature; missing measurements are kept and flagged."""
    features = spec.measured(df)
    long = values(df, features, keep=[spec.id, spec.ts, spec.label])
    return long.select(
        spec.id,
        spec.ts,
        spec.label,
        feature_name(features).alias("feature_name"),
        F.col("value").alias("feature_value"),
        F.col("value").isNull().alias("is_missing"),
    )


def values(df: DataFrame, features: Sequence[str], keep: Sequence[Column | str] = ()) -> DataFrame:
    """`keep` columns plus (ordinal, value) for every feature.

    The features travel as one array that is exploded with its position. Compared with `unpivot` the
    grouping key is an int instead of a name and the plan has one projection instead of one per feature
    (about half the run time in a local trial on 590 columns); compared with one aggregate expression per
    column the generated code stays small (a sixth to a tenth of the run time there).
    """
    packed = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    exploded = df.select(*keep, F.posexplode(packed).alias("ordinal", "value"))
    return exploded.withColumn("value", without_nan(F.col("value")))


def feature_name(features: Sequence[str], ordinal: str = "ordinal") -> Column:
    """Name of the feature at a position. The names are a literal: as many as the table has columns."""
    return F.element_at(F.array(*[F.lit(c) for c in features]), F.col(ordinal) + 1)


def feature_rows(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature_ordinal, feature_name): the table's own column list as rows."""
    names = F.array(*[F.lit(c) for c in features])
    return df.sparkSession.range(0, 1, 1, 1).select(F.posexplode(names).alias("feature_ordinal", "feature_name"))
