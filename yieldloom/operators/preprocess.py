"""From a resolved feature set and training statistics to a model matrix."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldloom.functions import without_nan
from yieldloom.spec import DEFAULT_SPEC, EntitySpec

SUFFIX = "_missing"


@dataclass(frozen=True)
class Input:
    """One model input: a feature with its training statistics, or the missing indicator of a feature."""

    name: str
    source: str
    indicator: bool
    median: float | None
    mean: float
    std: float
    null_share: float = 0.0


@dataclass(frozen=True)
class FoldInputs:
    """The inputs a fold uses, and the requested features it had to drop."""

    feature_set: str
    fold: int
    selected: tuple[str, ...]
    dropped: tuple[str, ...]
    inputs: tuple[Input, ...]

    @property
    def names(self) -> list[str]:
        return [i.name for i in self.inputs]


def input_statistics(resolved: DataFrame, scores: DataFrame) -> DataFrame:
    """Resolved features with the training statistics of their fold; indicators look up their source."""
    is_flag = F.col("feature_name").endswith(SUFFIX)
    source = F.when(is_flag, F.regexp_replace("feature_name", SUFFIX + "$", "")).otherwise(F.col("feature_name"))
    stats = scores.select(
        "fold",
        F.col("feature_name").alias("source"),
        "value_count",
        "null_count",
        "rows",
        "median",
        "fill_mean",
        "fill_std",
    )
    share = F.col("null_count") / F.col("rows")
    return (
        resolved.withColumn("indicator", is_flag)
        .withColumn("source", source)
        .join(stats, ["fold", "source"])
        .select(
            "feature_set",
            "fold",
            "position",
            "feature_name",
            "source",
            "indicator",
            (~F.col("indicator") & (F.col("value_count") == 0)).alias("all_missing"),
            F.when(~F.col("indicator"), F.col("median")).alias("median"),
            F.when(F.col("indicator"), share).otherwise(F.col("fill_mean")).alias("mean"),
            F.when(F.col("indicator"), F.sqrt(share * (1 - share))).otherwise(F.col("fill_std")).alias("std"),
            share.alias("null_share"),
        )
    )


def read_inputs(statistics: DataFrame) -> dict[tuple[str, int], FoldInputs]:
    """Per (feature set, fold) the model inputs. The rows are column metadata: sets x folds x columns."""
    rows: dict[tuple[str, int], list] = {}
    for r in statistics.collect():
        rows.setdefault((r.feature_set, r.fold), []).append(r)
    out = {}
    for (feature_set, fold), group in rows.items():
        group.sort(key=lambda r: r.position)
        used = tuple(
            Input(r.feature_name, r.source, r.indicator, r.median, r.mean, r.std, r.null_share)
            for r in group
            if not r.all_missing
        )
        dropped = tuple(sorted(r.feature_name for r in group if r.all_missing))
        out[feature_set, fold] = FoldInputs(feature_set, fold, tuple(r.feature_name for r in group), dropped, used)
    return out


def preparation(inputs: Sequence[Input], scale: bool, output: str = "features") -> list[Transformer]:
    """Stages that fill with the training median, optionally standardize, and assemble a vector.

    They are ordinary transformers, so a fitted model can be saved and loaded with its preprocessing.
    Standardization uses the population deviation after filling; a constant input keeps scale 1.
    """

    def number(x: float) -> str:
        return f"CAST({float(x)!r}D AS DOUBLE)"

    expressions, columns = [], []
    for n, i in enumerate(inputs):
        raw = f"nanvl(CAST(`{i.source}` AS DOUBLE), CAST(NULL AS DOUBLE))"
        value = f"CAST(({raw}) IS NULL AS DOUBLE)" if i.indicator else f"coalesce({raw}, {number(i.median)})"
        if scale:
            value = f"({value} - {number(i.mean)}) / {number(i.std or 1.0)}"
        columns.append(f"input_{n:04d}")
        expressions.append(f"{value} AS {columns[-1]}")
    statement = "SELECT *, " + ", ".join(expressions) + " FROM __THIS__"
    return [SQLTransformer(statement=statement), VectorAssembler(inputCols=columns, outputCol=output)]


def prepare(df: DataFrame, inputs: Sequence[Input], scale: bool, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """(id, y, features) of an entity table."""
    needed = sorted({i.source for i in inputs})
    out = df.select(spec.id, spec.y().alias("y"), *[F.col(f"`{c}`") for c in needed])
    for stage in preparation(inputs, scale):
        out = stage.transform(out)
    return out.select(spec.id, "y", "features")


def inputs_table(df: DataFrame, inputs: Sequence[Input], scale: bool, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """(id, y, one column per input) of an entity table: `prepare` before assembly."""
    stage = preparation(inputs, scale)[0]
    out = stage.transform(df.withColumn("y", spec.y()))
    return out.select(spec.id, "y", *[F.col(f"input_{n:04d}").alias(i.name) for n, i in enumerate(inputs)])


def raw_table(df: DataFrame, inputs: Sequence[Input], spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """(id, y, one column per input) for learners that split on missing values: nothing is filled or scaled."""
    columns = [without_nan(F.col(f"`{i.source}`")) for i in inputs]
    named = [(c.isNull().cast("double") if i.indicator else c).alias(i.name) for i, c in zip(inputs, columns)]
    return df.select(spec.id, spec.y().alias("y"), *named)
