"""Text sources: whitespace-separated measurement rows and label lines, joined by their row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from yieldloom.functions import decode_label
from yieldloom.sources.tables import feature_names
from yieldloom.sources.workspace import settled, stored
from yieldloom.spec import DEFAULT_SPEC, EntitySpec

# fixed values: cells that mean "missing", and the shape of a label line
MISSING_TOKENS = ["NaN", "nan", "", "NA", "N/A"]
LABEL_LINE = r'^(-?\d+)\s+"([^"]+)"'
LABEL_TIME = "dd/MM/yyyy HH:mm:ss"


# Rows of (file, split) offsets, 24 bytes each, up to which they are broadcast; beyond, the lines are shuffled to them.
BROADCAST_SPLITS = 1_000_000


def stripped(c: Column) -> Column:
    """Without white space of any kind, tabs included, at either end."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(row_number, value): the non-blank, stripped lines of one or many text files, numbered from 1 in file order.

    The files are read once, into a table that holds each line with its file, its split and its place there,
    so how the files are split is settled for good. Counts of the splits (one row each) are summed up in
    order and joined to the lines; two numbers tell splits apart, so their rows are small enough to be
    broadcast, and then the text is neither shuffled nor sorted.
    """
    # read again, the files might be split elsewhere, and lines would miss their counts
    lines = stored(
        spark.read.text(path)
        .select(
            stripped(F.col("value")).alias("value"),
            F.xxhash64(F.col("_metadata.file_path")).alias("file_no"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("start"),
        )
        .where(F.col("value") != "")
        .withColumn("place", F.monotonically_increasing_id()),
        "lines",
    )
    splits = lines.groupBy("file", "file_no", "start").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    earlier = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first") + 1
    offsets = settled(splits.select("file_no", "start", shift.alias("shift")))
    offsets = F.broadcast(offsets) if offsets.count() <= BROADCAST_SPLITS else offsets
    numbered = lines.select("value", "file_no", "start", "place").join(offsets, ["file_no", "start"], "left")
    number = F.when(F.col("shift").isNull(), F.raise_error(F.lit("a line has no offset"))).otherwise(F.col("place") + F.col("shift"))
    return numbered.select(number.cast("long").alias("row_number"), "value")


def parse_measurements(lines: DataFrame, n_features: int, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Measurement rows from (row_number, value): id and one double column per cell, missing as NULL."""
    cells = F.split(stripped(F.col("value")), r"\s+")
    columns = []
    for i, name in enumerate(feature_names(n_features, spec)):
        cell = F.get("cells", F.lit(i))
        number = F.when(~cell.isin(*MISSING_TOKENS), cell.try_cast("double"))
        columns.append(F.nanvl(number, F.lit(None).cast("double")).alias(name))
    return lines.select(F.col("row_number").alias(spec.id), cells.alias("cells")).select(spec.id, *columns)


def read_measurements(spark: SparkSession, path: str, spec: EntitySpec = DEFAULT_SPEC, most_bad_cells: int = 0) -> DataFrame:
    """Measurement file(s). Every line must have as many cells as the others.

    Runs a job over all lines first: lines of different width are refused, and so are more than
    `most_bad_cells` cells that are neither a number nor a missing token; allowed ones become NULL.
    """
    lines = numbered_lines(spark, path)
    cells = F.split("value", r"\s+")
    bad = F.size(F.filter(cells, lambda c: ~c.isin(*MISSING_TOKENS) & c.try_cast("double").isNull()))
    found = lines.agg(F.min(F.size(cells)).alias("least"), F.max(F.size(cells)).alias("most"), F.sum(bad).alias("bad")).head()
    if found["least"] is None:
        raise ValueError(f"no measurements in {path}")
    if found["least"] != found["most"]:
        raise ValueError(f"lines of {path} have from {found['least']} to {found['most']} cells")
    if found["bad"] > most_bad_cells:
        raise ValueError(f"{found['bad']} cells of {path} are neither numbers nor missing")
    return parse_measurements(lines, found["most"], spec)


def parse_labels(lines: DataFrame, spec: EntitySpec = DEFAULT_SPEC) -> DataFrame:
    """Label rows from (row_number, value): `-1 "19/07/2008 11:55:00"`, day first.

    Lines of another shape are cut at white space: the first word is the label, the rest the time, with or
    without quotes. A label that is no number leaves both label and outcome NULL.
    """
    line = stripped(F.col("value"))
    words = F.split(line, r"\s+")
    regular = line.rlike(LABEL_LINE)
    label = F.when(regular, F.regexp_extract(line, LABEL_LINE, 1)).otherwise(F.get(words, F.lit(0)))
    rest = F.trim(F.concat_ws(" ", F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(1)))), F.lit('"'))
    stamp = F.when(regular, F.regexp_extract(line, LABEL_LINE, 2)).otherwise(rest)
    labels = lines.select(
        F.col("row_number").alias(spec.id),
        label.try_cast("int").alias(spec.label),
        F.coalesce(
            F.try_to_timestamp(stamp, F.lit(LABEL_TIME)),
            F.try_to_timestamp(stamp, F.lit("dd/MM/yyyy")),
            F.try_to_timestamp(stamp),
        ).alias(spec.ts),
    )
    known = F.col(spec.label).isNotNull()
    return labels.withColumn(spec.outcome, F.when(known, decode_label(F.col(spec.label), spec.fail_value)))


def read_labels(spark: SparkSession, path: str, spec: EntitySpec = DEFAULT_SPEC, most_bad_lines: int = 0) -> DataFrame:
    """Label file(s). Refuses more than `most_bad_lines` lines whose label or time can't be read; runs a job to count them."""
    labels = parse_labels(numbered_lines(spark, path), spec)
    bad = labels.where(F.col(spec.label).isNull() | F.col(spec.ts).isNull()).count()
    if bad > most_bad_lines:
        raise ValueError(f"{bad} lines of {path} have a label or time that can't be read")
    return labels
