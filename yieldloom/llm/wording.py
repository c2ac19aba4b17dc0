"""What the text operators agree on: white space, words and the columns they read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"


def documents(docs: DataFrame, *extra: str) -> DataFrame:
    """doc_id, text (null: empty) and the named columns; whatever else `docs` holds is left behind."""
    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), *extra)


def words(text: Column) -> Column:
    """The runs of characters that are not ASCII white space, in order; an empty array without any."""
    bare = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE + "+"))


def without(text: Column, pattern: str) -> Column:
    return F.regexp_replace(text, pattern, "")


def n_words(text: Column) -> Column:
    """How many words `text` has, without building them: one more than its inner gaps."""
    bare = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(bare == "", F.lit(0)).otherwise(F.regexp_count(bare, F.lit(SPACE + "+")) + 1).cast("long")


def computed(df: DataFrame) -> DataFrame:
    """`df` behind a generator of one row, so that a filter on its columns isn't moved below and its expressions
    are not copied into the filter, where each use would compute them anew."""
    return df.select(F.inline(F.array(F.struct(*[F.col(f"`{c}`") for c in df.columns]))))
