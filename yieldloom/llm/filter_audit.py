"""Filter interaction audit: what five filters remove alone, together and in every order.

The filters look at whole texts: A under 100 words; B fewer than 80 distinct words in 100; C more than 10 in
100 characters among A-Z; D any of `#$%&*|`; E a text that a smaller doc_id has too. A to D follow from the
row. E takes a duplicate prepass: a counting Bloom filter of text hashes, whose counters are partial counts
per task merged by the shuffle. A text one of whose cells counts a single text is unique for certain and its
flag is settled without moving it; only possible repeats are read again and grouped by their full text for
the least id. Flags and labels then meet by doc_id in counts per failure mask, which add up to every figure
of every order.

Scale: the filter is a table of 64-cell words, a word per eight documents, so it grows with the table
instead of filling up. It is broadcast behind a check of its size, and unique texts then stay where they
were read. Beyond that bound rows are dealt by word and salt, which spreads a text held by a third of all
rows; the texts move once in that case. The group of a text is one row per task after partial aggregation.

Defined results: null text counts as empty, so null and empty texts are copies of each other. A null doc_id
is neither smaller nor larger than another: such a row doesn't fail E nor make others fail it, and has no
labels. Rows that repeat an id and text don't fail E for each other. Several labels of one id hold if any of
them does. A null lang is the part named by the empty string. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.llm.wording import documents, without, words
from yieldloom.sources.workspace import stored

FILTERS = "ABCDE"
REPEATED = 1 << FILTERS.index("E")
# Cells per word of the filter, texts per word, and cells that a text sets in its word.
CELLS = 64
TEXTS_PER_WORD = 8
HASHES = 3
# Words of the filter (16 bytes each) up to which it is broadcast; beyond, rows are dealt by word and salt.
BROADCAST_WORDS = 1 << 20
SALTS = 16


def text_mask(text: Column) -> Column:
    """The bits of filters A to D that `text` fails, A lowest."""
    spelled = words(text)
    capitals = F.length(text) - F.length(without(text, "[A-Z]+"))
    fails = [
        F.size(spelled) < 100,
        100 * F.size(F.array_distinct(spelled)).cast("long") < 80 * F.size(spelled).cast("long"),
        100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        text.rlike(r"[#$%&*|]"),
    ]
    return sum((F.when(fail, 1 << bit).otherwise(0) for bit, fail in enumerate(fails)), F.lit(0))


def _cells(hashed: Column) -> Column:
    spread = F.xxhash64(hashed, F.lit(1))
    return F.array_distinct(F.array(*[F.shiftrightunsigned(spread, 6 * i).bitwiseAND(CELLS - 1).cast("int") for i in range(HASHES)]))


def _word(hashed: Column, n_words: int) -> Column:
    return F.pmod(hashed, F.lit(n_words))


def repeat_filter(hashes: DataFrame, n_words: int) -> DataFrame:
    """word, cells: per word of the counting filter, the cells that two or more rows of `hashes` (column h) set."""
    counters = hashes.select(_word(F.col("h"), n_words).alias("word"), F.explode(_cells(F.col("h"))).alias("cell")).groupBy("word", "cell").agg(F.count("*").alias("n"))
    return counters.where(F.col("n") > 1).groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("cell"))).alias("cells"))


def with_possible_repeats(df: DataFrame, cells: DataFrame, n_words: int, small: bool) -> DataFrame:
    """`df` (column h) plus `maybe`: whether every cell of the row's text counts two or more."""
    bits = F.aggregate(_cells(F.col("h")), F.lit(0).cast("long"), lambda a, c: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), c)))
    keyed = df.withColumn("__word", _word(F.col("h"), n_words))
    side = cells.select(F.col("word").alias("__word"), F.col("cells").alias("__cells"))
    if small:
        met = keyed.join(F.broadcast(side), "__word", "left")
    else:
        keyed = keyed.withColumn("__salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
        side = side.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        met = keyed.join(side, ["__word", "__salt"], "left").drop("__salt")
    return met.withColumn("maybe", F.coalesce(F.col("__cells").bitwiseAND(bits) == bits, F.lit(False))).drop("__word", "__cells")


def masked(docs: DataFrame, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """doc_id, part and mask, the bits of all filters that the row fails, one row per row of `docs`."""
    df = documents(docs, F.coalesce("lang", F.lit("")).alias("part"))
    facts = stored(df.select("doc_id", "part", F.xxhash64("text").alias("h"), text_mask(F.col("text")).alias("own")), "audit")
    n_words = -(-facts.count() // TEXTS_PER_WORD) or 1
    cells = stored(repeat_filter(facts, n_words), "repeats")
    small = cells.count() <= broadcast_words
    texts = with_possible_repeats(df.select("doc_id", "text", F.xxhash64("text").alias("h")), cells, n_words, small)
    # one row per text after each task's part; the texts themselves go no further
    least = texts.where("maybe").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.first("h").alias("h")).select("doc_id", "h", F.lit(True).alias("least"))
    flagged = with_possible_repeats(facts, cells, n_words, small)
    settled = flagged.where(~F.col("maybe") | F.col("doc_id").isNull()).select("doc_id", "part", F.col("own").alias("mask"))
    open_rows = flagged.where(F.col("maybe") & F.col("doc_id").isNotNull()).join(least.distinct(), ["doc_id", "h"], "left")
    decided = open_rows.select("doc_id", "part", F.when(F.col("least"), F.col("own")).otherwise(F.col("own").bitwiseOR(REPEATED)).alias("mask"))
    return settled.unionByName(decided)


def mask_counts(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """part, mask, n, n_good, n_toxic: documents per failure mask, and those labelled of quality or toxic."""
    rows = masked(docs, **options)
    marks = labels.where(F.col("doc_id").isNotNull() & ((F.col("quality") == 1) | (F.col("toxic") == 1))).groupBy("doc_id").agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("long"), F.lit(0))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("long"), F.lit(0))).alias("toxic"),
    )
    # counts add up, so rows without an id, which have no labels, are counted without the join
    known = rows.where(F.col("doc_id").isNotNull()).join(marks, "doc_id", "left").select("part", "mask", F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))
    unknown = rows.where(F.col("doc_id").isNull()).select("part", "mask", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    return known.unionByName(unknown).groupBy("part", "mask").agg(F.count("*").alias("n"), F.sum("good").alias("n_good"), F.sum("toxic").alias("n_toxic"))


def audited(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """One row per part, filter_order and step with the documents kept, removed, redundant, failing that filter
    only, lost among the good and toxic ones, and the filter's removals over all orders."""
    orders = ",".join("".join(order) for order in permutations(FILTERS))
    steps = F.sequence(F.lit(1), F.lit(len(FILTERS)))
    counts = mask_counts(docs, labels, **options)
    placed = counts.withColumn("filter_order", F.explode(F.split(F.lit(orders), ","))).withColumn("step", F.explode(steps))

    def bit(at: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1), F.instr(F.lit(FILTERS), F.substring(F.col("filter_order"), at, F.lit(1))) - 1)

    earlier = F.aggregate(F.filter(steps, lambda s: s < F.col("step")), F.lit(0), lambda a, s: a.bitwiseOR(bit(s)))
    placed = placed.withColumn("letter", F.substring("filter_order", F.col("step"), F.lit(1))).withColumn("own", bit(F.col("step"))).withColumn("gone", F.col("mask").bitwiseAND(earlier) > 0)
    fails = F.col("mask").bitwiseAND(F.col("own")) > 0

    def total(condition: Column, column: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(column)).otherwise(0))

    figures = placed.groupBy("part", "filter_order", "step", "letter").agg(
        total(~fails & ~F.col("gone")).alias("kept"),
        total(fails & ~F.col("gone")).alias("removed"),
        total(fails & F.col("gone")).alias("redundant"),
        total(F.col("mask") == F.col("own")).alias("unique_fails"),
        total(fails & ~F.col("gone"), "n_good").alias("good_lost"),
        total(fails & ~F.col("gone"), "n_toxic").alias("toxic_lost"),
    )
    # one row per order in each group: 120 of them
    return figures.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "letter"))).drop("letter")
