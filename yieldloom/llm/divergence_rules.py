"""Quality rules: how far a document's characters and common words are from those of its language.

Two histograms per document are compared with the language's own by Jensen-Shannon distance (base 2, so
0 to 1): character classes, and the language's most frequent words plus one bin for all others. The
language references are counted over every document of the table. Everything is built-in functions; a
document is judged inside its own row, so one long or frequent document never meets another in a group.

Defined results: null text counts as empty. A document without words has both distances null. A language
(null included) with fewer than `least_reference_words` words has no reference, and a document of it, or
one with fewer than `least_words` words, is not judged by divergence: only the base rules hold. Repeated
rows are judged one by one and alike. Words equally frequent enter the reference in code-point order.
Columns besides doc_id, text and lang are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.llm.wording import SPACE, computed, documents, without, words
from yieldloom.sources.workspace import settled

# Character classes; what none of them holds (ASCII punctuation, controls) is the last bin.
CLASSES: Sequence[tuple[str, str]] = (
    ("lower", "[a-z]+"),
    ("upper", "[A-Z]+"),
    ("digit", "[0-9]+"),
    ("space", SPACE + "+"),
    ("symbol", "[#*$%&|<>]+"),
    ("wide", r"[^\x00-\x7F]+"),
)
BINS = [*[name for name, _ in CLASSES], "rest"]
COMMON_WORDS = 32
LEAST_REFERENCE_WORDS = 500
LEAST_WORDS = 50
MOST_CLASS_DISTANCE = 0.25
MOST_WORD_DISTANCE = 0.47
# References are one row per language; beyond this many they are joined by shuffle instead of broadcast.
BROADCAST_LANGUAGES = 2_000


def counted(docs: DataFrame) -> DataFrame:
    """Per row the base measures, the words, and `chars`, the character class counts."""
    df = documents(docs, "lang")
    df = class_counts(df, "text")
    return df.select(
        "doc_id", "lang", "text",
        F.array(*[F.col(f"n_{name}") for name in BINS]).alias("chars"),
        (F.length("text") - F.col("n_space")).cast("long").alias("word_chars"),
        F.col("n_symbol").alias("n_symbols"),
    )


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """`df` plus n_<class> for each of BINS; a class is looked for only in what earlier ones left over."""
    left = F.col(column)
    for name, pattern in CLASSES:
        df = df.withColumn("__left", without(left, pattern)).withColumn(f"n_{name}", (F.length(left) - F.length("__left")).cast("long"))
        df, left = df.withColumnRenamed("__left", f"__left_{name}"), F.col(f"__left_{name}")
    return df.withColumn("n_rest", F.length(left).cast("long")).drop(*[f"__left_{name}" for name, _ in CLASSES])


def language_references(docs: DataFrame, common_words: int = COMMON_WORDS, least_reference_words: int = LEAST_REFERENCE_WORDS) -> DataFrame:
    """One row per language: ref_chars, the class shares; ref_words and ref_shares, its common words; ref_total, their sum."""
    known = docs.where(F.col("lang").isNotNull())
    lengths = known.groupBy(F.col("lang").alias("key")).agg(F.sum(F.length("text")).alias("n_chars"))
    spoken = documents(known, "lang").select(F.col("lang").alias("key"), F.explode(words(F.col("text"))).alias("word")).groupBy("key", "word").agg(F.count("*").alias("n"))
    # the classes of all characters follow from the distinct words; what no word holds is white space
    sums = [F.sum(F.col(f"n_{name}") * F.col("n")).alias(f"n_{name}") for name in BINS if name != "space"]
    spelled = class_counts(spoken, "word").groupBy("key").agg(F.sum("n").alias("total"), *sums)
    in_words = sum((F.col(f"n_{name}") for name in BINS if name != "space"), F.lit(0))
    chars = (
        spelled.where(F.col("total") >= least_reference_words).join(lengths, "key")
        .withColumn("n_space", F.col("n_chars") - in_words)
        .select("key", "total", F.array(*[F.col(f"n_{name}") / F.col("n_chars") for name in BINS]).alias("ref_chars"))
    )
    # Ranks are limited before the shuffle too, so a language's vocabulary never meets in one task. What has
    # no letter or digit comes last, by its place in the order and not by a filter, so that both uses of
    # `spoken` read one shuffle.
    best = Window.partitionBy("key").orderBy(F.col("wordlike").desc(), F.desc("n"), "word")
    common = (
        spoken.groupBy("key", F.lower("word").alias("word")).agg(F.sum("n").alias("n"))
        .withColumn("wordlike", F.col("word").rlike(r"[0-9a-z]|[^\x00-\x7F]"))
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= common_words)
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.when(F.col("wordlike"), F.struct("rank", "word", "n")))).alias("common"))
    )
    return chars.join(common, "key").select(
        "key", "ref_chars",
        F.col("common.word").alias("ref_words"),
        F.transform("common", lambda x: x.n / F.col("total")).alias("ref_shares"),
        (F.aggregate("common", F.lit(0).cast("long"), lambda a, x: a + x.n) / F.col("total")).alias("ref_total"),
    )


def _part(p: Column, q: Column) -> Column:
    """What one bin adds to twice the divergence."""
    both = p + q

    def side(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / both)).otherwise(0.0)

    return side(p) + side(q)


def _distance(parts: Column) -> Column:
    return F.sqrt(F.greatest(F.lit(0.0), parts / 2))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def class_distance(chars: Column, reference: Column) -> Column:
    total = F.aggregate(chars, F.lit(0).cast("long"), lambda a, x: a + x)
    return _distance(_sum(F.zip_with(F.transform(chars, lambda c: c / total), reference, _part)))


def triples(tokens: Column) -> Column:
    """64-bit hashes of the three-word windows; two different windows of a text share one with a chance below 1e-10."""
    starts = F.sequence(F.lit(0), F.size(tokens) - 3)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.get(tokens, i), F.get(tokens, i + 1), F.get(tokens, i + 2)))
    return F.when(F.size(tokens) >= 4, hashes)


def judged(
    docs: DataFrame,
    references: DataFrame | None = None,
    least_words: int = LEAST_WORDS,
    most_class_distance: float = MOST_CLASS_DISTANCE,
    most_word_distance: float = MOST_WORD_DISTANCE,
) -> DataFrame:
    """doc_id, the base measures, class_distance, word_distance, base_failed and kept, one row per row of `docs`."""
    refs = language_references(docs) if references is None else references
    refs = settled(refs)
    refs = F.broadcast(refs) if refs.count() <= BROADCAST_LANGUAGES else refs
    df = counted(docs)
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    df = df.withColumn("lines", lines).withColumn("words", words(F.col("text")))
    df = df.select(
        "doc_id", "lang", "text", "chars", "word_chars", "n_symbols", "words",
        F.size("words").cast("long").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        triples(F.col("words")).alias("hashes"),
    )
    # only a text with an equal pair of windows needs them in order
    placed = F.sort_array(F.transform("hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("windows", F.when(F.size(F.array_distinct("hashes")) < F.size("hashes"), placed)).drop("hashes")
    same = F.filter(
        "windows",
        lambda x, j: (x.h == F.get("windows", j + 1)["h"]) | (x.h == F.get("windows", F.greatest(j - 1, F.lit(0)))["h"]) & (j > 0),
    )
    covered = F.size(F.array_distinct(F.flatten(F.transform(same, lambda x: F.array(x.i, x.i + 1, x.i + 2)))))
    df = df.withColumn("n_repeat_words", F.when(F.col("windows").isNull(), 0).otherwise(covered).cast("long")).drop("windows")

    df = df.join(refs, df.lang == refs.key, "left")
    # places of the document's words among the reference words, sorted, so that equal ones form runs
    spots = F.transform("words", lambda w: F.array_position("ref_words", F.lower(w)))
    df = df.withColumn("spots", F.sort_array(F.filter(spots, lambda s: s > 0)))
    ends = F.filter(F.sequence(F.lit(1), F.size("spots")), lambda e: F.coalesce(F.get("spots", e - 1) != F.get("spots", e), F.lit(True)))
    df = df.withColumn("ends", F.when(F.size("spots") > 0, ends).otherwise(F.array().cast("array<int>")))
    share = lambda n: n / F.col("n_words")
    run = lambda e, j: e - F.when(j > 0, F.get("ends", F.greatest(j - 1, F.lit(0)))).otherwise(0)
    # a reference word that the document lacks adds its share, so only present words need their own term
    present = F.transform(
        "ends",
        lambda e, j: _part(share(run(e, j)), F.get("ref_shares", (F.get("spots", e - 1) - 1).cast("int"))) - F.get("ref_shares", (F.get("spots", e - 1) - 1).cast("int")),
    )
    other = _part(1 - share(F.size("spots")), 1 - F.col("ref_total"))
    by_word = _distance(F.col("ref_total") + _sum(present) + other)
    df = df.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        F.when(F.col("n_words") > 0, class_distance(F.col("chars"), F.col("ref_chars"))).alias("class_distance"),
        F.when(F.col("n_words") > 0, by_word).alias("word_distance"),
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
    )
    far = (F.col("class_distance") > most_class_distance) | (F.col("word_distance") > most_word_distance)
    strange = (F.col("n_words") >= least_words) & F.coalesce(far, F.lit(False))
    return computed(df.withColumn("kept", ~F.col("base_failed") & ~strange))


def passing(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` that are kept. Rows that share a doc_id are told apart by their texts."""
    rejected = judged(docs.withColumn("doc_id", F.struct("doc_id", F.xxhash64("text").alias("h"), F.col("lang"))), **options)
    rejected = rejected.where(~F.col("kept")).select(F.col("doc_id").alias("__key")).distinct()
    key = F.struct("doc_id", F.xxhash64("text").alias("h"), F.col("lang"))
    return docs.join(rejected, key.eqNullSafe(F.col("__key")), "left_anti")
