"""Document fingerprints: a Merkle tree over paragraphs and sections, in built-in functions.

A paragraph is a line, digested with SHA-256. A section is a run of paragraphs; it ends after a blank
line, or after a paragraph whose own digest starts with 0, so that an insertion moves no boundary but its
own. A section's digest covers its paragraphs' digests in order, the root covers the sections' digests.
Equal roots mean equal texts; where roots differ, comparing section digests and then paragraph digests
leads to the edit. For the likeness of two texts each paragraph is cut further into phrases (up to
punctuation, or a word that ends in e): it is twice the characters of the phrases both hold, over the
characters of the phrases of either (1 only for equal roots, 0 without a common phrase).

Defined results: null text counts as empty; the empty text is one blank paragraph; two empty texts are
alike by 1, an empty and another by 0. Repeated rows get equal fingerprints. A phrase that occurs twice
in a text counts once. Only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldloom.llm.ordered_neighbors import with_next
from yieldloom.llm.wording import documents

PHRASE_ENDS = r"(?<=[\n.,;:!?|*%&$#] ?|[eE] )(?=[^\n.,;:!?|*%&$# ])"
# A phrase's number: 48 bits of its hash above 16 bits for its length.
LENGTH_BITS = 16
LENGTH_MASK = (1 << LENGTH_BITS) - 1


def paragraphs(text: Column) -> Column:
    """The digest of each paragraph, in order."""
    return F.transform(F.split(text, "\n"), lambda line: F.sha2(line, 256))


def sections(leaves: Column) -> Column:
    """Digests of the sections over the paragraph digests `leaves`."""
    blank = F.sha2(F.lit(""), 256)
    ended = F.transform(leaves, lambda d: F.when((d == blank) | d.startswith("0"), F.concat(d, F.lit(";"))).otherwise(F.concat(d, F.lit(","))))
    runs = F.filter(F.split(F.array_join(ended, ""), ";"), lambda run: run != "")
    return F.transform(runs, lambda run: F.sha2(run, 256))


def root(branches: Column) -> Column:
    return F.sha2(F.array_join(branches, ","), 256)


def phrases(text: Column) -> Column:
    """The distinct numbers of the text's phrases."""

    def number(phrase: Column) -> Column:
        return F.shiftleft(F.xxhash64(phrase), LENGTH_BITS).bitwiseOR(F.least(F.length(phrase), F.lit(LENGTH_MASK)).cast("long"))

    return F.array_distinct(F.transform(F.filter(F.split(text, PHRASE_ENDS), lambda p: p != ""), number))


def _chars(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0).cast("long"), lambda a, x: a + x.bitwiseAND(F.lit(LENGTH_MASK).cast("long")))


def likeness(root_a: Column, phrases_a: Column, root_b: Column, phrases_b: Column) -> Column:
    share = 2 * _chars(F.array_intersect(phrases_a, phrases_b)) / (_chars(phrases_a) + _chars(phrases_b))
    return F.when(root_a == root_b, 1.0).otherwise(F.coalesce(F.least(share, F.lit(1 - 1e-9)), F.lit(0.0)))


def first_difference(a: Column, b: Column) -> Column:
    """0-based place of the first element in which two digest arrays differ, null when they are equal."""
    at = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    return F.when(at > 0, (at - 1).cast("int"))


def trees(docs: DataFrame) -> DataFrame:
    """doc_id, text, leaves, branches, fingerprint (the root) and phrases of every row."""
    df = documents(docs).withColumn("leaves", paragraphs(F.col("text"))).withColumn("branches", sections(F.col("leaves")))
    return df.withColumn("fingerprint", root(F.col("branches"))).withColumn("phrases", phrases(F.col("text")))


def edited_tail(text: Column, donor: Column) -> Column:
    """`text` with its last quarter of code points replaced by the first as many of `donor`."""
    tail = F.floor(F.length(text) / 4).cast("int")
    return F.concat(text.substr(F.lit(1), F.length(text) - tail), donor.substr(F.lit(1), tail))


def compared_with_edits(docs: DataFrame) -> DataFrame:
    """Every text's fingerprint beside that of its edited text, and how near the edited and the next text are.

    edited_section and edited_paragraph are the 0-based places of the first differing section and paragraph
    (null if the edit changes nothing); only paragraphs from edited_section's start on can differ.
    """
    base = documents(docs)
    base = base.withColumn("phrases", phrases(F.col("text"))).withColumn("root_", root(sections(paragraphs(F.col("text")))))
    df = with_next(base, "doc_id", "text", {"text": "next_text", "root_": "next_root", "phrases": "next_phrases"})
    df = df.withColumn("edited", edited_tail(F.col("text"), F.col("next_text"))).drop("next_text")
    df = df.withColumn("leaves", paragraphs(F.col("text"))).withColumn("edited_leaves", paragraphs(F.col("edited")))
    df = df.withColumn("branches", sections(F.col("leaves"))).withColumn("edited_branches", sections(F.col("edited_leaves")))
    df = df.withColumn("edited_fingerprint", root(F.col("edited_branches"))).withColumn("edited_phrases", phrases(F.col("edited")))
    return df.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.col("root_").alias("fingerprint"),
        "edited_fingerprint",
        likeness(F.col("root_"), F.col("phrases"), F.col("edited_fingerprint"), F.col("edited_phrases")).alias("near_edited"),
        likeness(F.col("root_"), F.col("phrases"), F.col("next_root"), F.col("next_phrases")).alias("near_next"),
        first_difference(F.col("branches"), F.col("edited_branches")).alias("edited_section"),
        first_difference(F.col("leaves"), F.col("edited_leaves")).alias("edited_paragraph"),
    )
