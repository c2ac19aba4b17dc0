"""Benchmark decontamination: words of documents that lie inside an n-gram of a test item.

Words are lower-cased (A-Z) runs of digits, letters a-z and non-ASCII characters. A window is ten
consecutive words of an item; an item of fewer words is one window as a whole. A window of `length` words
holds, at whichever word of a document it begins, a half-window (its `anchor`, half the words rounded up)
that begins at a multiple of `stride`; so the anchors of every item position are broadcast as a hash set,
and a document looks up only its anchors at those places. A hit is then verified word by word and stretched
to both sides by up to stride - 1 words: it stands if the stretch reaches a whole window, and all its words
are hit. Everything is built-in functions; the lookup is a map-side join and only verified stretches and a
row per document are shuffled.

Scale: items are read in blocks, each below `BLOCK_ANCHORS` anchors (the broadcast's bound, which one item
alone may pass), so a large benchmark takes several scans instead of a larger broadcast. Rows are grouped by
doc_id and text hash with partial aggregation, so neither a null id nor copies under other ids meet in one
group, and identical rows arrive as one row per task.

Defined results: null and empty texts have no words and no hits. Repeated rows each get their result. Items
without words are no items; rows that share an item_id are one item (listed once), but no window reaches
from one row into another; a null item_id hits like others and is listed as the empty string. Columns other
than doc_id, text, item_id are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldloom.llm.wording import documents
from yieldloom.sources.workspace import settled

WINDOW = 10
# Items are put in blocks of about this many anchors (some 300 bytes each).
BLOCK_ANCHORS = 200_000
ANCHORS = "array<struct<at:int,hash:bigint>>"
OTHER = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A word as it stands in a text, with whatever precedes it.
PIECE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def normal_words(text: Column) -> Column:
    """The words of `text` in order."""
    lowered = F.translate(text, UPPER, LOWER)
    return F.filter(F.split(lowered, OTHER + "+"), lambda w: w != "")


def anchor_size(length: int) -> int:
    return -(-length // 2)


def _anchor(spelled: Column, at: Column, length: int) -> Column:
    """A hash of the half-window of `spelled` that begins at `at`."""
    return F.xxhash64(F.lit(length), *[F.get(spelled, at + i) for i in range(anchor_size(length))])


def _anchors(spelled: Column, length: int, stride: int) -> Column:
    last = F.size(spelled) - anchor_size(length)
    return F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(stride)), lambda at: F.struct(at.alias("at"), _anchor(spelled, at, length).alias("hash")))


def item_words(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """item, spelled, length: the id as text, the words and the length of the windows of every item with words."""
    spelled = normal_words(F.coalesce("text", F.lit("")))
    df = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), spelled.alias("spelled"))
    return df.where(F.size("spelled") > 0).withColumn("length", F.least(F.size("spelled"), F.lit(window)))


def item_anchors(items: DataFrame, lengths: list[int]) -> DataFrame:
    """A row per item position: hash, length, place (of the anchor in the item), item and its words."""
    each = F.lit(None).cast(ANCHORS)
    for length in lengths:
        each = F.when(F.col("length") == length, _anchors(F.col("spelled"), length, 1)).otherwise(each)
    return items.withColumn("anchor", F.explode(each)).select(F.col("anchor.hash").alias("hash"), "length", F.col("anchor.at").alias("place"), "item", "spelled")


def _same_run(theirs: Column, at: Column, ours: Column, place: Column, step: int, most: Column) -> Column:
    """How many words from there in steps of `step` are equal in both, `most` at most."""
    differs = lambda d: (d > most) | ~F.coalesce(F.get(theirs, at + step * d) == F.get(ours, place + step * d), F.lit(False))
    return F.array_min(F.filter(F.sequence(F.lit(1), most + 1), differs)) - 1


def stretches(docs: DataFrame, anchors: DataFrame, lengths: list[int]) -> DataFrame:
    """A row per document without a hit (`item` null), and one per verified stretch `begin` to `end` of words."""
    df = documents(docs).select("doc_id", F.xxhash64("text").alias("h"), normal_words(F.col("text")).alias("theirs"))
    # the first entry stands for the document itself
    itself = F.array(F.struct(F.lit(-1).alias("at"), F.lit(None).cast("long").alias("hash")))
    looked_up = F.concat(itself, *[F.when(F.size("theirs") >= n, _anchors(F.col("theirs"), n, n - anchor_size(n) + 1)).otherwise(F.array().cast(ANCHORS)) for n in lengths])
    df = df.withColumn("n_words", F.size("theirs").cast("long")).withColumn("anchor", F.explode(looked_up))
    met = df.join(F.broadcast(anchors), df["anchor.hash"] == anchors["hash"], "left")
    at, place, half = F.col("anchor.at"), F.col("place"), ((F.col("length") + 1) / 2).cast("int")
    side = F.col("length") - half
    equal = F.slice("theirs", at + 1, half) == F.slice("spelled", place + 1, half)
    back = _same_run(F.col("theirs"), at, F.col("spelled"), place, -1, side)
    ahead = _same_run(F.col("theirs"), at + half - 1, F.col("spelled"), place + half - 1, 1, side)
    reach = F.when(F.col("hash").isNotNull() & equal, F.struct((at - back).alias("begin"), (at + half + ahead).alias("end")))
    found = met.select("doc_id", "h", "n_words", (at < 0).alias("itself"), "item", "length", reach.alias("reach"))
    whole = F.col("reach.end") - F.col("reach.begin") >= F.col("length")
    return found.where(F.col("itself") | whole).select("doc_id", "h", "n_words", "itself", F.col("reach.begin").alias("begin"), F.col("reach.end").alias("end"), "item")


def _blocks(spelled: DataFrame, block_anchors: int) -> list[DataFrame]:
    n = spelled.agg(F.sum(F.size("spelled"))).head()[0] or 0
    blocks = max(1, -(-n // block_anchors))
    return [spelled.where(F.pmod(F.xxhash64("item", "spelled"), F.lit(blocks)) == b) for b in range(blocks)]


def found_spans(docs: DataFrame, items: DataFrame, window: int = WINDOW, block_anchors: int = BLOCK_ANCHORS) -> DataFrame:
    """doc_id, h (text hash), n_words, copies, spans (sorted, may overlap) and item_ids per distinct (doc_id, h)."""
    spelled = settled(item_words(items, window))
    lengths = sorted(r[0] for r in spelled.select("length").distinct().collect())
    blocks = [stretches(docs, item_anchors(block, lengths), lengths) for block in _blocks(spelled, block_anchors)]
    rows = blocks[0]
    for block in blocks[1:]:
        rows = rows.unionByName(block.where(~F.col("itself")))
    return rows.groupBy("doc_id", "h").agg(
        F.max("n_words").alias("n_words"),
        F.count_if("itself").alias("copies"),
        F.array_sort(F.collect_set(F.when(~F.col("itself"), F.struct("begin", "end")))).alias("spans"),
        F.array_sort(F.collect_set("item")).alias("item_ids"),
    )


def span_words(spans: Column) -> Column:
    """How many words lie in any of the sorted spans."""
    start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("reach"))
    step = lambda a, s: F.struct((a.n + F.greatest(s.end - F.greatest(s.begin, a.reach), F.lit(0))).alias("n"), F.greatest(a.reach, s.end).alias("reach"))
    return F.aggregate(spans, start, step, lambda a: a.n)


def contamination(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, one row per row of `docs`."""
    found = found_spans(docs, items, **options)
    found = found.withColumn("n_hit", span_words(F.col("spans"))).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def decontaminated(docs: DataFrame, items: DataFrame, remove: str = "spans", **options) -> DataFrame:
    """`docs` without what the items leaked into them: the hit words, each with the characters before it
    (`remove="spans"`), or every document with a hit (`remove="documents"`)."""
    if remove not in ("spans", "documents"):
        raise ValueError(f"remove is 'spans' or 'documents', not {remove!r}")
    found = found_spans(docs, items, **options).where(F.size("spans") > 0).select(F.col("doc_id").alias("__id"), F.col("h").alias("__h"), F.col("spans").alias("__spans"))
    key = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__h"))
    if remove == "documents":
        return docs.join(found, key, "left_anti")
    pieces = F.regexp_extract_all("text", F.lit(PIECE), F.lit(0))
    kept = F.filter(pieces, lambda _, i: ~F.exists("__spans", lambda s: (s.begin <= i) & (i < s.end)))
    tail = F.regexp_extract("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*\z", 0)
    cleaned = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.concat(F.array_join(kept, ""), tail))
    return docs.join(found, key, "left").select(*[cleaned.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
