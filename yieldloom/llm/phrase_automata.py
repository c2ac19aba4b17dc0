"""Substring dedup: words inside passages that occur more than once, located by sharded Aho-Corasick automata.

A passage recurs where a window of `window` consecutive words occurs at two places, in one document or two.

1. Anchors. Of every window the least of its `gram`-word hashes is its anchor (the last of equal ones), so
   equal windows have equal anchors, at places of their own. An anchor that is found once in all documents
   rules its windows out.
2. Proposals. Consecutive windows with one recurring anchor form a block. Equal blocks are kept once with
   their number of occurrences. Nothing is confirmed yet: blocks of one anchor may have no window in common.
3. Automata. The distinct blocks are dealt by anchor to shards of about SHARD_BLOCKS. Each shard compiles the
   windows of its blocks (the whole block where an anchor has one only) into an automaton over word numbers and
   streams all its blocks through it. Each hit counts as often as its block occurs; a pattern with two or
   more occurrences is a recurring passage, and its hits are the covers. Every window of the documents is in one
   block, and equal windows meet in one shard, so these counts are of all documents.
   An anchor with more than SHARD_BLOCKS distinct blocks is not held in one shard: its blocks are cut into pieces.
   The windows of a piece begin at most so many places from another, counted back from the anchor, as the first of
   CUTS says. So they share all but that many of their words, the core. Equal windows have equal cores: equal pieces
   are added up and dealt by their cores, and a core that occurs once rules its piece out. What still is too large
   for a shard is cut by the next of CUTS, down to single windows.
4. The covers go back to all places of a block, and a document's covered words are removed.

Anchors and 128-bit hashes of blocks only propose; the automata compare words, and covers come from their hits. Nothing gathers a block's or an anchor's places:
frequent ones are counted by partial aggregation, and joined with a side that has one row for each.

Defined results: words are kept as they are, case included; null text has none. A document with fewer than
`window` words loses none. Rows that repeat a doc_id are places of their own, so they are removed as copies;
rows with a null doc_id likewise. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldloom.llm.word_hashes import Words, mixed, stretches, word_hashes
from yieldloom.sources.workspace import new_folder

WINDOW = 35
GRAM = 6
# Blocks per automaton, at most twice as many: with up to WINDOW windows each, this bounds its nodes.
SHARD_BLOCKS = 500
# How many windows a piece of a block may have, cut by cut; the last leaves single windows.
CUTS = (10, 4, 1)
NO_ID = -(2**63)
_PLACE_BITS = 28
_PLACE = np.uint64((1 << _PLACE_BITS) - 1)
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


class Rolling:
    """128-bit hashes of word ranges, from prefix sums of word hashes times powers of an odd number."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.sums, self.back = [], []
        for base in _BASES:
            power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, base)]), dtype=np.uint64)
            inverse = np.uint64(pow(int(base), -1, 1 << 64))
            self.back.append(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64))
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(mixed(hashes + base) * power[:n], dtype=np.uint64)]))

    def of(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        length = (end - start).astype(np.uint64)
        return tuple(mixed((s[end] - s[start]) * b[start] + length) for s, b in zip(self.sums, self.back))


def anchors(w: Words, window: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The starts of all windows, the document of each, the place of its anchor, and the anchors' hashes."""
    none = np.zeros(0, np.int64)
    n = len(w.hashes)
    count = np.maximum(np.diff(w.first) - window + 1, 0)
    if n < window or not count.sum():
        return none, none, none, none.astype(np.uint64)
    doc = np.repeat(np.arange(len(count)), count)
    start = np.arange(int(count.sum())) + np.repeat(w.first[:-1] - (np.cumsum(count) - count), count)
    grams = np.zeros(n - gram + 1, dtype=np.uint64)
    for k in range(gram):
        grams += w.hashes[k : n - gram + 1 + k] * np.uint64(pow(int(_BASES[0]), k + 1, 1 << 64))
    grams = mixed(grams)
    # a hash above its place turned round, so that the least is the last place of the least hash
    least = (grams & ~_PLACE) | (_PLACE - np.arange(len(grams), dtype=np.uint64))
    span, wide = 1, window - gram + 1
    while 2 * span <= wide:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < wide:
        rest = wide - span
        least = np.minimum(least[: len(least) - rest], least[rest:])
    place = (_PLACE - (least[start] & _PLACE)).astype(np.int64)
    return start, doc, place, grams[place]


def _anchor_rows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """(anchor, doc, n): how many places of a document each anchor is chosen at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for lo, hi in stretches(batch.column(1)):
                _, doc, place, hashes = anchors(word_hashes(batch.column(1).slice(lo, hi - lo)), window, gram)
                place, at = np.unique(place, return_index=True)
                pairs = np.rec.fromarrays([doc[at], hashes[at].view(np.int64)], names="d,a")
                pairs, n = np.unique(pairs, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs.a), pa.array(ids[lo:hi][pairs.d]), pa.array(n)], ["anchor", "doc", "n"])

    return docs.mapInArrow(run, "anchor long, doc long, n long")


def _marked(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """doc, text, recurring (its recurring anchors) to doc, n_words, whole (digest of all words), text and blocks.

    A document without blocks loses its text here; one with blocks has no digest yet.
    """
    schema = "doc long, n_words long, whole string, text string, blocks array<struct<start:int,n:int,anchor:long,place:int,h1:long,h2:long>>"
    block = pa.struct([("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()), ("place", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in stretches(batch.column(1)):
                part = batch.slice(lo, hi - lo)
                w = word_hashes(part.column(1))
                start, doc, place, hashes = anchors(w, window, gram)
                known = part.column(2)
                sizes = known.value_lengths().to_numpy()
                flat = known.flatten().to_numpy().view(np.uint64)
                salt = np.uint64(0x165667B19E3779F9)
                wanted = mixed(flat + np.repeat(np.arange(len(sizes)), sizes).astype(np.uint64) * salt)
                hit = np.isin(mixed(hashes + doc.astype(np.uint64) * salt), wanted)
                s, d, p, a = start[hit], doc[hit], place[hit], hashes[hit]
                new = np.ones(len(s), dtype=bool)
                new[1:] = (p[1:] != p[:-1]) | (s[1:] != s[:-1] + 1)
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(s)))
                h1, h2 = Rolling(w.hashes).of(s[first], s[first] + n + window - 1)
                # equal words may lie around another anchor of equal windows; the number of windows is part of the hash
                values = pa.StructArray.from_arrays(
                    [pa.array((s[first] - w.first[d[first]]).astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(a[first].view(np.int64)), pa.array((p[first] - s[first]).astype(np.int32)), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                    fields=list(block),
                )
                ends = np.searchsorted(d[first], np.arange(len(part) + 1))
                held = (np.diff(ends) > 0).tolist()
                plain = part.column(1).cast(pa.binary()).to_pylist()
                texts = pa.array([text if h else None for h, text in zip(held, plain)], pa.binary()).cast(pa.string())
                whole = [None if h else _digest(_split(text)) for h, text in zip(held, plain)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(w.first)), pa.array(whole, pa.string()), texts, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), values)],
                    ["doc", "n_words", "whole", "text", "blocks"],
                )

    return docs.mapInArrow(run, schema)


def _split(text: bytes | None) -> list[bytes]:
    """Words of a text's bytes: these are cut at ASCII white space only, unlike those of a str."""
    return (text or b"").split()


def _digest(kept: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(kept)).hexdigest()


def _block_rows(marked: DataFrame, window: int) -> DataFrame:
    """(h1, h2, anchor, place, n, words, times) from documents, one row per block of a batch; place is where the anchor begins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[tuple[int, int], list] = {}
            blocks = batch.column(1)
            ends = np.cumsum(blocks.value_lengths().to_numpy()).tolist()
            blocks = blocks.flatten()
            rows = list(zip(*(blocks.field(name).to_pylist() for name in ("h1", "h2", "anchor", "place", "n", "start"))))
            for text, lo, hi in zip(batch.column(0).cast(pa.binary()).to_pylist(), [0, *ends], ends):
                words = _split(text)
                for h1, h2, anchor, place, n, start in rows[lo:hi]:
                    known = found.get((h1, h2))
                    if known:
                        known[4] += 1
                    else:
                        found[h1, h2] = [anchor, place, n, b" ".join(words[start : start + n + window - 1]), 1]
            keys, rest = list(found), list(found.values())
            types = (pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int64())
            columns = [pa.array([k[i] for k in keys], pa.int64()) for i in (0, 1)] + [pa.array([r[i] for r in rest], t) for i, t in enumerate(types)]
            columns[5] = columns[5].cast(pa.string())
            yield pa.RecordBatch.from_arrays(columns, ["h1", "h2", "anchor", "place", "n", "words", "times"])

    return marked.where(F.col("text").isNotNull()).select("text", "blocks").mapInArrow(run, "h1 long, h2 long, anchor long, place int, n int, words string, times long")


def _hits(rows: list[tuple], window: int) -> list[list[list[int]]]:
    """For each row (deal, h1, h2, words, times) the word ranges that recurring passages of these rows cover.

    Rows of one deal come together. The passages are found by the automaton alone: what it does not hit is not covered.
    """
    import ahocorasick

    numbers: dict[str, int] = {}
    texts = [tuple(numbers.setdefault(w, len(numbers) + 1) for w in r[3].split(" ")) for r in rows]
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    lengths: list[int] = []
    for i, (row, text) in enumerate(zip(rows, texts)):
        alone = (i == 0 or rows[i - 1][0] != row[0]) and (i + 1 == len(rows) or rows[i + 1][0] != row[0])
        size = len(text) if alone else window
        for a in range(len(text) - size + 1):
            # of equal patterns the last number stands
            automaton.add_word(text[a : a + size], len(lengths))
            lengths.append(size)
    automaton.make_automaton()
    counts = [0] * len(lengths)
    found = []
    for row, text in zip(rows, texts):
        hits = list(automaton.iter(text))
        for _, pattern in hits:
            counts[pattern] += row[4]
        found.append(hits)
    covers = []
    for hits in found:
        spans: list[list[int]] = []
        for end, pattern in hits:
            if counts[pattern] < 2:
                continue
            start = end + 1 - lengths[pattern]
            while spans and spans[-1][0] >= start:
                spans.pop()
            if spans and spans[-1][1] >= start:
                spans[-1][1] = end + 1
            else:
                spans.append([start, end + 1])
        covers.append(spans)
    return covers


def _pieces(blocks: DataFrame, window: int, most: int) -> DataFrame:
    """Pieces of at most `most` windows from (deal, h1, h2, place, n, words, times): the windows before the anchor are cut at multiples of `most`.

    `at` is the piece's first window in its block (h1, h2), (w1, w2) its own name, and `deal` comes from its core.
    """
    part, place, n = F.col("part"), F.col("place"), F.col("n")
    parts = F.sequence(F.floor((place - n + 1) / most).cast("int"), F.floor(place / most).cast("int"))
    cut = blocks.select("*", F.explode(parts).alias("part"))
    first, last = F.greatest(F.lit(0), place - (part + 1) * most + 1), F.least(n - 1, place - part * most)
    cut = cut.withColumns({"at": first, "m": last - first + 1, "split": F.split("words", " ")})
    core = F.array_join(F.slice("split", place - part * most + 1, window + 1 - most), " ")
    words = F.array_join(F.slice("split", F.col("at") + 1, F.col("m") + window - 1), " ")
    cut = cut.select("h1", "h2", "at", "times", F.xxhash64("deal", "part", core).alias("deal"), (place - F.col("at")).alias("place"), F.col("m").alias("n"), words.alias("words"))
    return cut.withColumns({f"w{i}": F.xxhash64(F.lit(i), F.lit(most), "words") for i in (1, 2)})


def _located(blocks: DataFrame, window: int, shard_blocks: int) -> DataFrame:
    """(h1, h2, covers): word ranges of distinct blocks (h1, h2, anchor, place, n, words, times) that occur elsewhere too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush() -> pa.RecordBatch:
            kept = [(r[5], r[1], r[2], c) for r, c in zip(held, _hits(held, window)) if c]
            held.clear()
            types = (pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.list_(pa.int32())))
            return pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], t) for i, t in enumerate(types)], ["level", "h1", "h2", "covers"])

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(6))):
                if len(held) >= shard_blocks and held[-1][0] != row[0]:
                    yield flush()
                held.append(row)
        if held:
            yield flush()

    pieces = blocks.withColumnRenamed("anchor", "deal")
    sums = pieces.groupBy("deal").agg(F.count("*").alias("same"))
    split = pieces.join(sums.where(F.col("same") > shard_blocks), "deal", "left")
    fitting, cuts = [split.where(F.col("same").isNull())], []
    for most in CUTS:
        cut = _written(_pieces(split.where(F.col("same") > shard_blocks), window, min(most, window)), "passages-cut")
        cuts.append(cut.select("h1", "h2", "at", "w1", "w2"))
        # equal words have equal cores and one place of the anchor
        pieces = cut.groupBy(F.col("w1").alias("h1"), F.col("w2").alias("h2")).agg(F.sum("times").alias("times"), *[F.first(c).alias(c) for c in ("deal", "place", "n", "words")])
        sums = pieces.groupBy("deal").agg(F.count("*").alias("same"), F.sum("times").alias("all")).where(F.col("all") > 1)
        split = pieces.join(sums, "deal")
        fitting.append(split.where(F.col("same") <= shard_blocks) if most > 1 else split)
    columns = ["deal", "h1", "h2", "words", "times"]
    dealt = fitting[0].select(*columns, F.lit(0).alias("level"))
    for level, fit in enumerate(fitting[1:], 1):
        dealt = dealt.union(fit.select(*columns, F.lit(level).alias("level")))
    dealt = dealt.repartition("deal").sortWithinPartitions("deal")
    covers = _written(dealt.mapInArrow(run, "level int, h1 long, h2 long, covers array<array<int>>"), "passages-covers")
    of = [covers.where(F.col("level") == level).drop("level") for level in range(len(CUTS) + 1)]
    found = of.pop()
    for cut, outer in zip(reversed(cuts), reversed(of)):
        # the covers of a piece move by its place in the block
        shifted = F.transform("covers", lambda c: F.transform(c, lambda x: x + F.col("at")))
        inner = found.select(F.col("h1").alias("w1"), F.col("h2").alias("w2"), "covers")
        found = outer.union(cut.join(inner, ["w1", "w2"]).select("h1", "h2", shifted.alias("covers")))
    return found


def _cut(marked: DataFrame, text_column: bool) -> DataFrame:
    """doc, n_words, n_removed, kept_sha256 (and before, a hash of the text, and kept, what is left) from marked rows with `spans`."""
    schema = "doc long, n_words long, n_removed long, kept_sha256 string" + ", before long, kept string" * text_column

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, digests, texts = [], [], []
            spans = batch.column(3)
            bounds = spans.flatten().flatten().to_numpy().reshape(-1, 2)
            # null spans count as none
            ends = np.cumsum(pc.fill_null(spans.value_lengths(), 0).to_numpy()).tolist()
            for text, lo, hi in zip(batch.column(2).cast(pa.binary()).to_pylist(), [0, *ends], ends):
                kept = words = _split(text)
                if hi > lo:
                    gone = np.bincount(bounds[lo:hi, 0], minlength=len(words) + 1) - np.bincount(bounds[lo:hi, 1], minlength=len(words) + 1)
                    kept = list(compress(words, (np.cumsum(gone) == 0).tolist()))
                removed.append(len(words) - len(kept))
                digests.append(_digest(kept))
                if text_column:
                    texts.append((b" ".join(kept) if removed[-1] else text).decode())
            columns = [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(digests, pa.string())] 
            columns += [batch.column(4), pa.array(texts, pa.string())] if text_column else []
            yield pa.RecordBatch.from_arrays(columns, ["doc", "n_words", "n_removed", "kept_sha256"] + ["before", "kept"] * text_column)

    return marked.select("doc", "n_words", "text", "spans", "h").mapInArrow(run, schema)


def _written(df: DataFrame, name: str) -> DataFrame:
    """`df` as Parquet in the shared folder: well compressed, unlike a checkpoint."""
    spark: SparkSession = df.sparkSession
    folder = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(folder)
    return spark.read.parquet(folder)


def _covered(docs: DataFrame, window: int, gram: int, shard_blocks: int) -> tuple[DataFrame, DataFrame]:
    """The marked documents, and (doc, h, spans) of those with covered words. `docs` is (doc, text)."""
    rows = _anchor_rows(docs, window, gram)
    recurring = rows.groupBy("anchor").agg(F.sum("n").alias("n")).where(F.col("n") > 1).select("anchor")
    by_doc = rows.select("anchor", "doc").join(recurring, "anchor").groupBy("doc").agg(F.collect_list("anchor").alias("recurring"))
    joined = docs.join(by_doc, "doc", "left").select("doc", "text", F.coalesce("recurring", F.array().cast("array<long>")).alias("recurring"))
    marked = _written(_marked(joined, window, gram), "passages-marked")
    blocks = _block_rows(marked, window).groupBy("h1", "h2").agg(F.sum("times").alias("times"), *[F.first(c).alias(c) for c in ("anchor", "place", "n", "words")])
    blocks = _written(blocks, "passages-blocks")
    covers = _located(blocks, window, shard_blocks)
    places = marked.where(F.col("text").isNotNull()).select("doc", F.xxhash64("text").alias("h"), F.explode("blocks").alias("b"))
    found = places.select("doc", "h", "b.start", "b.h1", "b.h2").join(covers, ["h1", "h2"]).select("doc", "h", "start", F.explode("covers").alias("c"))
    spans = found.groupBy("doc", "h").agg(F.collect_list(F.array(F.col("start") + F.get("c", F.lit(0)), F.col("start") + F.get("c", F.lit(1)))).alias("spans"))
    return marked, spans


def _cuts(docs: DataFrame, window: int, gram: int, shard_blocks: int, text_column: bool) -> tuple[DataFrame, DataFrame]:
    """The marked rows without any block, and the cut rows of those with some."""
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), "text")
    marked, spans = _covered(keyed, window, gram, shard_blocks)
    # rows that share a doc_id are told apart by their texts
    held = marked.where(F.col("text").isNotNull()).withColumn("h", F.xxhash64("text")).join(spans, ["doc", "h"], "left")
    return marked.where(F.col("text").isNull()), _cut(held, text_column)


def removals(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (of the kept words joined by one space), one row per row of `docs`."""
    untouched, cut = _cuts(docs, window, gram, shard_blocks, False)
    both = untouched.select("doc", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("whole").alias("kept_sha256")).unionByName(cut)
    return both.select(F.when(F.col("doc") != NO_ID, F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, shard_blocks: int = SHARD_BLOCKS) -> DataFrame:
    """`docs` with covered words removed: where any are, the kept words are joined by one space and n_chars is their length."""
    _, cut = _cuts(docs, window, gram, shard_blocks, True)
    changed = cut.where(F.col("n_removed") > 0).select(F.col("doc").alias("__doc"), F.col("before").alias("__h"), F.col("kept").alias("__kept")).distinct()
    own = (F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)) == F.col("__doc")) & (F.xxhash64("text") == F.col("__h"))
    out = docs.join(changed, own, "left").withColumn("text", F.coalesce("__kept", "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__kept").isNotNull(), F.length("__kept").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
