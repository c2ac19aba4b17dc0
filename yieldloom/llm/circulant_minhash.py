"""MinHash near-dedup: circulant signatures, banding, exact Jaccard verification, connected components.

Two fixed permutations of the 64-bit numbers make a whole signature: the first scatters a document's
shingle hashes, the second is shifted by k for coordinate k, whose value is the least image. Signatures
are cut into bands; texts whose shingle sets are equal form one class at once, and classes that share a
band are candidates. A link counts only if the full sets, built again from the texts, overlap enough.

In every bucket each class has one hub to be verified against, the bucket's most central class (the one that
meets the most others, over all its buckets), so a bucket of many near copies gives a star and not all its
pairs. A class first meets the hub that shares most of its buckets, then those of its other hubs that are not
in its component by then.
Buckets whose classes then still lie in different components go through a last round. A bucket of at most
`MANY` such classes pairs those that are not connected and whose signatures agree in at least
`least_agreement` of the coordinates. A larger one is dealt in blocks, and each pair of blocks is compared in
a task by the shingle hashes themselves (by the least `SKETCH` of them where a set has more), so that only
what really overlaps goes on to be verified. After it any two candidates are in one component or known to
have no link (up to pairs whose agreement lies over four standard deviations below their similarity).
With 32 bands of 4 coordinates a pair at similarity 0.75 becomes a candidate but for a chance of 5e-6.

Shingles are five lower-case words (A-Z only); a text of fewer words is one shingle, a text without words
has none and is linked with nothing. Sets are of 64-bit hashes, so two different shingles of a pair are
taken for one with a chance below 1e-10.

Defined results: null text counts as empty. A null doc_id is linked with nothing, its component is null
and it is kept. Repeated rows are one class: each is returned, with the same component. An empty table
gives no rows. Columns besides doc_id and text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from yieldloom.llm.word_hashes import mixed, stretches, word_hashes
from yieldloom.sources.workspace import settled, stored

SHINGLE = 5
BANDS = 32
ROWS = 4
LEAST_SHARE = 75
LEAST_AGREEMENT = 0.58
# Pairs of one hub that may meet its text in one task.
SLICE = 1000
# Classes of a bucket above which the last round compares in blocks of about BLOCK classes.
MANY = 32
BLOCK = 1024
SKETCH = 1024
# How far the share of a cut sketch may lie below the similarity: over four standard deviations; whole sets
# are hashes of 32 bits here, which may run together.
SKETCH_SLACK = 0.06
WHOLE_SLACK = 0.01
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA24BAED4963EE407], dtype=np.uint64)


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles."""
    w = word_hashes(column, lower=True)
    count = np.diff(w.first)
    n = len(w.hashes)
    rolled = np.zeros(max(0, n - size + 1), dtype=np.uint64)
    for k in range(size):
        rolled += w.hashes[k : n - size + 1 + k] * _FACTORS[k % len(_FACTORS)] * np.uint64(2 * (k // len(_FACTORS)) + 1)
    rolled = mixed(rolled)
    out = []
    for a, c in zip(w.first[:-1].tolist(), count.tolist()):
        if c >= size:
            out.append(np.unique(rolled[a : a + c - size + 1]))
        elif c:
            short = sum(int(h) * int(f) for h, f in zip(w.hashes[a : a + c], _FACTORS)) + c
            out.append(mixed(np.array([short & (2**64 - 1)], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """One row of `length` coordinates per non-empty set."""
    starts = np.cumsum([0, *[len(s) for s in sets[:-1]]])
    scattered = mixed(np.concatenate(sets) + np.uint64(0x5851F42D4C957F2D))
    out = np.empty((len(sets), length), dtype=np.uint64)
    x, y = np.empty_like(scattered), np.empty_like(scattered)
    for k in range(length):
        np.add(scattered, np.uint64(k), out=x)
        np.multiply(x, _FACTORS[3], out=x)
        np.right_shift(x, np.uint64(32), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, _FACTORS[1], out=x)
        np.right_shift(x, np.uint64(29), out=y)
        np.bitwise_xor(x, y, out=x)
        np.multiply(x, _FACTORS[0], out=x)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def fingerprints(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, size: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, digest (16 bytes, equal for equal sets, null for empty ones), bands, signature (two bytes a coordinate)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in stretches(batch.column(1)):
                sets = shingle_sets(batch.column(1).slice(lo, hi - lo), size)
                full = [s for s in sets if len(s)]
                sig = signatures(full, bands * rows) if full else np.zeros((0, bands * rows), np.uint64)
                keys = np.zeros((len(full), bands), np.uint64)
                for b in range(bands):
                    for r in range(rows):
                        keys[:, b] = mixed(keys[:, b] * _FACTORS[2] + sig[:, b * rows + r] + np.uint64(b))
                low = (sig & np.uint64(0xFFFF)).astype("<u2")
                at = iter(range(len(full)))
                digest, key_lists, low_bytes = [], [], []
                for s in sets:
                    i = next(at) if len(s) else None
                    digest.append(None if i is None else hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    key_lists.append([] if i is None else keys[i].view(np.int64))
                    low_bytes.append(b"" if i is None else low[i].tobytes())
                columns = [batch.column(0).slice(lo, hi - lo), pa.array([len(s) for s in sets], pa.int64()), pa.array(digest, pa.binary()), pa.array(key_lists, pa.list_(pa.int64())), pa.array(low_bytes, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "digest", "bands", "signature"])

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return narrow.mapInArrow(run, "doc_id long, n_shingles long, digest binary, bands array<long>, signature binary")


def verified(pairs: DataFrame, texts: DataFrame, least_share: int = LEAST_SHARE, size: int = SHINGLE) -> DataFrame:
    """Those rows (a, b) of `pairs` whose texts' full shingle sets have 100 * intersection >= least_share * union.

    `texts` is (node, text). The join on a comes last, so rows of a hub arrive together and its set is built once;
    a hub with more than SLICE pairs is sent once for each slice of them.
    """
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("b_text"))
    slices = pairs.groupBy("a").agg(F.ceil(F.count("*") / SLICE).cast("int").alias("slices")).where(F.col("slices") > 1)
    n = F.coalesce("slices", F.lit(1))
    dealt = pairs.join(slices, "a", "left").select("a", "b", F.pmod(F.xxhash64("b"), n).cast("int").alias("slice"))
    hubs = texts.select(F.col("node").alias("a"), F.col("text").alias("a_text"))
    hubs = hubs.join(slices, "a", "left").select("a", "a_text", F.explode(F.sequence(F.lit(0), n - 1)).alias("slice"))
    both = dealt.join(b, "b").join(hubs, ["a", "slice"]).select("a", "b", "a_text", "b_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, hub_set = None, None
        for batch in batches:
            for lo, hi in stretches(batch.column(3)):
                part = batch.slice(lo, hi - lo)
                left, right, sets = part.column(0).to_pylist(), part.column(1).to_pylist(), shingle_sets(part.column(3), size)
                linked = []
                for i, (x, other) in enumerate(zip(left, sets)):
                    if x != hub:
                        hub, hub_set = x, shingle_sets(part.column(2).slice(i, 1), size)[0]
                    common = len(np.intersect1d(hub_set, other, assume_unique=True))
                    if common and 100 * common >= least_share * (len(hub_set) + len(other) - common):
                        linked.append(i)
                yield pa.RecordBatch.from_arrays([pa.array([left[i] for i in linked], pa.int64()), pa.array([right[i] for i in linked], pa.int64())], ["a", "b"])

    return both.mapInArrow(run, "a long, b long")


def _kept(df: DataFrame) -> DataFrame:
    """`df` written and read again: a checkpoint would keep the constraints of its plan, which multiply in each round of a search."""
    return stored(df, "links")


def components(links: DataFrame) -> DataFrame:
    """(node, label) for every node of the links (a, b): the least node it is connected with.

    Each b follows its least a. What else b is linked with is linked with that a, so the search runs over
    the nodes that are some b's a, and a star of any size is one of them; the others take their a's label.
    """
    ends = links.select(F.col("a").alias("node"), F.col("a").alias("parent"), F.lit(True).alias("hub"))
    ends = ends.union(links.select("b", "a", F.lit(False)))
    nodes = _kept(ends.groupBy("node").agg(F.min("parent").alias("parent"), F.max("hub").alias("hub")))
    more = links.join(nodes.select(F.col("node").alias("b"), "parent"), "b").where(F.col("a") != F.col("parent")).select("parent", "a")
    nested = nodes.where(F.col("hub") & (F.col("node") != F.col("parent"))).select("parent", "node")
    found = _searched(more.union(nested).distinct()).toDF("parent", "label")
    # an a may be greater than its b's: the label is the least node that follows any of the connected ones
    least = nodes.groupBy("parent").agg(F.min("node").alias("least")).join(found, "parent", "left")
    least = least.select("parent", "least", F.coalesce("label", "parent").alias("group"))
    labels = least.join(least.groupBy("group").agg(F.min("least").alias("label")), "group").select("parent", "label")
    return _kept(nodes.select("node", "parent").join(labels, "parent").select("node", "label"))


def _searched(links: DataFrame) -> DataFrame:
    """(node, label) by passing labels to neighbours and then taking the labels of labels, until none changes; each round is written."""
    forth = links.toDF("a", "b")
    both = _kept(forth.union(forth.select("b", "a")).distinct())
    labels = _kept(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.min("a")).alias("label")))
    while True:
        offers = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("label").alias("offer"))
        better = labels.join(offers, "node").select("node", F.col("label").alias("old"), F.least("label", "offer").alias("label"))
        onward = better.select(F.col("node").alias("label"), F.col("label").alias("next"))
        moved = _kept(better.join(onward, "label").select("node", "old", F.least("label", "next").alias("label")))
        changed = moved.where(F.col("old") != F.col("label")).limit(1).count()
        labels = moved.select("node", "label")
        if not changed:
            return labels


def _apart(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows (a, b, ...) of `pairs` whose ends have different labels."""
    a = labels.select(F.col("node").alias("a"), F.col("label").alias("a_label"))
    b = labels.select(F.col("node").alias("b"), F.col("label").alias("b_label"))
    named = pairs.join(a, "a", "left").join(b, "b", "left")
    return named.where(F.coalesce("a_label", "a") != F.coalesce("b_label", "b")).select(*pairs.columns)


def _agreement(a: str, b: str, length: int):
    """Share of equal coordinates; a coordinate is two bytes, four hex digits."""
    places = F.sequence(F.lit(0), F.lit(length - 1))
    same = F.filter(places, lambda i: F.substring(F.col(a), i * 2 + 1, F.lit(2)) == F.substring(F.col(b), i * 2 + 1, F.lit(2)))
    return F.size(same) / length


def _sketches(texts: DataFrame, size: int) -> DataFrame:
    """(node, sketch, whole): the least SKETCH of a text's shingle hashes, four bytes each, and whether these are all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in stretches(batch.column(1)):
                short = [np.unique((s >> np.uint64(32)).astype(np.uint32)) for s in shingle_sets(batch.column(1).slice(lo, hi - lo), size)]
                columns = [
                    batch.column(0).slice(lo, hi - lo),
                    pa.array([s[:SKETCH].astype("<u4").tobytes() for s in short], pa.binary()),
                    pa.array([len(s) <= SKETCH for s in short], pa.bool_()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "sketch", "whole"])

    return texts.mapInArrow(run, "node long, sketch binary, whole boolean").where(F.octet_length("sketch") > 0)


def overlapping(sketches: list[np.ndarray], whole: np.ndarray, label: np.ndarray, first: np.ndarray, second: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Pairs (place in `first`, place in `second`) with different labels whose sketches may have a Jaccard similarity of `least`.

    Below the lesser end of two cut sketches both are complete, so their share there estimates the similarity.
    """
    values, codes = np.unique(np.concatenate(sketches), return_inverse=True)
    lengths = np.array([len(s) for s in sketches])
    starts = np.cumsum(lengths) - lengths
    top = np.uint32(2**32 - 1)
    limit = np.array([top if w else s[-1] for s, w in zip(sketches, whole)], np.uint32)
    flat = np.concatenate([codes[starts[j] : starts[j] + lengths[j]] for j in second])
    at = np.cumsum(lengths[second]) - lengths[second]
    marked = np.zeros(len(values), np.uint8)
    out = []
    for i in first:
        apart = label[second] != label[i]
        if not apart.any():
            continue
        own = codes[starts[i] : starts[i] + lengths[i]]
        marked[own] = 1
        common = np.add.reduceat(marked[flat], at, dtype=np.int32)
        marked[own] = 0
        n_own = np.searchsorted(sketches[i], limit[second], side="right")
        n_other = lengths[second] if whole[i] else np.add.reduceat(values[flat] <= limit[i], at, dtype=np.int32)
        needed = np.where(whole[i] & whole[second], least - WHOLE_SLACK, least - SKETCH_SLACK)
        out += [(int(i), int(second[j])) for j in np.flatnonzero(apart & (common >= needed * (n_own + n_other - common)))]
    return out


def _overlapping_in_blocks(members: DataFrame, sketches: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) of one bucket, a below b, with different labels and overlapping sketches.

    `members` is (bucket, node, label, size). Blocks follow from the node's hash; a task holds two of a bucket.
    """
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = placed.withColumn("partner", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("bucket", F.least("block", "partner").alias("low"), F.greatest("block", "partner").alias("high"), "block", "node", "label")

    def run(table: pa.Table) -> pa.Table:
        low, high = table["low"][0].as_py(), table["high"][0].as_py()
        nodes, block, label = (table[c].to_numpy() for c in ("node", "block", "label"))
        values = [np.frombuffer(s, "<u4") for s in table["sketch"].to_pylist()]
        whole = table["whole"].to_numpy()
        first, second = np.flatnonzero(block == low), np.flatnonzero(block == high)
        if low == high:
            # of two classes with different labels at least one lies outside the most frequent label
            names, counts = np.unique(label, return_counts=True)
            first = np.flatnonzero(label != names[counts.argmax()])
        found = overlapping(values, whole, label, first, second, least) if len(first) and len(second) else []
        a, b = (np.array([nodes[pair[side]] for pair in found], np.int64) for side in (0, 1))
        return pa.table({"a": np.minimum(a, b), "b": np.maximum(a, b)})

    return met.join(sketches, "node").groupBy("bucket", "low", "high").applyInArrow(run, "a long, b long").distinct()


def near_duplicates(
    docs: DataFrame, bands: int = BANDS, rows: int = ROWS, least_share: int = LEAST_SHARE, least_agreement: float = LEAST_AGREEMENT, size: int = SHINGLE
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept, one row per row of `docs`."""
    prints = settled(fingerprints(docs, bands, rows, size))
    real = prints.where(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
    classes = settled(real.groupBy("digest").agg(F.min("doc_id").alias("node")))
    own = classes.select(F.col("digest").alias("own"), F.col("node").alias("own_node"))
    reps = real.join(own, (real.doc_id == F.col("own_node")) & (real.digest == F.col("own"))).select(F.col("own_node").alias("node"), "bands", "signature")
    reps = settled(reps.dropDuplicates(["node", "bands"]))
    in_buckets = reps.select("node", F.explode("bands").alias("bucket"))
    sizes = in_buckets.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > 1)
    shared = settled(in_buckets.join(sizes, "bucket"))
    central = shared.groupBy("node").agg(F.sum("size").alias("meets"))
    hub = F.max_by("node", F.struct("meets", -F.col("node")))
    hubs = shared.select("bucket", "node").join(central, "node").groupBy("bucket").agg(hub.alias("a"))
    met = shared.join(hubs, "bucket").where(F.col("a") != F.col("node"))
    stars = met.groupBy("a", F.col("node").alias("b")).agg(F.count("*").alias("shared"))
    # a class has at most one hub in each band
    place = F.row_number().over(Window.partitionBy("b").orderBy(F.desc("shared"), "a"))
    stars = settled(stars.select("a", "b", place.alias("place")))
    first = stars.where(F.col("place") == 1).select("a", "b")
    links = _kept(verified(first, _texts(docs, classes, first), least_share, size))
    labels = components(links)
    others = _kept(_apart(stars.where(F.col("place") > 1).select("a", "b"), labels))
    if others.limit(1).count():
        links = _kept(links.union(verified(others, _texts(docs, classes, others), least_share, size)))
        labels = components(links)

    # last round: classes of one bucket that are not connected yet
    named = shared.select("bucket", "node").join(labels, "node", "left").select("bucket", "node", F.coalesce("label", "node").alias("label"))
    crossing = named.groupBy("bucket").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("size"))
    members = settled(named.join(crossing.where(F.col("low") < F.col("high")).select("bucket", "size"), "bucket"))
    few = members.where(F.col("size") <= MANY).join(reps.select("node", "signature"), "node")
    left = few.select("bucket", F.col("node").alias("a"), F.col("label").alias("a_label"), F.col("signature").alias("a_signature"))
    right = few.select("bucket", F.col("node").alias("b"), F.col("label").alias("b_label"), F.col("signature").alias("b_signature"))
    apart = (left.bucket == right.bucket) & (F.col("a") < F.col("b")) & (F.col("a_label") != F.col("b_label"))
    alike = _agreement("a_signature", "b_signature", bands * rows) >= least_agreement
    rest = left.join(right, apart & alike).select("a", "b").distinct()
    many = members.where(F.col("size") > MANY)
    if many.limit(1).count():
        sketches = _sketches(_texts(docs, classes, many.select(F.col("node").alias("a"), F.col("node").alias("b"))), size)
        rest = rest.union(_overlapping_in_blocks(many, sketches, least_share / 100)).distinct()
    known = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = _kept(rest.join(known, ["a", "b"], "left_anti"))
    if rest.limit(1).count():
        links = _kept(links.union(verified(rest, _texts(docs, classes, rest), least_share, size)))
        labels = components(links)

    named = classes.join(labels, "node", "left").select("digest", F.coalesce("label", "node").alias("component"))
    # the documents are the larger side: many of one digest are split, as the other side has one row for it
    worded = prints.where(F.col("digest").isNotNull()).select("doc_id", "n_shingles", "digest").join(named, "digest", "left")
    # empty texts have no digest and stay where they are
    wordless = prints.where(F.col("digest").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    found = worded.select("doc_id", "n_shingles", "component").union(wordless)
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, text) of the classes in `pairs`; rows that repeat a doc_id with other words are told apart by their sets."""
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    found = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(wanted, "node")
    return settled(found.groupBy("node").agg(F.min("text").alias("text")))


def deduplicated(docs: DataFrame, **options) -> DataFrame:
    """The rows of `docs` whose document is kept."""
    dropped = near_duplicates(docs, **options).where(~F.col("kept")).select(F.col("doc_id").alias("__dropped")).distinct()
    return docs.join(dropped, docs.doc_id == F.col("__dropped"), "left_anti")
