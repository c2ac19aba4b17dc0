"""Ranked lexical search by branch and bound over FP-trees of documents.

Terms are lower-cased (A-Z) runs of ASCII letters, digits and non-ASCII characters. A first pass reduces each
document to its length and its frequencies of the items' terms, and counts the corpus. Then every task packs
its vectors, terms in order of falling document frequency, into tries: documents that share their most
frequent terms share a path, and a branch of few documents is a leaf. Every node keeps the largest frequency
of each term below it and the least m; as a score grows with the frequency and falls with m, both bound the
score of every document below. An item's search goes depth-first into the child of the highest bound and
leaves out subtrees that can't reach the item's ten best of that task; documents in leaves are scored exactly.
Tasks report at most `top` documents an item, which are ranked together, so the answer is exact.

Scale: a tree holds at most TREE_DOCUMENTS vectors of one task, whatever the table's size, and node maxima
are kept per term bin (a bin's maximum bounds each of its terms), so memory is bounded; there is no shuffle
but of reports and term counts. Items are searched in blocks of about BLOCK_TERMS terms, which bounds what is
sent to the tasks.

Defined results: null and empty texts have no terms, aren't counted and aren't found. Repeated rows are
documents of their own and take a rank each. Rows that share an item_id are one item with the terms of all. A
null doc_id or item_id is kept as null; a null doc_id comes first among equal scores. An item without terms,
or whose terms no document holds, has no rows. Columns other than doc_id, text, item_id are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from yieldloom.llm.word_hashes import stretches, string_bytes, word_hashes
from yieldloom.sources.workspace import settled, stored

TOP = 10
# Items are put in blocks of about this many distinct terms (counted per item).
BLOCK_TERMS = 100_000
TREE_DOCUMENTS = 8_192
# Entries (document, term) after which a tree is closed early.
TREE_ENTRIES = 4_000_000
# A branch of at most this many documents is a leaf.
LEAF_DOCUMENTS = 12
BINS = 4_096
NO_ID = -(2**63)
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_IN_TERM = np.zeros(256, dtype=bool)
_IN_TERM[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


# --- vectors


def _only_terms(column: pa.Array) -> pa.Array:
    """The texts with every byte outside terms blanked, so that their terms are their words."""
    data, offsets = string_bytes(column)
    blanked = np.where(_IN_TERM[data], data, np.uint8(0x20)) if len(data) else np.zeros(1, np.uint8)
    return pa.LargeStringArray.from_buffers(len(column), pa.py_buffer(np.ascontiguousarray(offsets)), pa.py_buffer(blanked))


class Vocabulary:
    """Finds terms by hash and compares their bytes."""

    def __init__(self, terms: list[str]):
        known = word_hashes(pa.array(terms, pa.large_string()))
        self.order = np.argsort(known.hashes, kind="stable")
        self.hashes, self.data = known.hashes[self.order], known.data
        self.start, self.size = known.start[self.order], (known.end - known.start)[self.order]

    def find(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Terms per text, and of each term that is known, its text and number."""
        spelled = word_hashes(_only_terms(column), lower=True)
        counts = np.diff(spelled.first)
        texts = np.repeat(np.arange(len(counts)), counts)
        if not len(self.hashes) or not len(texts):
            return counts, np.zeros(0, np.int64), np.zeros(0, np.int64)
        place = np.minimum(np.searchsorted(self.hashes, spelled.hashes), len(self.hashes) - 1)
        size = spelled.end - spelled.start
        met = np.flatnonzero((self.hashes[place] == spelled.hashes) & (self.size[place] == size))
        if not len(met):
            return counts, met, met
        place, size, start = place[met], size[met], spelled.start[met]
        packed = np.cumsum(size) - size
        inner = np.arange(int(size.sum())) - np.repeat(packed, size)
        equal = spelled.data[np.repeat(start, size) + inner] == self.data[np.repeat(self.start[place], size) + inner]
        same = np.logical_and.reduceat(equal, packed)
        return counts, texts[met[same]], self.order[place[same]]


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values))


def vectors(docs: DataFrame, terms: list[str]) -> DataFrame:
    """doc_id, n (terms of the document), terms (numbers in `terms`, ascending) and tfs, for documents with terms."""

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(terms)
        for batch in batches:
            for lo, hi in stretches(batch.column("text")):
                counts, texts, numbers = known.find(batch.column("text").slice(lo, hi - lo))
                keys, tfs = np.unique(texts * max(1, len(terms)) + numbers, return_counts=True)
                rows = np.flatnonzero(counts)
                offsets = np.searchsorted(keys // max(1, len(terms)), np.append(rows, len(counts)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, hi - lo).take(pa.array(rows)), pa.array(counts[rows].astype(np.int64)),
                     _lists((keys % max(1, len(terms))).astype(np.int32), offsets), _lists(tfs.astype(np.int64), offsets)],
                    names=["doc_id", "n", "terms", "tfs"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(reduced, "doc_id long, n long, terms array<int>, tfs array<long>")


# --- trees


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count adds per unit of weight."""
    return (1_000_000_000 * tf) // (1_000 * tf + 8 * m)


@dataclass
class Forest:
    """The trie of one lot of documents, as arrays. Node v covers the documents first[v] up to last[v] and has
    the nodes child[v] up to child_end[v]; tf[v] holds the largest frequency per bin, m[v] the least m."""

    ids: np.ndarray
    ms: np.ndarray
    offsets: np.ndarray
    terms: np.ndarray
    tfs: np.ndarray
    first: np.ndarray
    last: np.ndarray
    child: np.ndarray
    child_end: np.ndarray
    tf: np.ndarray
    m: np.ndarray


def _branches(ranks: np.ndarray, offsets: np.ndarray, lo: int, hi: int, depth: int, leaf: int) -> tuple[list[tuple[int, int]], int]:
    """The ranges below documents lo to hi, which share `depth` terms, and how many terms they share in all.

    Neighbours too small for a node of their own are put together up to the size of a leaf."""
    low, high = ranks[offsets[lo] + depth : offsets[lo + 1]], ranks[offsets[hi - 1] + depth : offsets[hi]]
    most = min(len(low), len(high))
    differs = np.flatnonzero(low[:most] != high[:most])
    depth += int(differs[0]) if len(differs) else most
    ends = offsets[lo + 1 : hi + 1] - offsets[lo:hi] <= depth
    following = np.where(ends, -1, ranks[np.minimum(offsets[lo:hi] + depth, len(ranks) - 1)])
    cuts = lo + 1 + np.flatnonzero(np.diff(following))
    edges = [lo, *cuts.tolist(), hi]
    out: list[tuple[int, int]] = []
    for a, b in zip(edges, edges[1:]):
        if out and b - out[-1][0] <= leaf:
            out[-1] = (out[-1][0], b)
        elif b - a > leaf and following[a - lo] == -1:
            # equal vectors have no more terms to branch by
            out.extend((x, min(x + leaf, b)) for x in range(a, b, leaf))
        else:
            out.append((a, b))
    return out, depth


def grow(ids: np.ndarray, ms: np.ndarray, offsets: np.ndarray, terms: np.ndarray, tfs: np.ndarray, rank: np.ndarray, bins: int = BINS, leaf: int = LEAF_DOCUMENTS) -> Forest:
    """The tree of documents given as vectors; `rank` puts terms in order of falling document frequency."""
    ranks = rank[terms]
    docs = np.repeat(np.arange(len(ids)), np.diff(offsets))
    inner = np.lexsort((ranks, docs))
    ranks, terms, tfs = ranks[inner], terms[inner], tfs[inner]
    spelled = ranks.astype(">u4")
    order = np.array(sorted(range(len(ids)), key=lambda i: spelled[offsets[i] : offsets[i + 1]].tobytes()), dtype=np.int64)
    sizes = np.diff(offsets)[order]
    moved = np.concatenate([[0], np.cumsum(sizes)])
    take = np.repeat(offsets[:-1][order] - moved[:-1], sizes) + np.arange(moved[-1])
    ranks, terms, tfs, offsets = ranks[take], terms[take], tfs[take], moved
    ids, ms = ids[order], ms[order]

    first, last, child, child_end, depths = [0], [len(ids)], [0], [0], [0]
    at = 0
    while at < len(first):
        if last[at] - first[at] > leaf:
            parts, depth = _branches(ranks, offsets, first[at], last[at], depths[at], leaf)
            if len(parts) > 1:
                child[at], child_end[at] = len(first), len(first) + len(parts)
                for a, b in parts:
                    first.append(a), last.append(b), child.append(0), child_end.append(0), depths.append(depth)
        at += 1
    nodes = len(first)
    firsts, lasts, children, child_ends = (np.array(x, dtype=np.int64) for x in (first, last, child, child_end))
    tf, least = np.zeros((nodes, bins), dtype=np.int64), np.zeros(nodes, dtype=np.int64)
    for v in range(nodes - 1, -1, -1):
        if child[v] < child_end[v]:
            tf[v], least[v] = tf[child[v] : child_end[v]].max(axis=0), least[child[v] : child_end[v]].min()
        else:
            inside = slice(offsets[first[v]], offsets[last[v]])
            np.maximum.at(tf[v], terms[inside] % bins, tfs[inside])
            least[v] = ms[first[v] : last[v]].min() if last[v] > first[v] else 0
    return Forest(ids, ms, offsets, terms, tfs, firsts, lasts, children, child_ends, tf, least)


def search(tree: Forest, wanted: np.ndarray, weights: np.ndarray, by_term: np.ndarray, best: list[tuple[int, int]], top: int) -> int:
    """Adds the documents of `tree` that belong to `best`, a heap of at most `top` (score, -doc_id); returns how
    many documents were scored. `by_term` holds `weights` at `wanted` and 0 elsewhere."""
    bins = tree.tf.shape[1]

    def bound(nodes: slice) -> np.ndarray:
        return (gain(tree.tf[nodes][:, wanted % bins], tree.m[nodes, None]) * weights).sum(axis=1)

    scored = 0
    stack = [(int(bound(slice(0, 1))[0]), 0)]
    while stack:
        most, node = stack.pop()
        # an equal score may still win by its id
        if most <= 0 or len(best) == top and most < best[0][0]:
            continue
        lo, hi = int(tree.child[node]), int(tree.child_end[node])
        if lo < hi:
            bounds = bound(slice(lo, hi))
            order = np.argsort(bounds, kind="stable")
            order = order[bounds[order] >= (best[0][0] if len(best) == top else 1)]
            stack.extend(zip(bounds[order].tolist(), (lo + order).tolist()))
            continue
        lo, hi = int(tree.first[node]), int(tree.last[node])
        scored += hi - lo
        a, b = tree.offsets[lo], tree.offsets[hi]
        m = np.repeat(tree.ms[lo:hi], np.diff(tree.offsets[lo : hi + 1]))
        gains = np.concatenate([[0], np.cumsum(gain(tree.tfs[a:b], m) * by_term[tree.terms[a:b]])])
        scores = gains[tree.offsets[lo + 1 : hi + 1] - a] - gains[tree.offsets[lo:hi] - a]
        for doc, score in zip(tree.ids[lo:hi].tolist(), scores.tolist()):
            if score > 0:
                entry = (score, -doc)
                if len(best) < top:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
    return scored


def _lots(batches: Iterator[pa.RecordBatch], average: tuple[int, int], most_docs: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Vectors of the task in lots of bounded size: ids, m, offsets, terms, tfs."""
    n_docs, n_terms = average
    held: list[tuple[np.ndarray, ...]] = []
    docs = entries = 0

    def lot() -> tuple[np.ndarray, ...]:
        ids, ns, sizes, terms, tfs = (np.concatenate(x) for x in zip(*held))
        ms = 100 - 90 + (90 * ns * n_docs) // n_terms
        return ids, ms, np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64), terms.astype(np.int64), tfs

    for batch in batches:
        for at in range(0, batch.num_rows, 1_024):
            part = batch.slice(at, 1_024)
            terms, tfs = part.column("terms"), part.column("tfs")
            sizes = terms.value_lengths().to_numpy(zero_copy_only=False)
            ids = part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)
            held.append((ids, part.column("n").to_numpy(zero_copy_only=False), sizes, terms.flatten().to_numpy(zero_copy_only=False), tfs.flatten().to_numpy(zero_copy_only=False)))
            docs, entries = docs + len(ids), entries + int(sizes.sum())
            if docs >= most_docs or entries >= TREE_ENTRIES:
                yield lot()
                held, docs, entries = [], 0, 0
    if held:
        yield lot()


def _block_ranking(docs: DataFrame, items: list[list[str]], top: int, most_docs: int) -> DataFrame:
    """item (number in `items`), doc_id, score: the best of every task for every item."""
    terms = sorted({t for item in items for t in item})
    packed = stored(vectors(docs, terms), "vectors")
    n_docs, n_terms = (x or 0 for x in packed.agg(F.count("*"), F.sum("n")).head())
    held = dict(packed.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*").alias("df")).collect())
    frequency = np.array([held.get(i, 0) for i in range(len(terms))], dtype=np.int64)
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in frequency], dtype=np.int64)
    rank = np.empty(len(terms), dtype=np.int64)
    rank[np.argsort(-frequency, kind="stable")] = np.arange(len(terms))
    number = {t: i for i, t in enumerate(terms)}
    # terms that no document has, or that weigh nothing, add nothing
    asked = [np.array(sorted(i for i in map(number.get, item) if frequency[i] and weight[i]), dtype=np.int64) for item in items]

    def ranked_in_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple[int, int]]] = [[] for _ in asked]
        by_term = np.zeros(len(weight), dtype=np.int64)
        for lot in _lots(batches, (n_docs, n_terms), most_docs):
            tree = grow(*lot, rank=rank)
            for wanted, heap in zip(asked, best):
                if len(wanted):
                    by_term[wanted] = weight[wanted]
                    search(tree, wanted, weight[wanted], by_term, heap, top)
                    by_term[wanted] = 0
        found = [(i, -doc, score) for i, heap in enumerate(best) for score, doc in heap]
        columns = list(zip(*found)) or [(), (), ()]
        ids = pa.array([None if d == NO_ID else d for d in columns[1]], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int32()), ids, pa.array(columns[2], pa.int64())], names=["item", "doc_id", "score"])

    return packed.mapInArrow(ranked_in_task, "item int, doc_id long, score long")


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, block_terms: int = BLOCK_TERMS, tree_documents: int = TREE_DOCUMENTS) -> DataFrame:
    """item_id, rank, doc_id, score: the `top` documents of the highest scores above 0 for each item."""
    spark = docs.sparkSession
    spelled = items.select("item_id", F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(TERM), F.lit(0))).alias("term"))
    asked = settled(spelled.groupBy("item_id").agg(F.collect_set("term").alias("terms")))
    blocks = -(-(asked.agg(F.sum(F.size("terms"))).head()[0] or 0) // block_terms)
    named = StructType([StructField("item", IntegerType()), asked.schema["item_id"]])
    out = None
    for block in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(blocks)) == block).collect()
        found = _block_ranking(docs, [r["terms"] for r in rows], top, tree_documents)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], named)
        found = found.join(F.broadcast(names), "item").select("item", "item_id", "doc_id", "score")
        place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_first("doc_id")))
        found = found.withColumn("rank", place).where(F.col("rank") <= top).select("item_id", "rank", "doc_id", "score")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return asked.where(F.lit(False)).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return out
