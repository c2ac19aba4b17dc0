"""SentencePiece BPE encoding with seeded merge-dropout, and decoding.

Encoding works through an agenda of candidate merges, best piece first and leftmost among equals. A
candidate is skipped when a keyed hash of it falls below `dropout`; it comes back only as part of a new
candidate. The key is the seed, the chunk's characters, the occurrence (a hash of the document's id and the
chunk's place in it) and the candidate's span. So a document is segmented alike in every run, while the same
word varies freely within and between documents. With `dropout` 0 the result is the tokenizer's own.

A chunk is a run of blanks and what follows up to the next blank, or one character that is no piece; no
piece reaches across chunks, which is checked when the tokenizer is read. All chunks of a batch work
through their agendas together, one merge each per step; chunks over `LONGEST` symbols use a heap. Which of a chunk's
possible merges an occurrence skips decides its segmentation, so occurrences of a chunk that skip the same
ones are segmented once per batch, and kept between batches within a bounded cache.

Decoding joins the pieces; bytes of characters that are no piece are joined as bytes, so that any text comes
back unchanged, also one with the tokenizer's blank sign in it.

Defined results: null and empty text give no ids and decode to the empty text. Repeated rows are encoded
alike. A null doc_id is hashed like -1. Only doc_id and text are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldloom.llm.word_hashes import MULTIPLIER, mixed

DROPOUT = 0.1
SEED = 11
LONGEST = 24
NEVER = np.int32(2**31 - 1)
# Characters worked on at a time, and entries kept between batches: both bound a task's memory.
STRETCH = 1 << 20
CACHED = 400_000
BLANK = "▁"
WORD = (1 << 64) - 1
STEP_BITS = 20
SPAN = 0xA24BAED4963EE407


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@dataclass
class Pieces:
    """The tokenizer as arrays: `first` maps a code point to its piece (-1: none), `pairs` the sorted keys left * n + right of all merges.

    `steps` is a hash table of the keys node * n + symbol of the tree of all pieces' beginnings (-1: free), `child` the
    nodes they lead to; a symbol alone is the node of its own number, and `ends` has the piece that ends at a node (-1: none).
    `named` has a hash for each code point, alike for those of one symbol.
    """

    n: int
    first: np.ndarray
    pairs: np.ndarray
    merged: np.ndarray
    rank: np.ndarray
    byte_ids: list[int]
    spelled: list[bytes]
    blank: int
    steps: np.ndarray
    child: np.ndarray
    ends: np.ndarray
    named: np.ndarray

    def merge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that two pieces make, -1 if none."""
        key = left.astype(np.int64) * self.n + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where((self.pairs[at] == key) & (left >= 0) & (right >= 0), self.merged[at], np.int32(-1))

    def follow(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        """The node that a symbol leads to from a node, -1 if none."""
        key = node.astype(np.int64) * self.n + symbol
        slot = ((key.astype(np.uint64) * np.uint64(MULTIPLIER)) >> np.uint64(64 - STEP_BITS)).astype(np.int64)
        held = self.steps[slot]
        other = np.flatnonzero((held != key) & (held >= 0))
        while len(other):
            slot[other] = (slot[other] + 1) & ((1 << STEP_BITS) - 1)
            held[other] = self.steps[slot[other]]
            other = other[(held[other] != key[other]) & (held[other] >= 0)]
        return np.where(held == key, self.child[slot], np.int32(-1))


@cache
def pieces(path: str) -> Pieces:
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    special = {i for i in range(n) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i)}
    ids = {sp.id_to_piece(i): i for i in range(n) if i not in special}
    first = np.full(0x110000, -1, dtype=np.int32)
    for piece, i in ids.items():
        if len(piece) == 1:
            first[ord(piece)] = i
        if BLANK in piece.lstrip(BLANK) or any(c not in ids for c in piece):
            raise ValueError(f"piece {piece!r} reaches across chunks or is not made of pieces")
    blank = int(first[ord(BLANK)])
    first[ord(BLANK)], first[ord(" ")] = -1, blank
    order = sorted(ids.values(), key=lambda i: (-sp.get_score(i), i))
    rank = np.full(n, NEVER, dtype=np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    found = {}
    for piece, i in ids.items():
        for cut in range(1, len(piece)):
            left, right = ids.get(piece[:cut]), ids.get(piece[cut:])
            if left is not None and right is not None:
                found[left * n + right] = i
    keys = np.array(sorted(found), dtype=np.int64)
    spelled = [b""] * n
    for piece, i in ids.items():
        spelled[i] = piece.replace(BLANK, " ").encode()
    byte_ids = [0] * 256
    for i in range(n):
        if sp.is_byte(i):
            value = int(sp.id_to_piece(i)[3:5], 16)
            byte_ids[value], spelled[i] = i, bytes([value])
    ends, children = list(range(n)), {}
    for piece, i in ids.items():
        node = ids[piece[0]]
        for c in piece[1:]:
            key = node * n + ids[c]
            if key not in children:
                children[key] = len(ends)
                ends.append(-1)
            node = children[key]
        if len(piece) > 1:
            ends[node] = i
    steps, child = np.full(1 << STEP_BITS, -1, dtype=np.int64), np.zeros(1 << STEP_BITS, dtype=np.int32)
    if 2 * len(children) > len(steps):
        raise ValueError("too many pieces for the table of their beginnings")
    for key, node in children.items():
        slot = (key * MULTIPLIER & WORD) >> (64 - STEP_BITS)
        while steps[slot] >= 0:
            slot = (slot + 1) & (len(steps) - 1)
        steps[slot], child[slot] = key, node
    named = mixed(np.where(first < 0, np.arange(len(first)) + n, first).astype(np.uint64))
    return Pieces(n, first, keys, np.array([found[k] for k in keys.tolist()], dtype=np.int32), rank, byte_ids, spelled, blank, steps, child, np.array(ends, dtype=np.int32), named)


def _limit(dropout: float) -> int:
    return min(WORD, int(dropout * 2.0**64))


def _skipped(key: np.ndarray, start: np.ndarray, middle: np.ndarray, end: np.ndarray, limit: int) -> np.ndarray:
    span = (start.astype(np.uint64) << np.uint64(42)) | (middle.astype(np.uint64) << np.uint64(21)) | end.astype(np.uint64)
    return mixed(key + (span + np.uint64(1)) * np.uint64(SPAN)) < np.uint64(limit)


def agenda(symbols: np.ndarray, key: int, p: Pieces, limit: int) -> list[int]:
    """One chunk by a heap of candidates: (rank, start), each valid while both of its symbols stand."""
    n = len(symbols)
    piece, end, before = symbols.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int, int]] = []
    keys = np.array([key], dtype=np.uint64)

    def offer(left: int, right: int) -> None:
        if left < 0 or right >= n:
            return
        made = int(p.merge(np.array([piece[left]], np.int32), np.array([piece[right]], np.int32))[0])
        if made >= 0 and not (limit and _skipped(keys, np.array([left]), np.array([right]), np.array([end[right]]), limit)[0]):
            heapq.heappush(heap, (int(p.rank[made]), left, right, end[right], made))

    for i in range(n - 1):
        offer(i, i + 1)
    alive = [True] * n
    while heap:
        _, left, right, stop, made = heapq.heappop(heap)
        if not (alive[left] and right < n and alive[right] and end[left] == right and end[right] == stop):
            continue
        piece[left], end[left], alive[right] = made, stop, False
        if stop < n:
            before[stop] = left
            offer(left, stop)
        offer(before[left], left)
    return [piece[i] for i in range(n) if alive[i]]


def spans(symbols: np.ndarray, left: np.ndarray, p: Pieces) -> list[tuple[np.ndarray, np.ndarray]]:
    """For lengths 2, 3 and so on where a run of that many `symbols` is a piece, and which; `left` counts a chunk's symbols from each on."""
    out = []
    at, node = np.arange(len(symbols)), symbols
    size = 2
    while len(at):
        stays = left[at] >= size
        at, node = at[stays], node[stays]
        node = p.follow(node, symbols[at + size - 1])
        stays = node >= 0
        at, node = at[stays], node[stays]
        piece = p.ends[node]
        whole = piece >= 0
        out.append((at[whole], piece[whole]))
        size += 1
    return out


def agendas(symbols: np.ndarray, keys: np.ndarray, p: Pieces, limit: int, names: np.ndarray | None = None) -> list[bytes]:
    """Chunks of equal length (rows of `symbols`) together: each step makes the best candidate merge of every row that has one.

    Two neighbours merge if what they spell together is a piece, so candidates are looked up by their place in the chunk,
    once for all rows of one name. A part stands at the place of its first symbol; `end` has where the next one
    stands, `before` the last one, and `rank` and `made` the merge with the next one.
    """
    n, length = symbols.shape
    which, alike = np.arange(n), symbols
    if names is not None:
        _, first, which = np.unique(names, return_index=True, return_inverse=True)
        alike = symbols[first]
    found = spans(alike.reshape(-1), np.tile(np.arange(length, 0, -1), len(alike)), p)
    # the last column stands for all longer runs, the last rank for no piece
    wide = len(found) + 3
    whole = np.full(alike.size * wide, -1, dtype=np.int32)
    for size, (at, piece) in enumerate(found, 2):
        whole[at * wide + size] = piece
    ranks = np.append(p.rank, NEVER)

    def offered(row, a, b, c):
        made = whole[(which[row] * length + a) * wide + np.minimum(c - a, wide - 1)]
        best = ranks[made]
        if limit:
            hit = np.flatnonzero(made >= 0)
            best[hit[_skipped(keys[row[hit]], a[hit], b[hit], c[hit], limit)]] = NEVER
        return made, best

    ids, stands = symbols.astype(np.int32).reshape(-1), np.ones(n * length, dtype=bool)
    end, before = np.tile(np.arange(1, length + 1), n), np.tile(np.arange(-1, length - 1), n)
    made, rank = np.full(n * length, -1, dtype=np.int32), np.full((n, length), NEVER, dtype=np.int32)
    a = np.tile(np.arange(length - 1), n)
    pairs = offered(np.repeat(np.arange(n), length - 1), a, a + 1, a + 2)
    made.reshape(n, length)[:, :-1], rank[:, :-1] = (x.reshape(n, length - 1) for x in pairs)
    flat, rows = rank.reshape(-1), np.arange(n)
    while len(rows):
        held = rank if len(rows) == n else rank[rows]
        best = held.argmin(axis=1)
        going = np.flatnonzero(held[np.arange(len(rows)), best] < NEVER)
        rows, best = rows[going], best[going]
        at = rows * length + best
        right = rows * length + end[at]
        stop = end[right]
        ids[at], end[at], flat[at], flat[right], stands[right] = made[at], stop, NEVER, NEVER, False
        sel = np.flatnonzero(stop < length)
        row, middle = rows[sel], stop[sel]
        next_at = row * length + middle
        before[next_at] = best[sel]
        made[at[sel]], flat[at[sel]] = offered(row, best[sel], middle, end[next_at])
        left = before[at]
        sel = np.flatnonzero(left >= 0)
        row, left = rows[sel], left[sel]
        left_at = row * length + left
        made[left_at], flat[left_at] = offered(row, left, best[sel], stop[sel])
    data, ends = ids[stands].tobytes(), (4 * np.cumsum(stands.reshape(n, length).sum(axis=1))).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


def possible(symbols: np.ndarray, sizes: np.ndarray, p: Pieces) -> list[bytes]:
    """For chunks of `sizes` symbols, one after another, the terms that `_skipped` adds for every merge that some agenda could offer, as bytes."""
    begins = np.cumsum(sizes) - sizes
    place = np.arange(len(symbols)) - np.repeat(begins, sizes)
    found = spans(symbols, np.repeat(sizes, sizes) - place, p)
    # what merges can make: symbols, and pieces that fall into two such parts
    made = np.zeros((len(found) + 2, len(symbols)), dtype=bool)
    made[1] = True
    starts, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for size, (at, _) in enumerate(found, 2):
        for cut in range(1, size):
            hit = at[made[cut, at] & made[size - cut, at + cut]]
            if len(hit):
                made[size, hit] = True
                a = place[hit]
                starts.append(hit)
                terms.append((((a << 42) | ((a + cut) << 21) | (a + size)).astype(np.uint64) + np.uint64(1)) * np.uint64(SPAN))
    starts, terms = np.concatenate(starts), np.concatenate(terms)
    chunk = np.searchsorted(begins, starts, side="right") - 1
    order = np.argsort(chunk, kind="stable")
    data, ends = terms[order].tobytes(), (8 * np.cumsum(np.bincount(chunk, minlength=len(sizes)))).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


class Encoder:
    """Encodes lists of texts; holds the possible merges of chunks and the segmentations by the merges skipped."""

    def __init__(self, path: str, dropout: float = DROPOUT, seed: int = SEED):
        self.p, self.limit, self.seed = pieces(path), _limit(dropout), seed
        self.kept: dict[int, bytes] = {}
        self.merges: dict[int, bytes] = {}

    def _patterns(self, symbols: np.ndarray, at: np.ndarray, lengths: np.ndarray, hashes: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """A number per occurrence that tells which of its chunk's possible merges it skips; its key where the chunk is long."""
        unique, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        names, size = unique.tolist(), lengths[where]
        short = (size > 1) & (size <= LONGEST)
        if len(self.merges) + len(names) > CACHED:
            self.merges.clear()
        missing = np.array([i for i in np.flatnonzero(short).tolist() if names[i] not in self.merges], dtype=np.int64)
        if len(missing):
            n = size[missing]
            ends = np.cumsum(n)
            rows = symbols[np.arange(int(ends[-1])) + np.repeat(at[where[missing]] - (ends - n), n)]
            self.merges.update(zip((names[i] for i in missing.tolist()), possible(rows, n, self.p)))
        held = [self.merges[k] if s else b"" for k, s in zip(names, short.tolist())]
        flat = np.frombuffer(b"".join(held), dtype=np.uint64)
        count = np.array([len(x) for x in held], dtype=np.int64) // 8
        first = np.cumsum(count) - count
        n = count[back]
        ends = np.cumsum(n)
        terms = flat[np.arange(int(ends[-1])) + np.repeat(first[back] - (ends - n), n)]
        skipped = np.flatnonzero(mixed(np.repeat(keys, n) + terms) < np.uint64(self.limit))
        told = np.concatenate([[np.uint64(0)], np.cumsum(mixed(terms[skipped]), dtype=np.uint64)])
        until = np.searchsorted(skipped, np.concatenate([[0], ends]))
        return np.where(short[back], told[until[1:]] - told[until[:-1]], keys)

    def encode(self, doc_ids: Sequence[int], texts: Sequence[str]) -> list[np.ndarray]:
        p = self.p
        sizes = np.array([len(t) + 1 if t else 0 for t in texts], dtype=np.int64)
        points = np.frombuffer("".join(" " + t for t in texts if t).encode("utf-32-le"), dtype=np.uint32)
        if not len(points):
            return [np.zeros(0, np.int32) for _ in texts]
        symbols = p.first[points]
        blank, odd = symbols == p.blank, symbols < 0
        begins = np.ones(len(symbols), dtype=bool)
        begins[1:] = odd[1:] | odd[:-1] | (blank[1:] & ~blank[:-1])
        doc_ends = np.cumsum(sizes)
        begins[(doc_ends - sizes)[sizes > 0]] = True
        at = np.flatnonzero(begins)
        lengths = np.diff(np.append(at, len(symbols)))
        doc = np.searchsorted(doc_ends, at, side="right")
        first_chunk = np.searchsorted(at, doc_ends - sizes)
        place = np.arange(len(symbols)) - np.repeat(at, lengths)
        powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(int(lengths.max()), np.uint64(MULTIPLIER))]), dtype=np.uint64)
        hashes = np.add.reduceat(p.named[points] * powers[place], at) + lengths.astype(np.uint64)
        keyed = mixed(np.array([-1 if i is None else i for i in doc_ids], dtype=np.int64).astype(np.uint64) + np.uint64(self.seed * MULTIPLIER & WORD))
        occurrence = mixed(keyed[doc] + (np.arange(len(at)) - first_chunk[doc]).astype(np.uint64))
        keys = mixed(hashes + occurrence * np.uint64(SPAN) + np.uint64(self.seed))
        told = self._patterns(symbols, at, lengths, hashes, keys) if self.limit else np.zeros(len(at), np.uint64)
        unique, where, back = np.unique(mixed(hashes + told * np.uint64(SPAN)), return_index=True, return_inverse=True)
        single = lengths[where] == 1
        names = unique.tolist()
        found = [self.kept.get(k) for k in names]
        for i in np.flatnonzero(single).tolist():
            found[i] = self._alone(int(symbols[at[where[i]]]), int(points[at[where[i]]]))
        missing = np.array([i for i, x in enumerate(found) if x is None], dtype=np.int64)
        if len(missing):
            if len(self.kept) + len(missing) > CACHED:
                self.kept.clear()
            size = lengths[where[missing]]
            for length in np.unique(size).tolist():
                group = missing[size == length]
                rows = at[where[group]]
                if length > LONGEST:
                    made = [np.array(agenda(symbols[a : a + length], int(keys[where[i]]), p, self.limit), np.int32).tobytes() for i, a in zip(group.tolist(), rows.tolist())]
                else:
                    made = agendas(symbols[rows[:, None] + np.arange(length)], keys[where[group]], p, self.limit, hashes[where[group]])
                for i, x in zip(group.tolist(), made):
                    found[i] = x
                    if len(self.kept) < CACHED and length <= LONGEST:
                        self.kept[names[i]] = x
        flat = np.frombuffer(b"".join(found), dtype=np.int32)
        counts = np.array([len(x) for x in found], dtype=np.int64) // 4
        begin = np.cumsum(counts) - counts
        n = counts[back]
        ends = np.cumsum(n)
        ids = flat[np.repeat(begin[back] - (ends - n), n) + np.arange(int(ends[-1]))]
        cuts = np.concatenate([[0], ends])[np.searchsorted(at, doc_ends)]
        return np.split(ids, cuts[:-1])

    def _alone(self, symbol: int, point: int) -> bytes:
        """A chunk of one character: its piece, or the ids of its bytes."""
        if symbol >= 0:
            return np.int32(symbol).tobytes()
        return np.array([self.p.byte_ids[b] for b in chr(point).encode()], np.int32).tobytes()


def decode(ids: Sequence[int], path: str) -> str:
    spelled = pieces(path).spelled
    return b"".join(map(spelled.__getitem__, ids)).decode()[1:]


@cache
def _letters(path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bytes of all pieces one after another, where each begins and how many it has."""
    spelled = pieces(path).spelled
    widths = np.array([len(x) for x in spelled], dtype=np.int64)
    return np.frombuffer(b"".join(spelled), dtype=np.uint8), np.cumsum(widths) - widths, widths


def lossless(ids: Sequence[np.ndarray], texts: Sequence[str], path: str) -> list[bool]:
    """Whether decoding gives each text back, all at once: the bytes of the ids are those of a blank and the text."""
    letters, begins, widths = _letters(path)
    joined = np.concatenate(ids)
    n = widths[joined]
    ends = np.concatenate([[0], np.cumsum(n)])
    data = letters[np.arange(int(ends[-1])) + np.repeat(begins[joined] - ends[:-1], n)].tobytes()
    cuts = ends[np.concatenate([[0], np.cumsum([len(x) for x in ids])])].tolist()
    return [data[a:b] == (" " + t if t else "").encode() for a, b, t in zip(cuts, cuts[1:], texts)]


@cache
def _encoder(path: str, dropout: float, seed: int) -> Encoder:
    """One per worker and setting, so that a worker's tasks share the cache."""
    return Encoder(path, dropout, seed)


def stretches(texts: Sequence[str | None]) -> Iterator[tuple[int, int]]:
    """Row ranges of about STRETCH characters, a row at least."""
    lo, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text or "")
        if size >= STRETCH:
            yield lo, i + 1
            lo, size = i + 1, 0
    if lo < len(texts):
        yield lo, len(texts)


def encoded(docs: DataFrame, dropout: float = DROPOUT, seed: int = SEED, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids, and lossless: whether decoding the ids gives the text back."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(path, dropout, seed)
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for lo, hi in stretches(texts):
                ids = encoder.encode(doc_ids[lo:hi], texts[lo:hi])
                same = lossless(ids, texts[lo:hi], path)
                sizes = [len(x) for x in ids]
                lists = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), np.concatenate(ids))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_ids[lo:hi], pa.int64()), pa.array(sizes, pa.int64()), lists, pa.array(same)], ["doc_id", "n_tokens", "ids", "lossless"]
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_tokens long, ids array<int>, lossless boolean")


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and text from doc_id and ids."""
    path = path or model_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode(x or [], path) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(run, "doc_id long, text string")
