"""Token-id output: an adaptive context-mixing range coder in independently reset, checksummed blocks.

A block holds up to BLOCK_IDS ids below 65,536. Three orders predict each id. Order 0 is the adaptive share of
every id of the block's alphabet, whose unseen ids have a prior that falls with the id. Order 1 names the two ids
that followed the previous id, order 2 the one that followed the previous two, each with a streak. The predictions are
mixed into one distribution by weights that are learned while coding: a set of weights for each combination
of streaks, moved towards the part that each predictor had in the id that came. An id is one step of a
carry-less range coder. Model and coder start anew in each block, so blocks can be read alone and in any order;
a block's head has its id count, its payload's length, the CRC-32 of its ids and the size of its alphabet.

Coding is one id after another, so within a job it is done by the Java functions of IdCoder.java (see
jvm_functions.py), as is the cutting of texts into ids. The same model and coder stand here in Python for reading and
writing files without Spark; there all blocks of a batch advance together, one id per step, as numpy lanes. Both
write the same bytes. Only integers are used, so a reader on another machine follows exactly.

Files: documents are sorted by id into range partitions; a page holds whole documents, their ids (null
marked) and lengths, and the blocks of their ids. Pages are the rows of Parquet files, so that any store
Spark writes to will do, and a lost task leaves nothing behind.

Defined results: null text is empty and holds only the end id. Rows that repeat a doc_id are written one
after another, ordered by text; a null doc_id comes first. An empty table gives no rows.
"""

from __future__ import annotations

import json
import os
import struct
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import cache
from pathlib import Path
from zlib import compress, crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from yieldloom.llm import jvm_functions
from yieldloom.operators.ranking import prefix_sums
from yieldloom.sources.workspace import new_folder

BLOCK_IDS = 60_000
LANES = 160
# A page ends with the document that reaches this, so that most pages are one block.
PAGE_IDS = 56_000
END_ID = 2
MAGIC = b"IDCM2\0"
CACHED_WORDS = 600_000
# Pages on their way from Python to the coder at a time.
PAGES = 16

_IDS = 1 << 16
_SLOTS = 1 << 16  # of order 2, per lane
_TABLE_BITS = 22  # order 0's shares add up to this power of two
_MIX_BITS = 10  # and so do the weights when they are applied
_FULL = 1 << 16  # the weights when they are learned
_MOST = 64_500  # of them for orders 1 and 2 together
_STREAK = 4
_SETS = 2 * (_STREAK + 1) ** 2
_REFRESH = 1024
_PRIOR = (1 << 26) // (np.arange(_IDS) + 200)
_PRIOR_SUMS = np.cumsum(_PRIOR)
# By streak, and 8 more for a guess that held: the next streak, and whether order 1 keeps its first guess.
_NEXT2 = np.array([1] * 8 + [min(s + 1, _STREAK) for s in range(8)])
_NEXT1 = np.array([s - 1 if s > 1 else 1 for s in range(8)] + [min(s + 1, _STREAK) for s in range(8)])
_STAYS = np.arange(16) > 1
_HEAD = struct.Struct("<IIII")
_TOP, _BOTTOM = np.uint64(1 << 48), np.uint64(1 << 32)
_U16, _U32, _U48 = np.uint64(16), np.uint64(32), np.uint64(48)


class Model:
    """The predictions of all lanes; `plan` prepares the mix for the next id, `learn` takes the id in.

    Order 0 is summed up anew every _REFRESH ids, sooner at first. An id's mixed share is its order-0 share times
    that order's weight, plus the weights of the guesses that name it; the ids stay in their own order.
    """

    def __init__(self, limits: np.ndarray):
        lanes, wide = len(limits), int(limits.max(initial=1))
        self.limits, self.t, self.due = limits, 0, 0
        self.counts = np.zeros(lanes * wide, dtype=np.uint16)
        self.seen = np.zeros(lanes, np.int64)
        # a lane's sums go on from the lane before, so that one search serves all; beyond an alphabet's end stands the next lane's begin
        self.base = np.arange(lanes, dtype=np.int32) << _TABLE_BITS
        self.sums = np.empty((lanes, _IDS + 1), dtype=np.int32)
        self.sums[:] = (self.base + (1 << _TABLE_BITS))[:, None]
        self.flat = self.sums.reshape(-1)
        # order 1: second guess, first guess and streak in one number; order 2: guess and streak
        self.one, self.two = np.zeros(lanes * wide, np.int64), np.zeros(lanes * _SLOTS, np.int32)
        self.weights = np.repeat(np.array([_FULL * 3 // 10, _FULL * 2 // 10, _FULL // 20], dtype=np.int64), lanes * _SETS)
        self.parts = np.arange(3)[:, None] * (lanes * _SETS)
        self.last, self.before = np.zeros(lanes, np.int64), np.zeros(lanes, np.int64)
        self.wide = wide
        self._place(np.arange(lanes))
        self.at1 = self.cell

    def _place(self, lane: np.ndarray) -> None:
        self.lane, self.row, self.slot, self.cell, self.set = lane, lane * (_IDS + 1), lane * _SLOTS, lane * self.wide, lane * _SETS

    def shrink(self, n: int) -> None:
        """Lanes are sorted by length; the shorter ones end first."""
        self._place(self.lane[:n])
        self.seen, self.last, self.before, self.at1, self.base = self.seen[:n], self.last[:n], self.before[:n], self.at1[:n], self.base[:n]

    def _refresh(self) -> None:
        """Order-0 shares from the counts: one for each id, the rest by count; new ids share by the prior what is kept for them."""
        for lane in self.lane.tolist():
            limit = int(self.limits[lane])
            room = (1 << _TABLE_BITS) - limit
            each = room // (self.t + 8 + int(self.seen[lane]) * 5 // 8)
            kept = room - self.t * each
            share = self.counts[lane * self.wide : lane * self.wide + limit].astype(np.int64)
            share *= each
            share += 1 + _PRIOR[:limit] * kept // int(_PRIOR_SUMS[limit - 1])
            share[0] += self.base[lane]
            self.sums[lane, 0] = self.base[lane]
            np.cumsum(share, out=self.sums[lane, 1 : limit + 1])
        self.due = max(32, min(2 * self.t, self.t + _REFRESH))

    def plan(self) -> None:
        if self.t == self.due:
            self._refresh()
        self.at2 = self.slot + ((self.before * 40503 + self.last * 30011) >> 3 & (_SLOTS - 1))
        two, one = self.two.take(self.at2), self.one.take(self.at1)
        self.sure2, self.sure1 = two & 7, one & 7
        self.ids = ids = np.empty((3, len(two)), np.int64)
        np.right_shift(two, 3, out=ids[0])
        np.right_shift(one, 3, out=ids[1])
        ids[1] &= _IDS - 1
        np.right_shift(one, 19, out=ids[2])
        chosen = (self.sure2 * (_STREAK + 1) + self.sure1) * 2
        chosen += ids[0] == ids[1]
        chosen += self.set
        self.chosen = self.parts + chosen
        self.weight = self.weights.take(self.chosen)
        self.shares = self.weight >> (16 - _MIX_BITS)
        self.zero = (1 << _MIX_BITS) - np.add.reduce(self.shares, axis=0)

    def interval(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = self.row + ids
        low = self.flat.take(at)
        self.hit = self.ids == ids
        self.named = (self.shares * self.hit) << _TABLE_BITS
        self.freq = self.zero * (self.flat.take(at + 1) - low) + np.add.reduce(self.named, axis=0)
        return self.zero * (low - self.base) + (np.add.reduce(self.shares * (self.ids < ids), axis=0) << _TABLE_BITS), self.freq

    def find(self, value: np.ndarray) -> np.ndarray:
        """The id whose interval holds `value`."""
        guesses = np.sort((self.ids << _MIX_BITS) | self.shares, axis=0)
        ids, share = guesses >> _MIX_BITS, (guesses & ((1 << _MIX_BITS) - 1)) << _TABLE_BITS
        at, end = self.row + ids, np.add.accumulate(share, axis=0)
        begin = end - share
        begin += self.zero * (self.flat.take(at) - self.base)
        at += 1
        end += self.zero * (self.flat.take(at) - self.base)
        over = value >= end
        found = np.maximum.reduce(np.where((value >= begin) & ~over, ids, -1), axis=0)
        others = (found < 0).nonzero()[0]
        if len(others):
            rest = (value - np.add.reduce(share * over, axis=0)).take(others) // self.zero.take(others)
            key = np.minimum(rest, (1 << _TABLE_BITS) - 1).astype(np.int32) + self.base.take(others)
            at = self.flat.searchsorted(key, side="right") - 1
            found[others] = np.minimum(at - self.row.take(others), self.limits.take(others) - 1)
        return found

    def learn(self, ids: np.ndarray) -> None:
        """To be called after `interval` of the same ids."""
        weight = (self.named << 16).view(np.uint64) // self.freq.view(np.uint64)
        weight = weight.view(np.int64) - self.weight
        weight >>= 5
        weight += self.weight
        np.maximum(weight, 32, out=weight)
        total = np.add.reduce(weight, axis=0)
        if np.maximum.reduce(total) > _MOST:
            weight = np.where(total > _MOST, weight * _MOST // total, weight)
        self.weights[self.chosen] = weight
        hit2, hit1, _ = self.hit
        self.two[self.at2] = (ids << 3) | _NEXT2.take(self.sure2 + (hit2 << 3))
        state = self.sure1 + (hit1 << 3)
        stays, named = _STAYS.take(state), self.ids[1]
        other = np.where(hit1, self.ids[2], np.where(stays, ids, named))
        self.one[self.at1] = (other << 19) | (np.where(stays, named, ids) << 3) | _NEXT1.take(state)
        self.at1 = self.cell + ids
        n = self.counts.take(self.at1)
        self.seen = self.seen + (n == 0)
        n += 1
        self.counts[self.at1] = n
        self.before, self.last, self.t = self.last, ids, self.t + 1


def encode_blocks(blocks: Sequence[np.ndarray]) -> list[bytes]:
    """Each block of ids as head and payload."""
    order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
    out: list[bytes] = [b""] * len(blocks)
    for lo in range(0, len(order), LANES):
        lanes = order[lo : lo + LANES]
        sizes = np.array([len(blocks[i]) for i in lanes])
        grid = np.zeros((int(sizes[0]), len(lanes)), dtype=np.uint16)
        for k, i in enumerate(lanes):
            grid[: sizes[k], k] = blocks[i]
        n = len(lanes)
        low, size = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, dtype=np.uint64)
        words = np.zeros((n, 2 * len(grid) + 8), dtype=np.uint16)
        begins = np.arange(n) * words.shape[1]
        filled = begins.copy()
        limits = np.array([int(np.max(blocks[i], initial=0)) + 1 for i in lanes])
        model = Model(limits)
        for t, live in enumerate(np.searchsorted(-sizes, -np.arange(len(grid)), side="left").tolist()):
            if live < len(model.lane):
                model.shrink(live)
            ids = grid[t, :live].astype(np.int64)
            model.plan()
            cum, freq = model.interval(ids)
            step = size[:live] >> _U32
            low[:live] += step * cum.view(np.uint64)
            np.multiply(step, freq.view(np.uint64), out=size[:live])
            _shift_out(low, size, words.reshape(-1), filled, live)
            model.learn(ids)
        for k, i in enumerate(lanes):
            at = int(filled[k] - begins[k])
            for part in range(4):
                words[k, at + part] = (int(low[k]) >> (48 - 16 * part)) & 0xFFFF
            payload = words[k, : at + 4].astype("<u2").tobytes()
            out[i] = _HEAD.pack(sizes[k], len(payload), _crc(blocks[i]), limits[k]) + payload
    return out


def _crc(ids: np.ndarray) -> int:
    return crc32(np.asarray(ids).astype("<u4").tobytes())


def _small(low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes that have a word to move, and which of the lanes have one that is settled."""
    settled_top = (low ^ (low + size)) < _TOP
    return (settled_top | (size < _BOTTOM)).nonzero()[0], settled_top


def _moved(low: np.ndarray, size: np.ndarray, at: np.ndarray, settled_top: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Moves the lanes `at` by a word; returns their lows before, and what `_small` says of them after."""
    a = low.take(at)
    s = np.where(settled_top, size.take(at), (np.uint64(0) - a) & (_BOTTOM - np.uint64(1))) << _U16
    b = a << _U16
    low[at], size[at] = b, s
    again, settled_top = _small(b, s)
    return a, at.take(again), settled_top.take(again)


def _shift_out(low, size, words, filled, live: int) -> None:
    at, settled_top = _small(low[:live], size[:live])
    settled_top = settled_top.take(at)
    while len(at):
        put = filled.take(at)
        filled[at] = put + 1
        a, at, settled_top = _moved(low, size, at, settled_top)
        words[put] = a >> _U48


def decode_blocks(blocks: Sequence[bytes]) -> list[np.ndarray]:
    """The ids of each block; raises where a checksum does not hold."""
    heads = [_HEAD.unpack_from(b) for b in blocks]
    if any(not 0 < h[3] <= _IDS for h in heads):
        raise ValueError("not a block of ids")
    order = sorted(range(len(blocks)), key=lambda i: -heads[i][0])
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(blocks)
    for lo in range(0, len(order), LANES):
        lanes = order[lo : lo + LANES]
        sizes = np.array([heads[i][0] for i in lanes])
        n = len(lanes)
        words = np.zeros((n, max(heads[i][1] for i in lanes) // 2 + 8), dtype=np.uint16)
        for k, i in enumerate(lanes):
            payload = np.frombuffer(blocks[i], dtype="<u2", offset=_HEAD.size)
            words[k, : len(payload)] = payload
        low, size = np.zeros(n, np.uint64), np.full(n, 2**64 - 1, dtype=np.uint64)
        first = words[:, :4].astype(np.uint64)
        code = (first[:, 0] << _U48) | (first[:, 1] << _U32) | (first[:, 2] << _U16) | first[:, 3]
        flat_words, read = words.reshape(-1), np.arange(n) * words.shape[1] + 4
        ends = read + words.shape[1] - 5
        grid = np.zeros((int(sizes[0]), n), dtype=np.uint16)
        model = Model(np.array([heads[i][3] for i in lanes]))
        for t, live in enumerate(np.searchsorted(-sizes, -np.arange(len(grid)), side="left").tolist()):
            if live < len(model.lane):
                model.shrink(live)
            model.plan()
            step = size[:live] >> _U32
            value = np.minimum((code[:live] - low[:live]) // step, np.uint64(2**32 - 1)).view(np.int64)
            ids = model.find(value)
            cum, freq = model.interval(ids)
            low[:live] += step * cum.view(np.uint64)
            np.multiply(step, freq.view(np.uint64), out=size[:live])
            at, settled_top = _small(low[:live], size[:live])
            settled_top = settled_top.take(at)
            while len(at):
                put = read.take(at)
                code[at] = (code.take(at) << _U16) | flat_words.take(np.minimum(put, ends.take(at)))
                read[at] = put + 1
                _, at, settled_top = _moved(low, size, at, settled_top)
            grid[t, :live] = ids
            model.learn(ids)
        for k, i in enumerate(lanes):
            ids = grid[: sizes[k], k]
            if _crc(ids) != heads[i][2]:
                raise ValueError("a block's checksum does not hold")
            out[i] = ids
    return out


def plain_blocks(blocks: Sequence[np.ndarray]) -> list[bytes]:
    """Each block's ids as they are, behind a head with their number, for the coder in Java."""
    return [_HEAD.pack(len(b), 2 * len(b), 0, 0) + b.astype("<u2").tobytes() for b in blocks]


def packed_pages(pages: list[tuple[list, list[np.ndarray]]], code: Callable[[Sequence[np.ndarray]], list[bytes]] = encode_blocks) -> list[bytes]:
    """Pages of (doc ids, their token ids) as bytes; the blocks of all pages are coded together."""
    cut = []
    for _, texts in pages:
        ids = np.concatenate(texts)
        cut.append([ids[a : a + BLOCK_IDS] for a in range(0, len(ids), BLOCK_IDS)])
    coded = iter(code([b for blocks in cut for b in blocks]))
    out = []
    for (doc_ids, texts), blocks in zip(pages, cut):
        head = MAGIC + struct.pack("<II", len(doc_ids), len(blocks))
        known = np.array([d is not None for d in doc_ids], dtype=np.uint8)
        table = np.array([0 if d is None else d for d in doc_ids], dtype="<i8")
        lengths = np.array([len(t) for t in texts], dtype="<u4")
        out.append(head + known.tobytes() + table.tobytes() + lengths.tobytes() + b"".join(next(coded) for _ in blocks))
    return out


def unpacked_pages(pages: Sequence[bytes]) -> list[tuple[list, list[np.ndarray]]]:
    heads, blocks = [], []
    for page in pages:
        if page[: len(MAGIC)] != MAGIC:
            raise ValueError("not a page of ids")
        at = len(MAGIC)
        n, n_blocks = struct.unpack_from("<II", page, at)
        at += 8
        known = np.frombuffer(page, np.uint8, n, at)
        table = np.frombuffer(page, "<i8", n, at + n)
        lengths = np.frombuffer(page, "<u4", n, at + 9 * n)
        at += 13 * n
        for _ in range(n_blocks):
            size = _HEAD.size + _HEAD.unpack_from(page, at)[1]
            blocks.append(page[at : at + size])
            at += size
        heads.append(([int(d) if k else None for d, k in zip(table, known)], lengths, n_blocks))
    ids = iter(decode_blocks(blocks))
    out = []
    for doc_ids, lengths, n_blocks in heads:
        joined = np.concatenate([next(ids) for _ in range(n_blocks)])
        out.append((doc_ids, np.split(joined, np.cumsum(lengths)[:-1])))
    return out


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """Ids of texts by ids of their words, which this tokenizer encodes one by one; frequent words are kept."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kept: dict[bytes, bytes] = {}

    def encode(self, texts: Sequence[str | None], end_id: int = END_ID) -> list[np.ndarray]:
        end = np.array([end_id], dtype="<u2").tobytes()
        words = [(t or "").encode().split() for t in texts]
        new = [w for w in set().union(*words) if w not in self.kept]
        if len(self.kept) + len(new) > CACHED_WORDS:
            self.kept.clear()
            new = list(set().union(*words))
        coded = self.tokenizer.encode_batch_fast([w.decode() for w in new], add_special_tokens=False)
        for w, c in zip(new, coded):
            self.kept[w] = np.array(c.ids, dtype="<u2").tobytes()
        get = self.kept.__getitem__
        return [np.frombuffer(b"".join(map(get, ws)) + end, dtype="<u2") for ws in words]


@cache
def _word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


#: The only kind of tokenizer that the Java function knows; others are left to their library.
_KNOWN = {
    **dict.fromkeys(("truncation", "padding", "post_processor")),
    "added_tokens": ["<|endoftext|>", "<|startoftext|>"],
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "model": {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False},
}
_POINTS = 0x20000


def _composing() -> set[str]:
    """Characters that may join the one before them into a third."""
    found = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for c in map(chr, range(0x110000)):
        parts = unicodedata.decomposition(c).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(chr(int(parts[1], 16)))
    return found


def _code_points(tokenizer) -> np.ndarray:
    """For each code point what the tokenizer makes of it, as IdCoder.Tables says: the top bit where it is simple, its
    combining class, whether it is a blank, letter, number or another sign (0 to 3), and what it becomes.

    A code point is simple if a text of simple ones in the order of their combining classes is its own NFC, and if it becomes one other.
    """
    composing, simple = _composing(), {}
    for c in map(chr, range(_POINTS)):
        if unicodedata.category(c) not in ("Cn", "Cs") and c not in composing and unicodedata.is_normalized("NFC", c):
            became = tokenizer.normalizer.normalize_str(c)
            if len(became) == 1:
                simple[c] = became
    kinds = {c: 0 for c in simple.values()}
    several = sorted(kinds)
    for lo in range(0, len(several), 4096):
        # a letter joins the a before it, a sign the ! behind it, a number neither, and a blank belongs to no part
        part = several[lo : lo + 4096]
        for _, (begin, end) in tokenizer.pre_tokenizer.pre_tokenize_str("".join(f" a{c}! " for c in part)):
            for k in range(begin // 5, (end - 1) // 5 + 1):
                at = 5 * k + 2
                if begin <= at < end:
                    kinds[part[k]] = 1 if begin < at else 3 if end > at + 1 else 2
    held = np.zeros(_POINTS, np.uint32)
    for c, became in simple.items():
        held[ord(c)] = 1 << 31 | unicodedata.combining(c) << 23 | kinds[became] << 21 | ord(became)
    return held


def _byte_signs() -> list[str]:
    """The signs that the tokenizer's vocabulary has for bytes."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


@cache
def tokenizer_tables(path: str) -> bytes | None:
    """The tokenizer for IdCoder.WordIds; None if it is of another kind."""
    spec = json.loads(Path(path).read_text(encoding="utf-8"))
    model = spec["model"]
    vocab, merges = model.pop("vocab", {}), [m.split(" ") if isinstance(m, str) else m for m in model.pop("merges", [])]
    spec["added_tokens"] = sorted(t["content"] for t in spec.get("added_tokens", ()))
    spelled = [s + end for end in ("", "</w>") for s in _byte_signs()]
    if any(spec.get(k) != v for k, v in _KNOWN.items()) or max(vocab.values()) >= _IDS or any(s not in vocab for s in spelled) or len({*map(tuple, merges)}) < len(merges):
        return None
    from tokenizers import Tokenizer

    points = _code_points(Tokenizer.from_file(path))
    joined = [i for a, b in merges for i in (vocab[a], vocab[b], vocab[a + b])]
    return compress(b"".join([struct.pack(">I", len(points)), points.astype(">u4").tobytes(), np.array([vocab[s] for s in spelled], ">u2").tobytes(), struct.pack(">I", len(merges)), np.array(joined, ">u2").tobytes()]))


_DOCUMENTS = T.ArrayType(T.StructType([T.StructField(c, T.LongType()) for c in ("doc_id", "at", "n_tokens", "ids_crc32")]))


def _functions(spark: SparkSession, path: str | None = None) -> dict[str, str]:
    tables = tokenizer_tables(path) if path else None
    known = {"tokenizer.bin": tables} if tables else {}
    returns = {"Coded": T.BinaryType(), "Documents": _DOCUMENTS} | ({"WordIds": T.BinaryType()} if tables else {})
    return jvm_functions.registered(spark, Path(__file__).with_name("IdCoder.java"), known, returns)


def word_ids(spark: SparkSession, path: str, text: str = "text"):
    """A column of the ids of texts behind a 0, or behind a 1 the texts that are left to the tokenizer's library."""
    functions = _functions(spark, path)
    if "WordIds" in functions:
        return F.call_function(functions["WordIds"], F.col(text).cast("binary"))
    return F.concat(F.lit(bytearray(b"\1")), F.coalesce(F.col(text), F.lit("")).cast("binary"))


def written(docs: DataFrame, path: str | None = None, end_id: int = END_ID) -> str:
    """Writes the ids of all texts, in doc_id order, and returns the folder: rows (part, page, n_ids, ids)."""
    path = path or tokenizer_path()
    spark = docs.sparkSession
    # the number of ranges is left to AQE
    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    # the bounds are sampled from ids alone; texts order only the rows of one id, which share a partition
    ordered = ordered.sortWithinPartitions("doc_id", "text").select(F.spark_partition_id().alias("part"), "doc_id", word_ids(spark, path).alias("words"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages, doc_ids, texts, size, number, part = [], [], [], 0, 0, 0
        end = np.array([end_id], dtype="<u2").tobytes()

        def flush() -> pa.RecordBatch:
            nonlocal pages, number
            sizes = [sum(map(len, t)) for _, t in pages]
            numbers = range(number, number + len(pages))
            number += len(pages)
            batch = pa.RecordBatch.from_arrays(
                [pa.array([part] * len(pages), pa.int32()), pa.array(numbers, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed_pages(pages, plain_blocks), pa.binary())], ["part", "page", "n_ids", "ids"]
            )
            pages = []
            return batch

        for batch in batches:
            rows, step = batch.num_rows, 500
            for lo in range(0, rows, step):
                piece = batch.slice(lo, step)
                part = piece.column(0)[0].as_py()
                coded = piece.column(2).to_pylist()
                left = [w[1:].decode() for w in coded if w[0]]
                others = iter(_word_encoder(path).encode(left, end_id) if left else ())
                for doc_id, words in zip(piece.column(1).to_pylist(), coded):
                    ids = next(others) if words[0] else np.frombuffer(words[1:] + end, dtype="<u2")
                    doc_ids.append(doc_id)
                    texts.append(ids)
                    size += len(ids)
                    if size >= PAGE_IDS:
                        pages.append((doc_ids, texts))
                        doc_ids, texts, size = [], [], 0
                    if len(pages) >= PAGES:
                        yield flush()
        if doc_ids:
            pages.append((doc_ids, texts))
        if pages:
            yield flush()

    plain = ordered.mapInArrow(run, "part int, page long, n_ids long, ids binary")
    folder = new_folder(spark, "token-ids")
    plain.withColumn("ids", F.call_function(_functions(spark, path)["Coded"], "ids")).write.option("compression", "none").parquet(folder)
    return folder


def read_back(spark, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document in the files, start counting all ids before it."""
    files = spark.read.parquet(folder)
    key = (F.shiftleft(F.col("part").cast("long"), 40) + F.col("page")).alias("key")
    found = files.select(key, F.inline(F.call_function(_functions(spark)["Documents"], "ids")))
    starts = prefix_sums(files.select(key, "n_ids"), [], "key", ["n_ids"]).select("key", F.col("n_ids_before").alias("before"))
    return found.join(starts, "key").select("doc_id", (F.col("before") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def encoded_ids(docs: DataFrame, path: str | None = None) -> DataFrame:
    return read_back(docs.sparkSession, written(docs, path))
