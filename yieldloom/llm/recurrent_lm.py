"""LM scoring: a gated recurrent network with class-factored output, trained in numpy, run over whole documents.

Words are counted over all training documents. The `OUTPUTS` - 1 most frequent ones, the end of a text among
them, are the network's words; every other word is its last output, <rare>, and then has the add-one
share of its count among rare words, so that the probabilities of all texts add up. The output is
factored: first the class of a word (words of near frequency share one), then the word within it.

Training is by backpropagation through windows of `STEPS` tokens, in two stages. One task fits where training
begins on a bounded number of documents. Then every task that reads training documents goes on from there over
every window of every text, and the tasks' weights are averaged by the number of windows. A window begins with
the state that `WARM` tokens before it leave. In scoring the state is carried from window to window from the
first token to the end.

Two lexica go to the tasks: the network's words, and at most `LEXICON` frequent words with their counts. The
words beyond are joined with the table of counts by shuffle, once per document and word.

Defined results: null text is empty and is one token, the end. Training documents are those whose crc32 of
the id as text, modulo 7, is not 2; a null id trains. Without training documents nothing is known and score
equals base_score. Repeated rows are scored one by one. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import pairwise, repeat
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from yieldloom.sources.workspace import new_folder, settled

OUTPUTS = 4096
CLASSES = 64
HIDDEN = 16
STEPS = 32
WARM = 16
BATCH = 256
RATE = 0.01
SAMPLE_DOCUMENTS = 1500
LEXICON = 200_000
# Steps of a text that are looked up at once while scoring, and states that meet the output layer together.
SCORE_STEPS = 16
SCORE_ROWS = 8192
# States that meet the classes together, and texts that are scored side by side.
CLASS_ROWS = 1024
SCORE_TEXTS = 512
# Texts that are cut into words together.
SPLIT_TEXTS = 1000
CHUNK = 4096
END = ""  # no word is empty
IN_CLASS = OUTPUTS // CLASSES


def tokens(text: str | None) -> list[bytes]:
    """Words with A-Z in lower case: bytes know no other white space and no other capitals."""
    return (text or "").encode().lower().split()


def token_lists(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """`tokens` of all texts, one after another in one array, and where each text's begin in it, the end included."""
    words, ends, n = [], [np.zeros(1, np.int64)], 0
    for lo in range(0, len(texts), SPLIT_TEXTS):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.slice(lo, SPLIT_TEXTS), "")))
        flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        # white space at a text's ends leaves an empty word there
        full = pc.greater(pc.binary_length(flat), 0)
        if (kept := full.to_numpy(zero_copy_only=False)).all():
            offsets -= offsets[0]
        else:
            flat, offsets = flat.filter(full), np.concatenate([[0], np.cumsum(kept)])[offsets - offsets[0]]
        words.append(flat)
        ends.append(offsets[1:] + n)
        n += len(flat)
    return pa.chunked_array(words, texts.type), np.concatenate(ends)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)); `x` is overwritten."""
    x *= 0.5
    np.tanh(x, out=x)
    x += 1
    x *= 0.5
    return x


SHAPES = {
    "embed": (OUTPUTS, HIDDEN),
    "into": (HIDDEN, 3 * HIDDEN),
    "back": (HIDDEN, 3 * HIDDEN),
    "shift": (3 * HIDDEN,),
    "to_class": (HIDDEN, CLASSES),
    "class_shift": (CLASSES,),
    "to_word": (CLASSES, HIDDEN, IN_CLASS),
    "word_shift": (CLASSES, IN_CLASS),
}
SIZE = sum(int(np.prod(s)) for s in SHAPES.values())


def unpacked(flat: np.ndarray) -> dict[str, np.ndarray]:
    """Views of one flat array of weights."""
    out, at = {}, 0
    for name, shape in SHAPES.items():
        n = int(np.prod(shape))
        out[name], at = flat[at : at + n].reshape(shape), at + n
    return out


def initial(shares: np.ndarray) -> np.ndarray:
    """Small random weights; the output starts at the words' shares."""
    flat = np.random.default_rng(3).normal(0, 0.15, SIZE).astype(np.float32)
    w = unpacked(flat)
    for name in ("shift", "class_shift", "word_shift"):
        w[name][:] = 0
    for name in ("to_class", "to_word"):
        w[name] *= 0.3
    by_class = np.maximum(shares, 1e-9).reshape(CLASSES, IN_CLASS)
    w["class_shift"][:] = np.log(by_class.sum(axis=1))
    w["word_shift"][:] = np.log(by_class)
    return flat


def step(w: dict, x: np.ndarray, h: np.ndarray):
    """New state from the input's share of the gates `x` and the state; also what backpropagation needs.

    Rows are texts. Arrays whose columns lie together (the transposed views that `gradient` and `score_texts` pass)
    give such arrays and are quicker, as each gate is then one stretch of memory.
    """
    b = (w["back"].T @ h.T).T
    gates = _sigmoid(x[:, : 2 * HIDDEN] + b[:, : 2 * HIDDEN])
    z, r = gates[:, :HIDDEN], gates[:, HIDDEN:]
    c = r * b[:, 2 * HIDDEN :]
    c += x[:, 2 * HIDDEN :]
    np.tanh(c, out=c)
    new = h - c
    new *= z
    new += c
    return new, (z, r, c, b[:, 2 * HIDDEN :])


def _exponents(x: np.ndarray, axis: int, reach: float) -> np.ndarray | float:
    """`x` becomes its exponents, less the greatest along `axis` if `reach`, which no size in `x` exceeds, is too large for them; returns what was taken off."""
    most: np.ndarray | float = 0.0
    if reach > 60:
        most = x.max(axis=axis, keepdims=True)
        x -= most
        most = most.reshape(-1)
    np.exp(x, out=x)
    return most


def _with_shift(weights: np.ndarray, shift: np.ndarray) -> tuple[np.ndarray, float]:
    """The output weights with the shift as their last row, for states that end with a 1, and what no output exceeds in size: states are between -1 and 1."""
    joined = np.concatenate([weights, shift[..., None, :]], axis=-2)
    return joined, float(np.abs(joined).sum(axis=-2).max())


def by_class(targets: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Row numbers ordered by the targets' classes, and (class, first, end) of each among them; the class of <rare> has other words too."""
    # small numbers are sorted by radix
    classes = (targets // IN_CLASS).astype(np.uint8)
    order = np.argsort(classes, kind="stable")
    cuts = np.searchsorted(classes[order], np.arange(CLASSES + 1)).tolist()
    return order, [(c, cuts[c], cuts[c + 1]) for c in range(CLASSES) if cuts[c + 1] > cuts[c]]


def log_chances(w: dict, h: np.ndarray, targets: np.ndarray) -> np.ndarray:
    """Natural log probability of each target after each state."""
    to_class, class_reach = _with_shift(w["to_class"], w["class_shift"])
    to_word, word_reach = _with_shift(w["to_word"], w["word_shift"])
    out = np.empty(len(targets), dtype=np.result_type(h, to_word))
    ones = np.ones(IN_CLASS, out.dtype)
    # rows in lots that stay near the processor
    for lo in range(0, len(targets), SCORE_ROWS):
        wanted, part = targets[lo : lo + SCORE_ROWS], out[lo : lo + SCORE_ROWS]
        rows, states = np.arange(len(wanted)), np.ones((HIDDEN + 1, len(wanted)), out.dtype)
        states[:HIDDEN] = h[lo : lo + SCORE_ROWS].T
        for a in range(0, len(wanted), CLASS_ROWS):
            x = to_class.T @ states[:, a : a + CLASS_ROWS]
            own = x[wanted[a : a + CLASS_ROWS] // IN_CLASS, rows[: x.shape[1]]]
            own -= _exponents(x, 0, class_reach)
            part[a : a + CLASS_ROWS] = own - np.log(x.sum(axis=0))
        order, classes = by_class(wanted)
        states, at = np.ascontiguousarray(states.T)[order], wanted[order] % IN_CLASS
        own, total = np.empty_like(part), np.empty_like(part)
        for c, first, end in classes:
            x = states[first:end] @ to_word[c]
            own[first:end] = x[rows[: end - first], at[first:end]]
            own[first:end] -= _exponents(x, 1, word_reach)
            np.matmul(x, ones, out=total[first:end])
        own -= np.log(total)
        part[order] += own
    return out


def gradient(flat: np.ndarray, inputs: np.ndarray, targets: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """Gradient of the mean loss over windows (rows) of STEPS tokens after WARM tokens that only move the state."""
    w, grad = unpacked(flat), np.zeros_like(flat)
    g = unpacked(grad)
    kind, n, steps = flat.dtype, len(inputs), inputs.shape[1] - WARM
    # each step has a stretch of its own, windows side by side, which stays near the processor
    all_h, kept = np.ones((steps + 1, HIDDEN + 1, n), kind), []
    table = w["embed"] @ w["into"] + w["shift"]
    h = np.zeros((HIDDEN, n), kind)
    for t in range(inputs.shape[1]):
        after, parts = step(w, np.ascontiguousarray(table.take(inputs[:, t], axis=0).T).T, h.T)
        if t < WARM:
            # tokens before a text's start do not move the state
            h = np.where(weight[:, t] > 0, after.T, h)
        else:
            all_h[t - WARM, :HIDDEN] = h
            h = after.T
            kept.append(parts)
    all_h[steps, :HIDDEN] = h
    all_t, all_w = targets[:, WARM:].T, weight[:, WARM:].T
    all_w = (all_w / max(all_w.sum(), 1)).astype(np.float32)
    loss, dh, rows = 0.0, np.empty((steps, HIDDEN, n), kind), np.arange(n)
    to_class, reach = _with_shift(w["to_class"], w["class_shift"])
    by_class_row = np.zeros_like(to_class)
    for t in range(steps):
        states, at, own_w = all_h[t + 1], all_t[t] // IN_CLASS, all_w[t]
        d = to_class.T @ states
        own = d[at, rows]
        own -= _exponents(d, 0, reach)
        total = d.sum(axis=0)
        loss -= float((own - np.log(total)) @ own_w)
        d *= own_w / total
        d[at, rows] -= own_w
        by_class_row += states @ d.T
        np.matmul(w["to_class"], d, out=dh[t])
    g["to_class"][:], g["class_shift"][:] = by_class_row[:HIDDEN], by_class_row[HIDDEN]
    order, classes = by_class(all_t.reshape(-1))
    by_h = all_h[1:].transpose(0, 2, 1).reshape(-1, HIDDEN + 1).take(order, axis=0)
    by_t, by_w = all_t.reshape(-1)[order] % IN_CLASS, all_w.reshape(-1)[order]
    (to_word, reach), ones, rows = _with_shift(w["to_word"], w["word_shift"]), np.ones(IN_CLASS, kind), np.arange(len(order))
    by_dh = np.empty((len(order), HIDDEN), kind)
    for c, lo, hi in classes:
        at, own_w, each = by_t[lo:hi], by_w[lo:hi], rows[: hi - lo]
        d = by_h[lo:hi] @ to_word[c]
        own = d[each, at]
        own -= _exponents(d, 1, reach)
        total = d @ ones
        loss -= float((own - np.log(total)) @ own_w)
        d *= (own_w / total)[:, None]
        d[each, at] -= own_w
        moved = by_h[lo:hi].T @ d
        g["to_word"][c], g["word_shift"][c] = moved[:HIDDEN], moved[HIDDEN]
        np.matmul(d, w["to_word"][c].T, out=by_dh[lo:hi])
    back = np.empty_like(by_dh)
    back[order] = by_dh
    dh += back.reshape(steps, n, HIDDEN).transpose(0, 2, 1)
    carried = np.zeros((HIDDEN, n), kind)
    gates, to_back = np.empty((3 * HIDDEN, n), kind), np.empty((3 * HIDDEN, n), kind)
    to_embed = np.empty((HIDDEN, steps, n), kind)
    dz, dr, dc = gates.reshape(3, HIDDEN, n)
    for t in reversed(range(steps)):
        before, (z, r, c, b) = all_h[t, :HIDDEN], (y.T for y in kept[t])
        carried += dh[t]
        np.multiply(carried, 1 - z, out=dc)
        dc *= 1 - c * c
        np.subtract(before, c, out=dz)
        dz *= carried
        dz *= z
        dz *= 1 - z
        np.multiply(dc, b, out=dr)
        dr *= r
        dr *= 1 - r
        to_back[: 2 * HIDDEN] = gates[: 2 * HIDDEN]
        np.multiply(dc, r, out=to_back[2 * HIDDEN :])
        g["back"] += before @ to_back.T
        g["shift"] += gates.sum(axis=1)
        g["into"] += w["embed"][inputs[:, WARM + t]].T @ gates.T
        to_embed[:, t] = w["into"] @ gates
        carried *= z
        carried += w["back"] @ to_back
    words = inputs[:, WARM:].T.reshape(-1)
    for i in range(HIDDEN):
        g["embed"][:, i] = np.bincount(words, to_embed[i].reshape(-1), minlength=OUTPUTS)
    return grad, loss


class Trainer:
    """Adam on batches of windows, as they come."""

    def __init__(self, flat: np.ndarray, rate: float = RATE):
        self.flat, self.rate, self.windows, self.steps = flat.copy(), rate, 0, 0
        self.first, self.second = np.zeros_like(flat), np.zeros_like(flat)
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, ids: np.ndarray, at: int) -> None:
        """The window of `ids` (a text's tokens with its end) whose first target is ids[at]."""
        wide = WARM + STEPS
        inputs, targets, weight = (np.zeros(wide, np.int64) for _ in range(3))
        lo, hi = max(0, at - WARM), min(len(ids), at + STEPS)
        put = lo - (at - WARM)
        targets[put : put + hi - lo] = ids[lo:hi]
        weight[put : put + hi - lo] = 1
        inputs[put : put + hi - lo] = np.concatenate([ids[lo - 1 : lo] if lo else [0], ids[lo : hi - 1]])
        self._hold(inputs[None], targets[None], weight[None])

    def add_all(self, ids: np.ndarray) -> None:
        """The windows of `ids` at 0, STEPS and so on."""
        n = -(-len(ids) // STEPS)
        padded, inside = (np.zeros(WARM + 1 + n * STEPS, np.int64) for _ in range(2))
        padded[WARM + 1 : WARM + 1 + len(ids)] = ids
        inside[WARM + 1 : WARM + 1 + len(ids)] = 1
        # inputs are one place behind
        at = np.arange(0, n * STEPS, STEPS)[:, None] + np.arange(WARM + STEPS)
        weight = inside.take(at + 1)
        self._hold(padded.take(at) * weight, padded.take(at + 1), weight)

    def _hold(self, *windows: np.ndarray) -> None:
        self.held.append(windows)
        self.waiting += len(windows[0])
        if self.waiting >= BATCH:
            joined = [np.concatenate(x) for x in zip(*self.held)]
            full = self.waiting // BATCH * BATCH
            for lo in range(0, full, BATCH):
                self._fit(*(x[lo : lo + BATCH] for x in joined))
            self.held, self.waiting = [tuple(x[full:] for x in joined)], self.waiting - full

    def update(self) -> None:
        """Takes in what is left of a batch."""
        if self.waiting:
            self._fit(*(np.concatenate(x) for x in zip(*self.held)))
            self.held, self.waiting = [], 0

    def _fit(self, inputs: np.ndarray, targets: np.ndarray, weight: np.ndarray) -> None:
        self.windows += len(inputs)
        grad, self.loss = gradient(self.flat, inputs, targets, weight)
        grad *= min(1.0, 1 / max(float(np.linalg.norm(grad)), 1e-9))
        self.steps += 1
        self.first *= 0.9
        self.first += 0.1 * grad
        self.second *= 0.99
        grad *= grad
        grad *= 0.01
        self.second += grad
        rate = float(self.rate * np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps))
        np.sqrt(self.second, out=grad)
        grad += 1e-8
        np.divide(self.first, grad, out=grad)
        grad *= rate
        self.flat -= grad


@dataclass
class Lexicon:
    """Frequent words by rank, and what the whole vocabulary adds up to."""

    rank: dict[bytes, int]
    counts: np.ndarray
    total: int
    distinct: int

    @property
    def rare(self) -> tuple[int, int]:
        """Tokens and different words beyond the network's own."""
        own = self.counts[: OUTPUTS - 1]
        return self.total - int(own.sum()), self.distinct - len(own)

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Ranks of the words and the end; -1 beyond the lexicon."""
        return np.array([*map(self.rank.get, words, repeat(-1)), self.rank[END.encode()]], dtype=np.int64)


def _network_ids(ranks: np.ndarray) -> np.ndarray:
    return np.where((ranks < 0) | (ranks >= OUTPUTS - 1), OUTPUTS - 1, ranks)


def trains(doc_id) -> bool:
    return doc_id is None or crc32(str(doc_id).encode()) % 7 != 2


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n) over the training documents; the end of a text is the empty word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            training = [trains(i) for i in batch.column(0).to_pylist()]
            words, _ = token_lists(batch.column(1).filter(pa.array(training, pa.bool_())))
            found, n = words.value_counts().flatten()
            ends = [sum(training)] * any(training)
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([found.cast(pa.string()), pa.array([END] * len(ends), pa.string())]), pa.concat_arrays([n, pa.array(ends, pa.int64())])], ["word", "n"]
            )

    return docs.select("doc_id", "text").mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent(counts: DataFrame, most: int = LEXICON) -> Lexicon | None:
    """The lexicon: whole steps of frequency, from the top, as long as they hold at most `most` words."""
    step_no = F.floor(16 * F.log2("n")).cast("int")
    steps = counts.groupBy(step_no.alias("step")).agg(F.count("*").alias("words"), F.sum("n").alias("n")).orderBy(F.desc("step")).collect()
    if not steps:
        return None
    held, least = 0, None
    for row in steps:
        if held + row["words"] > most and held >= OUTPUTS:
            break
        held, least = held + row["words"], row["step"]
    rows = counts.where((step_no >= least) | (F.col("word") == END)).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["word"] != END, -r["n"], r["word"]))
    rank = {r["word"].encode(): i for i, r in enumerate(rows)}
    return Lexicon(rank, np.array([r["n"] for r in rows], dtype=np.int64), sum(r["n"] for r in steps), sum(r["words"] for r in steps))


def _shares(lexicon: Lexicon) -> np.ndarray:
    shares = np.zeros(OUTPUTS)
    own = lexicon.counts[: OUTPUTS - 1]
    shares[: len(own)] = own
    shares[-1] = lexicon.rare[0] + 1
    return shares / shares.sum()


def numbered(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Every row of `docs` with a number, whether it trains, its tokens as network ids (two bytes each), what base_score takes from the lexicon, and its words beyond the lexicon."""
    known = docs.sparkSession.sparkContext.broadcast(lexicon)
    names = ["row", "doc_id", "trains", "n_tokens", "n_inside", "log_inside", "log_beyond", "n_rare", "ids", "rare"]
    schema = "row long, doc_id long, trains boolean, n_tokens long, n_inside long, log_inside double, log_beyond double, n_rare long, ids binary, rare array<string>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex = known.value
        logs = np.log10(lex.counts + 1.0)
        end, inner = lex.rank[END.encode()], pa.array([w.decode() for w in lex.rank], pa.string())
        for batch in batches:
            words, cuts = token_lists(batch.column(3))
            found = pc.fill_null(pc.index_in(words, value_set=inner.cast(words.type)), -1).to_numpy()
            rare_cuts = np.concatenate([[0], np.cumsum(found < 0)])[cuts]
            stats, ids = [], []
            for lo, hi in pairwise(cuts.tolist()):
                ranks = np.append(found[lo:hi], end)
                inside = ranks >= 0
                beyond = ranks >= OUTPUTS - 1
                stats.append((len(ranks), int(inside.sum()), float(logs[ranks[inside]].sum()), float(logs[ranks[beyond]].sum()), int((beyond | ~inside).sum())))
                ids.append(_network_ids(ranks).astype("<u2").tobytes())
            outside = words.filter(pa.array(found < 0)).combine_chunks().cast(pa.string())
            rare = pa.ListArray.from_arrays(pa.array(rare_cuts, pa.int32()), outside)
            columns = [pa.array([s[i] for s in stats], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *columns, pa.array(ids, pa.binary()), rare], names)

    trains = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 != 2, F.lit(True))
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), trains.alias("trains"), "text").mapInArrow(run, schema)


def _read(ids: bytes) -> np.ndarray:
    return np.frombuffer(ids, dtype="<u2").astype(np.int64)


def trained(docs: DataFrame, lexicon: Lexicon, sample_documents: int = SAMPLE_DOCUMENTS) -> np.ndarray:
    """Weights after every window of every training document, from a start that `sample_documents` of them give."""
    return _trained(numbered(docs, lexicon), lexicon, sample_documents)


def _trained(rows: DataFrame, lexicon: Lexicon, sample_documents: int = SAMPLE_DOCUMENTS) -> np.ndarray:
    """`trained` from numbered rows."""
    spark = rows.sparkSession
    narrow = rows.where("trains").select("doc_id", "ids")
    sample = narrow.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_documents)
    sampled = narrow.join(F.broadcast(sample.distinct()), "doc_id").select("ids")
    begin = initial(_shares(lexicon))

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(begin)
        texts = [_read(x) for b in batches for x in b.column(0).to_pylist()]
        windows = [(i, at) for i, ids in enumerate(texts) for at in range(0, len(ids), STEPS)]
        for i, at in np.random.default_rng(9).permutation(np.array(windows, dtype=np.int64).reshape(-1, 2)).tolist():
            trainer.add(texts[i], at)
        trainer.update()
        yield pa.RecordBatch.from_arrays([pa.array([trainer.flat])], ["weights"])

    # the sample is bounded, so one task may hold it
    first = np.array(sampled.repartition(1).mapInArrow(start, "weights array<float>").head()[0], dtype=np.float32)
    sent = spark.sparkContext.broadcast(first)

    def go_on(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trainer = Trainer(sent.value, RATE / 4)
        for batch in batches:
            for ids in batch.column(0).to_pylist():
                trainer.add_all(_read(ids))
        trainer.update()
        if trainer.windows:
            n = -(-SIZE // CHUNK)
            parts = [trainer.flat[i * CHUNK : (i + 1) * CHUNK] for i in range(n)]
            group = crc32(trainer.flat.tobytes()) % 64
            yield pa.RecordBatch.from_arrays([pa.array(range(n), pa.int32()), pa.array([group] * n, pa.int32()), pa.array([float(trainer.windows)] * n), pa.array(parts, pa.list_(pa.float32()))], ["chunk", "part", "n", "weights"])

    def mean(rows: pd.DataFrame) -> pd.DataFrame:
        n = rows["n"].sum()
        weights = sum(np.asarray(x, dtype=np.float64) * k for x, k in zip(rows["weights"], rows["n"])) / n
        return pd.DataFrame({"chunk": [rows["chunk"].iloc[0]], "n": [n], "weights": [weights.astype(np.float32)]})

    schema = "chunk int, n double, weights array<float>"
    parts = narrow.select("ids").mapInArrow(go_on, "chunk int, part int, n double, weights array<float>")
    # averaged in two steps, so that no group grows with the number of tasks squared away
    averaged = parts.groupBy("chunk", "part").applyInPandas(mean, schema).groupBy("chunk").applyInPandas(mean, schema)
    rows = sorted(averaged.collect(), key=lambda r: r["chunk"])
    return np.concatenate([np.array(r["weights"], dtype=np.float32) for r in rows]) if rows else first


def score_texts(w: dict, texts: list[np.ndarray]) -> np.ndarray:
    """Natural log probability of each list of network ids (the end last), the state carried all the way.

    The texts go through the network SCORE_TEXTS at a time, those of near length together.
    """
    out = np.zeros(len(texts))
    order = np.argsort([-len(t) for t in texts], kind="stable")
    table = w["embed"] @ w["into"] + w["shift"]
    for lo in range(0, len(texts), SCORE_TEXTS):
        group = order[lo : lo + SCORE_TEXTS]
        out[group] = _score_group(w, table, [texts[i] for i in group.tolist()])
    return out


def _score_group(w: dict, table: np.ndarray, texts: list[np.ndarray]) -> np.ndarray:
    """`score_texts` of texts from the longest to the shortest; SCORE_ROWS states or more meet the output layer together."""
    out = np.zeros(len(texts))
    lengths = np.array([len(t) for t in texts], dtype=np.int64)
    ids = np.concatenate(texts)
    begins, longest = np.cumsum(lengths) - lengths, int(lengths[0])
    h, last = np.zeros((HIDDEN, len(texts)), table.dtype), np.zeros(len(texts), np.int64)
    held: list[tuple[np.ndarray, np.ndarray]] = []
    waiting = 0
    for t0 in range(0, longest, SCORE_STEPS):
        live = np.searchsorted(-lengths, -np.arange(t0, min(t0 + SCORE_STEPS, longest)), side="left").tolist()
        places = np.minimum(begins[: live[0], None] + np.arange(t0, t0 + len(live)), len(ids) - 1)
        block = np.ascontiguousarray(ids[places].T)
        for n, wanted in zip(live, block):
            h = step(w, np.ascontiguousarray(table.take(last[:n], axis=0).T).T, h[:, :n].T)[0].T
            last = wanted[:n]
            held.append((h, last))
            waiting += n
        if waiting >= SCORE_ROWS or t0 + len(live) == longest:
            chances = log_chances(w, np.concatenate([x[0] for x in held], axis=1).T, np.concatenate([x[1] for x in held]))
            at = 0
            for _, wanted in held:
                out[: len(wanted)] += chances[at : at + len(wanted)]
                at += len(wanted)
            held, waiting = [], 0
    return out


def scored(docs: DataFrame, lexicon_size: int = LEXICON) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score, one row per row of `docs`."""
    spark = docs.sparkSession
    counts = settled(word_counts(docs))
    lexicon = frequent(counts, lexicon_size)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 7 == 2, F.lit(False)).alias("held_out")
    if lexicon is None or lexicon.total == 0:
        size = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+"), lambda x: x != "")) + 1
        zero = F.lit(0).cast("long")
        return docs.select("doc_id", held_out, size.cast("long").alias("n_tokens"), zero.alias("n_known"), zero.alias("train_tokens"), F.lit(0.0).alias("base_score"), F.lit(0.0).alias("score"))
    # row numbers are not the same in a second run, so they are written once and used from there, as are the words' ids
    rows_folder, folder = new_folder(spark, "recurrent-ids"), new_folder(spark, "recurrent-scores")
    numbered(docs, lexicon).write.parquet(rows_folder)
    rows = spark.read.parquet(rows_folder)
    sent = spark.sparkContext.broadcast(_trained(rows, lexicon))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = unpacked(sent.value)
        for batch in batches:
            chance = score_texts(w, [_read(x) for x in batch.column(7).to_pylist()]) / np.log(10)
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(7)), pa.array(chance)], [*names, "chance"])

    names = ["row", "doc_id", "n_tokens", "n_inside", "log_inside", "log_beyond", "n_rare"]
    schema = "row long, doc_id long, n_tokens long, n_inside long, log_inside double, log_beyond double, n_rare long, chance double"
    rows.select(*names, "ids").mapInArrow(run, schema).write.parquet(folder)
    part = spark.read.parquet(folder)
    beyond = rows.select("row", F.explode("rare").alias("word")).join(counts, "word").groupBy("row").agg(F.count("*").alias("n_seen"), F.sum(F.log10(F.col("n") + 1)).alias("log_seen"))
    joined = part.join(beyond, "row", "left").fillna({"n_seen": 0, "log_seen": 0.0})
    rare_tokens, rare_words = lexicon.rare
    base = F.col("log_inside") + F.col("log_seen") - F.col("n_tokens") * float(np.log10(lexicon.total + lexicon.distinct + 1))
    score = F.col("chance") + F.col("log_beyond") + F.col("log_seen") - F.col("n_rare") * float(np.log10(rare_tokens + rare_words + 1))
    return joined.select(
        "doc_id", held_out, "n_tokens", (F.col("n_inside") + F.col("n_seen")).alias("n_known"),
        F.lit(lexicon.total).cast("long").alias("train_tokens"), base.alias("base_score"), score.alias("score"),
    )
