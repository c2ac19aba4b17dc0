"""The text operators against brute force, on the small documents table and on odd rows."""

import collections
import hashlib
import json
import math
import re
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from yieldloom.llm import (
    block_mixing,
    circulant_minhash,
    divergence_rules,
    id_coder,
    merge_dropout,
    merkle,
    offset_tokens,
    ordinal_quality,
    phrase_automata,
    queries,
    recurrent_lm,
)

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = "node bucket words block key h start n size label row spans parts word a b text_ lengths weight"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING.split())
LONG = " ".join(f"w{i % 977} x{i % 31}." for i in range(30_000))
PASSAGE = " ".join(f"p{i}" for i in range(60))
ODD = [
    (None, "no id at all, but words", "en", "a"),
    (1, None, "en", "a"),
    (2, "", None, None),
    (3, " \t\n ", "en", "b"),
    (4, "one", "en", "b"),
    (5, "same words here in both", "en", "b"),
    (6, "SAME words here\nin both", "en", "b"),
    (7, LONG, "en", "a"),
    (8, PASSAGE + " and a tail", "de", "c"),
    (8, PASSAGE + " and a tail", "de", "c"),
    (9, "head of it " + PASSAGE, None, None),
    (10, "a " * 36, "en", "b"),
    (11, "b " * 35, "en", "b"),
    (12, "x y z " * 40, "fr", "c"),
    (13, "ends with ▁ sign \U0001f600 and   no break space", "fr", "c"),
    (14, "<|endoftext|> <s></s><0x0A> it's\x0b12 \x0c 3.5", "en", "b"),
]


def frame(spark, rows):
    extra = len(CLASHING.split())
    return spark.createDataFrame([(*r, len(r[1] or ""), *["?"] * extra) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module", params=["odd", "documents"])
def both(request, odd, docs):
    return odd if request.param == "odd" else docs


def rows_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def matched(df, expected):
    """Rows of `df` and of `expected` are equal as bags."""
    got = collections.Counter(tuple(r) for r in df.collect())
    want = collections.Counter(expected)
    assert got == want, (list((got - want).items())[:3], list((want - got).items())[:3])


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# --- merge dropout


def test_encoding_is_lossless_and_repeatable(both):
    first = merge_dropout.encoded(both).select("doc_id", "ids", "n_tokens", "lossless")
    again = merge_dropout.encoded(both.repartition(3)).select("doc_id", "ids", "n_tokens", "lossless")
    kept = [(r.doc_id, tuple(r.ids), r.n_tokens, r.lossless) for r in first.collect()]
    assert all(x[3] and len(x[1]) == x[2] for x in kept)
    assert collections.Counter(kept) == collections.Counter((r.doc_id, tuple(r.ids), r.n_tokens, r.lossless) for r in again.collect())
    texts = collections.Counter((i, t or "") for i, t in rows_of(both))
    assert collections.Counter(tuple(r) for r in merge_dropout.decoded(first).collect()) == texts


def test_without_dropout_it_is_the_tokenizer(both):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=merge_dropout.model_path())
    ids = merge_dropout.encoded(both, dropout=0.0)
    plain = [(i, t or "") for i, t in rows_of(both) if "▁" not in (t or "")]
    want = collections.Counter((i, tuple(sp.encode(t))) for i, t in plain)
    got = collections.Counter((r.doc_id, tuple(r.ids)) for r in ids.collect())
    assert not want - got


def test_dropout_varies_with_seed_and_agrees_with_the_heap(docs):
    texts = [t for _, t in rows_of(docs)[:40]]
    path = merge_dropout.model_path()
    a = merge_dropout.Encoder(path, 0.2, 1).encode(range(40), texts)
    b = merge_dropout.Encoder(path, 0.2, 2).encode(range(40), texts)
    assert any(x.tolist() != y.tolist() for x, y in zip(a, b))
    longest, merge_dropout.LONGEST = merge_dropout.LONGEST, 0
    try:
        c = merge_dropout.Encoder(path, 0.2, 1).encode(range(40), texts)
    finally:
        merge_dropout.LONGEST = longest
    assert all(x.tolist() == y.tolist() for x, y in zip(a, c))


# --- Merkle


def test_lossless_agrees_with_decoding():
    path = merge_dropout.model_path()
    texts = ["", "two words", "a \u2581 sign", "\u4e16\U0001f600 x", "end"]
    ids = merge_dropout.Encoder(path, 0.3, 2).encode(range(5), texts)
    others = ["x", "two words", "a  sign", "\u4e16\U0001f600 x", "en"]
    for wanted in (texts, others):
        want = [merge_dropout.decode(x.tolist(), path) == t for x, t in zip(ids, wanted)]
        assert merge_dropout.lossless(ids, wanted, path) == want


def test_possible_merges_are_looked_up_once_a_span(monkeypatch):
    p = merge_dropout.pieces(merge_dropout.model_path())
    chunks = [p.first[[ord(c) for c in word]] for word in (" international", " unbelievably", "zq", " xyzzyplugh", " aaaaaaa")]
    want = []
    for symbols in chunks:
        n = len(symbols)
        made, terms = {(i, i + 1): symbols[i : i + 1] for i in range(n)}, []
        for size in range(2, n + 1):
            for i in range(n - size + 1):
                found = [(m, p.merge(made[i, m], made[m, i + size])) for m in range(i + 1, i + size) if (i, m) in made and (m, i + size) in made]
                found = [(m, piece) for m, piece in found if piece[0] >= 0]
                terms += [(((i << 42) | (m << 21) | (i + size)) + 1) * merge_dropout.SPAN & merge_dropout.WORD for m, _ in found]
                if found:
                    made[i, i + size] = found[0][1]
        want.append(sorted(terms))
    # neither they nor the agendas search the table of merges again
    monkeypatch.setattr(merge_dropout.Pieces, "merge", None)
    got = merge_dropout.possible(np.concatenate(chunks), np.array([len(c) for c in chunks]), p)
    assert [sorted(np.frombuffer(x, np.uint64).tolist()) for x in got] == want and any(want)
    ids = merge_dropout.agendas(chunks[0][None], np.zeros(1, np.uint64), p, 0)
    assert merge_dropout.decode(np.frombuffer(ids[0], np.int32).tolist(), merge_dropout.model_path()) == "international"


def test_a_chunk_is_segmented_by_occurrence():
    path = merge_dropout.model_path()
    found = merge_dropout.Encoder(path, 0.3, 5).encode(range(3000), ["international"] * 3000)
    assert len({tuple(x) for x in found}) > 40
    assert {merge_dropout.decode(x.tolist(), path) for x in found} == {"international"}


def test_merkle_rows(both):
    rows = sorted(((i, t or "") for i, t in rows_of(both)), key=lambda r: (-(2**63) if r[0] is None else r[0], r[1]))
    out = merkle.compared_with_edits(both).collect()
    want = collections.Counter()
    for (i, t), (_, following) in zip(rows, rows[1:] + rows[:1]):
        tail = len(t) // 4
        edited = t[: len(t) - tail] + following[:tail]
        want[(i, len(t), hashlib.sha256(edited.encode()).hexdigest())] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in out) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)
    assert all((r.near_edited == 1) == (r.fingerprint == r.edited_fingerprint) == (r.edited_paragraph is None) for r in out)
    by_text = dict(rows)
    prints = collections.defaultdict(set)
    for r in out:
        prints[by_text[r.doc_id]].add(r.fingerprint)
    assert all(len(p) == 1 for p in prints.values()) and len(set.union(*prints.values())) == len(prints)


def test_merkle_locates_the_edit(spark):
    lines = [f"line {i} of the text." for i in range(40)]
    changed = lines[:25] + ["another line"] + lines[26:]
    out = merkle.trees(spark.createDataFrame([(1, "\n".join(lines)), (2, "\n".join(changed))], "doc_id long, text string")).orderBy("doc_id").collect()
    a, b = out
    assert a.fingerprint != b.fingerprint
    assert [i for i, (x, y) in enumerate(zip(a.leaves, b.leaves)) if x != y] == [25]
    assert a.branches[0] == b.branches[0] or a.leaves[:1] == b.leaves[:1]


# --- near-dedup


def expected_components(rows):
    sets = []
    for i, t in rows:
        w = words(lower(t))
        sets.append(frozenset(tuple(w[j : j + 5]) for j in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    index = collections.defaultdict(list)
    for k, s in enumerate(sets):
        if rows[k][0] is None:
            continue
        seen = collections.Counter(j for g in s for j in index[g])
        for j, common in seen.items():
            if 100 * common >= 75 * len(s | sets[j]):
                parent[find(k)] = find(j)
        for g in s:
            index[g].append(k)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(s), least.get(find(k)), i is None or i == least[find(k)]) for k, ((i, _), s) in enumerate(zip(rows, sets))]


def test_near_duplicates(both):
    matched(circulant_minhash.near_duplicates(both), expected_components(rows_of(both)))


def test_near_duplicates_of_chains_and_stars(spark):
    base = [f"t{i}" for i in range(100)]
    rows, text = [], list(base)
    for i in range(30):  # each links with its neighbours, not with those far off
        text[3 * i] = f"new{i}"
        rows.append((100 + i, " ".join(text)))
    rows += [(200 + i, " ".join(base[:99] + [f"end{i}"])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    matched(circulant_minhash.near_duplicates(df), expected_components(rows))
    # a pair that rounds after the first must find: hubs alone leave it apart
    kept = circulant_minhash.deduplicated(df).count()
    assert kept == sum(r[3] for r in expected_components(rows))


def test_near_duplicates_compared_in_blocks(spark, monkeypatch):
    """A template whose copies mostly lie just below the threshold: many classes of a bucket stay apart."""
    rng = np.random.default_rng(5)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for i in range(90):
        text = list(base)
        for place in rng.choice(len(base), int(rng.integers(2, 8)), replace=False):
            text[place] = f"n{i}x{place}"
        rows.append((1000 - i, " ".join(text)))
    want = expected_components(rows)
    assert 5 < len({c for _, _, c, _ in want}) < 90
    df = spark.createDataFrame(rows, "doc_id long, text string")
    matched(circulant_minhash.near_duplicates(df), want)
    monkeypatch.setattr(circulant_minhash, "MANY", 2)
    monkeypatch.setattr(circulant_minhash, "BLOCK", 7)
    matched(circulant_minhash.near_duplicates(df), want)


def test_block_comparison_finds_links_the_hubs_miss(spark, monkeypatch):
    text = [f"t{i}" for i in range(60)]
    members = [(7, k, k, 12) for k in range(12)]
    texts = [(k, " ".join(text[:55] + [f"e{k // 2}"] * 5 if k < 6 else [f"o{k}"] * 9 + text[9:30])) for k in range(12)]
    want = set()
    for a, x in texts:
        for b, y in texts:
            p, q = ({tuple(words(t)[i : i + 5]) for i in range(len(words(t)) - 4)} for t in (x, y))
            if a < b and 100 * len(p & q) >= 75 * len(p | q):
                want.add((a, b))
    monkeypatch.setattr(circulant_minhash, "BLOCK", 4)
    sketches = circulant_minhash._sketches(spark.createDataFrame(texts, "node long, text string"), 5)
    found = circulant_minhash._overlapping_in_blocks(spark.createDataFrame(members, "bucket long, node long, label long, size long"), sketches, 0.75)
    assert want and want <= {tuple(r) for r in found.collect()} <= want | {(a, b) for a in range(6) for b in range(a + 1, 6)}


def test_cut_sketches_estimate_the_similarity():
    rng = np.random.default_rng(3)
    pool = rng.choice(2**32, 30000, replace=False).astype(np.uint32)
    full = [np.sort(pool[:20000]), np.sort(pool[2000:21500]), np.sort(pool[9000:29000]), np.sort(pool[:700])]
    sketches, whole = [s[:1024] for s in full], np.array([len(s) <= 1024 for s in full])
    at = np.arange(4)
    found = circulant_minhash.overlapping(sketches, whole, at, at, at, 0.75)
    assert {p for p in found if p[0] < p[1]} == {(0, 1)}


# --- substring dedup


def expected_removals(rows, window=35):
    counts = collections.Counter(tuple(w[j : j + window]) for _, t in rows for w in [words(t)] for j in range(len(w) - window + 1))
    out = []
    for i, t in rows:
        w = words(t)
        gone = np.zeros(len(w), dtype=bool)
        for j in range(len(w) - window + 1):
            if counts[tuple(w[j : j + window])] > 1:
                gone[j : j + window] = True
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), int(gone.sum()), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_chunks_of_one_name_are_looked_up_once(monkeypatch):
    p = merge_dropout.pieces(merge_dropout.model_path())
    chunks = [[p.blank, *(int(p.first[ord(c)]) for c in word)] for word in ("internation", "wonderfully")]
    symbols = np.array(chunks * 30, dtype=np.int32)
    keys = merge_dropout.mixed(np.arange(60, dtype=np.uint64))
    limit = merge_dropout._limit(0.3)
    looked_up, spans = [], merge_dropout.spans
    monkeypatch.setattr(merge_dropout, "spans", lambda symbols, left, p: looked_up.append(len(symbols)) or spans(symbols, left, p))
    found = merge_dropout.agendas(symbols, keys, p, limit, np.tile(np.array([5, 3], np.uint64), 30))
    assert looked_up == [symbols[:2].size]
    assert [np.frombuffer(x, np.int32).tolist() for x in found] == [merge_dropout.agenda(s, int(k), p, limit) for s, k in zip(symbols, keys)]
    assert len(set(found)) > 10


def test_removals(both):
    matched(phrase_automata.removals(both, shard_blocks=50), expected_removals(rows_of(both)))


def test_large_anchors_are_cut_into_windows(docs):
    matched(phrase_automata.removals(docs, shard_blocks=1), expected_removals(rows_of(docs)))


def test_blocks_around_a_common_passage_are_cut_into_few_pieces(spark, monkeypatch):
    random = np.random.default_rng(4)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(400):
        before, after = (random.choice([f"c{k}" for k in range(5000)], 40).tolist() for _ in range(2))
        rows.append((i, " ".join([*before, *passage[: 60 - i % 3], *after])))
    # texts that repeat a passage with some words around it
    rows += [(400 + i, " ".join([*rows[i][1].split(" ")[40 - i : 110 + i], f"own{i}"])) for i in range(20)]
    made = []
    pieces = phrase_automata._pieces

    def counted(blocks, window, most):
        out = pieces(blocks, window, most)
        made.append((out.count(), blocks.count(), blocks.agg({"n": "sum"}).head()[0] or 0))
        return out

    monkeypatch.setattr(phrase_automata, "_pieces", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    matched(phrase_automata.removals(docs, shard_blocks=20), expected_removals(rows))
    assert made[0][2] > 1000
    assert sum(n for n, _, _ in made) < made[0][2] / 2


def test_covers_come_from_the_automaton(monkeypatch):
    import ahocorasick

    text = " ".join(f"w{i}" for i in range(36))
    rows = [(1, 1, 1, text, 1), (1, 2, 2, "x " + text.rsplit(" ", 1)[0], 1), (2, 3, 3, text.replace("w", "v"), 1), (3, 4, 4, text.title(), 2)]
    assert phrase_automata._hits(rows, 35) == [[[0, 35]], [[1, 36]], [], [[0, 36]]]

    class Emptied:
        def __init__(self, *args): ...
        def add_word(self, *args): ...
        def make_automaton(self): ...
        def iter(self, text):
            return iter(())

    monkeypatch.setattr(ahocorasick, "Automaton", Emptied)
    assert phrase_automata._hits(rows, 35) == [[], [], [], []]


def test_words_are_cut_from_bytes_at_ascii_white_space():
    text = " a\u0085b\u00a0c\x1cd\te\x0bf\x0c\r\ng\u2003h  "
    assert phrase_automata._split(text.encode()) == [w.encode() for w in words(text)]
    assert phrase_automata._split(None) == []


def test_removals_in_batches_of_more_than_a_stretch(spark):
    random = np.random.default_rng(12)
    rows = [(i, " ".join(f"w{k}" for k in random.integers(0, 10**6, 9000)) if i % 5 else None) for i in range(40)]
    rows += [(40 + i, rows[i][1][:3000] + " end") for i in (1, 33, 39)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    matched(phrase_automata.removals(docs), expected_removals(rows))


def test_texts_without_repeats(odd):
    left = {r.doc_id: r for r in phrase_automata.without_repeats(odd).collect()}
    assert left[8].text == "" and left[8].n_chars == 0  # two rows, so each word lies in a copied window
    assert left[9].text == "head of it" and left[4].text == "one" and left[1].text is None
    assert phrase_automata.without_repeats(odd).columns == odd.columns


# --- ordinal classifier


def test_ordinal_model_ranks_and_keeps_order(docs, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = "crc32(cast(doc_id as string)) % 4 = 0"
    out = ordinal_quality.selected(docs, labels.where(f"not ({fold})")).join(labels.where(fold), "doc_id").collect()
    good = [r.expected_grade for r in out if r.quality == 1]
    bad = [r.expected_grade for r in out if r.quality == 0]
    assert np.mean([(g > b) + (g == b) / 2 for g in good for b in bad]) > 0.85
    assert all(r.p_top <= r.p_good and abs(r.expected_grade - r.p_good - r.p_top) < 1e-6 for r in out)


def test_ordinal_odd_rows(odd, empty, spark):
    labels = spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, 1, 0), (7, 1, 1), (None, 1, 0), (8, None, 1)], "doc_id long, quality int, toxic int")
    out = ordinal_quality.selected(odd, labels)
    assert out.count() == len(ODD) and out.where("selected is null").count() == 0
    assert ordinal_quality.selected(odd, labels.limit(0)).where("p_top is null and selected is null").count() == len(ODD)
    assert ordinal_quality.selected(empty, labels).count() == 0


# --- language model


def test_gradient_follows_the_loss():
    random = np.random.default_rng(0)
    flat = recurrent_lm.initial(np.full(recurrent_lm.OUTPUTS, 1 / recurrent_lm.OUTPUTS)).astype(np.float64)
    shape = (3, recurrent_lm.WARM + recurrent_lm.STEPS)
    inputs, targets, weight = random.integers(0, recurrent_lm.OUTPUTS, shape), random.integers(0, recurrent_lm.OUTPUTS, shape), np.ones(shape)
    # without tokens before the window nothing is cut off, so the gradient is exact
    weight[:, : recurrent_lm.WARM] = 0
    grad, _ = recurrent_lm.gradient(flat, inputs, targets, weight)
    for name, places in recurrent_lm.unpacked(np.arange(len(flat))).items():
        i = int(places.ravel()[np.abs(grad[places.ravel()]).argmax()])
        up, down = flat.copy(), flat.copy()
        up[i] += 1e-4
        down[i] -= 1e-4
        slope = (recurrent_lm.gradient(up, inputs, targets, weight)[1] - recurrent_lm.gradient(down, inputs, targets, weight)[1]) / 2e-4
        assert grad[i] == pytest.approx(slope, rel=1e-3, abs=1e-6), name


def test_carried_state_equals_one_long_run():
    w = recurrent_lm.unpacked(recurrent_lm.initial(np.full(recurrent_lm.OUTPUTS, 1 / recurrent_lm.OUTPUTS)))
    random = np.random.default_rng(1)
    texts = [random.integers(0, recurrent_lm.OUTPUTS, n) for n in (1, 16, 17, 70)]
    table = w["embed"] @ w["into"] + w["shift"]
    for text, got in zip(texts, recurrent_lm.score_texts(w, texts)):
        h, last, total = np.zeros((1, recurrent_lm.HIDDEN), np.float32), 0, 0.0
        for t in text:
            h, _ = recurrent_lm.step(w, table[[last]], h)
            total += recurrent_lm.log_chances(w, h, np.array([t]))[0]
            last = t
        assert got == pytest.approx(total, rel=1e-4)
    h = random.normal(size=(1, recurrent_lm.HIDDEN)).astype(np.float32)
    every = recurrent_lm.log_chances(w, np.repeat(h, recurrent_lm.OUTPUTS, 0), np.arange(recurrent_lm.OUTPUTS))
    assert np.exp(every).sum() == pytest.approx(1, abs=1e-3)


def test_language_model_scores(both):
    rows = rows_of(both)
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts = collections.Counter(w for i, t in rows if not held(i) for w in [*words(lower(t)), ""])
    total, distinct = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, t in rows:
        tokens = [*words(lower(t)), ""]
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        want[(i, held(i), len(tokens), sum(counts[w] > 0 for w in tokens), total, round(base, 4))] += 1
    out = recurrent_lm.scored(both, lexicon_size=4100).collect()
    assert collections.Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in out) == want
    assert all(r.score < 0 for r in out)
    if len(rows) > 100:
        assert sum(r.score for r in out if r.held_out) > sum(r.base_score for r in out if r.held_out)


# --- mixing


def expected_targets(sizes):
    names = sorted(s for s in sizes if s is not None) + [s for s in sizes if s is None]
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        unit = (total - sum(fixed.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if unit * weight[s] > 3 * sizes[s] + 1e-9]
        if not over:
            return fixed | {s: unit * weight[s] for s in free}
        fixed |= {s: 3 * sizes[s] for s in over}


def test_mixing(both):
    source = collections.defaultdict(int)
    seen = {}
    for r in both.select("doc_id", "source", "text").collect():
        seen[(r.doc_id, r.source)] = len(words(r.text))
    for (_, s), n in seen.items():
        source[s] += n
    out = block_mixing.taken_words(both).collect()
    again = block_mixing.taken_words(both.repartition(5)).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    targets = expected_targets(dict(source))
    assert {(r.doc_id, r.source): r["size"] for r in out} == seen and len(out) == len(seen)
    taken = collections.Counter()
    for r in out:
        assert r.source_size == source[r.source] and r.target == pytest.approx(targets[r.source]) and r.taken <= 3 * r["size"]
        taken[r.source] += r.taken
    assert all(abs(taken[s] - t) <= 1.5 * block_mixing.BLOCK_WORDS for s, t in targets.items())


def test_mixed_rows_hold_what_is_taken(docs):
    taken = {r.doc_id: r.taken for r in block_mixing.taken_words(docs).collect() if r.taken}
    mixed = block_mixing.mixed_documents(docs)
    held = collections.Counter()
    for r in mixed.collect():
        held[r.doc_id] += len(words(r.text))
        assert r.n_chars == len(r.text)
    assert dict(held) == taken and mixed.columns == docs.columns
    blocks = collections.Counter()
    for r in block_mixing.mixed_blocks(docs).collect():
        blocks[r.doc_id] += len(r.words)
    assert dict(blocks) == taken


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 100, 1000])
def test_permutations_are_bijections(spark, n):
    from pyspark.sql import functions as F

    bits = n.bit_length() - 1
    image = block_mixing.permuted(F.col("id"), F.lit(n).cast("long"), F.lit(bits), F.lit(5).cast("long"))
    assert sorted(r[0] for r in spark.range(n).select(image).collect()) == list(range(n))


# --- quality rules


def expected_rules(text):
    w = words(text)
    triples = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j + k for j, t in enumerate(zip(w, w[1:], w[2:])) if triples[t] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), failed


def test_rules(both):
    out = divergence_rules.judged(both)
    matched(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), [(i, *expected_rules(t)) for i, t in rows_of(both)])
    assert all(not (r.base_failed and r.kept) for r in out.collect())
    assert divergence_rules.passing(both).columns == both.columns
    assert divergence_rules.passing(both).count() == out.where("kept").count()


def test_divergence(docs):
    pattern = [(n, re.compile(p)) for n, p in divergence_rules.CLASSES]
    rows = docs.select("doc_id", "text", "lang").collect()
    classes = lambda t: [sum(map(len, p.findall(t))) for _, p in pattern]
    full = lambda t: np.array([*(c := classes(t)), len(t) - sum(c)], dtype=float)
    reference, spoken = {}, {}
    for r in rows:
        reference[r.lang] = reference.get(r.lang, 0) + full(r.text)
        spoken.setdefault(r.lang, collections.Counter()).update(x.lower() for x in words(r.text))

    def distance(p, q):
        m = (p + q) / 2
        part = lambda a: sum(x * math.log2(x / y) for x, y in zip(a, m) if x > 0)
        return math.sqrt(max(0.0, (part(p) + part(q)) / 2))

    common = {}
    for lang, counts in spoken.items():
        wordlike = [w for w in counts if re.search(r"[0-9a-z]|[^\x00-\x7f]", w)]
        best = sorted(wordlike, key=lambda w: (-counts[w], w.encode()))[: divergence_rules.COMMON_WORDS]
        common[lang] = {w: counts[w] / sum(counts.values()) for w in best}
    out = {r.doc_id: r for r in divergence_rules.judged(docs).collect()}
    for r in rows:
        w = [x.lower() for x in words(r.text)]
        got = out[r.doc_id]
        assert got.class_distance == pytest.approx(distance(full(r.text) / len(r.text), reference[r.lang] / reference[r.lang].sum()), abs=1e-6)
        q = np.array(list(common[r.lang].values()))
        p = np.array([w.count(x) / len(w) for x in common[r.lang]])
        assert got.word_distance == pytest.approx(distance(np.append(p, 1 - p.sum()), np.append(q, 1 - q.sum())), abs=1e-6)


# --- token attribution


@pytest.mark.parametrize("rule", offset_tokens.RULES)
def test_attribution_adds_up(both, rule):
    out = offset_tokens.attributed(both, rule=rule).collect()
    assert len(out) == both.count()
    for r in out:
        assert sum(r.field_tokens) == pytest.approx(r.n_tokens) and sum(r.line_tokens) == pytest.approx(r.field_tokens[-1])


def test_offsets_are_the_tokenizers(docs, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    path = offset_tokens.vocabulary_path()
    for _, text in rows_of(docs)[:50] + rows_of(odd):
        if text and len(text) < 50_000:
            assert [tuple(s) for s in offset_tokens.token_spans(text, path).T] == tokenizer.encode(text, add_special_tokens=False).offsets


def test_allocation_rules():
    spans = np.array([[0, 2, 5, 9], [2, 5, 9, 12]])
    ends = np.array([3, 3, 6, 12])  # the second section is empty; tokens 2-5 and 5-9 cross an end
    assert offset_tokens.allocated(spans, ends, "first")[0].tolist() == [2, 0, 1, 1]
    assert offset_tokens.allocated(spans, ends, "last")[0].tolist() == [1, 0, 1, 2]
    assert offset_tokens.allocated(spans, ends, "most")[0].tolist() == [1, 0, 1, 2]
    counts, crossing = offset_tokens.allocated(spans, ends, "share")
    assert counts == pytest.approx([1 + 1 / 3, 0, 2 / 3 + 1 / 4, 3 / 4 + 1]) and crossing == 2


# --- id coder


def test_blocks_round_trip_and_are_checked():
    random = np.random.default_rng(2)
    blocks = [random.integers(0, 65536, 2048), random.zipf(1.2, 2048) % 49408, np.zeros(2048, int), np.arange(300), np.array([65535]), np.full(7, 2), np.zeros(0, int)]
    coded = id_coder.encode_blocks(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, id_coder.decode_blocks(coded)))
    assert np.array_equal(id_coder.decode_blocks(coded[3:4])[0], blocks[3])  # alone
    assert len(coded[2]) < 100
    broken = bytearray(coded[1])
    broken[200] ^= 255
    with pytest.raises(ValueError, match="checksum"):
        id_coder.decode_blocks([bytes(broken)])


def test_blocks_keep_their_bytes():
    # files of earlier versions are read by later ones: the sums were taken before the lanes' steps were rewritten
    random = np.random.default_rng(12)
    ids = [random.integers(0, 65536, 1500), np.arange(3000) % 7, np.zeros(0, int), np.array([65535]), random.integers(0, 3, 2500), np.minimum(random.zipf(1.3, 2000), 65535)]
    ids.append(np.repeat(random.integers(0, 50, 500), 5))
    blocks = [x.astype(np.uint16) for x in ids]
    coded = id_coder.encode_blocks(blocks)
    assert [zlib.crc32(c) for c in coded] == [1814681430, 3358390961, 2780778749, 2369885661, 263987116, 2329490596, 1142838273]
    assert all(np.array_equal(a, b) for a, b in zip(blocks, id_coder.decode_blocks(coded)))


def test_order_0_is_searched_once_for_all_lanes():
    limits = np.array([50_000, 900, 1])
    model = id_coder.Model(limits)
    model.plan()
    for lane, limit in enumerate(limits.tolist()):
        row = model.sums[lane]
        assert row[0] == lane << 22 and (np.diff(row[: limit + 1]) > 0).all() and (row[limit + 1 :] == (lane + 1) << 22).all()
    assert (np.diff(model.flat) >= 0).all()


def test_mixing_packs_better_than_zlib_and_order_0(docs):
    texts = [r.text or "" for r in docs.orderBy("doc_id").collect()]
    ids = np.concatenate(id_coder.WordEncoder(id_coder.tokenizer_path()).encode(texts))
    blocks = [ids[a : a + id_coder.BLOCK_IDS] for a in range(0, len(ids), id_coder.BLOCK_IDS)]
    bits = 8 * sum(map(len, id_coder.encode_blocks(blocks))) / len(ids)
    packed = 8 * sum(len(zlib.compress(b.astype("<u2").tobytes(), 9)) for b in blocks) / len(ids)
    shares = np.unique(ids, return_counts=True)[1] / len(ids)
    assert bits < packed - 1 and bits < -(shares * np.log2(shares)).sum() + 0.3


def test_ids_in_files(both):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(id_coder.tokenizer_path())
    rows = sorted(((i, t or "") for i, t in rows_of(both)), key=lambda r: (-(2**63) if r[0] is None else r[0], r[1]))
    want, start = [], 0
    for i, text in rows:
        ids = np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    matched(id_coder.encoded_ids(both), want)


def test_ids_are_coded_and_read_in_the_jvm(docs):
    folder = id_coder.written(docs)
    plan = id_coder.read_back(docs.sparkSession, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan and "inline" in plan
    # what stands in the files is what the Python reader reads
    pages = docs.sparkSession.read.parquet(folder).orderBy("part", "page").collect()
    found = [(i, ids.tolist()) for page in id_coder.unpacked_pages([bytes(r.ids) for r in pages]) for i, ids in zip(*page)]
    rows = sorted(rows_of(docs))
    want = id_coder.WordEncoder(id_coder.tokenizer_path()).encode([t for _, t in rows])
    assert found == [(i, ids.tolist()) for (i, _), ids in zip(rows, want)]


def test_java_pages_are_those_of_python(spark, monkeypatch):
    monkeypatch.setattr(id_coder, "BLOCK_IDS", 2600)
    random = np.random.default_rng(21)
    texts = [random.integers(0, 65536, 9000), np.arange(6000) % 7, np.array([65535]), np.zeros(2700, int), random.zipf(1.2, 9000) % 49408, np.repeat(random.integers(0, 50, 900), 5)]
    # a model that changes halfway, so that every streak ends
    texts.append(np.concatenate([np.tile(random.integers(0, 300, 40), 60), np.tile(random.integers(0, 300, 40), 60)]))
    texts = [t.astype(np.uint16) for t in texts]
    pages = [([7], texts[:1]), ([None, -5, 2**40], texts[1:4]), ([0, 0], texts[4:6]), ([1], texts[6:])]
    functions = id_coder._functions(spark)
    packed = id_coder.packed_pages(pages)
    plain = spark.createDataFrame([(k, bytearray(p)) for k, p in enumerate(id_coder.packed_pages(pages, id_coder.plain_blocks))], "k int, ids binary")
    coded = plain.repartition(2).select("k", F.call_function(functions["Coded"], "ids").alias("ids"))
    assert [bytes(r.ids) for r in sorted(coded.collect())] == packed
    for (doc_ids, texts), row in zip(pages, sorted(coded.select("k", F.call_function(functions["Documents"], "ids").alias("d")).collect())):
        starts = np.cumsum([0, *map(len, texts)])
        assert [tuple(d) for d in row.d] == [(i, at, len(t), zlib.crc32(t.astype("<u4").tobytes())) for i, at, t in zip(doc_ids, starts, texts)]
    broken = bytearray(packed[0])
    broken[400] ^= 255
    for page, why in ((broken, "checksum"), (bytearray(b"no page at all"), "not a page")):
        with pytest.raises(Exception, match=why):
            spark.createDataFrame([(page,)], "ids binary").repartition(2).select(F.call_function(functions["Documents"], "ids")).collect()


def test_java_ids_are_those_of_the_tokenizer(spark):
    random = np.random.default_rng(4)
    points = [c for c in [*range(0x600), *random.choice(0x20000, 3000), *range(0x1100, 0x1210), *range(0x2000, 0x2070), 0x20000, 0x10FFFF] if not 0xD800 <= c < 0xE000]
    texts = [f"a{chr(c)}B {chr(c)}'s{chr(c)} 1{chr(c)}" for c in map(int, points)]
    simple = ["don't we'LL they've I'm it'd you're 's 'T !'s '' 'tis o'r o'v o'l", "Ein Gefäß Ça va ÉTÉ", "12³ Ⅷ 3.5% ½", "日本語 テスト", "“q” … – \U0001f600", "हिन्दी", "x" * 256 + " " + "ab1" * 200, None, "", " \t\n\x0b\x0c\r "]
    others = ["e\u0301 \u1112\u1161\u11ab", "q\u0301\u0323", "<|endoftext|>", "a<|startoftext|>b <|", "y" * 257, "1" * 70_000, "İ"]
    whole = "".join(chr(c) for c in random.integers(0x20, 0x2000, 4000).tolist())
    texts += [*simple, *others, whole, *(whole[k : k + 9] for k in range(0, 4000, 9))]
    path = id_coder.tokenizer_path()
    frame = spark.createDataFrame(list(enumerate(texts)), "k long, text string").repartition(3)
    got = dict(frame.select("k", id_coder.word_ids(spark, path)).collect())
    for k, (text, ids) in enumerate(zip(texts, id_coder.WordEncoder(path).encode(texts))):
        assert bytes(got[k]) in (b"\0" + ids[:-1].tobytes(), b"\1" + (text or "").encode()), text
        assert got[k][0] == (text in others) or text not in simple + others, text


def test_ids_of_another_tokenizer_and_session(both, tmp_path):
    spec = json.loads(Path(id_coder.tokenizer_path()).read_text(encoding="utf-8"))
    spec["normalizer"]["normalizers"].pop()
    path = str(tmp_path / "cased.json")
    Path(path).write_text(json.dumps(spec), encoding="utf-8")
    assert id_coder.tokenizer_tables(path) is None
    session = both.sparkSession.newSession()
    for p in (path, id_coder.tokenizer_path()):
        docs = session.createDataFrame(rows_of(both), "doc_id long, text string")
        texts = [t for _, t in sorted(rows_of(both), key=lambda r: (-(2**63) if r[0] is None else r[0], r[1] or ""))]
        want = [(len(x), zlib.crc32(x.astype("<u4").tobytes())) for x in id_coder.WordEncoder(p).encode(texts)]
        assert [(r.n_tokens, r.ids_crc32) for r in sorted(id_coder.encoded_ids(docs, p).collect(), key=lambda r: r.start)] == want


# --- all


@pytest.mark.parametrize(
    "operator",
    [
        merge_dropout.encoded,
        merkle.compared_with_edits,
        circulant_minhash.near_duplicates,
        circulant_minhash.deduplicated,
        phrase_automata.removals,
        phrase_automata.without_repeats,
        recurrent_lm.scored,
        block_mixing.taken_words,
        block_mixing.mixed_documents,
        divergence_rules.judged,
        divergence_rules.passing,
        offset_tokens.attributed,
        id_coder.encoded_ids,
    ],
    ids=lambda f: f"{f.__module__.rpartition('.')[2]}.{f.__name__}",
)
def test_empty_table(empty, operator):
    assert operator(empty).collect() == []


def test_lm_trains_on_every_window_of_a_training_document(spark):
    random = np.random.default_rng(5)
    text = " ".join(random.choice(list("abcdefgh"), 900))
    i = next(i for i in range(9) if recurrent_lm.trains(i))
    docs = spark.createDataFrame([(i, text)], "doc_id long, text string")
    lexicon = recurrent_lm.frequent(recurrent_lm.word_counts(docs))
    ids = recurrent_lm._network_ids(lexicon.ids(recurrent_lm.tokens(text)))
    windows = list(range(0, len(ids), recurrent_lm.STEPS))
    start = recurrent_lm.Trainer(recurrent_lm.initial(recurrent_lm._shares(lexicon)))
    for _, at in np.random.default_rng(9).permutation(np.array([(0, at) for at in windows])).tolist():
        start.add(ids, at)
    start.update()
    after = recurrent_lm.Trainer(start.flat, recurrent_lm.RATE / 4)
    for at in windows:
        after.add(ids, at)
    after.update()
    assert np.allclose(recurrent_lm.trained(docs, lexicon), after.flat, atol=1e-5)


def test_lm_takes_a_text_in_as_its_windows_one_by_one(monkeypatch):
    random = np.random.default_rng(8)
    texts = [random.integers(0, recurrent_lm.OUTPUTS, n) for n in (1, 31, 32, 33, 600 * recurrent_lm.STEPS, 100)]
    taken = []
    monkeypatch.setattr(recurrent_lm.Trainer, "_fit", lambda self, *batch: taken.append([self, *batch]))
    flat = np.zeros(recurrent_lm.SIZE, np.float32)
    at_once, singly = recurrent_lm.Trainer(flat), recurrent_lm.Trainer(flat)
    for ids in texts:
        at_once.add_all(ids)
        for at in range(0, len(ids), recurrent_lm.STEPS):
            singly.add(ids, at)
    at_once.update()
    singly.update()
    got, want = ([batch for who, *batch in taken if who is trainer] for trainer in (at_once, singly))
    assert len(got) == len(want) == 3
    assert all(np.array_equal(x, y) for a, b in zip(got, want) for x, y in zip(a, b))


def test_lm_looks_words_up_once_a_document(spark, monkeypatch):
    random = np.random.default_rng(6)
    docs = spark.createDataFrame([(i, " ".join(random.choice(list("abcdefgh"), 40)) if i else None) for i in range(12)], "doc_id long, text string").coalesce(1)
    lexicon = recurrent_lm.frequent(recurrent_lm.word_counts(docs))
    rows = sorted(recurrent_lm.numbered(docs, lexicon).collect(), key=lambda r: r.doc_id)
    for row, (doc_id, text) in zip(rows, sorted(rows_of(docs))):
        ids = recurrent_lm._network_ids(lexicon.ids(recurrent_lm.tokens(text)))
        assert np.array_equal(recurrent_lm._read(row.ids), ids) and row.n_tokens == len(ids)
        assert row.trains == recurrent_lm.trains(doc_id) and row.rare == []
    # groups, lots and blocks of a few texts give what all texts together do
    w = recurrent_lm.unpacked(recurrent_lm.initial(recurrent_lm._shares(lexicon)))
    texts = [random.integers(0, recurrent_lm.OUTPUTS, n) for n in (5, 1, 40, 17, 16)]
    whole = recurrent_lm.score_texts(w, texts)
    for name, size in (("SCORE_TEXTS", 2), ("SCORE_ROWS", 3), ("CLASS_ROWS", 2)):
        monkeypatch.setattr(recurrent_lm, name, size)
    assert np.allclose(recurrent_lm.score_texts(w, texts), whole, rtol=1e-5)


def test_lm_cuts_a_batch_into_the_words_of_its_texts(spark, monkeypatch):
    monkeypatch.setattr(recurrent_lm, "SPLIT_TEXTS", 2)
    texts = [None, "", " \t\n ", " a  B\x0bc\x0c ", "x\xa0y\u2003z\x1cq \x85 K\u212a \u0130 \xc9", "a", " b"]
    for column in (pa.array(texts), pa.array(texts).slice(3, 3), pa.array(texts, pa.large_string()), pa.array([], pa.string())):
        words, cuts = recurrent_lm.token_lists(column)
        got = [[w.encode() for w in words.to_pylist()[lo:hi]] for lo, hi in zip(cuts, cuts[1:])]
        assert got == [recurrent_lm.tokens(t) for t in column.to_pylist()]
    # the words of a table are counted and numbered by batches, not text by text
    monkeypatch.setattr(recurrent_lm, "tokens", None)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = collections.Counter(w.decode() for i, t in enumerate(texts) if recurrent_lm.trains(i) for w in [*(t or "").encode().lower().split(), b""])
    counts = recurrent_lm.word_counts(docs)
    assert {r.word: r.n for r in counts.collect()} == want
    lexicon = recurrent_lm.frequent(counts.where("word in ('', 'a', 'c')"))
    for row in recurrent_lm.numbered(docs, lexicon).collect():
        words = (texts[row.doc_id] or "").encode().lower().split()
        assert row.rare == [w.decode() for w in words if w not in lexicon.rank] and row.n_inside == row.n_tokens - len(row.rare)
        assert np.array_equal(recurrent_lm._read(row.ids), recurrent_lm._network_ids(lexicon.ids(words)))


def test_lm_layers_hold_outputs_too_large_to_raise(monkeypatch):
    w = recurrent_lm.unpacked(recurrent_lm.initial(np.full(recurrent_lm.OUTPUTS, 1 / recurrent_lm.OUTPUTS)).astype(np.float64))
    h, targets = np.random.default_rng(7).uniform(-1, 1, (6, recurrent_lm.HIDDEN)), np.arange(6) * 600
    want = recurrent_lm.log_chances(w, h, targets)
    # what all outputs share is no part of a chance
    w["class_shift"][:] += 2000
    w["word_shift"][:] += 2000
    assert np.allclose(recurrent_lm.log_chances(w, h, targets), want)


def test_every_operator_has_one_query():
    found = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES)
    assert found == list(range(1, 11))
