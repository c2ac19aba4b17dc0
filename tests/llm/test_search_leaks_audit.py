"""Ranked search, decontamination and filter audit against brute force, on odd rows and small tables."""

import collections
import hashlib
import itertools
import math
import re

import numpy as np
import pytest

from yieldloom.llm import decontamination, filter_audit, fp_tree_search, queries

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
CLASHING = "h hash item anchor word mask part least n own terms place length spelled maybe rank score cells begin end"
LONG = " ".join(f"w{i % 977}, x{i % 31}." for i in range(20_000))
PASSAGE = " ".join(f"p{i}" for i in range(24))
ODD = [
    (None, "No id, but Words #", "en", 5),
    (None, "No id, but Words #", "en", 5),
    (1, None, "en", 1),
    (2, "", None, 1),
    (3, " \t\n ", "de", 1),
    (4, "one", "de", 1),
    (5, "Élan VITAL  one-two\x00three", "fr", 1),
    (6, LONG, "en", 1),
    (7, f"head {PASSAGE.upper()} tail", "en", 1),
    (8, f"{PASSAGE[:60]} cut", "en", 1),
    (8, f"{PASSAGE[:60]} cut", "en", 1),
    (9, f"{PASSAGE} {PASSAGE}", None, 1),
    (10, "one", "fr", 1),
    (11, "x" * 50_000, "en", 1),
    (12, "p0 p1 p2 p3 p4 p5 p6 p7 p8 p9", "en", 1),
    (13, "p0 p1 p2 p3 p4 p5 p6 p7 p8 q p9", "en", 1),
    (14, "vital one TWO", "fr", 1),
]
ITEMS = [(1, PASSAGE), (2, "one"), (3, None), (4, "--"), (None, "p3 p4 P5"), (10, "vital one two"), (10, "w1 x1"), (5, "one"), (6, "absent words only " * 5)]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def terms(text):
    return TERM.findall(lower(text))


@pytest.fixture(scope="module")
def odd(spark):
    names = CLASHING.split()
    schema = "doc_id long, text string, lang string, n_chars long, " + ", ".join(f"{c} string" for c in names)
    return spark.createDataFrame([(*r, *["?"] * len(names)) for r in ODD], schema)


@pytest.fixture(scope="module")
def odd_items(spark):
    return spark.createDataFrame([(i, t, "?", "?") for i, t in ITEMS], "item_id long, text string, h string, terms string")


@pytest.fixture(scope="module")
def some_labels(spark):
    rows = [(1, 1, 0), (2, None, 1), (4, 1, 1), (8, 1, 0), (9, 0, 1), (9, 1, 0), (10, 1, None), (None, 1, 1), (77, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("documents", "benchmark", "labels")}


def pairs(df, key="doc_id"):
    return [(r[key], r["text"]) for r in df.select(key, "text").collect()]


# --- ranked search


def plain_ranking(docs, items, top=fp_tree_search.TOP):
    counted = [(i, collections.Counter(terms(t))) for i, t in docs]
    counted = [(i, c, sum(c.values())) for i, c in counted if c]
    n_docs, total = len(counted), sum(n for _, _, n in counted)
    df = collections.Counter(t for _, c, _ in counted for t in c)
    asked = collections.defaultdict(set)
    for i, t in items:
        asked[i] |= set(terms(t))
    out = collections.Counter()
    for item, wanted in asked.items():
        scores = []
        for i, c, n in counted:
            m = 100 - 90 + (90 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in wanted if c[t])
            if score > 0:
                scores.append((-score, -math.inf if i is None else i, i))
        for rank, (score, _, i) in enumerate(sorted(scores, key=lambda x: x[:2])[:top], 1):
            out[item, rank, i, -score] += 1
    return out


def ranking(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return collections.Counter(tuple(r) for r in df.collect())


def test_ranking_is_that_of_plain_scoring(odd, odd_items, tables):
    assert ranking(fp_tree_search.ranked(odd, odd_items)) == plain_ranking(pairs(odd), pairs(odd_items, "item_id"))
    docs, items = tables["documents"], tables["benchmark"]
    want = plain_ranking(pairs(docs), pairs(items, "item_id"))
    assert ranking(fp_tree_search.ranked(docs, items)) == want
    # many small trees, several blocks of items, other partitions
    assert ranking(fp_tree_search.ranked(docs.repartition(3), items, block_terms=300, tree_documents=17)) == want


def test_ranking_of_ties_takes_the_least_ids(spark):
    docs = spark.createDataFrame([(i, "same words here" if i % 3 else "other things") for i in range(200, 0, -1)], "doc_id long, text string").repartition(5)
    items = spark.createDataFrame([("a", "words")], "item_id string, text string")
    found = fp_tree_search.ranked(docs, items).orderBy("rank").collect()
    assert [r.doc_id for r in found] == [i for i in range(1, 16) if i % 3][:10]
    assert [r["rank"] for r in found] == list(range(1, 11)) and found[0].item_id == "a"


def test_ranking_without_documents_or_items(odd, odd_items):
    assert fp_tree_search.ranked(odd.where("false"), odd_items).count() == 0
    nothing = fp_tree_search.ranked(odd, odd_items.where("false"))
    assert nothing.count() == 0 and nothing.columns == ["item_id", "rank", "doc_id", "score"]


def lot(seed, n_docs, n_terms, at_most):
    random = np.random.default_rng(seed)
    sizes = random.integers(0, at_most, n_docs)
    parts = [np.unique(np.minimum(random.zipf(1.3, s), n_terms) - 1) for s in sizes]
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    held = np.concatenate(parts).astype(np.int64)
    return np.arange(n_docs, dtype=np.int64), random.integers(10, 400, n_docs), offsets, held, random.integers(1, 9, len(held)).astype(np.int64)


def test_tree_shares_paths_and_its_nodes_bound_what_is_below():
    n_terms = 300
    ids, ms, offsets, held, tfs = lot(3, 900, n_terms, 40)
    df = np.bincount(held, minlength=n_terms)
    rank = np.empty(n_terms, dtype=np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(n_terms)
    tree = fp_tree_search.grow(ids, ms, offsets, held, tfs, rank, bins=64)
    assert sorted(tree.ids) == list(ids)
    rows = [list(rank[tree.terms[tree.offsets[i] : tree.offsets[i + 1]]]) for i in range(len(ids))]
    assert all(r == sorted(r) for r in rows) and rows == sorted(rows)
    for v in range(len(tree.first)):
        inside = slice(tree.offsets[tree.first[v]], tree.offsets[tree.last[v]])
        want = np.zeros(64, dtype=np.int64)
        np.maximum.at(want, tree.terms[inside] % 64, tree.tfs[inside])
        assert (tree.tf[v] == want).all() and tree.m[v] == tree.ms[tree.first[v] : tree.last[v]].min()
        kids = range(tree.child[v], tree.child_end[v])
        if kids:
            assert [tree.first[c] for c in kids] + [tree.last[kids[-1]]] == [tree.first[v]] + [tree.last[c] for c in kids]
        else:
            assert tree.last[v] - tree.first[v] <= fp_tree_search.LEAF_DOCUMENTS


def test_bounds_leave_out_subtrees_and_lose_nothing():
    n_terms = 3_000
    ids, ms, offsets, held, tfs = lot(4, 4_000, n_terms, 60)
    df = np.bincount(held, minlength=n_terms)
    rank = np.empty(n_terms, dtype=np.int64)
    rank[np.argsort(-df, kind="stable")] = np.arange(n_terms)
    weight = np.array([math.floor(1000 * math.log((2 * 4_000 + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)
    tree = fp_tree_search.grow(ids, ms, offsets, held, tfs, rank)
    scored = 0
    for seed in range(20):
        own = held[offsets[seed * 50] : offsets[seed * 50 + 1]]
        wanted = np.unique(np.concatenate([own, np.random.default_rng(seed).integers(0, n_terms, 5)]))
        by_term = np.zeros(n_terms, dtype=np.int64)
        by_term[wanted] = weight[wanted]
        best = []
        scored += fp_tree_search.search(tree, wanted, weight[wanted], by_term, best, 10)
        gains = np.append(fp_tree_search.gain(tfs, np.repeat(ms, np.diff(offsets))) * by_term[held], 0)
        plain = [int(gains[offsets[i] : offsets[i + 1]].sum()) for i in range(len(ids))]
        want = sorted(((s, -i) for i, s in enumerate(plain) if s > 0), reverse=True)[:10]
        assert sorted(best, reverse=True) == want
    assert scored < 0.6 * 20 * len(ids)


# --- decontamination


def plain_leaks(docs, items, size=decontamination.WINDOW):
    spelled = [("" if i is None else str(i), terms(t)) for i, t in items]
    out = []
    for i, text in docs:
        ws = terms(text)
        hit, named = set(), set()
        for item, iw in spelled:
            n = min(size, len(iw))
            grams = {tuple(iw[k : k + n]) for k in range(len(iw) - n + 1)} if n else set()
            for p in range(len(ws) - n + 1) if n else []:
                if tuple(ws[p : p + n]) in grams:
                    hit.update(range(p, p + n))
                    named.add(item)
        out.append((i, text, ws, hit, named))
    return out


def digest(rows):
    return collections.Counter((i, len(ws), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)) for i, _, ws, hit, named in rows)


def test_hit_words_are_those_of_plain_search(odd, odd_items, tables):
    want = digest(plain_leaks(pairs(odd), pairs(odd_items, "item_id")))
    got = decontamination.contamination(odd, odd_items)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert collections.Counter(map(tuple, got.collect())) == want
    assert collections.Counter(map(tuple, decontamination.contamination(odd, odd_items, block_anchors=12).collect())) == want
    docs, items = tables["documents"], tables["benchmark"]
    found = decontamination.contamination(docs, items)
    want = digest(plain_leaks(pairs(docs), pairs(items, "item_id")))
    assert collections.Counter(map(tuple, found.collect())) == want
    assert any(x[5] for x in want) and not all(x[5] for x in want)


@pytest.mark.parametrize("window", [1, 2, 3, 7, 10, 13])
def test_any_window_is_found_wherever_it_begins(spark, window):
    random = np.random.default_rng(window)
    word = lambda n: " ".join(f"v{k}" for k in random.integers(0, 3 if window > 2 else 40, n))
    items = spark.createDataFrame([(i, word(int(random.integers(1, 30)))) for i in range(4)], "item_id long, text string")
    docs = spark.createDataFrame([(i, word(int(random.integers(0, 60)))) for i in range(40)], "doc_id long, text string")
    got = decontamination.contamination(docs, items, window=window)
    assert collections.Counter(map(tuple, got.collect())) == digest(plain_leaks(pairs(docs), pairs(items, "item_id"), window))


def test_spans_or_documents_are_removed(odd, odd_items):
    plain = plain_leaks(pairs(odd), pairs(odd_items, "item_id"))
    kept = decontamination.decontaminated(odd, odd_items, remove="documents")
    assert kept.columns == odd.columns
    assert collections.Counter(pairs(kept)) == collections.Counter((i, t) for i, t, _, hit, _ in plain if not hit)
    cleaned = decontamination.decontaminated(odd, odd_items)
    assert cleaned.columns == odd.columns

    def without(text, hit):
        if not hit:
            return text
        ends = [m.end() for m in TERM.finditer(text)]
        pieces = [text[a:b] for a, b in zip([0, *ends], ends)]
        return "".join(p for k, p in enumerate(pieces) if k not in hit) + text[ends[-1] :]

    assert collections.Counter(pairs(cleaned)) == collections.Counter((i, without(t, hit)) for i, t, _, hit, _ in plain)
    with pytest.raises(ValueError):
        decontamination.decontaminated(odd, odd_items, remove="lines")


def test_leaks_without_documents_or_items(odd, odd_items):
    assert decontamination.contamination(odd.where("false"), odd_items).count() == 0
    none = decontamination.contamination(odd, odd_items.where("false")).collect()
    assert len(none) == len(ODD) and not any(r.contaminated or r.n_hit or r.n_items for r in none)


def test_decontamination_runs_in_the_jvm(tables):
    plan = decontamination.contamination(tables["documents"], tables["benchmark"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan and "BroadcastHashJoin" in plan


# --- filter audit


def plain_masks(docs, labels):
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    out = collections.defaultdict(list)
    for i, text, lang in docs:
        text = text or ""
        ws = WORD.findall(text)
        fails = [len(ws) < 100, 100 * len(set(ws)) < 80 * len(ws), 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text), bool(re.search(r"[#$%&*|]", text)), i is not None and i > least[text]]
        out[lang or ""].append((dict(zip("ABCDE", fails)), i in good, i in toxic))
    return out


def plain_audit(docs, labels):
    rows, removals = [], collections.Counter()
    for part, members in plain_masks(docs, labels).items():
        for order in itertools.permutations("ABCDE"):
            left = members
            for step, f in enumerate(order, 1):
                removed = [x for x in left if x[0][f]]
                left = [x for x in left if not x[0][f]]
                redundant = sum(x[0][f] for x in members) - len(removed)
                alone = sum(x[0][f] and sum(x[0].values()) == 1 for x in members)
                rows.append((part, "".join(order), step, f, len(left), len(removed), redundant, alone, sum(x[1] for x in removed), sum(x[2] for x in removed)))
                removals[part, f] += len(removed)
    return collections.Counter((*r[:3], *r[4:], removals[r[0], r[3]]) for r in rows)


FIGURES = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize("broadcast_words", [filter_audit.BROADCAST_WORDS, 0])
def test_audit_is_that_of_plain_filtering(odd, some_labels, tables, broadcast_words):
    for docs, labels in [(odd, some_labels), (tables["documents"], tables["labels"])]:
        got = filter_audit.audited(docs, labels, broadcast_words=broadcast_words)
        assert got.columns == FIGURES
        rows = [tuple(r) for r in docs.select("doc_id", "text", "lang").collect()]
        want = plain_audit(rows, [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()])
        assert collections.Counter(map(tuple, got.collect())) == want


def test_prepass_clears_most_unique_texts_and_no_copy(spark):
    texts = [f"text {i}" for i in range(4_000)] + ["copy"] * 2_000 + [f"pair {i % 300}" for i in range(600)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").selectExpr("doc_id", "text", "xxhash64(text) as h")
    n_words = len(texts) // filter_audit.TEXTS_PER_WORD
    flagged = filter_audit.with_possible_repeats(rows, filter_audit.repeat_filter(rows, n_words), n_words, True)
    maybe = {r.text: r.maybe for r in flagged.collect()}
    assert maybe["copy"] and all(maybe[f"pair {i}"] for i in range(300))
    assert sum(maybe[f"text {i}"] for i in range(4_000)) < 400


def test_audit_of_no_documents(odd, some_labels):
    assert filter_audit.audited(odd.where("false"), some_labels).count() == 0
    assert filter_audit.audited(odd, some_labels.where("false")).count() == 4 * 120 * 5


def test_registered_queries_read_whole_tables(spark, sf_dir, tables):
    assert queries.op12_decontamination(spark, sf_dir).count() == tables["documents"].count()
    assert queries.op13_filter_audit(spark, sf_dir).groupBy("filter_order", "step").count().count() == 600
