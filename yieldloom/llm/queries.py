"""The registered queries of this subpackage: QUERIES and, where SQL can say the same, ORACLES."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yieldloom.llm import (
    block_mixing,
    circulant_minhash,
    decontamination,
    divergence_rules,
    filter_audit,
    fp_tree_search,
    id_coder,
    merge_dropout,
    merkle,
    offset_tokens,
    ordinal_quality,
    phrase_automata,
    recurrent_lm,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_merge_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge_dropout.encoded(_table(spark, sf_dir, "documents"))


def op2_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.compared_with_edits(_table(spark, sf_dir, "documents"))


def op3_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.removals(_table(spark, sf_dir, "documents"))


def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordinal_quality.selected(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_recurrent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recurrent_lm.scored(_table(spark, sf_dir, "documents"))


def op7_block_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_mixing.taken_words(_table(spark, sf_dir, "documents")).drop("source")


def op8_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = divergence_rules.judged(_table(spark, sf_dir, "documents"))
    # distances are rounded, as engines add in different orders
    return judged.withColumns({c: F.round(c, 6) for c in ("class_distance", "word_distance")})


def op9_offset_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return offset_tokens.attributed(_table(spark, sf_dir, "documents"))


def op10_id_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_coder.encoded_ids(_table(spark, sf_dir, "documents"))


def op11_fp_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fp_tree_search.ranked(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audited(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_merge_dropout": op1_merge_dropout,
    "op2_merkle": op2_merkle,
    "op3_circulant_minhash": op3_circulant_minhash,
    "op4_phrase_automata": op4_phrase_automata,
    "op5_ordinal_quality": op5_ordinal_quality,
    "op6_recurrent_lm": op6_recurrent_lm,
    "op7_block_mixing": op7_block_mixing,
    "op8_divergence_rules": op8_divergence_rules,
    "op9_offset_tokens": op9_offset_tokens,
    "op10_id_coder": op10_id_coder,
    "op11_fp_tree": op11_fp_tree,
    "op12_decontamination": op12_decontamination,
    "op13_filter_audit": op13_filter_audit,
}


def _removed(pattern: str) -> str:
    return f"length(t) - length(regexp_replace(t, '{pattern}', '', 'g'))"


def _parts(p: str, q: str) -> str:
    """SQL for twice what a bin adds to the Jensen-Shannon divergence."""
    return f"(CASE WHEN {p} > 0 THEN {p} * log2(2 * {p} / ({p} + {q})) ELSE 0 END + CASE WHEN {q} > 0 THEN {q} * log2(2 * {q} / ({p} + {q})) ELSE 0 END)"


_CLASS_NAMES = ", ".join(f"'{name}'" for name in divergence_rules.BINS)
_CLASS_COUNTS = ", ".join(f"n_{name}" for name in divergence_rules.BINS)
RULES_SQL = rf"""
WITH d AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
        {", ".join(f"{_removed(pattern.rstrip('+'))} AS n_{name}" for name, pattern in divergence_rules.CLASSES)} FROM d),
b AS (SELECT *, len(ws) AS n_words, length(t) - n_space AS word_chars, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
        length(t) - ({" + ".join(f"n_{name}" for name, _ in divergence_rules.CLASSES)}) AS n_rest FROM w),
tri AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
dup AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM tri) WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p) AS n_repeat_words FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM dup) GROUP BY 1),
cls AS (SELECT doc_id, lang, length(t) AS size, unnest([{_CLASS_NAMES}]) AS k, unnest([{_CLASS_COUNTS}]) AS n FROM b),
spoken AS (SELECT lang, lower(x) AS word, count(*) AS n FROM (SELECT lang, unnest(ws) AS x FROM w WHERE lang IS NOT NULL) GROUP BY 1, 2),
langs AS (SELECT lang, sum(n) AS total FROM spoken GROUP BY 1 HAVING sum(n) >= {divergence_rules.LEAST_REFERENCE_WORDS}),
cref AS (SELECT lang, k, sum(n) / CAST(sum(sum(n)) OVER (PARTITION BY lang) AS DOUBLE) AS q FROM cls JOIN langs USING (lang) GROUP BY 1, 2),
cdist AS (SELECT doc_id, sqrt(greatest(0, sum({_parts("(n / CAST(size AS DOUBLE))", "q")}) / 2)) AS class_distance FROM cls JOIN cref USING (lang, k) WHERE size > 0 GROUP BY 1),
common AS (SELECT lang, word, n / CAST(total AS DOUBLE) AS q FROM (
    SELECT *, regexp_matches(word, '[0-9a-z]|[^\x00-\x7F]') AS wordlike, row_number() OVER (PARTITION BY lang ORDER BY regexp_matches(word, '[0-9a-z]|[^\x00-\x7F]') DESC, n DESC, word) AS rn FROM spoken) JOIN langs USING (lang)
  WHERE rn <= {divergence_rules.COMMON_WORDS} AND wordlike),
said AS (SELECT doc_id, lower(x) AS word, count(*) AS c FROM (SELECT doc_id, unnest(ws) AS x FROM w) GROUP BY 1, 2),
bins AS (SELECT doc_id, coalesce(c, 0) / CAST(n_words AS DOUBLE) AS p, q FROM b JOIN common USING (lang) LEFT JOIN said USING (doc_id, word) WHERE n_words > 0),
wdist AS (SELECT doc_id, sqrt(greatest(0, (sum({_parts("p", "q")}) + {_parts("(1 - sum(p))", "(1 - sum(q))")}) / 2)) AS word_distance FROM bins GROUP BY 1),
out AS (SELECT doc_id, n_words, word_chars, n_symbol AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
          CASE WHEN n_words > 0 THEN class_distance END AS class_distance, word_distance,
          n_words < 50 OR 100 * coalesce(n_repeat_words, 0) > 50 * n_words AS base_failed
        FROM b LEFT JOIN rep USING (doc_id) LEFT JOIN cdist USING (doc_id) LEFT JOIN wdist USING (doc_id))
SELECT * REPLACE (round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance),
       NOT base_failed AND NOT (n_words >= {divergence_rules.LEAST_WORDS} AND coalesce(class_distance > {divergence_rules.MOST_CLASS_DISTANCE} OR word_distance > {divergence_rules.MOST_WORD_DISTANCE}, false)) AS kept
FROM out"""
_SPLIT = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
COMPONENTS_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_SPLIT.format(text=_ASCII_LOWER)} AS ws FROM documents),
runs AS (SELECT doc_id, ws, unnest(CASE WHEN len(ws) >= 5 THEN range(1, len(ws) - 3) WHEN len(ws) > 0 THEN [1] ELSE [] END) AS i FROM w),
sets AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM runs),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY 1),
met AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM met JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * c >= {circulant_minhash.LEAST_SHARE} * (p.n + q.n - c)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT reach.x, both_ways.y FROM reach JOIN both_ways ON reach.y = both_ways.x)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1) USING (doc_id)"""
REMOVALS_SQL = f"""
WITH w AS (SELECT doc_id, {_SPLIT.format(text="coalesce(text, '')")} AS ws FROM documents),
windows AS (SELECT doc_id, i, array_to_string(ws[i:i + {phrase_automata.WINDOW - 1}], ' ') AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - {phrase_automata.WINDOW - 2})) AS i FROM w)),
found AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY g) AS c FROM windows) WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {phrase_automata.WINDOW})) AS p FROM found),
spelled AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS text FROM spelled ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id) LEFT JOIN lost USING (doc_id)"""
_TERMS = r"regexp_extract_all({text}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')".format(text=_ASCII_LOWER)
RANKING_SQL = f"""
WITH spelled AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
asked AS (SELECT DISTINCT item_id, unnest({_TERMS}) AS term FROM benchmark),
sizes AS (SELECT doc_id, count(*) AS n FROM spelled GROUP BY 1),
corpus AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
tfs AS (SELECT doc_id, term, count(*) AS tf FROM spelled SEMI JOIN asked USING (term) GROUP BY 1, 2),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, corpus GROUP BY term, docs),
ms AS (SELECT doc_id, 100 - 90 + ((90 * n * docs) // terms) AS m FROM sizes, corpus),
scores AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
           FROM asked JOIN tfs USING (term) JOIN weights USING (term) JOIN ms USING (doc_id) GROUP BY 1, 2)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= {fp_tree_search.TOP}"""
LEAKS_SQL = f"""
WITH w AS (SELECT doc_id, {_TERMS} AS ws FROM documents),
items AS (SELECT item_id, ws, least(len(ws), {decontamination.WINDOW}) AS size FROM (SELECT item_id, {_TERMS} AS ws FROM benchmark) WHERE len(ws) > 0),
grams AS (SELECT DISTINCT item_id, size, array_to_string(ws[i:i + size - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS i FROM items)),
windows AS (SELECT doc_id, size, i, array_to_string(ws[i:i + size - 1], ' ') AS g
            FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM w, (SELECT DISTINCT size FROM items) WHERE len(ws) >= size)),
found AS (SELECT doc_id, size, i, item_id FROM windows JOIN grams USING (size, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""
AUDIT_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
f AS (SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad,
        CAST(len(ws) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 80 * len(ws) AS INT)
        + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 10 * length(t) AS INT)
        + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY t) AS INT) AS mask
      FROM w LEFT JOIN labels USING (doc_id)),
masks AS (SELECT part, mask, count(*) AS n, count_if(good) AS n_good, count_if(bad) AS n_bad FROM f GROUP BY 1, 2),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS bit),
orders AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
           FROM letters a JOIN letters b ON b.x <> a.x JOIN letters c ON c.x NOT IN (a.x, b.x)
           JOIN letters d ON d.x NOT IN (a.x, b.x, c.x) JOIN letters e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
steps AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0) AS earlier
          FROM orders, (SELECT unnest(range(1, 6)) AS step)),
figures AS (SELECT part, filter_order, step, own,
    sum(CASE WHEN mask & CAST(earlier AS INT) = 0 AND mask & own = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & CAST(earlier AS INT) = 0 AND mask & own > 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & CAST(earlier AS INT) > 0 AND mask & own > 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = own THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & CAST(earlier AS INT) = 0 AND mask & own > 0 THEN n_good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & CAST(earlier AS INT) = 0 AND mask & own > 0 THEN n_bad ELSE 0 END) AS toxic_lost
  FROM masks, steps GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
    CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM figures"""
ORACLES: dict[str, str] = {
    "op3_circulant_minhash": COMPONENTS_SQL,
    "op4_phrase_automata": REMOVALS_SQL,
    "op8_divergence_rules": RULES_SQL,
    "op11_fp_tree": RANKING_SQL,
    "op12_decontamination": LEAKS_SQL,
    "op13_filter_audit": AUDIT_SQL,
}
