"""Token counts by offset-mapped attribution: documents are encoded once, tokens are then dealt to sections.

A document is its fields, in order, each followed by a separator; the last field is cut into lines. Fields
and lines are the sections, and a separator or line end belongs to the section before it. The tokenizer is
a byte-level BPE, whose tokens' byte lengths add up to the text, so the offsets of all tokens come from one
encoding of the whole document; they are turned into character offsets (a token that holds part of a
character spans that character). Sections tile the text, so the interval join of tokens and sections is a
search among the section ends.

A token that lies in several sections is allocated by `rule`:
  first  to the section of its first character
  last   to the section of its last character
  most   to the section that holds most of its characters, the earliest of equals
  share  to each in proportion to its characters (counts are then fractions)

Defined results: null fields are empty and keep their separator; a section may be empty and then has no
tokens; the empty text is one empty line. Repeated rows are counted one by one. An empty table gives none.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FIELDS = ("source", "lang", "text")
SEPARATOR = " "
RULES = ("first", "last", "most", "share")
SCHEMA = "doc_id long, n_tokens long, n_sections long, n_crossing long, field_tokens array<double>, line_tokens array<double>"


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@cache
def _encoding(path: str):
    """The tokenizer and the byte length of each of its ids; read once per worker."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(text: str, path: str) -> np.ndarray:
    """Character start and end of every token, as two rows."""
    encoding, lengths = _encoding(path)
    ends = np.cumsum(lengths[np.array(encoding.encode_ordinary(text), dtype=np.int64)])
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)[: len(ends)]
    data = np.frombuffer(text.encode(), dtype=np.uint8)
    if len(data) == len(text):
        return np.stack([starts, ends])
    leads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    # characters begun before a byte; at a byte inside a character, that character counts as begun
    begun = leads[starts]
    inside = (data[starts] & 0xC0) == 0x80 if len(starts) else np.zeros(0, bool)
    return np.stack([begun - inside, leads[ends]])


def allocated(spans: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, int]:
    """Tokens per section, where section i spans ends[i - 1] to ends[i]; and how many tokens cross an end."""
    counts = np.zeros(len(ends))
    if not spans.shape[1]:
        return counts, 0
    # side="right" skips empty sections: a character belongs to the first section that ends behind it
    low = np.searchsorted(ends, spans[0], side="right")
    high = np.searchsorted(ends, spans[1] - 1, side="right")
    crossing = low != high
    if rule == "last":
        np.add.at(counts, high, 1)
        return counts, int(crossing.sum())
    if rule == "first":
        np.add.at(counts, low, 1)
        return counts, int(crossing.sum())
    np.add.at(counts, low[~crossing], 1)
    for k in np.flatnonzero(crossing):
        a, b = spans[:, k]
        inside = np.minimum(ends[low[k] : high[k] + 1], b) - np.maximum(np.concatenate([[a], ends[low[k] : high[k]]]), a)
        if rule == "most":
            counts[low[k] + int(np.argmax(inside))] += 1
        else:
            counts[low[k] : high[k] + 1] += inside / (b - a)
    return counts, int(crossing.sum())


def attributed(
    docs: DataFrame, fields: Sequence[str] = FIELDS, rule: str = "most", separator: str = SEPARATOR, path: str | None = None
) -> DataFrame:
    """doc_id, n_tokens, n_sections, n_crossing, field_tokens (one per field) and line_tokens (one per line of the last field)."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = path or vocabulary_path()
    # columns by place: the frame may hold others of any name
    narrow = docs.select(F.col("doc_id").alias("id"), *[F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"f{i}") for i, f in enumerate(fields)])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for doc_id, *parts in batch.itertuples(index=False):
                lines = parts[-1].split("\n")
                sizes = [len(p) + len(separator) for p in parts[:-1]] + [len(x) + 1 for x in lines]
                sizes[-1] -= 1
                spans = token_spans("".join(p + separator for p in parts[:-1]) + parts[-1], path)
                counts, crossing = allocated(spans, np.cumsum(sizes), rule)
                k = len(parts) - 1
                out.append((doc_id, spans.shape[1], len(sizes), crossing, [*counts[:k], counts[k:].sum()], counts[k:]))
            yield pd.DataFrame(out, columns=["doc_id", "n_tokens", "n_sections", "n_crossing", "field_tokens", "line_tokens"]).astype({"doc_id": "Int64"})

    return narrow.mapInPandas(count, SCHEMA)
