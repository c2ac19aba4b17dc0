"""Mixing sources to target weights: fixed-length blocks drawn by multinomial counts and index permutations.

Each source's words, documents in doc_id order, form one stream that is cut into blocks of `block_words`.
Every output shard draws how many of its slots each source fills. A source numbers its slots through all
shards; a pseudorandom permutation of its block indexes turns the slot's number into a block, so a source
is read through once before any of its blocks comes again. Slots and blocks are joined by that index.

A source's quota of blocks comes from its target: whole passes, then the rest rounded to blocks. Draws
beyond a quota are void, and one last shard holds what the draws left short, so the mix meets every
target to within one and a half blocks of words and takes no document more than `most_repeats` times its
size. All choices are hashes of the seed and of numbers; reruns agree.

Only built-in functions run. What reaches the driver is one row per source. The sums before a document in
its source come from value ranges (`prefix_sums`), so a source that holds a third of all rows is spread.

Defined results: null text has size 0, and nothing is taken of it. Null is a source of its own, the last.
Rows that repeat a doc_id within a source are one document of the largest size. A null doc_id comes first.
Without any word every target is 0. Equal remainders need no tie rule, since each source is rounded alone.
"""

from __future__ import annotations

from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from yieldloom.llm.wording import n_words, words
from yieldloom.operators.ranking import prefix_sums
from yieldloom.sources.workspace import settled

BLOCK_WORDS = 128
SHARD_SLOTS = 8192
WEIGHTS = (1, 2, 3)
MOST_REPEATS = 3
SEED = 17
LEAST_ID = -(2**63)
# Odd multipliers below 2**26, so that their product with an index below 2**37 stays a long.
ROUNDS = (48271131, 39373367, 57885161, 30402457)


@dataclass(frozen=True)
class Share:
    """A source's part of the mix; numbers in words, `quota` in blocks."""

    source: str | None
    size: int
    target: Fraction
    blocks: int
    passes: int
    extra: int

    @property
    def quota(self) -> int:
        return self.passes * self.blocks + self.extra


def shares(sizes: dict[str | None, int], block_words: int = BLOCK_WORDS, weights=WEIGHTS, most_repeats: int = MOST_REPEATS) -> list[Share]:
    """Targets for sources in code-point order, null last; what a full source can't take is shared out again by weight."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = Fraction(sum(sizes.values())), set(names), {}
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if unit * weight[s] > most_repeats * sizes[s]}
        for s in full or open_:
            target[s] = Fraction(most_repeats * sizes[s]) if full else unit * weight[s]
            left -= target[s]
        open_ -= full or set(open_)
    out = []
    for s in names:
        size = sizes[s]
        blocks = -(-size // block_words)
        passes = int(target[s] // size) if size else 0
        extra = min(blocks, round((target[s] - passes * size) / block_words)) if size else 0
        out.append(Share(s, size, target[s], blocks, passes, extra))
    return out


def alias_table(counts: list[int]) -> tuple[list[float], list[int]]:
    """Walker's tables: column i keeps a draw with probability keep[i], else gives it to other[i]."""
    n, total = len(counts), sum(counts)
    scaled = [Fraction(c * n, total) for c in counts]
    keep, other = [1.0] * n, list(range(n))
    small, large = [i for i in range(n) if scaled[i] < 1], [i for i in range(n) if scaled[i] >= 1]
    while small and large:
        i, j = small.pop(), large[-1]
        keep[i], other[i] = float(scaled[i]), j
        scaled[j] -= 1 - scaled[i]
        if scaled[j] < 1:
            small.append(large.pop())
    return keep, other


def _numbers(values, kind: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(f"array<{kind}>")


def permuted(index: Column, n: Column, bits: Column, key: Column) -> Column:
    """A keyed bijection of 0..n-1, where 2**bits <= n: rotate, then scramble the part below 2**bits, a few times."""
    power = F.call_function("shiftleft", F.lit(1).cast("long"), bits)
    half = F.greatest(F.lit(1), F.floor((bits + 1) / 2).cast("int"))

    def scrambled(x: Column, factor: Column) -> Column:
        y = (x * factor) % power
        return F.when(x < power, y.bitwiseXOR(F.call_function("shiftright", y, half))).otherwise(x)

    # an aggregate over the rounds, as nested expressions would double with each of them
    turned = F.aggregate(_numbers(ROUNDS, "long"), index, lambda x, factor: scrambled((x + F.pmod(F.xxhash64(key, factor), n)) % n, factor))
    return turned


@dataclass(frozen=True)
class Mix:
    """placed: (source_no, doc_id, size, start), a document's place in its source's stream; drawn: (shard,
    source_no, pass, block), the slots; sources: by source_no."""

    placed: DataFrame
    drawn: DataFrame
    sources: list[Share]
    block_words: int

    def values(self, of, kind: str) -> Column:
        return F.get(_numbers([of(s) for s in self.sources], kind), F.col("source_no"))

    def covered(self) -> DataFrame:
        """Documents by the blocks they reach into: (source_no, doc_id, size, block, from_word, upto_word), block null at size 0."""
        reached = F.sequence(F.floor(F.col("start") / self.block_words), F.floor((F.col("start") + F.col("size") - 1) / self.block_words))
        df = self.placed.select("*", F.explode_outer(F.when(F.col("size") > 0, reached)).alias("block"))
        first = F.col("block") * self.block_words - F.col("start")
        return df.select(
            "source_no", "doc_id", "size", "block",
            F.greatest(F.lit(0).cast("long"), first).alias("from_word"),
            F.least(F.col("size"), first + self.block_words).alias("upto_word"),
        )

    def passes(self) -> DataFrame:
        """(source_no, doc_id, size, pass, parts): which words, as sorted (from_word, upto_word), each pass takes of a document."""
        hits = self.covered().join(self.drawn, ["source_no", "block"])
        parts = F.array_sort(F.collect_list(F.struct("from_word", "upto_word")))
        return hits.groupBy("source_no", "doc_id", "size", "pass").agg(parts.alias("parts"))


def _numbered(df: DataFrame, names: list[str | None]) -> DataFrame:
    """`source_no` for each row: by a join with the sources, which are as many rows as the driver already holds."""
    table = df.sparkSession.range(1).select(F.posexplode(_numbers(names, "string")).alias("source_no", "name"))
    return df.join(F.broadcast(table), df.source.eqNullSafe(table.name)).drop("name")


def mixed(
    docs: DataFrame,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    weights=WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    seed: int = SEED,
) -> Mix:
    spark = docs.sparkSession
    sized = docs.select("doc_id", "source", n_words(F.coalesce("text", F.lit(""))).alias("size"))
    sized = settled(sized.groupBy("doc_id", "source").agg(F.max("size").alias("size")))
    found = {r["source"]: r["size"] for r in sized.groupBy("source").agg(F.sum("size").alias("size")).collect()}
    sources = shares(found, block_words, weights, most_repeats)
    ordered = _numbered(sized, [s.source for s in sources]).select(
        "source_no", "doc_id", "size", F.coalesce("doc_id", F.lit(LEAST_ID)).alias("place")
    )
    placed = prefix_sums(ordered, ["source_no"], "place", ["size"], few_groups=True).select(
        "source_no", "doc_id", "size", F.col("size_before").alias("start")
    )
    slots = sum(s.quota for s in sources)
    if not slots:
        empty = spark.createDataFrame([], "shard long, source_no int, pass long, block long")
        return Mix(placed, empty, sources, block_words)
    keep, other = alias_table([s.quota for s in sources])
    coin = F.pmod(F.xxhash64(F.lit(seed), F.lit("coin"), "id"), F.lit(1 << 52)) / float(1 << 52)
    column = F.pmod(F.xxhash64(F.lit(seed), F.lit("column"), "id"), F.lit(len(sources))).cast("int")
    drawn_no = F.when(coin < F.get(_numbers(keep, "double"), column), column).otherwise(F.get(_numbers(other, "int"), column))
    counts = (
        spark.range(slots)
        .select(F.floor(F.col("id") / shard_slots).alias("shard"), drawn_no.alias("source_no"))
        .groupBy("shard", "source_no")
        .agg(F.count("*").alias("n"))
    )
    # shards are numbered, so their counts add up in order; few rows: one per shard and source
    counts = prefix_sums(counts, ["source_no"], "shard", ["n"], few_groups=True)
    mix = Mix(placed, counts, sources, block_words)
    quota = mix.values(lambda s: s.quota, "long")
    drawn = counts.select("shard", "source_no", F.least("n_before", quota).alias("a"), F.least(F.col("n_before") + F.col("n"), quota).alias("b"))
    short = (
        spark.range(len(sources)).select(F.col("id").cast("int").alias("source_no"))
        .join(counts.groupBy("source_no").agg(F.sum("n").alias("n")), "source_no", "left")
        .select(F.lit(-(-slots // shard_slots)).cast("long").alias("shard"), "source_no", F.least(F.coalesce("n", F.lit(0)), quota).alias("a"), quota.alias("b"))
    )
    numbers = drawn.unionByName(short).where(F.col("a") < F.col("b")).select("shard", "source_no", F.explode(F.sequence("a", F.col("b") - 1)).alias("number"))
    blocks, bits = mix.values(lambda s: s.blocks, "long"), mix.values(lambda s: max(0, s.blocks.bit_length() - 1), "int")
    numbers = numbers.withColumn("n", blocks).withColumn("bits", bits)
    pass_no = F.floor(F.col("number") / F.col("n"))
    block = permuted(F.col("number") % F.col("n"), F.col("n"), F.col("bits"), F.xxhash64(F.lit(seed), "source_no", pass_no))
    return Mix(placed, numbers.select("shard", "source_no", pass_no.alias("pass"), block.alias("block")), sources, block_words)


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target and taken, one row per document."""
    mix = mixed(docs, **options)
    times = mix.drawn.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    words_taken = F.coalesce((F.col("upto_word") - F.col("from_word")) * F.col("times"), F.lit(0))
    per_doc = mix.covered().join(times, ["source_no", "block"], "left").groupBy("source_no", "doc_id", "size").agg(F.sum(words_taken).alias("taken"))
    return per_doc.select(
        "doc_id",
        mix.values(lambda s: s.source, "string").alias("source"),
        "size",
        mix.values(lambda s: s.size, "long").alias("source_size"),
        mix.values(lambda s: float(s.target), "double").alias("target"),
        "taken",
    )


def mixed_blocks(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, one row per slot and document part: shard, source, pass, block, doc_id, from_word and the words."""
    mix = mixed(docs, **options)
    hits = mix.covered().join(mix.drawn, ["source_no", "block"]).withColumn("source", mix.values(lambda s: s.source, "string"))
    own = docs.select(F.col("doc_id").alias("own_id"), F.col("source").alias("own_source"), F.coalesce("text", F.lit("")).alias("text"))
    own = own.groupBy("own_id", "own_source").agg(F.max_by("text", n_words(F.col("text"))).alias("text"))
    same = F.col("doc_id").eqNullSafe(F.col("own_id")) & F.col("source").eqNullSafe(F.col("own_source"))
    part = F.slice(words(F.col("text")), (F.col("from_word") + 1).cast("int"), (F.col("upto_word") - F.col("from_word")).cast("int"))
    return hits.join(own, same).select("shard", "source", "pass", "block", "doc_id", "from_word", part.alias("words"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """`docs` as the mix takes them: a row for each pass that takes words of a document, holding those words.

    A pass that takes a whole document leaves its text as it is; otherwise the taken words are joined by
    one space and n_chars, where there is such a column, is their length. A document that no pass takes has
    no row, so one without words has none. Columns and their order are those of `docs`.
    """
    mix = mixed(docs, **options)
    takes = mix.passes().select(
        F.col("doc_id").alias("__id"), mix.values(lambda s: s.source, "string").alias("__source"), F.col("parts").alias("__parts"), F.col("size").alias("__size")
    )
    joined = docs.join(takes, docs.doc_id.eqNullSafe(takes["__id"]) & docs.source.eqNullSafe(takes["__source"]))
    total = F.aggregate("__parts", F.lit(0).cast("long"), lambda a, p: a + p.upto_word - p.from_word)
    joined = joined.withColumn("__words", words(F.coalesce("text", F.lit(""))))
    pieces = F.flatten(F.transform("__parts", lambda p: F.slice("__words", (p.from_word + 1).cast("int"), (p.upto_word - p.from_word).cast("int"))))
    out = joined.withColumn("text", F.when(total == F.col("__size"), F.col("text")).otherwise(F.array_join(pieces, " ")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*docs.columns)
