"""Problem 8: mixing sources to target weights.

Documents are laid end to end within their source, in hashed order, and cut into blocks of BLOCK tokens; a source's last
block is as short as it comes.  The mix is planned for a budget of tokens, by default all that the target sources
have: a source gives its share of the budget, or what its documents give when each is used max_repeats times, if that is
less; ``p8_shares`` reports both.  Each output shard of SHARD_BLOCKS blocks draws its source counts from the multinomial
distribution, conditioned on the sources' totals so that the shares come out exact: a binary tree over the
shards splits each source's blocks binomially at every node, the same way at every size, and a shard's counts are read
down its own path, so no list of shards is held anywhere.  A source's slots are numbered through all shards, slot j is
pass j div n over the source's n blocks, and within a pass a pseudorandom permutation of the block index (a Feistel
network) says which block it takes.  Blocks join their slots by index, with their token ids; a text is encoded once for
its length, which its place depends on, and again when it is cut, so that no tokens are stored in between.

A block is used once a pass at most, so no document is used more often than its source's ``max_repeats``.  A source
without documents, or a document without a target, adds nothing; its share is reported as 0.  NULL and empty
texts have no tokens.  The tokenizer's file is given to the executors by Spark; its path is a parameter."""

from __future__ import annotations

import base64
import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.functions.arrow import arrow_schema
from vellum.sources.tables import checkpoint, table

TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
# Fixed value: how the vocabulary's byte-level BPE splits a text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK = 512
SHARD_BLOCKS = 1024  # blocks of a shard
SEED = 17


@functools.cache
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _give(spark: SparkSession, path: str) -> str:
    """Ships the tokenizer's file to the executors; its name there."""
    spark.sparkContext.addFile(path)
    return os.path.basename(path)


def _given(name: str):
    from pyspark import SparkFiles

    return _encoding(SparkFiles.get(name))


def count_tokens(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, source, text_key, n_tokens of documents (doc_id, source, text); text_key: hash of the text."""

    name = _give(documents.sparkSession, tokenizer)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _given(name).encode_ordinary
        for b in batches:
            n = [len(encode(t)) if t else 0 for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), b.column("text_key"), pa.array(n, type=pa.int64())], names=["doc_id", "source", "text_key", "n_tokens"])

    return documents.select("doc_id", "source", F.xxhash64("text").alias("text_key"), "text").mapInArrow(run, "doc_id BIGINT, source STRING, text_key BIGINT, n_tokens BIGINT")


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Running sum of n_tokens by source over a sorted partition."""
    source, run = None, 0
    for b in batches:
        out = []
        for s, n in zip(b.column("source").to_pylist(), b.column("n_tokens").to_pylist()):
            source, run = s, (run if s == source else 0) + n
            out.append(run)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, type=pa.int64())], names=[*b.schema.names, "run"])


def lay_out(sized: DataFrame) -> DataFrame:
    """source, doc_id, text_key, n_tokens, start: each document's place on its source's tape, in hashed order.  Range partitions
    and their offsets: no source is held by one task."""
    order = ["source", "h", "doc_id", "text_key"]
    keyed = sized.filter("n_tokens > 0").withColumn("h", F.xxhash64("doc_id", F.lit(SEED)))
    parts = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select(F.spark_partition_id().alias("part"), "source", "doc_id", "text_key", "n_tokens")
    tape = checkpoint(parts.mapInArrow(_running, "part INT, source STRING, doc_id BIGINT, text_key BIGINT, n_tokens BIGINT, run BIGINT"))
    # one row per partition and source; a source takes consecutive partitions
    ends = tape.groupBy("source", "part").agg(F.max("run").alias("end"))
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select("source", "part", F.coalesce(F.sum("end").over(before), F.lit(0)).alias("offset"))
    return tape.join(offsets, ["source", "part"]).select("source", "doc_id", "text_key", "n_tokens", (F.col("offset") + F.col("run") - F.col("n_tokens")).alias("start"))


def plan(available: dict[str, int], targets: list[tuple[str, float, int]], budget: int | None = None) -> dict[str, tuple[int, int]]:
    """source -> (its blocks, blocks drawn) of the sources with a target and a token; ``budget``: tokens of the mix."""
    have = {s: (available[s], share, rep) for s, share, rep in targets if share and share > 0 and rep and rep > 0 and available.get(s, 0) > 0}
    total = sum(n for n, _, _ in have.values()) if budget is None else budget
    out = {}
    for s, (n, share, rep) in have.items():
        blocks = -(-n // BLOCK)
        want = min(share * total, n * rep)
        # whole passes give all tokens of the source, the rest blocks of about BLOCK
        passes = int(want // n)
        out[s] = (blocks, min(passes * blocks + int(round((want - passes * n) / (n / blocks))), blocks * rep))
    return out


def split_counts(counts: np.ndarray, size: int, left: int, rng: np.random.Generator) -> np.ndarray:
    """The part of ``counts`` (summing to ``size``) that falls to the first ``left`` slots: binomial for each source,
    the surplus or lack against ``left`` taken from or given to all in proportion."""
    out = rng.binomial(counts, left / size) if size else np.zeros_like(counts)
    while over := int(out.sum()) - left:
        room = out if over > 0 else counts - out
        move = np.minimum(rng.multinomial(abs(over), room / room.sum()), room)
        out = out - move if over > 0 else out + move
    return out


class Shards:
    """The source counts of the shards of a mix and the sources' first slots in them, found by descent in a binary tree."""

    def __init__(self, counts: list[int], seed: int = SEED):
        self.counts, self.seed = np.array(counts, dtype=np.int64), seed
        self.total = int(self.counts.sum())
        self.shards = -(-self.total // SHARD_BLOCKS)
        self.path: list[tuple[int, int, np.ndarray, np.ndarray]] = []  # last shard's path: (low, high, counts, first)

    def of(self, shard: int) -> tuple[np.ndarray, np.ndarray]:
        """(counts, first slots) of one shard; consecutive shards share most of their path."""
        while self.path and not self.path[-1][0] <= shard < self.path[-1][1]:
            self.path.pop()
        if not self.path:
            self.path.append((0, self.shards, self.counts, np.zeros_like(self.counts)))
        while self.path[-1][1] - self.path[-1][0] > 1:
            low, high, counts, first = self.path[-1]
            mid = (low + high) // 2
            size = int(counts.sum())
            left = split_counts(counts, size, min(size, (mid - low) * SHARD_BLOCKS), np.random.default_rng([self.seed, low, high]))
            self.path.append((low, mid, left, first) if shard < mid else (mid, high, counts - left, first + left))
        return self.path[-1][2], self.path[-1][3]


def permute(i: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of 0..n-1 at ``i``: a four-round Feistel network, walked until it falls below n."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for r in range(4):
            f = (right + np.uint64((key * 4 + r) & 0xFFFFFFFF)) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((f >> np.uint64(32)) & mask)
        return (left << half) | right

    x = once(i.astype(np.uint64))
    while (far := x >= n).any():
        x[far] = once(x[far])
    return x.astype(np.int64)


def _choose(names: list[str], blocks: list[int], counts: list[int], seed: int):
    """The slots of each shard number: shard, source, pass, block."""
    schema = arrow_schema("shard BIGINT, source STRING, pass INT, block BIGINT")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = Shards(counts, seed)
        for b in batches:
            for shard in b.column("id").to_pylist():
                drawn, first = tree.of(shard)
                for i in np.flatnonzero(drawn).tolist():
                    n, j = blocks[i], first[i] + np.arange(drawn[i], dtype=np.int64)
                    times, block = j // n, np.empty(len(j), dtype=np.int64)
                    for p in np.unique(times).tolist():
                        at = times == p
                        block[at] = permute(j[at] % n, n, seed + 1000 * i + p)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(j), shard, dtype=np.int64)), pa.array([names[i]] * len(j)), pa.array(times.astype(np.int32)), pa.array(block)], schema=schema)

    return run


def _cut(name: str):
    """Pieces of documents (source, doc_id, start, text), cut where their source's blocks end, with their token ids."""
    names = ["source", "block", "doc_id", "from_token", "n_tokens", "at_token", "tokens"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _given(name).encode_ordinary
        for whole in batches:
            for k in range(0, len(whole), 1000):
                rows, ids = [], []
                for source, doc_id, start, text in zip(*(c.to_pylist() for c in whole.slice(k, 1000).columns)):
                    tokens = encode(text)
                    ids.append(np.array(tokens, dtype=np.int32))
                    for block in range(start // BLOCK, (start + len(tokens) - 1) // BLOCK + 1):
                        a, b = max(start, block * BLOCK), min(start + len(tokens), (block + 1) * BLOCK)
                        rows.append((source, block, doc_id, a - start, b - a, a - block * BLOCK))
                columns = list(zip(*rows))
                types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
                # a document's pieces follow one another, so all its tokens are theirs
                offsets = np.concatenate([[0], np.cumsum(columns[4])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids)))
                yield pa.RecordBatch.from_arrays([*(pa.array(c, type=t) for c, t in zip(columns, types)), lists], names=names)

    return run


def _pieces(tape: DataFrame) -> DataFrame:
    """Pointers of the pieces: source, block, doc_id, from_token, n_tokens, at_token."""
    cut = tape.select("source", "doc_id", "n_tokens", "start", F.explode(F.sequence(F.expr(f"start div {BLOCK}"), F.expr(f"(start + n_tokens - 1) div {BLOCK}"))).alias("block"))
    a, b = F.greatest(F.col("start"), F.col("block") * BLOCK), F.least(F.col("start") + F.col("n_tokens"), (F.col("block") + 1) * BLOCK)
    return cut.select("source", "block", "doc_id", (a - F.col("start")).alias("from_token"), (b - a).alias("n_tokens"), (a - F.col("block") * BLOCK).alias("at_token"))


def _token_pieces(docs: DataFrame, tape: DataFrame, tokenizer: str) -> DataFrame:
    """``_pieces`` with their token ids.  A document that stands there more than once takes each of its places once."""
    key = ["source", "doc_id", "text_key"]
    again = Window.partitionBy(*key)
    texts = docs.filter("text <> ''").withColumn("text_key", F.xxhash64("text")).withColumn("copy", F.row_number().over(again.orderBy(F.lit(0))))
    places = tape.select(*key, "start").withColumn("copy", F.row_number().over(again.orderBy("start")))
    # both grow with the data, as below
    both = texts.hint("merge").join(places.hint("merge"), [*key, "copy"]).select("source", "doc_id", "start", "text")
    return both.mapInArrow(_cut(_give(docs.sparkSession, tokenizer)), "source STRING, block BIGINT, doc_id BIGINT, from_token BIGINT, n_tokens BIGINT, at_token BIGINT, tokens ARRAY<INT>")


def _mixed(spark: SparkSession, data_dir: str, tokenizer: str, budget: int | None, payload: bool):
    clean = F.lower(F.trim(F.col("source")))
    targets = table(spark, data_dir, "mix_targets").select(clean.alias("source"), "target_share", "max_repeats").filter("source is not null")
    docs = table(spark, data_dir, "documents").select("doc_id", clean.alias("source"), "text").filter("doc_id is not null")
    # the targets are the mix's parameters, a row a source
    wanted = [(r.source, r.target_share, r.max_repeats) for r in targets.collect()]
    docs = docs.filter(F.col("source").isin([s for s, _, _ in wanted]))
    tape = lay_out(checkpoint(count_tokens(docs, tokenizer)))
    available = {r.source: r.n for r in tape.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}
    drawn = plan(available, wanted, budget)
    names = sorted(drawn)
    shards = Shards([drawn[s][1] for s in names]).shards if names else 0
    choose = _choose(names, [drawn[s][0] for s in names], [drawn[s][1] for s in names], SEED)
    slots = spark.range(shards).mapInArrow(choose, "shard BIGINT, source STRING, pass INT, block BIGINT")
    pieces = _token_pieces(docs, tape, tokenizer) if payload else _pieces(tape)
    # both sides grow with the data, whatever their estimated size: never broadcast one
    mix = slots.hint("merge").join(pieces.hint("merge"), ["source", "block"]).select("shard", F.xxhash64("source", "block", "pass", F.lit(SEED)).alias("slot_key"), "source", "block", "pass", "doc_id", "from_token", "n_tokens", "at_token", *["tokens"] * payload)
    return mix, targets, available


def p8_mix(spark: SparkSession, data_dir: str, tokenizer: str = TOKENIZER, budget: int | None = None) -> DataFrame:
    """The mix: for each block of each shard (in the order of slot_key) the pieces of documents it is made of -
    doc_id, from_token, n_tokens, at_token, where the piece stands in the block, and tokens, its token ids."""
    return _mixed(spark, data_dir, tokenizer, budget, True)[0]


def p8_blocks(spark: SparkSession, data_dir: str, tokenizer: str = TOKENIZER, budget: int | None = None) -> DataFrame:
    """shard, slot_key, source, block, pass, tokens: the mix as blocks of BLOCK token ids."""
    pieces = F.array_sort(F.collect_list(F.struct("at_token", "tokens")))
    return p8_mix(spark, data_dir, tokenizer, budget).groupBy("shard", "slot_key", "source", "block", "pass").agg(F.flatten(F.transform(pieces, lambda p: p["tokens"])).alias("tokens"))


def p8_pointers(spark: SparkSession, data_dir: str, tokenizer: str = TOKENIZER, budget: int | None = None) -> DataFrame:
    """The mix without its token ids: where each piece stands, and in which document."""
    return _mixed(spark, data_dir, tokenizer, budget, False)[0]


def p8_shares(spark: SparkSession, data_dir: str, tokenizer: str = TOKENIZER, budget: int | None = None) -> DataFrame:
    """source, target_share, max_repeats, tokens_available, tokens, share, budget_share, most_used: what each source really
    gives, of the tokens of the mix and of its budget, and how often its most used document occurs.  A source whose
    documents are all used max_repeats times falls short of its target in the latter."""
    mix, targets, available = _mixed(spark, data_dir, tokenizer, budget, False)
    # a document's pieces lie in several blocks; each place of it is used once a pass
    used = mix.groupBy("source", "doc_id", "from_token").agg(F.count("*").alias("times"), F.sum("n_tokens").alias("n")).groupBy("source").agg(F.max("times").alias("most_used"), F.sum("n").alias("tokens"))
    have = spark.createDataFrame([*available.items()], "source STRING, tokens_available BIGINT")
    out = targets.join(have, "source", "left").join(used, "source", "left").na.fill(0, ["tokens_available", "tokens", "most_used"])
    # a row per target: one small window
    every = Window.partitionBy()
    whole = F.sum("tokens_available").over(every) if budget is None else F.lit(budget)
    share = lambda n: F.coalesce(F.try_divide(F.col("tokens"), n), F.lit(0.0))
    return out.select("source", "target_share", "max_repeats", "tokens_available", "tokens", share(F.sum("tokens").over(every)).alias("share"), share(whole).alias("budget_share"), "most_used")
