"""Mixing sources to target shares of the total size in tokens.

The tokens of each source are packed into blocks of one length. The largest mixture in which every source gives its share
and none is read more often than allowed fixes the blocks that each gives; every output shard draws its counts by source
from a multinomial, and what a source was drawn too often over all shards goes to those drawn too seldom. A slot's number
within its source goes through a pseudorandom permutation of the source's block numbers, a new one for each reading, and
the blocks are joined by that number.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.tokens import token_ids
from millrace.plans.lineage import cut
from millrace.sources.tables import small_rows

#: Tokens of a block; blocks of an output shard, about; shards in one bucket of the prefix sum.
BLOCK_TOKENS, SHARD_BLOCKS, SHARD_BUCKET = 512, 1_024, 1_024
#: Documents of a source in one bucket of the prefix sum, about.
BUCKET_DOCS = 100_000
#: A mixture names at most so many sources.
MOST_SOURCES = 10_000
SEED = 20_240


class Plan(NamedTuple):
    #: by source: share wanted, tokens there, blocks there, blocks to give
    source: list[str]
    share: np.ndarray
    repeats: np.ndarray
    tokens: np.ndarray
    blocks: np.ndarray
    give: np.ndarray


def sizes(documents: DataFrame, targets: DataFrame, folder: str | None = None) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents of sources with a share; those without tokens are left out."""
    wanted = [r.source for r in small_rows(targets.where("source is not null").select("source").distinct(), MOST_SOURCES, "mix_targets")]
    return cut(token_ids(documents.where(F.col("source").isin(wanted)), "doc_id", "text", folder=folder, counts=True, keep=("source",)).where("n_tokens > 0"))


def quotas(share: np.ndarray, blocks: np.ndarray, repeats: np.ndarray) -> np.ndarray:
    """Blocks that each source gives in the largest mixture with these shares and at most ``repeats`` readings.

    Shares of sources without blocks go to the others in proportion. Rounded to whole blocks by largest remainders,
    within the limits.
    """
    there = (blocks > 0) & (share > 0) & (repeats > 0)
    if not there.any():
        return np.zeros(len(share), np.int64)
    q = np.where(there, share, 0.0) / share[there].sum()
    limit = np.where(there, blocks * repeats, 0)
    total = int(np.floor((limit[there] / q[there]).min() + 1e-9))
    exact = q * total
    give = np.minimum(np.floor(exact + 1e-9).astype(np.int64), limit)
    for k in np.argsort(-(exact - give), kind="stable")[: max(0, total - int(give.sum()))]:
        give[k] += give[k] < limit[k]
    return give


def plan(spark: SparkSession, size: DataFrame, targets: DataFrame) -> Plan:
    """The plan from the sources' totals, one row for each of ``targets``."""
    wanted = small_rows(targets.where("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats")).orderBy("source"), MOST_SOURCES, "mix_targets")
    totals = {r.source: r.n for r in size.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()}  # at most as many as targets
    source = [r.source for r in wanted]
    share = np.array([r.share or 0.0 for r in wanted], float)
    repeats = np.array([r.repeats or 0 for r in wanted], np.int64)
    tokens = np.array([totals.get(s, 0) for s in source], np.int64)
    blocks = -(-tokens // BLOCK_TOKENS)
    return Plan(source, share, repeats, tokens, blocks, quotas(share, blocks, repeats))


def pieces(size: DataFrame) -> DataFrame:
    """(source, block, at, doc_id, first, n): the tokens of a document, from its token ``first`` on, that lie in a block from
    its place ``at`` on.

    Where a document's tokens begin in its source is a prefix sum in two steps: sums of hash buckets, then within each
    bucket, so that a source of any size is spread over many tasks.
    """
    buckets = max(16, size.count() // BUCKET_DOCS)
    b = size.withColumn("bucket", F.expr(f"int(pmod(xxhash64(doc_id), {buckets}))"))
    sums = b.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("n"))
    offsets = sums.select("source", "bucket", (F.sum("n").over(Window.partitionBy("source").orderBy("bucket")) - F.col("n")).alias("offset"))
    own = Window.partitionBy("source", "bucket").orderBy("doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = b.withColumn("up_to", F.sum("n_tokens").over(own)).join(offsets, ["source", "bucket"])
    at = placed.select("source", "doc_id", (F.col("offset") + F.col("up_to") - F.col("n_tokens")).alias("a"), (F.col("offset") + F.col("up_to")).alias("b"))
    cuts = at.select("source", "doc_id", "a", "b", F.explode(F.sequence(F.expr(f"a div {BLOCK_TOKENS}"), F.expr(f"(b - 1) div {BLOCK_TOKENS}"))).alias("block"))
    low, high = F.greatest("a", F.col("block") * BLOCK_TOKENS), F.least("b", (F.col("block") + 1) * BLOCK_TOKENS)
    return cuts.select("source", "block", (low - F.col("block") * BLOCK_TOKENS).alias("at"), "doc_id", (low - F.col("a")).alias("first"), (high - low).alias("n"))


def permuted(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A pseudorandom permutation of 0..n-1 for each key, at ``index``: four Feistel rounds on the next even number of
    bits, walked on until the value is below n."""
    half = np.maximum(1, (np.ceil(np.log2(np.maximum(n, 2))).astype(np.uint64) + np.uint64(1)) // np.uint64(2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    out, todo = index.astype(np.uint64).copy(), np.arange(len(index))
    with np.errstate(over="ignore"):
        while len(todo):
            h, m, k = half[todo], mask[todo], key[todo].astype(np.uint64)
            left, right = out[todo] >> h, out[todo] & m
            for r in range(4):
                f = (right + k + np.uint64(r + 1) * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xBF58476D1CE4E5B9)
                f = (f ^ (f >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((f ^ (f >> np.uint64(32))) & m)
            out[todo] = left << h | right
            todo = todo[out[todo] >= n[todo].astype(np.uint64)]
    return out.astype(np.int64)


def shard_count(p: Plan) -> int:
    return max(1, int(p.give.sum()) // SHARD_BLOCKS)


def draws(spark: SparkSession, p: Plan, seed: int = SEED) -> DataFrame:
    """(shard, k, n): how many blocks of source k each output shard draws, a multinomial draw by the sources' shares.

    Each shard draws by itself, from a generator of its own number, so that any number of shards is drawn in tasks.
    """
    total, shards = int(p.give.sum()), shard_count(p)
    share = p.give / max(1, total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[int, int, int]] = []
            for s in batch.column(0).to_pylist():
                got = np.random.default_rng([seed, s]).multinomial((s + 1) * total // shards - s * total // shards, share)
                out += [(s, int(k), int(got[k])) for k in np.flatnonzero(got)]
            cols = [*zip(*out, strict=True)] if out else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64())], names=["shard", "k", "n"])

    return spark.range(0, shards if total else 0, 1, max(1, min(shards // 64 + 1, spark.sparkContext.defaultParallelism * 4))).mapInArrow(run, "shard bigint, k int, n bigint")


def numbered_draws(drawn: DataFrame) -> DataFrame:
    """``drawn`` with before, the source's blocks in earlier shards: a prefix sum by buckets of shards, then within each."""
    b = drawn.withColumn("bucket", F.expr(f"shard div {SHARD_BUCKET}"))
    sums = b.groupBy("k", "bucket").agg(F.sum("n").alias("m"))
    offsets = sums.select("k", "bucket", (F.sum("m").over(Window.partitionBy("k").orderBy("bucket")) - F.col("m")).alias("offset"))
    own = Window.partitionBy("k", "bucket").orderBy("shard")
    placed = b.withColumn("up_to", F.sum("n").over(own)).join(offsets, ["k", "bucket"])
    return placed.select("shard", "k", "n", (F.col("offset") + F.col("up_to") - F.col("n")).alias("before"))


def slots(spark: SparkSession, p: Plan, seed: int = SEED) -> DataFrame:
    """(shard, slot, source, reading, block): the mixture, block by block. ``reading`` counts the readings of a source from 0.

    Over all shards a source is drawn a little more or less often than its quota. Which of its draws are too many is
    pseudorandom; these go to the sources that were drawn too seldom, so that every quota is met and every shard keeps its size.
    """
    drawn = cut(draws(spark, p, seed))
    times = np.zeros(len(p.source), np.int64)
    for r in drawn.groupBy("k").agg(F.sum("n").alias("n")).collect():  # one row for each source at most
        times[r.k] = r.n
    give, blocks = p.give, p.blocks
    over, short = np.maximum(times - give, 0), np.maximum(give - times, 0)
    first_over, first_short = np.cumsum(over) - over, np.concatenate([[0], np.cumsum(short)])
    names = pa.array(p.source, pa.string())
    numbers = numbered_draws(drawn).select("shard", "k", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("n") - 1)).alias("number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k, number = (np.asarray(batch.column(c)).astype(np.int64) for c in ("k", "number"))
            v = permuted(number, times[k], (k + 1) * 7_368_787 + seed)
            extra = np.flatnonzero(v >= give[k])
            at = first_over[k[extra]] + v[extra] - give[k[extra]]
            to = np.searchsorted(first_short, at, side="right") - 1
            k[extra], v[extra] = to, times[to] + at - first_short[to]
            reading = v // blocks[k]
            block = permuted(v % blocks[k], blocks[k], (k + 1) * 1_000_003 + reading * 8_191 + seed)
            yield pa.RecordBatch.from_arrays([batch.column("shard"), names.take(pa.array(k)), pa.array(reading.astype(np.int32)), pa.array(block)], names=["shard", "source", "reading", "block"])

    mixed = numbers.mapInArrow(run, "shard bigint, source string, reading int, block bigint")
    in_shard = Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(seed), "shard", "source", "reading", "block"), "source", "reading", "block")
    return mixed.withColumn("slot", F.row_number().over(in_shard) - 1).select("shard", "slot", "source", "reading", "block")


def mixture(spark: SparkSession, documents: DataFrame, targets: DataFrame, folder: str | None = None) -> DataFrame:
    """(shard, slot, source, reading, block, n_tokens, n_docs, first_doc_id, pieces): every block of the mixture in its place.

    ``pieces`` are the block's tokens in their order, as (doc_id, first, n): n tokens of the document from its token ``first``
    on. With the documents' token ids they give the mixed corpus.

    Documents with a null, empty or unlisted source, and those without tokens, take no part. Without documents of any
    listed source the mixture is empty. The last block of a source may be shorter.
    """
    size = sizes(documents, targets, folder)
    p = plan(spark, size, targets)
    ordered = F.array_sort(F.collect_list(F.struct("at", "doc_id", "first", "n")))  # bounded: a piece has one token at least
    blocks = pieces(size).groupBy("source", "block").agg(F.sum("n").alias("n_tokens"), F.count(F.lit(1)).alias("n_docs"), ordered.alias("_p"))
    blocks = blocks.select("source", "block", "n_tokens", "n_docs", F.col("_p")[0]["doc_id"].alias("first_doc_id"), F.transform("_p", lambda x: F.struct(x.doc_id.alias("doc_id"), x["first"].alias("first"), x.n.alias("n"))).alias("pieces"))
    return slots(spark, p).join(blocks.hint("merge"), ["source", "block"]).select("shard", "slot", "source", "reading", "block", "n_tokens", "n_docs", "first_doc_id", "pieces")


def shares(spark: SparkSession, documents: DataFrame, targets: DataFrame, folder: str | None = None) -> DataFrame:
    """(source, target_share, max_repeats, tokens, blocks, blocks_out, repeats, tokens_out, actual_share), a row for each target."""
    size = sizes(documents, targets, folder)
    p = plan(spark, size, targets)
    last = p.tokens - (p.blocks - 1) * BLOCK_TOKENS
    tail = [(int(s), int(b) - 1) for s, b in enumerate(p.blocks)]
    ends = {r.source: r.n for r in slots(spark, p).join(F.broadcast(spark.createDataFrame([(p.source[s], b) for s, b in tail], "source string, block bigint")), ["source", "block"]).groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most one for each target
    out = np.array([int(g) * BLOCK_TOKENS - ends.get(s, 0) * (BLOCK_TOKENS - int(w)) for s, g, w in zip(p.source, p.give, last, strict=True)], np.int64)
    total = max(1, int(out.sum()))
    rows = [(s, float(sh), int(r), int(t), int(b), int(g), float(g / b) if b else 0.0, int(o), float(o / total)) for s, sh, r, t, b, g, o in zip(p.source, p.share, p.repeats, p.tokens, p.blocks, p.give, out, strict=True)]
    return spark.createDataFrame(rows, "source string, target_share double, max_repeats int, tokens bigint, blocks bigint, blocks_out bigint, repeats double, tokens_out bigint, actual_share double")
