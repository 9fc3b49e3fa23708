"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Every source is a run of words: its documents in an order fixed by a hash, cut
into blocks of ``block`` words (a long document spans several). The mix takes
whole passes over a source and then part of one; each pass has a keyed
permutation of the block numbers, so "the first q of the permuted blocks" needs
no sort. The last block taken is cut so that a source gives exactly its target,
rounded to a word.

The mix is dealt to output shards of ``shard`` blocks. A node of the splitting
tree holds a range of shards and how many blocks of each source fall to it; its
left half receives a multivariate-hypergeometric draw of them, the right half
the rest, down to single shards. Every shard so has the composition of a random
sample without replacement, while the quotas add up exactly. The nodes' draws
depend on seed and node alone; ``levels`` levels of the tree are one Spark job,
each node a group whose rows are sources, not documents. A shard's share of a
source is a range of the permuted blocks, disjoint from all others'. In the
shard the blocks are shuffled by a hash.

The targets: sources in code point order, null last, have the weights in turn
and share ``share`` times all words; a target stops at ``repeats`` times its
source's words and what is over goes to the others by weight.

Defined results: null texts and texts without words have size 0 and give nothing;
rows alike in doc_id, source and text are documents of their own that lie side
by side; a null doc_id is an id like others; a null source is a source; other
columns are ignored. The same rows give the same mix under any partitioning.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quarry.functions.ranking import global_rank
from quarry.llm.store import keep
from quarry.llm.textbytes import SPACE, mix, pieces, word_ranges

U = np.uint64
ROUNDS = 4
FULL = (1 << 64) - 1


@dataclass(frozen=True)
class Params:
    weights: tuple = (3, 1, 2)
    share: float = 1.5        # words of the mix, as a share of all words
    repeats: int = 2          # passes over a source at most
    block: int = 4096         # words; more where there would be over 2**28 blocks, which the draws allow for
    shard: int = 1024         # blocks
    levels: int = 6           # levels of the tree that one job descends
    cell: int = 64            # permuted blocks that a join key stands for
    bucket: int = 4096        # documents of a source whose offsets one window settles
    copies: int = 65_536      # equal rows that are dealt out together
    seed: int = 53


def permuted(block: np.ndarray, blocks: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A keyed permutation of ``0 .. blocks - 1`` at ``block``: a Feistel network
    on the next even number of bits, walked until it falls inside."""
    x, n = block.astype(U), np.broadcast_to(blocks, block.shape).astype(U)
    key = np.broadcast_to(key, block.shape).astype(U)
    half = np.maximum(1, np.ceil(np.log2(np.maximum(n.astype(np.float64), 2)) / 2)).astype(U)
    half = np.where((U(1) << (half * U(2))) < n, half + U(1), half)
    mask = (U(1) << half) - U(1)
    out, todo = x.copy(), np.arange(len(x))
    while len(todo):
        y, h, m, k = out[todo], half[todo], mask[todo], key[todo]
        left, right = y >> h, y & m
        for r in range(ROUNDS):
            left, right = right, left ^ (mix(right + k + U((r + 1) * 0x9E3779B97F4A7C15 & FULL)) & m)
        out[todo] = (left << h) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _pass_key(key, epoch):
    return mix(np.asarray(key).astype(np.int64).view(U) + U(epoch * 0xD1342543DE82EF95 & FULL))


def _sizes(batches):
    for batch in batches:
        for rows, data, off in pieces(batch, "text"):
            _, _, at = word_ranges(data, off, ~SPACE[data])
            part = batch.slice(rows.start, rows.stop - rows.start)
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "source", "digest")), pa.array(np.diff(at))],
                                             ["doc_id", "source", "digest", "size"])


def targets(sources: DataFrame, p: Params = Params()) -> DataFrame:
    """``sources`` (source, words) with ``at`` (number in code point order) and
    ``target``. Each round ends the sources that reach their bound and deals the
    rest again; one row per source, aggregated where it lies."""
    ranked = global_rank(sources.withColumn("void", F.col("source").isNull().cast("int")), ["void", "source"], "at", 0).drop("void")
    ranked = ranked.withColumn("weight", F.element_at(F.array(*map(F.lit, p.weights)), (F.col("at") % len(p.weights) + 1).cast("int")))
    bound = F.col("words") * p.repeats
    level = None  # words of a unit of weight
    while True:
        over = F.lit(False) if level is None else bound < F.col("weight") * level
        words, held, open_ = ranked.agg(F.sum("words"), F.sum(F.when(over, bound).otherwise(0)), F.sum(F.when(over, 0).otherwise(F.col("weight")))).first()
        if not words or not open_:
            break
        new = (p.share * words - held) / open_
        if level is not None and new <= level:
            break
        level = new
    return ranked.withColumn("target", F.least(F.col("weight") * F.lit(level or 0.0), bound.cast("double")))


def _quotas(batches, block: int, p: Params):
    """For each source its blocks, and for every pass how many it takes and the
    words of the last one."""
    for batch in batches:
        quota, last, blocks = [], [], []
        for words, target, key in zip(*(batch.column(c).to_pylist() for c in ("words", "target", "key"))):
            n = -(-words // block)
            left, q, e = min(round(target), words * p.repeats), [], []
            for epoch in range(p.repeats):
                take = min(left, words)
                left -= take
                if not take:
                    q.append(0)
                    e.append(0)
                    continue
                # the short block stands at one place of the permuted order
                short = int(permuted(np.array([n - 1]), np.array([n]), _pass_key([key], epoch))[0])
                lost = n * block - words
                full = -(-take // block)
                q.append(full if full <= short else min(n, -(-(take + lost) // block)))
                before = (q[-1] - 1) * block - (lost if q[-1] - 1 > short else 0)
                e.append(take - before)
            quota.append(q)
            last.append(e)
            blocks.append(n)
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(blocks, pa.int64()), pa.array(quota, kind), pa.array(last, kind)],
                                         [*batch.schema.names, "blocks", "quota", "last"])


def split(lo: int, hi: int, counts: np.ndarray, start: np.ndarray, total: int, shards: int, levels: int, seed: int):
    """Descend ``levels`` levels from the node of shards ``lo .. hi - 1``:
    (lo, hi, counts, start) of the nodes reached."""
    if hi - lo == 1 or not levels:
        yield lo, hi, counts, start
        return
    mid = (lo + hi) // 2
    room = total * mid // shards - total * lo // shards
    left = np.random.default_rng([seed, lo, hi]).multivariate_hypergeometric(counts, room, method="marginals")
    yield from split(lo, mid, left, start, total, shards, levels - 1, seed)
    yield from split(mid, hi, counts - left, start + left, total, shards, levels - 1, seed)


def _split_node(table: pa.Table, total: int, shards: int, p: Params) -> pa.Table:
    table = table.sort_by("at")
    at, counts, start = (np.asarray(table[c]) for c in ("at", "count", "start"))
    parts = []
    for lo, hi, n, s in split(table["lo"][0].as_py(), table["hi"][0].as_py(), counts, start, total, shards, p.levels, p.seed):
        on = n > 0
        parts.append(pa.table({"lo": np.full(on.sum(), lo), "hi": np.full(on.sum(), hi), "at": at[on], "start": s[on], "count": n[on]}))
    return pa.concat_tables(parts)


def shares(quotas: DataFrame, total: int, shards: int, p: Params = Params()) -> DataFrame:
    """(shard, at, start, count): the range of its permuted blocks that every
    source (``at``, ``count``) gives to each shard."""
    nodes = keep(quotas.where("count > 0").select(F.lit(0).cast("long").alias("lo"), F.lit(shards).cast("long").alias("hi"), "at",
                                                  F.lit(0).cast("long").alias("start"), "count"), "mixing-nodes")
    for _ in range(ceil(max(shards - 1, 0).bit_length() / p.levels)):
        nodes = keep(nodes.groupBy("lo", "hi").applyInArrow(lambda t: _split_node(t, total, shards, p),
                                                           "lo long, hi long, at long, start long, count long"), "mixing-nodes")
    return nodes.select(F.col("lo").alias("shard"), "at", "start", "count")


def _spans(batches, block: int, p: Params):
    """The parts of each document that the mix takes."""
    names = ["doc_id", "digest", "copy", "at"]
    for whole in batches:
        for a in range(0, whole.num_rows, 8192):
            batch = whole.slice(a, 8192)
            o, n, nb, key = (np.asarray(batch.column(c)) for c in ("offset", "size", "blocks", "key"))
            quota, last = (np.asarray(batch.column(c).flatten()).reshape(-1, p.repeats) for c in ("quota", "last"))
            first = o // block
            count = np.where(n > 0, (o + np.maximum(n, 1) - 1) // block - first + 1, 0)
            row = np.repeat(np.arange(len(n)), count)
            b = first[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            begin, end = np.maximum(o[row], b * block), np.minimum((o + n)[row], (b + 1) * block)
            base = np.zeros(len(n), dtype=np.int64)
            for epoch in range(p.repeats):
                some = np.flatnonzero(quota[row, epoch] > 0)
                r = row[some]
                pos = permuted(b[some], nb[r], _pass_key(key[r], epoch))
                q = quota[r, epoch]
                stop = np.where(pos == q - 1, np.minimum(end[some], b[some] * block + last[r, epoch]), end[some])
                on = (pos < q) & (stop > begin[some])
                some, r = some[on], r[on]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).take(pa.array(r)) for c in names), pa.array(np.full(len(r), epoch, dtype=np.int32)),
                     pa.array(base[r] + pos[on]), pa.array(begin[some] - b[some] * block), pa.array(begin[some] - o[r]),
                     pa.array(stop[on] - o[r])], [*names, "pass", "drawn", "within", "start", "stop"])
                base += quota[:, epoch]


def _unfolded(rows: DataFrame, p: Params) -> DataFrame:
    """One row for each of ``copies`` equal rows, dealt out in runs."""
    many = rows.where("copies > 1").withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1, F.lit(p.copies).cast("long"))))
    many = many.repartition("at", "offset", "run").withColumn(
        "copy", F.explode(F.sequence(F.col("run"), F.least(F.col("run") + p.copies, "copies") - 1))).drop("run")
    one = rows.where("copies = 1").withColumn("copy", F.lit(0).cast("long"))
    return one.unionByName(many).withColumn("offset", F.col("offset") + F.col("copy") * F.col("size")).drop("copies")


def _identified(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                       F.unhex(F.md5(text)).alias("digest"), text.alias("text"))


def documents(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """Every document's size, its place among its source's words, and the source's
    words, target and quotas: (doc_id, source, digest, copy, size, offset, at, words,
    target, key, blocks, quota, last)."""
    rows = keep(_identified(docs).mapInArrow(_sizes, "doc_id long, source string, digest binary, size long")
                .groupBy("doc_id", "source", "digest", "size").agg(F.count("*").alias("copies")), "mixing-sizes")
    sources = rows.groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("words"), F.count("*").alias("rows"))
    sources = keep(targets(keep(sources, "mixing-sources"), p).withColumn("key", F.xxhash64(F.lit(p.seed), "source", F.col("source").isNull())),
                   "mixing-targets")
    total = sources.agg(F.sum(F.col("words"))).first()[0] or 0
    block = max(p.block, -(-p.repeats * total >> 28))
    kind = "source string, words long, rows long, at long, weight int, target double, key long, blocks long, quota array<long>, last array<long>"
    sources = keep(sources.select("source", "words", "rows", "at", "weight", "target", "key")
                   .mapInArrow(lambda it: _quotas(it, block, p), kind), "mixing-quotas")
    order = F.xxhash64(F.lit(p.seed + 1), "doc_id", "digest", F.col("doc_id").isNull())
    rows = (rows.join(sources, rows["source"].eqNullSafe(sources["source"])).drop(sources["source"])
            .withColumn("order", order).withColumn("bucket", F.pmod(F.xxhash64("order"), F.ceil(F.col("rows") / p.bucket))))
    words = F.col("size") * F.col("copies")
    before = (rows.groupBy("at", "bucket").agg(F.sum(words).alias("held"))
              .select("at", "bucket", F.coalesce(F.sum("held").over(
                  Window.partitionBy("at").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")))
    inside = (Window.partitionBy("at", "bucket").orderBy("order", "doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1))
    rows = (rows.withColumn("offset", F.coalesce(F.sum(words).over(inside), F.lit(0))).join(before, ["at", "bucket"])
            .withColumn("offset", F.col("offset") + F.col("before")))
    out = _unfolded(rows.drop("order", "bucket", "before", "rows", "weight"), p).withColumn("block", F.lit(block).cast("long"))
    return keep(out, "mixing-documents")


def pieces_of(placed: DataFrame, p: Params = Params()) -> DataFrame:
    """The mix as rows (shard, slot, within, doc_id, digest, copy, at, pass, start,
    stop): words ``start .. stop - 1`` of a document stand in block ``slot`` of a
    shard, in the order of ``within``."""
    top = placed.groupBy("at").agg(F.first("quota").alias("quota"), F.first("block").alias("block"))
    quotas = keep(top.select("at", "block", F.aggregate("quota", F.lit(0).cast("long"), lambda a, x: a + x).alias("count")), "mixing-counts")
    total, block = quotas.agg(F.sum("count"), F.max("block")).first()
    total, block = total or 0, block or p.block
    shards = max(1, -(-total // p.shard))
    ranges = shares(quotas, total, shards, p).withColumn("cell", F.explode(F.sequence(
        F.floor(F.col("start") / p.cell), F.floor((F.col("start") + F.col("count") - 1) / p.cell))))
    spans = placed.where("size > 0").mapInArrow(
        lambda it: _spans(it, block, p), "doc_id long, digest binary, copy long, at long, pass int, drawn long, within long, start long, stop long")
    met = (spans.withColumnRenamed("start", "begin").withColumn("cell", F.floor(F.col("drawn") / p.cell)).join(ranges, ["at", "cell"])
           .where("drawn >= start AND drawn < start + count"))
    slot = F.dense_rank().over(Window.partitionBy("shard").orderBy(F.xxhash64(F.lit(p.seed), "shard", "at", "drawn"), "at", "drawn")) - 1
    return met.select("shard", slot.alias("slot"), "within", "doc_id", "digest", "copy", "at", "pass", F.col("begin").alias("start"), "stop")


def taken(placed: DataFrame, mixed: DataFrame) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken), one row for each document."""
    names = ["at", "doc_id", "digest", "copy"]
    each = placed.select(*names, F.struct("source", "size", "words", "target").alias("of"), F.lit(0).cast("long").alias("taken"))
    some = mixed.select(*names, F.lit(None).cast(each.schema["of"].dataType).alias("of"), (F.col("stop") - F.col("start")).alias("taken"))
    return (each.union(some).groupBy(*names).agg(F.max("of").alias("of"), F.sum("taken").alias("taken"))
            .select("doc_id", "of.source", "of.size", F.col("of.words").alias("source_size"), "of.target", "taken"))


def _cut(batches):
    for batch in batches:
        for rows, data, off in pieces(batch, "text"):
            s, e, at = word_ranges(data, off, ~SPACE[data])
            part = batch.slice(rows.start, rows.stop - rows.start)
            start, stop = np.asarray(part.column("start")) + at[:-1], np.asarray(part.column("stop")) + at[:-1]
            text = [data[a:b].tobytes().decode() for a, b in zip(s[start], e[stop - 1])]
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in part.schema.names if c != "text"), pa.array(text, pa.string())],
                                             [c for c in part.schema.names if c != "text"] + ["text"])


def mixture(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """The mix itself: (shard, slot, within, doc_id, source, pass, start, stop,
    text), to be written by shard in the order of slot and within."""
    placed = documents(docs, p)
    mixed = pieces_of(placed, p)
    source = placed.select("at", "source").distinct()
    texts = _identified(docs).dropDuplicates(["doc_id", "source", "digest"])
    full = mixed.join(source, "at").drop("copy")
    full = full.join(texts, full["doc_id"].eqNullSafe(texts["doc_id"]) & full["source"].eqNullSafe(texts["source"])
                     & (full["digest"] == texts["digest"])).select(*[full[c] for c in full.columns], texts["text"])
    names = ["shard", "slot", "within", "doc_id", "source", "pass", "start", "stop", "text"]
    kind = "shard long, slot int, within long, doc_id long, source string, pass int, start long, stop long, text string"
    return full.select(*names).mapInArrow(_cut, kind)
