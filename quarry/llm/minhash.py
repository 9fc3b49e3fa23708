"""MinHash near-duplicates by an inverted join on signature coordinates.

A text is its set of distinct word shingles; its signature holds, for each of
``size`` hash functions, the smallest value over the set. Texts with the same
set are one class from the start. Class representatives are posted under their
(coordinate, value) pairs. Two sets of similarity >= 0.8 agree in at least
``match`` coordinates (with a miss rate under 1e-4 at exactly 0.8, far less
above), so, the pairs of a signature being ordered from the rarest to the
commonest posting list, a common pair must occur within the first
``size - match + 1``: only that prefix is posted, and the long lists are
skipped. Colliding texts are counted on whole signatures, and those with
``match`` collisions are confirmed on the whole shingle sets.

No list is expanded into rows of all its pairs. First every list compares its
members with ``leaders`` of them, and the links found join components. What then
remains in a list, texts of different components, is compared exhaustively on
the signatures inside the tasks, in blocks of at most ``block`` texts, and only
pairs with enough collisions leave them, each from the first list it shares. Of
the texts that come there, sets of at most ``few`` shingles are made again (as
32-bit values) and compared too, so a crowd of short texts that are alike, but
not enough, sends nothing on.

Defined results: null text and text without words give an empty set, which is
linked with nothing; fewer words than a shingle has make one shingle of all of
them; of rows with one doc_id the one with the largest set counts (repeated
rows are one document); a null id is a document of its own, kept, with a null
component; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.components import components
from quarry.llm.store import id_text, keep
from quarry.llm.textbytes import distinct, mix, per_row, pieces, words

U = np.uint64


@dataclass(frozen=True)
class Params:
    words: int = 5     # words in a shingle
    percent: int = 80  # 100 * intersection >= percent * union
    size: int = 64     # coordinates of a signature
    match: int = 38    # collisions needed; P(Bin(64, 0.8) < 38) < 1e-4
    leaders: int = 3   # texts of a list that all its others are compared with first
    block: int = 2048  # texts of a list that meet in one task
    few: int = 256     # shingles of a set that is small enough to travel with its signature
    broadcast_ids: int = 250_000  # up to so many wanted ids and keys (under 100 bytes each as a hash table) are broadcast, more are shuffled
    seed: int = 29


def shingles(data: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingles of each text, sorted, and the rows' offsets."""
    h, at = words(data, off)
    n = np.diff(at)
    size = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    to = np.concatenate([[0], np.cumsum(size)])
    row = np.repeat(np.arange(len(n)), size)
    start = at[row] + np.arange(to[-1]) - to[row]
    left = n[row] - (start - at[row])
    value = np.full(to[-1], k, dtype=np.uint64)
    for i in range(k):
        there = left > i
        value[there] = mix(value[there] * U(0x9E3779B97F4A7C15) + h[start[there] + i] + U(i + 1))
    return distinct(value, to)


def _key(v: np.ndarray, at: np.ndarray, seed: int) -> np.ndarray:
    """A fingerprint of each row's whole set."""
    return per_row(mix(v ^ U(seed)), at, np.add, 0).astype(np.uint64).view(np.int64)


def _signatures(batches, p: Params):
    rng = np.random.default_rng(p.seed)
    a = rng.integers(0, 1 << 63, p.size, dtype=np.uint64) * U(2) + U(1)
    b = rng.integers(0, 1 << 63, p.size, dtype=np.uint64)
    for batch in batches:
        for rows, data, off in pieces(batch, "text"):
            v, at = shingles(data, off, p.words)
            n = np.diff(at)
            sig = np.empty((len(n), p.size), dtype=np.int32)
            for i in range(p.size):
                sig[:, i] = per_row((v * a[i] + b[i]) >> U(32), at, np.minimum, 0).astype(np.uint32).view(np.int32)
            sig = pa.FixedSizeListArray.from_arrays(pa.array(sig.ravel()), p.size).cast(pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id")[rows.start:rows.stop], pa.array(n), pa.array(_key(v, at, 1)),
                 pa.array(_key(v, at, 2)), sig], ["doc_id", "n", "key1", "key2", "sig"])


def _blobs(v: np.ndarray, at: np.ndarray) -> pa.Array:
    """Each row's values as the bytes of one binary value, without copies by row."""
    return pa.Array.from_buffers(pa.large_binary(), len(at) - 1, [
        None, pa.py_buffer((at * v.itemsize).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(v))]).cast(pa.binary())


def _sets(batches, p: Params, few: int | None = None):
    """Whole shingle sets of the rows with the wanted set (repeated rows of an id
    may hold another text than the one that counts); with ``few`` only sets of at
    most so many shingles, as 32-bit values."""
    for batch in batches:
        for rows, data, off in pieces(batch, "text"):
            v, at = shingles(data, off, p.words)
            n = np.diff(at)
            on = _key(v, at, 1) == np.asarray(batch.column("want")[rows.start:rows.stop])
            if few is not None:
                on &= n <= few
                v = v[np.repeat(on, n)].astype(np.uint32)
                at = np.concatenate([[0], np.cumsum(np.where(on, n, 0))])
            sets = pa.Array.from_buffers(pa.large_binary(), len(n), [
                None, pa.py_buffer((at * v.itemsize).astype(np.int64)), pa.py_buffer(np.ascontiguousarray(v))])
            on = pa.array(on)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id")[rows.start:rows.stop].filter(on), sets.filter(on).cast(pa.binary())],
                                             ["doc_id", "shingles"])


def _sets_of(texts: DataFrame, wanted: DataFrame, p: Params, few: int | None = None) -> DataFrame:
    """(doc_id, shingles) of the ``wanted`` (doc_id, key1)."""
    wanted = wanted.select("doc_id", F.col("key1").alias("want"))
    return (texts.join(F.broadcast(wanted) if wanted.count() <= p.broadcast_ids else wanted, "doc_id")
            .mapInArrow(lambda it: _sets(it, p, few), "doc_id long, shingles binary").dropDuplicates(["doc_id"]))


def _confirm(batches, p: Params):
    """Pairs whose whole sets reach the similarity."""
    for batch in batches:
        good = []
        for i, (x, y) in enumerate(zip(batch.column("x"), batch.column("y"))):
            x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            if 100 * common >= p.percent * (len(x) + len(y) - common):
                good.append(i)
        yield batch.select(["a", "b"]).take(pa.array(good, pa.int64()))


def _confirmed(pairs: DataFrame, reps: DataFrame, texts: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) that reach the similarity on their whole sets."""
    some = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    some = keep(reps.select("doc_id", "key1").join(some, "doc_id"), "minhash-wanted")
    sets = keep(_sets_of(texts, some, p), "minhash-sets")
    wide = (pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y")), "b"))
    return wide.mapInArrow(lambda it: _confirm(it, p), "a long, b long")


def _enough(pairs: DataFrame, reps: DataFrame, p: Params) -> DataFrame:
    """The pairs (a, b) with sizes near enough and ``match`` collisions."""
    side = lambda c: reps.select(F.col("doc_id").alias(c), F.col("sig").alias(f"s{c}"), F.col("n").alias(f"n{c}"))
    same = F.size(F.filter("same", lambda x: x))
    met = (pairs.join(side("a"), "a").join(side("b"), "b")
           .where(100 * F.least("na", "nb") >= p.percent * F.greatest("na", "nb"))
           .select("a", "b", F.zip_with("sa", "sb", lambda x, y: x == y).alias("same")))
    return met.where(same >= p.match).select("a", "b")


def _postings(reps: DataFrame, p: Params) -> DataFrame:
    """(pair, doc_id) of every prefix, lists of one text left out. ``pair`` is
    the coordinate and the value in one long."""
    post = keep(reps.select("doc_id", F.posexplode("sig").alias("i", "v"))
                .select("doc_id", (F.col("i").cast("long") * F.lit(1 << 32) + F.col("v").cast("long")).alias("pair")),
                "minhash-postings")
    often = post.groupBy("pair").agg(F.count("*").alias("n")).where("n > 1")
    # a signature has `size` pairs: its shared ones, rarest first, without the last match - 1
    mine = (post.join(often, "pair").groupBy("doc_id")
            .agg(F.array_sort(F.collect_list(F.struct("n", "pair"))).alias("pairs"))
            .where(F.size("pairs") >= p.match))
    return keep(mine.select("doc_id", F.explode(F.slice("pairs", 1, F.size("pairs") - p.match + 1)).alias("p"))
                .select(F.col("p.pair").alias("pair"), "doc_id"), "minhash-prefixes")


def _collide(batches, p: Params):
    """Pairs of texts of different components with enough collisions, from rows
    sorted by list and block pair; each pair from the first list it shares. One
    block pair at a time is held, as arrays."""
    def pairs(t: pa.Table):
        """``t``: the rows of one block pair."""
        doc, comp, size, block = (t[c].to_numpy() for c in ("doc_id", "component", "n", "block"))
        n = len(doc)
        if n < 2 or (comp == comp[0]).all():
            return
        pair, split = t["pair"][0].as_py(), t["i"][0].as_py() != t["j"][0].as_py()
        t = t.combine_chunks()
        sig = t["sig"].chunk(0).flatten().to_numpy().reshape(n, -1)
        lists, few = t["lists"].chunk(0), t["few"].chunk(0)

        def first(i, j):
            """Whether ``pair`` is the first list that both are in."""
            both = np.intersect1d(lists[i].values.to_numpy(), lists[j].values.to_numpy(), assume_unique=True)
            return both[0] == pair

        def alike(i, j):
            """False only for sets that are too far apart; two points of slack, as
            32-bit values may coincide."""
            if not (few[i].is_valid and few[j].is_valid):
                return True
            x, y = (np.frombuffer(few[k].as_buffer(), np.uint32) for k in (i, j))
            both = np.sort(np.concatenate([x, y]))
            common = int((both[1:] == both[:-1]).sum())
            return 100 * common >= (p.percent - 2) * (len(x) + len(y) - common)

        for a in range(0, n, 64):
            one = slice(a, min(a + 64, n))
            fits = (np.arange(n)[None, :] > np.arange(n)[one, None]) & (comp[one, None] != comp[None, :])
            if split:
                fits &= block[one, None] != block[None, :]
            low, high = np.minimum(size[one, None], size[None, :]), np.maximum(size[one, None], size[None, :])
            u, v = np.nonzero(fits & (100 * low >= p.percent * high))
            u = u + a
            for s in range(0, len(u), 8192):
                x, y = u[s:s + 8192], v[s:s + 8192]
                enough = (sig[x] == sig[y]).sum(axis=1) >= p.match
                for i, j in zip(x[enough].tolist(), y[enough].tolist()):
                    if first(i, j) and alike(i, j):
                        yield min(doc[i], doc[j]), max(doc[i], doc[j])

    def out(held):
        found = np.array(list(pairs(pa.Table.from_batches(held))), dtype=np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0]), pa.array(found[:, 1])], ["a", "b"])

    held, at = [], None
    for batch in batches:
        key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("pair", "i", "j")])
        cut = np.append(0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1)
        for a, b in zip(cut, np.append(cut[1:], batch.num_rows)):
            if b == a:
                continue
            if held and tuple(key[:, a]) != at:
                yield out(held)
                held = []
            held.append(batch.slice(a, b - a))
            at = tuple(key[:, a])
    if held:
        yield out(held)


def _leader_pairs(post: DataFrame, p: Params) -> DataFrame:
    """Every list's members with its leaders: the smallest by as many hashes of the id."""
    leads = post.groupBy("pair").agg(*[F.min(F.struct(
        (F.col("doc_id") if r == 0 else F.xxhash64("doc_id", F.lit(r))).alias("h"), "doc_id")).alias(f"l{r}")
        for r in range(p.leaders)])
    leads = leads.select("pair", F.array_distinct(F.array(*[f"l{r}.doc_id" for r in range(p.leaders)])).alias("leads"))
    return (post.join(leads, "pair").select("doc_id", F.explode("leads").alias("lead")).where("doc_id <> lead")
            .select(F.least("doc_id", "lead").alias("a"), F.greatest("doc_id", "lead").alias("b")).distinct())


def _remaining_pairs(post: DataFrame, reps: DataFrame, texts: DataFrame, labels: DataFrame, p: Params) -> DataFrame:
    """Colliding pairs of texts that are in one list but not yet in one component."""
    at = (post.join(labels.select(F.col("vertex").alias("doc_id"), "component"), "doc_id", "left")
          .withColumn("component", F.coalesce("component", "doc_id")))
    open_ = (at.groupBy("pair").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("members"))
             .where("lo < hi").select("pair", F.ceil(F.col("members") / p.block).cast("int").alias("blocks")))
    mine = at.join(open_, "pair")
    carried = (mine.groupBy("doc_id", "component").agg(F.collect_list(F.struct("pair", "blocks")).alias("lists"))
               .join(reps.select("doc_id", "n", "key1", "sig"), "doc_id"))
    carried = keep(carried, "minhash-carried")
    small = _sets_of(texts, carried.where(F.col("n") <= p.few), p, p.few).withColumnRenamed("shingles", "few")
    carried = carried.join(small, "doc_id", "left")
    met = (carried.select("doc_id", "component", "n", F.explode("lists").alias("l"), "sig",
                          F.array_sort(F.col("lists.pair")).alias("lists"), "few")
           .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("l.blocks")).cast("int"))
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("l.blocks") - 1)))
           .select(F.col("l.pair").alias("pair"), F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                   "doc_id", "component", "n", "block", "sig", "lists", "few"))
    return (met.repartition("pair", "i", "j").sortWithinPartitions("pair", "i", "j", "doc_id")
            .mapInArrow(lambda it: _collide(it, p), "a long, b long"))


def links(texts: DataFrame, reps: DataFrame, p: Params) -> DataFrame:
    """(a, b): links between representatives with the components of all links."""
    post = _postings(reps, p)
    first = keep(_enough(_leader_pairs(post, p), reps, p), "minhash-led")
    first = keep(_confirmed(first, reps, texts, p), "minhash-links")
    rest = keep(_remaining_pairs(post, reps, texts, components(first, "minhash"), p), "minhash-rest")
    # written, so that a task that joins components does not also confirm pairs, in two Python processes
    return first.union(keep(_confirmed(rest, reps, texts, p), "minhash-links"))


def groups(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row for each document."""
    texts = id_text(docs)
    sigs = keep(texts.mapInArrow(lambda it: _signatures(it, p),
                                 "doc_id long, n long, key1 long, key2 long, sig array<int>"), "minhash-signatures")
    mine = (sigs.where("doc_id IS NOT NULL").groupBy("doc_id")
            .agg(F.max(F.struct("n", "key1", "key2", "sig")).alias("s")).select("doc_id", "s.*"))
    mine = keep(mine, "minhash-documents")
    full = mine.where("n > 0")
    classes = full.groupBy("n", "key1", "key2").agg(F.min("doc_id").alias("rep"))
    classes = keep(full.select("doc_id", "n", "key1", "key2").join(classes, ["n", "key1", "key2"]).select("doc_id", "rep"),
                   "minhash-classes")
    reps = full.join(classes.where("doc_id = rep").select("doc_id"), "doc_id", "left_semi")
    near = links(texts.where("doc_id IS NOT NULL"), reps, p)
    copies = classes.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = components(near.union(copies), "minhash-all")
    out = (mine.select("doc_id", F.col("n").alias("n_shingles"))
           .join(labels.withColumnRenamed("vertex", "doc_id"), "doc_id", "left")
           .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")))
    void = sigs.where("doc_id IS NULL").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return out.union(void).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
