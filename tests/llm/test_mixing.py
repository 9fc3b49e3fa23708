"""Mixing: exact quotas, disjoint draws, the splitting tree's law, odd rows."""

import collections
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.llm import mixing, queries
from quarry.llm.store import read_table

KIND = "doc_id long, source string, text string, size int, at string, slot int, words int"


def wanted(words, weights=(3, 1, 2), share=1.5, top=2):
    """Targets by resharing what is over until none is above."""
    order = sorted(words, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, held = share * sum(words.values()), {}
    while True:
        free = [s for s in order if s not in held]
        level = (total - sum(held.values())) / max(sum(w[s] for s in free), 1)
        over = [s for s in free if w[s] * level > top * words[s]]
        if not over:
            return {s: held.get(s, w[s] * level) for s in order}
        held |= {s: float(top * words[s]) for s in over}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)
    out = []
    for i in range(400):
        source = rng.choice(["big", "big", "big", "big", "b", "ä", "z", None, "tiny"])
        n = rng.choice([0, 1, 3, 20, 60]) if source != "tiny" else 1
        out.append((i, source, " ".join(f"w{i}_{k}" for k in range(n))))
    out += [(1000, "big", "long " * 5000), (1001, "b", None), (None, "z", "no id here"), (1002, "void", ""), (1003, "", "x y")]
    return out + [out[7]] * 40 + [(7, "other", out[7][2])]


def frame(spark, rows, parts=5):
    return spark.createDataFrame([(i, s, t, 1, "a", 2, 3) for i, s, t in rows], KIND).repartition(parts)


@pytest.mark.parametrize("p", [mixing.Params(), mixing.Params(block=16, shard=8, levels=2, cell=4, bucket=20, copies=7)])
def test_mix(spark, rows, p):
    docs = frame(spark, rows)
    placed = mixing.documents(docs, p)
    mixed = mixing.pieces_of(placed, p)
    got = mixing.taken(placed, mixed).collect()
    size = lambda t: len((t or "").split())
    words = collections.Counter()
    for _, s, t in rows:
        words[s] += size(t)
    want = wanted(words)
    key = lambda r: tuple(map(str, r))
    assert sorted(((r.doc_id, r.source, r.size) for r in got), key=key) == sorted(((i, s, size(t)) for i, s, t in rows), key=key)
    assert all(r.source_size == words[r.source] and r.target == pytest.approx(want[r.source]) for r in got)
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    sums = collections.Counter()
    for r in got:
        sums[r.source] += r.taken
    assert {s: sums[s] for s in words} == {s: round(t) for s, t in want.items()}
    # whole passes come first: a document is taken once wherever its source is
    assert all(r.taken >= r.size for r in got if want[r.source] >= words[r.source])
    pieces = mixed.collect()
    spots = [(r["shard"], r.slot, r.within) for r in pieces]
    assert len(set(spots)) == len(spots)
    seen = collections.Counter()
    for r in pieces:
        for k in range(r.start, r.stop):
            seen[r["at"], r.doc_id, bytes(r.digest), r.copy, r["pass"], k] += 1
    assert set(seen.values()) == {1}  # draws are disjoint
    blocks = collections.defaultdict(set)
    for r in pieces:
        blocks[r["shard"]].add(r.slot)
    assert all(b == set(range(len(b))) for b in blocks.values())
    assert max(map(len, blocks.values())) - min(map(len, blocks.values())) <= 1 and max(map(len, blocks.values())) <= p.shard


def test_mix_is_the_same_under_any_partitioning(spark, rows):
    p = mixing.Params(block=16, shard=8, bucket=20)
    runs = []
    for parts, order in ((3, rows), (7, rows[::-1])):
        placed = mixing.documents(frame(spark, order, parts), p)
        runs.append(sorted(map(str, mixing.pieces_of(placed, p).collect())))
    assert runs[0] == runs[1]


def test_mixture_texts(spark, rows):
    text = {(i, s, t) for i, s, t in rows}
    got = mixing.mixture(frame(spark, rows), mixing.Params(block=16, shard=8)).collect()
    whole = {(i, s): [t.split() for j, u, t in text if (j, u) == (i, s) and t] for i, s, _ in text}
    assert got and all(r.text.split() in [w[r.start:r.stop] for w in whole[r.doc_id, r.source]] for r in got)


def test_odd_tables(spark):
    for rows in ([], [(1, "a", None)], [(1, None, ""), (2, "b", " ")]):
        docs = frame(spark, rows) if rows else frame(spark, [(1, "a", "b")]).where("false")
        placed = mixing.documents(docs)
        assert [r.taken for r in mixing.taken(placed, mixing.pieces_of(placed)).collect()] == [0] * len(rows)
        assert mixing.mixture(docs).count() == 0


def test_permutations():
    for n in (1, 2, 3, 5, 16, 17, 100, 1000):
        seen = {tuple(mixing.permuted(np.arange(n), np.full(n, n), mixing._pass_key(np.full(n, 11), e))) for e in range(3)}
        assert all(sorted(x) == list(range(n)) for x in seen) and (n < 5 or len(seen) == 3)
    first = [mixing.permuted(np.array([0]), np.array([4]), mixing._pass_key([k], 0))[0] for k in range(4000)]
    assert np.bincount(first, minlength=4).min() > 800


def test_splitting_tree_has_the_law_of_draws_without_replacement():
    """Quotas add up; a shard's composition has the hypergeometric mean and variance."""
    counts, shards = np.array([500, 120, 30, 1]), 13
    total = int(counts.sum())
    first = []
    for seed in range(800):
        leaves = list(mixing.split(0, shards, counts, np.zeros(4, dtype=np.int64), total, shards, 99, seed))
        assert [lo for lo, *_ in leaves] == list(range(shards))
        assert (sum(n for _, _, n, _ in leaves) == counts).all()
        assert [int(n.sum()) for _, _, n, _ in leaves] == [total * (j + 1) // shards - total * j // shards for j in range(shards)]
        at = np.zeros(4, dtype=np.int64)
        for _, _, n, s in leaves:
            assert (s == at).all()
            at = at + n
        first.append(leaves[5][2])
    first, room = np.array(first), total * 6 // shards - total * 5 // shards
    share = counts / total
    assert np.abs(first.mean(axis=0) - room * share).max() < 0.5
    want = room * share * (1 - share) * (total - room) / (total - 1)
    assert np.abs(first.var(axis=0) / want - 1)[:3].max() < 0.25


def test_query(spark):
    got = queries.op12_mixing(spark, SF_SMALL).collect()
    docs = read_table(spark, SF_SMALL, "documents").collect()
    size = {d.doc_id: len(re.findall("[^ \t\n\v\f\r]+", d.text or "")) for d in docs}
    words = collections.Counter()
    for d in docs:
        words[d.source] += size[d.doc_id]
    want = wanted(words)
    source = {d.doc_id: d.source for d in docs}
    assert {r.doc_id: r["size"] for r in got} == size and len(got) == len(docs)
    sums = collections.Counter()
    for r in got:
        assert r.source_size == words[source[r.doc_id]] and r.target == pytest.approx(want[source[r.doc_id]])
        sums[source[r.doc_id]] += r.taken
    assert {s: round(t) for s, t in want.items()} == dict(sums)
