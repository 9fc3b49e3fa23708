"""Ranked lexical search, reversed: documents stream through an index of the items.

The items (the queries) are few, the documents many. An inverted index over the
items' terms (term -> items that hold it, with counts) is broadcast, and every
document is read once against it: its term counts meet the index, the scores of
all items it touches come out at once, and each task keeps the best ``top``
documents of each item in a bounded heap (arrays of scores and ids). The tasks'
heaps are merged in two steps, groups of tasks first.

Before that, one pass counts what scores need from all documents: how many hold
a term, how many terms they hold together, and in how many each of the items'
terms occurs.

An index has at most ``postings`` entries (24 bytes each), checked before it is
built: items are dealt into as many blocks as that takes, and each block is an
index and a pass of its own. Only a single item with more distinct terms than
that makes a larger one.

A score is exact in 64-bit integers. With w = floor(1000 ln((2N+2)/(2 df+1))) and
m = 100-75 + (75 n N) div L it is the sum over the item's terms, repeats
included, of w * ((10^9 tf) div (1000 tf + 8 m)).

Defined results: null and termless texts are not counted and never found; items
without terms have no results; rows that repeat a doc_id are documents of their
own; of several rows with one item_id the longest text counts (ties: the
greatest); null ids are ids like others, a null doc_id after the others on equal
scores; other columns are ignored. Terms are told apart by 128 bits of hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from quarry.llm.store import keep
from quarry.llm.textbytes import TERM, WORDS, LOWER_CODE, Rolling, _LOWER, mix, pieces, word_ranges

U = np.uint64
CHECK = Rolling(19)
CHECK_CODE = CHECK.code[_LOWER]
FILTER_BITS = 20


@dataclass(frozen=True)
class Params:
    top: int = 10
    postings: int = 1_000_000  # entries of an index that is broadcast at once
    cells: int = 1 << 20       # scores (documents x items) that a task works on at once
    merge: int = 64            # groups of tasks whose heaps are merged first


def _term_hashes(data: np.ndarray, off: np.ndarray):
    """Hash of every term, its range of bytes, and the rows' offsets into them."""
    s, e, at = word_ranges(data, off, TERM[data])
    return WORDS.of(WORDS.sums(data, LOWER_CODE), s, e), s, e, at


def _checks(data: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    return CHECK.of(CHECK.sums(data, CHECK_CODE), s, e)


def _item_terms(batches) -> Iterator[pa.RecordBatch]:
    """(item_id, term, check, count) of every item's distinct terms."""
    for batch in batches:
        for rows, data, off in pieces(batch, "text"):
            h, s, e, at = _term_hashes(data, off)
            c = _checks(data, s, e)
            row = np.repeat(np.arange(len(off) - 1), np.diff(at))
            order = np.lexsort((c, h, row))
            h, c, row = h[order], c[order], row[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1]) | (row[1:] != row[:-1])
            first = np.flatnonzero(new)
            ids = batch.column("item_id")[rows.start:rows.stop]
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(row[first])), pa.array(h[first].view(np.int64)), pa.array(c[first].view(np.int64)),
                 pa.array(np.diff(np.append(first, len(h))))], ["item_id", "term", "check", "count"])


class Index:
    """term -> items that hold it, with counts; terms are numbered by their hashes' order."""

    def __init__(self, table: pa.Table):
        table = table.combine_chunks()
        items = table["item_id"].combine_chunks()
        coded = (items.chunk(0) if isinstance(items, pa.ChunkedArray) else items).dictionary_encode(null_encoding="encode")
        self.ids, item = coded.dictionary, np.asarray(coded.indices).astype(np.int64)
        h, c = (np.asarray(table[k]).view(U) for k in ("term", "check"))
        order = np.lexsort((item, c, h))
        h, c, self.item, self.count = h[order], c[order], item[order], np.asarray(table["count"])[order]
        new = np.ones(len(h), dtype=bool)
        new[1:] = (h[1:] != h[:-1]) | (c[1:] != c[:-1])
        first = np.flatnonzero(new)
        self.term, self.check, self.at = h[first], c[first], np.append(first, len(h))
        self.maybe = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.maybe[(self.term >> U(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, data: np.ndarray, off: np.ndarray):
        """(row, term number, occurrences) of the index's terms in each text,
        and every text's number of terms."""
        h, s, e, at = _term_hashes(data, off)
        on = np.flatnonzero(self.maybe[(h >> U(64 - FILTER_BITS)).astype(np.int64)])
        first = np.searchsorted(self.term, h[on])
        there = first < len(self.term)
        there[there] = self.term[first[there]] == h[on][there]
        on, term = on[there], first[there]
        check = _checks(data, s[on], e[on])
        while True:  # terms with one hash and different checks stand side by side
            wrong = np.flatnonzero(self.check[term] != check)
            if not len(wrong):
                break
            nxt = np.minimum(term[wrong] + 1, len(self.term) - 1)
            same = (nxt > term[wrong]) & (self.term[nxt] == self.term[term[wrong]])
            term[wrong[same]] += 1
            keep_ = np.ones(len(on), dtype=bool)
            keep_[wrong[~same]] = False
            on, term, check = on[keep_], term[keep_], check[keep_]
        row = np.searchsorted(at, on, side="right") - 1
        key, tf = np.unique(row * len(self.term) + term, return_counts=True)
        return key // max(len(self.term), 1), key % max(len(self.term), 1), tf, np.diff(at)


def _counts(batches, index) -> Iterator[pa.RecordBatch]:
    """(term, n): in how many documents each term of the index occurs; term -1 is
    the number of documents with terms, -2 their terms."""
    index = index.value
    df, docs, total = np.zeros(len(index.term), dtype=np.int64), 0, 0
    for batch in batches:
        for _, data, off in pieces(batch, "text"):
            _, term, _, n = index.hits(data, off)
            df += np.bincount(term, minlength=len(df))
            docs += int((n > 0).sum())
            total += int(n.sum())
    some = np.flatnonzero(df)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, [-1, -2])), pa.array(np.append(df[some], [docs, total]))], ["term", "n"])


def weights(df: np.ndarray, docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * docs + 2) / (2 * df + 1))).astype(np.int64)


class Heaps:
    """The best ``top`` (score, document) of every item; equal scores by rising id, null last."""

    def __init__(self, items: int, top: int):
        self.top = top
        self.item = self.score = self.doc = np.zeros(0, dtype=np.int64)
        self.void = np.zeros(0, dtype=bool)
        self.floor = np.ones(items, dtype=np.int64)  # the least score that may still enter

    def offer(self, item, score, doc, void) -> None:
        item, score, doc, void = (np.concatenate([a, b]) for a, b in (
            (self.item, item), (self.score, score), (self.doc, doc), (self.void, void)))
        order = np.lexsort((doc, void, -score, item))
        at = item[order]
        first = np.searchsorted(at, at)  # where the item's run begins
        rank = np.arange(len(at)) - first
        kept = order[rank < self.top]
        self.item, self.score, self.doc, self.void = item[kept], score[kept], doc[kept], void[kept]
        full = order[rank == self.top - 1]
        self.floor[item[full]] = score[full]


def _gain(tf: np.ndarray, n: np.ndarray, row: np.ndarray, docs: int, total: int) -> np.ndarray:
    if 75 * int(n.max(initial=0)) * docs >= 1 << 63:
        m = np.array([25 + 75 * int(x) * docs // total for x in n], dtype=np.int64)
    else:
        m = 25 + 75 * n * docs // max(total, 1)
    return 1_000_000_000 * tf // (1000 * tf + 8 * m[row])


def _search(batches, index, weight: np.ndarray, docs: int, total: int, p: Params) -> Iterator[pa.RecordBatch]:
    index = index.value
    items = len(index.ids)
    heaps, width = Heaps(items, p.top), max(1, p.cells // max(items, 1))
    size = np.diff(index.at)
    for batch in batches:
        for rows, data, off in pieces(batch, "text"):
            row, term, tf, n = index.hits(data, off)
            on = weight[term] > 0
            row, term, tf = row[on], term[on], tf[on]
            value = weight[term] * _gain(tf.astype(np.int64), n.astype(np.int64), row, docs, total)
            ids = batch.column("doc_id")[rows.start:rows.stop]
            doc, void = np.asarray(ids.fill_null(0)), np.asarray(ids.is_null())
            # runs of rows whose scores and whose met postings both fit
            met = np.concatenate([[0], np.cumsum(size[term])])
            first = np.searchsorted(row, np.arange(len(n) + 1))
            a = 0
            while a < len(n):
                b = int(np.searchsorted(met[first], met[first[a]] + 4 * p.cells, side="right")) - 1
                b = max(a + 1, min(b, a + width, len(n)))
                on = slice(first[a], first[b])
                each = np.repeat(np.arange(first[b] - first[a]), size[term[on]])
                begin = index.at[term[on]] - (met[first[a]:first[b]] - met[first[a]])
                post = begin[each] + np.arange(len(each))
                cell = (row[on][each] - a) * items + index.item[post]
                part = value[on][each] * index.count[post]
                if len(part) and int(part.max()) * len(part) < 1 << 53:
                    score = np.bincount(cell, weights=part, minlength=(b - a) * items).astype(np.int64)
                else:
                    score = np.zeros((b - a) * items, dtype=np.int64)
                    np.add.at(score, cell, part)
                score = score.reshape(b - a, items)
                d, i = np.nonzero(score >= heaps.floor)
                if len(d):
                    heaps.offer(i, score[d, i], doc[a:b][d], void[a:b][d])
                a = b
    part = TaskContext.get().partitionId()
    yield pa.RecordBatch.from_arrays(
        [index.ids.take(pa.array(heaps.item)), pa.array(heaps.doc, mask=heaps.void), pa.array(heaps.score),
         pa.array(np.full(len(heaps.item), part))], ["item_id", "doc_id", "score", "part"])


def _best(found: DataFrame, by: list[str], p: Params) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.top)


def _blocks(terms: DataFrame, p: Params) -> tuple[DataFrame, int]:
    """Items dealt into blocks of at most ``postings`` entries, or of one item."""
    total, most = terms.count(), None
    n = max(1, -(-total // p.postings))
    while True:
        dealt = terms.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(n)))
        if n == 1:
            return dealt, n
        most = dealt.groupBy("block").agg(F.count("*").alias("k"), F.min("item_id").alias("lo"), F.max("item_id").alias("hi"),
                                          F.count_if(F.col("item_id").isNull()).alias("void"))
        if most.where((F.col("k") > p.postings) & ((F.col("lo") < F.col("hi")) | (F.col("void") > 0) & F.col("lo").isNotNull())).isEmpty():
            return dealt, n
        n *= 2


def search(docs: DataFrame, items: DataFrame, p: Params = Params()) -> DataFrame:
    """(item_id, rank, doc_id, score): the best ``top`` documents of every item."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    asked = (items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
             .where("text IS NOT NULL").groupBy("item_id").agg(F.max(F.struct(F.length("text").alias("n"), "text")).alias("t"))
             .select("item_id", "t.text"))
    terms = keep(asked.mapInArrow(_item_terms, "item_id long, term long, check long, count long"), "search-terms")
    terms, blocks = _blocks(terms, p)
    found = None
    for b in range(blocks):
        entries = terms.where(F.col("block") == b).drop("block").toArrow()
        if not entries.num_rows:
            continue
        index = docs.sparkSession.sparkContext.broadcast(Index(entries))
        counts = (texts.select("text").mapInArrow(lambda it, i=index: _counts(it, i), "term long, n long")
                  .groupBy("term").agg(F.sum("n").alias("n")).toArrow())
        n_of = dict(zip(counts["term"].to_pylist(), counts["n"].to_pylist()))
        n_docs, total = n_of.pop(-1, 0), n_of.pop(-2, 0)
        df = np.zeros(len(index.value.term), dtype=np.int64)
        df[list(n_of)] = list(n_of.values())
        heaps = texts.mapInArrow(lambda it, i=index, w=weights(df, n_docs): _search(it, i, w, n_docs, total, p),
                                 "item_id long, doc_id long, score long, part long")
        heaps = keep(_best(heaps.withColumn("part", F.pmod("part", F.lit(p.merge))), ["item_id", "part"], p).drop("rank"), "search-heaps")
        index.unpersist()
        found = heaps if found is None else found.union(heaps)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "item_id long, doc_id long, score long, part long")
    return _best(found, ["item_id"], p).select("item_id", "rank", "doc_id", "score")


_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The same in SQL; ``{docs}`` and ``{items}`` name the tables.
SEARCH_SQL = r"""
asked AS (
  SELECT item_id, max_by(text, (length(text), text)) AS text FROM {items} WHERE text IS NOT NULL GROUP BY item_id),
item_terms AS (
  SELECT item_id, term, count(*) AS repeats FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, '""" + _LETTERS + "', '" + _LETTERS.lower() + r"""'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM asked) GROUP BY ALL),
doc_terms AS (
  SELECT doc, doc_id, term FROM (
    SELECT doc, doc_id, unnest(regexp_extract_all(translate(text, '""" + _LETTERS + "', '" + _LETTERS.lower() + r"""'),
           '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM {docs}))),
sizes AS (SELECT doc, count(*) AS n FROM doc_terms GROUP BY doc),
whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM sizes),
counts AS (SELECT doc, doc_id, term, count(*) AS tf FROM doc_terms SEMI JOIN item_terms USING (term) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counts, whole GROUP BY term, docs),
scores AS (
  SELECT item_id, doc, doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
  FROM counts JOIN sizes USING (doc) JOIN weights USING (term) JOIN item_terms USING (term), whole
  GROUP BY item_id, doc, doc_id),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
  FROM scores WHERE score > 0 QUALIFY rank <= 10)
"""
