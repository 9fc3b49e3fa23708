"""Language-model scoring by prediction by partial matching (PPM).

Texts are read as byte streams: the words (A-Z lower-cased) with one space
between them, an end byte after the last, ``order`` end bytes before the first. The
model is the trie of all contexts of up to ``order`` bytes in the learned texts, with
the counts of the bytes that followed them. A byte is predicted in the longest
context that has occurred; if it never followed there, the model escapes to the
next shorter one (estimation D: every first occurrence of a byte gives half a
count to the escape) and excludes the bytes that the longer context had already
offered; below order 0 the bytes never seen share what is left. Beside it a word
unigram model gives the baseline.

How it runs: texts are dealt to blocks of about ``block_bytes`` by a hash of the
id. Each block reports its distinct strings (a longest context and its
byte) and words with their learned counts; the sums over blocks are the trie's
leaves, and the counts of shorter contexts are sums of those. The probability of
every distinct string is worked out with joins on that table, and each block
gets back the numbers of its own strings and words only. So nothing that grows
with the corpus passes through the driver or one task: a block's report is
bounded by its size, and a word that all texts use is one row per block.

Defined results: a null text is an empty text (its end byte and end token are
scored); a null id counts as held out; repeated rows are learned and scored
each; without learned texts every byte has probability 1/256 and the baseline's
formula is kept (c = N = V = 0); other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quarry.llm.store import id_text, keep
from quarry.llm.textbytes import LOWER_CODE, SPACE, WORDS, _LOWER, buffers, word_ranges

U = np.uint64
END, GAP = 10, 32
PIECE = 2 << 20
WORD, STRING = 0, 1  # kinds of keys


@dataclass(frozen=True)
class Params:
    order: int = 5  # bytes of the longest context; a context and its byte fit a positive long up to 6
    block_bytes: int = 24 << 20


def stream(data: np.ndarray, off: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of some texts: the string (context and byte) that ends at every scored byte, the
    rows' offsets into those; the word hashes and the rows' offsets into them."""
    rows = len(off) - 1
    inside = ~SPACE[data] if len(data) else np.zeros(0, bool)
    s, e, at = word_ranges(data, off, inside)
    hashes = WORDS.of(WORDS.sums(data, LOWER_CODE), s, e) if len(s) else np.zeros(0, np.uint64)
    n = np.diff(at)
    lead = np.arange(1, rows + 1) * order + np.concatenate([[0], np.cumsum(n == 0)[:-1]]) if rows else np.zeros(0, int)
    word_row = np.repeat(np.arange(rows), n)
    before = np.arange(len(s)) + lead[word_row] if len(s) else np.zeros(0, int)  # bytes put before each word, beside words' own
    where = np.arange(int(inside.sum())) + np.repeat(before, e - s)
    row_bytes = np.bincount(word_row, e - s + 1, rows).astype(np.int64) if len(s) else np.zeros(rows, np.int64)
    row_bytes[n == 0] = 1
    to = np.concatenate([[0], np.cumsum(row_bytes)])
    full = np.full(to[-1] + rows * order, GAP, dtype=np.uint8)
    full[where] = _LOWER[data[inside]]
    first = to[:-1] + np.arange(rows) * order
    for k in range(order):
        full[first + k] = END
    full[first + order + row_bytes - 1] = END
    string = np.zeros(len(full) - order if rows else 0, dtype=np.uint64)
    for k in range(order + 1):
        string = string << U(8) | full[k:k + len(string)].astype(np.uint64)
    scored = np.ones(len(string), dtype=bool)
    for k in range(order):  # strings that end in a row's leading end bytes
        if rows > 1:
            scored[first[1:] + k - order] = False
    return string[scored], to, hashes, at


def _counted(keys: np.ndarray, learned: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and how often each is learned."""
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    if learned.all():
        return np.unique(keys, return_counts=True)
    own, n = np.unique(keys[learned], return_counts=True)
    all_ = np.unique(keys)
    out = np.zeros(len(all_), np.int64)
    out[np.searchsorted(all_, own)] = n
    return all_, out


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
    if not len(keys):
        return keys, n
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[new], np.add.reduceat(n, new)


def _texts(table: pa.Table):
    """Runs of rows of a block: (first row, bytes, offsets)."""
    row = 0
    for batch in table.select(["text"]).to_batches():
        data, off = buffers(batch.column(0))
        a = 0
        while a < len(off) - 1:
            b = max(a + 1, int(np.searchsorted(off, off[a] + PIECE, side="right")) - 1)
            yield row + a, data[off[a]:off[b]], off[a:b + 1] - off[a]
            a = b
        row += len(off) - 1


def _report(table: pa.Table, order: int) -> pa.Table:
    """(block, kind, key, n) of a block: its distinct strings and words with
    their learned counts."""
    learn = table["learn"].to_numpy()
    strings, found = [], []
    for row, data, off in _texts(table):
        string, to, hashes, at = stream(data, off, order)
        mine = learn[row:row + len(off) - 1]
        strings.append(_counted(string, np.repeat(mine, np.diff(to))))
        found.append(_counted(hashes, np.repeat(mine, np.diff(at))))
    empty = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    (sk, sn), (wk, wn) = _merged(strings or [empty]), _merged(found or [empty])
    return pa.table({
        "block": pa.array(np.full(len(sk) + len(wk), table["block"][0].as_py(), np.int32)),
        "kind": pa.array(np.repeat(np.array([STRING, WORD], np.int8), [len(sk), len(wk)])),
        "key": pa.array(np.concatenate([sk, wk]).view(np.int64)), "n": pa.array(np.concatenate([sn, wn]))})


class Lookup:
    """Values by 64-bit key: one probe for most keys, binary search for the rest."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.bits = max(8, int(len(keys) * 4).bit_length())
        self.table = np.zeros(1 << self.bits, dtype=np.int32)
        self.table[self._slot(self.keys)] = np.arange(len(keys))

    def _slot(self, keys):
        return (keys * U(0x9E3779B97F4A7C15)) >> U(64 - self.bits)

    def of(self, keys: np.ndarray, missing: float) -> np.ndarray:
        if not len(self.keys) or not len(keys):
            return np.full(len(keys), missing)
        at = self.table[self._slot(keys)]
        out = self.values[at]
        far = np.flatnonzero(self.keys[at] != keys)
        if len(far):
            k = np.minimum(np.searchsorted(self.keys, keys[far]), len(self.keys) - 1)
            out[far] = np.where(self.keys[k] == keys[far], self.values[k], missing)
        return out


def _score(texts: pa.Table, numbers: pa.Table, order: int, total: int, kinds: int, ends: int) -> pa.Table:
    """One row for each text of a block, from the numbers sent back to it."""
    learn, parts = texts["learn"].to_numpy(), []
    kind, key = numbers["kind"].to_numpy(), numbers["key"].to_numpy().view(np.uint64)
    value = numbers["value"].to_numpy()
    prob = Lookup(key[kind == STRING], value[kind == STRING])
    shared = Lookup(key[kind == WORD], value[kind == WORD])
    found = [] if texts.num_rows else [(np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for row, data, off in _texts(texts):
        mine = learn[row:row + len(off) - 1]
        s, e, at = word_ranges(data, off, ~SPACE[data])
        h = WORDS.of(WORDS.sums(data, LOWER_CODE), s, e) if len(s) else np.zeros(0, np.uint64)
        found.append(_counted(h, np.repeat(mine, np.diff(at))))
    own = Lookup(*_merged(found))  # words of this block alone are not sent: their counts are its own
    floor = np.log10(total + kinds + 1)
    for row, data, off in _texts(texts):
        string, to, hashes, at = stream(data, off, order)
        rows = len(off) - 1
        mine = learn[row:row + rows]
        score = np.add.reduceat(prob.of(string, -np.log10(256)), to[:-1])
        c = shared.of(hashes, -1.0)
        alone = np.flatnonzero(c < 0)
        c[alone] = own.of(hashes[alone], 0.0)
        of = np.repeat(np.arange(rows), np.diff(at))
        base = np.bincount(of, np.log10(c + 1), rows) + np.log10(ends + 1) - (np.diff(at) + 1) * floor
        parts.append(pa.table({
            "doc_id": texts["doc_id"].slice(row, rows), "learn": pa.array(mine), "n_tokens": pa.array(np.diff(at) + 1),
            "n_known": pa.array(np.bincount(of, c > 0, rows).astype(np.int64) + int(ends > 0)),
            "train_tokens": pa.array(np.full(rows, total, np.int64)), "base_score": pa.array(base), "score": pa.array(score)}))
    return pa.concat_tables(parts)


SCORES = ("doc_id long, learn boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _low(k: int):
    """The last ``k + 1`` bytes of a string: its context of order k and its byte."""
    return F.col("string").bitwiseAND(F.lit((1 << 8 * (k + 1)) - 1))


def probabilities(strings: DataFrame, order: int) -> DataFrame:
    """(string, logp): log10 of the last byte's probability after the others.
    ``strings``: (string, n), all distinct strings with their learned counts."""
    seen, contexts = {}, {}
    below = strings.where("n > 0").withColumnRenamed("n", "c")
    for k in range(order, -1, -1):  # counts of shorter contexts are sums of the longer ones'
        if k < order:
            below = below.groupBy(_low(k).alias("string")).agg(F.sum("c").alias("c"))
        seen[k] = below = keep(below, f"ppm-order{k}")
    for k in range(order + 1):
        each = seen[k].withColumn("ctx", F.shiftright("string", 8))
        if k:  # of the context's bytes, their counts one order below: what an escape excludes there
            each = each.withColumn("s", F.col("string").bitwiseAND(F.lit((1 << 8 * k) - 1))).join(
                seen[k - 1].select(F.col("string").alias("s"), F.col("c").alias("x")), "s")
        else:
            each = each.withColumn("x", F.lit(0).cast("long"))
        contexts[k] = each.groupBy("ctx").agg(F.sum("c").alias(f"total{k}"), F.count("*").alias(f"kinds{k}"), F.sum("x").alias(f"also{k}"))
    out = strings.select("string")
    for k in range(order, -1, -1):
        out = (out.withColumn("low", _low(k)).withColumn("ctx", F.shiftright("low", 8))
               .join(seen[k].select(F.col("string").alias("low"), F.col("c").alias(f"c{k}")), "low", "left")
               .join(contexts[k], "ctx", "left").drop("low", "ctx"))
    logp, escaped = F.lit(None).cast("double"), F.lit(0.0)
    for k in range(order, -1, -1):
        c, total, kinds = F.col(f"c{k}"), F.col(f"total{k}"), F.col(f"kinds{k}")
        if k < order:  # the bytes of the next longer context, if it has occurred, are excluded
            total, kinds = (total - F.coalesce(f"also{k + 1}", F.lit(0)), kinds - F.coalesce(f"kinds{k + 1}", F.lit(0)))
        logp = F.coalesce(logp, escaped + F.log10((c - 0.5) / total))
        escaped = escaped + F.when(kinds > 0, F.log10(0.5 * kinds / total)).otherwise(0.0)
    unseen = escaped - F.log10(256 - F.coalesce("kinds0", F.lit(0)))
    return out.select("string", F.coalesce(logp, unseen).alias("logp"))


def scores(docs: DataFrame, learned, p: Params = Params()) -> DataFrame:
    """``SCORES`` for every row; ``learned(doc_id)`` says which ids are learned from."""
    texts = id_text(docs).select("doc_id", "text", F.coalesce(learned(F.col("doc_id")), F.lit(False)).alias("learn"))
    size, ends = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
                           F.coalesce(F.sum(F.col("learn").cast("long")), F.lit(0))).first()
    blocks = max(1, -(-size // p.block_bytes))
    texts = texts.select(F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(blocks)).cast("int").alias("block"),
                         "doc_id", "text", "learn")
    keys = keep(texts.groupBy("block").applyInArrow(lambda t: _report(t, p.order), "block int, kind byte, key long, n long")
                .groupBy("kind", "key").agg(F.sum("n").alias("n"), F.collect_list("block").alias("blocks")), "ppm-keys")
    total, kinds = keys.where(F.col("kind") == WORD).agg(
        F.coalesce(F.sum("n"), F.lit(0)), F.count(F.when(F.col("n") > 0, 1))).first()
    total, kinds = total + ends, kinds + (ends > 0)
    strings = keys.where(F.col("kind") == STRING).select(F.col("key").alias("string"), "n", "blocks")
    logp = probabilities(strings.select("string", "n"), p.order)
    back = (strings.join(logp, "string").select(F.explode("blocks").alias("block"), F.lit(STRING).cast("byte").alias("kind"),
                                                F.col("string").alias("key"), F.col("logp").alias("value"))
            .union(keys.where((F.col("kind") == WORD) & (F.size("blocks") > 1))
                   .select(F.explode("blocks").alias("block"), "kind", "key", F.col("n").cast("double").alias("value"))))
    return texts.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        lambda t, n: _score(t, n, p.order, total, kinds, ends), SCORES)
