"""Repeated byte strings by run-length indexes (run-compressed Burrows-Wheeler
transforms with sampled run ends).

Wanted: every byte of a text covered by a string of ``length`` bytes that also
starts earlier (in a text with a smaller id, or earlier in the same text).

Bringing repeats together. Every window of ``length`` bytes names an anchor: the
``gram``-byte string inside it with the smallest hash (the leftmost of equal
ones). Equal windows name equal anchors at equal places, so a window is only
ever compared with windows of the same anchor. Consecutive windows with one
anchor are one piece of text. Anchors that occur once are dropped; equal pieces
are one piece, all but the first of them being repeats as a whole.

The index. The different pieces that share anchors are dealt to buckets by
anchor. A bucket's pieces, in corpus order, are one repetitive text; its
Burrows-Wheeler transform is run-compressed, and at each run's first row the
suffix's place, its predecessor and their common length are kept. Reading the
text from left to right, the matching statistics of every position follow from
the last sample before it (the predecessor moves along, the common length
shrinks by one), which gives each window's class of equal windows and so the
first of them. Windows that are not the first of their class are marked.

Hot anchors, with more than ``hot`` different pieces (say, a short line found in
a third of all texts), do not meet in one bucket: their windows are keyed by a
128-bit hash of the window itself and the first of each is a grouped minimum.

Defined results: a null text is an empty text; texts shorter than ``length``
lose nothing; a row with a null id loses nothing and repeats nothing; rows with
one doc_id stand at one place (exactly repeated rows do not repeat each other);
of several texts with one doc_id the one that counts is the longest in bytes
(ties: the greatest hash), rows with another one lose nothing and repeat nothing;
matches never cross texts; a text of 256 MB or more is an error; other columns
are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quarry.llm.store import id_text, keep
from quarry.llm.textbytes import Rolling, mix, pieces

U = np.uint64
CUT = 2 << 20      # bytes of text that a task looks at together
PLACE_BITS = 28    # of a place in those bytes, beside the hash's first bits
HASH = Rolling(71)
SECOND = Rolling(73)


@dataclass(frozen=True)
class Params:
    length: int = 100
    gram: int = 32
    hot: int = 8192            # different pieces of an anchor that may share a bucket
    bucket_bytes: int = 1 << 20


def anchors(data: np.ndarray, off: np.ndarray, p: Params):
    """Pieces of some texts: first byte, end, anchor's place, and the hash sums."""
    n, w = len(data), p.length - p.gram + 1
    sums = HASH.sums(data)
    none = np.zeros(0, np.int64)
    if n < p.length:
        return none, none, none, sums
    if n >= 1 << PLACE_BITS:
        raise ValueError("a text of 256 MB or more")
    at = np.arange(n - p.gram + 1)
    low = (HASH.of(sums, at, at + p.gram) >> U(PLACE_BITS)) << U(PLACE_BITS) | at.astype(np.uint64)
    width = 1
    while 2 * width <= w:  # minimum of 2, 4, 8 ... places, then of w
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if w > width:
        low = np.minimum(low[:width - w], low[w - width:])
    inside = np.zeros(n + 1, dtype=np.int64)  # windows that stay in their text
    good = np.maximum(np.diff(off) - p.length + 1, 0)
    has = np.flatnonzero(good)
    np.add.at(inside, off[has], 1)
    np.add.at(inside, off[has] + good[has], -1)
    start = np.flatnonzero(np.cumsum(inside)[:len(low)] > 0)
    if not len(start):
        return none, none, none, sums
    anchor = (low[start] & U((1 << PLACE_BITS) - 1)).astype(np.int64)
    new = np.ones(len(start), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    return start[first], start[last] + p.length, anchor[first], sums


def _anchor_counts(batches, p: Params):
    for batch in batches:
        for _, data, off in pieces(batch, "text", CUT):
            _, _, anchor, sums = anchors(data, off, p)
            h, n = np.unique(HASH.of(sums, anchor, anchor + p.gram), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n)], ["anchor", "n"])


def _spans(doc: np.ndarray, lo: np.ndarray, end: np.ndarray):
    """Overlapping or touching spans of one text joined."""
    if not len(doc):
        return doc, lo, end
    order = np.lexsort((lo, doc))
    doc, lo, end = doc[order], lo[order], end[order]
    base = np.concatenate([[0], np.cumsum(doc[1:] != doc[:-1])]) * (1 << 40)
    reach = np.maximum.accumulate(base + end)
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (base + lo)[1:] > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], lo[first], (reach - base)[last]


PIECES = "mark boolean, anchor long, piece long, doc_id long, lo int, size int"


def _pieces(batches, p: Params):
    """One row for each different piece of some texts (its first place); equal
    later ones are repeats already: rows that are marks, under a key of their own."""
    for batch in batches:
        ids = batch.column("doc_id").to_numpy()
        for rows, data, off in pieces(batch, "text", CUT):
            lo, end, anchor, sums = anchors(data, off, p)
            h, whole = HASH.of(sums, anchor, anchor + p.gram), HASH.of(sums, lo, end)
            row = np.searchsorted(off, lo, side="right") - 1
            doc = ids[rows][row]
            lo, end = lo - off[row], end - off[row]
            order = np.lexsort((lo, doc, whole, h))
            h, whole, doc, lo, end = h[order], whole[order], doc[order], lo[order], end[order]
            new = np.ones(len(h), dtype=bool)
            new[1:] = (h[1:] != h[:-1]) | (whole[1:] != whole[:-1])
            group = np.cumsum(new) - 1
            lead = np.flatnonzero(new)
            again = np.zeros(len(h), dtype=bool)
            if len(h):
                again = (doc != doc[lead][group]) | (lo != lo[lead][group])
            d, a, e = _spans(doc[again], lo[again], end[again])
            own = mix(d.astype(np.uint64) * U(0x9E3779B97F4A7C15) + a.astype(np.uint64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat([False, True], [len(lead), len(d)])),
                 pa.array(np.concatenate([h[new], own]).view(np.int64)),
                 pa.array(np.concatenate([whole[new], np.zeros(len(d), np.uint64)]).view(np.int64)),
                 pa.array(np.concatenate([doc[new], d])), pa.array(np.concatenate([lo[new], a]).astype(np.int32)),
                 pa.array(np.concatenate([end[new] - lo[new], e - a]).astype(np.int32))],
                ["mark", "anchor", "piece", "doc_id", "lo", "size"])


def _cut(batches, p: Params):
    """The bytes of the wanted pieces; those of hot anchors as window hashes."""
    for batch in batches:
        out = {k: [] for k in ("anchor", "doc_id", "lo", "bytes", "w1", "w2")}
        text = batch.column("text")
        for i, doc in enumerate(batch.column("doc_id").to_pylist()):
            data = text[i].as_buffer()
            whole = np.frombuffer(data, np.uint8)
            for want in batch.column("wanted")[i].as_py():
                lo, size = want["lo"], want["size"]
                if not want["hot"]:
                    out["anchor"].append(want["anchor"])
                    out["doc_id"].append(doc)
                    out["lo"].append(lo)
                    out["bytes"].append(data[lo:lo + size].to_pybytes())
                    out["w1"].append(None)
                    out["w2"].append(None)
                    continue
                part = whole[lo:lo + size]
                at = np.arange(size - p.length + 1)
                for k, r in (("w1", HASH), ("w2", SECOND)):
                    out[k] += r.of(r.sums(part), at, at + p.length).view(np.int64).tolist()
                n = len(at)
                out["anchor"] += [None] * n
                out["doc_id"] += [doc] * n
                out["lo"] += (lo + at).tolist()
                out["bytes"] += [None] * n
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], list(out))


class RunIndex:
    """The run-compressed transform of some pieces, each closed by an end mark
    of its own, and what is sampled at its runs."""

    def __init__(self, parts: list[bytes]):
        size = np.array([len(x) for x in parts], dtype=np.int64)
        self.end = np.cumsum(size + 1) - 1          # places of the end marks
        self.n = int(self.end[-1]) + 1
        text = np.zeros(self.n, dtype=np.int64)     # bytes + 1; 0 at end marks
        inner = np.ones(self.n, dtype=bool)
        inner[self.end] = False
        text[inner] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int64) + 1
        self.text = text
        self.left = np.repeat(self.end, size + 1) - np.arange(self.n)  # bytes before the end mark
        order = self._suffixes(int(size.max()) + 1)
        before = np.concatenate([[-1], text[:-1]])[order]
        # runs of equal preceding bytes; an end mark equals no other
        head = np.ones(self.n, dtype=bool)
        head[1:] = (before[1:] != before[:-1]) | (before[1:] <= 0)
        rows = np.flatnonzero(head)
        self.runs = len(rows)
        place, prior = order[rows], np.where(rows > 0, order[rows - 1], 0)
        common = self._common(place, prior)
        common[rows == 0] = 0
        by = np.argsort(place)
        self.place, self.prior, self.common = place[by], prior[by], common[by]

    def _suffixes(self, longest: int) -> np.ndarray:
        """Suffix order by doubling, of the rows that are not settled yet."""
        n, text, left = self.n, self.text, self.left
        key = np.zeros(n, dtype=np.int64)
        for k in range(7):  # seven 9-bit symbols; nothing after an end mark
            key <<= 9
            key[:n - k] |= np.where(left[:n - k] >= k, text[k:], 0)
        order = np.argsort(key, kind="stable")
        sorted_key, short = key[order], left[order] < 7
        new = np.ones(n, dtype=bool)
        new[1:] = (sorted_key[1:] != sorted_key[:-1]) | short[1:]  # end marks rank by place
        rank = np.empty(n, dtype=np.int64)
        lead = np.flatnonzero(new)
        rank[order] = lead[np.cumsum(new) - 1]
        step = 7
        while step < longest:
            group = np.cumsum(new) - 1
            many = np.flatnonzero(np.diff(np.append(np.flatnonzero(new), n))[group] > 1)
            if not len(many):
                break
            at = order[many]
            after = rank[np.minimum(at + step, n - 1)]
            own = rank[at]
            by = np.argsort(own * n + after)
            at, after, own = at[by], after[by], own[by]
            order[many] = at
            fresh = np.ones(len(many), dtype=bool)
            fresh[1:] = (own[1:] != own[:-1]) | (after[1:] != after[:-1])
            new[many] = fresh
            lead = np.flatnonzero(new)
            rank[at] = lead[(np.cumsum(new) - 1)[many]]
            step *= 2
        return order

    def _common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffix pairs (within their pieces)."""
        most = np.minimum(self.left[a], self.left[b])
        out = np.zeros(len(a), dtype=np.int64)
        live = np.flatnonzero(most > 0)
        while len(live):
            same = self.text[a[live] + out[live]] == self.text[b[live] + out[live]]
            live = live[same]
            out[live] += 1
            live = live[out[live] < most[live]]
        return out

    def statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """Of every place: the place of its suffix's predecessor, and the length
        of their match, streamed from the samples."""
        last = np.zeros(self.n, dtype=np.int64)
        last[self.place] = np.arange(len(self.place))
        last = np.maximum.accumulate(last)
        far = np.arange(self.n) - self.place[last]
        return self.prior[last] + far, self.common[last] - far

    def firsts(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where a window of ``length`` starts, and the first place of an
        equal window."""
        prior, match = self.statistics()
        up = np.where(match >= length, prior, np.arange(self.n))
        start = np.flatnonzero(self.left >= length)
        while True:  # pointer jumping along predecessors that share the window
            jump = up[up]
            if (jump == up).all():
                break
            up = jump
        low = np.full(self.n, self.n, dtype=np.int64)
        np.minimum.at(low, up[start], start)
        return start, low[up[start]]


def _index(table: pa.Table, p: Params) -> pa.Table:
    """Marks of one bucket: windows with an earlier equal one, as spans."""
    table = table.combine_chunks().sort_by([("doc_id", "ascending"), ("lo", "ascending")])
    doc, lo = table["doc_id"].to_numpy(), table["lo"].to_numpy().astype(np.int64)
    once = np.ones(len(doc), dtype=bool)  # repeated rows stand at one place
    once[1:] = (doc[1:] != doc[:-1]) | (lo[1:] != lo[:-1])
    doc, lo, parts = doc[once], lo[once], table["bytes"].filter(pa.array(once)).to_pylist()
    index = RunIndex(parts)
    start, first = index.firsts(p.length)
    again = start[first < start]
    piece = np.searchsorted(index.end, again)
    begin = np.concatenate([[0], index.end[:-1] + 1])
    at = lo[piece] + again - begin[piece]
    d, a, e = _spans(doc[piece], at, at + p.length)
    return pa.table({"doc_id": pa.array(d), "lo": pa.array(a.astype(np.int32)), "size": pa.array((e - a).astype(np.int32))})


MARKS = "doc_id long, lo int, size int"


def repeats(texts: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, lo, size): spans to remove, which may overlap. ``texts``:
    (doc_id, text) without null ids."""
    often = (texts.select("text").mapInArrow(lambda it: _anchor_counts(it, p), "anchor long, n long")
             .groupBy("anchor").agg(F.sum("n").alias("n")).where("n > 1").select("anchor", F.lit(True).alias("often")))
    shared = (texts.mapInArrow(lambda it: _pieces(it, p), PIECES).join(often, "anchor", "left")
              .where("mark OR often").drop("often").repartition("anchor", "piece"))
    first = F.first(F.struct("doc_id", "lo")).over(Window.partitionBy("anchor", "piece").orderBy("doc_id", "lo"))
    shared = keep(shared.withColumn("again", F.col("mark") | (F.struct("doc_id", "lo") != first)), "repeats-pieces")
    reps = shared.where("NOT again").dropDuplicates(["anchor", "piece"]).drop("again", "mark")
    kinds = reps.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = (reps.join(kinds, "anchor").withColumn("hot", F.col("kinds") > p.hot).groupBy("doc_id")
              .agg(F.collect_list(F.struct("anchor", "lo", "size", "hot")).alias("wanted")))
    cut = keep(texts.join(wanted, "doc_id").mapInArrow(
        lambda it: _cut(it, p), "anchor long, doc_id long, lo int, bytes binary, w1 long, w2 long"), "repeats-bytes")
    size = cut.agg(F.coalesce(F.sum(F.length("bytes")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // p.bucket_bytes))
    marked = (cut.where("bytes IS NOT NULL").withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)))
              .groupBy("bucket").applyInArrow(lambda t: _index(t, p), MARKS))
    windows = cut.where("bytes IS NULL")
    early = windows.groupBy("w1", "w2").agg(F.min(F.struct("doc_id", "lo")).alias("first"),
                                            F.max(F.struct("doc_id", "lo")).alias("last")).where("first <> last")
    hot = (windows.join(early, ["w1", "w2"]).where(F.struct("doc_id", "lo") != F.col("first"))
           .select("doc_id", "lo", F.lit(p.length).alias("size")))
    return shared.where("again").select("doc_id", "lo", "size").union(marked).union(hot)


def _kept(batches):
    for batch in batches:
        rows = {k: [] for k in ("n_bytes", "n_removed", "spans", "kept")}
        text = batch.column("text")
        for i, spans in enumerate(batch.column("spans")):
            data = text[i].as_buffer().to_pybytes() if text[i].as_buffer() is not None else b""
            merged: list[list[int]] = []
            for lo, size in sorted((s["lo"], s["size"]) for s in spans.as_py() or ()):
                if merged and lo <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], lo + size)
                else:
                    merged.append([lo, lo + size])
            left, at = [], 0
            for lo, end in merged:
                left.append(data[at:lo])
                at = end
            left.append(data[at:])
            rows["n_bytes"].append(len(data))
            rows["n_removed"].append(sum(e - s for s, e in merged))
            rows["spans"].append([{"start": s, "end": e} for s, e in merged])
            rows["kept"].append(b"".join(left))
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(rows["n_bytes"], pa.int64()), pa.array(rows["n_removed"], pa.int64()),
             pa.array(rows["spans"], span), pa.array(rows["kept"], pa.binary())],
            ["doc_id", "n_bytes", "n_removed", "spans", "kept"])


def dedup(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept): the removed spans of every
    row's text in bytes, and the remaining bytes."""
    texts = id_text(docs)
    # ids with several texts, and the text of each that counts: 24 bytes a row, combined where the rows lie
    mark = F.struct(F.octet_length("text").alias("n"), F.xxhash64("text").alias("h"))
    several = keep(texts.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min(mark).alias("least"), F.max(mark).alias("most"))
                   .where("least <> most").select("doc_id", F.col("most.h").alias("counts")), "repeats-ids")
    texts = texts.join(several, "doc_id", "left").withColumn(
        "own", F.col("doc_id").isNotNull() & (F.col("counts").isNull() | (F.col("counts") == F.xxhash64("text")))).drop("counts")
    spans = (repeats(texts.where("own").drop("own"), p).groupBy("doc_id")
             .agg(F.collect_set(F.struct("lo", "size")).alias("spans")))
    texts = texts.join(spans, "doc_id", "left").select("doc_id", "text", F.when(F.col("own"), F.col("spans")).alias("spans"))
    return texts.mapInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: int, end: int>>, kept binary")
