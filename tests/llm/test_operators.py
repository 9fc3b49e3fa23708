"""Each operator against its plain version, and on nulls, empty texts, ties,
repeated rows, empty tables and clashing extra columns."""

import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from conftest import SF_SMALL
from quarry.llm import bpe, decontam, html, lines, minhash, ppm, quality, queries, rindex, toxicity, vectors
from quarry.llm.components import components
from quarry.llm.store import id_text, read_table

SYL = "ba co di fu ge hi jo ku la mi no pu ra se ti vo".split()
#: Extra columns named like the operators' own work columns.
EXTRA = "doc_id long, text string, anchor long, component string, n int, row string, lines int, score double, label int"


def words(rng, n):
    return [rng.choice(SYL) + rng.choice(SYL) + rng.choice(["", rng.choice(SYL)]) for _ in range(n)]


def table(spark, rows):
    return spark.createDataFrame([(i, t, None, "x", None, "r", 3, None, 1) for i, t in rows], EXTRA)


@pytest.fixture(scope="module")
def texts():
    """Ids and texts with copies, near copies, shared passages, ties and odd ones."""
    rng = random.Random(4)
    out = {}
    shared = ["\n".join(" ".join(words(rng, 9)) for _ in range(6)) for _ in range(3)]
    for i in range(40):
        body = [" ".join(words(rng, rng.randint(4, 14))) for _ in range(rng.randint(1, 6))]
        if i % 4 == 1:
            body.insert(rng.randint(0, len(body)), shared[i % 3])
        out[i] = "\n".join(body)
    out[41] = out[3]
    w = " ".join(words(rng, 60)).split(" ")
    out[42] = " ".join(w)
    for k in range(43, 50):
        v = list(w)
        v[rng.randrange(60)] = "zzz"
        out[k] = " ".join(v)
    out |= {50: "", 51: None, 52: " \n\t ", 53: "ab " * 300, 54: "ab " * 200, 55: "\n\n\n", 56: "один два три " * 30,
            57: "één", 58: "x" * 5000}
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    return table(spark, [*texts.items(), (None, "a text without id " * 20), (None, None)]).repartition(5).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, []).where("false")


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(1000, 1000 + k) for k in range(50)]
    edges += [(2000 + k, 2001 + k) for k in range(30)]
    pairs = {frozenset(e) for e in edges}
    ids = sorted({x for e in edges for x in e})
    want = brute.groups(ids, lambda a, b: frozenset((a, b)) in pairs)
    got = dict(components(spark.createDataFrame(edges, "a long, b long").repartition(7), "t").collect())
    assert got == {i: c for i, c in want.items() if any(a != b for a, b in edges if i in (a, b))}


# 1 ---------------------------------------------------------------------------

def test_machine_learns_pairs_of_terms():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(3000):
        a, b = (rng.random(2) < 0.5).tolist()
        rows.append([0] * a + [1] * b + sorted(rng.choice(np.arange(2, 12), 3, replace=False).tolist()))
        y.append(float(a and b))
    k = np.concatenate(rows)
    start = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    m = toxicity.learn(np.array(y), k, start, np.arange(12), toxicity.Params(positive=1.0))
    assert ((m.raw(k.astype(np.uint64), start) > 0) == (np.array(y) == 1)).mean() > 0.98
    assert m.v[0] @ m.v[1] > 1


def test_toxicity_held_out(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    out = queries.op1_toxicity(spark, "/root/testdata/sf0.1").join(labels, "doc_id").where("held_out")
    right, caught, toxic, wrong = out.agg(
        F.avg((F.col("predicted") == F.col("toxic")).cast("double")), F.sum(F.col("toxic") * F.col("predicted")),
        F.sum("toxic"), F.sum((1 - F.col("toxic")) * F.col("predicted"))).first()
    assert right > 0.96 and caught > 0.8 * toxic and wrong < 0.01 * out.count()


def test_toxicity_odd_rows(spark, docs, empty, texts):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None), (4, 7)], "doc_id long, toxic int")
    m = toxicity.fit(docs, labels, lambda i: i >= 0)
    got = toxicity.score(docs, m).collect()
    assert len(got) == len(texts) + 2 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[50] == by[51] == by[52]
    assert toxicity.passing(docs, m, 2.0).schema == docs.schema and toxicity.passing(docs, m, 2.0).count() == len(texts) + 2
    none = toxicity.fit(docs, labels.where("false"), lambda i: i >= 0)
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(empty, toxicity.fit(empty, labels, lambda i: i >= 0)).count() == 0


# 2 ---------------------------------------------------------------------------

def test_quality_held_out(spark):
    labels = read_table(spark, "/root/testdata/sf0.01", "labels")
    out = queries.op2_quality(spark, "/root/testdata/sf0.01").join(labels, "doc_id").where("held_out")
    assert out.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.95


def test_quality_odd_rows(spark, docs, empty, texts):
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(None, 1), (3, None)], "doc_id long, quality int")
    got = quality.score(docs, quality.fit(docs, labels, lambda i: i >= 0)).collect()
    assert len(got) == len(texts) + 2 and all(0 <= r.score <= 1 for r in got)
    assert quality.fit(docs, labels.where("quality = 1"), lambda i: i >= 0) is None
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.score(empty, None).count() == 0


# 3 ---------------------------------------------------------------------------

def test_bpe_equals_library(spark, docs, texts, empty):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(bpe.default_path())
    odd = ["", None, "it's THEY'RE I'LL don't", "<|endoftext|>x<|startoftext|> <|endoftext|", "x\x1cy\x85z w\x1f",
           "İstanbul ΑΣ Σ ǅ ﬁ ½ ² Ⅷ ١٢", "é é 가 日本語テスト 🙂👍🏽", "aaaaaaaa abababab !!!??!! $$$###",
           "\t\n a b　c​d﻿q", "word " * 3000, "x" * 3000]
    rows = [*texts.items(), *enumerate(odd, 100), (100, ""), (None, "no id")]
    rows += [(r.doc_id + 1000, r.text) for r in read_table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()]
    table_ = table(spark, rows).repartition(3)
    enc = {i: lib.encode(t or "", add_special_tokens=False).ids for i, t in rows}
    full = {r.doc_id: r for r in bpe.encode(table_).collect()}
    assert {i: r.ids for i, r in full.items()} == enc
    for r in bpe.digests(table_).collect():
        ids, text = enc[r.doc_id], lib.decode(enc[r.doc_id], skip_special_tokens=False)
        assert full[r.doc_id].decoded == text and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode(empty).count() == 0


def test_bpe_cache_does_not_change_results(monkeypatch):
    e = bpe.Encoder(bpe.default_path())
    rng = random.Random(2)
    t = " ".join(words(rng, 400))
    want = e.text(t)
    monkeypatch.setattr(bpe, "PAIRS", 5)
    small = bpe.Encoder(bpe.default_path())
    small.cache = 7
    assert small.text(t) == want


# 4 ---------------------------------------------------------------------------

def test_lines_equal_brute_force(docs, texts, empty):
    want = brute.line_dedup(texts)
    out = lines.dedup_lines(docs).collect()
    assert len(out) == len(texts) + 2
    for r in out:
        if r.doc_id is None:
            assert r.line_dedup.n_removed == 0
        elif texts[r.doc_id] is None:
            assert r.text is None
        else:
            assert (r.text, r.line_dedup.n_removed) == want[r.doc_id], r.doc_id
    assert sum(r.line_dedup.n_removed for r in out) > 10
    assert lines.dedup_lines(docs).columns == [*docs.columns, "line_dedup"]
    assert lines.dedup_lines(empty).count() == 0


def test_lines_repeated_rows_share_a_fate(spark):
    t = "\n".join(f"line number {k}" for k in range(30))
    out = lines.dedup_lines(table(spark, [(1, t), (1, t), (2, t)])).collect()
    assert sorted((r.doc_id, r.line_dedup.n_removed > 0) for r in out) == [(1, False), (1, False), (2, True)]


# 5 ---------------------------------------------------------------------------

@pytest.mark.parametrize("k", [2, 5])
def test_minhash_equals_brute_force(docs, texts, k):
    n, label = brute.near(texts, k)
    got = minhash.groups(docs, minhash.Params(words=k)).collect()
    assert len(got) == len(texts) + 2
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is not None} == {
        i: (n[i], label[i], label[i] == i) for i in texts}
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    assert len(set(label.values())) < len(texts) - 5


def test_minhash_group_of_near_copies(spark, empty):
    """Near copies of one text, many of them too far from each other to link directly."""
    rng = random.Random(8)
    w = words(rng, 150)
    texts = {}
    for i in range(120):
        v = list(w)
        for k in rng.sample(range(150), 5):
            v[k] = f"q{i}k{k}"
        texts[500 + i] = " ".join(v)
    texts[700] = " ".join(w)
    texts |= {800 + i: " ".join(words(rng, 40)) for i in range(60)}
    _, label = brute.near(texts, 2)
    got = minhash.groups(table(spark, [*texts.items(), (700, texts[700])]), minhash.Params(words=2)).collect()
    assert {r.doc_id: r.component_id for r in got} == label and len(got) == len(texts)
    assert minhash.groups(empty).count() == 0


# 6 ---------------------------------------------------------------------------

def test_decontamination_equals_brute_force(spark, empty):
    rng = random.Random(3)
    items = {i: " ".join(words(rng, n)) for i, n in enumerate([20, 30, 45, 15, 13, 9, 4, 0])} | {20: None, 21: "dup one " * 9}
    bench = spark.createDataFrame([(i, t, "x", 1) for i, t in items.items()] + [(None, items[0], "x", 1), (1, items[1], "x", 1)],
                                  "item_id long, text string, tokens string, pos int")
    texts = {}
    for i in range(30):
        texts[i] = " ".join(words(rng, rng.randint(5, 80)))
        item = (items[i % 10] or "").split() if i % 10 in items else []
        if i % 3 and item:
            if i % 3 == 2:  # every eighth token substituted
                item = ["Other!" if k % 8 == 5 else x.upper() for k, x in enumerate(item)]
            texts[i] += ", " + " ".join(item) + ". " + " ".join(words(rng, 20))
    texts |= {40: None, 41: "", 42: (items[2] or "")[:100], 43: " ".join((items[2] or "").split()[-14:]) + " end"}
    rows = table(spark, [*texts.items(), (None, items[0]), (1, texts[1])])
    got = decontam.contaminated(rows, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute.leaks(texts, items) and len(got) >= 10
    kept = decontam.decontaminate(rows, bench)
    bad = {r.doc_id for r in got}
    assert {r.doc_id for r in kept.collect()} == ({*texts, None}) - bad and kept.schema == rows.schema
    forced = decontam.contaminated(rows, bench, decontam.Params(broadcast_seeds=0)).collect()
    assert sorted(forced) == sorted(got)
    assert decontam.contaminated(empty, bench).count() == 0
    assert decontam.contaminated(rows, bench.where("false")).count() == 0


# 7 ---------------------------------------------------------------------------

PAGES = [
    ('<html><body class="has-sidebar"><header class="site">Top, menu</header><div id="cookie-notice">We use cookies, ok</div>'
     '<div class="wrap with-sidebar"><main><article><header><h1>T &amp; x</h1></header><p>One, two,   three.<p>Second '
     '<a href="x">link</a> para&nbsp;here<ul><li>a<li>b</ul><section class="comments"><p>Reader says, hi, hi</p></section>'
     '<form>email <input></form></article></main><aside>side</aside></div><footer>f</footer>',
     "T & x\nOne, two, three.\nSecond link para here\na\nb"),
    ('<div><div class=content><p>' + "word, " * 50 + '</p><p>two</p></div><div class=menu><a>x</a></div></div><',
     "word, " * 49 + "word,\ntwo"),
    ('<div><div id="body"><p>' + "word, " * 40 + '</p><blockquote>' + "more, " * 40 + '</blockquote></div><p>A plain tail '
     'of prose that belongs.</p><div><a href="/">many links here and there</a> <a>and there again</a></div></div>',
     "word, " * 39 + "word,\n" + "more, " * 39 + "more,\nA plain tail of prose that belongs."),
    ('<script>var t="</p>";</script><style>p{}</style><!-- <p>no</p> --><p>a<p>b<script>x', "a\nb"),
    ("plain text", "plain text"), (None, ""), ("", ""), ("<nav><a>x</a></nav><div hidden>y</div>", ""),
    ("<article><p>caf&eacute; &#65;&#x42; &lt;b&gt;</p><pre>x\n  y</pre></article>", "café AB <b>\nx y"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table></article>", "1\n2\n3"),
]


def test_html(spark):
    rows = [(i, None if i == 2 else f"u{i}", h, "x") for i, (h, _) in enumerate(PAGES)] + [(None, "u", "<p>z", "x"), (0, "u0", PAGES[0][0], "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        want = "z" if r.page_id is None else PAGES[r.page_id][1]
        assert (r.text, r.n_chars) == (want, len(want)), r.page_id
    assert html.extract(pages.where("false")).count() == 0


def test_html_is_linear():
    for bad in ("<div>" * 30000, "<p>x" * 30000, '<a b="' * 30000, "<" * 100000, "<a " * 30000, "&" * 100000, "<script>" * 30000,
                "</p>" * 30000, "<li>" * 30000, "<!--" * 30000):
        html.main_text(bad)


# 8 ---------------------------------------------------------------------------

def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=(300, 32))
    base /= np.linalg.norm(base, axis=1)[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    for i in range(300, 460):  # partners at cosines around the threshold
        a, z = base[i % 40], rng.normal(size=32)
        z -= (z @ a) * a
        z /= np.linalg.norm(z)
        c = rng.uniform(0.85, 0.99)
        rows.append((i, ((c * a + math.sqrt(1 - c * c) * z) * rng.uniform(0.1, 50)).tolist()))
    rows += [(i, base[0].tolist()) for i in range(460, 475)] + [(475, None), (476, []), (477, [0.0] * 32), (478, [float("nan")] * 32),
             (479, [1.0, None] * 16), (480, [float("inf")] + [0.0] * 31), (481, base[0][:16].tolist()), (482, [1e-300] * 32), (483, [1e300] * 32)]
    good = {i: np.array(v) / np.abs(v).max() for i, v in rows if v and len(v) == 32 and None not in v and np.isfinite(v).all() and any(v)}
    ids = sorted(good)
    x = np.stack([good[i] / np.linalg.norm(good[i]) for i in ids])
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    want_n = dict(zip(ids, near.sum(axis=1).tolist()))
    at = {i: k for k, i in enumerate(ids)}
    want = brute.groups(ids, lambda a, b: near[at[a], at[b]])
    frame = spark.createDataFrame([(i, v, 1, "u") for i, v in [*rows, (None, base[0].tolist()), rows[5]]],
                                  "vec_id long, embedding array<double>, n int, unit string").repartition(4)
    for p in (vectors.Params(), vectors.Params(cell=64)):  # the second cuts cells into blocks and has many tables
        got = vectors.links(frame, p).collect()
        by = {r.vec_id: r for r in got}
        assert len(got) == len(rows) + 1 and by[None].kept and by[None].n_links == 0
        assert all(by[i].n_links == 0 and by[i].kept for i, _ in rows if i not in good)
        found, all_ = sum(by[i].n_links for i in ids), sum(want_n.values())
        assert all(by[i].n_links <= want_n[i] for i in ids) and found >= 0.97 * all_
        if found == all_:
            assert {i: by[i].component_id for i in ids} == want
        assert all(by[i].kept == (by[i].component_id == i) for i in ids)
    assert vectors.links(frame.where("false")).count() == 0


# 9 ---------------------------------------------------------------------------

@pytest.mark.parametrize("order,block", [(ppm.Params.order, 1 << 20), (2, 600)])
def test_ppm_equals_brute_force(docs, texts, order, block):
    learned = [t for i, t in texts.items() if zlib.crc32(str(i).encode()) % 7 != 2]
    got = ppm.scores(docs, lambda i: queries.crc_fold(i, 7) != 2, ppm.Params(order=order, block_bytes=block)).collect()
    assert len(got) == len(texts) + 2
    ids = [i for i in texts if texts[i] is None or len(texts[i]) < 3000]
    n, bases = brute.base(learned, [texts[i] for i in ids])
    by = {r.doc_id: r for r in got if r.doc_id is not None}
    for i, b, s in zip(ids, bases, brute.ppm(learned, [texts[i] for i in ids], order)):
        r = by[i]
        assert r.train_tokens == n and r.n_tokens == len(brute.words(texts[i])) + 1
        assert r.base_score == pytest.approx(b, abs=1e-6) and r.score == pytest.approx(s, abs=1e-6), i
        assert r.learn == (zlib.crc32(str(i).encode()) % 7 != 2)


def test_ppm_without_learned_texts(spark, empty):
    got = ppm.scores(table(spark, [(1, "ab"), (2, None)]), lambda i: F.lit(False)).collect()
    assert {(r.doc_id, round(r.score, 6), r.base_score, r.n_known) for r in got} == {
        (1, round(-3 * math.log10(256), 6), 0.0, 0), (2, round(-math.log10(256), 6), 0.0, 0)}
    assert ppm.scores(empty, lambda i: F.lit(True)).count() == 0


# 10 --------------------------------------------------------------------------

@pytest.mark.parametrize("p", [rindex.Params(), rindex.Params(length=20, gram=8), rindex.Params(length=20, gram=8, hot=2, bucket_bytes=500)])
def test_run_index_equals_brute_force(docs, texts, p):
    want = brute.repeated(texts, p.length)
    got = rindex.dedup(docs, p).collect()
    assert len(got) == len(texts) + 2 and sum(r.n_removed for r in got) > 1000
    for r in got:
        if r.doc_id is None:
            assert r.n_removed == 0
        else:
            assert (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) == want[r.doc_id], r.doc_id


def test_run_index_repeated_rows(spark, empty):
    t = "".join(random.Random(1).choices("abcdefgh ", k=400))
    got = rindex.dedup(table(spark, [(1, t), (1, t), (2, t[:50]), (3, "-" + t)])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (1, 0), (2, 0), (3, 400)]
    assert rindex.dedup(empty).count() == 0


def test_run_index_alone():
    rng = np.random.default_rng(0)
    for _ in range(40):
        length = int(rng.integers(3, 9))
        base = [rng.integers(97, 99 + int(rng.integers(0, 3)), int(rng.integers(length, 40))).astype(np.uint8).tobytes() for _ in range(3)]
        parts = [base[int(rng.integers(3))][int(rng.integers(0, 3)):] for _ in range(int(rng.integers(1, 12)))]
        index = rindex.RunIndex(parts)
        start, first = index.firsts(length)
        begin, seen, want = np.concatenate([[0], index.end[:-1] + 1]), {}, {}
        for b, x in zip(begin, parts):
            for i in range(len(x) - length + 1):
                want[b + i] = seen.setdefault(x[i:i + length], b + i)
        assert dict(zip(start.tolist(), first.tolist())) == want
