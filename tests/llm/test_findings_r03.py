"""What the second verdict found: recall of line chunks, repeated ids, nesting,
bounds, plain versions of the learned scores and of the page scoring."""

import itertools
import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import bpe, html, lines, minhash, quality, rindex, toxicity, vectors
from quarry.llm.store import read_table

KIND = "doc_id long, text string"


def test_chunks_find_most_repeated_lines(spark):
    """Of the lines that stand in windows of two lines seen before."""
    for sf in ("sf0.01", "sf0.1"):
        docs = read_table(spark, f"/root/testdata/{sf}", "documents")
        found, there = (f(docs).agg(F.sum("line_dedup.n_removed")).first()[0] for f in (lines.dedup_lines, lines.dedup_passages))
        assert found >= 0.9 * there and there > 500, (sf, found, there)


def test_run_index_with_several_texts_of_one_id(spark):
    rng = random.Random(1)
    t = "".join(rng.choices("abcdefgh ", k=400))
    rows = [(1, t), (1, t[:83]), (2, t[100:300]), (2, "x" * 50), (3, "-" + t), (3, "-" + t)]
    for p in (rindex.Params(), rindex.Params(hot=0)):
        got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in rindex.dedup(spark.createDataFrame(rows, KIND).repartition(3), p).collect())
        assert got == [(1, 83, 0), (1, 400, 0), (2, 50, 0), (2, 200, 200), (3, 401, 400), (3, 401, 400)]


def test_one_row_of_a_chosen_id_is_learned_from(spark):
    rng = random.Random(3)
    text = lambda bad: " ".join(rng.choices(["tree", "river", "stone", "cloud"], k=12) + ["vile"] * bad)
    rows = [(i, text(i % 2)) for i in range(60)] + [(1, text(k % 2)) for k in range(3000)]
    docs = spark.createDataFrame(rows, KIND).repartition(4)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(60)], "doc_id long, toxic int, quality int")
    seen = []
    for module, label in ((toxicity, "toxic"), (quality, "quality")):
        learn, module.learn = module.learn, lambda *a, f=module.learn: (seen.append(len(a[0])), f(*a))[1]
        try:
            module.fit(docs, labels, lambda i: i >= 0, module.Params(max_rows=40), label)
        finally:
            module.learn = learn
    assert seen == [40, 40]


def test_columns_that_tell_only_in_pairs(spark):
    rng = random.Random(4)
    rows, labels = [], []
    for i in range(1500):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((i, " ".join(["one"] * a + ["two"] * b + rng.sample([f"w{k}" for k in range(30)], 4))))
        labels.append((i, int(a != b)))
    docs = spark.createDataFrame(rows, KIND)
    m = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), lambda i: i < 1200, toxicity.Params(positive=1.0, epochs=40))
    right = {i: y for i, y in labels}
    got = toxicity.score(docs.where("doc_id >= 1200"), m).collect()
    assert sum((r.score >= 0.5) == right[r.doc_id] for r in got) > 0.9 * len(got)


def test_machine_scores_equal_all_pairs_of_terms(spark):
    rng = np.random.default_rng(2)
    words = ["alpha", "beta", "insulting", "groups", "Été", "x1"]
    texts = [" ".join(rng.choice(words, int(n))) for n in (0, 1, 3, 8, 20)]
    columns = []
    for t in texts:
        data = np.frombuffer(t.encode(), np.uint8)
        columns.append(toxicity.hashed(data, np.array([0, len(data)]), 26)[0].tolist())
    known = sorted({c for cs in columns for c in cs})[::2]
    m = toxicity.Machine(np.array(known, np.uint64), rng.normal(size=len(known)), rng.normal(size=(len(known), 3)), -0.3, 26)
    at = {c: k for k, c in enumerate(known)}
    want = []
    for cs in columns:
        on = [at[c] for c in cs if c in at]
        raw = m.bias + sum(m.w[k] for k in on) + sum(float(m.v[i] @ m.v[j]) for i, j in itertools.combinations(on, 2))
        want.append(1 / (1 + math.exp(-raw)))
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(list(enumerate(texts)), KIND), m).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-12)


def plain_features(text):
    """The surface features one character at a time."""
    data, n = text.encode(), max(len(text.encode()), 1)
    share = [sum(1 for b in data if inside[b]) / n for inside in quality.CLASSES.values()]
    words = ["".join(c.lower() if c < "\x80" else c for c in w) for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w]
    k = max(len(words), 1)
    pairs = list(zip(words, words[1:]))
    marked = sum(quality.CLASSES["mark"][w.encode()[-1]] for w in text.replace("\t", " ").replace("\n", " ").split(" ") if w)
    rest = [math.log1p(len(data)), math.log1p(len(words)), len(data) / k, len(set(words)) / k,
            max((words.count(w) for w in words), default=0) / k, sum(a == b for a, b in pairs) / k,
            1 - len(set(pairs)) / len(pairs) if pairs else 0.0, math.log1p(len(words) / (text.count("\n") + 1)), marked / k]
    return share + rest


def test_quality_scores_equal_plain_features(spark):
    texts = ["", "One two, two three.", "A# a# b\nC1 \t é é é", "x " * 50, "UPPER|bar| 42 {}", " \n "]
    x = np.array([plain_features(t) for t in texts])
    x = np.concatenate([x, x * x], axis=1)
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    assert quality.features(data, off) == pytest.approx(x, abs=1e-9)
    rng = np.random.default_rng(1)
    r = quality.Ranking(x.mean(axis=0), np.full(x.shape[1], 2.0), rng.normal(size=x.shape[1]), 0.2, 0.7, 0.3)
    want = [1 / (1 + math.exp(-((((row - r.mean) / 2.0) @ r.theta - 0.2) / 0.7 + math.log(0.3 / 0.7)))) for row in x]
    got = {i.doc_id: i.score for i in quality.score(spark.createDataFrame(list(enumerate(texts)), KIND), r).collect()}
    assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-9)


def test_long_words_are_not_remembered():
    e = bpe.Encoder(bpe.default_path())
    t = "\u6c34\u706b" * 400
    want = e.text(t)
    size = sum(map(len, e.words)) + sum(map(len, e.pieces))
    for k in range(50):
        e.text(t + chr(0x4E00 + k))
    assert e.text(t) == want
    assert all(len(w) <= bpe.LONGEST for d in (e.words, e.before, e.pieces) for w in d)
    assert sum(map(len, e.words)) + sum(map(len, e.pieces)) <= size + 50 * 2 * bpe.LONGEST


def test_html_is_linear_in_nesting():
    def took(source):
        began = time.process_time()
        html.main_text(source)
        return time.process_time() - began

    for part in ("<div>some words, here", "<article>some words, here", "<div><header>x", "<i>a<b>c, d"):
        took(part * 500)
        small, large = took(part * 1500), took(part * 12000)
        assert large < 16 * max(small, 0.02), part


def plain_points(page):
    """Points of the elements of ``page``, each block walking up to all ancestors."""
    points = [0.0] * len(page.tag)
    heads = ("p", "h1", "h2", "h3", "h4", "h5", "h6")
    for e, text, links in page.blocks:
        own = (text.count(",") + text.count("\uff0c") + 1 + min(len(text) / 100, 3.0)) * (1 - links / len(text))
        if page.tag[e] in heads[1:]:
            own *= 0.2
        up, k = (page.parent[e] if page.tag[e] in heads else e), 0
        while up > 0:
            points[up] += own / (1 if k == 0 else 2 if k == 1 else 3 * k)
            up, k = page.parent[up], k + 1
    return points


def test_html_picks_the_container_with_most_points(spark):
    """Pages of plain containers: the text is that of the best one and its siblings
    that count, by points worked out with a walk of their own."""
    rng = random.Random(6)
    for _ in range(60):
        def box(depth):
            inner = "".join(box(depth - 1) if depth and rng.random() < 0.5 else
                            f"<p>{', '.join('w' * rng.randint(1, 9) for _ in range(rng.randint(1, 25)))}</p>" for _ in range(rng.randint(1, 4)))
            return f"<div>{inner}</div>"
        page = html.Page(f"<body>{box(3)}</body>")
        points = plain_points(page)
        value = lambda e: points[e] + html.BASE.get(page.tag[e], 0.0)
        best = max((e for e in range(1, len(page.tag)) if page.tag[e] == "div"), key=lambda e: (value(e), -e))
        kept = {best} | {e for e in range(1, len(page.tag)) if page.parent[e] == page.parent[best]
                         and (value(e) >= max(10.0, 0.2 * value(best)) or page.tag[e] == "p")}

        def inside(e):
            while e > 0 and e not in kept:
                e = page.parent[e]
            return e in kept
        assert page.text() == "\n".join(t for e, t, _ in page.blocks if inside(e))


def test_block_pairs_are_dealt_one_by_one(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (np.ones(8) + rng.normal(size=8) * 0.01).tolist()) for i in range(600)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = vectors.links(frame, vectors.Params(cell=64)).collect()
    assert {r.component_id for r in got} == {0} and all(r.n_links == 599 for r in got)


def test_short_sets_met_in_a_list_are_compared(spark):
    """A crowd of short texts that share many shingles, none near enough."""
    rng = random.Random(9)
    texts = {i: " ".join(rng.sample([f"v{k}" for k in range(12)], 9)) for i in range(80)}
    texts |= {200: texts[3], 201: texts[5] + " tail"}
    import brute
    n, label = brute.near(texts, 2)
    got = minhash.groups(spark.createDataFrame(list(texts.items()), KIND), minhash.Params(words=2, few=4)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (n[i], label[i]) for i in texts}
