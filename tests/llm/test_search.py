"""Reversed search against a plain version and its SQL, and on odd rows."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from conftest import SF_SMALL
from quarry.llm import queries, search

TERMS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall("".join(c.lower() if c < "\x80" else c for c in text or ""))


def plain(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    n = sum(bool(b) for _, b in bags)
    total = sum(b.total() for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items.items():
        ranked = []
        for d, b in bags:
            if b:
                m = 25 + 75 * b.total() * n // total
                s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10 ** 9 * b[t] // (1000 * b[t] + 8 * m))
                        for t in terms(text) if b[t])
                if s > 0:
                    ranked.append((-s, d is None, d))
        out += [(item, k, d, -s) for k, (s, _, d) in enumerate(sorted(ranked, key=lambda r: (r[0], r[1], r[2] or 0))[:top], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(6)
    vocab = ["a", "the", "The", "été", "Ünder", "x1", "42", "日本", "ÀÉ"] + [f"w{k}" for k in range(60)]
    docs = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 80)))) for i in range(150)]
    docs += [(i + 1000, docs[i % 3][1]) for i in range(25)]  # ties
    docs += [(5, docs[5][1]), (5, "other w1 text"), (None, docs[0][1]), (2000, None), (2001, ""), (2002, "-- ?! \n"),
             (2003, "w1, W1. w1! the;x1 " * 400), (2004, "a\x00b the_cat")]
    items = {i: " ".join(rng.choices(vocab, k=n)) for i, n in enumerate([1, 3, 10, 40, 200, 12])}
    items |= {50: docs[0][1], 51: "", 52: "?", 53: "absent words", 54: "the the w3 w3 w3", None: "w7 w8"}
    return docs, items


def frames(spark, texts):
    docs, items = texts
    d = spark.createDataFrame([(i, t, 1, "s", 2) for i, t in docs], "doc_id long, text string, item_id int, term string, score int")
    q = [(i, t, 9, 1.0) for i, t in items.items()] + [(60, None, 1, 1.0), (1, items[1], 1, 1.0), (54, "w3", 1, 1.0)]
    return d.repartition(5), spark.createDataFrame(q, "item_id long, text string, doc_id int, rank double")


@pytest.mark.parametrize("p", [search.Params(), search.Params(postings=20, cells=50, merge=2), search.Params(top=3)])
def test_search_equals_plain_version(spark, texts, p):
    got = search.search(*frames(spark, texts), p).collect()
    assert sorted(map(tuple, got), key=str) == plain(*texts, p.top)


def test_search_odd_tables(spark, texts):
    docs, items = frames(spark, texts)
    assert search.search(docs.where("false"), items).count() == 0
    assert search.search(docs, items.where("false")).count() == 0
    assert search.search(docs.where("text IS NULL"), items).columns == ["item_id", "rank", "doc_id", "score"]


def test_terms_with_one_hash_are_told_apart():
    index = search.Index(pa.table({"item_id": [1, 2], "term": [5, 5], "check": [1, 2], "count": [1, 1]}))
    assert len(index.term) == 2
    table = pa.table({"item_id": [1, 2], "term": [0, 0], "check": [1, 2], "count": [1, 1]})
    data = np.frombuffer(b"abc abc", dtype=np.uint8)
    h, s, e, _ = search._term_hashes(data, np.array([0, 7]))
    check = int(search._checks(data, s, e)[0].view(np.int64))
    for checks, want in (([1, 2], 0), ([1, check], 1), ([check, 2], 1)):
        table = pa.table({"item_id": [1, 2], "term": [int(h[0].view(np.int64))] * 2, "check": pa.array(checks, pa.int64()), "count": [1, 1]})
        row, term, tf, n = search.Index(table).hits(data, np.array([0, 7]))
        assert len(row) == want and n.tolist() == [2] and (want == 0 or (tf.tolist() == [2] and search.Index(table).check.view(np.int64)[term[0]] == check))


def test_query_equals_sql(spark):
    got = sorted(map(tuple, queries.op13_search(spark, SF_SMALL).select("item_id", "rank", "doc_id", "score").collect()))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    want = con.execute(f"SELECT item_id, rank, doc_id, score FROM ({queries.ORACLES['op13_search']})").fetchall()
    assert got == sorted(want) and len(got) > 100
