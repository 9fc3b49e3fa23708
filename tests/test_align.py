"""Alignment by similarity against the rule written directly, and its use in E15."""

import hashlib
import itertools
import json
import random
from collections import defaultdict

import pytest

from quarry.operators import align
from quarry.operators import compare as C


def md5(x):
    return hashlib.md5(x.encode()).hexdigest()


def text(vals):
    return json.dumps(list(vals), separators=(",", ":"))


def plain(gold, pred):
    """Row pairs by the rule: levels of (shared values, sizes) from the most similar
    down, rows settling on the least subset of the level that both sides have."""
    left = {"gold": {i: frozenset(map(md5, r)) for i, r in gold}, "pred": {i: frozenset(map(md5, r)) for i, r in pred}}
    out = []

    def settle(groups):
        for sides in groups.values():
            for g, p in zip(sorted(sides["gold"]), sorted(sides["pred"])):
                out.append((g, p))
                del left["gold"][g], left["pred"][p]

    groups = defaultdict(lambda: {"gold": [], "pred": []})
    for side, rows in left.items():
        for i, r in rows.items():
            if r:
                groups[r][side].append(i)
    settle(groups)
    sizes = {len(r) for rows in left.values() for r in rows.values()}
    levels = {(s, a + b) for a in sizes for b in sizes for s in range(1, min(a, b) + 1) if 2 * s < a + b}
    for s, total in sorted(levels, key=lambda x: (-x[0] / (x[1] - x[0]), -x[0], x[1])):
        while True:
            useful = set().union(*left["gold"].values()) & set().union(*left["pred"].values())
            posts = defaultdict(lambda: defaultdict(set))
            for side, rows in left.items():
                for i, r in rows.items():
                    for sub in itertools.combinations(sorted(r & useful), s):
                        posts[md5(text(sub)), len(r) if side == "gold" else total - len(r)][side].add(i)
            groups = defaultdict(lambda: {"gold": [], "pred": []})
            both = {k: v for k, v in posts.items() if v["gold"] and v["pred"]}
            for side, rows in left.items():
                for i in rows:
                    mine = [k for k, v in both.items() if i in v[side]]
                    if mine:
                        groups[min(mine)][side].append(i)
            if not any(v["gold"] and v["pred"] for v in groups.values()):
                assert not both
                break
            settle(groups)
    return sorted(out)


def similarity(a, b):
    return len(a & b) / len(a | b) if a | b else 0


@pytest.mark.parametrize("most", [64, 0])
def test_alignment_equals_the_rule_and_is_stable(spark, most):
    rnd = random.Random(11)
    data, rows = {}, []
    for pid in range(12):
        width = pid % 3 + 1
        pool = [f"s:{k}" for k in range(rnd.choice([3, 6, 30]))]
        make = lambda n: [(i, [rnd.choice(pool) for _ in range(width)]) for i in rnd.sample(range(100), n)]
        data[pid] = make(rnd.randint(0, 14)), make(rnd.randint(0, 14))
        for side, part in zip(("gold", "pred"), data[pid]):
            rows += [(pid, side, i, r) for i, r in part]
    rows += [(50, "gold", 0, []), (50, "pred", 0, []), (51, "gold", 0, ["0:"])]
    frame = spark.createDataFrame(rows, C.ROWS_SCHEMA)
    got = defaultdict(list)
    for r in align.similar_rows(frame, most).collect():
        got[r.pair_id].append((r.gold_no, r.pred_no))
    for pid, (gold, pred) in data.items():
        assert sorted(got[pid]) == plain(gold, pred), pid
        g, p = {i: set(r) for i, r in gold}, {i: set(r) for i, r in pred}
        of, to = dict(got[pid]), {b: a for a, b in got[pid]}
        for a, b in itertools.product(g, p):  # no two rows are both worse off than with each other
            sim = similarity(g[a], p[b])
            mine = similarity(g[a], p[of[a]]) if a in of else 0
            theirs = similarity(g[to[b]], p[b]) if b in to else 0
            assert sim <= max(mine, theirs) + 1e-12
    assert not got[50] and not got[51]


def test_a_value_of_all_rows_makes_no_pairs_of_rows(spark):
    """20,000 rows a side that share one value and nothing else: 4 * 10^8 pairs."""
    n = 20_000
    from pyspark.sql import functions as F
    half = lambda side: spark.range(n).select(F.lit(1).cast("long").alias("pair_id"), F.lit(side).alias("side"), F.col("id").alias("row_no"),
                                              F.array(F.lit("s:hot"), F.concat(F.lit(f"s:{side}"), F.col("id").cast("string"))).alias("cells"))
    pairs = align.similar_rows(half("gold").union(half("pred")))
    assert pairs.where("gold_no = pred_no").count() == n == pairs.count()


def test_ordered_pairs(spark):
    df = spark.createDataFrame([(1, "SELECT a ORDER BY a", "x"), (2, "x", "select 1 Order By 1"), (3, "order", "by"), (4, None, None)],
                               "pair_id long, gold_sql string, pred_sql string")
    assert {r.pair_id: r.ordered for r in align.ordered_pairs(df).collect()} == {1: True, 2: True, 3: True, 4: False}


def test_mixed_similarity(spark):
    gold = [["a", "1"], ["b", "2"], ["c", "3"]]
    pred = [["c", "9"], ["b", "2"], ["a", "1"], ["z", "z"]]
    rows = [(pid, side, i, r) for pid in (1, 2) for side, part in (("gold", gold), ("pred", pred)) for i, r in enumerate(part)]
    frame = spark.createDataFrame(rows, C.ROWS_SCHEMA)
    ordered = spark.createDataFrame([(1, True), (2, False)], "pair_id long, ordered boolean")
    heads = C.heads_from_rows(frame, frame.select("pair_id").distinct())
    aligned = align.align_similar(frame, C.positions(frame))
    got = {r.pair_id: r.df_sim for r in C.frame_similarity(frame, heads, ordered, aligned).collect()}
    assert got[1] == pytest.approx(2 / 11) and got[2] == pytest.approx(5 / 8)


def test_equality_in_order(spark):
    gold = [["n:1", "s:a"], ["n:2", "s:b"], ["n:1", "s:a"]]
    cases = {1: gold, 2: [gold[1], gold[0], gold[2]], 3: [[b, a] for a, b in gold], 4: gold[:2], 5: []}
    rows = [(pid, side, i, r) for pid, pred in cases.items() for side, part in (("gold", gold), ("pred", pred)) for i, r in enumerate(part)]
    frame = spark.createDataFrame(rows, C.ROWS_SCHEMA)
    heads = C.heads_from_rows(frame, spark.createDataFrame([(p,) for p in cases], "pair_id long"), default_cols=2)
    for flag, want, quick in ((True, [1, 0, 1, 0, 0], [1, 0, 1, 0, 0]), (False, [1, 1, 1, 0, 0], [1, 1, 1, 1, 0])):
        r, h = C.with_order(frame, heads, spark.createDataFrame([(p, flag) for p in cases], "pair_id long, ordered boolean"))
        got = {x.pair_id: x.ex_eq for x in C.score_pairs(r, h).collect()}
        fast = {x.pair_id: x.quick_ok for x in C.unordered_rows_equal(r, h).collect()}
        assert [got[p] for p in cases] == want and [fast[p] for p in cases] == quick, flag


def test_later_rounds_of_a_level_read_only_rows_with_a_common_subset(spark, monkeypatch):
    """a row without a subset that both sides hold is not tried again at its level."""
    from pyspark.sql import functions as F
    half = lambda side: spark.range(300).select(F.lit(1).cast("long").alias("pair_id"), F.lit(side).alias("side"), F.col("id").alias("row_no"),
                                                F.array(F.concat(F.lit("s:"), (F.col("id") % 150).cast("string")), F.when(F.col("id") < 20, "s:hot").otherwise(F.lit("s:all")),
                                                        F.concat(F.lit(f"s:{side}"), F.col("id").cast("string"))).alias("cells"))
    seen, real = [], align._round
    monkeypatch.setattr(align, "_round", lambda rows, s, total, most: seen.append((s, rows.count())) or real(rows, s, total, most))
    pairs = align.similar_rows(half("gold").union(half("pred").where("row_no >= 10 and row_no % 3 > 0")))
    assert pairs.count() == pairs.select("gold_no").distinct().count() == pairs.select("pred_no").distinct().count() == 194
    first = [n for s, n in seen if s == 2]
    assert len(first) > 1 and max(first[1:]) < first[0] / 2


def test_frame_similarity_reads_a_position_once(spark):
    """a position's values meet in one row; rows that share a number share their positions."""
    rows = [(1, "gold", 0, ["a", "b", "b"]), (1, "gold", 5, ["c", "d"]), (1, "gold", 5, ["e"]),
            (1, "pred", 3, ["b", "x"]), (1, "pred", 4, ["e", "c"]), (2, "gold", 1, ["a"]), (3, "pred", 1, ["a"]), (4, "gold", 0, []), (4, "pred", 0, [])]
    frame = spark.createDataFrame(rows, C.ROWS_SCHEMA)
    heads = C.heads_from_rows(frame, frame.select("pair_id").distinct())
    # gold: {a, b}, {c, d, e} twice; pred: {b, x}, {c, e}
    plan = C.frame_similarity(frame, heads)
    assert {r.pair_id: r.df_sim for r in plan.collect()} == {1: pytest.approx(3 / 9), 2: 0, 3: 0, 4: 1}
    assert "explode(cells" not in plan._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("small", [5, 1000])
def test_positions_of_large_and_small_groups(spark, small):
    rows = [(p, side, n * 7 % 101, ["v"]) for p, m in ((1, 60), (2, 3), (None, 4)) for side in ("gold", "pred") for n in range(m)]
    rows += [(1, "gold", 7, ["w"]), (2, "pred", 0, ["w"]), (2, "pred", None, ["w"])]
    got = sorted((r.pair_id, r.side, r.row_no, r.cells[0], r.pos) for r in C.positions(spark.createDataFrame(rows, C.ROWS_SCHEMA), small).collect())
    want = []
    for p, side in ((1, "gold"), (1, "pred"), (2, "gold"), (2, "pred")):
        mine = sorted((n, c[0]) for q, s, n, c in rows if (q, s) == (p, side) and n is not None)
        for n, c in mine:
            want += [(p, side, n, c, i) for i, (m, _) in enumerate(mine) if m == n]
    assert got == sorted(want)
