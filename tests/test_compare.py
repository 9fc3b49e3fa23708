"""Result comparison (E5-E16) on literal cases the tables do not supply."""

import itertools
import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.cells import canonical_cell, cells_array
from quarry.operators import compare as C


def score(spark, pairs):
    """pairs: {pair_id: (gold_rows, pred_rows, gold_width, pred_width)} of canonical cells."""
    rows, heads = [], []
    for pid, (g, p, gw, pw) in pairs.items():
        for side, data, w in (("gold", g, gw), ("pred", p, pw)):
            heads.append((pid, side, len(data), w))
            rows += [(pid, side, i, list(r)) for i, r in enumerate(data)]
    r = spark.createDataFrame(rows, C.ROWS_SCHEMA)
    h = spark.createDataFrame(heads, C.HEADS_SCHEMA)
    return {x.pair_id: (x.ex_bird, x.ex_eq) for x in C.score_pairs(r, h).collect()}


def test_python_equality_of_cells(spark):
    df = spark.createDataFrame([(1, 1.0, True, "1", None, 2.5)],
                               "i int, d double, b boolean, s string, n int, f double")
    cells = df.select(cells_array(df).alias("c")).first()["c"]
    assert cells[0] == cells[1] == cells[2] == "n:1"
    assert cells[3] == "s:1" and cells[4] == "0:" and cells[5] == "n:2.5"
    dec = spark.createDataFrame([(1,)], "x int").select(
        canonical_cell(F.lit(1).cast("decimal(10,2)"), T.DecimalType(10, 2))).first()[0]
    assert dec == "n:1"


def test_empty_and_width_rules(spark):
    out = score(spark, {
        1: ([], [], 2, 3),                      # both empty: equal whatever the widths
        2: ([["n:1"]], [], 1, 1),               # one side empty
        3: ([["n:1", "s:a"]], [["n:1"]], 2, 1),  # different widths
        4: ([["0:"]], [["0:"]], 1, 1),          # NULL equals NULL
    })
    assert out[1][:2] == (1, 1)
    assert out[2][:2] == (0, 0)
    assert out[3][:2] == (0, 0)
    assert out[4][:2] == (1, 1)


def test_set_versus_bag(spark):
    g = [["n:1", "s:a"], ["n:2", "s:b"]]
    out = score(spark, {
        1: (g, [["s:a", "n:1"], ["s:b", "n:2"]], 2, 2),  # columns swapped
        2: (g, g + g, 2, 2),                             # every row twice
        3: (g, list(reversed(g)), 2, 2),                 # row order
    })
    assert out[1][:2] == (0, 1)
    assert out[2][:2] == (1, 0)
    assert out[3][:2] == (1, 1)


def test_tied_fingerprints_need_search(spark):
    # columns 0/1 have equal value bags, so the fingerprint alone cannot
    # place them; only the swap (1,0,3,2) matches
    g = [["n:1", "n:2", "s:x", "s:y"], ["n:2", "n:1", "s:y", "s:x"], ["n:3", "n:3", "s:z", "s:z"]]
    p = [[r[1], r[0], r[3], r[2]] for r in g]
    p = [p[0], p[1], p[2]]
    bad = [[r[0], r[0], r[2], r[3]] for r in g]
    out = score(spark, {1: (g, p, 4, 4), 2: (g, bad, 4, 4)})
    assert out[1][1] == 1
    assert out[2][1] == 0


def test_tied_and_identical_columns_are_decided(spark):
    # a Latin square: eight columns with equal value bags that differ row by row,
    # and eight columns that are equal row by row
    n = 8
    g = [[f"n:{(i * j) % 11}" for j in range(1, n + 1)] for i in range(1, 11)]
    perm = [3, 0, 7, 1, 6, 2, 5, 4]
    p = [[r[k] for k in perm] for r in reversed(g)]
    bad = [list(r) for r in p]
    bad[0][0], bad[1][0] = bad[1][0], bad[0][0]  # the column's bag stays, its rows change
    same = [[f"s:{i}"] * n for i in range(5)]
    out = score(spark, {1: (g, p, n, n), 2: (g, bad, n, n), 3: (same, same[::-1], n, n),
                        4: ([["n:1"] + r for r in same], [r + ["n:1"] for r in same], n + 1, n + 1)})
    assert [out[i][1] for i in (1, 2, 3, 4)] == [1, 0, 1, 1]


def brute_ex_eq(g, p):
    if not g and not p:
        return 1
    if len(g) != len(p) or len(g[0]) != len(p[0]):
        return 0
    for perm in itertools.permutations(range(len(g[0]))):
        if sorted(tuple(r[i] for i in perm) for r in p) == sorted(tuple(r) for r in g):
            return 1
    return 0


@settings(max_examples=12, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["n:1", "n:2", "s:a", "0:"]), min_size=3, max_size=3),
                min_size=1, max_size=5), st.permutations([0, 1, 2]), st.randoms())
def test_ex_eq_invariant_under_permutations(spark, g, perm, rnd):
    p = [[r[i] for i in perm] for r in g]
    rnd.shuffle(p)
    out = score(spark, {1: (g, p, 3, 3)})
    assert out[1][1] == brute_ex_eq(g, p) == 1


def test_has_null_and_row_jaccard(spark):
    rows = spark.createDataFrame([(1, "gold", 0, ["n:1", "0:"]), (1, "pred", 0, ["n:1", "n:2"])], C.ROWS_SCHEMA)
    heads = spark.createDataFrame([(1, "gold", 1, 2), (1, "pred", 1, 2), (2, "gold", 0, 1), (2, "pred", 0, 1)],
                                  C.HEADS_SCHEMA)
    hn = {(r.pair_id, r.side): r.has_null for r in C.has_null(rows, heads).collect()}
    assert hn == {(1, "gold"): True, (1, "pred"): False, (2, "gold"): True, (2, "pred"): True}
    df = spark.createDataFrame([(["a", "b"], ["b", "c"]), ([], [])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(C.row_jaccard(F.col("a"), F.col("b"))).collect()] == [1 / 3, 1.0]


def py_align(L, R):
    """The alignment rule written directly in Python: equal value sets first, in
    order, then the rows left over in their own order."""
    left, at, used = list(R), {}, set()
    for i, x in enumerate(L):
        for j, y in enumerate(left):
            if j not in used and x == y:
                at[j] = i
                used.add(j)
                break
    free = iter([i for i in range(len(L)) if i not in at.values()])
    extra = iter(range(len(L), len(L) + len(R)))
    rest = [j for j in range(len(R)) if j not in used]
    n_free = len(L) - len(at)
    for k, j in enumerate(rest):
        at[j] = next(free) if k < n_free else next(extra)
    a = {(i, v) for i, s in enumerate(L) for v in s}
    b = {(at[j], v) for j, s in enumerate(R) for v in s}
    return 1.0 if not a | b else len(a & b) / len(a | b)


def test_frame_similarity_aligned_matches_python(spark):
    rnd = random.Random(7)
    vals = ["s:a", "s:b", "s:c", "n:1", "n:2"]
    rows, heads, expect = [], [], {}
    for pid in range(8):
        g = [[rnd.choice(vals) for _ in range(2)] for _ in range(rnd.randint(0, 6))]
        p = [[rnd.choice(vals) for _ in range(2)] for _ in range(rnd.randint(0, 6))]
        rows += [(pid, "gold", i, r) for i, r in enumerate(g)] + [(pid, "pred", i, r) for i, r in enumerate(p)]
        heads += [(pid, "gold", len(g), 2), (pid, "pred", len(p), 2)]
        expect[pid] = py_align([set(r) for r in g], [set(r) for r in p])
    r = spark.createDataFrame(rows, C.ROWS_SCHEMA)
    h = spark.createDataFrame(heads, C.HEADS_SCHEMA)
    got = {x.pair_id: x.df_sim for x in C.frame_similarity(r, h, aligned=C.align_rows(r)).collect()}
    for pid in expect:
        assert abs(got[pid] - expect[pid]) < 1e-9, (pid, got[pid], expect[pid])


def test_jaro_winkler_known_values():
    assert abs(C._jw("MARTHA", "MARHTA") - 0.9611111) < 1e-6
    assert abs(C._jw("DIXON", "DICKSONX") - 0.8133333) < 1e-6
    assert C._jw("", "") == 1.0 and C._jw("a", "") == 0.0


def test_sql_text_key(spark):
    df = spark.createDataFrame([("SELECT  A FROM `t` -- c\n WHERE x = 'Ab' ;", "select a from \"t\" where x='Ab'")],
                               "a string, b string")
    assert df.select(C.sql_text_match(F.col("a"), F.col("b"))).first()[0] == 1
    df2 = spark.createDataFrame([("select a from t where x = 'AB'", "select a from t where x = 'ab'")],
                                "a string, b string")
    assert df2.select(C.sql_text_match(F.col("a"), F.col("b"))).first()[0] == 0
