"""Joins and ranks where one group holds most rows: no task gets the group."""

import pytest
from pyspark.sql import functions as F

from quarry.functions.ranking import rank_within
from quarry.functions.spread import spread_join


@pytest.fixture
def apart(spark):
    """Partitions as shuffled: neither merged nor avoided by a broadcast of the small side."""
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def most(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def hot(spark, n=8000):
    g = F.when(F.col("id") % 10 < 9, 1).when(F.col("id") % 100 == 99, None).otherwise(F.col("id") % 7 + 2)
    return spark.range(n).select(g.cast("long").alias("g"), F.col("id").alias("x"))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_spread_join_is_the_join(apart, how):
    rows = hot(apart)
    side = apart.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d")], "g long, y string")
    got = spread_join(rows, side, ["g"], how, most=100)
    want = rows.join(side, ["g"], how)
    assert got.columns == want.columns
    key = lambda r: tuple(str(v) for v in r)
    assert sorted(got.collect(), key=key) == sorted(want.collect(), key=key)


def test_spread_join_deals_a_hot_key(apart):
    rows = hot(apart)
    side = apart.createDataFrame([(i, i) for i in range(10)], "g long, y long")
    assert most(rows.join(side, ["g"])) > 7000
    assert most(spread_join(rows, side, ["g"], most=100)) < 2500


def test_rank_within_deals_a_hot_group(apart):
    rows = hot(apart).where("g IS NOT NULL")
    r = rank_within(rows, "g", ["x"], "r", "n")
    assert most(r) < 4000
    expect = {}
    for g, x in sorted((v.g, v.x) for v in rows.collect()):
        expect.setdefault(g, []).append(x)
    assert {(v.g, v.x, v.r, v.n) for v in r.collect()} == {(g, x, i, len(xs)) for g, xs in expect.items() for i, x in enumerate(xs)}


def test_ordered_scores_deal_a_hot_pair(apart, monkeypatch):
    from quarry.operators import compare as C
    from quarry.functions import spread
    monkeypatch.setattr(spread.spread_join, "__defaults__", ("inner", None, 100))
    rows = apart.range(4000).select(F.lit(1).cast("long").alias("pair_id"), F.explode(F.array(F.lit("gold"), F.lit("pred"))).alias("side"),
                                    F.col("id").alias("row_no"), F.array(F.concat(F.lit("n:"), F.col("id").cast("string"))).alias("cells"))
    heads = C.heads_from_rows(rows, rows.select("pair_id").distinct())
    ordered = apart.createDataFrame([(1, True)], "pair_id long, ordered boolean")
    placed, wider = C.with_order(rows, heads, ordered)
    assert most(placed) < 4000
    assert C.score_pairs(placed, wider).first()["ex_eq"] == 1


def test_composite_fks_send_only_possible_columns(spark, monkeypatch):
    """Columns whose values lie outside a key column's range, or in no key's type, are not shuffled."""
    from quarry.operators import keys as K
    parent = spark.createDataFrame([(i // 4, i % 4, f"t{i}") for i in range(16)], "a long, b long, t string")
    child = spark.createDataFrame([(i % 3, i % 4, 1000 + i, None, "é" * 40) for i in range(9)], "x long, y long, far long, none long, u string")
    sent, real = [], K.common_values
    monkeypatch.setattr(K, "common_values", lambda tables, cols: sent.append(len(cols)) or real(tables, cols))
    got = K.composite_fks({"p": parent, "c": child}, [("p", ("a", "b"))])
    assert got == [("c", ("x", "y"), "p", ("a", "b")), ("c", ("y", "x"), "p", ("a", "b")), ("p", ("b", "a"), "p", ("a", "b"))]
    assert sent[0] == 4  # a, b, x and y


def test_field_profile_profiles_the_tables_once(spark, monkeypatch):
    from quarry.operators import catalog, profile as PRO
    from quarry.plans import whole_queries as W
    calls, real = [], PRO.profile
    counted = lambda *a, **k: calls.append(1) or real(*a, **k)
    monkeypatch.setattr(PRO, "profile", counted)
    monkeypatch.setattr(catalog, "profile", counted)
    monkeypatch.setattr(W, "load_many", lambda *a: {"t": spark.createDataFrame([(i, f"v{i}") for i in range(12)], "k long, v string")})
    assert W.field_profile(spark, "", ["t"]).count() == 2
    assert len(calls) == 1


def test_catalog_takes_examples_from_a_profile(spark):
    from quarry.operators.catalog import build_catalog
    from quarry.operators.profile import profile
    tables = {"t": spark.createDataFrame([(i, f"v{i:02}", "a@b.cc" if i == 9 else f"m{i}") for i in range(12)], "k long, v string, m string")}
    of = lambda cf: sorted((r.field_name, r.examples) for r in cf.collect())
    assert of(build_catalog(spark, "d", tables, profiled=profile(tables, 10))[1]) == of(build_catalog(spark, "d", tables)[1])


def test_length_batches_tokenise_a_text_twice_at_most(spark):
    """Once for the lengths and once for the arrays; sampling the ranges reads the written lengths."""
    from pyspark.sql.types import ArrayType, IntegerType
    from quarry.operators import sft
    seen = spark.sparkContext.accumulator(0)

    def count(text):
        seen.add(1)
        return [len(w) for w in text.split()]

    rows = spark.range(40).select("id", F.repeat(F.lit("word "), (F.col("id") % 7 + 1).cast("int")).alias("x")).localCheckpoint()
    ids = rows.select("id", F.udf(count, ArrayType(IntegerType()))("x").alias("input_ids"))
    t = ids.withColumn("labels", F.col("input_ids")).withColumn("attention_mask", F.col("input_ids"))
    out = sft.length_batches(t, 8).collect()
    order = sorted(range(40), key=lambda i: (i % 7 + 1, i))
    assert {r.id: r.batch for r in out} == {i: at // 8 for at, i in enumerate(order)}
    assert seen.value <= 80
