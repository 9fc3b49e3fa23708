"""Smaller operator surfaces: catalog access, text sources, token filter,
date shapes, training-set padding, resume, prompts."""

import os
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import catalog as CAT
from quarry.operators import corpus as C
from quarry.operators import predict as PR
from quarry.operators import profile as P
from quarry.operators import prompts as G
from quarry.operators import sft as T
from quarry.sources import files as S
from quarry.sources.tables import load_many


def test_catalog_access(spark):
    tables = load_many(spark, SF_SMALL, ["region", "nation"])
    ct, cf, ck = CAT.build_catalog(spark, "tpch", tables, primary_keys={"region": ["r_regionkey"]})
    assert CAT.has_table(ct, "nation").count() == 1 and CAT.has_table(ct, "nope").count() == 0
    upd = spark.createDataFrame([("nation", "n_name", "Enum"), ("nation", "missing", "Code")],
                                "table_name string, field_name string, value string")
    cf2 = CAT.set_field_property(cf, upd, "category")
    assert [r.field_name for r in CAT.fields_by(cf2, category="Enum").collect()] == ["n_name"]
    with pytest.raises(AssertionError):
        CAT.fields_by(cf2, category="Nonsense")
    pk = {r.field_name: (r.primary_key, r.unique) for r in cf.collect()}
    assert pk["r_regionkey"] == (True, True) and pk["r_name"] == (False, False)


def test_read_lines_strips_tabs(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "l.txt")
    with open(p, "w") as f:
        f.write("\t a \n b\t\n")
    assert [r.value for r in S.read_lines(spark, p).collect()] == ["a", "b"]


def test_schema_files_last_record_wins(spark):
    df = spark.createDataFrame([(0, "d1", "old"), (5, "d1", "new"), (1, "d2", "x")],
                               "idx long, db_name string, db_schema string")
    out = os.path.join(tempfile.mkdtemp(), "schemas")
    S.schema_files(df, out)
    got = {r.db_name: r.value for r in spark.read.text(out).collect()}
    assert got == {"d1": "new", "d2": "x"}


def test_token_length_filter(spark):
    df = spark.createDataFrame([("a b c d",), ("a, b",)], "t string")
    out = [r.n_tokens for r in C.token_length_filter(df, "t", 4).collect()]
    assert out == [3]  # 'a, b' is three tokens; four tokens reach the limit
    assert C.token_length_filter(df, "t", 3).count() == 0


def test_text_date_granularity(spark):
    vals = spark.createDataFrame([("f", "2020-01"), ("f", "2020-02"), ("g", "2020-33"), ("g", "2020-07"),
                                  ("g", "2021-40"), ("h", "2020-01-02 03:04:05.123")], "field string, v string")
    out = {r.field: r.date_min_gran for r in P.text_date_granularity(vals, ["field"]).collect()}
    assert out == {"f": "MONTH", "g": "WEEK", "h": "MILLISECOND"}


def test_label_mask_route_and_batches(spark):
    conv = F.array(F.struct(F.lit("user").alias("role"), F.col("p").alias("content")),
                   F.struct(F.lit("assistant").alias("role"), F.col("a").alias("content")))
    df = spark.createDataFrame([(0, "q one", "SELECT 1", "nl2sqlite"), (1, "q", "SELECT a FROM t", "cypher"),
                                (2, "q two three", "x", "other")], "id long, p string, a string, sql_type string")
    m = T.label_mask(df.withColumn("conversations", conv))
    r = {x.id: x for x in T.route_labels(m, 3).collect()}
    assert r[0].labels[0] == 2 and r[1].labels[0] == 2 and r[2].labels[0] == T.IGNORE_ID
    b = {x.id: x for x in T.length_batches(m, 2, "id").collect()}
    for x in b.values():
        assert len(x.input_ids) == len(x.labels) == len(x.attention_mask)
    same = [x for x in b.values() if x.batch == 0]
    assert len({len(x.input_ids) for x in same}) == 1


def test_resume_and_predict(spark):
    inputs = spark.createDataFrame([(0, "p0"), (1, "p1"), (2, "p2")], "idx long, prompt string")
    saved = spark.createDataFrame([(0, "S0"), (1, "")], "idx long, pred_sql string")
    todo = PR.resume_todo(inputs, saved)
    assert sorted(r.idx for r in todo.collect()) == [1, 2]
    fresh = PR.batched_predict(todo, lambda ps: [p.upper() for p in ps])
    merged = {r.idx: r.pred_sql for r in PR.resume_merge(saved, fresh.drop("prompt")).collect()}
    assert merged == {0: "S0", 1: "P1", 2: "P2"}
    assert [r.idx for r in PR.restore_order(PR.head(inputs, 2)).collect()] == [0, 1]


def test_prompt_rejects_unknown_task(spark):
    df = spark.createDataFrame([(0, "q", "", "s", "SELECT 1", "d")],
                               "id long, question string, evidence string, db_schema string, sql string, db_name string")
    with pytest.raises(Exception):
        G.train_samples(df, "nl2sql").collect()
    t = G.train_samples(df, "nl2postgres").first()
    assert t.sql_type == "nl2postgresql" and t.conversations[1].content == "\nSELECT 1\n```"
    # slot-like text inside a value is not expanded
    df2 = df.withColumn("question", F.lit("{db_schema}"))
    assert "{db_schema}" in G.train_samples(df2, "nl2sqlite").first().conversations[0].content
