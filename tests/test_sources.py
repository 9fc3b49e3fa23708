"""File sources, registry and catalog dump."""

import json
import os
import tempfile

from quarry.sources import files as S
from quarry.sources import registry as REG


def test_raw_json_array_with_both_spellings(spark):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "raw.json"), "w", encoding="utf-8") as f:
        json.dump([{"db_id": "a", "question": "q1", "SQL": "S1"},
                   {"db_name": "b", "question": "q2", "sql": "s2", "db_schema": "x"},
                   {"db_id": "c", "SQL": "S3", "sql": "s3"}], f, ensure_ascii=False)
    rows = {r.idx: r for r in S.read_raw_records(spark, d).collect()}
    assert [rows[i].sql for i in range(3)] == ["S1", "s2", "S3"]
    assert rows[1].db_schema == "x" and rows[0].db_id == "a"


def test_map_file_last_key_wins(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "m.tsv")
    with open(p, "w", encoding="utf-8") as f:
        f.write("k1\ta、b\n k2\tc \nk1\td\n")
    m = {r.key: r["values"] for r in S.read_map_file(spark, p).collect()}
    assert m == {"k1": ["d", "k1"], "k2": ["c", "k2"]}


def test_whole_texts_missing_path_is_empty(spark):
    d = tempfile.mkdtemp()
    a = os.path.join(d, "a.txt")
    with open(a, "w") as f:
        f.write("line1\nline2")
    out = {r.path: r.text for r in S.read_whole_texts(spark, [a, os.path.join(d, "missing.txt")]).collect()}
    assert out[a] == "line1\nline2" and out[os.path.join(d, "missing.txt")] == ""


def test_registry_upsert_and_split_entries(spark):
    d = tempfile.mkdtemp()
    p = os.path.join(d, "reg.json")
    with open(p, "w") as f:
        json.dump({"a": {"data_path": "x.json", "sample_num": -1, "sum_num": 3, "task_name": "nl2sqlite"},
                   "b": {"data_path": "y.json", "sample_num": 10, "sum_num": 20, "task_name": "nl2mysql",
                         "data_aug": True}}, f)
    reg = REG.read_registry(spark, p)
    counts = spark.createDataFrame([("train", 8), ("test", 2)], "split string, n_rows long")
    new = REG.split_entries("b", "/home/u/data/splits", counts, "nl2mysql")
    out = {r.data_name: r for r in REG.upsert(reg, new).collect()}
    assert out["b_train"].data_path == "splits/b_train.json" and out["b_train"].data_aug
    assert not out["b_test"].data_aug and out["b_test"].sum_num == 2
    assert out["a"].reg_ord == 0 and out["b"].reg_ord == 1 and {out["b_train"].reg_ord, out["b_test"].reg_ord} == {2, 3}


def test_quoting(spark):
    from pyspark.sql import functions as F
    from quarry.operators.catalog import quote_field, quote_table, spark_quote
    df = spark.createDataFrame([("t",)], "n string")
    r = df.select(quote_table("n", "postgresql", "s"), quote_table("n", "mssql"), quote_field("n", "mysql")).first()
    assert tuple(r) == ('"s"."t"', "[t]", "`t`")
    assert spark_quote("a`b") == "`a``b`"
    assert F is not None
