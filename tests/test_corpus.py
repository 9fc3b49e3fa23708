"""Corpus operators (C1-C11): exact sizes, keyed determinism, quirks."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.functions.ranking import fill_forward, global_rank
from quarry.operators import corpus as C
from quarry.plans.fixtures import samples


def test_global_rank_is_dense_and_partition_independent(spark):
    df = spark.range(0, 1000).withColumn("k", (F.col("id") * 7919) % 1000)
    a = {r.id: r.rank for r in global_rank(df.repartition(3), ["k", "id"], "rank", 0, 5).collect()}
    b = {r.id: r.rank for r in global_rank(df.repartition(11), ["k", "id"], "rank", 0, 2).collect()}
    assert a == b and sorted(a.values()) == list(range(1000))


def test_random_split_sizes_and_seed(spark):
    f1 = samples(spark, SF_SMALL)
    n = f1.count()
    s1 = C.random_split(f1.repartition(2), "idx", 0.8, 42)
    s2 = C.random_split(f1.repartition(5), "idx", 0.8, 42)
    t1 = {r.idx for r in s1.where("split = 'train'").collect()}
    assert len(t1) == int(n * 0.8)
    assert t1 == {r.idx for r in s2.where("split = 'train'").collect()}
    s3 = C.random_split(f1, "idx", 0.8, 7)
    assert t1 != {r.idx for r in s3.where("split = 'train'").collect()}


def test_stratified_group_of_one_goes_to_test(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (3, "a"), (4, "a"), (5, "b"), (6, None)],
                               "idx long, db_name string")
    out = {r.idx: r.split for r in C.stratified_split(df, "idx", "db_name", 0.5).collect()}
    assert sum(1 for i in (1, 2, 3, 4) if out[i] == "train") == 2
    assert out[5] == "test" and out[6] == "test"  # quirk Q6; missing key -> 'unknown'


def test_sample_exact_and_too_many(spark):
    f1 = samples(spark, SF_SMALL)
    assert C.sample_n(f1, "idx", 100).count() == 100
    assert C.sample_n(f1, "idx", -1).count() == f1.count()
    try:
        C.sample_n(f1, "idx", f1.count() + 1)
        raise AssertionError("expected an error")
    except ValueError:
        pass


def test_reindex_contiguous(spark):
    df = spark.createDataFrame([(10, "b"), (3, "a"), (7, "a")], "old long, db string")
    out = [(r.old, r.idx) for r in C.reindex(df, ["db", "old"], 5).orderBy("idx").collect()]
    assert out == [(3, 5), (7, 6), (10, 7)]


def test_fill_forward_crosses_buckets(spark):
    rows = [(i, "d", "s0" if i == 0 else ("s5" if i == 5 else None)) for i in range(12)]
    rows += [(i, "e", None) for i in range(3)]
    df = spark.createDataFrame(rows, "idx long, db string, v string")
    out = {(r.db, r.idx): r.f for r in fill_forward(df, "db", "idx", "v", "f", bucket_size=2).collect()}
    assert out[("d", 4)] == "s0" and out[("d", 11)] == "s5" and out[("e", 2)] is None


def test_normalize_missing_and_null_schema_alike(spark):
    raw = spark.createDataFrame([(0, "x", None, "q", None, "S1", "sch"), (1, "x", None, None, "ev", None, None)],
                                "idx long, db_id string, db_name string, question string, evidence string, "
                                "SQL string, db_schema string")
    out = {r.idx: r for r in C.normalize_records(raw).collect()}
    assert out[1].db_schema == "sch" and out[1].question == "" and out[1].sql == ""
    assert out[0].evidence == "" and out[0].db_name == "x"


def test_task_name_detection(spark):
    df = spark.createDataFrame([("a_nl2sqlite.json",), ("x_NL2Postgres",), ("b",)], "n string")
    assert [r[0] for r in df.select(C.detect_task_name(F.col("n"))).collect()] == ["nl2sqlite", "nl2postgres",
                                                                                 "nl2sql"]


def test_task_info(spark):
    info = C.task_info("data/processed/train_nl2sqlite.json", "SQLite", spark.range(3)).first()
    assert info.data_name == "processed_train_nl2sqlite" and info.sum_num == 3 and info.task_name == "nl2sqlite"
