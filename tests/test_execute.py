"""SQL execution outcomes (E3, E4, E22): failing, timed-out and gold-failing SQL."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quarry.operators import execute as X
from quarry.sources.tables import register_views


def test_outcomes_and_scores(spark):
    register_views(spark, SF_SMALL, ["orders", "nation"])
    slow = ("SELECT count(*) FROM range(0, 400000000) a WHERE a.id % 7 = 3 "
            "AND reflect('java.lang.Thread', 'sleep', 1L) IS NULL")
    pairs = spark.createDataFrame([
        (1, "d", "SELECT n_name FROM nation", "SELECT n_name FROM nation"),
        (2, "d", "SELEC oops", "SELECT 1"),                        # prediction fails
        (3, "d", "SELECT 1", "SELECT * FROM no_such_table"),       # gold fails (Q9)
        (4, "d", slow, "SELECT 1"),                                # time-out (Q8)
        (5, "d", "SELECT n_nationkey, n_name FROM nation", "SELECT n_name, n_nationkey FROM nation"),
        (6, "d", "SELECT 1 AS a WHERE 1 = 0", "SELECT 2 AS b WHERE 1 = 0"),  # both empty
        (7, "d", "SELECT count(*), count(*) FROM nation", "SELECT count(*), count(*) FROM nation"),  # equal names
        (8, "d", "SELECT a.n_name, b.n_name FROM nation a JOIN nation b USING (n_nationkey)",
         "SELECT b.n_name, a.n_name FROM nation a JOIN nation b USING (n_nationkey)"),
        (9, "d", "DROP VIEW nation", "SELECT n_name FROM nation"),           # commands do not run
        (10, "d", "WITH x AS (SELECT 1) INSERT INTO nation SELECT * FROM x", "SELECT 1"),
        (11, "d", "SET spark.sql.shuffle.partitions=1", "SELECT 1"),
    ], "pair_id long, db string, pred_sql string, gold_sql string")
    out = {r.pair_id: r for r in X.evaluate_pairs(spark, pairs, timeout_s=8, threads=4).collect()}
    assert (out[1].ex_eq, out[1].ex_bird, out[1].executable) == (1, 1, 1)
    assert (out[2].executable, out[2].outcome) == (0, "error")
    assert (out[3].executable, out[3].gold_failed) == (0, True)
    assert (out[4].executable, out[4].outcome, out[4].ex_eq) == (1, "timeout", 0)
    assert (out[5].ex_eq, out[5].ex_bird) == (1, 0)
    assert (out[6].ex_eq, out[6].ex_bird) == (1, 1)
    assert all((out[i].ex_eq, out[i].executable) == (1, 1) for i in (7, 8))
    assert all((out[i].executable, out[i].outcome, out[i].gold_failed) == (0, "error", False) for i in (9, 10, 11))
    assert spark.table("nation").count() == 25 and len(out) == 11


def test_pair_limit_is_for_both_texts(spark):
    pairs = spark.createDataFrame([(1, "d", "p", "g"), (2, "d", "p", "p")], "pair_id long, db string, pred_sql string, gold_sql string")
    texts = [(r.text_id, "ok", None, 1, 6.0) for r in X.pair_texts(pairs).collect()]
    log = spark.createDataFrame(texts, "text_id string, status string, message string, n_cols int, seconds double")
    assert {r.pair_id: r.outcome for r in X.outcome_flags(pairs, log, 10).collect()} == {1: "timeout", 2: "ok"}


def test_dry_run(spark):
    register_views(spark, SF_SMALL, ["orders"])
    texts = spark.createDataFrame([("a", "d", "SELECT count(*) FROM orders"), ("b", "d", "SELECT nope FROM orders")],
                                  "text_id string, db string, sql string")
    ok = {r.text_id: r.ok for r in X.dry_run(spark, texts).collect()}
    assert ok == {"a": True, "b": None}


def test_package_pairs(spark):
    from quarry.operators.metrics import check_pairing, package_pairs
    preds = spark.createDataFrame([(0, "```sql\nSELECT 1\n```"), (1, "")], "idx long, pred_sql string")
    golds = spark.createDataFrame([(0, "", "db0", "SELECT 1"), (1, "db1", None, "SELECT 2")],
                                  "idx long, db_id string, db_name string, SQL string")
    p = {r.idx: r for r in package_pairs(preds, golds, post_process=True).collect()}
    assert p[0].pred_sql == "SELECT 1" and p[0].db == "db0" and p[0].gold_sql == "SELECT 1"
    assert p[1].db == "db1" and p[1].pairing == "ok"
    check_pairing(package_pairs(preds, golds))
    try:
        check_pairing(package_pairs(preds.where(F.col("idx") == 0), golds))
        raise AssertionError("expected unmatched rows to fail")
    except ValueError:
        pass
