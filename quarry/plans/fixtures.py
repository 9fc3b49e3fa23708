"""Inputs the driver's tables lack (questions, SQL, replies, schema texts,
result pairs), derived from those tables by DataFrame code.  The oracles
derive the same rows with the SQL in ``FIXTURES.md``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.sources.tables import load

NL = "\n"


def _sql_text(custkey) -> F.Column:
    return F.concat(F.lit("SELECT COUNT(*) FROM orders WHERE o_custkey = "), custkey.cast("string"))


def _orders_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders joined to their customer's nation (the 'database')."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return o.join(c, o.o_custkey == c.c_custkey).join(n, F.col("c_nationkey") == F.col("n_nationkey"))


def _f1_cols():
    return [F.col("o_orderkey").alias("idx"), F.col("n_name").alias("db_name"),
            F.concat(F.lit("How many orders did customer "), F.col("o_custkey").cast("string"),
                     F.lit(" place?")).alias("question"),
            F.when(F.col("o_orderkey") % 3 == 0, F.lit(""))
            .otherwise(F.concat(F.lit("status refers to "), F.col("o_orderstatus"))).alias("evidence"),
            _sql_text(F.col("o_custkey")).alias("sql")]


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """processed records, one per order; the database is the nation."""
    return _orders_by_nation(spark, sf_dir).select(*_f1_cols())


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """raw model text in six shapes around the F1 SQL."""
    o = load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("idx"), _sql_text(F.col("o_custkey")).alias("sql"))
    s, k = F.col("sql"), F.col("idx") % 6
    pred = (F.when(k == 0, F.concat(F.lit("```sql" + NL), s, F.lit(NL + "```")))
            .when(k == 1, F.concat(F.lit("Here is it: ```sql SELECT 1 ``` then ```sql "), s,
                                   F.lit(" ``` done")))
            .when(k == 2, F.concat(F.lit("```" + NL), s, F.lit(NL + "```")))
            .when(k == 3, F.concat(s, F.lit(NL + "```")))
            .when(k == 4, F.concat(s, F.lit(" -- trailing" + NL + "  AND 1 = 1" + NL + NL + NL + "LIMIT 5")))
            .otherwise(s))
    return o.select("idx", "sql", pred.alias("pred_sql"))


def _schema_text_col() -> F.Column:
    return F.concat(
        F.lit("【DB_ID】 "), F.col("n_name"), F.lit(NL + "【Schema】" + NL),
        F.lit("# Table: orders" + NL + "[" + NL),
        F.lit("(o_orderkey:BIGINT, Primary Key, Examples: ["), F.col("o_orderkey").cast("string"),
        F.lit("])," + NL),
        F.lit("(o_custkey:BIGINT)," + NL + "(o_orderstatus:TEXT, Examples: [F, O, P])" + NL + "]" + NL),
        F.lit("# Table: customer, buyers" + NL + "[" + NL),
        F.lit("(c_custkey:BIGINT, Primary Key)," + NL + "(c_name:TEXT)" + NL + "]" + NL),
        F.lit("【Foreign keys】" + NL + "orders.o_custkey=customer.c_custkey"))


def schema_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 records with an M-Schema text holding a commented table and a FK."""
    return _orders_by_nation(spark, sf_dir).select(
        F.col("o_orderkey").alias("idx"), F.col("n_name").alias("db_name"),
        _sql_text(F.col("o_custkey")).alias("sql"), _schema_text_col().alias("db_schema"))


BULK_PAIR = 996       # a pair with a third of all orders (predicted columns swapped)
CUSTOMER_PAIR = 1000  # plus the customer's key


def result_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gold and predicted result rows (two text columns): five pairs of
    nations by region, one pair per customer with orders, and one bulk pair.
    By its id modulo 5 a pair's prediction is the same (0, 4), has its columns
    swapped (1), lacks the even rows (2) or repeats every row (3)."""
    def rows(df, pair, row, c0, c1):
        return df.select(pair.cast("long").alias("pair_id"), F.lit("gold").alias("side"), F.col(row).cast("long").alias("row_no"),
                         F.col(c0).cast("string").alias("c0"), F.col(c1).cast("string").alias("c1"))
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority")
    g = (rows(load(spark, sf_dir, "nation"), F.col("n_regionkey"), "n_nationkey", "n_name", "n_nationkey")
         .unionByName(rows(o, F.col("o_custkey") + CUSTOMER_PAIR, "o_orderkey", "o_orderstatus", "o_orderpriority"))
         .unionByName(rows(o.where("o_orderkey % 3 = 0"), F.lit(BULK_PAIR), "o_orderkey", "o_orderstatus", "o_orderpriority")))
    kind = F.col("pair_id") % 5
    swap = kind == 1
    p = (g.where(~((kind == 2) & (F.col("row_no") % 2 == 0)))
         .select("pair_id", F.lit("pred").alias("side"), "row_no",
                 F.when(swap, F.col("c1")).otherwise(F.col("c0")).alias("c0"),
                 F.when(swap, F.col("c0")).otherwise(F.col("c1")).alias("c1")))
    dup = g.where(kind == 3).select(
        "pair_id", F.lit("pred").alias("side"), (F.col("row_no") + 1_000_000_000_000).alias("row_no"), "c0", "c1")
    return g.unionByName(p).unionByName(dup)


def altered_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gold and predicted rows of four text columns per customer, and the
    bulk pair. Predicted rows come in the opposite order; by the order's key
    modulo 8 a row is the same (0-3; every fifth of the 3s is missing), has
    another key (4), price (5), key and price (6), or key, price and status (7)."""
    o = load(spark, sf_dir, "orders")
    def rows(df, pair):
        return df.select(pair.cast("long").alias("pair_id"), F.col("o_orderkey").cast("long").alias("row_no"),
                         F.concat(F.lit("k"), F.col("o_orderkey").cast("string")).alias("c0"),
                         F.concat(F.lit("p"), F.round(F.col("o_totalprice") * 100).cast("long").cast("string")).alias("c1"),
                         F.col("o_orderstatus").alias("c2"), F.col("o_orderpriority").alias("c3"))
    g = rows(o, F.col("o_custkey") + CUSTOMER_PAIR).union(rows(o.where("o_orderkey % 3 = 0"), F.lit(BULK_PAIR)))
    kind = F.col("row_no") % 8
    p = g.where(~((kind == 3) & (F.col("row_no") % 5 == 0))).select(
        "pair_id", F.lit("pred").alias("side"), (F.lit(1_000_000_000_000) - F.col("row_no")).alias("row_no"),
        F.when(kind.isin(4, 6, 7), F.concat(F.lit("x"), "c0")).otherwise(F.col("c0")).alias("c0"),
        F.when(kind.isin(5, 6, 7), F.concat(F.lit("y"), "c1")).otherwise(F.col("c1")).alias("c1"),
        F.when(kind == 7, F.lit("Z")).otherwise(F.col("c2")).alias("c2"), "c3")
    return g.select("pair_id", F.lit("gold").alias("side"), "row_no", "c0", "c1", "c2", "c3").unionByName(p)


def pair_texts(pairs: DataFrame) -> DataFrame:
    """The two query texts of every F5 pair: some gold and some predicted ones ask for an order."""
    head = F.concat(F.lit("SELECT * FROM orders WHERE o_custkey = "), (F.col("pair_id") - CUSTOMER_PAIR).cast("string"))
    order = lambda k, text: F.when(F.col("pair_id") % 4 == k, F.lit(text)).otherwise(F.lit(""))
    return pairs.select("pair_id", F.concat(head, order(1, " ORDER BY o_orderkey")).alias("gold_sql"),
                        F.concat(F.lower(head), order(2, " order by o_totalprice")).alias("pred_sql"))


F1_SQL = """SELECT o_orderkey AS idx, n_name AS db_name,
 concat('How many orders did customer ', cast(o_custkey AS string), ' place?') AS question,
 CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE concat('status refers to ', o_orderstatus) END AS evidence,
 concat('SELECT COUNT(*) FROM orders WHERE o_custkey = ', cast(o_custkey AS string)) AS sql
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

F2_SQL = """WITH f1 AS (
 SELECT o_orderkey AS idx, concat('SELECT COUNT(*) FROM orders WHERE o_custkey = ', cast(o_custkey AS string)) AS sql
 FROM orders)
SELECT idx, sql, CASE idx % 6
 WHEN 0 THEN concat('```sql', chr(10), sql, chr(10), '```')
 WHEN 1 THEN concat('Here is it: ```sql SELECT 1 ``` then ```sql ', sql, ' ``` done')
 WHEN 2 THEN concat('```', chr(10), sql, chr(10), '```')
 WHEN 3 THEN concat(sql, chr(10), '```')
 WHEN 4 THEN concat(sql, ' -- trailing', chr(10), '  AND 1 = 1', chr(10), chr(10), chr(10), 'LIMIT 5')
 ELSE sql END AS pred_sql
FROM f1"""

F3_SQL = """SELECT o_orderkey AS idx, n_name AS db_name,
 concat('SELECT COUNT(*) FROM orders WHERE o_custkey = ', cast(o_custkey AS string)) AS sql,
 concat('【DB_ID】 ', n_name, chr(10), '【Schema】', chr(10),
  '# Table: orders', chr(10), '[', chr(10),
  '(o_orderkey:BIGINT, Primary Key, Examples: [', cast(o_orderkey AS string), ']),', chr(10),
  '(o_custkey:BIGINT),', chr(10), '(o_orderstatus:TEXT, Examples: [F, O, P])', chr(10), ']', chr(10),
  '# Table: customer, buyers', chr(10), '[', chr(10),
  '(c_custkey:BIGINT, Primary Key),', chr(10), '(c_name:TEXT)', chr(10), ']', chr(10),
  '【Foreign keys】', chr(10), 'orders.o_custkey=customer.c_custkey') AS db_schema
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""

F4_SQL = f"""WITH g AS (
 SELECT n_regionkey AS pair_id, 'gold' AS side, n_nationkey AS row_no, n_name AS c0, cast(n_nationkey AS string) AS c1
 FROM nation
 UNION ALL SELECT o_custkey + {CUSTOMER_PAIR}, 'gold', o_orderkey, o_orderstatus, o_orderpriority FROM orders
 UNION ALL SELECT {BULK_PAIR}, 'gold', o_orderkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey % 3 = 0),
p AS (
 SELECT pair_id, 'pred' AS side, row_no,
  CASE WHEN pair_id % 5 = 1 THEN c1 ELSE c0 END AS c0, CASE WHEN pair_id % 5 = 1 THEN c0 ELSE c1 END AS c1
 FROM g WHERE NOT (pair_id % 5 = 2 AND row_no % 2 = 0)
 UNION ALL
 SELECT pair_id, 'pred' AS side, row_no + 1000000000000 AS row_no, c0, c1 FROM g WHERE pair_id % 5 = 3)
SELECT * FROM g UNION ALL SELECT * FROM p"""


F5_SQL = f"""WITH g AS (
 SELECT p AS pair_id, o_orderkey AS row_no, 'k' || cast(o_orderkey AS string) AS c0,
  'p' || cast(cast(round(o_totalprice * 100) AS BIGINT) AS string) AS c1, o_orderstatus AS c2, o_orderpriority AS c3
 FROM (SELECT *, o_custkey + {CUSTOMER_PAIR} AS p FROM orders
  UNION ALL SELECT *, {BULK_PAIR} AS p FROM orders WHERE o_orderkey % 3 = 0))
SELECT pair_id, 'gold' AS side, row_no, row_no % 8 AS kind, c0, c1, c2, c3 FROM g
UNION ALL
SELECT pair_id, 'pred', 1000000000000 - row_no, row_no % 8, CASE WHEN row_no % 8 IN (4, 6, 7) THEN 'x' || c0 ELSE c0 END,
 CASE WHEN row_no % 8 IN (5, 6, 7) THEN 'y' || c1 ELSE c1 END, CASE WHEN row_no % 8 = 7 THEN 'Z' ELSE c2 END, c3
FROM g WHERE NOT (row_no % 8 = 3 AND row_no % 5 = 0)"""


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 records with F3's schema text: ``(idx, db_name, question, evidence,
    db_schema, sql)`` - both from one join."""
    return _orders_by_nation(spark, sf_dir).select(*_f1_cols(), _schema_text_col().alias("db_schema")).select(
        "idx", "db_name", "question", "evidence", "db_schema", "sql")


PROCESSED_SQL = f"""SELECT f1.idx, f1.db_name, f1.question, f1.evidence, f3.db_schema, f1.sql
FROM ({F1_SQL}) f1 JOIN ({F3_SQL}) f3 ON f1.idx = f3.idx"""
