"""Corpus queries (C1-C9) over F1 with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import corpus
from quarry.plans.fixtures import F1_SQL, F3_SQL, samples, schema_texts
from quarry.sources.tables import load

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw-record shapes from F1: ``db_id`` always, ``db_name`` on odd ids,
    missing evidence, ``SQL`` spelling, a schema on every seventh record."""
    f1 = samples(spark, sf_dir)
    return f1.select(
        "idx", F.col("db_name").alias("db_id"),
        F.when(F.col("idx") % 2 == 0, F.lit(None).cast("string")).otherwise(F.col("db_name")).alias("db_name"),
        "question",
        F.when(F.col("idx") % 3 == 0, F.lit(None).cast("string")).otherwise(F.col("evidence")).alias("evidence"),
        F.col("sql").alias("SQL"),
        F.when(F.col("idx") % 7 == 0, F.concat(F.lit("schema of "), F.col("db_name"), F.lit(" at "),
                                               F.col("idx").cast("string"))).alias("db_schema"))


RAW_SQL = f"""raw AS (
 SELECT idx, db_name AS db_id, CASE WHEN idx % 2 = 0 THEN NULL ELSE db_name END AS db_name, question,
  CASE WHEN idx % 3 = 0 THEN NULL ELSE evidence END AS evidence, sql AS raw_sql,
  CASE WHEN idx % 7 = 0 THEN concat('schema of ', db_name, ' at ', cast(idx AS string)) END AS db_schema
 FROM ({F1_SQL}))"""


@register("normalize_records", f"""
WITH {RAW_SQL},
gen AS (SELECT n_name, concat('【DB_ID】 ', n_name) AS g FROM nation),
n AS (SELECT idx, coalesce(db_name, db_id) AS db_name, coalesce(question, '') AS question,
  coalesce(evidence, '') AS evidence, db_schema, coalesce(raw_sql, '') AS sql FROM raw)
SELECT idx, db_name, question, evidence,
 coalesce(last_value(db_schema IGNORE NULLS) OVER (PARTITION BY db_name ORDER BY idx
   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), g) AS db_schema, sql
FROM n LEFT JOIN gen ON n.db_name = gen.n_name
""")
def normalize_records_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    gen = load(spark, sf_dir, "nation").select(
        F.col("n_name").alias("db_name"), F.concat(F.lit("【DB_ID】 "), F.col("n_name")).alias("db_schema"))
    # small bucket so the cross-bucket carry is exercised at test scale
    return corpus.normalize_records(raw_records(spark, sf_dir), gen, bucket_size=5000)


H_SPLIT = "md5(concat('42:split:', cast(idx AS string)))"


@register("split_random", f"""
WITH f AS ({F1_SQL}),
r AS (SELECT idx, row_number() OVER (ORDER BY {H_SPLIT}, idx) - 1 AS r, count(*) OVER () AS n FROM f)
SELECT idx, CASE WHEN r < floor(n * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split FROM r
""")
def split_random_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.random_split(samples(spark, sf_dir), "idx", 0.8, 42).select("idx", "split")


STRAT_SQL = f"""strat AS (
 SELECT idx, db_name, CASE WHEN row_number() OVER (PARTITION BY db_name ORDER BY {H_SPLIT}, idx) - 1
   < floor(count(*) OVER (PARTITION BY db_name) * CAST(0.8 AS DOUBLE)) THEN 'train' ELSE 'test' END AS split
 FROM ({F1_SQL}))"""


@register("split_stratified", f"WITH {STRAT_SQL} SELECT idx, db_name, split FROM strat")
def split_stratified_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.stratified_split(samples(spark, sf_dir), "idx", "db_name", 0.8, 42).select(
        "idx", "db_name", "split")


@register("split_stats", f"""
WITH {STRAT_SQL},
both_ AS (SELECT count(*) AS nb FROM (SELECT db_name FROM strat WHERE split = 'train'
  INTERSECT SELECT db_name FROM strat WHERE split = 'test'))
SELECT split, count(*) AS n_rows, round(count(*) * 100.0 / (SELECT count(*) FROM strat), 2) AS pct,
 count(DISTINCT db_name) AS n_dbs, (SELECT nb FROM both_) AS n_dbs_in_both
FROM strat GROUP BY split
""")
def split_stats_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = corpus.stratified_split(samples(spark, sf_dir), "idx", "db_name", 0.8, 42)
    return corpus.split_stats(s)


@register("reindex", f"""
SELECT idx AS old_idx, row_number() OVER (ORDER BY db_name, idx) - 1 + 1000 AS idx FROM ({F1_SQL})
""")
def reindex_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    f1 = samples(spark, sf_dir).withColumn("old_idx", F.col("idx"))
    return corpus.reindex(f1, ["db_name", "old_idx"], start=1000).select("old_idx", "idx")


@register("sample_n", f"""
SELECT idx FROM (SELECT idx, row_number() OVER (ORDER BY md5(concat('42:sample:', cast(idx AS string))), idx) AS r
 FROM ({F1_SQL})) WHERE r <= 1000
""")
def sample_n_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.sample_n(samples(spark, sf_dir), "idx", 1000, 42).select("idx")


@register("assemble", f"""
WITH a AS (SELECT 0 AS d, 'order_questions' AS data_name, idx FROM ({F1_SQL})),
b AS (SELECT 1 AS d, 'order_schemas' AS data_name, idx FROM (
  SELECT idx, row_number() OVER (ORDER BY md5(concat('42:sample:order_schemas:', cast(idx AS string))), idx) AS r
  FROM ({F3_SQL})) WHERE r <= 500),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT row_number() OVER (ORDER BY d, idx) - 1 AS id, data_name, idx FROM u
""")
def assemble_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ds = [("order_questions", samples(spark, sf_dir), -1),
          ("order_schemas", schema_texts(spark, sf_dir), 500)]
    return corpus.assemble(ds, "idx", 42).select("id", "data_name", "idx")

