"""From registry to evaluation: datasets registered, split, assembled and scored
(S4, S5, S8, S9, S12, P19, P20, C2, C7, C9, C10, T7, I2-I4, E18, E21)."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.functions.ranking import global_rank
from quarry.operators import assembly, catalog as CAT, corpus, metrics as M, predict as PR, prompts as G, sft
from quarry.operators.compare import sql_text_match
from quarry.operators import responses as R
from quarry.plans.catalog_queries import COLS
from quarry.plans.eval_queries import SQL_KEY
from quarry.plans.fixtures import F1_SQL, F2_SQL, F3_SQL, PROCESSED_SQL, processed, replies, samples, schema_texts
from quarry.plans.schema_queries import CHAIN_SQL
from quarry.plans.train_queries import CHAT_TRAIN, R1_OF_F2, TOKENS, VALS, chat_train_q, fill_sql
from quarry.session import scratch_path
from quarry.sources import files, jsonarrays, registry as REG
from quarry.sources.tables import TABLE_NAMES, load, load_many

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


# ------------------------------------------------- registry and assembly --

SAMPLED = 300
NAMES = ("orders_nl2sqlite", "orders_nl2postgres")


def _stored(df: DataFrame, path: str) -> DataFrame:
    """Written once: read by several steps."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _registered(spark: SparkSession, sf_dir: str):
    """Two datasets of F1 records with F3 schemas (even and odd ids) written as JSON
    arrays and registered; the second is split and its train half registered too."""
    base = scratch_path(spark, "corpus")
    records = processed(spark, sf_dir)
    root = f"{base}/registry"
    parts = {}
    for k, name in enumerate(NAMES):
        path = f"data/{name}.json"
        jsonarrays.write_json_arrays(records.where(F.col("idx") % 2 == k), f"{base}/{path}")
        parts[name] = _stored(files.read_json_array(spark, f"{base}/{path}", assembly.RECORD), f"{base}/parsed/{name}")
        task = spark.range(1).select(corpus.detect_task_name(F.lit(name))).first()[0]
        info = corpus.task_info(path, task.removeprefix("nl2"), parts[name])
        REG.register(info.withColumn("reg_ord", F.lit(None).cast("int")).withColumn("data_aug", F.lit(True))
                     .select(*REG.REGISTRY_SCHEMA.fieldNames()), root)
    # the first dataset is sampled from now on: its row is replaced and keeps its place
    now = REG.current(spark, root)
    REG.register(now.where(F.col("data_name") == NAMES[0]).withColumn("sample_num", F.lit(SAMPLED).cast("long")), root)
    split = _stored(corpus.random_split(parts[NAMES[1]].drop("_file", "_pos"), "idx", 0.8, 42), f"{base}/split")
    for half in ("train", "test"):
        jsonarrays.write_json_arrays(split.where(F.col("split") == half).drop("split"), f"{base}/splits/{NAMES[1]}_{half}.json")
    counts = split.groupBy("split").agg(F.count("*").alias("n_rows"))
    REG.register(REG.split_entries(NAMES[1], "/srv/data/splits", counts, "nl2postgres", data_aug=False), root)
    return base, root


REGISTRY_SQL = f"""SELECT data_name, CAST(reg_ord AS INTEGER) AS reg_ord, data_path, CAST(sample_num AS BIGINT) AS sample_num,
 CAST(sum_num AS BIGINT) AS sum_num, task_name, data_aug FROM (
 SELECT '{NAMES[0]}' AS data_name, 0 AS reg_ord, 'data/{NAMES[0]}.json' AS data_path, {SAMPLED} AS sample_num,
  count(*) FILTER (WHERE idx % 2 = 0) AS sum_num, 'nl2sqlite' AS task_name, true AS data_aug FROM f1
 UNION ALL SELECT '{NAMES[1]}', 1, 'data/{NAMES[1]}.json', -1, count(*) FILTER (WHERE idx % 2 = 1), 'nl2postgres', true FROM f1
 UNION ALL SELECT '{NAMES[1]}_test', 2, 'splits/{NAMES[1]}_test.json', -1, count(*) - CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT), 'nl2postgres', false
  FROM f1 WHERE idx % 2 = 1
 UNION ALL SELECT '{NAMES[1]}_train', 3, 'splits/{NAMES[1]}_train.json', -1, CAST(floor(count(*) * CAST(0.8 AS DOUBLE)) AS BIGINT), 'nl2postgres', false
  FROM f1 WHERE idx % 2 = 1)"""


@register("registry_rows", f"WITH f1 AS ({F1_SQL}) {REGISTRY_SQL}")
def registry_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the registry holds after two datasets, a changed
    sample size and a split were registered one after the other."""
    return REG.current(spark, _registered(spark, sf_dir)[1])


@register("registry_assembly", f"""WITH aug AS ({CHAIN_SQL} SELECT idx, db_schema FROM out),
r AS ({PROCESSED_SQL}),
a AS (SELECT 0 AS d, '{NAMES[0]}' AS data_name, r.idx, question, evidence, aug.db_schema, sql, 'nl2sqlite' AS sql_type
 FROM (SELECT *, row_number() OVER (ORDER BY md5('42:sample:{NAMES[0]}:' || cast(idx AS VARCHAR)), idx) AS n FROM r WHERE idx % 2 = 0) r
 JOIN aug ON aug.idx = r.idx WHERE n <= {SAMPLED}),
b AS (SELECT 1 AS d, '{NAMES[1]}_train' AS data_name, idx, question, evidence, db_schema, sql, 'nl2postgresql' AS sql_type
 FROM (SELECT *, row_number() OVER (ORDER BY md5('42:split:' || cast(idx AS VARCHAR)), idx) - 1 AS n, count(*) OVER () AS total
  FROM r WHERE idx % 2 = 1) WHERE n < floor(total * CAST(0.8 AS DOUBLE))),
u AS (SELECT *, '' AS error_sql, '' AS error_info FROM a UNION ALL SELECT *, '', '' FROM b)
SELECT row_number() OVER (ORDER BY d, idx) - 1 AS id, data_name, idx, sql_type,
 CASE WHEN d = 0 THEN {fill_sql(G.TEMPLATES[('nl2sqlite', 'en')], VALS)} ELSE {fill_sql(G.TEMPLATES[('nl2postgresql', 'en')], VALS)} END AS prompt,
 chr(10) || sql || chr(10) || '```' AS answer FROM u""")
def registry_assembly_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C9 from the registry: one dataset sampled and augmented, the train half of
    the other as it is, each with its own task's prompt."""
    base, root = _registered(spark, sf_dir)
    entries = REG.current(spark, root).where(F.col("data_name").isin(NAMES[0], NAMES[1] + "_train"))
    records = assembly.read_datasets(spark, entries, base)
    out = assembly.assemble_registry(records, entries)
    return out.select("id", "data_name", "idx", "sql_type", F.col("conversations")[0]["content"].alias("prompt"),
                      F.col("conversations")[1]["content"].alias("answer"))


@register("task_names", """SELECT DISTINCT db_id, CASE WHEN contains(f, 'nl2sqlite') THEN 'nl2sqlite' WHEN contains(f, 'nl2postgres') THEN 'nl2postgres'
 WHEN contains(f, 'nl2mysql') THEN 'nl2mysql' ELSE 'nl2sql' END AS task_name
FROM (SELECT o_orderkey AS db_id, lower(['Train_NL2SQLite', 'dev_nl2postgres', 'nl2MySQL_x', 'nl2cypher'][o_orderkey % 4 + 1] || o_orderstatus || '.json') AS f FROM orders)""")
def task_names_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 over file names made from the orders."""
    o = load(spark, sf_dir, "orders")
    stems = F.array(*map(F.lit, ("Train_NL2SQLite", "dev_nl2postgres", "nl2MySQL_x", "nl2cypher")))
    name = F.concat(F.element_at(stems, (F.col("o_orderkey") % 4 + 1).cast("int")), "o_orderstatus", F.lit(".json"))
    return o.select(F.col("o_orderkey").alias("db_id"), corpus.detect_task_name(name).alias("task_name"))


@register("token_filter", f"""WITH c AS ({CHAT_TRAIN})
SELECT id, CAST({TOKENS.format('prompt')} AS INTEGER) AS n_tokens FROM c WHERE {TOKENS.format('prompt')} < 138""")
def token_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prompts of fewer than 138 tokens."""
    return corpus.token_length_filter(chat_train_q(spark, sf_dir), "prompt", 138).select("id", "n_tokens")


# ------------------------------------------------------- files and catalog --

@register("schema_files", f"""SELECT db_name, arg_max(db_schema, idx) AS text FROM ({F3_SQL}) GROUP BY db_name
UNION ALL SELECT 'no such file', ''""")
def schema_files_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + S5: one schema file per database, read back as whole texts; a missing
    file is an empty text."""
    path = scratch_path(spark, "schema_files")
    files.schema_files(schema_texts(spark, sf_dir), path)
    found = [r[0] for r in spark.read.text(path, wholetext=True).select("_metadata.file_path").distinct().collect()]  # one per database
    texts = files.read_whole_texts(spark, [*map(_plain, found), f"{path}/db_name=none/none.txt"])
    name = F.regexp_extract(F.url_decode("path"), r"db_name=([^/]+)/", 1)
    # Spark's text sink ends a file with a newline
    return texts.select(F.when(name == "none", F.lit("no such file")).otherwise(name).alias("db_name"),
                        F.regexp_replace("text", r"\n\z", "").alias("text"))


def _plain(uri: str) -> str:
    """A file URI without its escapes."""
    from urllib.parse import unquote
    return unquote(uri)


@register("stripped_lines", r"""SELECT regexp_replace(chr(9) || '  ' || c_name || ' x ' || chr(9), '^\s+|\s+$', '', 'g') AS value FROM customer""")
def stripped_lines_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S4 (and S6): padded lines written and read back without the padding."""
    path = scratch_path(spark, "lines")
    files.save_lines(load(spark, sf_dir, "customer").select(F.concat(F.lit("\t  "), "c_name", F.lit(" x \t")).alias("line")), "line", path)
    return files.read_lines(spark, path)


@register("quoted_names", """SELECT c_custkey, '`' || c_name || '`' AS mysql, '`' || c_name || '`' AS sqlite,
 '"s"."' || c_name || '"' AS postgresql, '[' || c_name || ']' AS mssql, '"' || c_name || '"' AS pg_field FROM customer""")
def quoted_names_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P19 for every dialect, over the customers' names."""
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", *[CAT.quote_table("c_name", d).alias(d) for d in ("mysql", "sqlite", "mssql")],
                    CAT.quote_table("c_name", "postgresql", "s").alias("postgresql"), CAT.quote_field("c_name", "postgresql").alias("pg_field"))


KEYS = ("l_orderkey", "l_partkey", "l_suppkey")
_MEASURES = [(t, c) for t in TABLE_NAMES for c, ty in COLS[t] if ty == "DOUBLE"]


@register("catalog_access", "\nUNION ALL\n".join(
    [f"SELECT 'measure' AS what, '{t}' AS table_name, '{c}' AS field_name, (SELECT cast(max({c}) AS VARCHAR) FROM {t}) AS value" for t, c in _MEASURES]
    + [f"SELECT 'field', '{t}', '{c}', '{ty}' FROM (SELECT 1) WHERE (SELECT count(*) FROM {t}) > 0" for t in ("lineitem",) for c, ty in COLS[t] if c in KEYS]
    + ["SELECT 'table', 'orders', NULL, 'true'", "SELECT 'table', 'absent', NULL, 'false'"]))
def catalog_access_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: set a property, select by category, look up a field and a table."""
    from quarry.operators.profile import column_stats
    tables = load_many(spark, sf_dir, TABLE_NAMES)
    ct, cf, _ = CAT.build_catalog(spark, "tpch", tables, n_examples=0)
    measures = cf.where("type = 'DOUBLE'").select("table_name", "field_name", F.lit("Measure").alias("value"))
    cf = CAT.set_field_property(cf, measures, "category")
    stats = None
    for t, df in tables.items():
        part = column_stats(t, df)
        stats = part if stats is None else stats.unionByName(part)
    path = scratch_path(spark, "stats")  # read by every look-up
    stats.write.parquet(path)
    stats = spark.read.parquet(path)
    out = (CAT.fields_by(cf, category="Measure").join(stats, ["table_name", "field_name"])
           .select(F.lit("measure").alias("what"), "table_name", "field_name", F.col("max_text").alias("value")))
    for c in KEYS:
        out = out.union(CAT.field_info(cf, "lineitem", c).join(stats.where("n_rows > 0"), ["table_name", "field_name"])
                        .select(F.lit("field"), "table_name", "field_name", "type"))
    for t in ("orders", "absent"):
        out = out.union(spark.range(1).select(F.lit("table"), F.lit(t), F.lit(None).cast("string"),
                                              F.lit(not CAT.has_table(ct, t).isEmpty()).cast("string")))
    return out


# ------------------------------------------------- prediction and results --

@register("predict_resumed", f"""{R1_OF_F2}, saved AS (SELECT idx, s FROM s3 WHERE length(coalesce(s, '')) > 0),
merged AS (SELECT f2.idx, coalesce(saved.s, 'SELECT ' || cast(f2.idx AS VARCHAR)) AS pred_sql FROM f2 LEFT JOIN saved ON saved.idx = f2.idx
 WHERE f2.idx < (SELECT max(idx) FROM f2))
SELECT idx, pred_sql, row_number() OVER (ORDER BY idx) - 1 AS pos FROM merged""")
def predict_resumed_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 + I3 + I4: the first inputs by position, without those that have a saved
    prediction, predicted anew, merged, in input order."""
    f2 = replies(spark, sf_dir)
    top = f2.agg(F.max("idx")).first()[0]
    inputs = PR.head(f2.select("idx"), top)
    saved = PR.head(f2.select("idx", R.extract_sql("pred_sql").alias("pred_sql")), top)
    todo = PR.resume_todo(inputs, saved)
    fresh = PR.batched_predict(todo.withColumn("prompt", F.col("idx").cast("string")), lambda ps: ["SELECT " + p for p in ps]).drop("prompt")
    merged = PR.resume_merge(saved, fresh)
    ordered = PR.restore_order(merged)
    return global_rank(ordered, ["idx"], "pos", 0).select("idx", "pred_sql", "pos")


@register("eval_rows", f"""{R1_OF_F2} SELECT f2.idx, s3.s AS pred_sql, f2.sql, '00042' AS stem FROM f2 JOIN s3 ON f2.idx = s3.idx""")
def eval_rows_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a training step's evaluation writes, and its file's stem."""
    f2 = replies(spark, sf_dir)
    rows, stem = sft.eval_rows(f2.withColumn("pred_sql", R.extract_sql("pred_sql")), 42)
    return rows.withColumn("stem", F.lit(stem))


@register("merged_results", f"""WITH f1 AS ({F1_SQL}), f2 AS ({F2_SQL})
SELECT f2.idx, f1.db_name AS db, f1.question, f2.pred_sql, f1.sql AS gold_sql, f2.idx AS sql_idx,
 CASE WHEN {SQL_KEY.format(x='f1.sql')} = {SQL_KEY.format(x='f2.pred_sql')} THEN 1 ELSE 0 END AS ex_eq,
 row_number() OVER (ORDER BY f2.idx) - 1 AS pos FROM f2 JOIN f1 ON f1.idx = f2.idx""")
def merged_results_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs checked, scored, merged with their questions, sorted."""
    golds = samples(spark, sf_dir)
    pairs = M.package_pairs(replies(spark, sf_dir).drop("sql"), golds)
    M.check_pairing(pairs)
    scores = pairs.select("idx", sql_text_match(F.col("gold_sql"), F.col("pred_sql")).alias("ex_eq"))
    merged = M.sort_results(M.merge_results(pairs.drop("pairing"), scores, golds))
    return global_rank(merged, ["sql_idx"], "pos", 0).select("idx", "db", "question", "pred_sql", "gold_sql", "sql_idx", "ex_eq", "pos")


# ------------------------------------------------- generated schemas and labels --

from quarry.operators.mschema import to_mschema  # noqa: E402
from quarry.operators.profile import label_fields  # noqa: E402
from quarry.plans.catalog_queries import TPCH_FKS, TPCH_KEYS, _mschema_sql  # noqa: E402
from quarry.plans.corpus_queries import RAW_SQL, raw_records  # noqa: E402
from quarry.plans.rule_queries import _category_sql, _grain_sql  # noqa: E402

GEN_TABLES = ("orders", "customer")


@register("normalize_generated", f"""WITH {RAW_SQL}, gen AS ({_mschema_sql(list(GEN_TABLES), TPCH_KEYS, TPCH_FKS)}),
own AS (SELECT idx, question, coalesce(evidence, '') AS evidence, raw_sql AS sql, CASE WHEN idx > 1000 THEN db_schema END AS own FROM raw)
SELECT idx, 'tpch' AS db_name, question, evidence, coalesce(last_value(own IGNORE NULLS) OVER (ORDER BY idx
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), mschema) AS db_schema, sql FROM own, gen""")
def normalize_generated_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 with M2's output: records without a schema of their own or an earlier one
    get the text generated from the database's catalog."""
    tables = load_many(spark, sf_dir, GEN_TABLES)
    ct, cf, ck = CAT.build_catalog(spark, "tpch", tables, primary_keys=TPCH_KEYS,
                                   foreign_keys=[fk for fk in TPCH_FKS if fk[0] in tables and fk[2] in tables])
    generated = to_mschema(ct, cf, ck).select(F.col("db").alias("db_name"), F.col("mschema").alias("db_schema"))
    raw = raw_records(spark, sf_dir).withColumn("db_id", F.lit("tpch")).drop("db_name").withColumn(
        "db_schema", F.when(F.col("idx") > 1000, F.col("db_schema")))
    return corpus.normalize_records(raw, generated, bucket_size=5000)


LABEL_TABLES = ("orders", "lineitem", "customer", "part", "events")
_DAYS = [("dt_key", "BIGINT", None), ("dt_day", "TEXT", "DAY"), ("dt_month", "TEXT", "MONTH"), ("dt_year", "INTEGER", "YEAR"), ("dt_stamp", "TIMESTAMP", None)]


def _label_sql(t, c, ty, grain=None):
    unit = f"'{grain}'" if grain else f"(SELECT date_min_gran FROM ({_grain_sql(t, c)}))" if ty == "TIMESTAMP" else "NULL"
    return (f"SELECT table_name, field_name, category, dim_or_meas, CAST({unit} AS VARCHAR) AS date_min_gran, "
            f"CASE WHEN category = 'Enum' THEN (SELECT count(DISTINCT {c}) FROM {t}) END AS n_values FROM ({_category_sql(t, c, ty)})")


@register("field_labels", """WITH order_days AS (SELECT o_orderkey AS dt_key, strftime(o_orderdate, '%Y-%m-%d') AS dt_day, strftime(o_orderdate, '%Y-%m') AS dt_month,
 year(o_orderdate)::INTEGER AS dt_year, o_orderdate AS dt_stamp FROM orders)
""" + "\nUNION ALL\n".join([_label_sql(t, c, ty) for t in LABEL_TABLES for c, ty in COLS[t]] + [_label_sql("order_days", *f) for f in _DAYS]))
def field_labels_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 to P15 over given tables and one whose dates are texts and numbers."""
    tables = load_many(spark, sf_dir, LABEL_TABLES)
    tables["order_days"] = tables["orders"].select(
        F.col("o_orderkey").alias("dt_key"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("dt_day"),
        F.date_format("o_orderdate", "yyyy-MM").alias("dt_month"), F.year("o_orderdate").alias("dt_year"), F.col("o_orderdate").alias("dt_stamp"))
    out = label_fields(tables)
    return out.select("table_name", "field_name", "category", "dim_or_meas", "date_min_gran", F.size("values").cast("long").alias("n_values"))
