"""Composite keys and foreign keys over all given tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.operators import keys as K
from quarry.operators.catalog import build_catalog
from quarry.plans.catalog_queries import COLS
from quarry.session import scratch_path
from quarry.sources import files
from quarry.sources.tables import TABLE_NAMES, load_many

QUERIES: dict = {}
ORACLES: dict = {}
WIDTH = 3


def register(name, oracle):
    def deco(fn):
        QUERIES[name], ORACLES[name] = fn, oracle
        return fn
    return deco


def _unique_sql(t: str) -> str:
    """Which column sets of a table are unique and without nulls: one scan, a list of flags."""
    cols = [c for c, _ in COLS[t]]
    sets = [s for k in range(1, WIDTH + 1) for s in combinations(cols, k)]
    flags = ", ".join(f"{{'fields': {list(s)!r}, 'ok': count(*) > 0 AND count(DISTINCT ({', '.join(s)})) = count(*) AND "
                      + " AND ".join(f"count({c}) = count(*)" for c in s) + "}" for s in sets)
    return f"SELECT '{t}' AS table_name, unnest([{flags}], recursive := true) FROM {t}"


UNIQUE_SQL = f"""unique_sets AS (
 SELECT table_name, fields FROM ({chr(10).join((' UNION ALL ' if i else ' ') + _unique_sql(t) for i, t in enumerate(TABLE_NAMES))}) WHERE ok),
minimal AS (SELECT * FROM unique_sets a WHERE NOT EXISTS (
 SELECT 1 FROM unique_sets b WHERE b.table_name = a.table_name AND len(b.fields) < len(a.fields) AND list_has_all(a.fields, b.fields)))"""
MINIMAL_SQL = f"WITH {UNIQUE_SQL}\nSELECT table_name, array_to_string(fields, ',') AS fields FROM minimal"


@register("key_composite", MINIMAL_SQL)
def key_composite_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = K.key_rows(spark, "tpch", K.unique_sets(load_many(spark, sf_dir, TABLE_NAMES), WIDTH))
    return found.select("table_name", F.array_join("fields", ",").alias("fields"))


@register("mschema_dump_keys", MINIMAL_SQL)
def mschema_dump_keys_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Found keys through a dump to JSON and back."""
    tables = load_many(spark, sf_dir, TABLE_NAMES)
    found = K.key_rows(spark, "tpch", K.unique_sets(tables, WIDTH))
    ct, cf, ck = build_catalog(spark, "tpch", tables, n_examples=0)
    path = scratch_path(spark, "mschema_keys")
    files.dump_mschema(ct, cf, ck, found).write.json(path)
    back = files.load_keys(spark.read.schema(files.MSCHEMA_DUMP).json(path))
    return back.where("kind = 'unique'").select("table_name", F.array_join("fields", ",").alias("fields"))


def _with_answers(spark, sf_dir):
    """The given tables and two made from them: the assistant's turns, and the last
    such turn of every conversation."""
    tables = load_many(spark, sf_dir, TABLE_NAMES)
    turns = tables["conversations"].where("role = 'assistant'")
    tables["answers"] = turns.select(F.col("turn").alias("an_turn"), F.col("conv_id").alias("an_conv"), F.length("text").alias("an_length"))
    tables["last_answers"] = turns.groupBy(F.col("conv_id").alias("la_conv")).agg(F.max("turn").alias("la_turn"))
    return tables


_FK_COLS = {t: [(c, ty) for c, ty in COLS[t] if ty in ("INTEGER", "BIGINT", "TEXT")] for t in TABLE_NAMES} | {
    "answers": [("an_turn", "BIGINT"), ("an_conv", "BIGINT"), ("an_length", "INTEGER")],
    "last_answers": [("la_conv", "BIGINT"), ("la_turn", "BIGINT")]}


def _cells_sql() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{t}' AS tab, row_number() OVER () AS rn, unnest([" + ", ".join(
            f"{{'ord': {i}, 'col': '{c}', 'val': '{ty}:' || md5(cast({c} AS VARCHAR))}}" for i, (c, ty) in enumerate(cols))
        + f"], recursive := true) FROM {t}" for t, cols in _FK_COLS.items())


@register("fk_composite", f"""WITH answers AS (
 SELECT turn AS an_turn, conv_id AS an_conv, length(text)::INTEGER AS an_length FROM conversations WHERE role = 'assistant'),
last_answers AS (SELECT conv_id AS la_conv, max(turn) AS la_turn FROM conversations WHERE role = 'assistant' GROUP BY conv_id),
{UNIQUE_SQL},
cells AS (SELECT * FROM ({_cells_sql()}) WHERE val IS NOT NULL),
tuples AS (SELECT DISTINCT a.tab, [a.col, b.col] AS cols, a.val AS v1, b.val AS v2
 FROM cells a JOIN cells b ON a.tab = b.tab AND a.rn = b.rn AND a.ord <> b.ord),
parents AS (SELECT tuples.* FROM tuples JOIN minimal ON tab = table_name AND cols = fields),
counts AS (SELECT tab, cols, count(*) AS n FROM tuples GROUP BY ALL),
met AS (SELECT c.tab, c.cols, p.tab AS ref, p.cols AS ref_cols, count(*) AS n
 FROM tuples c JOIN parents p ON c.v1 = p.v1 AND c.v2 = p.v2 AND NOT (c.tab = p.tab AND c.cols = p.cols) GROUP BY ALL)
SELECT met.tab AS table_name, array_to_string(met.cols, ',') AS fields, ref AS ref_table, array_to_string(ref_cols, ',') AS ref_fields
FROM met JOIN counts ON met.tab = counts.tab AND met.cols = counts.cols AND met.n = counts.n""")
def fk_composite_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Foreign keys of two columns, with tables of answers beside the given ones."""
    tables = _with_answers(spark, sf_dir)
    given = {t: tables[t] for t in TABLE_NAMES}
    keys = [x for x in K.unique_sets(given, 2) if len(x[1]) == 2]
    rows = [(t, ",".join(s), u, ",".join(r)) for t, s, u, r in K.composite_fks(tables, keys)]
    return spark.createDataFrame(rows, "table_name string, fields string, ref_table string, ref_fields string")
