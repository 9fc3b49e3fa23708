"""The profile, catalog and key queries over all given tables; the queries of
the same names without ``_all`` read a part of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from quarry.operators import profile as PRO
from quarry.operators.catalog import build_catalog
from quarry.plans import catalog_queries as C
from quarry.plans import rule_queries as R
from quarry.session import scratch_path
from quarry.sources.tables import TABLE_NAMES, load_many

QUERIES: dict = {}
ORACLES: dict = {}


def _whole(name, fn, oracle):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir, TABLE_NAMES)
    run.__name__ = name
    run.__doc__ = fn.__doc__
    QUERIES[name], ORACLES[name] = run, oracle


def _exact_averages(tables) -> DataFrame:
    """Averages in millionths from exact sums: sums of doubles differ in the last
    bits between engines, which shows at ties."""
    out = None
    for t, df in tables.items():
        fields = [(i, f.name) for i, f in enumerate(df.schema.fields) if isinstance(f.dataType, NumericType)]
        if not fields:
            continue
        agg = df.agg(*[f(x).alias(f"{k}{i}") for i, c in fields for k, f, x in (
            ("s", F.sum, (F.col(c).cast("decimal(28,6)") * 1_000_000).cast("decimal(38,0)")), ("n", F.count, F.col(c)))])
        part = agg.select(F.inline(F.array(*[F.struct(
            F.lit(t).alias("table_name"), F.lit(c).alias("field_name"),
            (F.expr(f"(2 * s{i} + n{i}) div (2 * nullif(n{i}, 0))") / 1_000_000).alias("exact_avg")) for i, c in fields])))
        out = part if out is None else out.unionByName(part)
    return out


def field_profile(spark: SparkSession, sf_dir: str, names) -> DataFrame:
    """Averages to six digits, from exact sums."""
    tables = load_many(spark, sf_dir, names)
    path = scratch_path(spark, "profile")  # a row per field, read by the catalog too
    PRO.profile(tables, n_examples=10).write.parquet(path)
    profiled = spark.read.parquet(path)
    prof = profiled.join(_exact_averages(tables), ["table_name", "field_name"], "left")
    prof = prof.withColumn("avg_value", F.col("exact_avg"))
    _, cf, _ = build_catalog(spark, "tpch", tables, primary_keys=C.TPCH_KEYS, profiled=profiled)
    return PRO.field_profile_text(prof, cf.drop("examples")).select("table_name", "field_name", "profile_text")


def _block_sql(t):
    """Texts over 30 characters are cut at a word, which small tables never need."""
    sql = C._profile_block_sql(t).replace("string_agg(v, ", f"string_agg({C._trunc_sql('v')}, ")
    for c, _ in C.COLS[t]:
        sql = sql.replace(f"avg({c})::DOUBLE", 
                          f"(((2 * (sum(({c}::DECIMAL(28,6) * 1000000)::HUGEINT)) + count({c})) // (2 * count({c}))) / 1000000)::DOUBLE")
    return sql


def _schema_sql():
    """Examples over 30 characters are not shown; the array column has none."""
    sql = C._mschema_sql(TABLE_NAMES, C.TPCH_KEYS, C.TPCH_FKS)
    sql = sql.replace("FILTER (WHERE length(v) > 0)", "FILTER (WHERE length(v) BETWEEN 1 AND 30)")
    at = TABLE_NAMES.index("embeddings")
    return sql.replace("\n), l AS (", f"\nUNION ALL SELECT {at}, 'embeddings', 0.5, 'embedding', 'ARRAY', false, ''\n), l AS (")


def _comment_sql():
    """The array column has no profile, so no mode gives it a comment."""
    return R._comment_oracle(TABLE_NAMES) + "".join(
        f"\nUNION ALL\nSELECT '{m}', 'embeddings', 'embedding', ''" for m in ("origin", "no_comment", "generation", "merge"))


_SCHEMA = _schema_sql()
_whole("field_profile_all", field_profile, "\nUNION ALL\n".join(_block_sql(t) for t in TABLE_NAMES))
_whole("mschema_text_all", C.mschema_text, _SCHEMA)
_whole("mschema_dump_roundtrip_all", C.mschema_dump_roundtrip_q, _SCHEMA)
_whole("comment_modes_all", R.comment_modes_q, _comment_sql())
_whole("key_discovery_all", C.key_discovery_q, C._key_sql(TABLE_NAMES))
_whole("fk_discovery_all", C.fk_discovery_q, C._fk_sql(TABLE_NAMES))
