"""Catalog tables.

A database is a dict ``{table_name: DataFrame}`` in catalog order.  Its
description is three flat DataFrames:

* ``catalog_tables(db, schema, table_name, table_ord, table_type, comment)``
* ``catalog_fields(db, table_name, field_name, field_ord, type, primary_key,
  nullable, default, autoincrement, unique, comment, examples, category,
  dim_or_meas, date_min_gran, value_mapping)``
* ``catalog_fks(db, fk_ord, table_name, field_name, ref_schema, ref_table,
  ref_field)``

Table and field rows come from ``DataFrame.schema`` (schema-sized, built on the
driver); example values come from the profile job.  Spark sources carry no
constraints, so keys are either declared or discovered (:func:`discover_keys`,
:func:`discover_fks`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.types import sql_type_name
from quarry.operators.keys import KEY_TYPES, common_values
from quarry.operators.profile import examples_to_str, profile

TABLES_SCHEMA = T.StructType([
    T.StructField("db", T.StringType()), T.StructField("schema", T.StringType()),
    T.StructField("table_name", T.StringType()), T.StructField("table_ord", T.IntegerType()),
    T.StructField("table_type", T.StringType()), T.StructField("comment", T.StringType()),
])
FIELDS_BASE = T.StructType([
    T.StructField("db", T.StringType()), T.StructField("table_name", T.StringType()),
    T.StructField("field_name", T.StringType()), T.StructField("field_ord", T.IntegerType()),
    T.StructField("type", T.StringType()), T.StructField("primary_key", T.BooleanType()),
    T.StructField("nullable", T.BooleanType()), T.StructField("default", T.StringType()),
    T.StructField("autoincrement", T.BooleanType()), T.StructField("unique", T.BooleanType()),
    T.StructField("comment", T.StringType()),
])
FKS_SCHEMA = T.StructType([
    T.StructField("db", T.StringType()), T.StructField("fk_ord", T.IntegerType()),
    T.StructField("table_name", T.StringType()), T.StructField("field_name", T.StringType()),
    T.StructField("ref_schema", T.StringType()), T.StructField("ref_table", T.StringType()),
    T.StructField("ref_field", T.StringType()),
])


def build_catalog(spark: SparkSession, db_id: str, tables: dict[str, DataFrame],
                  schema: str | None = None,
                  primary_keys: dict[str, list[str]] | None = None,
                  unique_keys: dict[str, list[list[str]]] | None = None,
                  foreign_keys: list[tuple[str, str, str, str]] | None = None,
                  table_comments: dict[str, str] | None = None,
                  field_comments: dict[tuple[str, str], str] | None = None,
                  n_examples: int = 5, profiled: DataFrame | None = None):
    """Build the three catalog DataFrames for one database.

    ``foreign_keys`` are ``(table, field, ref_table, ref_field)`` in order; the
    referenced schema is the database's own. ``profiled`` may be a written
    :func:`profile` of these tables with at least ``n_examples`` examples."""
    primary_keys = primary_keys or {}
    unique_keys = unique_keys or {}
    table_comments = table_comments or {}
    field_comments = field_comments or {}
    t_rows, f_rows = [], []
    for t_ord, (tname, df) in enumerate(tables.items()):
        t_rows.append((db_id, schema, tname, t_ord, "table", table_comments.get(tname, "")))
        pks = primary_keys.get(tname, [])
        uks = unique_keys.get(tname, [])
        for f_ord, f in enumerate(df.schema.fields):
            is_pk = f.name in pks
            # unique: the only primary-key column, or itself a one-column unique key
            uniq = (is_pk and len(pks) == 1) or (not is_pk and [f.name] in uks)
            f_rows.append((db_id, tname, f.name, f_ord, sql_type_name(f.dataType), is_pk,
                           bool(f.nullable), None, False, bool(uniq),
                           field_comments.get((tname, f.name), "")))
    cat_tables = spark.createDataFrame(t_rows, TABLES_SCHEMA)
    base = spark.createDataFrame(f_rows, FIELDS_BASE)
    if profiled is None:
        prof = profile(tables, n_examples).select("table_name", "field_ord", F.col("examples"))
    else:
        first = F.slice("raw_examples", 1, n_examples)
        prof = profiled.select("table_name", "field_ord", examples_to_str(first, F.col("type_cate")).alias("examples"))
    fields = (base.join(prof, ["table_name", "field_ord"], "left")
              .select(*[c for c in FIELDS_BASE.fieldNames()],
                      F.coalesce("examples", F.array().cast("array<string>")).alias("examples"),
                      F.lit("").alias("category"), F.lit("").alias("dim_or_meas"),
                      F.lit(None).cast("string").alias("date_min_gran"),
                      F.create_map().cast("map<string,string>").alias("value_mapping")))
    fk_rows = [(db_id, i, a, b, schema, c, d) for i, (a, b, c, d) in enumerate(foreign_keys or [])]
    fks = spark.createDataFrame(fk_rows, FKS_SCHEMA)
    return cat_tables, fields, fks


# --- fixed values: identifier quoting per dialect ---
QUOTES = {"mysql": ("`", "`"), "sqlite": ("`", "`"), "postgresql": ('"', '"'), "mssql": ("[", "]")}
# --- end of fixed values ---


def quote_table(name, dialect: str, schema: str | None = None) -> F.Column:
    """P19 for tables: backtick (MySQL/SQLite), double quote with optional
    schema (PostgreSQL), brackets (MSSQL)."""
    if dialect not in QUOTES:
        raise NotImplementedError(dialect)
    lq, rq = QUOTES[dialect]
    c = F.col(name) if isinstance(name, str) else name
    q = F.concat(F.lit(lq), c, F.lit(rq))
    if dialect == "postgresql" and schema:
        q = F.concat(F.lit(f'"{schema}".'), q)
    return q


def quote_field(name, dialect: str) -> F.Column:
    """P19 for fields; MSSQL field quoting is not defined."""
    if dialect not in ("mysql", "sqlite", "postgresql"):
        raise NotImplementedError(dialect)
    lq, rq = QUOTES[dialect]
    c = F.col(name) if isinstance(name, str) else name
    return F.concat(F.lit(lq), c, F.lit(rq))


def spark_quote(name: str) -> str:
    """Backtick quoting for Spark SQL, doubling embedded backticks."""
    return "`" + name.replace("`", "``") + "`"


# --- P20: catalog access ---------------------------------------------------

def has_table(cat_tables: DataFrame, table: str) -> DataFrame:
    return cat_tables.where(F.col("table_name") == table).select("db").distinct()


def has_field(cat_fields: DataFrame, table: str, field: str) -> DataFrame:
    """The databases whose ``table`` has ``field``."""
    return field_info(cat_fields, table, field).select("db").distinct()


def field_info(cat_fields: DataFrame, table: str, field: str) -> DataFrame:
    """The catalog row of one field (one per database that has it)."""
    return cat_fields.where((F.col("table_name") == table) & (F.col("field_name") == field))


def table_info(cat_tables: DataFrame, cat_fields: DataFrame, table: str) -> DataFrame:
    """One row per database: the table's comment and its fields' names in order."""
    names = cat_fields.where(F.col("table_name") == table).groupBy("db").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("field_ord", "field_name"))), lambda x: x["field_name"]).alias("fields"))
    return cat_tables.where(F.col("table_name") == table).join(names, "db", "left")


def fields_by(cat_fields: DataFrame, category: str | None = None,
              role: str | None = None) -> DataFrame:
    from quarry.functions.types import FIELD_CATEGORIES, ROLES
    out = cat_fields
    if category is not None:
        assert category in FIELD_CATEGORIES, category
        out = out.where(F.col("category") == category)
    if role is not None:
        assert role in ROLES, role
        out = out.where(F.col("dim_or_meas") == role)
    return out


def set_field_property(cat_fields: DataFrame, updates: DataFrame, prop: str) -> DataFrame:
    """Set ``prop`` from ``updates(table_name, field_name, value)``; rows naming
    an absent field change nothing (left join + coalesce)."""
    u = updates.select("table_name", "field_name", F.col("value").alias("_new"))
    return (cat_fields.join(u, ["table_name", "field_name"], "left")
            .withColumn(prop, F.coalesce(F.col("_new").cast(cat_fields.schema[prop].dataType),
                                         F.col(prop)))
            .drop("_new"))


# --- P17: key discovery ------------------------------------------------------

def discover_keys(prof: DataFrame) -> DataFrame:
    """Single-column unique keys from a profile: every row non-null and all
    values distinct.  Needs ``n_rows`` per table: ``n_count`` equals the row
    count exactly when the column holds no NULL."""
    return prof.select("table_name", "field_name", "field_ord", "type_name",
                       ((F.col("n_count") == F.col("n_rows")) &
                        (F.col("n_distinct") == F.col("n_count")) &
                        (F.col("n_count") > 0)).alias("is_unique"))


def discover_fks(tables: dict[str, DataFrame]) -> DataFrame:
    """P17 FK discovery: ``child -> parent`` when the parent column is unique
    (non-null, all distinct), both have the same key-like type, and every
    distinct non-null child value occurs in the parent.

    One shuffle of values (``keys.common_values``); long texts travel as digests."""
    spark = next(iter(tables.values())).sparkSession
    cols = [(t, f.name, sql_type_name(f.dataType)) for t, df in tables.items() for f in df.schema.fields
            if sql_type_name(f.dataType) in KEY_TYPES]
    if not cols:
        return spark.createDataFrame([], "table_name string, field_name string, ref_table string, ref_field string")

    def keys(c, ty):
        x = F.col("`" + c.replace("`", "``") + "`")
        if ty == "TEXT":
            return F.lit(None), F.when(F.length(x) > 32, F.concat(F.lit("\u0001"), F.md5(x))).otherwise(x)
        return x, F.lit(None)

    common, sizes = common_values(tables, [(t, *keys(c, ty)) for t, c, ty in cols])
    names = spark.createDataFrame([(i, t, c, ty) for i, (t, c, ty) in enumerate(cols)],
                                  "col int, table_name string, field_name string, type_name string")
    # from here on everything is schema-sized
    own = common.where("child = parent").select(F.col("child").alias("col"), F.col("common").alias("n_distinct"))
    known = names.join(sizes, "col").join(own, "col")
    child = known.select(F.col("col").alias("child"), "table_name", "field_name", F.col("type_name").alias("ct"), "n_distinct")
    parent = known.where("n_count = n_rows AND n_distinct = n_count").select(
        F.col("col").alias("parent"), F.col("table_name").alias("ref_table"), F.col("field_name").alias("ref_field"),
        F.col("type_name").alias("pt"))
    return (common.where("child <> parent").join(child, "child").join(parent, "parent")
            .where("ct = pt AND common = n_distinct").select("table_name", "field_name", "ref_table", "ref_field"))


COMMENT_MODES = ["origin", "no_comment", "generation", "merge"]


def apply_comment_mode(cat_tables: DataFrame, cat_fields: DataFrame, mode: str,
                       descriptions: DataFrame | None = None):
    """``origin`` keeps comments; ``no_comment`` erases them all;
    ``generation`` erases then fills from ``descriptions``; ``merge`` fills
    only empty field comments and table comments shorter than 10 characters.

    ``descriptions(table_name, field_name, description)`` holds the generated
    texts (``field_name`` NULL for a table); they are tidied (P21)."""
    from quarry.operators.responses import tidy_description
    if mode not in COMMENT_MODES:
        raise NotImplementedError(f"comment mode must be one of {COMMENT_MODES}, not {mode!r}")
    if mode == "origin":
        return cat_tables, cat_fields
    if mode in ("no_comment", "generation"):
        cat_tables = cat_tables.withColumn("comment", F.lit(""))
        cat_fields = cat_fields.withColumn("comment", F.lit(""))
    if mode == "no_comment" or descriptions is None:
        return cat_tables, cat_fields
    d = descriptions.select("table_name", "field_name", tidy_description(F.col("description")).alias("_d"))
    fd = d.where(F.col("field_name").isNotNull())
    td = d.where(F.col("field_name").isNull()).select("table_name", F.col("_d").alias("_td"))
    fields = (cat_fields.join(fd, ["table_name", "field_name"], "left")
              .withColumn("comment", F.when(F.length(F.coalesce("comment", F.lit(""))) == 0,
                                            F.coalesce("_d", F.col("comment"))).otherwise(F.col("comment")))
              .drop("_d"))
    tables = (cat_tables.join(td, "table_name", "left")
              .withColumn("comment", F.when(F.length(F.coalesce("comment", F.lit(""))) < 10,
                                            F.coalesce("_td", F.col("comment"))).otherwise(F.col("comment")))
              .drop("_td"))
    return tables, fields
