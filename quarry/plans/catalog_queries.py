"""Profiling, catalog and M-Schema queries (P*, M1-M2) with their oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.catalog import build_catalog
from quarry.operators.mschema import to_mschema
from quarry.operators.profile import profile
from quarry.sources.tables import TABLE_NAMES, load, load_many

QUERIES: dict = {}
ORACLES: dict = {}


def register(name):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def _r6(c):
    return F.round(F.col(c), 6).alias(c)


@register("profile_numeric")
def profile_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profile({"lineitem": load(spark, sf_dir, "lineitem")})
    return p.select("table_name", "field_name", "field_ord", "type_name", "type_cate", "n_count",
                    "n_distinct", _r6("max_value"), _r6("min_value"),
                    # float sums differ in the last bits between engines
                    F.round("avg_value", 4).alias("avg_value"),
                    "max_len", "min_len")


@register("profile_lengths")
def profile_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profile({"customer": load(spark, sf_dir, "customer")}, n_examples=0)
    return p.select("table_name", "field_name", "n_count", "max_len", "min_len")


@register("value_examples")
def value_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = profile({"orders": load(spark, sf_dir, "orders")}, n_examples=5)
    return p.select("table_name", "field_name", F.array_join("examples", ", ").alias("examples"))


@register("type_category")
def type_category_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quarry.functions.types import sql_type_name, type_category
    rows = []
    for t in TABLE_NAMES:
        for i, f in enumerate(load(spark, sf_dir, t).schema.fields):
            n = sql_type_name(f.dataType)
            rows.append((t, f.name, i, n, type_category(n)))
    return spark.createDataFrame(
        rows, "table_name string, field_name string, field_ord int, type_name string, type_cate string")


TPCH_KEYS = {
    "region": ["r_regionkey"], "nation": ["n_nationkey"], "customer": ["c_custkey"],
    "supplier": ["s_suppkey"], "part": ["p_partkey"], "orders": ["o_orderkey"],
}
TPCH_FKS = [("nation", "n_regionkey", "region", "r_regionkey"),
            ("customer", "c_nationkey", "nation", "n_nationkey"),
            ("supplier", "s_nationkey", "nation", "n_nationkey"),
            ("orders", "o_custkey", "customer", "c_custkey"),
            ("lineitem", "l_orderkey", "orders", "o_orderkey"),
            ("lineitem", "l_partkey", "part", "p_partkey"),
            ("lineitem", "l_suppkey", "supplier", "s_suppkey")]


@register("mschema_text")
def mschema_text(spark: SparkSession, sf_dir: str, names=("region", "nation")) -> DataFrame:
    tables = load_many(spark, sf_dir, names)
    ct, cf, ck = build_catalog(spark, "tpch", tables, primary_keys=TPCH_KEYS,
                               foreign_keys=[fk for fk in TPCH_FKS
                                             if fk[0] in tables and fk[2] in tables])
    return to_mschema(ct, cf, ck).select(F.col("db").alias("db_id"), "mschema")


# ---------------------------------------------------------------- oracles --
# Column lists of the driver's tables (FIXTURES.md part B), for generating
# per-column oracle SQL.
COLS = {
    "customer": [("c_custkey", "BIGINT"), ("c_name", "TEXT"), ("c_nationkey", "INTEGER"),
                 ("c_acctbal", "DOUBLE"), ("c_mktsegment", "TEXT")],
    "orders": [("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "TEXT"),
               ("o_totalprice", "DOUBLE"), ("o_orderdate", "TIMESTAMP"),
               ("o_orderpriority", "TEXT")],
    "lineitem": [("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"),
                 ("l_linenumber", "INTEGER"), ("l_quantity", "DOUBLE"),
                 ("l_extendedprice", "DOUBLE"), ("l_discount", "DOUBLE"), ("l_tax", "DOUBLE"),
                 ("l_returnflag", "TEXT"), ("l_linestatus", "TEXT"), ("l_shipdate", "TIMESTAMP")],
    "region": [("r_regionkey", "INTEGER"), ("r_name", "TEXT")],
    "supplier": [("s_suppkey", "BIGINT"), ("s_name", "TEXT"), ("s_nationkey", "INTEGER"), ("s_acctbal", "DOUBLE")],
    "part": [("p_partkey", "BIGINT"), ("p_name", "TEXT"), ("p_brand", "TEXT"), ("p_type", "TEXT"),
             ("p_size", "INTEGER"), ("p_retailprice", "DOUBLE")],
    "nation": [("n_nationkey", "INTEGER"), ("n_name", "TEXT"), ("n_regionkey", "INTEGER")],
    "events": [("event_id", "BIGINT"), ("ts", "TIMESTAMP"), ("user_id", "BIGINT"), ("event_type", "TEXT"),
               ("value", "DOUBLE"), ("props", "TEXT")],
    "documents": [("doc_id", "BIGINT"), ("text", "TEXT"), ("lang", "TEXT"), ("source", "TEXT"), ("n_chars", "BIGINT")],
    # profiles leave arrays out: embeddings.embedding
    "embeddings": [("vec_id", "BIGINT"), ("label", "INTEGER")],
    "pages": [("page_id", "BIGINT"), ("url", "TEXT"), ("html", "TEXT")],
    "benchmark": [("item_id", "BIGINT"), ("text", "TEXT")],
    "labels": [("doc_id", "BIGINT"), ("quality", "INTEGER"), ("toxic", "INTEGER")],
    "conversations": [("conv_id", "BIGINT"), ("turn", "BIGINT"), ("role", "TEXT"), ("text", "TEXT")],
}
NUMERIC = {"BIGINT", "INTEGER", "DOUBLE"}
CATE = {"BIGINT": "Number", "INTEGER": "Number", "DOUBLE": "Number", "TEXT": "String",
        "TIMESTAMP": "DateTime"}


def _profile_sql(table):
    parts = []
    for i, (c, ty) in enumerate(COLS[table]):
        num = ty in NUMERIC
        agg = ([f"round(max({c})::DOUBLE, 6)", f"round(min({c})::DOUBLE, 6)", f"round(avg({c})::DOUBLE, 4)"]
               if num else ["NULL::DOUBLE"] * 3)
        parts.append(
            f"SELECT '{table}' AS table_name, '{c}' AS field_name, {i} AS field_ord, '{ty}' AS type_name, "
            f"'{CATE[ty]}' AS type_cate, count({c}) AS n_count, count(DISTINCT {c}) AS n_distinct, "
            f"{agg[0]} AS max_value, {agg[1]} AS min_value, {agg[2]} AS avg_value, "
            f"coalesce(max(length(cast({c} AS VARCHAR))), -1)::BIGINT AS max_len, "
            f"coalesce(min(length(cast({c} AS VARCHAR))), -1)::BIGINT AS min_len FROM {table}")
    return "\nUNION ALL\n".join(parts)


ORACLES["profile_numeric"] = _profile_sql("lineitem")
ORACLES["profile_lengths"] = (
    "SELECT table_name, field_name, n_count, max_len, min_len FROM (\n"
    + _profile_sql("customer") + "\n)")


def _examples_sql(table, c, ty, n):
    key = f"{c}::DOUBLE" if ty in NUMERIC else "NULL::DOUBLE"
    inner = (f"SELECT DISTINCT {key} AS k, cast({c} AS VARCHAR) AS v FROM {table} "
             f"WHERE {c} IS NOT NULL ORDER BY k NULLS LAST, v LIMIT {n}")
    if ty == "TIMESTAMP":
        inner = f"SELECT * FROM ({inner}) ORDER BY k NULLS LAST, v LIMIT 1"
    hide = (r"bool_or(regexp_matches(v, '^[\w\.-]+@[\w\.-]+\.\w+$') OR v LIKE '%http://%' "
            r"OR v LIKE '%https://%')")
    return (f"(SELECT CASE WHEN {hide} THEN '' ELSE coalesce(string_agg(v, ', ' ORDER BY k NULLS LAST, v) "
            f"FILTER (WHERE length(v) > 0), '') END FROM ({inner}))")


ORACLES["value_examples"] = "\nUNION ALL\n".join(
    f"SELECT 'orders' AS table_name, '{c}' AS field_name, {_examples_sql('orders', c, ty, 5)} AS examples"
    for c, ty in COLS["orders"])

ORACLES["type_category"] = """
SELECT table_name, column_name AS field_name, CAST(ordinal_position - 1 AS INTEGER) AS field_ord,
 CASE WHEN data_type = 'VARCHAR' THEN 'TEXT' WHEN data_type LIKE '%[]' THEN 'ARRAY'
      ELSE data_type END AS type_name,
 CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'FLOAT', 'SMALLINT', 'TINYINT') THEN 'Number'
      WHEN data_type = 'VARCHAR' THEN 'String'
      WHEN data_type IN ('TIMESTAMP', 'DATE') THEN 'DateTime'
      WHEN data_type = 'BOOLEAN' THEN 'Bool' ELSE 'Other' END AS type_cate
FROM information_schema.columns
WHERE table_name IN ('region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem',
 'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels', 'conversations')
"""


def _mschema_sql(tables, pks, fks):
    fields = []
    for t_ord, t in enumerate(tables):
        for f_ord, (c, ty) in enumerate(COLS[t]):
            pk = "true" if c in pks.get(t, []) else "false"
            fields.append(f"SELECT {t_ord} AS t_ord, '{t}' AS t, {f_ord} AS f_ord, '{c}' AS f, "
                          f"'{ty}' AS ty, {pk} AS pk, {_examples_sql(t, c, ty, 3)} AS ex")
    fk_lines = [f"{a}.{b}={c}.{d}" for a, b, c, d in fks if a in tables and c in tables]
    fk_txt = ("|| chr(10) || '【Foreign keys】' || chr(10) || '" + "' || chr(10) || '".join(fk_lines)
              + "'") if fk_lines else ""
    return f"""
WITH f AS (
{chr(10).join(('UNION ALL ' if i else '') + s for i, s in enumerate(fields))}
), l AS (
 SELECT t_ord, t, f_ord, '(' || f || ':' || ty || CASE WHEN pk THEN ', Primary Key' ELSE '' END
   || CASE WHEN ex <> '' THEN ', Examples: [' || ex || ']' ELSE '' END || ')' AS line FROM f
), tt AS (
 SELECT t_ord, '# Table: ' || t || chr(10) || '[' || chr(10)
   || string_agg(line, ',' || chr(10) ORDER BY f_ord) || chr(10) || ']' AS table_text
 FROM l GROUP BY t_ord, t
)
SELECT 'tpch' AS db_id, '【DB_ID】 tpch' || chr(10) || '【Schema】' || chr(10)
  || string_agg(table_text, chr(10) ORDER BY t_ord) {fk_txt} AS mschema
FROM tt
"""


ORACLES["mschema_text"] = _mschema_sql(["region", "nation"], TPCH_KEYS, TPCH_FKS)


# ------------------------------------------------------------- step 2 --
from quarry.operators import catalog as CAT  # noqa: E402
from quarry.operators import profile as PRO  # noqa: E402
from quarry.session import scratch_path  # noqa: E402

TPCH = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]


@register("value_exists")
def value_exists_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    probes = (c.select(F.lit("orders").alias("table_name"), F.lit("o_custkey").alias("field_name"),
                       F.col("c_custkey").cast("string").alias("value"))
              .unionByName(c.select(F.lit("orders").alias("table_name"), F.lit("o_orderpriority").alias("field_name"),
                                    F.col("c_mktsegment").alias("value")).distinct()))
    return PRO.value_exists({"orders": load(spark, sf_dir, "orders")}, probes)


ORACLES["value_exists"] = """
SELECT 'orders' AS table_name, 'o_custkey' AS field_name, cast(c_custkey AS VARCHAR) AS value,
 EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey) AS "exists" FROM customer
UNION ALL
SELECT 'orders', 'o_orderpriority', m, EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = m)
FROM (SELECT DISTINCT c_mktsegment AS m FROM customer)"""


@register("row_preview_md")
def row_preview_md_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = None
    for t in ("part", "supplier", "orders"):
        m = PRO.preview_markdown(load(spark, sf_dir, t), 5, 30).select(F.lit(t).alias("table_name"), "markdown")
        out = m if out is None else out.unionByName(m)
    return out


def _trunc_sql(c):
    head = f"substr({c}, 1, 27)"
    return (f"CASE WHEN length({c}) <= 30 THEN {c} ELSE (CASE WHEN contains({head}, ' ') THEN "
            f"substr({head}, 1, length({head}) - length(split_part({head}, ' ', -1)) - 1) ELSE {head} END) || '...' END")


def _preview_sql(t):
    cols = [c for c, _ in COLS[t]]
    cells = [(_trunc_sql(c) if ty == "TEXT" else f"cast({c} AS VARCHAR)") for c, ty in COLS[t]]
    line = "'| ' || " + " || ' | ' || ".join(f"coalesce({x}, 'None')" for x in cells) + " || ' |'"
    order = ", ".join(f"{c} NULLS FIRST" for c in cols)
    head = "| " + " | ".join(cols) + " |"
    sep = "| " + " | ".join(["---"] * len(cols)) + " |"
    return (f"SELECT '{t}' AS table_name, coalesce('{head}' || chr(10) || '{sep}' || chr(10) || "
            f"string_agg(line, chr(10) ORDER BY rn), '') AS markdown FROM (SELECT {line} AS line, "
            f"row_number() OVER (ORDER BY {order}) AS rn FROM (SELECT DISTINCT * FROM {t}) ORDER BY {order} LIMIT 5)")


ORACLES["row_preview_md"] = "\nUNION ALL\n".join(_preview_sql(t) for t in ("part", "supplier", "orders"))


@register("field_profile")
def field_profile_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = load_many(spark, sf_dir, ["region", "nation"])
    prof = profile(tables, n_examples=10)
    ct, cf, ck = build_catalog(spark, "tpch", tables, primary_keys=TPCH_KEYS)
    return PRO.field_profile_text(prof, cf.drop("examples")).select("table_name", "field_name", "profile_text")


def _profile_block_sql(t):
    parts = []
    for i, (c, ty) in enumerate(COLS[t]):
        pk = "True" if c in TPCH_KEYS.get(t, []) else "False"
        num = ty in NUMERIC
        ex = (f"(SELECT string_agg(v, ', ' ORDER BY k NULLS LAST, v) FROM (SELECT DISTINCT "
              f"{c + '::DOUBLE' if num else 'NULL::DOUBLE'} AS k, cast({c} AS VARCHAR) AS v FROM {t} "
              f"WHERE {c} IS NOT NULL ORDER BY k NULLS LAST, v LIMIT 10))")
        stats = ""
        if num:
            stats = (f" || chr(10) || 'MAX: ' || cast(max({c}) AS VARCHAR) || chr(10) || 'MIN: ' || "
                     f"cast(min({c}) AS VARCHAR) || chr(10) || 'AVG: ' || cast(avg({c})::DOUBLE AS VARCHAR)")
        parts.append(
            f"SELECT '{t}' AS table_name, '{c}' AS field_name, '[Field]' || chr(10) || 'Name: {c}' || chr(10) || "
            f"'Type: {ty}' || chr(10) || 'Primary key (alone or with other fields): {pk}' || chr(10) || "
            f"'UNIQUE: {pk}' || chr(10) || 'NULLABLE: ' || (SELECT CASE WHEN is_nullable = 'YES' THEN 'True' ELSE "
            f"'False' END FROM information_schema.columns WHERE table_name = '{t}' AND column_name = '{c}') "
            f"|| chr(10) || 'COUNT: ' || count({c}) || chr(10) || 'COUNT(DISTINCT): ' || "
            f"count(DISTINCT {c}){stats} || chr(10) || 'MAX(CHAR_LENGTH): ' || max(length(cast({c} AS VARCHAR))) "
            f"|| chr(10) || 'MIN(CHAR_LENGTH): ' || min(length(cast({c} AS VARCHAR))) || chr(10) || "
            f"'Value Examples: [' || {ex} || ']' AS profile_text FROM {t}")
    return "\nUNION ALL\n".join(parts)


ORACLES["field_profile"] = _profile_block_sql("region") + "\nUNION ALL\n" + _profile_block_sql("nation")


@register("enum_values")
def enum_values_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = PRO.enum_values(load_many(spark, sf_dir, ENUM_TABLES))
    return e.select("table_name", "field_name", F.col("n_values").cast("long").alias("n_values"),
                    F.array_join("values", ", ").alias("values"))


ENUM_TABLES = ["orders", "customer", "part", "lineitem"]


def _enum_sql(t, c, ty):
    """The Enum rule of P13 for text and integers: repeating, at most 50 values."""
    if ty not in ("TEXT", "INTEGER", "BIGINT") or c.endswith("key"):
        return None
    k = f"{c}::DOUBLE" if ty != "TEXT" else "NULL::DOUBLE"
    year = "" if ty == "TEXT" else f" AND NOT (min({c}) >= 1000 AND max({c}) <= 2999)"
    return (f"SELECT '{t}' AS table_name, '{c}' AS field_name, count(DISTINCT {c}) AS n_values, "
            f"(SELECT string_agg(v, ', ' ORDER BY k NULLS LAST, v) FROM (SELECT DISTINCT {k} AS k, cast({c} AS VARCHAR) AS v "
            f"FROM {t} WHERE {c} IS NOT NULL)) AS \"values\" FROM {t} "
            f"HAVING count(DISTINCT {c}) <= 50 AND count(DISTINCT {c}) * 2 <= count({c}){year}")


ORACLES["enum_values"] = "\nUNION ALL\n".join(
    q for t in ENUM_TABLES for c, ty in COLS[t] if (q := _enum_sql(t, c, ty)))


@register("profile_big_ids")
def profile_big_ids_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P7 and P6 beyond 2^53, where doubles merge neighbours: exact extremes,
    exact sum, and a probe for a value and for its absent neighbour."""
    ids = load(spark, sf_dir, "orders").select(
        (F.col("o_orderkey") * 2 + F.lit(2 ** 53)).alias("id"), (F.col("o_totalprice").cast("decimal(20,2)")).alias("price"))
    prof = profile({"big": ids}, n_examples=0).select("field_name", "max_text", "min_text", "sum_text")
    top = ids.agg(F.max("id").alias("m")).select(F.explode(F.array("m", F.col("m") + 1)).alias("v"))
    probes = top.select(F.lit("big").alias("table_name"), F.lit("id").alias("field_name"), F.col("v").cast("string").alias("value"))
    found = PRO.value_exists({"big": ids}, probes)
    return prof.select("field_name", "max_text", "min_text", "sum_text", F.lit(None).cast("boolean").alias("found")).union(
        found.select(F.lit("probe"), "value", F.lit(None).cast("string"), F.lit(None).cast("string"), "exists"))


ORACLES["profile_big_ids"] = """
WITH b AS (SELECT o_orderkey * 2 + 9007199254740992 AS id, cast(o_totalprice AS DECIMAL(20,2)) AS price FROM orders)
SELECT 'id' AS field_name, cast(max(id) AS VARCHAR) AS max_text, cast(min(id) AS VARCHAR) AS min_text,
 cast(sum(id) AS VARCHAR) AS sum_text, NULL::BOOLEAN AS found FROM b
UNION ALL SELECT 'price', cast(max(price) AS VARCHAR), cast(min(price) AS VARCHAR), cast(sum(price) AS VARCHAR), NULL FROM b
UNION ALL SELECT 'probe', cast(max(id) AS VARCHAR), NULL, NULL, true FROM b
UNION ALL SELECT 'probe', cast(max(id) + 1 AS VARCHAR), NULL, NULL, false FROM b"""


@register("text_lengths")
def text_lengths_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P8 in full: longest, shortest, mean and total length of text fields."""
    out = None
    for t in ("documents", "customer", "part"):
        x = PRO.text_lengths(t, load(spark, sf_dir, t))
        out = x if out is None else out.union(x)
    return out.withColumn("avg_len", F.round("avg_len", 6))


ORACLES["text_lengths"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS field_name, max(length({c})) AS max_len, min(length({c})) AS min_len, "
    f"round(avg(length({c})), 6) AS avg_len, cast(sum(length({c})) AS BIGINT) AS sum_len FROM {t}"
    for t, cs in (("documents", ("text", "lang", "source")), ("customer", ("c_name", "c_mktsegment")),
                  ("part", ("p_name", "p_brand", "p_type"))) for c in cs)


@register("key_discovery")
def key_discovery_q(spark: SparkSession, sf_dir: str, names=tuple(TPCH)) -> DataFrame:
    prof = profile(load_many(spark, sf_dir, names), n_examples=0)
    return CAT.discover_keys(prof).select("table_name", "field_name", "is_unique")


def _key_sql(names):
    return "\nUNION ALL\n".join(
        f"SELECT '{t}' AS table_name, '{c}' AS field_name, count({c}) = count(*) AND count(DISTINCT {c}) = count(*) "
        f"AND count(*) > 0 AS is_unique FROM {t}" for t in names for c, _ in COLS[t])


ORACLES["key_discovery"] = _key_sql(TPCH)


@register("fk_discovery")
def fk_discovery_q(spark: SparkSession, sf_dir: str, names=tuple(TPCH)) -> DataFrame:
    return CAT.discover_fks(load_many(spark, sf_dir, names))


def _fk_sql(names=tuple(TPCH)):
    key_types = {"INTEGER", "BIGINT", "TEXT"}
    cols = [(t, c, ty) for t in names for c, ty in COLS[t] if ty in key_types]
    parts = []
    for pt, pc, pty in cols:
        for ct, cc, cty in cols:
            if cty != pty or (ct, cc) == (pt, pc):
                continue
            parts.append(
                f"SELECT '{ct}' AS table_name, '{cc}' AS field_name, '{pt}' AS ref_table, '{pc}' AS ref_field "
                f"WHERE (SELECT count({pc}) = count(*) AND count(DISTINCT {pc}) = count(*) AND count(*) > 0 FROM {pt}) "
                f"AND (SELECT count({cc}) > 0 FROM {ct}) "
                f"AND NOT EXISTS (SELECT 1 FROM {ct} WHERE {cc} IS NOT NULL AND {cc} NOT IN (SELECT {pc} FROM {pt}))")
    return "\nUNION ALL\n".join(parts)


ORACLES["fk_discovery"] = _fk_sql()


@register("map_file")
def map_file_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S6 + S7: write ``brand \\t type、type…`` lines, read them back as a
    synonym map (``values`` ends with the key)."""
    from quarry.sources.files import read_map_file, save_lines
    p = load(spark, sf_dir, "part")
    lines = p.groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), "、").alias("ts"))
    path = scratch_path(spark, "map_file")
    save_lines(lines.select(F.concat("p_brand", F.lit("\t"), "ts").alias("line")), "line", path)
    m = read_map_file(spark, path)
    return m.select(F.col("key").alias("brand"), F.array_join("values", "、").alias("values"))


ORACLES["map_file"] = """SELECT p_brand AS brand, string_agg(DISTINCT p_type, '、' ORDER BY p_type) || '、' || p_brand AS "values"
FROM part GROUP BY p_brand"""


@register("mschema_dump_roundtrip")
def mschema_dump_roundtrip_q(spark: SparkSession, sf_dir: str, names=("region", "nation")) -> DataFrame:
    """Catalog -> nested JSON file -> catalog -> M-Schema text."""
    from quarry.sources.files import MSCHEMA_DUMP, dump_mschema, load_mschema
    tables = load_many(spark, sf_dir, names)
    ct, cf, ck = build_catalog(spark, "tpch", tables, primary_keys=TPCH_KEYS,
                               foreign_keys=[fk for fk in TPCH_FKS if fk[0] in tables and fk[2] in tables])
    path = scratch_path(spark, "mschema_dump")
    dump_mschema(ct, cf, ck).write.json(path)
    lt, lf, lk = load_mschema(spark.read.schema(MSCHEMA_DUMP).json(path))
    return to_mschema(lt, lf, lk).select(F.col("db").alias("db_id"), "mschema")


ORACLES["mschema_dump_roundtrip"] = ORACLES["mschema_text"]


# ------------------------------------------------ selected columns (M3/M4) --
from quarry.operators.mschema import to_mschema_with_selected  # noqa: E402
from quarry.plans.fixtures import F1_SQL, samples  # noqa: E402

SEL_TABLES = ["orders", "customer"]
SEL_EXTRA = ["customer.c_name", "customer.c_custkey"]


@register("mschema_selected")
def mschema_selected_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 + M4 per F1 record: the columns its SQL names plus the customer's
    key and name, with the customer id from the SQL as a selected value."""
    tables = load_many(spark, sf_dir, SEL_TABLES)
    ct, cf, ck = build_catalog(spark, "tpch", tables, primary_keys=TPCH_KEYS,
                               foreign_keys=[fk for fk in TPCH_FKS if fk[0] in tables and fk[2] in tables])
    names = [f"{t}.{c}" for t in SEL_TABLES for c in tables[t].columns]
    f1 = samples(spark, sf_dir)
    named = F.filter(F.array(*[F.lit(n) for n in names]),
                     lambda n: F.regexp_like(F.col("sql"), F.concat(F.lit("(?i)\\b"),
                                                                   F.substring_index(n, ".", -1), F.lit("\\b"))))
    req = f1.select(F.col("idx").alias("req_id"), F.lit("tpch").alias("db"),
                    F.concat(named, F.array(*[F.lit(x) for x in SEL_EXTRA])).alias("selected_cols"),
                    F.create_map(F.lit("orders.o_custkey"), F.array(F.regexp_extract("sql", r"= (\d+)$", 1)))
                    .alias("selected_values"))
    return to_mschema_with_selected(ct, cf, ck, req).select(F.col("req_id").alias("idx"), "mschema")


def _sel_oracle():
    cust_ex = _examples_sql("customer", "c_custkey", "BIGINT", 3)
    name_ex = _examples_sql("customer", "c_name", "TEXT", 3)
    ord_ex = f"string_split({_examples_sql('orders', 'o_custkey', 'BIGINT', 3)}, ', ')"
    return f"""
WITH f1 AS ({F1_SQL}),
r AS (SELECT idx, regexp_extract(sql, '= (\\d+)$', 1) AS v FROM f1),
o AS (SELECT idx, '# Table: orders' || chr(10) || '[' || chr(10) || '(o_custkey:BIGINT, Examples: ['
   || array_to_string(list_concat([v], list_filter({ord_ex}, lambda x: x <> v)), ', ') || '])' || chr(10) || ']' AS t
   FROM r),
c AS (SELECT '# Table: customer' || chr(10) || '[' || chr(10) || '(c_custkey:BIGINT, Primary Key, Examples: ['
   || {cust_ex} || ']),' || chr(10) || '(c_name:TEXT, Examples: [' || {name_ex} || '])' || chr(10) || ']' AS t)
SELECT o.idx, '【DB_ID】 tpch' || chr(10) || '【Schema】' || chr(10)
  || CASE WHEN length(o.t) <= length(c.t) THEN o.t || chr(10) || c.t ELSE c.t || chr(10) || o.t END
  || chr(10) || '【Foreign keys】' || chr(10) || 'orders.o_custkey=customer.c_custkey' AS mschema
FROM o, c"""


ORACLES["mschema_selected"] = _sel_oracle()
