"""M-Schema text: render (M1-M4), parse (M5), re-render (M6), FK filter (M7).

Rendering is two ordered aggregations over the catalog: field lines per table,
then tables and foreign keys per database.  Both groups are schema-sized (one
database's columns), never data-sized.  Parsing turns each schema text into
long rows with ``regexp_extract_all`` + ``posexplode``, so no Python runs per
record.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.session import scratch_path
from quarry.functions.types import SHORT_DATE_TYPES

# --- fixed values: M-Schema text markers ---
DB_HEAD = "【DB_ID】"
SCHEMA_HEAD = "【Schema】"
FK_HEAD = "【Foreign keys】"
TABLE_HEAD = "# Table: "
VALUE_MAP_JOIN = "表示"
# --- end of fixed values ---


def _sorted_join(pairs: Column, sep: str) -> Column:
    """Join the ``txt`` of ``array<struct<ord, txt>>`` in ``ord`` order."""
    return F.array_join(F.transform(F.array_sort(pairs), lambda x: x["txt"]), sep)


def example_list(examples: Column, type_abbr_upper: Column, example_num: int = 3,
                 max_len: int = 30, total_len: int = 100) -> Column:
    """Examples shown on a field line: first ``example_num``; date types keep
    one; if any is longer than ``max_len`` keep the short ones, and if those
    still total more than ``total_len`` characters keep only the first."""
    ex = F.slice(F.filter(examples, lambda x: x.isNotNull()), 1, example_num)
    longest = F.aggregate(ex, F.lit(0), lambda acc, x: F.greatest(acc, F.length(x)))
    short = F.filter(ex, lambda x: F.length(x) <= max_len)
    short_total = F.aggregate(short, F.lit(0), lambda acc, x: acc + F.length(x))
    return (F.when(type_abbr_upper.isin(SHORT_DATE_TYPES), F.slice(ex, 1, 1))
            .when((F.size(ex) > 0) & (longest > max_len),
                  F.when(short_total > total_len, F.slice(short, 1, 1)).otherwise(short))
            .otherwise(ex))


def field_lines(cat_fields: DataFrame, example_num: int = 3, max_len: int = 30,
                show_type_detail: bool = False) -> DataFrame:
    """M1 line per field: ``(name:TYPE[, comment][, k表示v,...][, Primary Key]
    [, Examples: [a, b, c]])``."""
    t = F.upper(F.col("type")) if show_type_detail else F.upper(F.substring_index("type", "(", 1))
    abbr = F.upper(F.substring_index("type", "(", 1))
    comment = F.coalesce(F.col("comment"), F.lit(""))
    vm = F.coalesce(F.col("value_mapping"), F.create_map().cast("map<string,string>"))
    vm_txt = F.array_join(F.transform(F.map_entries(vm), lambda e: F.concat(
        e["key"], F.lit(VALUE_MAP_JOIN), e["value"])), ",")
    ex = example_list(F.coalesce("examples", F.array().cast("array<string>")), abbr,
                      example_num, max_len) if example_num > 0 else F.array().cast("array<string>")
    line = F.concat(
        F.lit("("), F.col("field_name"), F.lit(":"), t,
        F.when(comment != "", F.concat(F.lit(", "), F.trim(comment))).otherwise(F.lit("")),
        F.when(F.size(vm) > 0, F.concat(F.lit(", "), vm_txt)).otherwise(F.lit("")),
        F.when(F.coalesce("primary_key", F.lit(False)), F.lit(", Primary Key")).otherwise(F.lit("")),
        F.when(F.size(ex) > 0, F.concat(F.lit(", Examples: ["), F.array_join(ex, ", "), F.lit("]")))
        .otherwise(F.lit("")),
        F.lit(")"))
    return cat_fields.select("db", "table_name", "field_name", "field_ord", line.alias("line"))


def table_texts(cat_tables: DataFrame, lines: DataFrame) -> DataFrame:
    """M1 per table: header, ``[``, field lines joined by ``,\\n``, ``]``."""
    per_table = (lines.groupBy("db", "table_name")
                 .agg(_sorted_join(F.collect_list(F.struct(
                     F.col("field_ord").alias("ord"), F.col("line").alias("txt"))), ",\n")
                      .alias("body")))
    comment = F.coalesce(F.col("comment"), F.lit(""))
    has_comment = (comment != "") & (comment != "None")
    qual = F.when(F.coalesce(F.length("schema"), F.lit(0)) > 0,
                  F.concat(F.col("schema"), F.lit("."), F.col("table_name"))).otherwise(F.col("table_name"))
    header = F.concat(F.lit(TABLE_HEAD), qual,
                      F.when(has_comment, F.concat(F.lit(", "), comment)).otherwise(F.lit("")))
    return (cat_tables.join(per_table, ["db", "table_name"], "left")
            .select("db", "schema", "table_name", "table_ord", "table_type",
                    F.concat(header, F.lit("\n[\n"), F.coalesce("body", F.lit("")), F.lit("\n]"))
                    .alias("table_text")))


def to_mschema(cat_tables: DataFrame, cat_fields: DataFrame, cat_fks: DataFrame,
               selected_tables: list[str] | None = None, table_type: str | None = None,
               example_num: int = 3, max_len: int = 30,
               show_type_detail: bool = False) -> DataFrame:
    """M2: one ``(db, mschema)`` row per database."""
    tt = table_texts(cat_tables, field_lines(cat_fields, example_num, max_len, show_type_detail))
    sel = [s.lower() for s in selected_tables] if selected_tables is not None else None
    keep = F.lit(True)
    if sel is not None:
        keep = keep & F.lower("table_name").isin(sel)
    if table_type is not None:
        keep = keep & (F.coalesce("table_type", F.lit("table")) == table_type)
    tables_txt = (tt.where(keep).groupBy("db")
                  .agg(_sorted_join(F.collect_list(F.struct(
                      F.col("table_ord").alias("ord"), F.col("table_text").alias("txt"))), "\n")
                       .alias("tables_txt")))
    schemas = cat_tables.select("db", F.col("schema").alias("db_schema")).distinct()
    fk = cat_fks.join(schemas, "db", "left")
    fk_keep = F.col("ref_schema").eqNullSafe(F.col("db_schema"))
    if sel is not None:
        fk_keep = fk_keep & F.lower("table_name").isin(sel) & F.lower("ref_table").isin(sel)
    fk_line = F.concat_ws("", F.col("table_name"), F.lit("."), F.col("field_name"), F.lit("="),
                          F.col("ref_table"), F.lit("."), F.col("ref_field"))
    fks_txt = (fk.groupBy("db").agg(
        F.count(F.lit(1)).alias("n_fk"),
        _sorted_join(F.collect_list(F.when(fk_keep, F.struct(
            F.col("fk_ord").alias("ord"), fk_line.alias("txt")))), "\n").alias("fks_txt")))
    dbs = cat_tables.select("db").distinct()
    return (dbs.join(tables_txt, "db", "left").join(fks_txt, "db", "left")
            .select("db", F.concat(
                F.lit(DB_HEAD + " "), F.col("db"), F.lit("\n" + SCHEMA_HEAD),
                F.when(F.coalesce("tables_txt", F.lit("")) != "",
                       F.concat(F.lit("\n"), F.col("tables_txt"))).otherwise(F.lit("")),
                F.when(F.coalesce("n_fk", F.lit(0)) > 0, F.concat(
                    F.lit("\n" + FK_HEAD),
                    F.when(F.col("fks_txt") != "", F.concat(F.lit("\n"), F.col("fks_txt")))
                    .otherwise(F.lit("")))).otherwise(F.lit(""))).alias("mschema")))


# ---------------------------------------------------------------- parsing --
# Parsed schema, one value per record (row-local, no shuffle):
#   struct<parsed: boolean,
#          tables: array<struct<key, name, cols: array<struct<name, line>>>>,
#          fks: array<struct<lt, lc, rt, rc>>>
# ``key`` is the full header text (may hold ", comment" or "schema."),
# ``name`` the bare table name used for matching (quirk Q2).

# what rendering puts around a table's columns; a block is its heading line and all up to the closing bracket's line
BODY_OPEN, BODY_CLOSE = "\n[", "]\n"
TABLE_BLOCK_RE = f"{re.escape(TABLE_HEAD)}([^\\n]+?{re.escape(BODY_OPEN)}(?s:.+?){re.escape(BODY_CLOSE)})"


def _strip(c: Column) -> Column:
    from quarry.operators.responses import strip_ws
    return strip_ws(c)


def _col_line_slow(item: Column) -> Column:
    """Index arithmetic for items without a ``(...)`` pair."""
    lpos = F.locate("(", item)
    start0 = F.when(lpos > 0, lpos).otherwise(F.lit(1))  # 0-based start of inner = left + 1
    rrev = F.locate(")", F.reverse(item))
    end0 = F.when(rrev > 0, F.length(item) - rrev).otherwise(F.length(item))  # 0-based exclusive end
    inner = F.substr(item, start0 + 1, F.greatest(end0 - start0, F.lit(0)))
    return F.concat(F.lit("("), inner, F.lit(")"))


def _col_line(item: Column) -> Column:
    """Text between the first ``(`` and the last ``)`` of a column item,
    wrapped in parentheses again; its name is before the first ``,`` then
    before the first ``:``.  One greedy regex covers well-formed items."""
    paren = F.regexp_extract(item, r"(?s)(\(.*\))", 1)
    line = F.when(paren != "", paren).otherwise(_col_line_slow(item))
    return F.struct(line.alias("line"))


def _named(c: Column) -> Column:
    """Add the column name read from the line."""
    name = _strip(F.regexp_extract(c["line"], r"^\(([^,:]*)", 1))
    return F.struct(name.alias("name"), c["line"].alias("line"))


def bare_table_name(key: Column) -> Column:
    """Header text before the first ``,`` (drops a table comment)."""
    return _strip(F.substring_index(key, ",", 1))


def _fk(line: Column) -> Column:
    left = _strip(F.substring_index(line, "=", 1))
    right = _strip(F.substring_index(line, "=", -1))

    def split_last_dot(s):
        col = F.substring_index(s, ".", -1)
        tab = F.substr(s, F.lit(1), F.greatest(F.length(s) - F.length(col) - 1, F.lit(0)))
        return tab, col

    lt, lc = split_last_dot(left)
    rt, rc = split_last_dot(right)
    ticks = lc.contains("`") & rc.contains("`")

    def unq(c):
        return F.when(ticks, F.substr(c, F.lit(2), F.length(c) - 2)).otherwise(c)

    return F.struct(lt.alias("lt"), unq(lc).alias("lc"), rt.alias("rt"), unq(rc).alias("rc"))


def parse_schema(text) -> Column:
    """M5: M-Schema text -> parsed struct (see above).  A text with no
    ``# Table:`` block (e.g. DDL, quirk Q1) gives ``parsed = false``."""
    t = F.col(text) if isinstance(text, str) else text
    t2 = F.when(t.contains(FK_HEAD), t).otherwise(F.concat(t, F.lit("\n")))
    # one regex pass: each block is "name\n[ body ]\n"; head and body are
    # then cut with string functions
    blocks = F.regexp_extract_all(t2, F.lit(TABLE_BLOCK_RE), 1)

    def table(b):
        head = F.substring_index(b, "\n[", 1)
        body = F.substr(b, F.length(head) + F.lit(3), F.length(b) - F.length(head) - F.lit(4))
        return F.struct(head.alias("key"), bare_table_name(head).alias("name"),
                        F.transform(F.transform(F.split(_strip(body), ",\n"), _col_line), _named).alias("cols"))
    tables = F.transform(blocks, table)
    fk_part = _strip(F.substring_index(_strip(t), FK_HEAD, -1))
    fk_lines = F.filter(F.split(fk_part, "\n"), lambda l: F.length(l) > 0)
    fks = F.when(t.contains(FK_HEAD), F.transform(fk_lines, _fk)).otherwise(
        F.array().cast("array<struct<lt:string,lc:string,rt:string,rc:string>>"))
    return F.struct((F.size(blocks) > 0).alias("parsed"), tables.alias("tables"), fks.alias("fks"))


def render_schema(db_id: Column, parsed: Column, indent: Column | None = None) -> Column:
    """M6: parsed struct -> text.  ``indent`` is the per-line prefix (two
    spaces by default; pass a column, not a computed expression, since it is
    read once per line); tables without columns are left out; both headings
    are always written; FKs as ``a.b = c.d``."""
    pre = F.lit("  ") if indent is None else indent
    kept = F.filter(parsed["tables"], lambda tb: F.size(tb["cols"]) > 0)
    tables_txt = F.array_join(F.transform(kept, lambda tb: F.concat(
        F.lit(TABLE_HEAD), tb["key"], F.lit("\n[\n"),
        F.array_join(F.transform(tb["cols"], lambda c: F.concat(pre, c["line"])), ",\n"),
        F.lit("\n]"))), "\n")
    fks_txt = F.array_join(F.transform(parsed["fks"], lambda k: F.concat(
        k["lt"], F.lit("."), k["lc"], F.lit(" = "), k["rt"], F.lit("."), k["rc"])), "\n")
    return F.concat(F.lit(DB_HEAD + " "), db_id, F.lit("\n" + SCHEMA_HEAD + "\n"), tables_txt,
                    F.lit("\n" + FK_HEAD + "\n"), fks_txt)


def _table_matches(tb_name: Column, fk_table: Column) -> Column:
    # a header may carry a "schema." prefix that FK lines do not
    return (tb_name == fk_table) | tb_name.endswith(F.concat(F.lit("."), fk_table))


def fk_filter(parsed: Column) -> Column:
    """M7: keep a FK when both tables and both columns survive (tables
    matched on the bare name, quirk Q2)."""
    tabs = parsed["tables"]

    def has(t, c):
        return F.exists(tabs, lambda tb: _table_matches(tb["name"], t)
                        & F.exists(tb["cols"], lambda col: col["name"] == c))
    return parsed.withField("fks", F.filter(parsed["fks"], lambda k: has(k["lt"], k["lc"]) & has(k["rt"], k["rc"])))


# ------------------------------------------------- selected columns (M3/M4) --

def _catalog_arrays(cat_tables: DataFrame, cat_fields: DataFrame, cat_fks: DataFrame,
                    example_num: int, max_len: int, show_type_detail: bool) -> DataFrame:
    """One row per database holding its tables (catalog order) with field
    line parts, and its FK lines - schema-sized."""
    t = F.upper(F.col("type")) if show_type_detail else F.upper(F.substring_index("type", "(", 1))
    abbr = F.upper(F.substring_index("type", "(", 1))
    comment = F.coalesce(F.col("comment"), F.lit(""))
    head = F.concat(F.lit("("), F.col("field_name"), F.lit(":"), t,
                    F.when(comment != "", F.concat(F.lit(", "), F.trim(comment))).otherwise(F.lit("")),
                    F.when(F.coalesce("primary_key", F.lit(False)), F.lit(", Primary Key")).otherwise(F.lit("")))
    raw = F.filter(F.coalesce("examples", F.array().cast("array<string>")), lambda x: x.isNotNull())
    ex = example_list(raw, abbr, example_num, max_len, 100) if example_num > 0 else F.array().cast("array<string>")
    f = cat_fields.select("db", "table_name", F.struct(
        F.col("field_ord").alias("ord"), F.col("field_name").alias("name"), head.alias("head"),
        ex.alias("ex"), ((F.size(raw) > 0) & F.lit(example_num > 0)).alias("has_ex")).alias("f"))
    per_table = f.groupBy("db", "table_name").agg(F.array_sort(F.collect_list("f")).alias("fields"))
    comment_t = F.coalesce(F.col("comment"), F.lit(""))
    qual = F.when(F.coalesce(F.length("schema"), F.lit(0)) > 0,
                  F.concat(F.col("schema"), F.lit("."), F.col("table_name"))).otherwise(F.col("table_name"))
    header = F.concat(F.lit(TABLE_HEAD), qual, F.when((comment_t != "") & (comment_t != "None"),
                                                       F.concat(F.lit(", "), comment_t)).otherwise(F.lit("")))
    tabs = (cat_tables.join(per_table, ["db", "table_name"], "left")
            .groupBy("db").agg(F.array_sort(F.collect_list(F.struct(
                F.col("table_ord").alias("ord"), F.col("table_name").alias("name"), header.alias("header"),
                F.coalesce("fields", F.array().cast(per_table.schema["fields"].dataType)).alias("fields"))))
                .alias("tables"),
                F.first("schema", ignorenulls=True).alias("db_schema")))
    fk = cat_fks.groupBy("db").agg(F.array_sort(F.collect_list(F.struct(
        F.col("fk_ord").alias("ord"), "table_name", "ref_table", "ref_schema",
        F.concat_ws("", "table_name", F.lit("."), "field_name", F.lit("="), "ref_table", F.lit("."),
                    "ref_field").alias("line")))).alias("fks"))
    return tabs.join(fk, "db", "left")


def to_mschema_with_selected(cat_tables: DataFrame, cat_fields: DataFrame, cat_fks: DataFrame,
                             requests: DataFrame, example_num: int = 3, show_type_detail: bool = False,
                             broadcast_bytes: int = 64 * 1024 * 1024) -> DataFrame:
    """M3 + M4 for ``requests(req_id, db, selected_cols array<string>,
    selected_values map<string, array<string>>)`` -> ``(req_id, mschema)``.

    Columns are named ``table.column`` (any case); the tables shown are those
    of the selected columns; a field with examples gets the caller's values
    first (order-preserving de-duplication); examples longer than 100
    characters are dropped; tables are sorted by text length (stable); FKs
    as in M2.  Each request reads its database's catalog arrays, joined by a
    broadcast when their size is known to be small."""
    # schema-sized and read twice (size check, join): written once
    cat = _catalog_arrays(cat_tables, cat_fields, cat_fks, example_num, 100, show_type_detail)
    path = scratch_path(cat.sparkSession, "catalog")
    cat.write.parquet(path)
    cat = cat.sparkSession.read.schema(cat.schema).parquet(path)
    size = cat.select(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0] or 0
    cat_side = F.broadcast(cat) if size <= broadcast_bytes else cat
    r = requests.select("req_id", "db",
                        F.transform(F.coalesce("selected_cols", F.array().cast("array<string>")),
                                    lambda s: F.lower(s)).alias("_sel"),
                        # names that differ only by case are one name: the last entry counts
                        F.aggregate(F.map_entries(F.coalesce("selected_values", F.create_map().cast("map<string,array<string>>"))),
                                    F.create_map().cast("map<string,array<string>>"),
                                    lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != F.lower(e["key"])),
                                                              F.create_map(F.lower(e["key"]), e["value"]))).alias("_vals"))
    j = r.join(cat_side, "db", "left")
    j = j.withColumn("_stabs", F.array_distinct(F.transform("_sel", lambda s: F.substring_index(s, ".", 1))))

    def field_line(tname, fld):
        key = F.concat(F.lower(tname), F.lit("."), F.lower(fld["name"]))
        sel_vals = F.coalesce(F.col("_vals")[key], F.array().cast("array<string>"))
        ex = F.when(fld["has_ex"], F.array_distinct(F.concat(sel_vals, fld["ex"]))).otherwise(fld["ex"])
        return F.concat(fld["head"], F.when(F.size(ex) > 0, F.concat(F.lit(", Examples: ["),
                                                                     F.array_join(ex, ", "), F.lit("]")))
                        .otherwise(F.lit("")), F.lit(")"))

    chosen = F.filter("tables", lambda tb: F.array_contains(F.col("_stabs"), F.lower(tb["name"])))
    texts = F.transform(chosen, lambda tb: F.struct(
        F.concat(tb["header"], F.lit("\n[\n"), F.array_join(F.transform(
            F.filter(tb["fields"], lambda fl: F.array_contains(
                F.col("_sel"), F.concat(F.lower(tb["name"]), F.lit("."), F.lower(fl["name"])))),
            lambda fl: field_line(tb["name"], fl)), ",\n"), F.lit("\n]")).alias("txt"),
        tb["ord"].alias("ord")))
    j = j.withColumn("_texts", texts)
    ordered = F.array_sort(F.transform("_texts", lambda x: F.struct(F.length(x["txt"]).alias("n"),
                                                                     x["ord"].alias("ord"), x["txt"].alias("txt"))))
    fks = F.coalesce("fks", F.array().cast(cat.schema["fks"].dataType))
    kept = F.filter(fks, lambda k: k["ref_schema"].eqNullSafe(F.col("db_schema"))
                    & F.array_contains(F.col("_stabs"), F.lower(k["table_name"]))
                    & F.array_contains(F.col("_stabs"), F.lower(k["ref_table"])))
    body = F.array_join(F.transform(ordered, lambda x: x["txt"]), "\n")
    text = F.concat(F.lit(DB_HEAD + " "), F.col("db"), F.lit("\n" + SCHEMA_HEAD),
                    F.when(F.size("_texts") > 0, F.concat(F.lit("\n"), body)).otherwise(F.lit("")),
                    F.when(F.size(fks) > 0, F.concat(F.lit("\n" + FK_HEAD), F.when(
                        F.size(kept) > 0, F.concat(F.lit("\n"), F.array_join(F.transform(kept, lambda k: k["line"]),
                                                                             "\n"))).otherwise(F.lit(""))))
                    .otherwise(F.lit("")))
    return j.select("req_id", text.alias("mschema"))
