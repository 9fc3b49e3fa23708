"""M-Schema parsing and schema augmentation queries (M5-M7, A1-A4) over F3.

The Spark side edits parsed arrays row by row; the oracles rebuild the same
texts from the long form (unnest + ordered ``string_agg``) in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.rand import threshold
from quarry.operators import augment as A
from quarry.operators import mschema as MS
from quarry.plans.fixtures import F3_SQL, schema_texts

QUERIES: dict = {}
ORACLES: dict = {}
SEED = 42


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def _s(x):
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def _h(purpose, *parts):
    return f"md5('{SEED}:{purpose}:' || concat_ws('|', {', '.join(parts)}))"


def _d(purpose, p, *parts):
    if p >= 1:
        return "true"
    if p <= 0:
        return "false"
    return f"(substr({_h(purpose, *parts)}, 1, 8) < '{threshold(p)}')"


TRE = r"'# Table: (.+?)\n\[([\s\S]+?)\]\n'"
# long form of F3: tables (t), columns (c), foreign keys (k)
LONG = f"""f3 AS ({F3_SQL}),
src AS (SELECT idx, db_name, sql, db_schema,
 CASE WHEN contains(db_schema, '【Foreign keys】') THEN db_schema ELSE db_schema || chr(10) END AS t2 FROM f3),
tb AS (SELECT idx, db_name, sql, regexp_extract_all(t2, {TRE}, 1) AS heads,
 regexp_extract_all(t2, {TRE}, 2) AS bodies FROM src),
t0 AS (SELECT idx, db_name, sql, heads, bodies, unnest(generate_series(1, len(heads))) AS t_ord FROM tb),
t AS (SELECT idx, db_name, sql, t_ord - 1 AS t_ord, heads[t_ord] AS tkey,
 {_s("split_part(heads[t_ord], ',', 1)")} AS tname, bodies[t_ord] AS body FROM t0),
i0 AS (SELECT idx, t_ord, tkey, tname, string_split({_s('body')}, ',' || chr(10)) AS items FROM t),
i1 AS (SELECT idx, t_ord, tkey, tname, items, unnest(generate_series(1, len(items))) AS c_ord FROM i0),
i2 AS (SELECT idx, t_ord, tkey, tname, c_ord - 1 AS c_ord, items[c_ord] AS item FROM i1),
i3 AS (SELECT *, CASE WHEN instr(item, '(') > 0 THEN instr(item, '(') ELSE 1 END AS s0,
 CASE WHEN instr(reverse(item), ')') > 0 THEN length(item) - instr(reverse(item), ')') ELSE length(item) END AS e0
 FROM i2),
c AS (SELECT idx, t_ord, tkey, tname, c_ord, substr(item, s0 + 1, greatest(e0 - s0, 0)) AS inner_,
 {_s(f"split_part(split_part({_s('substr(item, s0 + 1, greatest(e0 - s0, 0))')}, ',', 1), ':', 1)")} AS cname,
 '(' || substr(item, s0 + 1, greatest(e0 - s0, 0)) || ')' AS line FROM i3),
k0 AS (SELECT idx, string_split({_s(f"split_part({_s('db_schema')}, '【Foreign keys】', -1)")}, chr(10)) AS ls
 FROM f3 WHERE contains(db_schema, '【Foreign keys】')),
k1 AS (SELECT idx, ls, unnest(generate_series(1, len(ls))) AS k_ord FROM k0),
k2 AS (SELECT idx, k_ord - 1 AS k_ord, {_s("split_part(ls[k_ord], '=', 1)")} AS l,
 {_s("split_part(ls[k_ord], '=', -1)")} AS r FROM k1 WHERE length(ls[k_ord]) > 0),
k AS (SELECT idx, k_ord, left(l, length(l) - length(split_part(l, '.', -1)) - 1) AS lt, split_part(l, '.', -1) AS lc,
 left(r, length(r) - length(split_part(r, '.', -1)) - 1) AS rt, split_part(r, '.', -1) AS rc FROM k2)"""


def _parsed(spark, sf_dir):
    return schema_texts(spark, sf_dir).withColumn("p", MS.parse_schema("db_schema"))


@register("mschema_parse", f"""WITH {LONG}
SELECT idx, CAST(t_ord AS INTEGER) AS t_ord, tkey AS table_key, tname AS table_name, CAST(c_ord AS INTEGER) AS c_ord,
 cname AS col_name, line FROM c""")
def mschema_parse_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parsed(spark, sf_dir)
    t = p.select("idx", F.posexplode("p.tables").alias("t_ord", "t"))
    c = t.select("idx", "t_ord", F.col("t.key").alias("table_key"), F.col("t.name").alias("table_name"),
                 F.posexplode("t.cols").alias("c_ord", "c"))
    return c.select("idx", "t_ord", "table_key", "table_name", "c_ord",
                    F.col("c.name").alias("col_name"), F.col("c.line").alias("line"))


def _render_sql(cols_cte: str, tables_cte: str, fks_cte: str, indent_sql: str = "'  '") -> str:
    """Long form -> M6 text per record: tables by ``t_key_ord``, columns by
    ``c_key_ord``, FKs by ``k_key_ord``; tables without columns dropped."""
    return f"""
tt AS (SELECT c.idx, c.t_ord, '# Table: ' || c.tkey || chr(10) || '[' || chr(10)
  || string_agg({indent_sql} || c.line, ',' || chr(10) ORDER BY c.c_key, c.c_ord) || chr(10) || ']' AS ttxt
  FROM {cols_cte} c LEFT JOIN ind ON ind.idx = c.idx GROUP BY c.idx, c.t_ord, c.tkey),
ttx AS (SELECT tt.idx, string_agg(ttxt, chr(10) ORDER BY tk.t_key, tt.t_ord) AS tables_txt
  FROM tt JOIN {tables_cte} tk ON tk.idx = tt.idx AND tk.t_ord = tt.t_ord GROUP BY tt.idx),
kx AS (SELECT idx, string_agg(lt || '.' || lc || ' = ' || rt || '.' || rc, chr(10) ORDER BY k_key, k_ord) AS fks_txt
  FROM {fks_cte} GROUP BY idx),
out AS (SELECT f3.idx, '【DB_ID】 ' || f3.db_name || chr(10) || '【Schema】' || chr(10) || coalesce(tables_txt, '')
  || chr(10) || '【Foreign keys】' || chr(10) || coalesce(fks_txt, '') AS db_schema
  FROM f3 LEFT JOIN ttx ON ttx.idx = f3.idx LEFT JOIN kx ON kx.idx = f3.idx)"""


NO_SHUFFLE = f"""ind AS (SELECT idx, '  ' AS pre FROM f3),
cc AS (SELECT *, '' AS c_key FROM c), tk AS (SELECT idx, t_ord, '' AS t_key FROM t),
kk AS (SELECT *, '' AS k_key FROM k),"""


@register("mschema_roundtrip", f"WITH {LONG}, {NO_SHUFFLE}" + _render_sql("cc", "tk", "kk").lstrip()
          + "\nSELECT idx, db_schema FROM out")
def mschema_roundtrip_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parsed(spark, sf_dir)
    return p.select("idx", MS.render_schema(F.col("db_name"), F.col("p")).alias("db_schema"))


SHUFFLE = f"""ind AS (SELECT idx, '  ' AS pre FROM f3),
tk AS (SELECT idx, t_ord, CASE WHEN {_d('a1_tab', 0.5, 'cast(idx AS VARCHAR)')}
   THEN {_h('a1_tab_order', 'cast(idx AS VARCHAR)', 'tkey')} ELSE '' END AS t_key FROM t),
cc AS (SELECT *, CASE WHEN {_d('a1_col', 0.3, 'cast(idx AS VARCHAR)', 'tkey')}
   THEN {_h('a1_col_order', 'cast(idx AS VARCHAR)', 'tkey', 'cname')} ELSE '' END AS c_key FROM c),
kk AS (SELECT *, CASE WHEN {_d('a1_fk', 0.2, 'cast(idx AS VARCHAR)')}
   THEN {_h('a1_fk_order', 'cast(idx AS VARCHAR)', 'cast(k_ord AS VARCHAR)')} ELSE '' END AS k_key FROM k),"""


@register("schema_shuffle", f"WITH {LONG}, {SHUFFLE}" + _render_sql("cc", "tk", "kk").lstrip()
          + "\nSELECT idx, db_schema FROM out")
def schema_shuffle_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parsed(spark, sf_dir)
    p = p.withColumn("s", A.schema_shuffle(F.col("p"), F.col("idx"), SEED))
    return p.select("idx", MS.render_schema(F.col("db_name"), F.col("s")).alias("db_schema"))


def _in_sql(name):
    return f"regexp_matches(sql, '(?i)\\b' || regexp_escape({name}) || '\\b')"


FILTER = f"""ind AS (SELECT idx, '  ' AS pre FROM f3),
tkeep AS (SELECT * FROM t WHERE {_in_sql('tname')} OR {_d('a2_tab', 0.8, 'cast(idx AS VARCHAR)', 'tkey')}),
ckeep AS (SELECT c.* FROM c JOIN tkeep ON c.idx = tkeep.idx AND c.t_ord = tkeep.t_ord
  WHERE {_in_sql('c.cname')} OR {_d('a2_col', 0.7, 'cast(c.idx AS VARCHAR)', 'c.tkey', 'c.cname')}),
cc AS (SELECT *, '' AS c_key FROM ckeep), tk AS (SELECT idx, t_ord, '' AS t_key FROM tkeep),
kk AS (SELECT k.*, '' AS k_key FROM k
  WHERE EXISTS (SELECT 1 FROM ckeep x WHERE x.idx = k.idx AND (x.tname = k.lt OR ends_with(x.tname, '.' || k.lt)) AND x.cname = k.lc)
    AND EXISTS (SELECT 1 FROM ckeep x WHERE x.idx = k.idx AND (x.tname = k.rt OR ends_with(x.tname, '.' || k.rt)) AND x.cname = k.rc)),"""


@register("schema_filter", f"WITH {LONG}, {FILTER}" + _render_sql("cc", "tk", "kk").lstrip()
          + "\nSELECT idx, db_schema FROM out")
def schema_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parsed(spark, sf_dir)
    p = A.schema_filter(p, "p", "s", F.col("idx"), "sql", SEED)
    return p.select("idx", MS.render_schema(F.col("db_name"), F.col("s")).alias("db_schema"))


@register("fk_filter", f"""WITH {LONG}, {FILTER.rstrip().rstrip(',')}
SELECT f3.idx, CAST((SELECT count(*) FROM k WHERE k.idx = f3.idx) AS INTEGER) AS n_fk_before,
 CAST((SELECT count(*) FROM kk WHERE kk.idx = f3.idx) AS INTEGER) AS n_fk_after FROM f3""")
def fk_filter_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parsed(spark, sf_dir)
    p = A.schema_filter(p, "p", "s", F.col("idx"), "sql", SEED)
    return p.select("idx", F.size("p.fks").alias("n_fk_before"), F.size("s.fks").alias("n_fk_after"))


def _label_sql():
    acc, parts = 0.0, []
    total = float(sum(A.EXAMPLE_WEIGHTS))
    h = f"substr({_h('a3_label', 'cast(idx AS VARCHAR)')}, 1, 8)"
    for i, w in enumerate(A.EXAMPLE_WEIGHTS[:-1]):
        acc += w / total
        parts.append(f"WHEN {h} < '{threshold(acc)}' THEN '{A.EXAMPLE_LABELS[i]}'")
    return f"CASE {' '.join(parts)} ELSE '{A.EXAMPLE_LABELS[-1]}' END"


def _relabel(found, line="line"):
    pre = f"split_part({line}, '{found}', 1)"
    post = f"substr({line}, length({pre}) + {len(found) + 1})"
    return (f"CASE WHEN lab = '--' THEN {pre} || ') -- Value examples:' || left({post}, length({post}) - 1) "
            f"ELSE {pre} || lab || {post} END")


PERMUTE = f"""lab AS (SELECT idx, {_label_sql()} AS lab FROM f3),
ind AS (SELECT idx, CASE WHEN {_d('a3_indent', 0.5, 'cast(idx AS VARCHAR)')} THEN '' ELSE '  ' END AS pre FROM f3),
cc AS (SELECT c.idx, t_ord, tkey, tname, c_ord, cname, '' AS c_key,
  CASE WHEN contains(line, 'Value examples:') THEN {_relabel('Value examples:')}
       WHEN contains(line, 'Examples:') THEN {_relabel('Examples:')} ELSE line END AS line
  FROM c JOIN lab ON lab.idx = c.idx),
tk AS (SELECT idx, t_ord, '' AS t_key FROM t), kk AS (SELECT *, '' AS k_key FROM k),"""


@register("schema_permute", f"WITH {LONG}, {PERMUTE}" + _render_sql("cc", "tk", "kk", "ind.pre").lstrip()
          + "\nSELECT idx, db_schema FROM out")
def schema_permute_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _parsed(spark, sf_dir)
    p = (p.withColumn("label", A.permute_label(F.col("idx"), SEED))
         .withColumn("indent", A.permute_indent(F.col("idx"), SEED)))
    p = p.withColumn("s", A.schema_permute(F.col("p"), F.col("label")))
    return p.select("idx", MS.render_schema(F.col("db_name"), F.col("s"), F.col("indent")).alias("db_schema"))


@register("schema_rename", f"""WITH {LONG},
picks AS (SELECT idx, t_ord, tname, db_name || '.' || tname AS new FROM t
  WHERE {_in_sql('tname')} AND {_d('a4_tab', 0.5, 'cast(idx AS VARCHAR)', 'tkey')}),
agg AS (SELECT idx, list(struct_pack(o := tname, n := new) ORDER BY t_ord) AS ps FROM picks GROUP BY idx)
SELECT f3.idx,
 list_reduce(list_prepend(struct_pack(o := '', n := f3.db_schema), coalesce(ps, [])),
   lambda acc, x: struct_pack(o := '', n := regexp_replace(acc.n, '\\b' || regexp_escape(x.o) || '\\b', x.n, 'g'))).n AS db_schema,
 list_reduce(list_prepend(struct_pack(o := '', n := f3.sql), coalesce(ps, [])),
   lambda acc, x: struct_pack(o := '', n := regexp_replace(acc.n, '\\b' || regexp_escape(x.o) || '\\b', x.n, 'g'))).n AS sql
FROM f3 LEFT JOIN agg ON agg.idx = f3.idx""")
def schema_rename_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = schema_texts(spark, sf_dir)
    s, q = A.schema_rename(F.col("db_schema"), F.col("sql"), F.col("db_name"), F.col("idx"), SEED)
    return df.select("idx", s.alias("db_schema"), q.alias("sql"))


# the three steps on the long form: what each draws does not depend on the others
CHAIN = f"""tkeep AS (SELECT * FROM t WHERE {_in_sql('tname')} OR {_d('a2_tab', 0.8, 'cast(idx AS VARCHAR)', 'tkey')}),
ckeep AS (SELECT c.* FROM c JOIN tkeep ON c.idx = tkeep.idx AND c.t_ord = tkeep.t_ord
  WHERE {_in_sql('c.cname')} OR {_d('a2_col', 0.7, 'cast(c.idx AS VARCHAR)', 'c.tkey', 'c.cname')}),
lab AS (SELECT idx, {_label_sql()} AS lab FROM f3),
ind AS (SELECT idx, CASE WHEN {_d('a3_indent', 0.5, 'cast(idx AS VARCHAR)')} THEN '' ELSE '  ' END AS pre FROM f3),
tk AS (SELECT idx, t_ord, CASE WHEN {_d('a1_tab', 0.5, 'cast(idx AS VARCHAR)')}
   THEN {_h('a1_tab_order', 'cast(idx AS VARCHAR)', 'tkey')} ELSE '' END AS t_key FROM tkeep),
cc AS (SELECT c.idx, t_ord, tkey, tname, c_ord, cname, CASE WHEN {_d('a1_col', 0.3, 'cast(c.idx AS VARCHAR)', 'tkey')}
   THEN {_h('a1_col_order', 'cast(c.idx AS VARCHAR)', 'tkey', 'cname')} ELSE '' END AS c_key,
  CASE WHEN contains(line, 'Value examples:') THEN {_relabel('Value examples:')}
       WHEN contains(line, 'Examples:') THEN {_relabel('Examples:')} ELSE line END AS line
  FROM ckeep c JOIN lab ON lab.idx = c.idx),
kk AS (SELECT k.*, CASE WHEN {_d('a1_fk', 0.2, 'cast(k.idx AS VARCHAR)')}
   THEN {_h('a1_fk_order', 'cast(k.idx AS VARCHAR)', 'cast(k_ord AS VARCHAR)')} ELSE '' END AS k_key FROM k
  WHERE EXISTS (SELECT 1 FROM ckeep x WHERE x.idx = k.idx AND (x.tname = k.lt OR ends_with(x.tname, '.' || k.lt)) AND x.cname = k.lc)
    AND EXISTS (SELECT 1 FROM ckeep x WHERE x.idx = k.idx AND (x.tname = k.rt OR ends_with(x.tname, '.' || k.rt)) AND x.cname = k.rc)),"""
CHAIN_SQL = f"WITH {LONG}, {CHAIN}" + _render_sql("cc", "tk", "kk", "ind.pre").lstrip()


@register("augment_chain", CHAIN_SQL + "\nSELECT out.idx, out.db_schema, f3.sql FROM out JOIN f3 ON f3.idx = out.idx")
def augment_chain_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 -> A2 -> A3 -> A5 on F3 (its SQL has no comments, so A5 leaves it as it is)."""
    return A.augment_record(schema_texts(spark, sf_dir), SEED).select("idx", "db_schema", "sql")
