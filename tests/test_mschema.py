"""M-Schema rendering, parsing and augmentation (M1-M7, A1-A4)."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import augment as A
from quarry.operators import mschema as MS

TEXT = ("【DB_ID】 db\n【Schema】\n# Table: orders\n[\n(o_id:BIGINT, Primary Key, Examples: [1, 2]),\n"
        "(o_cust:BIGINT)\n]\n# Table: customer, buyers\n[\n(c_id:BIGINT, Primary Key),\n(c_name:TEXT)\n]\n"
        "【Foreign keys】\norders.o_cust=customer.c_id")


def parsed(spark, text, extra=None):
    df = spark.createDataFrame([(text, extra or "")], "t string, s string")
    return df.select(MS.parse_schema("t").alias("p")).first()["p"].asDict(recursive=True)


def test_parse_tables_columns_fks(spark):
    p = parsed(spark, TEXT)
    assert p["parsed"]
    assert [t["key"] for t in p["tables"]] == ["orders", "customer, buyers"]
    assert [t["name"] for t in p["tables"]] == ["orders", "customer"]
    assert [c["name"] for c in p["tables"][0]["cols"]] == ["o_id", "o_cust"]
    assert p["tables"][0]["cols"][0]["line"] == "(o_id:BIGINT, Primary Key, Examples: [1, 2])"
    assert p["fks"] == [{"lt": "orders", "lc": "o_cust", "rt": "customer", "rc": "c_id"}]


def test_ddl_is_not_parsed(spark):
    # quirk Q1: a DDL text has no '# Table:' block
    p = parsed(spark, "CREATE TABLE t (a INT);")
    assert not p["parsed"] and p["tables"] == []


def test_fk_split_on_last_dot_and_backticks(spark):
    # quirk Q3
    text = TEXT.replace("orders.o_cust=customer.c_id", "s.orders.`o_cust`=s.customer.`c_id`")
    p = parsed(spark, text)
    assert p["fks"] == [{"lt": "s.orders", "lc": "o_cust", "rt": "s.customer", "rc": "c_id"}]


def test_fk_filter_matches_bare_name_of_commented_table(spark):
    # quirk Q2: 'customer, buyers' still matches FK table 'customer'
    df = spark.createDataFrame([(TEXT,)], "t string").withColumn("p", MS.parse_schema("t"))
    out = df.select(MS.fk_filter(F.col("p")).alias("q")).first()["q"]
    assert len(out["fks"]) == 1


def test_render_roundtrip_format(spark):
    df = spark.createDataFrame([(TEXT,)], "t string").withColumn("p", MS.parse_schema("t"))
    out = df.select(MS.render_schema(F.lit("db"), F.col("p")).alias("r")).first()["r"]
    assert out.startswith("【DB_ID】 db\n【Schema】\n# Table: orders\n[\n  (o_id:BIGINT")
    assert out.endswith("【Foreign keys】\norders.o_cust = customer.c_id")


names = st.from_regex(r"[a-z][a-z0-9_]{0,8}", fullmatch=True)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(names, st.lists(names, min_size=1, max_size=4, unique=True)),
                min_size=1, max_size=4, unique_by=lambda x: x[0]))
def test_parse_render_is_identity(spark, tables):
    body = "\n".join(f"# Table: {t}\n[\n" + ",\n".join(f"  ({c}:TEXT)" for c in cols) + "\n]"
                     for t, cols in tables)
    text = f"【DB_ID】 d\n【Schema】\n{body}\n【Foreign keys】\n"
    df = spark.createDataFrame([(text,)], "t string").withColumn("p", MS.parse_schema("t"))
    again = df.select(MS.render_schema(F.lit("d"), F.col("p")).alias("r")).first()["r"]
    assert again == text


def test_permute_label_first_occurrence(spark):
    # quirk Q14: a label twice on a line splits at the first one
    df = spark.createDataFrame([("(a:TEXT, Examples: [x, Examples: y])",)], "line string")
    p = F.struct(F.lit(True).alias("parsed"), F.array(F.struct(
        F.lit("t").alias("key"), F.lit("t").alias("name"),
        F.array(F.struct(F.lit("a").alias("name"), F.col("line").alias("line"))).alias("cols"))).alias("tables"),
        F.array().cast("array<struct<lt:string,lc:string,rt:string,rc:string>>").alias("fks"))
    out = df.select(A.schema_permute(p, F.lit("values:")).alias("q")).first()["q"]
    assert out["tables"][0]["cols"][0]["line"] == "(a:TEXT, values: [x, Examples: y])"


def test_filter_keeps_tables_and_columns_named_in_sql(spark):
    df = spark.createDataFrame([(1, TEXT, "SELECT o_cust FROM ORDERS")], "idx long, t string, sql string")
    df = df.withColumn("p", MS.parse_schema("t"))
    out = A.schema_filter(df, "p", "q", F.col("idx"), "sql", 42, 0.0, 0.0).first()["q"]
    assert [t["name"] for t in out["tables"]] == ["orders"]
    assert [c["name"] for c in out["tables"][0]["cols"]] == ["o_cust"]
    assert out["fks"] == []


def test_rename_whole_words_only(spark):
    # quirk Q15: 'order' must not rewrite 'orders'
    text = "# Table: order\n[\n(a:TEXT)\n]\n# Table: orders\n[\n(b:TEXT)\n]\n"
    df = spark.createDataFrame([(1, text, "SELECT a FROM order JOIN orders", "db")],
                               "idx long, t string, sql string, d string")
    s, q = A.schema_rename(F.col("t"), F.col("sql"), F.col("d"), F.col("idx"), 42, 1.0)
    r = df.select(s.alias("s"), q.alias("q")).first()
    assert r["q"] == "SELECT a FROM db.order JOIN db.orders"
    assert "# Table: db.order\n" in r["s"] and "# Table: db.orders\n" in r["s"]


def test_same_seed_same_augmentation_any_partitioning(spark):
    from quarry.plans.fixtures import schema_texts
    from conftest import SF_SMALL
    df = schema_texts(spark, SF_SMALL)
    a = {r.idx: r.db_schema for r in A.augment_record(df.repartition(3)).collect()}
    b = {r.idx: r.db_schema for r in A.augment_record(df.repartition(7)).collect()}
    assert a == b


def test_example_list_rules(spark):
    df = spark.createDataFrame([(["a" * 40, "b", "c", "d"], "TEXT"), (["2020-01-01", "x"], "DATE"),
                                ([], "DATE")], "e array<string>, t string")
    out = [r[0] for r in df.select(MS.example_list(F.col("e"), F.col("t"))).collect()]
    assert out == [["b", "c"], ["2020-01-01"], []]


def test_distinct_schema_parse_matches_row_local(spark):
    # a corpus repeating one schema text per database takes the broadcast path
    from conftest import SF_SMALL
    from quarry.plans.fixtures import samples
    f1 = samples(spark, SF_SMALL)
    df = f1.withColumn("db_schema", F.concat(F.lit(TEXT.replace("【DB_ID】 db", "【DB_ID】 ")), F.lit("")))
    df = df.withColumn("db_schema", F.regexp_replace("db_schema", "【DB_ID】 ", F.concat(F.lit("【DB_ID】 "), F.col("db_name"))))
    a = {r.idx: (r.db_schema, r.sql) for r in A.augment_record(df, dedupe_parse=True).collect()}
    b = {r.idx: (r.db_schema, r.sql) for r in A.augment_record(df, dedupe_parse=False).collect()}
    assert a == b and len(a) == f1.count()
