"""Registry versions, assembly, executed feedback, resumable prediction, similarity by matrix."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from quarry.operators import assembly, compare, feedback, predict
from quarry.operators.mschema import to_mschema_with_selected
from quarry.sources import jsonarrays, registry as REG

ENTRY = "data_name string, reg_ord int, data_path string, sample_num long, sum_num long, task_name string, data_aug boolean"


def entries(spark, rows):
    return spark.createDataFrame(rows, ENTRY)


def test_registry_versions(spark):
    root = tempfile.mkdtemp() + "/reg"
    assert REG.current(spark, root).count() == 0
    REG.register(entries(spark, [("a", None, "a.json", -1, 5, "nl2sqlite", True), ("b", None, "b.json", 2, 9, "nl2mysql", False)]), root)
    REG.register(entries(spark, [("a", None, "a2.json", 1, 6, "nl2sqlite", False), ("c", None, "c.json", -1, 1, "nl2sqlite", None)]), root)
    got = {r.data_name: (r.reg_ord, r.data_path, r.sample_num) for r in REG.current(spark, root).collect()}
    assert got == {"a": (0, "a2.json", 1), "b": (1, "b.json", 2), "c": (2, "c.json", -1)}


def test_a_failed_writer_leaves_the_old_version(spark):
    root = tempfile.mkdtemp() + "/reg"
    REG.register(entries(spark, [("a", None, "a.json", -1, 5, "nl2sqlite", True)]), root)
    broken = entries(spark, [("z", None, "z.json", -1, 5, "nl2sqlite", True)]).withColumn("data_path", F.raise_error(F.lit("full disk")))
    with pytest.raises(Exception, match="full disk"):
        REG.publish(broken, root)
    assert [r.data_name for r in REG.current(spark, root).collect()] == ["a"]
    # a second writer of the same number fails on the pointer
    with pytest.raises(Exception):
        spark.range(1).select(F.lit("x").alias("version")).write.mode("errorifexists").parquet(f"{root}/current/seq=0")
    assert [r.data_name for r in REG.current(spark, root).collect()] == ["a"]


def test_assembly_follows_the_registry(spark):
    base = tempfile.mkdtemp()
    kind = "idx long, db_name string, question string, evidence string, db_schema string, sql string"
    for name in ("x", "xx", "y"):
        rows = [(i, "d", f"{name} q{i}", "", f"schema of {name}", f"SELECT {i} -- note\n") for i in range(20)]
        jsonarrays.write_json_arrays(spark.createDataFrame(rows, kind).repartition(2), f"{base}/{name}.json")
    reg = entries(spark, [("first", 1, "xx.json", 5, 20, "nl2sqlite", False), ("second", 2, "x.json", -1, 20, "nl2postgres", True),
                          ("third", 3, "y.json", 0, 20, "nl2mysql", None)])
    records = assembly.read_datasets(spark, reg, base)
    assert {(r.data_name, r["count"]) for r in records.groupBy("data_name").count().collect()} == {("first", 20), ("second", 20), ("third", 20)}
    out = sorted(assembly.assemble_registry(records, reg).collect(), key=lambda r: r.id)
    assert [r.id for r in out] == list(range(45)) and [r.data_name for r in out] == ["first"] * 5 + ["second"] * 20 + ["third"] * 20
    assert {r.sql_type for r in out} == {"nl2sqlite", "nl2postgresql", "nl2mysql"}
    answer = {r.data_name: r.conversations[1].content for r in out}
    assert "-- note" in answer["first"] and "-- note" not in answer["second"]  # only the second is augmented
    assert all("xx q" in r.conversations[0].content for r in out[:5])
    test = assembly.assemble_registry(records, reg, kind="test").first()
    assert "db_name" in test.asDict() and "sql" in test.asDict()
    with pytest.raises(ValueError, match="first"):
        assembly.assemble_registry(records, reg.withColumn("sample_num", F.lit(50).cast("long")))
    assert assembly.read_datasets(spark, reg.where("false"), base).count() == 0


def test_results_as_prompt_text(spark):
    outcomes = spark.createDataFrame([("a", "ok", None), ("b", "ok", None), ("c", "error", "[X] bad\nline two"), ("d", "timeout", None)],
                                     "text_id string, status string, message string")
    rows = spark.createDataFrame([("a", i, [f"n:{i}", "0:", "s:x"]) for i in range(30)], "text_id string, row_no long, cells array<string>")
    got = {r.text_id: r.exec_info for r in feedback.result_texts(outcomes, rows).collect()}
    assert got["a"].split("\n") == [f"{i} | NULL | x" for i in range(10)]
    assert (got["b"], got["c"], got["d"]) == ("[]", "error: [X] bad", "timeout: ")
    asked = spark.createDataFrame([(1, 1, "d", "s1"), (1, 2, "d", "s2"), (1, 3, "d", "s1"), (2, 7, "d", "s1")],
                                  "idx long, cand_no int, db string, sql string")
    none = spark.createDataFrame([], "text_id string, exec_info string")
    assert sorted((r.idx, r.cand_no, r.sql) for r in feedback.candidates(asked, none).collect()) == [(1, 1, "s1"), (1, 2, "s2"), (2, 1, "s1")]


def test_a_stopped_run_goes_on(spark):
    src, out, whole = (tempfile.mkdtemp() + "/x" for _ in range(3))
    df = spark.range(200).select(F.col("id").alias("idx"), F.col("id").cast("string").alias("prompt"))
    df.repartition(6).write.parquet(src)
    stream = lambda: spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(src)
    ask = lambda ps: [p + "!" for p in ps]
    with pytest.raises(Exception, match="stopped before batch 1"):
        predict.predict_stream(stream(), ask, out, stop_at=1).awaitTermination()
    part = predict.predicted(spark, out).count()
    assert 0 < part < 200
    # what a killed run left unnoted is written over
    spark.range(5).select(F.col("id").alias("idx"), F.lit("x").alias("prompt"), F.lit("junk").alias("pred_sql")).write.parquet(f"{out}/answers/batch=1")
    assert predict.predicted(spark, out).count() == part
    predict.predict_stream(stream(), ask, out).awaitTermination()
    predict.predict_stream(stream(), ask, whole).awaitTermination()
    got, want = (sorted(map(tuple, predict.predicted(spark, o).select("idx", "pred_sql").collect())) for o in (out, whole))
    assert got == want == [(i, f"{i}!") for i in range(200)]


def plain_jw(s1, s2):
    """Jaro-Winkler one character at a time."""
    if s1 == s2:
        return 1.0
    if not s1 or not s2:
        return 0.0
    window = max(max(len(s1), len(s2)) // 2 - 1, 0)
    used, left = set(), []
    for i, c in enumerate(s1):
        for j in range(max(0, i - window), min(len(s2), i + window + 1)):
            if j not in used and s2[j] == c:
                used.add(j)
                left.append(c)
                break
    if not left:
        return 0.0
    right = [s2[j] for j in sorted(used)]
    t = sum(x != y for x, y in zip(left, right)) // 2
    m = len(left)
    jaro = (m / len(s1) + m / len(s2) + (m - t) / m) / 3
    if jaro <= 0.7:
        return jaro
    p = next((k for k, (x, y) in enumerate(zip(s1[:4], s2[:4])) if x != y), min(4, len(s1), len(s2)))
    return jaro + p * 0.1 * (1 - jaro)


def test_similarity_by_matrix():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcé日x ", k=rng.choice([0, 1, 2, 5, 12, 40])))
    a = [word() for _ in range(600)]
    b = [w if rng.random() < 0.2 else "".join(rng.sample(w, len(w))) if rng.random() < 0.5 else word() for w in a]
    for cells in (1 << 22, 50):
        got = compare._jw_all(a + [None, "x"], b + ["x", None], cells)
        assert got[:600] == pytest.approx([plain_jw(x, y) for x, y in zip(a, b)], abs=1e-12)
        assert all(x != x for x in got[600:])


def test_selected_values_whose_names_differ_by_case(spark):
    tables = spark.createDataFrame([("d", None, "T", 0, "table", "")], "db string, schema string, table_name string, table_ord int, table_type string, comment string")
    fields = spark.createDataFrame([("d", "T", "name", 0, "TEXT", False, "", ["p", "q"])],
                                   "db string, table_name string, field_name string, field_ord int, type string, primary_key boolean, comment string, examples array<string>")
    fks = spark.createDataFrame([], "db string, fk_ord int, table_name string, field_name string, ref_schema string, ref_table string, ref_field string")
    asked = spark.createDataFrame([(1, "d", ["T.name"], {"T.name": ["one"], "t.NAME": ["two"]}), (2, "d", ["t.name"], None)],
                                  "req_id int, db string, selected_cols array<string>, selected_values map<string, array<string>>")
    got = {r.req_id: r.mschema for r in to_mschema_with_selected(tables, fields, fks, asked).collect()}
    assert ("Examples: [one, p, q]" in got[1]) != ("Examples: [two, p, q]" in got[1]) and "Examples: [p, q]" in got[2]


def test_registered_records_are_parsed_once(spark):
    """the draw, the ranks and the samples read the same stored records."""
    from pyspark.sql import functions as F
    from quarry.operators import assembly
    from quarry.sources.registry import REGISTRY_SCHEMA

    seen = spark.sparkContext.accumulator(0)

    def touch(x):
        seen.add(1)
        return x

    rows = [(name, i, "d", f"q{i}", "", "", "SELECT 1") for name in ("a_nl2sqlite", "b_nl2sqlite") for i in range(20)]
    records = spark.createDataFrame(rows, "data_name string, idx long, db_name string, question string, evidence string, db_schema string, sql string")
    records = records.withColumn("question", F.udf(touch, "string")("question"))
    entries = spark.createDataFrame([("a_nl2sqlite", 0, "a", 5, 20, "nl2sqlite", True), ("b_nl2sqlite", 1, "b", -1, 20, "nl2sqlite", False)], REGISTRY_SCHEMA)
    out = assembly.assemble_registry(records, entries).orderBy("id").collect()
    assert [r.id for r in out] == list(range(25)) and [r.data_name[0] for r in out] == ["a"] * 5 + ["b"] * 20
    assert seen.value == len(rows)
