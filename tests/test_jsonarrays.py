"""JSON arrays read by many tasks equal the whole-file reader."""

import json
import os
import random
import tempfile

import pytest

from quarry.sources import files as S
from quarry.sources import jsonarrays as J

NASTY = ['}', '{', '"', '\\', '\\\\"}', '},{', ']', '[', '"}', '\\"', 'é', '日本', '\n', '\t', '}}}}', '{"a": "}"}', '\\}', 'x', ' ', ',']


def records(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices(NASTY, k=rng.randint(0, 12)))
    return [{"id": i, "text": rng.choice([word(), word(), word() * 9]), "more": {word(): [word(), {"k}": word()}]}} for i in range(n)]


def write(rows, **how):
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "x.json"), "w", encoding="utf-8") as f:
        f.write(rows if isinstance(rows, str) else json.dumps(rows, **how))
    return d


@pytest.fixture
def small_splits(spark):
    def at(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield at
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("how", [{}, {"indent": 2}, {"ensure_ascii": False}, {"ensure_ascii": False, "indent": 1, "separators": (" ,", " : ")}])
@pytest.mark.parametrize("size", [151, 1 << 20])
def test_elements_are_the_array(spark, small_splits, how, size):
    rows = records(14, size)
    small_splits(size)
    got = J.elements(spark, write(rows, **how)).collect()
    assert [json.loads(r.text) for r in sorted(got, key=lambda r: r.pos)] == rows
    assert [r.pos for r in sorted(got, key=lambda r: r.pos)] == list(range(14))


def test_equals_the_whole_file_reader_with_several_tasks(spark, small_splits):
    rows = [{"id": r["id"], "text": r["text"], "SQL": None} for r in records(150, 5)]
    d = write(rows, ensure_ascii=False)
    want = spark.read.option("multiLine", True).schema("id long, text string, SQL string").json(d).collect()
    small_splits(1200)
    assert J._pieces(spark, d).rdd.getNumPartitions() > 10
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("SQL", T.StringType())])
    got = S.read_json_array(spark, d, schema).collect()
    assert sorted((r.id, r.text, r.SQL) for r in got) == sorted((r.id, r.text, r.SQL) for r in want)
    assert [r.id for r in sorted(got, key=lambda r: r._pos)] == list(range(150))


def test_an_element_over_many_splits_and_odd_files(spark, small_splits):
    small_splits(100)
    big = [{"a": "}" * 400}, {"b": {"c": [1, {"d": "x" * 500}]}}, {}]
    got = J.elements(spark, write(big)).collect()
    assert [json.loads(r.text) for r in sorted(got, key=lambda r: r.pos)] == big
    for text, want in (("", []), ("[]", []), (" [ ] \n", []), ("[1, \"{}\", [2], {\"a\": 1}, null]", [{"a": 1}]), ('\n{"a": {"b": 2}}\n', [{"a": {"b": 2}}])):
        assert [json.loads(r.text) for r in J.elements(spark, write(text)).collect()] == want, text


def test_many_files_and_written_arrays(spark, small_splits):
    path = tempfile.mkdtemp() + "/out"
    rows = [(i, f'"{i}}}', None if i % 3 else "{") for i in range(300)]
    J.write_json_arrays(spark.createDataFrame(rows, "id long, text string, more string").repartition(5), path)
    names = [n for n in os.listdir(path) if n.startswith("part-")]
    assert sum(len(json.load(open(os.path.join(path, n)))) for n in names if os.path.getsize(os.path.join(path, n))) == 300
    small_splits(1500)
    got = [json.loads(r.text) for r in J.elements(spark, path).collect()]
    assert sorted((r["id"], r["text"], r["more"]) for r in got) == rows
