"""Composite keys and foreign keys against plain enumeration."""

import itertools
import random

from quarry.operators import keys as K
from quarry.sources import files


def plain_keys(rows, cols, width):
    found = []
    for k in range(1, width + 1):
        for s in itertools.combinations(cols, k):
            vals = [tuple(r[c] for c in s) for r in rows]
            if (rows and len(set(vals)) == len(vals) and not any(v is None for t in vals for v in t)
                    and not any(set(f) <= set(s) for f in found)):
                found.append(s)
    return found


def test_minimal_unique_sets(spark):
    rng = random.Random(3)
    tables, want = {}, []
    for n in range(4):
        cols = "abcde"[:rng.randint(3, 5)]
        rows = list({tuple(rng.randrange(m) for m in (3, 4, 5, 6, 2)[:len(cols)]): None for _ in range(40)})
        rows = [tuple(str(v) if i == 1 else v for i, v in enumerate(r)) for r in rows]
        if n == 2:
            rows[0] = (None, *rows[0][1:])
        kind = ", ".join(f"{c} {'string' if i == 1 else 'int'}" for i, c in enumerate(cols))
        tables[f"t{n}"] = spark.createDataFrame(rows, kind).repartition(3)
        want += [(f"t{n}", s) for s in plain_keys([dict(zip(cols, r)) for r in rows], cols, 3)]
    tables["none"] = tables["t0"].where("false")
    got = K.unique_sets(tables, 3)
    assert sorted(got) == sorted(want) and any(len(s) > 1 for _, s in got)


def test_composite_foreign_keys(spark):
    parent = spark.createDataFrame([(i, j, f"{i}{j}") for i in range(5) for j in range(4)], "x int, y int, z string")
    child = spark.createDataFrame([(1, 2), (4, 3), (1, 2), (None, 3), (3, None)], "q int, p int")
    stray = spark.createDataFrame([(1, 2), (4, 4)], "q int, p int")
    keys = K.unique_sets({"parent": parent}, 2)
    assert ("parent", ("x", "y")) in keys and ("parent", ("z",)) in keys
    got = K.composite_fks({"parent": parent, "child": child, "stray": stray}, keys)
    # (p, q) -> (x, y): 2,1 and 3,4 are not both there as x < 5, y < 4: (3, 4) is no parent
    assert ("child", ("q", "p"), "parent", ("x", "y")) in got and not any(g[0] == "stray" for g in got)
    assert ("child", ("p", "q"), "parent", ("x", "y")) not in got
    lone = spark.createDataFrame([(1, 2), (None, 9)], "q int, p int")  # 9 is no value of y, beside a null or not
    assert K.composite_fks({"parent": parent, "lone": lone}, keys) == []


def test_keys_through_a_dump(spark):
    found = K.key_rows(spark, "d", [("t", ("a", "b")), ("t", ("c",))]).union(K.key_rows(spark, "d", [("t", ("b",))], "index"))
    tables = spark.createDataFrame([("d", None, "t", 0, "table", ""), ("d", None, "u", 1, "table", "")],
                                   "db string, schema string, table_name string, table_ord int, table_type string, comment string")
    fields = spark.createDataFrame([("d", t, "a", 0, "INTEGER", False, True, None, False, False, "", [], "", "") for t in "tu"],
                                   "db string, table_name string, field_name string, field_ord int, type string, primary_key boolean, "
                                   "nullable boolean, default string, autoincrement boolean, unique boolean, comment string, "
                                   "examples array<string>, category string, dim_or_meas string")
    fks = spark.createDataFrame([], "db string, fk_ord int, table_name string, field_name string, ref_schema string, ref_table string, ref_field string")
    dump = files.dump_mschema(tables, fields, fks, found)
    assert sorted(map(tuple, files.load_keys(dump).collect())) == [
        ("d", "t", "index", 0, ["b"]), ("d", "t", "unique", 0, ["a", "b"]), ("d", "t", "unique", 1, ["c"])]
    assert files.load_keys(files.dump_mschema(tables, fields, fks)).count() == 0


def test_nearly_unique_sets_are_settled_among_the_rows_that_repeat(spark):
    """few rows rule most sets out; the others are settled exactly, sets that
    add a column to one that is nearly a key among the rows that share its tuple."""
    rng = random.Random(5)
    rows = [(i // 4, rng.randrange(300), rng.randrange(300), i % 4 if i > 20 else 0, i % 7, f"{'long ' * 9}{rng.randrange(200)}") for i in range(1200)]
    rows += [(*rows[0][:3], 9, *rows[0][4:])]  # differs in d alone
    tables = {"t": spark.createDataFrame(rows, "a int, b int, c int, d int, e int, f string").repartition(3),
              "u": spark.createDataFrame(rows + rows[:1], "a int, b int, c int, d int, e int, f string")}
    want = plain_keys([dict(zip("abcdef", r)) for r in rows], "abcdef", 3)
    assert any(len(s) == 3 for s in want)
    assert sorted(K.unique_sets(tables, 3, seen=60)) == sorted(("t", s) for s in want) == sorted(K.unique_sets(tables, 3))


def test_sets_are_ruled_out_by_the_rows_of_one_scan(spark, monkeypatch):
    """tuples are made of few rows of a large table, not of all its rows for every set."""
    rng = random.Random(7)
    rows = [(i, i // 3, rng.randrange(900), rng.randrange(5), rng.randrange(40), f"{rng.randrange(2000)}") for i in range(6000)]
    rows = [(i, a, b, i % 3 if i > 30 else 0, c, e) for i, a, b, d, c, e in rows]
    tables = {"t": spark.createDataFrame(rows, "id int, a int, b int, c int, d int, e string").repartition(3).cache()}
    want = [("t", s) for s in plain_keys([dict(zip(["id", *"abcde"], r)) for r in rows], ["id", *"abcde"], 3)]
    assert any(len(s) > 1 for _, s in want)
    read, repeated = [], K._repeated
    monkeypatch.setattr(K, "_repeated", lambda sources: read.extend(x[0].count() for x in sources) or repeated(sources))
    assert sorted(K.unique_sets(tables, 3, seen=200)) == sorted(want)
    assert read and max(read) < 1500
