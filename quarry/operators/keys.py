"""Composite keys and foreign keys found in the data.

Unique column sets are searched level by level: a set is tried only if none of
its subsets is a key, so what is found is minimal. Sets are ruled out without
moving a row where the product of their columns' distinct counts (sketches, 1.6 %
standard error) is a fifth below the row count, and by few rows where two of them
repeat a tuple: one scan writes all rows whose values in a set's leading columns
fall in a share of the digests, so of every tuple among them all rows are there.
The sets that no such row rules out count as keys until they are settled exactly, all
tables and levels in one shuffle of tuple digests, 64 bits each: digests that differ
prove a set, the rows of those that repeat are read again and compared by 128 bits.
If a set fails, the search goes on with the sets that contain it.
Where a smaller set is nearly a key, most rows differ in it alone; sets that add a
column to it are settled among the rows that share its tuple.

Foreign keys of several columns start from the inclusions of single columns
(every value of c occurs in p). A tuple of child columns is tried against a
composite key only where each column is included in its partner, and all tuples
are tested in one shuffle in which every tuple digest collects the set of column
tuples that hold it, as bit masks.

What reaches the driver is lists of columns.
"""

from __future__ import annotations

from collections import Counter
from functools import reduce
from itertools import combinations, product
from math import prod

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quarry.functions.types import sql_type_name
from quarry.session import scratch_path

WORD = 62  # column tuples per bit mask
SLACK = 0.8  # share of the rows below which an estimate rules a set out
SEEN = 1 << 16  # rows in which repeated tuples are looked for first
TOGETHER = 16  # sets made in one scan
VALUES = 16  # values of the leading columns in their share, at least
TASK = 1 << 20  # digests of a task
NEAR = 1 / 16  # share of the rows up to which a set is nearly a key
KEY_TYPES = ["TINYINT", "SMALLINT", "INTEGER", "BIGINT", "TEXT"]


def _col(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _atomic(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType))]


def _sizes(tables: dict[str, DataFrame]) -> tuple[dict[str, tuple[int, list[str]]], dict[tuple[str, str], float]]:
    """Rows, and the columns without nulls, of every table; and about how many distinct
    values these have. One aggregate a table, all in one job."""
    rows = None
    for t, df in tables.items():
        cols = [_col(c) for c in _atomic(df)]
        part = df.agg(F.count(F.lit(1)).alias("n"), F.array(*map(F.count, cols)).cast("array<long>").alias("counts"), F.array(*[
            F.hll_sketch_estimate(F.hll_sketch_agg(F.xxhash64(c), F.lit(12))) for c in cols]).cast("array<double>").alias("about"))
        part = part.select(F.lit(t).alias("t"), "*")
        rows = part if rows is None else rows.union(part)
    sizes, about = {}, {}
    for r in rows.collect() if rows is not None else []:
        whole = [(c, e) for c, m, e in zip(_atomic(tables[r.t]), r.counts, r.about) if m == r.n]
        sizes[r.t] = r.n, [c for c, _ in whole]
        about |= {(r.t, c): e for c, e in whole}
    return sizes, about


def _short(df: DataFrame, c: str) -> Column:
    """A column's value, or a digest of it where it is a long text."""
    x = _col(c)
    return (F.when(F.length(x) > 32, F.md5(x)).otherwise(x) if isinstance(df.schema[c].dataType, T.StringType) else x).alias(c)


def _digests(s: tuple[str, ...]) -> list[Column]:
    return [F.xxhash64(*map(_col, s)).alias("h1"), F.xxhash64(F.lit(7), *map(_col, s)).alias("h2")]


def _repeated(sources: list[tuple[DataFrame, dict[int, tuple[str, ...]]]]) -> dict[int, int]:
    """By number, the rows of a numbered set that share their tuple with another row;
    one shuffle for all sources (rows, sets)."""
    rows = None
    for df, sets in sources:
        numbers = list(sets)
        for i in range(0, len(numbers), TOGETHER):
            part = df.select(F.inline(F.array(*[F.struct(F.lit(no).alias("no"), *_digests(sets[no])) for no in numbers[i:i + TOGETHER]])))
            rows = part if rows is None else rows.union(part)
    if rows is None:
        return {}
    again = rows.groupBy("no", "h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return {r["no"]: r["n"] for r in again.groupBy("no").agg(F.sum("n").alias("n")).collect()}


def _leading(about: dict, t: str, s: tuple[str, ...], share: int) -> tuple[str, ...]:
    """The fewest of a set's columns, most values first, whose values are enough for a share of them."""
    cols = sorted(s, key=lambda c: (-about[t, c], c))
    return next((tuple(cols[:i]) for i in range(1, len(cols)) if prod(about[t, c] for c in cols[:i]) >= VALUES * share), tuple(cols))


def _seen(df: DataFrame, cols: list[str], leading: list[tuple[str, ...]], share: int) -> DataFrame:
    """The rows whose values in one of ``leading`` fall in a share of their digests, and
    in which of them (``_at``); written once."""
    hit = [F.pmod(F.xxhash64(*map(_col, a)), F.lit(share)) == 0 for a in leading]
    path = scratch_path(df.sparkSession, "seen")
    (df.where(reduce(lambda a, b: a | b, hit))
     .select(*[_short(df, c) for c in cols], F.array(*[F.when(h, F.lit(i)) for i, h in enumerate(hit)]).alias("_at")).write.parquet(path))
    return df.sparkSession.read.parquet(path)


def _sharing(tables: dict[str, DataFrame], sizes: dict, sets: list[tuple[str, tuple[str, ...]]]) -> dict:
    """Of every set that is no key by its 64-bit digests, the rows that share theirs with another row."""
    if not sets:
        return {}
    spark = next(iter(tables.values())).sparkSession
    mine = {t: {i: s for i, (u, s) in enumerate(sets) if u == t} for t in dict.fromkeys(t for t, _ in sets)}

    def digests(t, *cols):
        return tables[t].select(*cols, F.inline(F.array(*[F.struct(F.lit(i).alias("_no"), F.xxhash64(*map(_col, s)).alias("_h")) for i, s in mine[t].items()])))

    rows = reduce(DataFrame.union, [digests(t) for t in mine])
    # nearly all differ: dealt before they are counted, a million to a task
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), sum(sizes[t][0] for t, _ in sets) // TASK)
    path = scratch_path(spark, "repeated")
    (rows.repartition(parts, "_h").groupBy("_no", "_h").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
     .select("_no", "_h").write.parquet(path))
    again = spark.read.schema("_no int, _h long").parquet(path)
    some = {r["_no"] for r in again.select("_no").distinct().collect()}
    out = {}
    for t in mine:
        mine[t] = {i: s for i, s in mine[t].items() if i in some}
        if mine[t]:
            path = scratch_path(spark, "sharing")
            (digests(t, *[_short(tables[t], c) for c in sizes[t][1]])
             .join(again.where(F.col("_no").isin(list(mine[t]))), ["_no", "_h"], "left_semi").drop("_h").write.partitionBy("_no").parquet(path))
            kept = spark.read.parquet(path)
            out |= {(t, s): kept.where(F.col("_no") == i).drop("_no") for i, s in mine[t].items()}
    return out


def unique_sets(tables: dict[str, DataFrame], width: int = 3, seen: int = SEEN) -> list[tuple[str, tuple[str, ...]]]:
    """(table, columns) of all minimal sets of at most ``width`` columns without
    nulls whose tuples are all different. Tables without rows have none. ``seen``:
    rows of a table in which a set's repeated tuples are looked for first."""
    sizes, about = _sizes(tables)
    shares = {t: max(1, sizes[t][0] // seen) for t in tables}
    # a set has at most the product of its columns' values
    level = {k: [(t, s) for t in tables for s in combinations(sizes[t][1], k)
                 if sizes[t][0] and prod(about[t, c] for c in s) >= SLACK * sizes[t][0]] for k in range(1, width + 1)}
    number = {x: i for i, x in enumerate(x for k in level for x in level[k])}
    lead = {(t, s): _leading(about, t, s, shares[t]) for t, s in number if shares[t] > 1}
    leading = {t: list(dict.fromkeys(a for (u, _), a in lead.items() if u == t)) for t in tables}
    some_rows = {t: _seen(tables[t], sizes[t][1], leading[t], shares[t]) for t in tables if leading[t]}

    def repeated(of: dict, chosen: list) -> dict:
        """For sets of one source each, the rows of it that share a set's tuple."""
        by: dict = {}
        for x in chosen:
            by.setdefault(of[x], {})[number[x]] = x[1]
        n = _repeated([(rows[y], sets) for y, sets in by.items()])
        return {x: n.get(number[x], 0) for x in chosen}

    # sources of sets: whole tables, rows of a share, and later, by a set, the rows that share its tuple
    rows: dict = {(t,): tables[t] for t in tables}
    rows |= {(t, a, shares[t]): some_rows[t].where(F.col("_at")[i].isNotNull()) for t in some_rows for i, a in enumerate(leading[t])}
    source = {(t, s): (t, lead[t, s], shares[t]) if (t, s) in lead else (t,) for t, s in number}
    some: dict = {}  # rows seen that share a set's tuple
    exact: dict = {}  # all rows that do; none: a key
    while True:
        found: list[tuple[str, tuple[str, ...]]] = []
        for k in level:
            open_ = [(t, s) for t, s in level[k] if not any(u == t and set(key) <= set(s) for u, key in found)]
            new = repeated(source, [x for x in open_ if x not in some])
            some |= new
            exact |= {x: n for x, n in new.items() if x not in lead}
            found += [x for x in open_ if not some[x] and not exact.get(x)]
        rest = [x for x in found if x not in exact]
        if not rest:
            break
        base: dict = {}
        for t, s in rest:
            near = {b: exact.get(b) or some[b] * shares[t] for b in ((t, x) for x in combinations(s, len(s) - 1)) if b in some}
            if near and min(near.values()) <= NEAR * sizes[t][0]:
                base[t, s] = min(near, key=lambda b: (near[b], b))
        users = Counter(base.values())
        # settling a base for one set alone saves nothing
        base = {x: b for x, b in base.items() if b in rows or users[b] > 1}
        whole = list(dict.fromkeys([x for x in rest if x not in base] + [b for b in base.values() if b not in rows]))
        sharing = _sharing(tables, sizes, whole)
        rows |= sharing
        exact |= {x: 0 for x in whole} | repeated({x: x for x in sharing}, list(sharing)) | repeated(base, list(base))
    order = list(tables)
    return sorted(found, key=lambda x: (order.index(x[0]), len(x[1]), [tables[x[0]].columns.index(c) for c in x[1]]))


def key_rows(spark, db: str, found: list[tuple[str, tuple[str, ...]]], kind: str = "unique") -> DataFrame:
    """Found keys as catalog rows (db, table_name, kind, key_ord, fields)."""
    return spark.createDataFrame([(db, t, kind, i, list(s)) for i, (t, s) in enumerate(found)],
                                 "db string, table_name string, kind string, key_ord int, fields array<string>")


def common_values(tables: dict[str, DataFrame], columns: list[tuple[str, Column, Column]]) -> tuple[DataFrame, DataFrame]:
    """For numbered ``columns`` (table, long key, text key; a value has one of
    them): (child, parent, common) distinct values held by both, and (col,
    n_count, n_rows).

    One shuffle of values: each distinct value gets the set of columns that hold
    it, as bit masks combined on the map side (a value in all rows is one row per
    task). Values with the same set are counted together; no value is joined."""
    words = range(-(-max(len(columns), 1) // WORD))
    values = sizes = None
    for t, df in tables.items():
        mine = [(i, kl, ks) for i, (u, kl, ks) in enumerate(columns) if u == t]
        if not mine:
            continue
        v = df.select(F.inline(F.array(*[F.struct(
            kl.cast("long").alias("kl"), ks.cast("string").alias("ks"),
            *[F.lit(1 << i % WORD if i // WORD == w else 0).cast("long").alias(f"m{w}") for w in words])
            for i, kl, ks in mine]))).where("kl IS NOT NULL OR ks IS NOT NULL")
        s = df.agg(F.array(*[F.struct(F.lit(i).alias("col"), F.count(F.coalesce(kl.cast("string"), ks)).alias("n_count"),
                                      F.count(F.lit(1)).alias("n_rows")) for i, kl, ks in mine]).alias("c")).select(F.inline("c"))
        values = v if values is None else values.unionByName(v)
        sizes = s if sizes is None else sizes.unionByName(s)
    masks = [f"m{w}" for w in words]
    sets = (values.groupBy("kl", "ks").agg(*[F.bit_or(m).alias(m) for m in masks])
            .groupBy(*masks).agg(F.count(F.lit(1)).alias("n")))
    bits = F.filter(F.sequence(F.lit(0), F.lit(len(columns) - 1)), lambda i: F.element_at(
        F.array(*masks), F.floor(i / WORD).cast("int") + 1)
        .bitwiseAND(F.element_at(F.array(*[F.lit(1 << b).cast("long") for b in range(WORD)]), (i % WORD).cast("int") + 1)) != 0)
    held = sets.select("n", bits.alias("held"))
    common = (held.select("n", "held", F.explode("held").alias("child")).select("n", "child", F.explode("held").alias("parent"))
              .groupBy("child", "parent").agg(F.sum("n").alias("common")))
    return common, sizes


def _included(common: DataFrame) -> set[tuple[int, int]]:
    """(child, parent) with every value of the child in the parent; schema-sized."""
    own = common.where("child = parent").select("child", F.col("common").alias("n"))
    return {(r.child, r.parent) for r in common.where("child <> parent").join(own, "child").where("common = n").collect()}


def _ranges(tables: dict[str, DataFrame], cols: list[tuple[str, str]]) -> dict[tuple[str, str], tuple]:
    """Least and greatest value, as long or text key, of columns with values: one aggregate a table."""
    out = {}
    for t, df in tables.items():
        mine = [c for u, c in cols if u == t]
        if mine:
            r = df.agg(*[f(_short(df, c)) for c in mine for f in (F.min, F.max)]).first()
            out |= {(t, c): (r[2 * i], r[2 * i + 1]) for i, c in enumerate(mine) if r[2 * i] is not None}
    return out


def _possible(tables: dict[str, DataFrame], typed: dict[tuple[str, str], str], parents: set[tuple[str, str]]) -> list[tuple[str, str]]:
    """The columns that an inclusion in one of ``parents`` can concern: a child's values
    lie between its parent's least and greatest, and texts compare as their bytes."""
    types = {typed[p] for p in parents}
    span = _ranges(tables, [x for x in typed if typed[x] in types])
    key = lambda v: v.encode("utf-8", "surrogatepass") if isinstance(v, str) else v
    found = [(c, p) for p in parents if p in span for c in span if c != p and typed[c] == typed[p]
             and key(span[p][0]) <= key(span[c][0]) and key(span[c][1]) <= key(span[p][1])]
    some = {x for pair in found for x in pair}
    return [x for x in typed if x in some]


def composite_fks(tables: dict[str, DataFrame], keys: list[tuple[str, tuple[str, ...]]]) -> list[tuple[str, tuple, str, tuple]]:
    """(table, columns, ref_table, ref_columns): every value of each of the child's
    columns occurs in its partner, and every tuple without nulls occurs in the
    composite key ``ref_columns``. Columns agree in type; a key's columns keep
    their order."""
    cols = [(t, f.name, sql_type_name(f.dataType)) for t, df in tables.items() for f in df.schema.fields
            if sql_type_name(f.dataType) in KEY_TYPES]
    typed = {(t, c): ty for t, c, ty in cols}
    parents = [(t, s) for t, s in keys if len(s) > 1 and all((t, c) in typed for c in s)]
    if not parents:
        return []

    def text(t, c):
        x = _col(c)
        return F.when(F.length(x) > 32, F.md5(x)).otherwise(x) if typed[t, c] == "TEXT" else x.cast("string")

    # only columns that can be a child or a parent send their values: integers as they are, as pairs agree in type
    near = _possible(tables, typed, {(t, c) for t, s in parents for c in s})
    inside: dict[tuple[str, str], list[tuple[str, str]]] = {}
    if near:
        common, _ = common_values(tables, [(t, F.lit(None), text(t, c)) if typed[t, c] == "TEXT" else (t, _col(c), F.lit(None)) for t, c in near])
        for child, parent in _included(common):
            inside.setdefault(near[parent], []).append(near[child])
    pairs = []  # (child table, columns, parent number)
    for n, (t, s) in enumerate(parents):
        for u in tables:
            # a column is included in itself
            partners = [[c for v, c in inside.get((t, p), []) + [(t, p)] if v == u and typed[u, c] == typed[t, p]] for p in s]
            pairs += [(u, tup, n) for tup in product(*partners) if len(set(tup)) == len(tup) and (u, tup) != (t, s)]
    tuples = list(dict.fromkeys(parents + [(u, tup) for u, tup, _ in pairs]))
    if not pairs:
        return []
    number = {x: i for i, x in enumerate(tuples)}

    def digest(t, s):
        whole = F.md5(F.to_json(F.array(*[text(t, c) for c in s])))
        absent = F.lit(False)
        for c in s:
            absent = absent | _col(c).isNull()
        return F.when(~absent, F.concat(F.lit(",".join(typed[t, c] for c in s) + ":"), whole))

    common, sizes = common_values(tables, [(t, F.lit(None), digest(t, s)) for t, s in tuples])
    held = _included(common)
    some = {r["col"] for r in sizes.where("n_count > 0").collect()}
    return sorted((u, tup, *parents[n]) for u, tup, n in pairs
                  if number[u, tup] in some and (number[u, tup], number[parents[n]]) in held)
