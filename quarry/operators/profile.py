"""Column profiling.

A table is read once per pass, never once per column:

* pass A - one global aggregate holding, for every column, the non-null count,
  min/max/avg/sum (numeric columns only) and the min/max character length of
  the text cast.  Partial aggregation runs map-side, so only one row per task
  crosses the network.
* pass B - every table is unpivoted to ``(table, field, key)`` rows, all
  tables together, and de-duplicated by one shuffle (map-side combine first,
  so a hot value or a low-cardinality column costs one row per task).  Keys are
  typed and short: texts of more than ``SHORT`` characters travel as 128-bit
  digests with their length.  Distinct counts, text lengths and the first ``n``
  values per field (a window group limit, applied before the shuffle) all read
  that one exchange.  Long texts among the first values come from a pass of
  their own in which every task keeps its ``n`` least per field.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.session import scratch_path
from quarry.functions.text import has_url, is_email
from quarry.functions.types import sql_type_name, type_category, type_category_col

PROFILE_STATS = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("field_name", T.StringType()),
    T.StructField("field_ord", T.IntegerType()),
    T.StructField("type_name", T.StringType()),
    T.StructField("type_cate", T.StringType()),
    T.StructField("n_count", T.LongType()),
    T.StructField("max_value", T.DoubleType()),
    T.StructField("min_value", T.DoubleType()),
    T.StructField("avg_value", T.DoubleType()),
    T.StructField("sum_value", T.DoubleType()),
    T.StructField("max_len", T.LongType()),
    T.StructField("min_len", T.LongType()),
])


def _profilable(df: DataFrame):
    """(ord, name, type) of the columns we profile: atomic types only."""
    out = []
    for i, f in enumerate(df.schema.fields):
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            continue
        out.append((i, f.name, f.dataType))
    return out


def value_text(c: Column, dt: T.DataType) -> Column:
    """Text of a value as examples show it (decimals through float)."""
    if isinstance(dt, T.DecimalType):
        return c.cast("double").cast("string")
    return c.cast("string")


def column_stats(table_name: str, df: DataFrame) -> DataFrame:
    """Pass A for one table: one aggregate (no text casts), unpivoted to one
    row per field.  Text lengths come from pass B: the longest value is among
    the distinct values."""
    cols = _profilable(df)
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    for i, name, dt in cols:
        c = F.col(f"`{name}`")
        aggs.append(F.count(c).alias(f"n{i}"))
        if isinstance(dt, T.NumericType):
            d = c.cast("double")
            # integers and decimals also exactly: doubles stop telling them apart at 2^53
            exact = c.cast("decimal(38,0)") if isinstance(dt, T.IntegralType) else c
            aggs += [F.max(d).alias(f"mx{i}"), F.min(d).alias(f"mn{i}"),
                     F.avg(d).alias(f"av{i}"), F.sum(d).alias(f"sm{i}"), F.max(c).cast("string").alias(f"xt{i}"),
                     F.min(c).cast("string").alias(f"nt{i}"), F.sum(exact).cast("string").alias(f"st{i}")]
    wide = df.agg(*aggs)
    rows = []
    for i, name, dt in cols:
        tname = sql_type_name(dt)
        num = isinstance(dt, T.NumericType)
        nul = F.lit(None).cast("double")
        rows.append(F.struct(
            F.lit(table_name).alias("table_name"), F.lit(name).alias("field_name"),
            F.lit(i).alias("field_ord"), F.lit(tname).alias("type_name"),
            F.lit(type_category(tname)).alias("type_cate"),
            F.col("n_rows").alias("n_rows"), F.col(f"n{i}").alias("n_count"),
            (F.col(f"mx{i}") if num else nul).alias("max_value"),
            (F.col(f"mn{i}") if num else nul).alias("min_value"),
            (F.col(f"av{i}") if num else nul).alias("avg_value"),
            (F.col(f"sm{i}") if num else nul).alias("sum_value"),
            *[(F.col(f"{k}{i}") if num else F.lit(None).cast("string")).alias(a)
              for k, a in (("xt", "max_text"), ("nt", "min_text"), ("st", "sum_text"))],
        ))
    return wide.select(F.inline(F.array(*rows)))


def text_lengths(table_name: str, df: DataFrame) -> DataFrame:
    """Longest, shortest, mean and total text length of every text field,
    over all values, in one aggregate."""
    cols = [name for _, name, dt in _profilable(df) if isinstance(dt, T.StringType)]
    n = {c: F.length("`" + c.replace("`", "``") + "`") for c in cols}
    aggs = [f(n[c]).alias(f"{k}{i}") for i, c in enumerate(cols)
            for k, f in (("x", F.max), ("n", F.min), ("a", F.avg), ("s", F.sum))]
    rows = [F.struct(F.lit(table_name).alias("table_name"), F.lit(c).alias("field_name"),
                     F.col(f"x{i}").cast("long").alias("max_len"), F.col(f"n{i}").cast("long").alias("min_len"),
                     F.col(f"a{i}").alias("avg_len"), F.col(f"s{i}").cast("long").alias("sum_len"))
            for i, c in enumerate(cols)]
    return df.agg(*aggs).select(F.inline(F.array(*rows)))


def long_values(table_name: str, df: DataFrame) -> DataFrame:
    """Pass B input: ``(table_name, field_ord, v, num_key)``, non-null values only.

    ``num_key`` orders numeric fields by value rather than by text."""
    cols = _profilable(df)
    structs = []
    for i, name, dt in cols:
        c = F.col(f"`{name}`")
        structs.append(F.struct(
            F.lit(i).alias("field_ord"), value_text(c, dt).alias("v"),
            (c.cast("double") if isinstance(dt, T.NumericType) else F.lit(None).cast("double"))
            .alias("num_key")))
    return (df.select(F.inline(F.array(*structs)))
            .where(F.col("v").isNotNull())
            .select(F.lit(table_name).alias("table_name"), "field_ord", "v", "num_key"))


SHORT = 32  # characters up to which a text is its own key


def _typed_keys(table_name: str, df: DataFrame, only: set | None = None, whole: bool = False) -> DataFrame:
    """``(table_name, field_ord, kl, kd, ks, n_chars)``: one typed key per
    non-null value - integers as long, floats as double, everything else as
    text - so de-duplication hashes short keys and casts nothing.  A long text's
    key is its digest (one character longer than any text that is its own key);
    ``whole`` keeps it as it is."""
    structs = []
    for i, name, dt in _profilable(df):
        if only is not None and (table_name, i) not in only:
            continue
        c = F.col(f"`{name}`")
        integral = isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))
        floating = isinstance(dt, (T.FloatType, T.DoubleType))
        is_text = isinstance(dt, T.StringType)
        text = c.cast("string")
        if is_text and not whole:
            text = F.when(F.length(c) > SHORT, F.concat(F.lit("\u0001"), F.md5(c))).otherwise(c)
        structs.append(F.struct(
            F.lit(i).alias("field_ord"),
            (c.cast("long") if integral else F.lit(None).cast("long")).alias("kl"),
            (c.cast("double") if floating else F.lit(None).cast("double")).alias("kd"),
            (text if not (integral or floating) else F.lit(None).cast("string")).alias("ks"),
            (F.length(c) if is_text else F.lit(None).cast("int")).alias("n_chars")))
    return (df.select(F.inline(F.array(*structs)))
            .where(F.col("kl").isNotNull() | F.col("kd").isNotNull() | F.col("ks").isNotNull())
            .select(F.lit(table_name).alias("table_name"), "field_ord", "kl", "kd", "ks", "n_chars"))


def distinct_values(tables: dict[str, DataFrame], only: set | None = None, whole: bool = False) -> DataFrame:
    """All tables' distinct ``(table_name, field_ord, v, num_key, n_chars)`` in one
    shuffle (typed keys, map-side combine); the text ``v`` is made after
    de-duplication (decimals shown through float, as examples are) and NULL for
    long texts unless ``whole``.  ``n_chars`` is the length of a text value.
    ``only`` restricts it to a set of ``(table_name, field_ord)``."""
    parts = [_typed_keys(n, df, only, whole) for n, df in tables.items()
             if only is None or any(t == n for t, _ in only)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    d = u.distinct()
    decimal_fields = [(n, i) for n, df in tables.items() for i, _, dt in _profilable(df)
                      if isinstance(dt, T.DecimalType)]
    is_dec = F.lit(False)
    for n, i in decimal_fields:
        is_dec = is_dec | ((F.col("table_name") == n) & (F.col("field_ord") == i))
    shown = F.when(is_dec, F.col("ks").cast("double").cast("string")).otherwise(F.col("ks"))
    if not whole:
        shown = F.when(F.coalesce("n_chars", F.lit(0)) <= SHORT, shown)
    text = F.coalesce(F.col("kl").cast("string"), F.col("kd").cast("string"), shown)
    num = F.coalesce(F.col("kl").cast("double"), F.col("kd"),
                     F.when(is_dec, F.col("ks").cast("double")))
    return d.select("table_name", "field_ord", text.alias("v"), num.alias("num_key"), "n_chars", "kl", "ks")


def _least_texts(batches, n: int):
    """The ``n`` least distinct values of every column, over a task's batches."""
    best: dict[str, pa.Array] = {}
    for batch in batches:
        for name, col in zip(batch.schema.names, batch.columns):
            col = col.cast(pa.large_string()).drop_null()
            if name in best and len(best[name]) == n:
                col = col.filter(pc.less(col, best[name][-1]))
            if len(col):
                both = pa.concat_arrays([best[name], col]) if name in best else col
                both = pc.unique(both)
                best[name] = both.take(pc.sort_indices(both)[:n])
    for name, col in best.items():
        yield pa.RecordBatch.from_arrays([pa.array([int(name)] * len(col), pa.int32()), col.cast(pa.string())], ["field_ord", "v"])


def long_examples(tables: dict[str, DataFrame], n: int) -> DataFrame | None:
    """The least long texts of every text field, at most ``n`` from each task."""
    out = None
    for t, df in tables.items():
        cols = [(i, F.col("`" + name.replace("`", "``") + "`")) for i, name, dt in _profilable(df) if isinstance(dt, T.StringType)]
        if not cols:
            continue
        long_ = df.select(*[F.when(F.length(c) > SHORT, c).alias(str(i)) for i, c in cols])
        long_ = long_.where(F.coalesce(*[F.col(f"`{i}`") for i, _ in cols]).isNotNull())
        part = long_.mapInArrow(lambda it: _least_texts(it, n), "field_ord int, v string").select(F.lit(t).alias("table_name"), "field_ord", "v")
        out = part if out is None else out.unionByName(part)
    return out


def first_values(distinct: DataFrame, n: int | None) -> DataFrame:
    """First ``n`` distinct values per field ordered by value -> ``examples``.

    The ``row_number <= n`` filter lets Spark plan a partial window group limit
    below the shuffle, so each task sends at most ``n`` rows per field."""
    key = ["table_name", "field_ord"]
    if n is None:
        ranked = distinct.withColumn("rn", F.lit(0))
    else:
        w = Window.partitionBy(*key).orderBy(F.col("num_key").asc_nulls_last(), F.col("v"))
        ranked = distinct.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    return (ranked.groupBy(*key)
            .agg(F.array_sort(F.collect_list(F.struct(
                F.col("num_key").isNull().alias("k0"), "num_key", "v"))).alias("_e"))
            .select(*key, F.transform("_e", lambda x: x["v"]).alias("examples")))


def examples_to_str(examples: Column, type_cate: Column) -> Column:
    """P18 on an ordered text list: date-like fields keep only their first
    value; a list holding an e-mail address or URL is dropped; empty strings
    are removed."""
    hidden = F.exists(examples, lambda x: is_email(x) | has_url(x))
    kept = (F.when(type_cate == "DateTime", F.slice(examples, 1, 1))
            .when(hidden, F.array().cast("array<string>"))
            .otherwise(examples))
    return F.filter(kept, lambda x: F.length(x) > 0)


def profile(tables: dict[str, DataFrame], n_examples: int | None = 5,
            distinct: DataFrame | None = None) -> DataFrame:
    """One profile row per (table, field): pass A statistics, and from pass
    B the distinct count, the min/max text length and the first
    ``n_examples`` distinct values (P2, P3, P5, P7, P8; ``None``: all but the
    long texts).  ``distinct`` may be
    a persisted :func:`distinct_values` result shared with other steps."""
    stats = None
    for name, df in tables.items():
        s = column_stats(name, df)
        stats = s if stats is None else stats.unionByName(s)
    d = distinct if distinct is not None else distinct_values(tables)
    key = ["table_name", "field_ord"]
    chars = F.coalesce("n_chars", F.length("v"))
    per = d.groupBy(*key).agg(F.count(F.lit(1)).alias("n_distinct"), F.max(chars).alias("_xl"), F.min(chars).alias("_nl"))
    out = stats.join(per, key, "left")
    if n_examples == 0:
        out = out.withColumn("examples", F.lit(None).cast("array<string>"))
    else:
        shown = d.where("v IS NOT NULL").select(*key, "v", "num_key")
        texts = long_examples(tables, n_examples) if n_examples is not None else None
        if texts is not None:
            shown = shown.unionByName(texts.distinct().withColumn("num_key", F.lit(None).cast("double")))
        out = out.join(first_values(shown, n_examples), key, "left")
    return (out.select("table_name", "field_name", "field_ord", "type_name", "type_cate", "n_rows",
                       "n_count", F.coalesce("n_distinct", F.lit(0).cast("long")).alias("n_distinct"),
                       "max_value", "min_value", "avg_value", "sum_value", "max_text", "min_text", "sum_text",
                       F.coalesce(F.col("_xl").cast("long"), F.lit(-1).cast("long")).alias("max_len"),
                       F.coalesce(F.col("_nl").cast("long"), F.lit(-1).cast("long")).alias("min_len"),
                       F.coalesce("examples", F.array().cast("array<string>")).alias("raw_examples"))
            .withColumn("examples", examples_to_str(F.col("raw_examples"), F.col("type_cate"))))


# ------------------------------------------------------------------ probes --

KINDS = ("exact", "float", "text")
EXACT = T.DecimalType(38, 9)


def _kind(dt: T.DataType) -> str:
    if isinstance(dt, (T.IntegralType, T.DecimalType)):
        return "exact"
    return "float" if isinstance(dt, (T.FloatType, T.DoubleType)) else "text"


def _probe_keys(kind: Column, value: Column) -> list[Column]:
    """Typed keys of a probe's text: exact numbers by decimal, floats by double."""
    return [F.when(kind == "exact", value.try_cast(EXACT)).alias("ke"),
            F.when(kind == "float", value.try_cast("double")).alias("kf"), F.when(kind == "text", value).alias("kt")]


def value_exists(tables: dict[str, DataFrame], probes: DataFrame,
                 broadcast_rows: int = 1_000_000) -> DataFrame:
    """``probes(table_name, field_name, value)`` + ``exists`` - whether the
    field holds the value.  Integers and decimals are compared exactly, floats
    as doubles, the rest as text; a probe that is not of the field's kind is
    not there.

    The tables are scanned once, unpivoted, reading the probed fields only."""
    fields = [(t, f.name, i, _kind(f.dataType)) for t, df in tables.items() for i, f in enumerate(df.schema.fields)
              if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    spark = probes.sparkSession
    fdf = spark.createDataFrame(fields, "table_name string, field_name string, field_ord int, kind string")
    p = probes.join(F.broadcast(fdf), ["table_name", "field_name"])  # schema-sized side
    p = p.select("table_name", "field_name", "value", "field_ord", *_probe_keys(F.col("kind"), F.col("value")))
    probed = {(r.table_name, r.field_name) for r in p.select("table_name", "field_name").distinct().collect()}
    vals = None
    for t, df in tables.items():
        structs = []
        for i, f in enumerate(df.schema.fields):
            if (t, f.name) in probed:
                c, k = F.col("`" + f.name.replace("`", "``") + "`"), _kind(f.dataType)
                structs.append(F.struct(
                    F.lit(i).alias("field_ord"), (c.cast(EXACT) if k == "exact" else F.lit(None).cast(EXACT)).alias("ke"),
                    (c.cast("double") if k == "float" else F.lit(None).cast("double")).alias("kf"),
                    (c.cast("string") if k == "text" else F.lit(None).cast("string")).alias("kt")))
        if structs:
            part = df.select(F.inline(F.array(*structs))).select(F.lit(t).alias("table_name"), "field_ord", "ke", "kf", "kt")
            vals = part if vals is None else vals.unionByName(part)
    if vals is None:
        return p.select("table_name", "field_name", "value", F.lit(False).alias("exists"))
    keys = p.select("table_name", "field_ord", "ke", "kf", "kt").distinct()
    small = keys.where(F.coalesce(F.length("kt"), F.lit(0)) <= 1000).count() == keys.count() <= broadcast_rows  # at most 1 KB each
    same = lambda a, b: ((a["table_name"] == b["table_name"]) & (a["field_ord"] == b["field_ord"])
                         & a["ke"].eqNullSafe(b["ke"]) & a["kf"].eqNullSafe(b["kf"]) & a["kt"].eqNullSafe(b["kt"]))
    some = F.col("ke").isNotNull() | F.col("kf").isNotNull() | F.col("kt").isNotNull()
    vals = vals.where(some).alias("v")
    side = (F.broadcast(keys) if small else keys).alias("k")
    hit = vals.join(side, same({c: F.col(f"v.{c}") for c in vals.columns}, {c: F.col(f"k.{c}") for c in vals.columns}), "left_semi")
    hit = hit.distinct().withColumn("exists", F.lit(True)).alias("h")
    q = p.alias("p")
    return (q.join(hit, same({c: F.col(f"p.{c}") for c in vals.columns}, {c: F.col(f"h.{c}") for c in vals.columns}), "left")
            .select("p.table_name", "p.field_name", "p.value", F.coalesce("h.exists", F.lit(False)).alias("exists")))


# ----------------------------------------------------------------- preview --

def truncate_word(c: Column, length: int = 30, suffix: str = "...") -> Column:
    """Cut text longer than ``length`` at a word boundary and add ``suffix``
    (text only; other values are shown whole)."""
    head = F.substr(c, F.lit(1), F.lit(max(length - len(suffix), 0)))
    last = F.substring_index(head, " ", -1)
    before_last = F.substr(head, F.lit(1), F.length(head) - F.length(last) - 1)
    cut = F.when(head.contains(" "), before_last).otherwise(head)
    return F.when(F.length(c) <= length, c).otherwise(F.concat(cut, F.lit(suffix)))


def preview_markdown(df: DataFrame, n: int = 5, max_str_len: int = 30) -> DataFrame:
    """P9 + P10: ``SELECT DISTINCT * LIMIT n`` (ordered by all columns, so the
    sample is deterministic), text cells cut by :func:`truncate_word`, as a
    markdown table; no rows -> ``''``.  The limit is the feature (a preview):
    Spark plans a top-n per task before one small merge."""
    cols = [f for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    names = [f.name for f in cols]
    d = df.select(*[F.col(f"`{c}`") for c in names]).distinct()
    top = d.orderBy(*[F.col(f"`{c}`").asc_nulls_first() for c in names]).limit(n)
    cells = []
    for f in cols:
        c = F.col(f"`{f.name}`")
        txt = truncate_word(c, max_str_len) if isinstance(f.dataType, T.StringType) else c.cast("string")
        cells.append(F.coalesce(txt, F.lit("None")))
    order = F.struct(*[F.col(f"`{c}`") for c in names])
    rows = top.select(order.alias("_o"), F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))
    header = "| " + " | ".join(names) + " |"
    sep = "| " + " | ".join(["---"] * len(names)) + " |"
    agg = rows.agg(F.array_sort(F.collect_list(F.struct("_o", "line"))).alias("ls"))
    return agg.select(F.when(F.size("ls") == 0, F.lit("")).otherwise(F.concat(
        F.lit(header + "\n" + sep + "\n"), F.array_join(F.transform("ls", lambda x: x["line"]), "\n")))
        .alias("markdown"))


# ---------------------------------------------------------- profile block --

def field_profile_text(prof: DataFrame, cat_fields: DataFrame | None = None) -> DataFrame:
    """One text block per (table, field): name, type, comment if any,
    primary key, unique (true for a primary key), nullable, counts, numeric
    max/min/avg, text length max/min, role and date granularity when set,
    and up to 10 value examples (cut to 30 characters).  Lines whose value
    is missing are skipped (``concat_ws`` drops NULLs)."""
    p = prof
    if cat_fields is not None:
        p = p.join(cat_fields.select("table_name", "field_name", "primary_key", "nullable", "unique", "comment",
                                     "dim_or_meas", "date_min_gran"), ["table_name", "field_name"], "left")
    else:
        p = (p.withColumn("primary_key", F.lit(False)).withColumn("nullable", F.col("n_count") < F.col("n_rows"))
             .withColumn("unique", F.lit(False)).withColumn("comment", F.lit(""))
             .withColumn("dim_or_meas", F.lit(None).cast("string"))
             .withColumn("date_min_gran", F.lit(None).cast("string")))

    def line(label, value):
        return F.when(value.isNotNull(), F.concat(F.lit(label), value.cast("string")))

    def b(c):
        return F.when(F.col(c), F.lit("True")).otherwise(F.lit("False"))

    ex = F.slice(F.transform("raw_examples", lambda x: truncate_word(x, 30)), 1, 10)
    text = F.concat_ws(
        "\n", F.lit("[Field]"), line("Name: ", F.col("field_name")), line("Type: ", F.col("type_name")),
        F.when(F.length(F.coalesce("comment", F.lit(""))) > 0, F.concat(F.lit("Description: "), F.col("comment"))),
        F.concat(F.lit("Primary key (alone or with other fields): "), b("primary_key")),
        F.concat(F.lit("UNIQUE: "), F.when(F.col("primary_key") | F.col("unique"), "True").otherwise("False")),
        F.concat(F.lit("NULLABLE: "), b("nullable")),
        line("COUNT: ", F.col("n_count")), line("COUNT(DISTINCT): ", F.col("n_distinct")),
        line("MAX: ", F.col("max_text")), line("MIN: ", F.col("min_text")),
        line("AVG: ", F.col("avg_value")),
        F.when(F.col("max_len") >= 0, F.concat(F.lit("MAX(CHAR_LENGTH): "), F.col("max_len").cast("string"))),
        F.when(F.col("min_len") >= 0, F.concat(F.lit("MIN(CHAR_LENGTH): "), F.col("min_len").cast("string"))),
        F.when(F.col("dim_or_meas").isin("Dimension", "Measure"),
               F.concat(F.lit("Dimension/Measure: "), F.col("dim_or_meas"))),
        line("Smallest date/time unit it may denote: ", F.col("date_min_gran")),
        F.when(F.size(ex) > 0, F.concat(F.lit("Value Examples: ["), F.array_join(ex, ", "), F.lit("]"))))
    return p.select("table_name", "field_name", "field_ord", text.alias("profile_text"))


# ------------------------------------------------------------ enumeration --

def enum_values(tables: dict[str, DataFrame], categories: DataFrame | None = None) -> DataFrame:
    """Every distinct value of the fields labelled ``Enum`` by P13 (or in
    ``categories(table_name, field_name, category)``), however many there are."""
    spark = next(iter(tables.values())).sparkSession
    names = spark.createDataFrame([(t, i, name) for t, df in tables.items() for i, name, _ in _profilable(df)],
                                  "table_name string, field_ord int, field_name string")
    path = scratch_path(spark, "distinct")  # three readers, one shuffle of the tables
    distinct_values(tables).write.parquet(path)
    distinct = spark.read.parquet(path)
    labels = field_categories(tables, distinct=distinct) if categories is None else categories
    enums = names.join(labels.where("category = 'Enum'").select("table_name", "field_name"), ["table_name", "field_name"])
    # only these fields' values are read as they are
    only = {(r.table_name, r.field_ord) for r in enums.select("table_name", "field_ord").collect()}
    if not only:
        return enums.select("table_name", "field_name", "field_ord", F.lit(0).cast("long").alias("n_values"),
                            F.array().cast("array<string>").alias("values"))
    ex = first_values(distinct_values(tables, only, whole=True), None)
    return (enums.join(ex, ["table_name", "field_ord"])
            .select("table_name", "field_name", "field_ord", F.size("examples").cast("long").alias("n_values"),
                    F.col("examples").alias("values")))


# ----------------------------------------------------- category and dates --
# The original asks a language model; here the same labels come from rules
# over the profile, and a user table of overrides can fix any field.

DATE_TEXT_RE = (r"^\d{4}([-/.]\d{1,2}([-/.]\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?)?)?$"
                r"|^\d{8}$|^\d{4}(0[1-9]|1[0-2])(\.0)?$")
INTEGRAL = ["TINYINT", "SMALLINT", "INTEGER", "BIGINT"]


def field_categories(tables: dict[str, DataFrame], prof: DataFrame | None = None,
                     overrides: DataFrame | None = None, enum_max: int = 50,
                     distinct: DataFrame | None = None) -> DataFrame:
    """``(table_name, field_name, category, dim_or_meas)``.  ``distinct``
    may be a written :func:`distinct_values` result shared with other steps.

    * DateTime types -> DateTime; booleans -> Enum.
    * date-like values -> DateTime: text where at least 90% of the distinct
      values look like dates, integers that all look like years (1000-2999)
      or ``yyyymmdd`` days.
    * text -> Enum when it has at most ``enum_max`` distinct values that
      repeat (at most half the count), Text when values exceed 30
      characters, else Code.
    * numbers -> Enum for repeating integers with at most ``enum_max``
      values; Code for unique integers or ``*key``/``*id`` names; Measure
      otherwise.  Only Measure has the Measure role."""
    d = distinct if distinct is not None else distinct_values(tables)
    if prof is None:
        prof = profile(tables, n_examples=0, distinct=d)
    # shapes are read where they count: of texts, and of integers
    share = d.groupBy("table_name", "field_ord").agg(
        F.avg(F.when(F.col("n_chars").isNotNull(), F.coalesce(F.col("v").rlike(DATE_TEXT_RE), F.lit(False))).cast("double")).alias("date_share"),
        F.min(F.when(F.col("kl").isNotNull(),
                     F.col("v").rlike(r"^(19|20)\d{2}(0[1-9]|1[0-2])(0[1-9]|[12]\d|3[01])$")))
        .alias("all_yyyymmdd"))
    p = prof.join(share, ["table_name", "field_ord"], "left")
    abbr = F.upper(F.substring_index("type_name", "(", 1))
    integral = abbr.isin(INTEGRAL)
    repeating = (F.col("n_distinct") <= enum_max) & (F.col("n_distinct") * 2 <= F.col("n_count"))
    name = F.lower("field_name")
    id_like = name.endswith("key") | name.endswith("id")
    unique = (F.col("n_distinct") == F.col("n_count")) & (F.col("n_count") > 0)
    year_like = integral & (F.col("min_value") >= 1000) & (F.col("max_value") <= 2999) & ~id_like
    date_like = (((F.col("type_cate") == "String") & (F.coalesce("date_share", F.lit(0.0)) >= 0.9))
                 | ((F.col("type_cate") == "Number") & (year_like | (integral & F.coalesce("all_yyyymmdd", F.lit(False))))))
    cat = (F.when(F.col("type_cate") == "DateTime", "DateTime")
           .when(F.col("type_cate") == "Bool", "Enum")
           .when((F.col("n_count") > 0) & date_like, "DateTime")
           .when(F.col("type_cate") == "String",
                 F.when(repeating, "Enum").when(F.col("max_len") > 30, "Text").otherwise("Code"))
           .when(F.col("type_cate") == "Number",
                 F.when(integral & repeating & ~id_like, "Enum")
                 .when(integral & (unique | id_like), "Code")
                 .when(integral, "Measure").otherwise("Measure"))
           .otherwise("Code"))
    out = p.select("table_name", "field_name", cat.alias("category"))
    if overrides is not None:
        o = overrides.select("table_name", "field_name", F.col("category").alias("_oc"))
        out = (out.join(o, ["table_name", "field_name"], "left")
               .withColumn("category", F.coalesce("_oc", "category")).drop("_oc"))
    return out.withColumn("dim_or_meas", F.when(F.col("category") == "Measure", "Measure").otherwise("Dimension"))


def _grain_from_micros(m: Column) -> list[tuple[Column, str]]:
    return [((m % 1000) != 0, "MICROSECOND"), ((m % 1_000_000) != 0, "MILLISECOND"),
            ((F.floor(m / 1_000_000) % 60) != 0, "SECOND"), ((F.floor(m / 60_000_000) % 60) != 0, "MINUTE"),
            ((F.floor(m / 3_600_000_000) % 24) != 0, "HOUR")]


def date_granularity(tables: dict[str, DataFrame]) -> DataFrame:
    """P14 for date and timestamp fields: the finest unit that is ever
    non-zero over all values - MICROSECOND, MILLISECOND, SECOND, MINUTE,
    HOUR, else DAY when a day of month other than 1 occurs, MONTH when a
    month other than January occurs, else YEAR.  One aggregate per table."""
    out = None
    for t, df in tables.items():
        aggs, fields = [], []
        for i, name, dt in _profilable(df):
            if not isinstance(dt, (T.DateType, T.TimestampType, T.TimestampNTZType)):
                continue
            c = F.col(f"`{name}`")
            checks = []
            if not isinstance(dt, T.DateType):
                checks = _grain_from_micros(F.unix_micros(c.cast("timestamp")))
            checks += [(F.dayofmonth(c) != 1, "DAY"), (F.month(c) != 1, "MONTH")]
            for j, (cond, unit) in enumerate(checks):
                aggs.append(F.max(cond.cast("int")).alias(f"f{i}_{j}"))
            fields.append((i, name, [u for _, u in checks]))
        if not fields:
            continue
        wide = df.agg(*aggs)
        rows = []
        for i, name, units in fields:
            g = None
            for j, unit in enumerate(units):
                hit = F.col(f"f{i}_{j}") == 1
                g = F.when(hit, F.lit(unit)) if g is None else g.when(hit, F.lit(unit))
            g = g.otherwise(F.when(F.col(f"f{i}_0").isNull(), F.lit(None)).otherwise(F.lit("YEAR")))
            rows.append(F.struct(F.lit(t).alias("table_name"), F.lit(name).alias("field_name"),
                                 g.alias("date_min_gran")))
        part = wide.select(F.inline(F.array(*rows)))
        out = part if out is None else out.unionByName(part)
    return out


# --- fixed values: text shapes and the time unit each one shows ---
TEXT_GRAINS = [
    (r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}\.\d{4,6}$", "MICROSECOND"),
    (r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}\.\d{1,3}$", "MILLISECOND"),
    (r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$", "SECOND"),
    (r"^\d{2}:\d{2}:\d{2}$", "SECOND"),
    (r"^\d{4}-\d{2}-\d{2}$", "DAY"),
    (r"^\d{8}$", "DAY"),
    (r"^\d{4}(0[1-9]|1[0-2])(\.0)?$", "MONTH"),
    (r"^\d{4}-\d{2}$", "MONTH"),
    (r"^\d{4}$", "YEAR"),
]
# --- end of fixed values ---


def text_date_granularity(values: DataFrame, key_cols: list[str], value_col: str = "v") -> DataFrame:
    """P14 for date-like text: each distinct value votes for the unit its
    shape shows (``yyyy-MM`` becomes WEEK when a part exceeds 12); the unit
    with most votes wins, finer units first on ties."""
    v = F.col(value_col)
    unit = None
    for pat, u in TEXT_GRAINS:
        if u == "MONTH" and pat == r"^\d{4}-\d{2}$":
            shown = F.when(F.substring(v, 6, 2).cast("int") > 12, F.lit("WEEK")).otherwise(F.lit("MONTH"))
        else:
            shown = F.lit(u)
        unit = F.when(v.rlike(pat), shown) if unit is None else unit.when(v.rlike(pat), shown)
    unit = unit.otherwise(F.lit("OTHER"))
    from quarry.functions.types import DATE_GRANULARITIES
    order = F.array_position(F.array(*[F.lit(x) for x in reversed(DATE_GRANULARITIES)]), F.col("unit"))
    votes = values.select(*key_cols, value_col).distinct().select(*key_cols, unit.alias("unit"))
    counted = votes.groupBy(*key_cols, "unit").agg(F.count(F.lit(1)).alias("n")).withColumn("o", order)
    return counted.groupBy(*key_cols).agg(F.max_by("unit", F.struct("n", "o")).alias("date_min_gran"))


def label_fields(tables: dict[str, DataFrame], overrides: DataFrame | None = None) -> DataFrame:
    """P13, P14 and P15 as one chain: ``(table_name, field_name, category,
    dim_or_meas, date_min_gran, values)``.  Date and timestamp fields get their
    finest unit from all values, date-like texts and numbers from the shapes of
    their distinct values, Enum fields all their values.  The distinct values are
    written once and shared by the steps."""
    spark = next(iter(tables.values())).sparkSession
    path = scratch_path(spark, "distinct")
    distinct_values(tables).write.parquet(path)
    distinct = spark.read.parquet(path)
    path = scratch_path(spark, "labels")
    field_categories(tables, overrides=overrides, distinct=distinct).write.parquet(path)
    labels = spark.read.parquet(path)
    names = spark.createDataFrame([(t, i, name, sql_type_name(dt)) for t, df in tables.items() for i, name, dt in _profilable(df)],
                                  "table_name string, field_ord int, field_name string, type_name string")
    key = ["table_name", "field_name"]
    shaped = names.join(labels.where("category = 'DateTime'").select(*key), key).where(
        type_category_col(F.col("type_name")) != "DateTime")
    texts = text_date_granularity(distinct.where("v IS NOT NULL").join(shaped, ["table_name", "field_ord"]), key)
    grains = texts.select(*key, "date_min_gran")
    exact = date_granularity(tables)
    if exact is not None:
        grains = grains.unionByName(exact)
    enums = enum_values(tables, labels.select(*key, "category"))
    return (labels.join(grains, key, "left").join(enums.select(*key, "values"), key, "left")
            .select(*key, "category", "dim_or_meas", "date_min_gran", "values"))
