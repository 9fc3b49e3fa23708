"""File sources and sinks at the edges of the corpus work.

Between stages everything is Parquet; JSON and text appear only where the
corpus enters or leaves.  Order is carried by an ``idx``/``id`` column, never
by file position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.jsonarrays import elements

RAW_SCHEMA = T.StructType([
    T.StructField("db_id", T.StringType()), T.StructField("db_name", T.StringType()),
    T.StructField("question", T.StringType()), T.StructField("evidence", T.StringType()),
    T.StructField("SQL", T.StringType()), T.StructField("sql", T.StringType()),
    T.StructField("db_schema", T.StringType()),
])

_WS = r"^\s+|\s+$"


def _parse(value: F.Column, schema: T.DataType, rename: dict[str, str] | None = None) -> F.Column:
    """``from_json`` with exact field names; ``rename`` then relabels fields
    by position (a struct cast), so ``SQL`` and ``sql`` can both be read."""
    parsed = F.from_json(value, schema)
    if not rename:
        return parsed
    st = schema.elementType if isinstance(schema, T.ArrayType) else schema
    renamed = T.StructType([T.StructField(rename.get(f.name, f.name), f.dataType) for f in st.fields])
    target = T.ArrayType(renamed) if isinstance(schema, T.ArrayType) else renamed
    return parsed.cast(target)


# raw files may carry both spellings; ``SQL`` is read as ``SQL_upper``
RAW_RENAME = {"SQL": "SQL_upper"}


def read_json_array(spark: SparkSession, path: str, schema: T.StructType,
                    rename: dict[str, str] | None = None) -> DataFrame:
    """Files each holding one JSON array of objects, with ``_file``
    and ``_pos`` (position in the array).  Large files are read by many tasks
    (``quarry.sources.jsonarrays``)."""
    items = elements(spark, path).select(F.col("file").alias("_file"), F.col("pos").alias("_pos"),
                                         _parse(F.col("text"), schema, rename).alias("r"))
    return items.select("_file", "_pos", "r.*")


def read_raw_records(spark: SparkSession, path: str) -> DataFrame:
    """S1 for raw question/SQL records: ``idx`` is the record's position
    (file by file, then array position); ``sql`` = ``SQL`` else ``sql``."""
    from quarry.functions.ranking import global_rank
    df = read_json_array(spark, path, RAW_SCHEMA, RAW_RENAME)
    df = global_rank(df, ["_file", "_pos"], "idx", 0).drop("_file", "_pos")
    return df.withColumn("sql", F.coalesce("SQL_upper", "sql")).drop("SQL_upper")


def write_json_lines(df: DataFrame, path: str, order_col: str | None = None) -> None:
    """JSON lines (UTF-8, not escaped); order is carried by a column."""
    w = df.sortWithinPartitions(order_col) if order_col else df
    w.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType,
                    rename: dict[str, str] | None = None) -> DataFrame:
    """S3: one JSON object per line (splittable), parsed with a fixed schema."""
    return spark.read.text(path).select(_parse(F.col("value"), schema, rename).alias("r")).select("r.*")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines stripped of surrounding white space (tabs too)."""
    return spark.read.text(path).select(F.regexp_replace("value", _WS, "").alias("value"))


def _path_of(uri: Column) -> Column:
    """The path in a file URI or plain path, escapes decoded."""
    plain = F.regexp_replace(uri, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    return F.when(uri.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.url_decode(F.replace(plain, F.lit("+"), F.lit("%2B")))).otherwise(plain)


def read_whole_texts(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Each file as one value; a missing path gives ``''``.

    Files are read per parent folder with a name filter (a missing folder
    contributes nothing), then left-joined onto the expected paths by the
    decoded path, so names with spaces and any file system's scheme match."""
    import posixpath
    import re
    from pyspark.errors import AnalysisException
    by_dir: dict[str, list[str]] = {}
    for p in paths:
        by_dir.setdefault(posixpath.dirname(p), []).append(posixpath.basename(p))
    got = None
    for d, names in by_dir.items():
        glob = "{" + ",".join(re.sub(r"([\\{}\[\],*?])", r"\\\1", n) for n in names) + "}"
        try:
            part = (spark.read.option("pathGlobFilter", glob).text(d, wholetext=True)
                    .select(_path_of(F.col("_metadata.file_path")).alias("_at"), "value"))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        got = part if got is None else got.unionByName(part)
    expected = spark.createDataFrame([(p, re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", p)) for p in paths],
                                     "path string, _at string")
    if got is None:
        return expected.select("path", F.lit("").alias("text"))
    return expected.join(got, "_at", "left").select("path", F.coalesce("value", F.lit("")).alias("text"))


def save_lines(df: DataFrame, col: str, path: str) -> None:
    """Newline-joined lines."""
    df.select(F.col(col).cast("string")).write.mode("overwrite").text(path)


def read_map_file(spark: SparkSession, path: str) -> DataFrame:
    """TSV ``key \\t a、b、c`` -> ``(key, values=[a, b, c, key])``.  For a
    duplicated key the last line wins (by line position)."""
    lines = spark.read.text(path).select(
        F.regexp_replace("value", _WS, "").alias("line"),
        F.monotonically_increasing_id().alias("_pos"))
    parts = lines.select("_pos", F.split("line", "\t").alias("p")).where(F.size("p") >= 2)
    kv = parts.select("_pos", F.col("p")[0].alias("key"),
                      F.array_append(F.split(F.col("p")[1], "、"), F.col("p")[0]).alias("values"))
    return (kv.groupBy("key").agg(F.max_by("values", "_pos").alias("values")))


def schema_files(processed: DataFrame, path: str) -> None:
    """One schema text per database, written under ``db_name=...``.
    The schema kept per database is the one of its last record (C1's rule)."""
    last = processed.groupBy("db_name").agg(F.max_by("db_schema", "idx").alias("db_schema"))
    last.write.mode("overwrite").partitionBy("db_name").text(path)


MSCHEMA_DUMP = T.StructType([
    T.StructField("db_id", T.StringType()), T.StructField("schema", T.StringType()),
    T.StructField("tables", T.MapType(T.StringType(), T.StructType([
        T.StructField("fields", T.MapType(T.StringType(), T.StructType([
            T.StructField("type", T.StringType()), T.StructField("primary_key", T.BooleanType()),
            T.StructField("nullable", T.BooleanType()), T.StructField("default", T.StringType()),
            T.StructField("autoincrement", T.BooleanType()), T.StructField("unique", T.BooleanType()),
            T.StructField("comment", T.StringType()),
            T.StructField("examples", T.ArrayType(T.StringType())),
            T.StructField("category", T.StringType()), T.StructField("dim_or_meas", T.StringType()),
        ]))),
        T.StructField("examples", T.ArrayType(T.StringType())),
        T.StructField("comment", T.StringType()),
        T.StructField("unique_keys", T.ArrayType(T.ArrayType(T.StringType()))),
        T.StructField("keys", T.ArrayType(T.ArrayType(T.StringType()))),
    ]))),
    T.StructField("foreign_keys", T.ArrayType(T.ArrayType(T.StringType()))),
])


def dump_mschema(cat_tables: DataFrame, cat_fields: DataFrame, cat_fks: DataFrame, cat_keys: DataFrame | None = None) -> DataFrame:
    """S11 dump: catalog tables -> one nested row per database.  ``cat_keys``:
    (db, table_name, kind, key_ord, fields) with the kinds ``unique`` and ``index``."""
    def in_order(ordinal, name, value):
        """A map whose entries follow ``ordinal``, however the rows arrive."""
        rows = F.array_sort(F.collect_list(F.struct(F.col(ordinal).alias("o"), F.col(name).alias("k"))))
        values = F.map_from_entries(F.collect_list(F.struct(name, value)))
        return F.map_from_entries(F.transform(rows, lambda x: F.struct(x["k"], F.element_at(values, x["k"]))))

    f = cat_fields.groupBy("db", "table_name").agg(in_order("field_ord", "field_name", F.struct(
        "type", "primary_key", "nullable", "default", "autoincrement", "unique", "comment", "examples", "category",
        "dim_or_meas")).alias("fields"))
    named = {"unique": "unique_keys", "index": "keys"}
    none = F.array().cast("array<array<string>>")
    if cat_keys is None:
        tables = cat_tables.withColumns({n: none for n in named.values()})
    else:
        k = cat_keys.groupBy("db", "table_name").agg(*[F.transform(F.array_sort(F.collect_list(F.when(
            F.col("kind") == kind, F.struct("key_ord", "fields")))), lambda x: x["fields"]).alias(n) for kind, n in named.items()])
        tables = cat_tables.join(k, ["db", "table_name"], "left").withColumns({n: F.coalesce(n, none) for n in named.values()})
    t = (tables.join(f, ["db", "table_name"], "left")
         .groupBy("db", "schema").agg(in_order("table_ord", "table_name", F.struct(
             "fields", F.array().cast("array<string>").alias("examples"),
             F.coalesce("comment", F.lit("")).alias("comment"), "unique_keys", "keys")).alias("tables")))
    k = cat_fks.groupBy("db").agg(F.transform(F.array_sort(F.collect_list(F.struct(
        "fk_ord", F.array("table_name", "field_name", "ref_schema", "ref_table", "ref_field").alias("a")))),
        lambda x: x["a"]).alias("foreign_keys"))
    return (t.join(k, "db", "left")
            .select(F.coalesce("db", F.lit("Anonymous")).alias("db_id"), "schema", "tables",
                    F.coalesce("foreign_keys", F.array().cast("array<array<string>>")).alias("foreign_keys")))


def load_mschema(dump: DataFrame):
    """S11 load: nested rows -> (catalog_tables, catalog_fields, catalog_fks)."""
    t = dump.select("db_id", "schema", F.posexplode("tables").alias("table_ord", "table_name", "t"))
    tables = t.select(F.col("db_id").alias("db"), "schema", "table_name",
                      F.col("table_ord").cast("int").alias("table_ord"), F.lit("table").alias("table_type"),
                      F.coalesce("t.comment", F.lit("")).alias("comment"))
    f = t.select(F.col("db_id").alias("db"), "table_name",
                 F.posexplode("t.fields").alias("field_ord", "field_name", "p"))
    fields = f.select("db", "table_name", "field_name", F.col("field_ord").cast("int").alias("field_ord"),
                      "p.*", F.lit(None).cast("string").alias("date_min_gran"),
                      F.create_map().cast("map<string,string>").alias("value_mapping"))
    k = dump.select(F.col("db_id").alias("db"), F.posexplode("foreign_keys").alias("fk_ord", "a"))
    fks = k.select("db", F.col("fk_ord").cast("int").alias("fk_ord"), F.col("a")[0].alias("table_name"),
                   F.col("a")[1].alias("field_name"), F.col("a")[2].alias("ref_schema"),
                   F.col("a")[3].alias("ref_table"), F.col("a")[4].alias("ref_field"))
    return tables, fields, fks


def load_keys(dump: DataFrame) -> DataFrame:
    """S11 load, unique keys and indexes: (db, table_name, kind, key_ord, fields);
    dumps without them have none."""
    t = dump.select(F.col("db_id").alias("db"), F.explode("tables").alias("table_name", "t"))
    part = lambda kind, name: t.select("db", "table_name", F.lit(kind).alias("kind"), F.posexplode(F.col("t")[name]).alias("key_ord", "fields"))
    return part("unique", "unique_keys").union(part("index", "keys"))
