"""Dataset registry (S8, S9, C2): a table keyed by ``data_name``.

Upserts replace a key's row and keep registry order: the new row takes the
old row's position, or goes last when the key is new.

A stored registry is a folder of versions. Spark can't overwrite what it reads,
so a change is a new version folder, and a one-row pointer written after it makes
it the current one: a writer that fails before that leaves the old version
readable, and readers never see half a registry.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

REGISTRY_SCHEMA = T.StructType([
    T.StructField("data_name", T.StringType()), T.StructField("reg_ord", T.IntegerType()),
    T.StructField("data_path", T.StringType()), T.StructField("sample_num", T.LongType()),
    T.StructField("sum_num", T.LongType()), T.StructField("task_name", T.StringType()),
    T.StructField("data_aug", T.BooleanType()),
])


def read_registry(spark: SparkSession, path: str) -> DataFrame:
    """A JSON object ``{name: {data_path, sample_num, ...}}`` -> rows in file
    order (``reg_ord``)."""
    raw = spark.read.option("multiLine", True).text(path, wholetext=True)
    entry = ("struct<data_path:string, sample_num:bigint, sum_num:bigint, task_name:string, "
             "data_aug:boolean>")
    m = raw.select(F.from_json("value", f"map<string,{entry}>").alias("m"))
    # map keys keep JSON order in Spark's map parser
    return m.select(F.posexplode("m").alias("reg_ord", "data_name", "e")).select(
        "data_name", F.col("reg_ord").cast("int").alias("reg_ord"), "e.data_path", "e.sample_num",
        "e.sum_num", "e.task_name", F.coalesce("e.data_aug", F.lit(False)).alias("data_aug"))


def upsert(old: DataFrame, new: DataFrame) -> DataFrame:
    """Replace rows of the same ``data_name``; new names go last (the
    registry is configuration-sized, so its order is fixed by one number)."""
    from pyspark.sql import Window
    top = old.agg(F.coalesce(F.max("reg_ord"), F.lit(-1))).first()[0]
    kept_ord = old.select("data_name", F.col("reg_ord").alias("_old_ord"))
    n = new.drop("reg_ord").join(kept_ord, "data_name", "left")
    fresh = F.row_number().over(Window.orderBy(F.col("_old_ord").isNotNull(), "data_name"))
    n = n.withColumn("reg_ord", F.coalesce("_old_ord", F.lit(top) + fresh).cast("int")).drop("_old_ord")
    return old.join(new.select("data_name"), "data_name", "left_anti").unionByName(
        n.select(*REGISTRY_SCHEMA.fieldNames()))


def split_entry_path(output_dir: str, data_path: str) -> str:
    """S9 path rule: an absolute output dir holding ``/data/`` is cut after it."""
    if os.path.isabs(output_dir) and "/data/" in output_dir:
        base = output_dir[output_dir.index("/data/") + 6:]
        return os.path.join(base, os.path.basename(data_path))
    if not os.path.isabs(data_path):
        return os.path.join(output_dir, os.path.basename(data_path))
    return data_path


def split_entries(input_name: str, output_dir: str, split_counts: DataFrame, task_name: str,
                  data_aug: bool = True, train_suffix: str = "_train",
                  test_suffix: str = "_test", ext: str = ".json") -> DataFrame:
    """Registry rows for a split, keys ``{input}{suffix}``; ``data_aug``
    only for train.  ``split_counts(split, n_rows)`` comes from C6."""
    rows = []
    for split, suffix, aug in (("train", train_suffix, data_aug), ("test", test_suffix, False)):
        path = split_entry_path(output_dir, os.path.join(output_dir, f"{input_name}{suffix}{ext}"))
        rows.append((split, f"{input_name}{suffix}", path, aug))
    keys = split_counts.sparkSession.createDataFrame(
        rows, "split string, data_name string, data_path string, data_aug boolean")
    return (keys.join(split_counts.select("split", "n_rows"), "split", "left")
            .select("data_name", F.lit(None).cast("int").alias("reg_ord"), "data_path",
                    F.lit(-1).cast("long").alias("sample_num"),
                    F.coalesce("n_rows", F.lit(0)).cast("long").alias("sum_num"),
                    F.lit(task_name).alias("task_name"), "data_aug"))


def _pointers(spark: SparkSession, root: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException
    try:
        return spark.read.schema("version string, seq long").parquet(f"{root.rstrip('/')}/current")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _last(spark: SparkSession, root: str):
    p = _pointers(spark, root)
    return None if p is None else p.orderBy(F.col("seq").desc()).first()


def current(spark: SparkSession, root: str) -> DataFrame:
    """The registry as last published; empty if nothing was."""
    last = _last(spark, root)
    if last is None:
        return spark.createDataFrame([], REGISTRY_SCHEMA)
    return spark.read.schema(REGISTRY_SCHEMA).parquet(f"{root.rstrip('/')}/versions/{last.version}")


def publish(registry: DataFrame, root: str) -> str:
    """Store ``registry`` as the current version; returns the version's name. Of two
    writers that publish at once, one fails on the pointer and may try again."""
    import uuid
    spark, root = registry.sparkSession, root.rstrip("/")
    last = _last(spark, root)
    seq = 0 if last is None else last.seq + 1
    version = f"{seq:010d}-{uuid.uuid4().hex[:8]}"
    registry.select(*REGISTRY_SCHEMA.fieldNames()).write.parquet(f"{root}/versions/{version}")
    # the pointer's folder carries its number: writing the same number twice is an error
    spark.range(1).select(F.lit(version).alias("version")).write.mode("errorifexists").parquet(f"{root}/current/seq={seq}")
    return version


def register(new: DataFrame, root: str) -> str:
    """S8 on a stored registry: upsert ``new`` into the current version and publish."""
    return publish(upsert(current(new.sparkSession, root), new), root)
