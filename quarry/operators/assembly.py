"""Assembly of a training set from the dataset registry.

Registry rows are data: all registered files are read in one plan, and every
record follows its dataset's row - how many are sampled, whether they are
augmented, which task's prompt they get. A registry of a hundred datasets is the
same few joins as one of two.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quarry.functions.ranking import global_rank, rank_within
from quarry.operators import prompts
from quarry.operators.augment import augment_record
from quarry.session import scratch_path
from quarry.sources import jsonarrays
from quarry.sources.files import _path_of

RECORD = T.StructType([T.StructField("idx", T.LongType()), *[T.StructField(c, T.StringType()) for c in (
    "db_name", "question", "evidence", "db_schema", "sql")]])


def _kept(df: DataFrame) -> DataFrame:
    """Written once under the shared checkpoint folder."""
    path = scratch_path(df.sparkSession, "assembly")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read_datasets(spark: SparkSession, registry: DataFrame, base: str, schema: T.StructType = RECORD) -> DataFrame:
    """(data_name, record fields) of all registered JSON array files or folders of
    them, paths taken under ``base``. The registry is configuration-sized."""
    entries = [(r.data_name, f"{base.rstrip('/')}/{r.data_path}") for r in registry.select("data_name", "data_path").collect()]
    if not entries:
        return spark.createDataFrame([], T.StructType([T.StructField("data_name", T.StringType()), *schema.fields]))
    found = jsonarrays.elements(spark, [p for _, p in entries])
    plain = spark.createDataFrame(entries, "data_name string, at string").select(
        "data_name", _path_of(F.col("at")).alias("at"))
    at = _path_of(F.col("file"))
    # a file belongs to the entry that names it or its folder
    own = F.broadcast(plain)
    rows = found.join(own, (at == F.col("at")) | at.startswith(F.concat(F.col("at"), F.lit("/"))))
    return rows.select("data_name", F.from_json("text", schema).alias("r")).select("data_name", "r.*")


def sampled(records: DataFrame, key: str = "idx", seed: int = 42) -> DataFrame:
    """C8 for every dataset at once: exactly ``sample_num`` records where that is
    positive, else all. A dataset with fewer is an error."""
    part = records.where("sample_num > 0").select("data_name", key, "sample_num")
    draw = F.md5(F.concat(F.lit(f"{seed}:sample:"), "data_name", F.lit(":"), F.col(key).cast("string")))
    ranked = rank_within(part.withColumn("_h", draw), "data_name", ["_h", key], "_r", "_size")
    short = ranked.where("_size < sample_num").select("data_name", "_size", "sample_num").distinct().collect()
    if short:
        raise ValueError("samples larger than their datasets: " + ", ".join(f"{r.data_name} ({r.sample_num} of {r._size})" for r in short))
    picked = ranked.where("_r < sample_num").select("data_name", key)
    return records.where("sample_num <= 0 OR sample_num IS NULL").unionByName(records.join(picked, ["data_name", key], "left_semi"))


def assemble_registry(records: DataFrame, registry: DataFrame, kind: str = "train", key: str = "idx", seed: int = 42,
                      english: bool = True) -> DataFrame:
    """Chat samples ``(id, data_name, idx, conversations, sql_type, ...)`` of all
    registered datasets in registry order. Records of datasets that are not
    registered are left out."""
    if kind not in ("train", "test"):
        raise ValueError("kind must be train or test")
    # parsed once: the draw, the ranks and the samples each read it
    records = _kept(records.join(registry.select("data_name", "reg_ord", "sample_num", "task_name", "data_aug"), "data_name"))
    plain = _kept(sampled(records, key, seed))
    ids = global_rank(plain.select("data_name", "reg_ord", key), ["reg_ord", "data_name", key], "id", 0)
    plain = plain.join(ids.select("data_name", key, "id"), ["data_name", key])
    aug = F.coalesce("data_aug", F.lit(False))
    rows = plain.where(~aug).unionByName(augment_record(plain.where(aug), seed, key_col=key).select(*plain.columns))
    make = prompts.train_samples if kind == "train" else prompts.test_samples
    chat = make(rows, F.col("task_name"), english)
    return plain.select("id", "data_name", key).join(chat, "id")
