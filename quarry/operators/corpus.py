"""Corpus normalisation, split, sampling and assembly.

Every random choice is a keyed md5 draw (``quarry.functions.rand``), and every
"first n in shuffled order" is a global rank computed by range partitioning
(``quarry.functions.ranking``), so no step needs one task to see a whole
dataset or a whole database.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.rand import keyed_hash
from quarry.functions.ranking import fill_forward, global_rank, rank_within

PROCESSED_SCHEMA = T.StructType([
    T.StructField("idx", T.LongType()), T.StructField("db_name", T.StringType()),
    T.StructField("question", T.StringType()), T.StructField("evidence", T.StringType()),
    T.StructField("db_schema", T.StringType()), T.StructField("sql", T.StringType()),
])


def _opt(df: DataFrame, name: str) -> F.Column:
    return F.col(name) if name in df.columns else F.lit(None).cast("string")


def normalize_records(raw: DataFrame, generated: DataFrame | None = None,
                      bucket_size: int = 100_000) -> DataFrame:
    """``db_name`` else ``db_id``; ``question``/``evidence``/``sql``
    default ``''``; schema = own, else the latest earlier one for the same
    database (by ``idx``), else ``generated(db_name, db_schema)``.

    ``raw`` needs an integer ``idx`` giving record order.  A missing and a
    null schema are treated alike."""
    # the raw field is ``SQL``; readers that saw both spellings give ``sql``
    sql = _opt(raw, "SQL") if "SQL" in raw.columns else _opt(raw, "sql")
    base = raw.select(
        F.col("idx").cast("long").alias("idx"),
        F.coalesce(_opt(raw, "db_name"), _opt(raw, "db_id")).alias("db_name"),
        F.coalesce(_opt(raw, "question"), F.lit("")).alias("question"),
        F.coalesce(_opt(raw, "evidence"), F.lit("")).alias("evidence"),
        _opt(raw, "db_schema").alias("_own"),
        F.coalesce(sql, F.lit("")).alias("sql"))
    filled = fill_forward(base, "db_name", "idx", "_own", "_carried", bucket_size)
    if generated is not None:
        filled = filled.join(generated.select("db_name", F.col("db_schema").alias("_gen")),
                             "db_name", "left")
    else:
        filled = filled.withColumn("_gen", F.lit(None).cast("string"))
    return filled.select("idx", "db_name", "question", "evidence",
                         F.coalesce("_carried", "_gen").alias("db_schema"), "sql")


def task_info(data_path: str, dialect: str, sum_num_df: DataFrame) -> DataFrame:
    """``(data_name, data_path, sample_num, sum_num, task_name)``; the
    name is the path parts after the first, joined by ``_``, no extension."""
    import os
    stem = os.path.splitext(data_path)[0]
    data_name = "_".join(stem.split("/")[1:])
    return sum_num_df.agg(F.count(F.lit(1)).alias("sum_num")).select(
        F.lit(data_name).alias("data_name"), F.lit(data_path).alias("data_path"),
        F.lit(-1).alias("sample_num"), "sum_num",
        F.lit(f"nl2{dialect.lower()}").alias("task_name"))


def detect_task_name(name: F.Column) -> F.Column:
    """From a file name."""
    n = F.lower(name)
    return (F.when(n.contains("nl2sqlite"), F.lit("nl2sqlite"))
            .when(n.contains("nl2postgres"), F.lit("nl2postgres"))
            .when(n.contains("nl2mysql"), F.lit("nl2mysql"))
            .otherwise(F.lit("nl2sql")))


def random_split(df: DataFrame, key: str, ratio: float = 0.8, seed: int = 42,
                 purpose: str = "split") -> DataFrame:
    """Shuffle by keyed hash; the first ``floor(n * ratio)`` are ``train``."""
    if not 0 < ratio < 1:
        raise ValueError("train ratio must be in (0, 1)")
    h = df.withColumn("_h", keyed_hash(seed, purpose, key))
    r = global_rank(h, ["_h", key], "_r", 0)
    # one number, read from the checkpointed ranks rather than recomputing the input
    top = r.agg(F.max("_r")).first()[0]
    n = 0 if top is None else top + 1
    cut = int(n * ratio)
    return r.withColumn("split", F.when(F.col("_r") < cut, "train").otherwise("test")).drop("_h", "_r")


def stratified_split(df: DataFrame, key: str, group: str = "db_name", ratio: float = 0.8,
                     seed: int = 42, purpose: str = "split") -> DataFrame:
    """C4: per group (missing -> ``'unknown'``) the first
    ``floor(len * ratio)`` in keyed-hash order go to ``train``.  A group of one
    goes wholly to test (kept as in the original)."""
    if not 0 < ratio < 1:
        raise ValueError("train ratio must be in (0, 1)")
    g = df.withColumn("_g", F.coalesce(F.col(group).cast("string"), F.lit("unknown")))
    g = g.withColumn("_h", keyed_hash(seed, purpose, key))
    r = rank_within(g, "_g", ["_h", key], "_rg", "_gn")
    cut = F.floor(F.col("_gn").cast("double") * F.lit(float(ratio)))
    return (r.withColumn("split", F.when(F.col("_rg") < cut, "train").otherwise("test"))
            .drop("_g", "_h", "_rg", "_gn"))


def reindex(df: DataFrame, order_cols: list, start: int = 0, col: str = "idx") -> DataFrame:
    """Sequential ``idx`` from ``start`` in ``order_cols`` order."""
    tmp = df.drop(col) if col in df.columns and col not in order_cols else df
    r = global_rank(tmp, order_cols, "_new", start)
    if col in r.columns:
        r = r.drop(col)
    return r.withColumnRenamed("_new", col)


def split_stats(split_df: DataFrame, group: str = "db_name") -> DataFrame:
    """Rows, percent and distinct groups per split, plus the number of
    groups present in both splits and the groups of one (Q6)."""
    total = split_df.count()
    per = split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"),
                                        F.count_distinct(group).alias("n_dbs"))
    in_both = (split_df.where(F.col("split") == "train").select(group).distinct()
               .intersect(split_df.where(F.col("split") == "test").select(group).distinct())
               .count())  # one number
    return per.select("split", "n_rows",
                      F.round(F.col("n_rows") * 100.0 / F.lit(total), 2).alias("pct"),
                      "n_dbs", F.lit(in_both).cast("long").alias("n_dbs_in_both"))


def sample_n(df: DataFrame, key: str, n: int, seed: int = 42, purpose: str = "sample") -> DataFrame:
    """``n > 0`` -> exactly ``n`` rows without replacement (error if the
    dataset is smaller), else all rows."""
    if n is None or n <= 0:
        return df
    # only keys are ranked and written out; the rows themselves are read once
    r = global_rank(df.select(key).withColumn("_h", keyed_hash(seed, purpose, key)), ["_h", key], "_r", 0)
    top = r.agg(F.max("_r")).first()[0]  # read from the checkpointed ranks
    total = 0 if top is None else top + 1
    if n > total:
        raise ValueError(f"sample of {n} from {total} rows")
    return df.join(r.where(F.col("_r") < n).select(key), key, "left_semi")


def assemble(datasets: list[tuple[str, DataFrame, int]], key: str = "idx", seed: int = 42,
             transform=None) -> DataFrame:
    """In registry order, sample each dataset, optionally transform it
    (augmentation + rendering), and number all rows with one running ``id``
    in (dataset order, row order)."""
    parts = None
    for d_ord, (name, df, sample_num) in enumerate(datasets):
        s = sample_n(df, key, sample_num, seed, f"sample:{name}")
        if transform is not None:
            s = transform(s)
        s = s.withColumn("data_name", F.lit(name)).withColumn("_dord", F.lit(d_ord))
        parts = s if parts is None else parts.unionByName(s, allowMissingColumns=True)
    return global_rank(parts, ["_dord", key], "id", 0).drop("_dord")


def token_length_filter(df: DataFrame, text_col: str, max_tokens: int = 12 * 1024,
                        count_fn=None) -> DataFrame:
    """Drop samples with ``>= max_tokens`` tokens.  ``count_fn`` is a
    plug-in column function (e.g. a tokenizer ``pandas_udf``); the default
    counts word and punctuation runs."""
    n = count_fn(F.col(text_col)) if count_fn else F.size(
        F.regexp_extract_all(F.col(text_col), F.lit(r"(\w+|[^\w\s])"), 0))
    return df.withColumn("n_tokens", n).where(F.col("n_tokens") < max_tokens)


# --- fixed values: prompt-language prefixes of chat sets ---
CN_PREFIX = "你是一名"
EN_PREFIX = "You are"
# --- end of fixed values ---


def chat_inspection(chat: DataFrame) -> DataFrame:
    """C11: sample count by prompt language, over all rows."""
    first = F.col("conversations")[0]["content"]
    lang = (F.when(first.startswith(CN_PREFIX), "zh").when(first.startswith(EN_PREFIX), "en")
            .otherwise("other"))
    return chat.groupBy(lang.alias("language")).agg(F.count(F.lit(1)).alias("n_samples"))
