"""Training-set preparation, the table half only.

The tokenizer and the chat template are plug-ins: ``tokenize`` maps a text
column to ``array<int>``.  The default stays JVM-side - word and punctuation
runs hashed into a vocabulary - so the whole step runs in code generation;
a real tokenizer can be passed as a ``pandas_udf``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.rand import keyed_hash
from quarry.functions.ranking import global_rank
from quarry.session import scratch_path

IGNORE_ID = -100
TOKEN_RE = r"(\w+|[^\w\s])"

# --- fixed values: dialect router codes ---
DIALECT_CODES = {"postgresql": 0, "mysql": 1, "sqlite": 2, "cypher": 3, "ngql": 4}
# --- end of fixed values ---


def default_tokenize(text: Column, vocab_size: int = 151_643) -> Column:
    toks = F.regexp_extract_all(text, F.lit(TOKEN_RE), 1)
    return F.transform(toks, lambda t: F.pmod(F.xxhash64(t), F.lit(vocab_size)).cast("int"))


def chat_text(conversations: Column, n_turns: int | None = None, generation_prompt: bool = False) -> Column:
    """Default chat template: ``<|im_start|>role\\ncontent<|im_end|>\\n`` per
    turn, plus an open assistant turn when asked."""
    turns = conversations if n_turns is None else F.slice(conversations, 1, n_turns)
    body = F.array_join(F.transform(turns, lambda m: F.concat(
        F.lit("<|im_start|>"), m["role"], F.lit("\n"), m["content"], F.lit("<|im_end|>\n"))), "")
    return F.concat(body, F.lit("<|im_start|>assistant\n")) if generation_prompt else body


def label_mask(chat: DataFrame, tokenize=default_tokenize, max_len: int | None = None) -> DataFrame:
    """``input_ids``, ``attention_mask`` and ``labels`` where the prompt's
    tokens (first turn plus the assistant opener) are ``-100``."""
    prompt_ids = tokenize(chat_text(F.col("conversations"), 1, True))
    ids = tokenize(chat_text(F.col("conversations")))
    if max_len:
        ids = F.slice(ids, 1, max_len)
    out = chat.withColumn("input_ids", ids).withColumn("_plen", F.size(prompt_ids))
    return (out.withColumn("labels", F.transform("input_ids", lambda x, i: F.when(
        i < F.col("_plen"), F.lit(IGNORE_ID)).otherwise(x)))
        .withColumn("attention_mask", F.array_repeat(F.lit(1), F.size("input_ids")))
        .drop("_plen"))


def dialect_code(sql_type: Column, n_dialects: int) -> Column:
    """Router code for the dialect (a leading ``nl2`` is dropped, quirk
    Q12), capped at ``n_dialects - 1``; NULL for other types."""
    t = F.regexp_replace(F.lower(sql_type), "^nl2", "")
    expr = None
    for name, code in DIALECT_CODES.items():
        v = F.lit(min(code, n_dialects - 1))
        expr = F.when(t == name, v) if expr is None else expr.when(t == name, v)
    return expr


def route_labels(df: DataFrame, n_dialects: int) -> DataFrame:
    """T2 applied: ``labels[0]`` becomes the dialect code when there is one."""
    code = dialect_code(F.col("sql_type"), n_dialects)
    return df.withColumn("labels", F.when(code.isNull() | (F.size("labels") == 0), F.col("labels"))
                         .otherwise(F.concat(F.array(code), F.slice("labels", 2, 1 << 30))))


def eval_target(db_name: Column, sql_type: Column, target: Column) -> Column:
    """``db_name[sep]sql_type[sep]target``."""
    return F.concat_ws("[sep]", F.coalesce(db_name, F.lit("")), F.coalesce(sql_type, F.lit("postgresql")),
                       target)


def seeded_shuffle(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """T4: a whole-set permutation as a position column ``shuffle_pos``."""
    h = df.withColumn("_h", keyed_hash(seed, "shuffle", key))
    return global_rank(h, ["_h", key], "shuffle_pos", 0).drop("_h")


def length_batches(df: DataFrame, batch_size: int, key: str = "id", max_len: int = 8192,
                   pad_id: int = 0, padding_side: str = "right") -> DataFrame:
    """T5: truncate to ``max_len``, group similar lengths into batches of
    ``batch_size`` (by global length order), and pad ``input_ids`` with
    ``pad_id`` and ``labels`` with -100 to the batch maximum."""
    t = (df.withColumn("input_ids", F.slice("input_ids", 1, max_len))
         .withColumn("labels", F.slice("labels", 1, max_len))
         .withColumn("_len", F.size("input_ids")))
    # lengths and keys are ranked; the token arrays are shuffled once, by key. A range
    # partitioning reads its input twice (sample, then deal), so the lengths are written first
    lengths, path = t.select(key, "_len"), scratch_path(df.sparkSession, "lengths")
    lengths.write.parquet(path)
    r = global_rank(df.sparkSession.read.schema(lengths.schema).parquet(path), ["_len", key], "_r", 0).withColumn("batch", F.floor(F.col("_r") / batch_size))
    mx = r.groupBy("batch").agg(F.max("_len").alias("_mx"))  # one row per batch
    r = t.join(r.join(mx, "batch").drop("_len"), key)

    def pad(col, value):
        fill = F.array_repeat(F.lit(value), (F.col("_mx") - F.size(col)).cast("int"))
        return F.concat(col, fill) if padding_side == "right" else F.concat(fill, col)
    return (r.withColumn("input_ids", pad(F.col("input_ids"), pad_id))
            .withColumn("labels", pad(F.col("labels"), IGNORE_ID))
            .withColumn("attention_mask", pad(F.array_repeat(F.lit(1), F.col("_len")), 0))
            .drop("_r", "_mx"))


def eval_rows(preds: DataFrame, step: int) -> tuple[DataFrame, str]:
    """``(idx, pred_sql, sql)`` and the file stem named by the
    zero-padded step."""
    return preds.select("idx", "pred_sql", "sql"), f"{step:05d}"
