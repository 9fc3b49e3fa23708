"""Streaming queries: chat samples and resumable prediction."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.operators import predict as PR
from quarry.operators import prompts as G
from quarry.plans.fixtures import F2_SQL, F3_SQL, PROCESSED_SQL, processed, replies, schema_texts
from quarry.plans.schema_queries import CHAIN_SQL
from quarry.plans.train_queries import VALS, fill_sql
from quarry.session import scratch_path
from quarry.streaming.chat import chat_samples

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, oracle):
    def deco(fn):
        QUERIES[name], ORACLES[name] = fn, oracle
        return fn
    return deco


def _stored(df: DataFrame, name: str, files: int) -> tuple[DataFrame, str]:
    """``df`` written as some files, as a stream that reads two of them at a time."""
    path = scratch_path(df.sparkSession, name)
    df.repartition(files).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(path), path


# every record gets the schema text of its database's last record
F3_BY_DB = f"SELECT idx, db_name, sql, arg_max(db_schema, idx) OVER (PARTITION BY db_name) AS db_schema FROM ({F3_SQL})"


@register("stream_chat_train", f"""WITH aug AS ({CHAIN_SQL.replace(F3_SQL, F3_BY_DB)} SELECT idx, db_schema FROM out),
r AS (SELECT p.idx, p.db_name, question, evidence, sql, aug.db_schema, '' AS error_sql, '' AS error_info FROM ({PROCESSED_SQL}) p JOIN aug ON aug.idx = p.idx)
SELECT idx AS id, 'nl2sqlite' AS sql_type, 2 AS code, concat_ws('[sep]', db_name, 'nl2sqlite', sql) AS target,
 {fill_sql(G.TEMPLATES[('nl2sqlite', 'en')], VALS)} AS prompt, chr(10) || sql || chr(10) || '```' AS answer FROM r""")
def stream_chat_train_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records arrive in files; schemas are a table of one text per database."""
    texts = schema_texts(spark, sf_dir).groupBy("db_name").agg(F.max_by("db_schema", "idx").alias("db_schema"))
    kept = scratch_path(spark, "schemas")
    texts.write.parquet(kept)
    stream, _ = _stored(processed(spark, sf_dir).drop("db_schema"), "records", 6)
    chat = chat_samples(stream, spark.read.parquet(kept), "nl2sqlite")
    out = scratch_path(spark, "chat")
    query = (chat.writeStream.format("parquet").option("path", f"{out}/rows").option("checkpointLocation", f"{out}/checkpoint")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    rows = spark.read.schema(chat.schema).parquet(f"{out}/rows")
    return rows.select("id", "sql_type", "code", "target", F.col("conversations")[0]["content"].alias("prompt"),
                       F.col("conversations")[1]["content"].alias("answer"))


@register("predict_stream", f"SELECT idx, 'answer to ' || cast(idx AS VARCHAR) AS pred_sql FROM ({F2_SQL})")
def predict_stream_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I1 + I2: the run fails before its second batch, is started again, and ends
    with every input answered once."""
    inputs = replies(spark, sf_dir).select("idx", F.concat(F.lit("to "), F.col("idx").cast("string")).alias("prompt"))
    stream, path = _stored(inputs, "prompts", 6)
    out = scratch_path(spark, "predicted")
    ask = lambda ps: ["answer " + p for p in ps]
    first = PR.predict_stream(stream, ask, out, stop_at=1)
    try:
        first.awaitTermination()
    except Exception:  # noqa: BLE001 - the stop that was asked for
        if not PR.predicted(spark, out).count():
            raise
    again = spark.readStream.schema(inputs.schema).option("maxFilesPerTrigger", 2).parquet(path)
    PR.predict_stream(again, ask, out).awaitTermination()
    return PR.predicted(spark, out).select("idx", "pred_sql")
