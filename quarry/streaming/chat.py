"""Chat samples from a stream of records.

Everything after the join is row-local, so it runs on a stream as it does on a
table: records meet their database's schema text in a stream-static join (the
static side is one text per database, read again for every micro-batch), are
augmented, rendered and routed. No state, no watermark. A schema text is parsed
once on the static side, not with every record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quarry.operators import prompts, sft
from quarry.operators.augment import augment_record
from quarry.operators.mschema import parse_schema


def dealt(records: DataFrame) -> DataFrame:
    """A micro-batch's records in as many tasks as a shuffle has, however few files they came in."""
    return records.repartition(int(records.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))) if records.isStreaming else records


def chat_samples(records: DataFrame, schemas: DataFrame, task: str, dialects: int = 3, seed: int = 42) -> DataFrame:
    """``(id, conversations, sql_type, code, target)`` of ``records(idx, db_name,
    question, evidence, sql)``, streaming or not. ``schemas``: (db_name, db_schema);
    a record of another database has an empty schema."""
    text = F.coalesce("db_schema", F.lit(""))
    texts = schemas.select("db_name", text.alias("db_schema"), parse_schema(text).alias("_p"))
    rows = dealt(records).join(texts, "db_name", "left").withColumns(
        {"db_schema": text, "_p": F.coalesce("_p", parse_schema(F.lit("")))})
    rows = augment_record(rows, seed, parsed=True)
    prompt = prompts.prompt_for(F.lit(task), prompts._values(rows))
    kind = prompts.normalize_task(F.lit(task))
    answer = F.concat(F.lit("\n"), F.col("sql"), F.lit("\n```"))
    return rows.select(
        F.col("idx").alias("id"),
        F.array(F.struct(F.lit("user").alias("role"), prompt.alias("content")),
                F.struct(F.lit("assistant").alias("role"), answer.alias("content"))).alias("conversations"),
        kind.alias("sql_type"), sft.dialect_code(kind, dialects).alias("code"),
        sft.eval_target(F.col("db_name"), kind, F.col("sql")).alias("target"))
