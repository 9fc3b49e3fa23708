"""Row-local cleaning on a Structured Streaming source."""

import tempfile

from conftest import SF_SMALL
from quarry.plans.fixtures import replies
from quarry.streaming.replies import REPLY_SCHEMA, clean_replies, stream_clean


def test_stream_matches_batch(spark):
    src, sink = tempfile.mkdtemp(), tempfile.mkdtemp()
    f2 = replies(spark, SF_SMALL)
    f2.select(*[c.name for c in REPLY_SCHEMA.fields]).write.mode("overwrite").parquet(src)
    q = stream_clean(spark, src, sink, checkpoint=tempfile.mkdtemp())
    q.awaitTermination(300)
    got = {r.idx: (r.extracted, r.cleaned, r.tidy) for r in spark.read.parquet(sink).collect()}
    want = {r.idx: (r.extracted, r.cleaned, r.tidy) for r in clean_replies(f2).collect()}
    assert got == want and len(got) == f2.count()


def test_a_batch_of_one_file_is_augmented_by_many_tasks(spark):
    """the work of a micro-batch doesn't hang on its number of files, and the
    samples are those of the batch chain."""
    from pyspark.sql import functions as F
    from quarry.operators.augment import augment_record
    from quarry.plans.fixtures import processed, schema_texts
    from quarry.streaming.chat import chat_samples

    src, sink = tempfile.mkdtemp(), tempfile.mkdtemp()
    records = processed(spark, SF_SMALL).drop("db_schema").limit(300)
    # one database has no schema text, one a null
    texts = (schema_texts(spark, SF_SMALL).groupBy("db_name").agg(F.max_by("db_schema", "idx").alias("db_schema")).where("db_name <> 'CHINA'")
             .withColumn("db_schema", F.when(F.col("db_name") != "BRAZIL", F.col("db_schema"))))
    kept = tempfile.mkdtemp()
    texts.write.mode("overwrite").parquet(kept)
    texts = spark.read.parquet(kept)
    records.coalesce(1).write.mode("overwrite").parquet(src)
    stream = spark.readStream.schema(records.schema).parquet(src)
    chat = chat_samples(stream, texts, "nl2sqlite").withColumn("task", F.spark_partition_id())
    q = chat.writeStream.format("parquet").option("path", sink).option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start()
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    assert got.select("task").distinct().count() > 1
    rows = spark.read.parquet(src).join(texts, "db_name", "left").withColumn("db_schema", F.coalesce("db_schema", F.lit("")))
    want = {r.idx: r.db_schema.strip() for r in augment_record(rows, 42).select("idx", "db_schema").collect()}
    got = {r.id: r.conversations[0].content for r in got.collect()}
    assert got.keys() == want.keys() and len(set(want.values())) > 20 and all(want[k] in got[k] for k in want)
