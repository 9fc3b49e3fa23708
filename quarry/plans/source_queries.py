"""Queries over file sources and sinks (S1-S9, S12, S13), fed from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from quarry.session import scratch_path
from quarry.sources import files, jsonarrays
from quarry.sources.tables import load

QUERIES: dict = {}
ORACLES: dict = {}


def register(name, oracle=None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@register("json_arrays", """SELECT event_id, event_type, props, value FROM events""")
def json_arrays_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an object of JSON array files (texts hold braces and
    quotes), read back by as many tasks as the files have splits."""
    path = scratch_path(spark, "json_arrays")
    jsonarrays.write_json_arrays(load(spark, sf_dir, "events").select("event_id", "event_type", "props", "value"), path)
    schema = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("event_type", T.StringType()),
                           T.StructField("props", T.StringType()), T.StructField("value", T.DoubleType())])
    return files.read_json_array(spark, path, schema).drop("_file", "_pos")
