"""Registered queries: each reads the given tables and runs one operator.

``spark_queries()`` maps a name to ``fn(spark, sf_dir) -> DataFrame``;
``oracle_queries()`` maps the same name to DuckDB SQL over the same tables.
"""

from __future__ import annotations


def _modules():
    from quarry.plans import (catalog_queries, chain_queries, corpus_queries, eval_queries, exec_queries, key_queries,
                              response_queries, rule_queries, schema_queries, source_queries, stream_queries, train_queries, whole_queries)
    return (catalog_queries, corpus_queries, response_queries, schema_queries, eval_queries, train_queries, exec_queries,
            rule_queries, whole_queries, source_queries, key_queries, chain_queries, stream_queries)


def spark_queries():
    return {name: fn for m in _modules() for name, fn in m.QUERIES.items()}


def oracle_queries():
    return {name: sql for m in _modules() for name, sql in m.ORACLES.items()}
