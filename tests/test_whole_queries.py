"""Catalog queries cover every given table (second review)."""

import __spark_entry__ as E
from conftest import SF_SMALL
from quarry.sources.tables import TABLE_NAMES


def test_whole_queries_read_every_table(spark):
    for name in ("field_profile_all", "key_discovery_all"):
        got = E.queries()[name](spark, SF_SMALL)
        assert {r.table_name for r in got.select("table_name").distinct().collect()} == set(TABLE_NAMES)
    for name in ("mschema_text_all", "mschema_dump_roundtrip_all"):
        text = E.queries()[name](spark, SF_SMALL).first().mschema
        assert all(f"# Table: {t}\n" in text for t in TABLE_NAMES)
