"""Long texts leave the profile's shuffle as digests."""

from quarry.operators import profile as PRO
from quarry.sources.tables import load_many
from conftest import SF_SMALL


def test_no_long_text_is_a_key(spark):
    d = PRO.distinct_values(load_many(spark, SF_SMALL, ["documents", "pages"]))
    assert d.where("length(ks) > 33 OR length(v) > 32").isEmpty()
    assert d.where("n_chars > 32 AND v IS NOT NULL").isEmpty() and not d.where("n_chars > 1000").isEmpty()


def test_long_values_among_the_examples(spark):
    rows = [("a" * 40,), ("a" * 41,), ("b",), (None,), ("a" * 40,), ("z" * 50 + "é",), ("",)] * 30
    t = {"t": spark.createDataFrame(rows, "x string").repartition(4)}
    one = PRO.profile(t, n_examples=3).first()
    assert one.raw_examples == ["", "a" * 40, "a" * 41]
    assert (one.n_distinct, one.n_count, one.max_len, one.min_len) == (5, 180, 51, 0)
    assert PRO.profile(t, n_examples=10).first().raw_examples == ["", "a" * 40, "a" * 41, "b", "z" * 50 + "é"]


def test_enum_values_are_whole_texts(spark):
    t = {"t": spark.createDataFrame([(c * 45,) for c in "abab" * 10], "x string")}
    assert PRO.enum_values(t).first()["values"] == ["a" * 45, "b" * 45]
