"""Reply cleaning (R1-R4), SQL tidy (A5), description tidy."""

from pyspark.sql import functions as F

from quarry.operators import responses as R
from quarry.operators.augment import sql_tidy

FENCE = "```"


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr.alias("y")).first()["y"]


def test_extract_last_sql_block(spark):
    text = f"a {FENCE}sql SELECT 1 {FENCE} b {FENCE}sql\nSELECT 2\n{FENCE} c"
    assert one(spark, R.extract_sql("x"), text) == "SELECT 2"


def test_extract_bare_fenced_block_is_empty(spark):
    # quirk Q21: the part after the last fence is taken first
    assert one(spark, R.extract_sql("x"), f"{FENCE}\nSELECT 3\n{FENCE}") == ""


def test_extract_closing_fence_only(spark):
    assert one(spark, R.extract_sql("x"), f"SELECT 4\n{FENCE}") == "SELECT 4\n"


def test_extract_plain_text_unchanged(spark):
    assert one(spark, R.extract_sql("x"), "SELECT 5") == "SELECT 5"


def test_clean_first_sql_block(spark):
    text = f"x {FENCE}sql SELECT 1 {FENCE} then {FENCE}sql SELECT 2 {FENCE}"
    assert one(spark, R.clean_sql("x"), text) == "SELECT 1"


def test_clean_plain_block_needs_keyword(spark):
    assert one(spark, R.clean_sql("x"), f"{FENCE}\nSELECT 3\n{FENCE}") == "SELECT 3"
    assert one(spark, R.clean_sql("x"), f"{FENCE}\nhello\n{FENCE}") == f"{FENCE}\nhello\n{FENCE}"


def test_clean_stops_at_explanation_case_sensitive(spark):
    text = "SELECT a\nFROM t\nThis query selects a\nmore"
    assert one(spark, R.clean_sql("x"), text) == "SELECT a FROM t"
    # the phrase on the first line does not stop it
    assert one(spark, R.clean_sql("x"), "SELECT a -- this query\nFROM t") == "SELECT a -- this query FROM t"
    # R2 is case-sensitive: 'THIS QUERY' is not an explanation
    assert one(spark, R.clean_sql("x"), "SELECT a\nTHIS QUERY\nx") == "SELECT a THIS QUERY x"


def test_sql_only_finds_keyword_inside_text(spark):
    assert one(spark, R.sql_only("x"), "Sure! select x from y\nthis will do") == "select x from y"
    # keywords are tried in list order: SELECT before WITH
    assert one(spark, R.sql_only("x"), "go: WITH a AS (x) SELECT 1") == "SELECT 1"


def test_sql_only_stops_at_fence_line(spark):
    assert one(spark, R.sql_only("x"), f"SELECT 4\n{FENCE}\nexplained") == "SELECT 4"


def test_empty_and_null_stay(spark):
    assert one(spark, R.clean_sql("x"), "") == ""
    assert one(spark, R.sql_only("x"), None) is None


def test_json_reply_with_repairs(spark):
    m = one(spark, R.json_reply("x"), "r: ```json {'a': 1, 'b': True, 'c': None}```")
    assert m == {"a": "1", "b": "true", "c": None}
    assert one(spark, R.json_reply("x"), '```json {"a": "x"}``` and ```json {"a": "y"}```') == {"a": "y"}
    assert one(spark, R.json_reply("x"), "no json here") == {}
    assert one(spark, R.json_reply("x"), "```json not json```") == {}


def test_sql_tidy_comment_becomes_newline(spark):
    # quirk Q22: lines do not fuse, and '--' inside a literal survives
    assert one(spark, sql_tidy("x"), "SELECT a -- c\nFROM t") == "SELECT a \nFROM t"
    assert one(spark, sql_tidy("x"), "SELECT '--x' FROM t") == "SELECT '--x' FROM t"


def test_sql_tidy_collapses_many_newlines(spark):
    text = "SELECT a\nFROM t\nWHERE b\n\nLIMIT 5"
    assert one(spark, sql_tidy("x"), text) == "SELECT a FROM t WHERE b LIMIT 5"


def test_description_tidy(spark):
    # the trailing '。' test runs on the whole text, before the first-line cut
    assert one(spark, R.tidy_description("x"), '**：描述。**\nline2') == "描述。"
    assert one(spark, R.tidy_description("x"), '“描述。”') == "描述"
    assert one(spark, R.tidy_description("x"), '"hello"') == "hello"


def test_strip_prompt(spark):
    df = spark.createDataFrame([("PROMPT", "PROMPT SELECT 1")], "p string, g string")
    assert df.select(R.strip_prompt(F.col("g"), F.col("p"))).first()[0] == " SELECT 1"
