"""Cleaning raw model replies into SQL (R1-R4) - column expressions only.

Every rule is a composition of Spark built-ins (regex extraction, array
higher-order functions), so it runs inside whole-stage code generation and
also works on streaming DataFrames (no cross-row state).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FENCE = "```"
SQL_FENCE = "```sql"
JSON_FENCE = "```json"

# --- fixed values: statement keywords and explanation phrases ---
SQL_KEYWORDS = ["SELECT", "INSERT", "UPDATE", "DELETE", "CREATE", "ALTER", "DROP", "WITH"]
# phrases that end the SQL part of a reply (case-sensitive test, R2)
EXPLANATION_PHRASES = ["this query", "here's", "to find", "you can use", "the query", "this will",
                       "selects", "groups", "This query", "Here's", "To find"]
# phrases tested against the lower-cased line (R3, keyword-led replies)
EXPLANATION_PHRASES_LOWER = ["this query", "here's", "to find", "you can use", "the query",
                             "this will", "selects", "groups"]
# phrases tested against the lower-cased line (R3, SQL found inside text)
EXPLANATION_PHRASES_SHORT = ["this query", "here's", "to find", "you can use", "the query",
                             "this will"]
# --- end of fixed values ---


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# every character Python's ``str.strip()`` removes, built from the rule
WHITESPACE = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())


def strip_ws(c: Column) -> Column:
    """Python ``str.strip()``: leading and trailing white space of any kind
    (``btrim`` with the character set - much cheaper than a regex)."""
    return F.btrim(c, F.lit(WHITESPACE))


def _tail(c: Column, sep: str) -> Column:
    """Text after the first ``sep``; ``''`` when absent."""
    pos = F.locate(sep, c)
    return F.when(pos > 0, F.substr(c, pos + F.lit(len(sep)))).otherwise(F.lit(""))


def extract_sql(x) -> Column:
    """Last ```` ```sql ```` block (stripped), else the text; then a fence
    in the first 5 characters keeps what follows the last fence, and a fence
    in the last 5 keeps what precedes the first fence."""
    c = _c(x)
    blocks = F.regexp_extract_all(c, F.lit(r"(?s)```sql(.*?)```"), 1)
    s1 = F.when(F.size(blocks) > 0, strip_ws(F.element_at(blocks, -1))).otherwise(c)
    s2 = F.when(F.left(s1, F.lit(5)).contains(FENCE), F.substring_index(s1, FENCE, -1)).otherwise(s1)
    return F.when(F.right(s2, F.lit(5)).contains(FENCE), F.substring_index(s2, FENCE, 1)).otherwise(s2)


def _starts_with_keyword(c: Column) -> Column:
    u = F.upper(c)
    cond = None
    for k in SQL_KEYWORDS:
        e = u.startswith(k)
        cond = e if cond is None else (cond | e)
    return cond


def _fenced_first(c: Column) -> tuple[Column, Column]:
    """(first ```sql block, stripped) and (first plain block, stripped)."""
    sql_block = strip_ws(F.substring_index(_tail(c, SQL_FENCE), FENCE, 1))
    plain = strip_ws(F.substring_index(_tail(c, FENCE), FENCE, 1))
    return sql_block, plain


def _lines_until(text: Column, stop) -> Column:
    """Stripped non-empty lines, up to (not including) the first line after
    the first one for which ``stop(line)`` holds; joined by a space."""
    lines = F.filter(F.transform(F.split(text, "\n"), lambda l: strip_ws(l)), lambda l: F.length(l) > 0)
    flags = F.transform(lines, lambda l, i: (i > 0) & stop(l))
    p = F.array_position(flags, True)
    kept = F.when(p > 0, F.slice(lines, 1, F.greatest(p - 1, F.lit(1)))).otherwise(lines)
    return F.array_join(kept, " ")


def _any_in(line: Column, phrases: list[str]) -> Column:
    cond = None
    for ph in phrases:
        e = line.contains(ph)
        cond = e if cond is None else (cond | e)
    return cond


def clean_sql(x) -> Column:
    """R2: first ```` ```sql ```` block; else the first plain block when it
    starts with a statement keyword; else, for text that starts with one, the
    non-empty lines up to an explanation phrase (case-sensitive) once a line
    is held, joined by a space; else the stripped text.  Empty stays empty."""
    raw = _c(x)
    c = strip_ws(raw)
    sql_block, plain = _fenced_first(c)
    lines = _lines_until(c, lambda l: _any_in(l, EXPLANATION_PHRASES))
    return (F.when(raw.isNull() | (raw == ""), raw)
            .when(c.contains(SQL_FENCE), sql_block)
            .when(c.contains(FENCE) & _starts_with_keyword(plain), plain)
            .when(_starts_with_keyword(c), lines)
            .otherwise(c))


def sql_only(x) -> Column:
    """As R2, but phrases are tested on the lower-cased line, a fence line
    without SELECT also stops, and a fourth rule takes the text from the
    first keyword found anywhere (trying keywords in list order)."""
    raw = _c(x)
    c = strip_ws(raw)
    sql_block, plain = _fenced_first(c)
    lines3 = _lines_until(c, lambda l: _any_in(F.lower(l), EXPLANATION_PHRASES_LOWER)
                          | (l.contains(FENCE) & ~F.upper(l).contains("SELECT")))
    u = F.upper(c)
    pos = None
    for k in reversed(SQL_KEYWORDS):
        p = F.locate(k, u)
        pos = F.when(p > 0, p) if pos is None else F.when(p > 0, p).otherwise(pos)
    pos = F.coalesce(pos, F.lit(0))
    rest = strip_ws(F.substr(c, pos))
    lines4 = _lines_until(rest, lambda l: _any_in(F.lower(l), EXPLANATION_PHRASES_SHORT))
    return (F.when(raw.isNull() | (raw == ""), raw)
            .when(c.contains(SQL_FENCE), sql_block)
            .when(c.contains(FENCE) & _starts_with_keyword(plain), plain)
            .when(_starts_with_keyword(c), lines3)
            .when(pos > 0, lines4)
            .otherwise(c))


# one token: a JSON string, a Python string, or a run without quotes
_REPLY_TOKEN = r"""("(?:[^"\\]|\\.)*+"|'(?:[^'\\]|\\.)*+'|[^"']++|["'])"""


def _as_json(body: Column) -> Column:
    """Python literal text as JSON: the quotes that delimit strings and the
    bare words True, False, None change; what strings hold does not."""
    def token(t):
        inner = F.substr(t, F.lit(2), F.length(t) - 2)
        string = F.concat(F.lit('"'), F.replace(F.replace(inner, F.lit("\\'"), F.lit("'")), F.lit('"'), F.lit('\\"')), F.lit('"'))
        words = t
        for a, b in (("True", "true"), ("False", "false"), ("None", "null")):
            words = F.regexp_replace(words, rf"\b{a}\b", b)
        return (F.when(t.startswith("'") & (F.length(t) > 1), string).when(t.startswith('"'), t).otherwise(words))
    return F.array_join(F.transform(F.regexp_extract_all(body, F.lit(_REPLY_TOKEN), 1), token), "")


def _json_body(x) -> Column:
    c = F.regexp_replace(_c(x), "\n", "")
    blocks = F.regexp_extract_all(c, F.lit(r"(?s)```json(.*?)```"), 1)
    return F.when(F.size(blocks) > 0, strip_ws(F.element_at(blocks, -1)))


def json_reply(x, schema: str = "map<string,string>") -> Column:
    """Newlines removed; the last ```` ```json ```` block parsed as JSON,
    retried as a Python literal; otherwise an empty map.  Text is never
    evaluated as code."""
    body = _json_body(x)
    read = lambda b: F.from_json(b, schema, {"mode": "PERMISSIVE"})
    return F.coalesce(read(body), read(_as_json(body)), read(F.lit("{}")))


def json_replies(x, schema: str = "map<string,string>") -> Column:
    """R4 for replies that hold a list: its elements as an array; a reply that
    holds one object gives one element, anything else none."""
    body = _json_body(x)
    many = lambda b: F.when(b.startswith("["), F.from_json(b, f"array<{schema}>", {"mode": "PERMISSIVE"})) \
        .when(b.startswith("{"), F.array(F.from_json(b, schema, {"mode": "PERMISSIVE"})))
    found = lambda b: F.when(F.forall(many(b), lambda m: m.isNotNull()), many(b))
    return F.coalesce(found(body), found(_as_json(body)), F.from_json(F.lit("[]"), f"array<{schema}>"))


def strip_prompt(pred: Column, prompt: Column) -> Column:
    """Generation text after the prompt's length."""
    return F.substr(pred, F.length(prompt) + F.lit(1))


# --- fixed values: characters removed from generated descriptions ---
DESC_STRIP = ['"', "“", "”", "**"]
# --- end of fixed values ---


def tidy_description(x) -> Column:
    """Drop quotes and ``**``, a trailing ``。``, a leading ``:``/``：``;
    keep the first line; strip."""
    c = _c(x)
    for s in DESC_STRIP:
        c = F.replace(c, F.lit(s), F.lit(""))
    c = strip_ws(c)
    c = F.when(c.endswith("。"), strip_ws(F.substr(c, F.lit(1), F.length(c) - 1))).otherwise(c)
    c = F.when(c.startswith(":") | c.startswith("："), strip_ws(F.substr(c, F.lit(2)))).otherwise(c)
    return strip_ws(F.substring_index(c, "\n", 1))
