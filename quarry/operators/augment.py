"""Record augmentation (A1-A5).

A1-A4 edit the long form of a parsed schema (see ``mschema.parse_schema``);
A5 is a column expression.  Every draw is keyed by (seed, purpose, record,
table, column), so a record's augmentation is the same under any
partitioning and on re-execution.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.sqltext import drop_line_comments
from quarry.operators.responses import extract_sql


def sql_tidy(x) -> Column:
    """A5: ``--`` comments outside literals are removed up to their newline
    (so two lines never fuse and ``'--'`` in a string survives); if three or
    more newlines remain, white space collapses to single spaces; then R1."""
    c = F.col(x) if isinstance(x, str) else x
    s = F.when(c.contains("--"), drop_line_comments(c)).otherwise(c)
    n_newlines = F.size(F.split(s, "\n")) - 1
    s = F.when(n_newlines >= 3, F.regexp_replace(F.regexp_replace(s, r"\s+", " "), r"^ | $", "")).otherwise(s)
    return extract_sql(s)


# ------------------------------------------------------ schema augmentation --
# All of A1-A4 edit the parsed struct of ``mschema.parse_schema`` with array
# higher-order functions: no explode, no shuffle, usable on streams.

from quarry.functions.rand import threshold  # noqa: E402
from quarry.functions.text import regex_escape  # noqa: E402
from quarry.operators.mschema import _table_matches, fk_filter, parse_schema, render_schema  # noqa: E402
from quarry.functions.rand import weighted_choice  # noqa: E402


def _h(seed: int, purpose: str, *parts: Column) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:{purpose}:"),
                          F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])))


def _draw(seed: int, purpose: str, p: float, *parts: Column) -> Column:
    if p >= 1:
        return F.lit(True)
    if p <= 0:
        return F.lit(False)
    return F.substring(_h(seed, purpose, *parts), 1, 8) < F.lit(threshold(p))


def _sort_by_hash(arr: Column, keyed) -> Column:
    """Sort ``arr`` by ``keyed(element, index)`` (a hash), ties by index."""
    tagged = F.transform(arr, lambda x, i: F.struct(keyed(x, i).alias("h"), i.alias("i"), x.alias("x")))
    return F.transform(F.array_sort(tagged), lambda t: t["x"])


def schema_shuffle(parsed: Column, rec: Column, seed: int = 42, tab_p: float = 0.5,
                   col_p: float = 0.3, fk_p: float = 0.2) -> Column:
    """A1: with ``tab_p`` permute the tables; per table with ``col_p``
    permute its columns; with ``fk_p`` permute the FKs."""
    tabs = parsed["tables"]
    tabs = F.when(_draw(seed, "a1_tab", tab_p, rec),
                  _sort_by_hash(tabs, lambda t, i: _h(seed, "a1_tab_order", rec, t["key"])))\
        .otherwise(tabs)
    tabs = F.transform(tabs, lambda t: t.withField("cols", F.when(
        _draw(seed, "a1_col", col_p, rec, t["key"]),
        _sort_by_hash(t["cols"], lambda c, i: _h(seed, "a1_col_order", rec, t["key"], c["name"])))
        .otherwise(t["cols"])))
    fks = parsed["fks"]
    fks = F.when(_draw(seed, "a1_fk", fk_p, rec),
                 _sort_by_hash(fks, lambda k, i: _h(seed, "a1_fk_order", rec, i))).otherwise(fks)
    return parsed.withField("tables", tabs).withField("fks", fks)


def sql_words(sql) -> Column:
    """Lower-cased maximal word runs of a SQL text (Unicode word characters).
    Materialise it as a column before the array edits that read it."""
    c = F.col(sql) if isinstance(sql, str) else sql
    return F.regexp_extract_all(F.lower(c), F.lit(r"(?U)(\w+)"), 1)


def _in_sql(sql: Column, name: Column, words: Column | None = None) -> Column:
    """``name`` occurs in ``sql`` as a whole word, case-insensitively.

    For a name made of word characters that is exactly membership in the
    SQL's word runs (``words`` from :func:`sql_words`): no regex is compiled
    per name.  Other names fall back to a word-boundary regex."""
    slow = F.regexp_like(sql, F.concat(F.lit("(?iU)\\b"), regex_escape(name), F.lit("\\b")))
    if words is None:
        return slow
    return F.when(name.rlike(r"(?U)^\w+$"), F.array_contains(words, F.lower(name))).otherwise(slow)


def kept_tables(parsed: Column, rec: Column, sql: Column, seed: int = 42, tab_p: float = 0.8,
                col_p: float = 0.7, words: Column | None = None) -> Column:
    """A2 without its last step: a table stays if its name (header before ``,``) is a whole word of
    the SQL, else with ``tab_p``; in a kept table a column stays by the same
    test, else with ``col_p``.  Pass ``words``
    (a column holding :func:`sql_words`) to test names without regexes."""
    kept = F.filter(parsed["tables"], lambda t: _in_sql(sql, t["name"], words)
                    | _draw(seed, "a2_tab", tab_p, rec, t["key"]))
    kept = F.transform(kept, lambda t: t.withField("cols", F.filter(
        t["cols"], lambda c: _in_sql(sql, c["name"], words)
        | _draw(seed, "a2_col", col_p, rec, t["key"], c["name"]))))
    return parsed.withField("tables", kept)


def schema_filter(df, parsed: str, out: str, rec: Column, sql: str, seed: int = 42, tab_p: float = 0.8, col_p: float = 0.7):
    """A2 on a DataFrame: column ``out`` holds ``parsed`` with the kept tables
    and columns, and the FKs among them (M7).  The SQL's words and the kept
    tables are columns of their own (a one-row Generate keeps the optimizer
    from pasting them into the foreign-key test), so each is made once per
    record instead of once per foreign key."""
    pin = lambda d, c, e: d.withColumn(c, e).select(*d.columns, F.inline(F.array(F.struct(F.col(c)))))
    d = pin(df, "_w", sql_words(sql))
    d = pin(d, "_kept", kept_tables(F.col(parsed), rec, F.col(sql), seed, tab_p, col_p, words=F.col("_w")))
    return d.withColumn(out, fk_filter(F.col("_kept"))).drop("_w", "_kept")


# --- fixed values: example labels and their weights (A3) ---
EXAMPLE_LABELS = ["Value examples:", "Examples:", "示例值:", "values:", "--"]
EXAMPLE_WEIGHTS = [10, 83, 3, 3, 1]
FOUND_LABELS = ["Value examples:", "Examples:"]
# --- end of fixed values ---


def permute_label(rec: Column, seed: int = 42) -> Column:
    """A3's one label per record (weighted draw)."""
    choice = weighted_choice(seed, "a3_label", EXAMPLE_WEIGHTS, rec)
    return F.element_at(F.array(*[F.lit(x) for x in EXAMPLE_LABELS]), choice + 1)


def permute_indent(rec: Column, seed: int = 42) -> Column:
    """A3's final render drops the two-space indent with probability 0.5."""
    return F.when(_draw(seed, "a3_indent", 0.5, rec), F.lit("")).otherwise(F.lit("  "))


def schema_permute(parsed: Column, label: Column) -> Column:
    """A3: every column line holding ``Value examples:`` or ``Examples:``
    gets ``label`` instead (split at the first occurrence, quirk Q14); the
    label ``--`` moves the values after the closing parenthesis.  ``label``
    should be a column (see :func:`permute_label`): it is read per line."""

    def relabel(line):
        out = line
        for found in reversed(FOUND_LABELS):
            pre = F.substring_index(line, found, 1)
            post = F.substr(line, F.length(pre) + F.lit(len(found) + 1))
            new = F.when(label == "--", F.concat(pre, F.lit(") -- Value examples:"),
                                                 F.substr(post, F.lit(1), F.length(post) - 1))) \
                .otherwise(F.concat(pre, label, post))
            out = F.when(line.contains(found), new).otherwise(out)
        return out

    tabs = F.transform(parsed["tables"], lambda t: t.withField("cols", F.transform(
        t["cols"], lambda c: c.withField("line", relabel(c["line"])))))
    return parsed.withField("tables", tabs)


def _replacement_text(s: Column) -> Column:
    return F.regexp_replace(s, r"([\\$])", r"\\$1")


def schema_rename(schema_text: Column, sql: Column, db_name: Column, rec: Column, seed: int = 42,
                  tab_p: float = 0.5) -> tuple[Column, Column]:
    """A4: each table named in the SQL is, with ``tab_p``, renamed
    ``db.table`` in both schema text and SQL - whole words only (quirk Q15),
    applied in table order."""
    parsed = parse_schema(schema_text)
    picks = F.filter(parsed["tables"], lambda t: _in_sql(sql, t["name"])
                     & _draw(seed, "a4_tab", tab_p, rec, t["key"]))
    pairs = F.transform(picks, lambda t: F.struct(t["name"].alias("old"),
                                                   F.concat(db_name, F.lit("."), t["name"]).alias("new")))

    def fold(text):
        return F.aggregate(pairs, text, lambda acc, x: F.regexp_replace(
            acc, F.concat(F.lit("\\b"), regex_escape(x["old"]), F.lit("\\b")), _replacement_text(x["new"])))
    return fold(schema_text), fold(sql)


def with_parsed_schema(df, schema_col: str = "db_schema", out_col: str = "_p",
                       broadcast_bytes: int = 64 * 1024 * 1024):
    """Add the parsed schema.  A corpus usually repeats one schema text per
    database, so the distinct texts are parsed once and broadcast back - but
    only when their total size is known to be under ``broadcast_bytes``
    (checked by one aggregate); otherwise every row parses its own text."""
    key = F.md5(F.col(schema_col))
    d = df.select(key.alias("_sk"), F.col(schema_col).alias("_st")).dropDuplicates(["_sk"])
    size = d.agg(F.coalesce(F.sum(F.length("_st")), F.lit(0))).first()[0]
    n = df.count()
    d_n = d.count() if size <= broadcast_bytes else n
    if size <= broadcast_bytes and d_n * 2 <= n:
        parsed = d.select("_sk", parse_schema(F.col("_st")).alias(out_col))
        return df.withColumn("_sk", key).join(F.broadcast(parsed), "_sk", "left").drop("_sk")
    return df.withColumn(out_col, parse_schema(schema_col))


def augment_record(df, seed: int = 42, shuffle=True, filter_=True, permute=True, tidy=True,
                   schema_col="db_schema", sql_col="sql", db_col="db_name", key_col="idx",
                   dedupe_parse: bool = False, parsed: bool = False):
    """The default chain (shuffle, filter, permute, SQL tidy) on a record
    DataFrame; unparsed schema texts (quirk Q1) pass through unchanged.
    ``dedupe_parse`` parses each distinct schema text once (batch only);
    ``parsed``: the column ``_p`` already holds the parsed schema."""
    rec = F.col(key_col)
    # each step reads the previous step's column, so the parse (regex work)
    # runs once per record instead of once per reference in the next step
    out = (df if parsed else with_parsed_schema(df, schema_col) if dedupe_parse
           else df.withColumn("_p", parse_schema(schema_col)))
    if shuffle:
        out = out.withColumn("_p", schema_shuffle(F.col("_p"), rec, seed))
    if filter_:
        out = schema_filter(out, "_p", "_p", rec, sql_col, seed)
    indent = None
    if permute:
        out = (out.withColumn("_label", permute_label(rec, seed))
               .withColumn("_indent", permute_indent(rec, seed)))
        out = out.withColumn("_p", schema_permute(F.col("_p"), F.col("_label")))
        indent = F.col("_indent")
    text = F.when(F.col("_p.parsed"), render_schema(F.col(db_col), F.col("_p"), indent)).otherwise(F.col(schema_col))
    out = out.withColumn(schema_col, text).drop("_p", "_label", "_indent")
    if tidy:
        out = out.withColumn(sql_col, sql_tidy(sql_col))
    return out
