"""Line de-duplication by content-defined chunks of lines.

A text's non-blank lines are hashed; a rolling hash over every ``window`` of them
decides which lines are boundaries (all but those where it is 0 modulo
``modulus``), so boundaries depend on nearby lines only and a passage shifted to
another place in another text is cut alike. A chunk reaches from one boundary to
the next, both included: it has two non-blank lines at least, neighbouring chunks
share a line, and a passage needs two of its lines to be boundaries for what lies
between them to be seen. A chunk whose bytes occur elsewhere stays at its first
place (smallest doc_id, then place) and its lines are removed from all others.
Equal hashes only nominate chunks: the removal groups by the chunk's own bytes.

What is left are lines before the first and after the last boundary of a repeated
passage, and short passages with fewer than two boundaries; the share found of
all lines that stand in repeated windows of two is measured in ``tests/llm``
(over 0.9). ``dedup_passages`` leaves none: there every non-blank line is a
boundary, so its chunks are the windows of two consecutive non-blank lines.

All work is DataFrame expressions. What is shuffled by hash is one short row per
chunk, pre-aggregated to its first and last place, so a chunk in a third of all
texts is one row per task; the joins back to the chunks' places carry one row for
each of them, which Spark splits where they pile up (skew join).

Defined results: null text is an empty text and loses nothing; a row with a null
id keeps its text and takes no part; rows with the same id and chunk number are
one place, so exactly repeated rows are both kept or both cut; rows with one id
and different texts are cut by their own chunks only; other columns are ignored
by ``repeated_chunks`` and carried by ``dedup_lines``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quarry.llm.store import id_text, keep


@dataclass
class Params:
    window: int = 2   # non-blank lines under one rolling hash
    modulus: int = 13  # a line in so many is no boundary; 0: every line is one


def line_hash(line: Column) -> Column:
    """32 bits of the line's md5."""
    return F.conv(F.substring(F.md5(line), 25, 8), 16, 10).cast("long")


def _pin(df: DataFrame, *cols: str) -> DataFrame:
    """Columns computed once per row: a one-row Generate keeps the optimizer
    from pasting their expressions into the lambdas that read them."""
    rest = [c for c in df.columns if c not in cols]
    return df.select(*rest, F.inline(F.array(F.struct(*cols))))


def chunked(docs: DataFrame, p: Params) -> DataFrame:
    """``docs`` with ``lines`` and ``chunks``: array of (first, last) line."""
    df = _pin(docs.withColumn("lines", F.split("text", "\n", -1)), "lines")
    df = _pin(df.withColumn("bounds", F.array_compact(F.transform(
        "lines", lambda x, i: F.when(F.trim(x) != "", i)))), "bounds")
    if p.modulus:
        df = _pin(df.withColumn("hashes", F.transform("bounds", lambda i: line_hash(F.get("lines", i)))), "hashes")
        df = _pin(df.withColumn("roll", F.transform("hashes", lambda x, k: sum(
            (F.coalesce(F.get("hashes", k - F.lit(j)), F.lit(0)) * (31 ** j) for j in range(1, p.window)), x))), "roll")
        df = _pin(df.withColumn("bounds", F.filter(
            "bounds", lambda i, k: F.pmod(F.get("roll", k), F.lit(p.modulus)) != 0)), "bounds").drop("hashes", "roll")
    return _pin(df.withColumn("chunks", F.transform(
        F.slice("bounds", 1, F.greatest(F.size("bounds") - 1, F.lit(0))), lambda a, j: F.struct(
            a.alias("first"), F.get("bounds", j + 1).alias("last")))), "chunks").drop("bounds")


def _text(w: Column) -> Column:
    return F.array_join(F.slice("lines", w["first"] + 1, w["last"] - w["first"] + 1), "\n")


def repeated_chunks(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """(doc_id, no, h) of every chunk whose bytes occur at an earlier place;
    ``h`` is the chunk's hash."""
    texts = id_text(docs).where("doc_id IS NOT NULL")
    rows = chunked(texts, p).select("doc_id", F.posexplode(F.transform(
        "chunks", lambda w: F.xxhash64(_text(w)))).alias("no", "h"))
    rows = keep(rows, "line-chunks")
    place = F.struct("doc_id", "no")
    again = rows.groupBy("h").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    wanted = (rows.join(again.select("h"), "h").groupBy("doc_id")
              .agg(F.collect_set(F.struct("no", "h")).alias("wanted")))
    found = (chunked(texts.join(wanted, "doc_id"), p)
             .select("doc_id", F.explode(F.transform("wanted", lambda w: F.struct(
                 w["no"].alias("no"), w["h"].alias("h"), _text(F.get("chunks", w["no"])).alias("bytes")))).alias("w"))
             .select("doc_id", "w.no", "w.h", "w.bytes").where(F.xxhash64("bytes") == F.col("h")))
    found = keep(found, "line-repeats")
    first = (found.groupBy("h", "bytes").agg(F.min(place).alias("first"), F.max(place).alias("last"))
             .where("first <> last"))
    return (found.join(first, ["h", "bytes"]).where(F.struct("doc_id", "no") != F.col("first"))
            .select("doc_id", "no", "h").distinct())


def dedup_lines(docs: DataFrame, p: Params = Params()) -> DataFrame:
    """``docs`` (all columns) with the lines of repeated chunks cut from
    ``text``, and the structs ``line_dedup``: (n_lines, n_removed)."""
    gone = repeated_chunks(docs, p).groupBy(F.col("doc_id").alias("line_dedup_id")).agg(
        F.collect_set(F.struct("no", "h")).alias("line_dedup_gone"))
    joined = docs.join(gone, docs["doc_id"].cast("long") == gone["line_dedup_id"], "left").drop("line_dedup_id")
    others = [c for c in docs.columns if c != "text"]
    whole = joined.select(F.struct(*others).alias("row"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                          F.col("text").isNull().alias("void"),
                          F.coalesce("line_dedup_gone", F.array().cast("array<struct<no:int,h:bigint>>")).alias("gone"))
    # rows of one id may have different texts: a chunk counts where its hash is the row's own
    own = F.filter("gone", lambda g: F.coalesce(
        F.xxhash64(_text(F.get("chunks", g["no"]))) == g["h"], F.lit(False)))
    cut = F.flatten(F.transform(own, lambda g: F.sequence(
        F.get("chunks", g["no"])["first"], F.get("chunks", g["no"])["last"])))
    left = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), cut)
    out = _pin(chunked(whole, p).withColumn("left", left), "left")
    kept = F.when(F.col("void"), F.lit(None).cast("string")).otherwise(
        F.array_join(F.transform("left", lambda i: F.get("lines", i)), "\n"))
    out = out.select("row", kept.alias("text"), F.struct(
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size("left")).alias("n_removed")).alias("line_dedup"))
    return out.select(*[F.col("text") if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns],
                      "line_dedup")


def dedup_passages(docs: DataFrame) -> DataFrame:
    """``dedup_lines`` where every non-blank line is a boundary."""
    return dedup_lines(docs, Params(modulus=0))


def _sql(bounds: str) -> str:
    return f"""
l AS (SELECT DISTINCT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM {{docs}}),
u AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM l),
b AS (SELECT doc_id, i FROM {bounds}),
p AS (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS j FROM b),
w AS (SELECT doc_id, i, j, row_number() OVER (PARTITION BY array_to_string(lines[i:j], chr(10)) ORDER BY doc_id, i) AS place
      FROM p JOIN l USING (doc_id) WHERE j IS NOT NULL),
x AS (SELECT DISTINCT doc_id, unnest(range(i, j + 1)) AS i, TRUE AS gone FROM w WHERE place > 1),
deduped AS (SELECT doc_id, count(*)::BIGINT AS n_lines, count(gone)::BIGINT AS n_removed,
            coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (gone IS NULL), '') AS text
            FROM u LEFT JOIN x USING (doc_id, i) GROUP BY doc_id)
"""


#: ``dedup_passages`` and ``dedup_lines`` in DuckDB SQL (31, 13: ``Params``' values).
PASSAGES_SQL = _sql("u WHERE trim(line) <> ''")
DEDUP_SQL = _sql("""(SELECT doc_id, i, ('0x' || substr(md5(line), 25, 8))::BIGINT
  + 31 * coalesce(lag(('0x' || substr(md5(line), 25, 8))::BIGINT) OVER (PARTITION BY doc_id ORDER BY i), 0) AS roll
  FROM u WHERE trim(line) <> '') WHERE roll % 13 <> 0""")
