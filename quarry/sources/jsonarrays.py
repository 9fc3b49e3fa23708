"""JSON arrays of objects, read by many tasks.

A file that is one JSON array has no line structure, so readers take it whole.
Here its bytes are dealt out like those of any text: Spark's text source splits
the file, with ``}`` as the line separator, so a piece ends at each closing brace
whether it stands in a string or not. What a byte means depends on all before
it, but only through two facts: whether it stands inside a string, and how deep.

1. Every split reports, for both possible beginnings (inside a string or not),
   how its quotes and brackets change them: one small row.
2. These rows are composed in file order, which gives each split's true beginning.
3. Every split cuts out its own elements. An element that crosses splits is put
   together from its parts, which alone are shuffled.

An escaped quote never counts: a quote is escaped after an odd number of
backslashes, and those stand in the same piece. Python sees whole batches of
pieces as byte arrays, never one character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from quarry.session import scratch_path

QUOTE, SLASH, OPEN, CLOSE = b'"\\{}'
_STEP = np.zeros(256, dtype=np.int64)
_STEP[[OPEN, ord("[")]] = 1
_STEP[[CLOSE, ord("]")]] = -1
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 0x09, 0x0A, 0x0D]] = True


def _pieces(spark: SparkSession, path) -> DataFrame:
    """The text between closing braces, with the split it was read in."""
    return (spark.read.option("lineSep", "}").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.col("value").cast("binary").alias("piece")))


def _runs(batches) -> Iterator[tuple[pa.RecordBatch, str, int, np.ndarray]]:
    """(rows, file, block, bytes) of the pieces of one split that came together,
    each with its closing brace again."""
    for batch in batches:
        block = np.asarray(batch.column("block"))
        file = np.asarray(batch.column("file").dictionary_encode().indices)
        cut = np.flatnonzero((block[1:] != block[:-1]) | (file[1:] != file[:-1])) + 1
        for a, b in zip(np.append(0, cut), np.append(cut, len(block))):
            part = batch.slice(a, b - a)
            data = b"".join(x.as_py() + b"}" for x in part.column("piece"))
            yield part, part.column("file")[0].as_py(), int(block[a]), np.frombuffer(data, dtype=np.uint8)


def _quotes(data: np.ndarray) -> np.ndarray:
    """Marks the quotes that begin or end a string."""
    quote = data == QUOTE
    at = np.flatnonzero(quote)
    plain = np.where(data != SLASH, np.arange(len(data)), -1)
    last = np.maximum.accumulate(plain)  # the last byte up to here that is no backslash
    before = np.where(at > 0, at - 1 - last[at - 1], 0)
    quote[at[before % 2 == 1]] = False
    return quote


def _changes(batches) -> Iterator[pa.RecordBatch]:
    """Per split: its quotes modulo 2, the change of depth for a beginning outside
    and inside a string, and its first byte that is not white space."""
    state: dict[tuple[str, int], list] = {}
    for _, file, block, data in _runs(batches):
        s = state.setdefault((file, block), [0, 0, 0, None])
        inside = (np.cumsum(_quotes(data)) + s[0]) % 2
        step = _STEP[data]
        s[1] += int(step[inside == 0].sum())
        s[2] += int(step[inside == 1].sum())
        s[0] = int(inside[-1])
        if s[3] is None and not _BLANK[data].all():
            s[3] = int(data[~_BLANK[data]][0])
    rows = [(f, b, *s) for (f, b), s in state.items()]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                                     ["file", "block", "quotes", "out_change", "in_change", "first"])


def _begins(changes: DataFrame) -> DataFrame:
    """(file, block, inside, depth, base): every split's beginning, and the depth
    of the file's elements (1 inside an array, 0 for a single object)."""
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    x = changes.withColumn("inside", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    x = x.withColumn("change", F.when(F.col("inside") == 0, F.col("out_change")).otherwise(F.col("in_change")))
    return x.select("file", "block", "inside", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("depth"),
                    F.coalesce((F.first("first", ignorenulls=True).over(whole) == ord("[")).cast("long"), F.lit(0)).alias("base"))


def _elements(batches) -> Iterator[pa.RecordBatch]:
    """(file, block, part, closed, text): the objects at the elements' depth, each
    once it is closed; at a split's end what is still open, and at its beginning
    the rest of what was open before (part 0). Parts are numbered in a split."""
    at = None
    names = ["file", "block", "part", "closed", "text"]

    def rows(found):
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*found), kinds)], names)

    for part, file, block, data in _runs(batches):
        found = []
        if (file, block) != at:
            if at is not None and held is not None:
                found.append((*at, number, False, held))
            at = (file, block)
            inside, depth, base = (part.column(c)[0].as_py() for c in ("inside", "depth", "base"))
            number = 0
            held = b"" if depth > base else None  # bytes of the element that is open
            if held is None:
                number = 1
        string = np.cumsum(_quotes(data)) + inside
        outside = string % 2 == 0
        step = np.where(outside, _STEP[data], 0)
        after = np.cumsum(step) + depth
        first = np.flatnonzero((step > 0) & (after == base + 1) & (data == OPEN))
        last = np.flatnonzero((step < 0) & (after == base) & (data == CLOSE)) + 1
        raw = data.tobytes()
        if held is not None:
            if len(last) and (not len(first) or last[0] <= first[0]):
                found.append((file, block, number, True, held + raw[:last[0]]))
                held, number, last = None, number + 1, last[1:]
            else:
                held += raw
        if held is None:
            for a, b in zip(first, last):
                found.append((file, block, number, True, raw[a:b]))
                number += 1
            if len(first) > len(last):
                held = raw[first[-1]:]
        inside, depth = int(string[-1] % 2), int(after[-1])
        if found:
            yield rows(found)
    if at is not None and held is not None:
        yield rows([(*at, number, False, held)])


def elements(spark: SparkSession, path) -> DataFrame:
    """(file, pos, text): the objects of files that each hold one JSON array (or
    one object), as text, with their position among the file's objects.

    Elements that are not objects are passed over. A file's text must be UTF-8.
    An empty file has no elements."""
    pieces = _pieces(spark, path)
    store = scratch_path(spark, "json-changes")
    pieces.mapInArrow(_changes, "file string, block long, quotes long, out_change long, in_change long, first long").write.parquet(store)
    changes = spark.read.parquet(store)
    # one row of a path and five numbers for each split: a table of 100 TB has under a million
    begins = F.broadcast(_begins(changes))
    cut = pieces.join(begins, ["file", "block"]).mapInArrow(
        _elements, "file string, block long, part long, closed boolean, text binary")
    store = scratch_path(spark, "json-elements")
    cut.write.parquet(store)
    cut = spark.read.parquet(store)
    # part 0 ends what an earlier split left open; a split that an element fills has a part 0 that is not closed
    whole = cut.where("closed AND part > 0").select("file", "block", "part", "text")
    torn = cut.where("part = 0 OR NOT closed")
    before = Window.partitionBy("file").orderBy("block", "part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    torn = torn.withColumn("element", F.sum((F.col("part") > 0).cast("long")).over(before))
    joined = torn.groupBy("file", "element").agg(
        F.array_sort(F.collect_list(F.struct("block", "part", "text", "closed"))).alias("parts"))
    joined = joined.where(F.element_at("parts", -1)["closed"]).select(
        "file", F.col("parts")[0]["block"].alias("block"), F.col("parts")[0]["part"].alias("part"),
        F.aggregate("parts", F.lit(b""), lambda a, x: F.concat(a, x["text"])).alias("text"))
    # positions: the objects begun in earlier splits, and those begun before in the same one
    begun = cut.where("part > 0").groupBy("file", "block").agg(F.count("*").alias("n")).withColumn(
        "before", F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    return whole.union(joined).join(begun, ["file", "block"]).select(
        "file", (F.col("before") + F.col("part") - 1).alias("pos"), F.col("text").cast("string").alias("text"))


def _lines(batches) -> Iterator[pa.RecordBatch]:
    """A task's objects as the lines of one JSON array."""
    held = None
    for batch in batches:
        lines = []
        for text in batch.column("json").to_pylist():
            lines.append("[" if held is None else held + ",")
            held = text
        yield pa.RecordBatch.from_arrays([pa.array(lines, pa.string())], ["value"])
    if held is not None:
        yield pa.RecordBatch.from_arrays([pa.array([held, "]"])], ["value"])


def write_json_arrays(df: DataFrame, path: str) -> None:
    """Each partition of ``df`` as one file holding a JSON array, an object a line."""
    rows = df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
    rows.mapInArrow(_lines, "value string").write.mode("overwrite").text(path)
