"""Canonical result cells.

Python equality makes ``1 == 1.0 == Decimal(1) == True`` and ``'1' != 1``.
A cell becomes ``tag:text`` so that equal values have equal text:

* NULL -> ``0:``
* booleans and numbers -> ``n:`` + integer text when integral, else double text
* strings -> ``s:`` + text; dates ``d:``, timestamps ``t:``, binary ``b:`` hex
* anything else -> ``x:`` + JSON
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

NULL_CELL = "0:"


def _num(c: Column) -> Column:
    d = c.cast("double")
    finite = ~F.isnan(d) & (F.abs(d) < F.lit(9.0e18))
    integral = finite & (d == F.floor(d))
    return F.concat(F.lit("n:"), F.when(integral, d.cast("long").cast("string"))
                    .otherwise(F.when(d == 0, F.lit("0")).otherwise(d.cast("string"))))


def canonical_cell(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, T.BooleanType):
        body = F.concat(F.lit("n:"), F.when(c, F.lit("1")).otherwise(F.lit("0")))
    elif isinstance(dt, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        body = F.concat(F.lit("n:"), c.cast("string"))
    elif isinstance(dt, (T.FloatType, T.DoubleType, T.DecimalType)):
        body = _num(c)
    elif isinstance(dt, (T.StringType, T.CharType, T.VarcharType)):
        body = F.concat(F.lit("s:"), c)
    elif isinstance(dt, T.DateType):
        body = F.concat(F.lit("d:"), c.cast("string"))
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        body = F.concat(F.lit("t:"), c.cast("string"))
    elif isinstance(dt, T.BinaryType):
        body = F.concat(F.lit("b:"), F.hex(c))
    else:
        body = F.concat(F.lit("x:"), F.to_json(F.struct(c.alias("v"))))
    return F.when(c.isNull(), F.lit(NULL_CELL)).otherwise(body)


def cells_array(df, cols: list[str] | None = None) -> Column:
    """``array<string>`` of canonical cells for the given columns, in order.

    Without ``cols`` every column is taken by position, so results with equal
    column names need ``df.toDF(...)`` first (see ``result_cells``)."""
    fields = [f for f in df.schema.fields if cols is None or f.name in cols]
    if cols is not None:
        order = {c: i for i, c in enumerate(cols)}
        fields.sort(key=lambda f: order[f.name])
    cells = [canonical_cell(F.col("`" + f.name.replace("`", "``") + "`"), f.dataType) for f in fields]
    return (F.array(*cells) if cells else F.array()).cast("array<string>")


def result_cells(df):
    """``df`` as one column ``cells``; columns are told apart by position, so
    a result may repeat column names (joins, ``count(*), count(*)``)."""
    d = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    return d.select(cells_array(d).alias("cells"))


def cell_value(cell: Column) -> Column:
    """Text after the tag (``NULL`` for a NULL cell)."""
    return F.when(cell == NULL_CELL, F.lit(None).cast("string")).otherwise(F.substr(cell, F.lit(3)))
